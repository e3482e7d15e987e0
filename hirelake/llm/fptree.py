"""Ranked lexical search over a document FP-tree.

Documents are reduced to the terms that the items ask for, most frequent term first, so
that similar documents share their first terms. Chunks of documents become tries whose
nodes know, for every term, the greatest frequency below them and the least length
measure m; both bound the score of any document below. Each item walks a trie depth
first, best bound first, and leaves out what cannot reach its ten best so far. A task
carries an item's ten best from chunk to chunk and sends no more than those.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder
from hirelake.llm.terms import term_slices

#: Sorts after every id; stands for a null one.
NO_ID = 2**63 - 1


@dataclass(frozen=True)
class TreePlan:
    """`k` results an item; tries of `chunk` documents end in leaves of about `leaf`; items of about `block_terms` terms share a pass."""

    k: int = 10
    chunk: int = 2048
    leaf: int = 16
    block_terms: int = 1 << 15
    salts: int = 32


@dataclass(frozen=True)
class Corpus:
    """N documents with a term, L terms in all; rank and weight of every asked term."""

    n_docs: int
    n_terms: int
    rank: np.ndarray
    weight: np.ndarray

    def m(self, length: np.ndarray) -> np.ndarray:
        return 10 + 90 * length * self.n_docs // max(self.n_terms, 1)


def saturated(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a weight is multiplied by; grows with tf and falls with m."""
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def restricted(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, tfs) of rows (doc_id, text): number of all terms, and the asked ones (by their place in `vocabulary`) with frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(vocabulary, pa.large_string())
        size = max(len(vocabulary), 1)
        for batch in batches:
            at = 0
            for words, doc, n in term_slices(batch.column(1)):
                place = pc.index_in(words, asked)
                hit = place.is_valid().to_numpy(zero_copy_only=False)
                pair, tf = np.unique(doc[hit].astype(np.int64) * size + place.filter(pa.array(hit)).to_numpy(), return_counts=True)
                offsets = pa.array(np.searchsorted(pair // size, np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, n), pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array((pair % size).astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32))),
                ], names=["doc_id", "n", "terms", "tfs"])
                at += n

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def statistics(vectors: DataFrame, size: int) -> Corpus:
    """Counts over all rows of `restricted`: every task adds its own up, and one number a term reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n = batch.column(0).to_numpy()
            n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=size)
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *hit.tolist()], pa.int64()), pa.array([n_docs, n_terms, *df[hit].tolist()], pa.int64())], names=["term", "n"])

    sums = {r.term: r.n for r in vectors.select("n", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs, df = sums.get(-2, 0), np.array([sums.get(t, 0) for t in range(size)], np.int64)
    order = np.argsort(-df, kind="stable")
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
    return Corpus(n_docs, sums.get(-1, 0), rank, weight)


@dataclass
class Best:
    """An item's terms (as ranks), their weights, and its best documents so far: (-score, id), best first."""

    item: int | None
    ranks: np.ndarray
    weights: np.ndarray
    k: int
    rows: list[tuple[int, int]] = field(default_factory=list)

    def least(self) -> int:
        """A document needs this score to matter."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least())
        if len(good) > self.k:
            good = good[np.lexsort((ids[good], -scores[good]))[: self.k]]
        if len(good):
            self.rows = sorted(self.rows + [(-int(s), int(i)) for s, i in zip(scores[good], ids[good])])[: self.k]


class Trie:
    """Documents sorted by their ranks, as a compressed prefix tree over ranges of them.

    Node 0 is the root; the children of a node are neighbours in the numbering. `bound`
    has, per node and rank, what a unit of the rank's weight can add to a score below it.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, starts: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, leaf: int):
        by = sorted(range(len(ids)), key=lambda d: ranks[starts[d]:starts[d + 1]].astype(">i4").tobytes())
        take = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in by])
        length = (starts[1:] - starts[:-1])[by]
        self.ids, self.m = ids[by], m[by]
        self.starts = np.concatenate([[0], np.cumsum(length)])
        self.tfs = tfs[take]
        self.asked, self.ranks = np.unique(ranks[take], return_inverse=True)
        self.gain = saturated(self.tfs, np.repeat(self.m, length))
        self._split(leaf)
        self._bounds()

    def _shared(self) -> np.ndarray:
        """How many first ranks each document shares with the one before it."""
        out = np.zeros(len(self.ids), np.int64)
        for i in range(1, len(out)):
            a, b = self.ranks[self.starts[i - 1]:self.starts[i]], self.ranks[self.starts[i]:self.starts[i + 1]]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            out[i] = differ[0] if len(differ) else n
        return out

    def _split(self, leaf: int) -> None:
        """Ranges of the documents below each node, and the first and end number of its children (equal for a leaf)."""
        shared = self._shared()
        self.low, self.high, self.first, self.end = [0], [len(self.ids)], [], []
        node = 0
        while node < len(self.low):
            lo, hi = self.low[node], self.high[node]
            self.first.append(len(self.low))
            inner = shared[lo + 1:hi]
            # Alike documents stay together however many they are.
            if hi - lo > leaf and inner.min() < max(int(self.starts[d + 1] - self.starts[d]) for d in (lo, hi - 1)):
                cuts = [lo, *(np.flatnonzero(inner == inner.min()) + lo + 1).tolist(), hi]
                at = 0
                while at < len(cuts) - 1:
                    # Small neighbours make one leaf below the path they share.
                    to = at + 1
                    while to < len(cuts) - 1 and cuts[to + 1] - cuts[at] <= leaf:
                        to += 1
                    self.low.append(cuts[at])
                    self.high.append(cuts[to])
                    at = to
            self.end.append(len(self.low))
            node += 1

    def _bounds(self) -> None:
        most = np.zeros((len(self.low), len(self.asked)), np.int32)
        least = np.zeros(len(self.low), np.int64)
        for node in reversed(range(len(self.low))):
            lo, hi = self.low[node], self.high[node]
            least[node] = self.m[lo:hi].min()
            if self.first[node] == self.end[node]:
                a, b = self.starts[lo], self.starts[hi]
                np.maximum.at(most[node], self.ranks[a:b], self.tfs[a:b])
            else:
                most[node] = most[self.first[node]:self.end[node]].max(0)
        self.bound = saturated(most, least[:, None]).astype(np.int32)

    def search(self, best: Best) -> int:
        """Take the trie's documents into the item's best; returns the number of nodes seen."""
        place = np.searchsorted(self.asked, best.ranks)
        known = place < len(self.asked)
        known[known] = self.asked[place[known]] == best.ranks[known]
        place, weights = place[known], best.weights[known]
        if not len(place):
            return 0
        worth = np.zeros(len(self.asked), np.int64)
        worth[place] = weights
        stack, seen = [(int(self.bound[0, place] @ weights), 0)], 0
        while stack:
            bound, node = stack.pop()
            if bound < best.least():
                continue
            seen += 1
            a, b = self.first[node], self.end[node]
            if a == b:
                lo, hi = self.low[node], self.high[node]
                x, y = self.starts[lo], self.starts[hi]
                gain = np.concatenate([[0], np.cumsum(worth[self.ranks[x:y]] * self.gain[x:y])])
                best.add(gain[self.starts[lo + 1:hi + 1] - x] - gain[self.starts[lo:hi] - x], self.ids[lo:hi])
                continue
            bounds = self.bound[a:b, place] @ weights
            # The last one put on the stack is seen first.
            stack += [(int(bounds[c]), a + int(c)) for c in np.argsort(bounds, kind="stable") if bounds[c] >= best.least()]
        return seen


def searched(vectors: DataFrame, items: list[tuple[int | None, np.ndarray]], corpus: Corpus, plan: TreePlan) -> DataFrame:
    """(item_id, doc_id, score): each task's best documents of each item, given as places in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests = [Best(i, np.sort(corpus.rank[t]), corpus.weight[t][np.argsort(corpus.rank[t])], plan.k) for i, t in items]
        for batch in batches:
            for at in range(0, batch.num_rows, plan.chunk):
                part = batch.slice(at, plan.chunk)
                has = pc.greater(pc.list_value_length(part.column(2)), 0)
                part = part.filter(has)
                if not part.num_rows:
                    continue
                ids = part.column(0).fill_null(NO_ID).to_numpy()
                size = pc.list_value_length(part.column(2)).to_numpy()
                starts = np.concatenate([[0], np.cumsum(size)])
                ranks, tfs = corpus.rank[part.column(2).flatten().to_numpy()], part.column(3).flatten().to_numpy()
                order = np.lexsort((ranks, np.repeat(np.arange(len(ids)), size)))
                trie = Trie(ids, corpus.m(part.column(1).to_numpy()), starts, ranks[order], tfs[order], plan.leaf)
                for best in bests:
                    trie.search(best)
        rows = [(b.item, None if i == NO_ID else i, -s) for b in bests for s, i in b.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "item_id long, doc_id long, score long")


def _first(rows: DataFrame, k: int, *keys: str | Column) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, plan: TreePlan = TreePlan()) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `k` best documents with a score above 0, equal ones by id.

    Rows of one item id are one item with the terms of all of them; an item or document
    without terms (null, empty, only separators) has no rows. Documents that repeat an id
    are ranked one by one; null ids come last. Other columns are not read. Items are taken in
    blocks of about `block_terms` terms, a pass over the documents each, so that what the
    driver and the tasks hold does not grow with the items.
    """
    folder = work_folder(docs.sparkSession)
    asked = stored(_item_terms(items), folder, "items")
    n_blocks = 1 + asked.count() // plan.block_terms
    block = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for b in range(n_blocks):
        pairs = asked.where(block == b).toArrow()
        terms = pairs["term"].unique()
        vocabulary = terms.to_pylist()
        place = pc.index_in(pairs["term"], terms).to_numpy()
        by_item: dict[int | None, list[int]] = {}
        for item, at in zip(pairs["item_id"].to_pylist(), place.tolist()):
            by_item.setdefault(item, []).append(at)
        vectors = stored(restricted(rows, vocabulary), folder, f"vectors{b}")
        part = searched(vectors, [(i, np.array(t)) for i, t in by_item.items()], statistics(vectors, len(vocabulary)), plan)
        found = part if found is None else found.unionByName(part)
    # Two steps, so that an item's rows of many tasks do not meet in one at once.
    some = _first(found, plan.k, "item_id", F.pmod(F.xxhash64("doc_id"), F.lit(plan.salts)))
    return _first(some, plan.k, "item_id").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _item_terms(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for words, doc, n in term_slices(batch.column(1)):
                ids = batch.column(0).slice(at, n).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([ids, words.cast(pa.string())], names=["item_id", "term"])
                at += n

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "item_id long, term string").distinct()


#: DuckDB SQL with the same rows as `rank_documents`.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM t, c GROUP BY term, n_docs),
s AS (SELECT i.item_id, t.r, sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * len(d.ws) * c.n_docs) // c.n_terms))))::BIGINT AS score
  FROM i JOIN t ON i.term = t.term JOIN w ON w.term = t.term JOIN d ON d.r = t.r, c GROUP BY i.item_id, t.r)
SELECT item_id, rank::INT AS rank, doc_id, score FROM
  (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s JOIN d ON s.r = d.r WHERE score > 0)
WHERE rank <= 10
"""
