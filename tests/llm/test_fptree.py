"""Ranked search: tries against scoring every document, pruning, blocks, odd inputs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from hirelake.llm.fptree import Best, Corpus, TreePlan, Trie, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, rank string, score string, n string"


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def expected(docs, items, k=10):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, want in asked.items():
        scored = []
        for i, c in docs:
            m = 10 + 90 * sum(c.values()) * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in want if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def given(spark):
    rng = random.Random(8)
    zipf = [f"t{k}é" if k % 5 == 0 else f"T{k}" for k in range(300) for _ in range(1 + 200 // (k + 1))]
    docs = [(i, rng.choice([" ", "_", "\n"]).join(rng.choices(zipf, k=rng.randint(0, 60)))) for i in range(900)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)]
    docs += [(2000, None), (2001, ""), (2002, "--- ,"), (2003, "t1 " * 40_000), (2004, "q" * 100_000), (5, docs[5][1]), (None, docs[6][1])]
    items = [(i, " ".join(rng.choices(zipf, k=rng.randint(1, 25)))) for i in range(40)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, docs[5][1]), (54, "T1 t1 T1"), (0, "T7 t250é"), (None, "T3 T9")]
    df = spark.createDataFrame([(i, t, "own", "own", "own") for i, t in docs], SCHEMA)
    return docs, items, df, spark.createDataFrame(items, "item_id long, text string")


def test_same_rows_as_scoring_everything(given):
    docs, items, df, asked = given
    want = expected(docs, items)
    for plan in (TreePlan(), TreePlan(chunk=50, leaf=3), TreePlan(block_terms=60)):
        out = rank_documents(df.repartition(3), asked, plan)
        assert out.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, out.collect()), key=str) == want


def test_empty_tables(spark, given):
    _, _, df, asked = given
    assert rank_documents(df.limit(0), asked).collect() == []
    assert rank_documents(df, asked.limit(0)).collect() == []


def test_trie_shares_paths_and_bounds_hold():
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(60, rng.integers(1, 20), replace=False)) for _ in range(400)]
    rows += [rows[0]] * 100
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    ranks = np.concatenate(rows)
    tfs, m = rng.integers(1, 9, len(ranks)), rng.integers(10, 300, len(rows))
    trie = Trie(np.arange(len(rows)), m, starts, ranks, tfs, 8)
    weights = rng.integers(0, 9000, len(trie.asked))
    gain = np.concatenate([[0], np.cumsum(weights[trie.ranks] * trie.gain)])
    scores = gain[trie.starts[1:]] - gain[trie.starts[:-1]]
    covered = []
    for node in range(len(trie.low)):
        lo, hi = trie.low[node], trie.high[node]
        assert scores[lo:hi].max() <= trie.bound[node] @ weights
        kids = range(trie.first[node], trie.end[node])
        if len(kids):
            assert [trie.low[kids[0]], trie.high[kids[-1]]] == [lo, hi]
            assert all(trie.high[a] == trie.low[a + 1] for a in kids[:-1])
        else:
            covered += range(lo, hi)
    assert sorted(covered) == list(range(len(rows)))


def test_search_leaves_out_what_cannot_matter():
    rng = np.random.default_rng(6)
    best = Best(1, np.arange(50, 60), np.full(10, 1000), 10)
    for part in range(4):
        # Ten subjects of ten terms; the item is about one of them.
        rows = [np.sort(rng.choice(10, rng.integers(3, 9), replace=False)) + 10 * rng.integers(10) for _ in range(500)]
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        ranks, tfs = np.concatenate(rows), rng.integers(1, 4, starts[-1])
        trie = Trie(np.arange(500) + 500 * part, np.full(500, 50), starts, ranks, tfs, 8)
        assert trie.search(best) < 0.3 * len(trie.low)
    assert len(best.rows) == 10


def test_weights_never_fall_below_zero():
    corpus = Corpus(10, 100, np.arange(2), np.array([0, 47]))
    assert corpus.m(np.array([0, 10])).tolist() == [10, 100]
