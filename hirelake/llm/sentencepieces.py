"""Sampled segmentations into the pieces of a given SentencePiece model, and lossless decoding.

A text is cut into units that no piece crosses (before a run of spaces, around line
breaks, and within a unit of thousands of characters). A unit's pieces form a lattice; forward sums over it are filtered once per
distinct unit and kept by the task, and every occurrence samples its own path backwards,
with random numbers that depend on the seed, the row's key and the place alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.wordhash import U64, mix, text_slices

SPACE = 0x2581
LITERAL = 0x110000  # stands for a U+2581 of the text itself, which goes byte by byte
LONG = 48  # units above it are summed in logarithms, one by one
MOST = 4096  # no piece crosses a cut after so many characters of one unit
BLOCK = 400_000  # characters whose units are sampled together
KEPT = 450_000  # characters of units whose sums a task keeps; more than a block has
NEAR = 0x800  # characters below it are numbered by a table
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Vocabulary:
    """The model as arrays: a trie over its characters, piece probabilities, piece bytes.

    The model has merge ranks, not probabilities; a piece of rank r has one in
    proportion to 1 / (r + 50), and a byte of a character that is no piece as the
    last rank. Weights are probabilities to the power `alpha`: 1 samples
    segmentations by probability, 0 all alike.
    """

    chars: np.ndarray
    keys: np.ndarray
    child: np.ndarray
    piece_of: np.ndarray
    weight: np.ndarray
    byte_weight: float
    first_byte: int
    longest: int
    data: np.ndarray
    offsets: np.ndarray


def load(path: str = MODEL, alpha: float = 0.3) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    usable = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in range(size)]
    first_byte = pieces.index("<0x00>")
    chars = np.array(sorted({ord(c) for p, ok in zip(pieces, usable) if ok for c in p}), np.int64)
    number = {int(c): i + 1 for i, c in enumerate(chars)}
    edges: dict[int, int] = {}
    piece_of = [-1]
    for i, p in enumerate(pieces):
        if not usable[i]:
            continue
        node = 0
        for c in p:
            key = node << 20 | number[ord(c)]
            if key not in edges:
                edges[key] = len(piece_of)
                piece_of.append(-1)
            node = edges[key]
        piece_of[node] = i
    keys = np.array(sorted(edges), np.int64)
    rank = np.arange(size, dtype=float)
    weight = 1.0 / (rank + 50)
    weight = (weight / weight[usable].sum()) ** alpha
    raw = [bytes([i - first_byte]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Vocabulary(
        chars, keys, np.array([edges[int(k)] for k in keys], np.int64), np.array(piece_of, np.int32), weight, float(weight[-1]),
        first_byte, max(len(p) for p, ok in zip(pieces, usable) if ok), np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]),
    )


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def _numbers(cp: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The number of each character in the trie, 0 for those of no piece."""
    j = np.minimum(np.searchsorted(v.chars, cp), len(v.chars) - 1)
    return np.where(v.chars[j] == cp, j + 1, 0)


def _edges(code: np.ndarray, room: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Piece ids (characters x longest, -1 for none) of the pieces that end at each place, by length; `room` is left in the unit."""
    found = np.full((len(code), v.longest), -1, np.int32)
    first = int(np.searchsorted(v.keys, 1 << 20))  # the root's edges come first
    root = np.zeros(len(v.chars) + 1, np.int64)
    root[v.keys[:first]] = v.child[:first]
    at, node = np.arange(len(code)), root[code]
    at, node = at[node > 0], node[node > 0]
    for k in range(v.longest):
        if k:
            fits = k < room[at]
            at, node = at[fits], node[fits]
            key = node << 20 | code[at + k]
            j = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
            hit = v.keys[j] == key
            at, node = at[hit], v.child[j[hit]]
        if not len(at):
            break
        found[at + k, k] = v.piece_of[node]
    return found


def _bytes_of(cp: np.ndarray) -> np.ndarray:
    """How many UTF-8 bytes each code point takes."""
    cp = np.where(cp == LITERAL, SPACE, cp)
    return 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)


def _uniform(state: np.ndarray) -> np.ndarray:
    return ((mix(state) >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _long_path(weights: np.ndarray, first: int, size: int, seeds: np.ndarray) -> list[int]:
    """Ends (relative) of one sampled path of a long unit; sums are kept as logarithms."""
    longest = weights.shape[1]
    alpha = [0.0] * (size + 1)
    w = weights[first:first + size].tolist()
    options: list[list[tuple[int, float]]] = [[]] * (size + 1)
    for e in range(1, size + 1):
        terms = [(k, alpha[e - k] + math.log(w[e - 1][k - 1])) for k in range(1, min(longest, e) + 1) if w[e - 1][k - 1] > 0]
        top = max(t for _, t in terms)
        parts = [(k, math.exp(t - top)) for k, t in terms]
        alpha[e] = top + math.log(sum(p for _, p in parts))
        options[e] = parts
    out, e, draws = [], size, _uniform(seeds).tolist()
    while e:
        out.append(e)
        left = draws[e - 1] * sum(p for _, p in options[e])
        for k, p in options[e]:
            left -= p
            if left <= 0:
                break
        e -= k
    return out


def encode_slice(data: np.ndarray, offsets: np.ndarray, row_seed: np.ndarray, v: Vocabulary, known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all texts, number of pieces of each); `known` keeps units from slice to slice."""
    known = known or Known()
    cp = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    n = len(cp)
    n_docs = len(offsets) - 1
    if not n:
        return np.zeros(0, np.int32), np.zeros(n_docs, np.int64)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    begin = lead[offsets]
    doc = np.repeat(np.arange(n_docs), np.diff(begin))
    cp[cp == SPACE] = LITERAL
    cp[cp == 0x20] = SPACE
    code = _numbers(np.arange(NEAR), v)[np.minimum(cp, NEAR - 1)]
    far = np.flatnonzero(cp >= NEAR)
    code[far] = _numbers(cp[far], v)
    # Units: before a run of spaces, and on both sides of a line break.
    cut = np.zeros(n + 1, bool)
    cut[begin] = True
    space, line = cp == SPACE, cp == 10
    cut[1:n] |= (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    cut[n] = True
    edge = np.flatnonzero(cut)
    if int(np.diff(edge).max()) > MOST:  # a unit without end is cut by length
        size = np.diff(edge)
        over = size > MOST
        extra = (size[over] - 1) // MOST
        cut[np.repeat(edge[:-1][over], extra) + (_ragged(np.ones(len(extra), np.int64), extra)) * MOST] = True
        edge = np.flatnonzero(cut)
    piece_at = np.full(n, -2, np.int32)  # by the place of a piece's last character
    seed_at = row_seed[doc] + (np.arange(n) - begin[doc]).astype(np.uint64) * U64(0x9E3779B97F4A7C15)
    blocks = np.searchsorted(edge, np.arange(0, n, BLOCK))
    for a, b in zip(blocks, [*blocks[1:], len(edge) - 1]):
        if b > a:
            _sample_units(cp, code, edge[a:b], np.diff(edge[a:b + 1]), seed_at, piece_at, v, known)
    # Pieces in order; characters without piece become their bytes.
    where = np.flatnonzero(piece_at > -2)
    ids = piece_at[where]
    raw = np.where(ids < 0, _bytes_of(cp[where]), 1)
    out = np.repeat(ids, raw)
    if (ids < 0).any():
        lost = np.flatnonzero(ids < 0)
        first_byte = np.flatnonzero((data & 0xC0) != 0x80)
        source = _ragged(first_byte[where[lost]], raw[lost])
        out[_ragged((np.cumsum(raw) - raw)[lost], raw[lost])] = data[source].astype(np.int32) + v.first_byte
    return out.astype(np.int32), np.bincount(doc[where], raw, n_docs).astype(np.int64)


class Known:
    """Lattices of the short units that a task has met, with their forward sums; bounded by `KEPT` characters.

    Units are told apart by a hash of their characters and length. When a
    block's new units do not fit, all are forgotten and the block's are computed anew.
    Each character has a row: the pieces that end at it by length, and the running
    sum, by length of that piece, of the paths up to its end.
    """

    def __init__(self) -> None:
        self.hashes, self.base, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        self.pid, self.total = np.zeros((0, 0), np.int32), np.zeros((0, 0))

    def bases(self, h: np.ndarray, cp: np.ndarray, code: np.ndarray, first: np.ndarray, size: np.ndarray, v: Vocabulary) -> np.ndarray:
        """The first row of each unit [first, first + size) of (different) hash `h`."""
        new = self._new(h)
        if self.used + int(size[new].sum()) > KEPT:
            self.hashes, self.base, self.used = self.hashes[:0], self.base[:0], 0
            new = np.ones(len(h), bool)
        if new.any():
            self._add(h[new], cp, code, first[new], size[new], v)
        return self.base[np.searchsorted(self.hashes, h)]

    def _new(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(h), bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)] != h

    def _add(self, h: np.ndarray, cp: np.ndarray, code: np.ndarray, first: np.ndarray, size: np.ndarray, v: Vocabulary) -> None:
        order = np.argsort(-size, kind="stable")  # long ones first, so that the k longest are a prefix
        h, first, size = h[order], first[order], size[order]
        chars = _ragged(first, size)
        base = np.cumsum(size) - size
        pid, w = _weights(cp, code, chars, np.repeat(base + size, size) - np.arange(len(chars)), v)
        # Forward sums by place in the unit; a power of 1000 a character keeps them in range.
        w *= 1000.0 ** np.arange(1, v.longest + 1)
        total = np.empty_like(w)
        gap = v.longest  # zeros before each unit, so that every place has as many sums before it
        alpha = np.zeros(len(chars) + (gap + 1) * len(size))
        slot = base + (gap + 1) * np.arange(len(size)) + gap  # alpha of unit i starts at slot[i]
        alpha[slot] = 1.0
        before = np.lib.stride_tricks.sliding_window_view(alpha, gap)[:, ::-1]
        for p in range(1, int(size[0]) + 1):
            live = int(np.searchsorted(-size, -p, "right"))
            last, here = base[:live] + p - 1, slot[:live] + p
            sums = np.cumsum(before[here - gap] * w[last], axis=1)
            total[last] = sums
            alpha[here] = sums[:, -1]
        end = self.used + len(chars)
        if end > len(self.total):
            room = max(min(2 * end, KEPT), end)
            self.pid = np.concatenate([self.pid[:self.used].reshape(-1, v.longest), np.zeros((room - self.used, v.longest), np.int32)])
            self.total = np.concatenate([self.total[:self.used].reshape(-1, v.longest), np.zeros((room - self.used, v.longest))])
        self.pid[self.used:end], self.total[self.used:end] = pid, total
        every = np.concatenate([self.hashes, h])
        sort = np.argsort(every, kind="stable")
        self.hashes, self.base = every[sort], np.concatenate([self.base, base + self.used])[sort]
        self.used = end


def _weights(cp: np.ndarray, code: np.ndarray, chars: np.ndarray, room: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids, weights) by length of the pieces that end at each of `chars`; a character without piece goes by bytes."""
    pid = _edges(code[chars], room, v)
    w = np.append(v.weight, 0.0)[pid]  # -1 is the last one
    no_piece = pid[:, 0] < 0
    w[no_piece, 0] = v.byte_weight ** _bytes_of(cp[chars[no_piece]])
    return pid, w


def _sample_units(cp: np.ndarray, code: np.ndarray, first: np.ndarray, size: np.ndarray, seed_at: np.ndarray, piece_at: np.ndarray, v: Vocabulary, known: Known) -> None:
    """Sample a path for each unit [first, first + size) and note its pieces in `piece_at` (-1: by bytes)."""
    short = size <= LONG
    if short.any():
        _sample_short(cp, code, first[short], size[short], seed_at, piece_at, v, known)
    if not short.all():
        first, size = first[~short], size[~short]
        base = np.cumsum(size) - size
        pid, w = _weights(cp, code, _ragged(first, size), np.repeat(base + size, size) - np.arange(int(size.sum())), v)
        for a, b, m in zip(first.tolist(), base.tolist(), size.tolist()):
            ends = _long_path(w, b, m, seed_at[a:a + m])
            for e, s in zip(ends, [*ends[1:], 0]):
                piece_at[a + e - 1] = pid[b + e - 1, e - s - 1]


def _sample_short(cp: np.ndarray, code: np.ndarray, first: np.ndarray, size: np.ndarray, seed_at: np.ndarray, piece_at: np.ndarray, v: Vocabulary, known: Known) -> None:
    # Distinct units, by a hash of their characters.
    where = _ragged(first, size)
    head = np.cumsum(size) - size
    within = np.arange(len(where)) - np.repeat(head, size)
    place_weight = mix(np.arange(LONG, dtype=np.uint64)) | U64(1)
    spread = mix(cp[where].astype(np.uint64) + U64(1))
    h = np.add.reduceat(spread * place_weight[within], head) + size.astype(np.uint64)
    h, pick, kind = np.unique(h, return_index=True, return_inverse=True)
    local = known.bases(h, cp, code, first[pick], size[pick], v)[kind]
    # Backward, all occurrences at once: the place after the piece to draw is start + left.
    left, start = size, first
    while len(left):
        last = local + left - 1
        place = start + left - 1
        sums = known.total[last]
        target = _uniform(seed_at[place]) * sums[:, -1]
        k = 1 + (sums[:, :-1] < target[:, None]).sum(1)
        piece_at[place] = known.pid[last, k - 1]
        left = left - k
        go = left > 0
        left, start, local = left[go], start[go], local[go]


def decode_ids(ids: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The UTF-8 bytes that the pieces stand for."""
    size = np.diff(v.offsets)[ids]
    return v.data[_ragged(v.offsets[ids], size)]


def encode(docs: DataFrame, vocabulary: Vocabulary, seed: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pieces, n_pieces, lossless): a sampled segmentation of every whole text.

    The same key, text and seed give the same pieces wherever the row is
    processed. lossless tells whether decoding gave the very text back. Null and empty
    texts have no pieces; null keys share a seed; other columns are not read.
    """
    v = vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for a, b, data, offsets in text_slices(batch.column(2), 1 << 20):
                row_seed = mix(keys[a:b] + mix(np.array([seed], np.uint64)))
                ids, counts = encode_slice(data, offsets, row_seed, v, known)
                back = decode_ids(ids, v)
                size = np.diff(v.offsets)[ids]
                ends = np.concatenate([[0], np.cumsum(counts)])
                got = np.concatenate([[0], np.cumsum(size)])[ends]
                bad = np.concatenate([[0], np.cumsum(back != data)]) if len(back) == len(data) else None
                same = (got == offsets) & True
                lossless = same[1:] & same[:-1] & (np.diff(bad[offsets]) == 0) if bad is not None else np.array(
                    [bytes(back[got[i]:got[i + 1]]) == bytes(data[offsets[i]:offsets[i + 1]]) for i in range(b - a)], bool)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), pa.array(counts), pa.array(lossless),
                ], names=[key, "pieces", "n_pieces", "lossless"])

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key), F.coalesce(F.xxhash64(F.col(key)), F.lit(0)).alias("key_hash"), F.col(text).cast("string"))
    return given.mapInArrow(run, f"`{key}` {kind}, pieces array<int>, n_pieces long, lossless boolean")


def decode(rows: DataFrame, vocabulary: Vocabulary, pieces: str = "pieces") -> DataFrame:
    """`rows` with the text of their pieces in a column `text` (replaced if there); null pieces give null."""
    v = vocabulary
    names = [c for c in rows.columns if c != "text"]
    schema = rows.select(*names).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index(pieces))
            texts = [None if x is None else decode_ids(np.array(x, np.int64), v).tobytes().decode() for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "text"])

    return rows.select(*names).mapInArrow(run, schema)
