"""Sampling against enumerated lattices; exact round trips."""

from collections import Counter

import numpy as np
import pytest

from hirelake.llm.sentencepieces import decode, decode_ids, encode, encode_slice, load
from hirelake.llm.wordhash import mix

TEXTS = [
    "the cat sat", "a ▁literal ▁▁  two  spaces\n\nnl\ttab\r\n", "日本語テキスト😀 ok", "", None, "x" * 9300 + " " + "é" * 100 + "xyz" * 4000,
    "   lead", "trail  ", "ünïcödé naïve ñandú <s> </s> <0x41> <unk>", "again and again " * 20_000, "\x00\x01",
]


@pytest.fixture(scope="module")
def vocabulary():
    return load()


def segmentations(unit, v):
    """All paths of a unit (spaces as U+2581) with their weights."""
    numbers = {int(c): i + 1 for i, c in enumerate(v.chars)}
    edges = dict(zip(v.keys.tolist(), v.child.tolist()))

    def piece(s):
        node = 0
        for c in s:
            node = edges.get(node << 20 | numbers.get(ord(c), 0), -1)
            if node < 0:
                return -1
        return int(v.piece_of[node])

    if not unit:
        return {(): 1.0}
    out = {}
    for k in range(1, min(len(unit), v.longest) + 1):
        p = piece(unit[:k])
        if p >= 0:
            for rest, w in segmentations(unit[k:], v).items():
                out[(p, *rest)] = w * v.weight[p]
    return out


@pytest.mark.parametrize("unit", ["there", " there", "tionable"])
def test_samples_follow_the_lattice(vocabulary, unit):
    n = 20_000
    data = np.frombuffer(unit.encode() * n, np.uint8)
    offsets = np.arange(n + 1) * len(unit)
    ids, counts = encode_slice(data, offsets, mix(np.arange(n, dtype=np.uint64)), vocabulary)
    ends = np.cumsum(counts)
    got = Counter(tuple(ids[e - c:e].tolist()) for e, c in zip(ends, counts))
    want = segmentations(unit.replace(" ", "▁"), vocabulary)
    total = sum(want.values())
    assert set(got) <= set(want) and len(got) > 1
    for path, w in want.items():
        p = w / total
        assert abs(got[path] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3


def test_long_units_sample_alike():
    """The logarithmic path of long units gives valid, varied pieces."""
    vocabulary = load(alpha=0.2)
    unit = "internationalisation" * 10
    data = np.frombuffer(unit.encode() * 50, np.uint8)
    ids, counts = encode_slice(data, np.arange(51) * len(unit), mix(np.arange(50, dtype=np.uint64)), vocabulary)
    ends = np.cumsum(counts)
    paths = [tuple(ids[e - c:e]) for e, c in zip(ends, counts)]
    assert len(set(paths)) > 10 and all(decode_ids(np.array(p), vocabulary).tobytes().decode() == unit for p in paths)


def test_round_trip_and_reruns(spark, vocabulary):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no key", "x"), (0, TEXTS[0], "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pieces string")
    coded = encode(docs, vocabulary)
    out = decode(coded, vocabulary).collect()
    assert all(r.lossless for r in out) and len(out) == len(rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in out) == sorted((i if i is not None else -1, t or "") for i, t, _ in rows)
    first = {(r.doc_id, tuple(r.pieces)) for r in out}
    again = {(r.doc_id, tuple(r.pieces)) for r in encode(docs.repartition(5), vocabulary).collect()}
    other = {(r.doc_id, tuple(r.pieces)) for r in encode(docs, vocabulary, seed=2).collect()}
    assert first == again and first != other
    assert encode(docs.limit(0), vocabulary).collect() == []
