"""SetSketch near-duplicates against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hirelake.llm import setsketch
from hirelake.llm.setsketch import SketchPlan, _block_pairs, estimate, may_link, near_duplicates, set_bits, sketch

SCHEMA = "doc_id long, text string, component string, n string"


def shingles(text, size=5):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, key = [], 0
    passage = say(200)
    for _ in range(12):
        base = say(rng.choice([6, 40, 150, 400]))
        for _ in range(rng.choice([1, 2, 5])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((key, " ".join(words)))
            key += 3
    for _ in range(40):  # one passage that many share, below the threshold
        rows.append((key, " ".join(say(90) + passage)))
        key += 1
    rows += [(key + 1, None), (key + 2, ""), (key + 3, " \t\n"), (key + 4, "one two"), (key + 5, "One\ttwo"), (key + 6, "three")]
    rows += [(key + 7, " ".join(say(30_000)))] * 2 + [(None, "one two"), (None, None)]
    return rows


def test_equals_all_pairs(spark):
    rows = corpus()
    given = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = near_duplicates(given, SketchPlan(block=4)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    sizes = dict(rows)
    assert all(r.n_shingles == len(shingles(sizes[r.doc_id])) for r in got if r.doc_id is not None)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sketches_merge_and_estimate():
    plan = SketchPlan(bands=64, rows=5)
    rng = np.random.default_rng(1)
    a = rng.integers(1, 2**63, 900, dtype=np.uint64)
    b = np.concatenate([a[:600], rng.integers(1, 2**63, 300, dtype=np.uint64)])
    who = np.repeat([0, 1], 900)
    regs = sketch(who, np.concatenate([a, b]), 2, plan)
    est = estimate(regs[:1], regs[1:], np.array([900.0]), np.array([900.0]), plan.base)[0]
    assert abs(est - 600 / 1200) < 0.12
    both = np.unique(np.concatenate([a, b]))
    union = sketch(np.zeros(len(both), int), both, 1, plan)[0]
    assert (np.maximum(regs[0], regs[1]) == union).mean() > 0.95


def test_same_shingle_count_as_whole_text(spark):
    text = "A b c d e f " * 50_000
    got = near_duplicates(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.n_shingles == len(shingles(text)) == 6


def test_bound_of_bitmaps_rejects_no_link():
    plan = SketchPlan()
    rng = np.random.default_rng(5)
    for n in (1, 7, 300, 9_000):
        whole = rng.integers(1, 2**63, 2 * n, dtype=np.uint64)
        for shared in {0, n // 2, (6 * n) // 7, (6 * n) // 7 + 1, n}:
            a, b = whole[:n], whole[n - shared:2 * n - shared]
            bits = set_bits(np.repeat([0, 1], n), np.concatenate([a, b]), 2, plan)
            size = np.array([n])
            good, most = may_link(bits[:1], bits[1:], size, size, 75)
            assert most[0] >= shared
            assert good[0] or 100 * shared < 75 * (2 * n - shared)


def test_near_copies_of_an_absent_text_send_few_pairs(spark, tmp_path, monkeypatch):
    """Documents that share a text they all differ from: alike below the threshold, in the same buckets."""
    rng = random.Random(11)
    counts = []
    for n in (60, 240):
        base = [f"b{i}" for i in range(300)]
        rows = []
        for k in range(n):
            words = list(base)
            for at in rng.sample(range(300), 7):
                words[at] = f"x{k}-{at}"
            rows.append((k, " ".join(words)))
        root = tmp_path / str(n)
        monkeypatch.setattr(setsketch, "work_folder", lambda _: str(root))
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        want = brute(rows)
        assert all(r.component_id == want[r.doc_id] for r in got)
        counts.append(sum(spark.read.parquet(str(p)).count() for p in root.iterdir() if p.name.startswith("more-")))
    assert counts[1] <= 3 * 240


@pytest.mark.parametrize("n_near", [3, 40])
def test_a_block_is_compared_as_one_table(n_near):
    """Pairs of a block are those that a comparison one by one finds; a crowded block sends each member's best."""
    plan, rng = SketchPlan(), np.random.default_rng(4)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [base.copy() for _ in range(n_near)] + [rng.integers(0, 2**63, k, dtype=np.uint64) for k in (300, 40, 900)]
    for s in sets[:n_near]:
        s[rng.choice(300, 20, replace=False)] = rng.integers(0, 2**63, 20, dtype=np.uint64)
    who, n = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.array([len(s) for s in sets])
    regs, bits = sketch(who, np.concatenate(sets), len(sets), plan), set_bits(who, np.concatenate(sets), len(sets), plan)
    raw = [regs[k].tobytes() + bits[k].tobytes() for k in range(len(sets))]
    ids = np.arange(len(sets)) * 7 + 5
    half = pa.table({"doc_id": ids, "comp": ids, "n": n, "sketch": raw})
    rows = pa.concat_tables([half.append_column("side", pa.array([k] * len(ids))) for k in (0, 1)])
    pairs = {}
    for a in range(len(sets)):
        good, shared = may_link(bits[a:a + 1], bits, n[a], n, plan.percent)
        est = estimate(np.repeat(regs[a:a + 1], len(sets), 0), regs, np.full(len(sets), float(n[a])), n.astype(float), plan.base)
        share = shared / (n + n[a] - shared)
        pairs[a] = sorted((-share[b], ids[b]) for b in range(len(sets)) if b != a and good[b] and est[b] >= plan.percent / 100 - plan.slack)
    crowded = sum(map(len, pairs.values())) > rows.num_rows
    assert crowded == (n_near == 40)
    for every in (True, False):
        out = _block_pairs(plan, every)(rows).to_pydict()
        cut = crowded and not every
        want = [(ids[a], b) for a, found in pairs.items() for _, b in (found[:1] if cut else found)]
        assert list(zip(out["a"], out["b"])) == want and set(out["cut"]) == {cut}
    assert _block_pairs(plan, True)(rows.slice(0, len(sets))).num_rows == 0
