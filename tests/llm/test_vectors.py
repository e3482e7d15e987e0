"""Vector near-duplicates and nearest neighbours against all pairs."""

import numpy as np
import pytest

from hirelake.llm.pqdedup import PqPlan, near_duplicates
from hirelake.llm.srsearch import SrsPlan, chi_square_quantile, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, component string, v string"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 32))
    for i in range(300, 600):  # near ones at many similarities
        t = rng.uniform(0.05, 0.7)
        x[i] = x[i - 300] / np.linalg.norm(x[i - 300]) + t * rng.standard_normal(32) / np.sqrt(32)
    hub = rng.standard_normal(32)
    x[600:700] = hub + 0.1 * rng.standard_normal((100, 32))
    x[700:760] = x[5]
    x[760:770] = 3 * x[6]
    rows = [(int(i) * 10, [float(a) for a in v.astype(np.float32)], 1, "c", "v") for i, v in enumerate(x)]
    bad = [None, [], [0.0] * 32, [None] + [1.0] * 31, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [1.0, 2.0]]
    rows += [(20_000 + i, v, None, "", "") for i, v in enumerate(bad)] + [(None, rows[0][1], 0, "", ""), rows[3], rows[3]]
    return spark.createDataFrame(rows, SCHEMA), {r[0]: np.array(r[1]) for r in rows[:900]}


def units(vectors):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids])
    return ids, x / np.linalg.norm(x, axis=1, keepdims=True)


def test_links_equal_all_pairs(table):
    df, vectors = table
    ids, x = units(vectors)
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    got = near_duplicates(df, PqPlan(block=64))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"] and got.count() == df.count()
    out = {r.vec_id: r for r in got.collect()}
    label = np.arange(len(ids))
    for _ in range(50):
        label = np.minimum(label, np.where(near, label[None, :], len(ids)).min(1))
    links = np.array([out[i].n_links for i in ids])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.99 * near.sum()
    comp = np.array([out[i].component_id for i in ids])
    assert (comp == ids[label]).mean() > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for i, r in out.items() if i is not None)
    assert all(out[20_000 + i].n_links == 0 and out[20_000 + i].kept for i in range(7)) and out[None].component_id is None


def test_no_usable_vectors(spark, table):
    df, _ = table
    assert near_duplicates(df.limit(0)).collect() == []
    rows = near_duplicates(df.where("vec_id in (20000, 20002)")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in rows) == [(20000, 0, 20000, True), (20002, 0, 20002, True)]
    one = near_duplicates(df.where("vec_id = 20006")).collect()
    assert [(r.vec_id, r.n_links, r.kept) for r in one] == [(20006, 0, True)]


def test_nearest_equal_brute_force(table):
    df, vectors = table
    ids, x = units(vectors)
    for plan in (SrsPlan(), SrsPlan(cell=64, leaf=8)):
        got = nearest(df, plan).collect()
        by = {}
        for r in got:
            by.setdefault(r.query_id, []).append(r)
        asked = [i for i in ids if i % 50 == 0]
        assert set(by) == set(asked) and all(len(v) == 5 for v in by.values())
        hits = 0
        for i in asked:
            rows = sorted(by[i], key=lambda r: r.rank)
            assert [r.rank for r in rows] == [1, 2, 3, 4, 5]
            cos = x @ x[np.flatnonzero(ids == i)[0]]
            assert all(abs(r.score - cos[np.flatnonzero(ids == r.vec_id)[0]]) < 1e-12 for r in rows)
            assert all((a.score, -a.vec_id) >= (b.score, -b.vec_id) for a, b in zip(rows, rows[1:]))
            cos[ids == i] = -2
            kth = np.sort(cos)[-5]
            hits += sum(r.score >= kth - 1e-12 for r in rows)
        assert hits / (5 * len(asked)) >= 0.9


def test_nearest_ties_few_and_none(spark, table):
    df, _ = table
    assert nearest(df.limit(0)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (50, [1.0, 1.0])], "vec_id long, embedding array<double>")
    out = sorted((r.query_id, r.rank, r.vec_id) for r in nearest(few).collect())
    assert out == [(0, 1, 50), (0, 2, 1), (0, 3, 2), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    copies = spark.createDataFrame([(i, [0.3, 0.4, 0.5]) for i in range(200)], "vec_id long, embedding array<float>")
    rows = nearest(copies, SrsPlan(cell=16, leaf=4)).where("query_id = 100").orderBy("rank").collect()
    assert [r.vec_id for r in rows] == [0, 1, 2, 3, 4]


def test_chi_square_quantiles():
    assert abs(chi_square_quantile(0.95, 8) - 15.507) < 1e-3 and abs(chi_square_quantile(0.5, 2) - 1.38629) < 1e-4
