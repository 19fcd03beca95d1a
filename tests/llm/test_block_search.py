import numpy as np
import pytest

from rowforge.llm import block_search as bs


def brute(rows, queries, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q, a in [x for x in good if x[0] in queries]:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]             # ties
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [None] * 8), (404, [float("nan")] * 8),
             (405, [float("inf")] * 8), (None, [1.0] * 8), (420, [1.0, 2.0]), (440, [3.0, 4.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, rank string, score int")
    got = sorted(map(tuple, bs.nearest(df, df.where("vec_id % 20 = 0"), 20, query_rows=7, candidate_rows=50).collect()))
    want = brute(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 20)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


@pytest.mark.parametrize("scale", [1e-320, 1e-8, 1e12])
def test_bounds_hold_at_any_scale(spark, scale):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=5) * scale * 10.0 ** rng.integers(-2, 3)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, bs.nearest(df, df.where("vec_id % 20 = 0"), 5, candidate_rows=32).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in brute(rows, set(range(0, 120, 20)), 5)]


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in bs.nearest(df, df.where("vec_id = 0"), 20).orderBy("rank").collect()] == [
        (0, 1, 1, 2.0), (0, 2, 1, 2.0)]
    assert bs.nearest(df.limit(0), df.limit(0), 20).count() == 0
    assert bs.nearest(df, df.limit(0), 20).count() == 0
