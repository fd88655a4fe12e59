import numpy as np
from dqloom.llm.vp_search import build, nearest, search
from pyspark.sql import functions as F


def brute(rows, k):
    use = [(i, np.array(v, float)) for i, v in rows if i is not None and v and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in use:
        if q % 20 == 0:
            s = sorted((-float(v @ x), i) for i, x in use if i != q)
            out.setdefault(q, [(n + 1, i, -d) for n, (d, i) in enumerate(s[:k])])
    return out


def test_factor_one_is_exact_and_larger_factors_keep_recall():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 6)) * rng.uniform(0.1, 1, size=(3000, 1))
    q, ids = x[:60], np.arange(3000)
    nodes = build(x, leaf=50)
    d = np.sqrt(((q[:, None] - x[None]) ** 2).sum(-1))
    d[np.arange(60), np.arange(60)] = np.inf
    want = np.argsort(d, axis=1, kind="stable")[:, :10]
    got, _ = search(nodes, x, ids, q, ids[:60], k=10)
    assert (got == want).all()
    loose, _ = search(nodes, x, ids, q, ids[:60], k=10, factor=2.0)
    assert sum(len(set(a) & set(b)) for a, b in zip(loose, want)) >= 0.9 * want.size


def test_query_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(400)]
    rows += [(400, None), (420, [0.0, 0.0, 0.0]), (440, [1.0, None, 0.0]), (460, [1.0, float("nan"), 0.0]), (480, [1.0, float("inf"), 2.0]), (500, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (520, [])]
    rows += [(600 + k, rows[40][1]) for k in range(30)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("score", F.lit(1))
    exact = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    got = {}
    for r in nearest(df, F.col("id") % 20 == 0, k=20, shard_rows=100, query_rows=7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(exact, 20)
    assert set(got) == set(want)
    for q in want:
        g = sorted(got[q])
        assert [x[:2] for x in g] == [x[:2] for x in want[q]]
        assert np.allclose([x[2] for x in g], [x[2] for x in want[q]], rtol=0, atol=1e-12)
    assert nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0
    few = nearest(df.filter("vec_id in (0, 1, 2)"), F.col("id") % 20 == 0)
    assert sorted((r.query_id, r.rank) for r in few.collect()) == [(0, 1), (0, 2)]


def test_one_very_long_vector_does_not_blur_the_others(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[7] *= 1e6
    x[100:140] = x[40]  # ties
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.col("id") % 20 == 0, k=20, shard_rows=200).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    exact = np.einsum("qj,ij->qi", x[::20], x)
    assert len(got) == 25
    for q, s in zip(range(0, 500, 20), exact):
        want = [i for i in np.lexsort((np.arange(500), -s)) if i != q][:20]
        assert [i for _, i in sorted(got[q])] == want


def test_norms_up_to_a_billion_times_shorter():
    rng = np.random.default_rng(6)
    for ratio in (1e3, 1e6, 1e9):
        x = rng.normal(size=(2000, 16))
        x /= np.linalg.norm(x, axis=1)[:, None]
        x[7] *= ratio
        ids, scale = np.arange(2000), 1 / np.sqrt((x * x).sum(1).max())
        y = np.column_stack([x * scale, np.sqrt(np.maximum(1 - ((x * scale) ** 2).sum(1), 0))])
        z = np.column_stack([x[:50] * scale, np.zeros(50)])
        got, _ = search(build(y, leaf=100), y, ids, z, ids[:50], 20, 1.0, x, x[:50], scale)
        s = np.einsum("qj,ij->qi", x[:50], x)
        s[np.arange(50), np.arange(50)] = -np.inf
        assert (got == np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, :20]).all()
