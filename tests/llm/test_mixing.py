from collections import defaultdict

import numpy as np
from dqloom.llm.mixing import fit_budget, mix, op4, shares


def test_shares():
    assert shares([10, 10], [1, 3]) == [5, 15]
    assert shares([1, 100], [3, 1]) == [3, 98]
    assert shares([0, 5], [1, 1]) == [0, 5]
    assert shares([], []) == []


def test_fit_budget_is_as_near_as_can_be():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lens = rng.choice(np.arange(1, 60), size=rng.integers(1, 7), replace=False)
        counts = rng.integers(1, 5, size=len(lens))
        budget = int(rng.integers(0, (lens * counts).sum() + 3))
        take = fit_budget(lens, counts, budget)
        sums = {0}
        for n, c in zip(lens, counts):
            sums = {s + k * int(n) for s in sums for k in range(c + 1)}
        got = int((take * lens).sum())
        assert (take <= counts).all() and (take >= 0).all() and got <= budget
        assert got == max(s for s in sums if s <= budget)


def check(rows):
    by = defaultdict(lambda: [0, 0, None, 0])
    for r in rows:
        x = by[r.source_size, r.target]
        x[1] += r.taken
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    for (_, target), (_, got, *_) in by.items():
        assert abs(got - target) <= max(2, 0.02 * target)


def test_op4(spark, sf, sf_empty):
    rows = op4(spark, sf).collect()
    assert len(rows) == 13 and sorted(map(str, rows)) == sorted(map(str, op4(spark, sf).collect()))
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert op4(spark, sf_empty).count() == 0


def test_near_targets_on_a_hot_source(spark, tmp_path):
    df = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', int(if(id % 3 = 0, 7, 1 + pmod(hash(id), 90)))) as text", "if(id % 3 = 0, 'a', concat('s', id % 5)) as source")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = op4(spark, str(tmp_path)).collect()
    check(rows)
    assert sum(r.taken for r in rows) <= sum(r.size for r in rows)


def test_rows_without_an_id_of_their_own_are_told_apart(spark, tmp_path):
    """No id at all, or one id for all, with different and with equal texts: exactly as many as are wanted are taken."""
    for name, id_, text in (("null", "cast(null as long)", "concat_ws(' ', 'w', id, 'x', id)"), ("same", "7L", "concat_ws(' ', 'w', id, 'x', id)"), ("equal", "7L", "'w w w w'")):
        df = spark.range(400).repartition(5).selectExpr(f"{id_} as doc_id", f"{text} as text", "if(id % 2 = 0, 'a', 'b') as source")
        (tmp_path / name).mkdir()
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        rows = op4(spark, f"{tmp_path}/{name}").collect()
        got = defaultdict(int)
        for r in rows:
            got[r.target] += r.taken
        assert len(rows) == 400 and len(got) == 2 and all(abs(t - n) <= 4 for t, n in got.items())
        mixed = mix(spark.read.parquet(f"{tmp_path}/{name}/documents.parquet"))
        assert abs(mixed.count() - 400) <= 2


def test_mix_keeps_columns_and_repeats(clashing):
    got = mix(clashing)
    assert got.columns == clashing.columns and got.filter("doc_id = 4").count() == 0
