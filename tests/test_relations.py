"""Relations of key columns against a plain count in Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dqloom.operators import profile as P
from dqloom.operators import relations as R


def plain(rows, names, keys):
    out, held = {}, defaultdict(set)
    for key in keys:
        for c in names:
            if c == key:
                continue
            by = defaultdict(Counter)
            for r in rows:
                k, v = r[names.index(key)], r[names.index(c)]
                if k is not None and v is not None:
                    by[k][v] += 1
                    held[key, c, v].add(k)
            if by:
                n, values = sum(sum(x.values()) for x in by.values()), sum(by.values(), Counter())
                out[key, c] = (n, len(by), sum(sum(x.values()) >= 2 for x in by.values()), sum(len(x) > 1 for x in by.values()), n - sum(max(x.values()) for x in by.values()), max(values.values()))
    return out, held


@pytest.mark.parametrize("hot", [2, 10_000])
def test_consistency_equals_a_plain_count(spark, monkeypatch, hot):
    """Also with a key on a third of the rows, met by broadcast (hot = 2: keys on half of the rows) or by shuffle."""
    monkeypatch.setattr(R, "HOT", hot)
    pick = random.Random(5)
    names = ["a id", "b", "c.d", "e"]
    rows = [("k0" if i % 3 else pick.choice([None, *(f"k{j}" for j in range(40))]), pick.choice([None, "x", "y"]), str(i) if i % 7 else "same", pick.choice(["u", None])) for i in range(600)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    r = R.relate(df, ["a id", "c.d"], names, {c: F.col(f"`{c}`") for c in names})
    want, held = plain(rows, names, ["a id", "c.d"])
    got = {(x["key"], x["column"]): tuple(x)[2:] for x in R.consistency(r).collect()}
    assert got == want
    counts = {(x["key"], x["column"], x["v"]): x["n"] for x in r.conflicts.groupBy("key", "column", "v").agg(F.countDistinct("k").alias("n")).collect()}
    assert all(n <= len(held[at]) for at, n in counts.items())
    repeats = {x["key"]: tuple(x)[1:] for x in R.key_repeats(r).collect()}
    seen = Counter(x[0] for x in rows if x[0] is not None)
    assert repeats["a id"] == (sum(seen.values()), len(seen), sum(n > 1 for n in seen.values()), sum(n for n in seen.values() if n > 1))
    r.discard()


def test_shared_values_of_keys_with_one_and_with_several_values(spark):
    rows = [(f"k{i}", "nobody" if i < 30 else f"v{i}") for i in range(200)] + [(f"k{i}", "nobody") for i in range(100, 105)]
    df = spark.createDataFrame(rows, "k string, v string")
    r = R.relate(df, ["k"], df.columns, P.present(df.columns))
    assert [tuple(x) for x in R.shared_values(r).collect()] == [("k", "v", "nobody", 35)]
    assert R.shared_values(r, []).count() == 0


def test_an_empty_table_and_columns_without_values(spark):
    df = spark.createDataFrame([], "k string, v string")
    r = R.relate(df, ["k"], df.columns, P.present(df.columns))
    assert [x.count() for x in (R.consistency(r), R.shared_values(r), R.key_repeats(r))] == [0, 0, 0]
    df = spark.createDataFrame([("a", None), ("a", None)], "k string, v string")
    assert R.consistency(R.relate(df, ["k"], df.columns, P.present(df.columns))).count() == 0


def test_numbers_of_all_columns_come_from_one_table_of_counts(spark):
    pick = random.Random(2)
    rows = [(str(pick.randint(-5, 40)), pick.choice(["0", "007", "1.5", "x", None]), "none") for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = {r["column"]: r.asDict() for r in P.numeric_profiles(P.numeric_values(P.value_counts(df))).collect()}
    import numpy as np

    for i, c in enumerate("ab"):
        x = np.array([float(r[i]) for r in rows if r[i] not in (None, "x")])
        g = got[c]
        assert (g["n"], g["min"], g["max"], g["zeros"], g["at_max"]) == (len(x), x.min(), x.max(), (x == 0).sum(), (x == x.max()).sum())
        assert np.allclose([g["mean"], g["std"], *(g[f"p{p}"] for p in (1, 5, 25, 50, 75, 95, 99))], [x.mean(), x.std(ddof=1), *np.percentile(x, (1, 5, 25, 50, 75, 95, 99))])
    assert got["b"]["leading_zeros"] == sum(r[1] == "007" for r in rows) and set(got) == {"a", "b"}
    assert P.numeric_profile(df, "c").first().asDict()["n"] == 0
