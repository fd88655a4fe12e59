import datetime as dt

from dqloom.operators import dates as D
from dqloom.operators import findings as G
from dqloom.operators import profile as P

KINDS = {"k": "identifier", "day": "date", "at": "time", "amount": "float", "tel": "phone"}
ROWS = [
    ("AB1", "2024-01-01", "10:00", "5", "+20 123 4567"), ("AB2", "1899-01-05", "24:00", "EGP 7", "12 (3)-- .4"), ("ab-3", "soon", "07:61 PM", "007", " +20 123 4567"),
    ("ab-3", "2024-01-09", "0:30 am", "x", None), (None, "n/a", "noon", "NULL", "-"),
]


def counted(spark, rows):
    return P.value_counts(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in KINDS)))


def test_what_is_odd_about_values(spark):
    counts = counted(spark, ROWS)
    got = {(r.column, r.code): r for r in G.summed(G.problems(counts, KINDS, votes=D.evidence(counts), run_date=dt.date(2024, 1, 8))).collect()}
    assert {k: (r.rows, [x["value"] for x in r.top]) for k, r in got.items()} == {
        ("day", "NULL_TOKENS"): (1, ["n/a"]), ("day", "MIXED_TYPES"): (1, ["soon"]), ("day", "VERY_OLD_DATES"): (1, ["1899-01-05"]), ("day", "FUTURE_DATES"): (1, ["2024-01-09"]),
        ("at", "OUT_OF_RANGE_TIMES"): (3, ["07:61 PM", "0:30 am", "24:00"]), ("at", "MIXED_TYPES"): (1, ["noon"]),
        ("amount", "MIXED_TYPES"): (2, ["EGP 7", "x"]), ("amount", "NUMBER_FORMAT_VARIANTS"): (1, ["EGP 7"]), ("amount", "LEADING_ZEROS"): (1, ["007"]), ("amount", "NULL_TOKENS"): (1, ["NULL"]),
        ("tel", "INVALID_FORMAT"): (1, ["12 (3)-- .4"]), ("tel", "WHITESPACE"): (1, [" +20 123 4567"]), ("tel", "NULL_TOKENS"): (1, ["-"]),
    }
    assert [k for k, r in got.items() if r.midnight] == [("at", "OUT_OF_RANGE_TIMES")]
    shapes = [r for r in G.layouts(counts, KINDS).orderBy("column", "rank").collect() if r.column == "k"]
    assert [(r.layout, r.n, r.example, r.layouts, r.of) for r in shapes] == [("AA9", 2, "AB1", 2, 4), ("aa-9", 2, "ab-3", 2, 4)]
    said = G.notes("time", {"rows": 5, "missing_count": 0, "distinct_count": 5}, {"OUT_OF_RANGE_TIMES": got["at", "OUT_OF_RANGE_TIMES"].asDict(recursive=True)}, [])
    assert said == [{"code": "OUT_OF_RANGE_TIMES", "detail": "3 times do not exist: '07:61 PM' (1), '0:30 am' (1), '24:00' (1). 24:00 seems to mean the end of a day."}]


def test_empty_and_hot_columns(spark):
    assert G.summed(G.problems(counted(spark, ROWS).limit(0), KINDS)).count() == 0 and G.layouts(counted(spark, ROWS).limit(0), KINDS).count() == 0
    counts = spark.range(20_000).selectExpr("'at' as column", "concat(24 + id % 70, ':', lpad(cast(id % 60 as string), 2, '0')) as value", "1L as n")
    (row,) = G.summed(G.problems(counts, KINDS)).collect()
    assert (row.rows, len(row.top)) == (20_000, 5)
    stats = {"rows": 3, "missing_count": 3, "distinct_count": 0}
    assert [x["code"] for x in G.notes("empty", stats, {}, [])] == ["ALL_MISSING"]
