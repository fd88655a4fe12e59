import datetime as dt

from dqloom.operators import dates as D
from dqloom.operators.profile import profile, value_counts


def read(spark, column):
    counts = value_counts(spark.createDataFrame([(v,) for v in column], "v string"))
    return {r.value: r.t and r.t.isoformat(" ") for r in D.read_counted(counts, D.evidence(counts)).collect()}


def test_the_majority_of_a_group_decides(spark):
    got = read(spark, [f"{k}/{k + 12}/2024" for k in range(1, 10)] + ["13/01/2024", "02/03/24", "05.06.2024", "25.12.70", "24.12.69", "2024/13/02", "2024/02/01"])
    assert got["1/13/2024"] == "2024-01-13 00:00:00" and got["13/01/2024"] is None and got["02/03/24"] == "2024-02-03 00:00:00"
    assert got["05.06.2024"] == "2024-06-05 00:00:00" and got["25.12.70"] == "1970-12-25 00:00:00" and got["24.12.69"] == "2069-12-24 00:00:00"
    assert got["2024/13/02"] == "2024-02-13 00:00:00" and got["2024/02/01"] == "2024-01-02 00:00:00"


def test_layouts_of_one_reading(spark):
    want = {
        "2024-01-05 10:00:00": "2024-01-05 10:00:00", "2024-01-05T23:30:00.5-02:00": "2024-01-06 01:30:00.500000", "2024-01-05T10:00Z": "2024-01-05 10:00:00", "2024-02": "2024-02-01 00:00:00", "20240131": "2024-01-31 00:00:00",
        "20241331": None, "7 Sep 2023": "2023-09-07 00:00:00", "12-Aug-24": "2024-08-12 00:00:00", "Aug 2, 2024": "2024-08-02 00:00:00", "may": None, "2024-02-30": None, "31/02/2024": None, "1/2/3": None, "": None, "1.5": None,
    }
    assert read(spark, want) == want


def test_profile_tells_datetimes_and_stray_dates(spark):
    rows = [(f"2024-01-{k + 1:02d} 10:00:00", f"{k % 9 + 1}/{k % 9 + 13}/2024" if k else "13/01/2024", f"05/{k % 12 + 1:02d}/24") for k in range(31)]
    found = profile(spark.createDataFrame(rows, "seen string, due string, short string"), relationships=False, run_date=dt.date(2024, 1, 20))
    by = {c["column_name"]: c for c in found["columns"]}
    assert {c: x["logical_type"] for c, x in by.items()} == {"seen": "datetime", "due": "date", "short": "date"}
    assert by["seen"]["dates"] == {"min": "2024-01-01 10:00:00", "max": "2024-01-31 10:00:00"} and "FUTURE_DATES" in by["seen"]["observations"]
    assert by["due"]["dates"] == {"min": "2024-01-13", "max": "2024-09-21"} and "MIXED_DATE_CONVENTIONS" in by["due"]["observations"]
    assert "AMBIGUOUS_DATES" in by["short"]["observations"]
