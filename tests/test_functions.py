import datetime as dt

import pytest
from dqloom.functions import expression, numbers, temporal, templates, text
from dqloom.operators.typed import typed
from pyspark.sql import functions as F


def values(spark, column, *rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_text(spark):
    assert values(spark, text.strip, "\t a b \n", "x", " y", None) == ["a b", "x", "y", None]
    assert values(spark, text.comparison_key, " Internet_Banking ", "A  -_b") == ["internet banking", "a b"]
    assert text.comparison_key_of(" A_-b ") == "a b"
    assert values(spark, lambda c: text.full_match(c, r"^TXN\d$"), "TXN1", "TXN1\n", "aTXN1") == [True, False, False]
    assert values(spark, text.shape, "Ab-12é") == ["Aa-99a"]
    assert values(spark, lambda c: text.shape(c, True), "ABc-1234") == ["Aa-9"]
    assert text.java_replacement(r"a$\1\g<2>") == r"a\$$1$2"


def test_folding_is_full_in_every_script(spark):
    cased = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and {chr(c).lower(), chr(c).upper(), chr(c).casefold()} != {chr(c)}]
    words = ["STRASSE", "Straße", "ΟΔΟΣ", "οδος", "İstanbul", "ﬃ x", "Ꭰꭰ", "𐐀x", "ŉ", "", None]
    assert len(cased) > 2500
    assert values(spark, text.fold, *cased, *words) == [v if v is None else v.casefold() for v in [*cased, *words]]
    assert values(spark, text.comparison_key, " GROẞE_Straße ", "Σίσυφος") == [text.comparison_key_of(" GROẞE_Straße "), "σίσυφοσ"] == ["grosse strasse", "σίσυφοσ"]


def test_numbers(spark):
    assert values(spark, numbers.to_number, "1", " 1.5 ", "1e3", ".5", "5.", "1d", "NaN", "inf", "1_000", "1e999", "") == [1, 1.5, 1000, 0.5, 5, None, None, None, None, None, None]
    assert values(spark, lambda c: numbers.number_text(numbers.to_number(c)), "12345678.5", "100", "10085.952", "0", "-0.1", "0.0001", "1e-12") == ["12345678.5", "100", "10085.952", "0", "-0.1", "0.0001", "1.0E-12"]
    assert values(spark, numbers.find_number, "EGP 12,284.15", "3780.11 LE", "1786,35", "1.234,56", "1,234", "abc", "-7", None) == [12284.15, 3780.11, 1786.35, 1234.56, 1234, None, -7, None]
    assert values(spark, lambda c: numbers.round_half_even(c.cast("double"), 2), "0.125", "0.135") == [0.12, 0.14]


def test_dates_and_times(spark):
    day = lambda *f: lambda c: temporal.write(temporal.parse(c, list(f)), "%Y-%m-%d")
    assert values(spark, day("%Y-%m-%d"), "2024-5-1", "2024-02-30", "24-5-1", "2024-05-01x") == ["2024-05-01", None, None, None]
    assert values(spark, day("%d-%b-%y"), "12-Aug-70", "12-Aug-68", "12-Aug-69") == ["1970-08-12", "2068-08-12", "1969-08-12"]
    assert values(spark, day("%d/%m/%Y", "%Y%m%d", "%d %b %Y"), "07/09/2023", "20230907", "07 Sep 2023", "x") == ["2023-09-07"] * 3 + [None]
    assert values(spark, temporal.repair_time, "9:05", "12.30.15", "07:19:20 PM", "12:05:00 am", "12:00 p.m.", "13:00 PM", "24:00", "1:60", "x") == ["09:05:00", "12:30:15", "19:19:20", "00:05:00", "12:00:00", None, None, None, None]
    run = dt.date(2024, 2, 29)
    assert temporal.resolve_bound("today-18y", "date", run) == dt.datetime(2006, 2, 28)
    assert temporal.resolve_bound("today + 1m", "date", run) == dt.datetime(2024, 3, 29)
    assert temporal.resolve_bound("today", "date", run) == dt.datetime(2024, 2, 29) and temporal.resolve_bound(5, "decimal", run) == 5.0 and temporal.resolve_bound(None, "date", run) is None
    assert temporal.add_months(dt.date(2023, 12, 31), 2) == dt.date(2024, 2, 29) and temporal.add_months(dt.date(2024, 1, 31), -1) == dt.date(2023, 12, 31)
    with pytest.raises(ValueError):
        temporal.java_format("%Q")


def test_typed_views(spark):
    see = lambda kind, **k: lambda c: typed(c, {"type": kind, **k})
    assert values(spark, see("integer"), "3", "3.0", "3.5", "x") == [3, 3, None, None]
    assert values(spark, see("boolean"), "1", "true", "0", "yes") == [True, True, False, None]
    assert values(spark, lambda c: see("year_month")(c).cast("string"), "2024-05", "2024") == ["2024-05-01 00:00:00", None]
    assert values(spark, see("string"), " x ") == [" x "]


def test_templates(spark):
    assert values(spark, lambda c: templates.format_value("ACC{0:0>7}", c), "12", "123456789") == ["ACC0000012", "ACC123456789"]
    assert values(spark, lambda c: templates.format_value("{0}-{0:x<3}", c), "a") == ["a-axx"]
    assert templates.message_parts("{column} '{value}' {other}", {"column": "c"}) == ["c '", "' {other}"] and templates.message_parts("{value}{value}", {}) == ["", "", ""]
    with pytest.raises(ValueError):
        templates.format_value("{0:,}", F.lit("1"))


def test_expressions(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x"), (None, 2.0, "y"), (0.0, 0.0, "x")], "a double, b double, s string")
    got = lambda e: [r[0] for r in df.select(expression.compile_expression(e, F.col)).collect()]
    assert got("0 <= a < b") == [True, False, False]
    assert got("(abs(a - b) == 1) & (s == 'x')") == [True, False, False]
    assert got("not a > 0 or s in ['y']") == [False, True, True]
    assert got("b / a") == [2.0, None, None]
    assert got("a ** 2 + -b") == [-1.0, None, 0.0]
    for bad in ("__import__('os')", "a.b", "lambda: 1", "a if b else 1", "f(a, b)", "a ="):
        with pytest.raises(ValueError):
            expression.compile_expression(bad, F.col)
