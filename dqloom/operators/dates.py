"""Dates in columns of text, read by what the column itself proves.

Numeric dates such as 03/04/24 don't tell day from month. For every column, layout (year last or first) and separator the values that can be read
one way only (a part above twelve) vote, and the majority decides for all values of that group; without one the month stands first. All columns
are judged together, from one table of counted values: their votes are one aggregation, whose few rows join back to the values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions.temporal import parse
from dqloom.functions.text import strip

# The layouts that are read, and formats with names of months.
THREE_PARTS = r"\A(\d{1,4})([/.\-])(\d{1,2})\2(\d{1,4})\z"
ISO_DATE = r"\A(\d{4})-(\d{2})(?:-(\d{2}))?(?:[T\s](\d{2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?)\d*)?\s*(Z|[+-]\d{2}:?\d{2})?)?\z"
COMPACT = r"\A(?:19|20)\d{6}\z"
NAMED = ["%d %b %Y", "%d-%b-%Y", "%d %B %Y", "%d-%B-%Y", "%b %d, %Y", "%B %d, %Y", "%b %d %Y", "%d %b %y", "%d-%b-%y"]
#: Two-digit years below it are of this century.
PIVOT = 70


def _group(s: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(s, pattern, i), F.lit(""))


def parts(s: Column) -> Column:
    """struct(layout, separator, a, b, year) of a numeric date whose order of day and month is open; nulls otherwise."""
    first, last = _group(s, THREE_PARTS, 1), _group(s, THREE_PARTS, 4)
    separator = _group(s, THREE_PARTS, 2)
    year_last = (F.length(first) <= 2) & F.length(last).isin(2, 4)
    year_first = (F.length(first) == 4) & (F.length(last) <= 2) & (separator != "-")
    layout = F.when(year_last, "year_last").when(year_first, "year_first")
    year = F.when(year_last, last).when(year_first, first)
    short = F.when(year.cast("int") < PIVOT, 2000).otherwise(1900)
    return F.struct(
        layout.alias("layout"), F.when(layout.isNotNull(), separator).alias("separator"), F.when(year_last, first).when(year_first, _group(s, THREE_PARTS, 3)).cast("int").alias("a"),
        F.when(year_last, _group(s, THREE_PARTS, 3)).when(year_first, last).cast("int").alias("b"), (F.when(F.length(year) == 2, short).otherwise(0) + year.cast("int")).alias("year"),
    )


def evidence(counts: DataFrame) -> DataFrame:
    """Votes of counted values (column, value, n): rows (column, layout, separator, rows, day_first_evidence, month_first_evidence, ambiguous, day_first)."""
    n, a, b = F.col("n"), F.col("p.a"), F.col("p.b")
    votes = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    rows = counts.filter(F.col("value").rlike(r"\d")).select("column", "n", parts(strip(F.col("value"))).alias("p")).filter("p.layout is not null")
    out = rows.groupBy("column", "p.layout", "p.separator").agg(F.sum("n").alias("rows"), votes(a > 12).alias("day_first_evidence"), votes(b > 12).alias("month_first_evidence"), votes((a <= 12) & (b <= 12) & (a != b)).alias("ambiguous"))
    return out.withColumn("day_first", F.col("day_first_evidence") > F.col("month_first_evidence"))


def read(s: Column, p: Column, day_first: Column) -> Column:
    """The timestamp (without zone; an offset in the text leads to UTC) of stripped text with its parts and their order; null if it is none."""
    zero = F.lit(0)
    made = F.try_make_timestamp_ntz(p["year"], F.when(day_first, p["b"]).otherwise(p["a"]), F.when(day_first, p["a"]).otherwise(p["b"]), zero, zero, zero)
    iso = [_group(s, ISO_DATE, i) for i in range(1, 8)]
    number = lambda i, default: F.coalesce(iso[i].cast("int"), F.lit(default))
    minutes = F.substring(iso[6], 2, 2).cast("int") * 60 + F.right(iso[6], F.lit(2)).cast("int")
    shift = F.when(iso[6].startswith("+"), minutes).when(iso[6].startswith("-"), -minutes).otherwise(0)
    exact = F.try_make_timestamp_ntz(iso[0].cast("int"), number(1, 1), number(2, 1), number(3, 0), number(4, 0), F.coalesce(iso[5].cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)")))
    exact = exact - F.make_dt_interval(mins=shift)
    digits = F.when(s.rlike(COMPACT), s)
    compact = F.try_make_timestamp_ntz(F.substring(digits, 1, 4).cast("int"), F.substring(digits, 5, 2).cast("int"), F.substring(digits, 7, 2).cast("int"), zero, zero, zero)
    named = F.when(s.rlike(r"[A-Za-z]{3}"), parse(s, NAMED).cast("timestamp_ntz"))
    return F.when(iso[0].isNotNull(), exact).when(p["layout"].isNotNull(), made).when(digits.isNotNull(), compact).when(s.rlike(r"\d"), named)


def read_counted(counts: DataFrame, votes: DataFrame) -> DataFrame:
    """counts (column, value, n) with the timestamp t of each value, read by the votes of its column."""
    rows = counts.withColumn("_s", strip(F.col("value"))).withColumn("_p", parts(F.col("_s")))
    chosen = votes.select(F.col("column").alias("_c"), F.col("layout").alias("_l"), F.col("separator").alias("_x"), "day_first")
    rows = rows.join(F.broadcast(chosen), (F.col("column") == F.col("_c")) & (F.col("_p.layout") == F.col("_l")) & (F.col("_p.separator") == F.col("_x")), "left")  # at most five rows for each column
    return rows.select(*counts.columns, read(F.col("_s"), F.col("_p"), F.coalesce("day_first", F.lit(False))).alias("t"))


def facts(dated: DataFrame) -> DataFrame:
    """By column: rows, how many are dates, whether any has a time of day, earliest and latest."""
    t, n = F.col("t"), F.col("n")
    timed = F.max(t != F.date_trunc("day", t).cast("timestamp_ntz"))
    return dated.groupBy("column").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(t.isNotNull(), n)), F.lit(0)).alias("dates"), F.coalesce(timed, F.lit(False)).alias("has_time"), F.min("t").alias("min"), F.max("t").alias("max"))


def order_of(vote: dict) -> str:
    """What a group's votes prove."""
    day, month = vote["day_first_evidence"] > 0, vote["month_first_evidence"] > 0
    return "mixed" if day and month else "day_first" if day else "month_first" if month else "ambiguous"


def column_value(c: Column, votes: list[dict]) -> Column:
    """read() for one column of a table, by its collected votes."""
    s = strip(c.cast("string"))
    p, first = parts(s), F.lit(False)
    for v in votes:
        if v["day_first"]:
            first = F.when((p["layout"] == v["layout"]) & (p["separator"] == v["separator"]), True).otherwise(first)
    return read(s, p, first)
