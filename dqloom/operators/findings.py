"""What is worth a look in a column before rules are written for it: values that are not what their column holds, in numbers and with examples.

All works on counted values (column, value, n). One pass gives each value the codes of what is odd about it; by (column, code) their rows are summed and the
most frequent ones ranked, the best of each of some hash slices first, so no task ranks all values. Layouts of values are counted in the same way.
Only a few rows for each column come to the driver, where they become sentences.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions.numbers import find_number, to_number
from dqloom.functions.text import comparison_key, fold, mapped, shape, strip
from dqloom.operators import dates as D

# Words for a missing value.
NULL_TOKENS = ("null", "none", "nan", "n/a", "na", "#n/a", "nil", "-", "--", "?")
# Catch-all labels.
GENERIC = ("other", "others", "unknown", "misc", "miscellaneous", "undefined", "unspecified", "not specified", "tbd")
# Placeholder currencies and patterns of everyday kinds.
PLACEHOLDER_CURRENCIES = ("XXX", "XTS")
EMAIL = r"[^@\s]+@[^@\s]+\.[^@\s]+"
PHONE = r"\+?[\d\s().\-]{7,20}"
CURRENCY = r"[A-Z]{3}"
TIME = r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2})(?:\.\d+)?)?(?:\s?([ap]\.?m\.?))?"
TOP, EXAMPLES, SLICES = 10, 5, 64
PHONE_DIGITS, FAR_IQR = 7, 3.0
OLD = dt.datetime(1900, 1, 1)
NUMBERS, DATES, LABELS = ("integer", "float"), ("date", "datetime"), ("categorical", "text")
#: Kinds whose layouts are compared letter by letter, and those where the length of a run doesn't count.
FIXED_LAYOUT, FREE_LAYOUT = ("identifier", "phone"), ("date", "datetime", "time")


def missing_kind(c: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """null, blank or token for a missing value; null for a present one."""
    s = fold(strip(c))
    return F.when(c.isNull(), "null").when(s == "", "blank").when(s.isin(*tokens), "token")


def ranked(rows: DataFrame, name: str, n: int, by: tuple[str, ...] = ("column",), more: tuple[str, ...] = ()) -> DataFrame:
    """First n by count within ``by``, ties by name: (by, rank, name, n, more)."""
    within = ", ".join(f"`{c}`" for c in by)
    key = F.struct((-F.col("n")).alias("o"), F.col(name).alias("v"), *more)
    some = rows.withColumn("slice", F.pmod(F.xxhash64(name), F.lit(SLICES))).withColumn("r", F.expr(f"row_number() over (partition by {within}, slice order by n desc, `{name}`)")).filter(F.col("r") <= n)
    best = some.groupBy(*by).agg(F.slice(F.array_sort(F.collect_list(key)), 1, n).alias("t"))  # at most SLICES * n each
    return best.select(*by, F.posexplode("t").alias("p", "x")).select(*by, (F.col("p") + 1).alias("rank"), F.col("x.v").alias(name), (-F.col("x.o")).alias("n"), *[F.col(f"x.{c}").alias(c) for c in more])


def problems(counts: DataFrame, kinds: dict[str, str], tokens: tuple[str, ...] = NULL_TOKENS, votes: DataFrame | None = None, run_date: dt.date | None = None) -> DataFrame:
    """(column, code, value, n) for all that is odd about a value in a column of its kind. votes: orders of day and month (``dates.evidence``)."""
    v, s, low, kind = F.col("value"), F.col("stripped"), F.col("folded"), F.col("kind")
    rows = counts.withColumn("kind", mapped(F.col("column"), kinds)).withColumn("stripped", strip(v)).withColumn("folded", fold(F.col("stripped"))).withColumn("gone", missing_kind(v, tokens))
    rows = D.read_counted(rows, votes if votes is not None else D.evidence(counts))
    hour, minute, second = (F.regexp_extract(low, rf"\A{TIME}\z", i).try_cast("int") for i in (1, 2, 3))
    half = F.regexp_extract(low, rf"\A{TIME}\z", 4) != ""
    beyond = (hour > 23) | half & ((hour > 12) | (hour == 0)) | (minute > 59) | F.coalesce(second > 59, F.lit(False))
    no_number = kind.isin(*NUMBERS) & to_number(s).isNull()
    good = F.when(kind == "email", s.rlike(rf"\A{EMAIL}\z")).when(kind == "currency_code", s.rlike(rf"\A{CURRENCY}\z")).when(kind == "phone", s.rlike(rf"\A{PHONE}\z") & (F.regexp_count(s, F.lit(r"\d")) >= PHONE_DIGITS))
    date = kind.isin(*DATES)
    found = {
        "WHITESPACE": v != s,
        "MIXED_TYPES": no_number | date & F.col("t").isNull() | (kind == "time") & hour.isNull(),
        "NUMBER_FORMAT_VARIANTS": no_number & find_number(s).isNotNull(),
        "LEADING_ZEROS": kind.isin(*NUMBERS) & s.rlike(r"\A[+-]?0\d"),
        "FUTURE_DATES": date & (F.to_date("t") > F.lit(run_date)) if run_date else F.lit(False),
        "VERY_OLD_DATES": date & (F.col("t") < F.lit(OLD)),
        "OUT_OF_RANGE_TIMES": (kind == "time") & beyond,
        "INVALID_FORMAT": ~good,
        "PLACEHOLDER_CODES": (kind == "currency_code") & s.isin(*PLACEHOLDER_CURRENCIES),
        "GENERIC_VALUES": kind.isin(*LABELS) & comparison_key(v).isin(*GENERIC),
    }
    present = F.array_compact(F.array(*[F.when(test, F.lit(code)) for code, test in found.items()]))
    codes = F.when(F.col("gone") == "token", F.array(F.lit("NULL_TOKENS"))).when(F.col("gone").isNull(), present)
    long = rows.select("column", F.explode(codes).alias("code"), "value", "stripped", "n")
    return long.select("column", "code", F.when(F.col("code") == "NULL_TOKENS", F.col("stripped")).otherwise(v).alias("value"), "n").groupBy("column", "code", "value").agg(F.sum("n").alias("n"))


def summed(found: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """By (column, code) of problems: rows, distinct values, the most frequent values with their counts, and whether a time is the end of a day."""
    total = found.groupBy("column", "code").agg(F.sum("n").alias("rows"), F.count("*").alias("values"), F.bool_or((F.col("code") == "OUT_OF_RANGE_TIMES") & strip(F.col("value")).rlike(r"\A24[:.]00")).alias("midnight"))
    best = ranked(found, "value", n, ("column", "code")).groupBy("column", "code").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("top"))
    return total.join(best, ["column", "code"])


def layouts(counts: DataFrame, kinds: dict[str, str], tokens: tuple[str, ...] = NULL_TOKENS, n: int = TOP) -> DataFrame:
    """The most frequent layouts of identifiers, phones, dates, times and of what is no number in a column of numbers: (column, rank, layout, n, example, layouts, of)."""
    v, kind = F.col("value"), F.col("kind")
    rows = counts.withColumn("kind", mapped(F.col("column"), kinds)).filter(kind.isin(*FIXED_LAYOUT, *FREE_LAYOUT) | kind.isin(*NUMBERS) & to_number(strip(v)).isNull()).filter(missing_kind(v, tokens).isNull())
    rows = rows.groupBy("column", F.when(kind.isin(*FIXED_LAYOUT), shape(v)).otherwise(shape(v, True)).alias("layout")).agg(F.sum("n").alias("n"), F.min("value").alias("example"))
    total = rows.groupBy("column").agg(F.count("*").alias("layouts"), F.sum("n").alias("of"))
    return ranked(rows, "layout", n, more=("example",)).join(total, "column")


def _quoted(values: list) -> str:
    return ", ".join(f"'{x['value']}' ({x['n']})" for x in values)


# What a note says; {rows}, {values} and {top} are the figures of ``summed``.
_SAYS = {
    "NULL_TOKENS": "{rows} values stand for a missing one: {top}.",
    "WHITESPACE": "{rows} values begin or end with white space.",
    "MIXED_TYPES": "{rows} values are no {kind}: {top}.",
    "NUMBER_FORMAT_VARIANTS": "{rows} of the other values hold a number among other characters: {top}.",
    "LEADING_ZEROS": "{rows} values begin with 0, as codes do: {top}.",
    "FUTURE_DATES": "{rows} dates lie after the day of the profile: {top}.",
    "VERY_OLD_DATES": "{rows} dates lie before the year 1900: {top}.",
    "OUT_OF_RANGE_TIMES": "{rows} times do not exist: {top}.",
    "INVALID_FORMAT": "{rows} values are not written as {kind}: {top}.",
    "PLACEHOLDER_CODES": "{rows} values are codes for no currency: {top}.",
    "GENERIC_VALUES": "{rows} values are catch-all labels: {top}.",
}


def notes(kind: str, stats: dict, found: dict[str, dict], layout: list[dict], votes: list[dict] = (), numeric: dict | None = None, variants: list[dict] = (), extreme: float = 0.0) -> list[dict]:
    """[{code, detail}] of one column, from rows of ``summed`` by code, of ``layouts``, of votes on dates and of spelling variants."""
    out: list[dict] = []

    def note(code: str, detail: str) -> None:
        out.append({"code": code, "detail": detail})

    if stats["rows"] and stats["missing_count"] == stats["rows"]:
        note("ALL_MISSING", f"None of {stats['rows']} rows has a value.")
    if stats["distinct_count"] == 1 and stats["rows"] > 1:
        note("CONSTANT", "All values are the same one.")
    for code, says in _SAYS.items():
        if code in found:
            f = found[code]
            end = " 24:00 seems to mean the end of a day." if f["midnight"] else ""
            note(code, says.format(rows=f["rows"], kind=kind.replace("_", " "), top=_quoted(f["top"])) + end)
    if kind not in NUMBERS and len(layout) > 1:
        main = layout[0]
        others = ", ".join(f"'{x['example']}'" for x in layout[1:4])
        note("FORMAT_VARIANTS", f"{main['of'] - main['n']} values have another layout than '{main['layout']}' (as in '{main['example']}'), {main['layouts']} layouts in all: {others}.")
    for x in votes:
        place, read = f"{x['layout'].replace('_', ' ')} and '{x['separator']}' between the parts", "day first" if x["day_first"] else "month first"
        day, month, open_ = x["day_first_evidence"], x["month_first_evidence"], x["ambiguous"]
        if day and month:
            note("AMBIGUOUS_DATES", f"Of dates with {place}, {day} must be day first and {month} month first; {open_} could be either and are read {read}.")
        elif open_ and not day and not month:
            note("AMBIGUOUS_DATES", f"No date with {place} tells the order of day and month; {open_} are read {read}.")
    both = any(x["day_first_evidence"] and x["month_first_evidence"] for x in votes)
    if both or len({x["day_first"] for x in votes if x["layout"] == "year_last"}) > 1 or any(x["day_first"] for x in votes if x["layout"] == "year_first"):
        note("MIXED_DATE_CONVENTIONS", "; ".join(f"{x['layout'].replace('_', ' ')} with '{x['separator']}': {'day' if x['day_first'] else 'month'} first" for x in votes) + ".")
    if numeric and numeric["far_outliers"]:
        note("FAR_OUTLIERS", f"{numeric['far_outliers']} values lie far beyond the quartiles.")
        wide = FAR_IQR * (numeric["p75"] - numeric["p25"])
        for end, far in (("min", numeric["min"] < numeric["p25"] - wide), ("max", numeric["max"] > numeric["p75"] + wide)):
            if far and numeric[f"at_{end}"] >= extreme:
                note("REPEATED_EXTREME_VALUE", f"{numeric[end]} stands {numeric[f'at_{end}']} times; it may be a cap or stand for an unknown value.")
    if variants and kind in (*LABELS, "currency_code"):
        note("SPELLING_VARIANTS", f"{variants[0]['of']} values are spelt in several ways, most often " + ", ".join(f"'{x['most_common']}'" for x in variants[:3]) + ".")
    return out
