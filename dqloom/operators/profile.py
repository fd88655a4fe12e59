"""Profile of text columns: what they hold, which types they look like, how they depend on each other.

The base is one aggregation, (column, value, count) in long form, with digests of whole rows: the table is read once for all figures of columns, of numbers and
dates too, and for repeated rows. Relationships with key columns are in ``relations``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions.numbers import find_number, number_text, to_number
from dqloom.functions.temporal import parse, repair_time
from dqloom.functions.text import comparison_key, fold, shape, strip
from dqloom.operators import dates as D
from dqloom.operators import relations as R
from dqloom.operators.findings import CURRENCY, EMAIL, FAR_IQR, GENERIC, NULL_TOKENS, PHONE, PLACEHOLDER_CURRENCIES, TIME, TOP, layouts, missing_kind, notes, problems, ranked, summed
from dqloom.plans.registry import Registry
from dqloom.sources.shared import discard, written

# Pairs of words for false and true.
BOOLEAN_PAIRS = (("false", "true"), ("no", "yes"), ("n", "y"), ("f", "t"), ("0", "1"))
# Words of a column's name that hint at its type.
HINTS = {"phone": {"phone", "mobile", "tel", "telephone"}, "currency_code": {"currency", "ccy"}, "boolean": {"is", "has", "flag"}, "time": {"time"}, "date": {"date", "datetime", "timestamp", "dob"}, "email": {"email", "mail"}}
ID_WORDS = {"id", "uuid", "guid"}
# Thresholds of the profile.
TYPE_SHARE, HINTED_SHARE = 0.80, 0.50
CATEGORY_VALUES, CATEGORY_SHARE = 50, 0.05
NEAR_IQR = 1.5
EXTREME_SHARE, EXTREME_ROWS = 0.001, 2
PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
MISSING_SHARE, PURITY, COVERAGE, MAX_CATEGORIES = 0.01, 0.98, 0.90, 30
DATE_FORMATS = ["%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%m-%Y", "%d %b %Y", "%d-%b-%Y", "%Y%m%d", "%m-%d-%Y", "%d.%m.%Y", "%m.%d.%Y"]


def _n(c: str) -> Column:
    return F.col(f"`{c}`")


def value_counts(df: DataFrame, columns: list[str] | None = None, whole_rows: bool = False) -> DataFrame:
    """(column, value, n) over all columns; with whole_rows also digests of rows, under the column null."""
    columns = columns or df.columns
    values = [F.struct(F.lit(c).alias("column"), _n(c).cast("string").alias("value")) for c in columns]
    if whole_rows:
        values.append(F.struct(F.lit(None).cast("string").alias("column"), row_digest(df, columns).alias("value")))
    pairs = F.explode(F.array(*values)).alias("p")
    return df.select(pairs).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def column_counts(counts: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """By column: rows, missing ones by kind, distinct present values, duplicates beyond the first, values with outer white space."""
    kind = missing_kind(F.col("value"), tokens)
    present = kind.isNull()
    some = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    out = counts.groupBy("column").agg(
        F.sum("n").alias("rows"), some(kind == "null").alias("null_count"), some(kind == "blank").alias("blank_count"), some(kind == "token").alias("token_count"), some(kind.isNotNull()).alias("missing_count"),
        F.sum(F.when(present, 1).otherwise(0)).alias("distinct_count"), some(present).alias("present"), some(present & (F.col("value") != strip(F.col("value")))).alias("whitespace_count"),
    )
    return out.withColumn("duplicate_count", F.col("present") - F.col("distinct_count")).drop("present")


def top_values(counts: DataFrame, n: int = TOP, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """The most frequent present values by column; ties by value."""
    rows = counts.filter(missing_kind(F.col("value"), tokens).isNull())
    return ranked(rows, "value", n)


def top_shapes(counts: DataFrame, n: int = TOP, collapse: bool = False, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    rows = counts.filter(missing_kind(F.col("value"), tokens).isNull()).groupBy("column", shape(F.col("value"), collapse).alias("shape")).agg(F.sum("n").alias("n"))
    return ranked(rows, "shape", n)


def spelling_variants(counts: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Groups of values that differ in case, spacing or separators only: (column, key, variants, rows, most_common)."""
    rows = counts.filter(missing_kind(F.col("value"), tokens).isNull()).withColumn("key", comparison_key(F.col("value")))
    out = rows.groupBy("column", "key").agg(F.count("*").alias("variants"), F.sum("n").alias("rows"), F.min_by("value", F.struct((-F.col("n")).alias("o"), "value")).alias("most_common"))
    return out.filter("variants > 1")


def top_variants(counts: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS, n: int = TOP) -> DataFrame:
    """The groups of spelling_variants with the most rows, by column, with the number of groups in ``of``."""
    found = spelling_variants(counts, tokens).select("column", "key", F.col("rows").alias("n"), "most_common", "variants")
    return ranked(found, "key", n, more=("most_common", "variants")).join(found.groupBy("column").agg(F.count("*").alias("of")), "column")


def generic_values(counts: DataFrame) -> DataFrame:
    """Rows with a catch-all label, by column and label."""
    return counts.withColumn("key", comparison_key(F.col("value"))).filter(F.col("key").isin(*GENERIC)).groupBy("column", F.col("key").alias("label")).agg(F.sum("n").alias("rows"))


def numeric_values(counts: DataFrame) -> DataFrame:
    """(column, x, n, lead, part) of the values of counts that are numbers, written by ranges of (column, x)."""
    value = F.col("value")
    rows = counts.select("column", to_number(value).alias("x"), F.when(strip(value).rlike(r"\A[+-]?0\d"), F.col("n")).otherwise(0).alias("lead"), "n").filter("x is not null")
    values = rows.groupBy("column", "x").agg(F.sum("n").alias("n"), F.sum("lead").alias("lead"))
    return written(values.repartitionByRange("column", "x").withColumn("part", F.spark_partition_id()), "values")


def numeric_profiles(values: DataFrame) -> DataFrame:
    """By column of numeric_values: count, range, moments, exact percentiles, outliers, and special values.

    A percentile's place is found by the counts of whole ranges, then by running sums in one. All columns go together; tables of one row for each column are broadcast.
    """
    x, n = F.col("x"), F.col("n")
    total = F.sum("n")
    base = values.groupBy("column").agg(total.alias("of"), F.min("x").alias("min"), F.max("x").alias("max"), (F.sum(x * n) / total).alias("mean"), F.sum("lead").alias("leading_zeros"))
    before = values.groupBy("column", "part").agg(total.alias("m")).select("column", "part", (F.expr("sum(m) over (partition by column order by part)") - F.col("m")).alias("before"))
    placed = values.join(F.broadcast(before), ["column", "part"]).join(F.broadcast(base.select("column", "of")), "column")  # as many rows as ranges and columns
    upto = F.col("before") + F.expr("sum(n) over (partition by column, part order by x rows unbounded preceding)")
    places = {f"p{round(100 * p)}": F.lit(p) * (F.col("of") - 1) for p in PERCENTILES}
    at = lambda place: F.max(F.when((F.col("upto") - n <= place) & (F.col("upto") > place), x))
    ends = [f(place) for place in places.values() for f in (F.floor, F.ceil)]
    found = placed.withColumn("upto", upto).groupBy("column").agg(*[at(e).alias(f"e{i}") for i, e in enumerate(ends)])
    facts = base.join(found, "column")
    for i, (name, place) in enumerate(places.items()):
        low, high = F.col(f"e{2 * i}"), F.col(f"e{2 * i + 1}")
        facts = facts.withColumn(name, F.when(F.floor(place) == F.ceil(place), low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high))
    facts = facts.select("column", F.col("of").alias("rows"), "min", "max", "mean", *places, "leading_zeros")
    some = lambda when: F.coalesce(F.sum(F.when(when, n)), F.lit(0))
    iqr, low, high = F.col("p75") - F.col("p25"), F.col("p25"), F.col("p75")
    beyond = lambda k: some((x < low - k * iqr) | (x > high + k * iqr))
    square = F.sum(n * F.pow(x - F.col("mean"), 2))
    second = values.join(F.broadcast(facts), "column").groupBy("column").agg(
        F.sqrt(F.when(total > 1, square / (total - 1))).alias("std"), beyond(NEAR_IQR).alias("outliers"), beyond(FAR_IQR).alias("far_outliers"), some(x == 0).alias("zeros"), some(x < 0).alias("negatives"),
        some(x == F.col("min")).alias("at_min"), some(x == F.col("max")).alias("at_max"),
    )
    return facts.join(F.broadcast(second), "column").select("column", F.col("rows").alias("n"), "min", "max", "mean", "std", *places, "leading_zeros", "outliers", "far_outliers", "zeros", "negatives", "at_min", "at_max")


def numeric_profile(df: DataFrame, column: str) -> DataFrame:
    """numeric_profiles of one column: one row, of no numbers too."""
    found = numeric_profiles(numeric_values(value_counts(df, [column])))
    numbers = ("n", "outliers", "far_outliers", "zeros", "negatives", "at_min", "at_max")
    one = df.sparkSession.range(1).select(F.lit(column).alias("column")).join(found, "column", "left")
    return one.select(*[F.coalesce(c, F.lit(0)).alias(c) if c in numbers else c for c in found.columns if c != "column"])


def type_rates(counts: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """By column: share of present values that read as each type."""
    v = F.col("value")
    rows = counts.filter(missing_kind(v, tokens).isNull()).withColumn("_s", strip(v))
    s, steps = F.col("_s"), []

    def let(value: Column) -> Column:
        steps.append(value)
        return F.col(f"_s{len(steps)}")

    low, number, found = let(fold(s)), let(to_number(s)), find_number(s, let)
    tests = {
        "phone": s.rlike(rf"\A{PHONE}\z"), "currency_code": s.rlike(rf"\A{CURRENCY}\z"), "placeholder_currency": s.isin(*PLACEHOLDER_CURRENCIES), "whole": number % 1 == 0, "float": number.isNotNull(),
        "number_in_text": found.isNotNull(), "time": low.rlike(rf"\A{TIME}\z"), "good_time": repair_time(s).isNotNull(), "date": v.rlike(r"\d") & parse(s, DATE_FORMATS).isNotNull(), "email": s.rlike(rf"\A{EMAIL}\z"),
    }
    for i, step in enumerate(steps):
        rows = rows.withColumn(f"_s{i + 1}", step)
    total = F.sum("n")
    pairs = [F.bool_and(low.isin(*p)).alias(f"is_{i}") for i, p in enumerate(BOOLEAN_PAIRS)]
    return rows.groupBy("column").agg(total.alias("present"), F.count("*").alias("distinct"), F.countDistinct(low).alias("folded"), *pairs, *[(F.coalesce(F.sum(F.when(t, F.col("n"))), F.lit(0)) / total).alias(k) for k, t in tests.items()])


def name_words(name: str) -> list[str]:
    """Words of a column name: camel case and separators."""
    import re

    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)]


def infer_type(name: str, rates: dict | None) -> str:
    """The logical type of a column from its rates (a row of type_rates), by a ladder; a hint in its name lowers the share that is asked for."""
    if not rates or not rates["present"]:
        return "empty"
    words = name_words(name)

    def hinted(kind: str) -> bool:
        return bool(set(words) & HINTS[kind])

    def enough(kind: str) -> bool:
        return rates[kind] >= (HINTED_SHARE if hinted(kind) else TYPE_SHARE)

    if words and (words[-1] in ID_WORDS or words[0] == "id"):
        return "identifier"
    if hinted("phone"):
        return "phone"
    if hinted("currency_code") and rates["currency_code"] >= HINTED_SHARE:
        return "currency_code"
    for i, pair in enumerate(BOOLEAN_PAIRS):
        if rates[f"is_{i}"] and (pair != ("0", "1") or rates["folded"] == 2 or hinted("boolean")):
            return "boolean"
    if rates["float"] >= TYPE_SHARE:
        return "integer" if rates["whole"] >= rates["float"] else "float"
    if enough("time"):
        return "time"
    if enough("date"):
        return "datetime" if rates.get("has_time") else "date"
    if rates["email"] >= TYPE_SHARE or hinted("email"):
        return "email"
    if rates["distinct"] <= CATEGORY_VALUES or rates["distinct"] <= CATEGORY_SHARE * rates["present"]:
        return "categorical"
    return "text"


def date_order_evidence(df: DataFrame, column: str) -> DataFrame:
    """For d/m/y-like text, by separator: rows, rows where the first or the second part is above 12, and the order they prove."""
    p = r"\A(\d{1,2})([/.-])(\d{1,2})[/.-](\d{4})\z"
    s = strip(_n(column).cast("string"))
    rows = df.filter(s.rlike(p)).select(F.regexp_extract(s, p, 1).cast("int").alias("a"), F.regexp_extract(s, p, 2).alias("separator"), F.regexp_extract(s, p, 3).cast("int").alias("b"))
    out = rows.groupBy("separator").agg(F.count("*").alias("rows"), F.sum((F.col("a") > 12).cast("int")).alias("day_first"), F.sum((F.col("b") > 12).cast("int")).alias("month_first"))
    order = F.when((F.col("day_first") > 0) & (F.col("month_first") > 0), "mixed").when(F.col("day_first") > 0, "day_first").when(F.col("month_first") > 0, "month_first").otherwise("ambiguous")
    return out.withColumn("order", order)


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*[_n(c) for c in columns]), {"ignoreNullFields": "false"}), 256)


def duplicate_row_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier one; nulls are equal."""
    return repeated_rows(df.groupBy(row_digest(df, columns or df.columns).alias("value")).agg(F.count("*").alias("n")))


def repeated_rows(digests: DataFrame) -> DataFrame:
    return digests.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def candidate_keys(column_stats: DataFrame) -> DataFrame:
    """Columns without missing or repeated values are keys; nearly so, near keys."""
    share = F.col("distinct_count") / F.col("rows")
    kind = F.when((F.col("missing_count") == 0) & (F.col("distinct_count") == F.col("rows")), "key").when((F.col("missing_count") == 0) & (share >= R.NEAR_KEY), "near_key")
    return column_stats.select("column", F.round(share, 6).alias("distinct_share"), kind.alias("kind")).filter("kind is not null")


def date_formats(evidence: list[dict] | None = None) -> list[str]:
    """DATE_FORMATS with those of a separator that date_order_evidence proves to be month first in that order."""
    proven = {e["separator"] for e in evidence or [] if e["order"] == "month_first"}
    return [f"%m{x}%d{x}%Y" for x in sorted(proven)] + DATE_FORMATS


def canonical(c: Column, kind: str, formats: list[str] = DATE_FORMATS, tokens: tuple[str, ...] = NULL_TOKENS, votes: list[dict] | None = None) -> Column:
    """The comparable form of a value in a column of a logical type; what can't be read keeps its text, a missing one is null."""
    text = c.cast("string")
    s = strip(text)
    if kind in ("categorical", "text", "boolean", "currency_code"):
        out = strip(comparison_key(text))
    elif kind == "email":
        out = F.lower(s)
    elif kind in ("integer", "float"):
        n = to_number(s)
        out = F.coalesce(number_text(F.when(n == 0, F.lit(0.0)).otherwise(n)), s)
    elif kind in ("date", "datetime"):
        out = F.coalesce(D.column_value(text, votes).cast("string") if votes is not None else parse(s, formats).cast("string"), s)
    elif kind == "time":
        out = F.coalesce(repair_time(s), s)
    else:
        out = s
    return F.when(missing_kind(text, tokens).isNull(), out)


def present(columns: list[str]) -> dict[str, Column]:
    """Forms of columns for ``relations.relate``: their text, null where it stands for a missing value."""
    return {c: F.when(missing_kind(_n(c).cast("string")).isNull(), _n(c).cast("string")) for c in columns}


def conditional_missing(df: DataFrame, columns: list[str], drivers: list[str], tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Partly missing columns whose gaps a category explains: (column, explained_by, explained_percentage, missing_when, exceptions), the best driver of each."""
    n = F.count("*")
    kind = lambda c: missing_kind(_n(c).cast("string"), tokens).isNotNull()
    structs = [F.struct(F.lit(c).alias("column"), F.lit(d).alias("driver"), comparison_key(_n(d).cast("string")).alias("category"), kind(c).alias("gone"), kind(d).alias("unknown")) for c in columns for d in drivers if c != d]
    long = df.select(F.explode(F.array(*structs)).alias("p")).select("p.*")
    totals = long.groupBy("column", "driver").agg(n.alias("rows"), F.sum(F.col("gone").cast("long")).alias("all_gone"))
    cats = long.filter("not unknown").groupBy("column", "driver", "category").agg(n.alias("size"), F.sum(F.col("gone").cast("long")).alias("gone"))
    mean = F.col("gone") / F.col("size")
    few = cats.groupBy("column", "driver").agg(F.count("*").alias("categories")).filter(F.col("categories") <= MAX_CATEGORIES)  # a driver has few categories
    cats = cats.join(F.broadcast(few.select("column", "driver")), ["column", "driver"])  # as many rows as pairs of columns
    cats = cats.withColumn("always", mean >= PURITY).withColumn("pure", (mean >= PURITY) | (mean <= 1 - PURITY))
    stats = cats.groupBy("column", "driver").agg(
        F.count("*").alias("categories"), (F.sum(F.when(F.col("pure"), F.col("size")).otherwise(0)) / F.sum("size")).alias("pure_share"), F.sum(F.when(F.col("always"), F.col("gone")).otherwise(0)).alias("explained"),
        F.sum(F.when(F.col("always"), F.col("size") - F.col("gone")).otherwise(F.col("gone"))).alias("exceptions"),
        F.sort_array(F.collect_list(F.when(F.col("always"), F.struct((-F.col("size")).alias("o"), "category")))).alias("w"),  # at most MAX_CATEGORIES
    )
    out = stats.join(totals, ["column", "driver"])
    share = F.col("all_gone") / F.col("rows")
    out = out.withColumn("coverage", F.col("explained") / F.col("all_gone")).filter(share.between(MISSING_SHARE, 1 - MISSING_SHARE) & (F.col("pure_share") >= PURITY) & (F.col("coverage") >= COVERAGE))
    place = F.array_position(F.array(*map(F.lit, drivers)), F.col("driver"))
    best = out.groupBy("column").agg(F.max_by(F.struct(*out.columns), F.struct("coverage", (-place).alias("p"))).alias("b")).select("b.*")
    return best.select("column", F.col("driver").alias("explained_by"), F.round(100 * F.col("coverage"), 4).alias("explained_percentage"), F.transform("w", lambda x: x["category"]).alias("missing_when"), "exceptions")


def profile(df: DataFrame, registry: Registry | None = None, relationships: bool = True, run_date: dt.date | None = None, null_tokens: tuple[str, ...] | None = None) -> dict:
    """A document on the table: a few rows of aggregates for each column, collected. null_tokens: words that stand for a missing value."""
    tokens = NULL_TOKENS if null_tokens is None else tuple(t.strip().casefold() for t in null_tokens)
    every = value_counts(df, whole_rows=True).persist()
    counts = every.filter("column is not null")
    by = {r["column"]: r.asDict() for r in column_counts(counts, tokens).collect()}
    rates = {r["column"]: r.asDict() for r in type_rates(counts, tokens).collect()}
    present = counts.filter(missing_kind(F.col("value"), tokens).isNull())
    voted = D.evidence(present).persist()
    votes: dict[str, list] = {}
    for r in voted.collect():  # at most five rows for each column
        votes.setdefault(r["column"], []).append(r.asDict() | {"order": D.order_of(r.asDict())})
    dated = {r["column"]: r.asDict() for r in D.facts(D.read_counted(present, voted)).collect()}
    for c, r in rates.items():
        r |= {"date": dated[c]["dates"] / dated[c]["rows"], "has_time": dated[c]["has_time"]} if c in dated else {}
    variants: dict[str, list] = {}
    for r in top_variants(counts, tokens).orderBy("column", "rank").collect():
        variants.setdefault(r["column"], []).append(r.asDict())
    tops: dict[str, list] = {}
    for r in top_values(counts, tokens=tokens).orderBy("column", "rank").collect():
        tops.setdefault(r["column"], []).append({"value": r["value"], "count": r["n"]})
    shapes: dict[str, list] = {}
    for r in top_shapes(counts, tokens=tokens).orderBy("column", "rank").collect():
        shapes.setdefault(r["column"], []).append({"shape": r["shape"], "count": r["n"]})
    kinds = {c: infer_type(c, rates.get(c)) for c in df.columns}
    odd: dict[str, dict] = {}
    for r in summed(problems(counts, kinds, tokens, voted, run_date)).collect():  # at most a row for each column and code
        odd.setdefault(r["column"], {})[r["code"]] = r.asDict(recursive=True)
    formats: dict[str, list] = {}
    for r in layouts(counts, kinds, tokens).orderBy("column", "rank").collect():
        formats.setdefault(r["column"], []).append(r.asDict())
    voted.unpersist()
    numbers = numeric_values(counts.filter(F.col("column").isin([c for c, kind in kinds.items() if kind in ("integer", "float")])))
    numerics = {r["column"]: {k: v for k, v in r.asDict().items() if k != "column"} for r in numeric_profiles(numbers).collect()}
    discard(numbers)
    columns, forms = [], {}
    for c in df.columns:
        stats, kind = by.get(c, {"rows": 0, "missing_count": 0, "token_count": 0, "whitespace_count": 0, "distinct_count": 0}), kinds[c]
        numeric = numerics.get(c)
        evidence = votes.get(c, []) if kind in ("date", "datetime") else None
        dates, forms[c] = None, canonical(_n(c), kind, tokens=tokens, votes=evidence)
        if evidence is not None:
            dates = {k: dated[c][k] if kind == "datetime" or dated[c][k] is None else dated[c][k].date() for k in ("min", "max")}
        extreme = max(EXTREME_ROWS, EXTREME_SHARE * numeric["n"]) if numeric else 0.0
        found = notes(kind, stats, odd.get(c, {}), formats.get(c, []), evidence or [], numeric, variants.get(c, []), extreme)
        if c != c.strip():
            found.append({"code": "COLUMN_NAME_WHITESPACE", "detail": "The column's name begins or ends with white space."})
        columns.append({"column_name": c, "logical_type": kind, **stats, "top_values": tops.get(c, []), "shapes": shapes.get(c, []), "numeric": numeric, "dates": {k: str(v) for k, v in dates.items()} if dates else None, "layouts": formats.get(c, []), "problems": odd.get(c, {}), "observations": [x["code"] for x in found], "notes": found})
    keys = [r.asDict() for r in candidate_keys(column_counts(counts, tokens)).collect()]
    repeated = repeated_rows(every.filter("column is null")).first()[0]
    total = max([s["rows"] for s in by.values()], default=0)
    file_notes = [{"code": "DUPLICATE_ROWS", "detail": f"{repeated} rows are copies of an earlier one."}] if repeated else []
    for k in columns:  # identifiers that would be keys but for missing or repeated values
        if total and k["logical_type"] == "identifier" and R.NEAR_KEY * total <= k["distinct_count"] and (k["missing_count"] or k["distinct_count"] < total):
            file_notes.append({"code": "NEAR_KEY", "detail": f"'{k['column_name']}' would be a key but for {k['missing_count']} missing and {k['duplicate_count']} repeated values."})
    out = {"row_count": total, "columns": columns, "duplicate_rows": repeated, "keys": keys}
    if relationships:
        ids = [c["column_name"] for c in columns if c["logical_type"] == "identifier"]
        if ids and len(df.columns) > 1:
            relations = R.relate(df, ids, df.columns, forms)
            stats = R.consistency(relations).persist()
            repeated_keys = [r.asDict() for r in R.duplicate_keys(R.key_repeats(relations), stats, out["row_count"]).collect()]
            own = [k for k in ids if k not in {r["key"] for r in repeated_keys}]  # near keys are described by their repeats, not as entities
            found = [r.asDict() for r in R.entity_attributes(stats.filter(F.col("key").isin(own))).collect()]
            shared = [r.asDict() for r in R.shared_values(relations, own).collect()]
            out |= {"entities": found, "shared_values": shared, "duplicate_keys": repeated_keys}
            for r in repeated_keys:
                where = ", ".join(f"{c} ({n})" for c, n in r["differing_columns"].items()) or "no column"
                file_notes.append({"code": "DUPLICATE_KEYS", "detail": f"{r['repeated_key_count']} values of '{r['key']}' stand on several rows, {r['row_count']} in all; rows of one value differ in {where}."})
            for r in found:
                if r["conflicting_rows"]:
                    file_notes.append({"code": "ENTITY_CONFLICTS", "detail": f"{r['conflicting_keys']} values of '{r['key']}' have more than one '{r['column']}'; {r['conflicting_rows']} rows differ from the usual one."})
            for at in sorted({(r["key"], r["column"]) for r in shared}):
                top = sorted((-r["key_count"], r["value"]) for r in shared if (r["key"], r["column"]) == at)[:5]
                file_notes.append({"code": "SHARED_VALUES", "detail": f"Many values of '{at[0]}' share a '{at[1]}': " + ", ".join(f"'{v}' ({-n})" for n, v in top) + "."})
            stats.unpersist()
            relations.discard()
        drivers = [c["column_name"] for c in columns if c["logical_type"] in ("categorical", "boolean") and c["distinct_count"] <= MAX_CATEGORIES]
        partly = [c["column_name"] for c in columns if c["rows"] and MISSING_SHARE <= c["missing_count"] / c["rows"] <= 1 - MISSING_SHARE]
        if any(c != d for c in partly for d in drivers):
            gaps = [r.asDict() for r in conditional_missing(df, partly, drivers, tokens).collect()]
            out["conditional_missing"] = gaps
            for r in gaps:
                file_notes.append({"code": "CONDITIONAL_MISSING", "detail": f"'{r['column']}' is missing where '{r['explained_by']}' is one of {', '.join(r['missing_when'])}; {r['exceptions']} rows are otherwise."})
    out |= {"notes": file_notes, "observations": list(dict.fromkeys(x["code"] for x in file_notes))}
    every.unpersist()
    return out
