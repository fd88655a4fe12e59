"""How columns depend on key columns.

No row is copied for each pair of columns. One grouping by key (a row goes once to each key column it is grouped by) tells for every other column how
many values a key has and the least and the greatest of them: where these are equal the key has one value and all is known. Only values of
keys in conflict are counted one by one. Keys on many rows are partial rows of each task in the grouping; where rows meet their conflicts, keys on more
than one of ``HOT`` parts of all rows, at most HOT for each key column, are broadcast, and no other key is large.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.sources.shared import discard, written

# Thresholds of the profile.
AGREEMENT, ERROR_RATIO = 0.95, 0.2
SHARED_KEYS, SHARED_FACTOR, SHARED_TOP = 10, 10, 10
NEAR_KEY = 0.99
#: Keys with at least this part of all rows are joined by broadcast.
HOT = 10_000


@dataclass(frozen=True)
class Relations:
    """What is known of key columns and others. groups: key, k, n, and for the i-th column n_i, lo_i, hi_i. conflicts: key, column, k, v, n for keys with
    several values. values: column, v and in n_i the rows that have the i-th key. No column is set against itself."""

    keys: list[str]
    columns: list[str]
    groups: DataFrame
    conflicts: DataFrame
    values: DataFrame

    def discard(self) -> None:
        discard(self.groups, self.conflicts, self.values)

    def pairs(self) -> list[tuple[str, str]]:
        return [(k, c) for k in self.keys for c in self.columns if k != c]


def _several(i: int) -> Column:
    return F.col(f"lo_{i}") != F.col(f"hi_{i}")


def relate(df: DataFrame, keys: list[str], columns: list[str], forms: dict[str, Column]) -> Relations:
    """forms: the comparable form of each column, null where it is missing. Rows without a key take no part in its figures, nor do missing values."""
    m = range(len(columns))
    flat = df.select(*[forms[k].alias(f"k_{j}") for j, k in enumerate(keys)], *[forms[c].alias(f"c_{i}") for i, c in enumerate(columns)])
    to_keys = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"k_{j}").alias("k")) for j, k in enumerate(keys)])).alias("p")
    own = lambda i: F.when(F.col("key") != columns[i], F.col(f"c_{i}"))
    rows = flat.select(to_keys, *[f"c_{i}" for i in m]).select("p.*", *[f"c_{i}" for i in m]).filter("k is not null").select("key", "k", *[own(i).alias(f"c_{i}") for i in m])
    measures = [f(f"c_{i}").alias(f"{name}_{i}") for i in m for f, name in ((F.count, "n"), (F.min, "lo"), (F.max, "hi"))]
    groups = written(rows.groupBy("key", "k").agg(F.count("*").alias("n"), *measures), "groups")

    all_rows = groups.groupBy("key").agg((F.sum("n") / HOT).alias("many"))  # as many rows as key columns
    open_ = F.array_compact(F.array(*[F.when(_several(i), F.lit(i)) for i in m]))
    marked = groups.select("key", "k", "n", open_.alias("open")).join(F.broadcast(all_rows), "key").withColumn("hot", F.col("n") >= F.greatest("many", F.lit(2)))
    hot = marked.filter("hot").select("key", "k", "open")  # at most HOT for each key column
    cold = marked.filter("not hot and size(open) > 0").select("key", "k", "open")
    wide = rows.select("key", "k", F.array(*[f"c_{i}" for i in m]).alias("c"))
    met = wide.join(F.broadcast(hot), ["key", "k"]).filter("size(open) > 0").unionByName(wide.join(F.broadcast(hot.drop("open")), ["key", "k"], "left_anti").join(cold, ["key", "k"]))
    names = F.array(*map(F.lit, columns))
    long = met.select("key", "k", "c", F.explode("open").alias("i")).select("key", F.get(names, "i").alias("column"), "k", F.get("c", F.col("i")).alias("v")).filter("v is not null")
    conflicts = written(long.groupBy("key", "column", "k", "v").agg(F.count("*").alias("n")), "conflicts")

    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c_{i}").alias("v")) for i, c in enumerate(columns)])).alias("p")
    held = flat.select(each, *[F.col(f"k_{j}").isNotNull().alias(f"h_{j}") for j in range(len(keys))]).filter("p.v is not null").groupBy("p.column", "p.v")
    values = written(held.agg(*[F.count_if(F.col(f"h_{j}")).alias(f"n_{j}") for j in range(len(keys))]), "values")
    return Relations(keys, columns, groups, conflicts, values)


def _longer(df: DataFrame, by: str, names: list[str], figures: dict[str, str], other: str) -> DataFrame:
    """One row for each of names from columns <figure>_<i>; a few rows in, a few out."""
    each = F.array(*[F.struct(F.lit(c).alias(other), *[F.col(f"{f}_{i}").alias(a) for f, a in figures.items()]) for i, c in enumerate(names)])
    return df.select(by, F.explode(each).alias("p")).select(by, "p.*").filter(F.col(by) != F.col(other))


def consistency(r: Relations) -> DataFrame:
    """By (key, column): how far each key has one value. Conflicting rows differ from their key's most frequent value."""
    figures = {"rows": "rows", "keys": "keys", "test": "testable_keys", "conf": "conflicting_keys", "alone": "alone"}
    sums = []
    for i in range(len(r.columns)):
        n = F.col(f"n_{i}")
        sums += [F.sum(n).alias(f"rows_{i}"), F.count_if(n > 0).alias(f"keys_{i}"), F.count_if(n >= 2).alias(f"test_{i}"), F.count_if(_several(i)).alias(f"conf_{i}"), F.sum(F.when(~_several(i), n).otherwise(0)).alias(f"alone_{i}")]
    stats = _longer(r.groups.groupBy("key").agg(*sums), "key", r.columns, figures, "column").filter("keys > 0")
    tops = r.conflicts.groupBy("key", "column", "k").agg(F.max("n").alias("top")).groupBy("key", "column").agg(F.sum("top").alias("tops"))
    best = _longer(r.values.groupBy("column").agg(*[F.max(f"n_{j}").alias(f"n_{j}") for j in range(len(r.keys))]), "column", r.keys, {"n": "top_value_rows"}, "key")
    out = stats.join(tops, ["key", "column"], "left").join(best, ["key", "column"])
    agreeing = F.when(F.col("alone").isNull(), 0).otherwise(F.col("alone")) + F.coalesce("tops", F.lit(0))
    return out.select("key", "column", "rows", "keys", "testable_keys", "conflicting_keys", (F.col("rows") - agreeing).alias("conflicting_rows"), "top_value_rows")


def entity_attributes(stats: DataFrame) -> DataFrame:
    """Columns that a key decides: agreement of rows is high, and the error far below that of always guessing the top value."""
    agreement = 1 - F.col("conflicting_rows") / F.col("rows")
    baseline = 1 - F.col("top_value_rows") / F.col("rows")
    ok = (F.col("testable_keys") > 0) & (agreement >= AGREEMENT) & (F.col("conflicting_rows") / F.col("rows") <= ERROR_RATIO * baseline)
    return stats.withColumn("agreement", F.round(agreement, 6)).filter(ok)


def key_repeats(r: Relations) -> DataFrame:
    """By key column: its present rows, distinct keys, keys on more than one row, and the rows of those."""
    many = F.col("n") > 1
    return r.groups.groupBy("key").agg(F.sum("n").alias("rows"), F.count("*").alias("keys"), F.count_if(many).alias("repeated_key_count"), F.sum(F.when(many, F.col("n")).otherwise(0)).alias("row_count"))


def duplicate_keys(repeats: DataFrame, stats: DataFrame, total: int) -> DataFrame:
    """Near keys that repeat: (key, repeated_key_count, row_count, differing_columns), the last with how many keys have several values in a column."""
    near = repeats.filter((F.col("repeated_key_count") > 0) & (F.col("keys") >= NEAR_KEY * total)).select("key", "repeated_key_count", "row_count")
    differing = stats.filter("conflicting_keys > 0").groupBy("key").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("conflicting_keys")).alias("o"), "column"))), lambda x: F.struct(x["column"], -x["o"]))).alias("differing_columns"))
    return near.join(differing, "key", "left").withColumn("differing_columns", F.coalesce("differing_columns", F.create_map().cast("map<string,bigint>")))


def shared_values(r: Relations, only: list[str] | None = None) -> DataFrame:
    """Values of a nearly identifying column that unusually many keys hold: (key, column, value, key_count), the top ones. only: these key columns.

    Which columns identify nearly is known from counts; only their keys are listed by value.
    """
    distinct = r.values.groupBy("column").agg(*[F.count_if(F.col(f"n_{j}") > 0).alias(f"n_{j}") for j in range(len(r.keys))])
    keys = r.groups.groupBy("key").agg(*[F.count_if(F.col(f"n_{i}") > 0).alias(f"n_{i}") for i in range(len(r.columns))])
    facts = _longer(distinct, "column", r.keys, {"n": "values"}, "key").join(_longer(keys, "key", r.columns, {"n": "keys"}, "column"), ["key", "column"])
    near = [(x["key"], x["column"]) for x in facts.filter("keys > 0 and values >= 0.5 * keys").select("key", "column").collect() if only is None or x["key"] in only]  # at most the pairs of columns
    schema = "key string, column string, value string, key_count long"
    if not near:
        return r.groups.sparkSession.createDataFrame([], schema)
    wanted = [F.when((F.col("key") == k) & (F.col(f"n_{i}") > 0) & ~_several(i), F.struct(F.lit(c).alias("column"), F.col(f"lo_{i}").alias("v"))) for i, c in enumerate(r.columns) for k in r.keys if (k, c) in near]
    single = r.groups.select("key", F.explode(F.array_compact(F.array(*wanted))).alias("p")).select("key", "p.column", "p.v")
    both = reduce(lambda x, y: x | y, [(F.col("key") == k) & (F.col("column") == c) for k, c in near])
    held = single.unionByName(r.conflicts.filter(both).select("key", "column", "v")).groupBy("key", "column", F.col("v").alias("value")).agg(F.count("*").alias("key_count"))
    least = held.groupBy("key", "column").agg(F.greatest(F.lit(float(SHARED_KEYS)), SHARED_FACTOR * F.percentile("key_count", F.lit(0.5))).alias("least"))  # counts repeat, so the percentile's table is small
    rows = held.join(F.broadcast(least), ["key", "column"]).filter(F.col("key_count") >= F.col("least"))  # least: at most the pairs of columns
    first = F.expr("row_number() over (partition by key, column, slice order by key_count desc, value)")
    some = rows.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(64))).withColumn("r", first).filter(F.col("r") <= SHARED_TOP)
    return some.withColumn("r", F.expr("row_number() over (partition by key, column order by key_count desc, value)")).filter(F.col("r") <= SHARED_TOP).select("key", "column", "value", "key_count")
