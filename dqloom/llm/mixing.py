"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length within each source. Sources share the whole corpus by weight, no source above
``MOST`` times its own size; what a capped source cannot take is shared again among the rest. A source then takes all its
documents q times (q = target div size) and, for the remaining budget, so many documents of each length: a share of each
count in proportion first, the longest next, and a bounded-knapsack over what is left for an exact fit. Which documents of
a length are taken follows a seeded hash of id and text, by one threshold for each (source, length); no document is sorted
with all others of its length in one task, so a length or a source may hold any share of the rows.

The knapsack sees one source's counts by length (as many rows as there are different lengths), never documents. Its room grows up to
``WIDEST`` words; what it then still misses is less than the length of the shortest document that was not taken.

Nulls and odd input: a null text has size 0, and documents of size 0 are never taken (taken = 0); a null source is one
source, last in order; rows without an id or that share one are told apart by their text, and rows that repeat both by their place in the
input, so that exactly as many of them are taken as are wanted (the input has to be read the same way twice, as a table is); a very long
text is a document of its size; an empty table gives an empty result; further columns are carried by ``mix`` whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import freed, n_words, table, written

MOST = 3
CYCLE = (1, 2, 3)
SEED = 17
SALTS = 64
#: Words that the knapsack may give back and fill anew at most; the fit is exact below, and off by a few words at worst beyond.
WIDEST = 1 << 20
#: Up to so many (source, length) pairs the plan is broadcast (32 bytes each); beyond it is joined by a salted shuffle.
BROADCAST_ROWS = 200_000


def shares(sizes: list[int], weights: list[float], most: int = MOST) -> list[float]:
    """Targets that add up to the sum of sizes, by weight, none above most * its size."""
    targets, open_, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in sorted(open_) if rest * weights[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = rest * weights[i] / total
            break
        for i in over:
            targets[i] = float(most * sizes[i])
            open_.discard(i)
        rest -= sum(targets[i] for i in over)
    return targets


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their lengths add up to the budget or as near below as can be.

    lengths: different, above 0. A proportional share first, then the longest that fit, then a bounded knapsack by
    dynamic programming over the remaining budget and a margin given back to it.
    """
    order = np.argsort(-lengths, kind="stable")
    lens, have = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    total = int((lens * have).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), dtype=np.int64)
    if budget >= total:
        return counts.astype(np.int64).copy()
    take = np.array([int(c) * budget // total for c in have], dtype=np.int64)
    rest = budget - int((take * lens).sum())
    for i, size in enumerate(lens):
        more = min(int(have[i] - take[i]), rest // int(size))
        take[i] += more
        rest -= more * int(size)
    room = 4 * int(lens[len(lens) // 2]) + 64
    while rest:
        # Give back documents, shortest first, so that the knapsack has room; more of them if that does not fill the budget.
        trial, left, given = take.copy(), rest, 0
        for i in range(len(lens) - 1, -1, -1):
            back = min(int(trial[i]), max(0, 1 + (room - given) // int(lens[i])) if given < room else 0)
            trial[i] -= back
            given += back * int(lens[i])
        left += given
        trial += _knapsack(lens, have - trial, left)
        over = budget - int((trial * lens).sum())
        if over < rest:
            take, rest = trial, over
        if given < room or room >= WIDEST:
            break
        room *= 4
    out = np.empty_like(take)
    out[order] = take
    return out


def _knapsack(lens: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: the largest sum up to budget; counts are split into powers of two, sums are bits of one integer."""
    reach, mask, pieces, added = 1, (1 << (budget + 1)) - 1, [], []
    for i in range(len(lens) - 1, -1, -1):
        left, size = min(int(free[i]), budget // int(lens[i])), 1
        while left > 0 and not reach >> budget & 1:
            n = min(size, left)
            new = (reach << (n * int(lens[i]))) & mask & ~reach
            if new:
                pieces.append((i, n))
                added.append(new)
                reach |= new
            left, size = left - n, size * 2
        if reach >> budget & 1:
            break
    at, out = reach.bit_length() - 1, np.zeros(len(lens), dtype=np.int64)
    for (i, n), new in zip(reversed(pieces), reversed(added), strict=True):
        if new >> at & 1:
            out[i] += n
            at -= n * int(lens[i])
    return out


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "id", "text_hash")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """(id, text_hash, source, size, place) of each row; place is its number by partition."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(source_col).alias("source"), n_words(text).alias("size"), F.monotonically_increasing_id().alias("place"), *more)


def plan(sized: DataFrame, seed: int = SEED, most: int = MOST, cycle: tuple = CYCLE, salts: int = SALTS) -> DataFrame:
    """For rows (id, text_hash, source, size, place): source, size, source_size, target, times (whole repeats), and the last (h, place) taken once more."""
    spark = sized.sparkSession
    cells = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    cells = written(cells, "cells")
    per = [(r["source"], int(r["total"] or 0)) for r in cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("total")).collect()]
    per.sort(key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    targets = shares([s for _, s in per], [float(cycle[i % len(cycle)]) for i in range(len(per))], most)
    # By Arrow: from a list of rows Spark would start Python workers of a second kind, which then stay beside the others.
    names, sizes = [k for k, _ in per], [s for _, s in per]
    sources = spark.createDataFrame(pa.table({"source": pa.array(names, pa.string()), "source_size": pa.array(sizes, pa.int64()), "target": pa.array(targets, pa.float64())}))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        times = min(most, int(target // total)) if total else 0
        some = pdf[pdf["size"] > 0]
        want = fit_budget(some["size"].to_numpy(), some["n"].to_numpy(), round(target) - times * total if times < most else 0)
        pdf = pdf.assign(times=times, want=0)
        pdf.loc[some.index, "want"] = want
        return pdf[["source", "size", "n", "source_size", "target", "times", "want"]]

    quota = cells.join(F.broadcast(sources), cells.source.eqNullSafe(sources.source)).drop(sources.source)
    quota = quota.groupBy("source").applyInPandas(freed(fit), "source string, size long, n long, source_size long, target double, times int, want long")
    quota = written(quota, "quota")
    # The want-th smallest hash of each cell: a cell is cut into slices of the hash's range, and one slice of it into its different hashes.
    rows = sized.withColumn("h", _hash(seed))
    slices = F.shiftright(F.col("h"), 54) + 512
    open_ = quota.filter("want > 0 and want < n").select("source", "size", "want")
    cut = _where_reached(rows.groupBy("source", "size", slices.alias("part")).agg(F.count("*").alias("m")), open_, ["source", "size"], "part")
    edge = _matched(rows.withColumn("part", slices), cut.select("source", "size", "part", F.col("k").alias("want")), ["source", "size", "part"])
    hashes = edge.groupBy("source", "size", "want", "h").agg(F.count("*").alias("m"))
    last = _where_reached(hashes.drop("want"), cut.select("source", "size", F.col("k").alias("want")), ["source", "size"], "h")
    # Rows of that hash (those that repeat id and text) by their place: by partition first, then in one partition.
    ties = _matched(edge.select("source", "size", "h", "place"), last.filter("k < m").select("source", "size", "h", F.col("k").alias("want")), ["source", "size", "h"])
    ties = ties.withColumn("part", F.shiftright("place", 33))
    within = _where_reached(ties.groupBy("source", "size", "h", "part").agg(F.count("*").alias("m")), last.select("source", "size", "h", F.col("k").alias("want")), ["source", "size", "h"], "part")
    ties = _matched(ties.drop("want"), within.select("source", "size", "h", "part", "k"), ["source", "size", "h", "part"])
    ties = ties.withColumn("r", F.expr("row_number() over (partition by source, size, h, part order by place)")).filter("r = k").select("source", "size", F.col("place").alias("last_place"))
    last = last.select(F.col("source").alias("s_"), F.col("size").alias("z_"), F.col("h").alias("last_h"))
    ties = ties.select(F.col("source").alias("s2_"), F.col("size").alias("z2_"), "last_place")
    out = quota.join(last, quota.source.eqNullSafe(F.col("s_")) & (quota["size"] == F.col("z_")), "left")
    out = out.join(ties, out.source.eqNullSafe(F.col("s2_")) & (out["size"] == F.col("z2_")), "left")
    return written(out.drop("s_", "z_", "s2_", "z2_"), "mixplan")


def _where_reached(counts: DataFrame, wanted: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Of counts (keys, by, m), in order of by, the row in which the sum reaches want, with k, how much of its m is still wanted."""
    w = f"partition by {', '.join(keys)} order by {by}"
    counts = _matched(counts, wanted, keys).withColumn("upto", F.expr(f"sum(m) over ({w} rows unbounded preceding)"))
    return counts.filter("upto >= want and upto - m < want").select(*keys, by, "m", (F.col("want") - F.col("upto") + F.col("m")).alias("k"))


def _matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    right = right.select(*[F.col(c).alias(f"r_{c}" if c in keys else c) for c in right.columns])
    on = None
    for k in keys:
        term = left[k].eqNullSafe(right[f"r_{k}"]) if k == "source" else left[k] == right[f"r_{k}"]
        on = term if on is None else on & term
    return left.join(right, on).drop(*[f"r_{k}" for k in keys])


def taken(rows: DataFrame, decided: DataFrame, seed: int = SEED, salts: int = SALTS) -> DataFrame:
    """rows (with id, text_hash, source, size, place) with source_size, target and repeats (how often the mix takes the row)."""
    few = decided.count() <= BROADCAST_ROWS
    right = decided.select(F.col("source").alias("s_"), F.col("size").alias("z_"), "n", "source_size", "target", "times", "want", "last_h", "last_place")
    on = F.col("source").eqNullSafe(F.col("s_")) & (F.col("size") == F.col("z_"))
    if few:
        rows = rows.join(F.broadcast(right), on)
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "place"), F.lit(salts)))
        right = right.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rows = rows.join(right, on & (F.col("salt") == F.col("salt_"))).drop("salt", "salt_")
    h = _hash(seed)
    tied = F.col("last_place").isNull() | (F.col("place") <= F.col("last_place"))
    within = (F.col("want") >= F.col("n")) | F.coalesce((h < F.col("last_h")) | ((h == F.col("last_h")) & tied), F.lit(False))
    once = F.when((F.col("size") > 0) & (F.col("want") > 0) & within, 1).otherwise(0)
    repeats = F.when(F.col("size") > 0, F.col("times") + once).otherwise(0)
    return rows.withColumn("repeats", repeats).drop("s_", "z_", "n", "times", "want", "last_h", "last_place")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """The mixed corpus: each row of docs as often as the mix takes it, with all its columns."""
    rows = docs.select(F.struct("*").alias("row"))
    rows = _sizes(rows, f"row.{id_col}", f"row.{text_col}", f"row.{source_col}", F.col("row"))
    sized = written(rows.drop("row"), "sizes")
    out = taken(rows, plan(sized, seed), seed).filter("repeats > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), "repeats"))).select("row.*")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = written(_sizes(docs, "doc_id", "text", "source"), "sizes")
    out = taken(sized, plan(sized))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("repeats")).cast("long").alias("taken"), F.col("repeats").cast("int").alias("repeats"))
