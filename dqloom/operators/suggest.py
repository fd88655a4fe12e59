"""Suggested values for fields to fill: what accepted records with the same key mostly hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.plans.registry import Registry


def key_pairs(registry: Registry) -> list[tuple[str, str]]:
    """(key, column) in order of declaration: entities, then dependencies."""
    out = []
    for e in (registry.schema.get("entities") or {}).values():
        out += [(e["key"], c) for c in [*e.get("attributes", []), *(e.get("references") or {}).values()]]
    for d in (registry.schema.get("dependencies") or {}).values():
        out += [(d["determinant"], c) for c in d["dependents"]]
    return list(dict.fromkeys(out))


def majority_table(valid: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(key, column, key_value, value, support, total, place): the most frequent value, the least of equally frequent ones."""
    long = valid.select(F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(k).alias("key"), F.lit(c).alias("column"), F.col(f"`{k}`").alias("key_value"), F.col(f"`{c}`").alias("value")) for i, (k, c) in enumerate(pairs)])).alias("p")).select("p.*")
    counts = long.filter("key_value is not null and value is not null").groupBy("place", "key", "column", "key_value", "value").count()
    best = counts.groupBy("place", "key", "column", "key_value").agg(F.min_by(F.struct("value", F.col("count").alias("support")), F.struct((-F.col("count")).alias("c"), "value")).alias("b"), F.sum("count").alias("total"))
    return best.select("place", "key", "column", "key_value", "b.value", "b.support", "total")


def suggest(records: DataFrame, needs: DataFrame, valid: DataFrame, registry: Registry, passes: int = 2) -> DataFrame:
    """For (record_id, column) in needs: value, source_column, source_value, support, total. A value found in one pass is a key in the next."""
    pairs = [(k, c) for k, c in key_pairs(registry) if k in valid.columns and c in valid.columns]
    table = majority_table(valid, pairs)
    keys = list(dict.fromkeys(k for k, _ in pairs))
    known = records.select("record_id", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"`{k}`").alias("key_value")) for k in keys if k in records.columns])).alias("p")).select("record_id", "p.key", "p.key_value").filter("key_value is not null")
    found = None
    for _ in range(passes):
        open_ = needs if found is None else needs.join(found.select("record_id", "column"), ["record_id", "column"], "left_anti")
        hits = open_.join(known, "record_id").join(table, ["key", "column", "key_value"])
        best = hits.groupBy("record_id", "column").agg(F.max_by(F.struct("value", F.col("key").alias("source_column"), F.col("key_value").alias("source_value"), "support", "total"), F.struct("support", (-F.col("place")).alias("p"))).alias("b")).select("record_id", "column", "b.*")
        found = best if found is None else found.unionByName(best)
        known = known.unionByName(best.filter(F.col("column").isin(keys)).select("record_id", F.col("column").alias("key"), F.col("value").alias("key_value")))
    return found


def complete_by_suggestion(needs: DataFrame, found: DataFrame, blocking: DataFrame) -> DataFrame:
    """Records for which every field to fill was found and no other problem blocks (blocking: record_id, column)."""
    all_ = needs.groupBy("record_id").agg(F.count("*").alias("n"))
    got = found.groupBy("record_id").agg(F.count("*").alias("k"))
    other = blocking.join(needs, ["record_id", "column"], "left_anti").select("record_id")
    return all_.join(got, "record_id").filter("n = k").join(other, "record_id", "left_anti").select("record_id")


def only_review(errors: DataFrame, review_code: str = "auto_fix_review") -> DataFrame:
    """Records whose only critical problem is the review of automatic repairs."""
    critical = errors.filter("severity = 'critical'")
    return critical.filter(F.col("error_category") == review_code).select("record_id").distinct().join(critical.filter(F.col("error_category") != review_code), "record_id", "left_anti")


def examples(valid: DataFrame, columns: list[str], order: str) -> DataFrame:
    """First value of each column by an order column."""
    row = valid.agg(*[F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(order))).alias(c) for c in columns])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("example")) for c in columns])).alias("p")).select("p.*")


def other_copies(records: DataFrame, column: str) -> DataFrame:
    """For every record whose value of a column others hold too: the value, how many others, and the first and last record of the value. The value names
    the class, so its members are a filter on this table; no pairs are made."""
    rows = records.select("record_id", F.col(f"`{column}`").alias("value")).filter("value is not null")
    classes = rows.groupBy("value").agg((F.count("*") - 1).alias("others"), F.min("record_id").alias("first"), F.max("record_id").alias("last")).filter("others > 0")
    return rows.join(classes, "value").select("record_id", "value", "others", "first", "last")


def copy_groups(records: DataFrame, column: str) -> DataFrame:
    """For every record: its value of a column, how many records hold it (1 for a null), and the least other one of them.

    The value names the group, so its members are a filter on this table; no pairs are made. Record ids are unique.
    """
    rows = records.select("record_id", F.col(f"`{column}`").alias("value"))
    groups = rows.filter("value is not null").groupBy("value").agg(F.count("*").alias("n"), F.min("record_id").alias("first")).filter("n > 1")
    known = rows.join(groups, "value", "left")
    # The first record of a group points to the second one.
    second = known.filter("record_id <> first").groupBy("value").agg(F.min("first").alias("record_id"), F.min("record_id").alias("second"))
    out = known.join(second, ["record_id", "value"], "left")
    return out.select("record_id", "value", F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.coalesce("second", "first").alias("representative"))


def lines_from_changes(changes: dict[str, dict]) -> list[dict]:
    """Correction lines from an editor's changes {record: {"discard": bool, "accept": bool, "values": {column: text}, "reason": text}}: discard wins; an accept stands before fixes; an empty text becomes the null marker."""
    out = []
    for record, c in changes.items():
        reason = c.get("reason", "")
        if c.get("discard"):
            out.append({"record_id": record, "column": "", "new_value": "", "action": "DISCARD", "reason": reason})
            continue
        if c.get("accept"):
            out.append({"record_id": record, "column": "", "new_value": "", "action": "ACCEPT", "reason": reason})
        out += [{"record_id": record, "column": k, "new_value": v if v != "" else "__NULL__", "action": "FIX", "reason": reason} for k, v in (c.get("values") or {}).items()]
    return out
