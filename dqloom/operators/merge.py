"""One clean table from accepted and resolved records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.operators.corrections import RESOLVED
from dqloom.plans.registry import ConfigError


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of rows with one key, the one that is last in order."""
    best = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order)).alias("r"))
    return best.select(*[key if c == key else F.col(f"r.{c}").alias(c) for c in rows.columns])


def merge(valid: DataFrame, resolved: DataFrame | None, ledger: DataFrame | None = None) -> DataFrame:
    """Accepted records and, in place of any of the same id, the newest resolved ones (with their ``round``). Checks that the parts fit."""
    if resolved is None:
        return valid
    unknown = set(resolved.columns) - set(valid.columns) - {"round"}
    if unknown:
        raise ConfigError(f"resolved records have unknown columns {sorted(unknown)}")
    last = latest(resolved, "record_id", ["round"]).drop("round")
    if ledger is not None:
        stray = last.join(ledger.filter(F.col("status") == RESOLVED), "record_id", "left_anti").limit(5).collect()
        if stray:
            raise ConfigError(f"records are resolved but not in the ledger: {[r['record_id'] for r in stray]}")
    kept = valid.join(last.select("record_id"), "record_id", "left_anti")
    return kept.unionByName(last, allowMissingColumns=True)


def check_merged(clean: DataFrame, valid: DataFrame, resolved: DataFrame | None) -> dict[str, int]:
    """Counts of the parts; raises if they do not add up or an id occurs twice."""
    n = clean.agg(F.count("*").alias("rows"), F.countDistinct("record_id").alias("ids")).first()
    v = valid.count()
    r = resolved.select("record_id").distinct() if resolved is not None else valid.limit(0).select("record_id")
    counts = {"valid": v, "resolved": r.count(), "replaced": valid.join(r, "record_id", "left_semi").count(), "clean": n["rows"]}
    if n["rows"] != n["ids"]:
        raise ConfigError(f"{n['rows'] - n['ids']} record ids occur twice in the clean table")
    if counts["clean"] != counts["valid"] + counts["resolved"] - counts["replaced"]:
        raise ConfigError(f"the clean table does not add up: {counts}")
    return counts
