"""Manual correction of quarantined records: template, import, re-validation, ledger."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.operators.engine import Validation, validate
from dqloom.plans.registry import ConfigError, Registry
from dqloom.sources.shared import written

OPEN, RESOLVED, MANUAL_REVIEW, DISCARDED = "OPEN", "RESOLVED", "MANUAL_REVIEW_REQUIRED", "DISCARDED"
ACTIONS = ("FIX", "DISCARD", "ACCEPT")
#: A new value that stands for null.
NULL_MARKER = "__NULL__"
MAX_ATTEMPTS = 3
LEDGER = "record_id string, status string, round int, attempts int, updated_at string"
CORRECTIONS = ["record_id", "column", "old_value", "new_value", "action", "reason", "user", "corrected_at"]


def open_ledger(quarantine: DataFrame, now: str) -> DataFrame:
    """The ledger after a first validation: every quarantined record is open in round 1."""
    return quarantine.select("record_id", F.lit(OPEN).alias("status"), F.lit(1).alias("round"), F.lit(0).alias("attempts"), F.lit(now).alias("updated_at"))


def current_round(ledger: DataFrame) -> int | None:
    """The highest round among open records; none if nothing is open."""
    return ledger.filter(F.col("status") == OPEN).agg(F.max("round")).first()[0]


def changed_entries(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ledger rows whose (record, status, round, attempts) was not there before; what the history gets."""
    key = ["record_id", "status", "round", "attempts"]
    return after.join(before.select(*key), key, "left_anti").select(*key, F.col("updated_at").alias("changed_at"))


def template(errors: DataFrame, open_ids: DataFrame, rules: list[str] | None = None, codes: list[str] | None = None) -> DataFrame:
    """One line per open record and column to correct, critical first: value, ordered distinct codes, messages and rules."""
    rows = errors.join(open_ids.select("record_id"), "record_id", "left_semi")
    if rules:
        rows = rows.filter(F.col("rule_id").isin(rules))
    if codes:
        rows = rows.filter(F.col("error_code").isin(codes))
    first = F.when(F.col("severity") == "critical", 0).otherwise(1)
    line = F.struct(first.alias("o"), F.col("rule_id").alias("r"), "error_code", "severity", "message", "value")
    rows = rows.withColumn("column", F.coalesce("column", F.lit(""))).groupBy("record_id", "column").agg(F.array_sort(F.collect_list(line)).alias("l"))  # a record has at most as many lines as rules

    def joined(name: str) -> Column:
        return F.concat_ws(" | ", F.array_distinct(F.transform("l", lambda x: x[name])))

    value = F.try_element_at(F.filter(F.transform("l", lambda x: x["value"]), lambda v: v.isNotNull()), F.lit(1))
    none = F.lit("")
    return rows.select("record_id", "column", value.alias("current_value"), joined("error_code").alias("error_codes"), F.col("l")[0]["severity"].alias("severity"), joined("message").alias("messages"), joined("r").alias("rule_ids"), none.alias("new_value"), none.alias("action"), none.alias("reason"))


@dataclass
class Import:
    round: int
    accepted: DataFrame
    refused: DataFrame


def import_lines(lines: DataFrame, ledger: DataFrame, records: DataFrame, registry: Registry, user: str, now: str, order: str = "line_no") -> Import:
    """Check correction lines (record_id, column, new_value[, action, reason], line number) against the open records of the round."""
    missing = {"record_id", "column", "new_value"} - set(lines.columns)
    if missing:
        raise ConfigError(f"the corrections lack the columns {sorted(missing)}")
    number = current_round(ledger)
    if number is None:
        raise ConfigError("no record is open")
    for c in ("action", "reason"):
        if c not in lines.columns:
            lines = lines.withColumn(c, F.lit(""))
    if order not in lines.columns:
        lines = lines.withColumn(order, F.monotonically_increasing_id())
    clean = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")).alias(c)
    rows = lines.select(*[clean(c) for c in ("record_id", "column", "new_value", "action", "reason")], F.col(order).alias("seq"))
    rows = rows.withColumn("action", F.when(F.col("action") == "", "FIX").otherwise(F.upper("action")))
    whole = F.col("action").isin("DISCARD", "ACCEPT")
    rows = rows.filter((F.col("new_value") != "") | whole)
    open_ = ledger.filter((F.col("status") == OPEN) & (F.col("round") == number)).select("record_id", F.lit(True).alias("is_open"))
    rows = rows.join(open_, "record_id", "left")
    editable = [c for c, s in registry.columns.items() if not s.get("generated")]
    refused = (
        F.when(~F.col("action").isin(*ACTIONS), F.concat(F.lit("unknown action '"), F.col("action"), F.lit("' (use FIX, DISCARD or ACCEPT)")))
        .when(F.col("is_open").isNull(), F.lit(f"record is not open in round {number}"))
        .when(whole, F.lit(""))
        .when(~F.col("column").isin(editable), F.concat(F.lit("'"), F.col("column"), F.lit("' is not an editable schema column")))
        .otherwise(F.lit(""))
    )
    rows = rows.withColumn("refused", refused)
    fix = (F.col("refused") == "") & (F.col("action") == "FIX")
    twice = rows.filter(fix).groupBy("record_id", "column").agg(F.countDistinct("new_value").alias("values")).filter("values > 1").select("record_id", "column", F.lit(True).alias("twice"))
    rows = rows.join(twice, ["record_id", "column"], "left").withColumn("refused", F.when(fix & F.coalesce("twice", F.lit(False)), F.lit("corrected more than once with different values")).otherwise(F.col("refused")))
    rows = written(rows, "lines")
    good = rows.filter("refused = ''").groupBy("record_id", "column", "action").agg(F.min_by(F.struct("new_value", "reason", "seq"), "seq").alias("f"))
    good = good.select("record_id", F.when(F.col("action") == "FIX", F.col("column")).otherwise("").alias("column"), "action", "f.new_value", "f.reason", "f.seq")
    values = old_values(records, [c for c in editable if c in records.columns])
    good = good.join(values, ["record_id", "column"], "left")
    good = good.select("record_id", "column", "old_value", "new_value", "action", "reason", F.lit(user).alias("user"), F.lit(now).alias("corrected_at"), "seq")
    return Import(number, good, rows.filter("refused <> ''").select("record_id", "column", "new_value", "action", "reason", "refused"))


def old_values(records: DataFrame, columns: list[str]) -> DataFrame:
    """Records in long form: (record_id, column, old_value)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("old_value")) for c in columns])).alias("p")
    return records.select("record_id", pairs).select("record_id", "p.column", "p.old_value")


def newest_lines(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Accepted lines of a round over several imports: of lines for one field, the newest."""
    rows = new.withColumn("batch", F.lit(1)) if existing is None else existing.withColumn("batch", F.lit(0)).unionByName(new.withColumn("batch", F.lit(1)))
    key = ["record_id", "column", "action"]
    rest = [c for c in new.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct("batch", "seq")).alias("n"))
    return best.select(*[c if c in key else F.col(f"n.{c}").alias(c) for c in new.columns])


def apply_fixes(records: DataFrame, fixes: DataFrame, columns: list[str]) -> DataFrame:
    """Records with corrected cells; a marker stands for null."""
    cells = fixes.groupBy("record_id").agg(F.map_from_entries(F.collect_list(F.struct("column", "new_value"))).alias("fix"))  # one line per column
    rows = records.join(cells, "record_id", "left")
    out = []
    for c in columns:
        new = F.try_element_at("fix", F.lit(c))
        out.append(F.when(new == NULL_MARKER, F.lit(None).cast("string")).otherwise(F.coalesce(new, F.col(f"`{c}`"))).alias(c))
    return rows.select("record_id", *out)


@dataclass
class Round:
    ledger: DataFrame
    resolved: DataFrame
    records: DataFrame  # open records of the next round
    errors: DataFrame
    audit: DataFrame
    validation: Validation | None
    routed: DataFrame  # record_id, route


def revalidate(
    records: DataFrame, errors: DataFrame, corrections: DataFrame, ledger: DataFrame, valid: DataFrame, resolved_before: DataFrame | None, registry: Registry, run_date: dt.date, now: str,
    max_attempts: int = MAX_ATTEMPTS, everything: bool = False,
) -> Round | None:
    """Corrected records run through all rules in the context of the accepted ones; each gets a new place in the ledger. None if there is nothing to do.

    records, errors, ledger and valid are read several times, so they should be tables and not the plan of a validation.
    """
    number = current_round(ledger)
    if number is None:
        raise ConfigError("no record is open")
    columns = [c for c in records.columns if c not in ("record_id", "dq_errors", "dq_warnings")]
    pending = ledger.filter((F.col("status") == OPEN) & (F.col("round") == number)).select("record_id")
    lines = corrections.join(pending, "record_id", "left_semi")
    by = lines.groupBy("record_id").agg(*[F.max((F.col("action") == a).cast("int")).alias(a) for a in ACTIONS])
    plan = pending.join(by, "record_id", "left").fillna(0, list(ACTIONS))
    target = F.lit(True) if everything else (F.col("FIX") == 1) | (F.col("ACCEPT") == 1)
    plan = written(plan.select("record_id", F.when(F.col("DISCARD") == 1, "discard").when(target, "target").otherwise("untouched").alias("part")), "plan")
    if not plan.filter("part <> 'untouched'").limit(1).count():
        return None

    def of(part: str) -> DataFrame:
        return plan.filter(F.col("part") == part).select("record_id")

    fixed = apply_fixes(records.join(of("target"), "record_id", "left_semi"), lines.filter("action = 'FIX'").join(of("target"), "record_id", "left_semi"), columns)
    context = valid.select("record_id", *columns)
    if resolved_before is not None:
        context = context.unionByName(resolved_before.select("record_id", *columns))
    context = context.unionByName(records.join(of("untouched"), "record_id", "left_semi").select("record_id", *columns))
    # Corrected records come last, so that of equal rows the one that was there stays.
    frame = context.withColumn("focus", F.lit(False)).unionByName(fixed.withColumn("focus", F.lit(True)))
    # A record's number in its batch ends its id, so ties are decided the same way on every run.
    own = F.coalesce(F.regexp_extract("record_id", r"(\d{1,18})\z", 1).try_cast("long"), F.monotonically_increasing_id())
    frame = frame.withColumn("row_no", own + F.when(F.col("focus"), F.lit(1 << 62)).otherwise(F.lit(0)))
    v = validate(written(frame, "context"), registry, run_date)
    got = v.rows.filter("focus").select("record_id", "status")
    led = ledger.join(plan, "record_id", "left").join(got.withColumnRenamed("status", "got"), "record_id", "left")
    attempts = F.col("attempts") + F.when(F.col("part") == "target", 1).otherwise(0)
    route = (
        F.when(F.col("part") == "discard", "discarded").when(F.col("part") == "untouched", "carried").when(F.col("got") == "accepted", "resolved").when(F.col("got") == "removed", "duplicate")
        .when((F.col("got") == "quarantined") & (attempts >= max_attempts), "manual").when(F.col("got") == "quarantined", "failed")
    )
    led = led.withColumn("route", route)
    status = F.when(F.col("route") == "resolved", RESOLVED).when(F.col("route").isin("discarded", "duplicate"), DISCARDED).when(F.col("route") == "manual", MANUAL_REVIEW).when(F.col("route").isNotNull(), OPEN).otherwise(F.col("status"))
    next_ = F.when(F.col("route").isin("failed", "carried", "manual"), F.lit(number + 1)).otherwise(F.col("round"))
    led = written(led.select("record_id", status.alias("status"), next_.alias("round"), attempts.alias("attempts"), F.when(F.col("route").isNotNull(), F.lit(now)).otherwise(F.col("updated_at")).alias("updated_at"), "route"), "ledger")
    ids = lambda *r: led.filter(F.col("route").isin(*r)).select("record_id")
    failed = v.quarantine.join(ids("failed", "manual"), "record_id", "left_semi")
    carried = records.join(ids("carried"), "record_id", "left_semi").select(*failed.columns)
    return Round(
        ledger=led.drop("route"), resolved=v.valid.join(ids("resolved"), "record_id", "left_semi"), records=failed.unionByName(carried),
        errors=v.errors.join(ids("failed", "manual"), "record_id", "left_semi").unionByName(errors.join(ids("carried"), "record_id", "left_semi")),
        audit=v.audit.join(of("target"), "record_id", "left_semi"), validation=v, routed=led.filter("route is not null").select("record_id", "route"),
    )


def status_totals(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status", "round").count()
