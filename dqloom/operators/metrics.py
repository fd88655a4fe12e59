"""Tables for reporting: runs by round, rules, the quarantine's history, corrections with their outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OUTCOMES = {"RESOLVED": "resolved", "OPEN": "failed_again", "MANUAL_REVIEW_REQUIRED": "manual_review", "DISCARDED": "discarded"}


def score(part: Column, whole: Column) -> Column:
    return F.round(F.when(whole > 0, part / whole).otherwise(F.lit(0.0)), 6)


def run_funnel(first: DataFrame, rounds: DataFrame) -> DataFrame:
    """Running totals over rounds. first: run_id, processed, valid, quarantined. rounds: run_id, round (2 and up), resolved, manually_fixed, confirmed, discarded, manual_review, open_after."""
    start = first.select("run_id", F.lit(1).alias("round"), *[F.lit(0).cast("long").alias(c) for c in ("resolved", "manually_fixed", "confirmed", "discarded", "manual_review")], F.col("quarantined").alias("open_after"))
    rows = start.unionByName(rounds.select(*start.columns))
    w = Window.partitionBy("run_id").orderBy("round").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = {c: F.sum(c).over(w) for c in ("resolved", "manually_fixed", "confirmed", "discarded", "manual_review")}
    rows = rows.select("run_id", "round", *[v.alias(c) for c, v in total.items()], F.col("open_after").alias("open"))
    rows = rows.join(first, "run_id")
    rows = rows.withColumns({
        "auto_resolved": F.col("resolved") - F.col("manually_fixed") - F.col("confirmed"), "unresolved": F.col("open") + F.col("manual_review"),
        "initial_score": score(F.col("valid"), F.col("processed")), "final_score": score(F.col("valid") + F.col("resolved"), F.col("processed")),
    })
    return rows.withColumn("balanced", F.col("resolved") + F.col("discarded") + F.col("unresolved") == F.col("quarantined"))


def quarantine_history(history: DataFrame, order: str = "seq", ordered: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Status changes of each record (of each run, if by names the run), numbered, with the status before; if ordered, sorted by record and number."""
    w = Window.partitionBy(*by, "record_id").orderBy(order)
    out = history.withColumn("sequence", F.row_number().over(w)).withColumn("previous_status", F.lag("status").over(w))
    return out.orderBy("record_id", "sequence") if ordered else out


def newest_lines(log: DataFrame, n: int = 200) -> DataFrame:
    """The last lines of the correction log, newest first."""
    return log.orderBy(F.desc("seq")).limit(n)


def correction_outcomes(log: DataFrame, after: DataFrame, automatic: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Manual lines (record_id, column, action, round, seq, ...) with what became of them, and automatic repairs.

    after: record_id, round, status_after. Of lines for one field in a round, all but the newest are superseded; a record
    whose round was not re-validated yet is pending. by: columns that tell runs apart.
    """
    w = Window.partitionBy(*by, "round", "record_id", "column", "action").orderBy(F.desc("seq"))
    named = F.create_map(*[F.lit(x) for kv in OUTCOMES.items() for x in kv])
    rows = log.join(after.dropDuplicates([*by, "record_id", "round"]), [*by, "record_id", "round"], "left").withColumn("newest", F.row_number().over(w) == 1)
    outcome = F.when(~F.col("newest"), "superseded").otherwise(F.coalesce(F.try_element_at(named, F.col("status_after")), F.lit("pending")))
    rows = rows.withColumn("outcome", outcome).withColumn("correction_type", F.lit("manual")).drop("newest", "status_after")
    if automatic is not None:
        rows = rows.unionByName(automatic.withColumn("correction_type", F.lit("automatic")), allowMissingColumns=True)
    return rows


def auto_fixed_records(audit: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Number of records that were repaired and not quarantined."""
    fixed = audit.filter(F.col("outcome").isin("remediated", "nullified_in_accepted")).join(quarantined.select("record_id"), "record_id", "left_anti")
    return fixed.agg(F.countDistinct("record_id").alias("auto_fixed_records"))


def rule_results(statistics: DataFrame, run_id: str | Column, round_: int | Column) -> DataFrame:
    kind = F.when(F.lit(round_) == 1, "validation").otherwise("revalidation")
    return statistics.select(F.lit(run_id).alias("run_id"), F.lit(round_).alias("round"), kind.alias("round_type"), "rule_id", "type", "dimension", "severity", "checked", F.col("detected").alias("failed"), F.col("remediated").alias("repaired"), "unresolved")


#: What is read of the document of a round.
RESULT = "run_id string, round int, revalidated_round int, counts map<string,double>, rules array<struct<rule_id:string,type:string,dimension:string,severity:string,checked:bigint,detected:bigint,remediated:bigint,unresolved:bigint>>"


def runs_funnel(results: DataFrame, resolved: DataFrame, log: DataFrame) -> DataFrame:
    """run_funnel of all runs. results: documents of rounds (RESULT); resolved: run_id, round, record_id; log: run_id, round, record_id, action, ...

    A resolved record counts as fixed by hand if any of its round's lines is a fix, and else as confirmed if any accepts.
    """
    count = lambda name: F.coalesce(F.try_element_at("counts", F.lit(name)).cast("long"), F.lit(0).cast("long"))
    first = results.filter("round = 1").select("run_id", count("processed").alias("processed"), count("accepted").alias("valid"), count("quarantined").alias("quarantined"))
    has = lambda action: F.max((F.col("action") == action).cast("int"))
    lines = log.groupBy("run_id", "round", "record_id").agg(has("FIX").alias("fix"), has("ACCEPT").alias("accept"))
    how = resolved.join(lines, ["run_id", "round", "record_id"]).groupBy("run_id", F.col("round").alias("revalidated_round")).agg(F.sum("fix").alias("f"), F.count_if((F.col("fix") == 0) & (F.col("accept") == 1)).alias("a"))
    later = results.filter("round > 1").join(how, ["run_id", "revalidated_round"], "left")
    rounds = later.select(
        "run_id", "round", count("resolved").alias("resolved"), F.coalesce("f", F.lit(0)).alias("manually_fixed"), F.coalesce("a", F.lit(0)).alias("confirmed"), (count("discarded") + count("removed_as_duplicate")).alias("discarded"),
        count("manual_review_required").alias("manual_review"), count("open_after").alias("open_after"),
    )
    return run_funnel(first, rounds)


def runs_rules(results: DataFrame) -> DataFrame:
    """rule_results of all runs and rounds."""
    return rule_results(results.select("run_id", "round", F.explode("rules").alias("r")).select("run_id", "round", "r.*"), F.col("run_id"), F.col("round"))


def runs_corrections(results: DataFrame, log: DataFrame, history: DataFrame, audit: DataFrame) -> DataFrame:
    """correction_outcomes of all runs: lines by hand with what became of them, and automatic repairs. history: run_id, record_id, status, seq; audit: run_id, round, ..."""
    rounds = results.filter("round > 1").select("run_id", F.col("round").alias("seq"), F.col("revalidated_round").alias("round"))
    after = history.select("run_id", "record_id", "status", "seq").join(rounds, ["run_id", "seq"]).select("run_id", "record_id", "round", F.col("status").alias("status_after"))
    automatic = audit.select("run_id", "record_id", "column", "round", "action", "rule_id", F.col("original_value").alias("old_value"), F.col("cleaned_value").alias("new_value"), "outcome")
    return correction_outcomes(log.withColumn("seq", F.struct("batch", "seq")), after, None, ("run_id",)).drop("seq", "batch").unionByName(automatic.withColumn("correction_type", F.lit("automatic")), allowMissingColumns=True)
