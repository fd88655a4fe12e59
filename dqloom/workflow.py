"""The steps of a run: land, profile, validate, template, import, revalidate, merge, metrics, status. Each reads and writes tables of the run."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.operators import corrections as C
from dqloom.operators import engine as E
from dqloom.operators import metrics as M
from dqloom.operators.merge import check_merged, merge
from dqloom.operators.profile import profile
from dqloom.plans.registry import ConfigError, Registry
from dqloom.sources.land import LayoutError, Run, all_documents, all_parts, list_runs, now_utc, read_batch, register_profile
from dqloom.sources.text_csv import missing_and_extra

# Columns of a run's tables that are read over all runs.
HISTORY = "record_id string, status string, round int, attempts int, changed_at string, seq int"
LOG = "record_id string, column string, old_value string, new_value string, action string, reason string, user string, corrected_at string, seq long, round int, batch int"
AUDIT = ", ".join(f"{c} string" for c in E.AUDIT_COLUMNS)


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def run_profile(spark: SparkSession, raw_root: str, dataset: str, out: str, run: str | None = None, run_date: dt.date | None = None, relationships: bool = True, null_tokens: tuple[str, ...] | None = None) -> dict:
    manifest, rows = read_batch(spark, raw_root, dataset, run, null_blank=False)
    found = profile(rows.drop("row_no", "record_id"), relationships=relationships, run_date=run_date, null_tokens=null_tokens)
    result = Run(spark, out, dataset, manifest["ingestion_id"])
    result.save("profile", found)
    register_profile(raw_root, dataset, manifest["ingestion_id"], str(result.documents / "profile.json"))
    return found


def run_validate(spark: SparkSession, raw_root: str, dataset: str, out: str, registry: Registry, run_date: dt.date, run: str | None = None, force: bool = False) -> dict:
    """First validation of a landed batch. A run that was validated is left alone unless forced; one that was left half-way is done again."""
    manifest, rows = read_batch(spark, raw_root, dataset, run)
    result = Run(spark, out, dataset, manifest["ingestion_id"])
    if result.rounds():
        if not force:
            raise LayoutError(f"run {result.run_id} was validated before; force clears it")
    result.clear()
    missing, extra = missing_and_extra(rows.drop("row_no", "record_id"), list(registry.columns), registry.generated)
    if missing:
        raise ConfigError(f"the file lacks the columns {missing}")
    started = now_utc()
    v = E.validate(rows, registry, run_date)
    marker = "result-1"
    result.write(v.valid, "valid", marker=marker)
    quarantine = result.write(v.quarantine, "records", 1, marker)
    result.write(v.errors, "errors", 1, marker)
    result.write(v.audit, "audit", 1, marker)
    ledger = result.write(C.open_ledger(quarantine, now_utc()), "ledger", 1, marker)
    result.append(ledger.select("record_id", "status", "round", "attempts", F.col("updated_at").alias("changed_at"), F.lit(1).alias("seq")), "history", 1, marker)
    counts = E.run_counts(v).first().asDict()
    document = {
        "run_id": result.run_id, "dataset": dataset, "round": 1, "started_at": started, "finished_at": now_utc(), "counts": counts, "extra_columns": extra, "rules": _rows(E.rule_statistics(v)), "dimensions": _rows(E.dimension_statistics(v)),
        "missing": _rows(E.missing_by_column(v, rows)), "repairs": _rows(E.audit_counts(v)), "quarantine": _rows(E.quarantine_counts(v)), "auto_fixed_records": M.auto_fixed_records(v.audit, quarantine).first()[0],
    }
    result.save(marker, document)
    return document


def _ledger(run: Run) -> DataFrame:
    rounds = run.rounds()
    if not rounds:
        raise LayoutError(f"run {run.run_id} was not validated")
    return run.need("ledger", rounds[-1])


def run_template(run: Run, rules: list[str] | None = None, codes: list[str] | None = None) -> DataFrame:
    ledger = _ledger(run)
    number = C.current_round(ledger)
    if number is None:
        raise LayoutError(f"run {run.run_id} has no open record")
    open_ = ledger.filter((F.col("status") == C.OPEN) & (F.col("round") == number))
    return C.template(run.need("errors", number), open_, rules, codes).orderBy(F.when(F.col("severity") == "critical", 0).otherwise(1), "record_id", "column")


def run_import(run: Run, lines: DataFrame, registry: Registry, user: str, dry_run: bool = False) -> C.Import:
    ledger = _ledger(run)
    number = C.current_round(ledger)
    if number is None:
        raise LayoutError(f"run {run.run_id} has no open record")
    got = C.import_lines(lines, ledger, run.need("records", number), registry, user, now_utc())
    if not dry_run:
        batch = 1 + len(run.published("import"))
        marker = f"import-{batch}"
        run.append(got.accepted.select("*", F.lit(number).alias("round"), F.lit(batch).alias("batch")), "log", batch, marker)
        run.append(got.refused.withColumn("round", F.lit(number)), "rejections", batch, marker)
        run.save(marker, {"batch": batch, "round": number, "user": user, "imported_at": now_utc()})
    return got


def corrections_of(run: Run, number: int) -> DataFrame:
    """The lines of a round that count: of several for one field, the newest."""
    log = run.appended("log", "import")
    if log is None:
        return run.spark.createDataFrame([], "record_id string, column string, old_value string, new_value string, action string, reason string, user string, corrected_at string, seq long")
    lines = log.filter(F.col("round") == number)
    rest = [c for c in lines.columns if c not in ("record_id", "column", "action")]
    best = lines.groupBy("record_id", "column", "action").agg(F.max_by(F.struct(*rest), F.struct("batch", "seq")).alias("n"))
    return best.select("record_id", "column", "action", "n.*").drop("round", "batch")


def resolved_of(run: Run) -> DataFrame | None:
    """Resolved records of all rounds, with their round."""
    df = run.read("resolved")
    rounds = [run.load(f"result-{n}")["revalidated_round"] for n in run.rounds() if n > 1]
    return None if df is None or not rounds else df.filter(F.col("round").isin(rounds))


def run_revalidate(run: Run, registry: Registry, run_date: dt.date, max_attempts: int = C.MAX_ATTEMPTS, everything: bool = False) -> dict | None:
    ledger = _ledger(run)
    number = C.current_round(ledger)
    if number is None:
        raise LayoutError(f"run {run.run_id} has no open record")
    started, last = now_utc(), run.rounds()[-1]
    before = resolved_of(run)
    got = C.revalidate(run.need("records", number), run.need("errors", number), corrections_of(run, number), ledger, run.need("valid"), before, registry, run_date, now_utc(), max_attempts, everything)
    if got is None:
        return None
    next_, marker = last + 1, f"result-{last + 1}"
    run.write(got.resolved, "resolved", number, marker)
    run.write(got.records, "records", next_, marker)
    run.write(got.errors, "errors", next_, marker)
    run.write(got.audit, "audit", next_, marker)
    new = run.write(got.ledger, "ledger", next_, marker)
    run.append(C.changed_entries(ledger, new).withColumn("seq", F.lit(next_)), "history", next_, marker)
    routes = {r["route"]: r["count"] for r in got.routed.groupBy("route").count().collect()}
    document = {
        "run_id": run.run_id, "dataset": run.dataset, "round": next_, "revalidated_round": number, "started_at": started, "finished_at": now_utc(), "max_attempts": max_attempts,
        "counts": {
            "open_before": sum(routes.values()), "revalidated": sum(routes.get(k, 0) for k in ("resolved", "failed", "manual", "duplicate")), "resolved": routes.get("resolved", 0), "failed_again": routes.get("failed", 0),
            "manual_review_required": routes.get("manual", 0), "discarded": routes.get("discarded", 0), "removed_as_duplicate": routes.get("duplicate", 0), "carried_over_untouched": routes.get("carried", 0), "open_after": routes.get("failed", 0) + routes.get("carried", 0),
        },
        "status_totals": _rows(C.status_totals(new)), "rules": _rows(E.rule_statistics(got.validation)),
    }
    run.save(marker, document)
    return document


def run_merge(run: Run) -> dict:
    """Writes the clean table; returns the counts of its parts."""
    valid, resolved, ledger = run.need("valid"), resolved_of(run), _ledger(run)
    clean = merge(valid, resolved, ledger)
    version = 1 + len(run.published("merge"))
    clean = run.write(clean.orderBy("record_id"), "clean", version, f"merge-{version}")
    counts = check_merged(clean, valid, resolved)
    run.save(f"merge-{version}", counts)
    return counts


def clean_table(run: Run) -> DataFrame:
    versions = run.published("merge")
    if not versions:
        raise LayoutError(f"run {run.run_id} was not merged")
    return run.need("clean", versions[-1])


def run_metrics(spark: SparkSession, out: str, dataset: str) -> dict[str, DataFrame]:
    """The four tables over all runs of a dataset. Each is one plan, however many runs there are: documents and tables of all are read together."""
    if not list_runs(out, dataset):
        raise LayoutError(f"no run of {dataset} under {out}")
    results = all_documents(spark, out, dataset, "result", M.RESULT)
    imports = all_documents(spark, out, dataset, "import", "run_id string, batch int")
    rounds, batches = results.select("run_id", F.col("round").alias("at")), imports.select("run_id", F.col("batch").alias("at"))
    revalidated = results.select("run_id", F.col("revalidated_round").alias("at")).filter("at is not null")
    history = all_parts(spark, out, dataset, "history", "at", HISTORY, rounds).drop("at")
    log = all_parts(spark, out, dataset, "log", "at", LOG, batches).drop("at")
    resolved = all_parts(spark, out, dataset, "resolved", "round", "record_id string", revalidated).withColumnRenamed("at", "round")
    audit = all_parts(spark, out, dataset, "audit", "round", AUDIT, rounds).withColumnRenamed("at", "round")
    funnel = M.runs_funnel(results, resolved, log)
    wrong = funnel.filter("not balanced").select("run_id").first()
    if wrong:
        raise ConfigError(f"run {wrong[0]}: resolved, discarded and unresolved records do not add up to the quarantined ones")
    return {"dq_run": funnel, "dq_rule_result": M.runs_rules(results), "dq_quarantine": M.quarantine_history(history, by=("run_id",)), "dq_correction": M.runs_corrections(results, log, history, audit)}


def run_status(run: Run) -> list[dict]:
    return _rows(C.status_totals(_ledger(run)).orderBy("status", "round"))


def report(document: object) -> str:
    return json.dumps(document, indent=2, ensure_ascii=False, default=str)
