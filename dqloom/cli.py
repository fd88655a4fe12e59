"""Command line: python -m dqloom.cli STEP --dataset NAME ... Exit code 2 if the configuration or a run's folder is not usable."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from dqloom import workflow as W
from dqloom.plans.banking import rules as banking_rules
from dqloom.plans.banking import schema as banking_schema
from dqloom.plans.registry import ConfigError, Registry, load_registry
from dqloom.sources.land import LayoutError, Run, land, list_runs
from dqloom.sources.text_csv import export_file, read_text

STEPS = ("ingest", "profile", "validate", "export-template", "import-corrections", "revalidate", "merge", "metrics", "status", "pipeline")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dqloom", description=__doc__)
    p.add_argument("step", choices=STEPS)
    p.add_argument("--dataset", default="banking_transactions")
    p.add_argument("--input", help="source file (ingest, pipeline)")
    p.add_argument("--raw-root", default="data/raw")
    p.add_argument("--output-root", default="data/runs")
    p.add_argument("--run", help="run id; the latest if left out")
    p.add_argument("--schema", help="schema document; the banking one if left out")
    p.add_argument("--rules", help="rules document; the banking one if left out")
    p.add_argument("--config-root", default=".", help="folder that lookup paths start from")
    p.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--delimiter", default=",")
    p.add_argument("--force", action="store_true", help="validate again, clearing the run")
    p.add_argument("--rule", action="append", help="only lines of this rule (export-template)")
    p.add_argument("--error-code", action="append", help="only lines of this code (export-template)")
    p.add_argument("--output", help="file to write (export-template)")
    p.add_argument("--file", help="correction file (import-corrections)")
    p.add_argument("--user", default="", help="who corrected (import-corrections)")
    p.add_argument("--max-attempts", type=int, default=3)
    p.add_argument("--all", action="store_true", help="re-validate untouched records too")
    p.add_argument("--skip-relationships", action="store_true")
    p.add_argument("--null-tokens", nargs="*", help="words that stand for a missing value (profile); the usual ones if left out")
    p.add_argument("--dry-run", action="store_true", help="check a correction file without taking it over (import-corrections)")
    p.add_argument("--metrics-dir")
    return p


def registry_of(a: argparse.Namespace) -> Registry:
    return load_registry(a.schema or banking_schema(), a.rules or banking_rules(), a.config_root)


def run(argv: list[str], spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("dqloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return _step(spark, a)
    except (ConfigError, LayoutError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


def _step(spark: SparkSession, a: argparse.Namespace) -> int:
    def current() -> Run:
        known = list_runs(a.output_root, a.dataset)
        if not known:
            raise LayoutError(f"no run of {a.dataset} under {a.output_root}")
        return Run(spark, a.output_root, a.dataset, a.run or known[-1])

    def metrics() -> None:
        for name, df in W.run_metrics(spark, a.output_root, a.dataset).items():
            df.write.mode("overwrite").parquet(f"{a.metrics_dir or a.output_root + '/metrics'}/{name}")

    if a.step in ("ingest", "pipeline"):
        if not a.input:
            raise ConfigError("--input is missing")
        a.run = land(spark, a.input, a.dataset, a.raw_root, a.delimiter, today=a.run_date)["ingestion_id"]
        print(a.run)
    if a.step in ("profile", "pipeline"):
        W.run_profile(spark, a.raw_root, a.dataset, a.output_root, a.run, a.run_date, not a.skip_relationships, None if a.null_tokens is None else tuple(a.null_tokens))
    if a.step in ("validate", "pipeline"):
        print(W.report(W.run_validate(spark, a.raw_root, a.dataset, a.output_root, registry_of(a), a.run_date, a.run, a.force)["counts"]))
    if a.step == "export-template":
        print(export_file(W.run_template(current(), a.rule, a.error_code), a.output or "template.csv", for_spreadsheets=True))
    if a.step == "import-corrections":
        if not a.file:
            raise ConfigError("--file is missing")
        got = W.run_import(current(), read_text(spark, a.file), registry_of(a), a.user, a.dry_run)
        print(W.report({"accepted": got.accepted.count(), "refused": [r.asDict() for r in got.refused.limit(100).collect()]}))
    if a.step == "revalidate":
        print(W.report(W.run_revalidate(current(), registry_of(a), a.run_date, a.max_attempts, a.all)))
    if a.step in ("merge", "pipeline"):
        print(W.report(W.run_merge(current())))
    if a.step in ("metrics", "pipeline"):
        metrics()
    if a.step == "status":
        print(W.report(W.run_status(current())))
    return 0


if __name__ == "__main__":
    sys.exit(run(sys.argv[1:]))
