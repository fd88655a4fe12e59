"""Filters on what the layers made stay above them."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import dqloom.queries as Q
from dqloom.operators import engine as E
from dqloom.plans.registry import load_registry

SCHEMA = {"columns": {"seg": {}, "name": {}}, "dataset": {"null_tokens": ["-"]}}
RULES = {
    "preprocessing": [{"id": "T", "type": "trim_whitespace", "columns": "all", "severity": "info", "remediation": {"action": "trim"}}, {"id": "N", "type": "null_tokens", "columns": "all", "severity": "info", "remediation": {"action": "set_null"}}],
    "rules": [
        {"id": "SEG", "type": "allowed_values", "column": "seg", "values": ["A", "B"], "severity": "critical", "remediation": {"action": "canonicalize"}},
        {"id": "REV", "type": "auto_fix_review", "severity": "warning", "min_changes": 2},
    ],
}
ROWS = [("R1", 1, " a ", "x"), ("R2", 2, "A", " - "), ("R3", 3, "C", "x"), ("R4", 4, None, "x")]


def size(df) -> int:
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_a_filter_does_not_repeat_the_layers(spark):
    v = E.validate_rows(spark.createDataFrame(ROWS, "record_id string, row_no long, seg string, name string").repartition(2), load_registry(SCHEMA, RULES), dt.date(2024, 1, 1))
    whole = size(v.rows)
    for df in (v.valid, v.quarantine, v.errors, v.audit, v.rows.filter(F.size("edits") > 1), v.rows.filter("seg = 'A'")):
        assert size(df) < 1.5 * whole
    assert v.rows.columns == ["record_id", "row_no", "focus", "active", "raw_key", "seg", "name", "fails", "edits", "scopes", "status", "dq_errors", "dq_warnings"]
    assert sorted(tuple(r) for r in v.valid.collect()) == [("R1", "A", "x", "REV"), ("R2", "A", None, "REV"), ("R4", None, "x", "")]
    assert sorted(tuple(r) for r in v.quarantine.collect()) == [("R3", "C", "x", "SEG", "")]
    assert sorted(r.record_id for r in v.rows.filter("seg = 'A'").collect()) == ["R1", "R2"]


def test_the_review_of_many_edits_has_a_small_plan(spark, tmp_path):
    spark.createDataFrame([(1, "Customer#1", "BUILDING")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    assert size(Q.queries()["auto_fix_review"](spark, str(tmp_path))) < 50_000


def test_a_round_reads_the_first_validation_as_a_table(spark, tmp_path, monkeypatch):
    names = "c_custkey long, c_name string, c_mktsegment string"
    spark.createDataFrame([(k, f"Customer#{k:09}", "BUILDING") for k in range(40)], names).write.parquet(f"{tmp_path}/customer.parquet")
    given, revalidate = [], Q.C.revalidate

    def seen(*args):
        given.extend(a for a in args if isinstance(a, DataFrame))
        return revalidate(*args)

    monkeypatch.setattr(Q.C, "revalidate", seen)
    rows = sorted(tuple(r) for r in Q.queries()["revalidate_routing"](spark, str(tmp_path)).collect())
    assert rows == [("R13", "RESOLVED", 2, 2), ("R23", "OPEN", 3, 2), ("R3", "OPEN", 3, 0), ("R33", "RESOLVED", 2, 1)]
    assert len(given) == 5
    for df in given:
        assert df.inputFiles() and not [f for f in df.inputFiles() if "customer.parquet" in f]
