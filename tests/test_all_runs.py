"""Documents and tables of all runs are read together; what no document publishes is left out."""

import pytest

from dqloom import workflow as W
from dqloom.sources.land import LayoutError, Run, all_documents, all_parts


def test_metrics_over_runs_with_different_rounds(spark, tmp_path):
    root, rule = str(tmp_path), {"rule_id": "Q", "type": "not_null", "dimension": "validity", "severity": "critical", "checked": 5, "detected": 2, "remediated": 0, "unresolved": 2}
    with pytest.raises(LayoutError):
        W.run_metrics(spark, root, "d")
    for name in ("A", "B", "C"):
        run = Run(spark, root, "d", name)
        run.write(spark.createDataFrame([("r1", "x", " v", "v", "TRIM", "trim", "remediated")], W.AUDIT), "audit", 1, "result-1")
        run.append(spark.createDataFrame([("r1", "OPEN", 1, 0, "t", 1), ("r2", "OPEN", 1, 0, "t", 1)], W.HISTORY), "history", 1, "result-1")
        if name == "C":  # it broke off
            continue
        run.save("result-1", {"run_id": name, "round": 1, "counts": {"processed": 5, "accepted": 3, "quarantined": 2, "acceptance_rate": 0.6}, "rules": [rule], "other": [1]})
    run = Run(spark, root, "d", "B")
    lines = [("r1", "x", "v", "w", "FIX", "", "me", "t", 1, 1, 1), ("r1", "x", "v", "u", "FIX", "", "me", "t", 2, 1, 1)]
    run.append(spark.createDataFrame(lines, W.LOG), "log", 1, "import-1")
    run.save("import-1", {"batch": 1, "round": 1})
    run.append(spark.createDataFrame(lines, W.LOG), "log", 2, "import-2")  # never published
    run.write(spark.createDataFrame([("r1", "w")], "record_id string, x string"), "resolved", 1, "result-2")
    run.write(spark.createDataFrame([], W.AUDIT), "audit", 2, "result-2")
    run.append(spark.createDataFrame([("r1", "RESOLVED", 1, 1, "t", 2)], W.HISTORY), "history", 2, "result-2")
    run.save("result-2", {"run_id": "B", "round": 2, "revalidated_round": 1, "counts": {"resolved": 1, "discarded": 0, "removed_as_duplicate": 0, "manual_review_required": 0, "open_after": 1}, "rules": [rule]})
    got = W.run_metrics(spark, root, "d")
    funnel = {(r.run_id, r["round"]): (r.resolved, r.manually_fixed, r.confirmed, r.open, r.initial_score, r.final_score) for r in got["dq_run"].collect()}
    assert funnel == {("A", 1): (0, 0, 0, 2, 0.6, 0.6), ("B", 1): (0, 0, 0, 2, 0.6, 0.6), ("B", 2): (1, 1, 0, 1, 0.6, 0.8)}
    assert sorted((r.run_id, r["round"], r.round_type) for r in got["dq_rule_result"].collect()) == [("A", 1, "validation"), ("B", 1, "validation"), ("B", 2, "revalidation")]
    assert sorted((r.run_id, r.record_id, r.sequence, r.previous_status) for r in got["dq_quarantine"].collect() if r.record_id == "r1") == [("A", "r1", 1, None), ("B", "r1", 1, None), ("B", "r1", 2, "OPEN")]
    assert sorted((r.run_id, r.correction_type, r.new_value, r.outcome) for r in got["dq_correction"].collect()) == [("A", "automatic", "v", "remediated"), ("B", "automatic", "v", "remediated"), ("B", "manual", "u", "resolved"), ("B", "manual", "w", "superseded")]
    assert all_documents(spark, root, "d", "none", "run_id string").count() == all_parts(spark, root, "d", "none", "at", "x string", spark.createDataFrame([], "run_id string, at int")).count() == 0
