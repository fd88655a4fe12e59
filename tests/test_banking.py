import datetime as dt
import os

import pytest
from dqloom import workflow as W
from dqloom.plans.banking import rules, schema
from dqloom.plans.registry import load_registry
from dqloom.sources.land import LayoutError, Run, land, latest_run, read_manifest
from dqloom.sources.text_csv import read_text

from tests import banking

TODAY = dt.date(2025, 6, 1)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bank")
    source = banking.write(folder)
    manifest = land(spark, source, "bank", str(folder / "raw"), today=TODAY)
    registry = load_registry(schema(), rules(), folder)
    W.run_validate(spark, str(folder / "raw"), "bank", str(folder / "runs"), registry, TODAY)
    return Run(spark, str(folder / "runs"), "bank", manifest["ingestion_id"]), registry, folder, manifest


def record(manifest, n):
    return f"{manifest['record_id']['prefix']}{n:06d}"


def test_landing(spark, run):
    _, _, folder, manifest = run
    assert manifest["row_count"] == 50 and manifest["column_count"] == 49 and manifest["ingestion_id"] == "ING_20250601_001"
    assert latest_run(str(folder / "raw"), "bank") == "ING_20250601_001"
    raw = read_manifest(str(folder / "raw"), "bank")[1]
    assert not os.stat(raw).st_mode & 0o222
    assert raw.read_bytes() == (folder / "transactions.csv").read_bytes()
    with pytest.raises(LayoutError):
        W.run_validate(spark, str(folder / "raw"), "bank", str(folder / "runs"), run[1], TODAY)


def test_every_defect_has_its_outcome(run):
    r, _, _, manifest = run
    valid = {x.record_id: x for x in r.need("valid").collect()}
    held = {x.record_id: x for x in r.need("records", 1).collect()}
    audit = {(x.record_id, x.rule_id, x.outcome) for x in r.need("audit", 1).collect()}
    for n, (rule, outcome, _) in banking.DEFECTS.items():
        i = record(manifest, n)
        if outcome == "repaired":
            assert i in valid and (i, rule, "remediated") in audit, n
        elif outcome == "removed":
            assert i not in valid and i not in held and (i, rule, "removed") in audit
        elif outcome == "flagged":
            assert i in valid and rule in valid[i].dq_warnings.split(";"), (n, valid.get(i) or held.get(i))
        else:
            assert i in held and rule in held[i].dq_errors.split(";"), (n, held.get(i) and held[i].dq_errors)
    clean = [n for n in range(1, 51) if n not in banking.DEFECTS]
    touched = {x[0] for x in audit}
    for n in clean:
        assert record(manifest, n) in valid and valid[record(manifest, n)].dq_warnings == "" and record(manifest, n) not in touched, (n, valid.get(record(manifest, n)))
    counts = r.load("result-1")["counts"]
    assert (counts["rows_in"], counts["duplicates_removed"], counts["processed"], counts["accepted"], counts["quarantined"]) == (50, 1, 49, 38, 11)
    one = valid[record(manifest, 33)]
    assert one.phone_number is None and one.amount_egp == "250.75" and one.country_code == "EG" and one.digital_migration_opportunity == "0"


def test_profile(spark, run):
    _, _, folder, _ = run
    found = W.run_profile(spark, str(folder / "raw"), "bank", str(folder / "runs"), run_date=TODAY)
    by = {c["column_name"]: c for c in found["columns"]}
    assert found["row_count"] == 50 and found["duplicate_rows"] == 1
    assert by["transaction_id"]["logical_type"] == "identifier" and by["transaction_amount"]["logical_type"] == "float" and by["gender"]["logical_type"] == "categorical" and by["email"]["logical_type"] == "email" and by["phone_number"]["logical_type"] == "phone"
    assert "FUTURE_DATES" in by["transaction_date"]["observations"] and "WHITESPACE" in by["transaction_type"]["observations"] and "SPELLING_VARIANTS" in by["customer_segment"]["observations"]
    assert read_manifest(str(folder / "raw"), "bank")[0]["profile"]


def test_correction_round_merge_and_metrics(spark, run):
    r, registry, folder, manifest = run
    ids = {n: record(manifest, n) for n in (40, 41, 48, 49, 50)}
    template = W.run_template(r).collect()
    assert {x.record_id for x in template} == {x.record_id for x in r.need("records", 1).collect()}
    assert template[0].severity == "critical" and any(x.record_id == ids[50] and x.column == "" for x in template)
    kept = "TXN0000000048"
    lines = [(ids[41], "credit_score", "700", ""), (ids[40], "customer_id", "CUST999001", ""), (ids[48], "transaction_id", kept, ""), (ids[49], "transaction_id", "", "DISCARD"), (ids[50], "", "", "accept"), (ids[41], "amount_egp", "1", ""), ("nobody", "gender", "Male", ""), (ids[41], "gender", "", "")]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(lines)], "line_no long, record_id string, column string, new_value string, action string")
    got = W.run_import(r, df, registry, "tester")
    assert got.accepted.count() == 5 and sorted(x.refused for x in got.refused.collect()) == ["'amount_egp' is not an editable schema column", "record is not open in round 1"]
    result = W.run_revalidate(r, registry, TODAY)
    assert result["counts"] == {"open_before": 11, "revalidated": 4, "resolved": 4, "failed_again": 0, "manual_review_required": 0, "discarded": 1, "removed_as_duplicate": 0, "carried_over_untouched": 6, "open_after": 6}
    ledger = {x.record_id: x for x in r.need("ledger", 2).collect()}
    assert all(ledger[ids[n]].status == "RESOLVED" and ledger[ids[n]].round == 1 and ledger[ids[n]].attempts == 1 for n in (40, 41, 48, 50))
    assert ledger[ids[49]].status == "DISCARDED" and ledger[ids[49]].attempts == 0
    assert sum(x.status == "OPEN" and x.round == 2 for x in ledger.values()) == 6
    counts = W.run_merge(r)
    assert counts == {"valid": 38, "resolved": 4, "replaced": 0, "clean": 42}
    clean = {x.record_id: x for x in W.clean_table(r).collect()}
    assert clean[ids[41]].credit_score == "700" and ids[49] not in clean
    tables = W.run_metrics(spark, str(folder / "runs"), "bank")
    runs = sorted(tables["dq_run"].collect(), key=lambda x: x.round)
    assert [x.round for x in runs] == [1, 2] and all(x.balanced for x in runs)
    last = runs[-1]
    assert (last.resolved, last.manually_fixed, last.confirmed, last.auto_resolved, last.discarded, last.unresolved) == (4, 3, 1, 0, 1, 6)
    assert round(last.initial_score, 5) == 0.77551 and last.final_score == 0.857143
    manual = tables["dq_correction"].filter("correction_type = 'manual'").collect()
    assert {x.outcome for x in manual} == {"resolved", "discarded"} and len(manual) == 5
    history = tables["dq_quarantine"].filter(f"record_id = '{ids[41]}'").orderBy("sequence").collect()
    assert [(x.status, x.previous_status) for x in history] == [("OPEN", None), ("RESOLVED", "OPEN")]
    assert tables["dq_rule_result"].count() == 2 * 152
    assert {x["status"] for x in W.run_status(r)} == {"OPEN", "RESOLVED", "DISCARDED"}


def test_source_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿a,b\n"x\ny", z \n,"q""r"\n', encoding="utf-8")
    assert [tuple(r) for r in read_text(spark, str(tmp_path / "a.csv")).collect()] == [("x\ny", " z "), (None, 'q"r')]
    (tmp_path / "b.csv").write_bytes("a\né\n".encode("cp1252"))
    from dqloom.sources.text_csv import find_encoding, read_any_encoding

    assert find_encoding(str(tmp_path / "b.csv")) == "cp1252" and read_any_encoding(spark, str(tmp_path / "b.csv")).first()[0] == "é"
