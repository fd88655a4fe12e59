"""Landing and runs on a file system given by its URI, and steps that are repeated after they broke off."""

import datetime as dt

import pytest

from dqloom import workflow as W
from dqloom.plans.registry import load_registry
from dqloom.sources.files import Place
from dqloom.sources.land import LayoutError, Run, land, latest_run, read_manifest

TODAY = dt.date(2025, 6, 1)


@pytest.fixture
def landed(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('id,kind\n1,good\n2,"b\nad"\n3,good\n4,\n', encoding="utf-8")
    root = f"file:{tmp_path}"
    manifest = land(spark, f"file:{source}", "t", f"{root}/raw", today=TODAY, digest="lines")
    registry = load_registry({"columns": {"id": {}, "kind": {}}}, {"schema_checks": {"columns": {c: {"type": {"enabled": False}} for c in ("id", "kind")}}, "rules": [{"id": "KIND", "type": "allowed_values", "column": "kind", "values": ["good"], "severity": "critical", "dimension": "validity"}, {"id": "HAVE", "type": "not_null", "column": "kind", "severity": "critical", "dimension": "completeness"}]})
    return root, manifest, registry


class Broken(Exception):
    pass


@pytest.fixture
def break_after(monkeypatch):
    """The n-th table or document that a step writes is its last."""
    real = {name: getattr(Run, name) for name in ("write", "append", "save")}
    left = [10**9]

    def broken(name):
        def call(self, *a, **b):
            if not left[0]:
                raise Broken
            left[0] -= 1
            return real[name](self, *a, **b)

        return call

    for name in real:
        monkeypatch.setattr(Run, name, broken(name))
    return left


def test_every_step_can_be_repeated_after_it_broke_off(spark, landed, break_after):
    root, manifest, registry = landed
    run = Run(spark, f"{root}/runs", "t", manifest["ingestion_id"])

    def until_done(step, writes):
        """Breaks off before each write in turn, then lets the step finish."""
        for n in range(writes):
            break_after[0] = n
            with pytest.raises(Broken):
                step()
        break_after[0] = writes
        out = step()
        assert break_after[0] == 0
        break_after[0] = 10**9
        return out

    def validate(force=False):
        return W.run_validate(spark, f"{root}/raw", "t", f"{root}/runs", registry, TODAY, force=force)

    until_done(validate, 7)
    assert run.load("result-1")["counts"]["quarantined"] == 2 and run.appended("history", "result").count() == 2
    with pytest.raises(LayoutError):
        validate()
    held = {r.id: r.record_id for r in run.need("records", 1).collect()}
    lines = spark.createDataFrame([(1, held["2"], "kind", "good", "")], "line_no long, record_id string, column string, new_value string, action string")
    until_done(lambda: W.run_import(run, lines, registry, "me"), 3)
    assert run.appended("log", "import").count() == 1
    until_done(lambda: W.run_revalidate(run, registry, TODAY), 7)
    assert run.load("result-2")["counts"]["resolved"] == 1 and W.resolved_of(run).count() == 1 and run.appended("history", "result").count() == 4
    assert until_done(lambda: W.run_merge(run), 2) == {"valid": 2, "resolved": 1, "replaced": 0, "clean": 3}
    assert W.clean_table(run).count() == 3
    break_after[0] = 3
    with pytest.raises(Broken):
        validate(force=True)
    break_after[0] = 10**9
    assert run.rounds() == [] and validate()["counts"]["quarantined"] == 2 and run.rounds() == [1]
    assert run.appended("log", "import") is None and W.resolved_of(run) is None


def test_landing_by_uri(spark, landed):
    root, manifest, _ = landed
    assert manifest["row_count"] == 4 and manifest["columns"] == ["id", "kind"] and manifest["digest"] == "lines"
    (Place(f"{root}/raw") / "t" / ".claims" / "ING_20250601_002").claim()  # someone else is landing
    third = land(spark, f"{root}/in.csv", "t", f"{root}/raw", today=TODAY)
    assert third["ingestion_id"] == "ING_20250601_003" == latest_run(f"{root}/raw", "t") and third["sha256"] != manifest["sha256"]
    assert [r.kind or "" for r in spark.read.parquet(f"{root}/raw/t/ING_20250601_003/rows").orderBy("row_no").collect()] == ["good", "b\nad", "good", ""]
    raw = read_manifest(f"{root}/raw", "t", manifest["ingestion_id"])[1]
    raw.delete()
    raw.write_text("id,kind\n1,good\n2,bad\n")
    with pytest.raises(LayoutError):
        read_manifest(f"{root}/raw", "t", manifest["ingestion_id"])
    assert [n for n in Place(f"{root}/raw/t").names() if n.startswith(".landing")] == []
    with pytest.raises(LayoutError):
        land(spark, f"{root}/none.csv", "t", f"{root}/raw")
