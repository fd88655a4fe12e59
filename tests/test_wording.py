import datetime as dt

from dqloom.operators import wording as W
from dqloom.plans.registry import load_registry
from dqloom.sources.text_csv import each_file, numbered

SCHEMA = {
    "columns": {
        "customer_id": {"nullable": False, "pattern": r"C\d+"}, "age": {"type": "integer", "min": 18, "max": 99}, "fee": {"type": "decimal", "min": 0, "exclusive_min": True}, "born": {"type": "date", "max": "today"},
        "kind": {"allowed_values": ["a", "b"]}, "at": {"type": "time"}, "note": {},
    },
    "entities": {"customer": {"key": "customer_id", "attributes": ["age"]}},
}


def registry():
    rules = [{"id": "R", "type": "functional_dependency", "entity": "customer", "severity": "critical"}, {"id": "D", "type": "duplicate_rows", "severity": "critical"}, {"id": "V", "type": "auto_fix_review", "severity": "critical"}, {"id": "N", "type": "not_null", "column": "note", "name": "Notes are asked for", "severity": "critical"}]
    return load_registry(SCHEMA, {"rules": rules})


def test_sentences_and_titles(spark):
    r = registry()
    columns = {"R": "customer_id", "D": None, "V": None, "N": "note", "SCH-age-range": "age", "SCH-fee-type": "fee"}
    rows = [("1", i, r.rule(i).error_category, columns[i], v, "m") for i, v in (("R", "C1"), ("D", None), ("V", "4 values: x"), ("N", None), ("SCH-age-range", "7"), ("SCH-fee-type", "x"))] + [("2", "?", "business_rule", "age", None, "said so")]
    errors = spark.createDataFrame(rows, "record_id string, rule_id string, error_category string, column string, value string, message string")
    got = {x.rule_id: (x.problem, x.group) for x in W.with_groups(W.problem_text(errors, r, lambda rule: columns.get(rule.id, rule.column)), r).collect()}
    assert got == {
        "R": ('Other records with the same customer ID "C1" show different details', "Customer details differ between records"), "D": ("This record is an exact copy of another record", "Duplicate records"),
        "V": ("4 values were changed automatically; please check that the changes are right", "Many values changed automatically"), "N": ("Note is missing (Notes are asked for)", "Missing note"),
        "SCH-age-range": ('Age "7" must be between 18 and 99', "Age out of range"), "SCH-fee-type": ('Fee "x" is not a valid number', "Fee not a valid number"), "?": ("said so", "Other problems with age"),
    }
    assert [(x.group, x.records) for x in W.records_by_group(errors, r).collect()][-1][1] == 1
    assert [tuple(x) for x in W.missing_fields(errors).collect()] == [("1", ["note"], 1)]


def test_typed_values_are_judged_by_the_rules(spark):
    r, day = registry(), dt.date(2024, 5, 1)
    forms = W.entry_forms(r, day)
    assert [forms[c]["kind"] for c in SCHEMA["columns"]] == ["text", "number", "number", "date", "choice", "text", "text"] and [c for c in forms if forms[c]["required"]] == ["customer_id"]
    assert forms["fee"]["help"] == "Must be above 0." and forms["born"]["checks"]["range"]["max"].date() == day and forms["kind"]["checks"]["allowed_values"] == {"values": ["a", "b"]}
    whole, written = "Enter a whole number between 18 and 99.", "Customer ID is not written the expected way."
    cases = {
        ("customer_id", ""): "Customer ID cannot be empty.", ("customer_id", None): "Customer ID cannot be empty.", ("customer_id", "x"): written + " For example: C12", ("customer_id", "C7"): None,
        ("age", ""): None, ("age", "18"): None, ("age", "17"): whole, ("age", "20.5"): whole, ("age", "x"): whole, ("fee", "0"): "Enter a number above 0.", ("fee", "0.1"): None,
        ("kind", "c"): "Choose one of the listed values for kind.", ("kind", "a"): None, ("born", "2024-05-01"): None, ("born", "2024-05-02"): "Enter a date (YYYY-MM-DD) at most today.", ("born", "soon"): "Enter a date (YYYY-MM-DD) at most today.",
        ("at", "25:00:00"): "At is not written the expected way. For example: 14:30:00", ("at", "14:30:00"): None, ("note", "x"): None, ("none such", "x"): None,
    }
    entries = spark.createDataFrame([(*k, i) for i, k in enumerate(cases)], "column string, value string, more int")
    got = W.judge_entries(entries, r, day, {"customer_id": "C12"})
    assert got.columns == ["column", "value", "more", "mistake"] and {(x["column"], x.value): x.mistake for x in got.collect()} == cases
    assert W.judge_entries(entries.limit(0), r, day).count() == 0


def test_rows_are_numbered_in_order(spark):
    got = numbered(spark.range(0, 1000, 1, 7).selectExpr("cast(id as string) as v")).collect()
    assert sorted((r.row_no, int(r.v)) for r in got) == [(i + 1, i) for i in range(1000)]


def test_one_bad_file_does_not_stop_the_others(tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.csv").write_text(name)

    def work(path):
        if path.endswith("b.csv"):
            raise ValueError("broken")
        return path[-5]

    done, failed = each_file(str(tmp_path), work)
    assert sorted(done.values()) == ["a", "c"] and list(failed.values()) == ["ValueError: broken"]
