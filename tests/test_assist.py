from dqloom import cli
from dqloom.operators import profile as P
from dqloom.operators import suggest as S
from dqloom.plans.registry import load_registry


def test_suggestions_find_keys_first(spark):
    registry = load_registry({"columns": {"acc": {}, "cust": {}, "name": {}}, "entities": {"account": {"key": "acc", "references": {"customer": "cust"}}, "customer": {"key": "cust", "attributes": ["name"]}}}, {"rules": []})
    valid = spark.createDataFrame([("A1", "C1", "Mona"), ("A1", "C1", "Mona"), ("A2", "C2", "Ali"), ("A3", "C2", "Aly"), ("A3", "C2", "Ali")], "acc string, cust string, name string")
    records = spark.createDataFrame([("r1", "A1", None, None), ("r2", None, "C2", None), ("r3", "A9", None, None)], "record_id string, acc string, cust string, name string")
    needs = spark.createDataFrame([("r1", "cust"), ("r1", "name"), ("r2", "name"), ("r3", "cust")], "record_id string, column string")
    found = S.suggest(records, needs, valid, registry)
    assert sorted((r.record_id, r.column, r.value, r.source_column, r.support, r.total) for r in found.collect()) == [("r1", "cust", "C1", "acc", 2, 2), ("r1", "name", "Mona", "cust", 2, 2), ("r2", "name", "Ali", "cust", 2, 3)]
    blocking = needs.unionByName(spark.createDataFrame([("r2", "acc")], "record_id string, column string"))
    assert [r.record_id for r in S.complete_by_suggestion(needs, found, blocking).collect()] == ["r1"]
    assert sorted((r.column, r.example) for r in S.examples(valid.selectExpr("*", "monotonically_increasing_id() as n"), ["acc", "name"], "n").collect()) == [("acc", "A1"), ("name", "Mona")]


def test_review_only_and_lines(spark):
    errors = spark.createDataFrame([("a", "critical", "auto_fix_review"), ("a", "warning", "null"), ("b", "critical", "auto_fix_review"), ("b", "critical", "null")], "record_id string, severity string, error_category string")
    assert [r.record_id for r in S.only_review(errors).collect()] == ["a"]
    lines = S.lines_from_changes({"x": {"discard": True, "values": {"c": "1"}}, "y": {"accept": True, "values": {"c": "", "d": "2"}, "reason": "why"}})
    assert [(x["record_id"], x["action"], x["column"], x["new_value"]) for x in lines] == [("x", "DISCARD", "", ""), ("y", "ACCEPT", "", ""), ("y", "FIX", "c", "__NULL__"), ("y", "FIX", "d", "2")]


def test_types_by_values_and_names(spark):
    columns = {
        "customer_id": ["1", "2"], "mobile": ["x", "y"], "currency": ["EGP", "usd"], "is_ok": ["1", "1"], "n": ["1", "0"], "amount": ["1.5", "2"], "count": ["1", "20"], "open_time": ["10:00", "x"], "day": ["2024-01-01", "2024-02-03"],
        "birth_date": ["2024-01-01", "soon"], "contact": ["a@b.co", "c@d.co"], "kind": ["a", "b"], "gone": [None, "N/A"],
    }
    df = spark.createDataFrame([tuple(v[i] for v in columns.values()) for i in range(2)], ", ".join(f"{c} string" for c in columns))
    rates = {r["column"]: r.asDict() for r in P.type_rates(P.value_counts(df)).collect()}
    got = {c: P.infer_type(c, rates.get(c)) for c in columns}
    assert got == {"customer_id": "identifier", "mobile": "phone", "currency": "currency_code", "is_ok": "boolean", "n": "boolean", "amount": "float", "count": "integer", "open_time": "time", "day": "date", "birth_date": "date", "contact": "email", "kind": "categorical", "gone": "empty"}
    assert P.name_words("accountID_noX2") == ["account", "id", "no", "x", "2"]


def test_exit_codes(spark, tmp_path, capsys):
    assert cli.run(["status", "--output-root", str(tmp_path), "--dataset", "x"], spark) == 2
    assert cli.run(["ingest", "--dataset", "x", "--raw-root", str(tmp_path)], spark) == 2
    assert cli.run(["validate", "--dataset", "x", "--raw-root", str(tmp_path), "--schema", str(tmp_path / "no.json"), "--rules", "x.json"], spark) == 2
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2,\n")
    (tmp_path / "s.json").write_text('{"columns": {"a": {"type": "integer"}, "b": {"nullable": false}}}')
    (tmp_path / "r.json").write_text('{"rules": []}')
    common = ["--dataset", "x", "--raw-root", str(tmp_path / "raw"), "--output-root", str(tmp_path / "out"), "--schema", str(tmp_path / "s.json"), "--rules", str(tmp_path / "r.json")]
    assert cli.run(["pipeline", "--input", str(tmp_path / "a.csv"), *common], spark) == 0
    assert cli.run(["status", *common], spark) == 0
    assert '"OPEN"' in capsys.readouterr().out
    assert cli.run(["export-template", "--output", str(tmp_path / "t.csv"), *common], spark) == 0
    assert "b is missing" in (tmp_path / "t.csv").read_text("utf-8-sig")


def test_groups_of_copies_answer_for_all_rows_without_pairs(spark):
    rows = [("a", "x"), ("b", "x"), ("c", "x"), ("d", "y"), ("e", None), ("f", None)]
    got = S.copy_groups(spark.createDataFrame(rows, "record_id string, g string"), "g").collect()
    assert sorted(((r.record_id, r.value, r.group_size, r.representative) for r in got)) == [("a", "x", 3, "b"), ("b", "x", 3, "a"), ("c", "x", 3, "a"), ("d", "y", 1, None), ("e", None, 1, None), ("f", None, 1, None)]
    hot = spark.range(20_000).selectExpr("cast(id as string) as record_id", "if(id % 3 = 0, 'hot', cast(id as string)) as g")
    out = S.copy_groups(hot, "g")
    assert out.count() == 20_000 and out.filter("group_size = 6667 and representative is not null").count() == 6667


def test_relationships_compare_canonical_values(spark):
    rows = []
    for i in range(60):
        for j in range(4):
            sex, day = ("Male", " male_", "MALE", "male")[j] if i % 2 else ("Female", "female ", "FEMALE", "female")[j], 13 + i % 15
            amount, at = ("7", "7.0", "07", "7.00")[j] if i % 3 else ("1", "1.0", "01", "1.00")[j], ("19:20:00", "07:20:00 PM", "19:20", "19.20.00")[j] if i % 2 else "08:00:00"
            rows.append((f"C{i}", sex, amount, f"02/{day}/2023" if j % 2 else f"2023-02-{day}", at, f"T{i * 4 + j if (i, j) != (59, 3) else 0}"))
    df = spark.createDataFrame(rows, "customer_id string, gender string, amount string, day string, open_time string, trip_id string")
    found = P.profile(df)
    entities = {(r["key"], r["column"]): r["conflicting_rows"] for r in found["entities"]}
    assert {c: n for (k, c), n in entities.items() if k == "customer_id"} == {"gender": 0, "amount": 0, "day": 0, "open_time": 0}
    assert not any(k == "trip_id" for k, _ in entities) and "ENTITY_CONFLICTS" not in found["observations"] and "DUPLICATE_KEYS" in found["observations"]
    (keys,) = found["duplicate_keys"]
    assert (keys["key"], keys["repeated_key_count"], keys["row_count"]) == ("trip_id", 1, 2)
    assert keys["differing_columns"] == dict.fromkeys(["customer_id", "gender", "amount", "day", "open_time"], 1)


def test_month_first_dates_give_the_right_range(spark):
    df = spark.createDataFrame([("03/04/2024",), ("01/25/2024",), ("02/11/2024",)], "day string")
    (column,) = P.profile(df)["columns"]
    assert column["dates"] == {"min": "2024-01-25", "max": "2024-03-04"}
