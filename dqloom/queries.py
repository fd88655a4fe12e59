"""The registered queries of the data-quality engine, each with the SQL that gives the same rows.

The tables hold clean data, so each query first spoils a column by a rule on its key, the same in both.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.operators import corrections as C
from dqloom.operators import dates as D
from dqloom.operators import engine as E
from dqloom.operators import merge as G
from dqloom.operators import metrics as M
from dqloom.operators import findings as FI
from dqloom.operators import profile as P
from dqloom.operators import relations as R
from dqloom.operators import suggest as S
from dqloom.operators import wording as W
from dqloom.plans.registry import Registry, load_registry
from dqloom.sources.text_csv import numbered, with_record_ids

RUN_DATE = dt.date(1998, 8, 2)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str) -> Callable:
    def add(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(df: DataFrame, key: str, **columns: str) -> DataFrame:
    """record_id, row_no and text columns by SQL expressions."""
    return df.selectExpr(f"concat('R', cast({key} as string)) as record_id", f"cast({key} as bigint) as row_no", *[f"{e} as {c}" for c, e in columns.items()])


def _registry(columns: dict, *rules: dict, tokens: tuple = (), entities: dict | None = None, dependencies: dict | None = None, pre: tuple = ()) -> Registry:
    full = [{"severity": "critical", "dimension": "validity", **r} for r in rules]
    return load_registry({"columns": columns, "dataset": {"null_tokens": list(tokens)}, "entities": entities or {}, "dependencies": dependencies or {}}, {"preprocessing": [{"severity": "info", "dimension": "validity", **p} for p in pre], "schema_checks": {"columns": {c: {"type": {"enabled": False}} for c in columns}}, "rules": full})


def _checked(df: DataFrame, registry: Registry) -> E.Validation:
    return E.validate_rows(df, registry, RUN_DATE)


TRIM = {"id": "TRIM", "type": "trim_whitespace", "columns": "all", "remediation": {"action": "trim"}}
TOKENS = {"id": "TOKEN", "type": "null_tokens", "columns": "all", "remediation": {"action": "set_null"}}

# Customers with spoiled segments: padded, other case or separators, placeholders, unknown ones.
_SEGMENT = """case c_custkey % 10 when 0 then concat('  ', c_mktsegment, ' ') when 1 then lower(c_mktsegment) when 2 then 'N/A' when 3 then concat(substring(c_mktsegment, 1, 3), 'X') when 4 then concat(' ', lower(c_mktsegment), ' ') else c_mktsegment end"""
_SEGMENT_RULE = {"id": "SEG", "type": "allowed_values", "column": "seg", "values": SEGMENTS, "remediation": {"action": "canonicalize"}}
_NAME_RULE = {"id": "NAME", "type": "pattern", "column": "name", "pattern": r"Customer#\d{9}", "severity": "warning"}
_NAME = "case when c_custkey % 7 = 0 then replace(c_name, '#', '-') when c_custkey % 11 = 0 then concat(c_name, ' ') else c_name end"
_SEGMENT_SQL = f"""
raw AS (SELECT 'R' || c_custkey AS record_id, c_custkey AS k, {_SEGMENT} AS seg0, {_NAME} AS name0 FROM customer),
cut AS (SELECT *, trim(seg0) AS seg1, trim(name0) AS name1 FROM raw),
tok AS (SELECT *, CASE WHEN lower(seg1) = 'n/a' THEN NULL ELSE seg1 END AS seg2 FROM cut),
fin AS (SELECT *, CASE WHEN upper(seg2) IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY') THEN upper(seg2) ELSE seg2 END AS seg3 FROM tok),
res AS (SELECT *, coalesce(seg3 NOT IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'), false) AS bad, seg3 IS NULL AS gone, NOT regexp_full_match(name1, 'Customer#[0-9]{{9}}') AS badname FROM fin)
"""


def _segments(spark: SparkSession, sf_dir: str, write: bool = False) -> E.Validation:
    """write: the validated rows as a table, for a query that reads them many times; a table that lies in one row group is dealt over all tasks first."""
    df = _rows(_t(spark, sf_dir, "customer"), "c_custkey", seg=_SEGMENT, name=_NAME)
    registry = _registry({"seg": {}, "name": {}}, _SEGMENT_RULE, {"id": "HAVE", "type": "not_null", "column": "seg", "severity": "warning", "dimension": "completeness"}, _NAME_RULE, tokens=("n/a",), pre=(TRIM, TOKENS))
    return E.validate(df.repartition("row_no"), registry, RUN_DATE) if write else _checked(df, registry)


@_query(f"WITH {_SEGMENT_SQL} SELECT CASE WHEN bad THEN 'quarantined' ELSE 'accepted' END AS status, NOT bad AND (gone OR badname) AS flagged, count(*) AS n FROM res GROUP BY ALL")
def segment_validation(spark, sf_dir):
    v = _segments(spark, sf_dir)
    return v.rows.groupBy("status", ((F.col("status") == "accepted") & (F.col("dq_warnings") != "")).alias("flagged")).agg(F.count("*").alias("n"))


@_query(f"""WITH {_SEGMENT_SQL} SELECT record_id, 'seg' AS "column", seg0 AS original_value, seg1 AS cleaned_value, 'TRIM' AS rule_id, 'trim' AS action, 'remediated' AS outcome FROM res WHERE seg0 <> seg1
UNION ALL SELECT record_id, 'name', name0, name1, 'TRIM', 'trim', 'remediated' FROM res WHERE name0 <> name1
UNION ALL SELECT record_id, 'seg', seg1, NULL, 'TOKEN', 'set_null', 'remediated' FROM res WHERE seg2 IS NULL
UNION ALL SELECT record_id, 'seg', seg2, seg3, 'SEG', 'canonicalize', CASE WHEN bad THEN 'not_fixed' ELSE 'remediated' END FROM res WHERE seg2 IS NOT NULL AND seg2 NOT IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY')""")
def repair_audit(spark, sf_dir):
    return _segments(spark, sf_dir).audit


@_query(f"WITH {_SEGMENT_SQL} SELECT record_id, seg3 AS seg, name1 AS name, concat_ws(';', CASE WHEN gone THEN 'HAVE' END, CASE WHEN badname THEN 'NAME' END) AS dq_warnings FROM res WHERE NOT bad")
def split_valid(spark, sf_dir):
    return _segments(spark, sf_dir).valid


@_query(f"WITH {_SEGMENT_SQL} SELECT record_id, seg3 AS seg, name1 AS name, 'SEG' AS dq_errors, CASE WHEN badname THEN 'NAME' ELSE '' END AS dq_warnings FROM res WHERE bad")
def split_quarantine(spark, sf_dir):
    return _segments(spark, sf_dir).quarantine


@_query(f"""WITH {_SEGMENT_SQL} SELECT record_id, 'SEG' AS rule_id, 'SEG' AS rule_name, 'DQ-DOM' AS error_code, 'domain_violation' AS error_category, 'validity' AS dimension, 'critical' AS severity, 'seg' AS "column", seg3 AS value, 'seg ''' || seg3 || ''' is not an allowed value' AS message FROM res WHERE bad
UNION ALL SELECT record_id, 'HAVE', 'HAVE', 'DQ-NULL', 'null', 'completeness', 'warning', 'seg', NULL, 'seg is missing' FROM res WHERE gone
UNION ALL SELECT record_id, 'NAME', 'NAME', 'DQ-FMT', 'format_violation', 'validity', 'warning', 'name', name1, 'name ''' || name1 || ''' does not match the required format' FROM res WHERE badname""")
def error_lines(spark, sf_dir):
    return _segments(spark, sf_dir).errors


_STATS = f"""WITH {_SEGMENT_SQL}, st AS (
SELECT 'TRIM' AS rule_id, 'validity' AS dimension, (SELECT count(*) FROM res WHERE seg0 <> seg1) + (SELECT count(*) FROM res WHERE name0 <> name1) AS remediated, 0 AS unresolved
UNION ALL SELECT 'TOKEN', 'validity', (SELECT count(*) FROM res WHERE seg2 IS NULL), 0
UNION ALL SELECT 'SEG', 'validity', (SELECT count(*) FROM res WHERE seg2 <> seg3), (SELECT count(*) FROM res WHERE bad)
UNION ALL SELECT 'HAVE', 'completeness', 0, (SELECT count(*) FROM res WHERE gone)
UNION ALL SELECT 'NAME', 'validity', 0, (SELECT count(*) FROM res WHERE badname))
"""


@_query(_STATS + "SELECT rule_id, remediated + unresolved AS detected, remediated, unresolved FROM st")
def rule_stats(spark, sf_dir):
    return E.rule_statistics(_segments(spark, sf_dir)).select("rule_id", "detected", "remediated", "unresolved")


@_query(_STATS + "SELECT dimension, count(*) AS rules, sum(remediated + unresolved)::BIGINT AS detected, sum(remediated)::BIGINT AS remediated, sum(unresolved)::BIGINT AS unresolved FROM st GROUP BY 1")
def dimension_rollup(spark, sf_dir):
    return E.dimension_statistics(_segments(spark, sf_dir))


@_query(f"WITH {_SEGMENT_SQL} SELECT count(*) AS rows_in, 0::BIGINT AS duplicates_removed, sum((NOT bad)::INT)::BIGINT AS accepted, sum(bad::INT)::BIGINT AS quarantined, sum((NOT bad AND (gone OR badname))::INT)::BIGINT AS flagged, count(*) AS processed, round(100.0 * sum((NOT bad)::INT) / count(*), 4)::DOUBLE AS accepted_rate, round(100.0 * sum(bad::INT) / count(*), 4)::DOUBLE AS quarantined_rate FROM res")
def run_counts(spark, sf_dir):
    return E.run_counts(_segments(spark, sf_dir))


@_query(f"""WITH {_SEGMENT_SQL}, a AS (SELECT 'trim' AS action, 'remediated' AS outcome FROM res WHERE seg0 <> seg1 UNION ALL SELECT 'trim', 'remediated' FROM res WHERE name0 <> name1 UNION ALL SELECT 'set_null', 'remediated' FROM res WHERE seg2 IS NULL UNION ALL SELECT 'canonicalize', CASE WHEN bad THEN 'not_fixed' ELSE 'remediated' END FROM res WHERE seg2 NOT IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY')) SELECT action, outcome, count(*) AS count FROM a GROUP BY ALL""")
def audit_counts(spark, sf_dir):
    return E.audit_counts(_segments(spark, sf_dir))


@_query(f"WITH {_SEGMENT_SQL} SELECT 'domain_violation' AS error_category, 'DQ-DOM' AS error_code, count(*) AS count FROM res WHERE bad UNION ALL SELECT 'format_violation', 'DQ-FMT', count(*) FROM res WHERE bad AND badname HAVING count(*) > 0")
def quarantine_error_counts(spark, sf_dir):
    return E.quarantine_counts(_segments(spark, sf_dir))


@_query(f"""WITH {_SEGMENT_SQL} SELECT record_id, "column", current_value, error_codes, severity, messages, rule_ids FROM (
SELECT record_id, 'seg' AS "column", seg3 AS current_value, 'DQ-DOM' AS error_codes, 'critical' AS severity, 'seg ''' || seg3 || ''' is not an allowed value' AS messages, 'SEG' AS rule_ids FROM res WHERE bad
UNION ALL SELECT record_id, 'name', name1, 'DQ-FMT', 'warning', 'name ''' || name1 || ''' does not match the required format', 'NAME' FROM res WHERE bad AND badname)""")
def template_lines(spark, sf_dir):
    v = _segments(spark, sf_dir)
    return C.template(v.errors, v.quarantine).select("record_id", "column", "current_value", "error_codes", "severity", "messages", "rule_ids")


# Reading and repairing values

_PRICE = "cast(cast(o_totalprice as decimal(15,2)) as varchar(30))"
_DIRTY_PRICE = f"case o_orderkey % 5 when 0 then concat('EGP ', {_PRICE}, ' only') when 1 then replace({_PRICE}, '.', ',') when 2 then 'abc' when 3 then concat(substring({_PRICE}, 1, 2), ',', substring({_PRICE}, 3, 30)) else {_PRICE} end"


def _values(v: E.Validation, column: str) -> DataFrame:
    return v.rows.select("record_id", F.col(column).alias("value"), (F.size("fails") > 0).alias("failed"))


@_query(f"""WITH r AS (SELECT 'R' || o_orderkey AS record_id, o_orderkey AS k, {_PRICE} AS p, {_DIRTY_PRICE} AS v FROM orders),
n AS (SELECT *, CASE k % 5 WHEN 2 THEN NULL WHEN 3 THEN substring(p, 1, 2) || substring(p, 3, 30) ELSE p END AS x FROM r)
SELECT record_id, CASE WHEN k % 5 = 2 THEN v WHEN k % 5 = 4 THEN v ELSE regexp_replace(regexp_replace(x, '0+$', ''), '\\.$', '') END AS value, k % 5 = 2 AS failed FROM n""")
def type_decimal_repair(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", price=_DIRTY_PRICE)
    return _values(_checked(df, _registry({"price": {"type": "decimal"}}, {"id": "T", "type": "type", "column": "price", "remediation": {"action": "parse_number"}})), "price")


@_query("SELECT 'R' || p_partkey AS record_id, p_size || CASE p_partkey % 3 WHEN 0 THEN '.0' WHEN 1 THEN '.5' ELSE '' END AS value, p_partkey % 3 = 1 AS failed FROM part")
def type_integer(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "part"), "p_partkey", size="concat(cast(p_size as string), case p_partkey % 3 when 0 then '.0' when 1 then '.5' else '' end)")
    return _values(_checked(df, _registry({"size": {"type": "integer"}}, {"id": "T", "type": "type", "column": "size"})), "size")


@_query("SELECT CASE doc_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN NULL ELSE toxic::VARCHAR END AS value, coalesce(doc_id % 4 = 0, false) AS failed, count(*) AS n FROM labels GROUP BY ALL")
def type_boolean(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "labels"), "doc_id", flag="case doc_id % 4 when 0 then 'yes' when 1 then null else cast(toxic as string) end")
    v = _checked(df, _registry({"flag": {"type": "boolean", "true_values": ["1"], "false_values": ["0"]}}, {"id": "T", "type": "type", "column": "flag"}))
    return _values(v, "flag").groupBy("value", "failed").agg(F.count("*").alias("n"))


_LAYOUTS = ["yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd", "d-MMM-yy", "yyyy/MM/dd"]


@_query("""WITH r AS (SELECT 'R' || o_orderkey AS record_id, o_orderkey AS k, o_orderdate AS d FROM orders)
SELECT record_id, CASE WHEN k % 6 = 5 THEN 'soon' ELSE strftime(d, '%Y-%m-%d') END AS value, k % 6 = 5 AS failed FROM r""")
def date_repair(spark, sf_dir):
    written = "case o_orderkey % 6 " + " ".join(f"when {i} then date_format(o_orderdate, '{f}')" for i, f in enumerate(_LAYOUTS)) + " else 'soon' end"
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", d=written)
    rule = {"id": "D", "type": "type", "column": "d", "remediation": {"action": "parse_date", "formats": ["%d/%m/%Y", "%Y%m%d", "%d-%b-%y", "%Y/%m/%d"]}}
    return _values(_checked(df, _registry({"d": {"type": "date"}}, rule)), "d")


@_query("""SELECT 'R' || event_id AS record_id, CASE event_id % 4 WHEN 3 THEN '25:10' WHEN 1 THEN strftime(ts, '%H:%M') || ':00' ELSE strftime(ts, '%H:%M:%S') END AS value, event_id % 4 = 3 AS failed FROM events""")
def time_repair(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "events"), "event_id", t="case event_id % 4 when 0 then date_format(ts, 'hh:mm:ss a') when 1 then date_format(ts, 'H.mm') when 3 then '25:10' else date_format(ts, 'HH:mm:ss') end")
    return _values(_checked(df, _registry({"t": {"type": "time"}}, {"id": "T", "type": "type", "column": "t", "remediation": {"action": "parse_time"}})), "t")


@_query("""WITH r AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'cust-' || c_custkey WHEN 1 THEN c_custkey::VARCHAR WHEN 2 THEN 'X' || c_custkey ELSE 'CUST' || lpad(c_custkey::VARCHAR, 9, '0') END AS v FROM customer)
SELECT 'R' || k AS record_id, CASE WHEN k % 4 = 2 THEN v ELSE 'CUST' || lpad(k::VARCHAR, 9, '0') END AS value, k % 4 = 2 AS failed FROM r""")
def pattern_reformat_id(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "customer"), "c_custkey", id="case c_custkey % 4 when 0 then concat('cust-', c_custkey) when 1 then cast(c_custkey as string) when 2 then concat('X', c_custkey) else concat('CUST', lpad(cast(c_custkey as string), 9, '0')) end")
    rule = {"id": "P", "type": "pattern", "column": "id", "pattern": r"CUST\d{9}", "remediation": {"action": "reformat_id", "patterns": [r"^(\d{1,9})$", r"^CUST[\s_-]?(\d{1,9})$"], "template": "CUST{0:0>9}"}}
    return _values(_checked(df, _registry({"id": {}}, rule)), "id")


@_query("""SELECT 'R' || c_custkey AS record_id, CASE WHEN c_custkey % 3 = 2 THEN c_name ELSE replace(replace(c_name, '#', ' '), 'Customer', 'Client') END AS value, c_custkey % 3 = 2 AS failed FROM customer""")
def replace_regex(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "customer"), "c_custkey", name="case c_custkey % 3 when 0 then concat(' ', replace(c_name, '#', ' ? ')) when 1 then replace(replace(c_name, '#', ' '), 'Customer', 'Client') else c_name end")
    rule = {"id": "P", "type": "pattern", "column": "name", "pattern": r"Client \d{9}", "when": {"column": "name", "not_null": True}, "remediation": {"action": "replace", "substitutions": [{"pattern": r"\?", "replace": ""}, {"pattern": r"Customer(\s+)", "replace": r"Client\1"}, {"pattern": r"\s+", "replace": " "}]}}
    return _values(_checked(df, _registry({"name": {}}, rule)), "name")


# Checks over numbers, dates and several columns

_LINE = {"l": "cast(l_linenumber as string)", "q": "cast(l_quantity as string)", "x": "cast(l_extendedprice as string)", "dis": "cast(l_discount as string)", "tax": "cast(l_tax as string)", "flag": "l_returnflag", "st": "l_linestatus", "day": "date_format(l_shipdate, 'yyyy-MM-dd')"}
_LINE_COLUMNS = {"l": {"type": "integer"}, "q": {"type": "decimal"}, "x": {"type": "decimal"}, "dis": {"type": "decimal"}, "tax": {"type": "decimal"}, "flag": {}, "st": {}, "day": {"type": "date"}}


def _lines(spark: SparkSession, sf_dir: str, *rules: dict, extra: dict | None = None, columns: dict | None = None) -> E.Validation:
    df = _rows(_t(spark, sf_dir, "lineitem"), "l_orderkey * 10 + l_linenumber", **_LINE, **(extra or {}))
    return _checked(df, _registry({**_LINE_COLUMNS, **(columns or {})}, *rules))


def _by_rule(v: E.Validation) -> DataFrame:
    return E.rule_statistics(v).select("rule_id", "unresolved")


@_query("""SELECT 'IN' AS rule_id, count(*) AS unresolved FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45 UNION ALL SELECT 'OUT', count(*) FROM lineitem WHERE l_quantity <= 5 OR l_quantity >= 45
UNION ALL SELECT 'LOW', count(*) FROM lineitem WHERE l_discount < 0.02 UNION ALL SELECT 'DAY', count(*) FROM lineitem WHERE l_shipdate::DATE < DATE '1992-02-03' OR l_shipdate::DATE > DATE '1998-07-03'""")
def range_bounds(spark, sf_dir):
    return _by_rule(_lines(
        spark, sf_dir, {"id": "IN", "type": "range", "column": "q", "min": 5, "max": 45}, {"id": "OUT", "type": "range", "column": "q", "min": 5, "max": 45, "exclusive_min": True, "exclusive_max": True},
        {"id": "LOW", "type": "range", "column": "dis", "min": 0.02}, {"id": "DAY", "type": "range", "column": "day", "min": "1992-02-03", "max": "today-30d"},
    ))


@_query("""SELECT 'YEARS' AS rule_id, count(*) AS unresolved FROM orders WHERE o_orderdate::DATE < DATE '1995-08-02' UNION ALL SELECT 'MONTHS', count(*) FROM orders WHERE o_orderdate::DATE > DATE '1997-08-02'""")
def relative_bounds(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", day="date_format(o_orderdate, 'yyyy-MM-dd')")
    return _by_rule(_checked(df, _registry({"day": {"type": "date"}}, {"id": "YEARS", "type": "range", "column": "day", "min": "today-3y"}, {"id": "MONTHS", "type": "range", "column": "day", "max": "today-12m"})))


@_query("""SELECT l_returnflag AS flag, sum((NOT l_shipdate::DATE >= o_orderdate::DATE + INTERVAL 1 MONTH)::INT)::BIGINT AS early, sum((NOT l_shipdate::DATE <= o_orderdate::DATE + INTERVAL 90 DAY)::INT)::BIGINT AS late FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def compare_offsets(spark, sf_dir):
    both = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    df = _rows(both, "l_orderkey * 10 + l_linenumber", ship="date_format(l_shipdate, 'yyyy-MM-dd')", ordered="date_format(o_orderdate, 'yyyy-MM-dd')", flag="l_returnflag")
    rules = [{"id": "EARLY", "type": "compare", "left": "ship", "operator": ">=", "right": "ordered", "offset": {"months": 1}}, {"id": "LATE", "type": "compare", "left": "ship", "operator": "<=", "right": "ordered", "offset": {"days": 90}}]
    v = _checked(df, _registry({"ship": {"type": "date"}, "ordered": {"type": "date"}, "flag": {}}, *rules))
    has = lambda no: F.sum(F.exists("fails", lambda f: f["no"] == no).cast("long"))
    return v.rows.groupBy("flag").agg(has(0).alias("early"), has(1).alias("late"))


@_query("""SELECT l_returnflag AS flag, sum((NOT (abs(l_extendedprice * (1 - l_discount)) <= 30000 AND l_tax < 0.07))::INT)::BIGINT AS failed FROM lineitem GROUP BY 1""")
def expression_rule(spark, sf_dir):
    v = _lines(spark, sf_dir, {"id": "X", "type": "expression", "expression": "(abs(x * (1 - dis)) <= 30000) & (tax < 0.07)", "columns": ["x", "dis", "tax"]})
    return v.rows.groupBy("flag").agg(F.sum((F.size("fails") > 0).cast("long")).alias("failed"))


@_query("""WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 = 0 THEN 'ATLANTIS' WHEN c_custkey % 6 = 1 THEN lower(n_name) ELSE n_name END AS v FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT 'R' || k AS record_id, CASE WHEN k % 6 = 1 THEN upper(v) ELSE v END AS value, k % 6 = 0 AS failed FROM r""")
def reference_lookup(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation")
    both = _t(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    df = _rows(both, "c_custkey", nation="case when c_custkey % 6 = 0 then 'ATLANTIS' when c_custkey % 6 = 1 then lower(n_name) else n_name end")
    names = [r["n_name"] for r in nation.select("n_name").distinct().collect()]
    return _values(_checked(df, _registry({"nation": {}}, {"id": "REF", "type": "reference", "column": "nation", "values": names, "reference": {"path": "nation", "column": "n_name"}, "remediation": {"action": "canonicalize"}})), "nation")


@_query("""WITH r AS (SELECT CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_returnflag END AS flag, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_linestatus END AS st FROM lineitem)
SELECT 'NEED' AS rule_id, sum((coalesce(st = 'O', false) AND flag IS NULL)::INT)::BIGINT AS unresolved FROM r
UNION ALL SELECT 'EMPTY', sum((NOT (coalesce(st IN ('O', 'F'), false)) AND flag IS NOT NULL)::INT)::BIGINT FROM r
UNION ALL SELECT 'ANY', sum((((coalesce(flag NOT IN ('A', 'R'), false)) OR st IS NULL) AND flag IS NULL)::INT)::BIGINT FROM r
UNION ALL SELECT 'BOTH', sum((flag IS NOT NULL AND st IS NOT NULL AND flag NOT IN ('N', 'R'))::INT)::BIGINT FROM r""")
def conditional_rules(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "lineitem"), "l_orderkey * 10 + l_linenumber", flag="case when l_orderkey % 9 = 0 then null else l_returnflag end", st="case when l_orderkey % 7 = 0 then null else l_linestatus end")
    rules = [
        {"id": "NEED", "type": "not_null", "column": "flag", "when": {"column": "st", "equals": "O"}}, {"id": "EMPTY", "type": "is_null", "column": "flag", "when": {"not": {"column": "st", "in": ["O", "F"]}}},
        {"id": "ANY", "type": "not_null", "column": "flag", "when": {"any": [{"column": "flag", "not_in": ["A", "R"]}, {"column": "st", "is_null": True}]}},
        {"id": "BOTH", "type": "allowed_values", "column": "flag", "values": ["N", "R"], "when": {"all": [{"column": "flag", "not_null": True}, {"column": "st", "is_null": False}]}},
    ]
    return _by_rule(_checked(df, _registry({"flag": {}, "st": {}}, *rules)))


@_query("""SELECT 'R' || o_orderkey AS record_id, strftime(o_orderdate, '%Y-%m') AS value, false AS failed FROM orders""")
def derived_month(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", day="date_format(o_orderdate, 'yyyy-MM-dd')", month="case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then '1900-01' else date_format(o_orderdate, 'yyyy-MM') end")
    rule = {"id": "M", "type": "derived", "column": "month", "source": "day", "format": "%Y-%m", "remediation": {"action": "derive"}}
    return _values(_checked(df, _registry({"day": {"type": "date"}, "month": {"type": "year_month"}}, rule)), "month")


@_query("""WITH r AS (SELECT o_orderkey AS k, o_orderdate::DATE AS d FROM orders),
s AS (SELECT k, d, CASE WHEN day(d) <= 12 AND k % 2 = 0 THEN make_date(year(d), day(d), month(d)) ELSE d END AS w FROM r)
SELECT 'R' || k AS record_id, strftime(d, '%Y-%m-%d') AS value, false AS failed FROM s""")
def swap_day_month(spark, sf_dir):
    swapped = "case when dayofmonth(o_orderdate) <= 12 and o_orderkey % 2 = 0 then date_format(make_date(year(o_orderdate), dayofmonth(o_orderdate), month(o_orderdate)), 'yyyy-MM-dd') else date_format(o_orderdate, 'yyyy-MM-dd') end"
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", day=swapped, month="date_format(o_orderdate, 'yyyy-MM')")
    rule = {"id": "S", "type": "derived", "column": "month", "source": "day", "format": "%Y-%m", "remediation": {"action": "swap_day_month", "target": "day"}}
    return _values(_checked(df, _registry({"day": {"type": "date"}, "month": {"type": "year_month"}}, rule)), "day")


@_query("""WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_quantity AS q, CASE l_orderkey % 4 WHEN 0 THEN 'EGP' WHEN 1 THEN 'USD' WHEN 2 THEN 'SAR' ELSE 'XXX' END AS cur FROM lineitem),
c AS (SELECT k, q * CASE cur WHEN 'EGP' THEN 1.0::DOUBLE WHEN 'USD' THEN 52.4::DOUBLE WHEN 'SAR' THEN 13.97::DOUBLE END AS x FROM r)
SELECT 'R' || k AS record_id, regexp_replace(regexp_replace((round_even(x * 100, 0) / 100)::DECIMAL(20, 4)::VARCHAR, '0+$', ''), '\\.$', '') AS value, x IS NULL AS failed FROM c""")
def generate_convert(spark, sf_dir):
    rule = {"id": "G", "type": "generate", "column": "egp", "method": "convert_currency", "amount": "q", "currency": "cur", "rates": {"EGP": 1, "USD": 52.4, "SAR": 13.97}, "decimals": 2}
    v = _lines(spark, sf_dir, rule, extra={"cur": "case l_orderkey % 4 when 0 then 'EGP' when 1 then 'USD' when 2 then 'SAR' else 'XXX' end"}, columns={"cur": {}, "egp": {"type": "decimal", "generated": True}})
    return _values(v, "egp")


@_query("""SELECT CASE WHEN l_returnflag IN ('A', 'R') AND l_linestatus = 'F' THEN '1' WHEN l_returnflag = 'N' THEN '2' END AS value, coalesce(NOT (l_returnflag IN ('A', 'R') AND l_linestatus = 'F') AND l_returnflag <> 'N', true) AS failed, count(*) AS n FROM lineitem GROUP BY ALL""")
def generate_case(spark, sf_dir):
    rule = {"id": "G", "type": "generate", "column": "kind", "method": "case", "cases": [{"when": {"all": [{"column": "flag", "in": ["A", "R"]}, {"column": "st", "equals": "F"}]}, "value": 1}, {"when": {"column": "flag", "equals": "N"}, "value": 2}]}
    v = _lines(spark, sf_dir, rule, columns={"kind": {"generated": True}})
    return _values(v, "kind").groupBy("value", "failed").agg(F.count("*").alias("n"))


@_query(f"""WITH {_SEGMENT_SQL} SELECT record_id, (seg0 <> seg1)::INT + (name0 <> name1)::INT + (seg2 IS NULL)::INT + coalesce((seg2 <> seg3)::INT, 0) AS edits FROM res
WHERE (seg0 <> seg1)::INT + (name0 <> name1)::INT + (seg2 IS NULL)::INT + coalesce((seg2 <> seg3)::INT, 0) >= 2""")
def auto_fix_review(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "customer"), "c_custkey", seg=_SEGMENT, name=_NAME)
    v = _checked(df, _registry({"seg": {}, "name": {}}, _SEGMENT_RULE, {"id": "REV", "type": "auto_fix_review", "min_changes": 2}, tokens=("n/a",), pre=(TRIM, TOKENS)))
    said = F.filter("fails", lambda f: f["no"] == 3)
    return v.rows.filter(F.size(said) > 0).select("record_id", F.regexp_extract(said[0]["value"], r"^(\d+) values", 1).cast("int").alias("edits"))


# Rules that compare rows

@_query("""SELECT 'R' || doc_id AS record_id, 'removed' AS status FROM (SELECT doc_id, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS r FROM documents) WHERE r > 1""")
def duplicate_rows(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "documents"), "doc_id", text="text", lang="lang")
    v = E.validate(df, _registry({"text": {}, "lang": {}}, pre=({"id": "DUP", "type": "duplicate_rows", "remediation": {"action": "drop_duplicates"}},)), RUN_DATE)
    return v.rows.filter("status = 'removed'").select("record_id", "status")


_COPIED = "case when o_orderkey % 50 = 0 then cast(o_orderkey + 1 as varchar(20)) else cast(o_orderkey as varchar(20)) end"


@_query(f"""WITH r AS (SELECT o_orderkey AS k, {_COPIED} AS v, o_orderstatus AS s FROM orders), u AS (SELECT *, count(*) OVER (PARTITION BY v) AS n FROM r WHERE s <> 'P') SELECT 'R' || k AS record_id, v AS value FROM u WHERE n > 1""")
def unique_rule(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", id=_COPIED, s="o_orderstatus")
    v = E.validate(df, _registry({"id": {}, "s": {}}, {"id": "U", "type": "unique", "column": "id", "when": {"column": "s", "not_in": ["P"]}}), RUN_DATE)
    return v.rows.filter("size(fails) > 0").select("record_id", F.col("id").alias("value"))


@_query("""WITH n AS (SELECT o_custkey AS c, o_orderpriority AS p, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY 1, 2),
m AS (SELECT c, p FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, f) AS r FROM n) WHERE r = 1),
n2 AS (SELECT o_custkey AS c, o_orderstatus AS s, count(*) AS n, min(o_orderkey) AS f FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY 1, 2),
m2 AS (SELECT c, s FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, f) AS r FROM n2) WHERE r = 1)
SELECT 'R' || o_orderkey AS record_id, o_custkey::VARCHAR AS value FROM orders JOIN m ON m.c = o_custkey LEFT JOIN m2 ON m2.c = o_custkey WHERE o_orderpriority <> p OR coalesce(o_orderkey % 10 <> 0 AND o_orderstatus <> s, false)""")
def functional_dependency(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", cust="cast(o_custkey as string)", prio="o_orderpriority", s="case when o_orderkey % 10 = 0 then null else o_orderstatus end")
    v = E.validate(df, _registry({"cust": {}, "prio": {}, "s": {}}, {"id": "FD", "type": "functional_dependency", "entity": "customer"}, entities={"customer": {"key": "cust", "attributes": ["prio", "s"]}}), RUN_DATE)
    return v.errors.select("record_id", "value")


@_query("""WITH b AS (SELECT 'seg' AS "column", sum((c_custkey % 10 = 2)::INT)::BIGINT AS missing_in_input, 0::BIGINT AS missing_in_accepted FROM customer) SELECT "column", 0::BIGINT AS missing_in_input, missing_in_input AS missing_in_accepted FROM b UNION ALL SELECT 'name', 0, 0""")
def missing_by_column(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "customer"), "c_custkey", seg=_SEGMENT, name=_NAME)
    return E.missing_by_column(_segments(spark, sf_dir), df)


# Corrections, ledger, merge, reporting

_LEDGER = "SELECT 'R' || c_custkey AS record_id, CASE WHEN c_custkey % 5 = 0 THEN 'RESOLVED' ELSE 'OPEN' END AS status, 2 AS round, (c_custkey % 3)::INT AS attempts FROM customer WHERE c_custkey % 2 = 0"


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").selectExpr("concat('R', c_custkey) as record_id", "case when c_custkey % 5 = 0 then 'RESOLVED' else 'OPEN' end as status", "2 as round", "cast(c_custkey % 3 as int) as attempts", "'t' as updated_at")


_CORRECTION_LINES = """lines AS (
SELECT c_custkey * 10 AS n, 'R' || c_custkey AS record_id, CASE WHEN c_custkey % 8 = 4 THEN 'egp' ELSE 'seg' END AS "column", ' ' || c_mktsegment || ' ' AS new_value, CASE c_custkey % 9 WHEN 0 THEN 'discard' WHEN 1 THEN 'Accept' WHEN 2 THEN 'drop' ELSE '' END AS action FROM customer
UNION ALL SELECT c_custkey * 10 + 1, 'R' || c_custkey, 'seg', CASE WHEN c_custkey % 6 = 0 THEN 'OTHER' ELSE c_mktsegment END, 'FIX' FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey * 10 + 2, 'R' || c_custkey, 'seg', '', '' FROM customer WHERE c_custkey % 4 = 0)"""
_IMPORT_SQL = f"""WITH {_CORRECTION_LINES}, led AS ({_LEDGER}),
a AS (SELECT n, record_id, "column", trim(new_value) AS new_value, CASE WHEN action = '' THEN 'FIX' ELSE upper(action) END AS action FROM lines),
t AS (SELECT a.*, l.status FROM a LEFT JOIN led l ON l.record_id = a.record_id AND l.status = 'OPEN' WHERE new_value <> '' OR action IN ('DISCARD', 'ACCEPT')),
r AS (SELECT *, CASE WHEN action NOT IN ('FIX', 'DISCARD', 'ACCEPT') THEN 'unknown action ''' || action || ''' (use FIX, DISCARD or ACCEPT)' WHEN status IS NULL THEN 'record is not open in round 2' WHEN action <> 'FIX' THEN '' WHEN "column" <> 'seg' THEN '''' || "column" || ''' is not an editable schema column' ELSE '' END AS why FROM t),
d AS (SELECT record_id, "column", count(DISTINCT new_value) AS v FROM r WHERE why = '' AND action = 'FIX' GROUP BY ALL),
f AS (SELECT r.*, CASE WHEN why = '' AND action = 'FIX' AND d.v > 1 THEN 'corrected more than once with different values' ELSE why END AS refused FROM r LEFT JOIN d USING (record_id, "column"))
"""


def _import(spark: SparkSession, sf_dir: str) -> C.Import:
    c = _t(spark, sf_dir, "customer")
    one = c.selectExpr("c_custkey * 10 as line_no", "concat('R', c_custkey) as record_id", "case when c_custkey % 8 = 4 then 'egp' else 'seg' end as column", "concat(' ', c_mktsegment, ' ') as new_value", "case c_custkey % 9 when 0 then 'discard' when 1 then 'Accept' when 2 then 'drop' else '' end as action")
    two = c.filter("c_custkey % 3 = 0").selectExpr("c_custkey * 10 + 1", "concat('R', c_custkey)", "'seg'", "case when c_custkey % 6 = 0 then 'OTHER' else c_mktsegment end", "'FIX'")
    three = c.filter("c_custkey % 4 = 0").selectExpr("c_custkey * 10 + 2", "concat('R', c_custkey)", "'seg'", "''", "''")
    records = c.selectExpr("concat('R', c_custkey) as record_id", "lower(c_mktsegment) as seg")
    registry = _registry({"seg": {}, "egp": {"type": "decimal", "generated": True}})
    return C.import_lines(one.union(two).union(three), _ledger(spark, sf_dir), records, registry, "u", "t")


@_query(_IMPORT_SQL + """, g AS (SELECT record_id, "column", action, arg_min(new_value, n) AS new_value FROM f WHERE refused = '' GROUP BY ALL)
SELECT g.record_id, CASE WHEN action = 'FIX' THEN "column" ELSE '' END AS "column", CASE WHEN action = 'FIX' THEN lower(c_mktsegment) END AS old_value, new_value, action FROM g JOIN customer ON 'R' || c_custkey = g.record_id""")
def correction_import(spark, sf_dir):
    return _import(spark, sf_dir).accepted.select("record_id", "column", "old_value", "new_value", "action")


@_query(_IMPORT_SQL + """SELECT record_id, "column", new_value, action, refused FROM f WHERE refused <> ''""")
def correction_refusals(spark, sf_dir):
    return _import(spark, sf_dir).refused.select("record_id", "column", "new_value", "action", "refused")


@_query("""SELECT 'R' || o_orderkey AS record_id, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'X' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 6 = 0 THEN 'low' ELSE o_orderpriority END AS prio FROM orders""")
def apply_corrections(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    records = o.selectExpr("concat('R', o_orderkey) as record_id", "o_orderstatus as status", "o_orderpriority as prio")
    fixes = o.filter("o_orderkey % 4 in (0, 1)").selectExpr("concat('R', o_orderkey) as record_id", "'status' as column", "case when o_orderkey % 4 = 0 then '__NULL__' else 'X' end as new_value").union(o.filter("o_orderkey % 6 = 0").selectExpr("concat('R', o_orderkey)", "'prio'", "'low'"))
    return C.apply_fixes(records, fixes, ["status", "prio"])


@_query("""WITH q AS (SELECT c_custkey AS k, (c_custkey % 3)::INT AS attempts FROM customer WHERE c_custkey % 10 = 3),
r AS (SELECT k, attempts, CASE k % 4 WHEN 0 THEN 'discarded' WHEN 1 THEN 'resolved' WHEN 2 THEN CASE WHEN attempts + 1 >= 3 THEN 'manual' ELSE 'failed' END ELSE 'carried' END AS route FROM q)
SELECT 'R' || k AS record_id, CASE route WHEN 'resolved' THEN 'RESOLVED' WHEN 'discarded' THEN 'DISCARDED' WHEN 'manual' THEN 'MANUAL_REVIEW_REQUIRED' ELSE 'OPEN' END AS status, CASE WHEN route IN ('failed', 'carried', 'manual') THEN 3 ELSE 2 END AS round, attempts + (route IN ('resolved', 'failed', 'manual'))::INT AS attempts FROM r""")
def revalidate_routing(spark, sf_dir):
    v = _segments(spark, sf_dir, write=True)
    q = v.quarantine
    k = F.expr("cast(substring(record_id, 2, 20) as bigint)")
    ledger = q.select("record_id", F.lit("OPEN").alias("status"), F.lit(2).alias("round"), (k % 3).cast("int").alias("attempts"), F.lit("s").alias("updated_at"))
    line = q.withColumn("k", k).filter("k % 4 in (0, 1, 2)").selectExpr("record_id", "case when k % 4 = 0 then '' else 'seg' end as column", "case when k % 4 = 1 then 'BUILDING' else 'STILL WRONG' end as new_value", "case when k % 4 = 0 then 'DISCARD' else 'FIX' end as action")
    round_ = C.revalidate(q, v.errors, line, ledger, v.valid, None, v.registry, RUN_DATE, "n")
    return round_.ledger.select("record_id", "status", "round", "attempts")


@_query(f"""WITH a AS ({_LEDGER}), b AS (SELECT record_id, CASE WHEN round = 2 AND attempts = 1 THEN 'DISCARDED' ELSE status END AS status, round, attempts FROM a) SELECT * FROM b EXCEPT SELECT * FROM a""")
def ledger_changes(spark, sf_dir):
    before = _ledger(spark, sf_dir)
    after = before.withColumn("status", F.when(F.col("attempts") == 1, "DISCARDED").otherwise(F.col("status")))
    return C.changed_entries(before, after).select("record_id", "status", "round", "attempts")


@_query(f"SELECT status, round, count(*) AS count FROM ({_LEDGER}) GROUP BY ALL")
def ledger_totals(spark, sf_dir):
    return C.status_totals(_ledger(spark, sf_dir))


@_query("""SELECT event_id, 'U' || user_id AS record_id, (row_number() OVER w)::INT AS sequence, lag(event_type) OVER w AS previous_status FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def history_sequence(spark, sf_dir):
    h = _t(spark, sf_dir, "events").selectExpr("event_id", "concat('U', user_id) as record_id", "event_type as status", "struct(ts, event_id) as seq")
    return M.quarantine_history(h).select("event_id", "record_id", "sequence", "previous_status")


@_query("""WITH r AS (SELECT 'R' || o_orderkey AS record_id, 'r' || g AS s, g AS round FROM orders, range(2, 5) t(g) WHERE o_orderkey % 3 = 0 AND o_orderkey % g = 0),
l AS (SELECT record_id, arg_max(s, round) AS s FROM r GROUP BY 1) SELECT coalesce(l.record_id, v.record_id) AS record_id, coalesce(l.s, v.s) AS s FROM (SELECT 'R' || o_orderkey AS record_id, o_orderstatus AS s FROM orders WHERE o_orderkey % 2 = 0) v FULL JOIN l ON l.record_id = v.record_id""")
def merge_latest(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    valid = o.filter("o_orderkey % 2 = 0").selectExpr("concat('R', o_orderkey) as record_id", "o_orderstatus as s")
    resolved = o.filter("o_orderkey % 3 = 0").selectExpr("concat('R', o_orderkey) as record_id", "explode(filter(array(2, 3, 4), g -> o_orderkey % g = 0)) as round").selectExpr("record_id", "concat('r', round) as s", "round")
    return G.merge(valid, resolved)


@_query("""WITH f AS (SELECT 'U' || user_id AS run_id, 100 + count(*) AS processed, 50::BIGINT AS valid, 40::BIGINT AS quarantined FROM events GROUP BY 1),
r AS (SELECT DISTINCT 'U' || user_id AS run_id, g AS round, (user_id % 4)::BIGINT AS resolved, (user_id % 2)::BIGINT AS manually_fixed, 0::BIGINT AS confirmed, 1::BIGINT AS discarded, 0::BIGINT AS manual_review, 40 - (g - 1) * (user_id % 4 + 1) AS open_after FROM events, range(2, 4) t(g)),
a AS (SELECT run_id, 1 AS round, 0 AS resolved, 0 AS manually_fixed, 0 AS confirmed, 0 AS discarded, 0 AS manual_review, 40 AS open_after FROM f UNION ALL SELECT * FROM r),
t AS (SELECT run_id, round, sum(resolved) OVER w AS resolved, sum(manually_fixed) OVER w AS manually_fixed, sum(discarded) OVER w AS discarded, sum(manual_review) OVER w AS mr, open_after AS open FROM a WINDOW w AS (PARTITION BY run_id ORDER BY round))
SELECT run_id, round::BIGINT AS round, resolved::BIGINT AS resolved, manually_fixed::BIGINT AS manually_fixed, (resolved - manually_fixed)::BIGINT AS auto_resolved, discarded::BIGINT AS discarded, (open + mr)::BIGINT AS unresolved, round((valid + resolved)::DOUBLE / processed, 6) AS final_score, resolved + discarded + open + mr = quarantined AS balanced FROM t JOIN f USING (run_id)""")
def run_funnel(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    first = e.groupBy(F.expr("concat('U', user_id)").alias("run_id")).agg((F.count("*") + 100).alias("processed")).withColumns({"valid": F.lit(50).cast("long"), "quarantined": F.lit(40).cast("long")})
    rounds = e.select("user_id").distinct().selectExpr("concat('U', user_id) as run_id", "user_id", "explode(array(2, 3)) as round").selectExpr("run_id", "round", "user_id % 4 as resolved", "user_id % 2 as manually_fixed", "cast(0 as bigint) as confirmed", "cast(1 as bigint) as discarded", "cast(0 as bigint) as manual_review", "40 - (round - 1) * (user_id % 4 + 1) as open_after")
    return M.run_funnel(first, rounds).selectExpr("run_id", "cast(round as bigint) as round", "resolved", "manually_fixed", "auto_resolved", "discarded", "unresolved", "final_score", "balanced")


@_query("""WITH l AS (SELECT event_id AS seq, 'R' || user_id AS record_id, event_type AS "column", 'FIX' AS action, 1 AS round FROM events), a AS (SELECT DISTINCT 'R' || user_id AS record_id, 1 AS round, CASE user_id % 3 WHEN 0 THEN 'RESOLVED' ELSE 'OPEN' END AS status_after FROM events WHERE user_id % 4 <> 0)
SELECT seq, l.record_id, "column", CASE WHEN row_number() OVER (PARTITION BY l.record_id, "column" ORDER BY seq DESC) > 1 THEN 'superseded' ELSE coalesce(CASE status_after WHEN 'RESOLVED' THEN 'resolved' WHEN 'OPEN' THEN 'failed_again' END, 'pending') END AS outcome FROM l LEFT JOIN a USING (record_id, round)""")
def correction_outcomes(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    log = e.selectExpr("event_id as seq", "concat('R', user_id) as record_id", "event_type as column", "'FIX' as action", "1 as round")
    after = e.filter("user_id % 4 <> 0").selectExpr("concat('R', user_id) as record_id", "1 as round", "case user_id % 3 when 0 then 'RESOLVED' else 'OPEN' end as status_after").distinct()
    return M.correction_outcomes(log, after).select("seq", "record_id", "column", "outcome")


@_query(f"WITH {_SEGMENT_SQL} SELECT count(*) AS auto_fixed_records FROM res WHERE NOT bad AND (seg0 <> seg1 OR name0 <> name1 OR seg2 IS NULL OR coalesce(seg2 <> seg3, false))")
def auto_fixed_records(spark, sf_dir):
    v = _segments(spark, sf_dir)
    return M.auto_fixed_records(v.audit, v.quarantine)


@_query("""WITH c AS (SELECT c_custkey AS k, c_nationkey::VARCHAR AS nat, c_mktsegment AS seg FROM customer), n AS (SELECT nat, seg, count(*) AS n FROM c WHERE k % 5 <> 0 GROUP BY ALL),
b AS (SELECT nat, arg_min(seg, struct_pack(o := -n, s := seg)) AS value, max(n) AS support, sum(n)::BIGINT AS total FROM n GROUP BY 1)
SELECT 'R' || k AS record_id, 'seg' AS "column", b.value, 'nat' AS source_column, c.nat AS source_value, support, total FROM c JOIN b USING (nat) WHERE k % 5 = 0""")
def suggest_values(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").selectExpr("concat('R', c_custkey) as record_id", "c_custkey as k", "cast(c_nationkey as string) as nat", "c_mktsegment as seg")
    registry = _registry({"nat": {}, "seg": {}}, dependencies={"d": {"determinant": "nat", "dependents": ["seg"]}})
    gaps = c.filter("k % 5 = 0").withColumn("seg", F.lit(None).cast("string"))
    return S.suggest(gaps, gaps.select("record_id", F.lit("seg").alias("column")), c.filter("k % 5 <> 0"), registry)


@_query("""WITH v AS (SELECT 'R' || c_custkey AS record_id, (c_custkey % 40)::VARCHAR AS value FROM customer), g AS (SELECT value, count(*) AS n, min(record_id) AS first, max(record_id) AS last FROM v GROUP BY 1)
SELECT record_id, value, n - 1 AS others, first, last FROM v JOIN g USING (value) WHERE n > 1""")
def other_copies(spark, sf_dir):
    return S.other_copies(_t(spark, sf_dir, "customer").selectExpr("concat('R', c_custkey) as record_id", "cast(c_custkey % 40 as string) as g"), "g")


@_query("""WITH v AS (SELECT 'R' || c_custkey AS record_id, (c_custkey % 40)::VARCHAR AS value FROM customer), a AS (SELECT record_id, value, count(*) OVER w AS n, min(record_id) OVER w AS lo FROM v WINDOW w AS (PARTITION BY value)), b AS (SELECT value, min(record_id) AS hi FROM a WHERE record_id <> lo GROUP BY value)
SELECT record_id, value, n AS group_size, CASE WHEN record_id <> lo THEN lo ELSE hi END AS representative FROM a LEFT JOIN b USING (value)""")
def copy_groups(spark, sf_dir):
    return S.copy_groups(_t(spark, sf_dir, "customer").selectExpr("concat('R', c_custkey) as record_id", "cast(c_custkey % 40 as string) as g"), "g")


# Profile

_PROFILED = "case c_custkey % 12 when 0 then null when 1 then '' when 2 then ' N/A' when 3 then lower(c_mktsegment) when 4 then concat(c_mktsegment, ' ') when 5 then 'Other' else c_mktsegment end"
_PROFILE_SQL = f"""p AS (SELECT {_PROFILED} AS v FROM customer),
k AS (SELECT v, CASE WHEN v IS NULL THEN 'null' WHEN trim(v) = '' THEN 'blank' WHEN lower(trim(v)) IN ('null','none','nan','n/a','na','#n/a','nil','-','--','?') THEN 'token' END AS m FROM p)"""


def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.value_counts(_t(spark, sf_dir, "customer").selectExpr(f"{_PROFILED} as v"))


@_query(f"""WITH {_PROFILE_SQL} SELECT 'v' AS "column", count(*) AS rows, sum((m = 'null')::INT)::BIGINT AS null_count, sum((m = 'blank')::INT)::BIGINT AS blank_count, sum((m = 'token')::INT)::BIGINT AS token_count, count(m) AS missing_count, count(DISTINCT CASE WHEN m IS NULL THEN v END) AS distinct_count, sum((m IS NULL AND v <> trim(v))::INT)::BIGINT AS whitespace_count, sum((m IS NULL)::INT)::BIGINT - count(DISTINCT CASE WHEN m IS NULL THEN v END) AS duplicate_count FROM k""")
def profile_missing(spark, sf_dir):
    return P.column_counts(_profiled(spark, sf_dir))


@_query(f"""WITH {_PROFILE_SQL}, t AS (SELECT v AS value, count(*) AS n FROM k WHERE m IS NULL GROUP BY 1) SELECT 'v' AS "column", row_number() OVER (ORDER BY n DESC, value)::INT AS rank, value, n FROM t ORDER BY n DESC, value LIMIT 10""")
def profile_top_values(spark, sf_dir):
    return P.top_values(_profiled(spark, sf_dir))


@_query(f"""WITH {_PROFILE_SQL}, t AS (SELECT regexp_replace(regexp_replace(regexp_replace(v, '[0-9]', '9', 'g'), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g') AS shape, count(*) AS n FROM k WHERE m IS NULL GROUP BY 1) SELECT 'v' AS "column", row_number() OVER (ORDER BY n DESC, shape)::INT AS rank, shape, n FROM t ORDER BY n DESC, shape LIMIT 10""")
def profile_shapes(spark, sf_dir):
    return P.top_shapes(_profiled(spark, sf_dir))


@_query(f"""WITH {_PROFILE_SQL}, t AS (SELECT v, count(*) AS n FROM k WHERE m IS NULL GROUP BY 1) SELECT 'v' AS "column", lower(trim(v)) AS key, count(*) AS variants, sum(n)::BIGINT AS rows, arg_min(v, struct_pack(o := -n, s := v)) AS most_common FROM t GROUP BY 2 HAVING count(*) > 1""")
def profile_spelling(spark, sf_dir):
    return P.spelling_variants(_profiled(spark, sf_dir))


@_query(f"""WITH {_PROFILE_SQL} SELECT 'v' AS "column", lower(trim(v)) AS label, count(*) AS rows FROM k WHERE lower(trim(v)) IN ('other', 'others', 'unknown', 'misc') GROUP BY 2""")
def profile_generic(spark, sf_dir):
    return P.generic_values(_profiled(spark, sf_dir))


@_query("""WITH x AS (SELECT CASE WHEN l_orderkey % 97 = 0 THEN 5000.0::DOUBLE WHEN l_orderkey % 89 = 0 THEN 0::DOUBLE WHEN l_orderkey % 83 = 0 THEN -3::DOUBLE ELSE l_quantity END AS x FROM lineitem),
b AS (SELECT count(*) AS n, min(x) AS min, max(x) AS max, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, quantile_cont(x, 0.95) AS p95 FROM x)
SELECT n, min, max, p25, p50, p75, p95, (SELECT count(*) FROM x WHERE x.x < p25 - 1.5 * (p75 - p25) OR x.x > p75 + 1.5 * (p75 - p25)) AS outliers, (SELECT count(*) FROM x WHERE x.x < p25 - 3 * (p75 - p25) OR x.x > p75 + 3 * (p75 - p25)) AS far_outliers, (SELECT count(*) FROM x WHERE x.x = 0) AS zeros, (SELECT count(*) FROM x WHERE x.x < 0) AS negatives, (SELECT count(*) FROM x WHERE x.x = max) AS at_max FROM b""")
def profile_numeric(spark, sf_dir):
    df = _t(spark, sf_dir, "lineitem").selectExpr("case when l_orderkey % 97 = 0 then '5000' when l_orderkey % 89 = 0 then '0' when l_orderkey % 83 = 0 then '-3' else cast(l_quantity as string) end as x")
    return P.numeric_profile(df, "x").select("n", "min", "max", "p25", "p50", "p75", "p95", "outliers", "far_outliers", "zeros", "negatives", "at_max")


@_query("""SELECT 'c_custkey' AS "column", 1.0::DOUBLE AS distinct_share, 'key' AS kind UNION ALL SELECT 'c_name', 1.0, 'key' UNION ALL SELECT 'near', round((count(*) - 1)::DOUBLE / count(*), 6), 'near_key' FROM customer""")
def candidate_keys(spark, sf_dir):
    df = _t(spark, sf_dir, "customer").selectExpr("cast(c_custkey as string) as c_custkey", "c_name", "c_mktsegment", "cast(case when c_custkey = 2 then 1 else c_custkey end as string) as near")
    return P.candidate_keys(P.column_counts(P.value_counts(df)))


@_query("SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS duplicate_rows FROM documents")
def duplicate_row_count(spark, sf_dir):
    return P.duplicate_row_count(_t(spark, sf_dir, "documents").select("text", "lang"))


_PAIRS_SQL = """long AS (SELECT o_custkey::VARCHAR AS k, 'prio' AS "column", o_orderpriority AS v FROM orders UNION ALL SELECT o_custkey::VARCHAR, 'nat', CASE WHEN o_orderkey % 200 = 0 THEN 'x' ELSE (o_custkey % 25)::VARCHAR END FROM orders),
pairs AS (SELECT "column", k, v, count(*) AS n FROM long GROUP BY ALL),
ks AS (SELECT "column", k, sum(n) AS rows, count(*) AS vals, max(n) AS top FROM pairs GROUP BY ALL),
st AS (SELECT "column", sum(rows)::BIGINT AS rows, count(*) AS keys, sum((rows >= 2)::INT)::BIGINT AS testable_keys, sum((vals > 1)::INT)::BIGINT AS conflicting_keys, (sum(rows) - sum(top))::BIGINT AS conflicting_rows FROM ks GROUP BY 1),
tv AS (SELECT "column", max(n)::BIGINT AS top_value_rows FROM (SELECT "column", v, sum(n) AS n FROM pairs GROUP BY ALL) GROUP BY 1)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _t(spark, sf_dir, "orders").selectExpr("cast(o_custkey as string) as cust", "o_orderpriority as prio", "case when o_orderkey % 200 = 0 then 'x' else cast(o_custkey % 25 as string) end as nat")
    return R.relate(df, ["cust"], ["prio", "nat"], P.present(df.columns))


@_query(f"""WITH {_PAIRS_SQL} SELECT 'cust' AS key, "column", rows, keys, testable_keys, conflicting_keys, conflicting_rows, top_value_rows FROM st JOIN tv USING ("column")""")
def key_consistency(spark, sf_dir):
    return R.consistency(_pairs(spark, sf_dir))


@_query(f"""WITH {_PAIRS_SQL} SELECT 'cust' AS key, "column", conflicting_rows, round(1 - conflicting_rows::DOUBLE / rows, 6) AS agreement FROM st JOIN tv USING ("column") WHERE 1 - conflicting_rows::DOUBLE / rows >= 0.95 AND conflicting_rows::DOUBLE / rows <= 0.2 * (1 - top_value_rows::DOUBLE / rows)""")
def entity_attributes(spark, sf_dir):
    return R.entity_attributes(R.consistency(_pairs(spark, sf_dir))).select("key", "column", "conflicting_rows", "agreement")


@_query("""WITH r AS (SELECT c_custkey::VARCHAR AS k, CASE WHEN c_custkey % 30 = 0 THEN 'none@x.com' ELSE c_name || '@x.com' END AS v FROM customer) SELECT 'k' AS key, 'v' AS "column", v AS value, count(DISTINCT k) AS key_count FROM r GROUP BY v HAVING count(DISTINCT k) >= 10""")
def shared_values(spark, sf_dir):
    df = _t(spark, sf_dir, "customer").selectExpr("cast(c_custkey as string) as k", "case when c_custkey % 30 = 0 then 'none@x.com' else concat(c_name, '@x.com') end as v")
    return R.shared_values(R.relate(df, ["k"], ["v"], P.present(df.columns)))


@_query("""WITH r AS (SELECT l_returnflag AS flag, CASE WHEN l_returnflag = 'N' AND l_orderkey % 300 <> 0 THEN NULL ELSE 'x' END AS v FROM lineitem)
SELECT 'v' AS "column", 'flag' AS explained_by, 100.0::DOUBLE AS explained_percentage, 'n' AS missing_when, (SELECT count(*) FROM r WHERE flag = 'N' AND v IS NOT NULL)::BIGINT AS exceptions""")
def conditional_missing(spark, sf_dir):
    df = _t(spark, sf_dir, "lineitem").selectExpr("l_returnflag as flag", "l_linestatus as st", "case when l_returnflag = 'N' and l_orderkey % 300 <> 0 then null else 'x' end as v")
    return P.conditional_missing(df, ["v"], ["flag", "st"]).withColumn("missing_when", F.concat_ws(",", "missing_when"))


@_query("""WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%m-%d-%Y') END AS v, o_orderdate AS d FROM orders)
SELECT CASE WHEN k % 2 = 0 THEN '/' ELSE '-' END AS separator, count(*) AS rows, sum((split_part(replace(v, '-', '/'), '/', 1)::INT > 12)::INT)::BIGINT AS day_first, sum((split_part(replace(v, '-', '/'), '/', 2)::INT > 12)::INT)::BIGINT AS month_first, CASE WHEN k % 2 = 0 THEN 'day_first' ELSE 'month_first' END AS "order" FROM r GROUP BY k % 2""")
def date_order_evidence(spark, sf_dir):
    df = _t(spark, sf_dir, "orders").selectExpr("case when o_orderkey % 2 = 0 then date_format(o_orderdate, 'dd/MM/yyyy') else date_format(o_orderdate, 'MM-dd-yyyy') end as v")
    return P.date_order_evidence(df, "v")


# Dates as text in four columns: day first with one stray in fifty, two-digit years month first, ISO with a time of day, year first with the day in front.
_DATED = {
    "d": ("if(o_orderkey % 50 = 1, date_format(o_orderdate, 'M/d/yyyy'), date_format(o_orderdate, 'd/M/yyyy'))", "CASE WHEN o_orderkey % 50 = 1 THEN strftime(o_orderdate, '%-m/%-d/%Y') ELSE strftime(o_orderdate, '%-d/%-m/%Y') END"),
    "m": ("date_format(o_orderdate, 'MM.dd.yy')", "strftime(o_orderdate, '%m.%d.%y')"),
    "t": ("concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T', lpad(cast(o_orderkey % 24 as string), 2, '0'), ':05:09+02:00')", "strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':05:09+02:00'"),
    "y": ("date_format(o_orderdate, 'yyyy/dd/MM')", "strftime(o_orderdate, '%Y/%d/%m')"),
}
_DATED_SQL = " UNION ALL ".join(f"""SELECT '{c}' AS "column", {sql} AS v, o_orderdate AS d, o_orderkey AS k FROM orders""" for c, (_, sql) in _DATED.items())


def _dated_counts(spark, sf_dir):
    return P.value_counts(_t(spark, sf_dir, "orders").selectExpr(*[f"{text} as {c}" for c, (text, _) in _DATED.items()]))


@_query(f"""WITH r AS ({_DATED_SQL}),
p AS (SELECT "column", CASE WHEN "column" = 'y' THEN 'year_first' ELSE 'year_last' END AS layout, CASE WHEN "column" = 'm' THEN '.' ELSE '/' END AS separator, string_split(replace(v, '.', '/'), '/') AS x FROM r WHERE "column" <> 't'),
q AS (SELECT "column", layout, separator, (CASE WHEN layout = 'year_first' THEN x[2] ELSE x[1] END)::INT AS a, (CASE WHEN layout = 'year_first' THEN x[3] ELSE x[2] END)::INT AS b FROM p)
SELECT "column", layout, separator, count(*) AS rows, count(*) FILTER (a > 12) AS day_first_evidence, count(*) FILTER (b > 12) AS month_first_evidence, count(*) FILTER (a <= 12 AND b <= 12 AND a <> b) AS ambiguous, count(*) FILTER (a > 12) > count(*) FILTER (b > 12) AS day_first FROM q GROUP BY 1, 2, 3""")
def date_votes(spark, sf_dir):
    return D.evidence(_dated_counts(spark, sf_dir))


@_query(f"""WITH r AS ({_DATED_SQL}),
q AS (SELECT "column", CASE "column" WHEN 't' THEN d::TIMESTAMP + INTERVAL 1 HOUR * (k % 24 - 2) + INTERVAL 5 MINUTE + INTERVAL 9 SECOND
  WHEN 'd' THEN CASE WHEN k % 50 <> 1 THEN d::TIMESTAMP WHEN day(d) <= 12 THEN make_timestamp(year(d), day(d), month(d), 0, 0, 0.0) END ELSE d::TIMESTAMP END AS t FROM r)
SELECT "column", count(*) AS rows, count(t) AS dates, "column" = 't' AS has_time, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS earliest, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS latest, CASE WHEN "column" = 't' THEN 'datetime' ELSE 'date' END AS kind FROM q GROUP BY 1""")
def date_facts(spark, sf_dir):
    counts = _dated_counts(spark, sf_dir)
    found = D.facts(D.read_counted(counts, D.evidence(counts)))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return found.select("column", "rows", "dates", "has_time", text("min").alias("earliest"), text("max").alias("latest"), F.when(F.col("has_time"), "datetime").otherwise("date").alias("kind"))


@_query("""WITH x AS (SELECT CASE WHEN l_orderkey % 97 = 0 THEN 5000.0::DOUBLE WHEN l_orderkey % 89 = 0 THEN 0::DOUBLE WHEN l_orderkey % 83 = 0 THEN -3::DOUBLE ELSE l_quantity END AS x, l_orderkey % 10 = 0 AND l_quantity < 10 AND l_orderkey % 97 <> 0 AND l_orderkey % 89 <> 0 AND l_orderkey % 83 <> 0 AS lead FROM lineitem)
SELECT round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, quantile_cont(x, 0.01) AS p1, quantile_cont(x, 0.05) AS p5, quantile_cont(x, 0.99) AS p99, sum(lead::INT)::BIGINT AS leading_zeros, sum((x = (SELECT min(x) FROM x))::INT)::BIGINT AS at_min FROM x""")
def profile_moments(spark, sf_dir):
    df = _t(spark, sf_dir, "lineitem").selectExpr("case when l_orderkey % 97 = 0 then '5000' when l_orderkey % 89 = 0 then '0' when l_orderkey % 83 = 0 then '-3' when l_orderkey % 10 = 0 and l_quantity < 10 then concat('0', cast(l_quantity as string)) else cast(l_quantity as string) end as x")
    return P.numeric_profile(df, "x").select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "p1", "p5", "p99", "leading_zeros", "at_min")


@_query(_STATS + """, n AS (SELECT count(*) AS n, (SELECT count(*) FROM res WHERE gone) AS gone FROM res)
SELECT rule_id, n * CASE WHEN rule_id IN ('TRIM', 'TOKEN') THEN 2 ELSE 1 END AS checked FROM st, n""")
def rule_checked(spark, sf_dir):
    return E.rule_statistics(_segments(spark, sf_dir)).select("rule_id", "checked")


@_query("""WITH r AS (SELECT CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_returnflag END AS flag, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_linestatus END AS st FROM lineitem)
SELECT 'IF' AS rule_id, sum(coalesce(st = 'O', false)::INT)::BIGINT AS checked, sum((coalesce(st = 'O', false) AND flag IS NULL)::INT)::BIGINT AS detected FROM r
UNION ALL SELECT 'NOT', sum((NOT coalesce(st = 'O', false))::INT)::BIGINT, sum((NOT coalesce(st = 'O', false) AND flag IS NULL)::INT)::BIGINT FROM r
UNION ALL SELECT 'ALL', count(*), sum((flag IS NULL)::INT)::BIGINT FROM r""")
def rule_scopes(spark, sf_dir):
    df = _t(spark, sf_dir, "lineitem").selectExpr("concat('R', l_orderkey, '-', l_linenumber) as record_id", "cast(l_orderkey * 10 + l_linenumber as bigint) as row_no", "case when l_orderkey % 9 = 0 then null else l_returnflag end as flag", "case when l_orderkey % 7 = 0 then null else l_linestatus end as st")
    is_o = {"column": "st", "equals": "O"}
    rules = [{"id": i, "type": "not_null", "column": "flag", "when": w} for i, w in (("IF", is_o), ("NOT", {"not": is_o}), ("ALL", None))]
    return E.rule_statistics(_checked(df, _registry({"flag": {}, "st": {}}, *rules))).select("rule_id", "checked", "detected")


@_query(_STATS + """, n AS (SELECT count(*) AS n FROM res)
SELECT 'run' AS run_id, 1 AS round, 'validation' AS round_type, rule_id, dimension, n * CASE WHEN rule_id IN ('TRIM', 'TOKEN') THEN 2 ELSE 1 END AS checked, remediated + unresolved AS failed, remediated AS repaired, unresolved FROM st, n""")
def rule_table(spark, sf_dir):
    return M.rule_results(E.rule_statistics(_segments(spark, sf_dir)), "run", 1).select("run_id", "round", "round_type", "rule_id", "dimension", "checked", "failed", "repaired", "unresolved")


@_query(f"""WITH {_SEGMENT_SQL} SELECT record_id, "column", problem, "group" FROM (
SELECT record_id, 'seg' AS "column", 'Seg "' || seg3 || '" is not one of the accepted values' AS problem, 'Seg not an accepted value' AS "group" FROM res WHERE bad
UNION ALL SELECT record_id, 'seg', 'Seg is missing', 'Missing seg' FROM res WHERE gone
UNION ALL SELECT record_id, 'name', 'Name "' || name1 || '" is not written correctly', 'Name written incorrectly' FROM res WHERE badname)""")
def plain_wording(spark, sf_dir):
    v = _segments(spark, sf_dir)
    return W.with_groups(W.problem_text(v.errors, v.registry, lambda r: E.error_column(r, v.registry)), v.registry).select("record_id", "column", "problem", "group")


@_query(f"""WITH {_SEGMENT_SQL} SELECT 'Seg not an accepted value' AS "group", count(*) AS records FROM res WHERE bad UNION ALL SELECT 'Missing seg', count(*) FROM res WHERE gone UNION ALL SELECT 'Name written incorrectly', count(*) FROM res WHERE badname""")
def records_by_group(spark, sf_dir):
    v = _segments(spark, sf_dir)
    return W.records_by_group(v.errors, v.registry)


@_query(f"WITH {_SEGMENT_SQL} SELECT record_id, 'seg' AS columns, 1::BIGINT AS n FROM res WHERE gone")
def missing_fields(spark, sf_dir):
    return W.missing_fields(_segments(spark, sf_dir).errors).withColumn("columns", F.concat_ws(",", "columns"))


@_query("""WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'Customer#000000007' WHEN o_orderkey % 11 = 0 THEN 'Nobody#' || o_orderkey WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN upper('Customer#' || lpad(o_custkey::VARCHAR, 9, '0')) ELSE 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') END AS v FROM orders)
SELECT 'R' || k AS record_id, coalesce(c_name, v) AS name, CASE WHEN v IS NOT NULL AND c_name IS NULL THEN 'REF' ELSE '' END AS dq_warnings, CASE WHEN v <> c_name THEN 'remediated' WHEN v IS NOT NULL AND c_name IS NULL THEN 'not_fixed' END AS outcome
FROM r LEFT JOIN customer ON lower(v) = lower(c_name)""")
def reference_table(spark, sf_dir):
    """A lookup in a table with a row for each customer, and a third of all rows with one value."""
    name = "concat('Customer#', lpad(cast(o_custkey as string), 9, '0'))"
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", name=f"case when o_orderkey % 3 = 0 then 'Customer#000000007' when o_orderkey % 11 = 0 then concat('Nobody#', o_orderkey) when o_orderkey % 13 = 0 then null when o_orderkey % 7 = 0 then upper({name}) else {name} end")
    place = {"path": f"{sf_dir}/customer.parquet", "column": "c_name", "format": "parquet"}
    v = E.validate(df, _registry({"name": {}}, {"id": "REF", "type": "reference", "column": "name", "reference": place, "severity": "warning", "remediation": {"action": "canonicalize"}}), RUN_DATE)
    return v.rows.select("record_id", "name", "dq_warnings", F.get("edits", F.lit(0))["outcome"].alias("outcome"))



# Documents of two rounds for each nation as a run: its customers are processed, every fourth is quarantined, and in round 2 those of each remainder go one way.
_RUNS_SQL = """c AS (SELECT 'N' || c_nationkey AS run_id, c_custkey AS k FROM customer),
t AS (SELECT run_id, count(*) AS processed, count(*) FILTER (k % 4 <> 0) AS valid, count(*) FILTER (k % 4 = 0) AS quarantined, count(*) FILTER (k % 4 = 0 AND k % 5 IN (0, 1)) AS resolved, count(*) FILTER (k % 4 = 0 AND k % 5 = 0) AS manually_fixed,
  count(*) FILTER (k % 4 = 0 AND k % 5 = 1 AND k % 3 = 0) AS confirmed, count(*) FILTER (k % 4 = 0 AND k % 5 = 2) AS discarded, count(*) FILTER (k % 4 = 0 AND k % 5 = 3) AS manual_review, count(*) FILTER (k % 4 = 0 AND k % 5 = 4) AS open_after FROM c GROUP BY 1)"""


def _run_documents(spark, sf_dir):
    """(results, resolved, log, records) as a run's folders hold them, the documents parsed from JSON."""
    c = _t(spark, sf_dir, "customer").selectExpr("concat('N', c_nationkey) as run_id", "c_custkey as k", "concat('R', c_custkey) as record_id")
    n = lambda when: f"count_if({when})"
    sums = c.groupBy("run_id").agg(*[F.expr(n(w)).alias(a) for a, w in {"processed": "true", "accepted": "k % 4 <> 0", "quarantined": "k % 4 = 0", "resolved": "k % 4 = 0 and k % 5 in (0, 1)", "discarded": "k % 4 = 0 and k % 5 = 2", "manual_review_required": "k % 4 = 0 and k % 5 = 3", "open_after": "k % 4 = 0 and k % 5 = 4"}.items()])
    rules = "array(named_struct('rule_id', 'Q', 'type', 'not_null', 'dimension', 'validity', 'severity', 'critical', 'checked', {}, 'detected', {}, 'remediated', 0, 'unresolved', {}))"
    first = sums.selectExpr("run_id", "1 as round", f"to_json(struct(map('processed', processed, 'accepted', accepted, 'quarantined', quarantined) as counts, {rules.format('processed', 'quarantined', 'quarantined')} as rules)) as j")
    left = "manual_review_required + open_after"
    second = sums.selectExpr("run_id", "2 as round", f"to_json(struct(1 as revalidated_round, map('resolved', resolved, 'discarded', discarded, 'manual_review_required', manual_review_required, 'open_after', open_after) as counts, {rules.format('quarantined', left, left)} as rules)) as j")
    results = first.unionByName(second).select("run_id", "round", F.from_json("j", M.RESULT).alias("d")).select("run_id", "round", "d.revalidated_round", "d.counts", "d.rules")
    held = c.filter("k % 4 = 0")
    lines = held.filter("k % 5 < 2 and (k % 5 = 0 or k % 3 = 0)").selectExpr("run_id", "1 as round", "record_id", "if(k % 5 = 0, 'name', '') as column", "if(k % 5 = 0, 'FIX', 'ACCEPT') as action", "1 as batch", "k as seq")
    return results, held.filter("k % 5 < 2").selectExpr("run_id", "1 as round", "record_id"), lines, held


@_query(f"""WITH {_RUNS_SQL}, s AS (SELECT *, round((valid + resolved)::DOUBLE / processed, 6) AS final_score FROM t)
SELECT run_id, 1 AS round, 0::HUGEINT AS resolved, 0::HUGEINT AS manually_fixed, 0::HUGEINT AS confirmed, 0::HUGEINT AS discarded, quarantined AS open, valid, quarantined, quarantined AS unresolved, round(valid::DOUBLE / processed, 6) AS final_score, true AS balanced FROM t
UNION ALL SELECT run_id, 2, resolved, manually_fixed, confirmed, discarded, open_after, valid, quarantined, open_after + manual_review, final_score, resolved + discarded + open_after + manual_review = quarantined FROM s""")
def metrics_of_runs(spark, sf_dir):
    results, resolved, log, _ = _run_documents(spark, sf_dir)
    return M.runs_funnel(results, resolved, log).select("run_id", "round", "resolved", "manually_fixed", "confirmed", "discarded", "open", "valid", "quarantined", "unresolved", "final_score", "balanced")


@_query(f"""WITH {_RUNS_SQL} SELECT run_id, 1 AS round, 'validation' AS round_type, 'Q' AS rule_id, processed AS checked, quarantined AS failed, quarantined AS unresolved FROM t
UNION ALL SELECT run_id, 2, 'revalidation', 'Q', quarantined, manual_review + open_after, manual_review + open_after FROM t""")
def rules_of_runs(spark, sf_dir):
    return M.runs_rules(_run_documents(spark, sf_dir)[0]).select("run_id", "round", "round_type", "rule_id", "checked", "failed", "unresolved")


@_query("""WITH c AS (SELECT 'N' || c_nationkey AS run_id, 'R' || c_custkey AS record_id, c_custkey AS k FROM customer WHERE c_custkey % 4 = 0)
SELECT run_id, record_id, CASE WHEN k % 5 = 0 THEN 'FIX' ELSE 'ACCEPT' END AS action, 'manual' AS correction_type, CASE WHEN k % 7 = 0 THEN 'failed_again' ELSE 'resolved' END AS outcome FROM c WHERE k % 5 = 0 OR (k % 5 = 1 AND k % 3 = 0)
UNION ALL SELECT run_id, record_id, 'trim', 'automatic', 'remediated' FROM c WHERE k % 8 = 0""")
def corrections_of_runs(spark, sf_dir):
    results, _, log, held = _run_documents(spark, sf_dir)
    history = held.selectExpr("run_id", "record_id", "if(k % 7 = 0, 'OPEN', 'RESOLVED') as status", "2 as seq")
    audit = held.filter("k % 8 = 0").selectExpr("run_id", "record_id", "1 as round", "'name' as column", "' x' as original_value", "'x' as cleaned_value", "'TRIM' as rule_id", "'trim' as action", "'remediated' as outcome")
    return M.runs_corrections(results, log, history, audit).select("run_id", "record_id", "action", "correction_type", "outcome")



@_query("""WITH e AS (SELECT c_custkey AS k, 'segment' AS "column", CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN lower(c_mktsegment) ELSE c_mktsegment END AS value FROM customer
UNION ALL SELECT c_custkey, 'code', CASE WHEN c_custkey % 6 = 0 THEN c_name || 'x' ELSE c_name END FROM customer UNION ALL SELECT c_custkey, 'size', CASE c_custkey % 7 WHEN 0 THEN '7.5' WHEN 1 THEN 'many' ELSE (c_custkey % 60)::VARCHAR END FROM customer)
SELECT k, "column", value, CASE "column" WHEN 'segment' THEN CASE WHEN value = '' THEN 'Segment cannot be empty.' WHEN value NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN 'Choose one of the listed values for segment.' END
  WHEN 'code' THEN CASE WHEN NOT regexp_full_match(value, 'Customer#[0-9]{9}') THEN 'Code is not written the expected way. For example: Customer#000000001' END
  ELSE CASE WHEN try_cast(value AS DOUBLE) IS NULL OR try_cast(value AS DOUBLE) % 1 <> 0 OR try_cast(value AS DOUBLE) NOT BETWEEN 1 AND 50 THEN 'Enter a whole number between 1 and 50.' END END AS mistake FROM e""")
def typed_entries(spark, sf_dir):
    registry = _registry({"segment": {"nullable": False, "allowed_values": SEGMENTS}, "code": {"pattern": "Customer#[0-9]{9}"}, "size": {"type": "integer", "min": 1, "max": 50}})
    texts = "stack(3, 'segment', case c_custkey % 5 when 0 then '' when 1 then lower(c_mktsegment) else c_mktsegment end, 'code', if(c_custkey % 6 = 0, concat(c_name, 'x'), c_name), 'size', case c_custkey % 7 when 0 then '7.5' when 1 then 'many' else cast(c_custkey % 60 as string) end) as (column, value)"
    return W.judge_entries(_t(spark, sf_dir, "customer").selectExpr("c_custkey as k", texts), registry, RUN_DATE, {"code": "Customer#000000001"})


_ODD = """WITH k AS (SELECT o_orderkey AS k FROM orders), v AS (
  SELECT 'amount' AS "column", CASE k % 40 WHEN 0 THEN 'EGP ' || (k % 30)::VARCHAR WHEN 1 THEN 'n/a' WHEN 2 THEN 'lots' WHEN 3 THEN '0' || (k % 50)::VARCHAR ELSE (k % 100)::VARCHAR END AS value FROM k
  UNION ALL SELECT 'at', (k % 26)::VARCHAR || ':' || lpad((k % 63)::VARCHAR, 2, '0') FROM k
  UNION ALL SELECT 'mail', CASE WHEN k % 33 = 0 THEN 'x' ELSE 'a' || (k % 5)::VARCHAR || '@b.co' END FROM k
  UNION ALL SELECT 'ccy', CASE WHEN k % 50 = 0 THEN 'XXX' WHEN k % 49 = 0 THEN 'eur' ELSE 'EUR' END FROM k
  UNION ALL SELECT 'label', CASE WHEN k % 21 = 0 THEN ' Other' ELSE 'A' || (k % 3)::VARCHAR END FROM k
  UNION ALL SELECT 'code', CASE WHEN k % 10 = 0 THEN 'ab-' || (k % 90 + 10)::VARCHAR ELSE 'AB' || (k % 900 + 100)::VARCHAR END FROM k)"""
_ODD_KINDS = {"amount": "float", "at": "time", "mail": "email", "ccy": "currency_code", "label": "categorical", "code": "identifier"}


def _odd_counts(spark, sf_dir):
    """Columns of several kinds with values that are not of them, counted."""
    texts = {
        "amount": "case o_orderkey % 40 when 0 then concat('EGP ', o_orderkey % 30) when 1 then 'n/a' when 2 then 'lots' when 3 then concat('0', o_orderkey % 50) else cast(o_orderkey % 100 as string) end",
        "at": "concat(o_orderkey % 26, ':', lpad(cast(o_orderkey % 63 as string), 2, '0'))", "mail": "if(o_orderkey % 33 = 0, 'x', concat('a', o_orderkey % 5, '@b.co'))",
        "ccy": "case when o_orderkey % 50 = 0 then 'XXX' when o_orderkey % 49 = 0 then 'eur' else 'EUR' end", "label": "if(o_orderkey % 21 = 0, ' Other', concat('A', o_orderkey % 3))",
        "code": "if(o_orderkey % 10 = 0, concat('ab-', o_orderkey % 90 + 10), concat('AB', o_orderkey % 900 + 100))",
    }
    return P.value_counts(_t(spark, sf_dir, "orders").selectExpr(*[f"{x} as {c}" for c, x in texts.items()]))


@_query(_ODD + """, f AS (
  SELECT "column", value, unnest([
    CASE WHEN value = 'n/a' THEN 'NULL_TOKENS' END, CASE WHEN value LIKE 'EGP%' OR value = 'lots' THEN 'MIXED_TYPES' END, CASE WHEN value LIKE 'EGP%' THEN 'NUMBER_FORMAT_VARIANTS' END,
    CASE WHEN "column" = 'amount' AND regexp_matches(value, '^0[0-9]') THEN 'LEADING_ZEROS' END,
    CASE WHEN "column" = 'at' AND (split_part(value, ':', 1)::INT > 23 OR split_part(value, ':', 2)::INT > 59) THEN 'OUT_OF_RANGE_TIMES' END,
    CASE WHEN value IN ('x', 'eur') THEN 'INVALID_FORMAT' END, CASE WHEN value = 'XXX' THEN 'PLACEHOLDER_CODES' END, CASE WHEN value = ' Other' THEN 'WHITESPACE' END, CASE WHEN value = ' Other' THEN 'GENERIC_VALUES' END]) AS code FROM v),
c AS (SELECT "column", code, value, count(*) AS n FROM f WHERE code IS NOT NULL GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY "column", code ORDER BY n DESC, value) AS r FROM c)
SELECT "column", code, sum(n)::BIGINT AS rows, count(*) AS distinct_values, bool_or(code = 'OUT_OF_RANGE_TIMES' AND value LIKE '24:00%') AS midnight, string_agg(value || '=' || n::VARCHAR, ';' ORDER BY r) FILTER (WHERE r <= 5) AS examples FROM o GROUP BY 1, 2""")
def profile_problems(spark, sf_dir):
    found = FI.summed(FI.problems(_odd_counts(spark, sf_dir), _ODD_KINDS))
    examples = F.array_join(F.transform("top", lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string"))), ";")
    return found.select("column", "code", "rows", F.col("values").alias("distinct_values"), "midnight", examples.alias("examples"))


@_query(_ODD + """, w AS (SELECT "column", value, regexp_replace(regexp_replace(regexp_replace(value, '[0-9]', '9', 'g'), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g') AS s FROM v WHERE value <> 'n/a' AND ("column" IN ('at', 'code') OR value LIKE 'EGP%' OR value = 'lots')),
l AS (SELECT "column", CASE WHEN "column" = 'code' THEN s ELSE regexp_replace(regexp_replace(regexp_replace(s, '9+', '9', 'g'), 'A+', 'A', 'g'), 'a+', 'a', 'g') END AS layout, count(*) AS n, min(value) AS example FROM w GROUP BY ALL)
SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY n DESC, layout) AS rank, layout, n, example, count(*) OVER (PARTITION BY "column") AS layouts FROM l""")
def profile_layouts(spark, sf_dir):
    return FI.layouts(_odd_counts(spark, sf_dir), _ODD_KINDS).drop("of")


@_query("SELECT 'ING_ROW_' || lpad(row_number() OVER (ORDER BY c_custkey)::VARCHAR, greatest(6, length(row_number() OVER (ORDER BY c_custkey)::VARCHAR))::INT, '0') AS record_id, row_number() OVER (ORDER BY c_custkey) AS row_no, c_custkey::VARCHAR AS c_custkey FROM customer")
def record_ids(spark, sf_dir):
    df = _t(spark, sf_dir, "customer").orderBy("c_custkey").selectExpr("cast(c_custkey as string) as c_custkey")
    return with_record_ids(numbered(df), "ING_ROW_", 6)


@_query("""WITH r AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%d/%m/%Y') AS d, CASE WHEN o_orderkey % 5 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m') END AS m FROM orders)
SELECT 'R' || k AS record_id, strftime(strptime(d, '%d/%m/%Y'), '%d.%m.%Y') AS d, m FROM r""")
def canonical_text(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "orders"), "o_orderkey", d="date_format(o_orderdate, 'dd/MM/yyyy')", m="case when o_orderkey % 5 = 0 then 'soon' else date_format(o_orderdate, 'yyyy-MM') end")
    registry = load_registry({"columns": {"d": {"type": "date", "source_format": "%d/%m/%Y"}, "m": {"type": "year_month"}}, "dataset": {"canonical_formats": {"date": "%d.%m.%Y"}}}, {"schema_checks": {"columns": {c: {"type": {"enabled": False}} for c in ("d", "m")}}, "rules": []})
    return _checked(df, registry).valid.select("record_id", "d", "m")


@_query("""SELECT 'R' || c_custkey AS record_id, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS seg, CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS nulled FROM customer""")
def nulled_in_accepted(spark, sf_dir):
    df = _rows(_t(spark, sf_dir, "customer"), "c_custkey", seg="case when c_custkey % 4 = 0 then 'NONE SUCH' else c_mktsegment end")
    v = _checked(df, _registry({"seg": {}}, {"id": "SEG", "type": "allowed_values", "column": "seg", "values": SEGMENTS, "severity": "warning", "on_accept": "set_null"}))
    return v.rows.select("record_id", "seg", F.size(F.filter("edits", lambda e: e["outcome"] == "nullified_in_accepted")).alias("nulled"))


@_query("""SELECT event_id AS seq, user_id AS record_id, event_type AS action FROM events ORDER BY event_id DESC LIMIT 200""")
def newest_lines(spark, sf_dir):
    return M.newest_lines(_t(spark, sf_dir, "events").selectExpr("event_id as seq", "user_id as record_id", "event_type as action"))


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
