"""Everyday words for errors and fields, from the registry: sentences and group titles as joins with small tables of the registry's own size, and
how a value is entered, with a check of typed values by the predicates of the registry's rules."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions.temporal import ISO, resolve_bound
from dqloom.operators.detect import detect
from dqloom.plans.registry import DECLARED, ERRORS, Registry, Rule, declared_rules

# Words that are written in capitals.
CAPITALS = {"id": "ID", "egp": "EGP", "iso": "ISO"}
# What a column type is called.
TYPE_WORDS = {"date": "date (YYYY-MM-DD)", "time": "time (HH:MM:SS)", "year_month": "month (YYYY-MM)", "integer": "whole number", "decimal": "number", "boolean": "yes/no value"}
# Examples of column types whose values are typed as text.
EXAMPLES = {"time": "14:30:00", "year_month": "2024-05"}
# How values of a type are entered, where not as text.
ENTRY_KINDS = {"date": "date", "integer": "number", "decimal": "number"}
# By rule type, what is said about a typed value that fails; {e} is the example.
MISTAKES = {
    "not_null": "{L} cannot be empty.", "allowed_values": "Choose one of the listed values for {l}.", "type": "Enter a {t}{b}.", "range": "Enter a {t}{b}.", "pattern": "{L} is not written the expected way.{e}",
}
MUST_BE = "Must be {}."
# What each automatic repair did.
REPAIR_WORDS = {
    "trim": "Removed extra spaces", "set_null": "Placeholder emptied", "canonicalize": "Standard spelling", "parse_number": "Number cleaned up", "parse_date": "Date put in YYYY-MM-DD", "parse_time": "Time put in 24-hour format",
    "reformat_id": "ID put in the standard format", "replace": "Known mistake corrected", "derive": "Recalculated from other fields", "swap_day_month": "Day and month swapped",
}
# By error category, the sentence and the title of its group. {L} and {l} are the column's label at the start of a sentence and inside one,
# {v} the quoted value, {t} the word for the column's type, {b} the column's bounds.
SENTENCES = {
    "null": "{L} is missing", "duplicate": "Another record has the same {l}{v}", "range_violation": "{L}{v} must be {b}", "format_violation": "{L}{v} is not written correctly", "domain_violation": "{L}{v} is not one of the accepted values",
    "type_mismatch": "{L}{v} is not a valid {t}", "referential_integrity": "{L}{v} is not a known {l}", "consistency": "Other records with the same {l}{v} show different details",
}
WHOLE_COPY, NO_BOUNDS = "This record is an exact copy of another record", "{L}{v} is out of range"
REVIEW = " values were changed automatically; please check that the changes are right"
TITLES = {
    "null": "Missing {l}", "duplicate": "Duplicate {l}", "range_violation": "{L} out of range", "format_violation": "{L} written incorrectly", "domain_violation": "{L} not an accepted value", "type_mismatch": "{L} not a valid {t}",
    "referential_integrity": "Unknown {l}", "auto_fix_review": "Many values changed automatically", "consistency": "Details differ for the same {l}",
}
ENTITY_TITLE, COPIES_TITLE, OTHER_TITLE, REST_TITLE = "{E} details differ between records", "Duplicate records", "Other problems with {l}", "Other problems"


def label(column: str | None) -> str:
    """A column's name for people."""
    text = " ".join(CAPITALS.get(w, w) for w in column.split("_")) if column else "record"
    return text[:1].upper() + text[1:]


def _inside(text: str) -> str:
    return text[:1].lower() + text[1:]


def bounds(spec: dict) -> str:
    low, high = spec.get("min"), spec.get("max")
    if low is not None and high is not None:
        return f"between {low} and {high}"
    ends = [(low, "above" if spec.get("exclusive_min") else "at least"), (high, "below" if spec.get("exclusive_max") else "at most")]
    return next((f"{words} {end}" for end, words in ends if end is not None), "")


def _filled(text: str, registry: Registry, column: str | None, **more: str) -> str:
    spec = registry.columns.get(column or "", {})
    words = {"L": label(column), "l": _inside(label(column)), "t": TYPE_WORDS.get(spec.get("type", ""), "value"), "b": bounds(spec), **more}
    return re.sub(r"\{(\w)\}", lambda m: words.get(m[1], m[0]), text)


def _sentence(rule: Rule, registry: Registry, column: str | None) -> str:
    """The rule's sentence with {v} still open."""
    if rule.type == "duplicate_rows":
        text = WHOLE_COPY
    elif rule.error_category not in SENTENCES:
        return rule.name or rule.message
    else:
        text = SENTENCES[rule.error_category]
        if rule.error_category == "range_violation" and not bounds(registry.columns.get(column or "", {})):
            text = NO_BOUNDS
    text = _filled(text, registry, column)
    return f"{text} ({rule.name})" if rule.origin != "schema" and rule.name and rule.name != rule.id else text


def problem_text(errors: DataFrame, registry: Registry, column_of) -> DataFrame:
    """errors with ``problem``, one sentence in everyday words. column_of: the column that a rule's errors name."""
    rows = []
    for rule in registry.rules:
        before, value, after = _sentence(rule, registry, column_of(rule)).partition("{v}")
        rows.append((rule.id, before, bool(value), after, rule.type == "auto_fix_review"))
    facts = errors.sparkSession.createDataFrame(rows, "rule_id string, before string, quoted boolean, after string, review boolean")
    value = F.when(F.col("quoted") & F.col("value").isNotNull(), F.concat(F.lit(' "'), F.col("value"), F.lit('"'))).otherwise("")
    text = F.when(F.col("review"), F.concat(F.coalesce(F.substring_index("value", " ", 1), F.lit("Several")), F.lit(REVIEW))).otherwise(F.concat("before", value, "after"))
    return errors.join(F.broadcast(facts), "rule_id", "left").withColumn("problem", F.coalesce(text, "message")).select(*errors.columns, "problem")  # as many rows as rules


def group_titles(registry: Registry) -> list[tuple[str, str | None, str]]:
    """(category, column or None, title) for every category of errors and column of the registry."""
    entities = {e["key"]: name for name, e in (registry.schema.get("entities") or {}).items()}
    out = []
    for category in dict.fromkeys(c for _, c, _ in ERRORS.values()):
        for column in (*registry.columns, None):
            text = TITLES.get(category, OTHER_TITLE if column else REST_TITLE)
            if category == "consistency" and column in entities:
                text = ENTITY_TITLE
            if category == "duplicate" and not column:
                text = COPIES_TITLE
            out.append((category, column, _filled(text, registry, column, E=label(entities.get(column or "")))))
    return out


def with_groups(errors: DataFrame, registry: Registry) -> DataFrame:
    """errors with ``group``, the plain title of the group an error belongs to."""
    titles = errors.sparkSession.createDataFrame([(c, k, t) for c, k, t in group_titles(registry)], "c string, k string, group string")
    on = (F.col("error_category") == F.col("c")) & F.col("column").eqNullSafe(F.col("k"))
    return errors.join(F.broadcast(titles), on, "left").select(*errors.columns, "group")  # categories times columns


def records_by_group(errors: DataFrame, registry: Registry) -> DataFrame:
    """(group, records): how many different records have an error of each group; the largest first."""
    return with_groups(errors, registry).groupBy("group").agg(F.countDistinct("record_id").alias("records")).orderBy(F.desc("records"), "group")


def missing_fields(errors: DataFrame) -> DataFrame:
    """By record, the columns that must be filled in: (record_id, columns, n), columns in order."""
    gone = errors.filter("error_category = 'null' and column is not null").select("record_id", "column").distinct()
    return gone.groupBy("record_id").agg(F.array_sort(F.collect_list("column")).alias("columns"), F.count("*").alias("n"))  # at most the table's columns


def repair_words(action: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in REPAIR_WORDS.items() for x in kv]), action), action)


def entry_rules(registry: Registry) -> dict[str, list[Rule]]:
    """By column, the rules that a typed value is judged by: what the schema declares of single values, also where a run leaves the check out.
    Lookups and uniqueness need other rows and stay with the validation."""
    alone = {c: {k: v for k, v in spec.items() if k not in ("reference", "unique")} for c, spec in registry.columns.items()}
    out: dict[str, list[Rule]] = {c: [] for c in alone}
    for rule in declared_rules({"columns": alone}, {}, lambda path, column: []):
        out[rule.column].append(rule)
    return out


def entry_forms(registry: Registry, run_date: dt.date, examples: dict[str, str] | None = None) -> dict[str, dict]:
    """By column, how its value is entered: label, help, whether it is required, an example, and under ``checks`` the entries of each of its rules
    with bounds such as today resolved. The kind follows from them."""
    out = {}
    for column, rules in entry_rules(registry).items():
        spec, checks = registry.columns[column], {r.type: {k: r[k] for k in DECLARED[r.type](registry.columns[column])} for r in rules}
        of_type = spec.get("type", "string")
        if "range" in checks and of_type in ISO:
            checks["range"] |= {k: resolve_bound(checks["range"][k], of_type, run_date) for k in ("min", "max") if k in checks["range"]}
        said = [spec["description"]] if spec.get("description") else []
        out[column] = {
            "label": label(column), "kind": "choice" if "allowed_values" in checks else ENTRY_KINDS.get(of_type, "text"), "required": "not_null" in checks,
            "help": " ".join(said + ([MUST_BE.format(bounds(spec))] if bounds(spec) else [])), "example": (examples or {}).get(column) or EXAMPLES.get(of_type), "checks": checks,
        }
    return out


def judge_entries(entries: DataFrame, registry: Registry, run_date: dt.date, examples: dict[str, str] | None = None) -> DataFrame:
    """entries (column, value, ...) with ``mistake``: what the first failing rule of the column says about the value; null if none fails, also for a
    column that the registry does not know. An empty value is a missing one. The rules' own predicates judge, one projection for all columns."""
    value = F.nullif(F.col("value"), F.lit(""))
    forms, judged = entry_forms(registry, run_date, examples), []
    for column, rules in entry_rules(registry).items():
        said = {"e": f" For example: {forms[column]['example']}" if forms[column]["example"] else "", "b": f" {bounds(registry.columns[column])}".rstrip()}
        texts = {r.type: MISTAKES["pattern" if r.type == "type" and registry.columns[column]["type"] in EXAMPLES else r.type] for r in rules}
        found = [F.when(detect(r, registry, run_date, lambda _: value), _filled(texts[r.type], registry, column, **said)) for r in rules]
        if found:
            judged.append(F.when(F.col("column") == column, F.coalesce(*found)))
    return entries.withColumn("mistake", F.coalesce(*judged, F.lit(None).cast("string")))
