"""Repairs: for each action, the new text of a value and whether the action has an answer for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqloom.functions.numbers import find_number, number_text, to_number
from dqloom.functions.temporal import ISO, parse, repair_time, write
from dqloom.functions.templates import format_value
from dqloom.functions.text import blank_to_null, comparison_key, comparison_key_of, java_replacement, mapped, strip
from dqloom.operators.detect import Columns, derived_text
from dqloom.operators.typed import view
from dqloom.plans.registry import Registry, Rule


def null() -> Column:
    return F.lit(None).cast("string")


def repair(rule: Rule, registry: Registry, column: Columns = F.col, on: str | None = None, see: Columns | None = None, let: Callable[[Column], Column] = lambda c: c) -> tuple[Column, Column]:
    """(new value, changed) for a failing value; where changed is false the old one stays. see: typed views of columns; let: makes a column of
    an intermediate value that is used more than once."""
    see = see or view(registry, column)
    options, name = rule.remediation or {}, on or rule.column
    action, c, spec = options["action"], column(on or rule.column), registry.columns.get(on or rule.column, {})
    if action == "trim":
        new = blank_to_null(strip(c))
        return new, F.coalesce(new != c, F.lit(True))
    if action == "set_null":
        if "values" not in options:
            return null(), F.lit(True)
        if spec.get("type") in ("integer", "decimal"):
            hit = to_number(c).isin([float(v) for v in options["values"]])
        else:
            hit = comparison_key(c).isin([comparison_key_of(v) for v in options["values"]])
        return null(), F.coalesce(hit, F.lit(False))
    if action == "canonicalize":
        values = rule.get("values") or spec.get("allowed_values") or []
        table = {comparison_key_of(v): str(v) for v in values} | {comparison_key_of(k): str(v) for k, v in (options.get("map") or {}).items()}
        new = mapped(comparison_key(c), table)
        return new, F.coalesce(new != c, F.lit(False))
    if action == "parse_number":
        n = let(find_number(c, let))
        return number_text(n, let), n.isNotNull()
    if action == "parse_date":
        t = let(parse(c, list(options.get("formats") or [])))
        return write(t, ISO["date"]), t.isNotNull()
    if action == "parse_time":
        new = let(repair_time(c))
        return new, new.isNotNull()
    if action == "replace":
        new = c
        for step in options.get("substitutions") or []:
            new = F.regexp_replace(new, step["pattern"], java_replacement(step.get("replace", "")))
        new = blank_to_null(let(strip(new)))
        return new, F.coalesce(new != c, F.lit(True))
    if action == "reformat_id":
        found = []
        for pattern in options.get("patterns") or []:
            ignoring = "(?i)" + pattern
            found.append(F.when(c.rlike(ignoring), F.regexp_extract(c, ignoring, 1)))
        part = F.coalesce(*found) if found else null()
        new = F.when(part.isNotNull(), format_value(options["template"], part))
        return new, new.isNotNull()
    if action == "derive":
        new = derived_text(rule, see)
        return new, new.isNotNull()
    if action == "swap_day_month":
        t = see(rule["source"])
        swapped = F.try_make_timestamp(F.year(t), F.dayofmonth(t), F.month(t), F.lit(0), F.lit(0), F.lit(0))
        fits = write(swapped, rule["format"]) == write(see(name), rule["format"])
        return write(swapped, ISO["date"]), F.coalesce(fits, F.lit(False))
    raise ValueError(f"rule {rule.id}: {action} is no repair of a value")
