"""Row-local detection: for each rule type, a predicate that is true where a row fails."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqloom.functions.expression import compile_expression
from dqloom.functions.numbers import number_text, round_half_even
from dqloom.functions.temporal import plus, resolve_bound, write
from dqloom.functions.text import fold, full_match, mapped, strip
from dqloom.operators.typed import view
from dqloom.plans.conditions import condition
from dqloom.plans.registry import Registry, Rule, leaves

Columns = Callable[[str], Column]
_COMPARE = {"==": "__eq__", "!=": "__ne__", "<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}
#: Rule types that look at one row only.
ROW_LOCAL = frozenset(("not_null", "is_null", "type", "pattern", "allowed_values", "reference", "expression", "range", "compare", "derived", "trim_whitespace", "null_tokens", "generate"))

#: A lookup list of more values is joined as a table.
LIST_VALUES = 10_000


def by_join(rule: Rule) -> bool:
    """Whether the rule looks its values up in a table."""
    return rule.type == "reference" and bool(rule.get("table") or len(rule.get("values") or ()) > LIST_VALUES)


def alone(rule: Rule) -> bool:
    """Whether a projection of each row is all that the rule needs."""
    return rule.type in ROW_LOCAL and not by_join(rule)


def out_of_range(value: Column, params: dict, kind: str, run_date: dt.date) -> Column:
    low, high = resolve_bound(params.get("min"), kind, run_date), resolve_bound(params.get("max"), kind, run_date)
    fail = F.lit(False)
    if low is not None:
        fail = fail | (value <= F.lit(low) if params.get("exclusive_min") else value < F.lit(low))
    if high is not None:
        fail = fail | (value >= F.lit(high) if params.get("exclusive_max") else value > F.lit(high))
    return fail


def derived_text(rule: Rule, see: Columns) -> Column:
    return write(see(rule["source"]), rule["format"])


def generated_value(rule: Rule, registry: Registry, column: Columns, see: Columns | None = None) -> Column:
    """Text of a generated column; null where it cannot be computed."""
    p, see = rule, see or view(registry, column)
    if p["method"] == "convert_currency":
        amount = see(p["amount"])
        rate = mapped(column(p["currency"]), {str(k): str(float(v)) for k, v in p["rates"].items()}).cast("double")
        return number_text(round_half_even(amount * rate, int(p.get("decimals", 2))))
    out = F.lit(str(p["default"])) if "default" in p else F.lit(None).cast("string")
    for case in reversed(p["cases"]):
        out = F.when(condition(case.get("when"), column), F.lit(str(case["value"]))).otherwise(out)
    return out


def detect(rule: Rule, registry: Registry, run_date: dt.date, column: Columns = F.col, on: str | None = None, see: Columns | None = None) -> Column:
    """Where the rule fails, not yet limited to its scope; two-valued. on: the column, for rules over several. see: typed views of columns."""
    p, see, name = rule, see or view(registry, column), on or rule.column
    c = column(name) if name else None
    kind = rule.type
    if kind == "not_null":
        return c.isNull()
    if kind == "is_null":
        return c.isNotNull()
    if kind == "type":
        return c.isNotNull() & see(name).isNull()
    if kind == "pattern":
        fail = ~full_match(c, p["pattern"])
    elif kind in ("allowed_values", "reference"):
        fail = ~c.isin([str(v) for v in p["values"]])
    elif kind == "expression":
        judged = F.lit(True)
        for x in rule.columns:
            judged = judged & see(x).isNotNull()
        return judged & ~F.coalesce(compile_expression(p["expression"], see), F.lit(False))
    elif kind == "range":
        fail = out_of_range(see(name), p, registry.columns[name].get("type", "string"), run_date)
    elif kind == "compare":
        fail = ~getattr(see(p["left"]), _COMPARE[p["operator"]])(plus(see(p["right"]), p.get("offset")))
    elif kind == "derived":
        expected = derived_text(rule, see)
        return expected.isNotNull() & ~F.coalesce(c == expected, F.lit(False))
    elif kind == "trim_whitespace":
        fail = c != strip(c)
    elif kind == "null_tokens":
        fail = fold(strip(c)).isin(registry.null_tokens) if registry.null_tokens else F.lit(False)
    elif kind == "generate":
        return generated_value(rule, registry, column, see).isNull()
    else:
        raise ValueError(f"{kind} is no row-local rule type")
    return F.coalesce(fail, F.lit(False))


def reads(rule: Rule, on: str | None = None) -> set[str]:
    """Columns that the rule's detection or repair looks at; on: the one column of a rule over several."""
    if rule.type in ("trim_whitespace", "null_tokens"):
        return {on} | {leaf["column"] for leaf in leaves(rule.when)}
    return rule.read_columns()
