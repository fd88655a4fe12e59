"""Typed views of text columns, by the schema's column type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqloom.functions.numbers import to_number
from dqloom.functions.temporal import ISO, parse, write
from dqloom.plans.registry import Registry


def typed(c: Column, spec: dict) -> Column:
    """The value of text c under a column specification; null where the text is no such value."""
    kind = spec.get("type", "string")
    if kind == "decimal":
        return to_number(c)
    if kind == "integer":
        n = to_number(c)
        return F.when(n % 1 == 0, n)
    if kind == "boolean":
        yes, no = spec.get("true_values", ["true", "1"]), spec.get("false_values", ["false", "0"])
        return F.when(c.isin([str(v) for v in yes]), F.lit(True)).when(c.isin([str(v) for v in no]), F.lit(False))
    if kind in ISO:
        formats = list(dict.fromkeys([*([spec["source_format"]] if spec.get("source_format") else []), ISO[kind]]))
        return parse(c, formats)
    return c


def view(registry: Registry, column: Callable[[str], Column] = F.col) -> Callable[[str], Column]:
    """Typed views by column name."""
    return lambda name: typed(column(name), registry.columns.get(name, {}))


def canonical(c: Column, spec: dict, formats: dict) -> Column:
    """Canonical text of dates and times; other values, and what cannot be read, as they are."""
    kind = spec.get("type", "string")
    if kind not in ISO:
        return c
    return F.coalesce(write(typed(c, spec), formats.get(kind, ISO[kind])), c)
