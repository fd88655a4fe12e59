"""Templates with one value ({0}, {0:0>7}) as Column, and message templates with named places."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_value(template: str, value: Column) -> Column:
    """A str.format template over one text value: fill, alignment (<, >, ^ with > assumed for zero padding) and width are supported."""
    parts = []
    for literal, field, spec, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if field not in ("", "0"):
                raise ValueError(f"template {template!r} has other fields than {{0}}")
            parts.append(_aligned(value, spec or "", template))
    return F.concat(*parts) if parts else F.lit("")


def _aligned(value: Column, spec: str, template: str) -> Column:
    if not spec or spec == "s":
        return value
    fill, rest = (spec[0], spec[1:]) if len(spec) > 1 and spec[1] in "<>" else (" ", spec)
    side, width = (rest[0], rest[1:]) if rest[:1] in ("<", ">") else ("<", rest)
    width = width.removesuffix("s")
    if not width.isdigit():
        raise ValueError(f"unsupported format {spec!r} in {template!r}")
    pad = (F.lpad if side == ">" else F.rpad)(value, int(width), fill)
    return F.when(F.length(value) < int(width), pad).otherwise(value)  # padding functions also cut


def message_parts(template: str, known: dict[str, str]) -> list[str]:
    """The text before, between and after the places of {value}; known places are filled in, unknown ones stay as written."""
    parts = [""]
    for literal, field, _, _ in string.Formatter().parse(template):
        parts[-1] += literal
        if field == "value":
            parts.append("")
        elif field is not None:
            parts[-1] += str(known.get(field, "{" + field + "}"))
    return parts
