"""Numbers in text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqloom.functions.text import strip

NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
#: A number inside other text.
_INSIDE = r"([+-]?\d[\d,.\s]*\d|[+-]?\d)"


def to_number(c: Column) -> Column:
    """A finite double, or null. The pattern keeps out what a cast would take as well (``1d``, ``1f``, ``NaN``)."""
    n = F.regexp_extract(c, rf"\A\s*({NUMBER})\s*\z", 1).try_cast("double")
    return F.when(F.abs(n) < float("inf"), n)


def _inline(value: Column) -> Column:
    return value


def number_text(n: Column, let: Callable[[Column], Column] = _inline) -> Column:
    """Plain shortest text: no exponent, no trailing zeros. let: makes a column of an intermediate value that is used more than once."""
    n = let(n)
    decimal = let(n.try_cast("decimal(38,10)"))
    text = let(F.when(decimal.isNotNull() & ((n == 0) | (F.abs(n) >= 1e-9)), decimal.cast("string")).otherwise(n.cast("string")))
    return F.when(text.contains(".") & ~text.contains("E"), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def find_number(c: Column, let: Callable[[Column], Column] = _inline) -> Column:
    """The first number in text, with thousands separators or a decimal comma: 'EGP 12,284.15', '1786,35', '1.234,56'."""
    raw = let(F.regexp_replace(F.regexp_extract(strip(c), _INSIDE, 1), r"\s", ""))
    last_comma, last_dot = F.length(raw) - F.instr(F.reverse(raw), ","), F.length(raw) - F.instr(F.reverse(raw), ".")
    comma, dot = raw.contains(","), raw.contains(".")
    decimal_comma = (comma & ~dot & raw.rlike(r"^[+-]?\d+,\d{1,2}$")) | (comma & dot & (last_comma > last_dot))
    text = let(F.when(decimal_comma, F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(F.replace(raw, F.lit(","), F.lit(""))))
    return to_number(text)


def round_half_even(n: Column, decimals: int) -> Column:
    power = float(10**decimals)
    return F.rint(n * F.lit(power)) / F.lit(power)
