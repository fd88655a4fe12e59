"""Dates and times in text."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqloom.functions.text import strip

#: strptime directive -> Java pattern letters when reading with separators (lenient on leading zeros), and when writing
_READ = {"Y": "yyyy", "m": "M", "d": "d", "H": "H", "M": "m", "S": "s", "b": "MMM", "B": "MMMM", "y": "yy", "I": "h", "p": "a", "j": "D"}
_WRITE = {"Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "b": "MMM", "B": "MMMM", "y": "yy", "I": "hh", "p": "a", "j": "DDD"}
ISO = {"date": "%Y-%m-%d", "time": "%H:%M:%S", "year_month": "%Y-%m"}
_BOUND = re.compile(r"^today(?:\s*([+-])\s*(\d+)\s*([ymd]))?$")
_TIME = r"^(\d{1,2})[:.](\d{2})(?:[:.](\d{2}))?(?:\s*([AaPp])\.?[Mm]\.?)?$"


def java_format(fmt: str, writing: bool = False) -> str:
    """A strptime format as a Java one. Without separators between directives digits are read by fixed width."""
    table = _WRITE if writing or re.search(r"%[A-Za-z]%", fmt) else _READ
    out, i = "", 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            if fmt[i + 1] == "%":
                out += "%"
            elif fmt[i + 1] not in table:
                raise ValueError(f"unsupported directive %{fmt[i + 1]} in {fmt!r}")
            else:
                out += table[fmt[i + 1]]
            i += 2
            continue
        out += f"'{fmt[i]}'" if fmt[i].isalpha() else "''" if fmt[i] == "'" else fmt[i]
        i += 1
    return out


def parse(c: Column, formats: list[str]) -> Column:
    """Timestamp by the first format that fits; two-digit years from 69 on are of the last century."""
    found = []
    for fmt in formats:
        t = F.try_to_timestamp(strip(c), F.lit(java_format(fmt)))
        if "%y" in fmt:
            t = F.when(F.year(t) >= 2069, F.add_months(t, -1200).cast("timestamp") + (t - F.date_trunc("day", t))).otherwise(t)
        found.append(t)
    return F.coalesce(*found) if found else F.lit(None).cast("timestamp")


def write(t: Column, fmt: str) -> Column:
    return F.date_format(t, java_format(fmt, writing=True))


def repair_time(c: Column) -> Column:
    """'9:05' -> '09:05:00', '12.30.15' -> '12:30:15', '07:19:20 PM' -> '19:19:20'; null if it is no time of day."""
    part = [F.regexp_extract(strip(c), _TIME, i) for i in range(1, 5)]
    hour, minute = part[0].try_cast("int"), part[1].try_cast("int")
    second = F.coalesce(F.when(part[2] != "", part[2].try_cast("int")), F.lit(0))
    half = F.lower(part[3])
    valid = ((half == "") & (hour <= 23) | (half != "") & hour.between(1, 12)) & (minute <= 59) & (second <= 59)
    hour = F.when(half == "", hour).otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    return F.when(valid, F.format_string("%02d:%02d:%02d", hour, minute, second))


def resolve_bound(value: object, kind: str, run_date: dt.date) -> float | dt.datetime | None:
    """A bound on the driver: a number, a date or time in text, or today with an offset (today-18y)."""
    if value is None:
        return None
    if kind in ("integer", "decimal"):
        return float(value)
    text = value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value).strip()
    m = _BOUND.match(text)
    if m:
        n = int(m[2] or 0) * (-1 if m[1] == "-" else 1)
        day = add_months(run_date, n * {"y": 12, "m": 1}[m[3]]) if m[3] in ("y", "m") else run_date + dt.timedelta(days=n)
        return dt.datetime(day.year, day.month, day.day)
    if kind == "time":
        return dt.datetime.combine(dt.date(1970, 1, 1), dt.time.fromisoformat(text))
    if kind == "year_month":
        text += "-01" if text.count("-") == 1 else ""
    return dt.datetime.fromisoformat(text)


def add_months(day: dt.date, months: int) -> dt.date:
    """Calendar months later; the last day of a shorter month."""
    y, m = divmod(day.year * 12 + day.month - 1 + months, 12)
    last = (dt.date(y + m // 11, (m + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(y, m + 1, min(day.day, last))


def plus(t: Column, offset: dict | None) -> Column:
    """Timestamp plus a calendar offset ({years, months, weeks, days, hours, minutes, seconds})."""
    if not offset:
        return t
    unknown = set(offset) - {"years", "months", "weeks", "days", "hours", "minutes", "seconds"}
    if unknown:
        raise ValueError(f"unknown offset {sorted(unknown)}")
    n = {k: F.lit(int(v)) for k, v in offset.items()}
    return t + F.make_interval(n.get("years"), n.get("months"), n.get("weeks"), n.get("days"), n.get("hours"), n.get("minutes"), n.get("seconds"))
