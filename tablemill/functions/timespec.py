"""Relative durations such as 30d, 12h or 90m, floors and retention, and backoff."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"d": "days", "h": "hours", "m": "minutes"}
_RELATIVE = re.compile(r"(\d+)\s*([dhm])", re.I)


def parse_relative(raw: str) -> timedelta | None:
    """FUN-1. None for anything that is not a number and a unit."""
    m = _RELATIVE.fullmatch(raw.strip())
    return timedelta(**{_UNITS[m[2].lower()]: int(m[1])}) if m else None


def resolve_since(raw: str, now: datetime) -> str:
    """FUN-2. A relative duration becomes an ISO stamp before now; an absolute stamp stays."""
    span = parse_relative(raw)
    return (now - span).isoformat() if span is not None else raw


def validate_retention(table: str, retention: str, since: str | None, ts_col: str | None) -> None:
    """FUN-3. What is kept at the source must reach further back than what is synced, and both must be of one form."""
    if not ts_col:
        raise ValueError(f"{table}: retention needs a timestamp column")
    if since is None:
        return
    keep, floor = parse_relative(retention), parse_relative(since)
    if (keep is None) != (floor is None):
        raise ValueError(f"{table}: retention and floor must both be relative or both absolute")
    if keep is not None:
        if keep <= floor:
            raise ValueError(f"{table}: retention {retention} must be longer than the floor {since}")
    elif datetime.fromisoformat(retention) >= datetime.fromisoformat(since):
        raise ValueError(f"{table}: retention {retention} must lie before the floor {since}")


def relative_seconds(c: Column) -> Column:
    """FUN-1 as a column expression: seconds, or null."""
    n = F.regexp_extract(F.trim(c), r"(?i)^(\d+)\s*[dhm]$", 1)
    unit = F.lower(F.regexp_extract(F.trim(c), r"(?i)^\d+\s*([dhm])$", 1))
    return F.when(n != "", n.try_cast("bigint")) * F.when(unit == "d", 86400).when(unit == "h", 3600).when(unit == "m", 60)


def backoff_ms(attempt: Column, base: int = 5000, most: int = 60000) -> Column:
    """FUN-22."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt), F.lit(float(most))).cast("bigint")
