"""Date, time and number column functions (DAT1-DAT9, MTH1-MTH3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_of_day(c: Column | str) -> Column:
    """DAT1: seconds in an 'HH:mm:ss' duration.

    Subtracting the parse of midnight keeps the value independent of the
    session time zone.
    """
    zero = F.unix_timestamp(F.lit("00:00:00"), "HH:mm:ss")
    return F.unix_timestamp(_c(c), "HH:mm:ss") - zero


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """DAT2: whole seconds from start to end (negative when end is earlier)."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def year_difference(earlier: Column | str, later: Column | str) -> Column:
    """DAT3: calendar-year difference, the way DATEDIFF(YEAR, a, b) counts."""
    return F.year(_c(later)) - F.year(_c(earlier))


def age_from_birth(dob: Column | str, as_of: str) -> Column:
    """DAT5: age as the difference of calendar years at ``as_of``."""
    return F.year(F.lit(as_of).cast("timestamp")) - F.year(_c(dob))


def add_months(ts: Column | str, months: int) -> Column:
    """DAT6."""
    return F.timestamp_add("MONTH", F.lit(months), _c(ts))


def parse_datetime(c: Column | str) -> Column:
    """DAT8 parse of 'yyyy-MM-dd HH:mm:ss'."""
    return F.to_timestamp_ntz(_c(c), F.lit("yyyy-MM-dd HH:mm:ss"))


def render_datetime(c: Column | str) -> Column:
    """DAT8 render as 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss")


def date_stamp(as_of: str) -> Column:
    """DAT9: 'yyyyMMdd' stamp for paths."""
    return F.date_format(F.lit(as_of).cast("timestamp"), "yyyyMMdd")


def bin_right_closed(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """MTH3: label ranges (lo, hi], the last range open-ended (pandas.cut semantics)."""
    col = _c(c)
    assert len(labels) == len(edges) - 1
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = col > F.lit(lo)
        if hi != float("inf"):
            cond = cond & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
