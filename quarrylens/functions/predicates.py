"""Filters, safe casts and labels.  All stay on bare columns so scans can push them down."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrylens.functions.numeric import Colish, as_col


def any_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)


def default_null(c: Colish, value) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def in_bbox(lat: Colish, lon: Colish, south: float, north: float, west: float, east: float) -> Column:
    return as_col(lat).between(south, north) & as_col(lon).between(west, east)


def to_date_safe(c: Colish) -> Column:
    """DATE, or NULL when the text is not a date."""
    return as_col(c).try_cast("date")


def to_ts_safe(c: Colish) -> Column:
    return as_col(c).try_cast("timestamp")


def flag(c: Colish) -> Column:
    """Boolean test where NULL counts as false."""
    return F.coalesce(as_col(c), F.lit(False))


def within_days(c: Colish, as_of: date, days: int) -> Column:
    """In [as_of, as_of + days] for days >= 0, in [as_of + days, as_of] otherwise."""
    other = as_of + timedelta(days=days)
    return as_col(c).between(F.lit(min(as_of, other)), F.lit(max(as_of, other)))


def since_months(c: Colish, as_of: date, months: int) -> Column:
    """On or after the day ``months`` before ``as_of``."""
    return as_col(c) >= F.add_months(F.lit(as_of), -months)


def within_months(c: Colish, as_of: date, months: int) -> Column:
    """In (as_of, as_of + months]: the coming months."""
    return (as_col(c) > F.lit(as_of)) & (as_col(c) <= F.add_months(F.lit(as_of), months))


def same_year(c: Colish, as_of: date) -> Column:
    """Same calendar year, written as a range so that it prunes."""
    return as_col(c).between(F.lit(date(as_of.year, 1, 1)), F.lit(date(as_of.year, 12, 31)))


def quarter_of(c: Colish, as_of: date) -> Column:
    first = date(as_of.year, 3 * ((as_of.month - 1) // 3) + 1, 1)
    return (as_col(c) >= F.lit(first)) & (as_col(c) < F.add_months(F.lit(first), 3))


def previous_month(c: Colish, as_of: date) -> Column:
    first = as_of.replace(day=1)
    return (as_col(c) >= F.add_months(F.lit(first), -1)) & (as_col(c) < F.lit(first))


def after_hour(c: Colish, start: str) -> Column:
    """Text times ``HH:mm`` compare as text; needs zero padding on both sides."""
    return as_col(c) >= F.lit(start)


def label(bands: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """First matching band wins."""
    (cond, name), *rest = bands
    out = F.when(cond, F.lit(name))
    for cond, name in rest:
        out = out.when(cond, F.lit(name))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def domain_rank(c: Colish, domain: Sequence[str]) -> Column:
    """1-based position in an ordered domain; values outside come last."""
    return label_int([(as_col(c) == v, i) for i, v in enumerate(domain, 1)], len(domain) + 1)


def label_int(bands: Sequence[tuple[Column, int]], otherwise: int) -> Column:
    (cond, value), *rest = bands
    out = F.when(cond, F.lit(value))
    for cond, value in rest:
        out = out.when(cond, F.lit(value))
    return out.otherwise(F.lit(otherwise))


def month_start(c: Colish) -> Column:
    """First day of the month as DATE."""
    return F.trunc(as_col(c), "MM")
