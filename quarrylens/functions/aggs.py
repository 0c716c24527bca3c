"""Named aggregate expressions shared by the data products and the query catalogue."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrylens.functions.numeric import SCALE, Colish, as_col, exact, pct, ratio, rnd


def n_rows() -> Column:
    return F.count(F.lit(1))


def total(c: Colish, scale: int = SCALE) -> Column:
    """Order-independent SUM as DOUBLE."""
    return F.sum(exact(c, scale)).cast("double")


def total_if(cond: Column, c: Colish, scale: int = SCALE) -> Column:
    """SUM of ``c`` over the rows meeting ``cond`` (NULL when none does)."""
    return F.sum(F.when(cond, exact(c, scale))).cast("double")


def total_int(c: Colish) -> Column:
    return F.sum(as_col(c).cast("bigint"))


def mean(c: Colish, scale: int = SCALE) -> Column:
    """Order-independent AVG as DOUBLE; NULLs do not count."""
    return ratio(F.sum(exact(c, scale)), F.count(as_col(c)))


def avg_rounded(c: Colish, places: int, scale: int = SCALE) -> Column:
    return rnd(mean(c, scale), places)


def count_where(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def rate_pct(cond: Column, places: int = 1, base: Column | None = None) -> Column:
    """Share of rows (or of ``base``) meeting ``cond``, in percent."""
    return rnd(pct(count_where(cond), n_rows() if base is None else base), places)


def weighted_ratio(num: Colish, den: Colish, scale: int = SCALE) -> Column:
    """Ratio of sums, NULL on a zero denominator."""
    return ratio(total(num, scale), total(den, scale))


def scaled(c: Colish, unit: float, places: int, scale: int = SCALE) -> Column:
    """SUM in units of a million, a billion, ..., rounded."""
    return rnd(total(c, scale) / float(unit), places)


def distinct(c: Colish, approx: bool = False, rsd: float = 0.02) -> Column:
    """COUNT(DISTINCT); the sketch form avoids the Expand rewrite on very wide groups."""
    return F.approx_count_distinct(as_col(c), rsd) if approx else F.countDistinct(as_col(c))


def status_counts(c: Colish, values: Iterable[str], suffix: str = "") -> list[Column]:
    """One COUNT per listed value: a pivot in a single aggregation."""
    x = as_col(c)
    return [count_where(x == v).alias(f"{v.lower()}{suffix}") for v in values]


def latest(c: Colish, *order: Colish) -> Column:
    """Value of ``c`` on the row that is last by ``order``."""
    return F.max_by(as_col(c), F.struct(*[as_col(o) for o in order]))


def basic(c: Colish, name: str, scale: int = SCALE) -> list[Column]:
    """COUNT, SUM, AVG, MIN, MAX of one measure."""
    x = as_col(c)
    return [
        F.count(x).alias(f"{name}_count"),
        total(x, scale).alias(f"{name}_sum"),
        mean(x, scale).alias(f"{name}_avg"),
        F.min(x).alias(f"{name}_min"),
        F.max(x).alias(f"{name}_max"),
    ]
