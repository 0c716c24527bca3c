"""Number handling that gives the same answer however the data is partitioned.

Sums of DOUBLE depend on the order in which partial sums are merged.  Every sum and
mean here is therefore taken over DECIMAL and cast to DOUBLE once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Colish = Column | str


def as_col(c: Colish) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Decimals that sums and means keep; values up to 1e20 fit beside them.
SCALE = 8


def dec(c: Colish, scale: int = 2) -> Column:
    """DECIMAL(18, scale) form of an amount with a known number of decimals, for products."""
    return as_col(c).cast(f"decimal(18,{scale})")


def exact(c: Colish, scale: int = SCALE) -> Column:
    """DECIMAL(28, 8 or more) form of any measure; its SUM has room for ten more digits.

    A value beyond that range ends the query with the cast's own error; it is never cut.
    """
    return as_col(c).cast(f"decimal(28,{max(scale, SCALE)})")


def rnd(c: Colish, places: int = 0) -> Column:
    """SQL ROUND (half away from zero), computed on DOUBLE.

    From 2^53 / 10^places on a DOUBLE has no digit left to round: it stays as it is.
    """
    x = as_col(c).cast("double")
    factor = float(10**places)
    # Whole-number arithmetic until the last step, so there is no negative zero.
    rounded = F.signum(x).cast("bigint") * F.floor(F.abs(x) * factor + 0.5) / factor
    return F.when(F.abs(x) * factor >= float(2**53), x).otherwise(rounded)


def ratio(num: Colish, den: Colish) -> Column:
    """num / den as DOUBLE; NULL when the denominator is zero or NULL."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def pct(num: Colish, den: Colish) -> Column:
    """100 * num / den as DOUBLE; NULL when the denominator is zero or NULL."""
    return F.try_divide(as_col(num).cast("double") * 100.0, as_col(den).cast("double"))


def clamp(c: Colish, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    x = as_col(c)
    return F.when(x < low, F.lit(low)).when(x > high, F.lit(high)).otherwise(x)


def fmt_money(c: Colish) -> Column:
    """`$` amount with thousands separators; M / B suffix from a million / a billion up."""
    x = as_col(c).cast("double")
    size = F.abs(x)
    sign = F.when(x < 0, "-").otherwise("")
    body = (
        F.when(size >= 1e9, F.concat(F.format_number(size / 1e9, 1), F.lit("B")))
        .when(size >= 1e6, F.concat(F.format_number(size / 1e6, 1), F.lit("M")))
        .otherwise(F.format_number(size, 0))
    )
    return F.concat(sign, F.lit("$"), body)
