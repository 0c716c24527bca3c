"""Grouping forms that recur: whole-table summary, per key, per period, ordered by a domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.predicates import domain_rank

PERIODS = {
    "day": lambda c: F.to_date(c),
    "month": lambda c: F.trunc(c, "MM"),
    "quarter": lambda c: F.trunc(c, "QUARTER"),
    "year": lambda c: F.trunc(c, "YEAR"),
}


def summary(df: DataFrame, *measures: Column) -> DataFrame:
    """One row over the whole table."""
    return df.agg(*measures)


def by(df: DataFrame, keys: Sequence[str | Column], *measures: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*measures)


def by_period(df: DataFrame, day: str, period: str, *measures: Column, keys: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Per calendar period (first day as DATE) and optional further keys."""
    return df.groupBy(*keys, PERIODS[period](F.col(day)).alias(out or period)).agg(*measures)


def order_by_domain(df: DataFrame, column: str, domain: Sequence[str], *then: str | Column) -> DataFrame:
    """Sort by position in an ordered domain, then by the tie-breaks."""
    return df.orderBy(domain_rank(column, domain), *then)
