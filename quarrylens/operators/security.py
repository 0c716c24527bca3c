"""Row filters, column masks and role policies as plain transforms.

Open-source Spark has no catalogue-enforced filters, so a governed table is a view over a
filtered frame.  The caller's groups are always explicit arguments or a membership table.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.functions.numeric import Colish, as_col, rnd

EXECUTIVES = "Group-Executives"
ADMINS = "admins"


def sees_all(groups: Collection[str], exec_groups: Collection[str] = (EXECUTIVES, ADMINS)) -> bool:
    return bool(set(groups) & set(exec_groups))


def division_filter(
    c: Colish,
    groups: Collection[str],
    mapping: Mapping[str, str],
    exec_groups: Collection[str] = (EXECUTIVES, ADMINS),
) -> Column:
    """True for rows the groups may see.  ``mapping`` is group -> division; no group, no rows."""
    if sees_all(groups, exec_groups):
        return F.lit(True)
    visible = sorted({mapping[g] for g in groups if g in mapping})
    return as_col(c).isin(visible) if visible else F.lit(False)


def mask_budget(c: Colish, is_exec: bool | Column, unit: float = 1e6) -> Column:
    """Full value for executives, else rounded to the nearest ``unit``."""
    x = as_col(c)
    masked = rnd(x / unit, 0) * unit
    if isinstance(is_exec, bool):
        return x if is_exec else masked
    return F.when(is_exec, x).otherwise(masked)


@dataclass(frozen=True)
class Policy:
    """Row filter column, and numeric columns shown rounded to everyone but executives."""

    mapping: Mapping[str, str]
    filter_column: str | None = "division"
    masked: Sequence[str] = ()
    exec_groups: Collection[str] = (EXECUTIVES, ADMINS)


def secure(df: DataFrame, groups: Collection[str], policy: Policy) -> DataFrame:
    """The frame as a caller in ``groups`` may see it; the filter stays on a bare column."""
    out = df
    if policy.filter_column:
        out = out.filter(division_filter(policy.filter_column, groups, policy.mapping, policy.exec_groups))
    is_exec = sees_all(groups, policy.exec_groups)
    return out.withColumns({c: mask_budget(c, is_exec) for c in policy.masked})


def secure_by_membership(df: DataFrame, principal: str, memberships: DataFrame, mapping: DataFrame, exec_group: str = EXECUTIVES, column: str = "division") -> DataFrame:
    """Same rule with memberships (principal, group_name) and mapping (group_name, division) as tables.

    Executives match through a row per division, so one semi-join covers both cases.
    """
    mine = memberships.filter(F.col("principal") == principal).select("group_name").distinct()
    own = mapping.join(mine, "group_name", "left_semi").select("division")
    everything = mapping.select("division").filter(mine.filter(F.col("group_name") == exec_group).exists())
    visible = own.unionByName(everything).distinct().withColumnRenamed("division", column)
    return df.join(visible, column, "left_semi")


@dataclass(frozen=True)
class Role:
    """One role covers one table: members of ``group`` see the rows meeting ``predicate``."""

    name: str
    group: str
    table: str
    predicate: Column = field(default_factory=lambda: F.lit(True))


def role_policy(table: str, roles: Sequence[Role], groups: Collection[str]) -> Column:
    """OR of the caller's role predicates on a table; no role means no rows."""
    mine = [r.predicate for r in roles if r.table == table and r.group in groups]
    return reduce(lambda a, b: a | b, mine) if mine else F.lit(False)


def apply_roles(df: DataFrame, table: str, roles: Sequence[Role], groups: Collection[str]) -> DataFrame:
    return df.filter(F.coalesce(role_policy(table, roles, groups), F.lit(False)))


def mirror_view(name: str, base: DataFrame) -> None:
    """Unfiltered view of a base frame, for services that filter on their own."""
    base.createOrReplaceTempView(name)


def membership_flags(memberships: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row per principal with a flag per group."""
    return memberships.groupBy("principal").agg(
        *[F.max(F.col("group_name") == g).alias(f"is_{g.lower().replace('-', '_').replace(' ', '_')}") for g in groups]
    )


def verify_visibility(tables: Mapping[str, DataFrame], memberships: DataFrame, mapping: DataFrame, exec_group: str = EXECUTIVES) -> DataFrame:
    """Visible rows per table, principal and division.

    Each table is counted once per division; principals meet the counts afterwards, so the
    cost does not grow with tables x principals scans.
    """
    counts = reduce(
        DataFrame.unionByName,
        [
            df.groupBy("division").agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
            for name, df in tables.items()
        ],
    )
    # Executives get one grant per division in the same table, so one equi-join serves everyone.
    grants = mapping.select("group_name", "division").unionByName(
        mapping.select(F.lit(exec_group).alias("group_name"), "division")
    )
    visible = memberships.join(grants.distinct(), "group_name").select("principal", "division").distinct()
    return visible.join(counts, "division").select("principal", "table_name", "division", "row_count")
