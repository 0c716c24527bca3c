"""One vocabulary for enumerations that sources spell differently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Canonical word per column, with the other spellings in use.
ALIASES: dict[str, dict[str, str]] = {
    "project_status": {"at_risk": "amber"},
    "equipment_status": {"active": "operational", "in_maintenance": "maintenance"},
    "severity": {"major": "serious", "high": "serious", "medium": "moderate", "low": "minor"},
    "price_trend": {"rising": "increasing", "falling": "decreasing"},
    "availability": {
        "in stock": "good",
        "in_stock": "good",
        "backordered": "limited",
        "discontinued": "out_of_stock",
    },
    "stock_status": {"critical": "out_of_stock", "low": "below_reorder", "adequate": "healthy", "surplus": "overstocked"},
    "supplier_tier": {
        "gold": "a - preferred",
        "silver": "b - approved",
        "bronze": "c - conditional",
        "at risk": "d - review required",
    },
}

# Ordered domains, worst first.
SEVERITIES = ("Critical", "Serious", "Moderate", "Minor")
EQUIPMENT_STATUSES = ("critical", "warning", "maintenance", "operational")
AVAILABILITY = ("out_of_stock", "limited", "moderate", "good")
STOCK_STATUSES = ("out_of_stock", "below_reorder", "healthy", "overstocked")
OPEN_STATUSES = ("open", "investigating", "overdue")
IN_SERVICE = ("operational", "warning", "critical")
SIGNIFICANT = ("Critical", "Serious")
SUPPLY_RISK = ("limited", "out_of_stock")
TIERS = ("A - Preferred", "B - Approved", "C - Conditional", "D - Review Required")

# Domains whose canonical spelling is capitalised word by word.
_TITLE = {"severity", "supplier_tier"}


def canonical(c: Column, domain: str, strip_prefix: str | None = None) -> Column:
    """Lower-case, trim, map aliases, restore the canonical case."""
    x = F.lower(F.trim(c))
    if strip_prefix:
        x = F.regexp_replace(x, f"^{strip_prefix.lower()}[ -]", "")
    table = ALIASES.get(domain, {})
    if table:
        pairs = F.create_map(*[F.lit(w) for pair in table.items() for w in pair])
        x = F.coalesce(F.try_element_at(pairs, x), x)
    return F.initcap(x) if domain in _TITLE else x


def canonicalise_vocab(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rewrite ``{column: domain}`` to canonical words."""
    return df.withColumns({name: canonical(F.col(name), domain) for name, domain in columns.items()})
