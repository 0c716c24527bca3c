"""Business rules as pure Column functions.  Thresholds come in named profiles."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrylens.functions import aggs
from quarrylens.functions.numeric import Colish, as_col, ratio
from quarrylens.functions.predicates import any_of, label
from quarrylens.functions.vocab import IN_SERVICE, OPEN_STATUSES, SIGNIFICANT, SUPPLY_RISK

# --- earned value -----------------------------------------------------------


def cv(ev: Colish, ac: Colish) -> Column:
    return as_col(ev) - as_col(ac)


def sv(ev: Colish, pv: Colish) -> Column:
    return as_col(ev) - as_col(pv)


def cpi(ev: Colish, ac: Colish) -> Column:
    return ratio(ev, ac)


def spi(ev: Colish, pv: Colish) -> Column:
    return ratio(ev, pv)


def cv_pct(ev: Colish, ac: Colish) -> Column:
    return ratio(cv(ev, ac), ev) * 100.0


def sv_pct(ev: Colish, pv: Colish) -> Column:
    return ratio(sv(ev, pv), pv) * 100.0


def eac(budget: Colish, cpi_: Colish) -> Column:
    """Estimate at completion: budget / CPI."""
    return ratio(budget, cpi_)


def vac(budget: Colish, cpi_: Colish) -> Column:
    return as_col(budget) - eac(budget, cpi_)


@dataclass(frozen=True)
class RagBands:
    """An index below ``red`` is red, up to ``green`` amber; CV in percent likewise."""

    index_red: float
    index_green: float
    cv_red: float
    cv_green: float


# The two published threshold sets.
RAG_PROFILES = {
    "controls": RagBands(index_red=0.95, index_green=1.0, cv_red=-5.0, cv_green=0.0),
    "governance": RagBands(index_red=0.85, index_green=0.95, cv_red=-10.0, cv_green=-5.0),
}


def rag(cv_percent: Colish, spi_: Colish, cpi_: Colish, profile: str = "controls", ev_vs_plan: Colish | None = None) -> Column:
    """Worst metric wins: red, amber or green; NULL metrics are ignored.

    On the ``governance`` bands a metric must be strictly above the green limit to be green,
    and the limits themselves are amber.
    """
    b = RAG_PROFILES[profile]
    indices = [as_col(spi_), as_col(cpi_)] + ([as_col(ev_vs_plan)] if ev_vs_plan is not None else [])
    cvp = as_col(cv_percent)
    red = [x < b.index_red for x in indices] + [cvp < b.cv_red]
    if profile == "governance":
        amber = [x <= b.index_green for x in indices] + [cvp <= b.cv_green]
    else:
        amber = [x < b.index_green for x in indices] + [cvp < b.cv_green]
    never = F.lit(False)
    return label(
        [(any_of(*[F.coalesce(x, never) for x in red]), "red"), (any_of(*[F.coalesce(x, never) for x in amber]), "amber")],
        "green",
    )


def risk_class(cpi_: Colish, spi_: Colish) -> Column:
    low = F.least(as_col(cpi_), as_col(spi_))
    return label([(low < 0.85, "Critical"), (low < 0.95, "High"), (low < 1.0, "Medium")], "Low")


def high_risk(status: Colish, cpi_: Colish) -> Column:
    return (as_col(status) == "red") & (as_col(cpi_) < 0.9)


def index_alert(cpi_: Colish, spi_: Colish) -> Column:
    return (as_col(cpi_) < 0.9) | (as_col(spi_) < 0.85)


def approver(value: Colish) -> Column:
    v = as_col(value)
    return label(
        [
            (v < 500_000, "Project Manager"),
            (v < 2_000_000, "Senior Project Manager"),
            (v < 5_000_000, "Divisional Director"),
            (v <= 20_000_000, "Executive Committee"),
        ],
        "Board of Directors",
    )


def evm_required(contract_value: Colish) -> Column:
    return as_col(contract_value) > 50_000_000


# --- safety -----------------------------------------------------------------


def frequency_rate(events: Colish, hours: Colish) -> Column:
    """Events per million hours worked (LTIFR with lost-time events, TRIFR with recordable ones)."""
    return ratio(as_col(events).cast("double") * 1e6, hours)


ltifr = frequency_rate
trifr = frequency_rate


def is_lti(lost_days: Colish) -> Column:
    return as_col(lost_days) > 0


def is_near_miss(injuries: Colish, incident_type: Colish | None = None) -> Column:
    """No injury; with a type given, the type must say near miss too."""
    none_hurt = as_col(injuries) == 0
    return none_hurt if incident_type is None else none_hurt & (as_col(incident_type) == "Near Miss")


def is_significant(severity: Colish) -> Column:
    return as_col(severity).isin(*SIGNIFICANT)


def is_open(status: Colish) -> Column:
    return as_col(status).isin(*OPEN_STATUSES)


def systemic_cause(root_cause: Colish) -> Column:
    return as_col(root_cause).isin("equipment_failure", "inadequate_training")


# --- equipment --------------------------------------------------------------


def temp_alert(temp: Colish, warning_from: float = 105.0, critical_from: float = 110.0) -> Column:
    t = as_col(temp)
    return label([(t > critical_from, "CRITICAL"), (t > warning_from, "WARNING")])


def fuel_band(fuel: Colish) -> Column:
    f = as_col(fuel)
    return F.when(f.isNotNull(), label([(f < 10, "critical"), (f <= 20, "low"), (f <= 50, "fair")], "good"))


def low_fuel(fuel: Colish, status: Colish, limit: float = 10.0) -> Column:
    return (as_col(fuel) < limit) & in_service(status)


def hydraulic_band(bar: Colish) -> Column:
    p = as_col(bar)
    return F.when(
        p.isNotNull(),
        label([((p > 400) | (p < 100), "critical"), ((p > 350) | (p < 150), "warning"), (p >= 200, "normal")], "low_normal"),
    )


def in_service(status: Colish) -> Column:
    return as_col(status).isin(*IN_SERVICE)


def utilisation(status: Colish) -> Column:
    """Aggregate: percent of rows in service; units in maintenance count as not deployed."""
    return aggs.rate_pct(in_service(status))


def days_overdue(due: Colish, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), as_col(due))


def overdue(due: Colish, as_of: date, status: Colish | None = None) -> Column:
    late = as_col(due) < F.lit(as_of)
    return late if status is None else late & in_service(status)


def overdue_priority(due: Colish, as_of: date) -> Column:
    return label([(days_overdue(due, as_of) > 7, "HIGH")], "MEDIUM")


def service_due(hours: Colish) -> Column:
    """Which service interval the hour meter has just reached; review past 10,000 h."""
    h = as_col(hours)
    return label([(h > 10_000, "major_review"), (h % 1000 == 0, "major"), (h % 250 == 0, "minor")], "none")


# Asset number prefix of each equipment type.
EQUIPMENT_PREFIXES = {
    "HT": "haul_truck",
    "EX": "excavator",
    "DR": "drill",
    "LD": "loader",
    "DZ": "dozer",
    "GR": "grader",
    "WC": "water_cart",
    "CR": "crane",
}


def equipment_type_of(equipment_id: Colish) -> Column:
    prefix = F.upper(F.substring_index(as_col(equipment_id), "-", 1))
    return label([(prefix == code, name) for code, name in EQUIPMENT_PREFIXES.items()])


def mtbf(operating_hours: Colish, breakdowns: Colish) -> Column:
    return ratio(operating_hours, breakdowns)


def mttr(downtime_hours: Colish, breakdowns: Colish) -> Column:
    return ratio(downtime_hours, breakdowns)


# --- procurement ------------------------------------------------------------


def est_spend(price: Colish, qty: Colish) -> Column:
    """Unit price x last order quantity, as exact DECIMAL."""
    return as_col(price).cast("decimal(18,2)") * as_col(qty).cast("decimal(10,0)")


def lead_band(days: Colish) -> Column:
    d = as_col(days)
    return F.when(d.isNotNull(), label([(d > 60, "critical"), (d > 30, "long")], "normal"))


def supply_risk(availability: Colish) -> Column:
    return as_col(availability).isin(*SUPPLY_RISK)


def procurement_risk(trend: Colish, availability: Colish, lead_days: Colish) -> Column:
    return (as_col(trend) == "increasing") & (supply_risk(availability) | (as_col(lead_days) > 30))


def poor_quality(score: Colish) -> Column:
    return as_col(score) < 3.0


def unreliable(on_time_pct: Colish) -> Column:
    return as_col(on_time_pct) < 85.0


def critical_supplier(spend: Colish, score: Colish, high_spend: float = 1_000_000.0) -> Column:
    return (as_col(spend) > high_spend) & poor_quality(score)


def contract_expiring(status: Colish) -> Column:
    return as_col(status) == "Expiring Soon"


# --- forecasting ------------------------------------------------------------


def forecast_duration(remaining: Colish, spi_: Colish) -> Column:
    """Our definition: periods still needed if the present SPI holds."""
    return ratio(remaining, spi_)


def forecast_delay(remaining: Colish, spi_: Colish, horizon: float | None = None) -> Column:
    """Periods lost if the SPI holds to the end, or for ``horizon`` periods and then is 1."""
    spell = forecast_duration(remaining, spi_)
    if horizon is None:
        return spell - as_col(remaining)
    return F.when(spell.isNotNull(), F.least(spell, F.lit(float(horizon)))) * (1.0 - as_col(spi_))


def forecast_cost(delay: Colish, spend_per_period: Colish) -> Column:
    """Our definition: lost periods cost the planned spend of a period each."""
    return as_col(delay) * as_col(spend_per_period)
