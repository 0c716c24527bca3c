"""Literal seed rows with known answers (fixed values: figures and dates; names shortened)."""

from __future__ import annotations

from datetime import date, datetime

M = 1_000_000.0


def _d(text: str) -> date:
    return date.fromisoformat(text)


def _project(i, division, state, budget, actual, ev, pv, cv, spi, cpi, status, end):
    return (
        f"P-{i:03d}", f"Project {i}", division, f"Client {i}", "Rail", state,
        budget * M, actual * M, ev * M, pv * M, cv, spi, cpi, status,
        _d("2023-01-01"), _d(end), _d("2025-03-31"), f"Manager {i}",
    )


FINANCIALS = [
    _project(1, "Build", "NSW", 850, 792, 810, 800, 2.1, 1.01, 1.02, "green", "2026-06-30"),
    _project(2, "Build", "NSW", 1200, 1150, 1080, 1100, -6.5, 0.98, 0.94, "amber", "2026-12-31"),
    _project(3, "Build", "NSW", 3200, 3450, 3100, 3150, -11.3, 0.98, 0.90, "red", "2025-12-31"),
    _project(4, "Mining", "QLD", 650, 610, 620, 615, 1.6, 1.01, 1.02, "green", "2027-06-30"),
    _project(5, "Mining", "NSW", 420, 445, 400, 410, -11.3, 0.98, 0.90, "red", "2026-12-31"),
    _project(6, "Engineering", "SA", 280, 265, 270, 268, 1.9, 1.01, 1.02, "green", "2025-09-30"),
    _project(7, "Build", "VIC", 2800, 2650, 2700, 2720, -1.8, 0.99, 1.02, "green", "2025-12-31"),
    _project(8, "Mining", "QLD", 550, 580, 520, 540, -11.5, 0.96, 0.90, "red", "2026-03-31"),
    _project(9, "Engineering", "WA", 180, 172, 175, 174, 1.7, 1.01, 1.02, "green", "2026-06-30"),
    _project(10, "Build", "NSW", 950, 920, 900, 910, -2.2, 0.99, 0.98, "green", "2026-03-31"),
]


def _unit(i, kind, site, division, temp, fuel, hours, due, status):
    return (i, kind, site, division, temp, fuel, hours, _d(due), status, datetime(2025, 4, 14, 8))


TELEMETRY = [
    _unit("HT-001", "haul_truck", "North", "Mining", 92.5, 78.0, 12450, "2025-05-15", "operational"),
    _unit("HT-002", "haul_truck", "North", "Mining", 110.3, 45.0, 15800, "2025-04-20", "warning"),
    _unit("HT-003", "haul_truck", "River", "Mining", 88.0, 92.0, 8900, "2025-06-01", "operational"),
    _unit("EX-001", "excavator", "North", "Mining", 85.0, 65.0, 9800, "2025-05-20", "operational"),
    _unit("EX-002", "excavator", "River", "Mining", 115.8, 30.0, 18200, "2025-04-16", "critical"),
    _unit("DR-001", "drill", "North", "Mining", 78.0, 88.0, 6500, "2025-07-01", "operational"),
    _unit("DR-002", "drill", "High", "Mining", 95.0, 55.0, 11200, "2025-04-25", "operational"),
    _unit("LD-001", "loader", "Dam", "Engineering", 82.0, 70.0, 7800, "2025-06-15", "operational"),
    _unit("DZ-001", "dozer", "North", "Mining", 90.0, 60.0, 13500, "2025-05-01", "operational"),
    _unit("HT-004", "haul_truck", "High", "Mining", 98.0, 35.0, 14200, "2025-04-18", "warning"),
]


def _incident(i, day, site, division, kind, severity, injuries, lost, status):
    return (f"INC-{i:03d}", _d(day), site, division, kind, severity, "", injuries, lost, "cause", "action", status)


INCIDENTS = [
    _incident(1, "2025-01-15", "Metro", "Build", "Slip/Trip/Fall", "Minor", 1, 0.0, "closed"),
    _incident(2, "2025-02-03", "North", "Mining", "Vehicle Interaction", "Serious", 0, 0.0, "closed"),
    _incident(3, "2025-02-20", "River", "Mining", "Equipment Failure", "Moderate", 0, 3.0, "closed"),
    _incident(4, "2025-03-08", "Tunnel", "Build", "Falling Object", "Minor", 0, 0.0, "closed"),
    _incident(5, "2025-03-22", "Dam", "Engineering", "Chemical Exposure", "Moderate", 1, 2.0, "open"),
    _incident(6, "2025-04-01", "North", "Mining", "Heat Stress", "Minor", 2, 0.5, "open"),
    _incident(7, "2025-04-10", "Bore", "Build", "Noise Exposure", "Minor", 0, 0.0, "open"),
]


def _material(i, name, category, supplier, price, unit, lead, day, qty, trend, availability):
    return (f"MAT-{i:03d}", name, category, supplier, price, unit, lead, _d(day), qty, trend, availability)


MATERIALS = [
    _material(1, "Structural Steel", "Steel", "S1", 2850.0, "tonne", 21, "2025-03-15", 500.0, "increasing", "good"),
    _material(2, "Concrete 40", "Concrete", "S2", 285.0, "cubic_meter", 3, "2025-04-10", 2000.0, "stable", "good"),
    _material(3, "Diesel", "Fuel", "S3", 1.85, "litre", 1, "2025-04-12", 500000.0, "increasing", "good"),
    _material(4, "Rebar N12", "Steel", "S4", 1650.0, "tonne", 14, "2025-03-28", 800.0, "stable", "moderate"),
    _material(5, "Shotcrete", "Concrete", "S5", 320.0, "cubic_meter", 5, "2025-04-05", 1500.0, "stable", "good"),
    _material(6, "Explosives", "Consumables", "S6", 950.0, "tonne", 7, "2025-04-08", 200.0, "stable", "good"),
    _material(7, "Liner Segments", "Precast", "S7", 4500.0, "segment", 28, "2025-03-01", 120.0, "stable", "limited"),
    _material(8, "Membrane", "Geosynthetics", "S8", 12.5, "square_meter", 10, "2025-03-20", 50000.0, "decreasing", "good"),
    _material(9, "Cutting Tools", "Consumables", "S9", 18500.0, "set", 14, "2025-04-01", 25.0, "increasing", "moderate"),
    _material(10, "Hard Hats", "Safety", "S10", 45.0, "unit", 5, "2025-04-05", 500.0, "stable", "good"),
]
