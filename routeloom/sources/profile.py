"""The profile: nested settings, read and checked on the driver before any job."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..errors import GateError

#: Settings that every profile must give, as dotted paths.
REQUIRED = (
    "demand.official_population", "demand.cell_m", "demand.depot_cell",
    "roads.access_threshold_m", "roads.max_inaccessible_percent",
    "energy.annual_household_kwh", "energy.household_size", "energy.kg_per_person",
    "truck.flat_kwh_per_km", "truck.mass_kg", "truck.gravity_m_s2", "truck.uphill_efficiency",
    "drone.nominal_battery_kwh", "drone.reserve_share",
    "scenarios.enabled",
)


def validate_profile(profile: dict) -> dict:
    """The profile, unless a required setting is missing or null; then the error names it."""
    for path in REQUIRED:
        at = profile
        for key in path.split("."):
            at = at.get(key) if isinstance(at, dict) else None
        if at is None:
            raise GateError(f"profile: {path} is missing")
    for i in profile.get("inputs", []):
        if not i.get("role") or not i.get("path"):
            raise GateError("profile: an input has no role or path")
    return profile


def read_profile(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def demo_profile() -> dict:
    """Synthetic settings, labelled so."""
    return {
        "name": "synthetic_demo", "synthetic": True,
        "demand": {"official_population": 1080.0, "cell_m": 100.0, "depot_cell": [2, 2]},
        "roads": {"access_threshold_m": 200.0, "max_inaccessible_percent": 20},
        "energy": {"annual_household_kwh": 7000.0, "household_size": 2.7, "kg_per_person": 2.0},
        "truck": {"flat_kwh_per_km": 0.85, "mass_kg": 18000.0, "gravity_m_s2": 9.80665, "uphill_efficiency": 0.82},
        "drone": {
            "nominal_battery_kwh": 12.0, "reserve_share": 0.2, "cruise_m_s": 20.0, "climb_m_s": 4.0, "descend_m_s": 3.0, "clearance_m": 60.0,
            "full_cruise_kw": 80.0, "full_climb_kw": 110.0, "full_descend_kw": 60.0, "empty_cruise_kw": 50.0, "empty_climb_kw": 70.0, "empty_descend_kw": 40.0,
        },
        "scenarios": {"enabled": True, "seed": 1},
        "inputs": [],
    }
