"""Scalar functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURS_PER_YEAR = 8760


def goods_kg(population: Column, kg_per_person: float) -> Column:
    """Decimal product as text with three digits, halves away from zero."""
    product = population.cast("decimal(24,12)") * F.lit(str(kg_per_person)).cast("decimal(10,4)")
    return F.round(product, 3).cast("decimal(24,3)").cast("string")


def truck_energy(distance_m: Column, ascent_m: Column, cfg: dict) -> Column:
    """Flat consumption plus the work of the ascent over uphill efficiency; nothing is recovered."""
    flat = distance_m / 1000 * F.lit(cfg["flat_kwh_per_km"])
    lift = ascent_m * F.lit(cfg["mass_kg"] * cfg["gravity_m_s2"] / (cfg["uphill_efficiency"] * 3.6e6))
    return flat + lift


def truck_minutes(distance_m: Column, road_class: Column, speeds_kmh: dict[str, float]) -> Column:
    speed = F.lit(None).cast("double")
    for name, v in speeds_kmh.items():
        speed = F.when(road_class == name, F.lit(float(v))).otherwise(speed)
    return distance_m / 1000 / speed * 60


def flight_cost(distance_m: Column, z_from: Column, z_to: Column, z_max: Column, payload: Column, cfg: dict) -> dict[str, Column]:
    """Three phases of a flight at fixed height over the corridor's highest ground.

    Climb to ``z_max + clearance_m``, cruise, descend.  ``cfg``: nominal_battery_kwh,
    reserve_share, cruise_m_s, climb_m_s, descend_m_s, clearance_m and, for each
    payload, cruise_kw, climb_kw and descend_kw.  The reserve is tested for the leg
    alone and leaves its energy as it is.
    """

    def power(phase: str) -> Column:
        return F.when(payload == "full", F.lit(float(cfg[f"full_{phase}_kw"]))).otherwise(F.lit(float(cfg[f"empty_{phase}_kw"])))

    top = z_max + F.lit(float(cfg["clearance_m"]))
    up, down, level = (top - z_from) / cfg["climb_m_s"], (top - z_to) / cfg["descend_m_s"], distance_m / cfg["cruise_m_s"]
    horizontal = level * power("cruise") / 3600
    vertical = (up * power("climb") + down * power("descend")) / 3600
    energy = horizontal + vertical
    return {
        "time_min": (up + down + level) / 60,
        "horizontal_energy_kwh": horizontal,
        "vertical_energy_kwh": vertical,
        "energy_kwh": energy,
        "arc_energy_necessary_feasible": energy <= F.lit(cfg["nominal_battery_kwh"] * (1 - cfg["reserve_share"])),
    }


def household_energy_kwh(population: Column, household_size: float, annual_household_kwh: float, hours: float = 12.0, share: float = 0.35) -> Column:
    """Emergency energy of the households of a population over some hours, at a share of the usual load."""
    return population / household_size * annual_household_kwh / HOURS_PER_YEAR * hours * share


def hstore(text: Column) -> Column:
    """Tags of an hstore text as a map; quotes and backslashes are unescaped, NULL values are null."""
    pair = r'"((?:[^"\\]|\\.)*)"\s*=>\s*(?:"((?:[^"\\]|\\.)*)"|(NULL))'
    plain = lambda x: F.regexp_replace(x, r"\\(.)", "$1")
    keys = F.transform(F.regexp_extract_all(text, F.lit(pair), F.lit(1)), plain)
    null = F.regexp_extract_all(text, F.lit(pair), F.lit(3))
    values = F.zip_with(F.regexp_extract_all(text, F.lit(pair), F.lit(2)), null, lambda v, n: F.when(n == "", plain(v)))
    # The first of repeated keys counts.
    both = F.arrays_zip(keys.alias("k"), values.alias("v"))
    first = F.filter(both, lambda e, i: F.array_position(keys, e["k"]) == i + 1)
    return F.map_from_arrays(F.transform(first, lambda e: e["k"]), F.transform(first, lambda e: e["v"]))


def has_credentials(url: Column, keys: str = "token|key|api_?key|access_?key|secret|password|passwd|signature|sig|auth") -> Column:
    """Whether a query string names a credential, or the URL holds user information."""
    query = F.coalesce(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), F.lit(""))
    return F.regexp_like(query, F.lit(rf"(?i)(^|[&;])({keys})=")) | F.regexp_like(url, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*@"))


def segment_fraction(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Position of the nearest point of a segment, 0 at a and 1 at b."""
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    return F.when(square == 0, F.lit(0.0)).otherwise(F.least(F.greatest(((px - ax) * dx + (py - ay) * dy) / square, F.lit(0.0)), F.lit(1.0)))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    t = segment_fraction(px, py, ax, ay, bx, by)
    return F.hypot(px - (ax + t * (bx - ax)), py - (ay + t * (by - ay)))


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys and the seed alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *keys)), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def transverse_mercator(lon: Column, lat: Column, lon0: float, lat0: float, k0: float, false_x: float, false_y: float, a: float = 6378137.0, f: float = 1 / 298.257222101) -> tuple[Column, Column]:
    """Degrees on an ellipsoid to metres, by Krueger's series to the fourth order (below a millimetre in a zone)."""
    n = f / (2 - f)
    e = math.sqrt(f * (2 - f))
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]

    def atanh(v: Column) -> Column:
        return 0.5 * F.log((1 + v) / (1 - v))

    s = F.sin(F.radians(lat))
    t = F.sinh(atanh(s) - F.lit(e) * atanh(F.lit(e) * s))
    d = F.radians(lon - lon0)
    xi, eta = F.atan2(t, F.cos(d)), atanh(F.sin(d) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, c in enumerate(alpha, 1):
        x = x + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)

    def meridian(deg: float) -> float:
        sn = math.sin(math.radians(deg))
        t0 = math.sinh(math.atanh(sn) - e * math.atanh(e * sn))
        x0 = math.atan(t0)
        return x0 + sum(c * math.sin(2 * j * x0) for j, c in enumerate(alpha, 1))

    return F.lit(false_x) + k0 * radius * x, F.lit(false_y) + k0 * radius * (y - F.lit(meridian(lat0)))


#: EPSG:2193: central meridian, origin, scale and false offsets.
NZTM = {"lon0": 173.0, "lat0": 0.0, "k0": 0.9996, "false_x": 1_600_000.0, "false_y": 10_000_000.0}
