"""Reprojection between EPSG:4326, EPSG:3857 and the WGS 84 UTM zones as Catalyst expressions.

Transverse Mercator follows the Krüger series in the third flattening to fourth order (Karney,
"Transverse Mercator with an accuracy of a few nanometers", 2011); the truncation error stays
far below a millimetre inside a zone. Every direction goes through longitude and latitude.

A projection is a chain of stages. Each stage names a few values computed from the previous ones,
so a value used many times is computed once per point instead of being expanded in place.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOGRAPHIC = 4326
WEB_MERCATOR = 3857

# The WGS 84 ellipsoid and the UTM grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_SOUTH_FALSE_NORTHING = 10000000.0

ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))
_N = FLATTENING / (2 - FLATTENING)
RECTIFYING_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)

# Series coefficients (Karney 2011, equations 35 and 36), to fourth order.
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)

Values = dict[str, Column]
Stage = Callable[[Values], Values]


def parse_srid(text: str | int | None) -> int:
    """EPSG code from ``""``, ``"32614"`` or ``"EPSG:32614"``; blank means geographic."""
    code = str(text or "").strip().split(":")[-1].strip()
    srid = int(code) if code else GEOGRAPHIC
    if srid not in (GEOGRAPHIC, WEB_MERCATOR) and utm_zone(srid) is None:
        raise ValueError(f"EPSG:{srid} is not supported; use 4326, 3857, 326zz or 327zz")
    return srid


def utm_zone(srid: int) -> tuple[int, bool] | None:
    """(zone, is_south) of a WGS 84 UTM code, else None."""
    hemisphere, zone = divmod(srid, 100)
    if hemisphere in (326, 327) and 1 <= zone <= 60:
        return zone, hemisphere == 327
    return None


def common_srid(srids: set[int]) -> int:
    """The one reference system of a set of layers; mixing systems is an error."""
    if len(srids) != 1:
        raise ValueError(f"layers do not share one reference system: {sorted(srids)}")
    return next(iter(srids))


#: Key of column metadata that holds the reference system of coordinates.
SRID = "srid"


def marked(df: DataFrame, srid: int | str, *columns: str) -> DataFrame:
    """``df`` whose coordinate columns carry their reference system through later steps."""
    for name in columns:
        own = {**df.schema[name].metadata, SRID: parse_srid(srid)}
        df = df.withMetadata(name, own)
    return df


def srid_of(df: DataFrame) -> int | None:
    """The reference system that the columns of ``df`` are marked with; two of them are an error."""
    found = {f.metadata[SRID] for f in df.schema.fields if SRID in f.metadata}
    return common_srid(found) if found else None


def _utm_forward(zone: int, south: bool) -> list[Stage]:
    central = math.radians(zone * 6 - 183)

    def conformal(v: Values) -> Values:
        s = F.sin(F.radians(v["y"]))
        t = F.sinh(F.atanh(s) - ECCENTRICITY * F.atanh(ECCENTRICITY * s))
        return {"t": t, "dl": F.radians(v["x"]) - central}

    def spherical(v: Values) -> Values:
        return {
            "xi": F.atan2(v["t"], F.cos(v["dl"])),
            "eta": F.asinh(F.sin(v["dl"]) / F.sqrt(v["t"] * v["t"] + F.pow(F.cos(v["dl"]), 2))),
        }

    def series(v: Values) -> Values:
        xi, eta = v["xi"], v["eta"]
        e, n = eta, xi
        for j, a in enumerate(ALPHA, start=1):
            n = n + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        scale = UTM_SCALE * RECTIFYING_RADIUS
        return {
            "x": UTM_FALSE_EASTING + scale * e,
            "y": (UTM_SOUTH_FALSE_NORTHING if south else 0.0) + scale * n,
        }

    return [conformal, spherical, series]


def _utm_inverse(zone: int, south: bool) -> list[Stage]:
    central = zone * 6 - 183
    scale = UTM_SCALE * RECTIFYING_RADIUS

    def grid(v: Values) -> Values:
        return {
            "xi": (v["y"] - (UTM_SOUTH_FALSE_NORTHING if south else 0.0)) / scale,
            "eta": (v["x"] - UTM_FALSE_EASTING) / scale,
        }

    def series(v: Values) -> Values:
        xi, eta = v["xi"], v["eta"]
        xp, ep = xi, eta
        for j, b in enumerate(BETA, start=1):
            xp = xp - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            ep = ep - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        return {"xp": xp, "sh": F.sinh(ep)}

    def spherical(v: Values) -> Values:
        t = F.sin(v["xp"]) / F.sqrt(v["sh"] * v["sh"] + F.pow(F.cos(v["xp"]), 2))
        return {"t0": t, "t": t, "x": central + F.degrees(F.atan2(v["sh"], F.cos(v["xp"])))}

    def newton(v: Values) -> Values:
        e2 = ECCENTRICITY**2
        t = v["t"]
        root = F.sqrt(1 + t * t)
        sigma = F.sinh(ECCENTRICITY * F.atanh(ECCENTRICITY * t / root))
        ti = t * F.sqrt(1 + sigma * sigma) - sigma * root
        step = (
            (v["t0"] - ti) / F.sqrt(1 + ti * ti) * (1 + (1 - e2) * t * t) / ((1 - e2) * root)
        )
        return {"t0": v["t0"], "t": t + step, "x": v["x"]}

    def latitude(v: Values) -> Values:
        return {"x": v["x"], "y": F.degrees(F.atan(v["t"]))}

    return [grid, series, spherical, newton, newton, newton, latitude]


def _mercator_forward(v: Values) -> Values:
    return {
        "x": SEMI_MAJOR * F.radians(v["x"]),
        "y": SEMI_MAJOR * F.asinh(F.tan(F.radians(v["y"]))),
    }


def _mercator_inverse(v: Values) -> Values:
    return {
        "x": F.degrees(v["x"] / SEMI_MAJOR),
        "y": F.degrees(F.atan(F.sinh(v["y"] / SEMI_MAJOR))),
    }


def _stages(source: int, target: int) -> list[Stage]:
    if source == target:
        return []
    stages: list[Stage] = []
    if source == WEB_MERCATOR:
        stages.append(_mercator_inverse)
    elif source != GEOGRAPHIC:
        stages += _utm_inverse(*utm_zone(source))
    if target == WEB_MERCATOR:
        stages.append(_mercator_forward)
    elif target != GEOGRAPHIC:
        stages += _utm_forward(*utm_zone(target))
    return stages


def reproject_coords(coords: Column, source: int | str, target: int | str) -> Column:
    """Reproject an array of ``struct<x,y>`` vertices."""
    for stage in _stages(parse_srid(source), parse_srid(target)):
        coords = _staged(coords, stage)
    return coords


def _staged(coords: Column, stage: Stage) -> Column:
    # A stage reads its inputs by name, which a struct column allows like a dictionary.
    return F.transform(
        coords, lambda p: F.struct(*[col.alias(name) for name, col in stage(p).items()])
    )


def reproject_rings(rings: Column, source: int | str, target: int | str) -> Column:
    return F.transform(rings, lambda r: reproject_coords(r, source, target))


def reproject_columns(
    df: DataFrame, source: int | str, target: int | str, x: str, y: str, to_x: str, to_y: str
) -> DataFrame:
    """Add ``to_x``/``to_y``: the reprojected ``x``/``y`` columns, marked with their reference system.

    Attribute columns stay as read, and are no longer marked.
    """
    stages = _stages(parse_srid(source), parse_srid(target))
    values = {"x": x, "y": y}
    temporary: list[str] = []
    for i, stage in enumerate(stages):
        computed = stage({name: F.col(col) for name, col in values.items()})
        values = {name: f"_crs{i}_{name}" for name in computed}
        temporary += values.values()
        df = df.withColumns({values[name]: col for name, col in computed.items()})
    kept = [
        F.col(f.name).alias(f.name, metadata={k: v for k, v in f.metadata.items() if k != SRID})
        for f in df.schema.fields
        if f.name not in (*temporary, to_x, to_y)
    ]
    placed = df.select(*kept, F.col(values["x"]).alias(to_x), F.col(values["y"]).alias(to_y))
    return marked(placed, target, to_x, to_y)
