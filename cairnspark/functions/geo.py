"""Geometry as native Column expressions: WKT, projections, containment, centroids."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"
#: Names of reference systems and their codes.
SRIDS = {"WGS84": 4326, "CGCS2000": 4490, "GCJ-02": 4326, "BD-09": 4326}
_POINT = rf"(?i)^\s*POINT\s*Z?\s*\(\s*({NUMBER})\s+({NUMBER})(?:\s+{NUMBER})?\s*\)\s*$"
_PAIR = rf"\s*{NUMBER}\s+{NUMBER}(?:\s+{NUMBER})?\s*"
_RING = rf"\({_PAIR}(?:,{_PAIR})*\)"
_POLYGON = rf"\(\s*{_RING}(?:\s*,\s*{_RING})*\s*\)"


def kind(wkt: Column) -> Column:
    return F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1))


def valid_wkt(wkt: Column) -> Column:
    """True for well-formed POINT, POLYGON and MULTIPOLYGON texts."""
    polygon = wkt.rlike(rf"(?i)^\s*POLYGON\s*{_POLYGON}\s*$")
    return wkt.rlike(_POINT) | polygon | wkt.rlike(rf"(?i)^\s*MULTIPOLYGON\s*\(\s*{_POLYGON}(?:\s*,\s*{_POLYGON})*\s*\)\s*$")


def point_x(wkt: Column) -> Column:
    return F.regexp_extract(wkt, _POINT, 1).try_cast("double")


def point_y(wkt: Column) -> Column:
    return F.regexp_extract(wkt, _POINT, 2).try_cast("double")


def rings(wkt: Column) -> Column:
    """Array of rings, each an array of (x, y), of a POLYGON or MULTIPOLYGON, holes included."""
    found = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))

    def ring(text: Column) -> Column:
        pairs = F.transform(F.split(text, ","), lambda p: F.split(F.trim(p), r"\s+"))
        return F.transform(pairs, lambda p: F.struct(p[0].cast("double").alias("x"), p[1].cast("double").alias("y")))

    return F.transform(found, ring)


def edges(shape: Column) -> Column:
    """All edges (x1, y1, x2, y2) of all rings."""

    def of(ring: Column) -> Column:
        n = F.size(ring)
        return F.zip_with(
            F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1),
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )

    return F.flatten(F.transform(shape, of))


def inside(edge_list: Column, x: Column, y: Column) -> Column:
    """True for a point strictly inside by the even-odd rule: holes count, points on an edge do not lie inside."""

    def crosses(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]))

    def on(e: Column) -> Column:
        turn = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        return (
            (turn == 0)
            & (x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
            & (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"]))
        )

    hits = F.aggregate(edge_list, F.lit(0), lambda n, e: n + F.when(F.coalesce(crosses(e), F.lit(False)), 1).otherwise(0))
    return (hits % 2 == 1) & ~F.exists(edge_list, on)


def centroid(edge_list: Column) -> Column:
    """Area centroid (x, y) of a polygon by the shoelace formula."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, e: Column) -> Column:
        w = e["x1"] * e["y2"] - e["x2"] * e["y1"]
        return F.struct(
            (acc["a"] + w).alias("a"), (acc["x"] + (e["x1"] + e["x2"]) * w).alias("x"), (acc["y"] + (e["y1"] + e["y2"]) * w).alias("y")
        )

    sums = lambda s: F.struct(F.try_divide(s["x"], s["a"] * 3).alias("x"), F.try_divide(s["y"], s["a"] * 3).alias("y"))
    return F.aggregate(edge_list, zero, add, sums)


def srid_of(crs: Column) -> Column:
    """Code of a named reference system; "unk" is null, unknown names are 4326."""
    name = F.upper(F.trim(F.coalesce(crs, F.lit(""))))
    numbered = F.regexp_extract(name, r"^EPSG:(\d+)$", 1).try_cast("int")
    out = F.when(name == "UNK", F.lit(None).cast("int")).when(numbered.isNotNull(), numbered)
    for n, code in SRIDS.items():
        out = out.when(name == n, code)
    return out.otherwise(4326)


def known_srid(srid: Column) -> Column:
    """True for systems that to_wgs84 handles: 4326, 4490 (taken as the same) and northern UTM zones; null counts as 4326."""
    return F.coalesce(srid.isin(4326, 4490) | srid.between(32601, 32660), F.lit(True))


def to_wgs84(wkt: Column, srid: Column) -> Column:
    """The WKT text in degrees: each coordinate pair is projected where it stands; a projected height is left out."""
    pair = rf"{NUMBER}\s+{NUMBER}(?:\s+{NUMBER})?"
    found = F.regexp_extract_all(wkt, F.lit(f"({pair})"), F.lit(1))
    between = F.split(wkt, pair)
    bind = lambda v, body: F.element_at(F.transform(F.array(v), body), 1)

    def projected(text: Column) -> Column:
        xy = F.transform(F.split(text, r"\s+"), lambda t: t.cast("double"))

        def of(e: Column, foot: Column) -> Column:
            lon, lat = _from_foot(e, foot, srid - 32600)
            return F.concat(lon.cast("string"), F.lit(" "), lat.cast("string"))

        return bind(xy, lambda p: bind(_foot(p[1]), lambda foot: of(p[0], foot)))

    moved = F.zip_with(F.transform(found, projected), F.slice(between, F.lit(2), F.size(found)), lambda p, after: F.concat(p, after))
    return F.when(srid.between(32601, 32660), F.concat(between[0], F.array_join(moved, ""))).otherwise(wkt)


#: The ellipsoid of WGS84 and the scale on the central meridian.
_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996
_E2 = _F * (2 - _F)
_EP2 = _E2 / (1 - _E2)


def _foot(northing: Column) -> Column:
    """Footpoint latitude in radians of a northing, by the inverse series."""
    e1 = (1 - math.sqrt(1 - _E2)) / (1 + math.sqrt(1 - _E2))
    mu = (northing / _K0) / (_A * (1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256))
    return (
        mu + F.sin(2 * mu) * (3 * e1 / 2 - 27 * e1**3 / 32) + F.sin(4 * mu) * (21 * e1**2 / 16 - 55 * e1**4 / 32)
        + F.sin(6 * mu) * (151 * e1**3 / 96) + F.sin(8 * mu) * (1097 * e1**4 / 512)
    )


def _from_foot(easting: Column, phi: Column, zone: int | Column) -> tuple[Column, Column]:
    s, c, t2 = F.sin(phi), F.cos(phi), F.pow(F.tan(phi), 2)
    w = 1 - _E2 * s * s
    n1, r1, c1 = _A / F.sqrt(w), _A * (1 - _E2) / F.pow(w, 1.5), _EP2 * c * c
    d = (easting - 500000.0) / (n1 * _K0)
    lat = phi - (n1 * F.tan(phi) / r1) * (
        d * d / 2 - (5 + 3 * t2 + 10 * c1 - 4 * c1 * c1 - 9 * _EP2) * F.pow(d, 4) / 24
        + (61 + 90 * t2 + 298 * c1 + 45 * t2 * t2 - 252 * _EP2 - 3 * c1 * c1) * F.pow(d, 6) / 720
    )
    lon = (
        d - (1 + 2 * t2 + c1) * F.pow(d, 3) / 6
        + (5 - 2 * c1 + 28 * t2 - 3 * c1 * c1 + 8 * _EP2 + 24 * t2 * t2) * F.pow(d, 5) / 120
    ) / c
    return F.degrees(lon) + (zone * 6 - 183.0), F.degrees(lat)


def utm_to_wgs84(easting: Column, northing: Column, zone: int | Column) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees of a northern UTM point, by the inverse transverse Mercator series."""
    return _from_foot(easting, _foot(northing), zone)
