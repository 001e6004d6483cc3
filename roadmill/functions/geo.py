"""Distances, bearings and offsets as column expressions. Angles are degrees, lengths metres."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sphere of graph lengths; WGS84 for metres between exits and places.
SPHERE_M = 6_371_000.0
WGS84_A = 6_378_137.0
WGS84_E2 = 0.0066943799901413165


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    return F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, form: str = "atan2") -> Column:
    """Metres on the sphere. form: atan2, asin, or asin_clamped, which differ by rounding only."""
    a = _half_chord(lat1, lon1, lat2, lon2)
    if form == "atan2":
        return F.lit(SPHERE_M) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    root = F.sqrt(a) if form == "asin" else F.least(F.lit(1.0), F.sqrt(a))
    return F.lit(SPHERE_M) * 2 * F.asin(root)


def spheroid_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on the WGS84 spheroid by the radii of curvature at the middle latitude; good to 0.03 mm up to 1600 m."""
    middle = F.radians((lat1 + lat2) / 2)
    w2 = 1 - WGS84_E2 * F.sin(middle) * F.sin(middle)
    w = F.sqrt(w2)
    north = WGS84_A * (1 - WGS84_E2) / (w2 * w) * F.radians(lat2 - lat1)
    east = WGS84_A / w * F.cos(middle) * F.radians(lon2 - lon1)
    return F.sqrt(north * north + east * east)


def planar_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.sqrt((lat2 - lat1) * (lat2 - lat1) + (lon2 - lon1) * (lon2 - lon1))


def segment_point(lat: Column, lon: Column, alat: Column, alon: Column, blat: Column, blon: Column, least: float = 0.0) -> tuple[Column, Column]:
    """The point of a segment that is nearest to (lat, lon) in degrees. A segment shorter than sqrt(least) is its start."""
    dy, dx = blat - alat, blon - alon
    square = dx * dx + dy * dy
    along = F.when(square > least, ((lon - alon) * dx + (lat - alat) * dy) / square).otherwise(0.0)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return alat + t * dy, alon + t * dx


def segment_deg(lat: Column, lon: Column, alat: Column, alon: Column, blat: Column, blon: Column) -> Column:
    return planar_deg(lat, lon, *segment_point(lat, lon, alat, alon, blat, blon))


def segment_m(lat: Column, lon: Column, alat: Column, alon: Column, blat: Column, blon: Column) -> Column:
    """Planar projection onto the segment, then metres on the sphere."""
    return haversine_m(lat, lon, *segment_point(lat, lon, alat, alon, blat, blon, 1e-16), form="asin")


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in [0, 360)."""
    dlon = F.radians(lon2 - lon1)
    y = F.sin(dlon) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def destination(lat: Column, lon: Column, heading: Column, metres: float) -> tuple[Column, Column]:
    """The point `metres` away on the sphere."""
    d, b, p = metres / SPHERE_M, F.radians(heading), F.radians(lat)
    out = F.asin(F.sin(p) * F.cos(F.lit(d)) + F.cos(p) * F.sin(F.lit(d)) * F.cos(b))
    east = F.radians(lon) + F.atan2(F.sin(b) * F.sin(F.lit(d)) * F.cos(p), F.cos(F.lit(d)) - F.sin(p) * F.sin(out))
    return F.degrees(out), F.degrees(east)


def cardinal(angle: Column) -> Column:
    """N from 315 to 45, E to 135, S to 225, W."""
    return F.when((angle >= 315) | (angle < 45), "N").when(angle < 135, "E").when(angle < 225, "S").otherwise("W")


def linestring_wkt(points: Column) -> Column:
    """points: array of structs with lat and lon."""
    return F.concat(F.lit("LINESTRING("), F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p.lon.cast("string"), p.lat.cast("string"))), ", "), F.lit(")"))


def bounds(points: Column) -> list[Column]:
    lats, lons = F.transform(points, lambda p: p.lat), F.transform(points, lambda p: p.lon)
    return [F.array_min(lats).alias("min_lat"), F.array_max(lats).alias("max_lat"), F.array_min(lons).alias("min_lon"), F.array_max(lons).alias("max_lon")]


def path_m(points: Column) -> Column:
    """Length of a polyline, an array of structs with lat and lon."""
    n = F.size(points)
    legs = F.when(n > 1, F.zip_with(F.slice(points, 1, F.greatest(n - 1, F.lit(1))), F.slice(points, 2, F.greatest(n - 1, F.lit(1))), lambda a, b: haversine_m(a.lat, a.lon, b.lat, b.lon)))
    return F.coalesce(F.aggregate(legs, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))


def edge_weight_m(metres: Column) -> Column:
    """Whole metres, one at least, halves away from zero."""
    return F.greatest(F.lit(1), F.round(metres).cast("long")).cast("long")
