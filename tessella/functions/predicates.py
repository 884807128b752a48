"""Predicates over points, geometries, addresses and published figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Review methods whose candidate road may be drawn, and scopes that belong to a city.
ROAD_METHODS = ("long_or_ambiguous_street_review", "disconnected_street_review")
CITY_SCOPES = ("in_city", "mixed")


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def valid_point(lon: Column, lat: Column) -> Column:
    """A finite position; the poles are none."""
    return finite(lon) & finite(lat) & F.coalesce(lon.between(-180, 180) & (lat > -90) & (lat < 90), F.lit(False))


def valid_geometry(kind: Column, points: Column) -> Column:
    """Whether points, array(struct(lon, lat)), make a geometry: one for a Point, two or more for a LineString, a closed ring of four or more for a Polygon."""
    good, n = F.coalesce(F.forall(points, lambda p: valid_point(p.lon, p.lat)), F.lit(False)), F.size(points)
    closed = (n >= 4) & (F.try_element_at(points, F.lit(1)) == F.try_element_at(points, F.lit(-1)))
    return good & F.coalesce(F.when(kind == "Point", n == 1).when(kind == "LineString", n >= 2).when(kind == "Polygon", closed), F.lit(False))


def of_kinds(kind: Column, context_kinds: Column, chosen: tuple[str, ...]) -> Column:
    """A report's place counts by its context kinds, or by its own kind where it has none."""
    return F.arrays_overlap(F.coalesce(context_kinds, F.array(kind)), F.array(*map(F.lit, chosen)))


def in_scope(scope: Column, city: Column) -> Column:
    """Articles of a city; Berlin's uncertain ones stay in review."""
    return F.coalesce(scope.isin(*CITY_SCOPES) | (city == "berlin") & (scope == "uncertain"), F.lit(False))


def safe_url(url: Column) -> Column:
    """https without user, on the standard port."""
    host = F.lower(F.regexp_extract(url, r"^https://([^/?#\\]*)", 1))
    return F.coalesce((host != "") & ~F.contains(host, F.lit("@")) & (~host.rlike(":[0-9]*$") | host.rlike(":(443)?$")), F.lit(False))


def merged_absent(tags: Column, more: Column) -> Column:
    """Tags with the entries of ``more`` whose keys they lack."""
    return F.map_concat(tags, F.map_filter(more, lambda k, _: ~F.map_contains_key(tags, k)))


def one_or_none(values: Column) -> Column:
    """The one value of an array whose entries agree; null if any is unknown or they differ."""
    return F.when((F.size(F.array_distinct(values)) == 1) & ~F.exists(values, lambda v: v.isNull()), F.element_at(values, 1))


def every(*tests: Column) -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
