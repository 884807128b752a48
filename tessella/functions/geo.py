"""Map projection, distances and rings as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Constants of the ellipsoids and of UTM.
A84, F84 = 6378137.0, 1 / 298.257223563
K0, EASTING = 0.9996, 500_000.0


def _series(inverse: bool) -> tuple[float, list[float]]:
    """Rectifying radius and the coefficients of the transverse Mercator series in the third flattening, to the fourth order."""
    n = F84 / (2 - F84)
    radius = A84 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    if inverse:
        return radius, [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
    return radius, [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]


def utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing in a northern UTM zone."""
    radius, coefficients = _series(False)
    e = math.sqrt(F84 * (2 - F84))
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for k, c in enumerate(coefficients, 1):
        east = east + c * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        north = north + c * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return EASTING + K0 * radius * east, K0 * radius * north


def from_utm(east: Column, north: Column, zone: int) -> tuple[Column, Column]:
    """Longitude and latitude of a point of a northern UTM zone."""
    radius, coefficients = _series(True)
    xi0, eta0 = north / (K0 * radius), (east - EASTING) / (K0 * radius)
    xi, eta = xi0, eta0
    for k, c in enumerate(coefficients, 1):
        xi = xi - c * F.sin(2 * k * xi0) * F.cosh(2 * k * eta0)
        eta = eta - c * F.cos(2 * k * xi0) * F.sinh(2 * k * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    n = F84 / (2 - F84)
    back = [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]
    phi = chi
    for k, c in enumerate(back, 1):
        phi = phi + c * F.sin(2 * k * chi)
    return (6 * zone - 183) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(phi)


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = A84) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def circle(x: Column, y: Column, radius: float = 50.0, quarter: int = 8) -> Column:
    """A closed ring about a point: four times ``quarter`` corners and the first again."""
    n = 4 * quarter
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: F.struct((x + radius * F.cos(2 * math.pi * (k % n) / n)).alias("x"), (y - radius * F.sin(2 * math.pi * (k % n) / n)).alias("y")))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a closed ring array(struct(x, y)), by crossings to its right."""
    edges = F.arrays_zip(F.slice(ring, F.lit(1), F.size(ring) - 1).alias("a"), F.slice(ring, F.lit(2), F.size(ring) - 1).alias("b"))
    crossed = F.filter(edges, lambda e: ((e.a.y > y) != (e.b.y > y)) & (x < F.try_divide((e.b.x - e.a.x) * (y - e.a.y), e.b.y - e.a.y) + e.a.x))
    return F.size(crossed) % 2 == 1


def radius_pixels(lat: Column, metres: float = 50.0) -> Column:
    """Pixels of a radius at zoom 0 of a web map with 512-pixel tiles."""
    return metres * 512 / (2 * math.pi * A84 * F.cos(F.radians(lat)))


#: Steps of the iterated solutions below; ten digits of an arc second are reached in four or five, but for nearly opposite points.
STEPS = 25
_B = A84 * (1 - F84)


def _series_of_u2(u2: Column) -> tuple[Column, Column]:
    return 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))), u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))


def _arc_correction(b: Column, sin_s: Column, cos_s: Column, cos_m: Column) -> Column:
    return b * sin_s * (cos_m + b / 4 * (cos_s * (2 * cos_m * cos_m - 1) - b / 6 * cos_m * (4 * sin_s * sin_s - 3) * (4 * cos_m * cos_m - 3)))


def _flat_term(cos2a: Column) -> Column:
    return F84 / 16 * cos2a * (4 + F84 * (4 - 3 * cos2a))


def _reduced(lat: Column) -> tuple[Column, Column]:
    """Sine and cosine of the reduced latitude."""
    u = F.atan((1 - F84) * F.tan(F.radians(lat)))
    return F.sin(u), F.cos(u)


def _states(start: Column, step: callable, steps: int) -> Column:
    """``start`` after ``steps`` applications of ``step``: a fold, since a column that is nested in itself would double at each step."""
    return F.aggregate(F.array_repeat(F.lit(0), steps), start, lambda state, _: step(state))


def geodesic_inverse(lon1: Column, lat1: Column, lon2: Column, lat2: Column, steps: int = STEPS) -> Column:
    """struct(metres, azimuth, converged) of the shortest line on the WGS84 ellipsoid, by Vincenty's inverse formula; azimuth at the first point, degrees east of north.

    Nearly opposite points may not converge in ``steps``: metres and azimuth are null then, never a guess. Equal points are 0 m apart, with a null azimuth.
    """

    def arc(p: Column, lam: Column) -> Column:
        """What the difference in longitude on the sphere, ``lam``, gives: sines and cosines of the arc, its azimuth and its middle."""
        cross = F.sqrt((p.c2 * F.sin(lam)) ** 2 + (p.c1 * p.s2 - p.s1 * p.c2 * F.cos(lam)) ** 2)
        along = p.s1 * p.s2 + p.c1 * p.c2 * F.cos(lam)
        sin_a = F.coalesce(F.try_divide(p.c1 * p.c2 * F.sin(lam), cross), F.lit(0.0))
        cos2a = 1 - sin_a * sin_a
        return F.struct(cross.alias("sin"), along.alias("cos"), F.atan2(cross, along).alias("arc"), sin_a.alias("sin_a"), cos2a.alias("cos2a"), F.coalesce(along - F.try_divide(2 * p.s1 * p.s2, cos2a), F.lit(0.0)).alias("mid"))

    s1, c1 = _reduced(lat1)
    s2, c2 = _reduced(lat2)
    given = F.struct(s1.alias("s1"), c1.alias("c1"), s2.alias("s2"), c2.alias("c2"), F.radians(lon2 - lon1).alias("l"))

    def solve(p: Column) -> Column:
        def step(state: Column) -> Column:
            def refined(a: Column) -> Column:
                c = _flat_term(a.cos2a)
                lam = p.l + (1 - c) * F84 * a.sin_a * (a.arc + c * a.sin * (a.mid + c * a.cos * (2 * a.mid * a.mid - 1)))
                return F.struct(lam.alias("lam"), state.lam.alias("before"))

            return _with(arc(p, state.lam), refined)

        def finish(state: Column) -> Column:
            def measured(a: Column) -> Column:
                a_, b_ = _series_of_u2(a.cos2a * ((A84 * A84 - _B * _B) / (_B * _B)))
                done = F.abs(state.lam - state.before) < 1e-12
                bearing = F.degrees(F.atan2(p.c2 * F.sin(state.lam), p.c1 * p.s2 - p.s1 * p.c2 * F.cos(state.lam)))
                return F.struct(F.when(done, _B * a_ * (a.arc - _arc_correction(b_, a.sin, a.cos, a.mid))).alias("metres"), F.when(done & (a.sin > 0), F.pmod(bearing, F.lit(360.0))).alias("azimuth"), done.alias("converged"))

            return _with(arc(p, state.lam), measured)

        return _with(_states(F.struct(p.l.alias("lam"), F.lit(None).cast("double").alias("before")), step, steps), finish)

    return _with(given, solve)


def geodesic_direct(lon: Column, lat: Column, azimuth: Column, metres: Column, steps: int = STEPS) -> Column:
    """struct(lon, lat): where one gets from a point by ``metres`` along the shortest line that leaves at ``azimuth``, by Vincenty's direct formula."""
    s1, c1 = _reduced(lat)
    sin_a1, cos_a1 = F.sin(F.radians(azimuth)), F.cos(F.radians(azimuth))
    given = F.struct(s1.alias("s1"), c1.alias("c1"), sin_a1.alias("sa"), cos_a1.alias("ca"), F.atan2(s1, c1 * cos_a1).alias("start"), (c1 * sin_a1).alias("sin_a"), (1 - c1 * c1 * sin_a1 * sin_a1).alias("cos2a"), metres.alias("metres"), lon.alias("lon"))

    def solve(p: Column) -> Column:
        a_, b_ = _series_of_u2(p.cos2a * ((A84 * A84 - _B * _B) / (_B * _B)))
        first = p.metres / (_B * a_)
        reached = _states(first, lambda s: first + _arc_correction(b_, F.sin(s), F.cos(s), F.cos(2 * p.start + s)), steps)

        def finish(s: Column) -> Column:
            flat = p.s1 * F.sin(s) - p.c1 * F.cos(s) * p.ca
            north = F.atan2(p.s1 * F.cos(s) + p.c1 * F.sin(s) * p.ca, (1 - F84) * F.sqrt(p.sin_a * p.sin_a + flat * flat))
            lam, c, mid = F.atan2(F.sin(s) * p.sa, p.c1 * F.cos(s) - p.s1 * F.sin(s) * p.ca), _flat_term(p.cos2a), F.cos(2 * p.start + s)
            east = lam - (1 - c) * F84 * p.sin_a * (s + c * F.sin(s) * (mid + c * F.cos(s) * (2 * mid * mid - 1)))
            return F.struct((F.pmod(p.lon + F.degrees(east) + 180, F.lit(360.0)) - 180).alias("lon"), F.degrees(north).alias("lat"))

        return _with(reached, finish)

    return _with(given, solve)


def _with(value: Column, use: callable) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def geodesic_circle(lon: Column, lat: Column, metres: Column, corners: int = 720) -> Column:
    """A closed ring of struct(lon, lat) at ``metres`` from a point on the ellipsoid, the northern corner first, clockwise."""
    return F.transform(F.sequence(F.lit(0), F.lit(corners)), lambda k: geodesic_direct(lon, lat, k % corners * (360.0 / corners), metres))
