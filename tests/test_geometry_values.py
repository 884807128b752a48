"""Simplified lines, close names and geodesics against plain versions and published values."""

import math
import random
import sys
from difflib import get_close_matches

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import geo
from tessella.operators import names, simplify


def recursive(points, tolerance):
    if len(points) < 4:
        return points
    (ax, ay), (bx, by) = points[0], points[-1]
    dx, dy = bx - ax, by - ay
    scale = dx * dx + dy * dy
    best, at = -1.0, 0
    for k, (x, y) in enumerate(points[1:-1], 1):
        t = min(1.0, max(0.0, ((x - ax) * dx + (y - ay) * dy) / scale)) if scale else 0.0
        d = (x - ax - t * dx) ** 2 + (y - ay - t * dy) ** 2
        if d > best:
            best, at = d, k
    if best <= tolerance * tolerance:
        return [points[0], points[-1]]
    return recursive(points[: at + 1], tolerance)[:-1] + recursive(points[at:], tolerance)


def walk(rng, n):
    x = y = 0.0
    out = []
    for _ in range(n):
        out.append((x, y))
        x, y = x + rng.randrange(-3, 5), y + rng.randrange(-4, 5)
    return out


def test_simplified_lines(spark):
    rng = random.Random(1)
    tracks = [walk(rng, n) for n in (1, 2, 3, 4, 5, 50, 10_000, 10_000)]
    tracks.append(tracks[5] + tracks[5][:1])  # a closed ring
    rows = [(k, [{"x": x, "y": y} for x, y in t], tol) for k, t in enumerate(tracks) for tol in (0.0, 2.5, 30.0)] + [(99, None, 1.0), (98, [], 1.0), (97, [{"x": 1.0, "y": 2.0}] * 5, None), (96, [{"x": 1.0, "y": 2.0}] * 5, 0.5)]
    df = spark.createDataFrame(rows, "k int, line array<struct<x:double,y:double>>, tol double").repartition(3)
    found = {(r.k, r.tol): None if r.line is None else [(p.x, p.y) for p in r.line] for r in simplify.simplified(df, "line", "tol").collect()}
    sys.setrecursionlimit(20_000)
    for k, t in enumerate(tracks):
        for tol in (0.0, 2.5, 30.0):
            assert found[k, tol] == recursive(t, tol)
    assert found[99, 1.0] is None and found[98, 1.0] == [] and len(found[97, None]) == 5 and len(found[96, 0.5]) == 2
    assert len(found[6, 30.0]) < 2000
    with pytest.raises(Exception, match="without coordinates"):
        simplify.simplified(spark.createDataFrame([(1, [{"x": None, "y": 1.0}], 1.0)], df.schema), "line", "tol").collect()


def test_a_line_that_splits_one_corner_at_a_time():
    """A spiral splits off few corners a step: deep for a recursion, nothing for a stack."""
    n = 30_000
    t = np.arange(n)
    assert simplify.corners_kept(t.astype(float), np.where(t % 2, 1.0, 0.0) * (n - t), 0.0).sum() == n


def test_close_matches_are_those_of_difflib(spark, sf):
    rng = random.Random(3)
    known = [r.p_name for r in spark.read.parquet(f"{sf}/part.parquet").select("p_name").distinct().collect()]
    known += ["".join(rng.choice("abst") for _ in range(rng.randrange(1, 30))) + rng.choice(["strasse", "allee", "ring"]) for _ in range(300)]
    asked = ["", "a", "strasse", *known[::5]]
    for name in known:
        for _ in range(3):
            chars = list(name)
            for _ in range(rng.randrange(1, 4)):
                at = rng.randrange(len(chars) + 1)
                rng.choice([lambda: chars.insert(at, rng.choice("abst")), lambda: chars.pop(min(at, len(chars) - 1)) if len(chars) > 1 else None, lambda: chars.reverse() if rng.random() < 0.1 else None])()
            asked.append("".join(chars))
    tokens, words = spark.createDataFrame([(a,) for a in [*asked, None, asked[5]]], "t string"), spark.createDataFrame([(k,) for k in [*known, None, known[0], ""]], "n string")
    for n, cutoff in ((2, 0.9), (3, 0.7)):
        rows = names.close_matches(tokens, words, "t", "n", n, cutoff).collect()
        got = {}
        for r in sorted(rows, key=lambda r: r.rank):
            got.setdefault(r.t, []).append(r.n)
        want = {t: m for t in set(asked) if (m := get_close_matches(t, sorted(set(known)), n=n, cutoff=cutoff))}
        assert got == want and len(rows) == sum(map(len, want.values()))
    with pytest.raises(ValueError, match="cutoff"):
        names.close_matches(tokens, words, "t", "n", 2, 0.66)


def dms(d, m, s):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


def test_geodesics_agree_with_published_lines(spark):
    # Flinders Peak to Buninyong (the Australian datum's ellipsoid differs from this one by a tenth of a millimetre in its axis), a degree of the equator, a quarter of a meridian.
    lines = [(dms(144, 25, 29.5244), dms(-37, 57, 3.7203), dms(143, 55, 35.3839), dms(-37, 39, 10.1561), 54972.271, dms(306, 52, 5.37)), (0.0, 0.0, 1.0, 0.0, 111319.491, 90.0), (0.0, 0.0, 0.0, 90.0, 10001965.729, 0.0)]
    df = spark.createDataFrame(lines, "a double, b double, c double, d double, metres double, azimuth double")
    g = geo.geodesic_inverse(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    for r in df.select("*", g.alias("g"), geo.geodesic_direct(F.col("a"), F.col("b"), F.col("azimuth"), F.col("metres")).alias("p")).collect():
        assert r.g.metres == pytest.approx(r.metres, abs=1e-3) and r.g.azimuth == pytest.approx(r.azimuth, abs=3e-6) and r.g.converged
        assert r.p.lat == pytest.approx(r.d, abs=2e-6) and (r.d == 90 or r.p.lon == pytest.approx(r.c, abs=2e-6))


def test_geodesics_there_and_back(spark):
    rng = random.Random(4)
    rows = [(rng.uniform(-179, 179), rng.uniform(-85, 85), rng.uniform(0, 360), rng.uniform(0.5, 12_000_000)) for _ in range(200)]
    df = spark.createDataFrame(rows, "lon double, lat double, azimuth double, metres double").withColumn("p", geo.geodesic_direct(F.col("lon"), F.col("lat"), F.col("azimuth"), F.col("metres")))
    for r in df.withColumn("g", geo.geodesic_inverse(F.col("lon"), F.col("lat"), F.col("p.lon"), F.col("p.lat"))).collect():
        assert r.g.metres == pytest.approx(r.metres, abs=1e-3) and -180 <= r.p.lon < 180
        assert min(abs(r.g.azimuth - r.azimuth), 360 - abs(r.g.azimuth - r.azimuth)) * r.metres < 100


def test_geodesics_at_their_limits(spark):
    same = spark.createDataFrame([(1.0, 2.0, 1.0, 2.0), (0.0, 0.0, 179.9, 0.3), (None, 1.0, 1.0, 1.0)], "a double, b double, c double, d double")
    equal, opposite, null = (r.g for r in same.select(geo.geodesic_inverse(*[F.col(c) for c in "abcd"]).alias("g")).collect())
    assert (equal.metres, equal.azimuth, equal.converged) == (0.0, None, True)
    assert opposite.metres is None and not opposite.converged  # nearly opposite points: no guess
    assert null.metres is None
    ring = spark.range(1).select(geo.geodesic_circle(F.lit(13.4), F.lit(52.5), F.lit(1852.0)).alias("r")).first().r
    assert len(ring) == 721 and ring[0] == ring[-1] and ring[0].lon == pytest.approx(13.4) and ring[180].lon > 13.4
