"""Hexagon cells, map tiles and plane coordinates as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the data model: tile size in degrees, and the hexagons' edge lengths in metres.
TILE_LON, TILE_LAT = 0.04, 0.025
HEX_EDGES = {"overview": 1100.0, "detail": 275.0}
VIEWPORT_TILES = 64


def plane(lon: Column, lat: Column, lon0: float = 13.0, lat0: float = 52.0) -> tuple[Column, Column]:
    """Metres in a flat frame about (lon0, lat0); enough for cells, and the same in any engine."""
    return (lon - lon0) * 67800, (lat - lat0) * 111200


def hex_cell(x: Column, y: Column, edge: float) -> Column:
    """struct(d2, i, j): the nearest centre of a flat-top grid at the origin; ties go to the smaller (i, j).

    Only the nine centres about the point can be nearest, so this stays an expression: no lookup, no join, no UDF.
    """
    height = math.sqrt(3) * edge
    near = F.rint(x / (1.5 * edge)).cast("bigint")
    found = []
    for a in (-1, 0, 1):
        i = near + a
        odd = F.pmod(i, F.lit(2)) / 2
        row = F.rint(y / height - odd).cast("bigint")
        for b in (-1, 0, 1):
            j = row + b
            dx, dy = x - 1.5 * edge * i, y - height * (j + odd)
            found.append(F.struct((dx * dx + dy * dy).alias("d2"), i.alias("i"), j.alias("j")))
    return F.array_min(F.array(*found))


def hex_ring(i: Column, j: Column, edge: float) -> Column:
    """The six corners of a cell, in metres."""
    cx, cy = 1.5 * edge * i, math.sqrt(3) * edge * (j + F.pmod(i, F.lit(2)) / 2)
    return F.array(*[F.struct((cx + edge * math.cos(k * math.pi / 3)).alias("x"), (cy + edge * math.sin(k * math.pi / 3)).alias("y")) for k in range(6)])


def tile(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.floor(lon / TILE_LON), F.floor(lat / TILE_LAT)


def tile_cover(west: Column, south: Column, east: Column, north: Column, most: int | None = None) -> Column:
    """array(struct(tx, ty)) of all tiles that a box touches; empty beyond ``most`` tiles, and for a box with a null side."""
    x0, y0 = tile(west, south)
    x1, y1 = tile(east, north)
    cover = F.flatten(F.transform(F.sequence(x0, x1), lambda tx: F.transform(F.sequence(y0, y1), lambda ty: F.struct(tx.alias("tx"), ty.alias("ty")))))
    none = F.array().cast("array<struct<tx:bigint,ty:bigint>>")
    if most is not None:
        cover = F.when((x1 - x0 + 1) * (y1 - y0 + 1) <= most, cover).otherwise(none)
    return F.coalesce(cover, none)
