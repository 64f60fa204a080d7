"""Well-known-text shapes as column expressions: points, bounds, area, coordinate strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def points(wkt: Column) -> Column:
    """ARRAY<STRUCT<x, y>> of the outer ring of a polygon, or of a line string; NULL for anything else."""
    body = F.regexp_extract(wkt, r"(?i)^\s*(?:POLYGON\s*\(\s*\(|LINESTRING\s*\()\s*([^()]+)\)", 1)
    pair = lambda p: F.struct(F.get(F.split(F.trim(p), r"\s+"), F.lit(0)).try_cast("double").alias("x"), F.get(F.split(F.trim(p), r"\s+"), F.lit(1)).try_cast("double").alias("y"))
    return F.when(body != "", F.transform(F.split(body, ","), pair))


def bounds(ring: Column) -> Column:
    """struct(minx, miny, maxx, maxy) of an array of points."""
    x, y = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(x).alias("minx"), F.array_min(y).alias("miny"), F.array_max(x).alias("maxx"), F.array_max(y).alias("maxy"))


def ring_area(ring: Column) -> Column:
    """Area of a closed ring, by the sum of cross products of its sides."""
    cross = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda a, v: a + v)) / 2


def coordinates(ring: Column) -> Column:
    """'x,y x,y ..' in whole numbers; halves go to the even one."""
    return F.array_join(F.transform(ring, lambda p: F.concat(F.bround(p["x"], 0).cast("bigint").cast("string"), F.lit(","), F.bround(p["y"], 0).cast("bigint").cast("string"))), " ")


def open_ring(ring: Column) -> Column:
    """A ring without the point that repeats its first."""
    return F.when((F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1)), F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)
