"""Joins and measures of axis-parallel boxes: (minx, miny, maxx, maxy), y downwards.

Range predicates alone would make a nested loop. A box is put into the cells of a coarse grid, boxes meet by an equi-join
on page and cell, and a pair is emitted only by the cell that holds the corner where its overlap begins, so no
``distinct`` is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = 256


def area(p: str = "") -> Column:
    return (F.col(f"{p}maxx") - F.col(f"{p}minx")) * (F.col(f"{p}maxy") - F.col(f"{p}miny"))


def diagonal(width: Column, height: Column) -> Column:
    return F.sqrt(width * width + height * height)


def rel_length(x: float, diag: Column) -> Column:
    return diag * F.lit(x)


def rel_area(a: float, diag: Column) -> Column:
    """The square of the relative length, as areas scale."""
    return F.pow(diag * F.lit(a), 2)


def intersection(a: str = "a_", b: str = "b_") -> Column:
    """Area of the overlap of two boxes, 0 if there is none."""
    dx = F.least(F.col(f"{a}maxx"), F.col(f"{b}maxx")) - F.greatest(F.col(f"{a}minx"), F.col(f"{b}minx"))
    dy = F.least(F.col(f"{a}maxy"), F.col(f"{b}maxy")) - F.greatest(F.col(f"{a}miny"), F.col(f"{b}miny"))
    return F.greatest(dx, F.lit(0)) * F.greatest(dy, F.lit(0))


def overlap_ratio(a: str = "a_", b: str = "b_") -> Column:
    """Overlap over the smaller area; 0 for a box without area."""
    small = F.least(area(a), area(b))
    return F.when(small > 0, intersection(a, b) / small).otherwise(F.lit(0.0))


def alignment(a0: Column, a1: Column, b0: Column, b1: Column, mode: str = "min") -> Column:
    """Shared span of two intervals over the shorter one ('min'), the first ('a') or the second ('b')."""
    shared = F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))
    size = {"min": F.least(a1 - a0, b1 - b0), "a": a1 - a0, "b": b1 - b0}[mode]
    return F.when(size > 0, shared / size).otherwise(F.lit(0.0))


def inset(fringe: float) -> list[Column]:
    """Bounds moved inwards; the far side never comes before the near one."""
    x0 = F.least(F.col("minx") + fringe, F.col("maxx"))
    y0 = F.least(F.col("miny") + fringe, F.col("maxy"))
    return [x0.alias("minx"), y0.alias("miny"), F.greatest(F.col("maxx") - fringe, x0).alias("maxx"), F.greatest(F.col("maxy") - fringe, y0).alias("maxy")]


def outset(fringe: float) -> list[Column]:
    return [(F.col("minx") - fringe).alias("minx"), (F.col("miny") - fringe).alias("miny"), (F.col("maxx") + fringe).alias("maxx"), (F.col("maxy") + fringe).alias("maxy")]


def _cells(df: DataFrame, p: str, cell: int) -> DataFrame:
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    return df.withColumn(f"{p}cx", F.explode(span(f"{p}minx", f"{p}maxx"))).withColumn(f"{p}cy", F.explode(span(f"{p}miny", f"{p}maxy")))


def prefixed(df: DataFrame, p: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(k) if k in keep else F.col(k).alias(p + k) for k in df.columns])


def meeting(a: DataFrame, b: DataFrame, page: str = "page_id", cell: int = CELL, within: float = 0) -> DataFrame:
    """Pairs of boxes of one page whose closed bounds meet, or come within ``within``; columns prefixed a_ and b_, the page once."""
    left, right = prefixed(a, "a_", [page]), prefixed(b, "b_", [])
    wide = left.withColumns({"a_minx": F.col("a_minx") - within, "a_miny": F.col("a_miny") - within, "a_maxx": F.col("a_maxx") + within, "a_maxy": F.col("a_maxy") + within}) if within else left
    x, y = _cells(wide, "a_", cell), _cells(right, "b_", cell)
    on = (x[page] == y[f"b_{page}"]) & (x["a_cx"] == y["b_cx"]) & (x["a_cy"] == y["b_cy"])
    touch = (F.col("a_minx") <= F.col("b_maxx")) & (F.col("b_minx") <= F.col("a_maxx")) & (F.col("a_miny") <= F.col("b_maxy")) & (F.col("b_miny") <= F.col("a_maxy"))
    first = (F.floor(F.greatest("a_minx", "b_minx") / cell) == F.col("a_cx")) & (F.floor(F.greatest("a_miny", "b_miny") / cell) == F.col("a_cy"))
    out = x.join(y, on).filter(touch & first).drop("a_cx", "a_cy", "b_cx", "b_cy", f"b_{page}")
    if within:
        out = out.withColumns({"a_minx": F.col("a_minx") + within, "a_miny": F.col("a_miny") + within, "a_maxx": F.col("a_maxx") - within, "a_maxy": F.col("a_maxy") - within})
    return out


def overlap_pairs(boxes: DataFrame, maximum: float = 0.0) -> DataFrame:
    """Pairs of boxes of one page and label that overlap by more than ``maximum`` of the smaller: ids, area, ratio."""
    pairs = meeting(boxes, boxes).filter((F.col("a_block_id") < F.col("b_block_id")) & (F.col("a_label") == F.col("b_label")))
    pairs = pairs.withColumn("overlap", intersection()).withColumn("ratio", overlap_ratio())
    return pairs.filter((F.col("overlap") > 0) & (F.col("ratio") > maximum))


def hit_by(boxes: DataFrame, obstacles: DataFrame, fringe: float = 0) -> DataFrame:
    """Semi join: boxes whose bounds, moved inwards by ``fringe``, meet an obstacle's bounds."""
    small = boxes.select("page_id", "block_id", *inset(fringe)) if fringe else boxes.select("page_id", "block_id", "minx", "miny", "maxx", "maxy")
    pairs = meeting(small, obstacles.select("page_id", "minx", "miny", "maxx", "maxy"))
    return boxes.join(pairs.select("page_id", F.col("a_block_id").alias("block_id")), ["page_id", "block_id"], "left_semi")


def outside(boxes: DataFrame, holes: DataFrame) -> DataFrame:
    """Anti join: boxes that no hole of their page contains."""
    pairs = meeting(boxes.select("page_id", "block_id", "minx", "miny", "maxx", "maxy"), holes.select("page_id", "minx", "miny", "maxx", "maxy"))
    inside = pairs.filter((F.col("a_minx") >= F.col("b_minx")) & (F.col("a_maxx") <= F.col("b_maxx")) & (F.col("a_miny") >= F.col("b_miny")) & (F.col("a_maxy") <= F.col("b_maxy")))
    return boxes.join(inside.select("page_id", F.col("a_block_id").alias("block_id")), ["page_id", "block_id"], "left_anti")


def best_match(targets: DataFrame, sources: DataFrame, share: float = 0.6) -> DataFrame:
    """For each target the source that overlaps it most, if by more than ``share`` of the source; ties go to the smaller source id."""
    pairs = meeting(targets, sources).withColumn("overlap", intersection())
    pairs = pairs.filter((area("b_") > 0) & (F.col("overlap") / area("b_") > share))
    best = pairs.groupBy("page_id", "a_block_id").agg(F.min_by("b_block_id", F.struct(-F.col("overlap"), F.col("b_block_id"))).alias("source_id"), F.max("overlap").alias("overlap"))
    return best.select("page_id", F.col("a_block_id").alias("block_id"), "source_id", "overlap")


def other_label_share(boxes: DataFrame) -> DataFrame:
    """For each box the largest share of a box of another label that it covers (0 if none)."""
    pairs = meeting(boxes, boxes).filter((F.col("a_label") != F.col("b_label")) & (area("b_") > 0)).withColumn("share", intersection() / area("b_"))
    most = pairs.groupBy("page_id", F.col("a_block_id").alias("block_id")).agg(F.max("share").alias("share"))
    return boxes.select("page_id", "block_id").join(most, ["page_id", "block_id"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))


def shrunk(merged: DataFrame, original: DataFrame) -> DataFrame:
    """Each box clipped to the bounds of the original boxes of its label that it meets; a box that meets none is dropped."""
    pairs = meeting(merged, original).filter("a_label = b_label")
    bounds = pairs.groupBy("page_id", "a_block_id", "a_label", "a_minx", "a_miny", "a_maxx", "a_maxy").agg(F.min("b_minx").alias("x0"), F.min("b_miny").alias("y0"), F.max("b_maxx").alias("x1"), F.max("b_maxy").alias("y1"))
    return bounds.select("page_id", F.col("a_block_id").alias("block_id"), F.col("a_label").alias("label"), F.greatest("a_minx", "x0").alias("minx"), F.greatest("a_miny", "y0").alias("miny"), F.least("a_maxx", "x1").alias("maxx"), F.least("a_maxy", "y1").alias("maxy"))
