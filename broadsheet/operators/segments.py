"""Paths and segments: subdivision, smoothing, progress, joins of ends, reasons against a join, and what training data need of pages."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.operators.intervals import runs
from broadsheet.operators.spatial import meeting


def subdivided(segments: DataFrame, most: float) -> DataFrame:
    """Each segment (x0, y0, x1, y1) in equal pieces no longer than ``most``, with ``piece`` from 0; a segment without length is one piece."""
    length = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    rows = segments.withColumn("__n", F.greatest(F.ceil(length / F.lit(float(most))), F.lit(1)).cast("int")).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / F.col("__n")
    new = {"x0": at("x0", "x1", F.col("piece")), "y0": at("y0", "y1", F.col("piece")), "x1": at("x0", "x1", F.col("piece") + 1), "y1": at("y0", "y1", F.col("piece") + 1)}
    return rows.select(*[c for c in segments.columns if c not in new], "piece", *[v.alias(k) for k, v in new.items()])


def smoothed(points: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], reach: int = 2) -> DataFrame:
    """Running means over ``reach`` points to either side, fewer at the ends."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(-reach, reach)
    return points.withColumns({v: F.avg(v).over(w) for v in values})


def path_lengths(points: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Points with ``progress``, the length of the path up to each, and ``step`` to the one before (0 at the first)."""
    w = W.partitionBy(*keys).orderBy(order)
    step = F.coalesce(F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)), F.lit(0.0))
    rows = points.withColumn("step", step)
    return rows.withColumn("progress", F.sum("step").over(w.rowsBetween(W.unboundedPreceding, 0)))


def steady(segments: DataFrame, keys: Sequence[str], angle: str, most: float = 0.1) -> DataFrame:
    """Rows of the separators whose angles spread (population deviation) by no more than ``most``."""
    good = segments.groupBy(*keys).agg(F.stddev_pop(angle).alias("__std")).filter(F.col("__std") <= most).select(*keys)
    return segments.join(good, list(keys), "left_semi")


def good_segments(segments: DataFrame, max_error: float, min_length: float) -> DataFrame:
    return segments.filter((F.col("error") <= max_error) & (F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) >= min_length))


def near_ends(segments: DataFrame, distances: dict[str, float]) -> DataFrame:
    """(page_id, label, a, b, distance): segments of a label whose nearest ends are closer than the label's distance, a < b; other labels have no pair."""
    least = F.create_map(*[F.lit(x) for pair in sorted(distances.items()) for x in pair])
    box = segments.select("page_id", "block_id", "label", "x0", "y0", "x1", "y1", F.least("x0", "x1").alias("minx"), F.least("y0", "y1").alias("miny"), F.greatest("x0", "x1").alias("maxx"), F.greatest("y0", "y1").alias("maxy"))
    pairs = meeting(box, box, within=max(distances.values())).filter((F.col("a_block_id") < F.col("b_block_id")) & (F.col("a_label") == F.col("b_label")))
    gap = lambda i, j: F.hypot(F.col(f"a_x{i}") - F.col(f"b_x{j}"), F.col(f"a_y{i}") - F.col(f"b_y{j}"))
    pairs = pairs.withColumn("distance", F.least(gap(0, 0), gap(0, 1), gap(1, 0), gap(1, 1)))
    return pairs.filter(F.col("distance") < least[F.col("a_label")]).select("page_id", F.col("a_label").alias("label"), F.col("a_block_id").alias("a"), F.col("b_block_id").alias("b"), "distance")


def turn(a: str, b: str) -> Column:
    """The angle between two segments' lines, 0 to a quarter turn."""
    angle = lambda p: F.atan2(F.col(f"{p}y1") - F.col(f"{p}y0"), F.col(f"{p}x1") - F.col(f"{p}x0"))
    d = F.abs(angle(a) - angle(b)) % F.pi()
    return F.least(d, F.pi() - d)


def parallel_pairs(segments: DataFrame, distance: float, most_turn: float = 0.1) -> DataFrame:
    """(page_id, a, b): segments of a label that run side by side: nearly parallel, their bounds closer than ``distance``, a < b."""
    box = segments.select("page_id", "block_id", "label", "x0", "y0", "x1", "y1", F.least("x0", "x1").alias("minx"), F.least("y0", "y1").alias("miny"), F.greatest("x0", "x1").alias("maxx"), F.greatest("y0", "y1").alias("maxy"))
    pairs = meeting(box, box, within=distance).filter((F.col("a_block_id") < F.col("b_block_id")) & (F.col("a_label") == F.col("b_label")) & (turn("a_", "b_") <= most_turn))
    gap = lambda lo, hi: F.greatest(F.col(f"a_{lo}") - F.col(f"b_{hi}"), F.col(f"b_{lo}") - F.col(f"a_{hi}"), F.lit(0))
    return pairs.filter(F.hypot(gap("minx", "maxx"), gap("miny", "maxy")) < distance).select("page_id", F.col("a_block_id").alias("a"), F.col("b_block_id").alias("b"))


def join_reasons(pairs: DataFrame, distance: float, most_turn: float = 0.3) -> DataFrame:
    """Pairs of segments (a_ and b_: label, x0 .. y1; masked) with ``reason``, why they may not be joined: the first that holds of LABEL, COLLAPSE
    (an end without length), DISTANCE (of the facing ends), PARALLEL (side by side rather than one after the other), DIRECTION, MASK; NULL if they may.
    """
    length = lambda p: F.hypot(F.col(f"{p}x1") - F.col(f"{p}x0"), F.col(f"{p}y1") - F.col(f"{p}y0"))
    gap = F.hypot(F.col("b_x0") - F.col("a_x1"), F.col("b_y0") - F.col("a_y1"))
    # how far the second one's begin lies ahead along the first one's direction
    ahead = ((F.col("b_x0") - F.col("a_x0")) * (F.col("a_x1") - F.col("a_x0")) + (F.col("b_y0") - F.col("a_y0")) * (F.col("a_y1") - F.col("a_y0"))) / length("a_")
    reason = (
        F.when(~F.col("a_label").eqNullSafe(F.col("b_label")), "LABEL").when((length("a_") == 0) | (length("b_") == 0), "COLLAPSE").when(gap > distance, "DISTANCE")
        .when(ahead < length("a_") / 2, "PARALLEL").when(turn("a_", "b_") > most_turn, "DIRECTION").when(F.col("masked"), "MASK")
    )
    return pairs.withColumn("reason", reason)


def tile_label_stats(pixels: DataFrame, tile: int, n_labels: int) -> DataFrame:
    """(page_id, label, mean): pixels of a label in a tile, averaged over all tiles of the page that have pixels; a label that a tile lacks counts as 0.

    ``pixels`` has page_id, x, y, label and may have ``n``, how many pixels a row stands for.
    """
    n = F.col("n") if "n" in pixels.columns else F.lit(1)
    per = pixels.groupBy("page_id", F.floor(F.col("x") / tile).alias("tx"), F.floor(F.col("y") / tile).alias("ty"), "label").agg(F.sum(n).alias("n"))
    tiles = per.groupBy("page_id").agg(F.countDistinct("tx", "ty").alias("tiles"), *[F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(n_labels)])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("label"), (F.col(f"n{k}") / F.col("tiles")).alias("mean")) for k in range(n_labels)]))
    return tiles.select("page_id", each.alias("s")).select("page_id", "s.label", "s.mean")


def line_form(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, form): mean length of the black runs along the rows of a line's image (keys, y, x, black); NULL without black."""
    found = runs(pixels, [*keys, "y"], ["x"], "black").filter("black")
    forms = found.groupBy(*keys).agg(F.avg("length").alias("form"))
    return pixels.select(*keys).distinct().join(forms, list(keys), "left")


def label_set(labels: DataFrame) -> DataFrame:
    """(name, label, group, group_label): labels in the order of their names from 0, groups likewise; labels without a group are their own.

    A dimension table: as many rows as there are names.
    """
    named = labels.select("name", F.coalesce("group", "name").alias("group")).distinct()
    groups = named.select("group").distinct().withColumn("group_label", F.row_number().over(W.orderBy("group")) - 1)
    return named.withColumn("label", F.row_number().over(W.orderBy("name")) - 1).join(groups, "group").select("name", "label", "group", "group_label")


def warp_parameters(name: Column, most: float = 0.2) -> list[Column]:
    """(alpha, beta) of the warp of a page, within ±``most``, from the sha256 of its name: the same in every run."""
    part = lambda k: F.conv(F.substring(F.sha2(name, 256), 1 + 8 * k, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return [((part(k) * 2 - 1) * most).alias(n) for k, n in enumerate(("alpha", "beta"))]


def resize_matrix(from_size: tuple[float, float], to_size: tuple[float, float]) -> np.ndarray:
    return np.array([[to_size[0] / from_size[0], 0, 0], [0, to_size[1] / from_size[1], 0]])


def rotation_matrix(phi: float, origin: tuple[float, float] = (0, 0)) -> np.ndarray:
    c, s = np.cos(phi), np.sin(phi)
    x, y = origin
    return np.array([[c, -s, x - c * x + s * y], [s, c, y - s * x - c * y]])


def chained(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The matrix of ``first`` and then ``second``."""
    whole = np.vstack((second, [0, 0, 1])) @ np.vstack((first, [0, 0, 1]))
    return whole[:2]


def transformed(points: DataFrame, matrix: np.ndarray, x: str = "x", y: str = "y") -> DataFrame:
    """Points moved by an affine matrix of two rows."""
    (a, b, c), (d, e, f) = matrix.tolist()
    return points.withColumns({x: F.col(x) * a + F.col(y) * b + c, y: F.col(x) * d + F.col(y) * e + f})
