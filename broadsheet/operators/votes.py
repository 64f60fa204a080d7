"""Votes and weighted measures over predictors and lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def majority(votes: DataFrame, keys: Sequence[str], label: str = "label", undecided: int = 0) -> DataFrame:
    """The label most predictors give; a tie for the first place is ``undecided``."""
    counted = votes.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count("*").alias("n"))
    best = counted.groupBy(*keys).agg(F.max_by(label, "n").alias("best"), F.max("n").alias("n"), F.collect_list("n").alias("all"))
    ties = F.size(F.filter("all", lambda x: x == F.col("n")))
    return best.select(*keys, F.when(ties > 1, F.lit(undecided)).otherwise(F.col("best")).alias(label))


def highest_sum(scores: DataFrame, keys: Sequence[str], label: str, score: str) -> DataFrame:
    """The label with the highest sum of scores over all models; the smaller label among equals."""
    sums = scores.groupBy(*keys, label).agg(F.sum(score).alias("s"))
    return sums.groupBy(*keys).agg(F.min_by(label, F.struct(-F.col("s"), F.col(label))).alias(label), F.max("s").alias("score"))


def label_shares(pixels: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """(keys, confidence): map of each label to its share of a line's pixels."""
    counted = pixels.groupBy(*keys, label).agg(F.count("*").alias("n"))
    share = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(label), (F.col("n") / F.col("total")).alias("share")))))
    return counted.join(pixels.groupBy(*keys).agg(F.count("*").alias("total")), list(keys)).groupBy(*keys).agg(share.alias("confidence"))


def predicted(confidence: Column, own: Column, background: str = "BACKGROUND") -> Column:
    """struct(label, share, error): the best label that is not background (the first among equals), its share, and by how much it beats ``own``."""
    entries = F.filter(F.map_entries(confidence), lambda e: e["key"] != background)
    best = F.aggregate(
        entries, F.struct(F.lit(None).cast("string").alias("key"), F.lit(0.0).alias("value")), lambda acc, e: F.when(e["value"] > acc["value"], F.struct(e["key"].alias("key"), e["value"].cast("double").alias("value"))).otherwise(acc)
    )
    return F.struct(best["key"].alias("label"), best["value"].alias("share"), (best["value"] - F.coalesce(F.element_at(confidence, own), F.lit(0.0))).alias("error"))


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """Weighted median of each key: at place p = (sum of weights up to the value - half its own) / all weights, linear between the values around 0.5."""
    w = W.partitionBy(*keys).orderBy(value, weight)
    rows = df.filter(F.col(value).isNotNull() & (F.col(weight) > 0))
    rows = rows.withColumn("p", (F.sum(weight).over(w.rowsBetween(W.unboundedPreceding, 0)) - F.col(weight) / 2) / F.sum(weight).over(W.partitionBy(*keys)))
    low = F.max(F.when(F.col("p") <= 0.5, F.struct("p", F.col(value).alias("v")))).alias("low")
    high = F.min(F.when(F.col("p") >= 0.5, F.struct("p", F.col(value).alias("v")))).alias("high")
    at = rows.groupBy(*keys).agg(low, high)
    part = (0.5 - F.col("low.p")) / (F.col("high.p") - F.col("low.p"))
    between = F.when(F.col("low").isNull(), F.col("high.v")).when(F.col("high").isNull(), F.col("low.v")).when(F.col("high.p") == F.col("low.p"), F.col("low.v"))
    return at.select(*keys, between.otherwise(F.col("low.v") + part * (F.col("high.v") - F.col("low.v"))).alias("median"))


def weighted_mean(value: str, weight: str) -> Column:
    """Sum of weight times value over the sum of weights; NULL without weight."""
    return F.when(F.sum(weight) != 0, F.sum(F.col(value) * F.col(weight)) / F.sum(weight))


def mean_skew(segments: DataFrame, keys: Sequence[str], limit: float = 15) -> DataFrame:
    """Length-weighted mean angle (degrees) of the segments within ``limit``; the standing ones (label 'V') if there are any."""
    near = segments.filter(F.abs("phi") <= limit)
    stand, rest = F.when(F.col("label") == "V", F.col("length")), F.col("length")
    mean = lambda w: F.sum(F.col("phi") * w) / F.sum(w)
    return near.groupBy(*keys).agg(F.when(F.sum(stand) > 0, mean(stand)).otherwise(mean(rest)).alias("skew"))


def line_metrics(lines: DataFrame) -> DataFrame:
    """Adds length, angle, centre and height of lines given by origin (px, py) and the vectors right and up."""
    half = lambda p, r, u: F.col(p) + (F.col(r) + F.col(u)) / 2
    return lines.withColumns({
        "length": F.hypot("right_x", "right_y"), "height": F.hypot("up_x", "up_y"), "angle": F.atan2("right_y", "right_x"),
        "center_x": half("px", "right_x", "up_x"), "center_y": half("py", "right_y", "up_y"),
    })


def spread(samples: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Population standard deviation of more than three samples, else 0."""
    return samples.groupBy(*keys).agg(F.when(F.count(value) > 3, F.stddev_pop(value)).otherwise(0.0).alias("std"))


def path_angles(points: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """(keys, order, angle) at each point of a polyline: of the first and last segment at the ends, the mean of both segments between."""
    w = W.partitionBy(*keys).orderBy(order)
    step = F.atan2(F.lead("y").over(w) - F.col("y"), F.lead("x").over(w) - F.col("x"))
    rows = points.withColumn("out", step)
    came = F.lag("out").over(w)
    return rows.withColumn("in", came).select(*keys, order, F.when(F.col("in").isNull(), F.col("out")).when(F.col("out").isNull(), F.col("in")).otherwise((F.col("in") + F.col("out")) / 2).alias("angle"))
