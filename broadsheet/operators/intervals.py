"""Intervals on a line: unions, coverage, runs, clusters of positions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.operators.grouped import each_group


def merged(df: DataFrame, keys: Sequence[str], lo: str = "lo", hi: str = "hi", extend: float = 1) -> DataFrame:
    """Unions of the overlapping intervals [lo, hi + extend) of each key, by gaps and islands."""
    order = W.partitionBy(*keys).orderBy("lo", "hi")
    rows = df.select(*keys, F.col(lo).alias("lo"), (F.col(hi) + extend).alias("hi"))
    reach = F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("starts", F.when(F.col("lo") <= reach, 0).otherwise(1))
    rows = rows.withColumn("island", F.sum("starts").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def coverage(df: DataFrame, keys: Sequence[str], lo: str = "lo", hi: str = "hi", extend: float = 1) -> DataFrame:
    """Covered length of each key."""
    return merged(df, keys, lo, hi, extend).groupBy(*keys).agg(F.sum(F.col("hi") - F.col("lo")).alias("covered"))


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Run-length encoding: (keys, run, value, length) of successive equal values; NULL equals NULL."""
    w = W.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(w) == 1
    rows = df.withColumn("changed", F.when(first | ~F.lag(value).over(w).eqNullSafe(F.col(value)), 1).otherwise(0))
    rows = rows.withColumn("run", F.sum("changed").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "run").agg(F.first(value).alias(value), F.count("*").alias("length"))


def average_link(values: np.ndarray, distance: float) -> np.ndarray:
    """Cluster numbers of sorted positions, average linkage: the two nearest neighbouring clusters join while nearer than ``distance``."""
    groups = [[v] for v in values]
    while len(groups) > 1:
        means = np.array([np.mean(g) for g in groups])
        gaps = np.diff(means)
        k = int(np.argmin(gaps))
        if gaps[k] >= distance:
            break
        groups[k : k + 2] = [groups[k] + groups[k + 1]]
    return np.repeat(np.arange(len(groups)), [len(g) for g in groups])


def position_clusters(df: DataFrame, keys: Sequence[str], position: str, distance: float = 20) -> DataFrame:
    """(keys, position, n, lo, hi): clusters of positions of each key, each at its median.

    On a line the mean distance of two clusters that do not interleave is the distance of their means, so neighbours suffice.
    """
    keys = list(keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keys) + ", position double, n bigint, lo double, hi double"

    def work(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        v = np.sort(g[position].astype(float))
        c = average_link(v, distance)
        parts = [v[c == k] for k in range(c.max() + 1)] if len(v) else []
        out = {k: np.repeat(g[k][:1], len(parts)) for k in keys}
        return out | {"position": np.array([np.median(p) for p in parts]), "n": np.array([len(p) for p in parts], np.int64), "lo": np.array([p[0] for p in parts]), "hi": np.array([p[-1] for p in parts])}

    return each_group(df.select(*keys, position).filter(F.col(position).isNotNull()), keys, schema, work)


def kept_positions(clusters: DataFrame, pieces: DataFrame, spans: DataFrame, keys: Sequence[str], distance: float = 20, least: float = 0.3) -> DataFrame:
    """Clusters whose separator pieces (keys, position, lo, hi) cover more than ``least`` of the key's span (keys, length)."""
    near = clusters.withColumnRenamed("lo", "clo").withColumnRenamed("hi", "chi").withColumnRenamed("position", "at")
    owned = pieces.join(near, list(keys)).filter((F.col("position") >= F.col("clo")) & (F.col("position") <= F.col("chi")))
    covered = coverage(owned.select(*keys, "at", "lo", "hi"), [*keys, "at"])
    return covered.join(spans, list(keys)).filter(F.col("covered") / F.col("length") > least).select(*keys, F.col("at").alias("position"), "covered")
