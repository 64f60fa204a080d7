"""Connected components of edge tables by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.session import write_shared


#: Parts of a node's edges.
SALTS = 4


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """(node, component) of every node of an edge; the component is its smallest node.

    Every step groups by a node and takes the minimum with a partial aggregate; no list of a node's neighbours is made. A hub's edges
    are joined to its minimum under ``SALTS`` parts of its key, so that they spread over as many tasks. Loops and NULL ends are
    ignored, repeated edges count once. Each round is written to the shared folder, so the plan stays short and a lost executor costs a
    task. The steps go on until nothing changes (about the logarithm of the longest path); ``max_rounds`` only guards against an error and
    raises.
    """
    pair = lambda x, y: F.struct(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    now = write_shared(edges.select(pair(F.col(a), F.col(b)).alias("e")).select("e.*").filter("u <> v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = least.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        large = both.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least, ["u", "part"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        small = large.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(low, ["u", "part"]).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        now = write_shared(small, "star")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components not found in {max_rounds} rounds")
    labels = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return labels.unionAll(labels.select(F.col("component").alias("node"), "component").distinct())
