"""Statistics of a corpus and of its processing, page signatures and their clusters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.functions.numbers import rounded
from broadsheet.operators.graph import connected_components
from broadsheet.session import broadcast_if_small, write_shared


#: Half the width, in shares of all values, of the band in which an exact percentile is looked for; smaller groups are ranked whole.
BAND = 0.001


def percentiles(df: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """(keys, n, q ARRAY): exact percentiles of each group, with linear interpolation between two values. NULLs do not count.

    A mergeable sketch gives a band around each percentile; how many values lie below a band is counted, and only the values within it
    (one in 250 of a large group) are ranked. No task holds all values of a group.
    """
    if not keys:
        return percentiles(df.withColumn("__all", F.lit(0)), ["__all"], value, shares).drop("__all")
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    edges = [e for q in shares for e in (max(0.0, q - 2 * BAND), min(1.0, q + 2 * BAND))]
    small = F.col("__n") * BAND < 2
    bands = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.percentile_approx("__v", edges, 10_000).alias("__e"), F.min("__v").alias("__least"), F.max("__v").alias("__most"))
    bands = write_shared(bands.withColumn("__b", F.explode(F.array(*[F.struct(F.lit(k).alias("__q"), F.when(small, F.col("__least")).otherwise(F.col("__e")[2 * k]).alias("__lo"), F.when(small, F.col("__most")).otherwise(F.col("__e")[2 * k + 1]).alias("__hi"), F.lit(q).alias("__share")) for k, q in enumerate(shares)]))).select(*keys, "__n", "__b.*"), "bands")
    on = [F.col(f"__k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)]
    met = rows.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__v").join(broadcast_if_small(bands), on).filter(F.col("__v") <= F.col("__hi"))
    # equal values are one row from here on
    counted = met.groupBy(*keys, "__q", "__n", "__share", F.when(F.col("__v") >= F.col("__lo"), F.col("__v")).alias("__x")).agg(F.count("*").alias("__c"))
    order = W.partitionBy(*keys, "__q").orderBy(F.col("__x").asc_nulls_first())
    ranked = counted.withColumn("__end", F.sum("__c").over(order.rowsBetween(W.unboundedPreceding, 0))).withColumn("__at", F.col("__share") * (F.col("__n") - 1))
    has = lambda i: F.max(F.when((F.col("__end") > i) & (F.col("__end") - F.col("__c") <= i), F.col("__x")))
    low, high = F.floor("__at"), F.ceil("__at")
    found = ranked.groupBy(*keys, "__q", "__n", "__at").agg(has(low).alias("__a"), has(high).alias("__z"))
    value_at = F.col("__a") + (F.col("__z") - F.col("__a")) * (F.col("__at") - F.floor("__at"))
    return found.groupBy(*keys, F.col("__n").alias("n")).agg(F.transform(F.array_sort(F.collect_list(F.struct("__q", value_at.alias("v")))), lambda x: x["v"]).alias("q"))


def elapsed(runs: DataFrame) -> DataFrame:
    """(batch, n, min, median, p90) of the completed runs' times; exact percentiles with linear interpolation, rounded to 6 places."""
    good = runs.filter("elapsed IS NOT NULL")
    r = lambda c: rounded(c, 6)
    least = good.groupBy("batch").agg(r(F.min("elapsed")).alias("min_s")).withColumnRenamed("batch", "__batch")
    found = percentiles(good, ["batch"], "elapsed", [0.5, 0.9]).join(least, F.col("batch").eqNullSafe(F.col("__batch")))
    return found.select("batch", "n", "min_s", r(F.col("q")[0]).alias("median_s"), r(F.col("q")[1]).alias("p90_s"))


def errors(runs: DataFrame) -> DataFrame:
    """(batch, traceback, n, first_page, n_pages) of failed runs; how many pages, and the first, rather than a list without end."""
    bad = runs.filter("traceback IS NOT NULL")
    return bad.groupBy("batch", "traceback").agg(F.count("*").alias("n"), F.min("page_path").alias("first_page"), F.countDistinct("page_path").alias("n_pages"))


def error_pages(runs: DataFrame) -> DataFrame:
    """(batch, traceback, page_path): every page of every error, one a row."""
    return runs.filter("traceback IS NOT NULL").select("batch", "traceback", "page_path").distinct()


def runtime_of(text: DataFrame, column: str) -> DataFrame:
    """(.., batch, status, elapsed, traceback) from JSON records {batch: {status, elapsed | total_time, traceback}}; bad JSON gives no row."""
    kind = "map<string, struct<status: string, elapsed: double, total_time: double, traceback: string>>"
    rows = text.withColumn("__m", F.from_json(column, kind)).select(*[c for c in text.columns if c != column], F.explode("__m").alias("batch", "__r"))
    return rows.select(*[c for c in rows.columns if c != "__r"], F.col("__r.status").alias("status"), F.coalesce("__r.elapsed", "__r.total_time").alias("elapsed"), F.col("__r.traceback").alias("traceback"))


def artifact_counts(artifacts: DataFrame, name: str, page: str) -> DataFrame:
    """(name, n, n_pages) of each kind of artifact."""
    return artifacts.groupBy(name).agg(F.count("*").alias("n"), F.countDistinct(page).alias("n_pages"))


def grid_signature(boxes: DataFrame, width: float, height: float, cells: int = 9) -> DataFrame:
    """(page_id, label, gx, gy, n): how many boxes of a label reach into each cell of a page grid; empty cells give no row."""
    cell = lambda v, size: F.least(F.greatest(F.floor(v * cells / F.lit(size)), F.lit(0)), F.lit(cells - 1)).cast("int")
    rows = boxes.withColumn("gx", F.explode(F.sequence(cell(F.col("minx"), width), cell(F.col("maxx"), width)))).withColumn("gy", F.explode(F.sequence(cell(F.col("miny"), height), cell(F.col("maxy"), height))))
    return rows.groupBy("page_id", "label", "gx", "gy").agg(F.count("*").alias("n"))


def position_signature(boxes: DataFrame, width: float, height: float, cells: int = 3) -> DataFrame:
    """(page_id, block_id, gx, gy, share): shares of a box's area in the cells of a coarse grid."""
    rows = boxes.withColumn("gx", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))).withColumn("gy", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    w, h = width / cells, height / cells
    dx = F.least(F.col("maxx"), (F.col("gx") + 1) * w) - F.greatest(F.col("minx"), F.col("gx") * w)
    dy = F.least(F.col("maxy"), (F.col("gy") + 1) * h) - F.greatest(F.col("miny"), F.col("gy") * h)
    whole = (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))
    share = F.when(whole > 0, F.greatest(dx, F.lit(0.0)) * F.greatest(dy, F.lit(0.0)) / whole)
    return rows.select("page_id", "block_id", "gx", "gy", rounded(share, 6).alias("share")).filter("share > 0")


#: Vectors of one block that are compared with those of another in one task.
BLOCK = 2000


def l1_pairs(vectors: DataFrame, key: str, vector: str, threshold: int) -> DataFrame:
    """(a, b, distance): vectors (ARRAY<INT> of one length) whose L1 distance is at most ``threshold``, the smaller key first; equal
    vectors go through the one of the smallest key.

    The sums of two such vectors differ by at most the threshold, so vectors meet in bands of their sum, each in its own and the one
    before. A band is cut into blocks by hash, and each pair of blocks is compared by one task in numpy, which gives near pairs only.
    """
    same = vectors.groupBy(vector).agg(F.min(key).alias("key")).select("key", F.col(vector).alias("v"))
    kind = vectors.schema[key].dataType.simpleString()
    band = F.floor(F.aggregate("v", F.lit(0), lambda a, x: a + x) / (threshold + 1))
    rows = write_shared(same.withColumn("own", band).withColumn("band", F.explode(F.array("own", F.col("own") - 1))), "vectors")
    blocks = rows.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = rows.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("band", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "own", "block", "key", "v")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        v, own, block = np.stack(pdf["v"]).astype(np.int32), pdf["own"].to_numpy(), pdf["block"].to_numpy()
        keys, low, cross = pdf["key"].to_numpy(), pdf["band"].iloc[0], pdf["p"].iloc[0] != pdf["q"].iloc[0]
        out = []
        for i in range(len(v) - 1):
            # of a pair one stands in the lower band of the two; a pair of one block is met by that block alone
            fits = ((own[i] == low) | (own[i + 1 :] == low)) & ((block[i] != block[i + 1 :]) if cross else True)
            j = i + 1 + np.flatnonzero(fits)
            d = np.abs(v[j] - v[i]).sum(1)
            near = d <= threshold
            out += [(min(keys[i], b), max(keys[i], b), int(n)) for b, n in zip(keys[j[near]], d[near])]
        return pd.DataFrame(out, columns=["a", "b", "distance"])

    near = cut.groupBy("band", "p", "q").applyInPandas(compare, f"a {kind}, b {kind}, distance int")
    copies = vectors.withColumnRenamed(vector, "v").join(same, "v").filter(F.col(key) != F.col("key")).select(F.col("key").alias("a"), F.col(key).alias("b"), F.lit(0).alias("distance"))
    return near.unionAll(copies)


def clusters(vectors: DataFrame, key: str, vector: str, threshold: int) -> DataFrame:
    """(key, cluster) of single linkage at ``threshold`` in L1: components of near pairs, named by their smallest key."""
    found = connected_components(l1_pairs(vectors, key, vector, threshold), "a", "b")
    return vectors.select(key).join(found, vectors[key] == found["node"], "left").select(key, F.coalesce("component", key).alias("cluster"))


def quantized(embeddings: DataFrame, column: str = "embedding", scale: float = 20, top: int = 2) -> DataFrame:
    """Vectors as small whole numbers: floor of absolute value times ``scale``, at most ``top``."""
    return embeddings.withColumn("vector", F.transform(column, lambda e: F.least(F.lit(top), F.floor(F.abs(e) * scale).cast("int"))))
