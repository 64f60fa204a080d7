"""Problem 3: millions of tiny files come out as few well-sized ones, every record of a place exactly once.

1. The manifest is frozen: one row for each file with its place (path in normal form) and its text without byte-order mark and
   trailing line ends, written once to the shared folder in the order of place and text.
2. A file gives no record of its own if another file of its place holds the same text (the smallest ``file_id`` stays) or a
   longer one that begins with it. Sorted by place and text, a text that begins others stands right before one of them, so
   one look at the next different text decides. The order is a range partitioning over place and text: a place with a third of
   all files spreads over many tasks. The first row after a partition's end is fetched from a table of one row for each partition.
3. The plan is SQL over the manifest: bytes of the kept files are summed in order (within partitions, then partition totals, of
   which there are as many as tasks), and every ``target_bytes`` begin a new group.
4. ``rewrite`` gives each group to one task as one file, in waves of ``WAVE`` groups, and ``reconcile`` compares counts and bytes.

A NULL text reads as empty, a NULL path is a place of its own for every file and is kept. An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.functions.paths import normal_path
from broadsheet.session import broadcast_if_small, write_shared

TARGET_BYTES = 128 << 20
#: Groups written by one job; it bounds the tasks of a job, not the groups.
WAVE = 20_000


def record_text(text: Column) -> Column:
    """The text without a leading byte-order mark and trailing line ends; NULL reads as empty."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "^﻿", ""), r"[\r\n]+\z", "")


def frozen_manifest(files: DataFrame) -> DataFrame:
    """(file_id, place, record, n_bytes, part, seq): the manifest in order; ``part`` is the range partition, ``seq`` the order in it.

    It is written before anything is planned: what later steps see does not change if a task is run again.
    """
    place = F.coalesce(normal_path(F.col("path")), F.concat(F.lit("\u0000no path "), F.col("file_id").cast("string")))
    rows = files.select(F.col("file_id").cast("bigint").alias("file_id"), place.alias("place"), record_text(F.col("ocr_text")).alias("record"), F.coalesce("n_bytes", F.lit(0)).cast("bigint").alias("n_bytes"))
    ordered = rows.repartitionByRange("place", "record", "file_id").sortWithinPartitions("place", "record", "file_id")
    return write_shared(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq")), "manifest")


def with_role(manifest: DataFrame) -> DataFrame:
    """Adds ``kept``: whether the file gives a record.

    One pass over each partition in order. A partition's last texts also need the first row of the next partition that is not
    empty, and its first row needs the last of the one before: those are at most two rows for each partition.
    """
    ends = manifest.groupBy("part").agg(F.min_by(F.struct("place", "record"), "seq").alias("first"), F.max_by(F.struct("place", "record"), "seq").alias("last"))
    order = W.orderBy("part")
    ends = ends.select("part", F.lead("first").over(order).alias("following"), F.lag("last").over(order).alias("preceding"))
    within = W.partitionBy("part").orderBy("seq")
    same = lambda a, b: (a["place"] == b["place"]) & (a["record"] == b["record"])
    rows = manifest.join(broadcast_if_small(write_shared(ends, "partition-ends")), "part")
    me = F.struct("place", "record")
    before = F.coalesce(F.lag(me).over(within), F.col("preceding"))
    after = F.coalesce(F.lead(me).over(within), F.col("following"))
    rows = rows.withColumn("repeat", F.coalesce(same(before, me), F.lit(False))).withColumn("after", after)
    # a repeated text is dropped for its own sake; of the last row of a run the next text tells whether it begins that one
    begins = F.coalesce((F.col("after.place") == F.col("place")) & (F.col("after.record") != F.col("record")) & F.col("after.record").startswith(F.col("record")), F.lit(False))
    return rows.withColumn("begins", begins).drop("after", "preceding", "following")


def roles(manifest: DataFrame) -> DataFrame:
    """(file_id, place, record, n_bytes, part, seq, kept)."""
    rows = with_role(manifest)
    # only the last row of a run of equal texts sees the next text; its finding goes to the first, which is the one to stay
    told = rows.filter("begins").select(F.col("place").alias("__p"), F.col("record").alias("__r")).distinct()
    out = rows.join(told, (F.col("place") == F.col("__p")) & (F.col("record") == F.col("__r")), "left")
    return out.withColumn("kept", ~F.col("repeat") & F.col("__p").isNull()).select("file_id", "place", "record", "n_bytes", "part", "seq", "kept")


def plan(manifest: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Adds ``kept`` and ``group``: the output file of a kept record, by intervals of ``target_bytes`` of the running sum; NULL for a file without a record."""
    rows = write_shared(roles(manifest), "roles")
    size = F.when(F.col("kept"), F.octet_length("record") + 1).otherwise(0)
    rows = rows.withColumn("size", size)
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"))
    start = totals.select("part", (F.sum("bytes").over(W.orderBy("part")) - F.col("bytes")).alias("start"))
    running = F.sum("size").over(W.partitionBy("part").orderBy("seq")) - F.col("size")
    rows = rows.withColumn("running", running).join(F.broadcast(start), "part")
    group = F.when(F.col("kept"), F.floor((F.col("start") + F.col("running")) / F.lit(target_bytes)).cast("bigint"))
    return rows.withColumn("group", group).select("file_id", "place", "record", "n_bytes", "size", "kept", "group")


def written_plan(manifest: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """The plan, written to the shared folder: what ``rewrite`` and ``reconcile`` read."""
    return write_shared(plan(manifest, target_bytes), "plan")


def rewrite(planned: DataFrame, path: str, fmt: str = "parquet", wave: int = WAVE) -> None:
    """Writes the kept records of a plan read from files, each group by one task as one file; ``group`` stays a column.

    Every wave is a job over a stretch of groups, which lie together in the plan, so that it reads that stretch only.
    """
    kept = planned.filter("kept").select("place", "record", "file_id", "group")
    groups = kept.agg(F.coalesce(F.max("group"), F.lit(-1))).first()[0] + 1
    for start in range(0, max(1, groups), wave):
        n = min(wave, max(1, groups) - start)
        part = kept.filter(F.col("group").between(start, start + n - 1))
        part.repartitionById(n, (F.col("group") - start).cast("int")).sortWithinPartitions("place", "record").write.format(fmt).mode("append" if start else "errorifexists").save(path)


def reconcile(planned: DataFrame, written: DataFrame) -> DataFrame:
    """(group, n_planned, n_written, ok) of every group of either side."""
    a = planned.filter("kept").groupBy("group").agg(F.count("*").alias("n_planned"), F.sum(F.xxhash64("place", "record").cast("decimal(38,0)")).alias("a"))
    b = written.groupBy(F.col("group").cast("bigint").alias("group")).agg(F.count("*").alias("n_written"), F.sum(F.xxhash64("place", "record").cast("decimal(38,0)")).alias("b"))
    joined = a.join(b, "group", "full_outer").na.fill(0, ["n_planned", "n_written"])
    return joined.select("group", "n_planned", "n_written", (F.coalesce(F.col("a") == F.col("b"), F.lit(False)) & (F.col("n_planned") == F.col("n_written"))).alias("ok"))


def superfluous(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(file_id) of the files that give no record of their own, from the plan."""
    return plan(frozen_manifest(files), target_bytes).filter("group IS NULL").select("file_id")
