"""Streams of run records: late and repeated records, counts by time window, pages that remain pending."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.operators.incremental import State, content_hash, page_key

#: How late a record may come after the latest one seen.
LATENESS = "30 days"


def run_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Run records as they are written as Parquet below ``path``, normalised."""
    schema = spark.read.parquet(path).schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        # a stream watches a folder: that of the file, with no other file in it
        raw = raw.option("pathGlobFilter", at.getName())
        path = str(at.getParent())
    raw = raw.parquet(path)
    return raw.select("run_id", page_key(F.col("page_path")).alias("page"), F.lower(F.trim("batch")).alias("batch"), F.upper(F.trim("status")).alias("status"), "elapsed", F.col("started_at").cast("timestamp").alias("started_at"), F.col("recorded_at").cast("timestamp").alias("recorded_at"))


def once(runs: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Each attempt (page, batch, start) once, repeats within ``lateness`` of its record dropped; state is kept no longer."""
    return runs.withWatermark("recorded_at", lateness).dropDuplicatesWithinWatermark(["page", "batch", "started_at"])


def window_counts(runs: DataFrame, window: str = "7 days", lateness: str = LATENESS) -> DataFrame:
    """(window_start, batch, status, n) of the attempts' starts in tumbling windows; late records count until the watermark passes."""
    w = F.window("started_at", window)
    return runs.withWatermark("started_at", lateness).groupBy(w.alias("w"), "batch", "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "batch", "status", "n")


def drained_table(df: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Runs an aggregating stream over all that is there now; the complete result, one row for each group, is held in memory."""
    df.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.table(name)


def drained_files(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs an appending stream over all that is there now into Parquet files, each record once, and reads them."""
    df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_state(runs: DataFrame, state: State, checkpoint: str, batch: str = "compose", after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """A stream that keeps the start of each page's last completed run as state versions; a micro-batch that is repeated changes nothing.

    The state holds (key, hash, started_at); ``after`` gets the new state of each micro-batch.
    """

    def step(rows: DataFrame, number: int) -> None:
        done = rows.filter((F.col("status") == "COMPLETED") & (F.col("batch") == batch)).groupBy(F.col("page").alias("key")).agg(F.max("started_at").alias("started_at"))
        version, old = state.version(), state.read()
        both = done if old is None else done.unionByName(old.select("key", "started_at"))
        new = both.groupBy("key").agg(F.max("started_at").alias("started_at")).select("key", content_hash(F.col("started_at")).alias("hash"), "started_at")
        if not state.commit(new, version):
            raise RuntimeError("another stream has changed the state meanwhile")
        if after:
            after(state.read(), number)

    return runs.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
