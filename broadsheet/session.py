"""Session helpers: shared folder, size-checked broadcast, shipping the package to executors."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in bytes of its serialised rows, that may be broadcast.
BROADCAST_LIMIT = 32 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only where that setting is absent and all tasks run on this machine a temporary folder takes its place; on a cluster, whose executors
    could not see it, the absence is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="broadsheet-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Tables that this driver has written to the shared folder.
_written: list[str] = []


def write_shared(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes ``df`` once as Parquet into the shared folder and reads it back.

    It cuts the lineage: a lost executor costs its tasks, not the plan before it. ``clear_shared`` removes the tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> int:
    """Removes the tables that ``write_shared`` has made; for when no result that reads them is needed any more. Gives their number."""
    hadoop, n = spark._jvm.org.apache.hadoop.fs.Path, len(_written)
    while _written:
        p = hadoop(_written.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


def drop_shared(df: DataFrame) -> None:
    """Removes a table that ``write_shared`` has made, when all that reads it is written."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _written[:] = [x for x in _written if x.rpartition("/")[2] != p.getName()]


def release(spark: SparkSession) -> None:
    """Has Spark remove the shuffle files of the jobs that are over; by itself it does so when the driver collects its garbage, which may be long after."""
    spark.range(1).write.format("noop").mode("overwrite").save()  # the last job is held until another has run
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.2)  # the files go in the background


def size_of(df: DataFrame) -> int:
    """Bytes on disk of a DataFrame read from files."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    total = 0
    for f in df.inputFiles():
        p = hadoop(f)
        total += p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen()
    return total


def broadcast_if_small(df: DataFrame, factor: int = 8, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """A broadcast hint for a table read from files whose bytes, times ``factor`` for compression, are under ``limit``; beyond it the optimiser joins by shuffle."""
    return F.broadcast(df) if size_of(df) * factor <= limit else df


def salted(many: DataFrame, few: DataFrame, on: list[str], part: Column, parts: int) -> DataFrame:
    """Inner equi-join in which the rows of a key of ``many`` spread over ``parts`` tasks by ``part``; ``few`` is repeated for each."""
    spread = many.withColumn("__part", F.pmod(F.xxhash64(part), F.lit(parts)).cast("int"))
    return spread.join(few.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), [*on, "__part"]).drop("__part")


def hot_join(left: DataFrame, right: DataFrame, key: str, spread_left: str, hot: int = 20_000) -> DataFrame:
    """Inner equi-join on ``key``; a key with more than ``hot`` rows of ``left`` is cut into parts of ``hot`` by a hash of ``spread_left``, and
    the rows of ``right`` of that key are repeated for each part. All rows of all keys are joined; both sides should be read from files.
    """
    heavy = left.groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot).select(key, F.ceil(F.col("__n") / hot).cast("int").alias("__parts"))
    heavy = write_shared(heavy, "hot-keys")
    if heavy.isEmpty():
        return left.join(right, key)
    heavy = broadcast_if_small(heavy)
    a = left.join(heavy, key, "left").withColumn("__part", F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread_left), F.col("__parts")).cast("int"))).drop("__parts")
    b = right.join(heavy, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return a.join(b, [key, "__part"]).drop("__part")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once a context."""
    sc = spark.sparkContext
    if getattr(sc, "_broadsheet_shipped", False):
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path(root.name) / p.relative_to(root))
    folder = tempfile.mkdtemp(prefix="broadsheet-ship-")
    path = os.path.join(folder, "broadsheet.zip")
    Path(path).write_bytes(data.getvalue())
    sc.addPyFile(path)
    sc._broadsheet_shipped = True
