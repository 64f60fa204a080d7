"""Problem 5: each run processes exactly the records added or changed since the last run that succeeded.

State lies in numbered versions below one folder that outlives the run: the content each path has now, the last completed run of each
page, the (path, content hash) that this run has seen, and the source files that were read. A call

1. reads the version in force and lists the source files; files that are in the state already are not opened,
2. folds the rows of the other files into the state (repeats change nothing; a path whose new listing is older than its last one
   is computed anew from all its listings),
3. writes the next version beside the old one and puts it in force by creating a pointer with overwriting off: of two runs the
   store lets one win, the other starts again from the winner's version,
4. joins the hashes of the current contents with those the state has seen; what is new or differs must be processed.

A run that dies before the pointer is written leaves the old version in force, so nothing is skipped; folding is repeatable, so nothing
is taken as done twice. A source file that has vanished or was rewritten makes the state start from nothing.

For page files the content of a path is its last change: the listing whose fingerprint differs from that of the path's listing
before. All of it is grouped with partial aggregates: a path listed very often is no single task's list.

NULL paths are left out. A NULL fingerprint is a fingerprint like any other. A listing without a time counts as the earliest; a path
whose every listing has no time is done by any completed run. Repeated listings and runs change nothing. ``done`` is not read.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.functions.paths import normal_path
from broadsheet.session import shared_dir, write_shared

#: A time before all others.
EARLIEST = "0001-01-01 00:00:00"
#: Folders of state that no pointer in force names are removed when they are older than this.
ORPHAN_SECONDS = 24 * 3600
#: Versions that are kept, for readers of the one before.
KEPT_VERSIONS = 2


class State:
    """Versions of named tables below one folder; the highest ``current-<n>`` that is complete names the one in force."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what lies in the folder."""
        if not self.fs.exists(self.hadoop(self.path)):
            return []
        return [(str(f.getPath().getName()), int(f.getModificationTime())) for f in self.fs.listStatus(self.hadoop(self.path))]

    def _pointers(self) -> list[int]:
        return sorted((int(n.removeprefix("current-")) for n, _ in self._names() if n.startswith("current-")), reverse=True)

    def version(self) -> int:
        """The number of the version in force, 0 if there is none. A pointer whose writer died within it is passed over."""
        return next((v for v in self._pointers() if self._folder(v)), 0)

    def next_version(self) -> int:
        return max(self._pointers(), default=0) + 1

    def read(self, name: str = "rows") -> DataFrame | None:
        """A table of the version in force."""
        v = self.version()
        return self.spark.read.parquet(f"{self.path}/{self._folder(v)}/{name}") if v else None

    def _folder(self, version: int) -> str:
        stream = self.fs.open(self.hadoop(f"{self.path}/current-{version:09d}"))
        try:
            text = str(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return text[:-1] if text.endswith("\n") else ""

    def commit(self, rows: DataFrame | dict[str, DataFrame], expected: int) -> bool:
        """Puts ``rows`` (one table, or several by name) in force after version ``expected``; False, and nothing changed, if another run has
        put one in force meanwhile. The pointer is created with overwriting off, so the store decides between two runs.
        """
        target = self.next_version()
        if self.version() != expected:
            return False
        folder = f"state-{target:09d}-{uuid.uuid4().hex}"
        for name, df in (rows if isinstance(rows, dict) else {"rows": rows}).items():
            df.write.parquet(f"{self.path}/{folder}/{name}")
        from py4j.protocol import Py4JJavaError

        try:
            if self.version() != expected:
                raise FileExistsError
            out = self.fs.create(self.hadoop(f"{self.path}/current-{target:09d}"), False)
        except (Py4JJavaError, FileExistsError) as e:
            self.fs.delete(self.hadoop(f"{self.path}/{folder}"), True)
            if isinstance(e, Py4JJavaError) and self.next_version() == target:
                raise  # no other run's pointer is there: the store cannot be written
            return False
        out.write(bytearray((folder + "\n").encode()))
        out.close()
        self.clear()
        return True

    def clear(self, now: float | None = None) -> int:
        """Removes old versions and folders that failed runs have left; gives how many folders went."""
        kept = {self._folder(v) for v in self._pointers()[:KEPT_VERSIONS]}
        edge, n = ((now or time.time()) - ORPHAN_SECONDS) * 1000, 0
        for name, changed in self._names():
            if name.startswith("state-") and name not in kept and changed < edge:
                n += bool(self.fs.delete(self.hadoop(f"{self.path}/{name}"), True))
        return n


def content_hash(*columns: Column) -> Column:
    """A digest in which NULL and the empty string differ and the columns keep apart."""
    return F.sha2(F.to_json(F.struct(*[c.cast("string").alias(f"c{k}") for k, c in enumerate(columns)]), {"ignoreNullFields": "false"}), 256)


def pending(current: DataFrame, state: DataFrame | None, key: str = "key") -> DataFrame:
    """Rows of ``current`` (key, hash, ..) that are new or changed against ``state`` (key, hash), with ``change``: 'new' or 'changed'."""
    if state is None:
        return current.withColumn("change", F.lit("new"))
    old = state.select(F.col(key).alias("__key"), F.col("hash").alias("__hash"))
    joined = current.join(old, current[key] == old["__key"], "left").filter(F.col("__key").isNull() | ~F.col("hash").eqNullSafe(F.col("__hash")))
    return joined.withColumn("change", F.when(F.col("__key").isNull(), "new").otherwise("changed")).drop("__key", "__hash")


# ---------------------------------------------------------------------------------------------------------------------
# Source files: which of them the state has seen.


def source_files(*tables: DataFrame) -> dict[str, list[int]]:
    """{file: [bytes, time of change]} of the files behind tables that are read from files."""
    found = {}
    for df in tables:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for f in df.inputFiles():
            p = hadoop(f)
            s = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
            found[f] = [int(s.getLen()), int(s.getModificationTime())]
    return found


def only_files(df: DataFrame, files: list[str]) -> DataFrame:
    """The rows of ``df`` that lie in ``files``; other files are not opened."""
    return df.sparkSession.read.schema(df.schema).parquet(*files) if files else df.limit(0)


# ---------------------------------------------------------------------------------------------------------------------
# Page files: contents by listings, runs by run records.


def listed(task: DataFrame) -> DataFrame:
    """(path, tag, at, id) of every listing with a path."""
    tag = F.coalesce(F.concat(F.lit("="), F.col("etag")), F.lit("none"))
    at = F.coalesce(F.col("changed_at").cast("timestamp"), F.lit(EARLIEST).cast("timestamp"))
    return task.filter(F.col("path").isNotNull()).select(normal_path(F.col("path")).alias("path"), tag.alias("tag"), at.alias("at"), F.col("task_id").alias("id"))


def folded(rows: DataFrame) -> DataFrame:
    """(path, tag, at, last_at, last_id): the content each path has now, ``at`` the listing in which it changed last.

    ``rows`` are listings, and for a path known before one row with ``known`` = when its content in force changed. Listings of one path
    are compared only with the next, by a sort within hash partitions of (path, month) first: within a month by window, between
    months by the first and last listing of each, so that an often listed path is cut up by time.
    """
    rows = rows.withColumn("month", F.date_format("at", "yyyyMM"))
    inside = W.partitionBy("path", "month").orderBy("at", "id")
    rows = rows.withColumn("before", F.lag("tag").over(inside)).withColumn("first", F.row_number().over(inside) == 1)
    last = F.max(F.struct("at", "id", "tag"))
    per = rows.groupBy("path", "month").agg(
        last.alias("last"), F.max(F.when(~F.col("first") & (F.col("tag") != F.col("before")), F.col("at"))).alias("inner"),
        F.min(F.when(F.col("first"), F.struct("tag", "at", "known"))).alias("opens"),
    )
    earlier = F.lag("last.tag").over(W.partitionBy("path").orderBy("month"))
    edge = F.when(F.col("opens.known").isNotNull(), F.col("opens.known")).when(~F.col("opens.tag").eqNullSafe(F.col("earlier")), F.col("opens.at"))
    per = per.withColumn("earlier", earlier).withColumn("changed", F.greatest("inner", edge))
    done = per.groupBy("path").agg(F.max("changed").alias("at"), F.max("last").alias("last"))
    return done.select("path", F.col("last.tag").alias("tag"), "at", F.col("last.at").alias("last_at"), F.col("last.id").alias("last_id"))


def page_key(path: Column) -> Column:
    """Key that task and runtime paths share: normal form, lower case, without the archive's root."""
    return F.regexp_replace(F.lower(normal_path(path)), "^/?archive/|^/", "")


def completed_runs(runtime: DataFrame, batch: str = "compose") -> DataFrame:
    """(key, started_at): start of the last completed run of each page; case and outer spaces of batch, status and path mean nothing."""
    good = (F.upper(F.trim("status")) == "COMPLETED") & (F.lower(F.trim("batch")) == batch)
    return runtime.filter(good & F.col("page_path").isNotNull()).groupBy(page_key(F.col("page_path")).alias("key")).agg(F.max("started_at").alias("started_at"))


def contents(task: DataFrame, fresh: DataFrame, known: DataFrame | None) -> DataFrame:
    """The contents after the listings ``fresh`` (part of ``task``) came in over the contents ``known``."""
    new = listed(fresh).withColumn("known", F.lit(None).cast("timestamp"))
    if known is None:
        return folded(new)
    new = write_shared(new, "fresh-listings")
    touched = new.groupBy("path").agg(F.min(F.struct("at", "id")).alias("least"))
    state = known.join(touched, "path", "left")
    late = write_shared(state.filter((F.col("least.at") < F.col("last_at")) | ((F.col("least.at") == F.col("last_at")) & (F.col("least.id") <= F.col("last_id")))).select("path"), "late-paths")
    if late.isEmpty():
        again, onward, base = None, new, state.filter("least IS NOT NULL")
    else:
        again = listed(task).withColumn("known", F.lit(None).cast("timestamp")).join(late, "path", "left_semi")
        onward, base = new.join(late, "path", "left_anti"), state.filter("least IS NOT NULL").join(late, "path", "left_anti")
    rows = onward.unionByName(base.select("path", "tag", F.col("last_at").alias("at"), F.col("last_id").alias("id"), F.col("at").alias("known")))
    moved = folded(rows if again is None else rows.unionByName(again))
    return known.join(touched, "path", "left_anti").unionByName(moved)


def advance(state: State, task: DataFrame, runtime: DataFrame) -> None:
    """Folds the source files that the state has not seen into its next version. Nothing is read or written if there are none."""
    spark = task.sparkSession
    while True:
        expected = state.version()
        now = {"task": source_files(task), "runtime": source_files(runtime)}
        seen: dict[str, dict[str, list[int]]] = {"task": {}, "runtime": {}}
        if expected:
            for r in state.read("sources").toLocalIterator():
                seen[r["source"]][r["file"]] = [r["bytes"], r["changed"]]
            if any(now[s].get(f) != v for s in seen for f, v in seen[s].items()):
                seen = {"task": {}, "runtime": {}}
        fresh = {s: sorted(now[s].keys() - seen[s].keys()) for s in now}
        onward = bool(expected) and any(seen.values())
        if onward and not fresh["task"] and not fresh["runtime"]:
            return
        have = contents(task, only_files(task, fresh["task"]) if onward else task, state.read("contents") if onward else None)
        ran = completed_runs(only_files(runtime, fresh["runtime"]) if onward else runtime)
        if onward:
            ran = ran.unionByName(state.read("runs")).groupBy("key").agg(F.max("started_at").alias("started_at"))
        have, ran = write_shared(have, "contents"), write_shared(ran, "runs")
        done = have.withColumn("key", page_key(F.col("path"))).join(ran, "key")
        # a run that began before the content in force came has seen another one, whatever it was
        saw = done.select("path", F.when(F.col("started_at") >= F.col("at"), content_hash(F.col("tag"), F.col("at"))).alias("hash"))
        files = [(s, f, *v) for s in now for f, v in now[s].items()]
        sources = spark.createDataFrame(files, "source string, file string, bytes bigint, changed bigint").coalesce(1)
        if state.commit({"contents": have, "runs": ran, "seen": saw, "sources": sources}, expected):
            return


def state_path(task: DataFrame, runtime: DataFrame) -> str:
    """The folder of the state of these sources in the shared folder: the same in every run over the same places."""
    places = sorted({f.rsplit("/", 1)[0] for f in (*task.inputFiles(), *runtime.inputFiles())})
    return f"{shared_dir(task.sparkSession)}/run-state/{hashlib.sha256(chr(10).join(places).encode()).hexdigest()[:32]}"


def pending_paths(task: DataFrame, runtime: DataFrame, path: str | None = None) -> DataFrame:
    """(path, change) of what the next run must process: the state at ``path`` is brought up to the sources, and the contents are joined with what it has seen."""
    state = State(task.sparkSession, path or state_path(task, runtime))
    advance(state, task, runtime)
    current = state.read("contents").select("path", content_hash(F.col("tag"), F.col("at")).alias("hash"))
    return pending(current, state.read("seen"), "path").select("path", "change")
