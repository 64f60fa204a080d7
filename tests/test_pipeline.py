"""Compaction of small files and incremental processing: defined results for odd inputs, exact counts, atomic state."""

import random
from datetime import datetime as dt

from pyspark.sql import functions as F

from broadsheet.functions.paths import normal_path
from broadsheet.operators import compaction, incremental

FILES = "file_id bigint, path string, ocr_text string, n_bytes bigint, written_at timestamp, place string"


def dropped(spark, rows):
    df = spark.createDataFrame([(i, p, t, None, None, "clash") for i, p, t in rows], FILES)
    return {r[0] for r in compaction.superfluous(df, 64).collect()}


def brute(rows):
    import posixpath
    import re

    def norm(p):
        return posixpath.normpath(re.sub("^/+", "/", p)) if p is not None else None

    def clean(t):
        return re.sub(r"[\r\n]+\Z", "", (t or "").removeprefix("﻿"))

    out = set()
    for i, p, t in rows:
        for j, q, u in rows:
            if i != j and p is not None and q is not None and norm(p) == norm(q):
                a, b = clean(t), clean(u)
                if (a == b and j < i) or (a != b and b.startswith(a)):
                    out.add(i)
    return out


def test_small_files_against_brute_force(spark):
    rng = random.Random(3)
    texts = ["", None, "a", "ab", "abc\n", "﻿abc", "abd", "b", "abc\r\n", "long " * 300, "long " * 300 + "x"]
    paths = ["/x/a", "/x//a", "/x/./a", "/x/tmp/../a", "//x/a", "/x/b", None]
    rows = [(k, rng.choice(paths), rng.choice(texts)) for k in range(120)]
    assert dropped(spark, rows) == brute(rows)


def test_lone_empty_file_stays_and_repeats_keep_the_smallest(spark):
    assert dropped(spark, [(1, "/a", ""), (2, "/b", "x"), (3, "/b", "x"), (4, "/b", ""), (5, None, ""), (6, None, "")]) == {3, 4}


def test_one_place_with_most_files(spark):
    rows = [(k, "/hot", f"t{k % 50:03d}") for k in range(400)] + [(1000 + k, f"/cold/{k}", "t") for k in range(50)]
    assert dropped(spark, rows) == {k for k in range(50, 400)}


def test_empty_table(spark):
    assert dropped(spark, []) == set()


def test_groups_hold_every_record_once(spark, tmp_path):
    df = spark.createDataFrame([(k, f"/p/{k}", "word " * (k % 7), None, None, None) for k in range(200)], FILES)
    planned = compaction.written_plan(compaction.frozen_manifest(df), 256)
    compaction.rewrite(planned, f"file://{tmp_path}/out", wave=3)
    written = spark.read.parquet(f"file://{tmp_path}/out")
    assert written.count() == 200
    assert compaction.reconcile(planned, written).filter("NOT ok").count() == 0
    sizes = [r["s"] for r in planned.filter("kept").groupBy("group").agg(F.sum("size").alias("s")).collect()]
    assert max(sizes) <= 256 + 36
    # one file for each group, and one group in each file
    files = written.groupBy(F.input_file_name().alias("f")).agg(F.countDistinct("group").alias("g")).collect()
    assert len(files) == len(sizes) and all(r["g"] == 1 for r in files)


def test_normal_path(spark):
    cases = {"/a/./b": "/a/b", "a//b/": "a/b", "/a/x/../b": "/a/b", "../a": "../a", "/../a": "/a", "a/../../b": "../b", " /a/b ": "/a/b", "": "", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "p string").select("p", normal_path(F.col("p")).alias("n"))
    assert {r["p"]: r["n"] for r in df.collect()} == cases


TASK = "task_id bigint, path string, done int, changed_at timestamp, etag string, key string"
RUN = "run_id bigint, page_path string, batch string, status string, elapsed double, traceback string, started_at timestamp, recorded_at timestamp"


def pending(spark, tasks, runs):
    t = spark.createDataFrame([(k, p, None, c, e, "clash") for k, (p, c, e) in enumerate(tasks)], TASK)
    r = spark.createDataFrame([(k, p, b, s, None, None, a, None) for k, (p, b, s, a) in enumerate(runs)], RUN)
    return {(x["path"], x["change"]) for x in incremental.pending_paths(t, r).collect()}


def test_pending(spark):
    day = lambda d: dt(2021, 3, d)
    tasks = [
        ("/archive/a/1.jpg", day(1), "x"), ("/archive/a/1.jpg", day(5), "x"),  # listed again, unchanged
        ("/archive/a/2.jpg", day(1), "x"), ("/archive/a/2.jpg", day(5), "y"),  # changed after its run
        ("/archive/a/3.jpg", day(1), "x"), ("/archive/a/3.jpg", day(3), "y"), ("/archive/a/3.jpg", day(5), "x"),  # changed back
        ("/archive/a/4.jpg", day(1), None), ("/archive/a/5.jpg", day(2), "x"), (None, day(1), "x"), ("/archive/a/6.jpg", None, "x"),
    ]
    runs = [
        ("a/1.jpg", "compose", "COMPLETED", day(2)), ("a//2.jpg", "compose", " completed ", day(2)), ("./A/3.jpg", "compose", "COMPLETED", day(2)), ("a/4.jpg", "compose", "COMPLETED", day(1)),
        ("a/5.jpg", "compose", "FAILED", day(9)), ("a/5.jpg", "ocr", "COMPLETED", day(9)), ("a/5.jpg", "compose", None, day(9)), ("a/6.jpg", "compose", "COMPLETED", day(1)), (None, "compose", "COMPLETED", day(9)),
    ]
    assert pending(spark, tasks, runs) == {("/archive/a/2.jpg", "changed"), ("/archive/a/3.jpg", "changed"), ("/archive/a/5.jpg", "new")}


def test_pending_of_empty_tables(spark):
    assert pending(spark, [], []) == set()
    assert pending(spark, [("/archive/a.jpg", dt(2021, 1, 1), "x")], []) == {("/archive/a.jpg", "new")}


def test_state_survives_failures_and_is_swapped_once(spark, tmp_path):
    state = incremental.State(spark, f"file://{tmp_path}/state")
    rows = lambda *ks: spark.createDataFrame([(k, "h") for k in ks], "key string, hash string")
    assert state.version() == 0 and state.read() is None
    assert state.commit(rows("a"), 0)
    # a run that wrote its rows and died before the swap leaves the old version in force
    rows("a", "b").write.parquet(f"file://{tmp_path}/state/state-000000002-dead")
    assert {r["key"] for r in state.read().collect()} == {"a"}
    # a second run that began from the same version may not swap after the first
    assert state.commit(rows("a", "b"), 1)
    assert not state.commit(rows("a", "c"), 1)
    assert {r["key"] for r in state.read().collect()} == {"a", "b"} and state.version() == 2


class Dying(incremental.State):
    """A run that dies at the end of its work, before or after the swap."""

    def __init__(self, spark, path, before):
        super().__init__(spark, path)
        self.before = before

    def commit(self, rows, expected):
        if self.before:
            for name, df in rows.items():
                df.write.parquet(f"{self.path}/state-000000009-dead/{name}")
            raise KeyboardInterrupt
        super().commit(rows, expected)
        raise KeyboardInterrupt


def test_runs_over_growing_files(spark, tmp_path):
    """New files are folded in, files seen before are not opened; crashes before and after the swap skip and repeat nothing."""
    day = lambda d: dt(2021, 3, d)
    where = f"file://{tmp_path}"
    batches = [
        ([("/archive/a/1.jpg", day(1), "x"), ("/archive/a/2.jpg", day(1), "x")], [("a/1.jpg", "compose", "COMPLETED", day(2))]),
        ([("/archive/a/1.jpg", day(5), "x"), ("/archive/a/2.jpg", day(6), "y"), ("/archive/a/3.jpg", day(6), "x")], [("a/2.jpg", "compose", "COMPLETED", day(7))]),
        # a late listing makes the later one a change; a run recorded late
        ([("/archive/a/1.jpg", day(3), "w"), ("/archive/a/2.jpg", day(8), "z")], [("a/3.jpg", "compose", "COMPLETED", day(8)), ("a/2.jpg", "compose", "FAILED", day(9))]),
    ]
    all_tasks, all_runs = [], []
    for k, (tasks, runs) in enumerate(batches):
        all_tasks += tasks
        all_runs += runs
        spark.createDataFrame([(10 * k + i, p, None, c, e, "clash") for i, (p, c, e) in enumerate(tasks)], TASK).write.mode("append").parquet(f"{where}/task")
        spark.createDataFrame([(10 * k + i, p, b, s, None, None, a, None) for i, (p, b, s, a) in enumerate(runs)], RUN).write.mode("append").parquet(f"{where}/run")
        t, r = spark.read.parquet(f"{where}/task"), spark.read.parquet(f"{where}/run")
        for before in (True, False):
            if k == 1:
                try:
                    incremental.advance(Dying(spark, f"{where}/state", before), t, r)
                except KeyboardInterrupt:
                    pass
        got = {x["path"] for x in incremental.pending_paths(t, r, f"{where}/state").collect()}
        assert got == {p for p, _ in pending(spark, all_tasks, all_runs)}, k
    state = incremental.State(spark, f"{where}/state")
    assert state.version() == 3
    import shutil

    for name in ("task", "run"):  # nothing but the listing of the files is needed by a run over unchanged sources
        for f in (tmp_path / name).glob("*.parquet"):
            stat, size = f.stat(), f.stat().st_size
            f.write_bytes(b"\0" * size)
            import os

            os.utime(f, ns=(stat.st_atime_ns, stat.st_mtime_ns))
            (tmp_path / name / f".{f.name}.crc").unlink(missing_ok=True)
    assert {x["path"] for x in incremental.pending_paths(t, r, f"{where}/state").collect()} == got and state.version() == 3
    assert state.clear() == 0 and state.clear(now=4e9) == 2  # the dead run's folder and the oldest version
    shutil.rmtree(tmp_path / "task")


def test_merged_codes(spark):
    from broadsheet.functions.paths import merged_codes

    links = {"a": "b", "b": "c", "c": "d", "d": "e", "e": "f", "x": "y", "y": "x", "z": "x", "m": "m", "n": None}
    got = {r["alias"]: r["main"] for r in merged_codes(spark.createDataFrame(list(links.items()), "paper_code string, merged_into string")).collect()}
    assert {k: got[k] for k in "abcde"} == dict.fromkeys("abcde", "f") and "m" not in got and "n" not in got
    assert merged_codes(spark.createDataFrame([], "paper_code string, merged_into string")).count() == 0


def test_hot_join(spark):
    from broadsheet.session import hot_join, write_shared

    a = write_shared(spark.range(500).selectExpr("id AS x", "CASE WHEN id < 300 THEN 0 ELSE id END AS k"), "left")
    b = write_shared(spark.range(40).selectExpr("id AS y", "CASE WHEN id < 20 THEN 0 ELSE id * 10 END AS k"), "right")
    got = sorted(tuple(r) for r in hot_join(a, b, "k", "x", 50).select("x", "y").collect())
    assert got == sorted(tuple(r) for r in a.join(b, "k").select("x", "y").collect()) and len(got) > 6000


def test_shared_tables_can_be_cleared(spark):
    from broadsheet.session import clear_shared, write_shared

    df = write_shared(spark.range(5), "five")
    files = df.inputFiles()
    assert df.count() == 5 and clear_shared(spark) >= 1
    from pathlib import Path

    assert not any(Path(f.removeprefix("file://")).exists() for f in files) and clear_shared(spark) == 0
