"""Region bookkeeping, segments, locks and percentiles: defined results for odd rows, brute force where there is no SQL."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import harmonize, layout, regions, sampling, segments, stats
from broadsheet.sources.locks import Locks

BOXES = "page_id bigint, block_id string, label string, minx double, miny double, maxx double, maxy double, extra string"


def boxes(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], BOXES)


def test_specs_are_read_and_not_run():
    assert regions.parsed_spec(" hull ") == ("hull", [], {}) and regions.parsed_spec("f(1, 'a', b=[2.5])") == ("f", [1, "a"], {"b": [2.5]})
    assert regions.built("add(2, b=3)", {"add": lambda a, b: a + b}) == 5
    for bad in ("", "1f()", "f(__import__('os'))", "f(g())"):
        with pytest.raises(ValueError):
            regions.parsed_spec(bad)
    with pytest.raises(ValueError):
        regions.built("g()", {"f": int})
    assert regions.composed(lambda x: x + 1, lambda x: 2 * x)(3) == 8
    assert regions.unescaped(r"a\n\\n\t\q") == "a\n\\n\t\\q"


def test_locks(tmp_path):
    a, b = Locks(str(tmp_path / "l"), 10), Locks(str(tmp_path / "l"), 10)
    assert a.acquire("p", "x", 100) and not b.acquire("p", "y", 105) and a.acquire("p", "x", 108)
    assert not b.acquire("p", "y", 115) and b.acquire("p", "y", 119) and not a.release("p", "x") and b.release("p", "y")
    assert a.acquire("q", "x", 100) and a.expire(200) == 1 and b.acquire("q", "y", 200)


def test_fixed_point_and_labels(spark):
    df = boxes(spark, [(1, "a", "t", 0.0, 0.0, 8.0, 8.0), (1, "b", "u", 0.0, 0.0, 3.0, 3.0), (1, "c", None, 0.0, 0.0, 1.0, 1.0)])
    half = regions.fixed_point(lambda d: d.withColumn("maxx", F.greatest(F.floor(F.col("maxx") / 2), F.lit(1)).cast("double")), df, F.sum("maxx"))
    assert {r["maxx"] for r in half.collect()} == {1.0}
    with pytest.raises(RuntimeError):
        regions.fixed_point(lambda d: d.withColumn("maxx", F.col("maxx") + 1), df, F.sum("maxx"), 3)
    out = regions.by_label({"t": lambda d: d.withColumn("maxy", F.lit(99.0))}, df)
    assert {(r["block_id"], r["maxy"]) for r in out.collect()} == {("a", 99.0), ("b", 3.0), ("c", 1.0)}


def test_merging_rightwards(spark):
    rows = [(1, "a", "t", 0.0, 0.0, 10.0, 10.0), (1, "b", "t", 15.0, 1.0, 25.0, 11.0), (1, "c", "t", 40.0, 0.0, 50.0, 10.0), (1, "d", "u", 11.0, 0.0, 14.0, 10.0), (2, "a", "t", 0.0, 0.0, 10.0, 10.0), (2, "b", "t", 12.0, 9.0, 20.0, 19.0)]
    walls = boxes(spark, [(1, "w", "V", 30.0, 0.0, 31.0, 100.0), (9, "w", "V", 0.0, 0.0, 1.0, 1.0)])
    got = {(r["page_id"], r["block_id"]): (r["minx"], r["maxx"]) for r in regions.merged_rightwards(boxes(spark, rows), walls, 20).collect()}
    assert got == {(1, "a"): (0, 25), (1, "c"): (40, 50), (1, "d"): (11, 14), (2, "a"): (0, 10), (2, "b"): (12, 20)}
    free = {(r["page_id"], r["block_id"]) for r in regions.merged_rightwards(boxes(spark, rows), None, 20).collect()}
    assert (1, "c") not in free and len(free) == 4


def test_dominance_starts_again_after_each_union():
    # the largest takes in one that brings the next within reach
    items = [["a", "TEXT", np.array([0.0, 0, 100, 100])], ["b", "TEXT", np.array([95.0, 10, 104, 20])], ["c", "TEXT", np.array([100.0, 12, 108, 18])]]
    assert [r[0] for r in layout.absorbed(items, 5)] == ["a"]


def test_growth_stops_at_obstacles(spark):
    rows = [(1, "a", "t", 0.0, 0.0, 10.0, 9.0), (1, "b", "t", 0.0, 10.0, 10.0, 20.0), (1, "c", "t", 0.0, 26.0, 10.0, 36.0), (1, "o", "wall", 0.0, 21.0, 10.0, 22.0)]
    run = lambda **k: {(r["block_id"], r["maxy"]) for r in layout.grown_along_order(boxes(spark, rows), "t", distance=10, max_error=2.0, **k).filter("label = 't'").collect()}
    assert run() == {("a", 36.0)} and run(obstacles=["wall"]) == {("a", 20.0), ("c", 36.0)}


def test_empty_regions(spark):
    e = boxes(spark, [])
    for df in (regions.repaired(e), regions.disjoint(e), regions.merged_rightwards(e, e, 5), regions.margin_noise(e, 100), layout.merge_overlaps(e), layout.dominated(e), layout.grown_along_order(e, "t"), regions.glued(e, 5, 5), regions.text_area(e), regions.greedy_match(e, e)):
        assert df.count() == 0


def test_review_order_by_error(spark):
    rows = [(1, "abc", "abc"), (2, "axc", "abc"), (3, "", "abc"), (4, None, "ab"), (5, "zz", ""), (6, "axc", "abc"), (7, None, None)]
    got = regions.by_error(spark.createDataFrame(rows, "row_id bigint, r string, t string"), "r", "t").orderBy("rank").collect()
    assert [r["row_id"] for r in got] == [5, 3, 4, 2, 6, 1, 7] and [r["rank"] for r in got] == list(range(1, 8))


def test_percentiles_of_any_distribution(spark):
    rng = random.Random(1)
    rows = [("many", rng.lognormvariate(0, 3)) for _ in range(6000)] + [("same", 5.0)] * 3000 + [("few", float(k)) for k in range(12)] + [("one", 3.0), ("none", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    shares = [0.0, 0.5, 0.9, 1.0]
    got = {r["k"]: (r["n"], r["q"]) for r in stats.percentiles(df, ["k"], "v", shares).collect()}
    for k in ("many", "same", "few", "one", None):
        v = [x for n, x in rows if n == k and x is not None]
        assert got[k][0] == len(v) and got[k][1] == pytest.approx([float(np.quantile(v, s)) for s in shares])
    assert "none" not in got and stats.percentiles(df.limit(0), ["k"], "v", shares).count() == 0


def test_strata_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id AS row_id", "CAST(id % 3 AS STRING) AS s")
    out = sampling.stratified(df, ["s"], "row_id", {"0": 5, "1": 2}, "s")
    assert {r["s"]: r["count"] for r in out.groupBy("s").count().collect()} == {"0": 5, "1": 2}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert sampling.stratified(df, ["s"], "row_id", {}, "s").count() == 0


def test_splits_cover_every_letter(spark):
    rng = random.Random(2)
    texts = {k: "".join(rng.choice("eeeeeaaxyzq"[: rng.randrange(1, 12)]) for _ in range(rng.randrange(1, 30))) for k in range(80)}
    counts = sampling.letter_counts(spark.createDataFrame(list(texts.items()), "k bigint, t string"), "k", "t")
    split = {r["k"]: r["split"] for r in sampling.covering_split(counts, "k").collect()}
    for letter in set("".join(texts.values())):
        total, have = sum(t.count(letter) for t in texts.values()), sum(t.count(letter) for k, t in texts.items() if split[k] == "train")
        assert have >= max(1, min(total - 1, int(total * 0.8)))


def test_affine_maps():
    m = segments.chained(segments.resize_matrix((100, 200), (50, 100)), segments.rotation_matrix(np.pi / 2, (0, 0)))
    assert m @ [10, 20, 1] == pytest.approx([-10, 5])


def test_normal_forms_of_arrays():
    import pyarrow as pa

    got = harmonize.normalized(pa.array(["ä", None, "", "ä", "x̣́"]), "NFC").to_pylist()
    assert got == ["ä", None, "", "ä", "x̣́"] and harmonize.normalized(pa.array([], pa.string()), "NFC").to_pylist() == []


def test_layout_program_runs_whole(spark):
    rng = random.Random(3)
    rows = [(k % 3, f"b{k:02d}", rng.choice(["TEXT", "TABULAR", "ILLUSTRATION"]), x := rng.uniform(0, 800), y := rng.uniform(0, 1200), x + rng.uniform(20, 300), y + rng.uniform(20, 300)) for k in range(60)]
    program = layout.newspaper_program(1320, 1650)
    got = program(boxes(spark, rows)).collect()
    assert not program.failed and 0 < len(got) < len(rows) and {r["page_id"] for r in got} == {0, 1, 2}
    text = [r for r in got if r["label"] in ("TEXT", "TABULAR")]
    for i, a in enumerate(text):
        for b in text[i + 1 :]:
            if a["page_id"] == b["page_id"] and a["label"] == b["label"]:
                w, h = min(a["maxx"], b["maxx"]) - max(a["minx"], b["minx"]), min(a["maxy"], b["maxy"]) - max(a["miny"], b["miny"])
                small = min((r["maxx"] - r["minx"]) * (r["maxy"] - r["miny"]) for r in (a, b))
                assert w <= 0 or h <= 0 or w * h <= 0.1 * small + 1e-6


def test_layout_program_is_its_steps_in_one_pass(spark):
    rng = random.Random(4)
    rows, cuts = [], []
    for page in [None, *range(12)]:
        for k in range(rng.randrange(30)):
            x, y = rng.randrange(0, 900, 25), rng.randrange(0, 1300, 25)
            rows.append((page, f"{k}-{k * 7}" if k % 2 else f"{k}", rng.choice(["TEXT", "TEXT", "TEXT", "TABULAR", "ILLUSTRATION", None]), float(x), float(y), float(x + rng.randrange(2, 200)), float(y + rng.randrange(2, 90))))
        cuts += [(page, float(rng.randrange(1000))) for _ in range(rng.randrange(4))] + [(page, None)]
    cuts = spark.createDataFrame(cuts, "page_id bigint, position double")
    df = layout.newspaper_program(1320, 1650, cuts)(boxes(spark, rows))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    diagonal = (1320**2 + 1650**2) ** 0.5
    near, least = 0.006 * diagonal, (0.0025 * diagonal) ** 2
    want, plain = layout.large_enough(boxes(spark, rows), least).drop("extra"), df.columns
    for pairs in (lambda t: layout.same_line_pairs(t, near), lambda t: layout.below_pairs(t, 30)):
        text = want.filter("label = 'TEXT'")
        want = layout.merge_adjacent(text, pairs(text)).select(*plain).unionByName(want.filter("label IS NULL OR label <> 'TEXT'"))
        want = spark.createDataFrame(want.collect(), want.schema)
    want = layout.grown_along_order(layout.dominated(layout.merge_overlaps(want), 0.005 * diagonal), "TEXT", distance=near, obstacles=["TABULAR"])
    want = layout.large_enough(layout.merge_overlaps(layout.split_on(want, cuts, "x")), least)
    got = sorted(map(repr, df.collect()))
    assert got == sorted(map(repr, want.collect())) and any("/2'" in r for r in got) and len(got) < len(rows)


def test_annotation_tables_are_made_filled_and_migrated(spark, tmp_path):
    import sqlite3

    from broadsheet.sources import database

    path = str(tmp_path / "a.db")
    df = spark.createDataFrame([(f"p{k % 3}", f"l{k % 5}", "x", k % 2 == 0) for k in range(30)], "page_path string, line_path string, annotation string, training boolean")
    assert database.insert(path, df, batch=7) == 15 and database.insert(path, df) == 0
    database.register(spark)
    assert spark.read.format("annotations").option("path", path).load().count() == 15
    old = str(tmp_path / "old.db")
    with sqlite3.connect(old) as c:
        c.execute("CREATE TABLE lines (page_path TEXT, training BOOLEAN)")
        c.execute("INSERT INTO lines VALUES ('p', NULL)")
    assert database.migrate(old) == ["validation"] and database.migrate(old) == []
    with sqlite3.connect(old) as c:
        assert c.execute("SELECT validation FROM lines").fetchall() == [(1,)]
