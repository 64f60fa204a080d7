"""Hand-made cases and properties of the core operators."""

import random
import zipfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import wkt
from broadsheet.operators import annotations, compose, geometry, graph, harmonize, intervals, layout, sampling, spatial, stats, tracking, votes, xycut
from broadsheet.sources import artifacts, database, models, pagexml

# Pairs of texts before and after harmonisation.
GOLDEN = {
    "default": [
        ("a  b c", "a b c"), ("a.b", "a. b"), ("a,b", "a, b"), ("a:b", "a: b"), ("a .b", "a. b"), ("a ,b", "a, b"), ("a ( b ) c", "a (b) c"), ("a ( b ) , c", "a (b), c"), ("a ( b ) . c", "a (b). c"),
        ("a„  b ”c", "a ‚‚b'' c"), ("a  '  b", "a ' b"), ("a 3. 7. 14.). b", "a 3. 7. 14.). b"), ("1 %", "1%"), ("12 - 34", "12-34"), ("12 -- 34", "12--34"), ("12 , 34", "12,34"), ("", ""), ("a.ße", "a. ße"),
    ],
    "styled": [("{a} [b]", "{a} [b]"), ("- [a]", "- [a]"), ("[- a]", "- [a]"), ("[-a]", "-[a]"), ("[a.]", "[a]."), ("[a?]", "[a]?"), ("[a) {b}]", "[a) {b}]"), ("3.4", "3.4"), ("12 -- 34", "12 -- 34"), ("Stückà3", "Stück à 3")],
    "unstyled": [("{a} [b]", "a b"), ('a"b', "a'' b"), ("a'''b", "a''' b"), ("a„b", "a ‚‚b"), ("a‚‚‚b", "a ‚‚‚b"), ("3 + 4", "3 + 4"), ("a-", "a-"), ("3,4", "3,4"), ("a.)", "a.)"), ("a!b", "a! b"), ("Thlr. .", "Thlr.."), ("1 %", "1%")],
}


@pytest.mark.parametrize("channel", sorted(GOLDEN))
def test_harmonised_pairs(spark, channel):
    df = spark.createDataFrame(GOLDEN[channel] + [(None, None)], "a string, b string").select("b", harmonize.harmonized(F.col("a"), channel).alias("c"))
    assert [(r["b"], r["c"]) for r in df.collect() if r["b"] != r["c"]] == []


BOX = "page_id bigint, block_id string, label string, minx double, miny double, maxx double, maxy double"


def boxes(spark, rows):
    return spark.createDataFrame(rows, BOX)


def test_pairs_against_all_pairs(spark):
    rng = random.Random(5)
    rows = []
    for k in range(120):
        x, y = rng.uniform(-300, 900), rng.uniform(-300, 900)
        rows.append((k % 3, f"b{k:03d}", rng.choice("ab"), x, y, x + rng.choice([0, 50, 600]), y + rng.choice([0, 40, 700])))
    found = {(r["page_id"], r["a_block_id"], r["b_block_id"]) for r in spatial.meeting(boxes(spark, rows), boxes(spark, rows)).collect()}
    naive = {(a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[3] <= b[5] and b[3] <= a[5] and a[4] <= b[6] and b[4] <= a[6]}
    assert found == naive
    assert spatial.meeting(boxes(spark, []), boxes(spark, rows)).count() == 0


def test_small_measures(spark):
    one = spark.range(1).select(
        spatial.rel_area(0.0025, spatial.diagonal(F.lit(1200), F.lit(1600))).alias("area"),
        *[spatial.alignment(F.lit(0), F.lit(10), F.lit(5), F.lit(25), m).alias(m) for m in ("min", "a", "b")],
    ).first()
    assert (one["area"], one["min"], one["a"], one["b"]) == (25, 0.5, 0.5, 0.25)
    b = boxes(spark, [(1, "x", "a", 0.0, 0.0, 10.0, 10.0)]).select(*spatial.inset(6)).first()
    assert tuple(b) == (6, 6, 6, 6)


def test_coverage_and_runs(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (1, 3.0, 8.0), (1, 10.0, 12.0)], "k int, lo double, hi double")
    assert intervals.coverage(df, ["k"]).first()["covered"] == 12
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate(["a", "a", None, None, "a", "b"])], "k int, i int, v string")
    assert [(r["v"], r["length"]) for r in intervals.runs(df, ["k"], ["i"], "v").orderBy("run").collect()] == [("a", 2), (None, 2), ("a", 1), ("b", 1)]


def test_position_clusters():
    assert intervals.average_link(np.array([0.0, 5, 30, 38, 100]), 20).tolist() == [0, 0, 1, 1, 2]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(5, 5), (7, None)] + [(1000, 1001 + k) for k in range(200)]
    found = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert found == {x: root(x) for x in list(parent)}
    assert graph.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def order(rows):
    return [i for g in xycut.cut_order(np.array(rows, float), xycut.SCORES["widest_gap"]) for i in g]


def test_cut_order():
    assert order([(0, 0, 10, 10), (20, 0, 30, 10), (0, 15, 30, 20)]) == [0, 1, 2]
    assert order([]) == [] and order([(0, 0, 1, 1)]) == [0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 60)] * 4), min_size=1, max_size=14))
def test_reading_order_is_a_permutation(rows):
    box = [(x, y, x + w, y + h) for x, y, w, h in rows]
    assert sorted(order(box)) == list(range(len(box)))
    grouped = xycut.cut_order(np.array(box, float), xycut.SCORES["widest_gap"], grouped=True)
    assert sorted(i for g in grouped for i in g) == list(range(len(box)))


def test_obstacle_score():
    # half of the gap's length has a separator along it, a fifth of its width one across it
    gap = xycut.Gap(0, 100, 110, 0, 100)
    seps = np.array([[105, 0, 105, 49], [100, 50, 101, 50]])
    assert xycut.obstacle_score(np.zeros((0, 4)), [], np.zeros(0))(gap) == 1000
    assert xycut.obstacle_score(seps, ["V", "H"], np.array([1.0, 1.0]))(gap) == pytest.approx(1200)
    assert xycut.obstacle_score(seps, ["V", "H"], np.array([4.0, 1.0]))(gap) == pytest.approx(9800)


def test_reading_order_of_pages(spark):
    df = boxes(spark, [(1, "c", "a", 0.0, 15.0, 30.0, 20.0), (1, "b", "a", 20.0, 0.0, 30.0, 10.0), (1, "a", "a", 0.0, 0.0, 10.0, 10.0), (2, "z", "a", None, None, None, None)])
    assert [(r["page_id"], r["block_id"]) for r in xycut.reading_order(df, ["page_id"], "block_id").orderBy("page_id", "rank").collect()] == [(1, "a"), (1, "b"), (1, "c")]


def test_reading_orders_of_many_pages_at_once(spark):
    rng = random.Random(11)
    rows, seps = [], []
    for page in [None, *range(40)]:
        for k in range(rng.randrange(9)):
            x, y = rng.randrange(60), rng.randrange(60)
            rows.append((page, f"b{k * 7 % 9}", "a", float(x), float(y), float(x + rng.randrange(25)), float(y + rng.randrange(25))))
        seps += [(page, rng.choice(["H", "V", None]), *(float(rng.randrange(-5, 90)) for _ in range(4)), rng.randrange(1, 5)) for _ in range(rng.randrange(4))]
    seps.append((99, "V", 1.0, 1.0, 1.0, 50.0, 1))
    df = xycut.reading_order(boxes(spark, rows), ["page_id"], "block_id", "obstacle", 2, spark.createDataFrame(seps, "page_id bigint, label string, x0 double, y0 double, x1 double, y1 double, width int"), grouped=True)
    assert "CoGroups" not in df._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["page_id"], []).append((r["block_id"], r["group"]))
    for page in {r[0] for r in rows}:
        own, lines = sorted(r for r in rows if r[0] == page), [s for s in seps if s[0] == page]
        b = [(x0 := min(x + 2, z), y0 := min(y + 2, w), max(z - 2, x0), max(w - 2, y0)) for *_, x, y, z, w in own]
        score = xycut.obstacle_score(np.array([s[2:6] for s in lines]).reshape(-1, 4), [s[1] for s in lines], np.array([s[6] for s in lines], float))
        assert got.pop(page) == [(own[i][1], g) for g, members in enumerate(xycut.cut_order(np.array(b), score, grouped=True)) for i in members]
    assert not got


def test_merging_to_the_fix_point(spark):
    rows = [(1, "a", "t", 0.0, 0.0, 10.0, 10.0), (1, "b", "t", 5.0, 0.0, 15.0, 10.0), (1, "c", "t", 12.0, 0.0, 40.0, 10.0), (1, "d", "u", 0.0, 0.0, 10.0, 10.0), (2, "a", "t", 0.0, 0.0, 1.0, 1.0)]
    got = {(r["page_id"], r["block_id"]): (r["minx"], r["maxx"]) for r in layout.merge_overlaps(boxes(spark, rows)).collect()}
    assert got == {(1, "c"): (0, 40), (1, "d"): (0, 10), (2, "a"): (0, 1)}


def test_dominance_leaves_no_overlap(spark):
    rng = random.Random(8)
    rows = []
    for k in range(40):
        x, y = rng.uniform(0, 300), rng.uniform(0, 300)
        rows.append((k % 2, f"b{k:02d}", rng.choice(["TEXT", "TABULAR", "ILLUSTRATION"]), x, y, x + rng.uniform(5, 90), y + rng.uniform(5, 90)))
    got = [r.asDict() for r in layout.dominated(boxes(spark, rows)).collect()]
    assert {g["block_id"] for g in got if g["label"] == "ILLUSTRATION"} == {r[1] for r in rows if r[2] == "ILLUSTRATION"}
    live = [g for g in got if g["label"] != "ILLUSTRATION"]
    for i, a in enumerate(live):
        for b in live[i + 1 :]:
            if a["page_id"] == b["page_id"]:
                w, h = min(a["maxx"], b["maxx"]) - max(a["minx"], b["minx"]), min(a["maxy"], b["maxy"]) - max(a["miny"], b["miny"])
                assert w <= 0 or h <= 0 or w * h < 1


def test_program_skips_a_failing_step(spark):
    df = boxes(spark, [(1, "a", "t", 0.0, 0.0, 1.0, 1.0)])
    program = layout.Program([("bad", lambda r: r.select("nothing")), ("good", lambda r: r.filter("label = 't'"))])
    assert program(df).count() == 1 and program.failed == ["bad"]


def test_split_keeps_the_area(spark):
    df = boxes(spark, [(1, "a", "t", 0.0, 0.0, 10.0, 10.0), (1, "b", "t", 0.0, 0.0, 100.0, 5.0), (2, "c", "t", 0.0, 0.0, 5.0, 5.0)])
    cuts = spark.createDataFrame([(1, 4.0), (1, 40.0)], "page_id bigint, position double")
    got = layout.split_on(df, cuts, "x")
    assert got.agg(F.sum(spatial.area())).first()[0] == 100 + 500 + 25
    assert sorted(r["block_id"] for r in got.collect()) == ["a/1", "a/2", "b/1", "b/2", "c"]


LINES = "page_path string, predictor string, label string, block_id string, line_id int, text string"


def test_composition(spark):
    rows = [("p", "r", "TEXT", "1", 0, "a "), ("p", "r", "TEXT", "1", 1, ""), ("p", "r", "TEXT", "2", 0, "b"), ("q", "r", "TEXT", "1", 0, None), ("p", "r", "TEXT", "1", 2, "  ")]
    df = spark.createDataFrame(rows, LINES)
    assert [tuple(r) for r in compose.plain_text(df).collect()] == [("p", "a\n\n\nb\n")]
    order = [(b, n) for b, n in compose.sorted_lines(spark.createDataFrame([("p", "r", "T", b, n, "") for b in ("2", "10") for n in (10, 9)], LINES)).orderBy("rank").select("block_id", "line_id").collect()]
    assert order == [("10", 9), ("10", 10), ("2", 9), ("2", 10)]
    assert compose.plain_text(df.limit(0)).count() == 0


def test_region_text_needs_more_than_the_least(spark):
    df = spark.createDataFrame([("p", "r", "T", "1", 0, "x" * 50), ("p", "r", "T", "2", 0, "x" * 51)], LINES)
    assert [r["block_id"] for r in compose.region_texts(df).collect()] == ["2"]


def test_table_as_text(spark):
    rows = [("p", "r", "TABULAR", "5.1.1.1", 0, "Good"), ("p", "r", "TABULAR", "5.1.1.2", 0, "Price"), ("p", "r", "TABULAR", "5.2.1.1", 0, "rye"), ("p", "r", "TABULAR", "5.2.1.2", 0, "7"), ("p", "r", "TABULAR", "6", 0, "one")]
    got = {r["table"]: r["text"] for r in compose.table_texts(compose.table_cells(spark.createDataFrame(rows, LINES))).collect()}
    assert got["6"] == "one"
    assert got["5"].split("\n") == ["+------+-------+", "| Good | Price |", "|------+-------|", "| rye  | 7     |", "+------+-------+"]
    path = spark.createDataFrame([("5.2.1.1", 3)], "b string, n int").select(compose.cell_path(F.col("b"), F.col("n"), 2)).first()[0]
    assert path == "5.2.4.2"


def test_votes(spark):
    rows = [(1, 1), (1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 1), (3, 2), (3, 2), (3, 3), (4, None)]
    got = {r["pixel"]: r["label"] for r in votes.majority(spark.createDataFrame(rows, "pixel int, label int"), ["pixel"], undecided=-1).collect()}
    assert got == {1: 1, 2: -1, 3: -1}
    m = spark.createDataFrame([({"TEXT": 0.3, "TABULAR": 0.6, "BACKGROUND": 0.1},)], "c map<string,double>").select(votes.predicted(F.col("c"), F.lit("TEXT")).alias("p")).first()["p"]
    assert (m["label"], m["share"], round(m["error"], 6)) == ("TABULAR", 0.6, 0.3)
    w = votes.weighted_median(spark.createDataFrame([(1, 1.0, 1.0), (1, 2.0, 1.0), (1, 10.0, 2.0), (1, None, 5.0)], "k int, v double, w double"), ["k"], "v", "w").first()["median"]
    assert w == pytest.approx(2 + (0.5 - 0.375) / 0.375 * 8)


def test_splits_and_folds(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    folds = [r["fold"] for r in sampling.folds(df, "k", 5).collect()]
    assert sorted(folds.count(f) for f in range(5)) == [1, 1, 1, 2, 2]
    assert sampling.train_val(df, "k", 0.3).filter("split = 'val'").count() == 2
    floors = [r[0] for r in spark.createDataFrame([(10,), (2,), (1,)], "n bigint").select(sampling.split_floor(F.col("n"), 0.8)).collect()]
    assert floors == [8, 1, 1]
    assert [r["bin"] for r in sampling.discretized(spark.createDataFrame([(float(k),) for k in range(1, 7)], "v double"), "v").orderBy("v").collect()] == [0, 0, 1, 1, 2, 2]


def test_covering_split_meets_its_floors(spark):
    rng = random.Random(2)
    texts = [(k, "".join(rng.choice("aaaabbbccd") for _ in range(12)) + ("z" if k == 3 else "")) for k in range(60)]
    counts = sampling.letter_counts(spark.createDataFrame(texts, "k bigint, t string"), "k", "t")
    got = {r["k"]: r["split"] for r in sampling.covering_split(counts, "k", 0.6).collect()}
    train = "".join(t for k, t in texts if got[k] == "train")
    assert sum(v == "train" for v in got.values()) >= int(60 * 0.6)
    for c in "abcdz":
        total = sum(t.count(c) for _, t in texts)
        assert train.count(c) >= max(1, min(total - 1, int(total * 0.6)))


def test_tiles_cover():
    for w, h in [(1280, 896), (1281, 2000), (2500, 3500), (10, 10)]:
        t = sampling.tiles(w, h, 1280, 896)
        assert max(x for x, _ in t) + 1280 >= w and max(y for _, y in t) + 896 >= h and t[0] == (0, 0)


def test_annotation_tables(spark):
    s = "row_id bigint, page_path string, line_path string, annotation string, author string, saved_at timestamp"
    rows = [(1, "p", "a", "x", "A", None), (2, "p", "a", "y", "B", None), (3, "p", "b", None, None, None)]
    df = spark.createDataFrame(rows, s)
    assert {r["row_id"] for r in annotations.latest(df).collect()} == {2, 3}
    assert annotations.found(df, "Y", text_only=True).count() == 1 and annotations.found(df, "Y", text_only=True, case=True).count() == 0
    assert {(r["line_path"], r["change"]) for r in annotations.delta(df.filter("row_id < 3"), df.filter("row_id = 3")).collect()} == {("b", "add"), ("a", "del")}


def test_tracking(spark):
    s = "k string, v int"
    got = {r["k"]: r["status"] for r in tracking.changes(spark.createDataFrame([("a", 1), ("b", None), ("c", 1), (None, 1)], s), spark.createDataFrame([("a", 1), ("b", 0), ("d", 1), (None, 1)], s), ["k"]).collect()}
    assert got == {"a": "same", "b": "changed", "c": "removed", "d": "added", None: "same"}


def test_near_vectors_against_all_pairs(spark):
    rng = random.Random(4)
    rows = [(k, [rng.randrange(3) for _ in range(12)]) for k in range(60)] + [(100, [0] * 12), (101, [0] * 12), (102, [0] * 12)]
    got = {(r["a"], r["b"]) for r in stats.l1_pairs(spark.createDataFrame(rows, "k bigint, v array<int>"), "k", "v", 3).collect()}
    naive = {(a, b) for a, x in rows for b, y in rows if a < b and sum(abs(p - q) for p, q in zip(x, y)) <= 3}
    assert got <= naive and naive - got <= {(a, b) for a, b in naive if b in (101, 102)}
    cluster = {r["k"]: r["cluster"] for r in stats.clusters(spark.createDataFrame(rows, "k bigint, v array<int>"), "k", "v", 0).collect()}
    assert cluster[101] == cluster[102] == 100


def test_shapes(spark):
    r = spark.createDataFrame([("POLYGON ((0 0, 4 0, 4 3, 0 3, 0 0))",), ("LINESTRING (0.5 1.5, 2 2)",), ("nonsense",), (None,)], "w string").select(wkt.points(F.col("w")).alias("r"))
    got = r.select(wkt.ring_area(F.col("r")).alias("a"), wkt.coordinates(F.col("r")).alias("c")).collect()
    assert got[0]["a"] == 12 and got[1]["c"] == "0,2 2,2" and got[2]["c"] is None and got[3]["c"] is None


def test_polygons():
    square = np.array([[0, 0], [4, 0], [4, 4], [0, 4.0]])
    assert geometry.area(geometry.convex_hull(np.vstack([square, [[1, 1], [2, 3]]]))) == 16
    assert geometry.area(geometry.clip_convex(square + 2, square)) == 4
    assert geometry.fill(square, 6, 6).sum() == 16
    grid = np.stack(np.meshgrid(np.arange(5) * 10.0 + 3, np.arange(4) * 10.0 - 2), -1)
    p = np.array([[12.5, 7.0], [0, 0], [39, 29]])
    assert np.allclose(geometry.off_grid(grid, 10, geometry.on_grid(grid, 10, p)), p, atol=0.01)
    assert geometry.adjacent(np.array([[0, 0, 10, 10], [20, 0, 30, 10], [40, 0, 50, 10.0]])) == {(0, 1), (1, 2)}


def test_neighbours_of_many_pages_at_once(spark):
    rng = np.random.default_rng(5)
    for cells, n in ((64, 2), (60, 5), (64, 9), (5, 3)):
        low = rng.integers(0, 300, (12, n, 2)) * (1 + rng.random((12, 1, 1)))
        box = np.concatenate((low, low + rng.integers(0, 90, (12, n, 2))), 2)
        box[0], box[1, 1] = box[0, 0], box[1, 0]  # boxes that are the same
        assert geometry.adjacents(box, cells).tolist() == [[k, *x] for k in range(12) for x in sorted(geometry.adjacent(box[k], cells))]
    rows = [(k % 7 or None, f"b{k * 13 % 40}", "a", float(x), float(y), float(x + 40), float(y + 30)) for k, (x, y) in enumerate(rng.integers(0, 400, (40, 2)).tolist())]
    want = set()
    for page in range(1, 7):
        own = sorted(r for r in rows if r[0] == page)
        want |= {(page, own[a][1], own[b][1]) for a, b in geometry.adjacent(np.array([r[3:] for r in own]), 64)}
    assert {tuple(r) for r in geometry.neighbours(boxes(spark, [*rows, (1, None, "a", 0.0, 0.0, 1.0, 1.0), (2, "b0", "a", None, 0.0, 1.0, 1.0)]), 64).collect()} == want
    assert geometry.neighbours(boxes(spark, [])).count() == 0


def test_page_documents_round_trip(spark):
    rows = [("p & q", "1", 0, "0,0 1,1", "a < b"), ("p & q", "1", 1, "0,0 1,1", None), ("r", "5.1.1.1", 0, "2,2", "")]
    docs = pagexml.documents(spark.createDataFrame(rows, "page_path string, block_id string, line_id int, points string, text string"))
    got = {(r["page_path"], r["line"], r["text"]) for r in pagexml.lines_of(docs).collect()}
    assert got == {("p & q", "r_1_l_0", "a < b"), ("p & q", "r_1_l_1", ""), ("r", "r_5_1_1_1_l_0", "")}
    assert pagexml.lines_of(spark.createDataFrame([("x", "<broken")], "page_path string, xml string")).count() == 0


def test_archives(spark, tmp_path):
    folder = tmp_path / "a" / "page1.out"
    folder.mkdir(parents=True)
    with zipfile.ZipFile(folder / "contours.2.zip", "w") as z:
        z.writestr("meta.json", '{"version": 2, "predictions": [{"name": "seps", "type": "SEPARATOR"}, {"name": "regions", "type": "REGION"}]}')
        z.writestr("regions/TEXT/0.wkt", "POLYGON ((0 0, 1 0, 1 1, 0 0))")
        z.writestr("seps/V/0.wkt", "LINESTRING (0 0, 0 9)")
        z.writestr("seps/V/meta.json", '{"width": [1.5]}')
    with zipfile.ZipFile(folder / "lines.3.zip", "w") as z:
        z.writestr("meta.json", '{"version": 1}')
        z.writestr("regions/TEXT/0/0.json", '{"p": [0, 1], "right": [5, 0], "up": [0, -2], "wkt": "", "confidence": 1, "tesseract_data": {"ascent": 2}}')
        z.writestr("regions/TEXT/0/1.json", '{"p": [0, 1], "right": [5, 0], "up": [0, -2], "wkt": "", "confidence": {"regions/TEXT": 0.4}}')
    (folder / "tables.json").write_text('{"version": 1, "columns": {"regions/TABULAR/5": [2349.55]}, "dividers": {}}')
    (folder / "order.json").write_text('{"version": 1, "orders": {"*": ["regions/TEXT/0", "regions/TEXT/1"]}}')
    (tmp_path / "a" / "page1.jpg").write_bytes(b"x")
    (folder / "thumbnail.jpg").write_bytes(b"x")
    root = f"file://{tmp_path}"
    load = lambda name: artifacts.load(spark, root, name)
    assert [(r["page"], r["label"], r["width"]) for r in artifacts.contours(load("contours/aggregate"), "SEPARATOR").collect()] == [("page1", "V", 1.5)]
    assert artifacts.contours(load("contours/aggregate")).count() == 2
    lines = {r["line_id"]: r for r in artifacts.text_lines(load("lines/reliable")).collect()}
    assert lines[0]["confidence"] == {"regions/TEXT": 1.0} and lines[0]["ascent"] == 2 and lines[1]["confidence"] == {"regions/TEXT": 0.4} and lines[1]["height"] is None
    assert [r["positions"] for r in artifacts.table_data(load("tables")).collect()] == [[2349.6]]
    assert [r["path"] for r in artifacts.orders(load("order")).orderBy("rank").collect()] == ["regions/TEXT/0", "regions/TEXT/1"]
    assert artifacts.scan_pages(spark, root).count() == 1
    assert artifacts.Artifact.parse("lines/reliable").file == "lines.3.zip"
    with pytest.raises(ValueError):
        artifacts.Artifact.parse("lines/aggregate")


def test_annotation_database(spark, tmp_path):
    import sqlite3

    with sqlite3.connect(tmp_path / "a.db") as c:
        c.execute("CREATE TABLE lines (page_path TEXT, line_path TEXT, line_wkt TEXT, annotation TEXT, author TEXT, training INTEGER, validation INTEGER)")
        c.executemany("INSERT INTO lines VALUES (?, ?, ?, ?, ?, ?, ?)", [("p", str(k), None, "t", None, k % 2, None) for k in range(25)])
    database.register(spark)
    df = spark.read.format("annotations").option("path", str(tmp_path / "a.db")).option("rows", "10").load()
    assert df.count() == 25 and df.filter("training").count() == 12 and df.filter("validation IS NULL").count() == 25


def test_recognition_contract(spark):
    rows = [("r", "TEXT", "1", 0, 10, 10), ("r", "TEXT", "1", 1, 5, 10), ("r", "TEXT", "1", 2, None, 10)]
    df = spark.createDataFrame(rows, "predictor string, label string, block_id string, line_id int, width int, height int")
    assert {r["line_id"]: r["text"] for r in models.recognized(df, models.PathText()).collect()} == {0: "text for r/TEXT/1/0.", 1: "", 2: ""}
