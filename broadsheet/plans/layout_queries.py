"""Queries of the layout operators over boxes and separators of pages, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.numbers import rounded
from broadsheet.operators import intervals, layout, spatial, stats, votes, xycut
from broadsheet.operators.graph import connected_components
from broadsheet.plans.fixtures import PAGE_HEIGHT, PAGE_WIDTH, boxes, duck, separators

#: Least area of a region, as a share of the page's diagonal (squared).
LEAST_AREA = 0.0025
DIAGONAL_SQUARED = PAGE_WIDTH**2 + PAGE_HEIGHT**2
LEAST = LEAST_AREA**2 * DIAGONAL_SQUARED
#: The test boxes are wide, so a larger share shows more.
TEST_AREA = 0.05
#: Farthest regions of one line.
LINE_DISTANCE = 60


def region_filter(spark: SparkSession, folder: str) -> DataFrame:
    return boxes(spark, folder).filter(F.concat_ws("/", F.lit("regions"), "label").isin("regions/TEXT", "regions/TABULAR")).select("page_id", "block_id", "label")


def area_filter(spark: SparkSession, folder: str) -> DataFrame:
    return layout.large_enough(boxes(spark, folder), TEST_AREA**2 * DIAGONAL_SQUARED).select("page_id", "block_id", spatial.area().cast("bigint").alias("area"))


def overlap_pairs(spark: SparkSession, folder: str) -> DataFrame:
    found = spatial.overlap_pairs(boxes(spark, folder), 0.1)
    return found.select("page_id", "a_block_id", "b_block_id", F.col("overlap").cast("bigint").alias("overlap"), rounded("ratio", 6).alias("ratio"))


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    key = lambda c: F.concat_ws("/", F.col("page_id").cast("string"), F.col(c))
    return spatial.overlap_pairs(boxes(spark, folder)).select(key("a_block_id").alias("a"), key("b_block_id").alias("b"))


def overlap_components(spark: SparkSession, folder: str) -> DataFrame:
    return connected_components(_edges(spark, folder)).select("node", "component")


def merged_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """Regions after uniting overlaps to the fix-point."""
    return layout.merge_overlaps(boxes(spark, folder), 0.1)


def same_line_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return layout.same_line_pairs(boxes(spark, folder), LINE_DISTANCE).select("page_id", "a_block_id", "b_block_id", rounded("aligned", 6).alias("aligned"), F.col("gap").cast("bigint").alias("gap"))


def below_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return layout.below_pairs(boxes(spark, folder), 200).select("page_id", "a_block_id", "b_block_id", rounded("aligned", 6).alias("aligned"), F.col("gap").cast("bigint").alias("gap"))


def merged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Text regions of one line united: members, joint box and cohesion."""
    text = boxes(spark, folder).filter("label = 'TEXT'")
    done = layout.merge_adjacent(text, layout.same_line_pairs(text, LINE_DISTANCE))
    return done.select("page_id", "block_id", "n_parts", *[F.col(c).cast("bigint").alias(c) for c in layout.BOX], rounded(layout.cohesion(), 6).alias("cohesion"))


def contained_regions(spark: SparkSession, folder: str) -> DataFrame:
    return layout.contained(boxes(spark, folder), 5).select("page_id", "a_block_id", "b_block_id")


def _seps(spark: SparkSession, folder: str) -> DataFrame:
    return separators(spark, folder).select("page_id", "label", F.least("x0", "x1").alias("minx"), F.least("y0", "y1").alias("miny"), F.greatest("x0", "x1").alias("maxx"), F.greatest("y0", "y1").alias("maxy"))


def obstacle_check(spark: SparkSession, folder: str) -> DataFrame:
    stand = _seps(spark, folder).filter("label IN ('V', 'T')")
    return spatial.hit_by(boxes(spark, folder), stand, 2).select("page_id", "block_id")


def exclude_boxes(spark: SparkSession, folder: str) -> DataFrame:
    holes = boxes(spark, folder).filter("label = 'ILLUSTRATION'")
    return spatial.outside(boxes(spark, folder).filter("label <> 'ILLUSTRATION'"), holes).select("page_id", "block_id")


def other_label_share(spark: SparkSession, folder: str) -> DataFrame:
    return spatial.other_label_share(boxes(spark, folder)).select("page_id", "block_id", rounded("share", 6).alias("share"))


def shrunk_regions(spark: SparkSession, folder: str) -> DataFrame:
    wide = boxes(spark, folder).select("page_id", "block_id", "label", *[(F.col(c) + (-30 if c.startswith("min") else 30)).alias(c) for c in layout.BOX])
    return spatial.shrunk(wide, boxes(spark, folder)).select("page_id", "block_id", *[F.col(c).cast("bigint").alias(c) for c in layout.BOX])


def transcription_best(spark: SparkSession, folder: str) -> DataFrame:
    moved = boxes(spark, folder).withColumns({"minx": F.col("minx") + (F.col("ord") - 4) * 5, "maxx": F.col("maxx") + (F.col("ord") - 4) * 5})
    return spatial.best_match(boxes(spark, folder), moved).select("page_id", "block_id", "source_id", F.col("overlap").cast("bigint").alias("overlap"))


def coverage_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Share of the page's height that its regions cover."""
    covered = intervals.coverage(boxes(spark, folder), ["page_id"], "miny", "maxy")
    return covered.select("page_id", F.col("covered").cast("bigint").alias("covered"), rounded(F.col("covered") / PAGE_HEIGHT, 6).alias("ratio"))


def merged_intervals(spark: SparkSession, folder: str) -> DataFrame:
    found = intervals.merged(boxes(spark, folder), ["page_id", "label"], "minx", "maxx")
    return found.select("page_id", "label", F.col("lo").cast("bigint").alias("lo"), F.col("hi").cast("bigint").alias("hi"))


def label_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = intervals.runs(boxes(spark, folder), ["page_id"], ["ord", "block_id"], "label")
    return found.select("page_id", F.col("run").cast("bigint").alias("run"), "label", "length")


def position_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Separator positions of each customer's pages, average linkage at 20 px."""
    s = separators(spark, folder).filter("label = 'V'").withColumn("page_id", F.floor(F.col("page_id") / 100))
    return intervals.position_clusters(s.select("page_id", "x0"), ["page_id"], "x0", 20)


def xycut_first_gap(spark: SparkSession, folder: str) -> DataFrame:
    return xycut.first_gap(boxes(spark, folder), ["page_id"], "y").select("page_id", F.col("at").cast("bigint").alias("at"), F.col("gap").cast("bigint").alias("gap"))


def xycut_order(spark: SparkSession, folder: str) -> DataFrame:
    return xycut.reading_order(boxes(spark, folder), ["page_id"], "block_id", fringe=2)


def xycut_obstacles(spark: SparkSession, folder: str) -> DataFrame:
    """Reading order in groups, separators lending their score to the gaps."""
    return xycut.reading_order(boxes(spark, folder), ["page_id"], "block_id", "obstacle", 2, separators(spark, folder), grouped=True)


def dominance(spark: SparkSession, folder: str) -> DataFrame:
    return layout.dominated(boxes(spark, folder), 5)


def sequential_merge(spark: SparkSession, folder: str) -> DataFrame:
    return layout.grown_along_order(boxes(spark, folder), "TABULAR", distance=60)


def split_regions(spark: SparkSession, folder: str) -> DataFrame:
    cuts = separators(spark, folder).filter("label = 'V'").select("page_id", F.col("x0").alias("position"))
    found = layout.split_on(boxes(spark, folder), cuts, "x")
    return found.select("page_id", "block_id", *[F.col(c).cast("bigint").alias(c) for c in layout.BOX])


def _columns(spark: SparkSession, folder: str) -> DataFrame:
    t = boxes(spark, folder).filter("label = 'TABULAR'")
    third = (F.col("maxx") - F.col("minx")) / 3
    return t.withColumn("positions", F.array(F.col("minx") + third, F.col("minx") + 2 * third).cast("array<double>"))


def table_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Column bands of each table region."""
    t = boxes(spark, folder).filter("label = 'TABULAR'")
    bands = layout.divided(t, _columns(spark, folder).select("page_id", "block_id", "positions"), "x")
    return bands.select("page_id", "block_id", "band", F.bround("minx", 1).alias("x0"), F.bround("maxx", 1).alias("x1"))


def table_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of tables divided at a quarter of their height: headers and bodies."""
    t = boxes(spark, folder).filter("label = 'TABULAR'")
    rows = t.select("page_id", "block_id", F.array((F.col("miny") + (F.col("maxy") - F.col("miny")) / 4).cast("double")).alias("positions"))
    found = layout.table_blocks(t, _columns(spark, folder).select("page_id", "block_id", "positions"), rows, line_height=8)
    return found.select("page_id", "block_id", "path", "is_header", F.size(F.coalesce("columns", F.array().cast("array<double>"))).alias("n_columns"))


def page_signature(spark: SparkSession, folder: str) -> DataFrame:
    return stats.grid_signature(boxes(spark, folder), PAGE_WIDTH, PAGE_HEIGHT)


def region_signature(spark: SparkSession, folder: str) -> DataFrame:
    return stats.position_signature(boxes(spark, folder), float(PAGE_WIDTH), float(PAGE_HEIGHT))


def line_metrics(spark: SparkSession, folder: str) -> DataFrame:
    lines = boxes(spark, folder).selectExpr("page_id", "block_id", "minx AS px", "maxy AS py", "maxx - minx AS right_x", "ord - 4 AS right_y", "0 AS up_x", "miny - maxy AS up_y")
    return votes.line_metrics(lines).select("page_id", "block_id", *[rounded(c, 6).alias(c) for c in ("length", "height", "angle", "center_x", "center_y")])


def _skews(spark: SparkSession, folder: str) -> DataFrame:
    return boxes(spark, folder).selectExpr("page_id", "label", "degrees(atan2(ord - 4, maxx - minx)) AS phi", "CAST(maxx - minx AS DOUBLE) AS length")


def weighted_median_skew(spark: SparkSession, folder: str) -> DataFrame:
    return votes.weighted_median(_skews(spark, folder).withColumn("phi", rounded("phi", 6)), ["page_id"], "phi", "length").select("page_id", (rounded("median", 3) + 0.0).alias("median"))


def mean_skew(spark: SparkSession, folder: str) -> DataFrame:
    s = _skews(spark, folder).withColumn("label", F.when(F.col("label") == "TEXT", "V").otherwise("H"))
    return votes.mean_skew(s, ["page_id"]).select("page_id", rounded("skew", 6).alias("skew"))


def width_weighted(spark: SparkSession, folder: str) -> DataFrame:
    s = separators(spark, folder).withColumn("extent", F.abs(F.col("x1") - F.col("x0")) + F.abs(F.col("y1") - F.col("y0")))
    return s.groupBy("label").agg(rounded(votes.weighted_mean("width", "extent"), 6).alias("width"))


def majority_vote(spark: SparkSession, folder: str) -> DataFrame:
    from broadsheet.session import table

    v = table(spark, folder, "lineitem").selectExpr("l_orderkey AS pixel", "CAST(l_suppkey % 4 AS INT) AS label")
    return votes.majority(v, ["pixel"])


def confidence_argmax(spark: SparkSession, folder: str) -> DataFrame:
    """Label shares of each page's pixels, the best label and its lead over TEXT."""
    shares = votes.label_shares(boxes(spark, folder).withColumn("label", F.when(F.col("ord") == 7, "BACKGROUND").otherwise(F.col("label"))), ["page_id"])
    best = votes.predicted(F.col("confidence"), F.lit("TEXT"))
    return shares.select("page_id", best.alias("p")).select("page_id", F.col("p.label").alias("label"), rounded("p.share", 6).alias("share"), rounded("p.error", 6).alias("error"))


def reclassify_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines whose label loses by more than a half become free lines; table lines stay."""
    shares = votes.label_shares(boxes(spark, folder), ["page_id"])
    rows = boxes(spark, folder).select("page_id", "block_id", "label").join(shares, "page_id")
    p = votes.predicted(F.col("confidence"), F.col("label"))
    rows = rows.withColumn("p", p)
    free = (F.col("label") != "TABULAR") & (F.col("p.error") > 0.5)
    return rows.select("page_id", "block_id", F.when(free, F.col("p.label")).otherwise(F.col("label")).alias("label"), free.alias("is_free"))


def confidence_vote(spark: SparkSession, folder: str) -> DataFrame:
    s = boxes(spark, folder).select("page_id", "label", "conf_pct")
    return votes.highest_sum(s, ["page_id"], "label", "conf_pct")


NAMES = [
    region_filter, area_filter, overlap_pairs, overlap_components, merged_overlaps, same_line_pairs, below_pairs, merged_lines, contained_regions, obstacle_check, exclude_boxes, other_label_share,
    shrunk_regions, transcription_best, coverage_ratio, merged_intervals, label_runs, position_clusters, xycut_first_gap, xycut_order, xycut_obstacles, dominance, sequential_merge, split_regions,
    table_columns, table_headers, page_signature, region_signature, line_metrics, weighted_median_skew, mean_skew, width_weighted, majority_vote, confidence_argmax, reclassify_lines, confidence_vote,
]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}


PAIRS = """b AS {boxes},
p AS (SELECT a.page_id, a.block_id AS a_block_id, b.block_id AS b_block_id, a.label AS a_label, b.label AS b_label,
  a.minx AS ax0, a.miny AS ay0, a.maxx AS ax1, a.maxy AS ay1, b.minx AS bx0, b.miny AS by0, b.maxx AS bx1, b.maxy AS by1,
  greatest(0, least(a.maxx, b.maxx) - greatest(a.minx, b.minx)) * greatest(0, least(a.maxy, b.maxy) - greatest(a.miny, b.miny)) AS overlap,
  (a.maxx - a.minx) * (a.maxy - a.miny) AS a_area, (b.maxx - b.minx) * (b.maxy - b.miny) AS b_area
  FROM b a JOIN b ON a.page_id = b.page_id)"""


def oracle_sql() -> dict[str, str]:
    s = {
        "region_filter": "SELECT page_id, block_id, label FROM {boxes} WHERE label IN ('TEXT', 'TABULAR')",
        "area_filter": f"SELECT page_id, block_id, (maxx - minx) * (maxy - miny) AS area FROM {{boxes}} WHERE (maxx - minx) * (maxy - miny) >= {TEST_AREA**2 * DIAGONAL_SQUARED!r}",
        "overlap_pairs": f"WITH {PAIRS} SELECT page_id, a_block_id, b_block_id, overlap, round(overlap / least(a_area, b_area), 6) AS ratio FROM p WHERE a_block_id < b_block_id AND a_label = b_label AND overlap > 0 AND overlap / least(a_area, b_area) > 0.1",
        "overlap_components": f"""WITH RECURSIVE {PAIRS},
e AS (SELECT page_id || '/' || a_block_id AS a, page_id || '/' || b_block_id AS b FROM p WHERE a_block_id <> b_block_id AND a_label = b_label AND overlap > 0),
r(node, other) AS (SELECT a, b FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a)
SELECT node, least(node, min(other)) AS component FROM r GROUP BY node""",
        "same_line_pairs": f"""WITH {PAIRS}, q AS (SELECT *, greatest(0, least(ay1, by1) - greatest(ay0, by0)) / least(ay1 - ay0, by1 - by0) AS aligned, greatest(0, greatest(ax0, bx0) - least(ax1, bx1)) AS gap FROM p)
SELECT page_id, a_block_id, b_block_id, round(aligned, 6) AS aligned, gap FROM q WHERE a_block_id < b_block_id AND a_label = b_label AND aligned >= 0.8 AND gap <= {LINE_DISTANCE}""",
        "below_pairs": f"""WITH {PAIRS}, q AS (SELECT *, greatest(0, least(ax1, bx1) - greatest(ax0, bx0)) / least(ax1 - ax0, bx1 - bx0) AS aligned, by0 - ay1 AS gap FROM p WHERE ay1 <= by0)
SELECT page_id, a_block_id, b_block_id, round(aligned, 6) AS aligned, gap FROM q WHERE a_block_id <> b_block_id AND a_label = b_label AND aligned >= 0.95 AND gap < 200""",
        "merged_lines": f"""WITH RECURSIVE {PAIRS}, q AS (SELECT *, greatest(0, least(ay1, by1) - greatest(ay0, by0)) / least(ay1 - ay0, by1 - by0) AS aligned, greatest(0, greatest(ax0, bx0) - least(ax1, bx1)) AS gap FROM p),
e AS (SELECT page_id, a_block_id AS a, b_block_id AS b FROM q WHERE a_block_id <> b_block_id AND a_label = 'TEXT' AND b_label = 'TEXT' AND aligned >= 0.8 AND gap <= {LINE_DISTANCE}),
r(page_id, node, other) AS (SELECT page_id, block_id, block_id FROM b WHERE label = 'TEXT' UNION SELECT r.page_id, r.node, e.b FROM r JOIN e ON r.page_id = e.page_id AND r.other = e.a),
c AS (SELECT page_id, node, min(other) AS component FROM r GROUP BY page_id, node),
m AS (SELECT c.page_id, component, node, minx, miny, maxx, maxy, (maxx - minx) * (maxy - miny) AS area FROM c JOIN b ON c.page_id = b.page_id AND c.node = b.block_id)
SELECT page_id, arg_min(node, (-area, node)) AS block_id, count(*) AS n_parts, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy,
  round(sum(area) / ((max(maxx) - min(minx)) * (max(maxy) - min(miny))), 6) AS cohesion FROM m GROUP BY page_id, component""",
        "contained_regions": f"WITH {PAIRS} SELECT page_id, a_block_id, b_block_id FROM p WHERE a_block_id <> b_block_id AND a_label = b_label AND ax0 >= bx0 - 5 AND ay0 >= by0 - 5 AND ax1 <= bx1 + 5 AND ay1 <= by1 + 5 AND (a_area < b_area OR (a_area = b_area AND a_block_id > b_block_id))",
        "obstacle_check": """SELECT DISTINCT b.page_id, b.block_id FROM {boxes} b JOIN {separators} s ON b.page_id = s.page_id AND s.label IN ('V', 'T')
  AND least(minx + 2, maxx) <= greatest(x0, x1) AND greatest(maxx - 2, least(minx + 2, maxx)) >= least(x0, x1) AND least(miny + 2, maxy) <= greatest(y0, y1) AND greatest(maxy - 2, least(miny + 2, maxy)) >= least(y0, y1)""",
        "exclude_boxes": f"WITH {PAIRS} SELECT page_id, block_id FROM b WHERE label <> 'ILLUSTRATION' AND NOT EXISTS (SELECT 1 FROM b h WHERE h.page_id = b.page_id AND h.label = 'ILLUSTRATION' AND b.minx >= h.minx AND b.maxx <= h.maxx AND b.miny >= h.miny AND b.maxy <= h.maxy)",
        "other_label_share": f"WITH {PAIRS} SELECT b.page_id, b.block_id, round(coalesce(max(CASE WHEN a_label <> b_label THEN overlap / b_area END), 0.0), 6) AS share FROM b LEFT JOIN p ON b.page_id = p.page_id AND b.block_id = p.a_block_id AND p.b_area > 0 GROUP BY b.page_id, b.block_id",
        "shrunk_regions": """WITH b AS {boxes} SELECT a.page_id, a.block_id, greatest(any_value(a.minx) - 30, min(b.minx)) AS minx, greatest(any_value(a.miny) - 30, min(b.miny)) AS miny, least(any_value(a.maxx) + 30, max(b.maxx)) AS maxx, least(any_value(a.maxy) + 30, max(b.maxy)) AS maxy
FROM b a JOIN b ON a.page_id = b.page_id AND a.label = b.label AND a.minx - 30 <= b.maxx AND b.minx <= a.maxx + 30 AND a.miny - 30 <= b.maxy AND b.miny <= a.maxy + 30 GROUP BY a.page_id, a.block_id""",
        "transcription_best": """WITH b AS {boxes}, m AS (SELECT page_id, block_id, minx + (ord - 4) * 5 AS minx, miny, maxx + (ord - 4) * 5 AS maxx, maxy FROM b),
p AS (SELECT b.page_id, b.block_id, m.block_id AS source_id, greatest(0, least(b.maxx, m.maxx) - greatest(b.minx, m.minx)) * greatest(0, least(b.maxy, m.maxy) - greatest(b.miny, m.miny)) AS overlap,
  (m.maxx - m.minx) * (m.maxy - m.miny) AS area FROM b JOIN m ON b.page_id = m.page_id)
SELECT page_id, block_id, source_id, overlap FROM p WHERE overlap / area > 0.6 QUALIFY row_number() OVER (PARTITION BY page_id, block_id ORDER BY overlap DESC, source_id) = 1""",
        "coverage_ratio": f"""WITH b AS {{boxes}}, i AS (SELECT page_id, miny AS lo, maxy + 1 AS hi FROM b),
s AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY page_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS starts FROM i),
n AS (SELECT *, sum(starts) OVER (PARTITION BY page_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM s),
m AS (SELECT page_id, island, max(hi) - min(lo) AS len FROM n GROUP BY page_id, island)
SELECT page_id, CAST(sum(len) AS BIGINT) AS covered, round(sum(len) / {PAGE_HEIGHT}, 6) AS ratio FROM m GROUP BY page_id""",
        "merged_intervals": """WITH b AS {boxes}, i AS (SELECT page_id, label, minx AS lo, maxx + 1 AS hi FROM b),
s AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY page_id, label ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS starts FROM i),
n AS (SELECT *, sum(starts) OVER (PARTITION BY page_id, label ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM s)
SELECT page_id, label, min(lo) AS lo, max(hi) AS hi FROM n GROUP BY page_id, label, island""",
        "label_runs": """WITH b AS {boxes}, s AS (SELECT page_id, label, ord, block_id, CASE WHEN label IS DISTINCT FROM lag(label) OVER (PARTITION BY page_id ORDER BY ord, block_id) THEN 1 ELSE 0 END AS starts FROM b),
n AS (SELECT *, sum(starts) OVER (PARTITION BY page_id ORDER BY ord, block_id ROWS UNBOUNDED PRECEDING) AS run FROM s)
SELECT page_id, CAST(run AS BIGINT) AS run, any_value(label) AS label, count(*) AS length FROM n GROUP BY page_id, run""",
        "xycut_first_gap": """WITH b AS {boxes}, r AS (SELECT page_id, miny AS lo, max(maxy) OVER (PARTITION BY page_id ORDER BY miny, maxy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b)
SELECT page_id, arg_min(reach, (reach - lo, reach)) AS at, max(lo - reach) AS gap FROM r WHERE lo > reach GROUP BY page_id""",
        "split_regions": """WITH b AS {boxes}, c AS (SELECT page_id, x0 AS position FROM {separators} WHERE label = 'V'),
a AS (SELECT b.page_id, b.block_id, min(position) AS cut FROM b JOIN c ON b.page_id = c.page_id AND position > minx AND position < maxx AND least(position - minx, maxx - position) / (maxx - minx) >= 0.2 GROUP BY 1, 2),
j AS (SELECT b.*, cut FROM b LEFT JOIN a ON b.page_id = a.page_id AND b.block_id = a.block_id)
SELECT page_id, block_id, minx, miny, maxx, maxy FROM j WHERE cut IS NULL
UNION ALL SELECT page_id, block_id || '/1', minx, miny, cut, maxy FROM j WHERE cut IS NOT NULL
UNION ALL SELECT page_id, block_id || '/2', cut, miny, maxx, maxy FROM j WHERE cut IS NOT NULL""",
        "table_columns": """SELECT page_id, block_id, CAST(k AS INT) AS band, round_even(minx + k * (maxx - minx) / 3, 1) AS x0, round_even(minx + (k + 1) * (maxx - minx) / 3, 1) AS x1 FROM {boxes}, range(3) t(k) WHERE label = 'TABULAR'""",
        "table_headers": """WITH t AS (SELECT *, miny + (maxy - miny) / 4 AS cut FROM {boxes} WHERE label = 'TABULAR'),
d AS (SELECT page_id, block_id, 1 AS division, cut - miny AS h FROM t UNION ALL SELECT page_id, block_id, 2, maxy - cut FROM t)
SELECT page_id, block_id, block_id || '.' || division || '.1.' || c AS path, true AS is_header, CAST(0 AS INT) AS n_columns FROM d, range(1, 4) x(c) WHERE h < 24
UNION ALL SELECT page_id, block_id, block_id || '.' || division || '.1.1', false, 2 FROM d WHERE h >= 24""",
        "page_signature": f"""WITH b AS (SELECT *, least(greatest(floor(minx * 9 / {PAGE_WIDTH}), 0), 8) AS a0, least(greatest(floor(maxx * 9 / {PAGE_WIDTH}), 0), 8) AS a1, least(greatest(floor(miny * 9 / {PAGE_HEIGHT}), 0), 8) AS c0, least(greatest(floor(maxy * 9 / {PAGE_HEIGHT}), 0), 8) AS c1 FROM {{boxes}})
SELECT page_id, label, CAST(x AS INT) AS gx, CAST(y AS INT) AS gy, count(*) AS n FROM b JOIN range(9) r(x) ON x BETWEEN a0 AND a1 JOIN range(9) s(y) ON y BETWEEN c0 AND c1 GROUP BY ALL""",
        "region_signature": f"""SELECT page_id, block_id, CAST(x AS INT) AS gx, CAST(y AS INT) AS gy, share FROM (SELECT page_id, block_id, x, y,
  round(greatest(0.0, least(maxx, (x + 1) * {PAGE_WIDTH / 3!r}) - greatest(minx, x * {PAGE_WIDTH / 3!r})) * greatest(0.0, least(maxy, (y + 1) * {PAGE_HEIGHT / 3!r}) - greatest(miny, y * {PAGE_HEIGHT / 3!r})) / ((maxx - minx) * (maxy - miny)), 6) AS share
  FROM {{boxes}}, range(3) r(x), range(3) s(y)) WHERE share > 0""",
        "line_metrics": """SELECT page_id, block_id, round(sqrt(CAST((maxx - minx) * (maxx - minx) + (ord - 4) * (ord - 4) AS DOUBLE)), 6) AS length, round(CAST(maxy - miny AS DOUBLE), 6) AS height,
  round(atan2(ord - 4, maxx - minx), 6) AS angle, round(minx + (maxx - minx) / 2, 6) AS center_x, round(maxy + (ord - 4 + miny - maxy) / 2, 6) AS center_y FROM {boxes}""",
        "weighted_median_skew": """WITH s AS (SELECT page_id, round(degrees(atan2(ord - 4, maxx - minx)), 6) AS phi, CAST(maxx - minx AS DOUBLE) AS w FROM {boxes}),
p AS (SELECT page_id, phi, (sum(w) OVER (PARTITION BY page_id ORDER BY phi, w ROWS UNBOUNDED PRECEDING) - w / 2) / sum(w) OVER (PARTITION BY page_id) AS p FROM s),
a AS (SELECT page_id, max(CASE WHEN p <= 0.5 THEN {'p': p, 'v': phi} END) AS low, min(CASE WHEN p >= 0.5 THEN {'p': p, 'v': phi} END) AS high FROM p GROUP BY page_id)
SELECT page_id, round(CASE WHEN low IS NULL THEN high.v WHEN high IS NULL THEN low.v WHEN high.p = low.p THEN low.v ELSE low.v + (0.5 - low.p) / (high.p - low.p) * (high.v - low.v) END, 3) + 0.0 AS median FROM a""",
        "mean_skew": """WITH s AS (SELECT page_id, label = 'TEXT' AS v, degrees(atan2(ord - 4, maxx - minx)) AS phi, CAST(maxx - minx AS DOUBLE) AS w FROM {boxes})
SELECT page_id, round(CASE WHEN coalesce(sum(w) FILTER (v), 0) > 0 THEN sum(phi * w) FILTER (v) / sum(w) FILTER (v) ELSE sum(phi * w) / sum(w) END, 6) AS skew FROM s WHERE abs(phi) <= 15 GROUP BY page_id""",
        "width_weighted": "SELECT label, round(sum(width * (abs(x1 - x0) + abs(y1 - y0))) / sum(abs(x1 - x0) + abs(y1 - y0)), 6) AS width FROM {separators} GROUP BY label",
        "majority_vote": """WITH c AS (SELECT l_orderkey AS pixel, CAST(l_suppkey % 4 AS INT) AS label, count(*) AS n FROM lineitem GROUP BY 1, 2), m AS (SELECT pixel, max(n) AS n FROM c GROUP BY pixel)
SELECT m.pixel, CAST(CASE WHEN count(*) > 1 THEN 0 ELSE max(label) END AS INT) AS label FROM m JOIN c ON m.pixel = c.pixel AND m.n = c.n GROUP BY m.pixel""",
        "confidence_argmax": """WITH l AS (SELECT page_id, CASE WHEN ord = 7 THEN 'BACKGROUND' ELSE label END AS label FROM {boxes}), t AS (SELECT page_id, count(*) AS total FROM l GROUP BY 1),
c AS (SELECT page_id, label, count(*) AS n FROM l GROUP BY 1, 2), s AS (SELECT c.page_id, label, n / total AS share FROM c JOIN t ON c.page_id = t.page_id),
best AS (SELECT page_id, arg_min(label, (-share, label)) AS label, max(share) AS share FROM s WHERE label <> 'BACKGROUND' GROUP BY page_id)
SELECT t.page_id, best.label, round(coalesce(best.share, 0.0), 6) AS share, round(coalesce(best.share, 0.0) - coalesce(o.share, 0.0), 6) AS error FROM t LEFT JOIN best ON t.page_id = best.page_id LEFT JOIN s o ON t.page_id = o.page_id AND o.label = 'TEXT'""",
        "reclassify_lines": """WITH l AS {boxes}, t AS (SELECT page_id, count(*) AS total FROM l GROUP BY 1), c AS (SELECT page_id, label, count(*) AS n FROM l GROUP BY 1, 2),
best AS (SELECT page_id, arg_min(label, (-n, label)) AS label, max(n) AS n FROM c GROUP BY page_id),
j AS (SELECT l.page_id, l.block_id, l.label, best.label AS top, l.label <> 'TABULAR' AND (best.n - c.n) / total > 0.5 AS is_free FROM l JOIN best ON l.page_id = best.page_id JOIN c ON c.page_id = l.page_id AND c.label = l.label JOIN t ON t.page_id = l.page_id)
SELECT page_id, block_id, CASE WHEN is_free THEN top ELSE label END AS label, is_free FROM j""",
        "confidence_vote": "WITH s AS (SELECT page_id, label, CAST(sum(conf_pct) AS BIGINT) AS s FROM {boxes} GROUP BY 1, 2) SELECT page_id, arg_min(label, (-s, label)) AS label, max(s) AS score FROM s GROUP BY page_id",
    }
    return {name: duck(sql) for name, sql in s.items()}
