"""Queries of the bookkeeping of regions, of joins between artifacts, and of segments for training, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.numbers import rounded
from broadsheet.operators import compose, layout, regions, segments, stats, xycut
from broadsheet.plans.fixtures import PAGE_HEIGHT, PAGE_WIDTH, boxes, duck, ocr_lines, separators
from broadsheet.plans.layout_queries import PAIRS
from broadsheet.session import table
from broadsheet.sources import pagexml

DIAGONAL = (PAGE_WIDTH**2 + PAGE_HEIGHT**2) ** 0.5
#: Bounds as whole numbers.
WHOLE = [f"CAST({c} AS BIGINT) AS {c}" for c in layout.BOX]
#: Palette of the label lookup.
PALETTE = {1: 2, 2: 1, 3: 1}


def _ocr_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of recognised lines as regions with made-up bounds: 40 pixels for each line."""
    lines = ocr_lines(spark, folder)
    rows = lines.groupBy(F.col("page_path").alias("page_id"), "label", "block_id").agg(F.min("line_id").alias("a"), F.max("line_id").alias("b"))
    return rows.select("page_id", "label", "block_id", F.lit(60).alias("minx"), (F.col("a") * 40).alias("miny"), F.lit(860).alias("maxx"), (F.col("b") * 40 + 40).alias("maxy"))


def _ocr_lines(spark: SparkSession, folder: str) -> DataFrame:
    return ocr_lines(spark, folder).withColumnRenamed("page_path", "page_id")


def repaired_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes of which some come reversed, empty or with a bound missing."""
    b = boxes(spark, folder)
    bad = b.withColumns({"minx": F.when(F.col("ord") == 2, F.col("maxx")).when(F.col("ord") == 3, None).otherwise(F.col("minx")), "maxx": F.when(F.col("ord") == 2, F.col("minx")).when(F.col("ord") == 4, F.col("minx")).otherwise(F.col("maxx"))})
    return regions.repaired(bad).select("page_id", "block_id", *map(F.expr, WHOLE))


def geometry_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Outlines of the annotations, some of them spoilt."""
    rows = table(spark, folder, "lines").select("row_id", "line_wkt")
    spoilt = F.when(F.col("row_id") % 7 == 0, F.replace("line_wkt", F.lit("POLYGON"), F.lit("POINT"))).when(F.col("row_id") % 11 == 0, F.regexp_replace("line_wkt", r", \S+ \S+\)\)$", "))")).when(F.col("row_id") % 13 == 0, F.replace("line_wkt", F.lit(" "), F.lit("?"))).otherwise(F.col("line_wkt"))
    return regions.geometry_faults(rows.select("row_id", spoilt.alias("shape")), "shape").select("row_id", "fault")


def long_separators(spark: SparkSession, folder: str) -> DataFrame:
    s = separators(spark, folder).withColumn("length", F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))
    return regions.long_lines(s, "length", F.lit(DIAGONAL), 0.05).select("page_id", "label")


def confident_lines(spark: SparkSession, folder: str) -> DataFrame:
    return regions.confident(ocr_lines(spark, folder), 0.8).select("row_id", "confidence")


def next_block_ids(spark: SparkSession, folder: str) -> DataFrame:
    return regions.next_ids(_ocr_lines(spark, folder))


def split_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Recognised lines under the names their page's block was split into: blocks 1 and 2 in two."""
    rows = ocr_lines(spark, folder).filter("label = 'TEXT'").select("row_id", F.concat_ws("/", "page_path", "block_id").alias("key"))
    mapping = rows.filter(F.col("key").rlike("/[12]$")).select(F.col("key").alias("old")).distinct().withColumn("new", F.explode(F.array(F.concat("old", F.lit(".1")), F.concat("old", F.lit(".2")))))
    return regions.mapped(rows, "key", mapping)


def label_lookup(spark: SparkSession, folder: str) -> DataFrame:
    pixels = table(spark, folder, "lineitem").selectExpr("l_orderkey AS pixel", "CAST(l_suppkey % 5 AS INT) AS label")
    return regions.looked_up(pixels, "label", PALETTE).groupBy("label").agg(F.count("*").alias("n"))


def all_labels(spark: SparkSession, folder: str) -> DataFrame:
    return regions.everything(boxes(spark, folder).select("page_id", "block_id", "label")).groupBy("page_id", "label").agg(F.count("*").alias("n"))


def lines_in_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the bounds of their block; blocks of one line are missing."""
    blocks = _ocr_regions(spark, folder).filter("maxy - miny > 40")
    rows = regions.with_block(_ocr_lines(spark, folder), blocks, ("page_id", "label", "block_id"))
    return rows.select("row_id", "block_miny", "block_maxy")


def page_document(spark: SparkSession, folder: str) -> DataFrame:
    lines = _ocr_lines(spark, folder)
    texts = lines.filter("text <> ''").select("page_id", "label", "block_id", "line_id", "text")
    return regions.document(texts, lines, _ocr_regions(spark, folder), 0.8).select("page_id", "label", "block_id", "line_id", "text", "confidence", "maxy")


def ordered_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Reading orders that name whole regions, or single lines of every third block, and some parts that are not there."""
    lines = _ocr_lines(spark, folder)
    whole = _ocr_regions(spark, folder).select("page_id", F.concat_ws("/", F.lit("regions"), "label", "block_id").alias("path"))
    single = lines.filter("line_id < 3").select("page_id", F.concat_ws("/", F.lit("regions"), "label", "block_id", F.col("line_id").cast("string")).alias("path"))
    gone = lines.filter("line_id = 0").select("page_id", F.concat_ws("/", F.lit("regions"), "label", "block_id", F.lit("999")).alias("path"))
    order = whole.unionAll(single).unionAll(gone).withColumn("rank", F.length("path"))
    return regions.ordered_parts(order, _ocr_regions(spark, folder), lines)


def missing_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Regions whose texts were all lost: those whose lines are all longer than 40 characters."""
    lines = _ocr_lines(spark, folder)
    return regions.missing_texts(_ocr_regions(spark, folder), lines.filter("length(text) <= 40"), lines, 0.8)


def combined_tables(spark: SparkSession, folder: str) -> DataFrame:
    return regions.combined_tables(_ocr_regions(spark, folder)).select("page_id", "label", "block_id", *map(F.expr, WHOLE), "n_parts")


def nested_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds of cells, columns, divisions and tables; cells are the boxes of table regions."""
    b = boxes(spark, folder).filter("label = 'TABULAR'")
    cells = b.selectExpr("page_id", "'t' AS `table`", "ord % 2 AS division", "ord % 3 AS `column`", "conf_pct AS `row`", "minx", "miny", "maxx", "maxy")
    return regions.nested_bounds(cells).select("page_id", "level", "division", "column", "row", *map(F.expr, WHOLE))


def merge_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Of the text regions united on their lines: the regions each came from."""
    text = boxes(spark, folder).filter("label = 'TEXT'")
    pairs = layout.same_line_pairs(text, 60).select("page_id", F.col("a_block_id").alias("a"), F.col("b_block_id").alias("b"))
    return regions.lineage(text, pairs)


def margin_noise(spark: SparkSession, folder: str) -> DataFrame:
    return regions.margin_noise(boxes(spark, folder), PAGE_WIDTH, 0.15).select("page_id", "block_id", "noise")


def greedy_match(spark: SparkSession, folder: str) -> DataFrame:
    moved = boxes(spark, folder).withColumns({"minx": F.col("minx") + (F.col("ord") - 4) * 5, "maxx": F.col("maxx") + (F.col("ord") - 4) * 5})
    return regions.greedy_match(boxes(spark, folder), moved).select("page_id", "source_id", "block_id", F.col("overlap").cast("bigint").alias("overlap"), "duplicate")


def interval_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return regions.interval_neighbours(boxes(spark, folder)).select("page_id", "a", "b", F.col("overlap").cast("bigint").alias("overlap"), F.col("gap").cast("bigint").alias("gap"))


def _walls(spark: SparkSession, folder: str) -> DataFrame:
    return separators(spark, folder).filter("label <> 'H'").select("page_id", F.concat_ws("/", "label", F.col("x0").cast("string")).alias("block_id"), F.col("x0").alias("minx"), F.least("y0", "y1").alias("miny"), F.col("x1").alias("maxx"), F.greatest("y0", "y1").alias("maxy"))


def unstopped_pairs(spark: SparkSession, folder: str) -> DataFrame:
    b = boxes(spark, folder)
    pairs = regions.interval_neighbours(b).filter("gap >= 0").select("page_id", "a", "b")
    return regions.unstopped(pairs, b, _walls(spark, folder))


def glued_regions(spark: SparkSession, folder: str) -> DataFrame:
    return regions.glued(boxes(spark, folder), 30, 4000).select("page_id", "block_id", "n_parts", *map(F.expr, WHOLE))


def agglomerated_regions(spark: SparkSession, folder: str) -> DataFrame:
    return regions.agglomerated(boxes(spark, folder), _walls(spark, folder), 10)


def text_areas(spark: SparkSession, folder: str) -> DataFrame:
    return regions.text_area(boxes(spark, folder), 5).select("page_id", "block_id", F.col("x0").cast("bigint").alias("x0"), F.col("x1").cast("bigint").alias("x1"))


def reliable_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks cut to their lines of even number; table lines of number 0 are free."""
    r = _ocr_regions(spark, folder)
    lines = _ocr_lines(spark, folder).select("page_id", "label", "block_id", "line_id", F.lit(100).alias("minx"), (F.col("line_id") * 40).alias("miny"), F.lit(800).alias("maxx"), (F.col("line_id") * 40 + 30).alias("maxy"))
    free = lines.filter("label = 'TEXT' AND line_id = 3").withColumn("line_id", F.concat_ws("/", "block_id", F.col("line_id").cast("string")))
    return regions.reliable(r.filter("label = 'TEXT'"), lines.filter("line_id % 2 = 0"), free).select("page_id", "label", "block_id", *map(F.expr, WHOLE))


def disjoint_hulls(spark: SparkSession, folder: str) -> DataFrame:
    return regions.disjoint(boxes(spark, folder)).select("page_id", "block_id", *map(F.expr, WHOLE))


def merged_rightwards(spark: SparkSession, folder: str) -> DataFrame:
    return regions.merged_rightwards(boxes(spark, folder), _walls(spark, folder), 100).select("page_id", "block_id", "label", *map(F.expr, WHOLE))


def review_order(spark: SparkSession, folder: str) -> DataFrame:
    """Recognised against annotated text, the worst first."""
    part = F.split("line_path", "/")
    lines = table(spark, folder, "lines").select("row_id", "page_path", F.get(part, F.lit(2)).alias("block_id"), F.get(part, F.lit(3)).try_cast("int").alias("line_id"), "annotation")
    read = ocr_lines(spark, folder).filter("label = 'TEXT'").groupBy("page_path", "block_id", "line_id").agg(F.min("text").alias("read"))
    rows = lines.join(read, ["page_path", "block_id", "line_id"]).filter("annotation <> ''")
    return regions.by_error(rows.select("row_id", "annotation", "read"), "read", "annotation").select("row_id", rounded("error", 6).alias("error"), "rank")


def navigation(spark: SparkSession, folder: str) -> DataFrame:
    return regions.navigation(table(spark, folder, "lines").select("row_id", "page_path", "line_path"), ["page_path"], ["line_path", "row_id"]).select("row_id", "previous", "next")


def paper_slugs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "paper").select("paper_code", regions.slug(F.col("title")).alias("slug"))


def subdivided_separators(spark: SparkSession, folder: str) -> DataFrame:
    found = segments.subdivided(separators(spark, folder).select("page_id", "x0", "y0", "x1", "y1"), 150)
    return found.select("page_id", "piece", *[rounded(c, 4).alias(c) for c in ("x0", "y0", "x1", "y1")])


def smoothed_paths(spark: SparkSession, folder: str) -> DataFrame:
    points = boxes(spark, folder).select("page_id", "ord", "block_id", F.col("minx").alias("x"), F.col("miny").alias("y")).groupBy("page_id", "ord").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    return segments.smoothed(points, ["page_id"], "ord", ["x", "y"]).select("page_id", "ord", rounded("x", 4).alias("x"), rounded("y", 4).alias("y"))


def path_progress(spark: SparkSession, folder: str) -> DataFrame:
    points = boxes(spark, folder).groupBy("page_id", "ord").agg(F.min("minx").alias("x"), F.min("miny").alias("y"))
    return segments.path_lengths(points, ["page_id"], "ord").select("page_id", "ord", rounded("progress", 3).alias("progress"))


def steady_separators(spark: SparkSession, folder: str) -> DataFrame:
    pieces = boxes(spark, folder).selectExpr("page_id", "label", "block_id", "atan2(ord - 4, maxx - minx) AS angle")
    return segments.steady(pieces, ["page_id", "label"], "angle", 0.01).select("page_id", "label", "block_id")


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return boxes(spark, folder).selectExpr("page_id", "block_id", "label", "minx AS x0", "miny AS y0", "maxx AS x1", "miny + ord AS y1", "conf_pct / 10.0 AS error")


def near_ends(spark: SparkSession, folder: str) -> DataFrame:
    return segments.near_ends(_segments(spark, folder), {"TEXT": 200.0, "TABULAR": 120.0}).select("page_id", "label", "a", "b", rounded("distance", 4).alias("distance"))


def parallel_segments(spark: SparkSession, folder: str) -> DataFrame:
    return segments.parallel_pairs(_segments(spark, folder), 80, 0.02)


def good_segments(spark: SparkSession, folder: str) -> DataFrame:
    return segments.good_segments(_segments(spark, folder), 0.5, 100).select("page_id", "block_id")


def join_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Why successive segments of a page may not be joined."""
    s = _segments(spark, folder)
    side = lambda p: s.select("page_id", *[F.col(c).alias(f"{p}_{c}") for c in ("block_id", "label", "x0", "y0", "x1", "y1")])
    pairs = side("a").join(side("b"), "page_id").filter("a_block_id < b_block_id").withColumn("masked", F.col("a_x0") % 2 == 0)
    return segments.join_reasons(pairs, 600, 0.02).select("page_id", F.col("a_block_id").alias("a"), F.col("b_block_id").alias("b"), "reason")


def tile_label_stats(spark: SparkSession, folder: str) -> DataFrame:
    pixels = boxes(spark, folder).selectExpr("page_id", "minx AS x", "miny AS y", "ord % 3 AS label")
    return segments.tile_label_stats(pixels, 500, 3).select("page_id", "label", rounded("mean", 6).alias("mean"))


def line_form(spark: SparkSession, folder: str) -> DataFrame:
    """The 'image' of a page: one row of pixels for each label, black where the order is odd."""
    pixels = boxes(spark, folder).selectExpr("page_id", "label AS y", "concat(ord, block_id) AS x", "ord % 3 > 0 AS black")
    return segments.line_form(pixels, ["page_id"]).select("page_id", rounded("form", 6).alias("form"))


def order_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Reading orders of each label and of all together ('*'), as the stage writes them; small regions are left out."""
    rows = regions.everything(boxes(spark, folder).filter("(maxx - minx) * (maxy - miny) >= 2000"))
    return xycut.reading_order(rows, ["page_id", "label"], "block_id", fringe=2)


def pagexml_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with text and table regions of recognised lines; outlines are the made-up bounds."""
    lines = ocr_lines(spark, folder)
    base = F.substring_index("block_id", ".", 1)
    points = lambda a, b: F.concat(F.lit("60,"), a.cast("string"), F.lit(" 860,"), a.cast("string"), F.lit(" 860,"), b.cast("string"), F.lit(" 60,"), b.cast("string"))
    at = points(F.col("line_id") * 40, F.col("line_id") * 40 + 40)
    text = lines.filter("label = 'TEXT'").groupBy("page_path", "block_id", "line_id").agg(F.min("text").alias("text")).withColumn("points", at)
    cells = compose.table_cells(lines).select("page_path", F.col("table").alias("block_id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("division", "row", "column")], "text").withColumn("points", points(F.col("row") * 40, F.col("row") * 40 + 40))
    areas = lines.groupBy("page_path", "label", base.alias("block_id")).agg(F.min("line_id").alias("a"), F.max("line_id").alias("b"))
    areas = areas.select("page_path", "label", "block_id", points(F.col("a") * 40, F.col("b") * 40 + 40).alias("points"))
    pictures = areas.filter("block_id = '1' AND label = 'TEXT'").select("page_path", F.lit("ILLUSTRATION").alias("label"), F.lit("9999").alias("block_id"), "points")
    return pagexml.region_documents(areas.unionByName(pictures), text, cells)


def layout_program(spark: SparkSession, folder: str) -> DataFrame:
    """Regions after the whole program of a newspaper page."""
    cuts = separators(spark, folder).filter("label = 'V'").select("page_id", F.col("x0").alias("position"))
    return layout.newspaper_program(PAGE_WIDTH, PAGE_HEIGHT, cuts)(boxes(spark, folder)).select("page_id", "block_id", "label", *[rounded(c, 3).alias(c) for c in layout.BOX])


def label_set(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "paper").selectExpr("paper_code AS name", "merged_into AS `group`")
    return segments.label_set(names).select("name", "label", "group", "group_label")


def warp_parameters(spark: SparkSession, folder: str) -> DataFrame:
    """The seeds of the warps, as whole numbers of the hash."""
    rows = table(spark, folder, "scan_page").select("page_path", *segments.warp_parameters(F.col("page_path")))
    return rows.select("page_path", rounded("alpha", 6).alias("alpha"), rounded("beta", 6).alias("beta"))


def resized_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Upper left corners on a page of 660 x 825, turned by a quarter around its centre."""
    import math

    matrix = segments.chained(segments.resize_matrix((PAGE_WIDTH, PAGE_HEIGHT), (660, 825)), segments.rotation_matrix(math.pi / 2, (330, 412.5)))
    return segments.transformed(boxes(spark, folder).select("page_id", "block_id", F.col("minx").alias("x"), F.col("miny").alias("y")), matrix).select("page_id", "block_id", rounded("x", 3).alias("x"), rounded("y", 3).alias("y"))


def partial_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of which some lines were written but not all that were recognised: to be done again."""
    page = F.regexp_extract("path", r"([^/]+/\d+/[^/]+/jpg/[^/.]+)\.out/", 1)
    written = table(spark, folder, "ocr_file").select(F.concat(page, F.lit(".jpg")).alias("page_path"), "path").filter("page_path <> '.jpg'").groupBy("page_path").agg(F.countDistinct("path").alias("n_written"))
    wanted = ocr_lines(spark, folder).groupBy("page_path").agg(F.count("*").alias("n_wanted"))
    return written.join(wanted, "page_path").filter("n_written < n_wanted")


def elapsed_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quartiles and the 99th percentile of widths, by status."""
    found = stats.percentiles(table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice", [0.25, 0.75, 0.99])
    return found.select("l_returnflag", "n", *[rounded(F.col("q")[k], 4).alias(f"q{k}") for k in range(3)])


def intersecting_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Places that are both recognised and annotated (INTERSECT)."""
    a = ocr_lines(spark, folder).select("page_path", F.concat_ws("/", "predictor", "label", "block_id", F.col("line_id").cast("string")).alias("line_path"))
    return a.intersect(table(spark, folder, "lines").select("page_path", "line_path"))


NAMES = [
    repaired_regions, geometry_faults, long_separators, confident_lines, next_block_ids, split_keys, label_lookup, all_labels, lines_in_blocks, page_document, ordered_parts, missing_texts, combined_tables, nested_bounds,
    merge_lineage, margin_noise, greedy_match, interval_neighbours, unstopped_pairs, glued_regions, agglomerated_regions, text_areas, reliable_regions, disjoint_hulls, merged_rightwards, review_order, navigation, paper_slugs,
    subdivided_separators, smoothed_paths, path_progress, steady_separators, near_ends, parallel_segments, good_segments, join_reasons, tile_label_stats, line_form, order_stage, pagexml_regions, layout_program, label_set, warp_parameters, resized_regions, partial_outputs,
    elapsed_percentiles, intersecting_keys,
]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}


REGIONS = "r AS (SELECT page_path AS page_id, label, block_id, 60 AS minx, min(line_id) * 40 AS miny, 860 AS maxx, max(line_id) * 40 + 40 AS maxy FROM {ocr_lines} GROUP BY ALL)"
SEGMENTS = "(SELECT page_id, block_id, label, minx AS x0, miny AS y0, maxx AS x1, miny + ord AS y1, conf_pct / 10.0 AS error FROM {boxes})"
WALLS = "(SELECT page_id, label || '/' || x0 AS block_id, x0 AS minx, least(y0, y1) AS miny, x1 AS maxx, greatest(y0, y1) AS maxy FROM {separators} WHERE label <> 'H')"
TURN = "least(abs(atan2(a.y1 - a.y0, a.x1 - a.x0) - atan2(b.y1 - b.y0, b.x1 - b.x0)) % pi(), pi() - abs(atan2(a.y1 - a.y0, a.x1 - a.x0) - atan2(b.y1 - b.y0, b.x1 - b.x0)) % pi())"
#: Components of ``e`` (page_id, a, b) over the nodes of ``b``: ``c`` (page_id, node, component).
CLOSED = """r(page_id, node, other) AS (SELECT page_id, block_id, block_id FROM b UNION SELECT r.page_id, r.node, e.b FROM r JOIN e ON r.page_id = e.page_id AND r.other = e.a),
c AS (SELECT page_id, node, min(other) AS component FROM r GROUP BY page_id, node)"""


MARK = "'r_' || translate(block_id, './', '__')"
CORDS = """'<Coords points="60,' || ({0}) || ' 860,' || ({0}) || ' 860,' || ({1}) || ' 60,' || ({1}) || '"/>'"""
ESCAPE = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
SAID = f"'<TextEquiv><Unicode>' || {ESCAPE.format('text')} || '</Unicode></TextEquiv>'"


def merging_rounds(condition: str, rounds: int) -> str:
    """``rounds`` rounds of uniting all boxes of ``b0`` that satisfy ``condition`` (of a and b), as further tables up to ``b<rounds>``."""
    out = []
    for k in range(rounds):
        out.append(f"""e{k} AS (SELECT a.page_id, a.block_id AS a, b.block_id AS b FROM b{k} a JOIN b{k} b ON a.page_id = b.page_id AND a.block_id <> b.block_id AND {condition}),
r{k}(page_id, node, other) AS (SELECT page_id, block_id, block_id FROM b{k} UNION SELECT r{k}.page_id, r{k}.node, e{k}.b FROM r{k} JOIN e{k} ON r{k}.page_id = e{k}.page_id AND r{k}.other = e{k}.a),
c{k} AS (SELECT page_id, node, min(other) AS component FROM r{k} GROUP BY page_id, node),
b{k + 1} AS (SELECT c{k}.page_id, arg_min(block_id, (-(maxx - minx) * (maxy - miny), block_id)) AS block_id, arg_min(label, (-(maxx - minx) * (maxy - miny), block_id)) AS label, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy
  FROM c{k} JOIN b{k} ON c{k}.page_id = b{k}.page_id AND c{k}.node = b{k}.block_id GROUP BY c{k}.page_id, component)""")
    return ",\n".join(out)


def oracle_sql() -> dict[str, str]:
    overlap = "greatest(0, least(a.maxx, b.maxx) - greatest(a.minx, b.minx)) * greatest(0, least(a.maxy, b.maxy) - greatest(a.miny, b.miny))"
    s = {
        "repaired_regions": """WITH b AS (SELECT page_id, block_id, CASE WHEN ord = 2 THEN maxx WHEN ord = 3 THEN NULL ELSE minx END AS p, CASE WHEN ord IN (2, 4) THEN minx ELSE maxx END AS q, miny, maxy FROM {boxes})
SELECT page_id, block_id, least(p, q) AS minx, least(miny, maxy) AS miny, greatest(p, q) AS maxx, greatest(miny, maxy) AS maxy FROM b WHERE p IS NOT NULL AND p <> q AND miny <> maxy""",
        "geometry_faults": r"""WITH s AS (SELECT row_id, CASE WHEN row_id % 7 = 0 THEN replace(line_wkt, 'POLYGON', 'POINT') WHEN row_id % 11 = 0 THEN regexp_replace(line_wkt, ', \S+ \S+\)\)$', '))') WHEN row_id % 13 = 0 THEN replace(line_wkt, ' ', '?') ELSE line_wkt END AS s FROM lines),
p AS (SELECT row_id, s, list_transform(string_split(regexp_extract(s, '\(\(([^()]+)\)', 1), ','), lambda x: trim(x)) AS pts FROM s)
SELECT row_id, CASE WHEN trim(coalesce(s, '')) = '' THEN 'missing' WHEN upper(regexp_extract(s, '^\s*([A-Za-z]+)', 1)) <> 'POLYGON' THEN 'type'
  WHEN len(pts) < 4 OR len(list_filter(pts, lambda x: NOT regexp_matches(x, '^-?\d+(\.\d+)?([eE][-+]?\d+)? -?\d+(\.\d+)?([eE][-+]?\d+)?$'))) > 0 THEN 'malformed' WHEN pts[1] <> pts[len(pts)] THEN 'open' END AS fault FROM p WHERE fault IS NOT NULL""",
        "long_separators": f"SELECT page_id, label FROM {{separators}} WHERE sqrt(CAST((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0) AS DOUBLE)) > {DIAGONAL * 0.05!r}",
        "confident_lines": "SELECT row_id, confidence FROM {ocr_lines} WHERE confidence >= 0.8",
        "next_block_ids": "SELECT page_path AS page_id, label, coalesce(max(TRY_CAST(string_split(block_id, '.')[1] AS BIGINT)), -1) + 1 AS next_id FROM {ocr_lines} GROUP BY ALL",
        "split_keys": "SELECT row_id, CASE WHEN regexp_matches(block_id, '^[12]$') THEN page_path || '/' || block_id || '.' || k ELSE page_path || '/' || block_id END AS key FROM {ocr_lines}, range(1, 3) t(k) WHERE label = 'TEXT' AND (k = 1 OR regexp_matches(block_id, '^[12]$'))",
        "label_lookup": "SELECT CAST(CASE l_suppkey % 5 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 0 END AS INT) AS label, count(*) AS n FROM lineitem GROUP BY 1",
        "all_labels": "SELECT page_id, label, count(*) AS n FROM {boxes} GROUP BY ALL UNION ALL SELECT page_id, '*', count(*) FROM {boxes} GROUP BY ALL",
        "lines_in_blocks": f"WITH {REGIONS} SELECT row_id, miny AS block_miny, maxy AS block_maxy FROM {{ocr_lines}} o JOIN r ON r.page_id = o.page_path AND r.label = o.label AND r.block_id = o.block_id WHERE maxy - miny > 40",
        "page_document": f"WITH {REGIONS} SELECT page_path AS page_id, o.label, o.block_id, line_id, text, confidence, maxy FROM {{ocr_lines}} o JOIN r ON r.page_id = o.page_path AND r.label = o.label AND r.block_id = o.block_id WHERE confidence >= 0.8 AND text <> ''",
        "ordered_parts": f"""WITH {REGIONS}, s AS (SELECT page_id, 'regions/' || label || '/' || block_id AS path, block_id, CAST(NULL AS INT) AS line_id, false AS is_line FROM r
UNION ALL SELECT page_path, 'regions/' || label || '/' || block_id || '/' || line_id, block_id, line_id, true FROM {{ocr_lines}} WHERE line_id < 3
UNION ALL SELECT page_path, 'regions/' || label || '/' || block_id || '/999', block_id, 999, true FROM {{ocr_lines}} a WHERE line_id = 0 AND EXISTS (SELECT 1 FROM {{ocr_lines}} b WHERE b.page_path = a.page_path AND b.label = a.label AND b.block_id = a.block_id AND b.line_id = 999))
SELECT page_id, CAST(length(path) AS INT) AS rank, path, block_id, line_id, is_line FROM s""",
        "missing_texts": f"""WITH {REGIONS} SELECT r.page_id, r.label, r.block_id, CASE WHEN bool_or(coalesce(confidence >= 0.8, false)) THEN 'lost' ELSE 'unsure' END AS state FROM r JOIN {{ocr_lines}} o ON r.page_id = o.page_path AND r.label = o.label AND r.block_id = o.block_id
GROUP BY r.page_id, r.label, r.block_id HAVING count(*) FILTER (length(text) <= 40) = 0""",
        "combined_tables": f"WITH {REGIONS} SELECT page_id, label, CASE WHEN label = 'TABULAR' THEN string_split(block_id, '.')[1] ELSE block_id END AS block_id, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, count(*) AS n_parts FROM r GROUP BY 1, 2, 3",
        "nested_bounds": """WITH c AS (SELECT page_id, ord % 2 AS division, ord % 3 AS col, conf_pct AS row, minx, miny, maxx, maxy FROM {boxes} WHERE label = 'TABULAR')
SELECT page_id, 'cell' AS level, division, col AS "column", row, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM c GROUP BY page_id, division, col, row
UNION ALL SELECT page_id, 'column', division, col, NULL, min(minx), min(miny), max(maxx), max(maxy) FROM c GROUP BY page_id, division, col
UNION ALL SELECT page_id, 'division', division, NULL, NULL, min(minx), min(miny), max(maxx), max(maxy) FROM c GROUP BY page_id, division
UNION ALL SELECT page_id, 'table', NULL, NULL, NULL, min(minx), min(miny), max(maxx), max(maxy) FROM c GROUP BY page_id""",
        "merge_lineage": f"""WITH RECURSIVE {PAIRS.replace("b AS {boxes}", "b AS (SELECT * FROM {boxes} WHERE label = 'TEXT')")}, q AS (SELECT *, greatest(0, least(ay1, by1) - greatest(ay0, by0)) / least(ay1 - ay0, by1 - by0) AS aligned, greatest(0, greatest(ax0, bx0) - least(ax1, bx1)) AS gap FROM p),
e AS (SELECT page_id, a_block_id AS a, b_block_id AS b FROM q WHERE a_block_id <> b_block_id AND aligned >= 0.8 AND gap <= 60), {CLOSED},
l AS (SELECT c.page_id, component, arg_min(node, (-(maxx - minx) * (maxy - miny), node)) AS lead FROM c JOIN b ON b.page_id = c.page_id AND b.block_id = c.node GROUP BY ALL)
SELECT c.page_id, lead AS block_id, node AS source FROM c JOIN l ON l.page_id = c.page_id AND l.component = c.component""",
        "margin_noise": f"""WITH n AS (SELECT page_id, block_id, minx, maxx, maxx - minx AS w, CAST(maxx - minx < {PAGE_WIDTH * 0.15!r} AS INT) AS n FROM {{boxes}})
SELECT page_id, block_id, min(n) OVER (PARTITION BY page_id ORDER BY minx, w, block_id ROWS UNBOUNDED PRECEDING) = 1 OR min(n) OVER (PARTITION BY page_id ORDER BY maxx DESC, w, block_id ROWS UNBOUNDED PRECEDING) = 1 AS noise FROM n""",
        "greedy_match": f"""WITH b AS {{boxes}}, m AS (SELECT page_id, block_id, minx + (ord - 4) * 5 AS minx, miny, maxx + (ord - 4) * 5 AS maxx, maxy FROM b),
p AS (SELECT a.page_id, a.block_id, b.block_id AS source_id, {overlap} AS overlap, (b.maxx - b.minx) * (b.maxy - b.miny) AS area FROM b a JOIN m b ON a.page_id = b.page_id),
f AS (SELECT *, overlap / area AS share FROM p WHERE area >= 10 AND overlap / area > 0.6 QUALIFY row_number() OVER (PARTITION BY page_id, source_id ORDER BY overlap / area DESC, block_id) = 1)
SELECT page_id, source_id, block_id, overlap, row_number() OVER (PARTITION BY page_id, block_id ORDER BY share DESC, source_id) > 1 AS duplicate FROM f""",
        "interval_neighbours": "WITH b AS {boxes} SELECT a.page_id, a.block_id AS a, b.block_id AS b, least(a.maxy, b.maxy) - greatest(a.miny, b.miny) AS overlap, b.minx - a.maxx AS gap FROM b a JOIN b ON a.page_id = b.page_id AND (a.minx, a.block_id) < (b.minx, b.block_id) AND least(a.maxy, b.maxy) - greatest(a.miny, b.miny) >= 3",
        "unstopped_pairs": f"""WITH b AS {{boxes}}, w AS {WALLS}, p AS (SELECT a.page_id, a.block_id AS a, b.block_id AS b, a.maxx AS x0, b.minx AS x1, greatest(a.miny, b.miny) AS y0, least(a.maxy, b.maxy) AS y1
  FROM b a JOIN b ON a.page_id = b.page_id AND (a.minx, a.block_id) < (b.minx, b.block_id) AND least(a.maxy, b.maxy) - greatest(a.miny, b.miny) >= 3 AND b.minx >= a.maxx)
SELECT page_id, a, b FROM p WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.page_id = p.page_id AND w.minx <= p.x1 AND w.maxx >= p.x0 AND w.miny <= p.y1 AND w.maxy >= p.y0)""",
        "glued_regions": f"""WITH RECURSIVE b AS {{boxes}}, e0 AS (SELECT a.page_id, a.block_id AS a, b.block_id AS b FROM b a JOIN b ON a.page_id = b.page_id AND a.block_id <> b.block_id AND (a.maxx - a.minx) * (a.maxy - a.miny) <= 4000
  AND pow(greatest(a.minx - b.maxx, b.minx - a.maxx, 0), 2) + pow(greatest(a.miny - b.maxy, b.miny - a.maxy, 0), 2) <= 900), e AS (SELECT * FROM e0 UNION SELECT page_id, b, a FROM e0), {CLOSED}
SELECT c.page_id, arg_min(node, (-(maxx - minx) * (maxy - miny), node)) AS block_id, count(*) AS n_parts, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM c JOIN b ON b.page_id = c.page_id AND b.block_id = c.node GROUP BY c.page_id, component""",
        "agglomerated_regions": f"""WITH RECURSIVE b AS {{boxes}}, w AS {WALLS}, t AS (SELECT b.page_id, b.block_id AS a, w.block_id AS s FROM b JOIN w ON b.page_id = w.page_id AND b.minx <= w.maxx + 10 AND b.maxx >= w.minx - 10 AND b.miny <= w.maxy + 10 AND b.maxy >= w.miny - 10),
e AS (SELECT DISTINCT x.page_id, x.a, y.a AS b FROM t x JOIN t y ON x.page_id = y.page_id AND x.s = y.s), {CLOSED} SELECT page_id, node AS block_id, component AS "group" FROM c""",
        "text_areas": """WITH b AS {boxes} SELECT a.page_id, a.block_id, max(CASE WHEN b.maxx <= a.minx THEN b.maxx + 5 END) AS x0, min(CASE WHEN b.minx >= a.maxx THEN b.minx - 5 END) AS x1
FROM b a LEFT JOIN b ON a.page_id = b.page_id AND a.block_id <> b.block_id AND least(a.maxy, b.maxy) > greatest(a.miny, b.miny) GROUP BY a.page_id, a.block_id""",
        "reliable_regions": f"""WITH {REGIONS}, o AS (SELECT page_path AS page_id, label, block_id, string_split(block_id, '.')[1] AS base, line_id FROM {{ocr_lines}}),
l AS (SELECT page_id, label, base, 100 AS minx, min(line_id) * 40 AS miny, 800 AS maxx, max(line_id) * 40 + 30 AS maxy FROM o WHERE line_id % 2 = 0 GROUP BY ALL),
n AS (SELECT page_id, label, coalesce(max(TRY_CAST(string_split(block_id, '.')[1] AS BIGINT)), -1) + 1 AS next_id FROM r WHERE label = 'TEXT' GROUP BY ALL)
SELECT r.page_id, r.label, r.block_id, greatest(r.minx, l.minx) AS minx, greatest(r.miny, l.miny) AS miny, least(r.maxx, l.maxx) AS maxx, least(r.maxy, l.maxy) AS maxy FROM r JOIN l ON l.page_id = r.page_id AND l.label = r.label AND l.base = string_split(r.block_id, '.')[1]
  WHERE r.label = 'TEXT' AND greatest(r.miny, l.miny) < least(r.maxy, l.maxy)
UNION ALL SELECT o.page_id, o.label, CAST(next_id + row_number() OVER (PARTITION BY o.page_id, o.label ORDER BY o.block_id || '/3') - 1 AS VARCHAR), 100, 120, 800, 150 FROM o JOIN n ON n.page_id = o.page_id AND n.label = o.label WHERE o.label = 'TEXT' AND line_id = 3""",
        "disjoint_hulls": f"WITH RECURSIVE b0 AS {{boxes}}, {merging_rounds('a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy', 7)} SELECT page_id, block_id, minx, miny, maxx, maxy FROM b7",
        "merged_overlaps": f"WITH RECURSIVE b0 AS {{boxes}}, {merging_rounds(f'a.label = b.label AND {overlap} > 0 AND {overlap} / least((a.maxx - a.minx) * (a.maxy - a.miny), (b.maxx - b.minx) * (b.maxy - b.miny)) > 0.1', 6)} SELECT page_id, block_id, label, minx, miny, maxx, maxy FROM b6",
        "navigation": "SELECT row_id, lag(row_id) OVER w AS previous, lead(row_id) OVER w AS next FROM lines WINDOW w AS (PARTITION BY page_path ORDER BY line_path NULLS FIRST, row_id)",
        "paper_slugs": "SELECT paper_code, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM paper",
        "subdivided_separators": """WITH s AS (SELECT *, greatest(1, CAST(ceil(sqrt(CAST((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0) AS DOUBLE)) / 150) AS INT)) AS n FROM {separators})
SELECT page_id, CAST(k AS INT) AS piece, round(x0 + (x1 - x0) * k / n, 4) AS x0, round(y0 + (y1 - y0) * k / n, 4) AS y0, round(x0 + (x1 - x0) * (k + 1) / n, 4) AS x1, round(y0 + (y1 - y0) * (k + 1) / n, 4) AS y1 FROM s, range(12) t(k) WHERE k < n""",
        "smoothed_paths": "WITH p AS (SELECT page_id, ord, min(minx) AS x, min(miny) AS y FROM {boxes} GROUP BY ALL) SELECT page_id, ord, round(avg(x) OVER w, 4) AS x, round(avg(y) OVER w, 4) AS y FROM p WINDOW w AS (PARTITION BY page_id ORDER BY ord ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)",
        "path_progress": """WITH p AS (SELECT page_id, ord, min(minx) AS x, min(miny) AS y FROM {boxes} GROUP BY ALL), s AS (SELECT page_id, ord, coalesce(sqrt(CAST(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2) AS DOUBLE)), 0.0) AS step FROM p WINDOW w AS (PARTITION BY page_id ORDER BY ord))
SELECT page_id, ord, round(sum(step) OVER (PARTITION BY page_id ORDER BY ord ROWS UNBOUNDED PRECEDING), 3) AS progress FROM s""",
        "steady_separators": "WITH p AS (SELECT page_id, label, block_id, atan2(ord - 4, maxx - minx) AS angle FROM {boxes}) SELECT page_id, label, block_id FROM p QUALIFY stddev_pop(angle) OVER (PARTITION BY page_id, label) <= 0.01",
        "near_ends": f"""WITH s AS {SEGMENTS}, p AS (SELECT a.page_id, a.label, a.block_id AS a, b.block_id AS b, sqrt(CAST(least(pow(a.x0 - b.x0, 2) + pow(a.y0 - b.y0, 2), pow(a.x0 - b.x1, 2) + pow(a.y0 - b.y1, 2), pow(a.x1 - b.x0, 2) + pow(a.y1 - b.y0, 2), pow(a.x1 - b.x1, 2) + pow(a.y1 - b.y1, 2)) AS DOUBLE)) AS d
  FROM s a JOIN s b ON a.page_id = b.page_id AND a.label = b.label AND a.block_id < b.block_id) SELECT page_id, label, a, b, round(d, 4) AS distance FROM p WHERE d < CASE label WHEN 'TEXT' THEN 200 WHEN 'TABULAR' THEN 120 END""",
        "parallel_segments": f"""WITH s AS {SEGMENTS} SELECT a.page_id, a.block_id AS a, b.block_id AS b FROM s a JOIN s b ON a.page_id = b.page_id AND a.label = b.label AND a.block_id < b.block_id AND {TURN} <= 0.02
  AND sqrt(CAST(pow(greatest(a.x0 - b.x1, b.x0 - a.x1, 0), 2) + pow(greatest(a.y0 - b.y1, b.y0 - a.y1, 0), 2) AS DOUBLE)) < 80""",
        "good_segments": f"SELECT page_id, block_id FROM {SEGMENTS} WHERE error <= 0.5 AND sqrt(CAST((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0) AS DOUBLE)) >= 100",
        "join_reasons": f"""WITH s AS {SEGMENTS} SELECT a.page_id, a.block_id AS a, b.block_id AS b, CASE WHEN a.label <> b.label THEN 'LABEL' WHEN (a.x0 = a.x1 AND a.y0 = a.y1) OR (b.x0 = b.x1 AND b.y0 = b.y1) THEN 'COLLAPSE'
  WHEN sqrt(CAST(pow(b.x0 - a.x1, 2) + pow(b.y0 - a.y1, 2) AS DOUBLE)) > 600 THEN 'DISTANCE' WHEN ((b.x0 - a.x0) * (a.x1 - a.x0) + (b.y0 - a.y0) * (a.y1 - a.y0)) * 2 < pow(a.x1 - a.x0, 2) + pow(a.y1 - a.y0, 2) THEN 'PARALLEL'
  WHEN {TURN} > 0.02 THEN 'DIRECTION' WHEN a.x0 % 2 = 0 THEN 'MASK' END AS reason FROM s a JOIN s b ON a.page_id = b.page_id AND a.block_id < b.block_id""",
        "tile_label_stats": """WITH p AS (SELECT page_id, minx // 500 AS tx, miny // 500 AS ty, ord % 3 AS label, count(*) AS n FROM {boxes} GROUP BY ALL), t AS (SELECT page_id, count(DISTINCT (tx, ty)) AS tiles FROM p GROUP BY page_id)
SELECT t.page_id, CAST(k AS INT) AS label, round(coalesce(sum(n), 0) / any_value(tiles), 6) AS mean FROM t CROSS JOIN range(3) r(k) LEFT JOIN p ON p.page_id = t.page_id AND p.label = k GROUP BY t.page_id, k""",
        "line_form": """WITH p AS (SELECT page_id, label AS y, CAST(ord AS VARCHAR) || block_id AS x, ord % 3 > 0 AS black FROM {boxes}), s AS (SELECT *, CASE WHEN black IS DISTINCT FROM lag(black) OVER w THEN 1 ELSE 0 END AS starts FROM p WINDOW w AS (PARTITION BY page_id, y ORDER BY x)),
n AS (SELECT *, sum(starts) OVER (PARTITION BY page_id, y ORDER BY x ROWS UNBOUNDED PRECEDING) AS run FROM s), r AS (SELECT page_id, count(*) AS len FROM n WHERE black GROUP BY page_id, y, run)
SELECT p.page_id, round(avg(len), 6) AS form FROM (SELECT DISTINCT page_id FROM p) p LEFT JOIN r ON r.page_id = p.page_id GROUP BY p.page_id""",
        "label_set": """WITH n AS (SELECT DISTINCT paper_code AS name, coalesce(merged_into, paper_code) AS g FROM paper) SELECT name, CAST(row_number() OVER (ORDER BY name) - 1 AS INT) AS label, g AS "group", CAST(dense_rank() OVER (ORDER BY g) - 1 AS INT) AS group_label FROM n""",
        "warp_parameters": "SELECT page_path, round((CAST(('0x' || sha256(page_path)[1:8]) AS BIGINT) / 4294967296.0 * 2 - 1) * 0.2, 6) AS alpha, round((CAST(('0x' || sha256(page_path)[9:16]) AS BIGINT) / 4294967296.0 * 2 - 1) * 0.2, 6) AS beta FROM scan_page",
        "resized_regions": f"SELECT page_id, block_id, round(330 - (miny * {825 / PAGE_HEIGHT!r} - 412.5), 3) AS x, round(412.5 + (minx * {660 / PAGE_WIDTH!r} - 330), 3) AS y FROM {{boxes}}",
        "partial_outputs": r"""WITH w AS (SELECT regexp_extract(path, '([^/]+/\d+/[^/]+/jpg/[^/.]+)\.out/', 1) || '.jpg' AS page_path, count(DISTINCT path) AS n_written FROM ocr_file GROUP BY 1), a AS (SELECT page_path, count(*) AS n_wanted FROM {ocr_lines} GROUP BY 1)
SELECT page_path, n_written, n_wanted FROM w JOIN a USING (page_path) WHERE n_written < n_wanted""",
        "pagexml_regions": f"""WITH l AS (SELECT page_path, block_id, line_id, min(text) AS text FROM {{ocr_lines}} WHERE label = 'TEXT' GROUP BY ALL),
t AS (SELECT page_path, CASE WHEN contains(block_id, '.') THEN block_id ELSE block_id || '.1.1.1' END AS p, line_id, text FROM {{ocr_lines}} WHERE label = 'TABULAR'),
c AS (SELECT page_path, string_split(p, '.')[1] AS block_id, coalesce(TRY_CAST(string_split(p, '.')[2] AS INT), 0) AS d, coalesce(TRY_CAST(string_split(p, '.')[3] AS INT), 0) AS r, coalesce(TRY_CAST(string_split(p, '.')[4] AS INT), 0) AS k, string_agg(text, chr(10) ORDER BY line_id, text) AS text FROM t GROUP BY ALL),
i AS (SELECT page_path, 'TEXT' AS label, block_id, string_agg('<TextLine id="' || {MARK} || '_l_' || line_id || '">' || {CORDS.format("line_id * 40", "line_id * 40 + 40")} || {SAID} || '</TextLine>', '' ORDER BY line_id) AS inner_ FROM l GROUP BY page_path, block_id
  UNION ALL SELECT page_path, 'TABULAR', block_id, string_agg('<TextRegion id="' || {MARK} || '_' || d || '_' || r || '_' || k || '">' || {CORDS.format("r * 40", "r * 40 + 40")} || {SAID} || '</TextRegion>', '' ORDER BY d, r, k) FROM c GROUP BY page_path, block_id),
a AS (SELECT page_path, label, string_split(block_id, '.')[1] AS block_id, min(line_id) AS lo, max(line_id) AS hi FROM {{ocr_lines}} GROUP BY ALL),
g AS (SELECT * FROM a UNION ALL SELECT page_path, 'ILLUSTRATION', '9999', lo, hi FROM a WHERE block_id = '1' AND label = 'TEXT'),
b AS (SELECT g.page_path, g.block_id, g.label, {MARK.replace("block_id", "g.block_id")} AS id, CASE g.label WHEN 'TEXT' THEN 'TextRegion' WHEN 'TABULAR' THEN 'TableRegion' ELSE 'GraphicRegion' END AS kind, {CORDS.format("lo * 40", "hi * 40 + 40")} AS coords, coalesce(inner_, '') AS inner_
  FROM g LEFT JOIN i ON i.page_path = g.page_path AND i.label = g.label AND i.block_id = g.block_id WHERE inner_ IS NOT NULL OR g.label NOT IN ('TEXT', 'TABULAR')),
n AS (SELECT *, row_number() OVER (PARTITION BY page_path ORDER BY block_id, label) - 1 AS n FROM b)
SELECT page_path, '<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="{pagexml.NAMESPACE}"><Metadata><Creator>broadsheet</Creator><Created>1970-01-01T00:00:00</Created><LastChange>1970-01-01T00:00:00</LastChange></Metadata><Page imageFilename="' || {ESCAPE.format("page_path")}
  || '" imageWidth="0" imageHeight="0"><ReadingOrder><OrderedGroup id="ro">' || string_agg('<RegionRefIndexed index="' || n || '" regionRef="' || id || '"/>', '' ORDER BY n) || '</OrderedGroup></ReadingOrder>'
  || string_agg('<' || kind || ' id="' || id || '">' || coords || inner_ || '</' || kind || '>', '' ORDER BY n) || '</Page></PcGts>' AS xml FROM n GROUP BY page_path""",
        "elapsed_percentiles": "SELECT l_returnflag, count(*) AS n, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.25), 4) AS q0, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.75), 4) AS q1, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.99), 4) AS q2 FROM lineitem GROUP BY 1",
        "intersecting_keys": "SELECT page_path, concat_ws('/', predictor, label, block_id, CAST(line_id AS VARCHAR)) AS line_path FROM {ocr_lines} INTERSECT SELECT page_path, line_path FROM lines",
    }
    return {name: duck(sql) for name, sql in s.items()}
