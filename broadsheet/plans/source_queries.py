"""Queries of sources, sinks, shapes, model contracts, training helpers and streams, with DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import wkt
from broadsheet.functions.numbers import rounded
from broadsheet.functions.paths import NORMAL_PATH_SQL, normal_path
from broadsheet.operators import geometry, sampling
from broadsheet.plans.fixtures import PAGE_HEIGHT, PAGE_WIDTH, boxes, duck, ocr_lines
from broadsheet.session import shared_dir, table
from broadsheet.sources import artifacts, models, pagexml
from broadsheet.streaming import runs as streams


def normal_paths(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "ocr_file").select("file_id", normal_path(F.col("path")).alias("place"))


def image_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listed paths by their kind of node."""
    return table(spark, folder, "task").select("task_id", artifacts.is_image(F.col("path")).alias("is_image"), artifacts.node_kind(F.col("path")).alias("kind"))


def resolved_images(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "scan_page").select(F.concat(F.lit("/archive/"), F.regexp_replace("page_path", r"\.jpg$", ".tif")).alias("page_path"))
    return artifacts.resolve(pages, table(spark, folder, "task").select("path").distinct())


def _outlined(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lines").filter("line_wkt IS NOT NULL AND page_path IS NOT NULL AND line_path IS NOT NULL")
    part = F.split("line_path", "/")
    rows = rows.select("row_id", "page_path", F.get(part, F.lit(2)).alias("block_id"), F.get(part, F.lit(3)).try_cast("int").alias("line_id"), "line_wkt", "annotation")
    first = rows.groupBy("page_path", "block_id", "line_id").agg(F.min_by(F.struct("row_id", "line_wkt", "annotation"), "row_id").alias("r"))
    return first.select("page_path", "block_id", "line_id", F.col("r.row_id").alias("row_id"), wkt.points(F.col("r.line_wkt")).alias("ring"), F.coalesce("r.annotation", F.lit("")).alias("text"))


def wkt_bounds(spark: SparkSession, folder: str) -> DataFrame:
    rows = _outlined(spark, folder).withColumn("b", wkt.bounds(F.col("ring")))
    return rows.select("row_id", "b.minx", "b.miny", "b.maxx", "b.maxy", rounded(wkt.ring_area(F.col("ring")), 3).alias("area"))


def convex_hulls(spark: SparkSession, folder: str) -> DataFrame:
    """Hull of all annotated lines of a block."""
    found = geometry.hulls(_outlined(spark, folder), ["page_path", "block_id"])
    return found.select("page_path", "block_id", F.size("hull").alias("corners"), rounded("area", 3).alias("area"))


def pagexml_write(spark: SparkSession, folder: str) -> DataFrame:
    rows = _outlined(spark, folder)
    return pagexml.documents(rows.withColumn("points", wkt.coordinates(wkt.open_ring(F.col("ring")))))


def pagexml_read(spark: SparkSession, folder: str) -> DataFrame:
    """Lines read back from the documents written."""
    return pagexml.lines_of(pagexml_write(spark, folder)).select("page_path", "region", "line", "points", "text")


def archive_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Recognised lines packed into one archive for each page and read back."""
    rows = ocr_lines(spark, folder).select(F.col("page_path").alias("page"), F.concat_ws("/", "predictor", "label", "block_id", F.concat(F.col("line_id").cast("string"), F.lit(".txt"))).alias("name"), F.col("text").alias("content"))
    return artifacts.texts(artifacts.archived(rows))


def region_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return geometry.neighbours(boxes(spark, folder), 64)


def mask_signature(spark: SparkSession, folder: str) -> DataFrame:
    """Pixels and rows of the mask of each page and label."""
    found = geometry.mask_signature(boxes(spark, folder), PAGE_WIDTH, PAGE_HEIGHT)
    line = F.transform("mask", lambda r: F.concat_ws(":", r["y"], r["w0"], r["w1"], r["w2"], r["w3"]))
    return found.select("page_id", "label", "pixels", F.md5(F.concat_ws(";", line)).alias("digest"))


def path_recognition(spark: SparkSession, folder: str) -> DataFrame:
    """The stand-in for recognition over all lines; those without confidence count as too small."""
    rows = ocr_lines(spark, folder).select("row_id", "predictor", "label", "block_id", "line_id", F.coalesce(F.col("confidence") * 40, F.lit(0.0)).alias("width"), F.lit(34).alias("height"))
    return models.recognized(rows, models.PathText()).select("row_id", "text")


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    pixels = table(spark, folder, "lineitem").selectExpr("CAST(l_suppkey % 4 AS INT) AS label")
    found = sampling.class_weights(pixels, 4)
    return spark.createDataFrame([(int(a), round(float(b), 6)) for a, b in found.itertuples(index=False)], "label int, weight double")


def tile_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles over every scanned page whose size is known."""
    pages = table(spark, folder, "scan_page").filter("width IS NOT NULL AND height IS NOT NULL").select("page_path", "width", "height")
    count = lambda full, size: F.when(full <= size, F.lit(1)).otherwise(F.ceil((full - 50) / (size - 50))).cast("int")
    rows = pages.withColumn("nx", count(F.col("width"), 1280)).withColumn("ny", count(F.col("height"), 896))
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    at = lambda k, n, full, size: F.when(n > 1, F.bround(k * (full - size) / (n - 1))).otherwise(0).cast("int")
    return rows.select("page_path", at(F.col("i"), F.col("nx"), F.col("width"), 1280).alias("x"), at(F.col("j"), F.col("ny"), F.col("height"), 896).alias("y"))


def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts by week, batch and status, counted by a stream over the run records."""
    name = f"counts_{uuid.uuid4().hex}"
    found = streams.window_counts(streams.run_stream(spark, f"{folder}/runtime.parquet"))
    return streams.drained_table(found, name, f"{shared_dir(spark)}/{name}")


def stream_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Each attempt once, repeats dropped by a stream with a watermark."""
    name = f"attempts_{uuid.uuid4().hex}"
    found = streams.once(streams.run_stream(spark, f"{folder}/runtime.parquet"), "3650 days").select("page", "batch", "started_at")
    return streams.drained_files(found, f"{shared_dir(spark)}/{name}/rows", f"{shared_dir(spark)}/{name}/checkpoint")


NAMES = [
    normal_paths, image_pages, resolved_images, wkt_bounds, convex_hulls, pagexml_write, pagexml_read, archive_round_trip, region_neighbours, mask_signature, path_recognition, class_weights, tile_layout,
    stream_counts, stream_attempts,
]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}


OUTLINED = r"""o AS (SELECT page_path, string_split(line_path, '/')[3] AS block_id, TRY_CAST(string_split(line_path, '/')[4] AS INT) AS line_id, row_id, coalesce(annotation, '') AS text,
  list_transform(string_split(regexp_extract(line_wkt, '\(\(([^()]+)\)', 1), ','), lambda p: {'x': CAST(string_split(trim(p), ' ')[1] AS DOUBLE), 'y': CAST(string_split(trim(p), ' ')[2] AS DOUBLE)}) AS ring
  FROM lines WHERE line_wkt IS NOT NULL AND page_path IS NOT NULL AND line_path IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY page_path, block_id, line_id ORDER BY row_id) = 1)"""
POINTS = "array_to_string(list_transform(CASE WHEN ring[1] = ring[len(ring)] THEN ring[1:len(ring) - 1] ELSE ring END, lambda p: CAST(CAST(round_even(p.x, 0) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(round_even(p.y, 0) AS BIGINT) AS VARCHAR)), ' ')"


def oracle_sql() -> dict[str, str]:
    page = "regexp_replace(regexp_replace(lower({0}), '^/?archive/', ''), '^/', '')".replace("{0}", NORMAL_PATH_SQL.format("page_path"))
    region = "'r_' || translate(block_id, './', '__')"
    escape = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
    zero = "1970-01-01T00:00:00"
    s = {
        "normal_paths": f"SELECT file_id, {NORMAL_PATH_SQL.format('path')} AS place FROM ocr_file",
        "image_pages": "SELECT task_id, regexp_matches(lower(path), '\\.(jpg|png|tif|tiff)$') AS is_image, CASE WHEN regexp_matches(path, '\\.out(/|$)') OR regexp_matches(path, '(^|/)presentation(/|$)') THEN 'ignore' WHEN regexp_matches(path, '/jpg/.*\\.jpg$') THEN 'page' ELSE 'descend' END AS kind FROM task",
        "resolved_images": """WITH i AS (SELECT regexp_replace(path, '\\.[^./]+$', '') AS stem, min(path) AS image FROM (SELECT DISTINCT path FROM task) GROUP BY 1 HAVING count(*) = 1)
SELECT '/archive/' || regexp_replace(page_path, '\\.jpg$', '.tif') AS page_path, image FROM scan_page LEFT JOIN i ON i.stem = '/archive/' || regexp_replace(page_path, '\\.jpg$', '')""",
        "wkt_bounds": f"""WITH {OUTLINED} SELECT row_id, list_min(list_transform(ring, lambda p: p.x)) AS minx, list_min(list_transform(ring, lambda p: p.y)) AS miny, list_max(list_transform(ring, lambda p: p.x)) AS maxx, list_max(list_transform(ring, lambda p: p.y)) AS maxy,
  round(abs(list_sum(list_transform(range(1, len(ring)), lambda i: ring[i].x * ring[i + 1].y - ring[i + 1].x * ring[i].y))) / 2, 3) AS area FROM o""",
        "pagexml_read": f"WITH {OUTLINED} SELECT page_path, {region} AS region, {region} || '_l_' || line_id AS line, {POINTS} AS points, text FROM o",
        "pagexml_write": f"""WITH {OUTLINED}, l AS (SELECT page_path, block_id, {region} AS region, line_id, {POINTS} AS points, text FROM o),
r AS (SELECT page_path, block_id, region, arg_min(points, line_id) AS points, string_agg('<TextLine id="' || region || '_l_' || line_id || '"><Coords points="' || points || '"/><TextEquiv><Unicode>' || {escape.replace("{0}", "text")} || '</Unicode></TextEquiv></TextLine>', '' ORDER BY line_id) AS lines FROM l GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY page_path ORDER BY block_id) - 1 AS i FROM r)
SELECT page_path, '<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="{pagexml.NAMESPACE}"><Metadata><Creator>broadsheet</Creator><Created>{zero}</Created><LastChange>{zero}</LastChange></Metadata><Page imageFilename="' || {escape.replace("{0}", "page_path")}
  || '" imageWidth="0" imageHeight="0"><ReadingOrder><OrderedGroup id="ro">' || string_agg('<RegionRefIndexed index="' || i || '" regionRef="' || region || '"/>', '' ORDER BY i) || '</OrderedGroup></ReadingOrder>'
  || string_agg('<TextRegion id="' || region || '"><Coords points="' || points || '"/>' || lines || '</TextRegion>', '' ORDER BY i) || '</Page></PcGts>' AS xml FROM n GROUP BY page_path""",
        "archive_round_trip": "SELECT page_path AS page, predictor, label, block_id, line_id, text FROM {ocr_lines}",
        "mask_signature": f"""WITH b AS (SELECT page_id, label, maxx - minx > 4 AND maxy - miny > 4 AS solid,
  {", ".join(f"CAST(least(greatest({f}(({c} {d} 2) * 128 / {size}), 0), 128) AS INT) AS {n}" for f, c, d, size, n in (("floor", "minx", "+", PAGE_WIDTH, "x0"), ("floor", "miny", "+", PAGE_HEIGHT, "y0"), ("ceil", "maxx", "-", PAGE_WIDTH, "x1"), ("ceil", "maxy", "-", PAGE_HEIGHT, "y1")))} FROM {{boxes}}),
r AS (SELECT page_id, label, y, {", ".join(f"bit_or(CAST(pow(2, least(greatest(x1 - {32 * k}, 0), 32)) AS BIGINT) - CAST(pow(2, least(greatest(x0 - {32 * k}, 0), 32)) AS BIGINT)) AS w{k}" for k in range(4))}
  FROM b, range(128) t(y) WHERE solid AND x0 < x1 AND y >= y0 AND y < y1 GROUP BY page_id, label, y),
s AS (SELECT page_id, label, CAST(sum(bit_count(w0) + bit_count(w1) + bit_count(w2) + bit_count(w3)) AS BIGINT) AS pixels, string_agg(concat_ws(':', y, w0, w1, w2, w3), ';' ORDER BY y) AS lines FROM r GROUP BY page_id, label)
SELECT DISTINCT b.page_id, b.label, coalesce(pixels, 0) AS pixels, md5(coalesce(lines, '')) AS digest FROM b LEFT JOIN s ON s.page_id = b.page_id AND s.label = b.label""",
        "path_recognition": "SELECT row_id, CASE WHEN coalesce(confidence * 40, 0) >= 6 THEN 'text for ' || concat_ws('/', predictor, label, block_id, CAST(line_id AS VARCHAR)) || '.' ELSE '' END AS text FROM {ocr_lines}",
        "class_weights": "WITH c AS (SELECT CAST(l_suppkey % 4 AS INT) AS label, count(*) AS n FROM lineitem GROUP BY 1) SELECT CAST(k AS INT) AS label, round(coalesce((SELECT median(n) FROM c) / c.n, 0.0), 6) AS weight FROM range(4) r(k) LEFT JOIN c ON c.label = k",
        "tile_layout": """WITH p AS (SELECT *, CASE WHEN width <= 1280 THEN 1 ELSE CAST(ceil((width - 50) / 1230) AS INT) END AS nx, CASE WHEN height <= 896 THEN 1 ELSE CAST(ceil((height - 50) / 846) AS INT) END AS ny FROM scan_page WHERE width IS NOT NULL AND height IS NOT NULL)
SELECT page_path, CAST(CASE WHEN nx > 1 THEN round_even(i * (width - 1280) / (nx - 1), 0) ELSE 0 END AS INT) AS x, CAST(CASE WHEN ny > 1 THEN round_even(j * (height - 896) / (ny - 1), 0) ELSE 0 END AS INT) AS y FROM p, range(64) a(i), range(64) b(j) WHERE i < nx AND j < ny""",
        "stream_counts": "SELECT time_bucket(INTERVAL 7 DAYS, started_at, TIMESTAMP '1970-01-01') AS window_start, lower(trim(batch)) AS batch, upper(trim(status)) AS status, count(*) AS n FROM runtime WHERE started_at IS NOT NULL GROUP BY ALL",
        "stream_attempts": f"SELECT DISTINCT {page} AS page, lower(trim(batch)) AS batch, started_at FROM runtime",
    }
    return {name: duck(sql) for name, sql in s.items()}
