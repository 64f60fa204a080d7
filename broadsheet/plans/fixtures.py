"""Deterministic projections of the star-schema tables onto pages: boxes, separators, runs and text lines, for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import table

#: Page frame of the box projection and its diagonal.
PAGE_WIDTH, PAGE_HEIGHT = 1320, 1650


def boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Regions of pages as axis-parallel boxes; (page_id, block_id) is unique."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS page_id",
        "concat_ws('-', CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING), CAST(CAST(l_quantity AS INT) AS STRING)) AS block_id",
        "CASE l_returnflag WHEN 'A' THEN 'TEXT' WHEN 'N' THEN 'TABULAR' ELSE 'ILLUSTRATION' END AS label",
        "(l_partkey * 37) % 1000 AS minx",
        "(l_suppkey * 53 + l_linenumber * 97) % 1400 AS miny",
        "(l_partkey * 37) % 1000 + 20 + CAST(l_quantity AS INT) * 6 AS maxx",
        "(l_suppkey * 53 + l_linenumber * 97) % 1400 + 10 + (l_partkey % 7) * 40 AS maxy",
        "l_linenumber AS ord",
        "CAST(round(l_discount * 100) AS INT) AS conf_pct",
    )


def separators(spark: SparkSession, folder: str) -> DataFrame:
    """One separator for each page: V and T stand, H lies."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS page_id",
        "CASE o_orderstatus WHEN 'P' THEN 'V' WHEN 'F' THEN 'H' ELSE 'T' END AS label",
        "CASE WHEN o_orderstatus = 'F' THEN 50 ELSE (o_custkey * 31) % 1000 END AS x0",
        "CASE WHEN o_orderstatus = 'F' THEN (o_custkey * 31) % 1400 ELSE 50 END AS y0",
        "CASE WHEN o_orderstatus = 'F' THEN 50 + o_custkey % 1200 ELSE (o_custkey * 31) % 1000 END AS x1",
        "CASE WHEN o_orderstatus = 'F' THEN (o_custkey * 31) % 1400 ELSE 50 + o_custkey % 1300 END AS y1",
        "1 + o_custkey % 4 AS width",
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts of batches on pages, normalised: page, batch, status (NULL when broken off), elapsed, traceback."""
    return table(spark, folder, "runtime").select("run_id", "page_path", F.lower(F.trim("batch")).alias("batch"), F.upper(F.trim("status")).alias("status"), "elapsed", "traceback")


def doc_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of documents, three to a block."""
    lines = table(spark, folder, "documents").select(F.col("doc_id").alias("page_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    return lines.selectExpr("page_id", "line_no", "CAST(line_no div 3 AS STRING) AS block_id", "line_no % 3 AS line_id", "text")


def ocr_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Recognised lines, each place once (the line loaded first), texts never NULL."""
    o = table(spark, folder, "ocr").filter("page_path IS NOT NULL")
    first = o.groupBy("page_path", "predictor", "label", "block_id", "line_id").agg(F.min_by(F.coalesce("ocr_text", F.lit("")), "row_id").alias("text"), F.min("row_id").alias("row_id"), F.min_by("confidence", "row_id").alias("confidence"))
    return first


DUCK = {
    "boxes": """(SELECT l_orderkey AS page_id,
  concat_ws('-', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS INT) AS VARCHAR)) AS block_id,
  CASE l_returnflag WHEN 'A' THEN 'TEXT' WHEN 'N' THEN 'TABULAR' ELSE 'ILLUSTRATION' END AS label,
  (l_partkey * 37) % 1000 AS minx, (l_suppkey * 53 + l_linenumber * 97) % 1400 AS miny,
  (l_partkey * 37) % 1000 + 20 + CAST(l_quantity AS INT) * 6 AS maxx,
  (l_suppkey * 53 + l_linenumber * 97) % 1400 + 10 + (l_partkey % 7) * 40 AS maxy,
  l_linenumber AS ord, CAST(round(l_discount * 100) AS INT) AS conf_pct FROM lineitem)""",
    "separators": """(SELECT o_orderkey AS page_id, CASE o_orderstatus WHEN 'P' THEN 'V' WHEN 'F' THEN 'H' ELSE 'T' END AS label,
  CASE WHEN o_orderstatus = 'F' THEN 50 ELSE (o_custkey * 31) % 1000 END AS x0,
  CASE WHEN o_orderstatus = 'F' THEN (o_custkey * 31) % 1400 ELSE 50 END AS y0,
  CASE WHEN o_orderstatus = 'F' THEN 50 + o_custkey % 1200 ELSE (o_custkey * 31) % 1000 END AS x1,
  CASE WHEN o_orderstatus = 'F' THEN (o_custkey * 31) % 1400 ELSE 50 + o_custkey % 1300 END AS y1,
  1 + o_custkey % 4 AS width FROM orders)""",
    "runs": "(SELECT run_id, page_path, lower(trim(batch)) AS batch, upper(trim(status)) AS status, elapsed, traceback FROM runtime)",
    "doc_lines": """(SELECT page_id, line_no, CAST(line_no // 3 AS VARCHAR) AS block_id, CAST(line_no % 3 AS INT) AS line_id, text FROM (
  SELECT doc_id AS page_id, CAST(unnest(range(len(t))) AS INT) AS line_no, unnest(t) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS t FROM documents WHERE text IS NOT NULL)))""",
    "ocr_lines": """(SELECT page_path, predictor, label, block_id, line_id, arg_min(coalesce(ocr_text, ''), row_id) AS text, min(row_id) AS row_id, arg_min_null(confidence, row_id) AS confidence
  FROM ocr WHERE page_path IS NOT NULL GROUP BY page_path, predictor, label, block_id, line_id)""",
}


def duck(sql: str) -> str:
    """``sql`` with {boxes}, {runs} .. replaced by DuckDB subqueries."""
    for name, text in DUCK.items():
        sql = sql.replace("{" + name + "}", text)
    return sql
