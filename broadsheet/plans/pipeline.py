"""Queries of the data-keeping operators of the core: compaction of small files, incremental processing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.paths import NORMAL_PATH_SQL
from broadsheet.operators import compaction, incremental
from broadsheet.session import shared_dir, table

#: Size of the files that p3_rewrite writes; small, as the test tables are.
REWRITE_BYTES = 64 << 10


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return compaction.superfluous(table(spark, folder, "ocr_file"))


def p3_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Files and bytes of each group of the plan."""
    planned = compaction.plan(compaction.frozen_manifest(table(spark, folder, "ocr_file")), REWRITE_BYTES)
    return planned.filter("kept").groupBy("group").agg(F.count("*").alias("n_records"), F.sum("size").alias("n_bytes"))


def p3_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """Rewrites the files in groups and reconciles the result with the plan."""
    import uuid

    planned = compaction.written_plan(compaction.frozen_manifest(table(spark, folder, "ocr_file")), REWRITE_BYTES)
    path = f"{shared_dir(spark)}/compacted-{uuid.uuid4().hex}"
    compaction.rewrite(planned, path)
    return compaction.reconcile(planned, spark.read.parquet(path)).filter("group IS NOT NULL")


def p3_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records that come out: one row for each."""
    return compaction.plan(compaction.frozen_manifest(table(spark, folder, "ocr_file"))).filter("kept").select("file_id", "place", "record")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.pending_paths(table(spark, folder, "task"), table(spark, folder, "runtime")).select("path")


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p3_plan, p3_rewrite, p3_records, p5_found)}


P3_ROWS = f"""
f AS (SELECT file_id, {NORMAL_PATH_SQL.format("path")} AS place,
  regexp_replace(regexp_replace(coalesce(ocr_text, ''), '^﻿', ''), '[\\r\\n]+$', '') AS record FROM ocr_file),
d AS (SELECT place, record, min(file_id) AS file_id FROM f GROUP BY place, record),
k AS (SELECT d.*, lead(record) OVER (PARTITION BY place ORDER BY record) AS next FROM d),
kept AS (SELECT file_id, place, record FROM k WHERE next IS NULL OR NOT starts_with(next, record))"""


def oracle_sql() -> dict[str, str]:
    p5 = f"""
WITH t AS (SELECT {NORMAL_PATH_SQL.format("path")} AS path, etag, changed_at, task_id FROM task WHERE path IS NOT NULL),
c AS (SELECT *, lag(etag) OVER w AS before, row_number() OVER w AS k FROM t WINDOW w AS (PARTITION BY path ORDER BY changed_at NULLS FIRST, task_id)),
last AS (SELECT path, max(changed_at) AS at FROM c WHERE k = 1 OR etag IS DISTINCT FROM before GROUP BY path),
r AS (SELECT regexp_replace(lower({NORMAL_PATH_SQL.format("page_path")}), '^/', '') AS key, started_at FROM runtime
  WHERE upper(trim(status)) = 'COMPLETED' AND lower(trim(batch)) = 'compose')
SELECT path FROM last WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.key = regexp_replace(lower(last.path), '^/?archive/', '') AND r.started_at >= last.at)"""
    return {
        "p3_found": f"WITH {P3_ROWS} SELECT file_id FROM ocr_file WHERE file_id NOT IN (SELECT file_id FROM kept)",
        "p3_plan": f"""WITH {P3_ROWS}, s AS (SELECT strlen(record) + 1 AS size, sum(strlen(record) + 1) OVER (ORDER BY place, record ROWS UNBOUNDED PRECEDING) - strlen(record) - 1 AS running FROM kept)
SELECT CAST(running // {REWRITE_BYTES} AS BIGINT) AS "group", count(*) AS n_records, CAST(sum(size) AS BIGINT) AS n_bytes FROM s GROUP BY 1""",
        "p3_rewrite": f"""WITH {P3_ROWS}, s AS (SELECT sum(strlen(record) + 1) OVER (ORDER BY place, record ROWS UNBOUNDED PRECEDING) - strlen(record) - 1 AS running FROM kept)
SELECT CAST(running // {REWRITE_BYTES} AS BIGINT) AS "group", count(*) AS n_planned, count(*) AS n_written, true AS ok FROM s GROUP BY 1""",
        "p3_records": f"WITH {P3_ROWS} SELECT * FROM kept",
        "p5_found": p5,
    }
