"""Queries of text composition, harmonisation, annotations, sampling, statistics and tracking, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.paths import main_page, normal_path
from broadsheet.operators import annotations, compose, harmonize, sampling, stats, tracking
from broadsheet.plans.fixtures import boxes, doc_lines, duck, ocr_lines, runs
from broadsheet.session import table

#: Characters the letter filter takes out.
IGNORED = "„“»«"


def ocr_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return compose.sorted_lines(ocr_lines(spark, folder)).select("row_id", "rank")


def compose_plain_text(spark: SparkSession, folder: str) -> DataFrame:
    return compose.plain_text(ocr_lines(spark, folder))


def compose_letter_filter(spark: SparkSession, folder: str) -> DataFrame:
    return compose.plain_text(ocr_lines(spark, folder), "\n", IGNORED)


def region_text_export(spark: SparkSession, folder: str) -> DataFrame:
    return compose.region_texts(ocr_lines(spark, folder))


def regionless_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of long lines of one block of a document, as new regions."""
    rows = doc_lines(spark, folder).withColumn("free", F.length("text") > 30)
    return compose.merged_regions(rows, "block_id", "line_no", "free").select("page_id", F.col("run").cast("bigint").alias("run"), "block_id", "n", "first", "last")


def table_cells(spark: SparkSession, folder: str) -> DataFrame:
    return compose.table_cells(ocr_lines(spark, folder))


def table_text(spark: SparkSession, folder: str) -> DataFrame:
    return compose.table_texts(compose.table_cells(ocr_lines(spark, folder)))


def cell_paths(spark: SparkSession, folder: str) -> DataFrame:
    rows = ocr_lines(spark, folder).filter("label = 'TABULAR'")
    return rows.select("row_id", compose.cell_path(compose.fixed_path(F.col("label"), F.col("block_id")), F.col("line_id"), 2).alias("path"))


def harmonize_default(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ocr").filter("ocr_text IS NOT NULL")
    return rows.select("row_id", harmonize.harmonized(F.col("ocr_text")).alias("text"))


def harmonize_styled(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ocr").filter("ocr_text IS NOT NULL")
    return rows.select("row_id", harmonize.harmonized(F.col("ocr_text"), "styled").alias("text"))


def harmonize_unstyled(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ocr").filter("ocr_text IS NOT NULL")
    return rows.select("row_id", harmonize.harmonized(F.col("ocr_text"), "unstyled").alias("text"))


def alphabet_violations(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ocr").filter("ocr_text IS NOT NULL")
    return harmonize.violations(rows, "ocr_text", "default").select("row_id", "illegal")


def annotation_export(spark: SparkSession, folder: str) -> DataFrame:
    """Harmonised annotations of either set, with the line's id and set; lines that come out empty are left out."""
    lines = table(spark, folder, "lines")
    rows = lines.select("row_id", annotations.line_id(F.col("page_path"), F.col("line_path")).alias("line"), annotations.membership(F.col("training"), F.col("validation")).alias("sets"), harmonize.harmonized(F.col("annotation")).alias("text"))
    return rows.filter("sets IS NOT NULL AND text <> ''")


def annotation_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The annotation saved last of each place, pages in normal form and merged papers under their main code."""
    rows = main_page(table(spark, folder, "lines"), table(spark, folder, "paper"))
    return annotations.latest(rows, ["page", "line_path"]).select("page", "line_path", "row_id", "annotation", annotations.author(F.col("author")).alias("author"))


def annotation_search(spark: SparkSession, folder: str) -> DataFrame:
    return annotations.found(table(spark, folder, "lines"), r"\bNr\. [0-9]+", regex=True).select("row_id")


def annotation_search_text(spark: SparkSession, folder: str) -> DataFrame:
    return annotations.found(table(spark, folder, "lines"), "Straße", text_only=True).select("row_id")


def annotation_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Two databases, of odd and of even rows, merged."""
    lines = table(spark, folder, "lines")
    return annotations.merged(lines.filter("row_id % 2 = 1"), lines.filter("row_id % 2 = 0")).select("page_path", "line_path", "row_id")


def annotation_delta(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lines")
    return annotations.delta(lines.filter("row_id % 3 <> 0"), lines.filter("row_id % 3 <> 1"))


def unsampled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Recognised lines that no annotation has."""
    rows = table(spark, folder, "ocr").filter("page_path IS NOT NULL").select("row_id", "page_path", F.concat_ws("/", "predictor", "label", "block_id", F.col("line_id").cast("string")).alias("line_path"))
    have = table(spark, folder, "lines").select(normal_path(F.col("page_path")).alias("page_path"), "line_path").distinct()
    return annotations.unsampled(rows, have).select("row_id")


def set_membership(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lines").withColumn("sets", annotations.membership(F.col("training"), F.col("validation")))
    return rows.groupBy("sets").agg(F.count("*").alias("n"))


def runtime_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.elapsed(runs(spark, folder))


def runtime_errors(spark: SparkSession, folder: str) -> DataFrame:
    return stats.errors(runs(spark, folder).withColumn("page_path", normal_path(F.col("page_path"))))


def runtime_json(spark: SparkSession, folder: str) -> DataFrame:
    """Runtime records read back from their JSON form."""
    rows = runs(spark, folder).filter("batch IS NOT NULL")
    text = rows.select("run_id", F.to_json(F.map_from_arrays(F.array("batch"), F.array(F.struct("status", F.col("elapsed").alias("total_time"))))).alias("json"))
    return stats.runtime_of(text, "json").select("run_id", "batch", "status", "elapsed")


def artifact_counts(spark: SparkSession, folder: str) -> DataFrame:
    done = runs(spark, folder).filter("status = 'COMPLETED'").withColumn("page_path", normal_path(F.col("page_path")))
    return stats.artifact_counts(done, "batch", "page_path")


def incremental_pending(spark: SparkSession, folder: str) -> DataFrame:
    """Pages ready for composition: no completed run of it, but completed runs of what it needs."""
    r = runs(spark, folder).withColumn("page_path", normal_path(F.col("page_path")))
    return tracking.unfinished(table(spark, folder, "scan_page").select("page_path"), r, "compose", ["ocr", "layout"])


def change_tracking(spark: SparkSession, folder: str) -> DataFrame:
    """Regions against a moved copy in which some are missing."""
    b = boxes(spark, folder).select("page_id", "block_id", "label", "minx")
    old = b.filter("ord <> 2")
    new = b.filter("ord <> 3").withColumn("minx", F.when(F.col("minx") % 5 == 0, F.col("minx") + 1).otherwise(F.col("minx")))
    return tracking.changes(old, new, ["page_id", "block_id"])


def record_upsert(spark: SparkSession, folder: str) -> DataFrame:
    b = boxes(spark, folder).select("page_id", "block_id", "label")
    fresh = b.filter("page_id % 4 = 0").select("page_id", "block_id", F.lit("TEXT").alias("label"), (F.col("page_id") % 8 == 0).alias("gone"))
    return tracking.upsert(b, fresh, ["page_id", "block_id"], "gone")


def letter_counts(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.letter_counts(table(spark, folder, "lines"), "row_id", "annotation")


def split_floor(spark: SparkSession, folder: str) -> DataFrame:
    totals = sampling.letter_counts(table(spark, folder, "lines"), "row_id", "annotation").groupBy("letter").agg(F.sum("n").alias("total"))
    return totals.select("letter", "total", sampling.split_floor(F.col("total"), 0.8).alias("need"))


def sample_uniform(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.uniform(table(spark, folder, "scan_page").select("page_path"), "page_path", 100)


def sample_stratified(spark: SparkSession, folder: str) -> DataFrame:
    """Five text lines and one table line of each page."""
    rows = ocr_lines(spark, folder).select("row_id", "page_path", "label")
    return sampling.stratified(rows, ["page_path", "label"], "row_id", {"TEXT": 5, "TABULAR": 1}, "label")


def split_train_val(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.train_val(table(spark, folder, "lines").select("row_id"), "row_id", 0.1)


def kfold(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.folds(table(spark, folder, "lines").select("row_id"), "row_id", 5)


def kfold_sets(spark: SparkSession, folder: str) -> DataFrame:
    rows = sampling.folds(table(spark, folder, "lines").select("row_id"), "row_id", 5)
    return sampling.fold_sets(rows).groupBy("fold", "set").agg(F.count("*").alias("n"))


def covering_split(spark: SparkSession, folder: str) -> DataFrame:
    """A training set in which every letter is frequent enough."""
    counts = sampling.letter_counts(table(spark, folder, "lines"), "row_id", "annotation")
    return sampling.covering_split(counts, "row_id")


def quantile_bins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").filter("n_chars IS NOT NULL").select("doc_id", "n_chars")
    return sampling.discretized(rows, "n_chars", 3).select("doc_id", "bin")


def sample_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "task").select("task_id", sampling.flattened_name(F.col("path")).alias("name"))


def cluster_signature(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as signatures, single linkage at L1 distance 40."""
    return stats.clusters(stats.quantized(table(spark, folder, "embeddings")).select("vec_id", "vector"), "vec_id", "vector", 40)


def signature_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return stats.l1_pairs(stats.quantized(table(spark, folder, "embeddings")).select("vec_id", "vector"), "vec_id", "vector", 40)


NAMES = [
    ocr_sorted, compose_plain_text, compose_letter_filter, region_text_export, regionless_merge, table_cells, table_text, cell_paths, harmonize_default, harmonize_styled, harmonize_unstyled,
    alphabet_violations, annotation_export, annotation_latest, annotation_search, annotation_search_text, annotation_merge, annotation_delta, unsampled_lines, set_membership, runtime_stats,
    runtime_errors, runtime_json, artifact_counts, incremental_pending, change_tracking, record_upsert, letter_counts, split_floor, sample_uniform, sample_stratified, split_train_val, kfold,
    kfold_sets, covering_split, quantile_bins, sample_names, cluster_signature, signature_pairs,
]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}


SPACE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"


def _plain(separator: str, ignored: str) -> str:
    text = f"regexp_replace(regexp_replace(text, '^{SPACE}+', ''), '{SPACE}+$', '')"
    if ignored:
        text = f"translate({text}, '{ignored}', '')"
    return f"""WITH o AS (SELECT page_path, concat_ws(chr(1), predictor, label, block_id) AS block, row_number() OVER (PARTITION BY page_path ORDER BY predictor, label, block_id, line_id) AS rank, {text} AS text FROM {{ocr_lines}}),
s AS (SELECT *, CASE WHEN lag(block) OVER (PARTITION BY page_path ORDER BY rank) <> block THEN {separator} ELSE '' END || text || chr(10) AS piece FROM o WHERE text <> '')
SELECT page_path, string_agg(piece, '' ORDER BY rank) AS text FROM s GROUP BY page_path"""


def oracle_sql() -> dict[str, str]:
    from broadsheet.functions.paths import NORMAL_PATH_SQL

    page = NORMAL_PATH_SQL.format("page_path")
    ident = "md5('0:' || CAST(row_id AS VARCHAR))"
    last = "coalesce(saved_at, TIMESTAMP '0001-01-01')"
    vector = "list_transform(embedding, lambda e: least(2, CAST(floor(abs(CAST(e AS FLOAT)) * 20) AS INT)))"
    near = f"""v AS (SELECT vec_id, {vector} AS v FROM embeddings),
n AS (SELECT a.vec_id AS a, b.vec_id AS b, list_sum(list_transform(list_zip(a.v, b.v), lambda z: abs(z[1] - z[2]))) AS distance FROM v a JOIN v b ON a.vec_id < b.vec_id)"""
    s = {
        "ocr_sorted": "SELECT row_id, CAST(row_number() OVER (PARTITION BY page_path ORDER BY predictor, label, block_id, line_id) AS INT) AS rank FROM {ocr_lines}",
        "compose_plain_text": _plain("chr(10) || chr(10)", ""),
        "compose_letter_filter": _plain("chr(10)", IGNORED),
        "region_text_export": "SELECT page_path, predictor, label, block_id, string_agg(text, chr(10) ORDER BY line_id) AS text FROM {ocr_lines} GROUP BY ALL HAVING sum(length(text)) > 50",
        "regionless_merge": """WITH d AS (SELECT *, length(text) > 30 AS free FROM {doc_lines}),
s AS (SELECT *, CASE WHEN free AND block_id = lag(block_id) OVER w AND lag(free) OVER w THEN 0 ELSE 1 END AS starts FROM d WINDOW w AS (PARTITION BY page_id ORDER BY line_no)),
n AS (SELECT *, sum(starts) OVER (PARTITION BY page_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS run FROM s)
SELECT page_id, CAST(run AS BIGINT) AS run, block_id, count(*) AS n, min(line_no) AS first, max(line_no) AS last FROM n WHERE free GROUP BY page_id, run, block_id""",
        "table_cells": """WITH f AS (SELECT *, string_split(CASE WHEN contains(block_id, '.') THEN block_id ELSE block_id || '.1.1.1' END, '.') AS p FROM {ocr_lines} WHERE label = 'TABULAR')
SELECT page_path, p[1] AS table, TRY_CAST(p[2] AS INT) AS division, TRY_CAST(p[3] AS INT) AS row, TRY_CAST(p[4] AS INT) AS column, string_agg(text, chr(10) ORDER BY line_id) AS text FROM f GROUP BY ALL""",
        "cell_paths": """WITH f AS (SELECT *, string_split(CASE WHEN contains(block_id, '.') THEN block_id ELSE block_id || '.1.1.1' END, '.') AS p FROM {ocr_lines} WHERE label = 'TABULAR')
SELECT row_id, p[1] || '.' || p[2] || '.' || CAST(line_id + 1 AS VARCHAR) || '.2' AS path FROM f""",
        "harmonize_default": f"SELECT row_id, {harmonize.sql_of('ocr_text')} AS text FROM ocr WHERE ocr_text IS NOT NULL",
        "harmonize_styled": f"SELECT row_id, {harmonize.sql_of('ocr_text', 'styled')} AS text FROM ocr WHERE ocr_text IS NOT NULL",
        "harmonize_unstyled": f"SELECT row_id, {harmonize.sql_of('ocr_text', 'unstyled')} AS text FROM ocr WHERE ocr_text IS NOT NULL",
        "alphabet_violations": f"SELECT row_id, left(r, 1) AS illegal FROM (SELECT row_id, translate(ocr_text, '{harmonize.ALPHABETS['default'].replace(chr(39), chr(39) * 2)}', '') AS r FROM ocr WHERE ocr_text IS NOT NULL) WHERE r <> ''",
        "annotation_export": f"""SELECT * FROM (SELECT row_id, replace(page_path, '/', '.') || '.' || replace(line_path, '/', '.') AS line,
  CASE WHEN training AND validation THEN 'tv' WHEN training THEN 't' WHEN validation THEN 'v' END AS sets, {harmonize.sql_of("annotation")} AS text FROM lines) WHERE sets IS NOT NULL AND text <> ''""",
        "annotation_latest": f"""WITH n AS (SELECT *, {page} AS p FROM lines), m AS (SELECT n.*, CASE WHEN merged_into IS NULL THEN p ELSE merged_into || substr(p, length(string_split(p, '/')[1]) + 1) END AS page
  FROM n LEFT JOIN (SELECT paper_code, min(merged_into) AS merged_into FROM paper WHERE merged_into IS NOT NULL GROUP BY 1) c ON c.paper_code = string_split(p, '/')[1])
SELECT page, line_path, row_id, annotation, nullif(lower(trim(author)), '') AS author FROM m QUALIFY row_number() OVER (PARTITION BY page, line_path ORDER BY {last} DESC, row_id DESC) = 1""",
        "annotation_search": r"SELECT row_id FROM lines WHERE regexp_matches(coalesce(concat_ws('|', page_path, line_path, annotation, author), ''), '(?i)\bNr\. [0-9]+')",
        "annotation_search_text": "SELECT row_id FROM lines WHERE contains(lower(annotation), 'straße')",
        "annotation_merge": f"SELECT page_path, line_path, row_id FROM lines QUALIFY row_number() OVER (PARTITION BY page_path, line_path ORDER BY {last} DESC, row_id % 2, row_id DESC) = 1",
        "annotation_delta": """WITH o AS (SELECT DISTINCT page_path, line_path FROM lines WHERE row_id % 3 <> 0), n AS (SELECT DISTINCT page_path, line_path FROM lines WHERE row_id % 3 <> 1)
SELECT *, 'add' AS change FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'del' FROM (SELECT * FROM o EXCEPT SELECT * FROM n)""",
        "unsampled_lines": f"SELECT row_id FROM ocr WHERE page_path IS NOT NULL AND NOT EXISTS (SELECT 1 FROM (SELECT {page} AS p, line_path FROM lines) l WHERE l.p = ocr.page_path AND l.line_path = concat_ws('/', predictor, label, block_id, CAST(line_id AS VARCHAR)))",
        "set_membership": "SELECT CASE WHEN training AND validation THEN 'tv' WHEN training THEN 't' WHEN validation THEN 'v' END AS sets, count(*) AS n FROM lines GROUP BY 1",
        "runtime_stats": "SELECT batch, count(*) AS n, round(min(elapsed), 6) AS min_s, round(median(elapsed), 6) AS median_s, round(quantile_cont(elapsed, 0.9), 6) AS p90_s FROM {runs} WHERE elapsed IS NOT NULL GROUP BY batch",
        "runtime_errors": f"SELECT batch, traceback, count(*) AS n, min(p) AS first_page, count(DISTINCT p) AS n_pages FROM (SELECT *, {page} AS p FROM {{runs}}) WHERE traceback IS NOT NULL GROUP BY batch, traceback",
        "runtime_json": "SELECT run_id, batch, status, elapsed FROM {runs} WHERE batch IS NOT NULL",
        "artifact_counts": f"SELECT batch, count(*) AS n, count(DISTINCT p) AS n_pages FROM (SELECT *, {page} AS p FROM {{runs}}) WHERE status = 'COMPLETED' GROUP BY batch",
        "incremental_pending": f"""WITH r AS (SELECT DISTINCT {page} AS p, batch FROM {{runs}} WHERE status = 'COMPLETED')
SELECT page_path FROM scan_page WHERE page_path NOT IN (SELECT p FROM r WHERE batch = 'compose') AND page_path IN (SELECT p FROM r WHERE batch = 'ocr') AND page_path IN (SELECT p FROM r WHERE batch = 'layout')""",
        "change_tracking": """WITH b AS {boxes}, o AS (SELECT * FROM b WHERE ord <> 2), n AS (SELECT page_id, block_id, label, CASE WHEN minx % 5 = 0 THEN minx + 1 ELSE minx END AS minx FROM b WHERE ord <> 3)
SELECT coalesce(o.page_id, n.page_id) AS page_id, coalesce(o.block_id, n.block_id) AS block_id, CASE WHEN o.page_id IS NULL THEN 'added' WHEN n.page_id IS NULL THEN 'removed' WHEN (o.label, o.minx) IS DISTINCT FROM (n.label, n.minx) THEN 'changed' ELSE 'same' END AS status
FROM o FULL JOIN n ON o.page_id = n.page_id AND o.block_id = n.block_id""",
        "record_upsert": "SELECT page_id, block_id, CASE WHEN page_id % 4 = 0 THEN 'TEXT' ELSE label END AS label FROM {boxes} WHERE page_id % 8 <> 0",
        "letter_counts": "SELECT row_id, letter, count(*) AS n FROM (SELECT row_id, unnest(string_split(annotation, '')) AS letter FROM lines) WHERE letter <> '' GROUP BY ALL",
        "split_floor": "WITH t AS (SELECT letter, count(*) AS total FROM (SELECT unnest(string_split(annotation, '')) AS letter FROM lines) WHERE letter <> '' GROUP BY 1) SELECT letter, total, greatest(1, least(total - 1, CAST(floor(total * 0.8) AS BIGINT))) AS need FROM t",
        "sample_uniform": "SELECT page_path FROM scan_page ORDER BY md5('0:' || page_path), page_path LIMIT 100",
        "sample_stratified": f"SELECT row_id, page_path, label FROM {{ocr_lines}} QUALIFY row_number() OVER (PARTITION BY page_path, label ORDER BY {ident}, row_id) <= CASE label WHEN 'TEXT' THEN 5 WHEN 'TABULAR' THEN 1 ELSE 0 END",
        "split_train_val": f"SELECT row_id, CASE WHEN row_number() OVER (ORDER BY {ident}, row_id) <= CAST(floor(0.1 * (SELECT count(*) FROM lines)) AS BIGINT) THEN 'val' ELSE 'train' END AS split FROM lines",
        "kfold": f"""WITH k AS (SELECT row_id, row_number() OVER (ORDER BY {ident}, row_id) - 1 AS i, (SELECT count(*) FROM lines) // 5 AS size, (SELECT count(*) FROM lines) % 5 AS more FROM lines)
SELECT row_id, CAST(CASE WHEN i < more * (size + 1) THEN i // (size + 1) ELSE more + (i - more * (size + 1)) // greatest(size, 1) END AS INT) AS fold FROM k""",
        "kfold_sets": """WITH c AS (SELECT count(*) AS n FROM lines), f AS (SELECT CAST(f AS INT) AS fold, n // 5 + CASE WHEN f < n % 5 THEN 1 ELSE 0 END AS own, n FROM c, range(5) r(f))
SELECT fold, 'val' AS set, own AS n FROM f UNION ALL SELECT fold, 'test', own FROM f UNION ALL SELECT fold, 'train', n - own FROM f""",
        "quantile_bins": """WITH q AS (SELECT quantile_cont(n_chars, [1 / 3, 2 / 3]) AS q FROM documents WHERE n_chars IS NOT NULL)
SELECT doc_id, CAST(CASE WHEN n_chars < q[1] THEN 0 ELSE 1 END + CASE WHEN n_chars < q[2] THEN 0 ELSE 1 END AS INT) AS bin FROM documents, q WHERE n_chars IS NOT NULL""",
        "sample_names": "SELECT task_id, regexp_replace(regexp_replace(path, '^/+|/+$', '', 'g'), '/+', '--', 'g') AS name FROM task",
        "signature_pairs": f"WITH {near} SELECT a, b, CAST(distance AS INT) AS distance FROM n WHERE distance <= 40 AND (distance > 0 OR NOT EXISTS (SELECT 1 FROM n m WHERE m.b = n.a AND m.distance = 0))",
        "cluster_signature": f"""WITH RECURSIVE {near}, e AS (SELECT a, b FROM n WHERE distance <= 40 UNION ALL SELECT b, a FROM n WHERE distance <= 40),
r(node, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a) SELECT node AS vec_id, min(other) AS cluster FROM r GROUP BY node""",
    }
    return {name: duck(sql) for name, sql in s.items()}
