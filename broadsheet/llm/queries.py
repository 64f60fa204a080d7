"""Queries of the operators for training data, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.paths import NORMAL_PATH_SQL
from broadsheet.llm import boilerplate, chars, grouping, leaks, overlap, repair, subjects, tokens
from broadsheet.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    found = overlap.overlaps(table(spark, folder, "lines"))
    return found.select(F.least("validation_row", "training_row").alias("row_id_a"), F.greatest("validation_row", "training_row").alias("row_id_b"))


def p1_report(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs and distinct rows by the papers of the validation and the training row."""
    return overlap.report(table(spark, folder, "lines"), table(spark, folder, "paper"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return chars.look_alikes(table(spark, folder, "ocr"), table(spark, folder, "lines"))


def p2_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = chars.texts_of(table(spark, folder, "ocr"), table(spark, folder, "lines"))
    return chars.with_canonical(rows, "text").select("tab", "row_id", "canonical")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return repair.Repair(*(table(spark, folder, t) for t in ("ocr", "lines", "paper"))).defects()


def p4_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The text of every page as continuous paragraphs."""
    return repair.Repair(*(table(spark, folder, t) for t in ("ocr", "lines", "paper"))).paragraphs()


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.boilerplate(table(spark, folder, "ocr")).select("row_id")


def p6_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of boilerplate: their paper, lines, rows and pages."""
    rows = boilerplate.boilerplate(table(spark, folder, "ocr"))
    return rows.groupBy("block").agg(F.min("paper").alias("paper"), F.countDistinct("node").alias("n_lines"), F.count("*").alias("n_rows"), F.countDistinct("page").alias("n_pages"))


def p6_clean(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.without_boilerplate(table(spark, folder, "ocr")).select("row_id", "page_path", "ocr_text")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.mixed_issues(table(spark, folder, "lines"), table(spark, folder, "paper"))


def p7_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The set of every annotation: each issue of a paper lies wholly in one."""
    rows = grouping.record_keys(table(spark, folder, "lines"), table(spark, folder, "paper"))
    return grouping.splits(rows.select("row_id", "keys"), "row_id")


def p7_related(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every annotation where issues that share a text belong together, too."""
    rows = grouping.record_keys(table(spark, folder, "lines"), table(spark, folder, "paper"), ("issue", "text"))
    return grouping.grouped(rows.select("row_id", "keys"), "row_id").select("row_id", "component")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, folder, "documents"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_passages(spark, folder).select("doc_id", "item_id")


def p9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "test_item"))


def p10_subjects(spark: SparkSession, folder: str) -> DataFrame:
    return subjects.document_subjects(*(table(spark, folder, t) for t in ("documents", "subject_area", "subject_sample")))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_subjects(spark, folder).select("doc_id", "subject")


def p10_composition(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus measured by subject: documents and sentences, also by language."""
    found = p10_subjects(spark, folder)
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(F.substring("lang", 1, 2)).alias("lang"))
    return found.join(docs, "doc_id", "left").groupBy("subject", "lang").agg(F.count("*").alias("n_documents"), F.sum("n_sentences").alias("n_sentences"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_report, p2_found, p2_text, p4_found, p4_pages, p6_found, p6_blocks, p6_clean, p7_found, p7_splits, p7_related, p8_ids, p9_found, p9_passages, p10_found, p10_subjects, p10_composition)}


# what the consistent form takes out or changes, as patterns
ODD = r"[\x{ff01}-\x{ff5e}\x{ffe0}-\x{ffe6}\x{fb00}-\x{fb06}\x{a0}\x{1680}\x{2000}-\x{200f}\x{202a}-\x{202f}\x{205f}-\x{2064}\x{2066}-\x{206f}\x{3000}\x{ad}\x{61c}\x{180e}\x{feff}\x{34f}\x{fe00}-\x{fe0f}\x{2028}\x{2029}\x{85}\t\x0b\x0c]"
MIXED = r"\p{Latin}\p{M}*[\p{Greek}\p{Cyrillic}]|[\p{Greek}\p{Cyrillic}]\p{M}*\p{Latin}"


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested against brute force."""
    page = NORMAL_PATH_SQL.format("page_path")
    rows = f"""n AS (SELECT row_id, {page} AS p, annotation, coalesce(training, false) AS t, coalesce(validation, false) AS v FROM lines),
m AS (SELECT row_id, annotation, t, v, nullif(string_split(p, '/')[1], '') AS code, coalesce(merged_into, nullif(string_split(p, '/')[1], '')) AS paper_code, TRY_CAST(regexp_extract(p, '/no0*([0-9]+)/', 1) AS BIGINT) AS issue_no
  FROM n LEFT JOIN (SELECT paper_code, min(merged_into) AS merged_into FROM paper WHERE merged_into IS NOT NULL GROUP BY 1) c ON c.paper_code = string_split(p, '/')[1])"""
    return {
        "p2_found": f"""SELECT tab, row_id FROM (SELECT 'ocr' AS tab, row_id, ocr_text AS t FROM ocr UNION ALL SELECT 'lines', row_id, annotation FROM lines)
WHERE t IS NOT NULL AND (regexp_matches(t, '{ODD}') OR nfc_normalize(t) <> t OR regexp_matches(t, '{MIXED}'))""",
        "p7_found": f"""WITH {rows} SELECT paper_code, issue_no FROM m WHERE issue_no IS NOT NULL AND paper_code IS NOT NULL GROUP BY 1, 2 HAVING bool_or(t AND NOT v) AND bool_or(v AND NOT t)""",
        # a component is named by its smallest key: the issue under the smallest of the names that occur, or under the main name
        "p7_splits": f"""WITH {rows}, k AS (SELECT row_id, paper_code, issue_no, code FROM m),
g AS (SELECT paper_code, issue_no, least('issue:' || min(code) || '/' || issue_no, 'issue:' || paper_code || '/' || issue_no) AS component FROM k WHERE issue_no IS NOT NULL AND paper_code IS NOT NULL GROUP BY paper_code, issue_no),
r AS (SELECT row_id, coalesce(component, 'row:' || row_id) AS component FROM k LEFT JOIN g ON g.paper_code = k.paper_code AND g.issue_no = k.issue_no),
s AS (SELECT component, count(*) AS n FROM r GROUP BY 1),
c AS (SELECT component, (sum(n) OVER (ORDER BY md5('0:' || component), component) - n + n / 2) / sum(n) OVER () AS place FROM s)
SELECT row_id, r.component, CASE WHEN place < 0.8 THEN 'train' WHEN place < {0.8 + 0.1!r} THEN 'validation' ELSE 'test' END AS split FROM r JOIN c ON c.component = r.component""",
        "p7_related": f"""WITH RECURSIVE {rows},
k AS (SELECT row_id, unnest(['issue:' || code || '/' || issue_no, 'issue:' || paper_code || '/' || issue_no, 'text:' || md5(nullif(regexp_replace(lower(annotation), '[^\\p{{L}}\\p{{N}}]+', '', 'g'), ''))]) AS key FROM m),
e AS (SELECT DISTINCT a.key AS a, b.key AS b FROM (SELECT row_id, min(key) AS key FROM k WHERE key IS NOT NULL GROUP BY 1) a JOIN k b ON a.row_id = b.row_id AND b.key IS NOT NULL),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
w(key, other) AS (SELECT a, a FROM u UNION SELECT w.key, u.b FROM w JOIN u ON w.other = u.a),
c AS (SELECT key, min(other) AS component FROM w GROUP BY key)
SELECT m.row_id, coalesce(min(component), 'row:' || m.row_id) AS component FROM m LEFT JOIN k ON k.row_id = m.row_id LEFT JOIN c ON c.key = k.key GROUP BY m.row_id""",
    }
