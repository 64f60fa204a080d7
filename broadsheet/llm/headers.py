"""Running headers and footers: titles that repeat at the edges of a paper's pages, whatever date and number stand beside; page numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.features import page_offset
from broadsheet.session import BROADCAST_LIMIT, broadcast_if_small, size_of, write_shared

#: A title must stand at the edge of this share of a paper's pages, and of this many.
TITLE_SHARE = 0.05
TITLE_PAGES = 3
#: Pages of an issue whose lone numbers must rise with the pages, if the first page is not number one.
SEQUENCE_PAGES = 3


def page_number(f: DataFrame) -> DataFrame:
    """``f``, read from files, with ``is_pagenum`` and without ``pagenum``: running text that is only a number of the sequence of its issue's page numbers.

    The pages of an issue are in the order of their files. A lone number belongs to a sequence if its distance from the page's place is
    that of the sequence: none, where an issue counts from one, or the distance that most of the issue's pages show, on
    ``SEQUENCE_PAGES`` pages at least and on more than show none.
    """
    f = f.withColumn("offset", F.when(F.col("label") == "TEXT", page_offset(F.col("pagenum"), F.col("page")))).withColumn("issue", F.regexp_replace("page", "/[^/]*$", ""))
    lone = f.filter("offset IS NOT NULL")
    per = lone.groupBy("issue", "offset").agg(F.countDistinct("page").alias("n"))
    best = per.groupBy("issue").agg(F.max(F.when(F.col("offset") != 0, F.struct("n", -F.abs("offset"), "offset"))).alias("b"), F.max(F.when(F.col("offset") == 0, F.col("n"))).alias("plain"))
    best = best.filter(F.col("b.n") >= F.greatest(F.lit(SEQUENCE_PAGES), F.coalesce("plain", F.lit(0)) + 1)).select("issue", F.col("b.offset").alias("start"))
    best = write_shared(best, "page-sequences")
    mark = lambda df: df.join(broadcast_if_small(best), "issue", "left").withColumn("is_pagenum", F.coalesce((F.col("offset") == 0) | F.coalesce(F.col("offset") == F.col("start"), F.lit(False)), F.lit(False))).drop("start", "offset", "issue", "pagenum")
    if size_of(best) * 8 <= BROADCAST_LIMIT:
        return mark(f)
    # where the sequences are joined by shuffle, only the lone numbers are shuffled
    return mark(lone).unionByName(f.filter("offset IS NULL").drop("offset", "issue", "pagenum").withColumn("is_pagenum", F.lit(False)))


def titles(f: DataFrame) -> DataFrame:
    """(paper, title) of the running titles, each also in the forms that have lost one letter.

    The first and the last line of running text of each page, page numbers aside, by a partial aggregate; then the share of a
    paper's pages on which a title stands there.
    """
    text = f.filter((F.col("label") == "TEXT") & ~F.col("is_pagenum") & (F.col("skel") != ""))
    edge = text.groupBy("paper", "page").agg(F.min(F.struct("place", "title")).alias("first"), F.max(F.struct("place", "title")).alias("last"))
    at = edge.select("paper", F.posexplode(F.array_distinct(F.array("first.title", "last.title"))).alias("pos", "title"))
    # every page has one NULL or title entry at least; the pages of a paper are counted by the first. Written, as it is asked for titles and for pages
    counted = write_shared(at.groupBy("paper", "title").agg(F.count("*").alias("n"), F.count_if(F.col("pos") == 0).alias("firsts")), "edge-titles")
    pages = counted.groupBy("paper").agg(F.sum("firsts").alias("pages"))
    good = counted.filter("title IS NOT NULL AND title <> ''").join(pages, "paper").filter(F.col("n") >= F.greatest(F.lit(TITLE_PAGES), F.col("pages") * TITLE_SHARE))
    lost = F.transform(F.sequence(F.lit(1), F.length("title")), lambda i: F.concat(F.expr("title").substr(F.lit(1), i - 1), F.expr("title").substr(i + 1, F.length("title"))))
    forms = F.when(F.length("title") >= 8, F.concat(F.array("title"), lost)).otherwise(F.array("title"))
    return good.select("paper", F.explode(forms).alias("title")).distinct()


def with_headers(f: DataFrame, running: DataFrame) -> DataFrame:
    """``f`` with ``is_header``: a line of a running title of its paper, with a number."""
    known = running.withColumn("is_header", F.lit(True))
    return f.join(known, ["paper", "title"], "left").withColumn("is_header", F.coalesce("is_header", F.lit(False)) & (F.coalesce("label", F.lit("TEXT")) == "TEXT"))
