"""Path expressions: the normal form a file system resolves, page keys, merged paper codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.session import write_shared


def normal_path(path: Column) -> Column:
    """``path`` as a file system resolves it: no empty or ``.`` steps, ``..`` taken back, outer spaces cut.

    A leading slash stays; ``..`` above the root of an absolute path is dropped, in a relative one kept. NULL stays NULL.
    """
    trimmed = F.trim(path)
    steps = F.aggregate(
        F.split(trimmed, "/"),
        F.array().cast("array<string>"),
        lambda acc, x: F.when((x == "") | (x == "."), acc)
        .when((x == "..") & (F.size(acc) > 0) & (F.coalesce(F.element_at(acc, -1), F.lit("")) != ".."), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when((x == "..") & trimmed.startswith("/"), acc)
        .otherwise(F.concat(acc, F.array(x))),
    )
    plain = ~trimmed.rlike(r"//|(^|/)\.\.?(/|$)|.+/$")
    return F.when(plain, trimmed).otherwise(F.concat(F.when(trimmed.startswith("/"), "/").otherwise(""), F.array_join(steps, "/")))


NORMAL_PATH_SQL = (
    "(CASE WHEN NOT regexp_matches(trim({0}), '//|(^|/)\\.\\.?(/|$)|.+/$') THEN trim({0}) ELSE "
    "(CASE WHEN trim({0}) LIKE '/%' THEN '/' ELSE '' END) || array_to_string(list_reduce("
    "list_prepend(CAST([] AS VARCHAR[]), list_transform(string_split(trim({0}), '/'), lambda x: [x])), "
    "lambda a, b: CASE WHEN b[1] IN ('', '.') THEN a "
    "WHEN b[1] = '..' AND len(a) > 0 AND a[len(a)] <> '..' THEN a[1:len(a)-1] "
    "WHEN b[1] = '..' AND trim({0}) LIKE '/%' THEN a ELSE list_concat(a, b) END), '/') END)"
)


def paper_of(page_path: Column) -> Column:
    return F.substring_index(page_path, "/", 1)


def issue_of(page_path: Column) -> Column:
    """Issue number of a page path ``paper/year/no<number>/jpg/page.jpg``; NULL if there is none."""
    return F.regexp_extract(page_path, r"/no0*(\d+)/", 1).try_cast("bigint")


def page_of(page_path: Column) -> Column:
    """Page number of a page path; NULL if there is none."""
    return F.regexp_extract(page_path, r"/0*(\d+)\.[A-Za-z]+$", 1).try_cast("bigint")


def merged_codes(paper: DataFrame) -> DataFrame:
    """(alias, main) of every paper code that is another name, renamings followed to their end.

    Chains are shortened by doubling until none leads on. A code that leads into a circle of codes keeps its own name.
    """
    links = write_shared(paper.filter("merged_into IS NOT NULL AND paper_code IS NOT NULL AND merged_into <> paper_code").groupBy(F.col("paper_code").alias("alias")).agg(F.min("merged_into").alias("main")), "codes")
    reach, most = 1, None
    while True:
        nxt = links.select(F.col("alias").alias("__a"), F.col("main").alias("__m"))
        if links.join(nxt, F.col("main") == F.col("__a"), "left_semi").isEmpty():
            return links
        most = most or links.count()
        if reach > most:
            return links.join(nxt, F.col("main") == F.col("__a"), "left_anti")
        links, reach = write_shared(links.join(nxt, F.col("main") == F.col("__a"), "left").select("alias", F.coalesce("__m", "main").alias("main")), "codes"), 2 * reach


def main_page(df: DataFrame, paper: DataFrame, column: str = "page_path", out: str = "page") -> DataFrame:
    """Adds ``out``: the page path in normal form, under the paper's main code.

    The paper table is a small dimension of fixed size; Spark's own threshold decides whether it is broadcast.
    """
    codes = merged_codes(paper)
    df = df.withColumn("__page", normal_path(F.col(column)))
    df = df.join(codes, paper_of(F.col("__page")) == codes["alias"], "left")
    rest = F.expr("substring(__page, length(substring_index(__page, '/', 1)) + 1)")
    return df.withColumn(out, F.when(F.col("main").isNotNull(), F.concat("main", rest)).otherwise(F.col("__page"))).drop("__page", "alias", "main")
