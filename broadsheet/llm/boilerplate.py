"""Problem 6: lines that one paper prints on many of its pages.

A line's key is its skeleton: case, spacing, punctuation, look-alike letters and most misread letters are gone. Keys of a paper
that differ by up to ``MAX_EDITS`` more letters (lost, added or wrong, but no number) are one node, that of the key on more pages. They are
found in two ways: of two halves of a line one is unharmed where the harm lies in one place, so halves are joined; and a line in a place
where the graph expects another (between the lines that stand before and after that one on other pages) is compared with it,
wherever the harm lies.

The graph: nodes weighted by the pages they stand on, edges of a paper's lines that follow one another, weighted by pages. Nodes and edges
of ``MIN_PAGES`` pages are kept; the connected components of what is left are the blocks of boilerplate, whose occurrences are
taken out of every page. A line that has no neighbour on as many pages is a block of one node: by the statement of the problem it is
boilerplate by itself.

NULL, empty and unlettered lines, page numbers and running headers belong to no block. A line loaded twice on a page counts
for one page. Rows without paper or page are no part of any paper and are kept. A skeleton of fewer than ``MIN_LETTERS`` letters has no
variants but those it folds itself: any two short words are a few letters apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from broadsheet.llm.features import reading_place, with_features
from broadsheet.llm.headers import page_number, titles, with_headers
from broadsheet.operators.graph import connected_components
from broadsheet.session import broadcast_if_small, hot_join, write_shared

#: Pages of one paper on which a line must stand.
MIN_PAGES = 5
#: Pages on which a key must stand to gather variants.
ANCHOR_PAGES = 2
#: Letters of the shortest skeleton that has variants.
MIN_LETTERS = 8
#: Letters of the skeleton in which a variant may differ (two, as one letter read as two changes two places).
MAX_EDITS = 2


def line_key(paper: Column, skel: Column, nums: Column) -> Column:
    return F.xxhash64(paper, skel, nums)


def prepared(ocr: DataFrame) -> DataFrame:
    """Features of all lines that may belong to boilerplate, written once to the shared folder."""
    rows = ocr.filter(F.col("ocr_text").isNotNull() & F.col("paper_code").isNotNull() & F.col("page_path").isNotNull())
    rows = rows.select("row_id", F.col("paper_code").alias("paper"), F.col("page_path").alias("page"), "label", reading_place(F.col("block_id"), F.col("line_id")).alias("place"), "ocr_text")
    f = with_features(rows, "ocr_text").filter("skel <> ''")
    return write_shared(f.withColumn("key", line_key(F.col("paper"), F.col("skel"), F.col("nums"))), "line-features")


def supports(f: DataFrame) -> DataFrame:
    """(key, node): for each key of a repeated line, or of a variant of one, its node; ``f`` without headers."""
    spread = f.groupBy("key").agg((F.min(F.xxhash64("page")) != F.max(F.xxhash64("page"))).alias("many")).filter("many").select("key")
    heavy = broadcast_if_small(write_shared(spread, "heavy-keys"))
    rows = f.join(heavy, "key", "left_semi")
    keys = rows.groupBy("key", "paper", "skel", "nums").agg(F.countDistinct("page").alias("pages"))
    keys = write_shared(keys, "keys")
    anchors = keys.filter(F.col("pages") >= ANCHOR_PAGES)
    # lines whose key is no anchor, beside the halves of the anchors
    half = lambda text, size: (F.expr(f"left({text}, int({size} / 2))"), F.expr(f"right({text}, {size} - int({size} / 2))"))
    side = lambda df, size: df.withColumn(
        "half", F.explode(F.array(F.xxhash64("paper", "nums", F.lit(0), size, half("skel", "size")[0]), F.xxhash64("paper", "nums", F.lit(1), size, half("skel", "size")[1])))
    )
    anchored = anchors.withColumn("size", F.explode(F.array(*[F.length("skel") + d for d in range(-MAX_EDITS, MAX_EDITS + 1)]))).filter(F.col("size") >= MIN_LETTERS)
    anchored = write_shared(side(anchored, F.col("size")).select("half", F.col("key").alias("anchor"), F.col("skel").alias("askel"), F.col("pages").alias("apages")), "halves")
    halves = broadcast_if_small(anchored.select("half").distinct())
    loose = f.withColumn("size", F.length("skel")).filter(F.col("size") >= MIN_LETTERS)
    loose = write_shared(side(loose, F.col("size")).join(halves, "half", "left_semi").select("key", "skel", "half").distinct(), "loose-halves")
    own = keys.select("key", F.col("pages").alias("own"))
    near = hot_join(loose, anchored, "half", "key").filter((F.col("key") != F.col("anchor")) & F.levenshtein("skel", "askel", MAX_EDITS).between(0, MAX_EDITS))
    near = near.join(own, "key", "left").filter(F.struct(F.coalesce("own", F.lit(1)), F.col("key")) < F.struct("apages", "anchor"))
    merged = near.groupBy("key").agg(F.max_by("anchor", F.struct("apages", "anchor")).alias("to"))
    # an anchor that is itself a variant leads on to its own anchor, which stands on more pages; followed to the end by doubling
    merged = write_shared(merged, "variants")
    while True:
        up = merged.select(F.col("key").alias("to"), F.col("to").alias("next"))
        if merged.join(up, "to", "left_semi").isEmpty():
            break
        merged = write_shared(merged.join(up, "to", "left").select("key", F.coalesce("next", "to").alias("to")), "variants")
    nodes = keys.select("key", F.col("key").alias("node")).join(merged, "key", "left_anti").unionAll(merged.select("key", F.col("to").alias("node")))
    return write_shared(nodes, "nodes")


def body_lines(ocr: DataFrame) -> DataFrame:
    """The lines of ``ocr`` that are no page number and no running header, with their keys."""
    f = page_number(prepared(ocr)).filter(~F.col("is_pagenum"))
    return with_headers(f, broadcast_if_small(write_shared(titles(f), "titles"))).filter(~F.col("is_header"))


def heavy_edges(rows: DataFrame) -> DataFrame:
    """(before, node, w): lines of the rows given that follow one another, ``w`` pages with both, ``MIN_PAGES`` at least."""
    order = W.partitionBy("page").orderBy("place", "row_id")
    after = rows.select("page", "place", "node", F.lag("node").over(order).alias("before"), F.lag("place").over(order).alias("at"))
    step = F.col("place") - F.col("at")
    follows = (step == 1) | ((F.floor(F.col("place") / (1 << 24)) - F.floor(F.col("at") / (1 << 24)) == 1) & (F.col("place") % (1 << 24) == 0))
    return after.filter(follows & (F.col("node") != F.col("before"))).groupBy("node", "before").agg(F.countDistinct("page").alias("w")).filter(F.col("w") >= MIN_PAGES)


def expected_variants(f: DataFrame, nodes: DataFrame, rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows of ``f`` that stand where an edge expects another node's line and differ from that by no more than ``MAX_EDITS``: (row_id, paper, page, place, node)."""
    spots = rows.select("page", "place", "node")
    onward = spots.join(edges.select(F.col("before").alias("node"), F.col("node").alias("expected")), "node").select("page", (F.col("place") + 1).alias("place"), "expected")
    back = spots.join(edges.select("node", F.col("before").alias("expected")), "node").select("page", (F.col("place") - 1).alias("place"), "expected")
    at = lambda page, place: F.xxhash64(page, place)
    wanted = onward.unionAll(back).select(at("page", "place").alias("spot"), "expected").distinct()
    # of all lines only place and key are shuffled; the few that stand in a wanted place and are no repeated line are then looked up
    there = f.filter(F.length("skel") >= MIN_LETTERS).select(at(F.col("page"), F.col("place")).alias("spot"), "row_id", "key").join(wanted, "spot")
    there = there.join(broadcast_if_small(nodes.select("key")), "key", "left_anti").select("row_id", "expected")
    there = broadcast_if_small(write_shared(there, "lines-in-wanted-places"))
    ends = edges.select(F.col("node").alias("key")).unionAll(edges.select(F.col("before").alias("key"))).distinct()
    skels = f.join(broadcast_if_small(write_shared(ends, "edge-nodes")), "key", "left_semi").groupBy("key").agg(F.min("skel").alias("askel"), F.min("nums").alias("anums"))
    skels = broadcast_if_small(write_shared(skels.withColumnRenamed("key", "expected"), "edge-skeletons"))
    near = f.join(there, "row_id").join(skels, "expected").filter((F.col("nums") == F.col("anums")) & F.levenshtein("skel", "askel", MAX_EDITS).between(0, MAX_EDITS))
    return near.groupBy("row_id").agg(F.first("paper").alias("paper"), F.first("page").alias("page"), F.first("place").alias("place"), F.min("expected").alias("node"))


def blocks(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, block): components of the graph of nodes and edges on ``MIN_PAGES`` pages; lighter nodes have no block."""
    kept = rows.groupBy("node").agg(F.countDistinct("page").alias("pages")).filter(F.col("pages") >= MIN_PAGES).select("node")
    # a loop at every kept node makes it part of the graph; components are named by their smallest node
    linked = connected_components(edges, "node", "before")
    return kept.join(linked, "node", "left").select("node", F.coalesce("component", "node").alias("block"))


def boilerplate(ocr: DataFrame) -> DataFrame:
    """(row_id, paper, page, node, block) of every row of a block of boilerplate."""
    f = body_lines(ocr)
    nodes = supports(f)
    rows = write_shared(f.join(broadcast_if_small(nodes), "key").select("row_id", "paper", "page", "place", "node"), "repeated")
    edges = write_shared(heavy_edges(rows), "line-edges")
    rows = write_shared(rows.unionByName(expected_variants(f, nodes, rows, edges)), "boilerplate-rows")
    return rows.join(blocks(rows, edges), "node").select("row_id", "paper", "page", "node", "block")


def without_boilerplate(ocr: DataFrame) -> DataFrame:
    """``ocr`` without the rows of boilerplate; all other rows, NULL and empty ones too, stay."""
    return ocr.join(boilerplate(ocr).select("row_id"), "row_id", "left_anti")
