"""PAGE-XML (schema of 2019-07-15) as string columns: written by concatenation, read by ``from_xml``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMESPACE = "http://schema.primaresearch.org/PAGE/gts/pagecontent/2019-07-15"
SCHEMA = """
Page STRUCT<_imageFilename: STRING, _imageWidth: INT, _imageHeight: INT,
  TextRegion: ARRAY<STRUCT<_id: STRING, Coords: STRUCT<_points: STRING>,
    TextLine: ARRAY<STRUCT<_id: STRING, Coords: STRUCT<_points: STRING>, TextEquiv: STRUCT<Unicode: STRING>>>>>>
"""


def escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def documents(lines: DataFrame, created: str = "1970-01-01T00:00:00") -> DataFrame:
    """(page_path, xml): one document for each page from lines (page_path, block_id, line_id, points, text).

    Regions come in the order of their block id as text and are referenced by the reading order; lines in the order of their number.
    Region and line ids are ``r_<block>`` and ``r_<block>_l_<line>``. A page's lines are aggregated: no more than a sheet holds.
    """
    ident = F.concat(F.lit("r_"), F.translate("block_id", "./", "__"))
    line = F.concat(
        F.lit('<TextLine id="'), ident, F.lit("_l_"), F.col("line_id").cast("string"), F.lit('"><Coords points="'), F.col("points"), F.lit('"/><TextEquiv><Unicode>'),
        escaped(F.coalesce("text", F.lit(""))), F.lit("</Unicode></TextEquiv></TextLine>"),
    )
    rows = lines.select("page_path", "block_id", ident.alias("region"), "line_id", "points", line.alias("line"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_id", "line", "points"))), lambda x: x["line"]), "")
    first = F.min_by("points", "line_id")
    regions = rows.groupBy("page_path", "block_id", "region").agg(joined.alias("lines"), first.alias("points"))
    body = F.concat(F.lit('<TextRegion id="'), "region", F.lit('"><Coords points="'), "points", F.lit('"/>'), "lines", F.lit("</TextRegion>"))
    ordered = F.array_sort(F.collect_list(F.struct("block_id", "region", body.alias("body"))))
    pages = regions.groupBy("page_path").agg(ordered.alias("regions"))
    refs = F.array_join(F.transform("regions", lambda x, i: F.concat(F.lit('<RegionRefIndexed index="'), i.cast("string"), F.lit('" regionRef="'), x["region"], F.lit('"/>'))), "")
    texts = F.array_join(F.transform("regions", lambda x: x["body"]), "")
    xml = F.concat(
        F.lit(f'<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="{NAMESPACE}"><Metadata><Creator>broadsheet</Creator><Created>{created}</Created><LastChange>{created}</LastChange></Metadata><Page imageFilename="'),
        escaped(F.col("page_path")), F.lit('" imageWidth="0" imageHeight="0"><ReadingOrder><OrderedGroup id="ro">'), refs, F.lit("</OrderedGroup></ReadingOrder>"), texts, F.lit("</Page></PcGts>"),
    )
    return pages.select("page_path", xml.alias("xml"))


#: Kinds of regions by label; other labels are written as graphics.
KINDS = {"TEXT": "TextRegion", "TABULAR": "TableRegion", "ILLUSTRATION": "GraphicRegion"}


def region_documents(regions: DataFrame, lines: DataFrame, cells: DataFrame, created: str = "1970-01-01T00:00:00") -> DataFrame:
    """(page_path, xml): one document for each page with text, table and graphic regions, in the order of their ids.

    ``regions`` has page_path, label, block_id and points; ``lines`` page_path, block_id, line_id, points and text of text regions; ``cells``
    page_path, block_id, division, row, column, points and text of table regions: each is a text region within the table's. A table
    without a cell and a text region without a line are left out, as nothing is in them. A page's regions are aggregated: no more than a sheet holds.
    """
    mark = lambda c: F.concat(F.lit("r_"), F.translate(c, "./", "__"))
    coords = F.concat(F.lit('<Coords points="'), "points", F.lit('"/>'))
    said = F.concat(F.lit("<TextEquiv><Unicode>"), escaped(F.coalesce("text", F.lit(""))), F.lit("</Unicode></TextEquiv>"))
    joined = lambda order, body: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, body.alias("__b")))), lambda x: x["__b"]), "")
    line = F.concat(F.lit('<TextLine id="'), mark("block_id"), F.lit("_l_"), F.col("line_id").cast("string"), F.lit('">'), coords, said, F.lit("</TextLine>"))
    cell = F.concat(F.lit('<TextRegion id="'), mark("block_id"), *[x for c in ("division", "row", "column") for x in (F.lit("_"), F.col(c).cast("string"))], F.lit('">'), coords, said, F.lit("</TextRegion>"))
    inner = lines.groupBy("page_path", "block_id").agg(joined(["line_id"], line).alias("inner")).withColumn("label", F.lit("TEXT"))
    inner = inner.unionByName(cells.groupBy("page_path", "block_id").agg(joined(["division", "row", "column"], cell).alias("inner")).withColumn("label", F.lit("TABULAR")))
    kind = F.lit("GraphicRegion")
    for label, name in KINDS.items():
        kind = F.when(F.col("label") == label, name).otherwise(kind)
    rows = regions.join(inner, ["page_path", "label", "block_id"], "left").filter(F.col("inner").isNotNull() | ~F.coalesce(F.col("label").isin("TEXT", "TABULAR"), F.lit(False)))
    body = F.concat(F.lit("<"), kind, F.lit(' id="'), mark("block_id"), F.lit('">'), coords, F.coalesce("inner", F.lit("")), F.lit("</"), kind, F.lit(">"))
    pages = rows.groupBy("page_path").agg(F.array_sort(F.collect_list(F.struct("block_id", "label", mark("block_id").alias("id"), body.alias("body")))).alias("r"))
    refs = F.array_join(F.transform("r", lambda x, i: F.concat(F.lit('<RegionRefIndexed index="'), i.cast("string"), F.lit('" regionRef="'), x["id"], F.lit('"/>'))), "")
    xml = F.concat(
        F.lit(f'<?xml version="1.0" encoding="UTF-8"?><PcGts xmlns="{NAMESPACE}"><Metadata><Creator>broadsheet</Creator><Created>{created}</Created><LastChange>{created}</LastChange></Metadata><Page imageFilename="'),
        escaped(F.col("page_path")), F.lit('" imageWidth="0" imageHeight="0"><ReadingOrder><OrderedGroup id="ro">'), refs, F.lit("</OrderedGroup></ReadingOrder>"), F.array_join(F.transform("r", lambda x: x["body"]), ""), F.lit("</Page></PcGts>"),
    )
    return pages.select("page_path", xml.alias("xml"))


def lines_of(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """(.., region, line, points, text) of every text line of the documents; a broken document gives no row."""
    rest = [c for c in pages.columns if c != xml]
    page = pages.withColumn("__p", F.from_xml(F.col(xml), SCHEMA, {"rowTag": "PcGts", "mode": "PERMISSIVE"}))
    regions = page.select(*rest, F.explode("__p.Page.TextRegion").alias("r"))
    lines = regions.select(*rest, F.col("r._id").alias("region"), F.explode("r.TextLine").alias("l"))
    return lines.select(*rest, "region", F.col("l._id").alias("line"), F.col("l.Coords._points").alias("points"), F.coalesce("l.TextEquiv.Unicode", F.lit("")).alias("text"))


def read_files(spark, path: str) -> DataFrame:
    """(path, region, line, points, text) of PAGE-XML files below ``path``."""
    files = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(path)
    return lines_of(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml")))
