"""Composition of page texts from recognised lines, and of table cells into text grids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.functions.text import strip, without_letters
from broadsheet.operators.grouped import each_group

PATH = ["page_path", "predictor", "label", "block_id", "line_id"]


def sorted_lines(lines: DataFrame) -> DataFrame:
    """Adds ``rank`` within the page: predictor, label, block as text (so '10' before '2'), line as number."""
    w = W.partitionBy("page_path").orderBy("predictor", "label", "block_id", "line_id")
    return lines.withColumn("rank", F.row_number().over(w))


def cell_path(block_id: Column, line_id: Column, column: int | Column | None = None) -> Column:
    """Path of a table line as a cell ``block.division.row.column``: line k of a division and column slot c give row k + 1."""
    part = lambda i: F.element_at(F.split(block_id, r"\."), i)
    column = F.lit(1) if column is None else column if isinstance(column, Column) else F.lit(column)
    return F.concat_ws(".", part(1), part(2), (line_id + 1).cast("string"), column.cast("string"))


def fixed_path(label: Column, block_id: Column) -> Column:
    """A table block without dots is its own first cell."""
    return F.when((label == "TABULAR") & ~F.contains(block_id, F.lit(".")), F.concat(block_id, F.lit(".1.1.1"))).otherwise(block_id)


def column_slots(lines: DataFrame, columns: DataFrame) -> DataFrame:
    """Each line of a table block once for each of its column slots: ``column`` from 1, ``x0`` and ``x1`` (NULL at the outer sides)."""
    rows = lines.join(columns, ["page_id", "block_id"], "left").withColumn("positions", F.coalesce("positions", F.array().cast("array<double>")))
    rows = rows.withColumn("column", F.explode(F.sequence(F.lit(1), F.size("positions") + 1)))
    return rows.withColumn("x0", F.get("positions", F.col("column") - 2)).withColumn("x1", F.get("positions", F.col("column") - 1)).drop("positions")


def plain_text(lines: DataFrame, separator: str = "\n\n", ignored: str = "") -> DataFrame:
    """(page_path, text): lines in order, each stripped and ended by a newline, blank ones skipped; ``separator`` where the block changes.

    A page's lines are aggregated into one text; a page has no more lines than a sheet holds. Pages without text give no row.
    """
    text = strip(F.coalesce("text", F.lit("")))
    rows = sorted_lines(lines.withColumn("text", without_letters(text, ignored) if ignored else text)).filter("text <> ''")
    block = F.concat_ws("\u0001", "predictor", "label", "block_id")
    w = W.partitionBy("page_path").orderBy("rank")
    changes = F.lag(block).over(w) != block
    piece = F.concat(F.when(F.coalesce(changes, F.lit(False)), separator).otherwise(""), F.col("text"), F.lit("\n"))
    rows = rows.withColumn("piece", piece)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "piece"))), lambda x: x["piece"]), "")
    return rows.groupBy("page_path").agg(whole.alias("text"))


def region_texts(lines: DataFrame, least: int = 50) -> DataFrame:
    """(page_path, predictor, label, block_id, text): texts of the regions with more than ``least`` characters, lines joined by newlines."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_id", "text"))), lambda x: x["text"]), "\n")
    return lines.groupBy("page_path", "predictor", "label", "block_id").agg(text.alias("text"), F.sum(F.length("text")).alias("n")).filter(F.col("n") > least).drop("n")


def merged_regions(rows: DataFrame, group: str, order: str, flag: str) -> DataFrame:
    """Runs of rows with ``flag`` that follow one another in ``order`` within a page and share ``group``: (page_id, run, group, n, first, last)."""
    w = W.partitionBy("page_id").orderBy(order)
    same = F.lag(group).over(w).eqNullSafe(F.col(group)) & F.coalesce(F.lag(flag).over(w), F.lit(False))
    marked = rows.withColumn("starts", F.when(F.coalesce(same, F.lit(False)) & F.col(flag), 0).otherwise(1))
    marked = marked.withColumn("run", F.sum("starts").over(w.rowsBetween(W.unboundedPreceding, 0))).filter(flag)
    return marked.groupBy("page_id", "run", group).agg(F.count("*").alias("n"), F.min(order).alias("first"), F.max(order).alias("last"))


def table_cells(lines: DataFrame) -> DataFrame:
    """(page_path, table, division, row, column, text) of table lines; parts are numbers, the texts of a cell are joined by newlines."""
    part = lambda i: F.get(F.split(fixed_path(F.col("label"), F.col("block_id")), r"\."), F.lit(i))
    rows = lines.filter("label = 'TABULAR'").select("page_path", part(0).alias("table"), part(1).try_cast("int").alias("division"), part(2).try_cast("int").alias("row"), part(3).try_cast("int").alias("column"), "line_id", "text")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_id", "text"))), lambda x: x["text"]), "\n")
    return rows.groupBy("page_path", "table", "division", "row", "column").agg(text.alias("text"))


def grid(rows: list[list[str]], header: bool) -> str:
    """Cells as a grid with rules; a column is as wide as its longest line."""
    cells = [[c.split("\n") for c in r] for r in rows]
    width = [max(len(x) for r in cells for x in r[k]) for k in range(len(cells[0]))]
    rule = "+" + "+".join("-" * (w + 2) for w in width) + "+"
    inner = "|" + "+".join("-" * (w + 2) for w in width) + "|"
    out = [rule]
    for n, r in enumerate(cells):
        for k in range(max(len(x) for x in r)):
            out.append("|" + "|".join(" " + (x[k] if k < len(x) else "").ljust(w) + " " for x, w in zip(r, width)) + "|")
        if header and n == 0 and len(cells) > 1:
            out.append(inner)
    return "\n".join([*out, rule])


def table_texts(cells: DataFrame) -> DataFrame:
    """(page_path, table, text): a table of one column as its rows, a wider one as a grid; the first division is the header if it is one row of two or more divisions."""

    def work(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        part = {c: [(v is None or v != v, v if v == v else None) for v in g[c].tolist()] for c in ("division", "row", "column")}
        order = sorted(range(len(g["text"])), key=lambda k: tuple(part[c][k] if not part[c][k][0] else (True, 0) for c in ("division", "row", "column")))
        columns = sorted(set(part["column"]), key=lambda x: x if not x[0] else (True, 0))
        rows: dict[tuple, dict] = {}
        for k in order:
            rows.setdefault((part["division"][k], part["row"][k]), {})[part["column"][k]] = g["text"][k] or ""
        divisions = [d for d, _ in rows]
        header = len(set(divisions)) >= 2 and divisions.count(divisions[0]) == 1
        at = [[r.get(c, "") for c in columns] for r in rows.values()]
        text = "\n".join(r[0] for r in at) if len(columns) == 1 else grid(at, header)
        return {"page_path": g["page_path"][:1], "table": g["table"][:1], "text": np.array([text], object)}

    return each_group(cells, ["page_path", "table"], "page_path string, `table` string, text string", work)
