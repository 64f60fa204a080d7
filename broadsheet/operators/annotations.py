"""The table of hand annotations: saving, merging, searching, deltas, export sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["page_path", "line_path"]


def latest(lines: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row for each place, the one saved last (the larger row_id among equal times)."""
    key = key or KEY
    rank = F.struct(F.coalesce(F.col("saved_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), F.col("row_id"))
    rest = [c for c in lines.columns if c not in key]
    return lines.groupBy(*key).agg(F.max_by(F.struct(*rest), rank).alias("r")).select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def merged(base: DataFrame, incoming: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Union of two annotation tables, unique by key: the row saved last wins, of equal ones that of ``incoming``."""
    key = key or KEY
    both = base.withColumn("__side", F.lit(0)).unionByName(incoming.withColumn("__side", F.lit(1)))
    rank = F.struct(F.coalesce(F.col("saved_at").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), F.col("__side"), F.col("row_id"))
    rest = [c for c in base.columns if c not in key]
    return both.groupBy(*key).agg(F.max_by(F.struct(*rest), rank).alias("r")).select(*key, *[F.col(f"r.{c}").alias(c) for c in rest])


def found(lines: DataFrame, pattern: str, regex: bool = False, case: bool = False, text_only: bool = False) -> DataFrame:
    """Rows whose page, line, text or author (or text alone) holds ``pattern``."""
    where = F.col("annotation") if text_only else F.concat_ws("|", "page_path", "line_path", "annotation", "author")
    where = F.coalesce(where, F.lit(""))
    if regex:
        return lines.filter(where.rlike(("" if case else "(?i)") + pattern))
    return lines.filter(F.contains(where, F.lit(pattern)) if case else F.contains(F.lower(where), F.lit(pattern.lower())))


def delta(old: DataFrame, new: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key, change): places marked only now ('add') or only before ('del')."""
    key = key or KEY
    add = new.select(*key).distinct().join(old, key, "left_anti").withColumn("change", F.lit("add"))
    return add.unionByName(old.select(*key).distinct().join(new, key, "left_anti").withColumn("change", F.lit("del")))


def unsampled(lines: DataFrame, sampled: DataFrame, key: list[str] | None = None) -> DataFrame:
    return lines.join(sampled.select(*(key or KEY)), key or KEY, "left_anti")


def membership(training: Column, validation: Column) -> Column:
    """'tv', 't', 'v' or NULL for the sets a line is exported to; NULL flags are not set."""
    t, v = F.coalesce(training, F.lit(False)), F.coalesce(validation, F.lit(False))
    return F.when(t & v, "tv").when(t, "t").when(v, "v")


def line_id(page: Column, line: Column) -> Column:
    return F.concat(F.translate(page, "/", "."), F.lit("."), F.translate(line, "/", "."))


def author(name: Column) -> Column:
    """An author's name in one writing; empty reads as NULL."""
    out = F.lower(F.trim(name))
    return F.when(out != "", out)
