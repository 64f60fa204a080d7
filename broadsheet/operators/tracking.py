"""What has changed between two states of a table, and records that are updated by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns])


def changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, status) of every key of either side: 'added', 'removed', 'changed' or 'same'. Keys are unique on both sides; NULL keys meet.

    Only keys and hashes of the other columns are shuffled.
    """
    key = list(key)
    rest = [c for c in new.columns if c not in key]
    names = [f"__{k}" for k in range(len(key))]
    a = old.select(*key, row_hash(rest).alias("h_old"))
    b = new.select(*[F.col(c).alias(n) for c, n in zip(key, names)], row_hash(rest).alias("h_new"))
    on = F.lit(True)
    for c, n in zip(key, names):
        on = on & F.col(c).eqNullSafe(F.col(n))
    status = F.when(F.col("h_old").isNull(), "added").when(F.col("h_new").isNull(), "removed").when(F.col("h_old") != F.col("h_new"), "changed").otherwise("same")
    joined = a.join(b, on, "full_outer")
    pick = lambda c, n: F.when(F.col("h_old").isNull(), F.col(n)).otherwise(F.col(c)).alias(c)
    return joined.select(*[pick(c, n) for c, n in zip(key, names)], status.alias("status"))


def upsert(base: DataFrame, updates: DataFrame, key: Sequence[str], delete: str | None = None) -> DataFrame:
    """``base`` with the rows of ``updates`` (unique by key) in place of its own; rows whose ``delete`` flag is set are removed."""
    key = list(key)
    keep = base.join(updates.select(*key), key, "left_anti")
    fresh = updates.filter(~F.coalesce(F.col(delete), F.lit(False))) if delete else updates
    return keep.unionByName(fresh.select(*base.columns))


def unfinished(pages: DataFrame, runs: DataFrame, batch: str, needs: Sequence[str] = ()) -> DataFrame:
    """Pages without a completed run of ``batch`` whose needed batches are all completed: anti and semi joins on the page."""
    done = lambda b: runs.filter((F.col("batch") == b) & (F.col("status") == "COMPLETED")).select("page_path")
    out = pages.join(done(batch), "page_path", "left_anti")
    for b in needs:
        out = out.join(done(b), "page_path", "left_semi")
    return out
