"""Samples, splits, folds and letter counts. Every choice follows the md5 of seed and key: the same on any cluster and in SQL."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.operators.stats import percentiles
from broadsheet.session import write_shared


def order_key(key: Column, seed: int = 0) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def uniform(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows in the order of their md5, all if there are fewer."""
    return df.withColumn("__o", order_key(F.col(key), seed)).orderBy("__o", key).limit(k).drop("__o")


def stratified(df: DataFrame, strata: Sequence[str], key: str, sizes: dict[str, int], by: str, seed: int = 0) -> DataFrame:
    """Of each stratum as many rows as ``sizes`` has for its value of ``by``; strata not listed give none.

    Only the hash order within a stratum is needed: rows beyond its size are dropped before they are shuffled further.
    """
    if not sizes:
        return df.limit(0)
    size = F.coalesce(F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))])[F.col(by)], F.lit(0))
    w = W.partitionBy(*strata).orderBy(order_key(F.col(key), seed), key)
    # the bound by a number is what lets each task drop rows before the shuffle
    ranked = df.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= max(sizes.values()))
    return ranked.filter(F.col("__k") <= size).drop("__k")


def _ranked(df: DataFrame, key: str, seed: int) -> tuple[DataFrame, int]:
    """Adds ``__k``, the rank by md5 from 1, without one task for all rows: ranks within 4096 buckets of the md5, and the buckets' offsets."""
    rows = df.withColumn("__o", order_key(F.col(key), seed)).withColumn("__b", F.substring("__o", 1, 3))
    per = rows.groupBy("__b").agg(F.count("*").alias("n"))
    starts = per.select("__b", (F.sum("n").over(W.orderBy("__b")) - F.col("n")).alias("start"))
    rows = rows.join(F.broadcast(starts), "__b").withColumn("__k", F.row_number().over(W.partitionBy("__b").orderBy("__o", key)) + F.col("start"))
    return rows.drop("__o", "__b", "start"), per.agg(F.sum("n")).first()[0] or 0


def train_val(df: DataFrame, key: str, share: float, seed: int = 0) -> DataFrame:
    """Adds ``split``: the first int(share * n) rows by md5 are 'val', the rest 'train'."""
    rows, n = _ranked(df, key, seed)
    return rows.withColumn("split", F.when(F.col("__k") <= int(share * n), "val").otherwise("train")).drop("__k")


def folds(df: DataFrame, key: str, n_folds: int = 5, seed: int = 0) -> DataFrame:
    """Adds ``fold`` from 0: successive stretches of the md5 order, the first n % n_folds of them one row longer."""
    rows, n = _ranked(df, key, seed)
    size, more = divmod(n, n_folds)
    i = F.col("__k") - 1
    fold = F.when(i < more * (size + 1), F.floor(i / (size + 1))).otherwise(more + F.floor((i - more * (size + 1)) / max(size, 1)))
    return rows.withColumn("fold", fold.cast("int")).drop("__k")


def fold_sets(folded: DataFrame, n_folds: int = 5) -> DataFrame:
    """(fold, set, ..) of every fold: its rows are the validation and, once more, the test set, all others the training set."""
    each = folded.withColumnRenamed("fold", "own").withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
    sets = F.when(F.col("own") == F.col("fold"), F.array(F.lit("val"), F.lit("test"))).otherwise(F.array(F.lit("train")))
    return each.withColumn("set", F.explode(sets)).drop("own")


def letter_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, letter, n): characters of each text."""
    letters = df.select(key, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "")).alias("letter")).filter("letter <> ''")
    return letters.groupBy(key, "letter").agg(F.count("*").alias("n"))


def split_floor(total: Column, ratio: float) -> Column:
    """Least number of a letter's occurrences that must be in training: all but one at most, one at least."""
    return F.greatest(F.lit(1), F.least(total - 1, F.floor(total * F.lit(ratio)).cast("bigint")))


def discretized(df: DataFrame, value: str, n: int = 3) -> DataFrame:
    """Adds ``bin``: how many of the quantiles 1/n .. (n-1)/n the value reaches."""
    found = percentiles(df, [], value, [i / n for i in range(1, n)]).first()
    cuts = found["q"] if found else []
    steps = [F.when(F.col(value) < F.lit(c), 0).otherwise(1) for c in cuts]
    total = F.lit(0)
    for s in steps:
        total = total + s
    return df.withColumn("bin", total)


def covering_split(counts: DataFrame, key: str, ratio: float = 0.8, rounds: int = 60, fixed: DataFrame | None = None) -> DataFrame:
    """(key, split): a small training set in which every letter reaches its floor and that has int(n * ratio) texts.

    Greedy in rounds: each round takes, of every letter still short, the texts that hold most of it, as many as one look
    at the sums before each text says are needed; then texts by md5 until the number is reached. The constraints hold; the set
    is not proven least. ``fixed`` (key, split) presets rows.
    """
    keys = counts.select(key).distinct()
    n = keys.count()
    totals = counts.groupBy("letter").agg(F.sum("n").alias("total")).withColumn("need", split_floor(F.col("total"), ratio))
    taken = fixed.filter("split = 'train'").select(key) if fixed is not None else keys.limit(0)
    barred = fixed.filter("split = 'val'").select(key) if fixed is not None else keys.limit(0)
    free = counts.join(barred, key, "left_anti")
    taken = write_shared(taken, "taken")
    for turn in range(rounds + 1):
        have = counts.join(taken, key, "left_semi").groupBy("letter").agg(F.sum("n").alias("have"))
        short = totals.join(have, "letter", "left").withColumn("missing", F.col("need") - F.coalesce("have", F.lit(0))).filter("missing > 0").select("letter", "missing")
        short = write_shared(short, "short")
        if short.isEmpty():
            break
        if turn == rounds:
            raise RuntimeError(f"constraints not met in {rounds} rounds")
        # summed by how often a text holds the letter, then, within the one frequency where the sum passes, by the hash of the text:
        # a letter that most texts hold is no single task's list
        rest = write_shared(free.join(taken, key, "left_anti").join(short, "letter").withColumn("h", order_key(F.col(key))).withColumn("b", F.substring("h", 1, 3)), "free")
        step = rest.groupBy("letter", "n", "b").agg(F.sum("n").alias("m"))
        ahead = step.withColumn("ahead", F.sum("m").over(W.partitionBy("letter").orderBy(F.desc("n"), "b")) - F.col("m")).drop("m")
        near = rest.join(ahead, ["letter", "n", "b"]).filter(F.col("ahead") < F.col("missing"))
        within = F.sum("n").over(W.partitionBy("letter", "n", "b").orderBy("h", key)) - F.col("n")
        more = near.withColumn("before", F.col("ahead") + within).filter(F.col("before") < F.col("missing")).select(key).distinct()
        more = write_shared(more, "more")
        if more.isEmpty():
            break
        taken = write_shared(taken.unionAll(more).distinct(), "taken")
    lack = int(n * ratio) - taken.count()
    if lack > 0:
        taken = write_shared(taken.unionAll(uniform(keys.join(taken, key, "left_anti").join(barred, key, "left_anti"), key, lack)), "taken")
    return keys.join(taken.withColumn("split", F.lit("train")), key, "left").withColumn("split", F.coalesce("split", F.lit("val")))


def sample_spec(spec: str) -> dict[str, int]:
    """'regions.TEXT:5, regions.TABULAR:all' as numbers; 'all' is without limit."""
    out = {}
    for part in filter(None, (p.strip() for p in spec.split(","))):
        name, _, size = part.partition(":")
        out[name.strip()] = (1 << 31) - 1 if size.strip() == "all" else int(size)
    return out


def flattened_name(path: Column) -> Column:
    """A path as one name: steps joined by '--', outer ones cut."""
    return F.regexp_replace(F.regexp_replace(path, "^/+|/+$", ""), "/+", "--")


def class_weights(pixels: DataFrame, n_classes: int, label: str = "label") -> pd.DataFrame:
    """All pixels over the median frequency, for each class; the median over classes that occur."""
    counts = {r[label]: r["n"] for r in pixels.groupBy(label).agg(F.count("*").alias("n")).collect()}
    present = pd.Series([v for v in counts.values() if v > 0])
    return pd.DataFrame({"label": range(n_classes), "weight": [present.median() / counts[k] if counts.get(k) else 0.0 for k in range(n_classes)]})


def tiles(width: int, height: int, tile_w: int, tile_h: int, overlap: int = 50) -> list[tuple[int, int]]:
    """Upper left corners of tiles that cover a page, neighbours sharing ``overlap`` pixels at least, spread evenly."""

    def starts(full: int, size: int) -> list[int]:
        if full <= size:
            return [0]
        n = -(-(full - overlap) // (size - overlap))
        return [round(k * (full - size) / (n - 1)) for k in range(n)]

    return [(x, y) for y in starts(height, tile_h) for x in starts(width, tile_w)]
