"""Problem 7: train, validation and test sets that keep related records together.

Records that share a key (an issue, a text, an author) are related. Keys are the nodes of a graph; a record with several keys links its
first to the others. Components are found by breadth-first frontiers: adjacency lists are hash-partitioned, every round a share of the
unreached nodes become seeds, all frontiers grow by one step, and where two labels meet the pair goes into a
small graph of labels, whose components rename the seeds at the end. A component is named by its smallest key. Components in the
order of their hash are cut at the given shares of all records, sizes being summed before anything is sorted.

What relates the records is a parameter (``record_keys``). For the queries it is the issue, as TESTDATA.md states the problem: a record
has its issue under the paper code of its path, and under the main code if the paper was merged; so the issues of all names of a paper
come together by the search. A split by author would put nearly all records into one component, as few authors wrote all.

A record without any key is a component of its own. NULL, empty and missing parts give no key. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from broadsheet.functions.paths import issue_of, merged_codes, normal_path, paper_of
from broadsheet.operators.graph import connected_components
from broadsheet.session import write_shared

SHARES = {"train": 0.8, "validation": 0.1, "test": 0.1}
#: In the first round one of so many unreached nodes becomes a seed, in every later one twice as large a share, and at last all: so the
#: search ends whatever the length of a path, and the label graph stays a fraction of the nodes.
SEED_EVERY = 8
#: Components are summed in so many buckets of their hash (three hexadecimal digits) before the order within a bucket is needed.
BUCKET_DIGITS = 3


def components(keys: DataFrame) -> tuple[DataFrame, int]:
    """((key, component) of every key of ``keys`` (``keys`` ARRAY), rounds of the search): breadth-first from many seeds at once."""
    listed = write_shared(keys.filter(F.size("keys") > 0).select(F.array_distinct("keys").alias("keys")).distinct(), "key-lists")
    nodes = listed.select(F.explode("keys").alias("key")).distinct()
    links = listed.filter(F.size("keys") > 1).select(F.element_at("keys", 1).alias("a"), F.explode(F.slice("keys", F.lit(2), F.size("keys"))).alias("b"))
    edges = write_shared(links.unionAll(links.select("b", "a")).distinct(), "group-edges")
    linked = edges.select(F.col("a").alias("key")).distinct()
    # a node alone is its own component
    done = [nodes.join(linked, "key", "left_anti").select("key", F.col("key").alias("component"))]
    open_nodes, fresh, turn = linked.count(), 0, 0
    frontiers: list[DataFrame] = []
    arrivals: list[DataFrame] = []
    while open_nodes or fresh:
        reached = reduce(DataFrame.unionAll, frontiers) if frontiers else None
        left = linked if reached is None else linked.join(reached.select("key"), "key", "left_anti")
        every = max(1, SEED_EVERY >> turn)
        seeds = left.filter(F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(every)) == 0).select("key", F.col("key").alias("label"))
        turn += 1
        if reached is not None:
            step = edges.join(frontiers[-1].select(F.col("key").alias("a"), "label"), "a").select(F.col("b").alias("key"), "label").distinct()
            seeds = seeds.unionAll(step) if open_nodes else step
        arrivals.append(write_shared(seeds, "arrivals"))
        # of several labels that reach a node the smallest stays; where they meet is found at the end
        new = arrivals[-1] if reached is None else arrivals[-1].join(reached.select("key"), "key", "left_anti")
        frontiers.append(write_shared(new.groupBy("key").agg(F.min("label").alias("label")), "frontier"))
        fresh = frontiers[-1].count()
        open_nodes -= fresh
    if frontiers:
        reached = write_shared(reduce(DataFrame.unionAll, frontiers), "reached")
        meetings = reduce(DataFrame.unionAll, arrivals).join(reached.withColumnRenamed("label", "own"), "key").filter("label <> own").select(F.col("label").alias("a"), F.col("own").alias("b"))
        names = connected_components(meetings, "a", "b")
        whole = write_shared(reached.join(names.withColumnRenamed("node", "label"), "label", "left").select("key", F.coalesce("component", "label").alias("label")), "labelled-keys")
        least = whole.groupBy("label").agg(F.min("key").alias("component"))
        done.append(whole.join(least, "label").select("key", "component"))
    return reduce(DataFrame.unionAll, done), turn


def grouped(rows: DataFrame, record: str) -> DataFrame:
    """Adds ``component`` to every row of ``rows`` (``record``, ``keys``); ``row:<record>`` where there is no key."""
    found, _ = components(rows.select("keys"))
    rows = rows.withColumn("__key", F.when(F.size("keys") > 0, F.element_at("keys", 1))).join(found.withColumnRenamed("key", "__key"), "__key", "left")
    return rows.withColumn("component", F.coalesce("component", F.concat(F.lit("row:"), F.col(record).cast("string")))).drop("__key")


def splits(keys: DataFrame, record: str, shares: dict[str, float] | None = None, seed: int = 0) -> DataFrame:
    """(record, component, split) of every row of ``keys`` (``record``, ``keys`` array of strings)."""
    shares = shares or SHARES
    rows = write_shared(grouped(keys.select(record, "keys"), record).select(record, "component"), "grouped-rows")
    sizes = rows.groupBy("component").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("h", F.md5(F.concat(F.lit(f"{seed}:"), "component"))).withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    sizes = write_shared(sizes, "component-sizes")
    per = sizes.groupBy("bucket").agg(F.sum("n").alias("m"))
    before = per.select("bucket", (F.sum("m").over(W.orderBy("bucket")) - F.col("m")).alias("start"), F.sum("m").over(W.partitionBy(F.lit(0))).alias("total"))
    within = F.sum("n").over(W.partitionBy("bucket").orderBy("h", "component")) - F.col("n")
    # as many rows as buckets, 4,096 at most
    placed = sizes.withColumn("within", within).join(F.broadcast(before), "bucket").withColumn("at", (F.col("start") + F.col("within") + F.col("n") / 2) / F.col("total"))
    upto, choice = 0.0, None
    whole = sum(shares.values())
    for name, share in shares.items():
        upto += share / whole
        choice = F.when(F.col("at") < upto, name) if choice is None else choice.when(F.col("at") < upto, name)
    placed = placed.select("component", choice.otherwise(list(shares)[-1]).alias("split"))
    return rows.join(placed, "component").select(record, "component", "split")


def entity(text: Column) -> Column:
    """A text without case, spaces and punctuation; NULL if nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def record_keys(lines: DataFrame, paper: DataFrame, by: Sequence[str] = ("issue",)) -> DataFrame:
    """``lines`` with ``code`` (paper code of the path), ``main`` (after merging), ``issue_no`` and ``keys``, what relates a record to others.

    ``by`` names relations: 'issue' (under either code), 'author' (case and outer spaces aside), 'text' (case, spacing and punctuation aside).
    """
    codes = merged_codes(paper).withColumnRenamed("main", "__main")
    path = normal_path(F.col("page_path"))
    rows = lines.drop("code", "main", "issue_no", "keys").withColumn("code", F.nullif(paper_of(path), F.lit(""))).withColumn("issue_no", issue_of(path))
    rows = rows.join(codes, F.col("code") == F.col("alias"), "left").withColumn("main", F.coalesce("__main", "code")).drop("alias", "__main")
    issue = lambda code: F.concat(F.lit("issue:"), F.col(code), F.lit("/"), F.col("issue_no").cast("string"))
    known = {
        "issue": [issue("code"), issue("main")], "author": [F.concat(F.lit("author:"), F.nullif(F.lower(F.trim("author")), F.lit("")))],
        "text": [F.concat(F.lit("text:"), F.md5(entity(F.col("annotation"))))],
    }
    return rows.withColumn("keys", F.array_distinct(F.array_compact(F.array(*[k for name in by for k in known[name]]))))


def mixed_issues(lines: DataFrame, paper: DataFrame) -> DataFrame:
    """(paper_code, issue_no) of the issues with rows of both sets: components of the issues under all names of a paper."""
    t, v = F.coalesce("training", F.lit(False)), F.coalesce("validation", F.lit(False))
    rows = record_keys(lines, paper).filter("size(keys) > 0")
    # what is asked of each list of keys is summed before anything is joined
    seen = rows.groupBy("keys", "main", "issue_no").agg(F.max(t & ~v).alias("train"), F.max(v & ~t).alias("valid"))
    seen = write_shared(seen, "issue-sets")
    one = grouped(seen.withColumn("record", F.lit(0)), "record").groupBy("component").agg(F.max("train").alias("train"), F.max("valid").alias("valid"), F.min("main").alias("paper_code"), F.min("issue_no").alias("issue_no"))
    return one.filter("train AND valid").select("paper_code", "issue_no")
