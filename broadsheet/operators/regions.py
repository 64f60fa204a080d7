"""Bookkeeping of regions and lines: repair, keys, joins between artifacts, nested table bounds, matches, margins, review order.

Regions are boxes of a page (page_id, block_id, label, minx, miny, maxx, maxy); see ``spatial`` and ``layout``.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.operators.layout import BOX, boxes_of, hull, of_page, page_components, roots, size, united
from broadsheet.operators.spatial import area, intersection, meeting
from broadsheet.session import broadcast_if_small, write_shared


def repaired(regions: DataFrame) -> DataFrame:
    """Bounds in their order; regions with a NULL bound or without area are left out."""
    low, high = (lambda a, b: F.least(a, b)), (lambda a, b: F.greatest(a, b))
    rows = regions.dropna(subset=BOX)
    rows = rows.withColumns({"minx": low("minx", "maxx"), "maxx": high("minx", "maxx"), "miny": low("miny", "maxy"), "maxy": high("miny", "maxy")})
    return rows.filter(area() > 0)


def geometry_faults(shapes: DataFrame, wkt: str, allowed: Sequence[str] = ("POLYGON",)) -> DataFrame:
    """Rows whose shape is no well-formed WKT of the ``allowed`` types, with ``fault``: 'missing', 'type', 'malformed' or 'open' (a ring that does not close)."""
    kind = F.regexp_extract(F.col(wkt), r"^\s*([A-Za-z]+)", 1)
    ring = F.regexp_extract(F.col(wkt), r"\(\(([^()]+)\)", 1)
    points = F.transform(F.split(ring, ","), lambda p: F.trim(p))
    number = r"^-?\d+(\.\d+)?([eE][-+]?\d+)? -?\d+(\.\d+)?([eE][-+]?\d+)?$"
    fault = (
        F.when(F.trim(F.coalesce(wkt, F.lit(""))) == "", "missing").when(~F.upper(kind).isin(list(allowed)), "type")
        .when((F.upper(kind) == "POLYGON") & (~F.forall(points, lambda p: p.rlike(number)) | (F.size(points) < 4)), "malformed")
        .when((F.upper(kind) == "POLYGON") & (points[0] != F.element_at(points, -1)), "open")
    )
    return shapes.withColumn("fault", fault).filter("fault IS NOT NULL")


def long_lines(lines: DataFrame, length: str, diagonal: Column, least: float = 0.05) -> DataFrame:
    """Lines and separators longer than a share of the page's diagonal."""
    return lines.filter(F.col(length) > diagonal * F.lit(least))


def confident(lines: DataFrame, least: float = 0.5) -> DataFrame:
    """Lines of at least this confidence; a missing one is none."""
    return lines.filter(F.col("confidence") >= least)


def next_ids(regions: DataFrame, keys: Sequence[str] = ("page_id", "label")) -> DataFrame:
    """(keys, next_id): one more than the largest whole-number id of each key; ids that are no numbers do not count, 0 if there is none."""
    own = F.substring_index("block_id", ".", 1).try_cast("bigint")
    return regions.groupBy(*keys).agg((F.coalesce(F.max(own), F.lit(-1)) + 1).alias("next_id"))


def mapped(values: DataFrame, key: str, mapping: DataFrame) -> DataFrame:
    """Rows under the keys their key was split into (mapping: ``old``, ``new``), once for each; others keep theirs."""
    rows = values.join(mapping.select(F.col("old").alias(key), "new"), key, "left").withColumn(key, F.coalesce("new", key))
    return rows.drop("new")


def looked_up(pixels: DataFrame, label: str, palette: dict[int, int]) -> DataFrame:
    """Palette indices as group indices by a table of constants; indices that the table lacks are background (0)."""
    table = F.create_map(*[F.lit(x) for pair in sorted(palette.items()) for x in pair])
    return pixels.withColumn(label, F.coalesce(table[F.col(label)], F.lit(0)))


def everything(regions: DataFrame) -> DataFrame:
    """Regions once under their label and once under '*', the label of all."""
    return regions.unionByName(regions.withColumn("label", F.lit("*")))


def with_block(lines: DataFrame, blocks: DataFrame, keys: Sequence[str] = ("page_id", "predictor", "label", "block_id")) -> DataFrame:
    """Lines with the bounds of their block; a line whose block is missing is left out, as it could not be opened."""
    return lines.join(blocks.select(*keys, *[F.col(c).alias(f"block_{c}") for c in BOX]), list(keys))


def document(texts: DataFrame, lines: DataFrame, regions: DataFrame, least: float = 0.5) -> DataFrame:
    """Texts (page_id, label, block_id, line_id, text) joined with their lines (confidence) and regions (bounds); lines below ``least`` are left out."""
    good = confident(lines, least).select("page_id", "label", "block_id", "line_id", "confidence")
    joined = texts.join(good, ["page_id", "label", "block_id", "line_id"])
    return joined.join(regions.select("page_id", "label", "block_id", *BOX), ["page_id", "label", "block_id"])


def ordered_parts(order: DataFrame, regions: DataFrame, lines: DataFrame) -> DataFrame:
    """(page_id, rank, path, block_id, line_id, is_line) of the steps of a reading order that exist: a path of three parts is a region, of four a line."""
    part = lambda k: F.get(F.split("path", "/"), F.lit(k))
    steps = order.select("page_id", "rank", "path", part(1).alias("label"), part(2).alias("block_id"), part(3).try_cast("int").alias("line_id"), (F.size(F.split("path", "/")) == 4).alias("is_line"))
    whole = steps.filter("NOT is_line").join(regions.select("page_id", "label", "block_id"), ["page_id", "label", "block_id"], "left_semi")
    single = steps.filter("is_line").join(lines.select("page_id", "label", "block_id", "line_id"), ["page_id", "label", "block_id", "line_id"], "left_semi")
    return whole.unionByName(single).select("page_id", "rank", "path", "block_id", "line_id", "is_line")


def missing_texts(regions: DataFrame, texts: DataFrame, lines: DataFrame, least: float = 0.5) -> DataFrame:
    """(page_id, label, block_id, state) of regions without any text: 'unsure' if every line is below ``least`` or there is none, else 'lost', which is an error."""
    keys = ["page_id", "label", "block_id"]
    bare = regions.select(*keys).join(texts.filter("text IS NOT NULL").select(*keys), keys, "left_anti")
    sure = lines.groupBy(*keys).agg(F.max(F.coalesce(F.col("confidence") >= least, F.lit(False))).alias("sure"))
    return bare.join(sure, keys, "left").select(*keys, F.when(F.coalesce("sure", F.lit(False)), "lost").otherwise("unsure").alias("state"))


def combined_tables(regions: DataFrame) -> DataFrame:
    """Sub-blocks of tables (``base.division.row.column``) united to their base block; other regions as they are. Adds ``n_parts``."""
    base = F.when(F.col("label") == "TABULAR", F.substring_index("block_id", ".", 1)).otherwise(F.col("block_id"))
    rows = regions.withColumn("block_id", base)
    return rows.groupBy("page_id", "label", "block_id").agg(*[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in BOX], F.count("*").alias("n_parts"))


def nested_bounds(cells: DataFrame) -> DataFrame:
    """(page_id, table, level, division, column, row, bounds) of every cell, column, division and table, by one pass of grouping sets.

    ``cells`` has page_id, table, division, column, row and the bounds; parts above a level are NULL.
    """
    bounds = ", ".join(f"{'min' if c.startswith('min') else 'max'}({c}) AS {c}" for c in BOX)
    cells.createOrReplaceTempView("__cells")
    return cells.sparkSession.sql(f"""SELECT page_id, `table`, CASE grouping_id() WHEN 0 THEN 'cell' WHEN 1 THEN 'column' WHEN 3 THEN 'division' ELSE 'table' END AS level,
  division, `column`, `row`, {bounds} FROM __cells GROUP BY page_id, `table`, division, `column`, `row` GROUPING SETS ((page_id, `table`, division, `column`, `row`), (page_id, `table`, division, `column`), (page_id, `table`, division), (page_id, `table`))""")


def lineage(regions: DataFrame, edges: DataFrame) -> DataFrame:
    """(page_id, block_id, source): of every region that a merge gives, the regions it came from (itself, where nothing was merged).

    ``edges`` (page_id, a, b) are what ``layout.united`` takes; the largest member gives the id, the smaller id among equals.
    """
    found = page_components(edges).withColumnRenamed("node", "block_id")
    rows = regions.join(found, ["page_id", "block_id"], "left").withColumn("component", F.coalesce("component", "block_id"))
    lead = rows.groupBy("page_id", "component").agg(F.min_by("block_id", F.struct(-area(), F.col("block_id"))).alias("lead"))
    return rows.join(lead, ["page_id", "component"]).select("page_id", F.col("lead").alias("block_id"), F.col("block_id").alias("source"))


# ---------------------------------------------------------------------------------------------------------------------
# Noise at the margins.


def margin_noise(regions: DataFrame, width: float, share: float = 0.05) -> DataFrame:
    """Regions with ``noise``: narrower than a share of the page, and with nothing wider between them and the page's left or right edge.

    From each edge inwards (ties by width, then id) the run of narrow regions ends at the first wider one.
    """
    narrow = (F.col("maxx") - F.col("minx")) < F.lit(width * share)
    left = W.partitionBy("page_id").orderBy("minx", F.col("maxx") - F.col("minx"), "block_id").rowsBetween(W.unboundedPreceding, 0)
    right = W.partitionBy("page_id").orderBy(F.desc("maxx"), F.col("maxx") - F.col("minx"), "block_id").rowsBetween(W.unboundedPreceding, 0)
    rows = regions.withColumn("__n", narrow.cast("int"))
    return rows.withColumn("noise", (F.min("__n").over(left) == 1) | (F.min("__n").over(right) == 1)).drop("__n")


# ---------------------------------------------------------------------------------------------------------------------
# Matches and neighbours.


def greedy_match(targets: DataFrame, sources: DataFrame, share: float = 0.6, least_area: float = 10) -> DataFrame:
    """(page_id, source_id, block_id, overlap, duplicate): sources given to targets, best share of the source first, each source once.

    A source goes with the first of its pairs in that order even where its target is taken already; it is then a ``duplicate``. Equal shares
    go by target and source id.
    """
    pairs = meeting(targets, sources).withColumn("overlap", intersection().cast("double")).filter((area("b_") >= least_area) & (F.col("overlap") / area("b_") > share))
    pairs = pairs.select("page_id", F.col("a_block_id").alias("block_id"), F.col("b_block_id").alias("source_id"), "overlap", (F.col("overlap") / area("b_")).alias("share"))
    # of a source only its first pair counts; of the sources of a target the first in the order of all pairs gets it
    first = pairs.groupBy("page_id", "source_id").agg(F.min(F.struct(-F.col("share"), F.col("block_id"), F.col("overlap"))).alias("p"))
    rows = first.select("page_id", "source_id", F.col("p.block_id").alias("block_id"), F.col("p.overlap").alias("overlap"), F.col("p").getField("col1").alias("share"))
    order = W.partitionBy("page_id", "block_id").orderBy("share", "source_id")
    return rows.withColumn("duplicate", F.row_number().over(order) > 1).drop("share")


def interval_neighbours(regions: DataFrame, least: float = 3) -> DataFrame:
    """(page_id, a, b, overlap, gap): regions that share ``least`` or more of their heights, a to the left of b (by left edge, then id)."""
    wide = regions.select("page_id", "block_id", F.lit(0).alias("minx"), "miny", F.lit(0).alias("maxx"), "maxy", F.col("minx").alias("x0"), F.col("maxx").alias("x1"))
    pairs = meeting(wide, wide).filter(F.struct("a_x0", "a_block_id") < F.struct("b_x0", "b_block_id"))
    pairs = pairs.withColumn("overlap", F.least("a_maxy", "b_maxy") - F.greatest("a_miny", "b_miny")).filter(F.col("overlap") >= least)
    return pairs.select("page_id", F.col("a_block_id").alias("a"), F.col("b_block_id").alias("b"), "overlap", (F.col("b_x0") - F.col("a_x1")).alias("gap"))


def unstopped(pairs: DataFrame, regions: DataFrame, stoppers: DataFrame) -> DataFrame:
    """Pairs (page_id, a, b) whose connection, the box between the facing sides at the height they share, meets no stopper."""
    side = lambda p: regions.select("page_id", F.col("block_id").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in BOX])
    rows = pairs.join(side("a"), ["page_id", "a"]).join(side("b"), ["page_id", "b"])
    way = rows.select(
        "page_id", F.concat_ws("\u0001", "a", "b").alias("block_id"), F.least("a_maxx", "b_minx").alias("minx"), F.greatest("a_miny", "b_miny").alias("miny"),
        F.greatest("a_maxx", "b_minx").alias("maxx"), F.least("a_maxy", "b_maxy").alias("maxy"),
    )
    hit = meeting(way, stoppers.select("page_id", *BOX)).select("page_id", F.col("a_block_id").alias("__pair")).distinct()
    return pairs.withColumn("__pair", F.concat_ws("\u0001", "a", "b")).join(hit, ["page_id", "__pair"], "left_anti").drop("__pair")


def glued(regions: DataFrame, distance: float, small: float) -> DataFrame:
    """Regions after small ones (area up to ``small``) are joined with whatever lies within ``distance`` of them."""
    near = meeting(regions, regions, within=distance).filter((F.col("a_block_id") != F.col("b_block_id")) & (area("a_") <= small))
    gap = lambda lo, hi: F.greatest(F.col(f"a_{lo}") - F.col(f"b_{hi}"), F.col(f"b_{lo}") - F.col(f"a_{hi}"), F.lit(0))
    near = near.filter(F.hypot(gap("minx", "maxx"), gap("miny", "maxy")) <= distance)
    return united(regions, near.select("page_id", F.col("a_block_id").alias("a"), F.col("b_block_id").alias("b")))


def agglomerated(regions: DataFrame, separators: DataFrame, buffer: float) -> DataFrame:
    """(page_id, block_id, group): regions that a separator, widened by ``buffer``, connects; a group is named by its smallest region."""
    wide = separators.select("page_id", F.concat(F.lit("\u0001"), "block_id").alias("block_id"), *[(F.col(c) + (-buffer if c.startswith("min") else buffer)).alias(c) for c in BOX])
    touch = meeting(regions.select("page_id", "block_id", *BOX), wide).select("page_id", F.col("b_block_id").alias("a"), F.col("a_block_id").alias("b"))
    found = page_components(touch).filter(~F.col("node").startswith("\u0001"))
    names = found.groupBy("page_id", "component").agg(F.min("node").alias("group"))
    own = found.join(names, ["page_id", "component"]).select("page_id", F.col("node").alias("block_id"), "group")
    return regions.select("page_id", "block_id").join(own, ["page_id", "block_id"], "left").select("page_id", "block_id", F.coalesce("group", "block_id").alias("group"))


def text_area(regions: DataFrame, buffer: float = 0) -> DataFrame:
    """(page_id, block_id, x0, x1): how far a region's lines may extend to the sides, up to the nearest regions that share its height.

    NULL where no region stands in the way. The neighbours are widened by ``buffer``.
    """
    wide = regions.select("page_id", "block_id", F.lit(0).alias("minx"), "miny", F.lit(0).alias("maxx"), "maxy", F.col("minx").alias("x0"), F.col("maxx").alias("x1"))
    pairs = meeting(wide, wide).filter((F.col("a_block_id") != F.col("b_block_id")) & (F.least("a_maxy", "b_maxy") > F.greatest("a_miny", "b_miny")))
    left, right = F.when(F.col("b_x1") <= F.col("a_x0"), F.col("b_x1") + buffer), F.when(F.col("b_x0") >= F.col("a_x1"), F.col("b_x0") - buffer)
    found = pairs.groupBy("page_id", F.col("a_block_id").alias("block_id")).agg(F.max(left).alias("x0"), F.min(right).alias("x1"))
    return regions.select("page_id", "block_id").join(found, ["page_id", "block_id"], "left")


def reliable(regions: DataFrame, lines: DataFrame, free: DataFrame) -> DataFrame:
    """Regions cut down to the hull of their lines, and one region for each free line: (page_id, label, block_id, bounds).

    A free line gets the ids after the largest of its label, in the order of its place. The lines of all sub-blocks of a table count for
    each sub-block. A region without lines stays out.
    """
    base = lambda: F.substring_index("block_id", ".", 1)
    bounds = [(F.min if c.startswith("min") else F.max)(c).alias(f"l_{c}") for c in BOX]
    span = lines.groupBy("page_id", "label", base().alias("base")).agg(*bounds)
    cut = regions.withColumn("base", base()).join(span, ["page_id", "label", "base"])
    cut = cut.select("page_id", "label", "block_id", *[(F.greatest if c.startswith("min") else F.least)(c, f"l_{c}").alias(c) for c in BOX]).filter("minx < maxx AND miny < maxy")
    order = W.partitionBy("page_id", "label").orderBy("miny", "minx", "line_id")
    after = free.withColumn("k", F.row_number().over(order)).join(next_ids(regions), ["page_id", "label"], "left")
    fresh = after.select("page_id", "label", (F.coalesce("next_id", F.lit(0)) + F.col("k") - 1).cast("string").alias("block_id"), *BOX)
    return cut.unionByName(fresh)


# ---------------------------------------------------------------------------------------------------------------------
# Merges until nothing changes.


def disjoint(regions: DataFrame) -> DataFrame:
    """Hulls of regions that meet, joined until all are disjoint, whatever their labels: the largest gives id and label."""

    def work(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        ids, labels, box = g["block_id"], g["label"], boxes_of(g)
        while True:
            a, b = np.nonzero(np.triu((box[:, None, :2] <= box[None, :, 2:]).all(-1) & (box[None, :, :2] <= box[:, None, 2:]).all(-1), 1))
            if not len(a):
                break
            found = roots(len(box), a, b)
            groups = [np.flatnonzero(found == k) for k in np.unique(found)]
            lead = [min(m, key=lambda k: (-size(box[k]), ids[k])) for m in groups]
            ids, labels, box = ids[lead], labels[lead], np.stack([hull(box[m]) for m in groups])
        return {"page_id": np.repeat(g["page_id"][:1], len(ids)), "block_id": ids, "label": labels, **{c: box[:, k] for k, c in enumerate(BOX)}}

    return of_page(regions, work)


def merged_rightwards(regions: DataFrame, stoppers: DataFrame | None, gap: float, least: float = 3) -> DataFrame:
    """Regions of a label joined with the nearest one to their right at their height, from left to right, until no pair is left.

    Two regions join if they share ``least`` of their heights, are not farther apart than ``gap``, and no stopper lies between them.
    """
    columns = ["page_id", "block_id", "label", *BOX]
    walls = stoppers.select("page_id", F.lit("").alias("block_id"), F.lit("\u0001").alias("label"), *[F.col(c).cast(regions.schema[c].dataType).alias(c) for c in BOX]) if stoppers is not None else regions.select(*columns).limit(0)
    walls = walls.join(regions.select("page_id").distinct(), "page_id", "left_semi")

    def work(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        wall = g["label"] == "\u0001"
        stop = boxes_of(g)[wall]
        items = [[i, x, b] for i, x, b in zip(g["block_id"][~wall], g["label"][~wall], boxes_of(g)[~wall])]
        again = True
        while again:
            again = False
            items.sort(key=lambda r: (r[2][0], r[0]))
            for i, a in enumerate(items):
                fits = []
                for j in range(len(items)):
                    b = items[j]
                    if i == j or a[1] != b[1] or b[2][0] < a[2][0] or min(a[2][3], b[2][3]) - max(a[2][1], b[2][1]) < least or b[2][0] - a[2][2] > gap:
                        continue
                    way = np.array([min(a[2][2], b[2][0]), max(a[2][1], b[2][1]), max(a[2][2], b[2][0]), min(a[2][3], b[2][3])])
                    if len(stop) and ((stop[:, :2] <= way[2:]) & (stop[:, 2:] >= way[:2])).all(1).any():
                        continue
                    fits.append((b[2][0] - a[2][2], b[0], j))
                if fits:
                    a[2] = hull(np.stack((a[2], items.pop(min(fits)[2])[2])))
                    again = True
                    break
        box = np.stack([r[2] for r in items]) if items else np.zeros((0, 4), g["minx"].dtype)
        out = {"page_id": np.repeat(g["page_id"][:1], len(items)), "block_id": np.array([r[0] for r in items], object), "label": np.array([r[1] for r in items], object)}
        return out | {c: box[:, k] for k, c in enumerate(BOX)}

    return of_page(regions.select(*columns).unionByName(walls.select(*columns)), work)


def fixed_point(step: Callable[[DataFrame], DataFrame], start: DataFrame, measure: Column, rounds: int = 100) -> DataFrame:
    """``step`` applied, each result written to the shared folder, until the aggregate ``measure`` stays the same; an error after ``rounds``."""
    now = write_shared(start, "fixed-point")
    before = now.agg(measure).first()
    for _ in range(rounds):
        now = write_shared(step(now), "fixed-point")
        after = now.agg(measure).first()
        if after == before:
            return now
        before = after
    raise RuntimeError(f"no fixed point in {rounds} rounds")


# ---------------------------------------------------------------------------------------------------------------------
# Lines under review, texts of options.


def by_error(lines: DataFrame, read: str, right: str) -> DataFrame:
    """Lines with ``error``, the letters that differ over those of the right text (at least one), and ``rank``, the worst first; ties by row_id.

    Ranks are those within the letters that differ and the length, so that no task has all lines; the classes' offsets are few.
    """
    edits = F.levenshtein(F.coalesce(read, F.lit("")), F.coalesce(right, F.lit("")))
    rows = lines.withColumn("error", edits / F.greatest(F.length(F.coalesce(right, F.lit(""))), F.lit(1)))
    per = rows.groupBy("error").agg(F.count("*").alias("m"))
    ahead = per.withColumn("ahead", F.sum("m").over(W.orderBy(F.desc("error"))) - F.col("m")).drop("m")
    within = F.row_number().over(W.partitionBy("error").orderBy("row_id"))
    return rows.withColumn("k", within).join(broadcast_if_small(write_shared(ahead, "error-classes")), "error").withColumn("rank", F.col("ahead") + F.col("k")).drop("ahead", "k")


def navigation(lines: DataFrame, keys: Sequence[str], order: Sequence[str], key: str = "row_id") -> DataFrame:
    """Rows with ``previous`` and ``next``, the neighbours in an order within each group; NULL at the ends."""
    w = W.partitionBy(*keys).orderBy(*order)
    return lines.withColumn("previous", F.lag(key).over(w)).withColumn("next", F.lead(key).over(w))


#: Names of options to functions, and literals, as ``name(key=value, ..)``.
CALL = re.compile(r"^\s*([A-Za-z_]\w*)\s*(?:\((.*)\))?\s*$", re.S)


def parsed_spec(spec: str) -> tuple[str, list, dict]:
    """(name, positional, named) of ``name(1, key=value)``; values are literals only, nothing is evaluated."""
    m = CALL.match(spec)
    if not m:
        raise ValueError(f"no call: {spec!r}")
    call = ast.parse(f"f({m[2] or ''})", mode="eval").body
    return m[1], [ast.literal_eval(a) for a in call.args], {k.arg: ast.literal_eval(k.value) for k in call.keywords}


def built(spec: str, known: dict[str, Callable]) -> object:
    """What the function of a spec's name makes of its options."""
    name, args, named = parsed_spec(spec)
    if name not in known:
        raise ValueError(f"{name!r} is none of {sorted(known)}")
    return known[name](*args, **named)


def composed(*steps: Callable) -> Callable:
    """One function of several, applied from left to right."""

    def run(x):
        for s in steps:
            x = s(x)
        return x

    return run


def by_label(steps: dict[str, Callable[[DataFrame], DataFrame]], regions: DataFrame) -> DataFrame:
    """Each label's regions through the step of the label; labels without a step stay as they are."""
    parts = [step(regions.filter(F.col("label") == label)) for label, step in sorted(steps.items())]
    out = regions.filter(~F.coalesce(F.col("label").isin(sorted(steps)), F.lit(False)))
    for p in parts:
        out = out.unionByName(p.select(*regions.columns))
    return out


def slug(c: Column) -> Column:
    """A name in lower case, letters and digits of ASCII only, other runs as one hyphen."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def unescaped(text: str) -> str:
    """An option's text with its escapes read: line end, tab, carriage return, backslash."""
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r", "\\": "\\"}.get(m[1], m[0]), text)
