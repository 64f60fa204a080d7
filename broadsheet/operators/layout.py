"""Refinement of page regions: merging, dominance, clipping, splitting, tables. Regions are boxes (see ``spatial``).

A layout program is a list of functions from regions to regions (``Program``); one that fails is reported and skipped.
Merges find pairs by the binned join, close them by the components of each page and unite each component by min and max;
what is sequential within a page (overlaps to the fix-point, dominance, growth along the reading order) runs over the arrays of many whole
pages (``Pages``), in one pass over pages sorted within hash partitions; only pages where a pair of regions calls for it are gone through.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.grouped import each_batch, each_group, floats, within_groups
from broadsheet.operators.spatial import alignment, area, intersection, meeting, overlap_pairs
from broadsheet.operators.xycut import SCORES, cut_orders

Step = Callable[[DataFrame], DataFrame]
BOX = ["minx", "miny", "maxx", "maxy"]


class Program:
    """Steps over regions, in order. A step that raises leaves the regions as they are; ``failed`` names it."""

    def __init__(self, steps: Sequence[tuple[str, Step]]):
        self.steps, self.failed = list(steps), []

    def __call__(self, regions: DataFrame) -> DataFrame:
        for name, step in self.steps:
            try:
                done = step(regions)
                done.schema  # noqa: B018  resolves the step now
                regions = done
            except Exception:
                logging.getLogger(__name__).exception("layout step %s failed", name)
                self.failed.append(name)
        return regions


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of ``n`` nodes joined by the edges (a, b)."""
    up = list(range(n))

    def root(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        up[max(x, y)] = min(x, y)
    return np.array([root(k) for k in range(n)], int)


def page_components(edges: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """(keys, node, component) of the nodes of ``edges`` (keys, a, b); components within a page, named by their smallest node."""
    keys, kinds = list(keys), {f.name: f.dataType.simpleString() for f in edges.schema.fields}

    def work(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        nodes, at = np.unique(np.concatenate((g["a"], g["b"])).astype(object), return_inverse=True)
        found = roots(len(nodes), at[: len(g["a"])], at[len(g["a"]) :])
        return {**{k: np.repeat(g[k][:1], len(nodes)) for k in keys}, "node": nodes, "component": nodes[found]}

    schema = ", ".join([f"{k} {kinds[k]}" for k in keys] + [f"node {kinds['a']}", f"component {kinds['a']}"])
    return each_group(edges.select(*keys, "a", "b").dropna(), keys, schema, work)


def united(regions: DataFrame, edges: DataFrame, line_count: str | None = None) -> DataFrame:
    """Regions with the components of ``edges`` (page_id, a, b: block ids) made one each.

    The largest member, the smaller id among equals, gives its id and label; the box is that of all members. Adds ``n_parts``, and sums ``line_count``.
    """
    found = page_components(edges).withColumnRenamed("node", "block_id")
    rows = regions.join(found, ["page_id", "block_id"], "left").withColumn("component", F.coalesce("component", "block_id"))
    rank = F.struct(-area(), F.col("block_id"))
    sums = [F.sum(line_count).alias(line_count)] if line_count else []
    return rows.groupBy("page_id", "component").agg(
        F.min_by("block_id", rank).alias("block_id"), F.min_by("label", rank).alias("label"), *[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in BOX],
        F.count("*").alias("n_parts"), F.sum(area()).alias("parts_area"), *sums,
    ).drop("component")


def cohesion() -> Column:
    """Area of the parts over the area of their union."""
    return F.when(area() > 0, F.col("parts_area") / area()).otherwise(1.0)


def size(box: np.ndarray) -> np.ndarray:
    return np.maximum(0, box[..., 2] - box[..., 0]) * np.maximum(0, box[..., 3] - box[..., 1])


def hull(box: np.ndarray) -> np.ndarray:
    return np.concatenate((box[:, :2].min(0), box[:, 2:].max(0)))


def boxes_of(g: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([g[c] for c in BOX], -1)


def of_page(regions: DataFrame, work: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], kind: str | None = None) -> DataFrame:
    """Regions made of each page's regions by ``work`` over (page_id, block_id, label and box) arrays; boxes as ``kind``, or as they are."""
    kinds = {f.name: f.dataType.simpleString() for f in regions.schema.fields}
    columns = ["page_id", "block_id", "label", *BOX]
    schema = ", ".join(f"{c} {kind if kind and c in BOX else kinds[c]}" for c in columns)
    return each_group(regions.select(*columns), ["page_id"], schema, work)


@dataclass
class Pages:
    """Regions of many pages as arrays, in order of their pages. ``row``: the row of ``table`` that gives id and page, ``part``: the part's number if it was split."""

    table: pa.Table
    page: np.ndarray
    row: np.ndarray
    part: np.ndarray
    label: np.ndarray
    box: np.ndarray
    labels: list[str | None]

    def taken(self, at: np.ndarray, **new: np.ndarray) -> Pages:
        return replace(self, **{c: getattr(self, c)[at] for c in ("page", "row", "part", "label", "box")} | new)

    def names(self, at: np.ndarray) -> list[str]:
        found = self.table.column("block_id").take(pa.array(self.row[at])).to_pylist()
        return [f"{n}/{k}" if k else n for n, k in zip(found, self.part[at].tolist())]

    def of(self, labels: Sequence[str]) -> np.ndarray:
        """Which regions have one of the labels."""
        return np.isin(self.label, [k for k, x in enumerate(self.labels) if x in labels])


#: Pairs that are looked at in one go.
PAIRS = 1 << 20


def of_pages(regions: DataFrame, steps: Callable[[Pages, np.ndarray, np.ndarray], Pages], kind: str | None = None, cuts: DataFrame | None = None) -> DataFrame:
    """Regions after ``steps`` over the arrays of many whole pages at a time; they get the page and place of each of ``cuts`` (page_id, position) too.

    Regions and cuts are shuffled once. Boxes come as ``kind``, or as they are.
    """
    kinds = {f.name: f.dataType.simpleString() for f in regions.schema.fields}
    columns = ["page_id", "block_id", "label", *BOX]
    schema = ", ".join(f"{c} {kind if kind and c in BOX else kinds[c]}" for c in columns)
    side = lambda df, box, cut: df.select("page_id", *[(F.col(c) if box else F.lit(None)).cast(kinds[c]).alias(c) for c in ("block_id", "label")], *[(F.col(c) if box else F.lit(None)).cast("double").alias(c) for c in BOX], cut.cast("double").alias("position"))
    rows = side(regions, True, F.lit(None))
    if cuts is not None:
        rows = rows.unionByName(side(cuts.filter("page_id IS NOT NULL AND position IS NOT NULL"), False, F.col("position")))

    def work(table: pa.Table, bounds: np.ndarray) -> pa.Table:
        page = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        is_cut = table.column("position").is_valid().to_numpy()
        place = floats(table, ["position"])[is_cut, 0]
        cut_page, table, page = page[is_cut], table.filter(pa.array(~is_cut)), page[~is_cut]
        kind = table.column("label").combine_chunks().dictionary_encode(null_encoding="encode")
        kind = kind.combine_chunks() if isinstance(kind, pa.ChunkedArray) else kind
        n = len(page)
        p = steps(Pages(table, page, np.arange(n), np.zeros(n, int), kind.indices.to_numpy(), floats(table, BOX), kind.dictionary.to_pylist()), cut_page, place)
        out = table.select(["page_id", "block_id", "label"]).take(pa.array(p.row))
        if p.part.any():
            names, split = out.column("block_id"), np.flatnonzero(p.part)
            changed = pc.replace_with_mask(names.combine_chunks(), pa.array(p.part > 0), pa.array(p.names(split), names.type))
            out = out.set_column(1, "block_id", changed)
        for k, c in enumerate(BOX):
            out = out.append_column(c, pa.array(p.box[:, k], from_pandas=True))
        return out

    return each_batch(rows, ["page_id"], schema, work)


def page_pairs(page: np.ndarray, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All i < j on one page that ``keep`` holds for; ``page`` is sorted."""
    later = np.searchsorted(page, page, "right") - np.arange(len(page)) - 1
    total, found, i0 = np.cumsum(later), [], 0
    while i0 < len(page):
        i1 = max(i0 + 1, int(np.searchsorted(total, total[i0] - later[i0] + PAIRS, "right")))
        i = np.repeat(np.arange(i0, i1), later[i0:i1])
        j = i + 1 + within_groups(later[i0:i1])
        good = keep(i, j)
        found.append((i[good], j[good]))
        i0 = i1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))


def overlap_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Overlaps of boxes of ``a`` and ``b``, one by one."""
    return np.maximum(0, np.minimum(a[:, 2:], b[:, 2:]) - np.maximum(a[:, :2], b[:, :2])).prod(-1)


def joined(p: Pages, i: np.ndarray, j: np.ndarray) -> Pages:
    """The components of the edges (i, j) made one region each; the largest member, the smaller id among equals, gives its id."""
    if not len(i):
        return p
    nodes, at = np.unique(np.concatenate((i, j)), return_inverse=True)
    root = roots(len(nodes), at[: len(i)], at[len(i) :])
    area = size(p.box[nodes])
    order = np.lexsort((-area, root))
    first = np.flatnonzero(np.diff(root[order], prepend=-1))
    last = np.append(first[1:], len(order))
    lead = order[first]
    for g in np.flatnonzero(area[order[first]] == area[order[np.minimum(first + 1, last - 1)]]):
        equal = order[first[g] : last[g]]
        equal = equal[area[equal] == area[lead[g]]]
        lead[g] = min(zip(p.names(nodes[equal]), equal))[1]
    box, member = p.box.copy(), p.box[nodes][order]
    stays, own = nodes[root[lead]], nodes[lead]
    box[stays] = np.concatenate((np.minimum.reduceat(member[:, :2], first), np.maximum.reduceat(member[:, 2:], first)), 1)
    row, part, kept = p.row.copy(), p.part.copy(), np.ones(len(box), bool)
    row[stays], part[stays] = p.row[own], p.part[own]
    kept[nodes] = False
    kept[stays] = True
    return replace(p, box=box, row=row, part=part).taken(kept)


def overlaps_merged(p: Pages, maximum: float) -> Pages:
    active = np.ones(len(p.page), bool)
    while True:
        at = np.flatnonzero(active)
        box, label = p.box[at], p.label[at]
        area = size(box)

        def over(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            least = np.minimum(area[i], area[j])  # noqa: B023
            return (overlap_of(box[i], box[j]) > maximum * least) & (least > 0) & (label[i] == label[j])  # noqa: B023

        i, j = page_pairs(p.page[at], over)
        if not len(i):
            return p
        changed = np.unique(p.page[at[i]])
        p = joined(p, at[i], at[j])
        active = np.isin(p.page, changed)


def merge_overlaps(regions: DataFrame, maximum: float = 0.1) -> DataFrame:
    """Unites overlapping regions of a label until none overlap by more than ``maximum`` of the smaller."""
    return of_pages(regions, lambda p, *_: overlaps_merged(p, maximum))


def same_line_pairs(regions: DataFrame, distance: float, least: float = 0.8) -> DataFrame:
    """Pairs of a label that stand side by side on one line: aligned in y by ``least``, not farther apart in x than ``distance``."""
    pairs = meeting(regions, regions, within=distance).filter((F.col("a_block_id") < F.col("b_block_id")) & (F.col("a_label") == F.col("b_label")))
    gap = F.greatest(F.col("a_minx"), F.col("b_minx")) - F.least(F.col("a_maxx"), F.col("b_maxx"))
    pairs = pairs.withColumn("aligned", alignment(F.col("a_miny"), F.col("a_maxy"), F.col("b_miny"), F.col("b_maxy"))).withColumn("gap", F.greatest(gap, F.lit(0)))
    return pairs.filter((F.col("aligned") >= least) & (F.col("gap") <= distance))


def below_pairs(regions: DataFrame, distance: float, least: float = 0.95) -> DataFrame:
    """Pairs of a label of which one stands below the other: aligned in x by ``least``, nearer in y than ``distance``."""
    pairs = meeting(regions, regions, within=distance).filter((F.col("a_block_id") != F.col("b_block_id")) & (F.col("a_label") == F.col("b_label")) & (F.col("a_maxy") <= F.col("b_miny")))
    pairs = pairs.withColumn("aligned", alignment(F.col("a_minx"), F.col("a_maxx"), F.col("b_minx"), F.col("b_maxx"))).withColumn("gap", F.col("b_miny") - F.col("a_maxy"))
    return pairs.filter((F.col("aligned") >= least) & (F.col("gap") < distance))


def merge_adjacent(regions: DataFrame, pairs: DataFrame) -> DataFrame:
    return united(regions, pairs.select("page_id", F.col("a_block_id").alias("a"), F.col("b_block_id").alias("b")))


def large_enough(regions: DataFrame, least: Column | float) -> DataFrame:
    return regions.filter(area() >= least)


def contained(regions: DataFrame, fringe: float = 0) -> DataFrame:
    """Pairs (a in b) of a label: region a lies within region b widened by ``fringe``; of equal boxes the larger id lies in the smaller."""
    pairs = meeting(regions, regions, within=fringe).filter((F.col("a_block_id") != F.col("b_block_id")) & (F.col("a_label") == F.col("b_label")))
    inside = (F.col("a_minx") >= F.col("b_minx") - fringe) & (F.col("a_miny") >= F.col("b_miny") - fringe) & (F.col("a_maxx") <= F.col("b_maxx") + fringe) & (F.col("a_maxy") <= F.col("b_maxy") + fringe)
    return pairs.filter(inside & ((area("a_") < area("b_")) | ((area("a_") == area("b_")) & (F.col("a_block_id") > F.col("b_block_id")))))


def absorbed(items: list[list], fringe: float) -> list[list]:
    """Regions [id, label, box] after the largest have taken in what lies within them (widened by ``fringe``), from the largest again after each."""
    again = True
    while again:
        again = False
        items.sort(key=lambda r: (-extent(r[2]), r[0]))
        for i, host in enumerate(items):
            x0, y0, x1, y1 = host[2]
            x0, y0, x1, y1 = x0 - fringe, y0 - fringe, x1 + fringe, y1 + fringe
            inner = next((j for j in range(i + 1, len(items)) if items[j][2][0] >= x0 and items[j][2][1] >= y0 and items[j][2][2] <= x1 and items[j][2][3] <= y1), None)
            if inner is not None:
                host[2] = around(host[2], items.pop(inner)[2])
                again = True
                break
    return items


def extent(b: Sequence[float]) -> float:
    return max(0, b[2] - b[0]) * max(0, b[3] - b[1])


def around(a: Sequence[float], b: Sequence[float]) -> list[float]:
    return [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]


def common(a: Sequence[float], b: Sequence[float]) -> float:
    return max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))


def resolved(items: list[list]) -> list[list]:
    """Regions [id, label, box] without overlaps of a pixel or more, see ``dominated``."""
    while True:
        at = next(((i, j) for i in range(len(items)) for j in range(i + 1, len(items)) if common(items[i][2], items[j][2]) >= 1), None)
        if at is None:
            return items
        a, b = items[at[0]], items[at[1]]
        low, high = [max(a[2][k], b[2][k]) for k in (0, 1)], [min(a[2][k], b[2][k]) for k in (2, 3)]
        big, small = (a, b) if (extent(a[2]), b[0]) >= (extent(b[2]), a[0]) else (b, a)
        rows = min(a[2][3] - a[2][1], b[2][3] - b[2][1])
        if a[1] != b[1] and rows > 0 and (high[1] - low[1]) / rows > 0.9:
            big[2] = around(a[2], b[2])
            items[:] = [r for r in items if r is not small]
            continue
        # the shared band is cut away on the side where least is lost
        loser = small if a[1] != b[1] else big
        x0, y0, x1, y1 = loser[2]
        loser[2] = max(([x0, y0, x1, low[1]], [x0, high[1], x1, y1], [x0, y0, low[0], y1], [high[0], y0, x1, y1]), key=extent)
        if extent(loser[2]) < 1:
            items[:] = [r for r in items if r is not loser]


def runs_of(page: np.ndarray) -> list[tuple[int, int]]:
    """Where each page begins and ends; ``page`` is sorted."""
    first = np.flatnonzero(np.diff(page, prepend=-1))
    return list(zip(first.tolist(), np.append(first[1:], len(page)).tolist()))


def dominance_settled(p: Pages, fringe: float, labels: Sequence[str]) -> Pages:
    """``dominated`` of many pages; only pages where a region meets or holds another are gone through."""
    mine = np.flatnonzero(p.of(labels))
    box = p.box[mine]
    wide = box + np.array([-fringe, -fringe, fringe, fringe])
    holds = lambda i, j: (box[j, :2] >= wide[i, :2]).all(1) & (box[j, 2:] <= wide[i, 2:]).all(1)
    i, _ = page_pairs(p.page[mine], lambda i, j: (overlap_of(box[i], box[j]) >= 1) | holds(i, j) | holds(j, i))
    mine = mine[np.isin(p.page[mine], p.page[mine[i]])]
    kept, done = np.ones(len(p.page), bool), p.box.copy()
    kept[mine] = False
    names, kinds, each = p.names(mine), p.label[mine].tolist(), p.box[mine].tolist()
    for a, b in runs_of(p.page[mine]):
        # the place of a region goes along behind its box
        for r in resolved(absorbed([[names[k], kinds[k], each[k], mine[k]] for k in range(a, b)], fringe)):
            kept[r[3]], done[r[3]] = True, r[2]
    return replace(p, box=done).taken(kept)


def dominated(regions: DataFrame, fringe: float = 0, labels: Sequence[str] = ("TEXT", "TABULAR")) -> DataFrame:
    """Per page: large regions take in what lies within them; of two that still overlap, text and table join when their rows agree
    by more than 0.9 and otherwise give the shared band to the larger, and of one label the larger is cut by the smaller."""
    labels = list(labels)
    return of_pages(regions, lambda p, *_: dominance_settled(p, fringe, labels), "double")


def grown(box: list[list[float]], others: list[list[float]], walls: list[list[float]], low: float, high: float, distance: float, max_error: float, fringe: float) -> list[tuple[int, list[float]]]:
    """(first region, box) of each run of boxes in order, see ``grown_along_order``."""
    out, i = [], 0
    while i < len(box):
        best, end, now, sizes = box[i], i, box[i], extent(box[i])
        for j in range(i + 1, len(box)):
            if apart(now, box[j]) > distance:
                break
            now = around(now, box[j])
            x0, y0, x1, y1 = now[0] + fringe, now[1] + fringe, now[2] - fringe, now[3] - fringe
            if any(w[0] <= x1 and w[1] <= y1 and w[2] >= x0 and w[3] >= y0 for w in walls):
                break
            sizes = sizes + extent(box[j])
            error = max((common(o, now) / max(extent(o), 1e-9) for o in others), default=0)
            c = sizes / max(extent(now), 1e-9)
            if c < low or error > max_error:
                break
            if c > high:
                # from here on the union is one region
                end, best, sizes = j, now, extent(now)
        out.append((i, best))
        i = end + 1
    return out


def apart(a: Sequence[float], b: Sequence[float]) -> float:
    return np.hypot(max(max(b[0] - a[2], a[0] - b[2]), 0), max(max(b[1] - a[3], a[1] - b[3]), 0))


def grown_pages(p: Pages, label: str, distance: float, obstacles: Sequence[str], **limits: float) -> Pages:
    """``grown_along_order`` of many pages. A run needs two successive regions that are near each other: the order is found for pages with near
    regions of the label only, and runs for those where such regions follow each other."""
    is_own = p.of([label])
    near = lambda a, b: np.hypot(*np.maximum(np.maximum(b[:, :2] - a[:, 2:], a[:, :2] - b[:, 2:]), 0).T) <= distance
    own = np.flatnonzero(is_own)
    i, _ = page_pairs(p.page[own], lambda i, j: near(p.box[own[i]], p.box[own[j]]))
    own = own[np.isin(p.page[own], p.page[own[i]])]
    if not len(own):
        return p
    names = p.names(own)
    own = own[sorted(range(len(own)), key=lambda k: (p.page[own[k]], str(names[k])))]
    own = own[cut_orders(p.box[own], np.append([a for a, _ in runs_of(p.page[own])], len(own)), lambda g, _: SCORES["widest_gap"](g))[0]]
    follow = (p.page[own[1:]] == p.page[own[:-1]]) & near(p.box[own[:-1]], p.box[own[1:]])
    own = own[np.isin(p.page[own], p.page[own[1:][follow]])]
    rest = np.flatnonzero(~is_own & np.isin(p.page, p.page[own]))
    wall, others = p.of(obstacles)[rest].tolist(), p.box[rest].tolist()
    span = {k: slice(*x) for k, x in zip(np.unique(p.page[rest]).tolist(), runs_of(p.page[rest]))}
    kept, done, each = np.ones(len(p.page), bool), p.box.copy(), p.box[own].tolist()
    kept[own] = False
    for a, b in runs_of(p.page[own]):
        at = span.get(int(p.page[own[a]]), slice(0, 0))
        for k, box in grown(each[a:b], others[at], [o for o, w in zip(others[at], wall[at]) if w], distance=distance, **limits):
            kept[own[a + k]], done[own[a + k]] = True, box
    return replace(p, box=done).taken(kept)


def grown_along_order(regions: DataFrame, label: str, low: float = 0.5, high: float = 0.8, distance: float = 20, max_error: float = 0.05, obstacles: Sequence[str] = (), fringe: float = 0) -> DataFrame:
    """Per page, along the reading order of one label: a run of regions is united while the cohesion of its union stays above ``low``; from
    ``high`` on the union is taken and the run goes on from it.

    A run ends at a gap beyond ``distance``, where its box, inset by ``fringe``, would hit a region of a label of ``obstacles``, or where it
    would cover more than ``max_error`` of a region of another label.
    """
    obstacles = list(obstacles)
    return of_pages(regions, lambda p, *_: grown_pages(p, label, distance, obstacles, low=low, high=high, max_error=max_error, fringe=fringe), "double")


def aligned(a: np.ndarray, b: np.ndarray, axis: int) -> np.ndarray:
    """``spatial.alignment`` of boxes, one by one."""
    least = np.minimum(a[:, 2 + axis] - a[:, axis], b[:, 2 + axis] - b[:, axis])
    shared = np.maximum(0, np.minimum(a[:, 2 + axis], b[:, 2 + axis]) - np.maximum(a[:, axis], b[:, axis]))
    return np.where(least > 0, shared / np.where(least > 0, least, 1), 0.0)


def reaching(a: np.ndarray, b: np.ndarray, within: float) -> tuple[np.ndarray, np.ndarray]:
    """Which boxes of ``a`` come within so much of those of ``b``, and ``a`` widened and narrowed again, rounded as in ``spatial.meeting``."""
    low, high = a[:, :2] - within, a[:, 2:] + within
    return ((low <= b[:, 2:]) & (b[:, :2] <= high)).all(1), np.concatenate((low + within, high - within), 1)


def lines_merged(p: Pages, label: str, distance: float, known: np.ndarray, least: float = 0.8) -> Pages:
    """Unites the ``same_line_pairs`` of a label; only on pages that are ``known``, as NULL joins with nothing."""
    own = np.flatnonzero(p.of([label]) & known[p.page])
    box = p.box[own]

    def beside(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        touch, a = reaching(box[i], box[j], distance)
        gap = np.maximum(np.maximum(a[:, 0], box[j, 0]) - np.minimum(a[:, 2], box[j, 2]), 0)
        return touch & (aligned(a, box[j], 1) >= least) & (gap <= distance)

    i, j = page_pairs(p.page[own], lambda i, j: beside(i, j) | beside(j, i))
    # the one with the smaller id is widened
    swap = np.array([a > b for a, b in zip(p.names(own[i]), p.names(own[j]))], bool)
    good = beside(np.where(swap, j, i), np.where(swap, i, j))
    return joined(p, own[i[good]], own[j[good]])


def below_merged(p: Pages, label: str, distance: float, known: np.ndarray, least: float = 0.95) -> Pages:
    """Unites the ``below_pairs`` of a label, see ``lines_merged``."""
    own = np.flatnonzero(p.of([label]) & known[p.page])
    box = p.box[own]

    def under(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        touch, a = reaching(box[i], box[j], distance)
        return touch & (a[:, 3] <= box[j, 1]) & (aligned(a, box[j], 0) >= least) & (box[j, 1] - a[:, 3] < distance)

    i, j = page_pairs(p.page[own], lambda i, j: under(i, j) | under(j, i))
    return joined(p, own[i], own[j])


def splits_of(p: Pages, cut_page: np.ndarray, place: np.ndarray, axis: int, least: float = 0.2) -> Pages:
    """``split_on`` of many pages."""
    order = np.argsort(cut_page, kind="stable")
    cut_page, place = cut_page[order], place[order]
    first = np.searchsorted(cut_page, p.page)
    counts = np.searchsorted(cut_page, p.page, "right") - first
    region = np.repeat(np.arange(len(p.page)), counts)
    position = place[first[region] + within_groups(counts)]
    lo, hi = p.box[region, axis], p.box[region, 2 + axis]
    inner = (position > lo) & (position < hi)
    region, position, lo, hi = region[inner], position[inner], lo[inner], hi[inner]
    good = np.minimum(position - lo, hi - position) / (hi - lo) >= least
    at = np.full(len(p.page), np.inf)
    np.minimum.at(at, region[good], position[good])
    cut = np.isfinite(at)
    out = p.taken(np.repeat(np.arange(len(p.page)), 1 + cut))
    head = np.flatnonzero(cut) + np.arange(cut.sum())
    out.part[head], out.part[head + 1] = 1, 2
    out.box[head, 2 + axis] = out.box[head + 1, axis] = at[cut]
    return out


def split_on(regions: DataFrame, cuts: DataFrame, axis: str, least: float = 0.2) -> DataFrame:
    """Regions cut at the positions of ``cuts`` (page_id, position) that lie within them, if each part keeps ``least`` of the area.

    Parts are numbered ``block/1``, ``block/2`` .. in order; a region without a good cut stays whole.
    """
    lo, hi = f"min{axis}", f"max{axis}"
    inner = regions.join(cuts.select("page_id", "position"), "page_id").filter((F.col("position") > F.col(lo)) & (F.col("position") < F.col(hi)))
    share = F.least(F.col("position") - F.col(lo), F.col(hi) - F.col("position")) / (F.col(hi) - F.col(lo))
    at = inner.filter(share >= least).groupBy("page_id", "block_id").agg(F.min("position").alias("at"))
    rows = regions.join(at, ["page_id", "block_id"], "left")
    parts = F.when(F.col("at").isNull(), F.array(F.struct(F.lit("").alias("s"), F.col(lo).cast("double").alias("a"), F.col(hi).cast("double").alias("b")))).otherwise(
        F.array(F.struct(F.lit("/1").alias("s"), F.col(lo).cast("double").alias("a"), F.col("at").cast("double").alias("b")), F.struct(F.lit("/2").alias("s"), F.col("at").cast("double").alias("a"), F.col(hi).cast("double").alias("b")))
    )
    rows = rows.withColumn("p", F.explode(parts))
    return rows.select("page_id", F.concat("block_id", "p.s").alias("block_id"), "label", *[F.col("p.a").alias(c) if c == lo else F.col("p.b").alias(c) if c == hi else F.col(c) for c in BOX])


def divided(regions: DataFrame, dividers: DataFrame, axis: str) -> DataFrame:
    """The bands of each region between its dividers (page_id, block_id, positions ARRAY, sorted); empty bands are kept. Adds ``band``, from 0."""
    lo, hi = F.col(f"min{axis}").cast("double"), F.col(f"max{axis}").cast("double")
    rows = regions.join(dividers, ["page_id", "block_id"], "left").withColumn("positions", F.coalesce("positions", F.array().cast("array<double>")))
    inside = F.transform("positions", lambda p: F.least(F.greatest(p, lo), hi))
    edges = F.concat(F.array(lo), inside, F.array(hi))
    rows = rows.withColumn("edges", edges).withColumn("band", F.explode(F.sequence(F.lit(0), F.size("positions"))))
    first, last = F.element_at("edges", F.col("band") + 1), F.element_at("edges", F.col("band") + 2)
    return rows.withColumn("__lo", first).withColumn("__hi", last).drop(f"min{axis}", f"max{axis}", "edges").withColumnRenamed("__lo", f"min{axis}").withColumnRenamed("__hi", f"max{axis}")


def table_blocks(tables: DataFrame, columns: DataFrame, dividers: DataFrame, line_height: float, header_lines: float = 3) -> DataFrame:
    """Table regions as numbered blocks: divisions by the horizontal dividers; a division lower than ``header_lines`` lines is a header and cut by the columns too.

    Ids are ``block.division.row.column`` from 1; only body divisions keep the columns.
    """
    rows = divided(tables, dividers, "y").withColumnRenamed("band", "division").drop("positions")
    rows = rows.withColumn("is_header", (F.col("maxy") - F.col("miny")) < F.lit(header_lines * line_height))
    head = divided(rows.filter("is_header"), columns, "x").withColumnRenamed("band", "column").drop("positions").withColumn("columns", F.array().cast("array<double>"))
    body = rows.filter("NOT is_header").join(columns.withColumnRenamed("positions", "columns"), ["page_id", "block_id"], "left").withColumn("column", F.lit(0))
    name = F.concat_ws(".", "block_id", (F.col("division") + 1).cast("string"), F.lit("1"), (F.col("column") + 1).cast("string"))
    keep = ["page_id", "block_id", "label", "division", "column", "is_header", *BOX, "columns"]
    both = head.select(*keep).unionByName(body.select(*[F.col(c).cast("double") if c in BOX else F.col(c) for c in keep]))
    return both.withColumn("path", name)


def line_counts(lines: DataFrame) -> DataFrame:
    """(page_id, block_id, n_lines) of a table of lines."""
    return lines.groupBy("page_id", "block_id").agg(F.count("*").alias("n_lines"))


def median_line_height(lines: DataFrame, height: str, least: int = 6) -> DataFrame:
    """(page_id, line_height): the whole part of the median height, at least ``least``."""
    return lines.groupBy("page_id").agg(F.greatest(F.lit(least), F.median(height).cast("int")).alias("line_height"))


def cover_share(pairs: DataFrame) -> DataFrame:
    """Adds ``share``: overlap over the area of b."""
    return pairs.withColumn("share", F.when(area("b_") > 0, intersection() / area("b_")).otherwise(0.0))


def newspaper_program(width: float, height: float, separators: DataFrame | None = None, line_height: float = 30) -> Program:
    """The steps by which regions of a newspaper page are refined, in order: regions on one line and below one another united, overlaps
    united, dominance, growth along the reading order with table regions as obstacles, standing separators cut what spills over them,
    small regions dropped. Distances are shares of the page's diagonal. All but the dropping runs in one pass over whole pages.
    """
    diagonal = (width**2 + height**2) ** 0.5
    near, least = 0.006 * diagonal, (0.0025 * diagonal) ** 2
    plain = ["page_id", "block_id", "label", *BOX]

    def refined(p: Pages, cut_page: np.ndarray, place: np.ndarray) -> Pages:
        known = np.ones(p.page.max(initial=0) + 1, bool)
        known[p.page[p.table.column("page_id").is_null().to_numpy()]] = False
        p = lines_merged(p, "TEXT", near, known)
        p = below_merged(p, "TEXT", line_height, known)
        p = overlaps_merged(p, 0.1)
        p = dominance_settled(p, 0.005 * diagonal, ["TEXT", "TABULAR"])
        p = grown_pages(p, "TEXT", near, ["TABULAR"], low=0.5, high=0.8, max_error=0.05, fringe=0)
        return overlaps_merged(splits_of(p, cut_page, place, 0), 0.1)

    return Program([
        ("small", lambda r: large_enough(r, least).select(*plain)), ("refined", lambda r: of_pages(r, refined, "double", separators)), ("small again", lambda r: large_enough(r, least)),
    ])
