"""Reading order by recursive cuts of a page along the best gap of either axis.

The cut itself is sequential by nature, but only in depth: of many pages the parts with as many boxes are cut at once (``cut_orders``);
``cut_order`` does the same for one page. The first gap of all pages is plain SQL (``first_gap``). Scores: 'widest_gap', 'largest_area', 'longest_cut', or 'obstacle' with separators.
Ties: the first maximum wins, the x axis before the y axis, coordinates in stable order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from broadsheet.operators.grouped import each_batch, floats, within_groups

#: Extent added to a box that has none.
MIN_EXTENT = 0.1
#: A separator gap is looked at with this margin.
GAP_MARGIN = 5
#: Thick separators (wider than the first) weaken obstacles and strengthen flow by the second.
THICK, THICK_DELTA = 2, 2


@dataclass
class Gap:
    """A candidate: the empty band [u0, u1] across one axis over the other axis' extent [v0, v1]."""

    axis: int
    u0: float
    u1: float
    v0: float
    v1: float

    @property
    def width(self) -> float:
        return self.u1 - self.u0

    @property
    def length(self) -> float:
        return self.v1 - self.v0


SCORES: dict[str, Callable[[Gap], float]] = {
    "widest_gap": lambda g: g.width,
    "largest_area": lambda g: g.width * g.length,
    "longest_cut": lambda g: g.length,
}


def union_length(parts: list[tuple[float, float]]) -> float:
    total, end = 0.0, -np.inf
    for a, b in sorted(parts):
        total += max(0.0, b - max(a, end))
        end = max(end, b)
    return total


def obstacle_score(separators: np.ndarray, labels: list[str], widths: np.ndarray) -> Callable[[Gap], float]:
    """Area of the gap, less for separators across it, more for separators along it (rows of x0, y0, x1, y1)."""
    box = np.column_stack((np.minimum(separators[:, 0], separators[:, 2]), np.minimum(separators[:, 1], separators[:, 3]), np.maximum(separators[:, 0], separators[:, 2]), np.maximum(separators[:, 1], separators[:, 3]))) if len(separators) else np.zeros((0, 4))

    def score(g: Gap) -> float:
        du, dv = g.width, g.length
        if du < 0.5 or dv < 0.5:
            return 0.0
        u, v = g.axis, 1 - g.axis
        lo, hi = np.zeros(2), np.zeros(2)
        lo[u], hi[u], lo[v], hi[v] = g.u0 - GAP_MARGIN, g.u1 + GAP_MARGIN, g.v0 - GAP_MARGIN, g.v1 + GAP_MARGIN
        across, along, weights, thick = [], [], [], []
        for b, label, w in zip(box, labels, widths):
            first, last = np.maximum(b[:2], lo), np.minimum(b[2:], hi)
            if (first > last).any():
                continue
            if (0 if label == "H" else 1) == g.axis:
                across.append((first[u], last[u] + 1))
            else:
                along.append((first[v], last[v] + 1))
                weights.append(last[v] - first[v])
                thick.append(w)
        blocked, flow = union_length(across) / du, union_length(along) / dv
        if along and np.average(thick, weights=np.maximum(weights, 1e-9)) > THICK:
            blocked, flow = blocked - THICK_DELTA, flow + THICK_DELTA
        return du * dv * (1 - blocked) * (1 + flow)

    return score


def union_lengths(at: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """``union_length`` of the parts (a, b) of each of ``n`` sets; ``at``: the set of each part."""
    order = np.lexsort((b, a, at))
    at, a, b = at[order], a[order], b[order]
    total, end, counts = np.zeros(n), np.full(n, -np.inf), np.bincount(at, minlength=n)
    first = np.cumsum(counts) - counts
    for k in range(counts.max(initial=0)):
        g = np.flatnonzero(counts > k)
        x, y = a[first[g] + k], b[first[g] + k]
        total[g] += np.maximum(0.0, y - np.maximum(x, end[g]))
        end[g] = np.maximum(end[g], y)
    return total


def obstacle_scores(separators: np.ndarray, lying: np.ndarray, widths: np.ndarray, counts: np.ndarray) -> Callable[[Gap, np.ndarray], np.ndarray]:
    """``obstacle_score`` for gaps of many pages: of arrays in a ``Gap`` and the page of each. ``counts``: separators of each page, which stand in order."""
    box = np.column_stack((np.minimum(separators[:, :2], separators[:, 2:]), np.maximum(separators[:, :2], separators[:, 2:])))
    start = np.cumsum(counts) - counts

    def score(g: Gap, page: np.ndarray) -> np.ndarray:
        du, dv, u, v = g.width, g.length, g.axis, 1 - g.axis
        fit = ~((du < 0.5) | (dv < 0.5))
        near = np.where(fit, counts[page], 0)
        at = np.repeat(np.arange(len(page)), near)
        own = start[page][at] + within_groups(near)
        low, high = {u: g.u0 - GAP_MARGIN, v: g.v0 - GAP_MARGIN}, {u: g.u1 + GAP_MARGIN, v: g.v1 + GAP_MARGIN}
        first, last = {d: np.maximum(box[own, d], low[d][at]) for d in (0, 1)}, {d: np.minimum(box[own, 2 + d], high[d][at]) for d in (0, 1)}
        hit = ~((first[0] > last[0]) | (first[1] > last[1]))
        side = np.where(lying[own], 0, 1) == g.axis
        across, along = np.flatnonzero(hit & side), np.flatnonzero(hit & ~side)
        with np.errstate(divide="ignore", invalid="ignore"):
            blocked = union_lengths(at[across], first[u][across], last[u][across] + 1, len(page)) / du
            flow = union_lengths(at[along], first[v][along], last[v][along] + 1, len(page)) / dv
            weight = np.maximum(last[v][along] - first[v][along], 1e-9)
            thick = np.bincount(at[along], widths[own[along]] * weight, len(page)) / np.bincount(at[along], weight, len(page)) > THICK
        blocked, flow = np.where(thick, blocked - THICK_DELTA, blocked), np.where(thick, flow + THICK_DELTA, flow)
        return np.where(fit, du * dv * (1 - blocked) * (1 + flow), 0.0)

    return score


def best_cut(box: np.ndarray, score: Callable[[Gap], float], eps: float) -> tuple[int, float, bool] | None:
    """(axis, coordinate, whether it is a gap) of the best candidate; boxes as rows of minx, miny, maxx, maxy."""
    best: tuple[float, int, float, bool] | None = None
    for axis in (0, 1):
        lo, hi, other = box[:, axis], box[:, 2 + axis], box[:, 3 - axis] - box[:, 1 - axis]
        at = np.concatenate((lo, hi))
        owner = np.tile(np.arange(len(box)), 2)
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        v0, v1 = box[:, 1 - axis].min(), box[:, 3 - axis].max()
        active: set[int] = set()
        for x0, x1, j in zip(at[:-1], at[1:], owner[:-1]):
            active ^= {int(j)}
            if x0 <= at[0] + eps:
                continue
            if not active:
                value, gap = score(Gap(axis, x0, x1, v0, v1)), True
            else:
                a = np.fromiter(active, int)
                value, gap = -float((other[a] * np.minimum(np.abs(x0 - lo[a]), np.abs(x0 - hi[a]))).sum()), False
            if best is None or value > best[0]:
                best = (value, axis, float(x0), gap)
    return best[1:] if best else None


def split_at(box: np.ndarray, axis: int, c: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices before and behind the cut; a box across it goes to the side where it reaches less far, no side stays empty."""
    lo, hi = box[:, axis], box[:, 2 + axis]
    before = np.where(hi <= c, True, np.where(lo >= c, False, np.abs(c - lo) >= np.abs(c - hi)))
    if before.all():
        before[np.argmax(hi)] = False
    elif not before.any():
        before[np.argmin(lo)] = True
    return np.flatnonzero(before), np.flatnonzero(~before)


def cut_order(box: np.ndarray, score: Callable[[Gap], float], eps: float = 0, grouped: bool = False) -> list[list[int]]:
    """Groups of box indices in reading order; without ``grouped`` each is one box, with it what no gap parts stays together."""
    box = box.astype(float).reshape(-1, 4).copy()
    box[:, 2] += np.where(box[:, 2] <= box[:, 0], MIN_EXTENT, 0)
    box[:, 3] += np.where(box[:, 3] <= box[:, 1], MIN_EXTENT, 0)

    def recurse(index: np.ndarray) -> tuple[list[list[int]], bool]:
        if len(index) < 2:
            return [index.tolist()], True
        cut = best_cut(box[index], score, eps)
        if cut is None:
            return ([index.tolist()] if grouped else [[int(i)] for i in index]), False
        axis, c, gap = cut
        a, b = split_at(box[index], axis, c)
        if not len(a) or not len(b):
            return ([index.tolist()] if grouped else [[int(i)] for i in index]), False
        parts = recurse(index[a])[0] + recurse(index[b])[0]
        if grouped and not gap:
            return [[i for p in parts for i in p]], False
        return parts, True

    return recurse(np.arange(len(box)))[0] if len(box) else []


#: Boxes of a part up to which parts are cut many at once, and numbers in one array of that.
MANY, CELLS = 512, 1 << 20


def best_cuts(box: np.ndarray, page: np.ndarray, score: Callable[[Gap, np.ndarray], np.ndarray], eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``best_cut`` of many parts with as many boxes each (parts, boxes, 4): axis, coordinate, whether it is a gap, whether there is a cut."""
    n, m = box.shape[:2]
    if m > MANY:
        one = lambda p: lambda g: float(score(Gap(g.axis, *(np.array([x]) for x in (g.u0, g.u1, g.v0, g.v1))), np.array([p]))[0])
        cuts = [best_cut(b, one(p), eps) for b, p in zip(box, page)]
        return tuple(np.array([c[k] if c else 0 for c in cuts], kind) for k, kind in enumerate((int, float, bool))) + (np.array([c is not None for c in cuts]),)
    rows, step = np.arange(n), np.arange(2 * m - 1)[:, None]
    best, axes, cut, is_gap, found = np.full(n, -np.inf), np.zeros(n, int), np.zeros(n), np.zeros(n, bool), np.zeros(n, bool)
    for axis in (0, 1):
        lo, hi, other = box[:, :, axis], box[:, :, 2 + axis], box[:, :, 3 - axis] - box[:, :, 1 - axis]
        v0, v1 = box[:, :, 1 - axis].min(1), box[:, :, 3 - axis].max(1)
        at = np.concatenate((lo, hi), 1)
        order = np.argsort(at, 1, kind="stable")
        at, rank = np.take_along_axis(at, order, 1), np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(2 * m)[None], 1)
        active = (rank[:, None, :m] <= step) ^ (rank[:, None, m:] <= step)
        x0 = at[:, :-1]
        reach = np.minimum(np.abs(x0[:, :, None] - lo[:, None]), np.abs(x0[:, :, None] - hi[:, None]))
        value = -np.where(active, other[:, None] * reach, 0.0).sum(-1)
        inner, empty = x0 > at[:, :1] + eps, ~active.any(-1)
        p, q = np.nonzero(inner & empty)
        if len(p):
            value[p, q] = score(Gap(axis, x0[p, q], at[p, q + 1], v0[p], v1[p]), page[p])
        value[~inner] = -np.inf
        k = np.argmax(value, 1)
        better = inner.any(1) & (~found | (value[rows, k] > best))
        best, axes, cut, is_gap = np.where(better, value[rows, k], best), np.where(better, axis, axes), np.where(better, x0[rows, k], cut), np.where(better, empty[rows, k], is_gap)
        found |= better
    return axes, cut, is_gap, found


def splits_at(box: np.ndarray, axis: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``split_at`` of many parts: which boxes come before the cut."""
    rows, c = np.arange(len(box)), c[:, None]
    lo, hi = box[rows, :, axis], box[rows, :, 2 + axis]
    before = np.where(hi <= c, True, np.where(lo >= c, False, np.abs(c - lo) >= np.abs(c - hi)))
    every, none = before.all(1), ~before.any(1)
    before[every, np.argmax(hi[every], 1)] = False
    before[none, np.argmin(lo[none], 1)] = True
    return before


def cut_orders(box: np.ndarray, bounds: np.ndarray, score: Callable[[Gap, np.ndarray], np.ndarray], eps: float = 0, grouped: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``cut_order`` of many pages, whose boxes stand between ``bounds``: the boxes in reading order, page after page, and where a group begins."""
    box = box.copy()
    box[:, 2] += np.where(box[:, 2] <= box[:, 0], MIN_EXTENT, 0)
    box[:, 3] += np.where(box[:, 3] <= box[:, 1], MIN_EXTENT, 0)
    order, begins = np.arange(len(box)), np.full(len(box), not grouped)
    start, count = bounds[:-1], np.diff(bounds)
    begins[start[count > 0]] = True
    # parts: the first place in the order, boxes, page, and whether a cut outside of a gap has made them one group
    parts = np.stack((start, count, np.arange(len(start)), np.zeros(len(start), int)), 1)[count > 1]
    while len(parts):
        after = []
        for m in np.unique(parts[:, 1]).tolist():
            same = parts[parts[:, 1] == m]
            size = max(1, CELLS // (2 * m * m))
            for some in (same[k : k + size] for k in range(0, len(same), size)):
                at = some[:, :1] + np.arange(m)
                own = order[at]
                axis, c, gap, found = best_cuts(box[own], some[:, 2], score, eps)
                before = splits_at(box[own], axis, c)
                some, at, own, before, gap = some[found], at[found], own[found], before[found], gap[found]
                order[at] = np.take_along_axis(own, np.argsort(~before, 1, kind="stable"), 1)
                left, one = before.sum(1), some[:, 3].astype(bool) | ~gap
                begins[(some[:, 0] + left)[~one]] = True
                after += [np.stack((some[:, 0], left, some[:, 2], one), 1), np.stack((some[:, 0] + left, m - left, some[:, 2], one), 1)]
        parts = np.concatenate(after)
        parts = parts[parts[:, 1] > 1]
    return order, begins


def reading_order(boxes: DataFrame, keys: list[str], item: str, score: str = "widest_gap", fringe: float = 0, separators: DataFrame | None = None, grouped: bool = False) -> DataFrame:
    """(keys, item, rank, group): reading order of the boxes of each page. Boxes are moved inwards by ``fringe`` first.

    NULL bounds leave a box or a separator out. With score 'obstacle' the page's ``separators`` (keys, label, x0, y0, x1, y1, width) are used.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in boxes.schema.fields if f.name in [*keys, item]) + ", `rank` int, `group` int"
    places = ["__x0", "__y0", "__x1", "__y1"]

    def side(df: DataFrame, item: Column, names: list[str], lying: Column, width: Column) -> DataFrame:
        return df.dropna(subset=names).select(*keys, item, *[F.col(c).cast("double").alias(p) for c, p in zip(names, places)], lying.cast("boolean").alias("__lying"), width.cast("double").alias("__width"))

    def order(table: pa.Table, bounds: np.ndarray) -> pa.Table:
        is_box = table.column("__lying").is_null().to_numpy()
        page = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        value = SCORES.get(score)
        if value is None:
            seps = table.filter(pa.array(~is_box))
            cost = obstacle_scores(floats(seps, places), seps.column("__lying").to_numpy().astype(bool), floats(seps, ["__width"])[:, 0], np.bincount(page[~is_box], minlength=len(bounds) - 1))
        else:
            cost = lambda g, _: value(g)
        table = table if is_box.all() else table.filter(pa.array(is_box))
        b, counts = floats(table, places), np.bincount(page[is_box], minlength=len(bounds) - 1)
        if fringe:
            low = np.minimum(b[:, :2] + fringe, b[:, 2:])
            b = np.concatenate((low, np.maximum(b[:, 2:] - fringe, low)), 1)
        flat, begins = cut_orders(b, np.append(0, np.cumsum(counts)), cost, grouped=grouped)
        number = np.cumsum(begins)
        start = np.repeat(np.cumsum(counts) - counts, counts)
        out = table.select([*keys, item]).take(pa.array(flat))
        return out.append_column("rank", pa.array(within_groups(counts).astype(np.int32))).append_column("group", pa.array((number - number[start]).astype(np.int32)))

    needed = side(boxes, F.col(item), ["minx", "miny", "maxx", "maxy"], F.lit(None), F.lit(None))
    if separators is not None and score not in SCORES:
        kind = boxes.schema[item].dataType
        needed = needed.unionByName(side(separators, F.lit(None).cast(kind).alias(item), ["x0", "y0", "x1", "y1"], F.coalesce(F.col("label") == "H", F.lit(False)), F.col("width")))
    return each_batch(needed, keys, schema, order, [item])


def first_gap(boxes: DataFrame, keys: list[str], axis: str = "y") -> DataFrame:
    """(keys, at, gap): the widest empty band of each page along an axis, the first of equals; by running maximum, as SQL."""
    lo, hi = F.col(f"min{axis}"), F.col(f"max{axis}")
    order = W.partitionBy(*keys).orderBy(lo, hi)
    rows = boxes.filter(lo.isNotNull() & hi.isNotNull()).select(*keys, lo.alias("lo"), F.max(hi).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("reach"))
    gaps = rows.filter(F.col("lo") > F.col("reach")).withColumn("gap", F.col("lo") - F.col("reach"))
    return gaps.groupBy(*keys).agg(F.max(F.struct("gap", (-F.col("reach")).alias("r"))).alias("m")).select(*keys, (-F.col("m.r")).alias("at"), F.col("m.gap").alias("gap"))
