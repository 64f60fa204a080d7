"""Polygons in numpy, as Arrow-batched functions: hulls, clipping, masks, neighbours, dewarping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.grouped import each_batch, floats
from broadsheet.session import ship

RING = "array<struct<x:double,y:double>>"


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull in order, by the monotone chain; fewer than three points come back sorted."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def chain(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out

    low, high = chain(p), chain(p[::-1])
    return np.array(low[:-1] + high[:-1])


def area(p: np.ndarray) -> float:
    return 0.0 if len(p) < 3 else float(abs(np.dot(p[:, 0], np.roll(p[:, 1], -1)) - np.dot(p[:, 1], np.roll(p[:, 0], -1))) / 2)


def clip_convex(subject: np.ndarray, window: np.ndarray) -> np.ndarray:
    """The part of a polygon within a convex window given counter-clockwise, cut side by side."""
    out = [tuple(p) for p in subject]
    for a, b in zip(window, np.roll(window, -1, axis=0)):
        side = lambda p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])  # noqa: B023, E731
        done = []
        for p, q in zip(out, out[1:] + out[:1]):
            sp, sq = side(p), side(q)
            if sp >= 0:
                done.append(p)
            if (sp > 0 > sq) or (sp < 0 < sq):
                t = sp / (sp - sq)
                done.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        out = done
        if not out:
            break
    return np.array(out).reshape(-1, 2)


def fill(polygon: np.ndarray, width: int, height: int) -> np.ndarray:
    """Mask of the pixels whose centre is inside a polygon, by the even-odd rule along each row."""
    mask = np.zeros((height, width), bool)
    if len(polygon) < 3:
        return mask
    x0, y0 = polygon.T
    x1, y1 = np.roll(x0, -1), np.roll(y0, -1)
    centres = np.arange(width) + 0.5
    for row in range(max(0, int(np.floor(y0.min()))), min(height, int(np.ceil(y0.max())) + 1)):
        y = row + 0.5
        hit = (y0 <= y) != (y1 <= y)
        cross = np.sort(x0[hit] + (y - y0[hit]) / (y1[hit] - y0[hit]) * (x1[hit] - x0[hit]))
        mask[row] = np.searchsorted(cross, centres) % 2 == 1
    return mask


def adjacent(box: np.ndarray, cells: int = 128) -> set[tuple[int, int]]:
    """Pairs of boxes whose areas of influence meet: a raster of the nearest box of each cell, and the neighbours in it.

    An approximation of the Voronoi diagram of the boxes, as fine as the raster.
    """
    if len(box) < 2:
        return set()
    lo, hi = box[:, :2].min(0), box[:, 2:].max(0)
    x, y = (np.linspace(a, b, cells) for a, b in zip(lo, hi))
    nearest = np.empty((cells, cells), int)
    for k, v in enumerate(y):
        dx = np.maximum(np.maximum(box[:, None, 0] - x, x - box[:, None, 2]), 0)
        dy = np.maximum(np.maximum(box[:, 1] - v, v - box[:, 3]), 0)[:, None]
        nearest[k] = np.argmin(dx * dx + dy * dy, axis=0)
    pairs = np.concatenate([np.stack((nearest[:, 1:], nearest[:, :-1]), -1).reshape(-1, 2), np.stack((nearest[1:], nearest[:-1]), -1).reshape(-1, 2)])
    pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
    return {(int(a), int(b)) for a, b in pairs}


#: Cells of a block's side, numbers in one array and boxes of a page up to which ``adjacents`` takes many pages at once.
BLOCK, NUMBERS, MOST = 8, 1 << 18, 256


def adjacents(box: np.ndarray, cells: int = 128) -> np.ndarray:
    """``adjacent`` of many pages with as many boxes each (pages, boxes, 4): rows of page, a and b, sorted.

    A block of cells (with the first of the next) is looked at only if no one box is surely the nearest of all its cells, and only for pairs not found
    yet: bounds of a block's distances are sums of bounds along either axis, rounded as the distances are.
    """
    pages, n = box.shape[:2]
    if n < 2 or not pages:
        return np.zeros((0, 3), int)
    if n > MOST:
        return np.array([(k, *x) for k, b in enumerate(box) for x in sorted(adjacent(b, cells))], int).reshape(-1, 3)
    size = max(1, NUMBERS // (n * cells))
    if pages > size:
        parts = [(k, adjacents(box[k : k + size], cells)) for k in range(0, pages, size)]
        return np.concatenate([p + [k, 0, 0] for k, p in parts])
    # pages, then blocks, are the last axis of all arrays
    starts = np.arange(0, cells, BLOCK)
    lows, highs, squares = [], [], []
    for axis in (0, 1):
        a, b = (np.ascontiguousarray(box[:, :, k].T) for k in (axis, 2 + axis))
        first, last = a.min(0), b.max(0)
        at = np.arange(cells)[:, None] * ((last - first) / (cells - 1)) + first
        at[-1] = last
        d = np.maximum(np.maximum(a[:, None] - at, at - b[:, None]), 0)
        d *= d
        beyond = d[:, np.minimum(starts + BLOCK, cells - 1)]
        squares.append(d)
        lows.append(np.minimum(np.minimum.reduceat(d, starts, 1), beyond))
        highs.append(np.maximum(np.maximum.reduceat(d, starts, 1), beyond))
    low, high = (x[0][:, None] + x[1][:, :, None] for x in (lows, highs))
    # of boxes equally near the first counts as the nearest
    may = low <= high.min(0)
    may[1:] &= low[1:] < np.minimum.accumulate(high[:-1], 0)
    row, column, page = np.nonzero(np.add.reduce(may, 0, dtype=np.int32) > 1)
    may = may[:, row, column, page]
    # blocks far from one another first: they find most pairs
    turn = (column + 3 * row) % BLOCK
    lower = np.tril(np.ones((n, n), bool))
    found = np.repeat(lower[:, :, None], pages, 2)
    for k in range(BLOCK):
        some = np.flatnonzero(turn == k)
        own = may[:, some]
        some = some[(own[:, None] & own[None] & ~found[:, :, page[some]]).any((0, 1))]
        if not len(some):
            continue
        p = page[some]
        dx, dy = (d[:, np.minimum(BLOCK * at[some] + np.arange(BLOCK + 1)[:, None], cells - 1), p] for d, at in zip(squares, (column, row)))
        best = dx[0] + dy[0][:, None]
        nearest = np.zeros(best.shape, np.int16)
        for i in range(1, n):
            d = dx[i] + dy[i][:, None]
            np.copyto(nearest, np.int16(i), where=d < best)
            np.minimum(best, d, out=best)
        for a, b in ((nearest[:, 1:], nearest[:, :-1]), (nearest[1:], nearest[:-1])):
            at = np.nonzero(a != b)
            a, b = a[at], b[at]
            found[np.minimum(a, b), np.maximum(a, b), p[at[2]]] = True
    return np.argwhere((found & ~lower[:, :, None]).transpose(2, 0, 1))


def on_grid(grid: np.ndarray, cell: float, points: np.ndarray) -> np.ndarray:
    """Points of the dewarped page on the warped one: bilinear within the cells of the grid (h, w, 2), clamped at its edge."""
    g = np.clip(points / cell, 0, [grid.shape[1] - 1, grid.shape[0] - 1])
    at = np.minimum(g.astype(int), [max(grid.shape[1] - 2, 0), max(grid.shape[0] - 2, 0)])
    f = g - at
    j, i = at.T
    i1, j1 = np.minimum(i + 1, grid.shape[0] - 1), np.minimum(j + 1, grid.shape[1] - 1)
    fx, fy = f[:, :1], f[:, 1:]
    return (grid[i, j] * (1 - fx) + grid[i, j1] * fx) * (1 - fy) + (grid[i1, j] * (1 - fx) + grid[i1, j1] * fx) * fy


def off_grid(grid: np.ndarray, cell: float, points: np.ndarray, rounds: int = 20) -> np.ndarray:
    """The way back: from the nearest knot, corrected by the remaining error until it is small."""
    flat = grid.reshape(-1, 2)
    near = np.array([np.argmin(((flat - p) ** 2).sum(1)) for p in points], int)
    out = np.stack((near % grid.shape[1], near // grid.shape[1]), -1).astype(float) * cell
    limit = np.array([grid.shape[1] - 1, grid.shape[0] - 1]) * cell
    for _ in range(rounds):
        step = points - on_grid(grid, cell, out)
        if np.abs(step).max(initial=0) < 1e-3:
            break
        out = np.clip(out + step, 0, limit)
    return out


def _ring(points: list) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in points if p["x"] is not None and p["y"] is not None], float).reshape(-1, 2)


def hulls(df: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    """(keys, hull, area): convex hull of all points of a key's rings.

    Hulls of rings are taken first, in batches, so that a key's group holds corners only.
    """
    ship(df.sparkSession)
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keys)

    def small(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f[f[ring].notna()]
            out = [[{"x": float(x), "y": float(y)} for x, y in convex_hull(_ring(r))] for r in f[ring]]
            yield f[keys].assign(ring=pd.Series(out, index=f.index, dtype=object))

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [r for r in map(_ring, pdf["ring"]) if len(r)]
        h = convex_hull(np.concatenate(parts)) if parts else np.zeros((0, 2))
        first = pdf[keys].iloc[[0]].reset_index(drop=True)
        return first.assign(hull=pd.Series([[{"x": float(x), "y": float(y)} for x, y in h]], dtype=object), area=area(h))

    cut = df.select(*keys, ring).mapInPandas(small, f"{head}, ring {RING}")
    return cut.groupBy(*keys).applyInPandas(joined, f"{head}, hull {RING}, area double")


def neighbours(boxes: DataFrame, cells: int = 128) -> DataFrame:
    """(page_id, a, b): regions of a page between which no other lies (see ``adjacent``)."""
    page, block = (next(f.dataType.simpleString() for f in boxes.schema.fields if f.name == n) for n in ("page_id", "block_id"))
    bounds_of_box = ["minx", "miny", "maxx", "maxy"]

    def work(table: pa.Table, bounds: np.ndarray) -> pa.Table:
        box, counts, found = floats(table, bounds_of_box), np.diff(bounds), [np.zeros((0, 2), int)]
        for n in np.unique(counts).tolist():
            first = bounds[:-1][counts == n]
            pairs = adjacents(box[first[:, None] + np.arange(n)], cells)
            found.append(first[pairs[:, :1]] + pairs[:, 1:])
        a, b = (pa.array(x) for x in np.concatenate(found).T)
        of = lambda name, at: table.column(name).take(at)
        return pa.table({"page_id": of("page_id", a), "a": of("block_id", a), "b": of("block_id", b)})

    needed = boxes.select("page_id", "block_id", *bounds_of_box).dropna()
    return each_batch(needed, ["page_id"], f"page_id {page}, a {block}, b {block}", work, [F.col("block_id").cast("string")])


#: Pixels of one word of a mask's row: sums of powers of two that every engine holds in a whole number.
WORD = 32


def mask_signature(boxes: DataFrame, width: float, height: float, size: int = 128, shrink: float = 2) -> DataFrame:
    """(page_id, label, pixels, mask): pixels of a small raster that the label's regions, shrunk a little, fill.

    ``mask`` is an array of (y, w0, w1 ..) of the rows with pixels, ``w0`` the bits of the first 32 pixels from the left. A label without
    pixels has 0 and an empty array; a region without a page or with a NULL bound is left out. Rows of the raster are ORed by partial aggregates.
    """
    words = range(-(-size // WORD))
    pixel = lambda v, full, up: F.least(F.greatest((F.ceil if up else F.floor)(v * size / F.lit(full)), F.lit(0)), F.lit(size)).cast("int")
    rows = boxes.select("page_id", "label", "minx", "miny", "maxx", "maxy").dropna()
    rows = rows.select("page_id", "label", pixel(F.col("minx") + shrink, width, False).alias("x0"), pixel(F.col("miny") + shrink, height, False).alias("y0"), pixel(F.col("maxx") - shrink, width, True).alias("x1"), pixel(F.col("maxy") - shrink, height, True).alias("y1"),
                       ((F.col("maxx") - F.col("minx") > 2 * shrink) & (F.col("maxy") - F.col("miny") > 2 * shrink)).alias("solid"))
    filled = F.when(F.col("solid") & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1")), F.sequence("y0", F.col("y1") - 1))
    rows = rows.withColumn("y", F.explode_outer(filled))
    at = lambda x, k: F.least(F.greatest(F.col(x) - WORD * k, F.lit(0)), F.lit(WORD))
    bits = lambda k: F.pow(F.lit(2.0), at("x1", k)).cast("bigint") - F.pow(F.lit(2.0), at("x0", k)).cast("bigint")
    lines = rows.groupBy("page_id", "label", "y").agg(*[F.bit_or(bits(k)).alias(f"w{k}") for k in words])
    count = sum((F.bit_count(f"w{k}") for k in words[1:]), F.bit_count("w0"))
    line = F.when(F.col("y").isNotNull(), F.struct("y", *[f"w{k}" for k in words]))
    return lines.groupBy("page_id", "label").agg(F.coalesce(F.sum(F.when(F.col("y").isNotNull(), count)), F.lit(0)).alias("pixels"), F.array_sort(F.collect_list(line)).alias("mask"))


def dewarped(points: DataFrame, grid: DataFrame, inverse: bool = False) -> DataFrame:
    """``points`` (page, x, y, ..) moved through their page's ``grid`` (page, gy, gx, x, y, cell); ``inverse`` from the warped to the dewarped page."""
    ship(points.sparkSession)
    schema = ", ".join(f"`{f.name}` {'double' if f.name in ('x', 'y') else f.dataType.simpleString()}" for f in points.schema.fields)

    def run(p: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        if not len(p) or not len(g):
            return p.iloc[:0]
        array = np.zeros((g["gy"].max() + 1, g["gx"].max() + 1, 2))
        array[g["gy"], g["gx"]] = g[["x", "y"]].to_numpy()
        moved = (off_grid if inverse else on_grid)(array, float(g["cell"].iloc[0]), p[["x", "y"]].to_numpy(float))
        return p.assign(x=moved[:, 0], y=moved[:, 1])

    return points.groupBy("page").cogroup(grid.groupBy("page")).applyInPandas(run, schema)


def rewarped(regions: DataFrame) -> DataFrame:
    """Bounds clipped to the page (width, height)."""
    cut = lambda c, top: F.least(F.greatest(F.col(c), F.lit(0)), F.col(top))
    return regions.withColumns({"minx": cut("minx", "width"), "miny": cut("miny", "height"), "maxx": cut("maxx", "width"), "maxy": cut("maxy", "height")})
