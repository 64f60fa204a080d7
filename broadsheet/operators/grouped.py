"""A function of numpy arrays for each group of rows, without a DataFrame for each group.

For very many small groups the cost of one pandas frame a group outweighs the work. Rows are sorted within hash partitions of the key
and streamed in Arrow batches; groups are slices of the batch's arrays, and only an open group is carried to the next batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from broadsheet.session import ship

Columns = dict[str, np.ndarray]


def each_group(df: DataFrame, keys: list[str], schema: str, work: Callable[[Columns], Columns]) -> DataFrame:
    """Rows of ``work`` for each group of ``df`` by ``keys``; it gets the group's columns and gives the columns of ``schema``."""
    ship(df.sparkSession)
    keys = list(keys)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for frame in frames:
            if not len(frame):
                continue
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            codes = [pd.factorize(frame[k], use_na_sentinel=False)[0] for k in keys]
            new = np.zeros(len(frame), bool)
            new[0] = True
            for c in codes:
                new[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(new)
            held = frame.iloc[starts[-1] :].reset_index(drop=True)
            if len(starts) > 1:
                yield done(frame, starts)
        if held is not None:
            yield done(held, np.array([0, len(held)]))

    def done(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        columns = {c: frame[c].to_numpy() for c in frame.columns}
        out = [work({c: v[a:b] for c, v in columns.items()}) for a, b in zip(starts[:-1], starts[1:])]
        out = [x for x in out if len(next(iter(x.values())))]
        return pd.DataFrame({c: np.concatenate([x[c] for x in out]) for c in names}) if out else pd.DataFrame(columns=names)

    names = [f.split(" ")[0].strip("`") for f in schema.split(", ")]
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


#: Rows that are gathered before ``each_batch`` works on them.
BATCH_ROWS = 65_536


def bounds_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the groups of a table sorted by ``keys`` begin, and its length."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        codes = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode")
        codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def each_batch(df: DataFrame, keys: list[str], schema: str, work: Callable[[pa.Table, np.ndarray], pa.Table], order: list[str | Column] | None = None) -> DataFrame:
    """Rows of ``work`` for many whole groups of ``df`` by ``keys`` at a time, for work that numpy does over all of them at once.

    It gets a table sorted by ``keys`` and ``order``, and the bounds of its groups; it gives the columns of ``schema``. A group is never cut.
    """
    ship(df.sparkSession)
    keys = list(keys)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, enough = 0, BATCH_ROWS
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < enough:
                continue
            table = pa.Table.from_batches(held)
            bounds = bounds_of(table, keys)
            if len(bounds) > 2:
                yield from done(table.slice(0, bounds[-2]), bounds[:-1])
                table = table.slice(bounds[-2])
            held, rows = table.to_batches(), table.num_rows
            enough = max(BATCH_ROWS, 2 * rows)  # a group that fills the table is not looked through again and again
        if rows:
            table = pa.Table.from_batches(held)
            yield from done(table, bounds_of(table, keys))

    def done(table: pa.Table, bounds: np.ndarray) -> list[pa.RecordBatch]:
        out = work(table.combine_chunks(), bounds)
        return out.select(target.names).cast(target).combine_chunks().to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys, *(order or [])).mapInArrow(run, schema)


def floats(table: pa.Table, names: list[str]) -> np.ndarray:
    """Columns of numbers side by side, NULL as NaN."""
    return np.stack([table.column(c).to_numpy().astype(float) for c in names], -1)


def within_groups(counts: np.ndarray) -> np.ndarray:
    """0, 1 .. for each group of so many rows."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
