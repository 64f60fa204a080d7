"""Contracts for what needs a trained network or an imaging library: segmentation, line detection, recognition, thumbnails, PDF pages.

A model is a picklable object that turns a batch of inputs into a batch of outputs; Spark hands it Arrow batches, so a
model is loaded once for a worker. Nothing here is a model; ``PathText`` stands in for recognition in tests.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame

from broadsheet.session import ship

#: Lines narrower or lower than this many pixels are not recognised; their text is empty.
LEAST_SIZE = 6


class Model(Protocol):
    def load(self) -> None:
        """Makes the model ready; called once in each task before any batch."""

    def predict(self, batch: pd.DataFrame) -> Sequence[Any]:
        """One output for each row."""


class PathText:
    """Recognition that tells the path of its line."""

    def load(self) -> None:
        pass

    def predict(self, batch: pd.DataFrame) -> list[str]:
        path = batch["predictor"] + "/" + batch["label"] + "/" + batch["block_id"] + "/" + batch["line_id"].astype(str)
        return ("text for " + path + ".").tolist()


def apply(df: DataFrame, model: Model, out: str, kind: str) -> DataFrame:
    """``df`` with the model's output in column ``out`` of type ``kind``."""
    ship(df.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` {kind}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model.load()
        for f in frames:
            yield f.assign(**{out: pd.Series(list(model.predict(f)), index=f.index, dtype=object)})

    return df.mapInPandas(run, schema)


def recognized(lines: DataFrame, model: Model, width: str = "width", height: str = "height") -> DataFrame:
    """Texts of lines by a recognition model; lines smaller than ``LEAST_SIZE`` get an empty text and are not handed to it."""
    large = lines.filter((lines[width] >= LEAST_SIZE) & (lines[height] >= LEAST_SIZE))
    small = lines.filter(~((lines[width] >= LEAST_SIZE) & (lines[height] >= LEAST_SIZE)) | lines[width].isNull() | lines[height].isNull())
    from pyspark.sql import functions as F

    return apply(large, model, "text", "string").unionByName(small.withColumn("text", F.lit("")))
