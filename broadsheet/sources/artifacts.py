"""Page folders and the artifacts in them as tables.

Files are read whole by Spark's ``binaryFile`` source and opened in Arrow batches; entries become rows. What is asked for of an archive
(predictor types, predictors, labels) is checked on the entries' names before anything is unpacked.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.session import ship

# Suffixes of page images, kinds of artifacts with their files, stages of a page.
IMAGES = ["jpg", "png", "tif", "tiff"]
ARTIFACTS = {
    "segmentation": "segment.zip", "contours": "contours.zip", "flow": "flow.zip", "lines": "lines.zip", "dewarp": "dewarp.zip", "tables": "tables.json", "order": "order.json",
    "ocr": "ocr.zip", "compose": "compose.zip", "runtime": "runtime.json", "signature": "signature.zip", "thumbnail": "thumbnail.jpg",
}
STAGES = {"warped": 0, "dewarped": 1, "aggregate": 2, "reliable": 3}
STAGED = {"contours": (0, 1, 2, 3), "lines": (0, 3)}


@dataclass(frozen=True)
class Artifact:
    """A kind of artifact, at a stage where the kind has stages; ``name`` is 'lines/reliable', 'ocr' .."""

    kind: str
    stage: int | None = None

    @classmethod
    def parse(cls, name: str) -> Artifact:
        kind, _, stage = name.lower().partition("/")
        if kind not in ARTIFACTS or (stage and (stage not in STAGES or STAGES[stage] not in STAGED.get(kind, ()))):
            raise ValueError(f"no such artifact: {name}")
        return cls(kind, STAGES[stage] if stage else None)

    @property
    def file(self) -> str:
        stem, _, suffix = ARTIFACTS[self.kind].partition(".")
        return ARTIFACTS[self.kind] if self.stage is None else f"{stem}.{self.stage}.{suffix}"


def is_image(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(" + "|".join(IMAGES) + ")$")


def node_kind(path: Column) -> Column:
    """'ignore' for data folders and presentation copies, 'page' for page images below jpg, else 'descend'."""
    return F.when(path.rlike(r"\.out(/|$)") | path.rlike("(^|/)presentation(/|$)"), "ignore").when(path.rlike(r"/jpg/.*\.jpg$"), "page").otherwise("descend")


def scan_pages(spark: SparkSession, root: str, pattern: str = "") -> DataFrame:
    """(path, length, modified) of the page images below ``root`` whose path matches ``pattern``; data folders are passed over. No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    return files.filter(is_image(F.col("path")) & ~F.col("path").rlike(r"\.out/") & F.col("path").rlike(pattern))


def resolve(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Page paths with the image that has the same stem, if exactly one has: (page_path, image)."""
    stem = lambda c: F.regexp_replace(c, r"\.[^./]+$", "")
    found = images.groupBy(stem(F.col("path")).alias("stem")).agg(F.count("*").alias("n"), F.min("path").alias("image")).filter("n = 1")
    return pages.withColumn("stem", stem(F.col("page_path"))).join(found, "stem", "left").select("page_path", "image")


def load(spark: SparkSession, root: str, artifact: Artifact | str) -> DataFrame:
    """(page, content): files of one artifact below ``root``; the page is the folder ``<page>.out`` they lie in."""
    artifact = Artifact.parse(artifact) if isinstance(artifact, str) else artifact
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", artifact.file).load(root)
    return files.select(F.regexp_extract("path", r"([^/]+)\.out/[^/]+$", 1).alias("page"), F.regexp_replace("path", r"/[^/]+$", "").alias("folder"), "content")


def _opened(files: DataFrame, schema: str, rows) -> DataFrame:
    ship(files.sparkSession)
    columns = [x.strip().split(" ")[0] for x in schema.split(",")]  # a map's comma is written ;

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [(page, *r) for page, content in zip(f["page"], f["content"]) for r in rows(content)]
            yield pd.DataFrame(out, columns=["page", *columns])

    return files.select("page", "content").mapInPandas(run, "page string, " + schema.replace(";", ", "))


def contours(files: DataFrame, kind: str | None = None) -> DataFrame:
    """(page, predictor, label, block_id, wkt, width): shapes of a contours archive; ``kind`` is REGION, SEPARATOR or both.

    Older archives list their predictors as an object. Separators have the width of their index, regions none.
    """

    def rows(content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            meta = json.loads(z.read("meta.json"))
            kinds = {p["name"]: p["type"] for p in meta["predictions"]} if isinstance(meta.get("predictions"), list) else dict(meta.get("predictions", meta))
            widths: dict[str, list[float]] = {}
            for name in sorted(z.namelist()):
                parts = name.split("/")
                if len(parts) != 3 or not name.endswith(".wkt") or (kind and kinds.get(parts[0]) != kind):
                    continue
                folder = f"{parts[0]}/{parts[1]}/meta.json"
                if folder not in widths:
                    widths[folder] = json.loads(z.read(folder)).get("width", []) if folder in z.namelist() else []
                block = parts[2].removesuffix(".wkt")
                width = widths[folder][int(block)] if block.isdigit() and int(block) < len(widths[folder]) else None
                yield parts[0], parts[1], block, z.read(name).decode(), width

    return _opened(files, "predictor string, label string, block_id string, wkt string, width double", rows)


def text_lines(files: DataFrame) -> DataFrame:
    """(page, predictor, label, block_id, line_id, px, py, right_x, right_y, up_x, up_y, wkt, confidence, ascent, descent, height)."""

    def rows(content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for name in sorted(z.namelist()):
                parts = name.split("/")
                if len(parts) != 4 or not parts[3].endswith(".json"):
                    continue
                d = json.loads(z.read(name))
                c = d.get("confidence", 1)
                confidence = {k: float(v) for k, v in c.items()} if isinstance(c, dict) else {f"{parts[0]}/{parts[1]}": float(c)} if c is not None else None
                t = d.get("tesseract_data") or {}
                yield *parts[:3], int(parts[3].removesuffix(".json")), *map(float, (*d["p"], *d["right"], *d["up"])), d.get("wkt"), confidence, *(None if t.get(k) is None else float(t[k]) for k in ("ascent", "descent", "height"))

    kinds = "predictor string, label string, block_id string, line_id int, px double, py double, right_x double, right_y double, up_x double, up_y double, wkt string, confidence map<string;double>, ascent double, descent double, height double"
    return _opened(files, kinds, rows)


def texts(files: DataFrame) -> DataFrame:
    """(page, predictor, label, block_id, line_id, text) of a recognition archive."""

    def rows(content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for name in sorted(z.namelist()):
                parts = name.split("/")
                if len(parts) == 4 and parts[3].endswith(".txt"):
                    yield *parts[:3], int(parts[3].removesuffix(".txt")), z.read(name).decode("utf-8")

    return _opened(files, "predictor string, label string, block_id string, line_id int, text string", rows)


def flow_samples(files: DataFrame) -> DataFrame:
    """(page, kind, x, y, phi) of a flow archive: points and angles of the kinds h and v."""

    def rows(content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = set(z.namelist())
            for kind in ("h", "v"):
                if f"{kind}/points.npy" in names:
                    p, a = (np.load(io.BytesIO(z.read(f"{kind}/{k}.npy")), allow_pickle=False) for k in ("points", "angles"))
                    yield from ((kind, float(x), float(y), float(phi)) for (x, y), phi in zip(p, a))

    return _opened(files, "kind string, x double, y double, phi double", rows)


def dewarp_grid(files: DataFrame) -> DataFrame:
    """(page, gy, gx, x, y, cell) of a dewarp archive."""

    def rows(content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            cell = int(json.loads(z.read("meta.json"))["cell"])
            g = np.load(io.BytesIO(z.read("data.npy")), allow_pickle=False)
            for i in range(g.shape[0]):
                for j in range(g.shape[1]):
                    yield i, j, float(g[i, j, 0]), float(g[i, j, 1]), cell

    return _opened(files, "gy int, gx int, x double, y double, cell int", rows)


def table_data(files: DataFrame) -> DataFrame:
    """(page, path, kind, positions) of table files: 'columns' and 'dividers' of each table region."""
    kind = "struct<columns: map<string, array<double>>, dividers: map<string, array<double>>>"
    d = files.select("page", F.from_json(F.col("content").cast("string"), kind).alias("d"))
    each = lambda k: d.select("page", F.explode(f"d.{k}").alias("path", "positions")).select("page", "path", F.lit(k).alias("kind"), F.transform("positions", lambda p: F.bround(p, 1)).alias("positions"))
    return each("columns").unionByName(each("dividers"))


def orders(files: DataFrame) -> DataFrame:
    """(page, order_key, rank, path) of order files; '*' is the order of all regions."""
    d = files.select("page", F.explode(F.from_json(F.col("content").cast("string"), "struct<orders: map<string, array<string>>>")["orders"]).alias("order_key", "paths"))
    return d.select("page", "order_key", F.posexplode("paths").alias("rank", "path"))


def archived(entries: DataFrame, page: str = "page", name: str = "name", content: str = "content") -> DataFrame:
    """(page, content): the entries of each page (name, content as text) as one zip archive, in the order of their names, with fixed times, so that equal entries give equal bytes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
            for n, c in sorted(zip(pdf[name], pdf[content])):
                z.writestr(zipfile.ZipInfo(n), c, zipfile.ZIP_DEFLATED)
        return pd.DataFrame({"page": [pdf[page].iloc[0]], "content": [data.getvalue()]})

    return entries.groupBy(page).applyInPandas(run, "page string, content binary")
