"""A SQLite table as a Spark source: rows are read by ranges of their rowid, one task each."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Columns of the annotation table.
ANNOTATIONS = {"page_path": "string", "line_path": "string", "line_wkt": "string", "annotation": "string", "author": "string", "training": "boolean", "validation": "boolean"}


class Span(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[tuple[str, str]]):
        self.path, self.table, self.columns, self.size = options["path"], options.get("table", "lines"), columns, int(options.get("rows", 100_000))

    def connect(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[Span]:
        with self.connect() as c:
            first, last = c.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        return [] if first is None else [Span(a, min(a + self.size - 1, last)) for a in range(first, last + 1, self.size)]

    def read(self, span: Span) -> Iterator[tuple]:
        flags = [kind == "boolean" for _, kind in self.columns]
        names = ", ".join(f'"{n}"' for n, _ in self.columns)
        with self.connect() as c:
            for row in c.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid BETWEEN ? AND ?', (span.first, span.last)):
                yield tuple(bool(v) if flag and v is not None else v for v, flag in zip(row, flags))


class AnnotationDatabase(DataSource):
    """``spark.read.format("annotations").option("path", file)``; the file must be reachable from all executors."""

    @classmethod
    def name(cls) -> str:
        return "annotations"

    def schema(self) -> str:
        return ", ".join(f"{n} {k}" for n, k in ANNOTATIONS.items())

    def reader(self, schema) -> Reader:
        return Reader(self.options, [(f.name, f.dataType.simpleString()) for f in schema.fields])


def register(spark: SparkSession) -> None:
    from broadsheet.session import ship

    ship(spark)
    spark.dataSource.register(AnnotationDatabase)


def create(path: str) -> None:
    """The annotation table and its unique index, if they are not there."""
    kinds = {"string": "TEXT", "boolean": "BOOLEAN"}
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE IF NOT EXISTS lines (" + ", ".join(f'"{n}" {kinds[k]}' for n, k in ANNOTATIONS.items()) + ")")
        c.execute("CREATE UNIQUE INDEX IF NOT EXISTS lines_place ON lines (page_path, line_path)")


def insert(path: str, lines: DataFrame, batch: int = 1000) -> int:
    """Appends the lines whose place the table lacks; gives their number. For samples: the rows come through the driver in batches."""
    names = [n for n in ANNOTATIONS if n in lines.columns]
    sql = f"INSERT OR IGNORE INTO lines ({', '.join(names)}) VALUES ({', '.join('?' * len(names))})"
    create(path)
    with sqlite3.connect(path) as c:
        before = c.total_changes
        held: list[tuple] = []
        for row in lines.select(*names).toLocalIterator():
            held.append(tuple(row))
            if len(held) == batch:
                c.executemany(sql, held)
                held = []
        c.executemany(sql, held)
        return c.total_changes - before


def migrate(path: str) -> list[str]:
    """Adds the flags that an older table lacks, true by default; gives the names of those added."""
    with sqlite3.connect(path) as c:
        have = {r[1] for r in c.execute("PRAGMA table_info(lines)")}
        new = [n for n in ("training", "validation") if n not in have]
        for n in new:
            c.execute(f"ALTER TABLE lines ADD COLUMN {n} BOOLEAN DEFAULT TRUE")
    return new
