"""``spark.read.format("arrayloom")``: the batch form of a scan as a data source, with its columns given as options.

Options: ``path`` (or load's argument), ``columns`` (dataset paths, ``index``, ``rse(starts, values)`` and
``ree(ends, values)``, each with an optional ``as name``, separated by commas), ``filename`` (true or a name),
``rangeRows``. It takes no filters: what one query pushes into a reader must not reach the next use of a frame.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from arrayloom.functions.definitions import alias, index, ree, rse
from arrayloom.model import ArrayFileError
from arrayloom.functions.settings import BATCH, batch_size, setting
from arrayloom.plans.bind import RANGE_ROWS, Bound, bind

COLUMN = re.compile(r"\s*(?:(rse|ree)\(\s*([^,()]+?)\s*,\s*([^,()]+?)\s*\)|(index)\b(?!/)|([^,]+?))(?:\s+as\s+(\w+))?\s*(?:,|$)", re.I)


def parse_columns(text: str) -> list:
    """Definitions of a comma-separated list."""
    out, at = [], 0
    while at < len(text):
        m = COLUMN.match(text, at)
        if not m:
            raise ArrayFileError(f"Can't read columns: {text[at:]}")
        runs, first, second, number, path, name = m.groups()
        d = (rse if runs.lower() == "rse" else ree)(first, second) if runs else index() if number else path.strip()
        out.append(alias(name, d) if name else d)
        at = m.end()
    return out


@dataclass
class RowRange(InputPartition):
    file: int
    start: int
    end: int


class ArraySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrayloom"

    def bound(self) -> Bound:
        filename = self.options.get("filename", "false")
        filename = {"true": True, "false": False}.get(filename.lower(), filename)
        return bind(self.options["path"], tuple(parse_columns(self.options.get("columns", ""))), filename)

    def schema(self) -> str:
        b = self.bound()
        return ", ".join([*[f"`{c.name}` {c.type}" for c in b.columns], *([f"`{b.filename}` string"] if b.filename else [])])

    def reader(self, schema) -> DataSourceReader:
        return ArrayReader(self.bound(), int(self.options.get("rangerows", RANGE_ROWS)))

    def streamReader(self, schema):
        from arrayloom.streaming.tail import TailReader, patiently

        b = patiently(self.bound, self.options["path"])
        return TailReader(self.options["path"], tuple(parse_columns(self.options.get("columns", ""))), b.filename or False)


class ArrayReader(DataSourceReader):
    def __init__(self, bound: Bound, rows: int):
        self.bound, self.rows = bound, rows
        self.batch_bytes = batch_size(setting(None, BATCH, "10MB"))

    def partitions(self) -> list[RowRange]:
        found = [RowRange(f.ordinal, a, min(a + self.rows, f.rows)) for f in self.bound.files for a in range(0, f.rows, self.rows)]
        return found or [RowRange(0, 0, 0)]

    def read(self, part: RowRange) -> Iterator[pa.RecordBatch]:
        from arrayloom.sources.scan import read_range

        one = self.bound.files[part.file]
        return read_range(one.columns, self.bound.filename, one.path, one.rows, part.start, part.end, self.batch_bytes)


def register_source(spark: SparkSession) -> None:
    spark.dataSource.register(ArraySource)
