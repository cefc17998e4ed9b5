"""Structured Streaming over files that grow: rows appended behind those already read are the next micro-batch."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSourceStreamReader, InputPartition

from arrayloom.functions.settings import BATCH, batch_size, setting
from arrayloom.model import ArrayFileError
from arrayloom.plans.bind import RANGE_ROWS, Column, bind
from arrayloom.sources.paths import expand, is_remote

#: Seconds that a file which can't be read must have rested before it counts as broken, and between two looks at it.
REST, PAUSE = 2.0, 0.05


@dataclass
class Rows(InputPartition):
    path: str
    total: int
    start: int
    end: int


def stamps(files) -> list[tuple] | None:
    """What tells that a write goes on; None where no size and time are at hand, or a file is gone for the moment."""
    try:
        found = [os.stat(p.removeprefix("file://")) for p in expand(files, "read") if not is_remote(p)]
    except (OSError, ArrayFileError):
        return None
    return [(s.st_ino, s.st_mtime_ns, s.st_size) for s in found]


def patiently[T](look: Callable[[], T], files) -> T:
    """What ``look`` gives, as soon as the files can be read: one that a writer is at may be cut short, or half there.

    Any error counts, as bytes may be anything then. It is raised once the files have rested for REST seconds.
    """
    seen, since = stamps(files), time.monotonic()
    while True:
        try:
            return look()
        except Exception:
            now = stamps(files)
            if now != seen:
                seen, since = now, time.monotonic()
            elif time.monotonic() - since > REST:
                raise
            time.sleep(PAUSE)


class TailReader(DataSourceStreamReader):
    """Micro-batches of new rows. Files are bound again for each, so new files of a pattern take part too.

    The driver looks at row counts only; ranges of rows are read by tasks. Files are taken to grow only. One that
    is found in the middle of a write is waited for, by the driver and by tasks.
    """

    def __init__(self, files, definitions: tuple, filename, rows: int = RANGE_ROWS):
        self.files, self.definitions, self.filename, self.rows = files, definitions, filename, rows
        self.batch_bytes = batch_size(setting(None, BATCH, "10MB"))
        self.known: dict[str, int] = {}
        self.at: dict[str, int] = {}

    def bound(self):
        bound = patiently(lambda: bind(self.files, self.definitions, self.filename), self.files)
        self.known = {f.path: f.rows for f in bound.files}
        return bound

    def initialOffset(self) -> dict:
        return {"rows": json.dumps({})}

    def latestOffset(self) -> dict:
        self.bound()
        self.at |= {p: max(self.at.get(p, 0), n) for p, n in self.known.items()}
        return {"rows": json.dumps(self.at, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        begin, behind = json.loads(start["rows"]), json.loads(end["rows"])
        self.at = {p: max(n, self.at.get(p, 0)) for p, n in behind.items()}
        self.columns: list[Column] = self.bound().columns
        out = []
        for path, n in behind.items():
            for at in range(begin.get(path, 0), n, self.rows):
                out.append(Rows(path, max(n, self.known.get(path, n)), at, min(at + self.rows, n)))
        return out

    def batches(self, part: Rows, at: int) -> Iterator[pa.RecordBatch]:
        from arrayloom.sources.scan import fresh, read_range

        fresh(part.path)  # its row count has changed since it was last opened
        columns = bind([part.path], self.definitions, self.filename).columns
        return read_range(columns, self.filename or None, part.path, part.total, at, part.end, self.batch_bytes)

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        at, left = part.start, None

        def following() -> pa.RecordBatch:
            nonlocal left
            try:
                left = left or self.batches(part, at)
                return next(left)
            except BaseException:
                left = None  # an iterator that has failed is at its end
                raise

        while at < part.end:
            batch = patiently(following, [part.path])
            yield batch
            at += batch.num_rows

    def commit(self, end: dict) -> None:
        pass
