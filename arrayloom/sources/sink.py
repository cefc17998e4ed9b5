"""A distributed sink: one array file for each partition of a frame, in a folder that all workers see."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrayloom.format.writer import Writer, number, vlen_string

NUMBERS = {T.ByteType: "<i1", T.ShortType: "<i2", T.IntegerType: "<i4", T.LongType: "<i8", T.FloatType: "<f4", T.DoubleType: "<f8"}


def column_values(values: pd.Series, kind: T.DataType) -> tuple[np.ndarray, object]:
    """(array, stored type) of a column: numbers, texts, or equally long lists of numbers."""
    if isinstance(kind, T.StringType):
        return np.array([v or "" for v in values], object), vlen_string()
    if isinstance(kind, T.ArrayType):
        inner = NUMBERS[type(kind.elementType)]
        return np.stack([np.asarray(v, inner) for v in values]) if len(values) else np.empty((0, 0), inner), number(inner)
    code = NUMBERS[type(kind)]
    return values.to_numpy().astype(code), number(code)


def run_starts(values: np.ndarray) -> np.ndarray:
    return np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1].astype(np.int64) if len(values) else np.empty(0, np.int64)


def write_files(df: DataFrame, folder: str, group: str = "/", runs: Iterable[str] = (), chunk: int | None = None, deflate: int = 0, latest: bool = False) -> list[str]:
    """Writes each partition, in its order, as ``part-NNNNN.h5`` and returns the names of those that have rows.

    A column becomes a dataset of ``group``; one of ``runs`` becomes <name>_starts, <name>_ends and
    <name>_values. Timestamps are stored as microseconds. A file gets its name when it is complete, and its content
    follows from its partition alone, so a task that runs twice leaves the same file.
    """
    os.makedirs(folder, exist_ok=True)
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    for name in times:
        df = df.withColumn(name, F.unix_micros(F.col(name).cast("timestamp")))
    schema, runs = df.schema, set(runs)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        parts = list(batches)
        rows = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=schema.names)
        if not len(rows):
            return
        path = os.path.join(folder, f"part-{TaskContext.get().partitionId():05d}.h5")
        w = Writer(f"{path}.{os.getpid()}.tmp", latest=latest)
        w.root.attributes["rows"] = np.int64(len(rows))
        base = group.rstrip("/")
        for f in schema.fields:
            values, kind = column_values(rows[f.name], f.dataType)
            if f.name in runs:
                starts = run_starts(values)
                w.dataset(f"{base}/{f.name}_starts", starts)
                w.dataset(f"{base}/{f.name}_ends", np.r_[starts[1:], len(values)] - 1)
                values = values[starts]
                w.dataset(f"{base}/{f.name}_values", values, type=kind)
            else:
                shape = None if chunk is None else (min(chunk, max(len(values), 1)), *[max(d, 1) for d in values.shape[1:]])
                w.dataset(f"{base}/{f.name}", values, type=kind, chunk=shape, deflate=deflate if shape else 0, shuffle=bool(shape and deflate))
        w.close()
        os.replace(w.path, path)
        yield pd.DataFrame({"path": [path]})

    names = [r.path for r in df.mapInPandas(write, "path string").collect()]  # one name a partition
    return sorted(names, key=lambda n: int(re.search(r"part-(\d+)", n)[1]))
