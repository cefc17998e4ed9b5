"""Expansion of run-encoded columns: normal form, lookup, and the row ranges on which several of them are constant."""

from __future__ import annotations

import numpy as np

from arrayloom.model import ArrayFileError


def normal_runs(boundaries: np.ndarray, rows: int, ends: bool) -> tuple[np.ndarray, int]:
    """(first row of each run, first row behind the last run) of run starts, or of inclusive run ends, over ``rows`` rows."""
    b = boundaries.astype(np.uint64)
    if (b[1:] < b[:-1]).any():
        raise ArrayFileError("Run-encoded boundaries must not decrease")
    cut = np.minimum(b, np.uint64(rows)).astype(np.int64)
    if not ends:
        return cut, rows
    behind = np.minimum(cut + 1, rows)  # clamped before the addition: no overflow
    if not len(cut):
        return cut, 0
    return np.r_[0, behind[:-1]], int(behind[-1])


def run_of(rows: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """The run of each row, -1 for rows of none. Of runs that start at one row the last is seen."""
    at = np.searchsorted(starts, rows, side="right") - 1
    return np.where(rows < end, at, -1)


def segments(rows: int, columns: list[tuple[np.ndarray, int]], most: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row ranges [start, end) of at most ``most`` rows on which each of the (starts, end) columns has one run, and those runs."""
    cuts = [np.arange(0, rows, most, dtype=np.int64)]
    for starts, end in columns:
        cuts += [starts[starts < rows], np.array([end] if 0 < end < rows else [], np.int64)]
    begin = np.unique(np.concatenate(cuts)) if rows else np.empty(0, np.int64)
    return begin, np.r_[begin[1:], rows] if len(begin) else begin, [run_of(begin, s, e) for s, e in columns]


def expand_runs(table, start: str, order, end: str | None = None):
    """Relational form: rows (start, ...) of a frame as one row for each position up to the next start or ``end``."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    if end is None:
        table = table.withColumn("__end", F.lead(start).over(Window.partitionBy(*order[0]).orderBy(start)) if order and order[0] else F.lead(start).over(Window.orderBy(start)))
        end = "__end"
    rows = table.filter(F.col(end) > F.col(start))  # sequence() would run backwards over an empty one
    return rows.withColumn("index", F.explode(F.sequence(F.col(start), F.col(end) - 1))).drop("__end")
