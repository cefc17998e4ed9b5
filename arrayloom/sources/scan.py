"""The scan of a bound read, in two physical forms with the same rows.

``late``: row ranges -> one row for each position -> one Arrow function for each dataset column. Catalyst drops the
functions of columns that are not used, puts filters on the index and on run-encoded columns below them, and
counts without any of them. ``full``: row ranges -> Arrow batches of all columns, the faster way to read them all.

Row ranges are made on the executors, one file at a time, cut where a run-encoded column changes; so the runs'
values are constants of a range, and a filter on them drops whole ranges before anything is read.
"""

from __future__ import annotations

import decimal
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrayloom.format.reader import File
from arrayloom.format.values import decode
from arrayloom.model import HType
from arrayloom.functions.settings import BATCH, batch_size, setting
from arrayloom.operators.runs import normal_runs, run_of, segments
from arrayloom.plans.bind import RANGE_ROWS, Bound, Column, checked_runs, dataset
from arrayloom.sources.bytesource import adopt, sftp_access, with_access

OPEN_FILES = 16
#: Rows of a task, about, where the data are large.
TASK_ROWS = 1 << 22
_open: OrderedDict[str, File] = OrderedDict()


def opened(path: str) -> File:
    """A file that this worker keeps open; the least recently used is closed."""
    file = _open.pop(path, None)
    if file is not None and getattr(file.source, "changed", bool)():
        file.close()
        file = None
    file = file or File(path)
    _open[path] = file
    if len(_open) > OPEN_FILES:
        _open.popitem(last=False)[1].close()
    return file


def fresh(path: str) -> File:
    """The file as it is now, for the first use by a task."""
    if path in _open:
        _open.pop(path).close()
    return opened(path)


def arrow_type(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(arrow_type(kind[6:-1]))
    return {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64(), "string": pa.string(), "decimal(20,0)": pa.decimal128(20, 0)}[kind]


def arrow_array(values: np.ndarray, kind: str) -> pa.Array:
    """Rows of numbers, texts or nested lists; inner axes become lists over one flat array, without a copy by row."""
    inner = kind
    while inner.startswith("array<"):
        inner = inner[6:-1]
    flat = values.reshape(-1)
    if inner == "decimal(20,0)":
        out = pa.array([decimal.Decimal(int(v)) for v in flat], pa.decimal128(20, 0))
    elif inner == "string":
        out = pa.array(flat, pa.string())
    else:
        out = pa.array(flat).cast(arrow_type(inner))
    for axis in range(values.ndim - 1, 0, -1):
        n = int(np.prod(values.shape[:axis], dtype=np.int64))
        out = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * values.shape[axis]), out)
    return out


def read_rows(path: str, column: str, rows: np.ndarray) -> np.ndarray:
    """The dataset's values at the given rows; each run of neighbours is one read."""
    file = opened(path)
    found = dataset(file, column)
    if not len(rows):
        return decode(file, found.raw_rows(0, 0), found.type, column)
    steps = np.diff(rows)
    if (steps == 1).all():
        return decode(file, found.raw_rows(int(rows[0]), int(rows[-1]) + 1), found.type, column)
    order = np.argsort(rows, kind="stable") if (steps < 0).any() else np.arange(len(rows))
    wanted = rows[order]
    chunk = found.layout.chunk[0] if found.layout.chunk else 1
    # Rows of one chunk are read together, for a chunk is decoded as a whole.
    cuts = np.flatnonzero((np.diff(wanted) > 1) & (np.diff(wanted // chunk) > 0)) + 1
    parts = []
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(wanted)], strict=True):
        lo, hi = int(wanted[a]), int(wanted[b - 1]) + 1
        parts.append(found.raw_rows(lo, hi)[wanted[a:b] - lo])
    raw = np.concatenate(parts)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return decode(file, np.ascontiguousarray(raw[back]), found.type, column)


def scalar(path: str, column: Column) -> object:
    file = opened(path)
    found = dataset(file, column.path)
    if found.space.dims is None:
        return None
    value = decode(file, found.raw_rows(0, 1), found.type, column.path)
    return plain(value.reshape(-1)[0], column.type)


def plain(value, kind: str):
    if kind == "decimal(20,0)":
        return decimal.Decimal(int(value))
    return value.item() if isinstance(value, np.generic) else value


def known_runs(file: File, column: Column, rows: int) -> tuple[np.ndarray, int, pa.Array]:
    """(starts, end, values) of a run-encoded column, kept for as long as the file is open."""
    kept = file.__dict__.setdefault("known_runs", {})
    key = column.path, column.boundaries, column.ends, rows
    if key not in kept:
        b, values = checked_runs(file, column)
        kept[key] = *normal_runs(b, rows, column.ends), arrow_array(decode(file, values.raw_rows(0, len(b)), values.type, column.path), column.type)
    return kept[key]


def plain_ranges(spark: SparkSession, bound: Bound, rows_of: int) -> DataFrame:
    """(__file, __path, __rows, __start, __end) of all files: they follow from the row counts, in the JVM."""
    listed = spark.createDataFrame([(f.ordinal, f.path, f.rows) for f in bound.files], "__file int, __path string, __rows long")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__rows") - 1, F.lit(rows_of).cast("long")))
    found = listed.filter("__rows > 0").select("*", start.alias("__start"))
    return found.withColumn("__end", F.least("__rows", F.col("__start") + rows_of))


def ranges(spark: SparkSession, bound: Bound, names: set[str], rows_of: int = RANGE_ROWS) -> DataFrame:
    """(__file, __path, __start, __end, the values of run-encoded and scalar columns) of all files."""
    constants = [c for c in bound.columns if c.kind in ("runs", "scalar") and c.name in names]
    files = [(f.ordinal, f.path, f.rows, [c.path for c in f.columns]) for f in bound.files]
    schema = ", ".join(["__file int", "__path string", "__start long", "__end long", *[f"`{c.name}` {c.type}" for c in constants]])

    # Arrow, not pandas: NaN is a value and must not become null.
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.to_pylist():
                path, rows, runs, fixed = one["path"], one["rows"], {}, {}
                file = fresh(path)
                for c in constants:
                    if c.kind == "scalar":
                        fixed[c.name] = scalar(path, c)
                    else:
                        b, values = checked_runs(file, c)
                        runs[c.name] = normal_runs(b, rows, c.ends), arrow_array(decode(file, values.raw_rows(0, len(b)), values.type, c.path), c.type)
                start, end, which = segments(rows, [r for r, _ in runs.values()], rows_of)
                at_run = dict(zip(runs, which, strict=True))
                for at in range(0, len(start), 10_000):
                    part = slice(at, at + 10_000)
                    n = len(start[part])
                    out = [pa.array([one["ordinal"]] * n, pa.int32()), pa.array([path] * n, pa.string()), pa.array(start[part]), pa.array(end[part])]
                    for c in constants:
                        if c.kind == "scalar":
                            out.append(pa.array([fixed[c.name]] * n, arrow_type(c.type)))
                        else:
                            run = at_run[c.name][part]
                            out.append(runs[c.name][1].take(pa.array(run, mask=run < 0)))
                    yield pa.RecordBatch.from_arrays(out, ["__file", "__path", "__start", "__end", *[c.name for c in constants]])

    if not constants:
        return plain_ranges(spark, bound, rows_of).drop("__rows")
    listed = spark.createDataFrame([(o, p, r) for o, p, r, _ in files], "ordinal int, path string, rows long")
    return listed.repartition(min(len(files), 1_000)).mapInArrow(with_access(cut), schema)


def sizes(bound: Bound, cores: int, rows_of: int | None) -> tuple[int, int]:
    """(rows of a range, tasks): a range for each core at least, and tasks by rows where there are many."""
    total = sum(f.rows for f in bound.files)
    rows_of = rows_of or max(1 << 12, min(RANGE_ROWS, total // (2 * cores) + 1))
    return rows_of, max(1, min(sum(-(-f.rows // rows_of) for f in bound.files), max(2 * cores, -(-total // TASK_ROWS))))


def of_any_size(split: DataFrame) -> DataFrame:
    """The ranges, whose size tells nothing of the rows that are read from them.

    Once they are dealt out, adaptive plans take the few bytes of their list for the size of the whole scan, and would
    send a table of any size through the driver to broadcast it in a join. An RDD has no known size, so with one
    without partitions beside them joins are chosen by the size of the rows that are shuffled, or by a hint.
    """
    return split.union(split.sparkSession.createDataFrame(split.sparkSession.sparkContext.emptyRDD(), split.schema))


def scan(spark: SparkSession, bound: Bound, mode: str = "auto", rows_of: int | None = None, rows_read=None) -> DataFrame:
    """All columns in the order of their definitions, then the file name if asked for.

    ``rows_read`` is an accumulator that is told how many values of datasets are read.
    """
    columns = bound.columns
    if mode == "auto":
        mode = "late" if any(c.kind in ("index", "runs") for c in columns) or len(columns) > 4 else "full"
    given = rows_of
    rows_of, tasks = sizes(bound, max(spark.sparkContext.defaultParallelism, 1), rows_of)
    name = [F.col("__path").alias(bound.filename)] if bound.filename else []
    if mode == "full":
        most = batch_size(setting(spark, BATCH, "10MB"))
        return full_scan(of_any_size(plain_ranges(spark, bound, rows_of).repartition(tasks)), bound, most, rows_read)
    split = ranges(spark, bound, {c.name for c in columns}, rows_of)
    if any(c.kind == "runs" for c in columns) and given is None:
        tasks = max(tasks, 2 * spark.sparkContext.defaultParallelism)  # runs cut the ranges further
    rows = of_any_size(split.repartition(tasks)).withColumn("__row", F.explode(F.sequence("__start", F.col("__end") - 1)))
    out = []
    for c in columns:
        if c.kind == "index":
            out.append(F.col("__row").alias(c.name))
        elif c.kind == "data":
            out.append(reader(c, rows_read)("__path", "__row").alias(c.name))
        else:
            out.append(F.col(f"`{c.name}`"))
    return rows.select(*out, *name)


def reader(column: Column, rows_read=None):
    kind, path, access = column.type, column.path, dict(sftp_access)

    @F.arrow_udf(kind)
    def read(files: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for names, rows in files:
            names, rows = names.dictionary_encode(), rows.to_numpy(zero_copy_only=False)
            adopt(access)
            if rows_read is not None:
                rows_read.add(len(rows))
            at = names.indices.to_numpy(zero_copy_only=False)
            found = [(np.flatnonzero(at == i), p.as_py()) for i, p in enumerate(names.dictionary)]
            parts = [arrow_array(read_rows(p, path, rows[where]), kind) for where, p in found]
            out = pa.concat_arrays(parts) if len(parts) != 1 else parts[0]
            if len(parts) > 1:
                back = np.empty(len(rows), np.int64)
                back[np.concatenate([w for w, _ in found])] = np.arange(len(rows))
                out = out.take(pa.array(back))
            yield out

    return read


def row_bytes(file: File, column: Column) -> int:
    kind: HType = dataset(file, column.path).type
    return 0 if kind.is_string else kind.size * int(np.prod(column.inner, dtype=np.int64))


def read_range(columns: list[Column], filename: str | None, path: str, total: int, start: int, end: int, batch_bytes: int, rows_read=None) -> Iterator[pa.RecordBatch]:
    """Batches of all columns for the rows from start to end of a file of ``total`` rows."""
    file = opened(path)
    fixed = {c.name: scalar(path, c) for c in columns if c.kind == "scalar"}
    wide = sum(row_bytes(file, c) for c in columns if c.kind == "data")
    step = max(1, min(RANGE_ROWS, batch_bytes // max(wide, 1)))
    by_place = sorted((c for c in columns if c.kind == "data"), key=lambda c: dataset(file, c.path).place)
    names = [*[c.name for c in columns], *([filename] if filename else [])]
    for at in range(start, end, step):
        rows = np.arange(at, min(at + step, end))
        data = {c.name: arrow_array(read_rows(path, c.path, rows), c.type) for c in by_place}
        if rows_read is not None:
            rows_read.add(len(rows) * len(by_place))
        for c in columns:
            if c.kind == "index":
                data[c.name] = pa.array(rows)
            elif c.kind == "scalar":
                data[c.name] = pa.array([fixed[c.name]] * len(rows), arrow_type(c.type))
            elif c.kind == "runs":
                starts, behind, values = known_runs(file, c, total)
                run = run_of(rows, starts, behind)
                data[c.name] = values.take(pa.array(run, mask=run < 0))
        if filename:
            data[filename] = pa.array([path] * len(rows), pa.string())
        yield pa.RecordBatch.from_arrays([data[n] for n in names], names)


def full_scan(split: DataFrame, bound: Bound, batch_bytes: int, rows_read=None) -> DataFrame:
    columns, filename = bound.columns, bound.filename
    schema = ", ".join([*[f"`{c.name}` {c.type}" for c in columns], *([f"`{filename}` string"] if filename else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.to_pylist():
                yield from read_range(columns, filename, one["__path"], one["__rows"], one["__start"], one["__end"], batch_bytes, rows_read)

    return split.mapInArrow(with_access(run), schema)
