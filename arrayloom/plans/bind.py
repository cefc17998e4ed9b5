"""Binding of a read on the driver: column specs of every file, their schemas compared, row counts, row ranges."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from arrayloom.format.reader import File, Object
from arrayloom.functions.definitions import Index, Runs, unwrap
from arrayloom.model import INTEGER, ArrayFileError
from arrayloom.sources.bytesource import with_access
from arrayloom.sources.paths import expand

#: Rows of a row range, at most; a range is read by one task and numbered by one array.
RANGE_ROWS = 1 << 16
MOST_RANK = 4
#: Files that the driver opens by itself.
BIND_HERE = 16


@dataclass(frozen=True)
class Column:
    """A column of one file. ``same`` is what must agree in all files."""

    name: str
    kind: str  # data, scalar, runs or index
    type: str  # of Spark
    path: str = ""
    boundaries: str = ""
    ends: bool = False
    inner: tuple[int, ...] = ()

    @property
    def same(self) -> tuple:
        return self.name, self.kind, self.type, self.inner, self.ends


@dataclass
class BoundFile:
    path: str
    ordinal: int
    rows: int
    columns: list[Column]


@dataclass
class Bound:
    files: list[BoundFile] = field(default_factory=list)
    filename: str | None = None

    @property
    def columns(self) -> list[Column]:
        return self.files[0].columns


def dataset(file: File, path: str) -> Object:
    found = file.resolve(path)
    if found is None or found.kind != "dataset":
        raise ArrayFileError(f"Failed to open dataset: {path} in file: {file.path}")
    return found


def last_part(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2] or "data"


def bind_column(file: File, definition) -> tuple[Column, int | None]:
    """A column, and the rows it has if they count for the file's."""
    name, d = unwrap(definition)
    if d is None:
        raise ArrayFileError("read dataset path must not be NULL")
    if isinstance(d, Index):
        return Column(name or "index", "index", "bigint"), None
    if isinstance(d, Runs):
        if d.boundaries is None or d.values is None:
            raise ArrayFileError("read dataset path must not be NULL")
        bounds, values = dataset(file, d.boundaries), dataset(file, d.values)
        if bounds.type.kind != INTEGER:
            raise ArrayFileError(f"{d.what} must be integer type: {d.boundaries} in file: {file.path}")
        return Column(name or last_part(d.values), "runs", values.type.spark(), d.values, d.boundaries, d.ends), None
    if not isinstance(d, str):
        raise ArrayFileError("read dataset path arguments must be a string, rse(), ree(), index(), or alias(...)")
    found = dataset(file, d)
    name, kind, dims = name or last_part(d), found.type.spark(), found.space.dims
    if not dims:
        return Column(name, "scalar", kind, d), None
    if len(dims) > MOST_RANK:
        raise ArrayFileError(f"Datasets with more than 4 dimensions are not currently supported: {d} in file: {file.path}")
    if len(dims) > 1 and found.type.is_string:
        raise ArrayFileError(f"String datasets with more than 1 dimension are not supported: {d} in file: {file.path}")
    for _ in dims[1:]:
        kind = f"array<{kind}>"
    return Column(name, "data", kind, d, inner=dims[1:]), dims[0]


def bind_file(path: str, ordinal: int, definitions: tuple) -> BoundFile:
    file = File(path)
    try:
        found = [bind_column(file, d) for d in definitions]
    finally:
        file.close()
    columns = [c for c, _ in found]
    names = [c.name.lower() for c in columns]
    for i, n in enumerate(names):
        if n in names[:i]:
            raise ArrayFileError(f'read has duplicate column name "{columns[i].name}"')
    if not any(c.kind in ("data", "scalar") for c in columns):
        raise ArrayFileError("read requires at least one regular column")
    rows = [n for _, n in found if n is not None]
    if not rows and any(c.kind == "runs" for c in columns):
        raise ArrayFileError("read requires at least one non-scalar regular column when using run-encoded columns to determine row count")
    return BoundFile(path, ordinal, min(rows, default=1), columns)


def bind_far(spark, paths: list[str], definitions: tuple, first: BoundFile) -> list[BoundFile]:
    """The other files, opened by tasks: only row counts, and what is wrong with a file, come back."""
    same = [c.same for c in first.columns]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for one in batch.to_pylist():
                rows, wrong = None, None
                try:
                    found = bind_file(one["path"], one["ordinal"], definitions)
                    rows = found.rows
                    if [c.same for c in found.columns] != same:
                        wrong = f"read matched file '{one['path']}' with an incompatible schema"
                except ArrayFileError as e:
                    wrong = str(e)
                yield pa.RecordBatch.from_pylist([{"ordinal": one["ordinal"], "rows": rows, "wrong": wrong}], pa.schema([("ordinal", pa.int32()), ("rows", pa.int64()), ("wrong", pa.string())]))

    listed = spark.createDataFrame(list(enumerate(paths))[1:], "ordinal int, path string")
    tasks = max(1, min(len(paths) - 1, 4 * spark.sparkContext.defaultParallelism))
    found = sorted(listed.repartition(tasks).mapInArrow(with_access(run), "ordinal int, rows long, wrong string").collect())
    for r in found:
        if r.wrong is not None:
            raise ArrayFileError(r.wrong)
    return [BoundFile(paths[r.ordinal], r.ordinal, r.rows, first.columns) for r in found]


def bind(files, definitions: tuple, filename: bool | str | None = False, spark=None) -> Bound:
    """Every file is opened, the first here and many others by tasks of ``spark``; their columns must be those of the first."""
    bound = Bound(filename=filename_column(filename))
    paths = expand(files, "read")
    bound.files.append(bind_file(paths[0], 0, definitions))
    if spark is not None and len(paths) > BIND_HERE:
        bound.files += bind_far(spark, paths, definitions, bound.files[0])
        paths = paths[:1]
    for i, path in enumerate(paths[1:], 1):
        one = bind_file(path, i, definitions)
        if [c.same for c in one.columns] != [c.same for c in bound.columns]:
            raise ArrayFileError(f"read matched file '{path}' with an incompatible schema")
        bound.files.append(one)
    if bound.filename and bound.filename.lower() in [c.name.lower() for c in bound.columns]:
        raise ArrayFileError(f'Option filename adds column "{bound.filename}", but that column name is already present in read output')
    return bound


def filename_column(option: bool | str | None) -> str | None:
    if option is None:
        raise ArrayFileError('Cannot use NULL as argument for "filename"')
    return "filename" if option is True else option or None


def checked_runs(file: File, column: Column) -> tuple[np.ndarray, Object]:
    """Boundaries and values of a run-encoded column, checked in the order: ranks, sizes, order."""
    from arrayloom.format.values import numbers

    bounds, values = dataset(file, column.boundaries), dataset(file, column.path)
    what = "REE run_ends" if column.ends else "RSE run_starts"
    for x, label, path in ((bounds, what, column.boundaries), (values, what[:3] + " values", column.path)):
        if len(x.space.dims or ()) != 1:
            raise ArrayFileError(f"{label} must be a 1-dimensional dataset: {path} in file: {file.path}")
    n, m = bounds.space.dims[0], values.space.dims[0]
    if n != m:
        raise ArrayFileError(f"{what} and values must have same size. Got {n} and {m} for {what.split()[1]} dataset: {column.boundaries}, values dataset: {column.path} in file: {file.path}")
    b = numbers(bounds.raw_rows(0, n), bounds.type)
    if (b[1:] < b[:-1]).any():
        raise ArrayFileError(f"{what} must be in non-decreasing order: {column.boundaries} in file: {file.path}")
    return b, values
