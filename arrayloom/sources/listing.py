"""Listings of a file's groups and reads of attributes, as tables."""

from __future__ import annotations

import decimal
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrayloom.format.reader import File, Link, Object
from arrayloom.format.values import attribute_type, attribute_value, element, variant
from arrayloom.functions import settings
from arrayloom.functions.definitions import Attr, unwrap
from arrayloom.model import ArrayFileError
from arrayloom.plans.bind import BIND_HERE, filename_column
from arrayloom.sources.bytesource import with_access
from arrayloom.sources.paths import expand

FIXED = ("path", "type", "dtype", "shape")
ROW = "path string, type string, dtype string, shape array<bigint>"


def plain_value(value, kind: str):
    """A value in the Python form that Spark's type wants."""
    if value is None:
        return None
    if isinstance(value, list):
        return [plain_value(v, kind.removeprefix("array<").removesuffix(">")) for v in value]
    return decimal.Decimal(value) if kind.startswith("decimal") else value


def cast_value(value, kind: str, what: str):
    """A value as the type of a projected attribute's default; an error where it is none."""
    try:
        if value is None:
            return None
        if kind.startswith("array<"):
            if not isinstance(value, list):
                raise ValueError
            return [cast_value(v, kind[6:-1], what) for v in value]
        if isinstance(value, list):
            raise ValueError
        if kind in ("tinyint", "smallint", "int", "bigint"):
            out = round(value) if isinstance(value, float) else int(value)
            bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[kind]
            if not -(1 << bits - 1) <= out < 1 << bits - 1:
                raise ValueError
            return out
        if kind in ("float", "double"):
            return float(value)
        if kind.startswith("decimal"):
            return decimal.Decimal(value)
        if kind == "string":
            if isinstance(value, bytes):
                raise ValueError
            return value if isinstance(value, str) else repr(value) if isinstance(value, float) else str(value)
        if kind == "boolean":
            return bool(value)
        if kind == "binary":
            return value if isinstance(value, bytes) else str(value).encode()
    except (ValueError, TypeError, decimal.InvalidOperation):
        raise ArrayFileError(what) from None
    raise ArrayFileError(what)


class Attributes:
    """Projected attributes: their column names and types, and how they are read of an object."""

    def __init__(self, definitions: tuple, taken: tuple[str, ...] = FIXED):
        self.items: list[tuple[str, Attr]] = []
        seen = {n.lower() for n in taken}
        for d in definitions:
            name, a = unwrap(d)
            if not isinstance(a, Attr):
                raise ArrayFileError("projected attribute arguments must be attr(), attr(name), or attr(name, default), or an alias of one")
            name = name or a.name or "attr"
            if name.lower() in seen:
                raise ArrayFileError(f'duplicate column name "{name}" in listing')
            seen.add(name.lower())
            self.items.append((name, a))

    @property
    def schema(self) -> str:
        return "".join(f", `{n}` {'map<string,variant>' if a.name is None else a.type}" for n, a in self.items)

    def read(self, file: File, found: Object | None, path: str) -> list:
        out = []
        for _, a in self.items:
            if a.name is None:
                out.append(None if found is None else all_attributes(file, found, path))
                continue
            own = next((x for x in found.attributes if x.name == a.name), None) if found is not None else None
            if own is None:
                out.append(variant(a.default) if a.type == "variant" and not hasattr(a.default, "value") else a.default)
                continue
            try:
                attribute_type(own.type, own.space)
            except ArrayFileError as e:
                raise ArrayFileError(f"Attribute '{a.name}' has unsupported type: {e} in object: {path} in file: {file.path}") from None
            blobs = "variant" in a.type or "binary" in a.type
            value = attribute_value(file, own, blobs, path)
            what = f"Attribute '{a.name}' contains values that cannot be cast to {a.type} in object: {path} in file: {file.path}"
            out.append(variant(value, element(own.type)) if a.type == "variant" else cast_value(value, a.type, what))
        return out


def all_attributes(file: File, found: Object, path: str) -> dict:
    """Variants by name; what can't be read is None."""
    out = {}
    for a in found.attributes:
        try:
            out[a.name] = variant(attribute_value(file, a, True, path), element(a.type))
        except ArrayFileError:
            out[a.name] = None
    return out


def join(parent: str, name: str) -> str:
    return f"{parent.rstrip('/')}/{name}"


def target(file: File, link: Link, parent: Object) -> tuple[str | None, Object | None]:
    """(type shown, object) of a link: external ones are not opened, dangling ones are links."""
    if link.kind == "external":
        return "external", None
    if link.kind == "unknown":
        return None, None
    found = file.object(link.address) if link.kind == "hard" else file.resolve(link.path, parent)
    return ("link", None) if found is None else (found.kind, found)


def row(file: File, path: str, kind: str | None, found: Object | None, attrs: Attributes) -> tuple:
    data = found is not None and kind == "dataset"
    dims = found.space.dims if data else None
    return path, kind, found.type.name if data else None, None if dims is None else list(dims), *attrs.read(file, found, path)


def tree_rows(file: File, attrs: Attributes) -> Iterator[tuple]:
    """All paths below and with the root, depth first. A group met again on its own way down is shown, not entered."""
    yield row(file, "/", "group", file.root, attrs)
    todo = [("/", file.root, frozenset([file.root.address]))]
    while todo:
        path, group, above = todo.pop()
        for link in group.links:
            own = join(path, link.name)
            kind, found = target(file, link, group)
            yield row(file, own, kind, found, attrs)
            if kind == "group" and found.address not in above:
                todo.append((own, found, above | {found.address}))


def opened_group(file: File, group: str) -> tuple[str, Object]:
    path = "/" + (group or "/").strip("/")
    found = file.resolve(path)
    if found is None:
        raise ArrayFileError(f"Failed to open object: {group} in file: {file.path}")
    if found.kind != "group":
        raise ArrayFileError(f"Object is not a group: {group} in file: {file.path}")
    return path, found


def ls_rows(file: File, group: str, attrs: Attributes) -> Iterator[tuple]:
    path, found = opened_group(file, group)
    for link in found.links:
        kind, own = target(file, link, found)
        yield row(file, join(path, link.name), kind, own, attrs)


def listed(spark: SparkSession, files, what: str, rows_of, attrs: Attributes, filename) -> DataFrame:
    """One task for each file, behind the file names: a filter on the name keeps a file from being opened."""
    name = filename_column(filename)
    if name and name.lower() in [*FIXED, *[n.lower() for n, _ in attrs.items]]:
        raise ArrayFileError(f'Option filename adds column "{name}", but that column name is already present in {what} output')
    paths = expand(files, what)
    names = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "__file int, __path string").repartition(min(len(paths), 1_000))

    @F.udf(f"array<struct<{', '.join(_struct(ROW + attrs.schema))}>>")
    @with_access
    def entries(path: str) -> list[tuple]:
        file = File(path)
        try:
            return list(rows_of(file))
        finally:
            file.close()

    one = names.select("__path", F.explode(entries("__path")).alias("r"))
    visible = [F.col("__path").alias(name)] if name else []
    return one.select("r.*", *visible)


def _struct(schema: str) -> list[str]:
    out, depth, part = [], 0, ""
    for c in schema + ",":
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            name, _, kind = part.strip().rpartition(" ")
            out.append(f"{name}:{kind}")
            part = ""
        else:
            part += c
    return out


def tree(spark: SparkSession, files, *attributes, filename=False, swmr: bool | None = None) -> DataFrame:
    """Every path of every file: path, type, dtype, shape, and the asked for attributes. Files are opened anew, so ``swmr`` is accepted."""
    settings.swmr(spark, swmr)
    attrs = Attributes(attributes)
    return listed(spark, files, "tree", lambda file: tree_rows(file, attrs), attrs, filename)


def ls(spark: SparkSession, files, group: str | None = "/", *attributes, filename=False, swmr: bool | None = None) -> DataFrame:
    """The entries of one group of every file."""
    settings.swmr(spark, swmr)
    if group is None:
        raise ArrayFileError("ls path must not be NULL")
    attrs = Attributes(attributes)
    return listed(spark, files, "ls", lambda file: ls_rows(file, group, attrs), attrs, filename)


def first_far(spark: SparkSession, paths: list[str], wrong) -> str | None:
    """What is wrong with the first file that has something wrong; tasks open the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(one["ordinal"], wrong(one["path"])) for one in batch.to_pylist()]
            at, errors = zip(*[x for x in found if x[1] is not None], strict=True) if any(e for _, e in found) else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(errors, pa.string())], ["ordinal", "error"])

    listed = spark.createDataFrame(list(enumerate(paths)), "ordinal int, path string")
    tasks = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    first = listed.repartition(tasks).mapInArrow(with_access(run), "ordinal int, error string").orderBy("ordinal").first()
    return None if first is None else first.error


def attributes(spark: SparkSession, files, path: str | None, filename=False, swmr: bool | None = None) -> DataFrame:
    """One row for each file with the attributes of an object, which must be the same in all, by name."""
    settings.swmr(spark, swmr)
    if path is None:
        raise ArrayFileError("attributes path must not be NULL")
    path = path or "/"
    name = filename_column(filename)

    def schema_of(one: str) -> list[tuple[str, str]]:
        file = File(one)
        try:
            found = file.resolve(path)
            if found is None:
                raise ArrayFileError(f"Failed to open object: {path} in file: {one}")
            if not found.attributes:
                raise ArrayFileError(f"Object has no attributes: {path} in file: {one}")
            out = []
            for a in found.attributes:
                try:
                    out.append((a.name, attribute_type(a.type, a.space)))
                except ArrayFileError as e:
                    raise ArrayFileError(f"Attribute '{a.name}' has unsupported type: {e} in object: {path} in file: {one}") from None
            return out
        finally:
            file.close()

    paths = expand(files, "attributes")
    columns = schema_of(paths[0])

    def wrong(one: str) -> str | None:
        try:
            return None if schema_of(one) == columns else f"attributes matched file '{one}' with an incompatible attribute schema"
        except ArrayFileError as e:
            return str(e)

    if len(paths) > BIND_HERE:
        error = first_far(spark, paths[1:], wrong)
    else:
        error = next((e for e in map(wrong, paths[1:]) if e is not None), None)
    if error is not None:
        raise ArrayFileError(error)
    if name and name.lower() in [n.lower() for n, _ in columns]:
        raise ArrayFileError(f'Option filename adds column "{name}", but that column name is already present in attributes output')

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for one in batch["path"]:
                file = File(one)
                found = file.resolve(path)
                rows.append([*[plain_value(attribute_value(file, a, False, path), k) for a, (_, k) in zip(found.attributes, columns, strict=True)], one])
                file.close()
            yield pd.DataFrame(rows, columns=[*[f"c{i}" for i in range(len(columns))], "__path"]).astype(object)

    listed_ = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 1_000))
    schema = ", ".join([*[f"c{i} {k}" for i, (_, k) in enumerate(columns)], "__path string"])
    wide = listed_.mapInPandas(with_access(run), schema)
    visible = [F.col("__path").alias(name)] if name else []
    return wide.select(*[F.col(f"c{i}").alias(n) for i, (n, _) in enumerate(columns)], *visible)
