"""Functions of each row: a dataset's value, a group's entries or an object's attributes, by file and path columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from arrayloom.format.reader import File
from arrayloom.format.values import decode, variant
from arrayloom.functions.definitions import Attr
from arrayloom.functions.settings import LIMIT, memory_limit, setting
from arrayloom.model import ArrayFileError
from arrayloom.plans.bind import dataset
from arrayloom.sources.bytesource import with_access
from arrayloom.sources.listing import ROW, Attributes, _struct, all_attributes, ls_rows
from arrayloom.sources.scan import fresh, opened


def _file(path: str) -> File:
    return opened(path)


def retained_bytes(payload: int, elements: int, lists: int, text: bool) -> int:
    """Memory that a value keeps, by the number of its elements and of the lists around them."""
    return payload + 96 * elements + 32 * lists if text else payload + 16 * elements + 32 * lists


def read_value(limit: int | str | None = ""):
    """f(file, path) -> variant: a whole dataset as a nested array, a scalar as it is, a null space as null.

    ``limit`` bounds the memory of one value, three times what it keeps; if none is given, the session's setting does.
    """
    most = memory_limit(setting(None, LIMIT, "64MB") if limit == "" else limit)

    @F.udf("variant")
    @with_access
    def value(file: str | None, path: str | None):
        if file is None or path is None:
            return None
        f = _file(file)
        found = dataset(f, path)
        dims = found.space.dims
        if dims is None:
            return None
        found.type.spark()
        n = found.space.count
        lists = sum(int(np.prod(dims[:i], dtype=np.int64)) for i in range(len(dims)))
        if most is not None and 3 * retained_bytes(n * found.type.size, n, lists, found.type.is_string) > most:
            raise ArrayFileError(f"read_value memory limit exceeded for dataset {path} in file {file}: shape {list(dims)}")
        values = decode(f, found.raw_rows(0, dims[0] if dims else 1), found.type, path)
        return variant(values.tolist() if dims else values.reshape(-1)[0], found.type)

    return value


def ls_value(*attributes: Attr):
    """f(file, group) -> map of names to (path, type, dtype, shape, attributes)."""
    attrs = Attributes(attributes)

    @F.udf(f"map<string,struct<{','.join(_struct(ROW + attrs.schema))}>>")
    @with_access
    def entries(file: str | None, group: str | None):
        if file is None or group is None:
            return None
        return {r[0].rpartition("/")[2]: r for r in ls_rows(_file(file), group, attrs)}

    return entries


def ls_swmr_value(*attributes: Attr):
    """As ``ls_value``, of files that another process may be writing: each is opened anew."""
    attrs = Attributes(attributes)

    @F.udf(f"map<string,struct<{','.join(_struct(ROW + attrs.schema))}>>")
    @with_access
    def entries(file: str | None, group: str | None):
        if file is None or group is None:
            return None
        return {r[0].rpartition("/")[2]: r for r in ls_rows(fresh(file), group, attrs)}

    return entries


def attributes_value():
    """f(file, path) -> map of names to variants; null where one can't be read."""

    @F.udf("map<string,variant>")
    @with_access
    def found(file: str | None, path: str | None):
        if file is None or path is None:
            return None
        f = _file(file)
        own = f.resolve(path or "/")
        if own is None:
            raise ArrayFileError(f"Failed to open object: {path} in file: {file}")
        return all_attributes(f, own, path)

    return found
