"""Errors and types that the reader, the planner and the sources share."""

from __future__ import annotations

from dataclasses import dataclass


class ArrayFileError(Exception):
    """A file, object, type or argument that can't be read as asked."""


#: Class numbers of the format's datatypes.
INTEGER, FLOAT, TIME, STRING, BITFIELD, OPAQUE, COMPOUND, REFERENCE, ENUM, VLEN, ARRAY = range(11)


@dataclass(frozen=True)
class HType:
    """A datatype of the file: class, size in bytes and what the class needs."""

    kind: int
    size: int
    signed: bool = False
    big: bool = False
    pad: int = 0  # strings: 0 up to a NUL, 1 NULs at the end, 2 spaces at the end
    utf8: bool = False
    vlen_string: bool = False
    base: HType | None = None
    dims: tuple[int, ...] = ()
    #: Integers: the bits that count and where they begin; no precision stands for all bits.
    precision: int = 0
    offset: int = 0

    @property
    def is_string(self) -> bool:
        return self.kind == STRING or self.kind == VLEN and self.vlen_string

    @property
    def name(self) -> str:
        """The name that listings show."""
        if self.is_string:
            return "string"
        bits = 8 * self.size
        return {INTEGER: f"{'' if self.signed else 'u'}int{bits}", FLOAT: f"float{bits}", COMPOUND: "compound", ENUM: "enum", ARRAY: "array"}.get(self.kind, "unknown")

    def numpy(self) -> str:
        """The numpy code of a number."""
        order = ">" if self.big else "<"
        return f"{order}{'f' if self.kind == FLOAT else 'i' if self.signed else 'u'}{self.size}"

    def spark(self) -> str:
        """The Spark type of one element, or an error for types without one."""
        if self.is_string:
            return "string"
        if self.kind == INTEGER:
            known = {(1, True): "tinyint", (2, True): "smallint", (4, True): "int", (8, True): "bigint", (1, False): "smallint", (2, False): "int", (4, False): "bigint", (8, False): "decimal(20,0)"}
            if (self.size, self.signed) not in known:
                raise ArrayFileError(f"Unsupported {'signed' if self.signed else 'unsigned'} integer size: {self.size}")
            return known[self.size, self.signed]
        if self.kind == FLOAT:
            if self.size not in (2, 4, 8):
                raise ArrayFileError(f"Unsupported float size: {self.size}")
            return "double" if self.size == 8 else "float"
        raise ArrayFileError(f"Unsupported HDF5 type class: {self.kind}")


@dataclass(frozen=True)
class Space:
    """Extents of a dataset or attribute: None for a null space, () for a scalar."""

    dims: tuple[int, ...] | None
    #: Extents that the dataset may grow to, None for each without a bound; the same as dims where not given.
    most: tuple[int | None, ...] | None = None

    @property
    def count(self) -> int:
        out = 1
        for d in self.dims or ():
            out *= d
        return 0 if self.dims is None else out
