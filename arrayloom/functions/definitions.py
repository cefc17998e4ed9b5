"""What a caller may ask of a file: columns stored as runs, the row index, attributes, and other names for them."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from arrayloom.model import ArrayFileError


@dataclass(frozen=True)
class Runs:
    """A column stored as run boundaries and one value for each run."""

    boundaries: str
    values: str
    ends: bool = False

    @property
    def what(self) -> str:
        return "REE run_ends" if self.ends else "RSE run_starts"


@dataclass(frozen=True)
class Index:
    """The row's number within its file."""


@dataclass(frozen=True)
class Alias:
    name: str
    definition: Any


@dataclass(frozen=True)
class Attr:
    """An attribute as a column: all of them as a map without a name, else one, with a default of a given type."""

    name: str | None = None
    default: Any = None
    type: str | None = None


def rse(run_starts: str, values: str) -> Runs:
    """Runs by their first rows; the last one reaches to the end."""
    return Runs(run_starts, values)


def ree(run_ends: str, values: str) -> Runs:
    """Runs by their last rows."""
    return Runs(run_ends, values, ends=True)


def index() -> Index:
    return Index()


def alias(name: str, definition: Any) -> Alias:
    """Another name for a definition; of nested ones the outermost holds."""
    if name is None:
        raise ArrayFileError("alias name must not be NULL")
    return Alias(name, definition)


def attr(*args, type: str | None = None) -> Attr:
    """``attr()`` for all attributes, ``attr(name)`` for a variant, ``attr(name, default, type=...)`` for a typed one."""
    if not args:
        return Attr()
    if args[0] is None:
        raise ArrayFileError("attr name must not be NULL")
    if len(args) == 1:
        return Attr(args[0], None, type or "variant")
    default = args[1]
    if type is None:
        known = {bool: "boolean", int: "bigint", float: "double", str: "string", bytes: "binary"}
        if default is None or default.__class__ not in known:
            raise ArrayFileError("attr default value must have a concrete type; give type=")
        type = known[default.__class__]
    return Attr(args[0], default, type)


def unwrap(definition: Any) -> tuple[str | None, Any]:
    """(outermost other name, definition)."""
    name = None
    while isinstance(definition, Alias):
        name = definition.name if name is None else name
        definition = definition.definition
    return name, definition
