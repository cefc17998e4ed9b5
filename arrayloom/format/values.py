"""Python and numpy values of stored elements: numbers, strings and nested lists, with the format's string rules."""

from __future__ import annotations

import struct
from typing import Any

import numpy as np

from arrayloom.format.reader import Attribute, File
from arrayloom.model import ARRAY, FLOAT, INTEGER, STRING, ArrayFileError, HType, Space


class BadText(Exception):
    """Bytes that are not text of the declared character set."""


def cut(raw: bytes, pad: int) -> bytes:
    """A fixed string without its padding."""
    if pad == 0:
        return raw.split(b"\0", 1)[0]
    return raw.rstrip(b"\0") if pad == 1 else raw.rstrip(b" ")


def text(raw: bytes, utf8: bool) -> str:
    try:
        return raw.decode("utf-8" if utf8 else "ascii")
    except UnicodeDecodeError as e:
        raise BadText from e


def vlen_bytes(file: File, raw: bytes) -> bytes | None:
    """The bytes a variable-length element points at; None for a null pointer."""
    n, address = struct.unpack_from("<IQ", raw)
    (index,) = struct.unpack_from("<I", raw, 12)
    return file.global_heap(address, index)[:n] if address else None


def numbers(raw: np.ndarray, kind: HType) -> np.ndarray:
    """Numbers in the machine's byte order; half precision is widened, integers of fewer bits than their bytes have are too."""
    out = np.ascontiguousarray(raw).view(kind.numpy()).reshape(raw.shape)
    out = out.astype(out.dtype.newbyteorder("="), copy=False)
    if kind.kind == INTEGER and 0 < kind.precision < 8 * kind.size:
        # Up to the top, dropping what is above, and back down, which repeats the sign.
        out = out << out.dtype.type(8 * kind.size - kind.precision - kind.offset) >> out.dtype.type(8 * kind.size - kind.precision)
    return out.astype(np.float32) if kind.kind == FLOAT and kind.size == 2 else out


def strings(file: File, raw: np.ndarray, kind: HType, path: str) -> np.ndarray:
    """Texts of a dataset: a null pointer is an empty text, bad bytes are an error."""
    out = np.empty(raw.size, object)
    for i, x in enumerate(raw.ravel()):
        b = x.tobytes()
        b = (vlen_bytes(file, b) or b"") if kind.vlen_string else cut(b, kind.pad)
        try:
            out[i] = text(b, kind.utf8)
        except BadText:
            raise ArrayFileError(f"Invalid unicode (byte sequence mismatch) detected in dataset: {path} in file: {file.path}") from None
    return out.reshape(raw.shape)


def decode(file: File, raw: np.ndarray, kind: HType, path: str) -> np.ndarray:
    kind.spark()  # an error for types without one
    return strings(file, raw, kind, path) if kind.is_string else numbers(raw, kind)


def attribute_type(kind: HType, space: Space) -> str:
    """The Spark type of an attribute's value."""
    inner = kind
    depth = 0
    if kind.kind == ARRAY:
        if len(kind.dims) != 1:
            raise ArrayFileError(f"Only 1D array attributes are supported, found {len(kind.dims)}D array")
        inner, depth = kind.base, 1
    if space.dims and len(space.dims) > 4:
        raise ArrayFileError("Attributes with more than 4 dimensions are not supported")
    depth += len(space.dims or ())
    out = inner.spark()
    for _ in range(depth):
        out = f"array<{out}>"
    return out


def attribute_value(file: File, a: Attribute, blobs: bool, path: str) -> Any:
    """Nested lists of an attribute; with ``blobs`` text that can't be decoded stays bytes, else it is an error."""
    attribute_type(a.type, a.space)
    if a.space.dims is None:
        return None
    kind, dims = a.type, a.space.dims
    if kind.kind == ARRAY:
        kind, dims = kind.base, (*dims, *kind.dims)
    n = int(np.prod(dims, dtype=np.int64))
    raw = np.frombuffer(a.data[: n * kind.size], np.dtype((np.void, kind.size)))
    if kind.is_string:
        flat: list[Any] = []
        for x in raw:
            whole = x.tobytes()
            b = vlen_bytes(file, whole) if kind.vlen_string else cut(whole, kind.pad)
            try:
                flat.append(None if b is None else text(b, kind.utf8))
            except BadText:
                if not blobs:
                    raise ArrayFileError(f"Invalid unicode (byte sequence mismatch) detected in value construction in object: {path} in file: {file.path}") from None
                flat.append(b if kind.vlen_string else whole)
    else:
        flat = numbers(raw, kind).tolist()

    def nest(values: list, dims: tuple[int, ...]) -> Any:
        if not dims:
            return values[0]
        step = len(values) // dims[0] if dims[0] else 0
        return [nest(values[i * step : (i + 1) * step], dims[1:]) if len(dims) > 1 else values[i] for i in range(dims[0])]

    return nest(flat, dims)


def element(kind: HType) -> HType:
    return kind.base if kind.kind == ARRAY else kind


# Variants

METADATA = b"\x01\x00\x00"  # version 1, no field names


def variant_bytes(value: Any, kind: HType | None = None) -> bytes:
    """The binary form of a value; ``kind`` tells the width of its numbers."""
    if value is None:
        return b"\x00"
    if isinstance(value, str):
        b = value.encode()
        return bytes([len(b) << 2 | 1]) + b if len(b) < 64 else bytes([16 << 2]) + struct.pack("<I", len(b)) + b
    if isinstance(value, bytes):
        return bytes([15 << 2]) + struct.pack("<I", len(value)) + value
    if isinstance(value, list):
        items = [variant_bytes(v, kind) for v in value]
        ends = np.cumsum([0, *map(len, items)]).tolist()
        width = 1 if ends[-1] < 256 else 2 if ends[-1] < 1 << 16 else 4
        large = len(items) > 255
        head = bytes([(large << 2 | width - 1) << 2 | 3]) + len(items).to_bytes(4 if large else 1, "little")
        return head + b"".join(e.to_bytes(width, "little") for e in ends) + b"".join(items)
    if kind is not None and kind.kind == FLOAT or isinstance(value, float):
        return bytes([7 << 2]) + struct.pack("<d", value) if kind is None or kind.size == 8 else bytes([14 << 2]) + struct.pack("<f", value)
    value = int(value)
    widest = 64 if kind is None else 8 * kind.size * (1 if kind.signed else 2)
    if kind is not None and kind.kind == INTEGER and kind.size == 8 and not kind.signed:
        return bytes([10 << 2, 0]) + value.to_bytes(16, "little", signed=True)
    for code, bits in ((3, 8), (4, 16), (5, 32), (6, 64)):
        if bits >= widest:
            return bytes([code << 2]) + value.to_bytes(bits // 8, "little", signed=True)
    raise ArrayFileError(f"No variant for {value!r}")


def variant(value: Any, kind: HType | None = None):
    from pyspark.sql.types import VariantVal

    return None if value is None else VariantVal(variant_bytes(value, kind), METADATA)


__all__ = ["STRING", "attribute_type", "attribute_value", "decode", "element", "variant"]
