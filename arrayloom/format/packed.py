"""Chunks that the format's N-bit and scale-offset filters have packed, by their public description."""

from __future__ import annotations

import struct

import numpy as np

from arrayloom.model import ArrayFileError

#: Fixed values of the format: classes of the N-bit filter's parameters, kinds of scaling.
ATOMIC, NBIT_ARRAY, COPIED = 1, 2, 4
DECIMAL, WHOLE = 0, 2
#: Where the packed values of a scale-offset chunk begin.
SCALED_AT = 21


def fields(data: bytes, n: int, width: int) -> np.ndarray:
    """n unsigned numbers of ``width`` bits each, the highest bit first, behind each other."""
    out = np.zeros((n, 64), np.uint8)
    out[:, 64 - width :] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    return np.packbits(out, axis=1).view(">u8").reshape(n).astype(np.uint64)


def stored(values: np.ndarray, size: int, big: bool) -> bytes:
    """The low ``size`` bytes of 64-bit numbers, in the dataset's byte order."""
    low = values.astype("<u8").view(np.uint8).reshape(len(values), 8)[:, :size]
    return np.ascontiguousarray(low[:, ::-1] if big else low).tobytes()


def nbit(data: bytes, values: tuple[int, ...], path: str) -> bytes:
    """The elements of a chunk of which only the significant bits are stored."""
    _, whole, count, kind, size, *rest = values
    if whole or kind == COPIED:
        return data
    if kind == NBIT_ARRAY:
        total, (kind, size, *rest) = size, rest
        count *= total // size
    if kind != ATOMIC or size > 8:
        raise ArrayFileError(f"Unsupported N-bit packing of a type in file: {path}")
    order, precision, offset = rest[:3]
    return stored(fields(data, count, precision) << np.uint64(offset), size, bool(order))


def scaled(data: bytes, values: tuple[int, ...], path: str) -> bytes:
    """The elements of a chunk that holds differences to its least value, or decimals of them."""
    way, factor, count, is_float, size, _, big, has_fill, *fill = values
    if way == WHOLE and factor == 8 * size:
        return data
    if way not in (DECIMAL, WHOLE):
        raise ArrayFileError(f"Unsupported way of scaling in file: {path}")
    (width,), least = struct.unpack_from("<I", data), data[5 : 5 + min(data[4], 8)].ljust(8, b"\0")
    if width >= 8 * size:
        raw = np.frombuffer(data, np.uint8, count * size, SCALED_AT).reshape(count, size)
        return np.ascontiguousarray(raw[:, ::-1] if big else raw).tobytes()
    steps = fields(data[SCALED_AT:], count, width)
    empty = struct.pack(f"<{len(fill)}I", *fill).ljust(8, b"\0")[:8]
    if is_float:
        kind = np.dtype(f"<f{size}")
        decimals = factor - (1 << 32) if factor >> 31 else factor
        real = steps.astype(kind) / kind.type(10.0**decimals) + np.frombuffer(least[:size], kind)[0]
        out = real.astype(kind).view(f"<u{size}").astype(np.uint64)
    else:
        out = steps + np.frombuffer(least, "<u8")[0]
    if has_fill:
        out = np.where(steps == (1 << width) - 1, np.frombuffer(empty, "<u8")[0], out)
    return stored(out, size, bool(big))
