"""Writer of a subset of the HDF5 format: groups, links, attributes, and contiguous, compact or chunked datasets.

With ``latest`` object headers of the second kind and link messages are written, else the first kind and symbol
tables, which every version of the format reads.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field
from typing import Any

import numpy as np

UNDEFINED = 0xFFFFFFFFFFFFFFFF
LEAF_K, NODE_K = 32_767, 32


def checksum(data: bytes) -> int:
    """Jenkins' lookup3 hash, little-endian, as the format's second-kind structures use."""
    mask = 0xFFFFFFFF
    rot = lambda x, k: (x << k | x >> 32 - k) & mask
    a = b = c = 0xDEADBEEF + len(data) & mask
    full = max((len(data) - 1) // 12, 0) * 12
    for i in range(0, full, 12):
        x, y, z = struct.unpack_from("<3I", data, i)
        a, b, c = a + x & mask, b + y & mask, c + z & mask
        a = (a - c & mask) ^ rot(c, 4)
        c = c + b & mask
        b = (b - a & mask) ^ rot(a, 6)
        a = a + c & mask
        c = (c - b & mask) ^ rot(b, 8)
        b = b + a & mask
        a = (a - c & mask) ^ rot(c, 16)
        c = c + b & mask
        b = (b - a & mask) ^ rot(a, 19)
        a = a + c & mask
        c = (c - b & mask) ^ rot(b, 4)
        b = b + a & mask
    if not data:
        return c
    x, y, z = struct.unpack("<3I", data[full:].ljust(12, b"\0"))
    a, b, c = a + x & mask, b + y & mask, c + z & mask
    for p, q, k in (("c", "b", 14), ("a", "c", 11), ("b", "a", 25), ("c", "b", 16), ("a", "c", 4), ("b", "a", 14), ("c", "b", 24)):
        v = {"a": a, "b": b, "c": c}
        v[p] = (v[p] ^ v[q]) - rot(v[q], k) & mask
        a, b, c = v["a"], v["b"], v["c"]
    return c


@dataclass(frozen=True)
class Type:
    """An encoded datatype and how to encode values of it."""

    message: bytes
    size: int
    vlen: bool = False


def number(kind: str) -> Type:
    d = np.dtype(kind)
    order = 1 if d.str[0] == ">" else 0
    if d.kind in "iu":
        return Type(struct.pack("<B3BI2H", 0x10, order | (8 if d.kind == "i" else 0), 0, 0, d.itemsize, 0, 8 * d.itemsize), d.itemsize)
    exponent, mantissa = {2: (5, 10), 4: (8, 23), 8: (11, 52)}[d.itemsize]
    bits = order | 0x20
    return Type(struct.pack("<B3BI2H4BI", 0x11, bits, 8 * d.itemsize - 1, 0, d.itemsize, 0, 8 * d.itemsize, mantissa, exponent, 0, mantissa, (1 << exponent - 1) - 1), d.itemsize)


def fixed_string(size: int, pad: int = 1, utf8: bool = False) -> Type:
    return Type(struct.pack("<B3BI", 0x13, pad | (0x10 if utf8 else 0), 0, 0, size), size)


def vlen_string(utf8: bool = True) -> Type:
    base = struct.pack("<B3BI", 0x13, 0, 0, 0, 1)
    return Type(struct.pack("<B3BI", 0x19, 1, 1 if utf8 else 0, 0, 16) + base, 16, True)


def opaque(kind: int, size: int, tail: bytes = b"") -> Type:
    """A type of another class, for listings."""
    return Type(struct.pack("<B3BI", 0x10 | kind, 0, 0, 0, size) + tail, size)


def array_of(base: Type, dims: tuple[int, ...]) -> Type:
    size = base.size * int(np.prod(dims))
    tail = struct.pack("<B3x", len(dims)) + struct.pack(f"<{2 * len(dims)}I", *dims, *[0] * len(dims)) + base.message
    return Type(struct.pack("<B3BI", 0x2A, 0, 0, 0, size) + tail, size, base.vlen)


def type_of(value: np.ndarray) -> Type:
    if value.dtype.kind in "iuf":
        return number(value.dtype.str)
    if value.dtype.kind == "S":
        return fixed_string(max(value.dtype.itemsize, 1))
    return vlen_string()


@dataclass
class Node:
    attributes: dict[str, Any] = field(default_factory=dict)
    address: int = 0


@dataclass
class Group(Node):
    entries: dict[str, Any] = field(default_factory=dict)


@dataclass
class Data(Node):
    value: Any = None
    type: Type | None = None
    chunk: tuple[int, ...] | None = None
    deflate: int = 0
    shuffle: bool = False
    fletcher: bool = False
    compact: bool = False
    fill: Any = None
    shape: tuple[int, ...] | None = None  # of a dataset without stored values
    index: str = "btree1"  # or single, implicit, fixed, extensible, btree2
    most: tuple[int | None, ...] | None = None  # extents to grow to


@dataclass
class Named(Node):
    type: Type | None = None


@dataclass
class Soft:
    path: str


@dataclass
class External:
    file: str
    path: str


class Null:
    """A null space of a type."""

    def __init__(self, type: Type):
        self.type = type


class Writer:
    """Collects objects by path; ``close`` writes the file."""

    def __init__(self, path: str, latest: bool = False):
        self.path, self.latest = path, latest
        self.root = Group()
        self.out = bytearray()

    def group(self, path: str) -> Group:
        at = self.root
        for name in [p for p in path.split("/") if p]:
            at = at.entries.setdefault(name, Group())
        return at

    def put(self, path: str, node):
        parent, _, name = path.rstrip("/").rpartition("/")
        self.group(parent).entries[name] = node
        return node

    def dataset(self, path: str, value, **options) -> Data:
        if not isinstance(value, Null | np.ndarray) and value is not None:
            value = np.asarray(value)
            value = value.astype(object) if value.dtype.kind == "U" else value
        return self.put(path, Data(value=value, **options))

    def soft(self, path: str, target: str) -> None:
        self.put(path, Soft(target))

    def external(self, path: str, file: str, target: str) -> None:
        self.put(path, External(file, target))

    # encoding

    def add(self, data: bytes, align: int = 8) -> int:
        self.out += b"\0" * (-len(self.out) % align)
        self.out += data
        return len(self.out) - len(data)

    def encode(self, value: np.ndarray, kind: Type) -> bytes:
        if not kind.vlen:
            return np.ascontiguousarray(value).tobytes() if isinstance(value, np.ndarray) else bytes(value)
        texts = [v.encode() if isinstance(v, str) else v for v in np.asarray(value, object).ravel()]
        places, n = [], 0
        for at in range(0, len(texts), 30_000):
            part, body = texts[at : at + 30_000], bytearray()  # bytes would be copied for each text
            for i, t in enumerate(part, 1):
                if t:
                    body += struct.pack("<HHIQ", i, 1, 0, len(t)) + t + b"\0" * (-len(t) % 8)
            size = max(16 + len(body) + 16, 4096)
            address = self.add(struct.pack("<4sB3xQ", b"GCOL", 1, size) + (body + struct.pack("<HHIQ", 0, 0, 0, size - 16 - len(body))).ljust(size - 16, b"\0"))
            places += [struct.pack("<IQI", len(t), address, i) if t else struct.pack("<IQI", 0, 0, 0) for i, t in enumerate(part, 1)]
            n += len(part)
        return b"".join(places)

    def space(self, dims: tuple[int, ...] | None, most: tuple[int | None, ...] | None = None) -> bytes:
        if dims is None:
            return struct.pack("<4B", 2, 0, 0, 2)
        if most:
            ends = [UNDEFINED if m is None else m for m in most]
            return struct.pack("<BBB5x", 1, len(dims), 1) + struct.pack(f"<{2 * len(dims)}Q", *dims, *ends)
        return struct.pack("<BBB5x", 1, len(dims), 0) + struct.pack(f"<{len(dims)}Q", *dims)

    def attribute(self, name: str, value) -> bytes:
        kind = None
        if isinstance(value, tuple) and len(value) == 2 and isinstance(value[1], Type):
            value, kind = value
        if isinstance(value, Null):
            kind, dims, data = value.type, None, b""
        elif isinstance(value, bytes) and kind is not None:
            dims, data = (), value
        else:
            value = np.asarray(value)
            value = value.astype(object) if value.dtype.kind == "U" else value
            kind = kind or type_of(value)
            dims, data = value.shape, self.encode(value, kind)
            if len(kind.message) > 8 and kind.message[0] & 15 == 10:  # the last axes are the type's own
                dims = value.shape[: value.ndim - kind.message[8]]
        pad = lambda b: b + b"\0" * (-len(b) % 8)
        label, space = name.encode() + b"\0", self.space(dims)
        return struct.pack("<BBHHH", 1, 0, len(label), len(kind.message), len(space)) + pad(label) + pad(kind.message) + pad(space) + data

    def header(self, messages: list[tuple[int, bytes]]) -> int:
        if self.latest:
            body = b"".join(struct.pack("<BHB", k, len(d), 0) + d for k, d in messages)
            data = b"OHDR" + struct.pack("<BBI", 2, 2, len(body)) + body
            return self.add(data + struct.pack("<I", checksum(data)))
        body = b"".join(struct.pack("<HHB3x", k, len(d) + -len(d) % 8, 0) + d + b"\0" * (-len(d) % 8) for k, d in messages)
        return self.add(struct.pack("<BxHII4x", 1, len(messages), 1, len(body)) + body)

    def tree(self, kind: int, entries: list[tuple[bytes, int]], last: bytes, level: int = 0) -> int:
        """A version 1 tree over (key, child); ``last`` is the key behind all."""
        most, nodes = 2 * NODE_K, []
        for at in range(0, max(len(entries), 1), most):
            part = entries[at : at + most]
            after = entries[at + most][0] if at + most < len(entries) else last
            body = b"".join(k + struct.pack("<Q", c) for k, c in part) + after
            data = struct.pack("<4sBBHQQ", b"TREE", kind, level, len(part), UNDEFINED, UNDEFINED) + body
            nodes.append((part[0][0] if part else last, self.add(data.ljust(24 + most * 8 + (most + 1) * len(last), b"\0"))))
        return nodes[0][1] if len(nodes) == 1 else self.tree(kind, nodes, last, level + 1)

    def write_data(self, node: Data) -> list[tuple[int, bytes]]:
        null = isinstance(node.value, Null)
        kind = node.type or (node.value.type if null else type_of(node.value))
        dims = None if null else node.shape if node.value is None else node.value.shape
        fill = b"" if node.fill is None else np.asarray(node.fill).tobytes()
        out = [(1, self.space(dims, node.most)), (3, kind.message), (5, struct.pack("<4BI", 2, 2, 2, 1, len(fill)) + fill)]
        data = b"" if node.value is None or null else self.encode(node.value, kind)
        if node.compact:
            return [*out, (8, struct.pack("<BBH", 3, 0, len(data)) + data)]
        if node.chunk is None or not dims:
            return [*out, (8, struct.pack("<BBQQ", 3, 1, self.add(data) if data else UNDEFINED, len(data)))]
        filters = []
        if node.shuffle:
            filters.append(struct.pack("<HHHH2I", 2, 0, 0, 1, kind.size, 0))
        if node.deflate:
            filters.append(struct.pack("<HHHH2I", 1, 0, 0, 1, node.deflate, 0))
        if node.fletcher:
            filters.append(struct.pack("<HHHH", 3, 0, 0, 0))
        address = UNDEFINED
        if node.index != "btree1":
            out.append((8, self.indexed(node, kind, dims, data, bool(filters))))
        elif data:
            entries = []
            for start, raw in self.blocks(node, kind, dims, data):
                entries.append((struct.pack(f"<II{len(dims) + 1}Q", len(raw), 0, *start, 0), self.add(raw)))
            end = tuple(-(-d // c) * c for d, c in zip(dims, node.chunk, strict=True))
            address = self.tree(1, entries, struct.pack(f"<II{len(dims) + 1}Q", 0, 0, *end, kind.size))
        if node.index == "btree1":
            out.append((8, struct.pack(f"<BBBQ{len(dims) + 1}I", 3, 2, len(dims) + 1, address, *node.chunk, kind.size)))
        return [*out, (11, struct.pack("<BB6x", 1, len(filters)) + b"".join(filters))] if filters else out

    def blocks(self, node: Data, kind: Type, dims: tuple[int, ...], data: bytes):
        """(offset, filtered bytes) of each chunk."""
        values = np.frombuffer(data, np.dtype((np.void, kind.size))).reshape(dims)
        for place in np.ndindex(*[-(-d // c) for d, c in zip(dims, node.chunk, strict=True)]):
            start = tuple(p * c for p, c in zip(place, node.chunk, strict=True))
            block = np.zeros(node.chunk, values.dtype)
            part = values[tuple(slice(s, s + c) for s, c in zip(start, node.chunk, strict=True))]
            block[tuple(slice(0, n) for n in part.shape)] = part
            raw = block.tobytes()
            if node.shuffle:
                raw = np.frombuffer(raw, np.uint8).reshape(-1, kind.size).T.tobytes()
            if node.deflate:
                raw = zlib.compress(raw, node.deflate)
            if node.fletcher:
                raw += b"\0\0\0\0"
            yield start, raw

    def sealed(self, data: bytes) -> int:
        return self.add(data + struct.pack("<I", checksum(data)))

    def indexed(self, node: Data, kind: Type, dims: tuple[int, ...], data: bytes, filtered: bool) -> bytes:
        """The layout message of the newer kind, with its chunk index."""
        found = list(self.blocks(node, kind, dims, data))
        head = struct.pack("<BBBBB", 4, 2, 2 if node.index == "single" and filtered else 0, len(dims) + 1, 4) + struct.pack(f"<{len(dims) + 1}I", *node.chunk, kind.size)
        if node.index == "single":
            ((_, raw),) = found
            return head + b"\x01" + (struct.pack("<QI", len(raw), 0) if filtered else b"") + struct.pack("<Q", self.add(raw))
        if node.index == "implicit":
            return head + b"\x02" + struct.pack("<Q", self.add(b"".join(raw for _, raw in found)))
        entry = lambda raw: struct.pack("<Q", self.add(raw)) + (struct.pack("<II", len(raw), 0) if filtered else b"")
        width = 16 if filtered else 8
        none = struct.pack("<Q", UNDEFINED) + bytes(width - 8)
        if node.index == "btree2":
            records = [entry(raw) + struct.pack(f"<{len(dims)}Q", *[s // c for s, c in zip(start, node.chunk, strict=True)]) for start, raw in found]
            size, kind_ = width + 8 * len(dims), 11 if filtered else 10
            bytes_ = 10 + size * len(records)
            leaf = self.sealed(struct.pack("<4sBB", b"BTLF", 0, kind_) + b"".join(records))
            tree = self.sealed(struct.pack("<4sBBIHHBBQHQ", b"BTHD", 0, kind_, bytes_, size, 0, 100, 40, leaf, len(records), len(records)))
            return head + b"\x05" + struct.pack("<IBB", bytes_, 100, 40) + struct.pack("<Q", tree)
        most = node.most or dims
        # The dimension without a bound is numbered first.
        grows = most.index(None) if None in most else 0
        order = [grows, *[i for i in range(len(dims)) if i != grows]]
        grid = [-(-(dims[i] if most[i] is None else most[i]) // node.chunk[i]) for i in order]
        slots = [none] * int(np.prod(grid))
        for start, raw in found:
            slots[int(np.ravel_multi_index([start[i] // node.chunk[i] for i in order], grid))] = entry(raw)
        if node.index == "fixed":
            return head + b"\x03" + struct.pack("<BQ", 2, self.fixed_array(slots, width, filtered, 2))
        return head + b"\x04" + struct.pack("<5B", 32, 4, 4, 16, 3) + struct.pack("<Q", self.extensible_array(slots, width, filtered))

    def fixed_array(self, slots: list[bytes], width: int, filtered: bool, bits: int) -> int:
        page = 1 << bits
        at = len(self.out) + -len(self.out) % 8
        block = at + 32  # behind the header of 28 bytes
        header = struct.pack("<4sBBBBQQ", b"FAHD", 0, filtered, width, bits, len(slots), block)
        self.sealed(header)
        data = struct.pack("<4sBBQ", b"FADB", 0, filtered, at)
        if len(slots) <= page:
            where = self.sealed(data + b"".join(slots))
        else:
            pages = [slots[i : i + page] for i in range(0, len(slots), page)]
            bitmap = bytearray(-(-len(pages) // 8))
            for i, p in enumerate(pages):
                if any(not s.startswith(b"\xff" * 8) for s in p):
                    bitmap[i // 8] |= 128 >> i % 8
            data += bytes(bitmap)
            data += struct.pack("<I", checksum(data))
            for p in pages:
                body = b"".join(p)
                data += body + struct.pack("<I", checksum(body))
            where = self.add(data)
        if where != block:
            raise ValueError("misplaced")
        return at

    def extensible_array(self, slots: list[bytes], width: int, filtered: bool) -> int:
        bits, in_index, least, pointers, page_bits = 32, 4, 16, 4, 3
        page, n_super = 1 << page_bits, 1 + bits - 4
        plan = [(1 << (s // 2), least << ((s + 1) // 2)) for s in range(n_super)]
        at = self.add(bytes(72))  # the header, filled in at the end
        none = struct.pack("<Q", UNDEFINED) + bytes(width - 8)
        rest, done = slots[in_index:], in_index

        def block(part: list[bytes], n: int, offset: int) -> int:
            part = part + [none] * (n - len(part))
            data = struct.pack("<4sBBQI", b"EADB", 0, filtered, at, offset)
            if n <= page:
                return self.sealed(data + b"".join(part))
            data += struct.pack("<I", checksum(data))
            for i in range(0, n, page):
                body = b"".join(part[i : i + page])
                data += body + struct.pack("<I", checksum(body))
            return self.add(data)

        direct, supers, offset = [], [], 0
        for s, (blocks, n) in enumerate(plan):
            places = []
            for _ in range(blocks):
                places.append(block(rest[:n], n, offset) if rest else UNDEFINED)
                done += n if rest else 0
                offset += n
                rest = rest[n:]
            if s < 4:
                direct += places
            elif places[0] == UNDEFINED:
                supers.append(UNDEFINED)
            else:
                bitmap = b"\xff" * (blocks * -(-(n // page) // 8) if n > page else 0)
                supers.append(self.sealed(struct.pack("<4sBBQI", b"EASB", 0, filtered, at, offset) + bitmap + struct.pack(f"<{blocks}Q", *places)))
        index = struct.pack("<4sBBQ", b"EAIB", 0, filtered, at) + b"".join(slots[:in_index] + [none] * (in_index - len(slots)))
        where = self.sealed(index + struct.pack(f"<{len(direct) + len(supers)}Q", *direct, *supers))
        head = struct.pack("<4sBB6B", b"EAHD", 0, filtered, width, bits, in_index, least, pointers, page_bits) + struct.pack("<7Q", 0, 0, 0, 0, len(slots), done, where)
        self.out[at : at + 72] = head + struct.pack("<I", checksum(head))
        return at

    def write(self, node) -> int:
        if node.address:
            return node.address
        if isinstance(node, Group):
            messages = self.write_group(node)
        elif isinstance(node, Data):
            messages = self.write_data(node)
        else:
            messages = [(3, node.type.message)]
        messages += [(12, self.attribute(k, v)) for k, v in node.attributes.items()]
        if node.address:  # a group that holds itself has its place already
            raise ValueError("cycles need soft links")
        node.address = self.header(messages)
        return node.address

    def write_group(self, node: Group) -> list[tuple[int, bytes]]:
        names = sorted(node.entries, key=str.encode)
        hard = {n: self.write(e) for n, e in node.entries.items() if not isinstance(e, Soft | External)}
        if self.latest:
            out = [(2, struct.pack("<BBQQ", 0, 0, UNDEFINED, UNDEFINED)), (10, b"\0\0")]
            for n in names:
                e, label = node.entries[n], n.encode()
                head = lambda k: struct.pack("<BBBH", 1, 9, k, len(label)) + label  # noqa: B023, E731
                if n in hard:
                    out.append((6, struct.pack("<BBH", 1, 1, len(label)) + label + struct.pack("<Q", hard[n])))
                elif isinstance(e, Soft):
                    out.append((6, head(1) + struct.pack("<H", len(e.path.encode())) + e.path.encode()))
                else:
                    value = b"\0" + e.file.encode() + b"\0" + e.path.encode() + b"\0"
                    out.append((6, head(64) + struct.pack("<H", len(value)) + value))
            return out
        heap, places = bytearray(8), {}

        def text(t: str) -> int:
            at = len(heap)
            heap.extend(t.encode() + b"\0" * (8 - len(t.encode()) % 8))
            return at

        entries = b""
        for n in names:
            e, places[n] = node.entries[n], text(n)
            if n in hard:
                entries += struct.pack("<QQII16x", places[n], hard[n], 0, 0)
            elif isinstance(e, Soft):
                entries += struct.pack("<QQIII12x", places[n], UNDEFINED, 2, 0, text(e.path))
            else:
                raise ValueError("external links need latest=True")
        segment = self.add(bytes(heap))
        local = self.add(struct.pack("<4sB3xQQQ", b"HEAP", 0, len(heap), UNDEFINED, segment))
        nodes = [(struct.pack("<Q", 0), self.add(struct.pack("<4sBxH", b"SNOD", 1, len(names)) + entries))] if names else []
        tree = self.tree(0, nodes, struct.pack("<Q", places[names[-1]] if names else 0))
        return [(17, struct.pack("<QQ", tree, local))]

    def close(self) -> None:
        self.out = bytearray(96)
        root = self.write(self.root)
        end = len(self.out)
        if self.latest:
            head = b"\x89HDF\r\n\x1a\n" + struct.pack("<4B4Q", 2, 8, 8, 0, 0, UNDEFINED, end, root)
            head += struct.pack("<I", checksum(head))
        else:
            head = b"\x89HDF\r\n\x1a\n" + struct.pack("<8B2HI4Q", 0, 0, 0, 0, 0, 8, 8, 0, LEAF_K, NODE_K, 0, 0, UNDEFINED, end, UNDEFINED)
            head += struct.pack("<QQII16x", 0, root, 0, 0)
        self.out[: len(head)] = head
        with open(self.path, "wb") as f:
            f.write(self.out)
