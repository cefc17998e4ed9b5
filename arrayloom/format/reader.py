"""Reader of the HDF5 file format, from its public specification: superblocks 0 to 3, both kinds of object headers and groups, all common storage layouts."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

from arrayloom.format.packed import nbit, scaled
from arrayloom.model import ARRAY, ENUM, FLOAT, INTEGER, STRING, VLEN, ArrayFileError, HType, Space
from arrayloom.sources.bytesource import open_bytes

SIGNATURE = b"\x89HDF\r\n\x1a\n"
#: Numbers of the header messages.
DATASPACE, LINK_INFO, DATATYPE, OLD_FILL, FILL, LINK, LAYOUT, FILTERS, ATTRIBUTE, CONTINUATION, SYMBOLS, ATTRIBUTE_INFO = 1, 2, 3, 4, 5, 6, 8, 11, 12, 16, 17, 21


class Cursor:
    """Little-endian fields of a run of bytes."""

    def __init__(self, data: bytes, at: int = 0, offsets: int = 8, lengths: int = 8):
        self.data, self.at, self.offsets, self.lengths = data, at, offsets, lengths

    def uint(self, n: int) -> int:
        self.at += n
        return int.from_bytes(self.data[self.at - n : self.at], "little")

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n : self.at]

    def address(self) -> int | None:
        v = self.uint(self.offsets)
        return None if v == (1 << 8 * self.offsets) - 1 else v

    def length(self) -> int:
        return self.uint(self.lengths)


@dataclass
class Link:
    """A name in a group: hard with an address, soft with a path, or external with a file and a path."""

    name: str
    kind: str
    address: int | None = None
    path: str = ""
    file: str = ""


@dataclass
class Chunk:
    offset: tuple[int, ...]
    address: int
    size: int
    mask: int = 0


@dataclass
class Attribute:
    name: str
    type: HType
    space: Space
    data: bytes


@dataclass
class Layout:
    kind: str  # compact, contiguous or chunked
    address: int | None = None
    size: int = 0
    data: bytes = b""
    chunk: tuple[int, ...] = ()
    index: str = "btree1"
    detail: dict = field(default_factory=dict)


class File:
    """An open file; objects are had by their address or path."""

    def __init__(self, path: str):
        self.path = path
        self.source = open_bytes(path)
        try:
            self.read_superblock()
        except BaseException:
            self.source.close()
            raise
        self.objects: dict[int, Object] = {}
        self.heaps: dict[int, bytes] = {}

    def read_superblock(self) -> None:
        path = self.path
        at = 0
        while True:
            if at + 8 > self.source.size:
                raise ArrayFileError(f"Failed to open HDF5 file: {path}")
            if self.source.read(at, 8) == SIGNATURE:
                break
            at = at * 2 if at else 512
        head = self.source.read(at, min(160, self.source.size - at))
        version = head[8]
        self.offsets = self.lengths = 8
        if version in (0, 1):
            self.offsets, self.lengths = head[13], head[14]
            c = self.cursor(head, 24 if version == 0 else 28)
            c.address()
            c.at += 3 * self.offsets
            c.at += self.offsets  # name of the root's entry
            self.root_address = c.address()
        elif version in (2, 3):
            self.offsets, self.lengths = head[9], head[10]
            c = self.cursor(head, 12)
            c.address()
            c.at += 2 * self.offsets
            self.root_address = c.address()
        else:
            raise ArrayFileError(f"Unsupported superblock version {version} in file: {path}")
        self.base = at  # addresses count from the superblock, wherever the file has moved it

    def cursor(self, data: bytes, at: int = 0) -> Cursor:
        return Cursor(data, at, self.offsets, self.lengths)

    def read(self, address: int, n: int) -> bytes:
        return self.source.read(self.base + address, n)

    def close(self) -> None:
        self.source.close()

    def object(self, address: int) -> Object:
        if address not in self.objects:
            self.objects[address] = Object(self, address)
        return self.objects[address]

    @property
    def root(self) -> Object:
        return self.object(self.root_address)

    def resolve(self, path: str, start: Object | None = None, depth: int = 0) -> Object | None:
        """The object at a path, soft links followed; None if there is none or an external link is on the way."""
        if depth > 32:
            return None
        at = self.root if path.startswith("/") or start is None else start
        for name in [p for p in path.split("/") if p and p != "."]:
            link = at.links_by_name.get(name)
            if link is None:
                return None
            if link.kind == "hard":
                at = self.object(link.address)
            elif link.kind == "soft":
                at = self.resolve(link.path, at, depth + 1)
                if at is None:
                    return None
            else:
                return None
        return at

    def global_heap(self, address: int, index: int) -> bytes:
        key = address, index
        if key not in self.heaps:
            size = self.cursor(self.read(address, 8 + self.lengths), 8).length()
            c = self.cursor(self.read(address, size), 8 + self.lengths)
            while c.at + 8 + self.lengths <= size:
                i = c.uint(2)
                c.at += 6
                n = c.length()
                if i == 0:
                    break
                self.heaps[address, i] = c.data[c.at : c.at + n]
                c.at += (n + 7) // 8 * 8
            if len(self.heaps) > 100_000:
                self.heaps = {key: self.heaps.get(key, b"")}
        return self.heaps.get(key, b"")

    # B-trees

    def btree2(self, address: int) -> Iterator[bytes]:
        """All records of a version 2 tree, in order."""
        c = self.cursor(self.read(address, 18 + self.offsets + self.lengths), 6)
        node, size, depth = c.uint(4), c.uint(2), c.uint(2)
        c.at += 2
        root, n = c.address(), c.uint(2)
        if root is None:
            return
        wide = lambda v: (max(v, 1).bit_length() + 7) // 8
        most = [(node - 10) // size]
        totals, total_bytes = [most[0]], [0]
        for d in range(1, depth + 1):
            pointer = self.offsets + wide(most[0]) + (total_bytes[d - 1] if d > 1 else 0)
            most.append((node - 10 - pointer) // (size + pointer))
            totals.append((most[d] + 1) * totals[d - 1] + most[d])
            total_bytes.append(wide(totals[d]))

        def walk(at: int, n: int, d: int) -> Iterator[bytes]:
            c = self.cursor(self.read(at, node), 6)
            records = [c.take(size) for _ in range(n)]
            if d == 0:
                yield from records
                return
            for i in range(n + 1):
                child, m = c.address(), c.uint(wide(most[0]))
                if d > 1:
                    c.at += total_bytes[d - 1]
                yield from walk(child, m, d - 1)
                if i < n:
                    yield records[i]

        yield from walk(root, n, depth)

    def btree1(self, address: int | None, key_size: int) -> Iterator[tuple[int, list[bytes], list[int]]]:
        """(level, keys, children) of one node of a version 1 tree."""
        c = self.cursor(self.read(address, 8 + 2 * self.offsets), 4)
        c.at += 1
        level, used = c.uint(1), c.uint(2)
        body = self.cursor(self.read(address + 8 + 2 * self.offsets, used * (key_size + self.offsets) + key_size))
        keys, children = [], []
        for _ in range(used):
            keys.append(body.take(key_size))
            children.append(body.address())
        return level, keys, children


class FractalHeap:
    """Objects of a group's or object's dense storage."""

    def __init__(self, file: File, address: int):
        self.file = file
        c = file.cursor(file.read(address, 22 + 12 * file.lengths + 3 * file.offsets), 5)
        self.id_size, filters, self.flags, self.max_managed = c.uint(2), c.uint(2), c.uint(1), c.uint(4)
        c.length()
        self.huge = c.address()
        self.huge_objects: dict[int, tuple[int, int]] | None = None
        c.length()
        c.address()
        for _ in range(8):
            c.length()
        self.width, self.start, self.max_direct, self.bits = c.uint(2), c.length(), c.length(), c.uint(2)
        c.uint(2)
        self.root, self.rows = c.address(), c.uint(2)
        if filters:
            raise ArrayFileError("Filtered heaps are not supported")
        self.offset_size = (self.bits + 7) // 8
        least = min(self.max_direct, self.max_managed)
        self.length_size = (least.bit_length() + 7) // 8

    def row_size(self, row: int) -> int:
        return self.start if row < 2 else self.start << (row - 1)

    def find(self, offset: int, at: int, base: int, rows: int) -> tuple[int, int]:
        """(address, heap offset) of the direct block that holds ``offset``."""
        if rows == 0:
            return at, base
        f = self.file
        direct_rows = self.max_direct.bit_length() - self.start.bit_length() + 2
        c = f.cursor(f.read(at, 5 + f.offsets + self.offset_size + rows * self.width * f.offsets), 5 + f.offsets + self.offset_size)
        for row in range(rows):
            size = self.row_size(row)
            for _ in range(self.width):
                child = c.address()
                if base <= offset < base + size:
                    if row < direct_rows:
                        return child, base
                    inner = size.bit_length() - (self.start * self.width).bit_length() + 1
                    return self.find(offset, child, base, inner)
                base += size
        raise ArrayFileError("Broken heap")

    def huge_place(self, heap_id: bytes) -> tuple[int, int]:
        """(address, bytes) of an object outside the heap's blocks: in the id where that has room, else in a tree by number."""
        f = self.file
        c = f.cursor(heap_id, 1)
        if self.id_size - 1 >= f.offsets + f.lengths:
            return c.address(), c.length()
        if self.huge_objects is None:
            self.huge_objects = {}
            for r in f.btree2(self.huge):
                own = f.cursor(r)
                place = own.address(), own.length()
                self.huge_objects[own.length()] = place
        return self.huge_objects[c.uint(min(self.id_size - 1, 8))]

    def get(self, heap_id: bytes) -> bytes:
        kind = heap_id[0] >> 4 & 3
        if kind == 2:  # tiny: in the id itself
            return heap_id[1 : 2 + (heap_id[0] & 15)]
        if kind == 1:
            return self.file.read(*self.huge_place(heap_id))
        c = Cursor(heap_id, 1)
        offset, size = c.uint(self.offset_size), c.uint(self.length_size)
        block, base = self.find(offset, self.root, 0, self.rows)
        return self.file.read(block + offset - base, size)


def parse_type(file: File, data: bytes, at: int = 0) -> tuple[HType, int]:
    """The datatype at a place, and where it ends."""
    kind, version = data[at] & 15, data[at] >> 4
    bits = int.from_bytes(data[at + 1 : at + 4], "little")
    size = int.from_bytes(data[at + 4 : at + 8], "little")
    end = at + 8
    if kind == INTEGER:
        offset, precision = struct.unpack_from("<HH", data, end)
        return HType(kind, size, signed=bool(bits & 8), big=bool(bits & 1), offset=offset, precision=precision), end + 4
    if kind == FLOAT:
        return HType(kind, size, signed=True, big=bool(bits & 1)), end + 12
    if kind == STRING:
        return HType(kind, size, pad=bits & 15, utf8=bits >> 4 & 15 == 1), end
    if kind == VLEN:
        base, end = parse_type(file, data, end)
        return HType(kind, size, vlen_string=bits & 15 == 1, pad=bits >> 4 & 15, utf8=bits >> 8 & 15 == 1, base=base), end
    if kind == ARRAY:
        rank = data[end]
        end += 1 if version >= 3 else 4
        dims = struct.unpack_from(f"<{rank}I", data, end)
        end += 4 * rank * (1 if version >= 3 else 2)
        base, end = parse_type(file, data, end)
        return HType(kind, size, base=base, dims=dims), end
    if kind == ENUM:
        base, end = parse_type(file, data, end)
        return HType(kind, size, base=base), end
    return HType(kind, size), end


def parse_space(data: bytes, lengths: int) -> Space:
    version, rank = data[0], data[1]
    if version == 2 and data[3] == 2:
        return Space(None)
    c = Cursor(data, 8 if version == 1 else 4, lengths=lengths)
    dims = tuple(c.length() for _ in range(rank))
    if not data[2] & 1:
        return Space(dims)
    none = (1 << 8 * lengths) - 1
    return Space(dims, tuple(None if m == none else m for m in (c.length() for _ in range(rank))))


class Object:
    """A group, dataset or named datatype: its header's messages, read on first use."""

    def __init__(self, file: File, address: int):
        self.file, self.address = file, address

    @cached_property
    def messages(self) -> list[tuple[int, bytes]]:
        f = self.file
        head = f.read(self.address, 16)
        out: list[tuple[int, int, bytes]] = []
        if head[:4] == b"OHDR":
            flags = head[5]
            at = self.address + 6 + (16 if flags & 0x20 else 0) + (4 if flags & 0x10 else 0)
            width = 1 << (flags & 3)
            size = int.from_bytes(f.read(at, width), "little")
            todo, extra, version = [(at + width, size)], 2 if flags & 4 else 0, 2
        elif head[0] == 1:
            todo, extra, version = [(self.address + 16, int.from_bytes(head[8:12], "little"))], 0, 1
        else:
            raise ArrayFileError(f"Broken object header in file: {f.path}")
        while todo:
            at, size = todo.pop(0)
            c = f.cursor(f.read(at, size))
            least = 8 if version == 1 else 4 + extra
            while c.at + least <= size:
                if version == 1:
                    kind, n, flags = c.uint(2), c.uint(2), c.uint(1)
                    c.at += 3
                else:
                    kind, n, flags = c.uint(1), c.uint(2), c.uint(1)
                    c.at += extra
                data = c.take(n)
                if kind == CONTINUATION:
                    m = f.cursor(data)
                    start, length = m.address(), m.length()
                    todo.append((start, length) if version == 1 else (start + 4, length - 8))
                else:
                    out.append((kind, flags, data))
        return [(k, self.shared(k, d) if flags & 2 else d) for k, flags, d in out]

    def shared(self, kind: int, data: bytes) -> bytes:
        """What a message stands for that is kept in another object's header."""
        c = self.file.cursor(data, 2)
        if data[0] == 1:
            c.at = 8
        elif data[0] == 3 and data[1] == 1:
            raise ArrayFileError("Messages in a shared heap are not supported")
        return self.file.object(c.address()).message(kind) or b""

    def message(self, kind: int) -> bytes | None:
        return next((d for k, d in self.messages if k == kind), None)

    @cached_property
    def kind(self) -> str:
        kinds = {k for k, _ in self.messages}
        if LAYOUT in kinds:
            return "dataset"
        if SYMBOLS in kinds or LINK_INFO in kinds or LINK in kinds:
            return "group"
        return "datatype" if DATATYPE in kinds else "group"

    # groups

    @cached_property
    def links(self) -> list[Link]:
        f, out = self.file, []
        for kind, data in self.messages:
            if kind == SYMBOLS:
                c = f.cursor(data)
                out += self.symbol_links(c.address(), c.address())
            elif kind == LINK:
                out.append(self.parse_link(data))
            elif kind == LINK_INFO:
                c = f.cursor(data, 2 + (8 if data[1] & 1 else 0))
                heap, names = c.address(), c.address()
                if heap is not None and names is not None:
                    store = FractalHeap(f, heap)
                    out += [self.parse_link(store.get(r[4 : 4 + store.id_size])) for r in f.btree2(names)]
        return sorted(out, key=lambda x: x.name.encode("utf-8", "surrogateescape"))

    @cached_property
    def links_by_name(self) -> dict[str, Link]:
        return {x.name: x for x in self.links} if self.kind == "group" else {}

    def symbol_links(self, tree: int, heap: int) -> list[Link]:
        f = self.file
        c = f.cursor(f.read(heap, 8 + 2 * f.lengths + f.offsets), 8)
        size = c.length()
        c.length()
        names = f.read(c.address(), size)
        text = lambda at: names[at : names.index(b"\0", at)].decode("utf-8", "surrogateescape")
        out, todo = [], [tree]
        while todo:
            level, _, children = f.btree1(todo.pop(), f.lengths)
            if level:
                todo += children
                continue
            for node in children:
                n = int.from_bytes(f.read(node + 6, 2), "little")
                entry = 2 * f.offsets + 24
                c = f.cursor(f.read(node + 8, n * entry))
                for i in range(n):
                    c.at = i * entry
                    name, address, cache = c.uint(f.offsets), c.address(), c.uint(4)
                    c.at += 4
                    out.append(Link(text(name), "soft", path=text(c.uint(4))) if cache == 2 else Link(text(name), "hard", address))
        return out

    def parse_link(self, data: bytes) -> Link:
        flags = data[1]
        c = self.file.cursor(data, 2)
        kind = c.uint(1) if flags & 8 else 0
        c.at += (8 if flags & 4 else 0) + (1 if flags & 16 else 0)
        name = c.take(c.uint(1 << (flags & 3))).decode("utf-8", "surrogateescape")
        if kind == 0:
            return Link(name, "hard", c.address())
        value = c.take(c.uint(2))
        if kind == 1:
            return Link(name, "soft", path=value.decode("utf-8", "surrogateescape"))
        if kind == 64:
            file, path = value[1:].split(b"\0")[:2]
            return Link(name, "external", path=path.decode(), file=file.decode())
        return Link(name, "unknown")

    # attributes

    @cached_property
    def attributes(self) -> list[Attribute]:
        """All attributes, by name."""
        f = self.file
        found = [self.parse_attribute(d) for k, d in self.messages if k == ATTRIBUTE]
        info = self.message(ATTRIBUTE_INFO)
        if info:
            c = f.cursor(info, 2 + (2 if info[1] & 1 else 0))
            heap, names = c.address(), c.address()
            if heap is not None and names is not None:
                store = FractalHeap(f, heap)
                found += [self.parse_attribute(store.get(r[: store.id_size])) for r in f.btree2(names)]
        return sorted(found, key=lambda a: a.name.encode("utf-8", "surrogateescape"))

    def parse_attribute(self, data: bytes) -> Attribute:
        version, flags = data[0], data[1]
        n_name, n_type, n_space = struct.unpack_from("<3H", data, 2)
        at = 8 + (version == 3)
        pad = (lambda n: (n + 7) // 8 * 8) if version == 1 else lambda n: n
        name = data[at : at + n_name].split(b"\0")[0].decode("utf-8", "surrogateescape")
        at += pad(n_name)
        kind = data[at : at + n_type]
        at += pad(n_type)
        space = data[at : at + n_space]
        at += pad(n_space)
        if version > 1 and flags & 1:
            kind = self.shared(DATATYPE, kind)
        if version > 1 and flags & 2:
            space = self.shared(DATASPACE, space)
        return Attribute(name, parse_type(self.file, kind)[0], parse_space(space, self.file.lengths), data[at:])

    # datasets

    @cached_property
    def type(self) -> HType:
        return parse_type(self.file, self.message(DATATYPE))[0]

    @cached_property
    def space(self) -> Space:
        return parse_space(self.message(DATASPACE), self.file.lengths)

    @cached_property
    def filters(self) -> list[tuple[int, tuple[int, ...]]]:
        data = self.message(FILTERS)
        if not data:
            return []
        c, out = Cursor(data, 8 if data[0] == 1 else 2), []
        for _ in range(data[1]):
            number = c.uint(2)
            name = c.uint(2) if data[0] == 1 or number >= 256 else 0
            c.at += 2
            values = c.uint(2)
            c.at += (name + 7) // 8 * 8 if data[0] == 1 else name
            out.append((number, tuple(c.uint(4) for _ in range(values))))
            if data[0] == 1 and values % 2:
                c.at += 4
        return out

    @cached_property
    def fill(self) -> bytes:
        """One element of the fill value; zeros where none is set."""
        none = bytes(self.type.size)
        data = self.message(FILL)
        if data:
            if data[0] == 3:
                return data[6 : 6 + struct.unpack_from("<I", data, 2)[0]] if data[1] & 0x20 else none
            if data[0] == 1 or data[3]:
                n = struct.unpack_from("<I", data, 4)[0]
                return data[8 : 8 + n] if n else none
            return none
        data = self.message(OLD_FILL)
        return data[4 : 4 + struct.unpack_from("<I", data)[0]] or none if data else none

    @cached_property
    def layout(self) -> Layout:
        f, data = self.file, self.message(LAYOUT)
        version = data[0]
        if version in (1, 2):
            rank, kind = data[1], data[2]
            c = f.cursor(data, 8)
            address = c.address() if kind else None
            dims = [c.uint(4) for _ in range(rank)]
            if kind == 0:
                return Layout("compact", data=c.take(c.uint(4)))
            if kind == 1:
                return Layout("contiguous", address, self.space.count * self.type.size)
            return Layout("chunked", address, chunk=tuple(dims[: len(self.space.dims)]))
        kind, c = data[1], f.cursor(data, 2)
        if kind == 0:
            return Layout("compact", data=c.take(c.uint(2)))
        if kind == 1:
            return Layout("contiguous", c.address(), c.length())
        if kind != 2:
            raise ArrayFileError(f"Unsupported storage layout in file: {f.path}")
        if version == 3:
            rank, address = c.uint(1), c.address()
            return Layout("chunked", address, chunk=tuple(c.uint(4) for _ in range(rank - 1)))
        flags, rank, width = c.uint(1), c.uint(1), c.uint(1)
        dims = tuple(c.uint(width) for _ in range(rank))[:-1]
        index, detail = c.uint(1), {"flags": flags}
        if index == 1 and flags & 2:
            detail |= {"size": c.length(), "mask": c.uint(4)}
        elif index in (3, 4, 5):
            c.at += {3: 1, 4: 5, 5: 6}[index]
        name = {1: "single", 2: "implicit", 3: "fixed", 4: "extensible", 5: "btree2"}[index]
        return Layout("chunked", c.address(), chunk=dims, index=name, detail=detail)

    def chunks(self, first: int, last: int) -> Iterator[Chunk]:
        """The stored chunks with rows in [first, last)."""
        f, lay, dims = self.file, self.layout, self.space.dims
        if lay.address is None:
            return
        size = self.type.size * int(np.prod(lay.chunk))
        grid = [-(-d // c) for d, c in zip(dims, lay.chunk, strict=True)]
        if lay.index == "btree1":
            rank = len(dims)
            todo = [lay.address]
            while todo:
                level, keys, children = f.btree1(todo.pop(), 8 + 8 * (rank + 1))
                starts = [struct.unpack_from(f"<{rank}Q", k, 8) for k in keys]
                for i, child in enumerate(children):
                    if starts[i][0] >= last:
                        break
                    if level:
                        # The next key begins the next child: a child before the rows can be passed by.
                        if i + 1 < len(children) and starts[i + 1][0] + lay.chunk[0] <= first and starts[i + 1][0] < first:
                            continue
                        todo.append(child)
                    elif starts[i][0] + lay.chunk[0] > first:
                        n, mask = struct.unpack_from("<II", keys[i])
                        yield Chunk(starts[i], child, n, mask)
        elif lay.index == "single":
            yield Chunk((0,) * len(dims), lay.address, lay.detail.get("size", size), lay.detail.get("mask", 0))
        elif lay.index == "btree2":
            for r in f.btree2(lay.address):
                c = f.cursor(r)
                address = c.address()
                width = len(r) - f.offsets - 4 - 8 * len(dims)
                n, mask = (c.uint(width), c.uint(4)) if self.filters else (size, 0)
                start = tuple(c.uint(8) * d for d in lay.chunk)
                if start[0] < last and start[0] + lay.chunk[0] > first:
                    yield Chunk(start, address, n, mask)
        else:
            # Chunks are numbered by the extents that the dataset may grow to, the one without a bound first.
            most = self.space.most or dims
            free = [i for i, m in enumerate(most) if m is None]
            if len(free) > 1:
                raise ArrayFileError(f"Broken chunk index: two dimensions without a bound in file: {f.path}")
            grows = free[0] if free else 0
            order = [grows, *[i for i in range(len(dims)) if i != grows]]
            grid = [grid[i] if most[i] is None or i == grows == 0 else -(-most[i] // lay.chunk[i]) for i in order]
            per_row = int(np.prod(grid[1:], dtype=np.int64))
            lo, hi = (0, grid[0] * per_row) if grows else (first // lay.chunk[0] * per_row, min(grid[0], -(-last // lay.chunk[0])) * per_row)
            for number, (address, n, mask) in zip(range(lo, hi), self.array_entries(lo, hi, size), strict=False):
                if address is not None:
                    at = dict(zip(order, np.unravel_index(number, grid), strict=True))
                    place = tuple(int(at[i]) * c for i, c in enumerate(lay.chunk))
                    if place[0] < last and place[0] + lay.chunk[0] > first and all(p < d for p, d in zip(place, dims, strict=True)):
                        yield Chunk(place, address, n, mask)

    def array_entries(self, lo: int, hi: int, size: int) -> Iterator[tuple[int | None, int, int]]:
        """(address, bytes, filter mask) of chunks lo to hi of an implicit, fixed or extensible array."""
        f, lay = self.file, self.layout
        if lay.index == "implicit":
            yield from ((lay.address + i * size, size, 0) for i in range(lo, hi))
            return
        filtered = bool(self.filters)

        def entries(data: bytes, width: int) -> Iterator[tuple[int | None, int, int]]:
            c = f.cursor(data)
            while c.at + width <= len(data):
                address = c.address()
                yield (address, c.uint(width - f.offsets - 4), c.uint(4)) if filtered else (address, size, 0)

        if lay.index == "fixed":
            c = f.cursor(f.read(lay.address, 8 + f.lengths + f.offsets), 6)
            width, page_bits, total, block = c.uint(1), c.uint(1), c.length(), c.address()
            if block is None:
                return
            body, page = block + 6 + f.offsets, 1 << page_bits
            if total <= page:
                yield from entries(f.read(body + lo * width, (hi - lo) * width), width)
                return
            pages = -(-total // page)
            bitmap = f.read(body, -(-pages // 8))
            body += len(bitmap) + 4
            for number in range(lo, hi):
                p, i = divmod(number, page)
                if bitmap[p // 8] >> (7 - p % 8) & 1:
                    yield from entries(f.read(body + p * (page * width + 4) + i * width, width), width)
                else:
                    yield None, 0, 0
            return
        yield from list(self.extensible_entries(entries))[lo:hi]

    def extensible_entries(self, entries) -> Iterator[tuple[int | None, int, int]]:
        f = self.file
        c = f.cursor(f.read(self.layout.address, 12 + 6 * f.lengths + f.offsets), 6)
        width, bits, in_index, least, pointers, page_bits = (c.uint(1) for _ in range(6))
        for _ in range(5):
            c.length()
        total, index = c.length(), c.address()
        if index is None:
            return
        # Super blocks in turn double the number of data blocks, or the elements of each.
        n_super = 1 + bits - (least.bit_length() - 1)
        plan = [(1 << (s // 2), least << ((s + 1) // 2)) for s in range(n_super)]  # (blocks, elements of each)
        direct = 2 * (pointers.bit_length() - 1)  # super blocks whose data blocks the index points at
        n_direct = sum(plan[s][0] for s in range(direct))
        n_rest = n_super - direct
        offset_size, page = (bits + 7) // 8, 1 << page_bits
        c = f.cursor(f.read(index, 6 + f.offsets + in_index * width + (n_direct + n_rest) * f.offsets), 6 + f.offsets)
        yield from entries(c.take(in_index * width), width)
        done = in_index

        def block(address: int | None, n: int, written: bytes | None, bit: int) -> Iterator[tuple[int | None, int, int]]:
            if address is None:
                yield from ((None, 0, 0) for _ in range(n))
                return
            at = address + 6 + f.offsets + offset_size
            if n <= page:
                yield from entries(f.read(at, n * width), width)
                return
            at += 4
            for p in range(n // page):
                if written is None or written[(bit + p) // 8] >> (7 - (bit + p) % 8) & 1:
                    yield from entries(f.read(at + p * (page * width + 4), page * width), width)
                else:
                    yield from ((None, 0, 0) for _ in range(page))

        blocks = [(c.address(), plan[s][1]) for s in range(direct) for _ in range(plan[s][0])]
        rest = [c.address() for _ in range(n_rest)]
        for address, n in blocks:
            if done >= total:
                return
            yield from block(address, n, None, 0)
            done += n
        for s, address in enumerate(rest, direct):
            if done >= total:
                return
            n_blocks, n = plan[s]
            if address is None:
                yield from ((None, 0, 0) for _ in range(n_blocks * n))
            else:
                bitmap = n_blocks * (-(-(n // page) // 8)) if n > page else 0
                inner = f.cursor(f.read(address, 6 + f.offsets + offset_size + bitmap + n_blocks * f.offsets), 6 + f.offsets + offset_size)
                written = inner.take(bitmap) or None
                for i in range(n_blocks):
                    yield from block(inner.address(), n, written, i * (n // page))
            done += n_blocks * n

    def unfiltered(self, chunk: Chunk) -> bytes:
        data = self.file.read(chunk.address, chunk.size)
        if self.layout.detail.get("flags", 0) & 1 and any(o + c > d for o, c, d in zip(chunk.offset, self.layout.chunk, self.space.dims, strict=True)):
            return data  # chunks beyond the extent are stored as they are
        for i, (number, values) in reversed(list(enumerate(self.filters))):
            if chunk.mask >> i & 1:
                continue
            if number == 1:
                data = zlib.decompress(data)
            elif number == 2:
                size = values[0] if values else self.type.size
                n = len(data) // size
                data = np.frombuffer(data[: n * size], np.uint8).reshape(size, n).T.tobytes() + data[n * size :]
            elif number == 3:
                data = data[:-4]
            elif number == 5:
                data = nbit(data, values, self.file.path)
            elif number == 6:
                data = scaled(data, values, self.file.path)
            else:
                raise ArrayFileError(f"Unsupported filter {number} in file: {self.file.path}")
        return data

    def raw_rows(self, first: int, last: int) -> np.ndarray:
        """Rows [first, last) as opaque elements in the dataset's shape; a scalar has the one row 0."""
        size, dims, lay = self.type.size, self.space.dims, self.layout
        kind = np.dtype((np.void, size))
        if dims == ():
            data = lay.data if lay.kind == "compact" else self.file.read(lay.address, size) if lay.kind == "contiguous" and lay.address is not None else self.fill
            return np.frombuffer(data[:size], kind).reshape(())
        shape = (max(last - first, 0), *dims[1:])
        per_row = size * int(np.prod(dims[1:], dtype=np.int64))
        if lay.kind == "compact":
            return np.frombuffer(lay.data[first * per_row : last * per_row], kind).reshape(shape)
        if 0 in shape:
            return np.empty(shape, kind)
        if lay.kind == "contiguous" and lay.address is not None:
            return np.frombuffer(self.file.read(lay.address + first * per_row, (last - first) * per_row), kind).reshape(shape)
        out = np.empty(shape, kind)
        out[...] = np.frombuffer(self.fill, kind)[0]
        if lay.kind == "chunked":
            for c in sorted(self.chunks(first, last), key=lambda c: c.address):
                data = np.frombuffer(self.unfiltered(c), kind, count=int(np.prod(lay.chunk))).reshape(lay.chunk)
                a, b = max(c.offset[0], first), min(c.offset[0] + lay.chunk[0], last)
                inner = [slice(o, min(o + n, d)) for o, n, d in zip(c.offset[1:], lay.chunk[1:], dims[1:], strict=True)]
                part = data[(slice(a - c.offset[0], b - c.offset[0]), *[slice(0, s.stop - s.start) for s in inner])]
                out[(slice(a - first, b - first), *inner)] = part
        return out

    @property
    def place(self) -> int:
        """Where the data begin, for reading columns in the file's order."""
        return self.layout.address or 0
