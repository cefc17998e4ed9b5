import struct

import numpy as np
import pytest

from arrayloom.format.packed import nbit, scaled
from arrayloom.format.reader import File, FractalHeap
from arrayloom.format.values import attribute_value, decode, numbers
from arrayloom.format.writer import Null, Soft, Writer, array_of, checksum, fixed_string, number, opaque, vlen_string
from arrayloom.model import INTEGER, ArrayFileError, HType


@pytest.fixture(params=[False, True], ids=["old", "latest"])
def made(request, tmp_path):
    def make(fill):
        w = Writer(str(tmp_path / "x.h5"), latest=request.param)
        fill(w)
        w.close()
        return File(w.path)

    return make


def rows(f, path, a=0, b=None):
    d = f.resolve(path)
    b = d.space.dims[0] if b is None and d.space.dims else b or 1
    return decode(f, d.raw_rows(a, b), d.type, path)


@pytest.mark.parametrize("kind", ["i1", "i2", "i4", "i8", "u1", "u2", "u4", "u8", "f2", "f4", "f8", ">i4", ">f8", ">u2"])
def test_numbers(made, kind):
    values = np.array([0, 1, 3, 100], kind)
    f = made(lambda w: w.dataset("/x", values))
    got = rows(f, "/x")
    assert got.tolist() == values.tolist() and got.dtype.isnative
    assert f.resolve("/x").type.name == f"{'float' if 'f' in kind else 'uint' if 'u' in kind else 'int'}{8 * values.dtype.itemsize}"


def test_greatest_unsigned(made):
    f = made(lambda w: w.dataset("/x", np.array([2**64 - 1], np.uint64)))
    assert int(rows(f, "/x")[0]) == 18446744073709551615


@pytest.mark.parametrize("chunk", [(2, 3, 2), (5, 4, 3), (1, 1, 1), (7, 8, 9)])
@pytest.mark.parametrize("options", [{}, {"deflate": 4}, {"shuffle": True, "deflate": 1}, {"fletcher": True}])
def test_chunks_and_filters(made, chunk, options):
    values = np.arange(60, dtype=np.int32).reshape(5, 4, 3)
    f = made(lambda w: w.dataset("/x", values, chunk=chunk, **options))
    for a, b in ((0, 5), (1, 4), (4, 5), (2, 2)):
        assert (rows(f, "/x", a, b) == values[a:b]).all()


@pytest.mark.parametrize("index", ["single", "implicit", "fixed", "extensible", "btree2"])
@pytest.mark.parametrize("deflate", [0, 1])
@pytest.mark.parametrize("rows", [1, 9, 700])
def test_newer_chunk_indexes(tmp_path, index, deflate, rows):
    if index == "implicit" and deflate:
        pytest.skip("only chunks without filters are implicit")
    values = np.arange(rows * 6, dtype=np.int32).reshape(rows, 6)
    chunk = (rows, 6) if index == "single" else (2, 4)
    most = {"extensible": (None, 9), "fixed": (rows + 5, 9)}.get(index)
    w = Writer(str(tmp_path / "x.h5"), latest=True)
    w.dataset("/x", values, chunk=chunk, deflate=deflate, index=index, most=most)
    w.close()
    f = File(w.path)
    for a, b in ((0, rows), (rows // 3, rows // 2), (rows - 1, rows)):
        assert (rows_of(f, a, b) == values[a:b]).all()


def rows_of(f, a, b):
    d = f.resolve("/x")
    return decode(f, d.raw_rows(a, b), d.type, "/x")


def test_many_chunks_need_a_tree_of_levels(made):
    values = np.arange(50_000, dtype=np.int64)
    f = made(lambda w: w.dataset("/x", values, chunk=(7,)))
    assert (rows(f, "/x", 12_345, 23_456) == values[12_345:23_456]).all()
    read = {c.offset[0] for c in f.resolve("/x").chunks(700, 714)}
    assert read == {700, 707}


def test_fill_values_compact_and_scalars(made):
    def fill(w):
        w.dataset("/f", None, type=number("<i2"), shape=(4, 2), chunk=(2, 2), fill=np.int16(-7))
        w.dataset("/c", np.arange(4, dtype="u1"), compact=True)
        w.dataset("/s", np.float32(3.5))
        w.dataset("/n", Null(number("<i4")))
        w.dataset("/e", np.empty((0, 3), "i4"))
        w.dataset("/z", np.empty((3, 0), "i4"))

    f = made(fill)
    assert (rows(f, "/f") == -7).all() and rows(f, "/f").shape == (4, 2)
    assert rows(f, "/c", 1, 3).tolist() == [1, 2]
    assert rows(f, "/s").tolist() == 3.5
    assert f.resolve("/n").space.dims is None
    assert rows(f, "/e").shape == (0, 3) and rows(f, "/z").shape == (3, 0)


def test_string_padding_and_character_sets(made):
    def fill(w):
        w.dataset("/term", np.array([b"ab\0cd", b"abcde"]), type=fixed_string(5, pad=0))
        w.dataset("/null", np.array([b"A\0B"]), type=fixed_string(3, pad=1))
        w.dataset("/space", np.array([b"a    ", b"xy   "]), type=fixed_string(5, pad=2))
        w.dataset("/vlen", np.array(["", "hello", "wörld"], object), type=vlen_string())
        w.dataset("/bad", np.array([b"\xff\xfe"]), type=fixed_string(2))

    f = made(fill)
    assert rows(f, "/term").tolist() == ["ab", "abcde"]
    assert rows(f, "/null").tolist() == ["A\0B"]
    assert rows(f, "/space").tolist() == ["a", "xy"]
    assert rows(f, "/vlen").tolist() == ["", "hello", "wörld"]
    with pytest.raises(ArrayFileError, match="Invalid unicode"):
        rows(f, "/bad")


def test_attributes(made):
    values = {"i": np.int32(7), "s": "text", "l": np.array([1.5, 2.5]), "m": np.arange(6, dtype="i4").reshape(2, 3), "n": Null(number("<i4")), "t": np.array(["a", "bb"], object), "e": np.empty(0, "i4"), "a": (np.array([1, 2, 3], "<i4"), array_of(number("<i4"), (3,)))}
    f = made(lambda w: w.root.attributes.update(values))
    got = {a.name: attribute_value(f, a, False, "/") for a in f.root.attributes}
    assert list(got) == sorted(values)
    assert got == {"i": 7, "s": "text", "l": [1.5, 2.5], "m": [[0, 1, 2], [3, 4, 5]], "n": None, "t": ["a", "bb"], "e": [], "a": [1, 2, 3]}


def test_undecodable_attributes_are_bytes_or_errors(made):
    f = made(lambda w: w.root.attributes.update(x=(np.array(b"\xff\xfe\0\0"), fixed_string(4, pad=0))))
    (a,) = f.root.attributes
    assert attribute_value(f, a, True, "/") == b"\xff\xfe\0\0"
    with pytest.raises(ArrayFileError, match="Invalid unicode"):
        attribute_value(f, a, False, "/")


def test_unsupported_classes_are_listed_but_not_read(made):
    f = made(lambda w: w.dataset("/x", np.zeros(4, "V4"), type=opaque(5, 4)))
    assert f.resolve("/x").type.name == "unknown"
    with pytest.raises(ArrayFileError, match="Unsupported HDF5 type class: 5"):
        rows(f, "/x")


def test_links(made):
    def fill(w):
        w.dataset("/g/d", np.arange(3))
        w.put("/g/rel", Soft("d"))
        w.soft("/abs", "/g/rel")
        w.soft("/loop", "/loop")
        w.soft("/none", "/g/x")

    f = made(fill)
    assert f.resolve("/abs").kind == "dataset" and f.resolve("/abs").address == f.resolve("/g/d").address
    assert f.resolve("/loop") is None and f.resolve("/none") is None and f.resolve("/g/d/x") is None


def test_a_group_of_many_names(made):
    f = made(lambda w: [w.soft(f"/g/n{i:05d}", "/x") for i in range(3_000)])
    assert [x.name for x in f.resolve("/g").links] == [f"n{i:05d}" for i in range(3_000)]


def test_a_block_before_the_superblock(tmp_path):
    w = Writer(str(tmp_path / "x.h5"))
    w.dataset("/x", np.arange(5))
    w.close()
    data = (tmp_path / "x.h5").read_bytes()
    (tmp_path / "y.h5").write_bytes(b"\0" * 512 + data)
    assert rows(File(str(tmp_path / "y.h5")), "/x").tolist() == [0, 1, 2, 3, 4]


def test_other_files_are_errors(tmp_path):
    (tmp_path / "x.h5").write_bytes(b"nothing" * 1_000)
    for path in ("x.h5", "missing.h5", "."):
        with pytest.raises(ArrayFileError, match="Failed to open HDF5 file"):
            File(str(tmp_path / path))


def test_checksum_of_the_specification():
    assert checksum(b"") == 0xDEADBEEF
    assert checksum(b"Four score and seven years ago") == 0x17770551


def test_a_hand_built_dense_group(tmp_path):
    """A group whose links lie in a fractal heap and a version 2 tree, laid out by hand from the specification."""
    w = Writer(str(tmp_path / "x.h5"), latest=True)
    w.dataset("/d", np.arange(3))
    w.close()
    out = bytearray((tmp_path / "x.h5").read_bytes())
    target = File(w.path).resolve("/d").address
    links = []
    for name in (b"alpha", b"beta"):
        links.append(struct.pack("<BBB", 1, 0, len(name)) + name + struct.pack("<Q", target))
    none = 0xFFFFFFFFFFFFFFFF

    def put(data):
        out.extend(b"\0" * (-len(out) % 8))
        out.extend(data)
        return len(out) - len(data)

    header_at = len(out) + -len(out) % 8
    header_size = 142
    block_at = header_at + header_size + -(header_at + header_size) % 8
    head = struct.pack("<4sBHHBI", b"FRHP", 0, 7, 0, 0, 4_096) + struct.pack("<QQQQ", 0, none, 0, none) + struct.pack("<8Q", 512, 512, 512, 2, 0, 0, 0, 0)
    head += struct.pack("<HQQHHQH", 4, 512, 1_024, 32, 0, block_at, 0)
    assert put(head.ljust(header_size, b"\0")) == header_at
    body = struct.pack("<4sBQ", b"FHDB", 0, header_at) + b"\0" * 4
    ids = []
    for x in links:
        ids.append(struct.pack("<B", 0) + len(body).to_bytes(4, "little") + len(x).to_bytes(2, "little"))
        body += x
    assert put(body.ljust(512, b"\0")) == block_at
    leaf = put((struct.pack("<4sBB", b"BTLF", 0, 5) + b"".join(struct.pack("<I", i) + x for i, x in enumerate(ids))).ljust(512, b"\0"))
    tree = put(struct.pack("<4sBBIHHBBQHQ", b"BTHD", 0, 5, 512, 11, 0, 100, 40, leaf, 2, 2) + b"\0" * 4)
    info = struct.pack("<BBQQ", 0, 0, header_at, tree)
    messages = struct.pack("<BHB", 2, len(info), 0) + info
    data = b"OHDR" + struct.pack("<BBI", 2, 2, len(messages)) + messages
    root = put(data + struct.pack("<I", checksum(data)))
    out[36:44] = struct.pack("<Q", root)
    (tmp_path / "y.h5").write_bytes(out)
    f = File(str(tmp_path / "y.h5"))
    assert [x.name for x in f.root.links] == ["alpha", "beta"]
    assert rows(f, "/beta").tolist() == [0, 1, 2]


@pytest.mark.parametrize("deflate", [0, 1])
def test_another_dimension_than_the_first_may_grow(tmp_path, deflate):
    values = np.arange(7 * 120 * 2, dtype=np.int32).reshape(7, 120, 2)
    w = Writer(str(tmp_path / "x.h5"), latest=True)
    w.dataset("/x", values, chunk=(2, 3, 2), deflate=deflate, index="extensible", most=(9, None, 2))
    w.close()
    f = File(w.path)
    for a, b in ((0, 7), (3, 4), (6, 7), (2, 2)):
        assert (rows_of(f, a, b) == values[a:b]).all()


def test_pages_that_were_never_written_hold_the_fill_value(tmp_path):
    values = np.arange(700, dtype=np.int32)
    w = Writer(str(tmp_path / "x.h5"), latest=True)
    w.dataset("/x", values, chunk=(1,), index="extensible", most=(None,), fill=np.int32(-1))
    w.close()
    data = bytearray((tmp_path / "x.h5").read_bytes())
    # The last super block: blocks of 128 entries in pages of 8, so 16 bits for each block.
    at = [i for i in range(len(data)) if data[i : i + 4] == b"EASB"][0] + 4 + 2 + 8 + 4
    data[at] = 0b10111111
    (tmp_path / "y.h5").write_bytes(data)
    got = rows_of(File(str(tmp_path / "y.h5")), 0, 700)
    lost = np.flatnonzero(got != values)
    assert len(lost) == 8 and (np.diff(lost) == 1).all() and (got[lost] == -1).all()


def test_chunks_beyond_the_extent_may_be_left_unfiltered(tmp_path):
    values = np.arange(10, dtype=np.int32)
    w = Writer(str(tmp_path / "x.h5"), latest=True)
    w.dataset("/x", values, chunk=(4,), deflate=1, index="btree2")
    w.close()
    f = File(w.path)
    d = f.resolve("/x")
    last = next(iter(d.chunks(8, 10)))
    raw = np.array([8, 9, 0, 0], "<i4").tobytes()
    data = bytearray((tmp_path / "x.h5").read_bytes())
    where = len(data)
    (tmp_path / "y.h5").write_bytes(data + raw)
    g = File(str(tmp_path / "y.h5"))
    own = g.resolve("/x")
    own.layout.detail["flags"] = 1
    assert own.unfiltered(type(last)(last.offset, where, len(raw), last.mask)) == raw
    assert own.unfiltered(next(iter(own.chunks(0, 4)))) == values[:4].tobytes()


def test_integers_of_fewer_bits_than_their_bytes():
    signed, unsigned = HType(INTEGER, 2, signed=True, precision=12, offset=3), HType(INTEGER, 4, precision=20, offset=0)
    raw = np.array([(v & 0xFFF) << 3 | 0x8005 for v in (-2048, -1, 0, 2047)], "<u2")
    assert numbers(raw, signed).tolist() == [-2048, -1, 0, 2047]
    assert numbers(np.array([0xFFF00001, 5], "<u4"), unsigned).tolist() == [1, 5]


def test_n_bit_chunks_by_hand():
    # Three elements of 12 bits, the highest bit first: ABC 123 FFF, and four bits to fill the byte.
    data = bytes([0xAB, 0xC1, 0x23, 0xFF, 0xF0])
    assert nbit(data, (8, 0, 3, 1, 2, 0, 12, 0), "f") == np.array([0xABC, 0x123, 0xFFF], "<u2").tobytes()
    assert nbit(data, (8, 0, 3, 1, 4, 1, 12, 4), "f") == np.array([0xABC0, 0x1230, 0xFFF0], ">u4").tobytes()
    assert nbit(data, (10, 0, 1, 2, 6, 1, 2, 0, 12, 0), "f") == np.array([0xABC, 0x123, 0xFFF], "<u2").tobytes()
    assert nbit(b"as it is", (8, 1, 1, 1, 8, 0, 64, 0), "f") == b"as it is"
    with pytest.raises(ArrayFileError, match="N-bit"):
        nbit(data, (8, 0, 3, 3, 2, 0), "f")


def scale_offset(width, least, packed):
    return struct.pack("<IB8s8x", width, 8, least) + packed


def test_scale_offset_chunks_by_hand():
    # Differences 0 7 3 6 of 3 bits: 000 111 011 110, and four bits to fill the byte.
    packed = bytes([0b00011101, 0b11100000])
    least = struct.pack("<q", -5)
    whole = scale_offset(3, least, packed)
    assert scaled(whole, (2, 0, 4, 0, 4, 1, 0, 0), "f") == np.array([-5, 2, -2, 1], "<i4").tobytes()
    assert scaled(whole, (2, 0, 4, 0, 4, 1, 1, 0), "f") == np.array([-5, 2, -2, 1], ">i4").tobytes()
    fill = struct.unpack("<I", struct.pack("<i", -99))[0]
    assert scaled(whole, (2, 0, 4, 0, 4, 1, 0, 1, fill), "f") == np.array([-5, -99, -2, 1], "<i4").tobytes()
    assert scaled(scale_offset(0, least, b""), (2, 0, 2, 0, 2, 1, 0, 0), "f") == np.array([-5, -5], "<i2").tobytes()
    full = np.array([1, -1], "<i4").tobytes()
    assert scaled(scale_offset(32, least, full), (2, 0, 2, 0, 4, 1, 0, 0), "f") == full
    assert scaled(full, (2, 32, 2, 0, 4, 1, 0, 0), "f") == full
    decimals = scale_offset(3, struct.pack("<d", 1.5), packed)
    assert np.frombuffer(scaled(decimals, (0, 2, 4, 1, 8, 1, 0, 0), "f"), "<f8") == pytest.approx([1.5, 1.57, 1.53, 1.56])
    short = scale_offset(3, struct.pack("<f4x", 1.5), packed)
    assert np.frombuffer(scaled(short, (0, 2, 4, 1, 4, 1, 1, 0), "f"), ">f4") == pytest.approx([1.5, 1.57, 1.53, 1.56])


def test_a_hand_built_file_of_the_oldest_kind(tmp_path):
    """Superblock 0, a symbol table, local heap, and scale-offset chunks below a version 1 tree, by hand from the specification."""
    none = 0xFFFFFFFFFFFFFFFF
    root, tree, heap, names, node, data, chunks, first, second = 96, 160, 248, 280, 312, 672, 1200, 1400, 1500
    out = bytearray(1600)

    def put(at, *parts):
        body = b"".join(parts)
        assert not any(out[at : at + len(body)])
        out[at : at + len(body)] = body

    def message(kind, body):
        body = body.ljust(-(-len(body) // 8) * 8, b"\0")
        return struct.pack("<HHB3x", kind, len(body), 0) + body

    def header(messages):
        body = b"".join(messages)
        return struct.pack("<BxHII4x", 1, len(messages), 1, len(body)) + body

    put(0, b"\x89HDF\r\n\x1a\n", struct.pack("<8BHHI", 0, 0, 0, 0, 0, 8, 8, 0, 4, 16, 0), struct.pack("<4Q", 0, none, len(out), none))
    put(56, struct.pack("<QQII", 0, root, 1, 0), struct.pack("<QQ", tree, heap))
    put(root, header([message(17, struct.pack("<QQ", tree, heap))]))
    put(tree, b"TREE", struct.pack("<BBHQQ", 0, 0, 1, none, none), struct.pack("<QQQ", 0, node, 8))
    put(heap, b"HEAP", struct.pack("<B3xQQQ", 0, 32, none, names))
    put(names, b"\0" * 8 + b"x\0")
    put(node, b"SNOD", struct.pack("<BxH", 1, 1), struct.pack("<QQII16x", 8, data, 0, 0))
    space = struct.pack("<BBB5xQ", 1, 1, 0, 6)
    kind = struct.pack("<B3BI2H", 0x10, 8, 0, 0, 4, 0, 32)
    fill = struct.pack("<4BI", 2, 3, 0, 1, 0)
    layout = struct.pack("<BBBQII", 3, 2, 2, chunks, 4, 4)
    values = [2, 0, 4, 0, 4, 1, 0, 0, *[0] * 12]
    pipeline = struct.pack("<BB6x", 1, 1) + struct.pack("<HHHH", 6, 0, 0, 20) + struct.pack("<20I", *values)
    put(data, header([message(1, space), message(3, kind), message(5, fill), message(8, layout), message(11, pipeline)]))
    a, b = (scale_offset(3, struct.pack("<q", v), bytes([0b00011101, 0b11100000])) for v in (-5, 100))
    put(chunks, b"TREE", struct.pack("<BBHQQ", 1, 0, 2, none, none), struct.pack("<IIQQQ", len(a), 0, 0, 0, first), struct.pack("<IIQQQ", len(b), 0, 4, 0, second), struct.pack("<IIQQ", 0, 0, 8, 4))
    put(first, a)
    put(second, b)
    (tmp_path / "x.h5").write_bytes(out)
    f = File(str(tmp_path / "x.h5"))
    assert [x.name for x in f.root.links] == ["x"]
    assert f.resolve("/x").type.name == "int32"
    assert rows(f, "/x").tolist() == [-5, 2, -2, 1, 100, 107]
    assert rows(f, "/x", 3, 5).tolist() == [1, 100]


@pytest.mark.parametrize("in_id", [False, True])
def test_huge_heap_objects_by_hand(tmp_path, in_id):
    """Attributes too large for a heap's blocks: in the file by themselves, told by the id or by a tree of numbers."""
    w = Writer(str(tmp_path / "x.h5"), latest=True)
    w.dataset("/d", np.arange(3))
    w.close()
    out = bytearray((tmp_path / "x.h5").read_bytes())
    none = 0xFFFFFFFFFFFFFFFF

    def put(data):
        out.extend(b"\0" * (-len(out) % 8))
        out.extend(data)
        return len(out) - len(data)

    text = bytes(range(256)) * 300
    where = put(text)
    record = struct.pack("<QQQ", where, len(text), 7)
    leaf = put((struct.pack("<4sBB", b"BTLF", 0, 1) + record).ljust(512, b"\0"))
    tree = put(struct.pack("<4sBBIHHBBQHQ", b"BTHD", 0, 1, 512, 24, 0, 100, 40, leaf, 1, 1) + b"\0" * 4)
    head = struct.pack("<4sBHHBI", b"FRHP", 0, 17 if in_id else 8, 0, 0, 4_096) + struct.pack("<QQQQ", 7, none if in_id else tree, 0, none) + struct.pack("<8Q", *[0] * 8)
    heap = put((head + struct.pack("<HQQHHQH", 4, 512, 1_024, 32, 0, none, 0)).ljust(160, b"\0"))
    (tmp_path / "y.h5").write_bytes(out)
    found = FractalHeap(File(str(tmp_path / "y.h5")), heap)
    heap_id = b"\x10" + (struct.pack("<QQ", where, len(text)) if in_id else struct.pack("<Q", 7)[:7])
    assert found.get(heap_id) == text


def test_a_deep_tree_by_hand(tmp_path):
    """A version 2 tree of three levels; a leaf has room for more than 255 records, so all counts take two bytes."""
    w = Writer(str(tmp_path / "x.h5"), latest=True)
    w.dataset("/d", np.arange(3))
    w.close()
    out = bytearray((tmp_path / "x.h5").read_bytes())

    def put(data, n=4_096):
        out.extend(b"\0" * (-len(out) % 8))
        out.extend(data.ljust(n, b"\0"))
        return len(out) - n

    def record(i):
        return struct.pack("<I7x", i)

    def leaf(i):
        return put(struct.pack("<4sBB", b"BTLF", 0, 5) + record(i))

    def inner(i):
        return put(struct.pack("<4sBB", b"BTIN", 0, 5) + record(i) + b"".join(struct.pack("<QH", leaf(j), 1) for j in (i - 1, i + 1)))

    # 194 records fit a node above leaves of 371: 195 * 371 + 194 below it, at most, which take three bytes.
    below = b"".join(struct.pack("<QH", inner(i), 1) + (3).to_bytes(3, "little") for i in (2, 6))
    root = put(struct.pack("<4sBB", b"BTIN", 0, 5) + record(4) + below)
    tree = put(struct.pack("<4sBBIHHBBQHQ", b"BTHD", 0, 5, 4_096, 11, 2, 100, 40, root, 1, 7), 38)
    (tmp_path / "y.h5").write_bytes(out)
    found = [struct.unpack_from("<I", r)[0] for r in File(str(tmp_path / "y.h5")).btree2(tree)]
    assert found == [1, 2, 3, 4, 5, 6, 7]
