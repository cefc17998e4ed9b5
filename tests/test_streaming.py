import os
import threading

import numpy as np
import pytest

from arrayloom import api
from arrayloom.format.writer import Writer
from arrayloom.model import ArrayFileError
from arrayloom.streaming import tail


def test_appended_rows_arrive_once(spark, tmp_path):
    def write(n):
        w = Writer(str(tmp_path / "x.h5"))
        w.dataset("/x", np.arange(n))
        w.close()

    api.register(spark)
    write(3)
    stream = spark.readStream.format("arrayloom").option("columns", "index, /x").load(str(tmp_path / "x.h5"))
    query = stream.writeStream.format("memory").queryName("tailed").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        query.processAllAvailable()
        assert sorted(tuple(r) for r in spark.table("tailed").collect()) == [(i, i) for i in range(3)]
        write(8)
        query.processAllAvailable()
        assert sorted(tuple(r) for r in spark.table("tailed").collect()) == [(i, i) for i in range(8)]
    finally:
        query.stop()


def array_file(path, n):
    w = Writer(str(path))
    w.dataset("/x", np.arange(n))
    w.close()
    return path.read_bytes()


@pytest.mark.parametrize("part", [0, 4, 60, 200, 0.5, 0.99])
def test_a_file_in_the_middle_of_a_write(spark, tmp_path, part):
    path = tmp_path / "x.h5"
    array_file(path, 3)
    reader = tail.TailReader(str(path), ("/x",), False)
    start = reader.latestOffset()
    data = array_file(tmp_path / "next", 8)
    half = data[: int(part * len(data)) if isinstance(part, float) else part]

    def later(f):
        path.write_bytes(half)
        writer = threading.Timer(0.3, path.write_bytes, [data])
        writer.start()
        try:
            return f()
        finally:
            writer.join()

    end = later(reader.latestOffset)
    assert end == {"rows": '{"%s": 8}' % path}
    (rows,) = later(lambda: reader.partitions(start, end))
    assert (rows.start, rows.end) == (3, 8)
    assert [x for b in later(lambda: list(reader.read(rows))) for x in b["x"].to_pylist()] == [3, 4, 5, 6, 7]


def test_a_read_goes_on_where_a_write_cut_it_short(spark, tmp_path):
    path = tmp_path / "x.h5"
    data = array_file(path, 50)
    reader = tail.TailReader(str(path), ("/x",), False)
    (rows,) = reader.partitions(reader.initialOffset(), reader.latestOffset())
    reader.batch_bytes = 80
    found = reader.read(rows)
    got = next(found)["x"].to_pylist()
    path.write_bytes(b"")
    writer = threading.Timer(0.3, path.write_bytes, [data])
    writer.start()
    try:
        got += [x for b in found for x in b["x"].to_pylist()]
    finally:
        writer.join()
    assert got == list(range(50))


def test_a_file_that_stays_broken(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tail, "REST", 0.2)
    path = tmp_path / "x.h5"
    data = array_file(path, 3)
    reader = tail.TailReader(str(path), ("/x",), False)
    reader.latestOffset()
    path.write_bytes(data[:100])
    held = len(os.listdir("/proc/self/fd"))
    with pytest.raises(ArrayFileError):
        reader.latestOffset()
    path.write_bytes(data[:4])
    with pytest.raises(ArrayFileError):
        reader.latestOffset()
    assert len(os.listdir("/proc/self/fd")) == held
