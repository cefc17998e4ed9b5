import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrayloom import api
from arrayloom.format.writer import Null, Writer, fixed_string, number, opaque, vlen_string
from arrayloom.functions.settings import batch_size, memory_limit
from arrayloom.model import ArrayFileError


@pytest.fixture()
def file(tmp_path):
    def make(name="x.h5", latest=False, **datasets):
        w = Writer(str(tmp_path / name), latest=latest)
        for path, value in datasets.items():
            if isinstance(value, tuple):
                w.dataset("/" + path, value[0], **value[1])
            else:
                w.dataset("/" + path, value)
        w.close()
        return w.path

    return make


def collect(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.mark.parametrize("mode", ["late", "full"])
def test_columns_end_with_the_shortest(spark, file, mode):
    path = file(a=np.arange(5, dtype="i4"), b=np.array(["x", "", "z"], object), s=np.float64(2.5), n=Null(number("<i4")))
    df = api.read(spark, path, api.index(), "/a", "/b", "/s", "/n", mode=mode)
    assert df.dtypes == [("index", "bigint"), ("a", "int"), ("b", "string"), ("s", "double"), ("n", "int")]
    assert collect(df, "index") == [(0, 0, "x", 2.5, None), (1, 1, "", 2.5, None), (2, 2, "z", 2.5, None)]
    # Pruned columns still count for the rows.
    assert df.select("a").count() == 3


def test_all_scalars_are_one_row_and_null_spaces_count_as_scalars(spark, file):
    path = file(a=np.int32(7), n=Null(number("<i4")))
    assert collect(api.read(spark, path, "/a", api.index()), "a") == [(7, 0)]
    assert collect(api.read(spark, path, "/n"), "n") == [(None,)]


@pytest.mark.parametrize("mode", ["late", "full"])
def test_types(spark, file, mode):
    path = file(u1=np.array([255], "u1"), u2=np.array([65535], "u2"), u4=np.array([2**32 - 1], "u4"), u8=np.array([2**64 - 1], "u8"), f2=np.array([1.5], "f2"), b=np.array([7], ">i4"), m=np.arange(6, dtype="f4").reshape(1, 2, 3), z=np.empty((1, 0), "i2"))
    df = api.read(spark, path, *[f"/{c}" for c in ("u1", "u2", "u4", "u8", "f2", "b", "m", "z")], mode=mode)
    assert [t for _, t in df.dtypes] == ["smallint", "int", "bigint", "decimal(20,0)", "float", "int", "array<array<float>>", "array<smallint>"]
    (r,) = df.collect()
    assert (r.u1, r.u2, r.u4, int(r.u8), r.f2, r.b) == (255, 65535, 2**32 - 1, 2**64 - 1, 1.5, 7)
    assert r.m == [[0, 1, 2], [3, 4, 5]] and r.z == []


@pytest.mark.parametrize("mode", ["late", "full"])
def test_runs(spark, file, mode):
    path = file(x=np.arange(6), rs=np.array([2, 4, 4, 9], "u8"), re=np.array([1, 3, 3], "u8"), v=np.array([10, 20, 30, 40], "i2"), w=np.array(["a", "b", "c"], object), o=np.empty(0, "u8"), ov=np.empty(0, "i4"))
    df = api.read(spark, path, "/x", api.rse("/rs", "/v"), api.ree("/re", "/w"), api.rse("/o", "/ov"), mode=mode)
    assert collect(df, "x") == [(0, None, "a", None), (1, None, "a", None), (2, 10, "b", None), (3, 10, "b", None), (4, 30, None, None), (5, 30, None, None)]
    assert collect(df.filter("v = 30 and x > 4"), "x") == [(5, 30, None, None)]
    assert df.filter("v is null").count() == 2
    # A filter on one use of a frame says nothing about the next.
    assert df.where("x < 3").unionAll(df).count() == 9


def test_not_a_number_is_greatest(spark, file):
    path = file(x=np.arange(4), rs=np.array([0, 2]), v=np.array([1.0, np.nan]))
    assert api.read(spark, path, "/x", api.rse("/rs", "/v")).filter("v > 3.5").count() == 2


def test_many_files_keep_order_repeats_and_their_own_index(spark, file):
    a, b, c = file("a.h5", v=np.array([1, 2])), file("b.h5", v=np.empty(0, "i8"), latest=True), file("c.h5", v=np.array([10, 20, 30]))
    df = api.read(spark, [a, b, c, a], api.index(), "/v", filename="from")
    assert collect(df, "v", "index", "from") == [(0, 1, a), (0, 1, a), (1, 2, a), (1, 2, a), (0, 10, c), (1, 20, c), (2, 30, c)]


def test_strings_of_two_encodings_agree_but_types_must(spark, file):
    a = file("a.h5", t=np.array(["x"], object), m=np.zeros((1, 2)))
    b = file("b.h5", t=(np.array([b"yy "]), {"type": fixed_string(3, pad=2)}), m=np.zeros((1, 3)))
    assert collect(api.read(spark, [a, b], "/t"), "t") == [("x",), ("yy",)]
    with pytest.raises(ArrayFileError, match="incompatible schema"):
        api.read(spark, [a, b], "/m")


def test_errors_when_bound(spark, file):
    path = file(x=np.arange(3), s=np.int32(1), f=np.zeros(2), t=(np.array([[b"ab"]]), {"type": fixed_string(2)}), d=np.zeros((1, 1, 1, 1, 1)), o=(np.zeros(2, "V4"), {"type": opaque(5, 4)}))
    cases = [
        ((None,), "must not be NULL"), ((1,), "must be a string"), (("/none",), "Failed to open dataset"), ((api.index(),), "at least one regular column"), (("/s", api.rse("/x", "/x")), "non-scalar regular column"),
        (("/x", api.rse("/f", "/x")), "must be integer type"), (("/x", api.alias("X", "/f")), "duplicate column name"), (("/t",), "more than 1 dimension"), (("/d",), "more than 4 dimensions"), (("/o",), "type class: 5"),
    ]
    for definitions, message in cases:
        with pytest.raises(ArrayFileError, match=message):
            api.read(spark, path, *definitions)
    with pytest.raises(ArrayFileError, match="already present"):
        api.read(spark, path, api.alias("filename", "/x"), filename=True)
    with pytest.raises(ArrayFileError, match="NULL as argument"):
        api.read(spark, path, "/x", filename=None)
    with pytest.raises(ArrayFileError, match="Failed to open"):
        api.read(spark, path + "x", "/x")


def test_errors_of_runs_only_where_they_are_used(spark, file):
    path = file(x=np.arange(3), bad=np.array([2, 1]), v=np.array([1, 2]), three=np.arange(3))
    df = api.read(spark, path, "/x", api.rse("/bad", "/v"))
    with pytest.raises(Exception, match="non-decreasing"):
        df.collect()
    with pytest.raises(Exception, match="same size"):
        api.read(spark, path, "/x", api.rse("/three", "/v")).collect()


def test_aliases(spark, file):
    path = file(x=np.arange(2))
    assert api.read(spark, path, api.alias("out", api.alias("in", "/x"))).columns == ["out"]


def test_filters_lie_below_the_readers(spark, file):
    path = file(x=np.arange(100), y=np.arange(100), rs=np.array([0, 50]), v=np.array([1, 2]))
    df = api.read(spark, path, api.index(), "/x", "/y", api.rse("/rs", "/v"))
    plan = df.filter("v = 2 and index < 60").select("x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("read(") >= 1 and plan.index("ArrowEvalPython") < plan.rindex("Filter")
    assert "ArrowEvalPython" not in df.agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_and_lazy_chunks(spark, file):
    path = file(x=(None, {"type": number("<i2"), "shape": (2_000, 500, 500), "chunk": (1, 500, 500), "fill": np.int16(-7)}))
    (r,) = api.read(spark, path, "/x").limit(1).collect()
    assert len(r.x) == 500 and r.x[0][0] == -7


@pytest.fixture()
def linked(tmp_path):
    w = Writer(str(tmp_path / "links.h5"), latest=True)
    w.dataset("/g/data", np.arange(4, dtype="i4")).attributes |= {"unit": "m", "n": np.int64(7), "bad": (b"\0" * 4, opaque(5, 4))}
    w.soft("/g/self", "/g")
    w.soft("/alias", "/g")
    w.soft("/dangling", "/nowhere")
    w.external("/out", "other.h5", "/x")
    w.dataset("/none", Null(number("<i4")))
    w.group("/g").attributes["title"] = "group"
    w.close()
    return w.path


def test_tree_is_safe_of_cycles(spark, linked):
    rows = {r.path: r for r in api.tree(spark, linked).collect()}
    assert sorted(rows) == ["/", "/alias", "/alias/data", "/alias/self", "/dangling", "/g", "/g/data", "/g/self", "/none", "/out"]
    assert rows["/g/self"].type == "group" and rows["/dangling"].type == "link" and rows["/out"].type == "external"
    assert rows["/g/data"].dtype == "int32" and rows["/g/data"].shape == [4] and rows["/none"].shape is None


def test_listed_attributes_have_defaults_and_types(spark, linked):
    rows = {r.path: r for r in api.tree(spark, linked, api.attr("n", -1), api.alias("u", api.attr("unit", "?")), api.attr()).collect()}
    assert (rows["/g/data"].n, rows["/g/data"].u) == (7, "m") and (rows["/dangling"].n, rows["/dangling"].u) == (-1, "?")
    assert rows["/dangling"].attr is None and rows["/none"].attr == {} and rows["/g/data"].attr["bad"] is None
    assert rows["/g/data"].attr["n"].toPython() == 7
    with pytest.raises(Exception, match="cannot be cast"):
        api.tree(spark, linked, api.attr("unit", 1)).collect()
    with pytest.raises(Exception, match="unsupported type"):
        api.tree(spark, linked, api.attr("bad", "")).collect()
    for bad in ((api.attr("path", "")), "x"):
        with pytest.raises(ArrayFileError):
            api.tree(spark, linked, bad)
    with pytest.raises(ArrayFileError, match="concrete type"):
        api.attr("x", None)


def test_ls(spark, linked):
    assert collect(api.ls(spark, linked, "/g").select("path", "type"), "path") == [("/g/data", "dataset"), ("/g/self", "group")]
    assert api.ls(spark, linked, "").count() == 5
    for group, message in (("/g/data", "not a group"), ("/x", "Failed to open object")):
        with pytest.raises(Exception, match=message):
            api.ls(spark, linked, group).collect()
    with pytest.raises(ArrayFileError, match="must not be NULL"):
        api.ls(spark, linked, None)


def test_a_filter_on_the_name_opens_no_other_file(spark, linked):
    df = api.tree(spark, [linked, "/missing.h5"], filename=True)
    assert df.filter(F.col("filename").like("%links%")).count() == 10
    with pytest.raises(Exception, match="Failed to open"):
        df.collect()


def test_attributes_table(spark, file, linked, tmp_path):
    assert api.attributes(spark, linked, "/g").collect()[0].title == "group"
    with pytest.raises(ArrayFileError, match="unsupported type"):
        api.attributes(spark, linked, "/g/data")
    with pytest.raises(ArrayFileError, match="no attributes"):
        api.attributes(spark, linked, "/none")
    paths = []
    for i, value in enumerate((np.int32(1), np.int32(2), np.float64(3))):
        w = Writer(str(tmp_path / f"a{i}.h5"))
        w.root.attributes["v"] = value
        w.close()
        paths.append(w.path)
    assert collect(api.attributes(spark, paths[:2], "/", filename=True), "v") == [(1, paths[0]), (2, paths[1])]
    with pytest.raises(ArrayFileError, match="incompatible attribute schema"):
        api.attributes(spark, paths, "/")


def test_row_functions(spark, linked, file):
    path = file(u=np.array([2**64 - 1], "u8"), f=np.array([1.5], "f4"), t=np.array(["x" * 70, ""], object), m=np.arange(300, dtype="i2").reshape(150, 2), s=np.int8(-3), z=np.empty(0, "i4"), n=Null(number("<i4")), five=np.zeros((1, 1, 1, 1, 2)))
    df = spark.createDataFrame([(path, f"/{c}") for c in ("u", "f", "t", "m", "s", "z", "n", "five")] + [(None, "/u"), (path, None)], "f string, p string")
    got = {r.p: r.v for r in df.withColumn("v", F.to_json(api.read_value()("f", "p"))).collect() if r.p}
    m = "[" + ",".join(f"[{2 * i},{2 * i + 1}]" for i in range(150)) + "]"
    assert got == {"/u": "[18446744073709551615]", "/f": "[1.5]", "/t": f'["{"x" * 70}",""]', "/m": m, "/s": "-3", "/z": "[]", "/n": None, "/five": "[[[[[0.0,0.0]]]]]"} | {"/u": got["/u"]}
    with pytest.raises(Exception, match="memory limit exceeded"):
        df.filter("p = '/m'").select(api.read_value(1_000)("f", "p")).collect()
    one = spark.createDataFrame([(linked, "/g")], "f string, p string")
    entries = one.select(api.ls_value(api.attr("n", 0))("f", "p").alias("v")).first().v
    assert {k: (e.path, e.type, e.n) for k, e in entries.items()} == {"data": ("/g/data", "dataset", 7), "self": ("/g/self", "group", 0)}
    assert one.select(api.attributes_value()("f", "p").alias("v")).first().v["title"].toPython() == "group"
    api.register(spark)
    assert spark.sql(f"SELECT to_json(read_value('{path}', '/s')) AS v").first().v == "-3"


def test_settings():
    assert memory_limit("64MB") == 64_000_000 and memory_limit("1 KiB") == 1_024 and memory_limit("None") is None
    assert batch_size("5GB") == 10**9
    for bad in ("0", "-1", "x", ""):
        with pytest.raises(ArrayFileError):
            memory_limit(bad)


def test_http_ranges(tmp_path, file):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from arrayloom.format.reader import File

    path = file(x=np.arange(100_000), s=np.array(["a", "b"], object))
    data = open(path, "rb").read()
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_HEAD(self):
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()

        def do_GET(self):
            a, b = map(int, self.headers["Range"].removeprefix("bytes=").split("-"))
            asked.append((a, b))
            self.send_response(206)
            self.send_header("Content-Length", str(b - a + 1))
            self.end_headers()
            self.wfile.write(data[a : b + 1])

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        f = File(f"http://127.0.0.1:{server.server_port}/x.h5")
        assert np.frombuffer(f.resolve("/x").raw_rows(5, 10).tobytes(), "<i8").tolist() == [5, 6, 7, 8, 9]
        n = len(asked)
        f.resolve("/x").raw_rows(5, 10)
        assert len(asked) == n  # from the blocks kept
        with pytest.raises(ArrayFileError, match="beyond end"):
            f.source.read(len(data) - 2, 10)
    finally:
        server.shutdown()


def test_sink_writes_a_file_for_each_partition(spark, tmp_path):
    from arrayloom.sources.sink import write_files

    df = spark.range(100).selectExpr("id", "cast(id as double) / 2 as half", "cast(id div 30 as string) as part").repartitionByRange(3, "id").sortWithinPartitions("id")
    paths = write_files(df, str(tmp_path / "out"), "/t", runs=("part",), chunk=16, deflate=1)
    assert len(paths) == 3 and sorted(os.listdir(tmp_path / "out")) == [os.path.basename(p) for p in paths]
    back = api.read(spark, paths, "/t/id", "/t/half", api.alias("part", api.rse("/t/part_starts", "/t/part_values")))
    assert collect(back, "id") == [(i, i / 2, str(i // 30)) for i in range(100)]


def test_the_data_source(spark, file):
    from arrayloom.sources.datasource import parse_columns

    api.register(spark)
    path = file(x=np.arange(7), rs=np.array([2, 4]), v=np.array([1.5, np.nan]), s=np.array("k", object))
    options = {"columns": "index as i, /x, rse(/rs, /v) as v, /s", "filename": "from", "rangeRows": "3"}
    df = spark.read.format("arrayloom").options(**options).load(path)
    want = api.read(spark, path, api.alias("i", api.index()), "/x", api.rse("/rs", "/v"), "/s", filename="from", mode="late")
    assert df.dtypes == want.dtypes and repr(collect(df, "i")) == repr(collect(want, "i"))
    assert df.filter("x < 3").count() == 3 and df.count() == 7
    assert parse_columns("/index/a, ree(/a,/b)") == ["/index/a", api.ree("/a", "/b")]


def test_settings_of_the_session(spark, file):
    path = file(x=np.arange(40_000, dtype="i8"))
    before = sorted(api.read(spark, path, "/x", mode="full").collect())
    try:
        spark.conf.set("spark.arrayloom.batchSize", "8KB")
        assert sorted(api.read(spark, path, "/x", mode="full", range_rows=40_000).collect()) == before
        spark.conf.set("spark.arrayloom.batchSize", "much")
        with pytest.raises(ArrayFileError, match="Invalid value"):
            api.read(spark, path, "/x", mode="full")
        spark.conf.unset("spark.arrayloom.batchSize")
        spark.conf.set("spark.arrayloom.valueMemoryLimit", "1KB")
        rows = spark.createDataFrame([(path, "/x")], "f string, p string")
        with pytest.raises(Exception, match="memory limit exceeded"):
            rows.select(api.read_value()("f", "p")).collect()
        assert rows.select(api.read_value("none")("f", "p")).count() == 1
        spark.conf.set("spark.arrayloom.swmrDefault", "perhaps")
        for call in (lambda **o: api.read(spark, path, "/x", **o), lambda **o: api.tree(spark, path, **o), lambda **o: api.ls(spark, path, **o)):
            with pytest.raises(ArrayFileError, match="swmrDefault"):
                call()
            assert call(swmr=True).count() >= 1
        spark.conf.set("spark.arrayloom.swmrDefault", "TRUE")
        assert api.ls(spark, path).count() == 1
    finally:
        for name in ("batchSize", "valueMemoryLimit", "swmrDefault"):
            spark.conf.unset(f"spark.arrayloom.{name}")


@pytest.mark.parametrize("mode", ["late", "full"])
def test_rows_read(spark, file, mode):
    path = file(x=np.arange(1_000), y=np.arange(1_000) * 2, rs=np.array([0, 600]), v=np.array([1, 2]))
    count = lambda f, *d: (n := spark.sparkContext.accumulator(0), f(api.read(spark, path, *d, mode=mode, rows_read=n)).collect(), n.value)[2]
    assert count(lambda d: d, "/x", "/y", api.index()) == 2_000
    if mode == "late":  # nothing is read of rows that a filter on the index or on runs drops, nor of unused columns
        assert count(lambda d: d.filter("index between 10 and 19"), "/x", "/y", api.index()) == 20
        assert count(lambda d: d.filter("v = 2").select("x"), "/x", "/y", api.rse("/rs", "/v")) == 400
        assert count(lambda d: d.groupBy().count(), "/x", "/y", api.index()) == 0


def test_many_files_are_bound_by_tasks(spark, file, monkeypatch):
    from arrayloom.plans import bind

    monkeypatch.setattr(bind, "BIND_HERE", 2)
    paths = [file(f"m{i}.h5", x=np.arange(i + 1)) for i in range(5)]
    assert collect(api.read(spark, paths, "/x", filename=True).groupBy("filename").count(), "filename") == [(p, i + 1) for i, p in enumerate(paths)]
    assert api.read(spark, [paths[0]] * 4, "/x").count() == 4
    with pytest.raises(ArrayFileError, match="incompatible schema"):
        api.read(spark, [*paths, file("other.h5", x=np.zeros(2))], "/x")
    with pytest.raises(ArrayFileError, match="Failed to open dataset"):
        api.read(spark, [*paths, file("none.h5", y=np.zeros(2))], "/x")


def test_short_runs_are_read_in_wide_batches(spark, file):
    n = 50_000
    path = file(x=np.arange(n), re=np.arange(0, n, 2), w=np.arange(0, n, 2), rs=np.arange(1, n, 3), v=np.arange(1, n, 3))
    df = api.read(spark, path, "/x", api.ree("/re", "/w"), api.rse("/rs", "/v"), mode="full")
    got = df.toPandas().sort_values("x", ignore_index=True)
    x = got["x"].to_numpy()
    assert (got["w"].dropna().to_numpy() == ((x + 1) // 2 * 2)[: len(got["w"].dropna())]).all()
    assert (got["v"][1:].to_numpy() == (x[1:] - 1) // 3 * 3 + 1).all() and got["v"].isna()[0]


def test_attributes_of_many_files_are_compared_by_tasks(spark, tmp_path, monkeypatch):
    from arrayloom.sources import listing

    monkeypatch.setattr(listing, "BIND_HERE", 2)
    paths = [str(tmp_path / f"{i}.h5") for i in range(5)]

    def write(i, **attributes):
        w = Writer(paths[i])
        w.root.attributes.update(attributes)
        w.dataset("/x", np.arange(2))
        w.close()

    for i in range(5):
        write(i, n=np.int32(i))
    assert collect(api.attributes(spark, paths, "/"), "n") == [(i,) for i in range(5)]
    write(4)
    with pytest.raises(ArrayFileError, match="no attributes.*4.h5"):
        api.attributes(spark, paths, "/")
    write(3, n=np.float64(1))
    with pytest.raises(ArrayFileError, match="3.h5' with an incompatible attribute schema"):
        api.attributes(spark, paths, "/")


@pytest.mark.parametrize("mode", ["late", "full"])
def test_adaptive_plans_do_not_take_a_scan_for_its_ranges(spark, file, mode):
    path = file(x=np.arange(20_000))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        few, known = api.read(spark, path, "/x", mode=mode).limit(25), api.read(spark, path, "/x", mode=mode).distinct()
        joined = few.join(known.withColumn("known", F.lit(True)), "x", "left").agg(F.count("known").alias("n"))
        assert joined.collect() == [(25,)]
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan


def test_limited_rows_come_from_files_of_partitions(spark):
    from arrayloom.plans import catalog

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert len(catalog.order_key_files.__wrapped__(spark, "/root/testdata/sf0.001")) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (r,) = catalog.limit_rows(spark, "/root/testdata/sf0.001").collect()
    assert (r.rows, r.in_table) == (25, True)


def test_texts_of_a_heap_are_written_in_linear_time(tmp_path):
    import time

    w = Writer(str(tmp_path / "x.h5"))
    began = time.process_time()
    w.encode(np.array(["x" * 200] * 20_000, object), vlen_string())
    assert time.process_time() - began < 2
