"""Registered queries: tables are written as array files once, then read by the engine. ORACLES holds the DuckDB twin of each."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrayloom import api
from arrayloom.format.writer import Null, Writer, fixed_string, number
from arrayloom.operators.runs import expand_runs
from arrayloom.sources.sink import write_files

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "pricing_summary"
_made: dict[tuple[str, str], list[str]] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


def scratch(spark: SparkSession) -> str:
    """A folder for array files that all workers see: below spark.checkpoint.dir where the session names one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared and "://" in shared and not shared.startswith("file://"):
        raise ValueError("array files need a shared folder with plain file access")
    if shared:
        return os.path.join(shared.removeprefix("file://").removeprefix("file:"), f"array-files-{uuid.uuid4().hex}")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="array-files-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def once(make):
    """Files of one table set, made on first use in a session."""

    @wraps(make)
    def kept(spark: SparkSession, sf_dir: str) -> list[str]:
        key = make.__name__, sf_dir
        if key not in _made or not all(map(os.path.exists, _made[key])):
            _made[key] = make(spark, sf_dir)
        return _made[key]

    return kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@once
def lineitem_files(spark, sf_dir):
    """Line items in order of flag, status, ship date and key, range-partitioned; flag and status as runs."""
    items = table(spark, sf_dir, "lineitem").orderBy("l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber")
    return write_files(items, scratch(spark), "/lineitem", runs=("l_returnflag", "l_linestatus"))


@once
def lineitem_chunked(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice").orderBy("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice").coalesce(1)
    return write_files(items, scratch(spark), "/", chunk=4_096, deflate=4, latest=True)


@once
def orders_files(spark, sf_dir):
    return write_files(table(spark, sf_dir, "orders").orderBy("o_orderkey").coalesce(1), scratch(spark), "/orders")


@once
def order_key_files(spark, sf_dir):
    """Order keys alone, range-partitioned: a file a partition, so that no task holds the table."""
    return write_files(table(spark, sf_dir, "orders").select("o_orderkey").orderBy("o_orderkey"), scratch(spark), "/orders")


@once
def customer_files(spark, sf_dir):
    return write_files(table(spark, sf_dir, "customer").orderBy("c_custkey").coalesce(1), scratch(spark), "/customer")


@once
def embedding_files(spark, sf_dir):
    return write_files(table(spark, sf_dir, "embeddings").orderBy("vec_id").coalesce(1), scratch(spark), "/e", chunk=256, deflate=1)


@once
def event_files(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type").orderBy("event_id").coalesce(1)
    return write_files(events, scratch(spark), "/", runs=("event_type",))


@once
def small_files(spark, sf_dir):
    """One file with a group a table, scalars, short datasets, attributes and links."""
    path = os.path.join(scratch(spark), "tables.h5")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    nation = table(spark, sf_dir, "nation").orderBy("n_nationkey").toPandas()  # tables of fixed size
    region = table(spark, sf_dir, "region").orderBy("r_regionkey").toPandas()
    w = Writer(path, latest=True)
    w.dataset("/nation/n_nationkey", nation["n_nationkey"].to_numpy(np.int32))
    w.dataset("/nation/n_regionkey", nation["n_regionkey"].to_numpy(np.int32))
    w.dataset("/nation/n_name", nation["n_name"].to_numpy(object))
    w.dataset("/region/r_regionkey", region["r_regionkey"].to_numpy(np.int32)).attributes |= {"unit": "key", "rows": np.int64(len(region))}
    w.dataset("/region/r_name", region["r_name"].to_numpy(object))
    w.dataset("/scale", np.float64(2.5))
    w.dataset("/label", np.array("fixed", object))
    w.root.attributes |= {"title": "tables", "version": np.int32(3)}
    w.group("/nation").attributes["rows"] = np.int64(len(nation))
    w.soft("/countries", "/nation")
    w.soft("/missing", "/nowhere")
    w.external("/elsewhere", "other.h5", "/x")
    w.close()
    return [path]


def items(spark, sf_dir, *names, mode="auto", **options):
    return api.read(spark, lineitem_files(spark, sf_dir), *names, mode=mode, **options)


FLAG, STATUS = (api.rse(f"/lineitem/{c}_starts", f"/lineitem/{c}_values") for c in ("l_returnflag", "l_linestatus"))
FLAG, STATUS = api.alias("l_returnflag", FLAG), api.alias("l_linestatus", STATUS)


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, count(*) AS count_order
FROM lineitem GROUP BY ALL""")
def pricing_summary(spark, sf_dir):
    """Line-item totals by flag and status, both run-encoded."""
    rows = items(spark, sf_dir, "/lineitem/l_quantity", "/lineitem/l_extendedprice", "/lineitem/l_discount", FLAG, STATUS, mode="full")
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_disc_price"), F.count(F.lit(1)).alias("count_order"))


@query("SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) - 1 AS index, l_orderkey, l_linenumber, l_quantity FROM lineitem")
def stack_columns(spark, sf_dir):
    """Datasets side by side with the row index, from compressed chunks."""
    return api.read(spark, lineitem_chunked(spark, sf_dir), api.index(), "/l_orderkey", "/l_linenumber", "/l_quantity")


@query("SELECT l_orderkey, l_quantity * l_extendedprice AS amount FROM lineitem")
def full_scan(spark, sf_dir):
    """The batch form of the scan."""
    rows = api.read(spark, lineitem_chunked(spark, sf_dir), "/l_orderkey", "/l_quantity", "/l_extendedprice", mode="full")
    return rows.select("l_orderkey", (F.col("l_quantity") * F.col("l_extendedprice")).alias("amount"))


@query("SELECT n_name, r_name FROM (SELECT *, row_number() OVER (ORDER BY n_nationkey) AS k FROM nation) JOIN (SELECT *, row_number() OVER (ORDER BY r_regionkey) AS k FROM region) USING (k)")
def shortest_dataset(spark, sf_dir):
    """Rows end with the shortest dataset."""
    return api.read(spark, small_files(spark, sf_dir), "/nation/n_name", "/region/r_name")


@query("SELECT n_name, 2.5::DOUBLE AS scale, 'fixed' AS label, n_nationkey * 2.5::DOUBLE AS scaled FROM nation")
def scalar_broadcast(spark, sf_dir):
    rows = api.read(spark, small_files(spark, sf_dir), "/nation/n_name", "/nation/n_nationkey", "/scale", "/label")
    return rows.select("n_name", "scale", "label", (F.col("n_nationkey") * F.col("scale")).alias("scaled"))


@query("SELECT event_id, event_type FROM events")
def rse_expand(spark, sf_dir):
    """Runs by their starts."""
    return api.read(spark, event_files(spark, sf_dir), "/event_id", api.alias("event_type", api.rse("/event_type_starts", "/event_type_values")))


@query("SELECT event_id, event_type FROM events")
def ree_expand(spark, sf_dir):
    """Runs by their inclusive ends."""
    return api.read(spark, event_files(spark, sf_dir), "/event_id", api.alias("event_type", api.ree("/event_type_ends", "/event_type_values")), mode="full")


@query("SELECT l_linestatus, count(*) AS n, sum(l_quantity) AS qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL")
def run_filter(spark, sf_dir):
    """A filter on a run-encoded column drops row ranges before any dataset is read."""
    rows = items(spark, sf_dir, "/lineitem/l_quantity", FLAG, STATUS)
    return rows.filter("l_returnflag = 'R'").groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@query("SELECT index, o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS index FROM orders) WHERE index BETWEEN 100 AND 119 OR index = 7")
def index_filter(spark, sf_dir):
    rows = api.read(spark, orders_files(spark, sf_dir), api.index(), "/orders/o_orderkey")
    return rows.filter("index between 100 and 119 or index = 7")


@query("SELECT vec_id, embedding[1]::DOUBLE AS first, embedding[len(embedding)]::DOUBLE AS last, len(embedding)::INTEGER AS dims FROM embeddings")
def inner_dimensions(spark, sf_dir):
    """A two-dimensional dataset is a column of arrays."""
    rows = api.read(spark, embedding_files(spark, sf_dir), "/e/vec_id", "/e/embedding")
    return rows.select("vec_id", F.element_at("embedding", 1).cast("double").alias("first"), F.element_at("embedding", -1).cast("double").alias("last"), F.size("embedding").alias("dims"))


@query("SELECT count(*) AS rows, sum(l_orderkey)::BIGINT AS keys, true AS gapless FROM lineitem")
def many_files(spark, sf_dir):
    """All parts as one table; each file's index begins at 0."""
    rows = items(spark, sf_dir, api.index(), "/lineitem/l_orderkey", filename=True)
    one = rows.groupBy("filename").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_orderkey").alias("keys"), F.min("index").alias("low"), (F.max("index") + 1).alias("high"))
    return one.agg(F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.bool_and((F.col("low") == 0) & (F.col("high") == F.col("rows"))).alias("gapless"))


@query("SELECT count(*) AS n FROM lineitem")
def count_only(spark, sf_dir):
    """Counting reads no dataset."""
    return items(spark, sf_dir, api.index(), "/lineitem/l_quantity", FLAG).agg(F.count(F.lit(1)).alias("n"))


TREE = [
    ("/", "group", None), ("/countries", "group", None), ("/countries/n_name", "dataset", "string"), ("/countries/n_nationkey", "dataset", "int32"), ("/countries/n_regionkey", "dataset", "int32"),
    ("/elsewhere", "external", None), ("/label", "dataset", "string"), ("/missing", "link", None), ("/nation", "group", None), ("/nation/n_name", "dataset", "string"),
    ("/nation/n_nationkey", "dataset", "int32"), ("/nation/n_regionkey", "dataset", "int32"), ("/region", "group", None), ("/region/r_name", "dataset", "string"), ("/region/r_regionkey", "dataset", "int32"), ("/scale", "dataset", "float64"),
]
_ROWS = ", ".join(f"('{p}', '{t}', {'NULL' if d is None else repr(d)})" for p, t, d in TREE)


@query(f"SELECT path, type, dtype, CASE WHEN path LIKE '/region/%' THEN (SELECT count(*) FROM region) WHEN dtype IS NOT NULL AND (path LIKE '/nation/%' OR path LIKE '/countries/%') THEN (SELECT count(*) FROM nation) END AS first_dim FROM (VALUES {_ROWS}) t(path, type, dtype)")
def tree_listing(spark, sf_dir):
    rows = api.tree(spark, small_files(spark, sf_dir))
    return rows.select("path", "type", "dtype", F.get("shape", F.lit(0)).alias("first_dim"))


@query("SELECT '/nation/' || c AS path, 'dataset' AS type, CASE c WHEN 'n_name' THEN 'string' ELSE 'int32' END AS dtype FROM (VALUES ('n_name'), ('n_nationkey'), ('n_regionkey')) t(c)")
def group_listing(spark, sf_dir):
    return api.ls(spark, small_files(spark, sf_dir), "/nation").select("path", "type", "dtype")


@query("SELECT '/region/r_regionkey' AS path, 'key' AS unit, (SELECT count(*) FROM region) AS rows UNION ALL SELECT '/region/r_name', 'none', -1")
def listed_attributes(spark, sf_dir):
    return api.ls(spark, small_files(spark, sf_dir), "/region", api.attr("unit", "none"), api.attr("rows", -1)).select("path", "unit", "rows")


@query("SELECT 'tables' AS title, 3::INTEGER AS version")
def object_attributes(spark, sf_dir):
    return api.attributes(spark, small_files(spark, sf_dir), "/")


@query("SELECT '/region/r_name' AS path, (SELECT list(r_name ORDER BY r_regionkey) FROM region) AS names, (SELECT count(*)::INTEGER FROM region) AS n")
def row_value(spark, sf_dir):
    """A dataset of a path column, as a variant."""
    (file,) = small_files(spark, sf_dir)
    rows = spark.createDataFrame([(file, "/region/r_name")], "file string, path string").withColumn("v", api.read_value()("file", "path"))
    names = F.try_variant_get("v", "$", "array<string>")
    return rows.select("path", names.alias("names"), F.size(names).alias("n"))


@query("SELECT 'n_name' AS name, 'string' AS dtype UNION ALL SELECT 'n_nationkey', 'int32' UNION ALL SELECT 'n_regionkey', 'int32'")
def row_listing(spark, sf_dir):
    (file,) = small_files(spark, sf_dir)
    rows = spark.createDataFrame([(file, "/nation")], "file string, path string").select(F.explode(api.ls_value()("file", "path")).alias("name", "entry"))
    return rows.select("name", "entry.dtype")


@query("SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def join_scans(spark, sf_dir):
    """An inner join of two scans, and its aggregate."""
    orders = api.read(spark, orders_files(spark, sf_dir), "/orders/o_custkey", "/orders/o_totalprice")
    customers = api.read(spark, customer_files(spark, sf_dir), "/customer/c_custkey", "/customer/c_mktsegment")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT a.index // 10 AS tens, count(*) AS pairs FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS index FROM orders) a JOIN (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS index FROM customer) b ON a.index // 10 = b.index // 10 GROUP BY ALL")
def join_on_expression(spark, sf_dir):
    a = api.read(spark, orders_files(spark, sf_dir), api.alias("i", api.index()), "/orders/o_orderkey")
    b = api.read(spark, customer_files(spark, sf_dir), api.alias("j", api.index()), "/customer/c_custkey")
    joined = a.join(b, F.expr("i div 10 = j div 10"))
    return joined.groupBy(F.expr("i div 10").alias("tens")).agg(F.count(F.lit(1)).alias("pairs"))


@query("SELECT n_name, r_name FROM (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) AS k FROM nation) FULL JOIN (SELECT r_name, row_number() OVER (ORDER BY r_regionkey) AS k FROM region) USING (k)")
def positional_join(spark, sf_dir):
    """Rows of two scans by their positions; the shorter one ends in nulls."""
    a = api.read(spark, small_files(spark, sf_dir), api.index(), "/nation/n_name")
    b = api.read(spark, small_files(spark, sf_dir), api.index(), "/region/r_name")
    return a.join(b, "index", "full_outer").select("n_name", "r_name")


@query("SELECT n_name, r_name FROM nation CROSS JOIN region")
def cross_join(spark, sf_dir):
    a = api.read(spark, small_files(spark, sf_dir), "/nation/n_name")
    return a.crossJoin(F.broadcast(api.read(spark, small_files(spark, sf_dir), "/region/r_name")))  # two tables of fixed size


@query("SELECT count(DISTINCT l_suppkey) AS suppliers, count(*) FILTER (l_quantity > 25) AS large, min(l_tax) AS low, max(l_tax) AS high, round(avg(l_extendedprice), 6) AS mean FROM lineitem")
def aggregates(spark, sf_dir):
    rows = items(spark, sf_dir, "/lineitem/l_suppkey", "/lineitem/l_quantity", "/lineitem/l_tax", "/lineitem/l_extendedprice")
    return rows.agg(F.count_distinct("l_suppkey").alias("suppliers"), F.expr("count(*) filter (where l_quantity > 25)").alias("large"), F.min("l_tax").alias("low"), F.max("l_tax").alias("high"), F.round(F.avg("l_extendedprice"), 6).alias("mean"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_rows(spark, sf_dir):
    return api.read(spark, orders_files(spark, sf_dir), "/orders/o_orderkey", "/orders/o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 5 OFFSET 20")
def offset_rows(spark, sf_dir):
    return api.read(spark, orders_files(spark, sf_dir), "/orders/o_orderkey").orderBy("o_orderkey").offset(20).limit(5)


@query("SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region EXCEPT ALL SELECT r_regionkey FROM region")
def set_operations(spark, sf_dir):
    nation = api.read(spark, small_files(spark, sf_dir), api.alias("k", "/nation/n_nationkey"))
    region = api.read(spark, small_files(spark, sf_dir), api.alias("k", "/region/r_regionkey"))
    return nation.unionAll(region).exceptAll(region)


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark, sf_dir):
    return api.read(spark, orders_files(spark, sf_dir), "/orders/o_orderstatus", "/orders/o_orderpriority").distinct()


@query("SELECT event_type, n, row_number() OVER (ORDER BY n DESC, event_type) AS rank FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)")
def window_rank(spark, sf_dir):
    rows = api.read(spark, event_files(spark, sf_dir), "/event_id", api.alias("event_type", api.rse("/event_type_starts", "/event_type_values")))
    counts = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "event_type")))  # one row a type


@query("SELECT upper(n_name) AS upper_name, length(n_name) AS n, substr(n_name, 1, 3) AS head, replace(n_name, 'A', '_') AS replaced, contains(n_name, 'IN') AS has_in, strpos(n_name, 'A') AS at, coalesce(nullif(n_regionkey, 1), -1) AS region, greatest(n_nationkey, 10) AS larger FROM nation")
def scalar_functions(spark, sf_dir):
    n = api.read(spark, small_files(spark, sf_dir), "/nation/n_name", "/nation/n_regionkey", "/nation/n_nationkey")
    return n.select(
        F.upper("n_name").alias("upper_name"), F.length("n_name").cast("long").alias("n"), F.substring("n_name", 1, 3).alias("head"), F.replace("n_name", F.lit("A"), F.lit("_")).alias("replaced"),
        F.contains("n_name", F.lit("IN")).alias("has_in"), F.locate("A", "n_name").cast("long").alias("at"), F.coalesce(F.expr("nullif(n_regionkey, 1)"), F.lit(-1)).alias("region"), F.greatest("n_nationkey", F.lit(10)).alias("larger"),
    )


@once
def edge_files(spark, sf_dir):
    """Two files of fixed small datasets that differ in string encoding and in what is scalar."""
    folder = scratch(spark)
    os.makedirs(folder, exist_ok=True)
    made = []
    for i, latest in enumerate((False, True)):
        w = Writer(os.path.join(folder, f"edge_{i}.h5"), latest=latest)
        x = np.arange(6, dtype=np.int32) + 10 * i
        w.dataset("/x", x)
        w.dataset("/big", np.array([2**64 - 1, 2**63, 1, 2, 3, 4], np.uint64))
        w.dataset("/name", np.array(["a", "b", "", "d", "e", "f"], object) if i else np.array([b"a", b"b", b"", b"d", b"e", b"f"], "S3"), **({} if i else {"type": fixed_string(3)}))
        w.dataset("/nothing", Null(number("<i4")))
        w.dataset("/none", np.empty(0, np.int64))
        w.dataset("/flat", np.empty((6, 0), np.float32))
        w.dataset("/run", np.float64(1.5 + i))
        w.dataset("/starts", np.array([2, 4, 4, 9], np.uint64))
        w.dataset("/ends", np.array([1, 3, 3], np.uint64))
        w.dataset("/starts_values", np.array([10, 20, 30, 40], np.int16))
        w.dataset("/ends_values", np.array(["p", "q", "r"], object))
        w.dataset("/text_numbers", np.array(["1", "2", "x", "4", "5", "6"], object))
        w.dataset("/chunked", np.arange(60, dtype=np.int64).reshape(6, 10) + 100 * i, chunk=(2, 3), deflate=3, shuffle=True, fletcher=True)
        w.root.attributes |= {"run": np.int64(i), "site": "here"}
        w.close()
        made.append(w.path)
    return made


X = "(VALUES (0), (1), (2), (3), (4), (5)) t(i)"


@query(f"SELECT i::BIGINT AS index, i::INTEGER AS x, CASE WHEN i < 2 THEN NULL WHEN i < 4 THEN 10 ELSE 30 END::SMALLINT AS by_start, CASE WHEN i < 2 THEN 'p' WHEN i < 4 THEN 'q' END AS by_end FROM {X}")
def run_edges(spark, sf_dir):
    """Rows before the first start and after the last end are null; empty runs vanish; what reaches beyond the rows is cut."""
    file = edge_files(spark, sf_dir)[0]
    return api.read(spark, file, api.index(), "/x", api.alias("by_start", api.rse("/starts", "/starts_values")), api.alias("by_end", api.ree("/ends", "/ends_values")))


@query(f"SELECT i::INTEGER AS x, CASE WHEN i < 2 THEN NULL WHEN i < 4 THEN 10 ELSE 30 END::SMALLINT AS by_start FROM {X}")
def run_edges_in_batches(spark, sf_dir):
    """The same by the batch form."""
    file = edge_files(spark, sf_dir)[0]
    return api.read(spark, file, "/x", api.alias("by_start", api.rse("/starts", "/starts_values")), mode="full")


@query("SELECT count(*) AS n, (SELECT count(DISTINCT event_type) FROM events) AS types, min(event_id)::BIGINT AS low FROM events")
def run_relation(spark, sf_dir):
    """Runs as a table of (start, value), expanded by a range join's equal: one sequence for each run."""
    (file,) = event_files(spark, sf_dir)
    runs = api.read(spark, file, api.alias("start", "/event_type_starts"), api.alias("end", "/event_type_ends"), api.alias("type", "/event_type_values"))
    rows = expand_runs(runs.withColumn("end", F.col("end") + 1), "start", None, "end")
    found = rows.join(api.read(spark, file, api.index(), "/event_id"), "index")
    return found.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("type").alias("types"), F.min("event_id").cast("long").alias("low"))


@query(f"SELECT i::INTEGER AS x, NULL::INTEGER AS nothing, 1.5::DOUBLE AS run FROM {X} UNION ALL SELECT i + 10, NULL, 2.5 FROM {X}")
def null_spaces(spark, sf_dir):
    """A dataset without a space is null in each row; scalars are those of their file."""
    return api.read(spark, edge_files(spark, sf_dir), "/x", "/nothing", "/run")


@query("SELECT 0::BIGINT AS rows")
def empty_dataset(spark, sf_dir):
    """An empty dataset ends the rows before the first."""
    return api.read(spark, edge_files(spark, sf_dir), "/x", "/none").agg(F.count(F.lit(1)).alias("rows"))


@query(f"SELECT i::INTEGER AS x, 0 AS inner_size FROM {X}")
def zero_sized_inner(spark, sf_dir):
    rows = api.read(spark, edge_files(spark, sf_dir)[0], "/x", "/flat")
    return rows.select("x", F.size("flat").alias("inner_size"))


@query("SELECT name, count(*) AS n FROM (VALUES ('a'), ('b'), (''), ('d'), ('e'), ('f')) t(name), (VALUES (0), (1)) f(i) GROUP BY name")
def string_encodings(spark, sf_dir):
    """Fixed and variable strings of two files are one column."""
    return api.read(spark, edge_files(spark, sf_dir), "/name").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT (18446744073709551615::HUGEINT + 9223372036854775808::HUGEINT + 10)::DECIMAL(30, 0)::VARCHAR AS total, '18446744073709551615' AS most")
def unsigned_sum(spark, sf_dir):
    """Unsigned numbers of 64 bits add up beyond 64 bits."""
    rows = api.read(spark, edge_files(spark, sf_dir)[0], "/big")
    return rows.agg(F.sum("big").cast("decimal(30,0)").cast("string").alias("total"), F.max("big").cast("string").alias("most"))


@query("SELECT x, first_ FROM (VALUES (2, 20), (3, 30), (12, 120), (13, 130)) t(x, first_)")
def cast_filters(spark, sf_dir):
    """Filters through casts, of datasets and of the index."""
    rows = api.read(spark, edge_files(spark, sf_dir), api.index(), "/x", "/chunked", "/text_numbers")
    rows = rows.filter("cast(index as string) in ('2', '3') and cast(x as double) >= 1.5 and coalesce(try_cast(text_numbers as int), 4) > 3")
    return rows.select("x", F.get("chunked", F.lit(0)).cast("int").alias("first_"))


@query(f"SELECT CASE WHEN i < 2 THEN 'unknown' WHEN i < 4 THEN 'low' ELSE 'high' END AS class, count(*) AS n FROM {X} GROUP BY ALL")
def unknown_run_values(spark, sf_dir):
    """Comparisons with null runs are unknown: such rows pass neither a filter nor its opposite."""
    rows = api.read(spark, edge_files(spark, sf_dir)[0], "/x", api.alias("v", api.rse("/starts", "/starts_values")))
    low, high, rest = rows.filter("v < 20"), rows.filter("not (v < 20)"), rows.filter("(v < 20) is null")
    named = [d.select(F.lit(name).alias("class")) for d, name in ((low, "low"), (high, "high"), (rest, "unknown"))]
    return named[0].unionAll(named[1]).unionAll(named[2]).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, index FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS index FROM orders) WHERE index < 3 OR o_orderkey % 997 = 0")
def residual_filter(spark, sf_dir):
    """A filter of which only one side concerns the index."""
    return api.read(spark, orders_files(spark, sf_dir), api.index(), "/orders/o_orderkey").filter("index < 3 or o_orderkey % 997 = 0").select("o_orderkey", "index")


@query("SELECT 25::BIGINT AS rows, true AS in_table")
def limit_rows(spark, sf_dir):
    """A limit without an order: so many rows, whichever they are; a scan stops at them."""
    few = api.read(spark, order_key_files(spark, sf_dir), "/orders/o_orderkey").limit(25)
    known = api.read(spark, order_key_files(spark, sf_dir), "/orders/o_orderkey").distinct()
    joined = few.join(known.withColumn("known", F.lit(True)), "o_orderkey", "left")
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.bool_and(F.coalesce("known", F.lit(False))).alias("in_table"))


@query("SELECT l_orderkey, count(*) AS n, round(sum(l_extendedprice - mean), 2) + 0 AS over FROM lineitem, (SELECT avg(l_extendedprice) AS mean FROM lineitem) WHERE l_extendedprice > 1.9 * mean GROUP BY l_orderkey")
def join_to_aggregate(spark, sf_dir):
    """Rows against an aggregate of all rows: one row, so it is sent to every task."""
    rows = api.read(spark, lineitem_chunked(spark, sf_dir), "/l_orderkey", "/l_extendedprice")
    mean = rows.agg(F.avg("l_extendedprice").alias("mean"))
    over = rows.crossJoin(F.broadcast(mean)).filter("l_extendedprice > 1.9 * mean")
    return over.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum(F.col("l_extendedprice") - F.col("mean")), 2) + 0).alias("over"))


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_using(spark, sf_dir):
    nations = api.read(spark, small_files(spark, sf_dir), "/nation/n_name", api.alias("k", "/nation/n_regionkey"))
    regions = api.read(spark, small_files(spark, sf_dir), api.alias("k", "/region/r_regionkey"), "/region/r_name")
    return nations.join(regions, "k").select("n_name", "r_name")


@query("SELECT run::BIGINT AS run, count(*) AS n, sum(i + 10 * run)::BIGINT AS total FROM (VALUES (0), (1)) f(run), " + X + " GROUP BY run")
def metadata_join(spark, sf_dir):
    """Rows of each file with an attribute of that file, by the file name."""
    files = edge_files(spark, sf_dir)
    rows = api.read(spark, files, "/x", filename=True)
    runs = api.attributes(spark, files, "/", filename=True).select("filename", "run")
    return rows.join(runs, "filename").groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"))


@query(f"SELECT i + 10 * f.run AS x, 10 * i AS geometry FROM (VALUES (0), (1)) f(run), {X}")
def geometry_join(spark, sf_dir):
    """Rows of all files with a table that is read from the first file only."""
    files = edge_files(spark, sf_dir)
    pattern = os.path.join(os.path.dirname(files[0]), "edge_*.h5")
    geometry = api.read(spark, api.first_file(pattern), api.alias("place", api.index()), "/chunked").select("place", F.get("chunked", F.lit(0)).cast("int").alias("geometry"))
    rows = api.read(spark, pattern, api.alias("place", api.index()), "/x")
    return rows.join(geometry, "place").select("x", "geometry")


@query(f"SELECT count(*) * 3 AS rows, (sum(i) * 3 + 60)::BIGINT AS total FROM {X}")
def listed_files(spark, sf_dir):
    """Names and patterns in a list, left to right, repeats kept."""
    files = edge_files(spark, sf_dir)
    rows = api.read(spark, [os.path.join(os.path.dirname(files[0]), "edge_?.h5"), files[0]], "/x")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("x").alias("total"))


@query("SELECT 1::BIGINT AS files, count(*) AS paths FROM (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13), (14)) t(i)")
def pruned_listing(spark, sf_dir):
    """A filter on the file name keeps the other files from being opened."""
    files = edge_files(spark, sf_dir)
    rows = api.tree(spark, files, filename=True).filter(F.col("filename") == files[1])
    return rows.agg(F.count_distinct("filename").alias("files"), F.count(F.lit(1)).alias("paths"))


@query("SELECT f.run::BIGINT AS run, 'here' AS site FROM (VALUES (0), (1)) f(run)")
def attributes_of_files(spark, sf_dir):
    """One row a file, with the attributes in the order of the object."""
    return api.attributes(spark, edge_files(spark, sf_dir), "/")


@query("SELECT 'r_regionkey' AS name, 'key' AS unit, (SELECT count(*) FROM region) AS rows, 2 AS n UNION ALL SELECT 'r_name', NULL, NULL, 0")
def mapped_attributes(spark, sf_dir):
    """All attributes of an entry as a map of variants."""
    rows = api.ls(spark, small_files(spark, sf_dir), "/region", api.alias("all", api.attr()))
    value = lambda key, kind: F.expr(f"try_variant_get(`all`['{key}'], '$', '{kind}')")
    return rows.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), value("unit", "string").alias("unit"), value("rows", "bigint").alias("rows"), F.size("all").alias("n"))


@query("SELECT 'key' AS unit, (SELECT count(*) FROM region) AS rows, true AS none_for_null")
def row_attributes(spark, sf_dir):
    """The attributes of an object in each row's file; null for a row without a path."""
    (file,) = small_files(spark, sf_dir)
    rows = spark.createDataFrame([(file, "/region/r_regionkey"), (file, None)], "file string, path string").withColumn("a", api.attributes_value()("file", "path"))
    unit, n = F.expr("try_variant_get(a['unit'], '$', 'string')"), F.expr("try_variant_get(a['rows'], '$', 'bigint')")
    return rows.agg(F.max(unit).alias("unit"), F.max(n).alias("rows"), F.bool_and(F.col("path").isNotNull() | F.col("a").isNull()).alias("none_for_null"))


@query("SELECT 'n_name' AS name, 'string' AS dtype UNION ALL SELECT 'n_nationkey', 'int32' UNION ALL SELECT 'n_regionkey', 'int32'")
def row_listing_anew(spark, sf_dir):
    """The listing of each row's group, from files opened anew."""
    (file,) = small_files(spark, sf_dir)
    rows = spark.createDataFrame([(file, "/nation")], "file string, path string").select(F.explode(api.ls_swmr_value()("file", "path")).alias("name", "entry"))
    return rows.select("name", "entry.dtype")


@query("SELECT (SELECT list(r_name ORDER BY r_regionkey) FROM region) AS names, 3::BIGINT AS entries, 2.5::DOUBLE AS scale")
def registered_functions(spark, sf_dir):
    """The row functions by their SQL names."""
    api.register(spark)
    (file,) = small_files(spark, sf_dir)
    return spark.sql(
        "SELECT try_variant_get(read_value(f, '/region/r_name'), '$', 'array<string>') AS names, cast(cardinality(ls_value(f, '/nation')) AS bigint) AS entries, try_variant_get(read_value(f, '/scale'), '$', 'double') AS scale FROM (SELECT :file AS f)",
        args={"file": file},
    )


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS at FROM orders")
def data_source(spark, sf_dir):
    """The table as a data source with options."""
    api.register(spark)
    return spark.read.format("arrayloom").option("columns", "index as at, /orders/o_orderkey").load(orders_files(spark, sf_dir)[0]).select("o_orderkey", "at")


@query("SELECT event_id, event_type FROM events")
def streamed_rows(spark, sf_dir):
    """A file tailed as a stream: all its rows arrive once."""
    api.register(spark)
    (file,) = event_files(spark, sf_dir)
    columns = "/event_id, rse(/event_type_starts, /event_type_values) as event_type"
    stream = spark.readStream.format("arrayloom").option("columns", columns).load(file)
    folder = scratch(spark)
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").start(f"{folder}/rows")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query("SELECT l_orderkey, l_linenumber FROM lineitem")
def small_batches(spark, sf_dir):
    """Batches of the size that the session sets."""
    before = spark.conf.get("spark.arrayloom.batchSize", None)
    spark.conf.set("spark.arrayloom.batchSize", "64KB")
    try:
        return api.read(spark, lineitem_chunked(spark, sf_dir), "/l_orderkey", "/l_linenumber", mode="full", swmr=True)
    finally:
        spark.conf.unset("spark.arrayloom.batchSize") if before is None else spark.conf.set("spark.arrayloom.batchSize", before)


@query("SELECT true AS engine, true AS spark")
def versions(spark, sf_dir):
    return spark.range(1).select(api.version().alias("v")).select((F.length("v.engine") > 0).alias("engine"), (F.length("v.spark") > 0).alias("spark"))


@query(f"SELECT f.run AS file, i AS row, (i * 10 + 7 + 100 * f.run)::BIGINT AS eighth, 10 AS n FROM (VALUES (0), (1)) f(run), {X}")
def filtered_chunks(spark, sf_dir):
    """Chunks that cut both dimensions, through shuffle, deflate and checksum, of either format version."""
    rows = api.read(spark, edge_files(spark, sf_dir), api.index(), "/chunked", "/run")
    return rows.select((F.col("run") - 1.5).cast("int").alias("file"), F.col("index").cast("int").alias("row"), F.get("chunked", F.lit(7)).alias("eighth"), F.size("chunked").alias("n"))
