"""What the corpus operators share: word rules, shared scratch tables and deterministic prefix sums."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a maximal run of anything but space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


class Kept(dict):
    """Values by key, made on first use, in two generations: what is not asked for while a whole one fills up is dropped."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        out = self.old.get(key)
        self[key] = out = self.make(key) if out is None else out
        return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; a temporary one only where the session names none and all runs in one process."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="arrayloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and returns a reader of it; cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/arrayloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_join(left: DataFrame, right: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``left.join(right, key, how)`` for a ``right`` of at most one row a key, with the hot keys of ``left`` split.

    A key is hot beyond a thousandth of the rows of ``left`` (and 1,000): fewer than a thousand keys are, so their
    list may be sent to every task. Their rows are dealt over parts by the hash of the column ``by``, and the row
    of ``right`` is copied to each part: fewer than 2,000 copies in all.
    """
    many = max(left.count() // 1_000, 1_000)
    hot = left.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > many).select(key, F.ceil(F.col("__n") / many).cast("int").alias("__parts"))
    parts = F.coalesce("__parts", F.lit(1))
    left = left.join(F.broadcast(hot), key, "left").withColumn("__part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("__parts")
    right = right.join(F.broadcast(hot), key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return left.join(right, [key, "__part"], how).drop("__part")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null. Counts run starts, without building the words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_buckets(rows: int) -> int:
    """Hash buckets for a group so that both a bucket and the list of buckets stay near the square root of the rows."""
    return max(1, math.isqrt(max(rows, 1)) // 4 * 2 + 1)


def prefix_sums(df: DataFrame, group: list[str], order: list[Column], bucket: Column, size: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over the rows of the same group that come before, in the order (bucket, *order).

    ``bucket`` must be a deterministic, evenly spread function of the row that grows with ``order``. Sums of
    (group, bucket) are pre-aggregated before the shuffle, their running sums are joined back, and only the
    rows of one bucket are ordered in one task; a hot group is thus spread over all its buckets. Only
    deterministic expressions take part, so any stage can be run again after a loss.
    """
    df = df.withColumn("__bucket", bucket)
    keys = [*group, "__bucket"]
    sums = df.groupBy(*keys).agg(F.sum(size).alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    on = None
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        on = same if on is None else on & same
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, on)
    return joined.withColumn(out, F.col("__start") + F.coalesce(F.sum(size).over(inside), F.lit(0))).drop("__bucket", "__start", *[f"__k{i}" for i in range(len(keys))])
