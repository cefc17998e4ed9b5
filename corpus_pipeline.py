"""A corpus from documents to token ids: toxic texts go, near copies go, secrets are masked, sources are mixed, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes and reads again as the next
stage's ``docs``. All but the last return the columns of ``documents``. Rows without a text pass the first three
stages; the mix takes no words of them, so they end there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrayloom.llm import bpe, mixing, neardup, secrets, toxicity
from arrayloom.llm.common import BLANKS, materialise, table, word_count

#: The stages of a trained model and of random keys can't be told in SQL; tests hold them against plain versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), out="__score")
    return scored.filter("__score < 0.5").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least id, of each group of near copies."""
    return neardup.deduplicate(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each run of secrets replaced by a mark."""
    clean = secrets.scan(docs, secrets.learn(docs), redact=True, out="__spans")
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one that a source's budget cuts ends after its last word taken."""
    # The row travels in one column, so that none of its own names can clash.
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.struct(*docs.columns).alias("row"))
    mixed = mixing.mix(rows).filter("taken > 0").withColumn("rest", F.expr("cast(taken % size as int)"))
    copies = F.expr("taken div size") + F.when(F.col("rest") > 0, 1).otherwise(0)
    each = mixed.select("row", "size", "taken", "rest", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"))
    text = F.col("row.text")
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    cut = F.array_join(F.slice(words, F.lit(1), F.greatest("rest", F.lit(1))), " ")
    text = F.when(F.col("copy") * F.col("size") > F.col("taken"), cut).otherwise(text)
    own = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in own:
        own["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return each.select(*[v.alias(c) for c, v in own.items()])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of what they decode to, in place of its text."""
    return bpe.code(docs, ("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
