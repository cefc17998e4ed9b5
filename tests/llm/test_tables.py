"""The registered queries on a whole small table: against DuckDB where there is SQL, and the pipeline against plain steps."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

from arrayloom.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_against_duckdb(spark, con, name):
    want = con.execute(registry.ORACLES[name])
    columns = [d[0] for d in want.description]
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(want.fetchall())


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline
    from arrayloom.llm import bpe, mixing, neardup, secrets

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.withColumn("size", F.lit("s")).withColumn("spans", F.lit(1)).withColumn("taken", F.lit(2)).unionByName(spark.createDataFrame([(None, None, None, None, None, "s", 1, 2)], [*docs.schema.names, "size", "spans", "taken"] and "doc_id long, text string, lang string, source string, n_chars long, size string, spans int, taken int"))
    kept = pipeline.drop_toxic(spark, extra, SF)
    assert kept.columns == extra.columns
    scores = {r.doc_id: r.score for r in registry.QUERIES["op1_toxicity_pu"](spark, SF).collect()}
    assert 0 < kept.count() < extra.count() and sum(s < 0.5 for s in scores.values()) > 0.7 * len(scores)
    one = pipeline.drop_near_copies(spark, extra, SF)
    found = registry.QUERIES["op7_minhash_multi_index"](spark, SF).filter("kept").select("doc_id").collect()
    assert sorted(r.doc_id for r in one.collect() if r.doc_id is not None) == sorted(r.doc_id for r in found) and one.columns == extra.columns
    clean = pipeline.mask_secrets(spark, extra, SF)
    assert clean.columns == extra.columns and clean.count() == extra.count()
    for r in clean.collect():
        assert not secrets.base_spans(r.text or "") and (r.text is None or r.n_chars == len(r.text))
    mixed = pipeline.mix_sources(spark, extra, SF)
    assert mixed.columns == extra.columns
    plan = mixing.mix(extra.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    want = {r.doc_id: r.taken for r in plan.collect() if r.taken}
    got = collections.Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(r.text.encode().split())
    assert got == want
    assert set(pipeline.encode(spark, extra, SF).columns) >= {"doc_id", "n_tokens", "ids"} and bpe and neardup
    assert 4 <= len(pipeline.STAGES) <= 5


def test_pipeline_run(spark):
    import corpus_pipeline as pipeline

    out = pipeline.run(spark, SF)
    rows = out.collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)
    sources = {r.source for r in rows}
    assert len(sources) == 20
    again = {(r.doc_id, tuple(r.ids)) for r in pipeline.run(spark, SF).collect()}
    assert again == {(r.doc_id, tuple(r.ids)) for r in rows}
