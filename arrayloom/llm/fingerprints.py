"""I-Match fingerprints in DataFrame functions only: terms of a document-frequency band, several random lexicons.

A term is a lower-cased word, known by its 64-bit hash. The lexicon holds the terms whose share of documents
lies in a band, that is, of an inverse document frequency in a band. A term in at least a share s of the N
documents is counted s N times or more, so there are at most (mean distinct terms of a document) / s such
terms, however large N is: the lexicon may be sent to every task.

A fingerprint has SUBSETS parts, each the hash of the sorted distinct terms of a random part of the lexicon
(of several sizes, for short texts and long ones), and one more for all of a text's terms, which
alone counts for texts without a term of the lexicon.

Defined results: a null text is an empty one; equal texts have equal fingerprints; rows that repeat an id follow
each other by text hash; null ids come last, by text hash too; columns named as what is added are replaced, all
others pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrayloom.llm.common import BLANKS, table

#: Shares of documents that a term of the lexicon is in, at least and at most: about 1.6 to 3.9 nats of IDF.
BAND = (0.02, 0.2)
#: Parts of the lexicon hold an eighth, a sixteenth, ... a 128th of it, in turn.
SUBSETS, FIRST, SCALES = 32, 3, 5
#: The hash of an empty array.
NOTHING = 42
#: Rows of a run of neighbouring ids, at least.
RUN_ROWS = 1_024


def long_array(values) -> Column:
    """A constant array, written as one string so that it is planned as one literal."""
    values = list(values)
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def terms(text: Column) -> Column:
    """Hashes of a text's distinct words, in lower case."""
    words = F.filter(F.split(F.lower(text), BLANKS), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text: str = "text", band: tuple[float, float] = BAND) -> list[int]:
    """Hashes of the terms whose share of all documents is in the band."""
    n = docs.count()
    counts = docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # Never more than the mean number of a document's terms over the least share.
    return [r.term for r in counts.filter((F.col("df") >= band[0] * n) & (F.col("df") <= band[1] * n)).select("term").orderBy("term").collect()]


def part(kept: Column, number: int) -> Column:
    """Hash of the terms that are in the lexicon's random part ``number``; NOTHING if there are none."""
    share = 1 << FIRST + number % SCALES
    return F.xxhash64(F.filter(kept, lambda t: F.pmod(F.xxhash64(t, F.lit(number)), F.lit(share)) == 0))


def with_fingerprint(df: DataFrame, text: str, lex: Column, out: str, subsets: int = SUBSETS) -> DataFrame:
    """Adds the array of the fingerprint's parts."""
    df = df.withColumn("__found", terms(F.col(text)))
    df = df.withColumn("__kept", F.array_sort(F.array_intersect("__found", lex)))
    parts = [part(F.col("__kept"), i) for i in range(subsets)]
    return df.withColumn(out, F.array(*parts, F.xxhash64(F.array_sort("__found")))).drop("__found", "__kept")


def likeness(a: Column, b: Column, subsets: int = SUBSETS) -> Column:
    """Share of the parts, of those that either text has, which are equal; by all terms where neither has any."""
    both = F.zip_with(F.slice(a, 1, subsets), F.slice(b, 1, subsets), lambda x, y: F.when((x == NOTHING) & (y == NOTHING), F.lit(None).cast("int")).otherwise((x == y).cast("int")))
    had = F.filter(both, lambda v: v.isNotNull())
    same = F.size(F.filter(had, lambda v: v == 1))
    whole = (F.element_at(a, subsets + 1) == F.element_at(b, subsets + 1)).cast("double")
    return F.when(F.size(had) == 0, whole).otherwise(same / F.size(had)).cast("double")


def with_next(docs: DataFrame, columns: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds next_<column> of the document that follows in descending order of ids; the first follows the last.

    Ids are cut into runs at approximate quantiles, null ids by text hash, and each run is ordered by itself. The
    first row of each run is also sent, as a guest, to the end of the run before it, so that no task sees all the
    rows. The runs, and the rows of a run, grow with the square root of the rows.
    """
    n = docs.count()
    runs = n // max(RUN_ROWS, math.isqrt(n)) + 1
    cuts = docs.agg(F.percentile_approx(doc_id, [i / runs for i in range(1, runs)], max(10_000, 8 * runs))).first()[0] or [] if runs > 1 else []
    cuts = sorted(set(cuts))
    bounds, steps = long_array(cuts), [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]
    # Binary search: how many cuts are not above the id; null ids come before all cuts.
    place = F.aggregate(
        long_array(steps),
        F.lit(0).cast("long"),
        lambda at, step: F.when((at + step <= len(cuts)) & (F.get(bounds, (at + step - 1).cast("int")) <= F.col(doc_id)), at + step).otherwise(at),
    ) if cuts else F.lit(0).cast("long")
    docs = docs.withColumn("__th", F.coalesce(F.xxhash64(text), F.lit(0)))
    nameless = F.shiftright((F.shiftright("__th", 32) + F.lit(1 << 31)) * F.lit(runs), 32) - F.lit(runs)
    docs = docs.withColumn("__run", F.when(F.col(doc_id).isNull(), nameless).otherwise(place))
    # One row a run: no more than twice ``runs``.
    heads = docs.groupBy("__run").agg(F.max(F.struct(doc_id, "__th")).alias("head"))
    around = Window.partitionBy().orderBy("__run")
    least = F.min("__run").over(Window.partitionBy())
    heads = heads.select(F.col("head")[doc_id].alias("__hid"), F.col("head.__th").alias("__hth"), F.coalesce(F.lead("__run").over(around), least).alias("__to"))
    guests = docs.join(F.broadcast(heads), F.col(doc_id).eqNullSafe(F.col("__hid")) & (F.col("__th") == F.col("__hth")))
    guests = guests.withColumn("__run", F.col("__to")).withColumn("__guest", F.lit(1)).drop("__hid", "__hth", "__to")
    rows = docs.withColumn("__guest", F.lit(0)).unionByName(guests)
    order = Window.partitionBy("__run").orderBy("__guest", F.col(doc_id).desc_nulls_last(), F.col("__th").desc())
    for c in columns:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(order))
    return rows.filter("__guest = 0").drop("__guest", "__run", "__th")


def op9_i_match(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lex = long_array(lexicon(docs))
    rows = with_next(with_fingerprint(docs, "text", lex, "parts"), ["text", "parts"]).withColumn("n_chars", F.length("text").cast("long"))
    half = F.expr("cast(n_chars div 2 as int)")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    rows = with_fingerprint(rows.withColumn("edited", edited), "edited", lex, "edited_parts")
    line = lambda parts: F.concat_ws("-", F.transform(parts, lambda p: F.lower(F.hex(p))))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        line(F.col("parts")).alias("fingerprint"),
        line(F.col("edited_parts")).alias("edited_fingerprint"),
        likeness(F.col("parts"), F.col("edited_parts")).alias("near_edited"),
        likeness(F.col("parts"), F.col("next_parts")).alias("near_next"),
    )
