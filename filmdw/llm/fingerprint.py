"""Document fingerprints: the k smallest hashes of a text's shingles of five words.

Fingerprints of parts merge into that of their union, and estimate resemblance, containment and
the number of distinct shingles; up to k shingles all of these are exact. Only built-in functions
are used.

Defined results: a text of one to four words is one shingle; a null, empty or blank text has none,
and its fingerprint is empty; two empty fingerprints resemble each other by 1, an empty and another
one by 0. Fingerprints do not depend on row order or partitioning; equal texts have equal ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from filmdw.llm.words import text_or_empty, with_five_word_hashes, words_of
from filmdw.session import write_stage

SMALLEST = 128
BITS = 48


def with_sketch(df: DataFrame, text: str, out: str, k: int = SMALLEST) -> DataFrame:
    """Add ``out``: the ascending array of the k smallest 48-bit shingle hashes of a text column."""
    kept = df.columns
    words, five = f"{out}_words", f"{out}_five"
    df = with_five_word_hashes(df.withColumn(words, words_of(F.col(text))), words, five)
    short = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(
        F.array().cast("array<bigint>")
    )
    shingles = F.when(F.size(words) >= 5, F.col(five)).otherwise(short)
    values = F.transform(shingles, lambda h: F.shiftrightunsigned(h, 64 - BITS))
    return df.withColumn(out, F.slice(F.sort_array(F.array_distinct(values)), 1, k)).select(*kept, out)


def merged(left: Column, right: Column, k: int = SMALLEST) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, k)


def resemblance(left: Column, right: Column, k: int = SMALLEST) -> Column:
    """Estimated size of the intersection over size of the union, 0 to 1."""
    union = merged(left, right, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(left, right)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def distinct_shingles(sketch: Column, k: int = SMALLEST) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    full = (k - 1) * F.lit(2.0**BITS) / (F.element_at(sketch, -1) + 1)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(full)


def containment(left: Column, right: Column, k: int = SMALLEST) -> Column:
    """Estimated part of the left shingles that the right text also has, 0 to 1."""
    near = resemblance(left, right, k)
    own, other = distinct_shingles(left, k), distinct_shingles(right, k)
    return F.when(F.size(left) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), near * (own + other) / (1 + near) / own)
    )


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), BITS // 4, "0")), "")


def fingerprints(docs: DataFrame, k: int = SMALLEST) -> DataFrame:
    """doc_id, fingerprint (text) and n_shingles (estimate) of every row."""
    rows = with_sketch(docs.select("doc_id", "text"), "text", "_sketch", k)
    return rows.select(
        "doc_id", as_text(F.col("_sketch")).alias("fingerprint"), distinct_shingles(F.col("_sketch"), k).alias("n_shingles")
    )


def followers(docs: DataFrame) -> DataFrame:
    """doc_id, next_id (the next larger id; the smallest after the largest) and need (a quarter of
    the text's characters), without a global window: ids are dealt by range, and the first id of
    a range follows the last one of the range before it."""
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.floor(F.length(text_or_empty(F.col("text"))) / 4)).cast("int").alias("need")
    )
    ranged = ids.repartitionByRange("doc_id").withColumn("_part", F.spark_partition_id())
    rows = write_stage(ranged, "followers")
    # one row for each range partition
    firsts = rows.groupBy("_part").agg(F.min("doc_id").alias("_first"))
    in_order = Window.orderBy("_part")
    across = firsts.select(
        "_part",
        F.coalesce(F.lead("_first").over(in_order), F.min("_first").over(Window.partitionBy())).alias("_over"),
    )
    inside = F.lead("doc_id").over(Window.partitionBy("_part").orderBy("doc_id"))
    return (
        rows.withColumn("_inside", inside)
        .join(F.broadcast(across), "_part")
        .select("doc_id", F.coalesce("_inside", "_over").alias("next_id"), "need")
    )


def edited_likeness(docs: DataFrame, k: int = SMALLEST) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and to the
    next document's.

    The edited text has its last quarter of characters replaced by as many from the start of the next
    document. Where rows share an id, that document's text is the smallest of theirs; a row without an
    id has no next document. Texts are dealt by id once; the exchange is used from both sides.
    """
    texts = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    # both uses below read the same exchange, so both have the same filter
    dealt = texts.where("doc_id IS NOT NULL").repartition("doc_id")
    links = followers(docs)
    alone = dealt.groupBy("doc_id").agg(F.min("text").alias("text"))
    ahead = alone.join(links.withColumnRenamed("doc_id", "_before"), F.col("doc_id") == F.col("next_id"))
    ahead = with_sketch(ahead, "text", "_next", k).select(
        F.col("_before").alias("doc_id"),
        F.substring("text", F.lit(1), F.col("need")).alias("_start"),
        "_next",
    )
    nothing = [F.lit(None).cast("string").alias("_start"), F.lit(None).cast("array<bigint>").alias("_next")]
    nameless = texts.where("doc_id IS NULL").select("*", *nothing)
    rows = dealt.join(ahead, "doc_id").unionByName(nameless).withColumn("n_chars", F.length("text"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars") - quarter),
        F.substring(F.coalesce("_start", F.lit("")), F.lit(1), quarter),
    )
    rows = rows.withColumn("_edited_text", edited)
    rows = with_sketch(with_sketch(rows, "text", "_own", k), "_edited_text", "_edited", k)
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("_edited_text", 256).alias("edited_sha256"),
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_edited")).alias("edited_fingerprint"),
        resemblance(F.col("_own"), F.col("_edited"), k).alias("near_edited"),
        resemblance(F.col("_own"), F.col("_next"), k).alias("near_next"),
        distinct_shingles(F.col("_own"), k).alias("n_shingles"),
    )
