"""Quality rules, and a log-likelihood ratio of hashed n-grams against the documents labelled good.

Two multinomials over hashed pairs of tokens are counted: one over every document, one over
documents labelled good. A document's score is the mean log ratio of its pairs. The threshold
separates good from bad best among those that pass the base rules; a document is kept when it
passes the base rules and its score reaches the threshold.

Every label is used: a seeded hash of the id deals one half to the counts and one to the threshold.
The threshold is the best of all scores, found by running sums over ranges of them. The driver holds one
number pair per bucket, and a pass over the texts' buckets is sent one bit a document. Texts are tokenised once: base rules and the buckets of a document's
pairs are written, and counted and scored from there. Only built-in functions are used.

Defined results: a null or empty text has no words and fails the base rules; without good labels
every document that passes them is kept; labels without a document, repeated labels (the largest
counts) and extra columns do no harm.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from filmdw.llm.words import GAP_CHARACTERS, head, tail, text_or_empty, with_five_word_hashes, without, words_of
from filmdw.session import write_stage

BUCKETS = 16_384
SEED = 8
SMOOTHING = 1.0
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: letters and digits in runs, any other visible character alone
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


def labelled(labels: DataFrame, seed: int = SEED) -> DataFrame:
    """_doc, _good, _fits (counted for the target) and not _fits (sets the threshold) of every label."""
    order = F.xxhash64(F.lit(seed), F.col("_doc"))
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg((F.max("quality") > 0).alias("_good"))
    )
    return known.withColumn("_fits", F.pmod(order, F.lit(2)) == 0)


def with_grams(docs: DataFrame, buckets: int) -> DataFrame:
    """Add ``_grams``: the bucket of every pair of neighbouring tokens (of a lone token: its own)."""
    kept = docs.columns
    tokens = F.regexp_extract_all(text_or_empty(F.col("text")), F.lit(TOKEN), F.lit(0))
    pairs = F.zip_with(
        head(F.col("_tokens"), 1), tail(F.col("_tokens"), 1), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets))
    )
    alone = F.transform("_tokens", lambda a: F.pmod(F.xxhash64(a), F.lit(buckets)))
    return (
        docs.withColumn("_tokens", tokens)
        .withColumn("_grams", F.when(F.size("_tokens") > 1, pairs).otherwise(alone))
        .select(*kept, "_grams")
    )


def log_ratios(rows: DataFrame, known: DataFrame, buckets: int = BUCKETS) -> list[float] | None:
    """Log of target over corpus probability for each bucket of ``_grams``; None without a trusted document.

    ``_row`` numbers the rows in partitions, as ``monotonically_increasing_id`` does.
    """
    target = known.where("_good AND _fits").select("_doc")
    # one bit a row, by its number, so that only ids are shuffled to meet the labels
    word, bit = F.shiftright("_row", 6), F.expr("shiftleft(1L, CAST(_row & 63 AS INT))")
    found = rows.select("doc_id", "_row").join(target, F.col("doc_id") == F.col("_doc"), "left_semi")
    bits = found.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = rows.withColumn("_word", word).join(F.broadcast(bits), "_word", "left")
    grams = marked.select(F.explode("_grams").alias("_gram"), F.when(F.col("_bits").bitwiseAND(bit) != 0, 1).alias("_target"))
    counts = grams.groupBy("_gram").agg(F.count("*").alias("n"), F.count("_target").alias("t")).collect()
    corpus = {r["_gram"]: r["n"] for r in counts}
    trusted = {r["_gram"]: r["t"] for r in counts}
    n, t = sum(corpus.values()), sum(trusted.values())
    if not t:
        return None
    rest = SMOOTHING * buckets
    return [
        math.log((trusted.get(b, 0) + SMOOTHING) / (t + rest)) - math.log((corpus.get(b, 0) + SMOOTHING) / (n + rest))
        for b in range(buckets)
    ]


def with_score(rows: DataFrame, ratios: list[float] | None) -> DataFrame:
    """``score`` in place of ``_grams``: the mean log ratio of a document's pairs; 0 without any."""
    if ratios is None:
        return rows.withColumn("score", F.lit(0.0)).drop("_grams")
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    rows = rows.withColumn(
        "_sum", F.aggregate("_grams", F.lit(0.0), lambda done, g: done + F.get(table, g.cast("int")))
    )
    return rows.withColumn("score", F.col("_sum") / F.greatest(F.size("_grams"), F.lit(1))).drop("_grams", "_sum")


def best_threshold(scored: list[tuple[float, bool]]) -> float:
    """The score that separates good from bad best: the most good kept less the most bad kept, as shares."""
    good, bad = sum(g for _, g in scored), sum(not g for _, g in scored)
    if not good:
        return -math.inf
    best, at, kept_good, kept_bad = -1.0, -math.inf, 0, 0
    ordered = sorted(scored, key=lambda x: (-x[0], x[1]))
    for i, (score, is_good) in enumerate(ordered):
        kept_good, kept_bad = kept_good + is_good, kept_bad + (not is_good)
        if i + 1 < len(ordered) and ordered[i + 1][0] == score:
            continue
        gain = kept_good / good - (kept_bad / bad if bad else 0)
        if gain >= best:
            # half way to the next score, so that documents near the last one kept are kept too
            below = ordered[i + 1][0] if i + 1 < len(ordered) else score
            best, at = gain, (score + below) / 2
    return at


def best_threshold_of(held: DataFrame) -> float:
    """``best_threshold`` of a table (score, _good) of any size.

    Distinct scores are dealt by ranges from the highest and written; what is kept down to a score is what
    the ranges before hold, one row each, and a running sum inside its own range.
    """
    each = held.groupBy("score").agg(F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad"))
    ranged = each.repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id())
    ranged = write_stage(ranged, "threshold")
    every = Window.partitionBy(F.lit(0))
    ahead = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad")).select(
        "part",
        F.sum("n_good").over(every).alias("all_good"),
        F.sum("n_bad").over(every).alias("all_bad"),
        F.coalesce(F.sum("n_good").over(ahead), F.lit(0)).alias("good_ahead"),
        F.coalesce(F.sum("n_bad").over(ahead), F.lit(0)).alias("bad_ahead"),
    )
    down = Window.partitionBy("part").orderBy(F.desc("score"))
    kept_good = F.col("good_ahead") + F.sum("good").over(down)
    kept_bad = F.col("bad_ahead") + F.sum("bad").over(down)
    share_bad = F.when(F.col("all_bad") > 0, kept_bad / F.col("all_bad")).otherwise(0.0)
    placed = ranged.join(F.broadcast(parts), "part").where("all_good > 0")
    gains = placed.select("score", (kept_good / F.col("all_good") - share_bad).alias("gain"))
    best = gains.orderBy(F.desc("gain"), "score").first()
    if best is None:
        return -math.inf
    below = ranged.where(F.col("score") < best["score"]).agg(F.max("score")).first()[0]
    return (best["score"] + (best["score"] if below is None else below)) / 2


def with_base_rules(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    kept = docs.columns
    text = text_or_empty(F.col("text"))
    rows = docs.withColumn("_words", words_of(F.col("text")))
    lines = F.filter(F.split(text, "\n"), lambda line: without(line, GAP_CHARACTERS) != "")
    rows = with_five_word_hashes(rows.withColumn("_lines", lines), "_words", "_five")
    rows = rows.withColumn(
        "_twice", (F.size("_five") > 1) & (F.size(F.array_distinct("_five")) < F.size("_five"))
    )
    # places of windows that occur again: sorted by hash, those equal to a neighbour
    sorted_windows = F.when(
        F.col("_twice"), F.array_sort(F.transform("_five", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    )
    rows = rows.withColumn("_sorted", sorted_windows)
    again = F.filter(
        "_sorted",
        lambda w, i: (w["h"] == F.get("_sorted", i - 1)["h"]) | (w["h"] == F.get("_sorted", i + 1)["h"]),
    )
    rows = rows.withColumn("_starts", F.sort_array(F.transform(again, lambda w: w["i"])))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda done, start: F.struct(
            (done["n"] + F.least(F.lit(5), start + 5 - done["to"])).alias("n"), (start + 5).alias("to")
        ),
        lambda done: done["n"],
    )
    n_words = F.size("_words").cast("long")
    bare = F.length(without(text, GAP_CHARACTERS))
    rows = rows.select(
        *kept,
        n_words.alias("n_words"),
        bare.cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_twice"), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, the base rules, score, threshold and kept for every row of ``docs``."""
    kind = "array<short>" if buckets <= 1 << 15 else "array<int>"
    rows = with_grams(with_base_rules(docs.select("doc_id", "text")), buckets).drop("text")
    rows = rows.withColumn("_grams", F.col("_grams").cast(kind)).withColumn("_row", F.monotonically_increasing_id())
    rows = write_stage(rows, "grams")
    known = labelled(labels, seed)
    ratios = log_ratios(rows, known, buckets)
    scored, threshold = with_score(rows.drop("_row"), ratios), -math.inf
    if ratios is not None:
        # without the buckets, so that no more than ids and scores meet the labels
        scored = write_stage(scored, "scores")
        passed = scored.where("NOT base_failed").select("doc_id", "score")
        held = passed.join(known.where("NOT _fits"), F.col("doc_id") == F.col("_doc"))
        threshold = best_threshold_of(held.select("score", "_good"))
    verdict = ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        verdict.alias("kept"), "score", F.lit(threshold).alias("threshold"),
    )
