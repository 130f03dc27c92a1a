"""Columns named as those of the operators, columns that cannot be null, and equal rows in a mix."""

from collections import Counter

import pytest
from pyspark.sql import functions as F, types as T

from filmdw.llm import langid, mixing, neardup, phrases
from filmdw.llm.words import free_name
from tests.llm import brute

NAMES = (
    "_pattern", "_order", "_size", "_tie", "_doc", "_row", "_several", "_language_rejected", "_language_score",
    "mix_copies", "row", "node", "block", "carried", "kept", "n_words", "_read",
)


def strict(spark):
    """Awkward rows without nulls, in columns that cannot be null, beside others of clashing names."""
    rows = [(r[0], r[1], r[2] or "en", r[3] or "a", *(f"{name}-{r[0]}" for name in NAMES)) for r in brute.awkward_rows() if None not in r[:2]]
    named = [("doc_id", T.LongType()), *((n, T.StringType()) for n in ("text", "lang", "source", *NAMES))]
    schema = T.StructType([T.StructField(n, kind, False) for n, kind in named])
    return spark.createDataFrame(rows, schema)


STAGES = [langid.accepted, neardup.one_of_each, phrases.deduplicated, mixing.take]


@pytest.mark.parametrize("stage", STAGES, ids=lambda stage: stage.__name__)
def test_clashing_columns_keep_their_values(spark, stage):
    docs = strict(spark)
    plain = stage(docs.select("doc_id", "text", "lang", "source"))
    found = stage(docs)
    assert found.columns == docs.columns
    rows = found.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in plain.collect())
    assert rows and all(r[name] == f"{name}-{r['doc_id']}" for r in rows for name in NAMES)


def test_free_names():
    assert free_name(["a", "_row", "__ROW"], "_row") == "___row" and free_name([], "x") == "x"


def test_equal_rows_are_taken_as_far_as_the_target(spark):
    """300 copies of one row, a third of all words, beside others."""
    rows = [(7, "one two three four five", "a")] * 300 + [(i, "w " * (1 + i % 9), "a" if i % 2 else "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(9)
    for given in (docs, docs.where("source = 'a' AND doc_id = 7").unionByName(docs.where("source = 'b'"))):
        found = mixing.mix(given).collect()
        taken, target, largest = Counter(), {}, Counter()
        for r in found:
            taken[r["source"]] += r["mix_copies"] * r["mix_size"]
            target[r["source"]] = r["mix_target"]
            largest[r["source"]] = max(largest[r["source"]], r["mix_size"])
        assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
        again = Counter((r["doc_id"], r["text"], r["mix_copies"]) for r in mixing.mix(given.repartition(4)).collect())
        assert again == Counter((r["doc_id"], r["text"], r["mix_copies"]) for r in found)
        assert mixing.take(given).count() == sum(r["mix_copies"] for r in found)


def test_a_given_copies_column_is_replaced(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 9)], "doc_id long, text string, source string, mix_copies int")
    row = mixing.mix(docs).first()
    assert row["mix_copies"] == 1 and mixing.mix(docs).columns.count("mix_copies") == 1
    assert mixing.take(docs.withColumn("n", F.lit(1))).first()["mix_copies"] == 9
