"""The exact filter between open buckets, against all pairs."""

import random

from filmdw.llm import neardup
from tests.llm import brute


def texts_around_the_threshold():
    """Copies of three bases with 0 to 12 changed words, of several lengths, with a passage many share."""
    rng, passage, out = random.Random(5), brute.sentence(60, 30), []
    for base in (brute.sentence(61, 40), brute.sentence(62, 90), brute.sentence(63, 200)):
        for changes in list(range(13)) * 3:
            words = list(base)
            for i in range(changes):
                words[rng.randrange(len(words))] = f"changed{rng.randrange(40)}"
            out.append(" ".join(words + (passage if rng.random() < 0.5 else [])))
    return [*dict.fromkeys(out), "one", "two words", "three words here", " ".join(passage)]


def test_no_similar_pair_is_lost(spark):
    texts = texts_around_the_threshold()
    sets = [brute.shingle_set(t, 3) for t in texts]
    similar = {
        (a, b)
        for b in range(len(texts))
        for a in range(b)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    table = spark.createDataFrame(list(enumerate(texts)), "node long, text string").repartition(3)
    nodes = table.selectExpr("node", "node AS component")
    found = {tuple(r) for r in neardup.pairs_between(nodes, table, 3, 80).collect()}
    every = len(texts) * (len(texts) - 1) // 2
    assert len(similar) > 50 and similar <= found and len(found) < every / 4
    confirmed = neardup.confirmed(spark.createDataFrame(sorted(found), "p long, x long"), table, 3, 80)
    assert {tuple(r) for r in confirmed.collect()} == similar


def test_pairs_within_a_component_are_not_met(spark):
    rows = [(i, " ".join(brute.sentence(1, 40)) + f" end{i}", i // 2) for i in range(6)]
    table = spark.createDataFrame(rows, "node long, text string, component long")
    found = neardup.pairs_between(table.select("node", "component"), table.select("node", "text"), 4, 80)
    assert {tuple(r) for r in found.collect()} == {(a, b) for b in range(6) for a in range(b) if a // 2 != b // 2}


def test_nothing_open(spark):
    nodes = spark.createDataFrame([], "node long, component long")
    texts = spark.createDataFrame([], "node long, text string")
    assert neardup.pairs_between(nodes, texts, 4, 80).count() == 0
    links, labels = neardup.link_classes(spark.createDataFrame([], "key long, node long"), texts, 4, 80)
    assert links.count() == labels.count() == 0
