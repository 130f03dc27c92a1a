"""Spelling variants, ranked lexical search and nearest neighbours against plain versions."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmdw.llm import forest, signatures, spelling
from filmdw.llm.queries import ORACLE_SQL, QUERIES
from tests.llm import brute
from tests.oracle_check import connect, difference

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
CLASHING = ("n", "word", "side", "shard", "row", "rank", "score", "query", "block", "place")


def crowded(df):
    """With columns named as those of the operators."""
    return df.withColumns({name: F.lit(7) for name in CLASHING})


@pytest.fixture(scope="module")
def small(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# ---- 11


def one_edit(a: str, b: str) -> bool:
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_vocabulary(rows) -> dict[str, int]:
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 2}


def plain_variants(n: dict[str, int]) -> list[tuple]:
    by_deletion, near, form = defaultdict(set), defaultdict(set), {}
    for word in n:
        for key in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}:
            by_deletion[key].add(word)
    for words in by_deletion.values():
        for a in words:
            near[a] |= {b for b in words if one_edit(a, b)}
    for word in n:
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        if best is not None and n[best] >= 10 * n[word]:
            form[word] = best
    out = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n[word], len(near[word]), n.get(form.get(word))))
    return sorted(out, key=repr)


def found_variants(df) -> list[tuple]:
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_variants_of_documents(spark, small):
    assert found_variants(QUERIES["op11_search_schemes"](spark, SF)) == plain_variants(plain_vocabulary(small))


@pytest.mark.parametrize("entries, hot", [(60_000, 20_000), (50, 3), (7, 1)])
def test_variants_in_small_shards_and_split_halves(spark, entries, hot):
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("abé"), rng.integers(7, 11))) for _ in range(700)} | {"aaaaaaa", "aaaaaaaa"}
    n = {w: int(10 ** rng.integers(0, 5) * 2 + rng.integers(0, 9)) for w in sorted(words)}
    given = spark.createDataFrame(list(n.items()), "word string, n long")
    want = plain_variants(n)
    assert max(x[4] for x in want) > 5 and any(x[1] and x[2] != x[1] for x in want)
    assert found_variants(spelling.group_variants(given, entries, hot)) == want


def test_chains_of_forms_are_followed_to_the_end(spark):
    n = {"abcdefg" + "x" * i: 2 * 10**i for i in range(9)}
    given = spark.createDataFrame(list(n.items()), "word string, n long")
    found = found_variants(spelling.group_variants(given))
    assert found == plain_variants(n) and {x[2] for x in found} == {"abcdefgxxxxxxxx"}


def test_variants_of_awkward_rows(spark):
    long = "Wörterbuch " * 100_000 + "wörterbüch woerterbuch wörterbuc"
    extra = [(40, long), (41, "wörterbüch Ünicode ÜNICODE ünicode 汉字汉字汉字汉字"), (41, "wörterbüch Ünicode"), (None, None)]
    rows = [r[:2] for r in brute.awkward_rows()] + extra
    docs = crowded(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found_variants(spelling.spelling_variants(docs)) == plain_variants(plain_vocabulary(rows))
    assert spelling.spelling_variants(brute.empty(spark)).count() == 0


# ---- 12


def plain_ranking(rows, items, k=10) -> list[tuple]:
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(i, Counter(term.findall((text or "").translate(LOWER)))) for i, text in rows]
    docs = [(i, counts, sum(counts.values())) for i, counts in docs if counts]
    all_docs, occurrences = len(docs), sum(size for _, _, size in docs)
    held_by = Counter(t for _, counts, _ in docs for t in counts)
    out = []
    for item, text in items:
        weights = {
            t: math.floor(1000 * math.log((2 * all_docs + 2) / (2 * held_by[t] + 1)))
            for t in set(term.findall((text or "").translate(LOWER)))
        }
        scores = []
        for doc_id, counts, size in docs:
            m = 100 - 90 + (90 * size * all_docs) // occurrences
            shared = weights.keys() & counts.keys()
            score = sum(weights[t] * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m)) for t in shared)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        ranked = sorted(scores)[:k]
        out += [(item, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(ranked, 1)]
    return sorted(out, key=repr)


def found_ranking(df) -> list[tuple]:
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_ranking_of_documents(spark, small):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert found_ranking(QUERIES["op12_bit_slices"](spark, SF)) == plain_ranking(small, items)


def test_ranking_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    query = QUERIES["op12_bit_slices"](spark, sf_dir)
    assert difference(query, connect(sf_dir), ORACLE_SQL["op12_bit_slices"]) is None


def test_ranking_of_awkward_rows(spark, monkeypatch):
    copies = [(100 + i, "alpha beta gamma") for i in range(40)]
    often = [(200, "alpha " * 70), (201, "ALPHA alpha beta"), (202, "alpha " * 400_000 + "rare"), (203, "É é alpha")]
    rows = [r[:2] for r in brute.awkward_rows()] + copies + often
    items = [(1, "Alpha delta rare"), (2, "beta"), (3, None), (4, " ,. "), (5, "not there"), (6, "É 漢字 one two")]
    docs = crowded(spark.createDataFrame(rows, "doc_id long, text string"))
    asked = crowded(spark.createDataFrame(items + [(None, "alpha"), (2, "beta")], "item_id long, text string"))
    want = plain_ranking(rows, items)
    assert found_ranking(signatures.rank_documents(docs, asked)) == want
    # blocks of items give the same
    assert found_ranking(signatures.search(signatures.build(docs), asked, most_items=2)) == want
    empty = brute.empty(spark)
    assert signatures.rank_documents(empty, asked).count() == 0
    assert signatures.rank_documents(docs, asked.limit(0)).count() == 0


def test_bounds_are_never_below_scores():
    rng = np.random.default_rng(3)
    vocabulary = [f"t{i}".encode() for i in range(300)]
    pending = signatures._Pending()
    for i in range(200):
        words = rng.choice(vocabulary, rng.integers(1, 400), p=(w := 1 / np.arange(1, 301)) / w.sum()).tolist()
        pending.add(i, b" ".join(words), Counter(words))
    row = pending.row(1, 12 << 8)
    items = signatures._Items(list(range(20)), [b" ".join(rng.choice(vocabulary, 30).tolist()) for _ in range(20)])
    items.weigh(dict(zip(row["terms"], row["held_by"])), row["documents"], row["occurrences"])
    block = signatures._Block(row, items)
    bounds = block.bounds()
    scores = np.array([[block.score(i, d) for d in range(200)] for i in range(20)])
    assert (bounds >= scores).all() and (bounds < 1.5 * scores).mean() > 0.5


# ---- 13


def plain_neighbours(rows, k=20) -> dict[int, list[tuple]]:
    usable = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    ]
    out = {}
    for own in sorted({i for i, _ in usable if i % 20 == 0}):
        query = min((v for i, v in usable if i == own), key=tuple)
        others = {(i, tuple(v)) for i, v in usable if i != own and len(v) == len(query)}
        scored = {(-float((np.array(v) * query).sum()), i) for i, v in others}
        out[own] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def found_neighbours(df) -> dict[int, list[tuple]]:
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return dict(out)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    given = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding")
    want = plain_neighbours([tuple(r) for r in given.collect()])
    found = found_neighbours(QUERIES["op13_prefix_forest"](spark, f"/root/testdata/{sf}"))
    assert found.keys() == want.keys() and all(len(found[q]) == len(want[q]) for q in want)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) > 0.95
    exact = {q: dict(rows) for q, rows in want.items()}
    assert all(abs(s - exact[q].get(i, s)) < 1e-12 for q, rows in found.items() for i, s in rows)


def test_recall_of_unequal_lengths_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHARD_ROWS", 300)
    rng = np.random.default_rng(1)
    points = rng.standard_normal((40, 16))[rng.integers(0, 40, 2000)] + 0.3 * rng.standard_normal((2000, 16))
    points *= rng.lognormal(0, 0.7, (2000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    asked = given.where("vec_id % 20 = 0")
    found, want = found_neighbours(forest.search(forest.build(given), asked, block=30)), plain_neighbours(rows)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert found.keys() == want.keys() and hits > 0.9 * 20 * len(want)


def test_neighbours_of_awkward_rows(spark):
    same = [(1000 + i, [1.0, 2.0, 3.0]) for i in range(60)]
    rows = [
        (0, [1.0, 2.0, 3.0]),
        (20, [0.0, 0.0, 0.0]),
        (40, [1.0, None, 2.0]),
        (60, [1.0, float("nan"), 2.0]),
        (80, [float("inf"), 1.0, 1.0]),
        (100, None),
        (120, []),
        (140, [1.0, 2.0]),
        (141, [3.0, 4.0]),
        (160, [-1.0, -2.0, -3.0]),
        (180, [5.0, 0.0, 1.0]),
        (180, [5.0, 0.0, 1.0]),
        (180, [4.0, 0.0, 1.0]),
        (-20, [1e-9, 1e9, 0.0]),
        (None, [1.0, 1.0, 1.0]),
        *same,
    ]
    given = crowded(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found, want = found_neighbours(forest.neighbours(given)), plain_neighbours(rows)
    assert found == want and found[0][0][0] == -20 and found[140] == [(141, 11.0)]
    assert forest.neighbours(given.limit(0)).count() == 0


def test_chance_of_a_miss(spark):
    bits = forest._bits_for(np.array([0.9, 0.5, 0.0, -np.inf, 1.0]), np.ones(5), 1.0, forest.MISS)
    assert bits[-1] == forest.BITS and bits[3] == 0 and (np.diff(bits[:4]) < 0).all()
    stays = 1 - np.arccos([0.9, 0.5, 0.0]) / np.pi
    assert ((1 - stays ** bits[:3]) ** forest.TREES <= forest.MISS).all()
