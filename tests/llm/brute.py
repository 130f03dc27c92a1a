"""Plain versions of the operators, and small tables with every awkward case."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for columns of their own
        *[T.StructField(n, T.StringType()) for n in ("block", "node", "row", "size", "start", "key", "score", "piece")],
    ]
)


def sentence(seed: int, n: int, letters: str = "abcdefghij") -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(n)]


def awkward_rows() -> list[tuple]:
    base, other = sentence(1, 120), sentence(2, 300)
    near = [*base[:60], "changed", *base[61:]]
    nearer = [*base[:30], "other", *base[31:]]
    passage = sentence(3, 80)
    texts = [
        (1, " ".join(base)),
        (2, " ".join(base)),
        (3, " ".join(near)),
        (4, "  ".join(nearer) + "\n"),
        (5, None),
        (6, ""),
        (7, " \t\n\x0b\f\r "),
        (8, "one"),
        (9, "one two"),
        (10, "One TWO"),
        (11, "a b c d e f g h i j"),
        (12, " ".join(other[:90] + passage + other[90:150])),
        (13, " ".join(sentence(5, 40) + passage)),
        (14, " ".join(passage[20:70])),
        (15, "x" * 1300),
        (16, "ab " * 500),
        (17, "été \U0001f600 漢字 \x00 </s> [INST] <|endoftext|>  nbsp " * 12),
        (18, "line one\nline two\nline one\n\n  \nline two\n" + " ".join(sentence(6, 30))),
        (19, " ".join(sentence(7, 6000))),
        (20, " ".join(sentence(7, 6000)[2000:2600])),
        (30, " ".join(sentence(8, 50))),
        (30, " ".join(sentence(9, 50))),
        (31, " ".join(sentence(10, 50))),
        (31, " ".join(sentence(10, 50))),
        (None, "no id here but some words that are long enough to count for something at all"),
    ]
    langs, sources = ["en", None, "de"], ["b", "a", None, "\U0001f600"]
    extra = ("x",) * 8
    return [
        (d, t, langs[i % 3], sources[i % 4], None if t is None else len(t), *extra) for i, (d, t) in enumerate(texts)
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text) -> list[bytes]:
    return (text or "").encode().split()


def phrase_rows(rows, window=13) -> Counter:
    """(doc_id, n_words, n_removed, sha of what is kept), with repetitions."""
    first = {}
    rank = lambda d: float("-inf") if d is None else d
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, float("inf")), rank(d))
    out = Counter()
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < rank(d):
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def repeat_rows(rows, length=400) -> Counter:
    count = Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = Counter()
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def shingle_set(text, k) -> frozenset:
    w = [x.lower() for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_rows(rows, k=4, percent=80) -> Counter:
    """(doc_id, n_shingles, component_id, kept), with repetitions."""
    sets = [shingle_set(t, k) for _, t in rows]
    holders, parent = defaultdict(list), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(b)] = root(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    out = Counter()
    for i, (d, _) in enumerate(rows):
        c = least.get(root(i))
        out[d, len(sets[i]), c, c is None or d == c] += 1
    return out
