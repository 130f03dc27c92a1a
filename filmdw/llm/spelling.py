"""Spelling variants of a vocabulary: words one edit apart, by search schemes over FM-indexes.

Two words are near if one inserted, deleted or replaced code point makes them equal. With M the length
of the longer one, near words share their first M // 2 code points or their last M - M // 2. So the
vocabulary is dealt twice: by the first half and by the second half that a word has as the longer
partner (M its length) and as the shorter one (M one more). What shares a half meets in one shard.

A shard holds an FM-index of its words, each between delimiters: the suffix ranks, and the sorted (code
point before, rank) pairs in which one binary search is a backward step. Shards of second halves index
the text and extend matches leftwards; shards of first halves index the reversed text and so extend them
rightwards: the two directions of a bidirectional index. The scheme matches the delimiter and one half
exactly, then steps across the other half; at each code point a branch may delete it or replace it by
one that the suffix interval holds, and goes on without errors to the other delimiter. Each pair is
looked for from its longer word (from the smaller one if both are as long), at one place of the word and
in one shard, so it is found once. Shards return counts and the best partner of each word, never pairs.

A half that more than ``HOT`` words share is dealt to several shards: each word is indexed in one of
them and searched in all.

Given:
* null and empty texts have no words; very long texts are read whole; a row without a doc_id is named by
  an empty id, repeated rows count again
* ties go to the smallest word in code-point order
* an empty table gives an empty result; other columns are not read
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filmdw.session import write_stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: how many times as frequent a word's form is
FORM_TIMES = 10
#: one run in so many of each document loses a code point
SLIP = 31
#: entries of a shard, words that may share a half before it is split
SHARD_ENTRIES = 60_000
HOT = 20_000
#: hot halves that are sent to all tasks; more of them are joined by a shuffle
MOST_HOT = 100_000
#: distinct words counted before they are passed on, queries searched at a time
COUNTED = 200_000
QUERIES = 8_192

_RUN = re.compile(rf"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
_NEAR_DDL = "word string, n_near long, form_n long, form string"


def words_of(doc_id, text: str) -> Counter:
    """The counted words of a text, after the slips of its document."""
    # bytes.lower() changes A-Z only
    runs = Counter(_RUN.findall(text.encode().lower().decode()))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter = Counter()
    for run, often in runs.items():
        hashed = zlib.crc32(run.encode(), start)
        if hashed % SLIP == 0:
            at = hashed % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        words[run] += often
    return words


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    flush = lambda: pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], schema=_WORDS
    )
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            for word, often in words_of(doc_id.as_py(), text.as_py()).items():
                total[word] += often
            if len(total) >= COUNTED:
                yield flush()
                total.clear()
    yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur ``LEAST_COUNT`` times or more."""
    given = docs.select("doc_id", F.col("text").cast("string")).where("text IS NOT NULL")
    counted = given.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return write_stage(counted.where(F.col("n") >= LEAST_COUNT), "vocabulary")


def _dealt(words: DataFrame, entries: int, hot: int) -> DataFrame:
    """Each word under its four halves: side (0 first, 1 second), shard, whether it asks there and is
    indexed there, and the part of a split half that its answers come from."""
    length = F.length("word")
    halves = F.array(
        *(
            F.struct(
                F.lit(side).alias("side"),
                (length + more).alias("longer"),
                (F.lit(more) == 0).alias("asks"),
                F.left("word", F.floor((length + more) / 2).cast("int")).alias("half")
                if side == 0
                else F.right("word", (length + more - F.floor((length + more) / 2)).cast("int")).alias("half"),
            )
            for side in (0, 1)
            for more in (0, 1)
        )
    )
    keys = ["side", "longer", "half"]
    under = words.withColumn("salt", F.xxhash64("word")).withColumn("under", F.explode(halves))
    under = under.select("word", "n", "salt", "under.*")
    many = under.groupBy(*keys).count().where(F.col("count") > hot)
    many = write_stage(many.select(*keys, F.ceil(F.col("count") / hot).cast("int").alias("parts")), "hot-halves")
    if many.limit(MOST_HOT + 1).count() <= MOST_HOT:
        many = F.broadcast(many)
    under = under.join(many, keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod("salt", "parts").cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    under = under.withColumn("part", F.explode(F.when(F.col("asks"), every).otherwise(F.array(own))))
    shards = max(1, -(-4 * words.count() // entries))
    shard = F.pmod(F.xxhash64(*keys, "part"), F.lit(shards))
    indexed = (F.col("part") == own).alias("indexed")
    return under.select("word", "n", "salt", "side", shard.alias("shard"), "asks", indexed, "part", "parts")


class FMIndex:
    """Suffix ranks of ``#word#word#...#`` over small codes, 0 being the delimiter."""

    def __init__(self, words: list[np.ndarray]):
        lengths = np.array([len(w) for w in words])
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        text = np.zeros(starts[-1] + 1, np.int64)
        text[np.delete(np.arange(1, len(text)), starts[1:] - 1)] = np.concatenate(words)
        self.n = len(text)
        ranks = self._ranked(text, int(lengths.max()) + 2)
        self.before = text[ranks - 1].astype(np.uint8)
        self.base = np.int64(self.n + 1)
        self.pairs = np.sort(self.before * self.base + np.arange(self.n))
        self.codes = int(text.max()) + 1
        # the first ranks are the delimiters; the last one opens no word
        self.delimiters = len(words) + 1
        self.word_at = np.searchsorted(starts, ranks[: self.delimiters])

    @staticmethod
    def _ranked(text: np.ndarray, depth: int) -> np.ndarray:
        """Suffixes in the order of their first ``depth`` codes: more than any pattern has."""
        n, width = len(text), 8
        key = np.zeros(n, np.int64)
        for i in range(width):
            key = (key << 7) + np.concatenate([text[i:], np.zeros(i, np.int64)])
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            if width >= depth or rank.max() == n - 1:
                return order
            key = rank * np.int64(n + 1) + np.concatenate([rank[width:] + 1, np.zeros(min(width, n), np.int64)])[:n]
            width *= 2

    def step(self, code, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that start with ``code`` and go on as those of (low, high) start."""
        code = np.asarray(code, np.int64) * self.base
        return np.searchsorted(self.pairs, code + low), np.searchsorted(self.pairs, code + high)

    def above(self, low: np.ndarray, high: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in low, code) for the distinct codes above the given that stand before an interval."""
        size = high - low
        small = np.flatnonzero(size <= self.codes)
        large = np.flatnonzero(size > self.codes)
        place = np.repeat(small, size[small])
        rows = np.repeat(low[small] - (np.cumsum(size[small]) - size[small]), size[small]) + np.arange(len(place))
        found = self.before[rows].astype(np.int64)
        chosen = found > code[place]
        pairs = np.unique(place[chosen] * 256 + found[chosen])
        more = self.codes - 1 - code[large]
        place = np.repeat(large, more)
        each = np.repeat(code[large] + 1 - (np.cumsum(more) - more), more) + np.arange(len(place))
        return np.concatenate([pairs >> 8, place]), np.concatenate([pairs & 255, each])

    def near(self, patterns: np.ndarray, half: int, ends: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(row of patterns, word): words that a deleted code, or one replaced by a larger one, before the
        last ``half`` codes makes of a pattern; all patterns have one length. ``ends``, where given, says
        for each code whether its deletion may be counted here."""
        count, length = patterns.shape
        row = np.arange(count)
        low, high = np.zeros(count, np.int64), np.full(count, self.delimiters)
        for i in range(length - 1, length - half - 1, -1):
            low, high = self.step(patterns[row, i], low, high)
            alive = high > low
            row, low, high = row[alive], low[alive], high[alive]
        empty = np.zeros(0, np.int64)
        wrong = (empty, empty, empty)
        for i in range(length - half - 1, -1, -1):
            code = patterns[wrong[0], i]
            wrong = (wrong[0], *self.step(code, wrong[1], wrong[2]))
            # of a run of equal codes, deleting the first stands for all
            first = np.ones(len(row), bool) if i == 0 else patterns[row, i] != patterns[row, i - 1]
            if ends is not None:
                first &= ends[row, i]
            place, other = self.above(low, high, patterns[row, i])
            replaced = self.step(other, low[place], high[place])
            wrong = (
                np.concatenate([wrong[0], row[first], row[place]]),
                np.concatenate([wrong[1], low[first], replaced[0]]),
                np.concatenate([wrong[2], high[first], replaced[1]]),
            )
            alive = wrong[2] > wrong[1]
            wrong = tuple(x[alive] for x in wrong)
            low, high = self.step(patterns[row, i], low, high)
            alive = high > low
            row, low, high = row[alive], low[alive], high[alive]
        low, high = self.step(0, wrong[1], wrong[2])
        found = high > low
        return wrong[0][found], self.word_at[low[found]]


def _deletable(patterns: np.ndarray) -> np.ndarray:
    """Whether a code's run of equal codes ends in the first half, so that no shard of first halves
    finds the deletion."""
    count, length = patterns.shape
    end = np.empty((count, length), np.int64)
    end[:, -1] = length - 1
    for i in range(length - 2, -1, -1):
        end[:, i] = np.where(patterns[:, i] == patterns[:, i + 1], end[:, i + 1], i)
    return end < length // 2


def _pairs(table: pa.Table, words: np.ndarray, codes: list[np.ndarray], at: np.ndarray) -> Iterator[tuple]:
    """(word, near word) as numbers in ``words``, each pair once, for the rows of a shard."""
    first_halves = table["side"][0].as_py() == 0
    indexed = np.unique(at[table["indexed"].to_numpy()])
    if not len(indexed):
        return
    turned = [c[::-1] for c in codes] if first_halves else codes
    index = FMIndex([turned[i] for i in indexed])
    salts = np.zeros(len(words), np.int64)
    salts[at] = table["salt"].to_numpy()
    parts, part = table["parts"].to_numpy(), table["part"].to_numpy()
    asks = np.flatnonzero(table["asks"].to_numpy())
    lengths = np.array([len(c) for c in codes])[at[asks]]
    for length in np.unique(lengths):
        rows = asks[lengths == length]
        half = length // 2 if first_halves else length - length // 2
        for a in range(0, len(rows), QUERIES):
            own = rows[a : a + QUERIES]
            patterns = np.array([turned[i] for i in at[own]], np.int64)
            row, near = index.near(patterns, half, None if first_halves else _deletable(patterns))
            near = indexed[near]
            kept = salts[near] % parts[own[row]] == part[own[row]]
            yield at[own[row[kept]]], near[kept]


def _shard_near(table: pa.Table) -> pa.Table:
    """The near words of a shard, summed up by word."""
    given = np.array(table["word"].to_pylist(), dtype=object)
    words, at = np.unique(given.astype(str), return_inverse=True)
    n = np.zeros(len(words), np.int64)
    n[at] = table["n"].to_numpy()
    # words hold a-z and code points up to 255 only
    points = [np.frombuffer(w.encode("latin-1"), np.uint8) for w in words]
    used = np.unique(np.concatenate(points)) if points else np.zeros(0, np.uint8)
    code = np.zeros(256, np.int64)
    code[used] = np.arange(1, len(used) + 1)
    found = list(_pairs(table, words, [code[p] for p in points], at))
    a = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in found), *(y for _, y in found)])
    b = np.concatenate([np.zeros(0, np.int64), *(y for _, y in found), *(x for x, _ in found)])
    order = np.lexsort((b, -n[b], a))
    a, b = a[order], b[order]
    starts = np.flatnonzero(np.diff(a, prepend=-1))
    counts = np.diff(np.append(starts, len(a)))
    columns = [words[a[starts]].tolist(), counts, n[b[starts]], words[b[starts]].tolist()]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NEAR)], schema=_NEAR)


def near_words(words: DataFrame, entries: int = SHARD_ENTRIES, hot: int = HOT) -> DataFrame:
    """(word, n_near, form_n, form) for the words of (word, n) that have near ones; the form is the most
    frequent of them. Words are of a-z and code points up to 255, two or more, each once."""
    dealt = _dealt(words, entries, hot)
    found = dealt.groupBy("side", "shard").applyInArrow(_shard_near, _NEAR_DDL)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def _with_roots(forms: DataFrame, rounds: int) -> DataFrame:
    """Follow forms to their last, twice as far in each round."""
    for _ in range(rounds):
        forms = write_stage(forms, "forms")
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        forms = forms.join(onward, "root", "left").select(
            "word", "form", "form_n", F.coalesce("onward", "root").alias("root")
        )
    return forms


def group_variants(words: DataFrame, entries: int = SHARD_ENTRIES, hot: int = HOT) -> DataFrame:
    """Every word of (word, n) with its form, the root that its forms lead to, and its near words."""
    near = write_stage(near_words(words, entries, hot), "near-words")
    known = words.join(near, "word", "left")
    formed = F.col("form_n") >= FORM_TIMES * F.col("n")
    forms = known.where(formed).select("word", "form", "form_n", F.col("form").alias("root"))
    # each form is ten times as frequent as the one before, which bounds the length of a chain
    most = words.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, FORM_TIMES)) + 1)
    roots = _with_roots(forms, math.ceil(math.log2(steps)))
    joined = known.drop("form", "form_n").join(roots, "word", "left")
    return joined.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        "form_n",
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The vocabulary of (doc_id, text) with its variants grouped."""
    return group_variants(vocabulary(docs))
