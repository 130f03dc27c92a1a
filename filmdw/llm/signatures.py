"""Ranked lexical search over bit-sliced Bloom signatures.

The index is a table with one row per block of documents of like size. A document's signature is a Bloom
filter of its (term, level) pairs, level l standing for a term that occurs 2 ** l times or more. The
signatures of a block are stored as bit slices: slice b holds bit b of every document of the block, one
bit a document. The bits of a term's slices, and-ed, are a bitmap of documents that overestimates the
term's presence and never misses one.

A search scans the index three times and shuffles nothing but the best rows of each block:

1. Weighted sums of the slices give each document an upper bound of its score for every item: level by
   level, the sum of the term weights, times what that level can add in a document of its length. The
   ten highest bounds of each item are kept.
2. Those documents are scored exactly. The tenth score is a bound that every better document exceeds.
3. Every document whose upper bound is not below that score is scored exactly in its block. All others
   are proved not to be among the ten.

Blocks hold their texts and their own dictionary (term, documents holding it), so that document
frequencies are exact and rescoring needs no join. Items are read in blocks of at most ``ITEMS`` rows and
about ``ITEM_CHARACTERS`` characters, the only data sent to all tasks.

Given:
* null and empty texts, and texts without a term, are in no result and not counted
* very long texts are read whole; a block is closed by characters, so one text may be a block
* equal texts of a block are scored once; equal scores go to the smaller doc_id, rows without an id last;
  repeated rows are ranked each
* an item without an id takes no part; of several texts with one item_id the smallest is the item
* an empty table gives an empty result; other columns are not read
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from filmdw.llm.hashing import mixed, word_hashes
from filmdw.session import stage_root, write_stage

#: documents and bytes of text in a block, bits a pair in the fullest signature of a block, bits a pair sets
BLOCK_DOCUMENTS = 4_096
BLOCK_BYTES = 2_000_000
BITS_A_PAIR = 12
HASHES = 4
LEVELS = 6
#: items and characters of items that are searched at a time
ITEMS = 512
ITEM_CHARACTERS = 4_000_000
BEST = 10
#: documents of a block, a multiple of 8, whose slices are summed at a time
PART = 512

_LETTER = [48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b >= 128 for b in range(256)]
_FOLD = bytes((b + 32 if 65 <= b < 91 else b) if _LETTER[b] else 32 for b in range(256))

_INDEX = pa.schema(
    [
        ("block", pa.int64()),
        ("documents", pa.int64()),
        ("occurrences", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.binary()),
        ("width", pa.int64()),
        ("slices", pa.binary()),
        ("terms", pa.list_(pa.binary())),
        ("held_by", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.binary())),
    ]
)
_INDEX_DDL = (
    "block long, documents long, occurrences long, doc_ids array<long>, sizes binary, width long,"
    " slices binary, terms array<binary>, held_by array<long>, texts array<binary>"
)
_SCORED_DDL = "item_id long, score long, doc_id long, block long, place long"
_SCORED = pa.schema([(n, pa.int64()) for n in ("item_id", "score", "doc_id", "block", "place")])
_FREQUENCY = pa.schema([("term", pa.binary()), ("held_by", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all other code points above 127; only A-Z are lower-cased."""
    return text.translate(_FOLD).split()


def positions(terms: list[bytes], width: int) -> np.ndarray:
    """(LEVELS, HASHES, terms) the slices of each term at each level."""
    hashes = word_hashes([b" ".join(terms)])[0]
    out = np.empty((LEVELS, HASHES, len(terms)), np.int64)
    for level in range(LEVELS):
        for i in range(HASHES):
            out[level, i] = (mixed(hashes, 1 + level * HASHES + i) % np.uint64(width)).astype(np.int64)
    return out


class _Pending:
    """Documents of one size class that wait for a block."""

    def __init__(self):
        self.ids, self.texts, self.sizes, self.bytes = [], [], [], 0
        self.vocabulary: dict[bytes, int] = {}
        self.terms, self.often = [], []

    def add(self, doc_id, text: bytes, counts: Counter) -> None:
        self.ids.append(doc_id)
        self.texts.append(text)
        self.sizes.append(sum(counts.values()))
        self.bytes += len(text)
        place = self.vocabulary.setdefault
        self.terms.append(np.array([place(t, len(self.vocabulary)) for t in counts], np.int32))
        self.often.append(np.fromiter(counts.values(), np.int32, len(counts)))

    def row(self, block: int, width: int) -> dict:
        n = len(self.ids)
        terms, often = np.concatenate(self.terms), np.concatenate(self.often)
        docs = np.repeat(np.arange(n), [len(t) for t in self.terms])
        vocabulary = list(self.vocabulary)
        at = positions(vocabulary, width)
        bits = np.zeros((width, n), bool)
        for level in range(LEVELS):
            reached = often >= 1 << level
            for i in range(HASHES):
                bits[at[level, i, terms[reached]], docs[reached]] = True
        return {
            "block": block,
            "documents": n,
            "occurrences": int(sum(self.sizes)),
            "doc_ids": self.ids,
            "sizes": np.array(self.sizes, np.int64).tobytes(),
            "width": width,
            "slices": np.packbits(bits, axis=1).tobytes(),
            "terms": vocabulary,
            "held_by": np.bincount(terms, minlength=len(vocabulary)).tolist(),
            "texts": self.texts,
        }


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, made = TaskContext.get().partitionId() << 32, 0
    waiting: dict[int, _Pending] = {}

    def flush(size: int) -> pa.RecordBatch:
        nonlocal made
        made += 1
        row = waiting.pop(size).row(first + made, BITS_A_PAIR << size)
        return pa.RecordBatch.from_pylist([row], schema=_INDEX)

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py().encode()
            counts = Counter(terms_of(text))
            if not counts:
                continue
            pairs = sum(min(n.bit_length(), LEVELS) for n in counts.values())
            size = (pairs - 1).bit_length()
            pending = waiting.setdefault(size, _Pending())
            pending.add(doc_id.as_py(), text, counts)
            if len(pending.ids) >= BLOCK_DOCUMENTS or pending.bytes >= BLOCK_BYTES:
                yield flush(size)
    for size in list(waiting):
        yield flush(size)


def build(docs: DataFrame) -> DataFrame:
    """The written index of (doc_id, text)."""
    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    path = f"{stage_root(docs.sparkSession)}/signatures-{uuid.uuid4().hex}"
    # rows are megabytes, so the writer looks at its memory after every few of them
    writer = given.mapInArrow(_blocks, _INDEX_DDL).write.option("parquet.page.size.row.check.min", "4")
    writer.parquet(path)
    return docs.sparkSession.read.schema(_INDEX_DDL).parquet(path)


class _Items:
    """Items of a block with their weighted terms."""

    def __init__(self, ids: list[int], texts: list[bytes]):
        self.ids = ids
        self.own = [sorted(set(terms_of(t))) for t in texts]
        self.terms = sorted(set().union(*self.own)) if self.own else []
        self.known = place = {t: i for i, t in enumerate(self.terms)}
        self.places = [np.array([place[t] for t in own], np.int64) for own in self.own]

    def weigh(self, held_by: dict[bytes, int], documents: int, occurrences: int) -> None:
        self.documents, self.occurrences = documents, occurrences
        weight = lambda n: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
        self.weights = np.array([weight(held_by.get(t, 0)) for t in self.terms], np.int64)

    def lengths(self, sizes: np.ndarray) -> np.ndarray:
        return np.array([10 + (90 * int(n) * self.documents) // self.occurrences for n in sizes], np.int64)


def _gain(often, length):
    return (1_000_000_000 * often) // (1000 * often + 8 * length)


class _Block:
    def __init__(self, row: dict, items: _Items):
        self.row, self.items = row, items
        self.lengths = items.lengths(np.frombuffer(row["sizes"], np.int64))
        self.counts: dict[bytes, dict[bytes, int]] = {}

    def bounds(self) -> np.ndarray:
        """(items, documents) no score is above."""
        items, n, width = self.items, self.row["documents"], self.row["width"]
        slices = np.frombuffer(self.row["slices"], np.uint8).reshape(width, -1)
        at = positions(items.terms, width)
        parts = [
            self._part_bounds(slices[:, a // 8 : (a + PART) // 8], at, self.lengths[a : a + PART])
            for a in range(0, n, PART)
        ]
        return np.concatenate(parts, axis=1)

    def _part_bounds(self, slices: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        items, n = self.items, len(lengths)
        total = np.zeros((len(items.ids), n))
        before = np.zeros(n, np.int64)
        for level in range(LEVELS):
            most = np.int64((2 << level) - 1)
            # an occurrence more always adds less than what is left to a million
            gain = _gain(most, lengths) if level + 1 < LEVELS else np.full(n, 1_000_000, np.int64)
            present = slices[at[level, 0]]
            for i in range(1, HASHES):
                present = present & slices[at[level, i]]
            held = np.flatnonzero(present.any(axis=1))
            if len(held):
                # weights below 2 ** 17 and terms below 2 ** 35 stay whole in a double
                narrow = np.full(len(items.terms), -1)
                narrow[held] = np.arange(len(held))
                weighted = np.unpackbits(present[held], axis=1, count=n).astype(np.float64)
                weighted *= items.weights[held, None]
                for i, places in enumerate(items.places):
                    own = narrow[places]
                    own = own[own >= 0]
                    if len(own):
                        total[i] += weighted[own].sum(axis=0) * (gain - before)
            before = gain
        return total

    def score(self, item: int, place: int) -> int:
        text = self.row["texts"][place]
        counts = self.counts.get(text)
        if counts is None:
            found = Counter(terms_of(text))
            counts = self.counts[text] = {t: n for t, n in found.items() if t in self.items.known}
        length, total = int(self.lengths[place]), 0
        for term, at in zip(self.items.own[item], self.items.places[item].tolist()):
            often = counts.get(term, 0)
            if often:
                total += int(self.items.weights[at]) * _gain(often, length)
        return total

    def line(self, item: int, score: int, place: int) -> tuple:
        return self.items.ids[item], int(score), self.row["doc_ids"][place], self.row["block"], int(place)


def _lines(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_SCORED)
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=_SCORED)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _frequencies(index: DataFrame, items: _Items) -> dict[bytes, int]:
    wanted = pa.array(items.terms, pa.binary())

    def held(batches):
        for batch in batches:
            terms, often = batch.column(0).flatten(), batch.column(1).flatten()
            asked = pc.is_in(terms, value_set=wanted)
            yield pa.RecordBatch.from_arrays([terms.filter(asked), often.filter(asked)], schema=_FREQUENCY)

    found = index.select("terms", "held_by").mapInArrow(held, "term binary, held_by long")
    counted = found.groupBy("term").agg(F.sum("held_by").alias("held_by")).toArrow()
    return dict(zip(counted["term"].to_pylist(), counted["held_by"].to_pylist()))


def _highest(index: DataFrame, items: _Items, k: int) -> DataFrame:
    """The k highest upper bounds of each item in each block."""

    def search(batches):
        for row in _each(batches):
            block = _Block(row, items)
            bounds, lines = block.bounds(), []
            for item in range(len(items.ids)):
                own = bounds[item]
                best = np.argpartition(-own, k - 1)[:k] if len(own) > k else np.arange(len(own))
                lines += [block.line(item, own[place], place) for place in best if own[place] > 0]
            yield _lines(lines)

    columns = ["block", "documents", "doc_ids", "sizes", "width", "slices"]
    return index.select(*columns).mapInArrow(search, _SCORED_DDL)


def _named(index: DataFrame, items: _Items, chosen: dict[int, list[tuple[int, int]]]) -> DataFrame:
    """Exact scores of named (item, place) of blocks."""

    def search(batches):
        for row in _each(batches):
            block = _Block(row, items)
            yield _lines([block.line(i, block.score(i, place), place) for i, place in chosen[row["block"]]])

    columns = ["block", "documents", "doc_ids", "sizes", "texts"]
    return index.select(*columns).where(F.col("block").isin(list(chosen))).mapInArrow(search, _SCORED_DDL)


def _rescored(index: DataFrame, items: _Items, least: list[int], k: int) -> DataFrame:
    """The k best of each item in each block among all whose upper bound reaches the item's least score."""

    def search(batches):
        for row in _each(batches):
            block = _Block(row, items)
            bounds, lines = block.bounds(), []
            for item in range(len(items.ids)):
                scores: dict[bytes, int] = {}
                own = []
                for place in np.flatnonzero(bounds[item] >= least[item]).tolist():
                    text = row["texts"][place]
                    if text not in scores:
                        scores[text] = block.score(item, place)
                    if scores[text] >= least[item]:
                        own.append((scores[text], place))
                ids = row["doc_ids"]
                own.sort(key=lambda x: (-x[0], ids[x[1]] is None, ids[x[1]]))
                lines += [block.line(item, score, place) for score, place in own[:k]]
            yield _lines(lines)

    columns = ["block", "documents", "doc_ids", "sizes", "width", "slices", "texts"]
    return index.select(*columns).mapInArrow(search, _SCORED_DDL)


def _best(lines: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "place")
    return lines.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = BEST, most_items: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each of the given (item_id, text)."""
    spark = queries.sparkSession
    asked = queries.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna()
    asked = write_stage(asked.groupBy("item_id").agg(F.min("text").alias("text")), "signature-items")
    count, characters = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // most_items), -(-characters // ITEM_CHARACTERS))
    documents, occurrences = index.agg(F.sum("documents"), F.sum("occurrences")).first()
    path = f"{stage_root(spark)}/signature-found-{uuid.uuid4().hex}"
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).toArrow().sort_by("item_id")
        items = _Items(own["item_id"].to_pylist(), [t.as_py().encode() for t in own["text"]])
        if documents:
            items.weigh(_frequencies(index, items), documents, occurrences)
            chosen: dict[int, list[tuple[int, int]]] = {}
            where = {item: i for i, item in enumerate(items.ids)}
            for line in _best(_highest(index, items, k), k).collect():
                chosen.setdefault(line["block"], []).append((where[line["item_id"]], line["place"]))
            scores = [[] for _ in items.ids]
            if chosen:
                for line in _named(index, items, chosen).collect():
                    scores[where[line["item_id"]]].append(line["score"])
            least = [max(1, sorted(s)[-k]) if len(s) >= k else 1 for s in scores]
            found = _best(_rescored(index, items, least, k), k)
        else:
            found = spark.createDataFrame([], f"{_SCORED_DDL}, rank int")
        found.select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    return spark.read.schema("item_id long, rank int, doc_id long, score long").parquet(path)


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = BEST) -> DataFrame:
    """The k best documents of each item."""
    return search(build(docs), queries, k)
