"""Nearest neighbours by inner product: a forest of hash strings in sorted arrays.

A vector's hash string in one of ``TREES`` trees is the side on which it lies of ``BITS`` seeded random
planes. The index is a table with one row per shard of at most ``SHARD_ROWS`` vectors: the vectors and,
for each tree, their hash strings as a sorted array. Descending a tree is a binary search for the longest
prefix that the query shares with any vector; the vectors below a prefix are one run of the array, so
ascending by one bit, in all trees at once, only moves the ends of the runs.

A query is answered in two rounds. In the first, each shard ascends until its runs hold ``LEAST``
candidates; the best over all shards bound the true neighbours from below. In the second, each shard
ascends to the longest prefix at which a vector as near as that bound is missed by all trees with a
chance of at most ``MISS``: (1 - p ** bits) ** TREES, where p = 1 - angle / pi is the chance that one
plane does not part the two. So the number of candidates follows the data, recall does not depend on
the size of the table, and the prefix of no bits, which holds the whole shard, is the last resort where
fewer than the wanted neighbours are known. Neither candidates nor partners are capped.

Inner products become angles by one more coordinate: vectors are divided by the longest of their shard
and padded to length one; queries are divided by their length and padded with zero.

The index is built in one pass without a shuffle. Queries are read in blocks of ``QUERY_BLOCK`` (the only
data sent to all tasks); a block meets every shard in two scans of the index. On vectors without any
structure most of a shard is a candidate, as for every index of this kind; on clustered vectors few are.

Given:
* a vector that is null, empty, all zero, or holds a null or non-finite component takes no part, nor does
  one without an id; vectors of different lengths never meet
* rows equal in id and vector count once; of several vectors with one id each is a candidate, and the
  smallest one (as an array) asks; a query never finds its own id
* equal vectors are scored once and keep all their ids; equal scores go to the smaller id
* an empty table gives an empty result; other columns are not read
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from filmdw.session import stage_root, write_stage

TREES, BITS = 64, 32
SHARD_ROWS = 8_192
#: candidates of a shard in the first round, chance that a neighbour is missed in the second
LEAST = 256
MISS = 0.08
NEIGHBOURS = 20
QUERY_BLOCK = 8_192

_INDEX = pa.schema(
    [
        ("dimension", pa.int32()),
        ("longest", pa.float64()),
        ("width", pa.int32()),
        ("vectors", pa.binary()),
        ("ids", pa.binary()),
        ("first_id", pa.binary()),
        ("hashes", pa.binary()),
        ("places", pa.binary()),
    ]
)
_INDEX_DDL = (
    "dimension int, longest double, width int, vectors binary, ids binary, first_id binary, hashes binary,"
    " places binary"
)
_FOUND = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_FOUND_DDL = "query long, vec_id long, score double"


def hash_strings(unit: np.ndarray) -> np.ndarray:
    """(vectors, TREES) strings of BITS bits, first plane in the highest bit, of vectors of length one."""
    planes = np.random.default_rng(13).standard_normal((unit.shape[1], TREES * BITS)).astype(np.float32)
    out = np.empty((len(unit), TREES), np.uint32)
    for a in range(0, len(unit), 2048):
        sides = unit[a : a + 2048].astype(np.float32) @ planes > 0
        out[a : a + 2048] = np.packbits(sides, axis=1).view(">u4")
    return out


def _usable(vectors: pa.Array) -> tuple[list[np.ndarray], list[int]]:
    kept, at = [], []
    for i, value in enumerate(vectors):
        given = value.values
        if given is None or not len(given) or given.null_count:
            continue
        vector = given.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(vector).all() and vector.any():
            kept.append(vector)
            at.append(i)
    return kept, at


def _shard(vectors: np.ndarray, ids: np.ndarray) -> dict:
    """One row of the index."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    vectors, ids = vectors[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
    other = new.copy()
    other[1:] |= ids[1:] != ids[:-1]
    ids, new = ids[other], new[other]
    distinct = vectors[other][new]
    lengths = np.linalg.norm(distinct, axis=1)
    longest = lengths.max()
    pad = np.sqrt(np.maximum(0, 1 - (lengths / longest) ** 2))
    strings = hash_strings(np.column_stack([distinct / longest, pad]))
    places = np.argsort(strings, axis=0, kind="stable")
    single = distinct.astype(np.float32)
    kept = single if (single == distinct).all() else distinct
    return {
        "dimension": distinct.shape[1],
        "longest": float(longest),
        "width": kept.itemsize,
        "vectors": kept.tobytes(),
        "ids": ids.astype(np.int64).tobytes(),
        "first_id": np.append(np.flatnonzero(new), len(ids)).astype(np.int64).tobytes(),
        "hashes": np.take_along_axis(strings, places, axis=0).T.copy().tobytes(),
        "places": places.T.astype(np.uint16).tobytes(),
    }


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[int, tuple[list, list]] = {}

    def flush(dimension: int) -> pa.RecordBatch:
        vectors, ids = waiting.pop(dimension)
        return pa.RecordBatch.from_pylist([_shard(np.array(vectors), np.array(ids, np.int64))], schema=_INDEX)

    for batch in batches:
        ids = batch.column(0)
        for vector, i in zip(*_usable(batch.column(1))):
            vectors, own = waiting.setdefault(len(vector), ([], []))
            vectors.append(vector)
            own.append(ids[i].as_py())
            if len(own) == SHARD_ROWS:
                yield flush(len(vector))
    for dimension in list(waiting):
        yield flush(dimension)


def build(rows: DataFrame) -> DataFrame:
    """The written index of (vec_id, embedding)."""
    given = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    shards = -(-given.count() // SHARD_ROWS)
    packed = given.where("vec_id IS NOT NULL AND embedding IS NOT NULL").coalesce(max(1, shards))
    return write_stage(packed.mapInArrow(_rows, _INDEX_DDL), "forest")


class _Shard:
    """A row of the index as arrays."""

    def __init__(self, row: dict):
        array = lambda name, kind: np.frombuffer(row[name], kind)
        self.longest = row["longest"]
        self.vectors = array("vectors", f"f{row['width']}").reshape(-1, row["dimension"])
        self.n = len(self.vectors)
        self.narrow = self.vectors.astype(np.float32, copy=False)
        self.ids, self.first_id = array("ids", np.int64), array("first_id", np.int64)
        self.hashes = array("hashes", np.uint32).reshape(TREES, self.n)
        self.places = array("places", np.uint16).reshape(TREES, self.n)

    def runs(self, strings: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(queries, TREES) first and last place of the vectors that share so many first bits."""
        free = (np.uint64(BITS) - bits.astype(np.uint64))[:, None]
        low = (strings.astype(np.uint64) >> free) << free
        high = low + (np.uint64(1) << free)
        first, last = np.empty(low.shape, np.int64), np.empty(low.shape, np.int64)
        for tree in range(TREES):
            own = self.hashes[tree]
            first[:, tree] = np.searchsorted(own, low[:, tree].astype(np.uint32))
            last[:, tree] = np.searchsorted(own, (high[:, tree] - np.uint64(1)).astype(np.uint32), "right")
        return first, last

    def ascend(self, strings: np.ndarray, least: int) -> np.ndarray:
        """The most bits at which the runs of all trees hold ``least`` entries together; 0 if none do."""
        few, many = np.full(len(strings), BITS + 1), np.zeros(len(strings), np.int64)
        while (few - many > 1).any():
            middle = np.where(few - many > 1, (few + many) // 2, many)
            first, last = self.runs(strings, middle)
            enough = (last - first).sum(axis=1) >= least
            moved = few - many > 1
            many = np.where(moved & enough, middle, many)
            few = np.where(moved & ~enough, middle, few)
        return many

    def candidates(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        sizes = last - first
        steps = first + np.arange(TREES) * self.n - (np.cumsum(sizes) - sizes)
        seen = np.zeros(self.n, bool)
        seen[self.places.ravel()[np.repeat(steps, sizes) + np.arange(sizes.sum())]] = True
        return np.flatnonzero(seen)

    def best(self, query: np.ndarray, candidates: np.ndarray, k: int, bound: float):
        """(ids, scores) of the k nearest candidates that are not below the bound, nearest first."""
        rough = self.narrow[candidates] @ query.astype(np.float32)
        # more than any single-precision sum of products can be wrong by
        slack = 1e-6 * len(query) * self.longest * np.linalg.norm(query)
        least = bound
        if len(rough) > k:
            least = max(bound, np.partition(rough, -k)[-k] - slack)
        candidates = candidates[rough >= least - slack]
        scores = (self.vectors[candidates].astype(np.float64) * query).sum(axis=1)
        order = np.argsort(-scores, kind="stable")
        ids, values = [], []
        for place in order:
            if scores[place] < bound or len(ids) >= k and scores[place] < values[k - 1]:
                break
            a, b = self.first_id[candidates[place]], self.first_id[candidates[place] + 1]
            named = self.ids[a : min(b, a + k)]
            ids.extend(named.tolist())
            values.extend([scores[place]] * len(named))
        ids, values = np.array(ids, np.int64), np.array(values, np.float64)
        chosen = np.lexsort((ids, -values))[:k]
        return ids[chosen], values[chosen]


def _bits_for(bounds: np.ndarray, lengths: np.ndarray, longest: float, miss: float) -> np.ndarray:
    """The longest prefixes at which a vector as near as the bound is missed with a chance below ``miss``."""
    cosine = np.clip(np.where(np.isfinite(bounds), bounds / (lengths * longest), -1.0), -1.0, 1.0)
    stays = 1 - np.arccos(cosine) / np.pi
    wanted = 1 - miss ** (1 / TREES)
    with np.errstate(divide="ignore"):
        bits = np.floor(np.log(wanted) / np.log(np.minimum(stays, 1 - 1e-12)))
    return np.where(stays <= 0, 0, np.clip(bits, 0, BITS)).astype(np.int64)


def _searched(index: DataFrame, ids, vectors, k: int, bounds=None) -> DataFrame:
    """(query, vec_id, score): the nearest in each shard of the queries of one block."""

    def search(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                own = [i for i, v in enumerate(vectors) if len(v) == row["dimension"]]
                if not own:
                    continue
                shard = _Shard(row)
                asked = np.array([vectors[i] for i in own])
                asked, same = np.unique(asked, axis=0, return_inverse=True)
                lengths = np.linalg.norm(asked, axis=1)
                strings = hash_strings(np.column_stack([asked / lengths[:, None], np.zeros(len(asked))]))
                limits = np.full(len(asked), -np.inf)
                if bounds is None:
                    bits = shard.ascend(strings, LEAST)
                else:
                    # equal vectors have equal bounds, but for their own ids: the lower one serves all
                    limits[:] = np.inf
                    np.minimum.at(limits, same.ravel(), np.array([bounds[i] for i in own]))
                    bits = _bits_for(limits, lengths, shard.longest, MISS)
                first, last = shard.runs(strings, bits)
                members = np.argsort(same.ravel(), kind="stable")
                ends = np.searchsorted(same.ravel()[members], np.arange(len(asked) + 1))
                out = ([], [], [])
                for j in range(len(asked)):
                    found = shard.candidates(first[j], last[j])
                    # an id may stand on several vectors of a shard, so one more than k is not always enough
                    wanted = k + 1
                    named, scores = shard.best(asked[j], found, wanted, limits[j])
                    for m in members[ends[j] : ends[j + 1]]:
                        while len(named) == wanted and (named != ids[own[m]]).sum() < k:
                            wanted *= 2
                            named, scores = shard.best(asked[j], found, wanted, limits[j])
                        others = np.flatnonzero(named != ids[own[m]])[:k]
                        out[0].append(np.full(len(others), ids[own[m]]))
                        out[1].append(named[others])
                        out[2].append(scores[others])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=_FOUND)

    return index.mapInArrow(search, _FOUND_DDL)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all shards, with their rank."""
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def search(index: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each of the given (vec_id, embedding)."""
    spark = queries.sparkSession
    asked = (
        queries.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
        .where("vec_id IS NOT NULL AND size(embedding) > 0")
        .where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .where(F.exists("embedding", lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )
    asked = write_stage(asked, "forest-queries")
    blocks = max(1, -(-asked.count() // block))
    path = f"{stage_root(spark)}/forest-found-{uuid.uuid4().hex}"
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).toArrow()
        ids = own["vec_id"].to_numpy()
        vectors = [v.values.to_numpy() for v in own["embedding"]]
        first = write_stage(_merged(_searched(index, ids, vectors, k), k), "forest-first")
        known = first.where(F.col("rank") == k).select("query", "score").toArrow()
        bound = dict(zip(known["query"].to_pylist(), known["score"].to_pylist()))
        bounds = [bound.get(i, -np.inf) for i in ids.tolist()]
        second = _searched(index, ids, vectors, k, bounds)
        both = _merged(first.select("query", "vec_id", "score").unionByName(second), k)
        both.select(F.col("query").alias("query_id"), "rank", "vec_id", "score").write.mode("append").parquet(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score double").parquet(path)


def neighbours(rows: DataFrame, every: int = 20, k: int = NEIGHBOURS) -> DataFrame:
    """The k nearest rows of each row whose vec_id is divisible by ``every``."""
    return search(build(rows), rows.where(F.col("vec_id") % every == 0), k)
