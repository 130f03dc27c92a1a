"""Token ids in ORC files: runs of integers, row indexes and Bloom filters on document ids.

Documents are dealt by ranges of doc_id and sorted, so a file, its stripes and its row groups each
hold a narrow range of ids. A reader that looks for some ids skips files, stripes and row groups by
their smallest and largest id and by the Bloom filter; a reader of everything takes stripes in
parallel. Integer columns are run-length encoded by the format. Each row says in which part and at
which token of that part it starts, so that where a document starts in the whole corpus follows from
one sum per part, read without touching the ids.

Defined results: a null or empty text has the end token alone; rows with equal ids are written each,
in the order of their texts; rows without an id come first; an empty table reads back empty.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from filmdw.llm.memory import BATCH, give_back
from filmdw.llm.tokens import encoder, vocabulary
from filmdw.session import conf, scratch_root

END_TOKEN = 2
#: rows of an index entry, bytes of a stripe, false positives of the Bloom filter
INDEX_ROWS = 1000
STRIPE_BYTES = 16 << 20
FALSE_POSITIVES = 0.01
SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


def write(docs: DataFrame, target: str, path: str | None = None, end_token: int = END_TOKEN) -> None:
    """Encode whole texts and write them in ascending doc_id order."""
    path = path or vocabulary("word_bpe_49k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(1))
            ids = [np.append(i, np.uint32(end_token)).astype(np.int32) for i in encoder(path).encode(texts)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            ends = np.cumsum(lengths)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(ids), part), pa.int32()),
                    pa.array(start + ends - lengths),
                    pa.array(lengths),
                    lists,
                ],
                ["doc_id", "part", "start_in_part", "n_tokens", "ids"],
            )
            start += int(lengths.sum())
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    written = (
        ranged.mapInArrow(encode, SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", FALSE_POSITIVES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.compress", "ZSTD")
    )
    with conf(docs.sparkSession, **BATCH):
        written.orc(target)


def read(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens and ids."""
    rows = spark.read.schema(SCHEMA).orc(target)
    # one row for each part; the ids are not read for it
    ends = rows.groupBy("part").agg(F.max(F.col("start_in_part") + F.col("n_tokens")).alias("_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("part", F.coalesce(F.sum("_tokens").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("_before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def find(spark: SparkSession, target: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; other files, stripes and row groups are skipped by metadata."""
    rows = spark.read.schema(SCHEMA).orc(target)
    return rows.where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc of the ids as they were read."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            edges = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            lengths = np.diff(edges).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lengths), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return rows.select("doc_id", "start", "ids").mapInArrow(digest, schema)


def round_trip(docs: DataFrame, path: str | None = None, end_token: int = END_TOKEN) -> DataFrame:
    """Write the documents' ids below the shared folder, read them back, and digest them."""
    spark = docs.sparkSession
    target = f"{scratch_root(spark)}/filmdw/orc-{uuid.uuid4().hex}"
    write(docs, target, path, end_token)
    return digests(read(spark, target))
