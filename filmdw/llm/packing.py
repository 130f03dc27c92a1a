"""Packing of tokenized documents into sequences by vector best-fit.

A document longer than a sequence is cut into full pieces, the first of which may be shorter. Every
piece then has a demand vector (tokens, one document, attention cost) and every open sequence a
vector of what it has left. Pieces come longest first; among the sequences that can take a piece in
every dimension, one is chosen by the weighted dot product of demand and rest, or by the smallest
weighted norm of what would remain.

Pieces are dealt to shards by a hash of their row number, each with the same mix of lengths, so that a
shard loses at most its last sequences; only lengths are shuffled, texts are read once.

Defined results: a null or empty text is the end token alone; repeated rows are packed each; a
document without an id is packed too; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filmdw.llm.memory import BATCH, give_back
from filmdw.llm.tokens import encoder, vocabulary
from filmdw.session import conf, write_stage

SEQUENCE = 2048
END_TOKEN = 0
SHARD_PIECES = 20_000
#: capacity of a sequence in documents, and in the sum of squared lengths
MOST_DOCUMENTS = 2048
MOST_COST = 2048.0 * 2048.0
WEIGHTS = (1.0, 0.01, 0.01)


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_token: int = END_TOKEN) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            out = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            doc_ids = batch.column(0).to_pylist()
            texts = (t.as_py() or "" for t in batch.column(1))
            for doc_id, ids in zip(doc_ids, encode(texts)):
                ids = np.append(ids, np.uint32(end_token)).astype("<u4")
                edges = list(range(len(ids) % sequence or sequence, len(ids) + 1, sequence))
                start = 0
                for piece, edge in enumerate([min(len(ids), sequence)] if len(ids) <= sequence else edges):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(edge - start)
                    out["ids_crc32"].append(zlib.crc32(ids[start:edge]))
                    start = edge
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema(
                    [
                        ("doc_id", pa.int64()),
                        ("piece", pa.int32()),
                        ("start", pa.int64()),
                        ("length", pa.int64()),
                        ("ids_crc32", pa.int64()),
                    ]
                ),
            )
        give_back()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def best_fit(
    lengths: np.ndarray,
    capacity: tuple[float, float, float] = (SEQUENCE, MOST_DOCUMENTS, MOST_COST),
    weights: tuple[float, float, float] = WEIGHTS,
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length; lengths should come longest first."""
    n = len(lengths)
    full = np.asarray(capacity, float)
    weight = np.asarray(weights, float)[:, None]
    rest = np.empty((3, max(n, 1)))
    opened, names = 0, np.empty(max(n, 1), np.int64)
    total, sequence, offset = 0, np.empty(n, np.int64), np.empty(n, np.int64)
    least = lengths.min() if n else 0
    for i, length in enumerate(lengths):
        demand = np.array([length, 1.0, float(length) * length])[:, None]
        left = rest[:, :opened] - demand
        fits = np.flatnonzero(left.min(axis=0) >= 0) if opened else []
        if len(fits):
            share = left[:, fits] / full[:, None]
            if rule == "norm":
                score = (weight * share * share).sum(axis=0)
            else:
                score = -(weight * (demand / full[:, None]) * (rest[:, fits] / full[:, None])).sum(axis=0)
            at = fits[np.argmin(score)]
        else:
            at = opened
            rest[:, at], names[at] = full, total
            opened, total = opened + 1, total + 1
        sequence[i], offset[i] = names[at], full[0] - rest[0, at]
        rest[:, at] -= demand[:, 0]
        if rest[0, at] < least or rest[1, at] < 1:  # closed: the last open one takes its place
            opened -= 1
            rest[:, at], names[at] = rest[:, opened], names[opened]
    return sequence, offset


def pack(cut: DataFrame, shard_pieces: int = SHARD_PIECES, **options) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces with a number ``_row`` for each."""
    rows = cut.count()
    shards = max(1, -(-rows // shard_pieces))
    # by row, not by id: repeated rows are spread like any others
    shard = F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("long")

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = best_fit(table["length"].to_numpy(), **options)
        base = table["_shard"][0].as_py() << 32
        table = table.drop_columns(["_shard", "_row"])
        return table.append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return cut.withColumn("_shard", shard).groupBy("_shard").applyInArrow(place, schema)


def pack_documents(
    docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_token: int = END_TOKEN, **options
) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    path = path or vocabulary("byte_bpe_50k.json")
    numbered = pieces(docs, path, sequence, end_token).withColumn("_row", F.monotonically_increasing_id())
    with conf(docs.sparkSession, **BATCH):
        cut = write_stage(numbered, "pieces")
    capacity = (sequence, MOST_DOCUMENTS, float(sequence) ** 2)
    return pack(cut, **{"capacity": capacity, **options})
