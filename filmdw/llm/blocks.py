"""An exchange between blocks of documents and shards of hashes.

Documents are dealt to blocks by a hash, once; every pass over the blocks reads that same exchange.
A block sends each distinct value once, packed by shard; a shard finds what occurs again anywhere
and answers each block with what concerns it. So a value that a third of all documents share costs
one entry per block, no shard sees more than one entry per block and value, and nothing passes
through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from filmdw.llm.words import text_or_empty

#: characters of text in a block, blocks whose values meet in a shard
BLOCK_CHARACTERS = 1_500_000
BLOCKS_PER_SHARD = 4
LEAST_BLOCKS = 24


def in_blocks(
    docs: DataFrame, carry: tuple[str, ...] = (), block_characters: int = BLOCK_CHARACTERS
) -> tuple[DataFrame, int]:
    """(doc_id, text, block, and the columns of ``carry`` in one) and the number of blocks, which follows
    the size of the table."""
    carried = F.lit(None).cast("int")
    if carry:
        # what comes back from the tasks may be null, whatever the table says
        carried = F.struct(*carry).cast(docs.select(*carry).schema.simpleString())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", carried.alias("carried"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(LEAST_BLOCKS, -(-total // block_characters))
    block = F.pmod(F.xxhash64("doc_id", text_or_empty(F.col("text"))), F.lit(blocks)).cast("long")
    return rows.withColumn("block", block), blocks


def texts_of(table: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and encoded texts of a block, in the order of ``placed``."""
    return table["doc_id"].to_pylist(), [(t.as_py() or "").encode() for t in table["text"]]


def placed(table: pa.Table) -> pa.Table:
    """The block in an order that does not depend on how rows arrived."""
    keys = [("doc_id", "ascending"), ("text", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=keys))


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpacked(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(v.as_py(), kind) for v in column]


def by_shard(shards: int, key: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(shard, the columns of that shard) for the shards that have any."""
    shard = (key % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        chosen = order[a:b]
        yield int(shard[chosen[0]]), *(c[chosen] for c in columns)


def table_of(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_VALUES = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("values", pa.binary()), ("twice", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("values", pa.binary()), ("often", pa.binary())])


def recurring(dealt: DataFrame, blocks: int, values_of: Callable, often: int = 1 << 60) -> DataFrame:
    """(block, values, often): which of a block's values occur again anywhere, and which of those
    occur in more than ``often`` blocks.

    ``values_of(ids, texts)`` gives a block's distinct values and whether each occurs twice in it.
    """
    shards = max(1, blocks // BLOCKS_PER_SHARD)

    def send(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        values, twice = values_of(*texts_of(placed(table)))
        rows = [(s, block, packed(v), packed(t)) for s, v, t in by_shard(shards, values, values, twice)]
        return table_of(_VALUES, rows)

    def meet(table: pa.Table) -> pa.Table:
        values, twice = unpacked(table["values"], np.uint64), unpacked(table["twice"], np.bool_)
        every = np.concatenate(values)
        distinct, at, count = np.unique(every, return_inverse=True, return_counts=True)
        again = count > 1
        again[at[np.concatenate(twice)]] = True
        answers, start = [], 0
        for block, own in zip(table["block"].to_pylist(), values):
            place = at[start : start + len(own)]
            chosen = again[place]
            if chosen.any():
                answers.append((block, packed(own[chosen]), packed(count[place][chosen] > often)))
            start += len(own)
        return table_of(_ANSWER, answers)

    sent = dealt.groupBy("block").applyInArrow(send, "shard long, block long, values binary, twice binary")
    return sent.groupBy("shard").applyInArrow(meet, "block long, values binary, often binary")


def inside(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each value is in the ordered ones, its place there)."""
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values, place
