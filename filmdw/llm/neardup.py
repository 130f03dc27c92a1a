"""Near-duplicates by MinHash with tensored banding, and links confirmed on full shingle sets.

Two small collections of half keys, each of ``ROWS`` minhashes, are drawn for every distinct shingle
set. A table key is a pair of one half key from either collection, so ``HALVES`` squared tables cost
2 * HALVES * ROWS minhashes instead of as many for each table. Half keys that no other set shares
are dropped first; keys are formed from the rest only.

Rows with equal sets form a class, and only classes are compared. In a table bucket every member is
compared with the first, links are confirmed on the full sets and components are formed: linked
copies are settled by one comparison each. Members of buckets that still hold several components go
through an exact filter on their rarest shingles, sizes, places and parities, and the pairs that pass it are
confirmed. No bucket is capped, and a pair within a component is not compared again.

Defined results: a null text or one without words has an empty set, a component of its own and is
linked with nothing; a text of fewer words than a shingle is one shingle; rows with equal ids are
judged each by their text; component_id is the smallest id of a component's rows; a row without an
id has component_id null unless others are linked to it; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from filmdw.llm.hashing import mixed, run_hashes, slices, word_hashes
from filmdw.llm.words import free_name
from filmdw.session import write_stage

SHINGLE = 5
PERCENT = 80
HALVES = 12
ROWS = 2
PARITIES = [f"odd_{i}" for i in range(8)]
# shingles carried with each one, so that a pair is not met again at the next shingle it shares
RARER = 16


def shingle_sets(texts: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased."""
    words, counts = word_hashes([t.lower() for t in texts])
    runs, start = run_hashes(words, shingle), 0
    for n in counts:
        if n >= shingle:
            yield np.unique(runs[start : start + n - shingle + 1])
        elif n:
            yield run_hashes(words[start : start + n], int(n), 1)
        else:
            yield runs[:0]
        start += n


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, shingle: int, halves: int = HALVES, rows: int = ROWS) -> DataFrame:
    """doc_id, row (a hash of id and text), n_shingles, digest of the set, and its half keys of both
    collections in one array."""
    random = np.random.default_rng(6)
    factors = random.integers(0, 1 << 63, 2 * halves * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"n_shingles": [], "digest": [], "half_keys": []}
            texts = ((t.as_py() or "").encode() for t in batch.column(1))
            for group in slices(texts, len):
                for own in shingle_sets(group, shingle):
                    out["n_shingles"].append(len(own))
                    out["digest"].append(set_digest(own))
                    if len(own):
                        # the shift makes the minimum depend on all bits of the product
                        least = np.array([mixed(own * f).min() for f in factors]) if len(own) > 4096 else (
                            mixed(own[None, :] * factors[:, None]).min(axis=1)
                        )
                        keys = mixed(run_pairs(least.reshape(2 * halves, rows))).view(np.int64)
                    else:
                        keys = np.zeros(0, np.int64)
                    out["half_keys"].append(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(out["n_shingles"], pa.int64()),
                    pa.array(out["digest"], pa.binary()),
                    pa.array(out["half_keys"], pa.list_(pa.int64())),
                ],
                ["doc_id", "row", "n_shingles", "digest", "half_keys"],
            )

    schema = "doc_id long, row long, n_shingles long, digest binary, half_keys array<long>"
    return docs.select("doc_id", "text", row_hash().alias("row")).mapInArrow(sign, schema)


def row_hash() -> Column:
    return F.xxhash64("doc_id", "text")


def run_pairs(least: np.ndarray) -> np.ndarray:
    """One value per row of minhashes."""
    total = np.zeros(len(least), np.uint64)
    for i in range(least.shape[1]):
        total = mixed(total ^ least[:, i], i + 1)
    return total


def tables(classes: DataFrame, halves: int) -> DataFrame:
    """(key, node): keys paired from half keys that other classes share too."""
    each = classes.select("node", F.posexplode("half_keys").alias("i", "half"))
    shared = each.groupBy("i", "half").agg(F.count("*").alias("n")).where("n > 1").select("i", "half")
    found = each.join(shared, ["i", "half"]).groupBy("node").agg(
        F.collect_list(F.when(F.col("i") < halves, F.struct("i", "half"))).alias("a"),
        F.collect_list(F.when(F.col("i") >= halves, F.struct("i", "half"))).alias("b"),
    )
    pairs = found.select("node", F.explode("a").alias("a"), "b").select("node", "a", F.explode("b").alias("b"))
    return pairs.select(F.xxhash64("a.i", "a.half", "b.i", "b.half").alias("key"), "node")


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (p, x) whose full sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, x, of_p, of_x = batch.columns
            keep, sets, held = [], {}, 0
            for i, (a, b) in enumerate(zip(p.to_pylist(), x.to_pylist())):
                for node, column in ((a, of_p), (b, of_x)):
                    if node not in sets:
                        if held > 2_000_000:
                            sets, held = {k: v for k, v in sets.items() if k == a}, 0
                        sets[node] = next(shingle_sets([column[i].as_py().encode()], shingle))
                        held += len(sets[node])
                one, two = sets[a], sets[b]
                both = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * both >= percent * (len(one) + len(two) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([p.take(pa.array(keep, pa.int64())), x.take(pa.array(keep, pa.int64()))], ["p", "x"])

    with_x = pairs.join(texts.select(F.col("node").alias("x"), F.col("text").alias("of_x")), "x")
    with_both = with_x.join(texts.select(F.col("node").alias("p"), F.col("text").alias("of_p")), "p")
    return with_both.select("p", "x", "of_p", "of_x").mapInArrow(verify, "p long, x long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (p, x): the smallest node reachable.

    Each round takes the smallest of a node's label, the labels next to it and its label's own label,
    so distances double from round to round. A round is one written table.
    """
    both = write_stage(
        links.select("p", "x").unionByName(links.select(F.col("x").alias("p"), F.col("p").alias("x"))).distinct(),
        "links",
    )
    labels = write_stage(
        both.groupBy("p").agg(F.min("x").alias("least")).select(
            F.col("p").alias("node"), F.least("p", "least").alias("component")
        ),
        "labels",
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "x"), "x").groupBy("p").agg(F.min("component").alias("near"))
        onward = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        least = F.least("component", "near", "further")
        moved = labels.join(near.withColumnRenamed("p", "node"), "node").join(onward, "component")
        changed = Observation()
        moved = moved.select("node", least.alias("component"), (least != F.col("component")).alias("moved"))
        labels = write_stage(moved.observe(changed, F.count_if("moved").alias("n")), "labels").drop("moved")
        if not changed.get["n"]:
            return labels


def shingle_rows(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, n, shingle): a row for each distinct shingle hash of a text, n of them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in slices((t.as_py().encode() for t in batch.column(1)), len):
                sets = list(shingle_sets(group, shingle))
                sizes = np.array([len(own) for own in sets])
                nodes = np.repeat(batch.column(0).slice(at, len(sets)).to_numpy(), sizes)
                columns = [nodes, np.repeat(sizes, sizes), np.concatenate(sets).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "n", "shingle"])
                at += len(sets)

    return texts.select("node", "text").mapInArrow(rows, "node long, n long, shingle long")


def parities(held: DataFrame) -> DataFrame:
    """(node, odd_0 .. odd_7): for each of 512 bits whether an odd number of the set's shingles falls on it.

    The bits in which two sets differ are at most as many as the shingles that only one of them has.
    """
    bit, word = F.expr("shiftleft(1L, CAST(shingle & 63 AS INT))"), F.expr("shiftright(shingle, 6) & 7")
    odd = [F.coalesce(F.bit_xor(F.when(word == i, bit)), F.lit(0)).alias(c) for i, c in enumerate(PARITIES)]
    return held.groupBy("node").agg(*odd)


def pairs_between(nodes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(p, x): a superset of the similar pairs of ``nodes`` (node, component) in different components.

    With the shingles of every set in one order, rarest first, the first shingle that two sets share
    leaves no more in common than the fewer of the shingles from there on, those that no other set
    holds left out. Only pairs that can still reach the similarity there are met, so that sets with a
    common passage, or copies with too many changes of their own, are not. Of those, pairs whose parities
    differ in more bits than similar sets differ in shingles are left out. No similar pair is lost.

    Two sets that share one of the ``RARER`` shingles just before, in the order of either, are met there
    or earlier, where they can reach more, and not again.
    """
    held = write_stage(shingle_rows(texts.join(nodes, "node", "left_semi"), shingle), "shingles")
    shared = held.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1")
    order = Window.partitionBy("node").orderBy(F.desc("holders"), F.desc("shingle"))
    ahead = held.join(shared, "shingle").withColumn("left", F.row_number().over(order))
    # no partner can be similar if fewer are left than it must share of the set alone
    ahead = ahead.where(F.col("left") * 100 >= F.col("n") * percent)
    ahead = ahead.withColumn("rarer", F.collect_list("shingle").over(order.rowsBetween(1, RARER)))
    marked = nodes.join(parities(held), "node")
    columns = ["node", "component", "n", "left", "rarer", *PARITIES]
    ahead = write_stage(ahead.join(marked, "node").select("shingle", *columns), "ahead")
    other = ahead.select("shingle", *[F.col(c).alias(f"{c}_2") for c in columns])
    both = F.col("n") + F.col("n_2")
    reach = F.least("left", "left_2") * (100 + percent) >= both * percent
    apart = reduce(add, [F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_2"))) for c in PARITIES])
    met = (
        ahead.join(other, "shingle")
        .where("node < node_2 AND component != component_2")
        .where(reach & (apart * (100 + percent) <= both * (100 - percent)))
        .where(~F.arrays_overlap("rarer", "rarer_2"))
    )
    return met.select(F.col("node").alias("p"), F.col("node_2").alias("x")).distinct()


def link_classes(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, labels) of classes: all confirmed links that are needed for the components."""
    spark = members.sparkSession
    leads = members.groupBy("key").agg(F.min("node").alias("p"))
    pairs = members.join(leads, "key").where("node != p").select("p", F.col("node").alias("x")).distinct()
    links = write_stage(confirmed(write_stage(pairs, "pairs"), texts, shingle, percent), "confirmed")
    labels = None if links.isEmpty() else components(links)
    named = members.withColumn("component", F.col("node"))
    if labels is not None:
        named = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    still_open = named.join(spread.where("lo < hi").select("key"), "key", "left_semi")
    nodes = write_stage(still_open.select("node", "component").distinct(), "open-nodes")
    pairs = write_stage(pairs_between(nodes, texts, shingle, percent), "pairs")
    found = write_stage(confirmed(pairs, texts, shingle, percent), "confirmed")
    if not found.isEmpty():
        labels, links = _relabelled(labels, found), links.unionByName(found)
    return links, spark.createDataFrame([], "node long, component long") if labels is None else labels


def _relabelled(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """Labels after new links: the components found so far are linked, not their nodes again."""
    if labels is None:
        return components(found)
    now = [labels.select(F.col("node").alias(e), F.col("component").alias(f"of_{e}")) for e in ("p", "x")]
    between = found.join(now[0], "p", "left").join(now[1], "x", "left").select(
        F.coalesce("of_p", "p").alias("p"), F.coalesce("of_x", "x").alias("x")
    )
    merged = components(between.where("p != x").distinct())
    onward = merged.select(F.col("node").alias("component"), F.col("component").alias("least"))
    old = labels.join(onward, "component", "left").select("node", F.coalesce("least", "component").alias("component"))
    return write_stage(old.unionByName(merged.join(labels, "node", "left_anti")), "labels")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, halves: int = HALVES, rows: int = ROWS
) -> DataFrame:
    """doc_id, row, n_shingles, class_id (smallest id with an equal set), component_id and kept, per row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = write_stage(signatures(docs, shingle, halves, rows), "signatures")
    classes = (
        signed.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("class_id"), F.min("row").alias("row"), F.first("half_keys").alias("half_keys"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = write_stage(classes, "classes")
    members = write_stage(tables(classes, halves), "tables")
    several = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = write_stage(members.join(several, "key"), "tables")
    wanted = members.select("node").distinct().join(classes.select("node", "row", "digest"), "node")
    texts = write_stage(_texts(docs, wanted, shingle), "candidates")
    _, labels = link_classes(members, texts, shingle, percent)

    named = classes.select("node", "class_id", "digest").join(labels, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "component").select("digest", "class_id", "component_id")
    return (
        signed.join(named, "digest", "left")
        .select(
            "doc_id",
            "row",
            "n_shingles",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    )


def _texts(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, text) for the classes wanted: the row of the class's smallest row hash, with or without an
    id, if it has the class's set."""

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, at = [], 0
            digests = batch.column(2)
            for group in slices((t.as_py().encode() for t in batch.column(1)), len):
                for own in shingle_sets(group, shingle):
                    if set_digest(own) == digests[at].as_py():
                        keep.append(at)
                    at += 1
            chosen = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(i).take(chosen) for i in (0, 1)], ["node", "text"])

    held = docs.where("text IS NOT NULL").select("text", row_hash().alias("row")).join(wanted, "row")
    checked = held.select("node", "text", "digest").mapInArrow(same, "node long, text string")
    return checked.groupBy("node").agg(F.min("text").alias("text"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with their columns, that their group keeps; equal rows once."""
    columns = docs.columns
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    judged = write_stage(near_duplicates(docs, **options).select("row", "kept"), "judged")
    row = free_name(columns, "_row")
    gone = judged.where("NOT kept").select(F.col("row").alias(row)).distinct()
    # texts are shuffled once, by row: what goes is left out and equal rows are taken once in the same place
    left = docs.withColumn(row, row_hash()).join(gone, row, "left_anti")
    return left.dropDuplicates([row]).select(*columns)
