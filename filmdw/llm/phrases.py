"""Substring dedup by repeated-phrase automata.

A window of ``WINDOW`` words is kept in the first document it starts in, by id, and removed from all
others. Passes over blocks of documents:

1. Every window names an anchor, the smallest hash of its runs of ``ANCHOR`` words, so equal windows
   name equal anchors, and a document needs few of them. Shards find the anchors that recur.
2. Windows with a recurring anchor are confirmed: a shard compares 128 bits of each and answers with
   the smallest document id of those that start in several documents.
3. Each block is a shard of the automata: the passages confirmed for it (longest runs of recurring
   windows) are compiled into an Aho-Corasick automaton, and all documents of the block are streamed
   through it. Each occurrence of a passage removes the words of the windows that an earlier
   document holds.

An automaton holds at most the text of its block. Defined results: null or blank texts have no words;
texts shorter than a window lose nothing; windows are judged on the input; among rows with equal ids
none removes from another; a row without an id comes first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filmdw.llm.blocks import by_shard, in_blocks, inside, packed, placed, recurring, table_of, texts_of, unpacked
from filmdw.llm.blocks import BLOCKS_PER_SHARD
from filmdw.llm.hashing import run_hashes, slices, word_hashes
from filmdw.llm.memory import give_back

WINDOW = 13
ANCHOR = 5
#: stands for a missing id, before all others
NO_ID = -(1 << 63)

_WINDOWS = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("one", "two", "first", "last")]
)
_OWNERS = pa.schema([("block", pa.int64())] + [(c, pa.binary()) for c in ("one", "two", "owner")])
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())]
)


def _windows(ids: list, texts: list[bytes], window: int, anchor: int):
    """Per slice of a block: (document, anchor, hash, second hash) of every window, by position."""
    for group in slices(zip(ids, texts), lambda row: len(row[1])):
        words, counts = word_hashes([t for _, t in group])
        own = np.array([NO_ID if d is None else d for d, _ in group])
        if len(words) < window:
            continue
        grams = run_hashes(words, anchor)
        n = len(words) - window + 1
        least = grams[:n].copy()
        for i in range(1, window - anchor + 1):
            np.minimum(least, grams[i : i + n], out=least)
        ends = np.cumsum(counts)
        left = np.repeat(ends, counts)[:n] - np.arange(n)
        whole = left >= window
        documents = np.repeat(own, counts)[:n]
        yield documents[whole], least[whole], run_hashes(words, window, 2)[whole], run_hashes(words, window, 3)[whole]


def _anchors(window: int, anchor: int):
    def values_of(ids: list, texts: list[bytes]):
        values, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for documents, least, _, _ in _windows(ids, texts, window, anchor):
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (documents[1:] != documents[:-1])
            values.append(least[new])
            owners.append(documents[new])
        values, owners = np.concatenate(values), np.concatenate(owners)
        distinct, at = np.unique(values, return_inverse=True)
        low = np.full(len(distinct), np.iinfo(np.int64).max)
        high = np.full(len(distinct), np.iinfo(np.int64).min)
        np.minimum.at(low, at, owners)
        np.maximum.at(high, at, owners)
        return distinct, low < high

    return values_of


def _answer(right: pa.Table, *kinds) -> list[np.ndarray]:
    """The answers of all shards to a block, ordered by the first column."""
    columns = [
        np.concatenate([np.zeros(0, kind), *unpacked(right[name], kind)]) for name, kind in kinds
    ]
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the remaining words joined by a blank), kept_sha256, and the
    columns of ``carry`` in one."""
    dealt, blocks = in_blocks(docs, carry)
    shards = max(1, blocks // BLOCKS_PER_SHARD)
    suspected = recurring(dealt, blocks, _anchors(window, anchor))

    def candidates(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table_of(_WINDOWS, [])
        (anchors,) = _answer(right, ("values", np.uint64))
        parts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for documents, least, one, two in _windows(*texts_of(placed(left)), window, anchor):
            chosen = inside(least, anchors)[0]
            for part, column in zip(parts, (documents, one, two)):
                part.append(column[chosen])
        documents, one, two = map(np.concatenate, parts)
        # one entry for each distinct window, with its smallest and largest document
        order = np.lexsort((documents, two, one))
        documents, one, two = documents[order], one[order], two[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(one))[: len(starts)] - 1
        block = left["block"][0].as_py()
        columns = one[starts], two[starts], documents[starts], documents[ends]
        rows = [(s, block, *map(packed, own)) for s, *own in by_shard(shards, columns[0], *columns)]
        return table_of(_WINDOWS, rows)

    def confirm(table: pa.Table) -> pa.Table:
        ones = unpacked(table["one"], np.uint64)
        sizes = [len(o) for o in ones]
        one = np.concatenate(ones)
        two = np.concatenate(unpacked(table["two"], np.uint64))
        first = np.concatenate(unpacked(table["first"], np.int64))
        last = np.concatenate(unpacked(table["last"], np.int64))
        order = np.lexsort((two, one))
        new = np.ones(len(one), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        starts = np.flatnonzero(new)
        group = np.empty(len(one), np.int64)
        group[order] = np.cumsum(new) - 1
        owner = np.minimum.reduceat(first[order], starts)[group]
        several = owner < last  # this block holds a later document than the owner
        rows, start = [], 0
        for block, size in zip(table["block"].to_pylist(), sizes):
            part = slice(start, start + size)
            chosen = several[part]
            if chosen.any():
                rows.append((block, packed(one[part][chosen]), packed(two[part][chosen]), packed(owner[part][chosen])))
            start += size
        return table_of(_OWNERS, rows)

    def locate(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table_of(_RESULT, []).append_column("carried", left["carried"])
        one, two, owner = _answer(right, ("one", np.uint64), ("two", np.uint64), ("owner", np.int64))
        left = placed(left)
        found = table_of(_RESULT, _stream(*texts_of(left), one, two, owner, window))
        give_back()
        return found.append_column("carried", left["carried"])

    blocks_of = dealt.groupBy("block")
    sent = blocks_of.cogroup(suspected.groupBy("block")).applyInArrow(
        candidates, "shard long, block long, one binary, two binary, first binary, last binary"
    )
    owners = sent.groupBy("shard").applyInArrow(confirm, "block long, one binary, two binary, owner binary")
    return blocks_of.cogroup(owners.groupBy("block")).applyInArrow(
        locate,
        "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string, carried "
        + dealt.schema["carried"].dataType.simpleString(),
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """``docs``, in its columns, without repeated passages. A text that loses nothing stays as it is,
    others become their remaining words joined by a blank; without any left, the row goes. ``n_chars``,
    where there is one, follows the text."""
    rows = remove_repeats(docs, carry=tuple(docs.columns), **options)
    text = F.when(F.col("n_removed") == 0, F.col("carried.text")).otherwise(F.col("kept"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    rows = rows.where("n_removed = 0 OR n_removed < n_words")
    return rows.select(*[new.get(c, F.col("carried")[c]).alias(c) for c in docs.columns])


def _stream(ids: list, texts: list[bytes], one, two, owner, window: int) -> list[tuple]:
    """Compile the confirmed passages of a block and look for them in all its documents."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    split = [t.split() for t in texts]
    for group in slices(zip(texts, split), lambda row: len(row[0])) if len(one) else ():
        words, counts = word_hashes([t for t, _ in group])
        first, second, start = run_hashes(words, window, 2), run_hashes(words, window, 3), 0
        for (_, own), n in zip(group, counts):
            places = slice(start, start + max(0, n - window + 1))
            found, at = inside(first[places], one)
            # equal first halves are told apart by the second
            while found.any() and (wrong := found & (two[at] != second[places])).any():
                at = np.minimum(at + wrong, len(one) - 1)
                found &= one[at] == first[places]
                if (wrong & (at == len(one) - 1) & (two[at] != second[places])).any():
                    found &= two[at] == second[places]
            edges = np.flatnonzero(np.diff(found, prepend=False, append=False))
            for a, b in zip(edges[::2], edges[1::2]):
                passage = " " + b" ".join(own[a : b + window - 1]).decode() + " "
                if passage not in automaton:
                    automaton.add_word(passage, (b + window - 1 - a, owner[at[a:b]]))
            start += n
    if len(automaton):
        automaton.make_automaton()
    rows = []
    for doc_id, own in zip(ids, split):
        removed = np.zeros(len(own), bool)
        if len(automaton) and len(own) >= window:
            rank = NO_ID if doc_id is None else doc_id
            hay = " " + b" ".join(own).decode() + " "
            longest: dict[int, tuple] = {}
            for end, value in automaton.iter(hay):
                # shorter passages that end here are its ends, and say the same
                if end not in longest or value[0] > longest[end][0]:
                    longest[end] = value
            if longest:
                blanks = np.flatnonzero(np.frombuffer(hay.encode("utf-32-le"), np.uint32) == 32)
                change = np.zeros(len(own) + 1, np.int64)
                for end, (n, owners) in longest.items():
                    start = int(np.searchsorted(blanks, end)) - n
                    late = start + np.flatnonzero(owners < rank)
                    np.add.at(change, late, 1)
                    np.add.at(change, late + window, -1)
                removed = np.cumsum(change[:-1]) > 0
        kept = b" ".join(w for w, gone in zip(own, removed) if not gone)
        rows.append(
            (doc_id, len(own), int(removed.sum()), kept.decode(), hashlib.sha256(kept).hexdigest())
        )
    return rows
