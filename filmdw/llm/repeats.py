"""Removal of repeated byte strings by the common-prefix interval tree of enhanced suffix arrays.

A byte is removed when a string of ``LENGTH`` bytes over it also starts anywhere else, in the same
document or another. Passes over blocks of documents:

1. Every window of LENGTH bytes names an anchor, the smallest hash of its runs of ``GRAM`` bytes.
   Windows in a row with one anchor form a segment, so equal windows lie in segments of equal
   anchors. Shards find the anchors that recur.
2. Segments of recurring anchors meet in the shard of their anchor, equal ones of a block once. A
   shard with different segments of an anchor builds an enhanced suffix array over them (suffix
   order by prefix doubling up to the length sought, common prefixes from the ranks). A stack scan
   over the common prefixes yields the intervals of the common-prefix tree; an interval of at least
   LENGTH whose suffixes have different bytes on their left is a maximal repeat, and all its
   occurrences are covered, not just neighbours. Suffixes that agree as far as they are ordered are
   covered that far at each of their places, whatever is on their left, so repeats of any length
   are found whole.
3. Blocks map what is covered back to every document that holds the segment.

An anchor in more than ``OFTEN`` blocks would bring unbounded segments to one shard (the edges of a
passage that very many documents share). Its windows are settled one by one instead, by 128 bits of
hash dealt to shards by that hash. Both ways are exact, so the bound drops nothing.

Defined results: null or empty texts have no bytes; shorter texts lose nothing; overlapping strings
count, and strings are judged on the input; rows with equal ids are documents of their own, so exact
copies of a row lose their repeated bytes like others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filmdw.llm.blocks import BLOCKS_PER_SHARD, by_shard, in_blocks, inside, packed, placed, recurring, table_of, texts_of, unpacked
from filmdw.llm.hashing import mixed, powers

LENGTH = 400
GRAM = 32
OFTEN = 200
#: bytes of segments in one suffix array
ARRAY_BYTES = 1_000_000
#: a byte that no UTF-8 text has
BETWEEN = b"\xff"
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(10).integers(1, 1 << 63, 256, dtype=np.uint64)
_BACK = np.ones(1, np.uint64)

_SENT = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64()), ("kind", pa.string()), ("one", pa.binary()), ("two", pa.binary())]
    + [("twice", pa.binary()), ("segments", pa.list_(pa.binary()))]
)
_SENT_TYPES = "shard long, block long, kind string, one binary, two binary, twice binary, segments array<binary>"
_SAID = pa.schema([("block", pa.int64()), ("kind", pa.string())] + [(c, pa.binary()) for c in ("one", "two", "place", "start", "end")])
_SAID_TYPES = "block long, kind string, one binary, two binary, place binary, start binary, end binary"
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
    + [("kept", pa.binary()), ("kept_sha256", pa.string())]
)


def _backwards(n: int) -> np.ndarray:
    global _BACK
    if len(_BACK) < n:
        _BACK = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _STEP_INVERSE)]), dtype=np.uint64)
    return _BACK[:n]


def byte_runs(text: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of k bytes, from prefix sums."""
    if len(text) < k:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((_VALUES ^ np.uint64(salt))[text] * powers(len(text)), out=sums[1:])
    n = len(text) - k + 1
    return mixed((sums[k:] - sums[:n]) * _backwards(n), salt)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments_of(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per document that has a window: its number, all gram hashes, and per segment its anchor, first
    window and the window after its last."""
    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        grams = byte_runs(np.frombuffer(text, np.uint8), gram)
        least = sliding_least(grams, length - gram + 1)
        edges = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate([[0], edges])
        yield i, grams, least[first], first, np.append(edges, len(least))


def _anchors(length: int, gram: int):
    def values_of(ids: list, texts: list[bytes]):
        values, doubled = [np.zeros(0, np.uint64)], []
        for _, grams, anchors, first, after in segments_of(texts, length, gram):
            values.append(anchors)
            # an anchor may stand twice among the windows of one segment
            for anchor, a, b in zip(anchors, first, after):
                if np.count_nonzero(grams[a : b + length - gram] == anchor) > 1:
                    doubled.append(anchor)
        distinct, count = np.unique(np.concatenate(values), return_counts=True)
        return distinct, (count > 1) | np.isin(distinct, np.array(doubled, np.uint64))

    return values_of


# ---- enhanced suffix array


def ordered_bytes(length: int) -> int:
    """How many bytes order the suffixes: the first doubling of 8 that holds ``length``."""
    size = 8
    while size < length:
        size *= 2
    return size


def suffix_array(text: np.ndarray, length: int, sought: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes ordered by their first ``ordered_bytes(length)`` bytes; common prefix of each with the
    one before, up to that many). Of all suffixes, or of those that ``sought`` marks."""
    n, most = len(text), ordered_bytes(length)
    # the places that have a rank at each size: a rank needs those of its two halves
    ranked = {most: np.ones(n, bool) if sought is None else sought}
    size = most
    while size > 8:
        at = ranked[size]
        size //= 2
        ranked[size] = at.copy()
        ranked[size][size:] |= at[: max(n - size, 0)]
    packed_bytes = np.zeros(n, np.uint64)
    padded = np.concatenate([text, np.zeros(size, np.uint8)]).astype(np.uint64)
    for i in range(size):
        packed_bytes = (packed_bytes << np.uint64(8)) | padded[i : i + n]
    at = np.flatnonzero(ranked[size])
    order = at[np.argsort(packed_bytes[at])]
    values = packed_bytes[order]
    ranks = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]])[: len(order)])
    levels = []
    while True:
        rank = np.zeros(n + 1, np.int64)
        rank[order] = ranks
        levels.append((size, rank))
        tied = ranks[1:] == ranks[:-1]
        if size == most or not tied.any():
            break
        kept = ranked[2 * size][order]
        order, ranks = order[kept], ranks[kept]
        tied = ranks[1:] == ranks[:-1]
        # only suffixes with an equal rank are put in order again; the end of the text comes first
        chosen = np.flatnonzero(np.concatenate([tied, [False]]) | np.concatenate([[False], tied]))
        halves = np.zeros(len(order), np.int64)
        ahead = order[chosen] + size
        halves[chosen] = np.where(ahead < n, rank[np.minimum(ahead, n)] + 1, 0)
        keys = ranks[chosen] * (n + 2) + halves[chosen]
        sorting = np.argsort(keys)
        order[chosen], halves[chosen] = order[chosen[sorting]], halves[chosen[sorting]]
        ranks = np.cumsum(np.concatenate([[0], ~tied | (halves[1:] != halves[:-1])])[: len(order)])
        size *= 2
    order = order[ranked[most][order]]
    common = np.zeros(len(order), np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for size, rank in reversed(levels):
        inside_text = np.maximum(a, b) < n
        same = inside_text & (rank[np.minimum(a, n)] == rank[np.minimum(b, n)])
        # beyond the end of the text, bytes are counted as zero; the callers cut that off
        common[1:] += np.where(same, size, 0)
        a, b = a + size * same, b + size * same
    last = np.append(packed_bytes, np.uint64(0))
    apart = last[np.minimum(a, n)] ^ last[np.minimum(b, n)]
    for equal in range(1, 8):
        common[1:] += (apart >> np.uint64(64 - 8 * equal)) == 0
    return order, np.minimum(common, most)


def maximal_repeats(
    text: np.ndarray, order: np.ndarray, common: np.ndarray, least: int, most: int = 1 << 62
) -> Iterator[tuple[int, np.ndarray]]:
    """(length, all places) of every repeat of at least ``least`` bytes that cannot be extended to both
    sides: a stack scan over the common prefixes closes one interval of the tree at a time.

    Common prefixes end at ``most``, where the order ends too. What reaches it is yielded first, at all
    its places: a repeat that starts further left may end before it, so the left tells nothing there.
    """
    n = len(order)
    reached = common >= most
    reached[:-1] |= reached[1:]
    if reached.any():
        yield most, order[reached]
    left = np.where(order > 0, text[order - 1].astype(np.int64), -1)
    # whether a byte on the left differs from that of the suffix before, summed, tells of diversity
    differs = np.cumsum(np.concatenate([[0], (left[1:] != left[:-1]) | (left[1:] == 255) | (left[1:] < 0)]))
    stack: list[tuple[int, int]] = []
    at = np.flatnonzero(common >= least)
    previous = -2
    for i in [*at.tolist(), n]:
        if i != previous + 1 or i == n:  # a smaller common prefix between: every open interval ends
            while stack:
                depth, start = stack.pop()
                if depth < most and differs[previous] > differs[start]:
                    yield depth, order[start : previous + 1]
        if i == n:
            break
        depth, start = int(common[i]), i - 1
        while stack and stack[-1][0] > depth:
            closed, start = stack.pop()
            if closed < most and differs[i - 1] > differs[start]:
                yield closed, order[start:i]
        if not stack or stack[-1][0] < depth:
            stack.append((depth, start))
        previous = i


def joined(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all segments with BETWEEN around them; start and size of each; whether a string of
    ``length`` bytes of a segment starts at a place)."""
    text = np.frombuffer(BETWEEN.join([b"", *segments, b""]), np.uint8)
    sizes = np.array([len(s) for s in segments])
    starts = np.cumsum(np.append(1, sizes[:-1] + 1))
    change = np.zeros(len(text) + 1, np.int64)
    long = sizes >= length
    change[starts[long]] += 1
    change[(starts + sizes - length + 1)[long]] -= 1
    return text, starts, sizes, np.cumsum(change[:-1]) > 0


def may_repeat(segments: list[bytes], length: int) -> np.ndarray:
    """Numbers of the segments with a string of ``length`` bytes whose hash occurs again in these: an
    anchor recurs more often than the strings around it, and the others need no place in the array."""
    text, starts, _, sought = joined(segments, length)
    places = np.flatnonzero(sought)
    hashes = byte_runs(text, length, 23)[places]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.concatenate([order[1:][same], order[:-1][same]])
    return np.unique(np.searchsorted(starts, places[again], side="right") - 1)


def repeated_in(segments: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """What is covered in each segment by strings of ``length`` bytes that occur again in these."""
    found: list[list[tuple[int, int]]] = [[] for _ in segments]
    chosen = may_repeat(segments, length)
    if not len(chosen):
        return found
    text, starts, sizes, sought = joined([segments[i] for i in chosen], length)
    # a repeat starts where its segment has that many bytes left
    order, common = suffix_array(text, length, sought)
    # a common prefix ends with the segment of either suffix
    owner = np.maximum(np.searchsorted(starts, order, side="right") - 1, 0)
    room = np.maximum(starts[owner] + sizes[owner] - order, 0)
    common[1:] = np.minimum(common[1:], np.minimum(room[1:], room[:-1]))
    change = np.zeros(len(text) + 1, np.int64)
    for depth, places in maximal_repeats(text, order, common, length, ordered_bytes(length)):
        np.add.at(change, places, 1)
        np.add.at(change, places + depth, -1)
    covered = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(covered, prepend=False, append=False))
    for a, b in zip(edges[::2], edges[1::2]):
        i = int(np.searchsorted(starts, a, side="right")) - 1
        found[chosen[i]].append((int(a - starts[i]), int(b - starts[i])))
    return found


def covered_segments(groups: dict[int, dict[bytes, int]], length: int) -> dict[bytes, list[tuple[int, int]]]:
    """Covered spans of each distinct segment, by anchor; the numbers are how often each occurs."""
    spans: dict[bytes, list[tuple[int, int]]] = {}
    batch, size = [], 0

    def flush():
        nonlocal batch, size
        if batch:
            for segment, found in zip(batch, repeated_in(batch, length)):
                spans[segment] = [(0, len(segment))] if spans.get(segment) else found
        batch, size = [], 0

    for segments in groups.values():
        for segment, count in segments.items():
            if count > 1:
                spans[segment] = [(0, len(segment))]
        # one segment alone may still repeat itself
        if len(segments) > 1 or any(len(s) > 2 * length for s in segments) or all(c == 1 for c in segments.values()):
            batch += segments
            size += sum(map(len, segments))
            if size >= ARRAY_BYTES:
                flush()
    flush()
    return spans


# ---- the passes


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, often: int = OFTEN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) and kept_sha256."""
    dealt, blocks = in_blocks(docs)
    shards = max(1, blocks // BLOCKS_PER_SHARD)
    suspected = recurring(dealt, blocks, _anchors(length, gram), often)

    def answers(right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate([np.zeros(0, np.uint64), *unpacked(right["values"], np.uint64)])
        hot = np.concatenate([np.zeros(0, bool), *unpacked(right["often"], np.bool_)])
        order = np.argsort(values)
        return values[order], hot[order]

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return table_of(_SENT, [])
        block = left["block"][0].as_py()
        values, hot = answers(right)
        texts = texts_of(placed(left))[1]
        held: dict[int, dict[bytes, int]] = defaultdict(dict)
        windows = [np.zeros((2, 0), np.uint64)]
        for i, _, anchors, first, after in segments_of(texts, length, gram):
            found, at = inside(anchors, values)
            for k in np.flatnonzero(found):
                if hot[at[k]]:
                    part = np.frombuffer(texts[i][first[k] : after[k] + length - 1], np.uint8)
                    windows.append(np.stack([byte_runs(part, length, 21), byte_runs(part, length, 22)]))
                else:
                    own, segment = held[int(anchors[k])], texts[i][first[k] : after[k] + length - 1]
                    own[segment] = own.get(segment, 0) + 1
        keys = np.array([a for a, own in held.items() for _ in own], np.uint64)
        segments = np.empty(len(keys), object)
        segments[:] = [s for own in held.values() for s in own]
        twice = np.array([c > 1 for own in held.values() for c in own.values()], bool)
        rows = [
            (shard, block, "segment", packed(k), b"", packed(t), list(s))
            for shard, k, t, s in by_shard(shards, keys, keys, twice, segments)
        ]
        one, two = np.concatenate(windows, axis=1)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        count = np.diff(np.append(np.flatnonzero(new), len(one)))
        rows += [
            (shard, block, "window", packed(a), packed(b), packed(t), [])
            for shard, a, b, t in by_shard(shards, one[new], one[new], two[new], count > 1)
        ]
        return table_of(_SENT, rows)

    def meet(table: pa.Table) -> pa.Table:
        blocks_of, kinds = table["block"].to_pylist(), table["kind"].to_pylist()
        ones, twos = unpacked(table["one"], np.uint64), unpacked(table["two"], np.uint64)
        twice = unpacked(table["twice"], np.bool_)
        groups: dict[int, dict[bytes, int]] = defaultdict(dict)
        held = {}
        for row, kind in enumerate(kinds):
            if kind == "segment":
                held[row] = table["segments"][row].as_py()
                for anchor, segment, again in zip(ones[row].tolist(), held[row], twice[row].tolist()):
                    groups[anchor][segment] = groups[anchor].get(segment, 0) + 1 + again
        spans = covered_segments(groups, length)
        said = []
        for row, segments in held.items():
            anchor, place, start, end = [], [], [], []
            seen: dict[int, int] = defaultdict(int)
            for key, segment in zip(ones[row].tolist(), segments):
                for a, b in spans.get(segment, ()):
                    anchor.append(key)
                    place.append(seen[key])
                    start.append(a)
                    end.append(b)
                seen[key] += 1
            if anchor:
                columns = np.array(anchor, np.uint64), np.array(place), np.array(start), np.array(end)
                said.append((blocks_of[row], "segment", packed(columns[0]), b"", *map(packed, columns[1:])))
        rows = [row for row, kind in enumerate(kinds) if kind == "window"]
        if rows:
            one, two = np.concatenate([ones[r] for r in rows]), np.concatenate([twos[r] for r in rows])
            order = np.lexsort((two, one))
            new = np.ones(len(one), bool)
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
            group = np.empty(len(one), np.int64)
            group[order] = np.cumsum(new) - 1
            count = np.bincount(group) + np.bincount(group, np.concatenate([twice[r] for r in rows]))
            again, begin = count[group] > 1, 0
            for r in rows:
                part = slice(begin, begin + len(ones[r]))
                if again[part].any():
                    said.append((blocks_of[r], "window", packed(one[part][again[part]]), packed(two[part][again[part]]), b"", b"", b""))
                begin += len(ones[r])
        return table_of(_SAID, said)

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table_of(_RESULT, [])
        ids, texts = texts_of(placed(left))
        spans: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        one, two = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        hot = [np.zeros(0, np.uint64)]
        for row in right.to_pylist():
            if row["kind"] == "segment":
                columns = [np.frombuffer(row["one"], np.uint64)] + [np.frombuffer(row[c], np.int64) for c in ("place", "start", "end")]
                for anchor, place, a, b in zip(*(c.tolist() for c in columns)):
                    spans[anchor, place].append((a, b))
            elif row["kind"] == "window":
                one.append(np.frombuffer(row["one"], np.uint64))
                two.append(np.frombuffer(row["two"], np.uint64))
            else:
                hot.append(np.frombuffer(row["one"], np.uint64))
        one, two, hot = np.concatenate(one), np.concatenate(two), np.sort(np.concatenate(hot))
        pairs = set(zip(one.tolist(), two.tolist()))
        one = np.sort(one)
        covered_anchors = np.array(sorted({a for a, _ in spans}), np.uint64)
        changes = [np.zeros(len(t) + 1, np.int32) for t in texts]
        places: dict[int, dict[bytes, int]] = defaultdict(dict)
        for i, _, anchors, first, after in segments_of(texts, length, gram):
            for k in np.flatnonzero(inside(anchors, covered_anchors)[0]):
                anchor, segment = int(anchors[k]), texts[i][first[k] : after[k] + length - 1]
                place = places[anchor].setdefault(segment, len(places[anchor]))
                for a, b in spans.get((anchor, place), ()):
                    changes[i][first[k] + a] += 1
                    changes[i][first[k] + b] -= 1
            for k in np.flatnonzero(inside(anchors, hot)[0]) if len(one) else ():
                part = np.frombuffer(texts[i][first[k] : after[k] + length - 1], np.uint8)
                a = byte_runs(part, length, 21)
                at = np.flatnonzero(inside(a, one)[0])
                if len(at):
                    b = byte_runs(part, length, 22)
                    at = at[[pair in pairs for pair in zip(a[at].tolist(), b[at].tolist())]]
                    np.add.at(changes[i], first[k] + at, 1)
                    np.add.at(changes[i], first[k] + at + length, -1)
        rows = []
        for doc_id, text, change in zip(ids, texts, changes):
            gone = np.cumsum(change[:-1]) > 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            n_spans = int(np.count_nonzero(np.diff(gone, prepend=False) & gone))
            rows.append((doc_id, len(text), int(gone.sum()), n_spans, kept, hashlib.sha256(kept).hexdigest()))
        return table_of(_RESULT, rows)

    def hot_only(table: pa.Table) -> pa.Table:
        values, hot = answers(table)
        rows = [(table["block"][0].as_py(), "hot", packed(values[hot]), b"", b"", b"", b"")] if hot.any() else []
        return table_of(_SAID, rows)

    blocks_of = dealt.groupBy("block")
    sent = blocks_of.cogroup(suspected.groupBy("block")).applyInArrow(send, _SENT_TYPES)
    said = sent.groupBy("shard").applyInArrow(meet, _SAID_TYPES)
    said = said.unionByName(suspected.groupBy("block").applyInArrow(hot_only, _SAID_TYPES))
    return blocks_of.cogroup(said.groupBy("block")).applyInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )
