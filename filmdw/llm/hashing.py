"""Hashes of words and of runs of words, for many texts at a time, in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_BYTE_VALUES = np.random.default_rng(64).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_VALUES[32] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
#: characters of text worked on at a time
SLICE = 1_000_000


def powers(n: int) -> np.ndarray:
    """_STEP ** 0 .. n - 1, modulo 2 ** 64."""
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _STEP)]), dtype=np.uint64)
    return _POWERS[:n]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text); words are separated by the six ASCII blanks."""
    split = [t.split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    if not counts.sum():
        return np.zeros(0, np.uint64), counts
    points = np.frombuffer(b" ".join(w for words in split for w in words) + b" ", np.uint8)
    ends = np.flatnonzero(points == 32) + 1
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    place = np.arange(len(points)) - np.repeat(starts, lengths)
    values = _BYTE_VALUES[points] * powers(int(lengths.max()))[place]
    return mixed(np.add.reduceat(values, starts), 7), counts


def run_hashes(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of k hashes; the last k - 1 places have none."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    n = len(words) - k + 1
    total = np.zeros(n, np.uint64)
    for i, power in enumerate(powers(k)):
        total += words[i : i + n] * power
    return mixed(total, 1000 * salt + k)


def slices(items: Iterable, size) -> Iterator[list]:
    """Lists of items of about SLICE together."""
    group, total = [], 0
    for item in items:
        group.append(item)
        total += size(item)
        if total >= SLICE:
            yield group
            group, total = [], 0
    if group:
        yield group
