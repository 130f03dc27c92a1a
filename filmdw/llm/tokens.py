"""Token ids of whole texts by the tokenizers library, through a bounded table of known pieces.

Both vocabularies work on pretokens that never reach across certain blanks, so a text is cut at
those blanks and its ids are put together from those of the pieces. Pieces not seen before are cut
into pretokens together, and new pretokens are encoded by the library's model once.
Control strings of a vocabulary are ordinary text here.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: characters of either generation of pieces, and of pretokens, held in the tables of a worker
KEPT_CHARACTERS = 1_000_000
#: characters of text encoded at a time
SLICE_CHARACTERS = 2_500_000
#: pretokens of the byte-level vocabulary; with word ends, the file has its own pattern
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: characters that are blanks to one of the two pattern libraries only
_DOUBTFUL = re.compile("[\x1c-\x1f\x85\u180e\u200b\ufeff]")
#: what Python calls a blank, as Arrow's patterns write it
_BLANK = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
_TWO_BLANKS = f"{_BLANK}{{2}}"
#: pieces after a blank that are cut into other pretokens between others than alone, and first pieces
_UNEVEN = rf"^{_BLANK}|{_BLANK}\z| |^\z"
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_ENCODERS: dict[str, Encoder] = {}


def vocabulary(name: str) -> str:
    """The file of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: visible ones for themselves,
    the others by their order from code point 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


def _strings(values: list[str]) -> pa.Array:
    return pa.array(values, pa.large_string())


class Generation:
    """The ids of strings, end to end."""

    def __init__(self):
        self.known = _strings([])
        self.characters = 0
        self.starts = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def add(self, strings: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, strings])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.pool = np.concatenate([self.pool, ids])
        self.characters += pc.sum(pc.utf8_length(strings)).as_py()

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the ids at these places, end to end; how many of each)."""
        starts = self.starts[at]
        lengths = self.starts[at + 1] - starts
        ends = np.cumsum(lengths)
        index = np.repeat(starts - ends + lengths, lengths)
        index += np.arange(len(index))
        return self.pool[index], lengths


class Table:
    """Ids of strings in two generations: those in use move to the newer one before the older is dropped."""

    def __init__(self, learn):
        self.learn = learn
        self.newer, self.older = Generation(), Generation()

    def places(self, strings: pa.Array) -> np.ndarray:
        """The number of each string in the newer generation."""
        if self.newer.characters > KEPT_CHARACTERS:
            self.newer, self.older = Generation(), self.newer
        n, old = len(self.newer.known), len(self.older.known)
        # known strings come first, so the code of a string says which generation has it
        coded = pa.concat_arrays([self.newer.known, self.older.known, strings]).dictionary_encode()
        distinct, codes = coded.dictionary, coded.indices.to_numpy()
        place = np.arange(len(distinct))
        before = np.full(len(distinct), -1)
        before[codes[n : n + old]] = np.arange(old)
        used = np.zeros(len(distinct), bool)
        used[codes[n + old :]] = True
        used[:n] = False
        held, new = np.flatnonzero(used & (before >= 0)), np.flatnonzero(used & (before < 0))
        if len(held):
            self.newer.add(distinct.take(pa.array(held)), *self.older.take(before[held]))
            place[held] = n + np.arange(len(held))
        if len(new):
            missing = distinct.take(pa.array(new))
            order, ids, lengths = self.learn(missing.to_numpy(zero_copy_only=False).tolist())
            self.newer.add(missing.take(pa.array(order)), ids, lengths)
            place[new[order]] = n + len(held) + np.arange(len(new))
        return place[codes[n + old :]]

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.newer.take(at)


def _matches(strings: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(strings, pattern).to_numpy(zero_copy_only=False)


def _summed(lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the next lengths for each count of them, which may be none."""
    ends = np.cumsum(counts)
    until = np.concatenate([[0], np.cumsum(lengths)])
    return until[ends] - until[ends - counts]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # with word ends, blanks only separate; without, a blank belongs to the piece after it
        self.blanks_matter = not self.tokenizer.model.end_of_word_suffix
        if self.blanks_matter:
            self.pretokens = regex.compile(BYTE_LEVEL).findall
        else:
            pattern = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
            # no piece has a line break: it stands between pieces
            self.pretokens = regex.compile(pattern + r"|\n").findall
        self.points = np.array([ord(c) for c in _byte_names()], "<u4")
        self._clear()

    def _clear(self) -> None:
        """Forget all pieces and pretokens."""
        self.known_pretokens = Table(self._learn_pretokens)
        self.known_pieces = Table(self._learn)

    def _learn(self, missing: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New pieces: an order of them, their ids in that order, and how many each has."""
        if self.blanks_matter:
            strings = [p[1:] if p[:1] == " " else " " + p for p in missing]
        else:
            strings = missing
        together, alone, doubtful = list(range(len(strings))), [], []
        if _DOUBTFUL.search("".join(strings)):
            doubtful = [i for i in together if _DOUBTFUL.search(strings[i])]
            together = sorted(set(together).difference(doubtful))
        if self.blanks_matter:
            uneven = _matches(_strings(missing), _UNEVEN)
            alone = [i for i in together if uneven[i]]
            together = [i for i in together if not uneven[i]]
            found = self.pretokens("".join([strings[i] for i in together]))
            first = np.flatnonzero(pc.starts_with(_strings(found), " ").to_numpy(zero_copy_only=False))
            counts = np.diff(np.append(first, len(found)))
        else:
            # composed and lower-cased as the vocabulary wants it
            normal = self.tokenizer.normalizer.normalize_str
            plain = pc.string_is_ascii(_strings(strings)).to_numpy(zero_copy_only=False)
            together = [i for i in together if plain[i]] + [i for i in together if not plain[i]]
            first = [strings[i] for i in together if plain[i]]
            others = [strings[i] for i in together if not plain[i]]
            parts = ["\n".join(first).lower()] if first else []
            if any("\0" in p for p in others):
                parts += map(normal, others)
            elif others:
                parts.append(normal("\0".join(others)).replace("\0", "\n"))
            together = [i for i in together if plain[i]] + [i for i in together if not plain[i]]
            found = self.pretokens("\n".join([*parts, ""]))
            last = np.flatnonzero(pc.equal(_strings(found), "\n").to_numpy(zero_copy_only=False))
            counts = np.diff(np.concatenate([[-1], last])) - 1
            found = [p for p in found if p != "\n"]
        for i in alone:
            own = self.pretokens(strings[i])
            found += own
            counts = np.append(counts, len(own))
        ids, lengths = self.known_pretokens.take(self.known_pretokens.places(_strings(found)))
        lengths = _summed(lengths, counts[: len(together) + len(alone)])
        whole = [self.tokenizer.encode(strings[i], add_special_tokens=False).ids for i in doubtful]
        ids = np.concatenate([ids, *(np.array(w, np.uint32) for w in whole)])
        lengths = np.append(lengths, [len(w) for w in whole]).astype(np.int64)
        return np.array([*together, *alone, *doubtful], np.int64), ids, lengths

    def _learn_pretokens(self, missing: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if any("\0" in p for p in missing):
            named = [self._named(p) for p in missing]
        else:
            named = self._named("\0".join(missing)).split(self._named("\0"))
        tokenize = self.tokenizer.model.tokenize
        ids, lengths = [], []
        for name in named:
            own = [t.id for t in tokenize(name)]
            ids += own
            lengths.append(len(own))
        return np.arange(len(missing)), np.array(ids, np.uint32), np.array(lengths, np.int64)

    def _named(self, text: str) -> str:
        """Text with a character of the vocabulary for each byte."""
        return self.points[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")

    def _slice(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text. A first piece is marked by a blank, as none stands before it; no other
        piece starts with one."""
        cut, even, uneven = _strings(texts), np.arange(len(texts)), []
        if self.blanks_matter:
            # a blank between two other characters always starts a pretoken; with runs of blanks only those
            runs = _matches(cut, _TWO_BLANKS)
            even, uneven = np.flatnonzero(~runs), np.flatnonzero(runs)
            cut = cut.filter(pa.array(~runs)) if len(uneven) else cut
        else:
            cut = pc.replace_substring(cut, "\n", " ")
        lists = pc.split_pattern(cut, " ")
        pieces = lists.flatten()
        counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        if self.blanks_matter:
            firsts, others, sizes = [" " + texts[i].split(" ", 1)[0] for i in even], [], []
            for i in uneven:
                own = _LONE_BLANK.split(texts[i])
                others += [" " + own[0], *own[1:]]
                sizes.append(len(own))
            at = self.known_pieces.places(pa.concat_arrays([pieces, _strings(firsts + others)]))
            at[np.cumsum(counts) - counts] = at[len(pieces) : len(pieces) + len(firsts)]
            at = np.delete(at, slice(len(pieces), len(pieces) + len(firsts)))
            counts = np.append(counts, sizes).astype(np.int64)
        else:
            at = self.known_pieces.places(pieces)
        ids, lengths = self.known_pieces.take(at)
        ends = np.cumsum(_summed(lengths, counts))
        found = dict(zip([*even.tolist(), *uneven], np.split(ids, ends[:-1])))
        return map(found.get, range(len(texts)))

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        texts = list(texts)
        total = sum(map(len, texts))
        # even slices: what is left over would cost as much as a whole one
        share = total / max(1, round(total / SLICE_CHARACTERS))
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= share:
                yield from self._slice(group)
                group, size = [], 0
        if group:
            yield from self._slice(group)


def encoder(path: str) -> Encoder:
    """One for each vocabulary and worker process, so that pieces stay known from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
