"""Pieces and pretokens in use stay known when a worker's tables turn over."""

import gc
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from filmdw.llm import tokens


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_what_is_in_use_is_not_learned_again(monkeypatch, name):
    monkeypatch.setattr(tokens, "KEPT_CHARACTERS", 400)
    monkeypatch.setattr(tokens, "SLICE_CHARACTERS", 300)
    path = tokens.vocabulary(name)
    encoder = tokens.Encoder(path)
    learned = []
    table = encoder.known_pieces
    learn = table.learn
    table.learn = lambda missing: learned.extend(missing) or learn(missing)
    texts = [f"always used words stay, it's new{i} 12.5\nline {'é' * (i % 3)}\x00 ​  end " * 3 for i in range(80)]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.array_equal(ids, plain.encode(text, add_special_tokens=False).ids)
    used = [p for p in learned if p in ("used", "words")]
    assert sorted(used) == ["used", "words"] and len(table.older.known) > 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_known_strings_take_little_memory(name):
    encoder = tokens.Encoder(tokens.vocabulary(name))
    # words of letters alone, so that pieces and pretokens are the same strings
    words = ["".join(chr(97 + (i // 26**k) % 26) for k in range(8)) for i in range(7, 90_000_000, 3001)]
    texts = [" ".join(words[i : i + 200]) for i in range(0, len(words), 200)]
    list(encoder.encode(texts[:2]))
    gc.collect()
    tracemalloc.start()
    arrow = pa.total_allocated_bytes()
    list(encoder.encode(texts))
    gc.collect()
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    tables = encoder.known_pieces, encoder.known_pretokens
    known = sum(len(generation.known) for t in tables for generation in (t.newer, t.older))
    assert known > 40_000 and held < 90 * known


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_slices_are_even_and_blanks_of_all_kinds_are_told(monkeypatch, name):
    monkeypatch.setattr(tokens, "SLICE_CHARACTERS", 100)
    path = tokens.vocabulary(name)
    encoder, sizes = tokens.Encoder(path), []
    cut = encoder._slice
    monkeypatch.setattr(encoder, "_slice", lambda texts: sizes.append(sum(map(len, texts))) or cut(texts))
    blanks = ["\t", "\x0b", "\x85", "\xa0", " ", " ", "\x1c", "\r\n", "  ", "\n\n"]
    texts = [f" Σ{b}σς é{b}{b}THE ́x{b}" for b in blanks] + ["", " ", "\0 É\0"]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.array_equal(ids, plain.encode(text, add_special_tokens=False).ids)
    sizes.clear()
    list(encoder.encode(["word " * 2] * 21))
    assert sizes == [110, 100]
