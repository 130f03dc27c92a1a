"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its words' character n-grams (a word between ``<`` and
``>``, n from 2 to 5, hashed), followed by a linear softmax. Both are trained in numpy by stochastic
gradient descent with averaged gradients per minibatch. As average and softmax are linear, the
trained table is folded into one row of class scores per bucket, and a prediction is a sum of rows.

Probabilities are calibrated by a temperature fitted on held-back segments, so a score says how often
such a prediction is right. A document is rejected when that is less often than ``REJECT_BELOW``.

The model is fitted on a bounded sample: at most ``PER_LANGUAGE`` rows of a language, in a seeded
order, and ``SEGMENTS`` segments of ``SEGMENT_WORDS`` words from each, taken anywhere in the text.
Predictions read every word of every text.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; without
any labelled row every text is ``und``; a null label is not learned from; repeated rows and equal ids
are predicted each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from filmdw.llm.memory import give_back
from filmdw.llm.words import free_name

PER_LANGUAGE = 600
SEGMENTS = 3
SEGMENT_WORDS = 40
MOST_LANGUAGES = 500
BUCKETS = 1 << 16
DIMENSIONS = 16
EPOCHS = 6
#: a small sample is gone through more often, until so many steps are done
LEAST_STEPS = 1000
RATE = 2.0
REJECT_BELOW = 0.5
SEED = 11
UNDETERMINED = "und"
#: words whose scores a worker keeps before it starts anew
KEPT_WORDS = 200_000
SLICE_CHARACTERS = 1_000_000
#: characters of new words that are hashed at a time, which bounds the arrays over their n-grams
LEARNED_CHARACTERS = 50_000

_WORD = re.compile(r"[^\W\d_]+")
_LENGTHS = (2, 3, 4, 5)


def subwords(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram of every word, n-grams per word), hashed without a loop over n-grams."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(len(points))
    owner = np.repeat(np.arange(len(words)), sizes)
    mixed, owners, value = [], [], np.zeros(len(points), np.uint64)
    for n in range(1, max(_LENGTHS) + 1):
        shifted = np.zeros_like(points)
        shifted[: len(points) - n + 1] = points[n - 1 :]
        value = (value ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        if n in _LENGTHS:
            inside = room >= n
            mixed.append(value[inside])
            owners.append(owner[inside])
    grams, owners = np.concatenate(mixed), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (grams[order] % np.uint64(buckets)).astype(np.int64), np.bincount(owners, minlength=len(words))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embeddings folded into the softmax weights
    bias: np.ndarray
    temperature: float
    least_score: float


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def train(
    segments: list[str],
    labels: list[str],
    buckets: int = BUCKETS,
    dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS,
    rate: float = RATE,
    reject_below: float = REJECT_BELOW,
    seed: int = SEED,
    batch: int = 32,
) -> Model | None:
    """Fit on four fifths of the segments, calibrate on the rest."""
    found = [(s, _WORD.findall(s.lower()), y) for s, y in zip(segments, labels)]
    found = [(words, y) for _, words, y in found if words]
    if not found:
        return None
    languages = sorted({y for _, y in found})
    grams = [subwords(words, buckets)[0] for words, _ in found]
    target = np.array([languages.index(y) for _, y in found])
    random = np.random.default_rng(seed)
    order = random.permutation(len(grams))
    held = order[: len(order) // 5] if len(order) >= 5 else order
    fitted = order[len(order) // 5 :] if len(order) >= 5 else order
    embeddings = random.uniform(-1, 1, (buckets, dimensions)) / dimensions
    weights, bias = np.zeros((dimensions, len(languages))), np.zeros(len(languages))

    def averages(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat = np.concatenate([grams[i] for i in chosen])
        sizes = np.array([len(grams[i]) for i in chosen])
        sums = np.add.reduceat(embeddings[flat], np.cumsum(sizes) - sizes, axis=0)
        return sums / sizes[:, None], flat, sizes

    epochs = max(epochs, -(-LEAST_STEPS // -(-len(fitted) // batch)))
    steps, done = epochs * -(-len(fitted) // batch), 0
    for _ in range(epochs):
        shuffled = random.permutation(fitted)
        for first in range(0, len(shuffled), batch):
            chosen = shuffled[first : first + batch]
            hidden, flat, sizes = averages(chosen)
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            error /= len(chosen)
            step = rate * (1 - done / steps)
            back = (error @ weights.T) / sizes[:, None]
            weights -= step * hidden.T @ error
            bias -= step * error.sum(axis=0)
            np.subtract.at(embeddings, flat, step * len(chosen) * np.repeat(back, sizes, axis=0))
            done += 1
    scores = averages(held)[0] @ weights + bias
    losses = []
    temperatures = np.geomspace(0.05, 5, 60)
    for temperature in temperatures:
        right = _softmax(scores / temperature)[np.arange(len(held)), target[held]]
        losses.append(-np.log(np.maximum(right, 1e-12)).mean())
    temperature = float(temperatures[int(np.argmin(losses))])
    return Model(
        languages,
        (embeddings @ weights).astype(np.float32),
        bias.astype(np.float32),
        temperature,
        reject_below,
    )


def sample(docs: DataFrame, learned_from: Column, per_language: int = PER_LANGUAGE, seed: int = SEED) -> DataFrame:
    """lang and segments of a bounded sample: the first rows of each language in a seeded order.

    The order is cut by the count of the language first, so that no task sorts a whole language.
    """
    rows = docs.where(learned_from & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 1) / F.lit(2.0**63)
    rows = rows.select("lang", "text", order.alias("_order"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    few = [F.lit(False)]
    for row in counts:
        share = min(1.0, (2 * per_language + 20) / row["n"])
        few.append((F.col("lang") == row["lang"]) & (F.col("_order") <= share))
    chosen = few[0]
    for one in few[1:]:
        chosen = chosen | one
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_order"))
    words = F.split(F.trim("text"), r"\s+")
    segments = F.transform(
        F.sequence(F.lit(0), F.lit(SEGMENTS - 1)),
        lambda i: F.array_join(
            F.slice(
                words,
                F.pmod(F.xxhash64(F.lit(seed), "text", i), F.greatest(F.size(words) - SEGMENT_WORDS + 1, F.lit(1)))
                .cast("int")
                + 1,
                SEGMENT_WORDS,
            ),
            " ",
        ),
    )
    # cut before the order by language, so that only segments are moved
    cut = rows.where(chosen).select("lang", "_order", F.array_distinct(segments).alias("segments"))
    return cut.withColumn("_place", place).where(F.col("_place") <= per_language).select("lang", "segments", "_order")


def fit(docs: DataFrame, learned_from: Column | None = None, **options) -> Model | None:
    learned_from = F.lit(True) if learned_from is None else learned_from
    rows = sample(docs, learned_from).collect()
    rows.sort(key=lambda r: (r["lang"], r["_order"]))
    pairs = [(s, r["lang"]) for r in rows for s in r["segments"]]
    return train([s for s, _ in pairs], [y for _, y in pairs], **options)


class _Scorer:
    """Class scores of texts from those of their words, which are computed once per word."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, len(self.model.languages) + 1), np.float32)

    def _learn(self, words: list[str]) -> None:
        part, characters = [], 0
        for word in words:
            part.append(word)
            characters += len(word)
            if characters >= LEARNED_CHARACTERS:
                self._learn_part(part)
                part, characters = [], 0
        if part:
            self._learn_part(part)

    def _learn_part(self, words: list[str]) -> None:
        grams, sizes = subwords(words, len(self.model.table))
        n = len(self.known)
        while n + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        sums = np.add.reduceat(self.model.table[grams], np.cumsum(sizes) - sizes, axis=0)
        self.rows[n : n + len(words), :-1] = sums
        self.rows[n : n + len(words), -1] = sizes
        self.known.update(zip(words, range(n, n + len(words))))

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(class with the highest score, calibrated score), -1 and 0 without a letter."""
        if len(self.known) > KEPT_WORDS:
            self._clear()
        words, counts = [], []
        for text in texts:
            own = _WORD.findall(text.lower())
            words += own
            counts.append(len(own))
        best, top = np.full(len(texts), -1), np.zeros(len(texts))
        if not words:
            return best, top
        places = list(map(self.known.get, words))
        if None in places:
            self._learn(list(dict.fromkeys(w for w, at in zip(words, places) if at is None)))
            places = list(map(self.known.get, words))
        counts = np.array(counts)
        some = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[some]
        sums = np.add.reduceat(self.rows[np.array(places)].astype(np.float64), starts, axis=0)
        chances = _softmax((sums[:, :-1] / sums[:, -1:] + self.model.bias) / self.model.temperature)
        best[some], top[some] = chances.argmax(axis=1), chances.max(axis=1)
        return best, top


def predict(docs: DataFrame, model: Model | None, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns ``keep`` of ``docs``, with lang_pred, score and rejected, named with ``prefix``."""
    spark = docs.sparkSession
    # bounded: buckets x languages numbers
    shared = spark.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = _Scorer(model) if model else None
        for batch in batches:
            texts = batch.column(at)
            best, top = np.full(len(texts), -1), np.zeros(len(texts))
            first, group, size = 0, [], 0
            for i, text in enumerate(texts):
                group.append(text.as_py() or "")
                size += len(group[-1])
                if scorer and (size >= SLICE_CHARACTERS or i + 1 == len(texts)):
                    best[first : i + 1], top[first : i + 1] = scorer.scores(group)
                    first, group, size = i + 1, [], 0
            names = [model.languages[b] if b >= 0 else UNDETERMINED for b in best]
            rejected = [b < 0 or t < model.least_score for b, t in zip(best, top)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(names, pa.string()), pa.array(top), pa.array(rejected, pa.bool_())],
                [*keep, *names_out],
            )
        give_back()

    names_out = [f"{prefix}{n}" for n in ("lang_pred", "score", "rejected")]
    # a text that is kept is not sent twice
    at = keep.index("text") if "text" in keep else len(keep)
    rows = docs.select(*keep) if "text" in keep else docs.select(*keep, F.col("text").alias("_read"))
    kinds = ", ".join(f"`{n}` {kind}" for n, kind in zip(names_out, ("string", "double", "boolean")))
    return rows.mapInArrow(run, f"{out}, {kinds}")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected; a quarter of the ids is never learned from."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = fit(docs, ~held_out)
    rows = predict(docs, model, ["doc_id"])
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, whose language is told with enough confidence."""
    rejected = free_name(docs.columns, "_language_rejected")
    rows = predict(docs, fit(docs), docs.columns, rejected.removesuffix("rejected"))
    return rows.where(~F.col(rejected)).select(*docs.columns)
