"""Column expressions over whole texts, shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed, return.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
GAP_CHARACTERS = " \t\n\x0b\f\r"


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, or with more underscores before it where a column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(text_or_empty(text), GAP), lambda word: word != "")


def word_count(text: Column) -> Column:
    """Number of words, as long; 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def tail(array: Column, skipped: int) -> Column:
    """The array without its first items."""
    return F.slice(array, F.lit(skipped + 1), F.greatest(F.size(array) - skipped, F.lit(0)))


def head(array: Column, left_out: int) -> Column:
    """The array without its last items."""
    return F.slice(array, F.lit(1), F.greatest(F.size(array) - left_out, F.lit(0)))


def with_five_word_hashes(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add ``out``: a 64-bit hash for each run of five consecutive words, in order.

    Every step is a column of its own, so that no step is evaluated twice.
    """
    kept = df.columns
    one, two, four = f"{out}_1", f"{out}_2", f"{out}_4"
    df = df.withColumn(one, F.transform(words, lambda word: F.xxhash64(word)))
    df = df.withColumn(two, F.zip_with(head(F.col(one), 1), tail(F.col(one), 1), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn(four, F.zip_with(head(F.col(two), 2), tail(F.col(two), 2), lambda a, b: F.xxhash64(a, b)))
    five = F.zip_with(head(F.col(four), 1), tail(F.col(one), 4), lambda a, b: F.xxhash64(a, b))
    return df.withColumn(out, five).select(*kept, out)
