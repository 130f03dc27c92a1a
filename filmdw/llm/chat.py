"""Chat formatting into budgeted windows, with turn-aligned spans and a loss mask.

Prefix sums of turn tokens choose the spans: a turn belongs to the half-budget cell in which its
prefix sum starts, and a turn above half a budget is a span of its own, so a span never exceeds
the budget unless a single turn does. Every window after the first repeats the system turn and at
most ``history`` turns before its span; repeated turns carry no loss. They come on top of the budget:
a window holds its span and, beyond that, the tokens of what it repeats.

The template marks a turn as ``<s>[role]`` line feed text ``</s>`` line feed. Inside a text, every
``<s>``, ``</s>``, ``[INST]`` and ``[/INST]`` gets a tilde after its first character, and one that
already has tildes gets one more, so no text can hold a mark and each is read back exactly.

Defined results: a null text or role is empty; equal turn numbers are ordered by role and text;
repeated rows are turns of their own; an empty table gives no windows; extra columns are ignored.
Only DataFrame functions are used. A span is bounded by the budget, and so is what is gathered in
one row; running sums stream over the sorted turns of a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUDGET = 1024
HISTORY = 2
CHARACTERS_PER_TOKEN = 4
END = "</s>\n"
_MARK = r"([<\[])(~*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])~(~*)(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _MARK, "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    role = F.replace(F.replace(role, F.lit("~"), F.lit("~0")), F.lit("\n"), F.lit("~1"))
    return F.replace(F.replace(role, F.lit("]"), F.lit("~2")), F.lit("<"), F.lit("~3"))


def _unescape_role(role: Column) -> Column:
    role = F.replace(F.replace(role, F.lit("~3"), F.lit("<")), F.lit("~2"), F.lit("]"))
    return F.replace(F.replace(role, F.lit("~1"), F.lit("\n")), F.lit("~0"), F.lit("~"))


def _marked(role: Column) -> Column:
    return F.concat(F.lit("<s>["), _escape_role(role), F.lit("]\n"))


def windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    target: str = "assistant",
    system: str = "system",
) -> DataFrame:
    """conv_id, window, formatted, n_repeated (turns at its head that earlier windows hold),
    n_turns, and loss: (start, length) of every target text in ``formatted``."""
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
    )
    rows = rows.withColumn("head", _marked(F.col("role")))
    tokens = F.ceil((F.length("head") + F.length("text") + len(END)) / CHARACTERS_PER_TOKEN)
    rows = rows.withColumn("tokens", tokens.cast("long"))

    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    half = max(1, budget // 2)
    large = (F.col("tokens") > half).cast("long")
    rows = (
        rows.withColumn("place", F.row_number().over(in_order))
        .withColumn("before", F.sum("tokens").over(so_far) - F.col("tokens"))
        .withColumn("large", 2 * F.sum(large).over(so_far) - large)
        .withColumn("cell", F.struct(F.floor(F.col("before") / half), F.col("large")))
        .withColumn("opens", (F.lag("cell").over(in_order) != F.col("cell")).cast("long"))
        .withColumn("window", F.sum(F.coalesce("opens", F.lit(0))).over(so_far))
        .withColumn("last", F.max("window").over(Window.partitionBy("conv_id")))
    )
    at_end = Window.partitionBy("conv_id", "window").orderBy(F.desc("place"))
    rows = rows.withColumn("from_end", F.row_number().over(at_end))

    is_system = (F.col("role") == system) & (F.col("place") == 1)
    after = F.when(F.col("window") < F.col("last"), F.sequence(F.col("window") + 1, F.col("last")))
    again = F.when(is_system, after).otherwise(
        F.when((F.col("from_end") <= history) & (F.col("window") < F.col("last")), F.array(F.col("window") + 1))
    )
    used_in = F.explode(F.concat(F.array("window"), F.coalesce(again, F.array().cast("array<bigint>"))))
    used = rows.withColumn("own", F.col("window")).withColumn("window", used_in)
    parts = used.groupBy("conv_id", "window").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "place",
                    "head",
                    "text",
                    (F.col("own") != F.col("window")).alias("repeated"),
                    ((F.col("own") == F.col("window")) & (F.col("role") == target)).alias("learned"),
                )
            )
        ).alias("parts")
    )
    state = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("loss"),
    )

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["head"])
        length = F.length(part["text"]).cast("long")
        span = F.array(F.struct(start.alias("start"), length.alias("length")))
        return F.struct(
            (start + length + len(END)).alias("at"),
            F.when(part["learned"], F.concat(done["loss"], span)).otherwise(done["loss"]).alias("loss"),
        )

    pieces = F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(END)))
    return parts.select(
        "conv_id",
        "window",
        F.array_join(pieces, "").alias("formatted"),
        F.size(F.filter("parts", lambda p: p["repeated"])).alias("n_repeated"),
        F.size("parts").alias("n_turns"),
        F.aggregate("parts", state, step, lambda done: done["loss"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: conv_id, turns (role and text, each once), loss_text
    and formatted_chars. A conversation is one row here, as a digest of it needs."""
    marked = F.split("formatted", END)
    pieces = F.slice(marked, F.col("n_repeated") + 1, F.greatest(F.size(marked) - 1 - F.col("n_repeated"), F.lit(0)))
    own = F.transform(
        pieces,
        lambda p: F.struct(
            _unescape_role(F.substring_index(F.substr(p, F.lit(5)), "]\n", 1)).alias("role"),
            unescape(F.substr(p, F.instr(p, "]\n") + 2)).alias("text"),
        ),
    )
    learned = F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    parts = formatted.select(
        "conv_id",
        "window",
        own.alias("own"),
        F.array_join(learned, "").alias("learned"),
        F.length("formatted").cast("long").alias("chars"),
    )
    grouped = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "own", "learned"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        F.flatten(F.transform("w", lambda w: w["own"])).alias("turns"),
        F.array_join(F.transform("w", lambda w: w["learned"]), "").alias("loss_text"),
        "formatted_chars",
    )


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows."""
    back = read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )
