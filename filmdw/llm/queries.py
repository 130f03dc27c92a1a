"""Registered queries over the corpus tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from filmdw.llm import (
    chat,
    fingerprint,
    forest,
    langid,
    mixing,
    neardup,
    orc_tokens,
    packing,
    phrases,
    quality,
    repeats,
    signatures,
    spelling,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op2_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_repeats(documents(spark, sf_dir)).drop("kept", "carried")


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table.select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digests(chat.windows(turns))


def op4_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op5_orc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.round_trip(documents(spark, sf_dir))


def op6_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neardup.near_duplicates(documents(spark, sf_dir), shingle=4)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(documents(spark, sf_dir))


def op8_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(documents(spark, sf_dir), labels)


def op9_flow_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").cast("long").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).cast("long").alias("taken"),
    )


def op10_interval_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op11_search_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_bit_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return signatures.rank_documents(documents(spark, sf_dir), items)


def op13_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_subword_langid": op1_subword_langid,
    "op2_phrase_automata": op2_phrase_automata,
    "op3_chat_windows": op3_chat_windows,
    "op4_vector_best_fit": op4_vector_best_fit,
    "op5_orc_ids": op5_orc_ids,
    "op6_tensored_minhash": op6_tensored_minhash,
    "op7_bottom_k": op7_bottom_k,
    "op8_ngram_quality": op8_ngram_quality,
    "op9_flow_mix": op9_flow_mix,
    "op10_interval_tree": op10_interval_tree,
    "op11_search_schemes": op11_search_schemes,
    "op12_bit_slices": op12_bit_slices,
    "op13_prefix_forest": op13_prefix_forest,
}

_MARKS = r"([<\[])(~*)(/?(?:s>|INST\]))"

_OP3 = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(said, '{_MARKS}', '\\1~\\2\\3', 'g') AS escaped,
    6 + length(replace(replace(replace(replace(role, '~', '~0'), chr(10), '~1'), ']', '~2'), '<', '~3')) AS head
  FROM given),
counted AS (
  SELECT *, head + length(escaped) + 5 AS chars,
    CAST(ceil((head + length(escaped) + 5) / {chat.CHARACTERS_PER_TOKEN}.0) AS BIGINT) AS tokens,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, escaped) AS place
  FROM marked),
summed AS (
  SELECT *, sum(tokens) OVER w - tokens AS before,
    2 * sum(CASE WHEN tokens > {chat.BUDGET // 2} THEN 1 ELSE 0 END) OVER w
      - CASE WHEN tokens > {chat.BUDGET // 2} THEN 1 ELSE 0 END AS large
  FROM counted WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
opened AS (
  SELECT *, CASE WHEN (lag(before // {chat.BUDGET // 2}) OVER w, lag(large) OVER w)
      <> (before // {chat.BUDGET // 2}, large) AND place > 1 THEN 1 ELSE 0 END AS opens
  FROM summed WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
spans AS (
  SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY place) AS span,
    sum(opens) OVER (PARTITION BY conv_id) AS final
  FROM opened),
used AS (
  SELECT *, CASE WHEN role = 'system' AND place = 1 THEN final - span
      WHEN span < final AND row_number() OVER (PARTITION BY conv_id, span ORDER BY place DESC) <= {chat.HISTORY}
      THEN 1 ELSE 0 END AS again
  FROM spans),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || said || chr(10), '' ORDER BY place) AS lines,
    coalesce(string_agg(said, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum(chars * (1 + again)) AS BIGINT) AS formatted_chars
  FROM used GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars FROM joined
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP12 = f"""
WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, {_LOWER} AS low FROM documents),
found AS (SELECT row, doc_id, unnest(regexp_extract_all(low, '{_TERM}')) AS term FROM numbered),
counted AS (SELECT row, doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
sized AS (SELECT row, sum(tf) AS n FROM counted GROUP BY row),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS occurrences FROM sized),
items AS (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM items),
weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals WHERE term IN (SELECT term FROM asked) GROUP BY term),
gained AS (
  SELECT item_id, row, doc_id,
    w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * CAST(n AS BIGINT) * docs) // occurrences))) AS gain
  FROM asked JOIN weighed USING (term) JOIN counted USING (term) JOIN sized USING (row), totals),
scored AS (
  SELECT item_id, row, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM gained GROUP BY ALL HAVING sum(gain) > 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {signatures.BEST}
"""

ORACLE_SQL: dict[str, str] = {"op3_chat_windows": _OP3, "op12_bit_slices": _OP12}
