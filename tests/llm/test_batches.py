"""Tasks of the pipeline get whole texts in bounded batches."""

import corpus_pipeline
from filmdw.llm import langid, memory
from filmdw.session import conf

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_batches_of_the_pipeline_are_bounded(spark, tmp_path, monkeypatch):
    before = spark.conf.get(ROWS, None)
    text = "'the words of this text are plain and they are read whole ' || id"
    docs = spark.range(3000).selectExpr("id AS doc_id", f"{text} AS text", "'en' AS lang", "'web' AS source", "0L AS n_chars")
    docs = docs.coalesce(1)
    spark.conf.unset(ROWS)
    try:
        stage = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
        sizes = docs.mapInArrow(
            lambda batches: (b.slice(0, 1).drop_columns(["text", "lang", "source", "n_chars"]) for b in batches), "doc_id long"
        )
        assert stage.count() == 3000 and sizes.count() == 3
        with conf(spark, **{ROWS: "1500"}):
            memory.bounded_batches(spark)
            assert spark.conf.get(ROWS) == "1500"
    finally:
        spark.conf.unset(ROWS) if before is None else spark.conf.set(ROWS, before)


def test_memory_is_given_back():
    memory.give_back()
    assert langid.give_back is memory.give_back
