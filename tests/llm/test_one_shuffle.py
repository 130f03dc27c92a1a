"""Texts are shuffled once when near-duplicates are dropped."""

import re

from filmdw.llm import neardup
from filmdw.session import conf


def test_texts_are_read_and_shuffled_once(spark, tmp_path):
    words = "one two three four five six seven eight nine ten".split()
    text = " ".join(words)
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "b"), (3, "other words " + text[::-1], "c"), (3, None, "c"), (3, None, "c")]
    rows += [(None, "no id " + text.upper()[::-1], "d"), (4, "", None), (5, "", None)]
    spark.createDataFrame(rows, "doc_id long, text string, _row string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        left = neardup.one_of_each(docs)
        plan = left._jdf.queryExecution().executedPlan().toString()
        found = sorted(map(tuple, left.collect()), key=repr)
    assert left.columns == docs.columns
    assert found == sorted(set(rows) - {(2, text, "b")}, key=repr)
    assert len(re.findall(r"FileScan parquet \[[^\]]*text#", plan)) == 1
    # the join on the row's hash and what takes equal rows once share one exchange of the texts
    assert len(re.findall(r"Exchange hashpartitioning\(__row#", plan)) == 2
