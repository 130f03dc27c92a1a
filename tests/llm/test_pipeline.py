"""The corpus pipeline, stage by stage, on awkward rows and on the smallest table."""

import corpus_pipeline
import __spark_entry__ as contract
from filmdw.session import write_stage
from tests.llm import brute
from tests.llm.test_operators import check_packing, encoded

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        after = write_stage(stage(spark, docs, SF), f"test-{name}")
        yield name, docs, after
        docs = after


def test_stages_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, before, after in stages(spark, docs):
        rows = [(r["doc_id"], r["text"]) for r in before.collect()]
        if name != "pack_sequences":
            assert after.columns == docs.columns
            found = [(r["doc_id"], r["text"]) for r in after.collect()]
        if name == "identify_language":
            assert set(found) <= set(rows) and len(found) > 0.97 * len(rows)
        if name == "drop_near_duplicates":
            assert {d for d, _ in found} == {k[0] for k in brute.near_rows(rows, k=5) if k[3]}
        if name == "drop_repeated_passages":
            expected = {k[0]: k for k in brute.phrase_rows(rows)}
            for d, t in found:
                assert len(brute.words(t)) == expected[d][1] - expected[d][2]
            assert {d for d, k in expected.items() if k[2] < k[1]} <= {d for d, _ in found}
        if name == "mix_sources":
            assert set(found) <= set(rows) and max(found.count(x) for x in set(found)) <= 3
        if name == "pack_sequences":
            check_packing(after.collect(), encoded(rows, "byte_bpe_50k.json", 0))


def test_awkward_and_empty_tables_pass(spark):
    for docs in (brute.awkward(spark), brute.empty(spark)):
        for name, _, after in stages(spark, docs):
            assert name == "pack_sequences" or after.columns == docs.columns
    assert after.count() == 0


def test_registered(spark):
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
