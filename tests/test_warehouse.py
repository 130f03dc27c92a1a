"""Files, warehouse tables, rebuild, models and incremental loads on disk."""

import json

import pytest
from pyspark.sql import functions as F

from filmdw.fixed_values import FACT_TABLE, STAGING_TABLE
from filmdw.operators import cleaning, delta, staging
from filmdw.plans.model_tables import build_models
from filmdw.plans.warehouse import LOG_TABLE, REJECT_TABLE, REJECTED_DOCUMENTS, Warehouse, run_summary
from filmdw.schemas import CLEANED, RAW_TEXT, STAGING, WAREHOUSE
from filmdw.session import drop_stages, scratch_root, stage_root, write_stage
from filmdw.sources import files, writers
from filmdw.sources.bindings import raw_from_orders, staging_from_orders, table
from filmdw.streaming.incremental import load_new_files, load_new_ids, read_loaded, rejects_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return write_stage(raw_from_orders(spark, SF), "raw")


@pytest.fixture(scope="module")
def warehouse(spark, raw, tmp_path_factory):
    house = Warehouse(spark, str(tmp_path_factory.mktemp("tables")), "film_test")
    house.create_schema()
    parts = staging.split_dataset(cleaning.clean_movies(raw), ["id"])
    for part in (1, 2, 3, 4):
        rows = parts.where(F.col("chunk_id") == part).drop("chunk_id")
        assert house.load_part(rows, part, "2001-01-01") == "SUCCESS"
    house.rebuild("2001-01-01")
    return house


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_round_trip(spark, tmp_path):
    columns = [f.name for f in RAW_TEXT]
    odd = spark.createDataFrame(
        [("1", 'say "hi", twice', "a\nb"), ("2", "", "None"), ("3", None, "x")],
        "id string, title string, overview string",
    )
    df = odd.select(*[F.col(c) if c in odd.columns else F.lit("1").alias(c) for c in columns])
    writers.write_csv(df, str(tmp_path / "csv"))
    found = {r["id"]: r for r in files.read_csv(spark, str(tmp_path / "csv"), multi_line=True).collect()}
    assert found["1"]["title"] == 'say "hi", twice' and found["1"]["overview"] == "a\nb"
    assert found["2"]["title"] is None and found["2"]["overview"] == "None"


def test_cleaned_csv_types_back(spark, raw, tmp_path):
    rows = cleaning.clean_movies(raw)
    writers.write_csv(rows, str(tmp_path / "cleaned"))
    back = cleaning.typed(files.read_cleaned_csv(spark, str(tmp_path / "cleaned")))
    back = back.select(*[F.col(f.name).cast(f.dataType) for f in CLEANED])
    # empty text is read back as missing and filled again when staged
    empty = {"title": "", "overview": ""}
    assert rows_of(back.na.fill(empty)) == rows_of(rows.select(*back.columns).na.fill(empty))


def test_parts_prune(spark, raw, tmp_path):
    path = str(tmp_path / "parts")
    writers.write_parts(staging.split_dataset(raw, ["id"]), path)
    parts = [files.read_part(spark, path, k) for k in (1, 2, 3, 4)]
    assert sum(p.count() for p in parts) == raw.count()
    plan = parts[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk_id" in plan
    with pytest.raises(ValueError):
        files.read_part(spark, path, 5)


def test_publish_overwrites(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.publish(spark.range(5), path)
    writers.publish(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_documents_from_files(spark, tmp_path):
    (tmp_path / "page1.json").write_text(json.dumps({"page": 1, "results": [{"id": 1}, {"id": 2}]}, indent=1))
    (tmp_path / "page2.json").write_text(json.dumps({"results": [{"id": 3}]}))
    ids = delta.listed_ids(files.read_listing(spark, str(tmp_path)))
    assert sorted(r["movie_id"] for r in ids.collect()) == [1, 2, 3]
    detail = tmp_path / "detail"
    detail.mkdir()
    (detail / "d.json").write_text('{"id": 7, "title": "T", "genres": [{"name": "War"}]}\n')
    row = delta.parse_details(files.read_details(spark, str(detail))).first()
    assert (row["movie_id"], row["genres"]) == (7, "War")
    assert delta.parse_detail_text(files.read_detail_text(spark, str(detail)))[1].count() == 0


def test_schema_and_table_list(warehouse):
    listed = {r["table_name"] for r in warehouse.tables().collect()}
    assert {name.lower() for name in WAREHOUSE} <= listed


def test_parts_load_once(warehouse, raw):
    before = warehouse.read(STAGING_TABLE).count()
    assert before == cleaning.kept(cleaning.typed(raw)).count()
    again = staging.staging_rows(cleaning.clean_movies(raw), staging.part_source(2))
    assert warehouse.stage_batch(again) == 0
    assert warehouse.read(STAGING_TABLE).count() == before
    keys = warehouse.read(STAGING_TABLE).agg(F.countDistinct("staging_id"), F.count("*")).first()
    assert keys[0] == keys[1]


def test_fact_properties(warehouse):
    rows, fact = warehouse.read(STAGING_TABLE), warehouse.read(FACT_TABLE)
    kept = rows.where(
        "exists(split(production_companies, '-'), x -> trim(x) NOT IN ('', 'Unknown'))"
        " AND release_date IS NOT NULL AND budget > 0 AND revenue > 0"
    )
    tokens = kept.agg(F.sum(F.size(F.split("genres", "-")))).first()[0]
    assert fact.count() == tokens
    assert fact.select("fact_id").distinct().count() == tokens
    assert fact.select("movie_id").distinct().count() <= rows.select("movie_id").distinct().count()
    assert fact.where("abs(profit - (revenue - budget)) > 1e-6").count() == 0
    for dim, key, name in (
        ("Dim_Genre", "genre_id", "genre_name"),
        ("Dim_Time", "time_id", "full_date"),
        ("Dim_Country", "country_id", "country_code"),
        ("Dim_Studio", "studio_id", "studio_name"),
    ):
        table_rows = warehouse.read(dim)
        n = table_rows.count()
        assert table_rows.select(key).distinct().count() == n
        assert table_rows.select(name).distinct().count() == n
        assert table_rows.agg(F.max(key)).first()[0] == n
        assert fact.join(table_rows, key, "left_anti").where(F.col(key).isNotNull()).count() == 0


def test_rebuild_gives_the_same_tables(warehouse):
    names = ["Dim_Genre", "Dim_Studio", "Agg_Genre_Performance", "Agg_Yearly_Trends"]
    before = {n: warehouse.read(n).count() for n in names}
    totals = warehouse.read("Agg_Yearly_Trends").agg(F.round(F.sum("total_revenue"), 2)).first()
    overall = warehouse.rebuild("2001-01-01").first()
    assert overall["total_validations"] == 19
    assert before == {n: warehouse.read(n).count() for n in names}
    after = warehouse.read("Agg_Yearly_Trends").agg(F.round(F.sum("total_revenue"), 2)).first()
    assert totals == after


def test_run_log(warehouse):
    def broken():
        raise RuntimeError("no input")

    with pytest.raises(RuntimeError):
        warehouse.run("Broken", broken)
    log = {r["job_name"]: r for r in warehouse.read(LOG_TABLE).collect()}
    assert log["Load_Fact"]["status"] == "SUCCESS" and log["Load_Fact"]["rows_processed"] > 0
    assert (log["Broken"]["status"], log["Broken"]["error_message"]) == ("FAILED", "no input")
    assert "Data_Quality_Validation" in log


def test_models(warehouse):
    results = build_models(warehouse, "2001-01-01")
    assert results.count() == 11
    stg, fact = warehouse.spark.table("stg_movies"), warehouse.read("model_fact_movies")
    assert fact.count() == stg.count()
    assert warehouse.read("model_dim_genre").where("genre_name = 'Unknown'").count() == 0


def test_a_part_is_skipped_the_second_time(warehouse, raw):
    before = warehouse.read(STAGING_TABLE).count()
    assert warehouse.load_part(cleaning.clean_movies(raw), 3) == "SKIPPED"
    assert warehouse.read(STAGING_TABLE).count() == before
    summary = {r["outcome"] for r in run_summary(warehouse.read(LOG_TABLE)).collect()}
    assert {"SUCCESS", "SKIPPED"} <= summary


def test_rejects_are_kept_aside(warehouse, raw, tmp_path):
    house = Warehouse(warehouse.spark, str(tmp_path), "film_rejects")
    house.create_schema()
    rows = cleaning.with_derived(cleaning.typed(raw))
    assert house.load_part(rows, 1) == "PARTIAL_SUCCESS"
    rejected = house.read(REJECT_TABLE)
    assert rejected.count() > 0 and rejected.where("reject_reason = ''").count() == 0
    assert house.read(STAGING_TABLE).count() + rejected.count() == raw.count()


def test_delta_and_purge(spark, warehouse):
    before = warehouse.read(STAGING_TABLE).count()
    texts = [('{"id": 999999999, "title": "new"}',), ('{"id": 9, "ti',), ('{"id": 8, "budget": null}',)]
    documents = spark.createDataFrame(texts, "json string")
    for added, status in ((1, "PARTIAL_SUCCESS"), (0, "FAILED")):
        assert warehouse.load_delta(documents) == added
        last = warehouse.read(LOG_TABLE).orderBy(F.desc("log_id")).first()
        assert (last["rows_processed"], last["rows_failed"], last["status"]) == (added, 2, status)
    assert warehouse.read(REJECTED_DOCUMENTS).count() == 4
    assert warehouse.read(STAGING_TABLE).count() == before + 1
    assert warehouse.purge() == before


def test_full_load_replaces(warehouse, raw):
    rows = staging.staging_rows(cleaning.clean_movies(raw))
    n = warehouse.stage_full(rows)
    assert warehouse.read(STAGING_TABLE).count() == n
    assert warehouse.read(STAGING_TABLE).select("source").distinct().collect()[0][0] == "CSV"


def test_new_files_once(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    checkpoint, log = str(tmp_path / "checkpoint"), str(tmp_path / "log")
    events = table(spark, SF, "events")
    events.where("event_id < 500").coalesce(1).write.mode("append").parquet(landing)
    args = (spark, landing, events.schema, target, checkpoint)
    first = load_new_files(*args, log_path=log)
    assert first == events.where("event_id < 500").count()
    assert load_new_files(*args, log_path=log) == 0
    events.where("event_id >= 500").coalesce(1).write.mode("append").parquet(landing)
    assert load_new_files(*args, log_path=log) == events.where("event_id >= 500").count()
    loaded = read_loaded(spark, target, events.schema)
    assert loaded.exceptAll(events).count() == 0 and loaded.count() == events.count()
    assert sorted(r["rows_processed"] for r in spark.read.parquet(log).collect()) == sorted(
        [first, events.count() - first]
    )


def test_new_ids_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")
    staged = spark.createDataFrame([(1,)], "movie_id bigint")

    def land(name, ids):
        (landing / name).write_text("".join(f'{{"id": {i}, "title": "T{i}"}}\n' for i in ids))
        return load_new_ids(spark, str(landing), target, checkpoint, staged, "2001-01-01")

    assert land("a.json", [1, 2, 2, 3]) == 2
    assert land("b.json", [2, 3, 4]) == 1
    assert land("c.json", [4]) == 0
    ids = sorted(r["movie_id"] for r in read_loaded(spark, target, STAGING).collect())
    assert ids == [2, 3, 4]

    # a lost checkpoint starts its batches anew, but replaces and repeats nothing
    checkpoint = str(tmp_path / "another")
    (landing / "d.json").write_text('{"id": 5, "title": "T5"}\n{"id": 6, "bud\n{"id": 7, "budget": null}\n')
    assert load_new_ids(spark, str(landing), target, checkpoint, staged, "2001-01-01") == 1
    ids = sorted(r["movie_id"] for r in read_loaded(spark, target, STAGING).collect())
    assert ids == [2, 3, 4, 5]
    assert spark.read.schema("json string").parquet(rejects_of(target)).count() == 2


def test_a_batch_reads_no_earlier_batch(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "landing", str(tmp_path / "target"), str(tmp_path / "check")
    landing.mkdir()

    def land(name, lines):
        (landing / name).write_text("".join(f"{line}\n" for line in lines))
        return load_new_ids(spark, str(landing), target, checkpoint, None, "2001-01-01")

    titled = lambda i, title: f'{{"id": {i}, "title": "{title}"}}'
    assert land("a.json", [titled(1, "b"), titled(1, "a"), titled(2, "x"), '{"title": "no id"}']) == 3
    for part in (tmp_path / "target").rglob("*.parquet"):
        part.write_bytes(b"not to be read")
    # ids of documents put aside are not seen, repeats of loaded ids are
    assert land("b.json", [titled(2, "y"), titled(3, "z"), '{"id": 4, "budget": null}']) == 1
    assert land("c.json", [titled(4, "w"), titled(3, "v"), titled(1, "u")]) == 1
    assert land("d.json", []) == 0
    runs = [p for p in (tmp_path / "target").iterdir() if p.name.startswith("run=")]
    assert len(runs) == 1
    later = [str(p) for p in runs[0].iterdir() if p.name != "batch_id=0"]
    rows = spark.read.schema(STAGING).parquet(*later).select("movie_id", "title").collect()
    assert sorted(map(tuple, rows)) == [(3, "z"), (4, "w")]
    state = json.loads(sorted((tmp_path / "check" / "offsets").glob("[0-9]*"))[-1].read_text().split("\n")[1])
    assert "RocksDB" in state["conf"]["spark.sql.streaming.stateStore.providerClass"]


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stages_are_scans(spark):
    df = write_stage(spark.range(10).withColumn("b", F.lit(1)), "x")
    plan = df.where("id > 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_drop_stages(spark):
    write_stage(spark.range(1), "gone")
    drop_stages(spark)
    import os

    other = f"{scratch_root(spark)}/filmdw/another-application"
    os.makedirs(other)
    drop_stages(spark)
    assert not os.path.exists(stage_root(spark)) and os.path.exists(other)


def test_binding_covers_every_order(spark):
    rows = staging_from_orders(spark, SF, ())
    assert rows.count() == table(spark, SF, "orders").count()
