"""Each landed file is loaded once; each unseen id is loaded once.

The checkpoint remembers which files were read. A batch that is replayed after
a failure writes the same folder again, so rows are not doubled. The folder
names the checkpoint's query as well as the batch: a new checkpoint starts its
batches at 0 again and must not replace those of an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from filmdw.functions.status import load_status
from filmdw.operators.delta import one_row_per_id, parse_detail_text, parse_details
from filmdw.operators.lookup import keep_unknown
from filmdw.operators.staging import append_sources
from filmdw.schemas import RUN_LOG, STAGING
from filmdw.session import conf, write_stage

#: keeps the ids of a stream on the executors' disks, not in their heaps
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _file_stream(
    spark: SparkSession, path: str, schema: StructType | None, fmt: str, options: dict
) -> DataFrame:
    stream = spark.readStream if schema is None else spark.readStream.schema(schema)
    return stream.format(fmt).options(**options).load(path)


def _run_id(spark: SparkSession) -> str:
    """Id of the running query, which stays with its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _other_runs(spark: SparkSession, target: str) -> list[str]:
    """Folders of the target that streams with other checkpoints wrote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    paths = [status.getPath() for status in files.listStatus(place)]
    own = f"run={_run_id(spark)}"
    return [p.toString() for p in paths if p.getName().startswith("run=") and p.getName() != own]


def _write_batch(rows: DataFrame, target: str, batch_id: int) -> int:
    """Write one batch into its own folder; returns the rows written."""
    run = _run_id(rows.sparkSession)
    written = Observation()
    (
        rows.observe(written, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .parquet(f"{target}/run={run}/batch_id={batch_id}")
    )
    return written.get["rows"]


def _log_batch(
    spark: SparkSession,
    log_path: str,
    job: str,
    start: datetime,
    rows: int,
    batch_id: int,
    failed: int = 0,
) -> None:
    end = datetime.now(timezone.utc)
    row = (batch_id + 1, job, start, end, rows, failed, load_status(rows, failed), None, end)
    log = spark.createDataFrame([row], RUN_LOG)
    path = f"{log_path}/run={_run_id(spark)}/batch_id={batch_id}"
    log.coalesce(1).write.mode("overwrite").parquet(path)


def load_new_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    log_path: str | None = None,
    job: str = "File_Load",
    **options: str,
) -> int:
    """Append the files not read before to ``target``; returns the rows added."""
    added = []

    def load(batch: DataFrame, batch_id: int) -> None:
        start = datetime.now(timezone.utc)
        rows = _write_batch(transform(batch), target, batch_id)
        added.append(rows)
        if log_path:
            _log_batch(batch.sparkSession, log_path, job, start, rows, batch_id)

    stream = _file_stream(spark, landing, schema, fmt, options)
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(added)


def read_loaded(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """Everything a stream has loaded."""
    return spark.read.schema(schema).parquet(target).select(*schema.names)


def _loaded_ids(spark: SparkSession, run: str) -> DataFrame:
    return spark.read.schema(f"{STAGING.toDDL()}, batch_id int").parquet(run).select("movie_id")


def rejects_of(target: str) -> str:
    """Folder of the documents that a load into ``target`` could not read, as JSON text."""
    return f"{target.rstrip('/')}-rejects"


def load_new_ids(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    staged: DataFrame | None = None,
    as_of: str | None = None,
    log_path: str | None = None,
    **options: str,
) -> int:
    """Load detail documents whose id is neither staged nor loaded before.

    The ids seen are the keyed state of the stream, kept with its checkpoint, so a batch reads no batch
    that was loaded before; what it costs follows its own documents. Only what streams with other
    checkpoints wrote to ``target`` is read. A replayed batch starts from the state before it and
    overwrites its own first attempt. Repeats inside a batch are reduced to one row. Documents that
    cannot be read go to ``rejects_of(target)`` and are logged as failed; their ids are not seen.
    """

    def fresh(parsed: DataFrame, ids: DataFrame) -> DataFrame:
        rows = one_row_per_id(parsed)
        rows = rows.join(ids, "movie_id", "left_semi").unionByName(rows.where("movie_id IS NULL"))
        known = [staged.select("movie_id")] if staged is not None else []
        known += [_loaded_ids(spark, path) for path in _other_runs(spark, target)]
        return keep_unknown(rows, append_sources(*known), "movie_id") if known else rows

    added = []

    def load(batch: DataFrame, batch_id: int) -> None:
        start = datetime.now(timezone.utc)
        batch = write_stage(batch, "landed")
        good, bad = parse_detail_text(batch.where("movie_id IS NULL").select("json"))
        failed = _write_batch(bad, rejects_of(target), batch_id)
        parsed = write_stage(parse_details(good, as_of), "parsed")
        new = batch.select("movie_id").where("movie_id IS NOT NULL")
        rows = _write_batch(fresh(parsed, new), target, batch_id)
        added.append(rows)
        if log_path:
            _log_batch(spark, log_path, "Delta_Load", start, rows, batch_id, failed)

    texts = _file_stream(spark, landing, None, "text", options).withColumnRenamed("value", "json")
    # the state holds ids only; a batch carries its documents and, beside them, the ids not seen before
    seen = parse_detail_text(texts)[0].select(F.col("id").alias("movie_id")).where("movie_id IS NOT NULL")
    new_ids = seen.dropDuplicates(["movie_id"])
    stream = texts.withColumn("movie_id", F.lit(None).cast("bigint")).unionByName(
        new_ids.withColumn("json", F.lit(None).cast("string"))
    )
    with conf(spark, **{"spark.sql.streaming.stateStore.providerClass": STATE_STORE}):
        query = (
            stream.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return sum(added)
