"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "filmdw", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect.

    Shuffle parallelism is left to adaptive execution: it starts from
    ``spark.sql.shuffle.partitions`` (raise it on a cluster), merges small
    partitions and splits skewed join partitions at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Session settings that hold for what is planned and run inside."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors for tables that cut lineage.

    It is the one named in ``spark.checkpoint.dir``. A temporary folder is
    used only when the session is local; on a cluster such a folder would
    be lost with its machine, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="filmdw-"))
    return context.getCheckpointDir()


def stage_root(spark: SparkSession) -> str:
    """Folder of this application's written tables; others on the same root have their own."""
    return f"{scratch_root(spark)}/filmdw/{spark.sparkContext.applicationId}"


def write_stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Later reads prune columns and push filters as on any parquet table, and
    a lost executor costs a re-read, not a recomputation of the whole plan.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_together(spark: SparkSession, *works: Callable) -> list:
    """Submit independent small jobs at once, so that none leaves the cluster idle."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(works)) as pool:
        started = [pool.submit(inherit(work)) for work in works]
        return [future.result() for future in started]


def drop_stages(spark: SparkSession) -> None:
    """Delete this application's intermediate tables once its results are saved."""
    path = spark._jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
