"""Warehouse tables, their rebuild, and the run log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from filmdw.fixed_values import FACT_TABLE, STAGING_TABLE
from filmdw.functions.dates import seconds_between
from filmdw.functions.status import batch_status, load_status
from filmdw.operators.aggregates import aggregate_by_genre, aggregate_by_year
from filmdw.operators.delta import delta_load, parse_detail_text, parse_details
from filmdw.operators.dimensions import (
    build_dim_country,
    build_dim_genre,
    build_dim_studio,
    build_dim_time,
)
from filmdw.operators.fact import build_fact
from filmdw.operators.quality import overall_quality, quality_report
from filmdw.operators.ranking import dense_keys
from filmdw.operators.staging import (
    load_once,
    part_source,
    purge_staging,
    split_rejects,
    staging_rows,
)
from filmdw.schemas import RUN_LOG, WAREHOUSE
from filmdw.session import write_stage

LOG_TABLE = "ETL_Log"
REPORT_TABLE = "Quality_Report"
REJECT_TABLE = "Staging_Rejects"
REJECTED_DOCUMENTS = "Document_Rejects"


@dataclass(frozen=True)
class Warehouse:
    """External parquet tables of one database under one folder.

    A rebuilt table is written beside the old one and the table is pointed at
    it afterwards, so readers see the old rows or the new rows, and a build may
    read the table it replaces.
    """

    spark: SparkSession
    root: str
    database: str = "default"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def replace(self, table: str, df: DataFrame) -> int:
        """Full rebuild of a table; returns the rows written."""
        # names of generations sort by the time they were begun
        path = f"{self.root.rstrip('/')}/{table}/{time.time_ns():020d}-{uuid.uuid4().hex}"
        written = Observation()
        df.observe(written, F.count("*").alias("rows")).write.parquet(path)
        if self.exists(table):
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(self.name(table))
        else:
            self.spark.catalog.createTable(self.name(table), path, "parquet")
        return written.get["rows"]

    def generations(self, table: str) -> DataFrame:
        """(generation, complete, current) of a table, oldest first: the folders written for it, whether
        their write ended, and which one the table is pointed at."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/{table}")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        held = files.listStatus(place) if files.exists(place) else []
        details = self.spark.sql(f"DESCRIBE FORMATTED {self.name(table)}") if self.exists(table) else None
        at = details.where("col_name = 'Location'").first()["data_type"] if details is not None else ""
        done = lambda path: files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))
        rows = [
            (s.getPath().getName(), done(s.getPath()), s.getPath().getName() == at.rstrip("/").rsplit("/", 1)[-1])
            for s in held
        ]
        return self.spark.createDataFrame(sorted(rows), "generation string, complete boolean, current boolean")

    def drop_generations(self, table: str, keep: int = 1) -> int:
        """Delete all but the last ``keep`` generations up to the current one; returns how many went.

        Call it when no reader holds an older one. What was begun after the current one, a write that
        goes on or was broken off, stays until a later one is current.
        """
        rows = self.generations(table).collect()
        current = max((r["generation"] for r in rows if r["current"]), default="")
        whole = [r["generation"] for r in rows if r["complete"] and r["generation"] <= current]
        gone = [r["generation"] for r in rows if r["generation"] < current and r["generation"] not in whole[-keep:]]
        for name in gone:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/{table}/{name}")
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        return len(gone)

    def append(self, table: str, df: DataFrame) -> int:
        """Add rows to a table; returns how many."""
        written = Observation()
        rows = df.select(*self.read(table).columns)
        rows.observe(written, F.count("*").alias("rows")).write.insertInto(self.name(table))
        return written.get["rows"]

    def create_schema(self) -> None:
        """Drop the nine tables if they exist and create them empty."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        for table, schema in WAREHOUSE.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            self.replace(table, self.spark.createDataFrame([], schema))

    def tables(self) -> DataFrame:
        """(table_name), in name order."""
        return (
            self.spark.sql(f"SHOW TABLES IN {self.database}")
            .where(~F.col("isTemporary"))
            .select(F.col("tableName").alias("table_name"))
            .orderBy("table_name")
        )

    # Staging

    def stage_full(self, rows: DataFrame) -> int:
        """Replace staging by one full load."""
        return self.replace(STAGING_TABLE, dense_keys(rows, "staging_id"))

    def stage_batch(self, rows: DataFrame) -> int:
        """Append a tagged batch unless its source tag is staged already."""
        fresh = load_once(self.read(STAGING_TABLE), rows)
        return self.append(STAGING_TABLE, self._keyed_after(fresh))

    def _keep_rejects(self, rejects: DataFrame, table: str = REJECT_TABLE) -> int:
        if self.exists(table):
            return self.append(table, rejects)
        return self.replace(table, rejects)

    def load_part(self, cleaned: DataFrame, part: int, as_of: str | None = None) -> str:
        """Load one numbered part at most once; returns the logged status.

        Rows that cannot be staged go to the reject table, the others are loaded.
        """
        source, start = part_source(part), datetime.now(timezone.utc)
        job = f"CSV_Chunk_{part}_to_Staging"
        if not self.read(STAGING_TABLE).where(F.col("source") == source).isEmpty():
            note = f"Chunk {part} already loaded"
            self.log(job, start, datetime.now(timezone.utc), 0, 0, "SKIPPED", note)
            return "SKIPPED"
        rows = write_stage(staging_rows(cleaned, source, as_of, strict_dates=False), "part")
        good, bad = split_rejects(rows)
        loaded, failed = self.stage_batch(good), self._keep_rejects(bad)
        status = "SUCCESS" if failed == 0 else "PARTIAL_SUCCESS"
        self.log(job, start, datetime.now(timezone.utc), loaded, failed, status)
        return status

    def load_delta(self, documents: DataFrame, as_of: str | None = None) -> int:
        """Append detail documents whose id is not staged yet; returns how many.

        Documents are JSON text in a column ``json``. Those that cannot be read go to a table of
        their own and count as failed.
        """
        start = datetime.now(timezone.utc)
        good, bad = parse_detail_text(write_stage(documents.select("json"), "documents"))
        batch = write_stage(parse_details(good, as_of), "delta")
        try:
            failed = self._keep_rejects(bad, REJECTED_DOCUMENTS)
            fresh = self._keyed_after(delta_load(self.read(STAGING_TABLE), batch))
            added = self.append(STAGING_TABLE, fresh)
        except Exception as error:
            self.log("API_Refresh", start, datetime.now(timezone.utc), 0, 0, "FAILED", str(error))
            raise
        status = load_status(added, failed)
        self.log("API_Refresh", start, datetime.now(timezone.utc), added, failed, status)
        return added

    def _keyed_after(
        self, rows: DataFrame, table: str = STAGING_TABLE, key: str = "staging_id"
    ) -> DataFrame:
        """Add a key that continues after the last one of the table, without gaps."""
        last = self.read(table).agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
        return dense_keys(rows, key, last)

    def purge(self) -> int:
        """Keep part loads only; returns the rows that are left."""
        return self.replace(STAGING_TABLE, purge_staging(self.read(STAGING_TABLE)))

    # Run log

    def log(
        self,
        job: str,
        start: datetime,
        end: datetime,
        processed: int,
        failed: int,
        status: str,
        error: str | None = None,
    ) -> None:
        last = self.read(LOG_TABLE).agg(F.coalesce(F.max("log_id"), F.lit(0))).first()[0]
        row = (last + 1, job, start, end, processed, failed, status, error, end)
        self.append(LOG_TABLE, self.spark.createDataFrame([row], RUN_LOG))

    def run(self, job: str, work: Callable[[], int]) -> int:
        """Run one stage and log it; a failure is logged as FAILED and raised."""
        start = datetime.now(timezone.utc)
        try:
            rows = work()
        except Exception as error:
            self.log(job, start, datetime.now(timezone.utc), 0, 0, "FAILED", str(error))
            raise
        self.log(job, start, datetime.now(timezone.utc), rows, 0, "SUCCESS")
        return rows

    # Rebuild

    def load_dimensions(self, as_of: str | None = None) -> int:
        staging = self.read(STAGING_TABLE)
        builders = {
            "Dim_Genre": build_dim_genre,
            "Dim_Time": build_dim_time,
            "Dim_Country": build_dim_country,
            "Dim_Studio": build_dim_studio,
        }
        return sum(self.replace(name, build(staging, as_of)) for name, build in builders.items())

    def load_fact(self, as_of: str | None = None, country_mode: str = "code") -> int:
        dims = [self.read(n) for n in ("Dim_Genre", "Dim_Time", "Dim_Country", "Dim_Studio")]
        fact = build_fact(self.read(STAGING_TABLE), *dims, country_mode=country_mode, as_of=as_of)
        return self.replace(FACT_TABLE, dense_keys(fact, "fact_id"))

    def load_aggregates(self, as_of: str | None = None) -> int:
        fact = self.read(FACT_TABLE)
        by_genre = aggregate_by_genre(fact, self.read("Dim_Genre"), as_of)
        by_year = aggregate_by_year(fact, self.read("Dim_Time"), as_of)
        return self.replace(
            "Agg_Genre_Performance", dense_keys(by_genre, "agg_id")
        ) + self.replace("Agg_Yearly_Trends", dense_keys(by_year, "agg_id"))

    def validate(self, as_of: str | None = None) -> DataFrame:
        """Write the quality report, log the grade, and return the overall row."""
        start = datetime.now(timezone.utc)
        dims = [self.read(n) for n in ("Dim_Genre", "Dim_Time", "Dim_Studio")]
        report = quality_report(self.read(STAGING_TABLE), self.read(FACT_TABLE), *dims, as_of)
        self.replace(REPORT_TABLE, report)
        overall = overall_quality(self.read(REPORT_TABLE))
        row = overall.first()
        self.log(
            "Data_Quality_Validation",
            start,
            datetime.now(timezone.utc),
            row["total_records"],
            row["total_issues"],
            row["job_status"],
            row["error_message"],
        )
        return overall

    def rebuild(self, as_of: str | None = None) -> DataFrame:
        """Dimensions, fact, aggregates, quality, in this order; returns the overall row."""
        self.run("Load_Dimensions", lambda: self.load_dimensions(as_of))
        self.run("Load_Fact", lambda: self.load_fact(as_of))
        self.run("Load_Aggregations", lambda: self.load_aggregates(as_of))
        return self.validate(as_of)


def run_summary(log: DataFrame) -> DataFrame:
    """(job_name, start_time, seconds, rows_processed, rows_failed, outcome) of each run.

    A run that failed or was skipped keeps its status; for the others it follows
    from the rows that failed.
    """
    given = F.col("status").isin("FAILED", "SKIPPED", "SUCCESS_WITH_WARNINGS")
    loaded = batch_status(F.col("rows_failed"))
    return log.select(
        "job_name",
        "start_time",
        seconds_between(F.col("start_time"), F.col("end_time")).alias("seconds"),
        "rows_processed",
        "rows_failed",
        F.when(given, F.col("status")).otherwise(loaded).alias("outcome"),
    )
