"""Files with line breaks inside quotes, cut into many ranges."""

import csv
import io
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from filmdw.schemas import RAW_TEXT
from filmdw.plans import queries
from filmdw.session import conf, scratch_root
from filmdw.sources.files import read_csv
from filmdw.sources.quoted_csv import quoted_records, read_quoted_csv

SCHEMA = StructType([StructField(c, StringType()) for c in ("a", "b", "c")])


def quoted(value: str) -> str:
    return '"' + value.replace('"', '""') + '"'


def some_text(rng: random.Random) -> str:
    pieces = ["x", "word", "\n", "\r\n", '"', '""', ",", " ", "é", "漢", "\n\n", '"\n"', "\t"]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))


def write(path, seed: int, rows: int, end: str, long_every: int = 50) -> None:
    rng = random.Random(seed)
    lines = [f'a,"b\n of two lines",c{end}']
    for i in range(rows):
        middle = some_text(rng) * (40 if i % long_every == 0 else 1)
        lines.append(f"{i},{quoted(middle)},{rng.choice(['', 'plain', quoted(some_text(rng))])}{end}")
        if i % 7 == 0:
            lines.append(end)
    path.write_bytes("".join(lines).encode())


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", ["300b", "4k", "1m"])
def test_rows_are_those_of_one_task(spark, tmp_path, end, size):
    for seed in (1, 2, 3):
        write(tmp_path / f"{seed}.csv", seed, 300, end)
    want = []
    for file in tmp_path.iterdir():
        rows = csv.reader(io.StringIO(file.read_bytes().decode(), newline=""))
        want += [tuple(value or None for value in row) for row in list(rows)[1:] if row]
    want.sort(key=repr)
    assert len(want) == 900
    if end == "\n":
        assert rows_of(read_csv(spark, str(tmp_path), SCHEMA, multi_line=True)) == want
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1"}):
        found = read_quoted_csv(spark, str(tmp_path), SCHEMA)
        ranges = spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions()
        assert rows_of(found) == want
    if size != "1m":
        assert ranges > 10


def test_a_record_over_many_ranges(spark, tmp_path):
    body = "".join(f"line {i}\n" for i in range(2000))
    (tmp_path / "one.csv").write_text(f"a,b,c\n1,{quoted(body)},x\n2,y,z\n")
    (tmp_path / "two.csv").write_text('a,b,c\n3,"no end of line, ""quoted"""\n4,,"last\nvalue"')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b,c\n")
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1"}):
        found = rows_of(read_quoted_csv(spark, str(tmp_path), SCHEMA))
    assert found == [("1", body, "x"), ("2", "y", "z"), ("3", 'no end of line, "quoted"', None), ("4", None, "last\nvalue")]


def test_text_is_shuffled_once(spark, tmp_path):
    write(tmp_path / "1.csv", 1, 50, "\n")
    records = quoted_records(spark, str(tmp_path))
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan
    names = read_quoted_csv(spark, str(tmp_path)).columns
    assert names == RAW_TEXT.names and records.select(F.col("value")).count() == 50 + 8


def test_no_task_writes_or_numbers_all_text(spark, tmp_path):
    """Documents of several files are written by as many tasks, and only counts are in one task for a file."""
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit('a "b"\n'), F.col("id"), F.lit("\n,c")).alias("text")
    )
    docs.repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    before = set(Path(scratch_root(spark), "filmdw").glob("quoted-*"))
    with conf(spark, **{"spark.sql.files.openCostInBytes": str(1 << 40)}):
        found = queries.csv_quoted_breaks(spark, str(tmp_path))
    assert rows_of(found.select("doc_id", "source", "text")) == rows_of(docs)
    (folder,) = set(Path(scratch_root(spark), "filmdw").glob("quoted-*")) - before
    assert len(list(folder.glob("part-*.csv"))) == 6

    plan = quoted_records(spark, str(folder))._jdf.queryExecution().optimizedPlan().toString()
    # windows over a whole file: its ranges, and not the pieces with their text
    over_files = re.findall(r"\], \[file#\d+\], \[(\w+)#", plan)
    assert over_files and set(over_files) == {"range"} and not re.search(r"\[file#\d+\], \[range#\d+L? ASC NULLS FIRST, record", plan)
