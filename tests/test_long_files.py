"""Text files that are longer than what one task reads."""

import pytest
from pyspark.sql import functions as F

from filmloom.sources import readers

MARK = "﻿"
FILES = {
    "closed": "a\r\nb\n\nc d\r\n", "open": "a\nb\r\nlast\r", "mark": MARK + "a\nb\n", "mark_open": MARK + "a\n\r\r\nb", "breaks": "\n\r\n\n", "one": "x", "empty": "",
    "long": "".join(f"line {i}\r\n" if i % 3 else "é\n" for i in range(5000)), "long_mark": MARK + "\n".join(str(i) * 50 for i in range(900)),
}


@pytest.fixture
def files(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


@pytest.mark.parametrize("few", [0, readers.FEW_FILES])
@pytest.mark.parametrize("size", ["300", "128m"])
def test_lines_as_of_the_whole_file(spark, monkeypatch, files, size, few):
    monkeypatch.setattr(readers, "FEW_FILES", few)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        got = sorted((r.file.rsplit("/", 1)[1], r.line_no, r.text) for r in readers.read_srt(spark, files).collect())
        whole = spark.read.text(files, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
        assert got == sorted(tuple(r) for r in readers.split_lines(whole, "file", "value").collect())
        some = readers.read_srt(spark, files).where("file like '%/long' and line_no = 4001").collect()
        assert [r.text for r in some] == ["line 4000"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_task_holds_a_file(spark, files):
    """A long file is read by many tasks, as stretches of it."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        rows = readers.read_srt(spark, f"{files}/long")
        assert rows.groupBy(F.spark_partition_id()).count().count() >= 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
