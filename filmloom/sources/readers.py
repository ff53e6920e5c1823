"""Readers of what a catalog lands: crawl logs, CSV exports, URL lists, subtitle files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The columns of a crawl log's line, in order.
LOG_COLUMNS = ("timestamp", "spider_name", "request_url", "response_status", "saved_data_fields", "saved_id", "item_count", "elapsed_ms")


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed columns of pipe-separated lines; a line with another number of fields is kept whole in `corrupt`."""
    parts = F.split(F.col(column), r"\|")
    whole = F.size(parts) == len(LOG_COLUMNS)
    at = {name: F.when(whole, F.trim(F.try_element_at(parts, F.lit(i + 1)))) for i, name in enumerate(LOG_COLUMNS)}
    typed: dict[str, Column] = {
        "timestamp": at["timestamp"].try_cast("timestamp"),
        "spider_name": at["spider_name"],
        "request_url": at["request_url"],
        "response_status": at["response_status"].try_cast("int"),
        "saved_data_fields": F.from_json(at["saved_data_fields"], "array<string>"),
        "saved_id": at["saved_id"].try_cast("bigint"),
        "item_count": at["item_count"].try_cast("int"),
        "elapsed_ms": at["elapsed_ms"].try_cast("double"),
    }
    return lines.select(*[c.alias(n) for n, c in typed.items()], F.when(~whole, F.col(column)).alias("corrupt"))


def read_crawl_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_log(spark.read.text(path))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV export with a header; a byte-order mark before the first name does no harm under a given schema."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=True, multiLine=True, escape='"', encoding="UTF-8")


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line, trimmed; of `text -> href` what follows the last arrow; blanks are dropped."""
    line = F.trim(F.element_at(F.split("value", "->"), -1))
    return spark.read.text(path).select(line.alias("url")).where(F.length("url") > 0)


def split_lines(df: DataFrame, file: str, text: str) -> DataFrame:
    """file, line_no from 1, text; a byte-order mark is dropped."""
    rows = df.select(file, F.posexplode(F.split(F.regexp_replace(text, "^﻿", ""), r"\r?\n")).alias("_p", "text"))
    return rows.select(file, (F.col("_p") + 1).alias("line_no"), "text")


#: The stretches of at most so many files go to every task; those of more files are joined by a shuffle.
FEW_FILES = 10_000


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no and text of every line, as split_lines has them of a whole file; no task holds more than a line.

    A task reads a stretch of a file. A line's number is its place in there, after the lines of the stretches before it.
    Whether a file ends with a line break, after which one more line is empty, is told by its size; of a compressed file
    it can't be told, and that line is left out.
    """
    raw = spark.read.text(path, lineSep="\n")
    # the ids stand between the scan and any filter, so that both uses of the rows read the same stretches
    rows = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_i"), "value")
    per = rows.groupBy("file", "_start").agg(F.min("_i").alias("_first"), F.count("*").alias("_n"), F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("_bytes"), F.first("_size").alias("_size"))
    whole, so_far = Window.partitionBy("file"), Window.partitionBy("file").orderBy("_start")
    # a byte-order mark, of three bytes, is none of the first line's
    over = F.sum("_bytes").over(whole) - F.col("_size")
    per = per.select(
        F.col("file").alias("_f"), F.col("_start").alias("_s"), (F.sum("_n").over(so_far) - F.col("_n") - F.col("_first") + 1).alias("_shift"),
        F.sum("_n").over(whole).alias("_last"), over.isin(0, -3).alias("_closed"), over.isin(1, -2).alias("_open"),
    )
    per = F.broadcast(per) if len(raw.inputFiles()) <= FEW_FILES else per
    rows = rows.join(per, (F.col("file") == F.col("_f")) & (F.col("_start") == F.col("_s"))).withColumn("_line", F.col("_i") + F.col("_shift"))
    ends = F.col("_line") == F.col("_last")
    text = F.when(ends & F.col("_open"), F.col("value")).otherwise(F.regexp_replace("value", r"\r\z", ""))
    texts = F.when(ends & F.col("_closed"), F.array(text, F.lit(""))).otherwise(F.array(text))
    rows = rows.select("file", "_line", F.posexplode(texts).alias("_p", "text")).select("file", (F.col("_line") + F.col("_p")).alias("line_no"), "text")
    # an empty file is one empty line
    empty = spark.read.format("binaryFile").load(path).where("length = 0").select(F.col("_metadata.file_path"), F.lit(1).cast("long"), F.lit(""))
    return rows.union(empty)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file and text of lines as write_lines leaves them."""
    rows = spark.read.text(path, lineSep="\n")
    return rows.select(F.substring_index("value", "\t", 1).alias("file"), F.expr("substr(value, instr(value, '\t') + 1)").alias("text"))


def latest_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """family and path of the newest file of each family; a family is the pattern's first group in a file's path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime")
    rows = files.select(F.regexp_extract("path", pattern, 1).alias("family"), "path", "modificationTime").where("family <> ''")
    return rows.groupBy("family").agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
