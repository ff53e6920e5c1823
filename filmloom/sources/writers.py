"""Writers of exports, and the ledger of what was exported."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.functions.values import strip_unprintable
from filmloom.operators.aggregate import high_water, since

LEDGER = "table_name string, export_type string, path string, row_count long, status string, created_at timestamp"


def reordered(df: DataFrame, first: list[str]) -> DataFrame:
    """The named columns that exist first, the rest after."""
    have = [c for c in first if c in df.columns]
    return df.select(*have, *[c for c in df.columns if c not in have])


def printable(df: DataFrame) -> DataFrame:
    """All text columns without characters that a sink rejects."""
    return df.withColumns({f.name: strip_unprintable(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


def export_path(folder: str, table: str, kind: str, at: datetime.datetime) -> str:
    """A folder per run, named by table, kind and time."""
    return f"{folder.rstrip('/')}/{table}_{kind}_{at:%Y%m%d_%H%M%S}"


def write_csv(df: DataFrame, path: str, mark: bool = False) -> None:
    """A full export; quotes are doubled and line breaks kept, so that it reads back as it was.

    mark: each file begins with a byte-order mark, before the first column's name.
    """
    df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0]) if mark else df
    df.write.csv(path, header=True, escape='"', encoding="UTF-8")


def write_sorted(df: DataFrame, path: str, columns: list[Column | str], order: list[str], rows_per_file: int = 100_000) -> None:
    """A projection in a fixed order: ranges of the order go to files, sorted within."""
    rows = df.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_sheets(sheets: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Several results as named folders under one path."""
    for name, df in sheets.items():
        df.write.format(fmt).option("header", True).save(f"{path}/{name}")


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """A folder per value; rows are spread by value and a salt, so one value's rows don't meet in one task."""
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in by]), F.lit(8))
    df.repartition(*by, salt).write.partitionBy(*by).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path, ignoreNullFields=False)


def write_lines(lines: DataFrame, path: str, file: str, line_no: str, text: str) -> None:
    """Text lines, those of a file in order and together, each after the file's name and a tab; as many files as tasks."""
    rows = lines.repartition(file).sortWithinPartitions(file, line_no)
    rows.select(F.concat(F.col(file).cast("string"), F.lit("\t"), F.coalesce(text, F.lit(""))).alias("value")).write.text(path, lineSep="\n")


def append_ledger(ledger_path: str, df: DataFrame, table: str, kind: str, path: str, at: datetime.datetime) -> None:
    """Write df as Parquet and add a ledger row with its count, observed while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    row = [(table, kind, path, seen.get["n"], "success", at)]
    df.sparkSession.createDataFrame(row, LEDGER).coalesce(1).write.mode("append").parquet(ledger_path)


def incremental(df: DataFrame, ledger: DataFrame, table: str, time: str) -> DataFrame:
    """Rows newer than the table's last successful export."""
    done = (F.col("table_name") == table) & (F.col("status") == "success")
    return since(df, high_water(ledger, done, "created_at"), time)
