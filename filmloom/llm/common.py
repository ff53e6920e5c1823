"""Small helpers that the training-text operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.sources.shared import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whole texts are long: batches of these bytes go between Spark and Python, unless the session says otherwise.
BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"


def small_batches(spark: SparkSession) -> None:
    """Keeps a worker's memory low: where the session has Spark's default for a batch's bytes, it gets fewer.

    The setting is read when a result is computed, so it stays; a session that sets its own keeps that.
    """
    if spark.conf.get(BATCH_KEY, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the named columns; other columns, whatever their names, are left out."""
    small_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def tied(docs: DataFrame) -> DataFrame:
    """doc_id, text and tie, a hash of the text, by which rows of one doc_id are ordered and dealt to several ranges."""
    return texts(docs).withColumn("tie", F.xxhash64("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df, written as Parquet to the shared folder and read back: it cuts the lineage and outlives executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that a task holds few texts in Python at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sized_slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 1 << 20, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, and so many bytes in a column unless one row alone has more."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first = held = 0
        for at, n in enumerate(sizes):
            if at > first and (held + n > most or at - first >= rows):
                yield batch.slice(first, at - first)
                first, held = at, 0
            held += n
        if first < batch.num_rows:
            yield batch.slice(first)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits mixed."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """64-bit polynomial hashes of any stretches of a buffer of bytes, from running sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self._of_byte = rng.integers(0, 1 << 64, 256, np.uint64)
        self._base = int(rng.integers(0, 1 << 62)) * 8 + 5
        self._inverse = pow(self._base, -1, 1 << 64)
        self._powers = self._inverse_powers = np.ones(1, np.uint64)

    def _grown(self, n: int) -> None:
        if len(self._powers) >= n:
            return
        n = 1 << (n - 1).bit_length()
        for name, base in (("_powers", self._base), ("_inverse_powers", self._inverse)):
            steps = np.full(n, base & ((1 << 64) - 1), np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def of(self, data: np.ndarray) -> None:
        """Take a buffer; stretches() then answers for it."""
        self._grown(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._of_byte[data] * self._powers[: len(data)], out=self._sums[1:])

    def stretches(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._inverse_powers[starts]
