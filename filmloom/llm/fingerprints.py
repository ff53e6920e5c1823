"""Document fingerprints by content-defined chunking.

A gear hash runs over the bytes; a chunk ends where it has zeros under a mask. The mask is stricter before the normal
size and looser after it, so that sizes gather around it, and no chunk is shorter or longer than the limits. Chunks
depend on the bytes around their borders alone, so an edit changes only the chunks that it touches. A fingerprint is
the set of chunk digests with the chunks' lengths; the likeness of two is the length that they share, over the
shorter one's whole length (containment).

Defined cases: a null or empty text has an empty fingerprint; two empty fingerprints are alike by 1, an empty and
another by 0; a single document is its own neighbour; documents without doc_id come last in descending order and
repeated doc_ids stand by their text, descending; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmloom.llm.common import RollingHash, mixed, partitions, sized_slices, table, texts

LEAST, NORMAL, MOST = 16, 64, 256
#: Bits that must be zero before and after the normal size.
STRICT, LOOSE = 7, 4
_GEAR = np.random.default_rng(3).integers(0, 1 << 32, 256, np.uint32)
_HASHES = RollingHash(3)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the last 32 bytes' gear numbers, each shifted by its age."""
    out = _GEAR[data]
    age = 1
    while age < 32:
        older = np.zeros_like(out)
        older[age:] = out[:-age] << np.uint32(age)
        out = out + older
        age *= 2
    return out


def chunk_ends(data: np.ndarray) -> np.ndarray:
    n = len(data)
    if n <= LEAST:
        return np.array([n] if n else [], np.int64)
    top = gear_hashes(data)
    loose = np.flatnonzero(top >> np.uint32(32 - LOOSE) == 0) + 1
    strict = loose[top[loose - 1] >> np.uint32(32 - STRICT) == 0]
    # the next strict and the next loose border at or after a place, by one search for all candidate starts
    ends, at = [], 0
    loose_list, strict_list = loose.tolist(), strict.tolist()
    i = k = 0
    while n - at > LEAST:
        low, middle, high = at + LEAST, at + NORMAL, min(at + MOST, n)
        while k < len(strict_list) and strict_list[k] < low:
            k += 1
        if k < len(strict_list) and strict_list[k] < min(middle, n):
            at = strict_list[k]
        else:
            while i < len(loose_list) and loose_list[i] < middle:
                i += 1
            at = loose_list[i] if i < len(loose_list) and loose_list[i] < high else high
        ends.append(at)
    if at < n:
        ends.append(n)
    return np.array(ends, np.int64)


def fingerprint(data: bytes) -> np.ndarray:
    """Sorted distinct chunks, each a digest of 32 bits above a length of 16."""
    buffer = np.frombuffer(data, np.uint8)
    ends = chunk_ends(buffer)
    if not len(ends):
        return np.zeros(0, np.uint64)
    starts = np.concatenate([[0], ends[:-1]])
    _HASHES.of(buffer)
    sizes = (ends - starts).astype(np.uint64)
    digest = mixed(_HASHES.stretches(starts, ends) + sizes) >> np.uint64(32)
    return np.unique(digest << np.uint64(16) | sizes)


def written(chunks: np.ndarray) -> str:
    """12 hexadecimal digits for each chunk: its digest and its length."""
    return chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    size = np.uint64(0xFFFF)
    whole = min(int((one & size).sum()), int((two & size).sum()))
    if not whole:
        return float(len(one) == len(two))
    return int((np.intersect1d(one, two, assume_unique=True) & size).sum()) / whole


def _part(edges: list[int]) -> Column:
    """How many of the falling edges doc_id lies below (all, if it is null): first by every step-th edge, then within a step."""
    step = max(1, math.isqrt(len(edges)))
    array = lambda x: F.array(*[F.lit(y) for y in x]).cast("array<bigint>")
    below = lambda x: F.size(F.filter(x, lambda y: F.coalesce(F.col("doc_id") < y, F.lit(True))))
    first = (below(array(edges[::step])) - 1) * step
    return F.when(first < 0, 0).otherwise(first + below(F.slice(array(edges), F.greatest(first, F.lit(0)) + 1, step)))


def with_next(docs: DataFrame) -> DataFrame:
    """part, doc_id, text and guest, in rising parts and descending doc_id within each.

    Parts are ranges of doc_id. Each ends with a guest, the first row of the part that follows (of the first one,
    after the last), so that a task finds the next document of all its own.
    """
    spark = docs.sparkSession
    rows = texts(docs)
    n = partitions(spark)
    # as many numbers as partitions
    bounds = rows.where("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (10 * n)) if n > 1 else []
    rows = rows.withColumn("part", _part(sorted({int(x) for x in bounds or []}, reverse=True)))
    # of each part the first row's key: a row per part
    keys = rows.groupBy("part").agg(F.max(F.struct("doc_id", "text")).alias("first")).withColumn("at", F.col("part"))
    order, whole = Window.orderBy("part"), Window.partitionBy()
    before = F.coalesce(F.lag("part").over(order), F.max("part").over(whole))
    guests = keys.select(before.alias("part"), "first.doc_id", "first.text", F.lit(True).alias("guest"))
    return rows.select("part", "doc_id", "text", F.lit(False).alias("guest")).union(guests)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and its likeness to that and to the next document's."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in sized_slices(batches):
            rows = []
            for part, doc_id, text, guest in zip(*(batch.column(x).to_pylist() for x in ("part", "doc_id", "text", "guest")), strict=True):
                mine = fingerprint(text.encode())
                if last and last[0] == part:
                    _, name, before, prints = last
                    cut = len(before) // 3
                    edited = (before[: len(before) - cut] + text[:cut]).encode()
                    other = fingerprint(edited)
                    sha = hashlib.sha256(edited).hexdigest()
                    rows.append((name, len(before), sha, written(prints), written(other), likeness(prints, other), likeness(prints, mine)))
                last = None if guest else (part, doc_id, text, mine)
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, types, strict=True)], names=names)

    rows = with_next(docs)
    n = partitions(docs.sparkSession)
    return (
        rows.repartitionByRange(n, "part")
        .sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
        .mapInArrow(run, schema)
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
