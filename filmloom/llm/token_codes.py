"""Token-id files of directly addressable codes.

An id is cut into 8-bit chunks. Level k holds chunk k of every id that has one, a bitmap with a set bit where the id
goes on in the next level, and a rank directory with the set bits before every 512th place. An id at any place is
found by one rank a level, without decoding its neighbours.

A file is Parquet with one row per segment of whole documents; Spark's commit makes a write safe when an executor is
lost. Segments follow ascending doc_id. Defined cases: a null or empty text holds the end id alone; documents without
doc_id come first; repeated doc_ids stay apart, in the order of a hash of their text; an empty table gives files without segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmloom.llm.common import new_path, partitions, slices, table, tied
from filmloom.llm.tokens import default_path, encoder, text_batches

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 18
END_ID = 2
SEGMENTS = (
    "part int, segment int, start long, n_tokens long, doc_ids array<long>, lengths array<long>,"
    " chunks array<binary>, bitmaps array<binary>, ranks array<binary>"
)


def encode_codes(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, bitmaps and rank directories by level. The last level of any id has no set bit."""
    chunks, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint64)
    while True:
        more = rest >> np.uint64(CHUNK_BITS)
        on = more > 0
        bits = np.packbits(on, bitorder="little")
        padded = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        per_block = np.bitwise_count(padded.reshape(-1, RANK_BITS // 8)).sum(axis=1, dtype=np.uint32)
        chunks.append((rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes())
        bitmaps.append(bits.tobytes())
        ranks.append((np.cumsum(per_block, dtype=np.uint32) - per_block).astype("<u4").tobytes())
        if not on.any():
            return chunks, bitmaps, ranks
        rest = more[on]


def token_at(chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], place: int) -> int:
    """The id at one place of a segment."""
    value = 0
    for level, (chunk, bitmap, rank) in enumerate(zip(chunks, bitmaps, ranks, strict=True)):
        value |= chunk[place] << (CHUNK_BITS * level)
        if not bitmap[place >> 3] >> (place & 7) & 1:
            break
        block = place // RANK_BITS
        begin = block * RANK_BITS // 8
        before = int.from_bytes(rank[4 * block : 4 * block + 4], "little")
        before += int.from_bytes(bitmap[begin : place >> 3], "little").bit_count()
        place = before + (bitmap[place >> 3] & ((1 << (place & 7)) - 1)).bit_count()
    return value


def decode_codes(chunks: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    out = np.frombuffer(chunks[0], np.uint8).astype("<u4")
    at = np.arange(len(out))
    for level in range(1, len(chunks)):
        on = np.unpackbits(np.frombuffer(bitmaps[level - 1], np.uint8), count=len(at), bitorder="little").astype(bool)
        at = at[on]
        out[at] |= np.frombuffer(chunks[level], np.uint8).astype("<u4") << np.uint32(CHUNK_BITS * level)
    return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode whole texts and write segments in ascending doc_id order, one folder of files at path."""
    n = partitions(docs.sparkSession)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        part, segment, start = 0, 0, 0
        names: list[pa.Array] = []
        coded: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal segment, start
            lengths, ids = np.concatenate(sizes), np.concatenate(coded)
            row = (part, segment, start, len(ids), pa.concat_arrays(names).to_pylist(), lengths.tolist(), *encode_codes(ids))
            segment, start = segment + 1, start + len(ids)
            names.clear()
            coded.clear()
            sizes.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        held = 0
        for batch in text_batches(batches):
            part = batch.column("part")[0].as_py()
            ids, n = coder.ended(batch.column("text"), end_id)
            ends = np.cumsum(n)
            i = 0
            while i < len(n):
                # whole documents until the segment is full
                before = int(ends[i - 1]) if i else 0
                j = min(len(n), i + 1 + int(np.searchsorted(ends[i:] - before, SEGMENT_TOKENS - held, "left")))
                names.append(batch.column("doc_id").slice(i, j - i))
                coded.append(ids[before : ends[j - 1]])
                sizes.append(n[i:j])
                held += int(ends[j - 1]) - before
                i = j
                if held >= SEGMENT_TOKENS:
                    yield flush()
                    held = 0
        if coded:
            yield flush()

    longs, blobs = pa.list_(pa.int64()), pa.list_(pa.binary())
    schema = pa.schema(
        [("part", pa.int32()), ("segment", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64())]
        + [("doc_ids", longs), ("lengths", longs), ("chunks", blobs), ("bitmaps", blobs), ("ranks", blobs)]
    )
    (
        tied(docs)
        .repartitionByRange(n, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(encode, SEGMENTS)
        .write.option("compression", "uncompressed")
        .option("parquet.block.size", 32 << 20)
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The segments with `base`, the ids before each segment's part. One small row per part is summed up."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # one row for each output partition of the write, so broadcast size is bounded by the partition count
    return segments.join(F.broadcast(parts.select("part", F.coalesce(upto, F.lit(0)).alias("base"))), "part")


def document_digests(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids of each document, decoded from the segments."""
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            ids = memoryview(decode_codes(row["chunks"], row["bitmaps"]).tobytes())
            ends = np.cumsum(np.array(row["lengths"], np.int64))
            starts = ends - row["lengths"]
            crc = [zlib.crc32(ids[4 * i : 4 * j]) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
            first = row["base"] + row["start"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + first), pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                schema=out,
            )

    columns = ["start", "base", "doc_ids", "lengths", "chunks", "bitmaps"]
    return segments.select(*columns).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-codes")
    write_token_files(table(spark, sf_dir, "documents"), path, default_path())
    return document_digests(read_token_files(spark, path))
