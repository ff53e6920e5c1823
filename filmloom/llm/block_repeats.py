"""Removal of repeated passages of words: every word that lies in a window of `length` words which stands twice or more.

1. Texts are packed to about PACK bytes, compressed and stored under a number, so that later steps can answer a pack.
2. Fixed blocks: each document is cut into blocks of (length + 1) // 2 words from its first word on. A window holds
   exactly one or two whole blocks of its own document, so of two equal windows each holds a reference block that the
   other one meets at some place. The blocks are the index; the hash of every rolling stretch of a block's length is a
   probe. Both are reduced to distinct ones in a pack and dealt to buckets by their hash, so a passage that all
   documents share is one entry a pack. In a bucket the index comes first and is all that a task holds; probes pass by.
3. A pack learns which of its stretches are hits: reference blocks somewhere, and met in another place. A hit's
   extension by up to length - block words to either side are the windows that hold it. Windows whose own block is a
   hit are dealt to buckets by 128-bit hashes; those that stand in two places are repeats. Windows in a row join to the
   maximal exact repeats, and the union of these is removed.

What is equal is decided by hashes of whole windows: 64 bits within a bucket, and the bucket from 32 bits of a second hash.
The filter before that keeps 32 bits within a bucket; a collision there only lets a window through to be compared.
Places never travel, nor do pairs: a group of copies costs its windows once for each pack.

Defined cases: a null or empty text has no words; a text with fewer than `length` words keeps all; ids play no part, so
rows without one or with equal ones are documents as others are; equal rows repeat each other's windows; an empty
table gives no row. A document of many packs' size is one pack, so its words must fit a worker.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import RollingHash, mixed, partitions, sized_slices, slices, small_batches, stored, table

PACK = 1 << 21
#: Buckets for each shuffle partition, so that they spread evenly.
SPREAD = 4
#: New windows that a task gathers before they are sorted into those it knows.
FOLD = 1 << 18
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOW = np.uint64(0xFFFFFFFF)
_ANSWERS = "pack long, bucket int, keys binary"


def word_bounds(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of bytes that `inside` marks, by byte value."""
    marks = np.zeros(len(data) + 2, bool)
    marks[1:-1] = inside[data]
    edges = np.flatnonzero(marks[1:] != marks[:-1])
    return edges[::2], edges[1::2]


def grams(words: np.ndarray, n: int, base: int = _BASES[0]) -> np.ndarray:
    """Hashes of all stretches of n words, by where they start."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = h * np.uint64(base) + words[i : i + m]
    return mixed(h)


class _Pack:
    """The words of a pack: their hashes, their place in the document, and how many follow from there on."""

    def __init__(self, texts: list[bytes], hashes: RollingHash):
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        begin, end = word_bounds(data, ~_SPACE)
        hashes.of(data)
        self.words = mixed(hashes.stretches(begin, end) + (end - begin).astype(np.uint64))
        ends = np.cumsum([len(x) + 1 for x in texts])
        owner = np.searchsorted(ends, begin, "right")
        self.counts = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(self.counts) - self.counts
        self.place = np.arange(len(begin)) - first[owner]
        self.left = self.counts[owner] - self.place

    def windows(self, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each window: its bucket, its key in there, and whether it lies in one document."""
        n = max(0, len(self.words) - length + 1)
        bucket = (grams(self.words, length, _BASES[0]) >> np.uint64(32)) % np.uint64(buckets)
        return bucket, grams(self.words, length, _BASES[1]), self.left[:n] >= length


def _expanded(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """The place of a row and its pack's texts."""
    expand = zstandard.ZstdDecompressor().decompress
    for i in range(batch.num_rows):
        data = expand(batch.column("data")[i].as_py())
        ends = np.cumsum([0, *batch.column("sizes")[i].as_py()]).tolist()
        yield i, [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def packed(docs: DataFrame, *more: str) -> DataFrame:
    """pack, data, sizes and docs (the columns doc_id and more of each document), stored."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    names = ["doc_id", *more]
    schema = rows.select(F.array(F.struct(*names)).alias("docs")).withColumn("data", F.lit(None).cast("binary")).withColumn("sizes", F.lit(None).cast("array<int>")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in sized_slices(batches, most=PACK, rows=1 << 16):
            texts = [x.encode() for x in batch.column("text").to_pylist()]
            of = pa.StructArray.from_arrays([batch.column(x) for x in names], names=names)
            one = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), of)
            sizes = pa.array([[len(x) for x in texts]], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([one, pa.array([squeeze(b"".join(texts))], pa.binary()), sizes], names=["docs", "data", "sizes"])

    return stored(rows.mapInArrow(run, schema).withColumn("pack", F.monotonically_increasing_id()), "packs", "uncompressed")


def _rows(found: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)


def runs(x: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    edges = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)] if len(x) else []
    return list(zip(edges[:-1], edges[1:], strict=True))


def _dealt(bucket: np.ndarray, key: np.ndarray, kind: str) -> Iterator[tuple[int, bytes]]:
    """The distinct keys of each bucket, sorted."""
    order = np.lexsort((key, bucket))
    bucket, key = bucket[order], key[order].astype(kind)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])
    bucket, key = bucket[new].astype(np.int64), key[new]
    for i, j in runs(bucket):
        yield int(bucket[i]), key[i:j].tobytes()


def squeezed(keys: bytes) -> bytes:
    """Sorted 32-bit keys as their differences, the bytes of equal weight together, compressed."""
    steps = np.frombuffer(keys, "<u4").copy()
    steps[1:] -= steps[:-1].copy()
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def expanded(data: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(steps.T).view("<u4").reshape(-1), dtype=np.uint32)


def _blocks_and_probes(packs: DataFrame, block: int, buckets: int) -> DataFrame:
    """bucket, kind (0: reference blocks, 1: probes), pack, keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RollingHash(31)
        for batch in slices(batches, 8):
            for i, texts in _expanded(batch):
                pack = _Pack(texts, hashes)
                h = grams(pack.words, block)
                whole = pack.left[: len(h)] >= block
                bucket, key = (h >> np.uint64(32)) % np.uint64(buckets), h & _LOW
                of = batch.column("pack")[i].as_py()
                found = []
                for kind, take in ((0, whole & (pack.place[: len(h)] % block == 0)), (1, whole)):
                    found += [(b, kind, of, squeezed(keys)) for b, keys in _dealt(bucket[take], key[take], "<u4")]
                yield _rows(found, ["bucket", "kind", "pack", "keys"], [pa.int32(), pa.int8(), pa.int64(), pa.binary()])

    return packs.select("pack", "data", "sizes").mapInArrow(run, "bucket int, kind byte, pack long, keys binary")


class _Index:
    """The reference blocks of a bucket, by key: the pack that has it, and whether others have it too."""

    def __init__(self, parts: list[tuple[np.ndarray, int]]):
        key = np.concatenate([x for x, _ in parts] or [np.zeros(0, "<u4")])
        pack = np.repeat([p for _, p in parts], [len(x) for x, _ in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        key, pack = key[order], pack[order]
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        self.key, self.pack = key[new], pack[new]
        self.shared = np.diff(np.append(np.flatnonzero(new), len(key))) > 1
        self.met = np.zeros(len(self.key), bool)

    def probe(self, keys: np.ndarray, pack: int) -> np.ndarray:
        """The keys that another pack has as a block; blocks that are met are marked."""
        if not len(self.key):
            return keys[:0]
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        found = self.key[at] == keys
        other = found & (self.pack[at] != pack)
        self.met[at[other]] = True
        return keys[other | (found & self.shared[at])]

    def owners(self) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks of one pack alone that others met: the pack is told as well."""
        mine = self.met & ~self.shared
        key, pack = self.key[mine], self.pack[mine]
        for p in np.unique(pack).tolist():
            yield p, key[pack == p]


def _hits(dealt: DataFrame, buckets: int) -> DataFrame:
    """pack, bucket, keys of the stretches that are a reference block and stand in another pack too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, index, found = None, [], None, []

        def close() -> None:
            if index:
                found.extend((p, now, keys.tobytes()) for p, keys in index.owners())

        for batch in slices(batches, 1024):
            for bucket, kind, pack, data in zip(*(batch.column(x).to_pylist() for x in ("bucket", "kind", "pack", "keys")), strict=True):
                if bucket != now:
                    close()
                    now, blocks, index = bucket, [], None
                keys = expanded(data)
                if kind == 0:
                    blocks.append((keys, pack))
                    continue
                index = index or _Index(blocks)
                if len(hit := index.probe(keys, pack)):
                    found.append((pack, bucket, hit.tobytes()))
            yield _rows(found, ["pack", "bucket", "keys"], [pa.int64(), pa.int32(), pa.binary()])
            found = []
        close()
        yield _rows(found, ["pack", "bucket", "keys"], [pa.int64(), pa.int32(), pa.binary()])

    n = partitions(dealt.sparkSession)
    return dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(run, _ANSWERS)


def _told(packs: DataFrame, answers: DataFrame, *columns: str) -> DataFrame:
    """The packs with the keys that they are told, none where nothing is."""
    per = answers.groupBy("pack").agg(F.collect_list(F.struct("bucket", "keys")).alias("told")).withColumnRenamed("pack", "of")
    return packs.join(per, F.col("pack") == F.col("of"), "left").select(*columns, "told")


def _named(told: list[dict] | None, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and keys that a pack is told."""
    keys = [np.frombuffer(x["keys"], kind) for x in told or []]
    bucket = np.repeat(np.array([x["bucket"] for x in told or []], np.uint64), [len(x) for x in keys])
    return bucket, np.concatenate([*keys, np.zeros(0, kind)]).astype(np.uint64)


def _twice(codes: np.ndarray) -> np.ndarray:
    """Which values stand more than once."""
    _, back, n = np.unique(codes, return_inverse=True, return_counts=True)
    return n[back] > 1


def _candidates(told: DataFrame, length: int, block: int, buckets: int) -> DataFrame:
    """bucket, pack, keys: the windows around hits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RollingHash(31)
        for batch in slices(batches, 8):
            for i, texts in _expanded(batch):
                pack = _Pack(texts, hashes)
                h = grams(pack.words, block)
                code = ((h >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (h & _LOW)
                b, k = _named(batch.column("told")[i].as_py(), "<u4")
                # hits: told by others, or met again in this pack
                hit = np.isin(code, b << np.uint64(32) | k)
                whole = np.flatnonzero(pack.left[: len(h)] >= block)
                hit[whole] |= _twice(code[whole])
                bucket, key, inside = pack.windows(length, buckets)
                at = np.flatnonzero(inside)
                own = at + (-pack.place[at]) % block
                at = at[hit[own]]
                found = [(x, batch.column("pack")[i].as_py(), keys) for x, keys in _dealt(bucket[at], key[at], "<u8")]
                yield _rows(found, ["bucket", "pack", "keys"], [pa.int32(), pa.int64(), pa.binary()])

    return told.mapInArrow(run, "bucket int, pack long, keys binary")


class _Known:
    """The windows of a bucket so far, each with the first pack that has it and whether that pack was told."""

    def __init__(self) -> None:
        self.key, self.pack, self.told = np.zeros(0, "<u8"), np.zeros(0, np.int64), np.zeros(0, bool)
        self._new: list[tuple[np.ndarray, int]] = []
        self._n = 0

    def add(self, keys: np.ndarray, pack: int) -> Iterator[tuple[int, np.ndarray]]:
        self._new.append((keys, pack))
        self._n += len(keys)
        if self._n >= max(FOLD, len(self.key)):
            yield from self.fold()

    def fold(self) -> Iterator[tuple[int, np.ndarray]]:
        """Sort what is new into what is known; the packs and windows that are now found to repeat."""
        if not self._new:
            return
        key = np.concatenate([self.key, *(x for x, _ in self._new)])
        pack = np.concatenate([self.pack, np.repeat([p for _, p in self._new], [len(x) for x, _ in self._new])])
        told = np.concatenate([self.told, np.zeros(self._n, bool)])
        self._new, self._n = [], 0
        order = np.argsort(key, kind="stable")
        key, pack, told = key[order], pack[order], told[order]
        new = np.append(True, key[1:] != key[:-1])
        several = np.diff(np.append(np.flatnonzero(new), len(key))) > 1
        tell = several[np.cumsum(new) - 1] & ~told
        self.key, self.pack, self.told = key[new], pack[new], (told | tell)[new]
        by = np.argsort(pack[tell], kind="stable")
        key, pack = key[tell][by], pack[tell][by]
        for i, j in runs(pack):
            yield int(pack[i]), key[i:j]


def _repeats(windows: DataFrame) -> DataFrame:
    """pack, bucket, keys of the windows that stand in another pack too."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, found = None, _Known(), []
        for batch in slices(batches, 1024):
            for bucket, pack, data in zip(*(batch.column(x).to_pylist() for x in ("bucket", "pack", "keys")), strict=True):
                if bucket != now:
                    found += [(p, now, x.tobytes()) for p, x in known.fold()]
                    now, known = bucket, _Known()
                found += [(p, now, x.tobytes()) for p, x in known.add(np.frombuffer(data, "<u8"), pack)]
            yield _rows(found, ["pack", "bucket", "keys"], [pa.int64(), pa.int32(), pa.binary()])
            found = []
        yield _rows([(p, now, x.tobytes()) for p, x in known.fold()], ["pack", "bucket", "keys"], [pa.int64(), pa.int32(), pa.binary()])

    n = partitions(windows.sparkSession)
    return windows.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, _ANSWERS)


def _kept(told: DataFrame, length: int, buckets: int, schema: object) -> DataFrame:
    """A row per document: its words, the removed stretches of words and the text of those that stay."""
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RollingHash(31)
        for batch in slices(batches, 8):
            for i, texts in _expanded(batch):
                pack = _Pack(texts, hashes)
                bucket, key, inside = pack.windows(length, buckets)
                code = key ^ mixed(bucket + np.uint64(1))
                b, k = _named(batch.column("told")[i].as_py(), "<u8")
                repeated = np.isin(code, k ^ mixed(b + np.uint64(1))) & inside
                at = np.flatnonzero(inside)
                repeated[at] |= _twice(code[at])
                steps = np.zeros(len(pack.words) + 1, np.int64)
                starts = np.flatnonzero(repeated)
                np.add.at(steps, starts, 1)
                np.add.at(steps, starts + length, -1)
                covered = np.cumsum(steps[:-1]) > 0
                removed, kept, first = [], [], 0
                for text, n in zip(texts, pack.counts.tolist(), strict=True):
                    mine = np.zeros(n + 2, bool)
                    mine[1:-1] = covered[first : first + n]
                    first += n
                    edges = np.flatnonzero(mine[1:] != mine[:-1]).tolist()
                    words = text.split()
                    stays = [0, *edges, n]
                    removed.append([{"begin": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                    kept.append(b" ".join([w for a, b in zip(stays[::2], stays[1::2], strict=True) for w in words[a:b]]))
                of = batch.column("docs").slice(i, 1).flatten()
                columns = [*of.flatten(), pa.array(pack.counts, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return told.mapInArrow(run, schema)


def remove_repeated_windows(docs: DataFrame, length: int = 35, *more: str) -> DataFrame:
    """doc_id, the named columns, n_words, removed (stretches of words) and kept (the other words, a space between two)."""
    block, buckets = (length + 1) // 2, SPREAD * partitions(docs.sparkSession)
    packs = packed(docs, *more)
    hits = _hits(_blocks_and_probes(packs, block, buckets), buckets)
    windows = _candidates(_told(packs, hits, "pack", "data", "sizes"), length, block, buckets)
    removed = F.lit(None).cast("array<struct<begin: long, end: long>>")
    shape = packs.select(F.inline("docs")).select("doc_id", *more, F.lit(0).cast("long").alias("n_words"), removed.alias("removed"), F.lit("").alias("kept"))
    return _kept(_told(packs, _repeats(windows), "docs", "data", "sizes"), length, buckets, shape.schema)


def op13_block_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(table(spark, sf_dir, "documents"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    return out.select("doc_id", "n_words", length.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
