"""Removal of repeated passages: every byte that lies in a string of `length` bytes which also starts earlier.

1. Anchors. Of the `length - SEED + 1` seeds of SEED bytes in a window of `length` bytes the one with the least hash
   (the leftmost of equal ones) is the window's anchor. It depends on the window's bytes alone, so equal windows have
   equal anchors at equal offsets, and about one place in 33 is an anchor. An anchor's span is the stretch that its
   windows cover. Anchors whose seed stands only once are left out by a count of seeds and a semi-join.
2. Equal spans are pre-aggregated to their first place: all windows of the later ones start earlier as well.
3. Where a seed has several spans, their windows are suffixes of the spans, cut at `length` bytes. Tasks sort them by
   the deep-shallow method: multikey quicksort on 8-byte characters to SHALLOW characters, then blind tries order the
   groups that still agree. Neighbours with a common prefix of `length` bytes are equal, and all but the first place
   of such a run are repeated.
4. A document's removed bytes are the union of the repeated windows.

Seeds with more than HOT spans are dealt by the hash of each window instead of the seed, so that a frequent line
doesn't fill one task. Every aggregate of a seed or span is combined before it is shuffled.

Defined cases: a null or empty text has no bytes; a text under `length` bytes keeps all; documents without doc_id
keep all bytes and count for no other; rows that repeat a doc_id follow each other by their text;
an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmloom.llm.common import RollingHash, mixed, partitions, sized_slices, slices, small_batches, stored, table

SEED = 36
SHALLOW = 4
HOT = 1024
#: Bytes worked on at once; places in a block fit the low bits of PLACE.
BLOCK = 1 << 19
PLACE = np.uint64((1 << 22) - 1)


def anchors(data: np.ndarray, ends: np.ndarray, length: int, hashes: RollingHash) -> tuple[np.ndarray, ...]:
    """Of a buffer of documents that end at `ends`: first and last window, seed hash and span hash of each anchor."""
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none, none
    hashes.of(data)
    at = np.arange(len(data) - SEED + 1)
    seeds = mixed(hashes.stretches(at, at + SEED))
    packed = (seeds & ~PLACE) | at.astype(np.uint64)
    width, span = length - SEED + 1, 1
    while span * 2 <= width:
        packed = np.minimum(packed[:-span], packed[span:])
        span *= 2
    if span < width:
        packed = np.minimum(packed[: len(packed) - (width - span)], packed[width - span :])
    chosen = (packed & PLACE).astype(np.int64)
    # a window lies in one document
    document = np.searchsorted(ends, np.arange(n), "right")
    inside = np.arange(n) + length <= ends[document]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | (chosen[1:] != chosen[:-1]) | (document[1:] != document[:-1])
    first = np.flatnonzero(opens)
    if not len(first):
        return none, none, none, none
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    last = np.flatnonzero(closes)
    place = chosen[first]
    spans = hashes.stretches(first, last + length)
    spans = mixed(mixed(spans + (last - first).astype(np.uint64)) + (place - first).astype(np.uint64))
    return first, last, seeds[place].view(np.int64), spans.view(np.int64)


def _blocks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of up to BLOCK bytes with the documents in them: numbers, starts within the document, ends."""
    parts, numbers, shifts, held = [], [], [], 0
    for i, text in enumerate(texts):
        for shift in range(0, max(1, len(text) - length + 1), BLOCK):
            part = text[shift : shift + BLOCK + length - 1]
            if held + len(part) > 2 * BLOCK and parts:
                yield _block(parts, numbers, shifts)
                parts, numbers, shifts, held = [], [], [], 0
            parts.append(part)
            numbers.append(i)
            shifts.append(shift)
            held += len(part)
    if parts:
        yield _block(parts, numbers, shifts)


def _block(parts: list[bytes], numbers: list[int], shifts: list[int]) -> tuple[np.ndarray, ...]:
    ends = np.cumsum([len(x) for x in parts])
    return np.frombuffer(b"".join(parts), np.uint8), np.array(numbers), np.array(shifts), ends


def _anchor_table(docs: DataFrame, length: int, columns: list[str]) -> DataFrame:
    """Anchors of docs (doc_id, copy, text); a place is a window's first byte in its document."""
    kinds = {"seed": "long", "span": "long", "doc_id": "long", "copy": "int", "first": "long", "last": "long"}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RollingHash(29)
        for batch in sized_slices(batches, most=BLOCK, rows=4096):
            ids = batch.column("doc_id").to_numpy()
            copies = batch.column("copy").to_numpy()
            for data, numbers, shifts, ends in _blocks([x.encode() for x in batch.column("text").to_pylist()], length):
                first, last, seed, span = anchors(data, ends, length, hashes)
                document = np.searchsorted(ends, first, "right")
                move = shifts[document] - np.concatenate([[0], ends[:-1]])[document]
                made = {"seed": seed, "span": span, "doc_id": ids[numbers[document]], "copy": copies[numbers[document]]}
                made |= {"first": first + move, "last": last + move}
                yield pa.RecordBatch.from_arrays([pa.array(made[x]) for x in columns], names=columns)

    return docs.select("doc_id", "copy", "text").mapInArrow(run, ", ".join(f"{x} {kinds[x]}" for x in columns))


def multikey_order(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort on 8-byte characters, a depth at a time: the order, and the number of each group that agrees."""
    order = np.arange(len(words))
    group = np.zeros(len(words), np.int64)
    loose = np.arange(len(words))
    for d in range(depth):
        if not len(loose):
            break
        key = words[order[loose], d]
        by = np.lexsort((key, group[loose]))
        order[loose] = order[loose][by]
        key = key[by]
        mine = group[loose]
        new = np.ones(len(loose), bool)
        new[1:] = (key[1:] != key[:-1]) | (mine[1:] != mine[:-1])
        # a group is named by the place at which it starts
        group[loose] = loose[np.maximum.accumulate(np.where(new, np.arange(len(loose)), 0))]
        alone = new & np.append(new[1:], True)
        loose = loose[~alone]
    return order, group


def blind_tries(suffixes: np.ndarray, order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order groups that agree by blind tries, all groups a level at a time.

    A node keeps one suffix; the others branch off it where they first differ, and only that place and character are
    kept of them. Those that branch off alike form the next level's nodes. Returns the order and the final groups, of
    equal suffixes.
    """
    order, group = order.copy(), group.copy()
    width = suffixes.shape[1]
    sizes = np.bincount(group, minlength=len(group))
    loose = np.flatnonzero(sizes[group] > 1)
    while len(loose):
        head = suffixes[order[group[loose]]]
        mine = suffixes[order[loose]]
        differ = mine != head
        equal = ~differ.any(axis=1)
        at = np.where(equal, width, differ.argmax(axis=1))
        row, spot = np.arange(len(loose)), np.minimum(at, width - 1)
        mark = mine[row, spot].astype(np.int64)
        below = ~equal & (mark < head[row, spot])
        # smaller ones by rising depth, then those equal to the node, then larger ones by falling depth
        rank = np.where(equal, 1 << 40, np.where(below, at * 512 + mark, (1 << 41) - at * 512 + mark))
        by = np.lexsort((rank, group[loose]))
        order[loose] = order[loose][by]
        rank, old, equal = rank[by], group[loose], equal[by]
        new = np.ones(len(loose), bool)
        new[1:] = (rank[1:] != rank[:-1]) | (old[1:] != old[:-1])
        group[loose] = loose[np.maximum.accumulate(np.where(new, row, 0))]
        alone = new & np.append(new[1:], True)
        loose = loose[~alone & ~equal]
    return order, group


def deep_shallow(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order rows of bytes; of each place in the order, the number of its group of equal rows."""
    width = -(-suffixes.shape[1] // 8) * 8
    padded = np.zeros((len(suffixes), width), np.uint8)
    padded[:, : suffixes.shape[1]] = suffixes
    words = padded.view(">u8").astype(np.uint64)
    return blind_tries(suffixes, *multikey_order(words, min(SHALLOW, words.shape[1])))


def _repeated(spans: DataFrame, length: int) -> DataFrame:
    """doc_id, copy, first, last of the runs of windows that start earlier, of spans (key, doc_id, copy, first, bytes)."""
    kinds = "doc_id long, copy int, first long, last long"

    def sort(rows: pa.Table) -> pa.RecordBatch:
        blobs = rows.column("bytes").to_pylist()
        data = np.frombuffer(b"".join(blobs), np.uint8)
        sizes = np.array([len(x) for x in blobs])
        windows = sizes - length + 1
        owner = np.repeat(np.arange(len(blobs)), windows)
        inner = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = np.repeat(np.cumsum(sizes) - sizes, windows) + inner
        suffixes = np.lib.stride_tricks.sliding_window_view(data, length)[begin]
        order, group = deep_shallow(suffixes)
        ids, copies = rows.column("doc_id").to_numpy()[owner], rows.column("copy").to_numpy()[owner]
        place = rows.column("first").to_numpy()[owner] + inner
        by = np.lexsort((place[order], copies[order], ids[order], group))
        later = np.ones(len(by), bool)
        sorted_group = group[by]
        later[np.flatnonzero(np.append(True, sorted_group[1:] != sorted_group[:-1]))] = False
        hit = np.sort(order[by[later]])
        opens = np.ones(len(hit), bool)
        opens[1:] = (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])
        closes = np.append(opens[1:], True)[: len(hit)]
        i, j = hit[opens], hit[closes]
        made = [ids[i], copies[i], place[i], place[j]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["doc_id", "copy", "first", "last"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in slices(batches, 1024):
            held.append(batch)
            n += batch.num_rows
            if n < 1024:
                continue
            # all keys but the last are whole
            rows = pa.Table.from_batches(held)
            keys = rows.column("key").to_numpy()
            stop = int(np.searchsorted(keys, keys[-1], "left"))
            if stop:
                yield sort(rows.slice(0, stop))
                held, n = rows.slice(stop).to_batches(), n - stop
        if held:
            yield sort(pa.Table.from_batches(held))

    n = partitions(spans.sparkSession)
    return spans.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, kinds)


def _numbered(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, copy, text and more columns; copy numbers the rows of a doc_id that repeats."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more
    )
    if not rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").take(1):
        return rows.withColumn("copy", F.lit(0))
    # rows without an id aren't numbered, so they needn't meet
    order = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy("text")
    return rows.withColumn("copy", F.when(F.col("doc_id").isNull(), 0).otherwise(F.row_number().over(order) - 1))


def _packed(rows: DataFrame) -> DataFrame:
    """rows with the text's bytes compressed, for shuffles."""
    others = [x for x in rows.columns if x != "text"]
    schema = rows.select(*others).withColumn("data", F.lit(None).cast("binary")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in sized_slices(batches):
            data = pa.array([squeeze(x.encode()) for x in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in others), data], names=[*others, "data"])

    return rows.select(*others, "text").mapInArrow(run, schema)


def repeated_windows(rows: DataFrame, length: int) -> DataFrame:
    """doc_id, copy and runs (first and last window) of what starts earlier, for rows (doc_id, copy, text) that have any."""
    usable = rows.where("doc_id is not null")
    # stored, so that both sides of the joins below are shuffled anew and a frequent seed's rows can be split
    seeds = stored(_anchor_table(usable, length, ["seed"]).groupBy("seed").count().where("count > 1").select("seed"), "seeds")
    found = _anchor_table(usable, length, ["seed", "span", "doc_id", "copy", "first", "last"])
    found = stored(found.join(seeds, "seed", "left_semi"), "anchors")
    head = F.min(F.struct("doc_id", "copy", "first", "last")).alias("head")
    spans = stored(found.groupBy("seed", "span").agg(head), "spans")
    firsts = spans.select(F.col("seed").alias("s"), F.col("span").alias("p"), "head")
    copies = found.join(firsts, (F.col("seed") == F.col("s")) & (F.col("span") == F.col("p")))
    copies = copies.where(F.struct("doc_id", "copy", "first", "last") != F.col("head")).select("doc_id", "copy", "first", "last")

    several = stored(spans.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1"), "several")
    heads = spans.join(several, "seed").select("seed", "n", "head.*")
    wanted = heads.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("seed", "n", "first", "last")).alias("wanted"))
    cut = stored(_cut(_packed(usable.select("doc_id", "copy", "text")).join(wanted, ["doc_id", "copy"]), length), "suffixes")
    sorted_ = _repeated(cut.where(~F.col("hot")).select("key", "doc_id", "copy", "first", "bytes"), length)
    hot = cut.where("hot").select(F.md5("bytes").alias("window"), "doc_id", "copy", "first")
    least = hot.groupBy("window").agg(F.min(F.struct("doc_id", "copy", "first")).alias("least"))
    hot = hot.join(least, "window").where(F.struct("doc_id", "copy", "first") != F.col("least"))
    hot = hot.select("doc_id", "copy", "first", F.col("first").alias("last"))
    runs = copies.union(sorted_).union(hot)
    return runs.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def _cut(joined: DataFrame, length: int) -> DataFrame:
    """Spans of seeds with few of them, and single windows of the hot seeds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        names = ["key", "doc_id", "copy", "first", "bytes", "hot"]
        for batch in sized_slices(batches, "data"):
            rows: list[tuple] = []
            for row in batch.to_pylist():
                text = expand(row["data"])
                for x in row["wanted"]:
                    key, i, j = x["seed"], x["first"], x["last"]
                    if x["n"] <= HOT:
                        rows.append((key, row["doc_id"], row["copy"], i, text[i : j + length], False))
                    else:
                        rows += [(key, row["doc_id"], row["copy"], k, text[k : k + length], True) for k in range(i, j + 1)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)

    return joined.select("doc_id", "copy", "data", "wanted").mapInArrow(
        run, "key long, doc_id long, copy int, first long, bytes binary, hot boolean"
    )


def merged(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal removed stretches (begin, end) of sorted runs of windows."""
    out: list[list[int]] = []
    for x in runs:
        begin, end = x["first"], x["last"] + length
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(i, j) for i, j in out]


def remove_repeats(docs: DataFrame, length: int = 100, *more: str, as_text: bool = False) -> DataFrame:
    """doc_id, the named columns, n_bytes, removed (stretches of bytes) and kept (the other bytes), a row per row.

    as_text: kept as text, without characters of which a byte was removed.
    """
    rows = _numbered(docs, *more)
    runs = repeated_windows(rows, length).withColumnsRenamed({"doc_id": "of", "copy": "number"})
    joined = _packed(rows).join(runs, (F.col("doc_id") == F.col("of")) & (F.col("copy") == F.col("number")), "left")
    joined = joined.select("doc_id", *more, "data", "runs")
    stretches = "array<struct<begin: long, end: long>>"
    schema = joined.select(
        "doc_id", *more, F.lit(0).cast("long").alias("n_bytes"), F.lit(None).cast(stretches).alias("removed"), F.col("data").cast("string" if as_text else "binary").alias("kept")
    ).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in sized_slices(batches, "data"):
            sizes, removed, kept = [], [], []
            for data, found in zip(batch.column("data").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                text = expand(data)
                out = merged(found or [], length)
                edges = [0, *(x for pair in out for x in pair), len(text)]
                sizes.append(len(text))
                removed.append([{"begin": i, "end": j} for i, j in out])
                kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
            columns = [batch.column(x) for x in ("doc_id", *more)]
            left = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            columns += [pa.array(sizes, pa.int64()), pa.array(removed, kind), left]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *more, "n_bytes", "removed", "kept"])

    return joined.mapInArrow(run, schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    return out.select(
        "doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
