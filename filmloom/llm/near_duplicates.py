"""Near-duplicate documents: MinHash signatures joined by Hamming distance, links confirmed on full shingle sets.

A signature has SYMBOLS symbols of 16 bits; two sets of Jaccard likeness J differ in each with probability 1 - J.
Signatures are split into chunks of CHUNK symbols. Two that differ in at most LIMIT = 2 * chunks - 1 places have, by
the pigeonhole principle, a chunk with at most one error, so they share one of its CHUNK keys that leave one symbol
out. Every pair within LIMIT therefore meets in a bucket. At J = 0.8 a pair lies beyond LIMIT with a probability of
about 5 in a million; such a link is found only if a chain of others holds its ends together.

1. Equal sets are one class first.
2. In each bucket, members are compared by signature with the bucket's head. Those beyond LIMIT are compared with all
   members of their bucket, in blocks of bounded size, so that every pair within LIMIT is joined, by itself or by a
   chain of such pairs. The components of these pairs are the candidate clusters; documents that only meet in a bucket
   by chance, or share a small part, are in different ones.
3. Each member is compared with its cluster's hub, the one that shares most places with others, on full sets. What
   isn't linked with a hub is compared with every member of its cluster, in blocks of bounded size, by an index of the
   block's shingles; a block tells only the links that join what was apart. So of every two different components of a
   cluster one side has been compared with the other: no link within it is lost, and no group is gathered. Work on
   members that aren't linked with their hub grows with their number times the cluster's size.

Shingles are compared as 64-bit hashes of all words' hashes; long words are hashed by xxHash, since the running sums
that hash short ones can be made to collide on long words.

Defined cases: a null or empty text, or one without words, has an empty set and is alone; a document without doc_id is
alone, with a null component, and kept; rows that repeat a doc_id are one node, for which its least text speaks;
an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import RollingHash, mixed, sized_slices, stored, table, texts
from filmloom.llm.components import components

SYMBOLS = 48
CHUNK = 4
LIMIT = 2 * (SYMBOLS // CHUNK) - 1
BLOCK_SHINGLES = 300_000
#: Members of a bucket that are compared with as many others at once.
BLOCK_SIGNATURES = 2048
#: Bytes of a word from which on it is hashed by itself.
LONG_WORD = 32
_rng = np.random.default_rng(5)
_FLIPS = _rng.integers(0, 1 << 64, SYMBOLS, np.uint64)
_ODD = _rng.integers(0, 1 << 64, SYMBOLS, np.uint64) | np.uint64(1)
_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_sets(whole: list[bytes], width: int, hashes: RollingHash) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct shingles of so many words; fewer words are one shingle."""
    data = np.frombuffer(b"\n".join(whole).translate(_LOWER) + b"\n", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1))
    starts, ends = edge[::2], edge[1::2]
    hashes.of(data)
    words = mixed(hashes.stretches(starts, ends) + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        words[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    firsts = np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in whole)]))
    out = []
    odd = [np.uint64(0x9E3779B97F4A7C15 + 2 * k) for k in range(width)]
    for i, j in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        n = j - i
        if n >= width:
            total = words[i : j - width + 1] * odd[0]
            for k in range(1, width):
                total = mixed(total) + words[i + k : j - width + 1 + k] * odd[k]
            out.append(np.unique(mixed(total)))
        elif n:
            total = np.array([n], np.uint64)
            for k in range(n):
                total = mixed(total) + words[i + k : i + k + 1] * odd[k]
            out.append(mixed(total))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """SYMBOLS 16-bit symbols of a set that isn't empty."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = (shingles[at : at + 4096, None] ^ _FLIPS) * _ODD
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(48)).astype("<u2")


def bucket_keys(signatures: np.ndarray) -> np.ndarray:
    """A row per signature: for each chunk and each of its symbols, a hash of the chunk without that symbol."""
    chunks = signatures.reshape(len(signatures), -1, CHUNK).astype(np.uint64)
    keys = []
    for left_out in range(CHUNK):
        total = np.arange(chunks.shape[1], dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(left_out + 1)
        total = np.broadcast_to(total, chunks.shape[:2])
        for k in range(CHUNK):
            if k != left_out:
                total = mixed(total) ^ chunks[:, :, k]
        keys.append(mixed(total))
    return np.concatenate(keys, axis=1).view(np.int64)


def features(rows: DataFrame, width: int) -> DataFrame:
    """Of rows (doc_id, text): doc_id, n_shingles, set_key (equal for equal sets) and signature (null for empty sets)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RollingHash(17)
        for batch in sized_slices(batches):
            sets = shingle_sets([x.encode() for x in batch.column("text").to_pylist()], width, hashes)
            keys, signs = [], []
            for x in sets:
                second = mixed(x ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
                keys.append(np.array([len(x), x.sum(dtype=np.uint64), second], "<u8").tobytes() if len(x) else None)
                signs.append(signature(x).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "signature"],
            )

    return rows.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def _keys(classes: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                signs = np.frombuffer(b"".join(part.column("signature").to_pylist()), "<u2").reshape(-1, SYMBOLS)
                keys = bucket_keys(signs)
                ids = np.repeat(part.column("rep").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "rep"])

    return classes.select("rep", "signature").mapInArrow(run, "key long, rep long")


def far(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether signatures, row by row, differ in more than LIMIT places."""
    return (one != two).sum(axis=-1) > LIMIT


def _signatures(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, SYMBOLS)


def _near_pairs(keys: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) that join whatever is within LIMIT of each other in a bucket; keys has key and rep."""

    def apart(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                mark = far(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b")))
                yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("head"), pa.array(mark)], names=["rep", "head", "far"])

    heads = keys.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("members")).where("members > 1")
    heads = stored(heads.withColumnRenamed("key", "at"), "heads")
    buckets = stored(keys.join(heads, F.col("key") == F.col("at")).select("key", "rep", "head", "members"), "buckets")
    signs = classes.select("rep", "signature")
    pairs = buckets.where("rep <> head").select("rep", "head").distinct()
    both = pairs.join(signs.withColumnRenamed("signature", "sig_a"), "rep")
    both = both.join(signs.select(F.col("rep").alias("head"), F.col("signature").alias("sig_b")), "head")
    judged = stored(both.select("rep", "head", "sig_a", "sig_b").mapInArrow(apart, "rep long, head long, far boolean"), "judged")
    close = judged.where(~F.col("far")).select(F.col("rep").alias("a"), F.col("head").alias("b"))

    # those far from their head meet all members of their bucket but the head
    beyond = judged.where("far").select(F.col("rep").alias("r"), F.col("head").alias("h"))
    beyond = buckets.where("members > 2").join(beyond, (F.col("rep") == F.col("r")) & (F.col("head") == F.col("h")), "left")
    beyond = beyond.where("rep <> head").select("key", "rep", "members", F.col("r").isNotNull().alias("far"))
    totals = beyond.groupBy("key").agg(F.sum(F.col("far").cast("long")).alias("n"), F.first("members").alias("m")).where("n > 0")
    size = F.lit(BLOCK_SIGNATURES)
    totals = stored(totals.select(F.col("key").alias("at"), F.ceil(F.col("n") / size).alias("groups"), F.ceil(F.col("m") / size).alias("blocks")), "totals")
    rows = stored(beyond.join(totals, F.col("key") == F.col("at")).join(signs, "rep").select("key", "rep", "far", "signature", "groups", "blocks"), "beyond")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    members = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("group", upto("groups"))
    asked = rows.where("far").withColumn("group", F.pmod(F.xxhash64("rep"), F.col("groups"))).withColumn("block", upto("blocks"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(block: pa.Table, group: pa.Table) -> pa.Table:
        if not block.num_rows or not group.num_rows:
            return out.empty_table()
        one, two = block.column("rep").to_numpy(), group.column("rep").to_numpy()
        mine, other = _signatures(block.column("signature")), _signatures(group.column("signature"))
        joined = Joined()
        links = []
        # those close to the head are one already
        near = one[~block.column("far").to_numpy()].tolist()
        for x in near[1:]:
            joined.join(x, near[0])
        for i in range(len(two)):
            for k in np.flatnonzero(~far(mine, other[i])).tolist():
                if joined.join(int(two[i]), int(one[k])):
                    links.append((int(two[i]), int(one[k])))
        return pa.table(dict(zip(("a", "b"), zip(*links, strict=True), strict=True)), schema=out) if links else out.empty_table()

    by = ["key", "block", "group"]
    left = members.select(*by, "rep", "far", "signature").groupBy(*by)
    more = left.cogroup(asked.select(*by, "rep", "signature").groupBy(*by)).applyInArrow(compare, "a long, b long")
    return close.union(more)


class Joined:
    """Sets of nodes that were joined."""

    def __init__(self) -> None:
        self._parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self._parent.setdefault(x, x)) != x:
            self._parent[x] = x = self._parent.setdefault(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        """Join two; whether they were apart."""
        one, two = self.find(a), self.find(b)
        self._parent[one] = two
        return one != two


def _sets(rows: pa.Table, width: int, hashes: RollingHash) -> list[np.ndarray]:
    return [y for x in sized_slices(rows.to_batches()) for y in shingle_sets([z.encode() for z in x.column("text").to_pylist()], width, hashes)]


def _confirmed(pairs: DataFrame, whole: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of members to their hubs, on full sets; pairs has rep, hub and n, whole has doc_id and text.

    A hub's members are dealt to blocks by their shingles' number, and its text goes once to each block.
    """
    totals = stored(pairs.groupBy("hub").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks")), "totals")
    rows = pairs.join(totals, "hub").join(whole.withColumnRenamed("doc_id", "rep"), "rep")
    rows = rows.select("hub", F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block"), "rep", "text")
    heads = totals.join(whole.withColumnRenamed("doc_id", "hub"), "hub")
    heads = heads.select(F.col("hub").alias("hub"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("text").alias("text"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(block: pa.Table, head: pa.Table) -> pa.Table:
        if not block.num_rows or not head.num_rows:
            return out.empty_table()
        hashes = RollingHash(17)
        x = _sets(head, width, hashes)[0]
        found = []
        for name, y in zip(block.column("rep").to_pylist(), _sets(block, width, hashes), strict=True):
            small, large = sorted((len(x), len(y)))
            if small and 100 * small >= percent * large:
                same = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * same >= percent * (small + large - same):
                    found.append(name)
        return pa.table({"a": found, "b": [head.column("hub")[0].as_py()] * len(found)}, schema=out)

    by = ["hub", "block"]
    return rows.groupBy(*by).cogroup(heads.groupBy(*by)).applyInArrow(compare, "a long, b long")


def _others(rows: DataFrame, whole: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of members that aren't linked with their hub to any member of their cluster.

    rows: cluster, rep, n, linked. Members are dealt to blocks, and those to compare to groups, by their shingles'
    number; each group meets each block once.
    """
    free = ~F.col("linked")
    totals = rows.groupBy("cluster").agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"),
        F.ceil(F.sum(F.when(free, F.col("n"))) / BLOCK_SHINGLES).alias("groups"),
        F.count("*").alias("size"),
    )
    totals = stored(totals.where("groups > 0 and size > 2"), "totals")
    rows = rows.join(totals, "cluster").join(whole.withColumnRenamed("doc_id", "rep"), "rep")
    rows = stored(rows.select("cluster", "rep", "linked", "text", "blocks", "groups"), "members")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    members = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("group", upto("groups"))
    asked = rows.where(free).withColumn("group", F.pmod(F.xxhash64("rep"), F.col("groups"))).withColumn("block", upto("blocks"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(block: pa.Table, group: pa.Table) -> pa.Table:
        hashes = RollingHash(17)
        if not block.num_rows or not group.num_rows:
            return out.empty_table()
        names = block.column("rep").to_pylist()
        mine = _sets(block, width, hashes)
        every = np.concatenate(mine)
        sizes = np.array([len(x) for x in mine])
        owner = np.repeat(np.arange(len(mine)), sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        joined = Joined()
        # those linked with the hub are one already
        known = [x for x, y in zip(names, block.column("linked").to_pylist(), strict=True) if y]
        for x in known[1:]:
            joined.join(x, known[0])
        links = []
        for name, x in zip(group.column("rep").to_pylist(), _sets(group, width, hashes), strict=True):
            low, high = np.searchsorted(every, x, "left"), np.searchsorted(every, x, "right")
            n = high - low
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            same = np.bincount(owner[at], minlength=len(mine))
            for i in np.flatnonzero(100 * same >= percent * (sizes + len(x) - same)).tolist():
                if joined.join(name, names[i]):
                    links.append((name, names[i]))
        return pa.table(dict(zip(("a", "b"), zip(*links, strict=True), strict=True)), schema=out) if links else out.empty_table()

    keys = ["cluster", "block", "group"]
    left = members.select(*keys, "rep", "linked", "text").groupBy(*keys)
    return left.cogroup(asked.select(*keys, "rep", "text").groupBy(*keys)).applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links) and kept, one row per row of docs."""
    rows = texts(docs)
    found = stored(features(rows, width), "signatures")
    nodes, whole = found, rows
    if _repeats(found):
        whole = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text"))
        nodes = stored(features(whole, width), "nodes")
    usable = nodes.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature"), F.any_value("n_shingles").alias("n")
    )
    classes = stored(classes, "classes")
    near = stored(_near_pairs(_keys(classes), classes), "near")

    clusters = components(near)
    weight = near.select(F.col("a").alias("rep")).union(near.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("shared"))
    members = clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")).join(weight, "rep").join(classes.select("rep", "n"), "rep")
    members = stored(members, "clusters")
    first = F.struct("shared", -F.col("rep"))
    hubs = members.groupBy("cluster").agg(F.max_by("rep", first).alias("hub"), F.max_by("n", first).alias("m"))
    hubs = stored(hubs, "hubs")  # so that a large cluster's rows can be split in the joins
    alike = F.lit(100) * F.least("n", "m") >= F.lit(percent) * F.greatest("n", "m")
    pairs = members.join(hubs, "cluster").where((F.col("rep") != F.col("hub")) & alike).select("rep", "hub", "n")
    pairs = stored(pairs, "pairs")

    whole = stored(whole.join(members.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), "texts")
    links = stored(_confirmed(pairs, whole, width, percent), "confirmed")
    linked = links.select(F.col("a").alias("rep")).union(links.select(F.col("b").alias("rep"))).distinct()
    members = members.join(linked.withColumn("linked", F.lit(True)), "rep", "left").join(hubs.select("cluster", "hub"), "cluster")
    # a hub is compared already, whether or not any member is linked with it
    members = members.withColumn("linked", F.coalesce("linked", F.col("rep") == F.col("hub")))
    more = _others(members.select("cluster", "rep", "n", "linked"), whole, width, percent)
    label = components(stored(links.union(more), "links"))

    by_set = classes.select(F.col("set_key").alias("of"), "rep").join(label, F.col("rep") == F.col("node"), "left")
    by_set = by_set.select("of", F.coalesce("component", "rep").alias("component"))
    ids = usable.select("doc_id", "set_key").join(by_set, F.col("set_key") == F.col("of")).select(F.col("doc_id").alias("id"), "component")
    if nodes is found:
        out = found.join(by_set, F.when(F.col("doc_id").isNotNull(), F.col("set_key")) == F.col("of"), "left")
    else:
        out = found.join(ids, F.col("doc_id") == F.col("id"), "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _repeats(found: DataFrame) -> bool:
    return bool(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").take(1))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)
