"""Phrases that stand together more often than their parts would by chance, per language.

1. Of every word the window of up to `longest` words that it leads, within its piece of text, is one row of lead
   columns, padded with "" behind the piece's end. Only these longest windows are counted; a ROLLUP over language and
   columns sums them to the counts of all shorter phrases, and of all words at the level of the language.
2. Before that, sketches count phrases in 2**BITS buckets: words and pairs, then longer ones both of whose parts may be
   frequent. A window ends before the word with which its bucket has fewer than `least`: no phrase that is as frequent
   as that goes on there, so no count that is asked for changes, and rare windows don't reach the shuffle. A sketch is a
   bitmap of 2**BITS bits (32 MB) at any size of the corpus; where more phrases than that are frequent it lets more
   windows through, with equal results.
3. Candidates meet the counts of their parts by equi-joins on language and phrase. Scores are exact decimals.

Windows are counted by batch in tasks, then by Spark before and behind the shuffle, so the commonest word is a row per
task. The first of each language are taken from salted groups first.

Defined cases: a null or empty text has no words; a null language is `und`; equal rows count each; the id plays no part;
an empty table, or one without frequent phrases, gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmloom.llm.block_repeats import runs, word_bounds
from filmloom.llm.common import RollingHash, mixed, partitions, sized_slices, slices, small_batches, stored, table

BITS = 28
#: Buckets whose counts travel as one row.
CHUNK = 16
#: Buckets that a task holds before it passes them on.
HELD = 1 << 22
#: Rows of a language that the last step sorts: so many groups of the first ones.
GROUPS = 16
#: Products pass 64 bits, so they are decimals of 38 digits.
SCORE = "(cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(38, 0)) * r)"
_BREAK = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_WORD = ~_BREAK & ~np.isin(np.arange(256), [9, 32])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Batch:
    """The words of a batch of texts: their number among the distinct ones, their language's, their hash and their piece."""

    def __init__(self, batch: pa.RecordBatch, hashes: RollingHash):
        texts = [x.encode() for x in batch.column("text").to_pylist()]
        data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        begin, end = word_bounds(data, _WORD)
        hashes.of(data)
        inside = np.concatenate([data[_WORD[data]], np.zeros(0, np.uint8)])
        offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
        every = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(inside)]).dictionary_encode()
        self.number, self.words = every.indices.to_numpy(), every.dictionary
        self.piece = np.cumsum(_BREAK[data])[begin] if len(begin) else begin
        of = batch.column("lang").dictionary_encode()
        owner = np.searchsorted(np.cumsum([len(x) + 1 for x in texts]), begin, "right")
        self.lang, self.langs = of.indices.to_numpy()[owner] if len(begin) else begin, of.dictionary
        salt = np.array([xxhash.xxh64_intdigest(x.encode()) for x in of.dictionary.to_pylist()], np.uint64)
        self.hash = mixed(hashes.stretches(begin, end) + (end - begin).astype(np.uint64))
        self.hash = mixed(self.hash ^ salt[self.lang]) if len(begin) else self.hash

    def orders(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length, of the phrases of so many words that each word leads: the bucket, and whether a piece holds it."""
        code, n = self.hash, len(self.hash)
        for k in range(1, longest + 1):
            if k > 1:
                code = mixed(code[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.hash[k - 1 :])
            yield k, (code >> np.uint64(64 - BITS)).astype(np.int64), self.piece[: n - k + 1] == self.piece[k - 1 :]
            if k == n:
                return


def _often(known: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether the bits of buckets are set."""
    return (known[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1).astype(bool)


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    return docs.select(lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def frequent_buckets(docs: DataFrame, least: int, shortest: int, longest: int, known: Broadcast | None = None) -> np.ndarray:
    """A bit for each bucket: whether its phrases of these lengths stand `least` times or more, all together.

    known: bits of all shorter lengths; only phrases both of whose parts of one word less may be frequent are counted.
    """
    kind = "<u1" if least < 256 else "<u4"

    def passed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bucket, n = _summed(held)
        chunk = bucket >> CHUNK
        spans = runs(chunk)
        low, n = (bucket & ((1 << CHUNK) - 1)).astype("<u2"), np.minimum(n, least).astype(kind)
        columns = [pa.array([int(chunk[i]) for i, _ in spans], pa.int32()), *(pa.array([x[i:j].tobytes() for i, j in spans], pa.binary()) for x in (low, n))]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "low", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held = RollingHash(37), []
        for batch in sized_slices(batches):
            alive, found = None, [np.zeros(0, np.int64)]
            for k, bucket, near in _Batch(batch, hashes).orders(longest):
                alive = near if alive is None else near & alive[:-1] & alive[1:]
                if k >= shortest:
                    found.append(bucket[alive])
                elif known:
                    alive = alive & _often(known.value, bucket)
            held.append(np.unique(np.concatenate(found), return_counts=True))
            if sum(len(x) for x, _ in held) > HELD:
                held = [_summed(held)]
                if len(held[0][0]) > HELD // 2:
                    yield passed(held)
                    held = []
        yield passed(held)

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(1 << CHUNK, np.int64)
        done: list[tuple[int, bytes]] = []

        def close() -> None:
            if now is not None and (total >= least).any():
                done.append((now, np.packbits(total >= least, bitorder="little").tobytes()))

        for batch in slices(batches, 256):
            for chunk, low, n in zip(*(batch.column(x).to_pylist() for x in ("chunk", "low", "n")), strict=True):
                if chunk != now:
                    close()
                    now, total = chunk, np.zeros(1 << CHUNK, np.int64)
                total[np.frombuffer(low, "<u2")] += np.frombuffer(n, kind)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int32()), pa.array([x for _, x in done], pa.binary())], names=["chunk", "bits"])

    parts = _texts(docs).mapInArrow(count, "chunk int, low binary, n binary")
    parts = parts.repartition(partitions(docs.sparkSession), "chunk").sortWithinPartitions("chunk")
    size = 1 << CHUNK - 3
    out = np.zeros(1 << BITS - 3, np.uint8)
    for row in parts.mapInArrow(join, "chunk int, bits binary").toLocalIterator():  # 2**BITS bits at most
        out[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their counts, of several lists of them."""
    bucket = np.concatenate([*(x for x, _ in held), np.zeros(0, np.int64)])
    n = np.concatenate([*(x for _, x in held), np.zeros(0, np.int64)])
    order = np.argsort(bucket, kind="stable")
    bucket, n = bucket[order], n[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    return bucket[first], np.add.reduceat(n, first) if len(first) else n


def lead_windows(docs: DataFrame, least: int, longest: int) -> DataFrame:
    """lang, w1 to w<longest> ("" behind the window's end) and n: how often each longest window stands."""
    context = docs.sparkSession.sparkContext
    bits = context.broadcast(frequent_buckets(docs, least, 1, min(2, longest)))
    if longest > 2:
        bits = context.broadcast(bits.value | frequent_buckets(docs, least, 3, longest, bits))
    names = [f"w{i + 1}" for i in range(longest)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = RollingHash(37), bits.value
        for batch in sized_slices(batches):
            b = _Batch(batch, hashes)
            if not len(b.number):
                continue
            lead, pad, n = b.number.astype(np.int64), len(b.words), len(b.number)
            stays, columns = np.ones(n, bool), []
            for k, bucket, near in b.orders(longest):
                stays = stays & np.append(near & _often(known, bucket), np.zeros(k - 1, bool))
                columns.append(np.where(stays, np.append(lead[k - 1 :], np.full(k - 1, pad)), pad))
            columns += [np.full(n, pad)] * (longest - len(columns))
            code = b.lang.astype(np.int64)
            for x in columns:
                _, code = np.unique(code * (pad + 1) + x, return_inverse=True)
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            words = pa.concat_arrays([b.words, pa.array([""])])
            made = [b.langs.take(pa.array(b.lang[first])), *(words.take(pa.array(x[first])) for x in columns), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=["lang", *names, "n"])

    kinds = ", ".join(f"{x} string" for x in ["lang", *names])
    found = _texts(docs).mapInArrow(run, f"{kinds}, n long")
    return found.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """lang, size, words, phrase, f of phrases up to `longest` words that stand `least` times; and lang, n of all words."""
    names = [f"w{i + 1}" for i in range(longest)]
    windows = stored(lead_windows(docs, least, longest), "windows")
    level = F.grouping_id().alias("level")
    sums = windows.rollup("lang", *names).agg(F.sum("n").alias("f"), level).where(F.col("lang").isNotNull())
    # a column that the rollup summed over has its bit in level; one that it kept mustn't be padding
    size = (F.lit(longest) - F.bit_count("level")).cast("int")
    last = F.element_at(F.array(F.lit(""), *names), F.col("size") + 1)
    sums = sums.withColumn("size", size).where((F.col("size") == 0) | ((F.col("f") >= least) & (last != "")))
    sums = stored(sums.withColumn("words", F.slice(F.array(*names), F.lit(1), F.col("size"))).select("lang", "size", "words", "f"), "phrases")
    return sums.where("size > 0").withColumn("phrase", F.array_join("words", " ")), sums.where("size = 0").select("lang", F.col("f").alias("n"))


def _part(start: Column, n: Column) -> Column:
    return F.array_join(F.slice("words", start, n), " ")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, share: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` of each language.

    score is the least of floor(1000 * a * n / (l * r)) over a phrase's cuts. A phrase goes where a longer candidate
    around it has `share` per cent of its count or more.
    """
    counts, totals = phrase_counts(docs, least, longest)
    candidates = counts.where("size > 1").select("lang", "phrase", "words", "size", F.col("f").alias("a"))
    cuts = candidates.select("lang", "phrase", "words", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    parts = counts.select("lang", "phrase", "f")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select(F.col("lang").alias("_g"), F.col("phrase").alias("_p"), F.col("f").alias(name)), (F.col("lang") == F.col("_g")) & (F.col(side) == F.col("_p"))).drop("_g", "_p")
    cuts = cuts.join(totals, "lang")
    best = cuts.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("b"))

    # stretches of two words or more within a longer candidate
    size = F.col("size")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: _part(i, n))))
    around = candidates.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    rows = best.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("b.a")))
    rows = rows.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs.sparkSession)))
    for groups in ([salt], [F.pmod(salt, F.lit(GROUPS))], []):
        rank = F.row_number().over(Window.partitionBy("lang", *groups).orderBy(*order))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
