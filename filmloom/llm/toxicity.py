"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

1. A bounded sample of labelled rows, at most SAMPLE of each class in md5 order of doc_id, gives the examples. Only
   labels whose crc32(doc_id) mod 3 is not 1 are read. The bound is a parameter; all else covers all documents.
2. Terms are words, their first three to six letters (stems, as words are inflected), and either again where a document
   has it twice, three times or five times, since a word may be harmless once. All terms of the examples that stand in
   label 1 more often than in label 0 by more than chance (log-likelihood ratio and lift) are the features of the fitted
   space, without a limit to their number; in the space of all terms, the few words that make a text toxic drown in its
   topic. Their document frequencies come from all documents.
3. The index is an inverted index over the examples, in blocks with the highest weight of each feature. A document's
   blocks are visited by falling bound until no bound reaches the K-th best cosine, so the neighbours are exact.
4. Votes of the neighbours are weighted by the square of their cosine, beside one vote of DOUBT for label 0. Votes of the
   examples themselves, each without itself, give a monotone calibration, weighted to the classes' shares among the
   labelled rows.

Features, examples and calibration are bounded by the sample, so they are broadcast in the tasks' code. Texts without
any feature have no neighbour: they get one score, the calibrated rate of label 1 among such examples.
Defined cases: a null or empty text and one without features get the calibrated score of "no evidence"; without
any labels of both classes all scores are 0; rows that repeat a doc_id are scored each; documents without doc_id are
scored and not held out; null labels are ignored and of repeated ones the larger counts; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import sized_slices, stored, table, texts

SAMPLE = 6000
K = 10
BLOCK = 64
LEAST_RATIO, LEAST_LIFT = 14.0, 8.0
THRESHOLD = 0.7
DOUBT = 1.0
BINS = 20
STEMS = (3, 4, 5, 6)
LEVELS = (2, 3, 5)
_LETTERS = bytes(x if 97 <= x <= 122 or x >= 128 else 32 for x in range(256))


def _counts(text: str) -> Counter[str]:
    return Counter(text.lower().encode().translate(_LETTERS).decode().split())


def _stems(words: Counter[str]) -> Counter[str]:
    out: Counter[str] = Counter()
    for size in STEMS:
        for word, n in words.items():
            if len(word) > size:
                out[word[:size] + "-"] += n
    return out


def terms(text: str) -> list[str]:
    """The distinct terms of a text: words, stems, and either with a level that its count reaches."""
    words = _counts(text)
    out = [*words, *(stems := _stems(words))]
    return out + [f"{x}{level}" for counts in (words, stems) for x, n in counts.items() if n > 1 for level in LEVELS if n >= level]


def hits(text: str, features: dict[str, int], stems: frozenset[str]) -> dict[int, int]:
    """Counts of the features in a text; stems are the beginnings that any feature has."""
    words = _counts(text)
    counts: Counter[str] = Counter()
    for word in features.keys() & words.keys():
        counts[word] = words[word]
    for size in STEMS:
        for word, n in words.items():
            if len(word) > size and (stem := word[:size]) in stems:
                counts[stem + "-"] += n
    out = {i: n for x, n in counts.items() if (i := features.get(x)) is not None}
    for x, n in (*words.items(), *counts.items()):
        if n > 1:
            out |= {i: n for level in LEVELS if n >= level and (i := features.get(f"{x}{level}")) is not None}
    return out


def stems_of(features: Iterable[str]) -> frozenset[str]:
    return frozenset(x.partition("-")[0] for x in features if "-" in x)


class Index(NamedTuple):
    """Examples by block; postings of feature f are ids[starts[f]:starts[f + 1]], and bounds[f] its highest weights."""

    idf: np.ndarray
    doc_ids: np.ndarray
    labels: np.ndarray
    starts: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray


def weighted(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and their weights, of length 1."""
    at = np.array(sorted(counts), np.int64)
    w = np.array([1.0 + math.log(counts[i]) for i in at.tolist()]) * idf[at]
    norm = math.sqrt(float(w @ w))
    return at, w / norm if norm else w


def build_index(examples: list[tuple[int, int, dict[int, int]]], idf: np.ndarray) -> Index:
    """examples: doc_id, label, counts. Those alike stand together, so that blocks have tight bounds."""
    examples = sorted((x for x in examples if x[2]), key=lambda x: (sorted(x[2]), x[0]))
    triples = []
    for e, (_, _, counts) in enumerate(examples):
        at, w = weighted(counts, idf)
        triples += zip(at.tolist(), [e] * len(at), w.tolist(), strict=True)
    triples.sort()
    features = np.array([x[0] for x in triples], np.int64)
    ids, weights = np.array([x[1] for x in triples], np.int64), np.array([x[2] for x in triples], float)
    bounds = np.zeros((len(idf), len(examples) // BLOCK + 1))
    np.maximum.at(bounds, (features, ids // BLOCK), weights)
    starts = np.searchsorted(features, np.arange(len(idf) + 1))
    labels = np.array([x[1] for x in examples], np.int64)
    return Index(idf, np.array([x[0] for x in examples], np.int64), labels, starts, ids, weights, bounds)


def nearest(index: Index, counts: dict[int, int], k: int = K, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and cosines of the k nearest examples, ties to smaller places; `but` is a doc_id to leave out."""
    at, q = weighted(counts, index.idf)
    bound = q @ index.bounds[at]
    lists = []
    for f in at.tolist():
        i, j = index.starts[f], index.starts[f + 1]
        ids = index.ids[i:j]
        lists.append((ids, index.weights[i:j], np.searchsorted(ids, np.arange(len(bound) + 1) * BLOCK)))
    best: list[tuple[float, int]] = []
    least = 0.0
    for b in np.argsort(-bound, kind="stable").tolist():
        if bound[b] <= 0 or len(best) == k and bound[b] < least - 1e-12:
            break
        cosine = np.zeros(BLOCK)
        for (ids, weights, cuts), w in zip(lists, q.tolist(), strict=True):
            i, j = cuts[b], cuts[b + 1]
            if i < j:
                cosine[ids[i:j] - b * BLOCK] += w * weights[i:j]
        for x in np.flatnonzero(cosine >= max(least - 1e-12, 1e-12)).tolist():
            if index.doc_ids[b * BLOCK + x] != but:
                best.append((-round(float(cosine[x]), 12), b * BLOCK + x))
        best = sorted(best)[:k]
        if len(best) == k:
            least = -best[-1][0]
    return np.array([x[1] for x in best], np.int64), np.array([-x[0] for x in best])


def vote(index: Index, places: np.ndarray, cosines: np.ndarray) -> float:
    """The share of label 1 among the neighbours, each with the square of its cosine, and one vote of label 0 for doubt:
    neighbours that share little with the text, as by a single chance term, have little to say."""
    w = cosines * cosines
    return float((w * index.labels[places]).sum() / (w.sum() + DOUBT))


def calibration(counts: dict[tuple[int, int], float]) -> tuple[list[float], list[float], float]:
    """Votes and scores of a rising curve, and the score without evidence; counts by (bin, label), bin -1: none."""
    rate = lambda one, zero: one / (one + zero + 0.5)  # noqa: E731  half a row of label 0 as a prior
    alone = rate(counts.get((-1, 1), 0.0), counts.get((-1, 0), 0.0))
    pools: list[list[float]] = []
    for b in range(BINS + 1):
        one, zero = counts.get((b, 1), 0.0), counts.get((b, 0), 0.0)
        if one + zero:
            pools.append([one, zero, b / BINS * (one + zero), one + zero])
            while len(pools) > 1 and rate(*pools[-2][:2]) >= rate(*pools[-1][:2]):
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    return [p[2] / p[3] for p in pools], [rate(*p[:2]) for p in pools], alone


def _split(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model(NamedTuple):
    features: dict[str, int]
    stems: frozenset[str]
    index: Index
    votes: list[float]
    scores: list[float]
    alone: float


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    rows = texts(docs)
    marked = labels.select(F.col("doc_id").cast("long").alias("of"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where(F.col("of").isNotNull() & F.col("toxic").isin(0, 1) & ~_split(F.col("of"))).groupBy("of").agg(F.max("toxic").alias("toxic"))
    totals = {x["toxic"]: x["count"] for x in marked.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return None
    parts = [marked.where(F.col("toxic") == y).orderBy(F.md5(F.col("of").cast("string"))).limit(sample) for y in (0, 1)]
    # at most two samples of ids
    chosen = F.broadcast(parts[0].union(parts[1]))
    examples = stored(rows.join(chosen, F.col("doc_id") == F.col("of")).select("doc_id", "toxic", "text"), "examples")

    def distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches):
            counts: Counter[tuple[str, int]] = Counter()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts.update((x, y) for x in terms(text))
            names = [x for x, _ in counts]
            ones = [n * y for (_, y), n in counts.items()]
            zeros = [n * (1 - y) for (_, y), n in counts.items()]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ones, pa.int64()), pa.array(zeros, pa.int64())], names=["term", "ones", "zeros"])

    sizes = {x["toxic"]: x["count"] for x in examples.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return None
    by_term = examples.mapInArrow(distinct, "term string, ones long, zeros long").groupBy("term").agg(F.sum("ones").alias("a"), F.sum("zeros").alias("b"))
    pooled = (F.col("a") + F.col("b")) / (n1 + n0)
    part = lambda seen, n, rate: F.when(seen > 0, seen * F.log(seen / (n * rate))).otherwise(0.0)
    ratio = 2 * (
        part(F.col("a"), n1, pooled) + part(F.col("b"), n0, pooled)
        + part(n1 - F.col("a"), n1, 1 - pooled) + part(n0 - F.col("b"), n0, 1 - pooled)
    )
    lift = (F.col("a") / n1) / ((F.col("b") + 0.5) / n0)
    picked = by_term.withColumn("ratio", ratio).where((F.col("ratio") >= LEAST_RATIO) & (lift >= LEAST_LIFT))
    features = {x["term"]: i for i, x in enumerate(picked.orderBy(F.desc("ratio"), "term").collect())}  # bounded by the sample's terms
    stems = stems_of(features)

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(features) + 1, np.int64)
        for batch in sized_slices(batches):
            counts[-1] += batch.num_rows
            for text in batch.column("text").to_pylist():
                for i in hits(text, features, stems):
                    counts[i] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["feature", "n"])

    seen = rows.select("text").mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df = {x["feature"]: x["n"] for x in seen.collect()}  # a row per feature
    n = df.get(len(features), 0)
    idf = np.array([math.log(1 + n / (1 + df.get(i, 0))) for i in range(len(features))])

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches):
            found = [hits(x, features, stems) for x in batch.column("text").to_pylist()]
            pairs = pa.array([list(x.items()) for x in found], pa.map_(pa.int64(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pairs], names=["doc_id", "toxic", "counts"])

    vectors = stored(examples.mapInArrow(counted, "doc_id long, toxic int, counts map<long,long>"), "vectors")
    # bounded by the two samples, and by the features in each
    index = build_index([(x["doc_id"], x["toxic"], dict(x["counts"])) for x in vectors.where("size(counts) > 0").collect()], idf)

    def left_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = []
            for name, counts in zip(batch.column("doc_id").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                found = nearest(index, dict(counts), but=name) if counts else (np.zeros(0, np.int64), np.zeros(0))
                bins.append(round(vote(index, *found) * BINS) if len(found[0]) else -1)
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int64()), batch.column("toxic")], names=["bin", "toxic"])

    votes = vectors.mapInArrow(left_out, "bin long, toxic int").groupBy("bin", "toxic").count().collect()
    # each example stands for as many labelled rows of its class
    stands = {y: totals[y] / sizes[y] for y in (0, 1)}
    curve = calibration({(x["bin"], x["toxic"]): x["count"] * stands[x["toxic"]] for x in votes})
    return Model(features, stems, index, *curve)


def score(docs: DataFrame, model: Model | None, *more: str) -> DataFrame:
    """doc_id, text (null: empty), the named columns, held_out, score, predicted and evidence (neighbours with cosine and label)."""
    rows = texts(docs, *more)
    kind = "array<struct<doc_id: long, cosine: double, toxic: int>>"
    schema = rows.select("doc_id", "text", *more, F.lit(0.0).alias("score"), F.lit(None).cast(kind).alias("evidence")).schema
    names = ["doc_id", "text", *more, "score", "evidence"]
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches):
            scores, shown = [], []
            for text in batch.column("text").to_pylist():
                counts = hits(text, model.features, model.stems) if model else {}
                if not counts:
                    scores.append(model.alone if model else 0.0)
                    shown.append([])
                    continue
                places, cosines = nearest(model.index, counts)
                if not len(places):
                    scores.append(model.alone)
                    shown.append([])
                    continue
                v = vote(model.index, places, cosines)
                scores.append(float(np.interp(v, model.votes, model.scores)) if model.votes else model.alone)
                shown.append([
                    {"doc_id": int(model.index.doc_ids[p]), "cosine": float(c), "toxic": int(model.index.labels[p])}
                    for p, c in zip(places, cosines, strict=True)
                ])
            columns = [batch.column(x) for x in ("doc_id", "text", *more)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64()), pa.array(shown, evidence)], names=names)

    out = rows.mapInArrow(run, schema)
    return out.select(
        "doc_id", "text", *more, _split(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence",
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).drop("text", "evidence")
