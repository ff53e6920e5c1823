"""Approximate nearest neighbours: inverted lists, scanned by dimension with early abandoning.

1. Centroids come from k-means on at most SAMPLE vectors in md5 order of vec_id (the only sample); every vector is put
   in the list of its nearest centroid. A list is dealt to blocks of about BLOCK vectors, and its queries to groups of
   about QUERIES, so one list with most of the vectors or queries is many tasks' work.
2. A block is rotated by a random orthogonal matrix and held by columns. For each query, ROWS vectors at a time, partial
   squared distances grow by COLUMNS dimensions at a time. After d of D dimensions a vector is abandoned when its partial
   distance rejects, by the test partial > best * d / D * (1 + EPSILON / sqrt(d))**2, that it is nearer than the K-th
   best so far. A query scans its nearest list first; the K-th best distance found there bounds the other lists' scan.
3. What is left gets its exact distance in double precision from the original vectors; a query's best K of all its
   blocks are its result, ties to the smaller vec_id.

A query probes as many lists as find the share WANTED of the sample's own neighbours, and further ones until they hold
ENOUGH vectors; vectors without clusters need many. Each block of a list is copied once for every QUERIES queries that ask
it: where the queries grow with the table, as when every hundredth vector is one, so do these copies, and a search of
all of them against all remains a product of both. Recall is measured in tests/llm.

Defined cases: vectors that are null, zero, or hold nulls or non-finite numbers take no part, nor do rows
without vec_id or of another length than most; a query leaves out all rows with its own vec_id; rows that repeat a
vec_id are candidates each, and as queries the same; fewer than K candidates are all returned; an empty table gives no
row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmloom.llm.common import stored, table

K = 10
SAMPLE = 16384
LISTS_MOST = 1024
WANTED = 0.96
ENOUGH = 512
BLOCK = 4096
QUERIES = 1024
COLUMNS = 16
ROWS = 1024
EPSILON = 2.1
_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part."""
    v = F.col("vector")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0))
    most = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (most["n"] if most else 0))


def centroids(rows: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, int]:
    """k-means on a bounded sample, k as half the root of the number of rows, and the lists that a query probes."""
    n = rows.count()
    taken = rows.orderBy(F.md5(F.col("vec_id").cast("string")), "vec_id").limit(sample).collect()
    points = np.array([x["vector"] for x in taken], float)
    if not len(points):
        return np.zeros((0, 0)), 0
    k = max(1, min(LISTS_MOST, int(n**0.5 / 2), len(points)))
    centres = points[np.random.default_rng(0).permutation(len(points))[:k]].copy()
    for _ in range(8):
        near = nearest_centres(points, centres, 1)[:, 0]
        for c in range(k):
            if (mine := near == c).any():
                centres[c] = points[mine].mean(axis=0)
    return centres, probes_for(points, centres)


def probes_for(points: np.ndarray, centres: np.ndarray, wanted: float = WANTED, asked: int = 256) -> int:
    """The lists to probe so that a share of the sample's own nearest neighbours is found."""
    home = nearest_centres(points, centres, 1)[:, 0]
    ranks = []
    for i in range(min(asked, len(points))):
        apart = ((points - points[i]) ** 2).sum(axis=1)
        apart[i] = np.inf
        order = nearest_centres(points[i : i + 1], centres, len(centres))[0]
        place = np.empty(len(centres), np.int64)
        place[order] = np.arange(len(centres))
        ranks += place[home[np.argsort(apart, kind="stable")[: min(K, len(points) - 1)]]].tolist()
    return 1 + int(np.quantile(ranks, wanted, method="higher")) if ranks else 1


def nearest_centres(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """A row per point: its n nearest centres, nearest first."""
    apart = (centres * centres).sum(axis=1) - 2 * points @ centres.T
    return np.argsort(apart, axis=1, kind="stable")[:, :n]


def scan_block(
    ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray | None = None, k: int = K
) -> list[tuple[int, int, float]]:
    """The k nearest of a block to each query, by the adaptive scan and exact distances.

    bounds: for each query a distance beyond which nothing is wanted, as known from other lists.
    """
    width = points.shape[1]
    turn = np.linalg.qr(np.random.default_rng(1).normal(size=(width, width)))[0]
    columns = np.ascontiguousarray((points @ turn).T)
    turned = queries @ turn
    bounds = np.full(len(queries), np.inf) if bounds is None else bounds
    out = []
    for name, query, original, bound in zip(query_ids.tolist(), turned, queries, bounds.tolist(), strict=True):
        found, apart = np.zeros(0, np.int64), np.zeros(0)
        best = bound * bound * (1 + 1e-9)
        for at in range(0, len(ids), ROWS):
            mine = at + np.flatnonzero(ids[at : at + ROWS] != name)
            partial = np.zeros(len(mine))
            for d in range(0, width, COLUMNS):
                if not len(mine):
                    break
                stop = min(d + COLUMNS, width)
                partial = partial + ((columns[d:stop, mine] - query[d:stop, None]) ** 2).sum(axis=0)
                limit = best * (1 + 1e-9) if stop == width else best * stop / width * (1 + EPSILON / stop**0.5) ** 2
                keep = partial <= limit + 1e-12
                mine, partial = mine[keep], partial[keep]
            if len(mine):
                found = np.concatenate([found, mine])
                apart = np.concatenate([apart, ((points[mine] - original) ** 2).sum(axis=1)])
                first = np.lexsort((ids[found], apart))[:k]
                found, apart = found[first], apart[first]
                # the k-th best so far bounds the rows that follow
                best = min(best, float(apart[-1])) if len(found) == k else best
        out += [(name, x, d) for x, d in zip(ids[found].tolist(), np.sqrt(apart).tolist(), strict=True)]
    return out


def search(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for each query (vec_id, vector) the k nearest found in rows."""
    centres, probes = centroids(rows)

    def assign(batches):
        for batch in batches:
            vectors = np.array(batch.column("vector").to_pylist(), float).reshape(batch.num_rows, -1)
            near = nearest_centres(vectors, centres, 1)[:, 0] if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(near), *batch.columns], names=["list", "vec_id", "vector"])

    lists = stored(rows.mapInArrow(assign, "list long, vec_id long, vector array<double>"), "lists")
    # at most LISTS_MOST rows
    held = np.zeros(len(centres), np.int64)
    for x in lists.groupBy("list").count().collect():
        held[x["list"]] = x["count"]

    def probe(batches):
        for batch in batches:
            vectors = np.array(batch.column("vector").to_pylist(), float).reshape(batch.num_rows, -1)
            order = nearest_centres(vectors, centres, len(centres))
            before = np.cumsum(held[order], axis=1) - held[order]
            wanted = (np.arange(len(centres)) < probes) | (before < ENOUGH)
            wanted &= held[order] > 0
            row, at = np.nonzero(wanted)
            taken = batch.take(pa.array(row))
            first = pa.array(at == wanted.argmax(axis=1)[row])
            yield pa.RecordBatch.from_arrays([pa.array(order[row, at]), *taken.columns, first], names=["list", "query_id", "vector", "first"])

    asked = queries.select("vec_id", "vector").distinct().mapInArrow(probe, "list long, query_id long, vector array<double>, first boolean")
    asked = stored(asked, "probes")
    # the nearest list first: its k-th best distance bounds the scan of the others
    near = stored(_scanned(lists, asked.where("first").withColumn("bound", F.lit(float("inf"))), k), "near")
    bounds = _ranked(near, k).groupBy("query_id").agg(F.when(F.count("*") == k, F.max("score")).alias("most"))
    others = asked.where(~F.col("first")).join(bounds, "query_id", "left").withColumn("bound", F.coalesce("most", F.lit(float("inf"))))
    return _ranked(near.union(_scanned(lists, others, k)), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scanned(lists: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k nearest of each block of the lists that are asked; asked has list, query_id, vector, bound."""
    asked = asked.select("list", "query_id", "vector", "bound")
    groups = asked.groupBy("list").agg(F.ceil(F.count("*") / QUERIES).alias("groups"))
    blocks = lists.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = F.broadcast(groups.join(blocks, "list"))  # at most LISTS_MOST rows
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = lists.join(dealt, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).withColumn("group", upto("groups"))
    right = asked.join(dealt, "list").withColumn("group", F.pmod(F.xxhash64("query_id"), F.col("groups"))).withColumn("block", upto("blocks"))

    def scan(points: pa.Table, questions: pa.Table) -> pa.Table:
        if not points.num_rows or not questions.num_rows:
            return _OUT.empty_table()
        found = scan_block(
            points.column("vec_id").to_numpy(), np.array(points.column("vector").to_pylist(), float),
            questions.column("query_id").to_numpy(), np.array(questions.column("vector").to_pylist(), float), questions.column("bound").to_numpy(), k,
        )
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found, strict=True), _OUT, strict=True)], schema=_OUT) if found else _OUT.empty_table()

    keys = ["list", "block", "group"]
    return (
        left.select(*keys, "vec_id", "vector").groupBy(*keys)
        .cogroup(right.select(*keys, "query_id", "vector", "bound").groupBy(*keys))
        .applyInArrow(scan, "query_id long, vec_id long, score double")
    )


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    return search(rows, rows.where(F.col("vec_id") % 100 == 0))
