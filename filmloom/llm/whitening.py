"""Whitening of embeddings by the leading eigenvectors of their covariance.

1. Entries become integers, x = floor(64 * c) + 1000000. The fit list is each distinct x once, stored. Its number, its
   sums and the sums of its centred products are gathered by Spark as exact integers: products are of x less the
   integer next to the mean, and what that leaves is put right in integers as well, so the covariance is the exact one,
   rounded once.
2. Spectrum slicing: LDL' of the covariance less a shift has as many positive pivots as there are eigenvalues above the
   shift. Halving brackets by these counts isolates each leading eigenvalue; Rayleigh quotient iteration from within its
   bracket converges cubically; the counts to either side of the result certify its number. Eigenvalues that rounding
   can't tell apart share a bracket; vectors are held orthogonal to those found before.
3. Every row is centred, projected and scaled in its task. Whitened values of the fit list are reduced to a count, means
   and centred products by task, and these are combined by Spark for identity_error.

The driver holds matrices of width by width only. Vectors of another width are a space of their own, with a fit of
their own.

Defined cases: vectors that are null or hold a null or non-finite entry are left out; empty vectors have no component;
components whose eigenvalue isn't above what rounding leaves of zero (one vector, or equal ones) are left out, as
nothing can whiten them; an entry beyond 2**53 counts as 2**53; deviation is null where it passes 64 bits;
rows without an id, and rows that repeat one, are rows as others are; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import slices, stored, table

SCALE, OFFSET = 64, 1000000
COMPONENTS = 16
_MOST = 2.0**53
#: Halvings of a bracket after which its eigenvalues count as equal.
HALVINGS = 60
_PIVOT = (1 + 17**0.5) / 8


class Fit(NamedTuple):
    """Of the vectors of one width: their number, sums, eigenvalues, components (a row each) and trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector of rows whose vector has finite entries alone."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & ~odd)


def integers(rows: DataFrame) -> DataFrame:
    """rows with x, the entries as integers."""
    bounded = lambda c: F.least(F.greatest(F.floor(SCALE * c), F.lit(-int(_MOST))), F.lit(int(_MOST))) + OFFSET
    return rows.withColumn("x", F.transform("vector", bounded))


def _matrix(column: pa.Array) -> np.ndarray:
    """An array column whose rows have one width."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_width(batches: Iterable[pa.RecordBatch], column: str, rows: int = 2048) -> Iterator[tuple[np.ndarray, pa.RecordBatch, int]]:
    """Places, batch and width of the rows of each width."""
    for batch in slices(batches, rows):
        widths = np.array([len(x) for x in batch.column(column)], np.int64)
        for width in np.unique(widths[widths > 0]).tolist():
            at = np.flatnonzero(widths == width)
            yield at, batch.take(pa.array(at)), width


def _exact_products(y: np.ndarray) -> np.ndarray:
    """y' y in Python's integers. Products of doubles are exact while sums stay below 2**53."""
    most = int(np.abs(y).max(initial=0))
    step = int(_MOST // max(1, most * most))
    if step < 1:
        y = y.astype(object)
        return y.T @ y
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), step):
        part = y[at : at + step].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(fit_list: DataFrame, centres: dict[int, list[int]] | None = None) -> dict[int, tuple[int, dict[tuple[int, int], int]]]:
    """By width, the number of vectors and the sums of entries (i, i), or with centres those of products (i, j) with i <= j.

    Each task sums what it reads; the sums travel in two limbs of 64 bits, and the driver gets a number for each entry.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for at, batch, width in _by_width(batches, "x"):
            x = _matrix(batch.column("x"))
            part = x.sum(axis=0, dtype=object) if centres is None else _exact_products(x - np.array(centres[width], np.int64))
            n[width] = n.get(width, 0) + len(at)
            total[width] = total.get(width, 0) + part
        for width, sums in total.items():
            i, j = np.triu_indices(width) if sums.ndim == 2 else (np.arange(width),) * 2
            every = (sums[i, j] if sums.ndim == 2 else sums).tolist()
            limbs = [pa.array([Decimal(v) for v in x], pa.decimal128(38)) for x in ([v >> 64 for v in every], [v & (1 << 64) - 1 for v in every])]
            count = np.where((i == 0) & (j == 0), n[width], 0)
            columns = [pa.array(np.full(len(i), width), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(count, pa.int64()), *limbs]
            yield pa.RecordBatch.from_arrays(columns, names=["width", "i", "j", "n", "high", "low"])

    found = fit_list.mapInArrow(run, "width int, i int, j int, n long, high decimal(38, 0), low decimal(38, 0)")
    out: dict[int, tuple[int, dict]] = {}
    for r in found.groupBy("width", "i", "j").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).toLocalIterator():
        n, sums = out.get(r["width"], (0, {}))
        sums[r["i"], r["j"]] = (int(r["high"]) << 64) + int(r["low"])
        out[r["width"]] = (n + r["n"], sums)
    return out


def covariance(n: int, rest: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance, rounded once: of sums of y and of products of y, where y is x less an integer for each entry."""
    out = np.zeros((len(rest), len(rest)))
    for (i, j), p in products.items():
        out[i, j] = out[j, i] = float(Fraction(n * p - rest[i] * rest[j], n * n))
    return out


def above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a lie above the shift: the positive pivots of LDL' of a - shift, with pivots of one or two rows."""
    a = a - shift * np.eye(len(a))
    found = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        r = int(diagonal.argmax())
        p, q = divmod(int((size - np.diag(diagonal)).argmax()), len(a))
        if diagonal[r] >= _PIVOT * size[p, q] or len(a) == 1:
            if a[r, r] == 0:
                return found
            found += bool(a[r, r] > 0)
            others = np.arange(len(a)) != r
            column = a[others, r]
            a = a[np.ix_(others, others)] - np.outer(column, column / a[r, r])
        else:
            # a block whose determinant is negative: one eigenvalue of either sign
            found += 1
            others = np.ones(len(a), bool)
            others[[p, q]] = False
            columns = a[np.ix_(others, [p, q])]
            a = a[np.ix_(others, others)] - columns @ np.linalg.solve(a[np.ix_([p, q], [p, q])], columns.T)
        a = (a + a.T) / 2
    return found


def _solved(a: np.ndarray, shift: float, x: np.ndarray, nudge: float) -> np.ndarray:
    """A unit vector along (a - shift)^-1 x."""
    try:
        y = np.linalg.solve(a - shift * np.eye(len(a)), x)
    except np.linalg.LinAlgError:
        y = np.linalg.solve(a - (shift + nudge) * np.eye(len(a)), x)
    return y / np.linalg.norm(y)


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their vectors as rows; fewer if the rest is zero."""
    width = len(a)
    radius = np.abs(a).sum(axis=1) - np.abs(a.diagonal())
    scale = max(float((np.abs(a.diagonal()) + radius).max()), 1e-300)
    tiny = 4 * width * np.finfo(float).eps * scale
    top = float((a.diagonal() + radius).max()) + tiny
    counted = {top: 0, tiny: above(a, tiny)}  # what isn't above tiny is zero
    values, vectors = [], np.zeros((0, width))

    def bracket(j: int) -> tuple[float, float]:
        """The closest shifts that are counted with j or more above, and with fewer."""
        return max(s for s, n in counted.items() if n >= j), min(s for s, n in counted.items() if n < j)

    def halved(j: int) -> bool:
        low, high = bracket(j)
        middle = (low + high) / 2
        if high - low <= tiny or not low < middle < high:
            return False
        counted[middle] = above(a, middle)
        return True

    def apart(x: np.ndarray) -> np.ndarray:
        """x less what it has of the vectors found, taken off twice for rounding's sake."""
        for _ in range(2):
            x = x - vectors.T @ (vectors @ x)
        return x

    start = np.random.default_rng(5)
    for j in range(1, min(k, counted[tiny]) + 1):
        for _ in range(HALVINGS):
            low, high = bracket(j)
            if counted[low] - counted[high] == 1 or not halved(j):
                break
        while True:
            low, high = bracket(j)
            x = apart(start.normal(size=width))
            x = x / np.linalg.norm(x)
            shift = (low + high) / 2
            for step in range(12):
                x = apart(_solved(a, shift, x, tiny))
                x = x / np.linalg.norm(x)
                quotient = float(x @ a @ x)
                left = float(np.linalg.norm(a @ x - quotient * x))
                if left <= tiny:
                    break
                # two steps of inverse iteration turn x to the bracket's vector, then the quotient is the shift
                shift = quotient if step > 0 else shift
            certain = low - tiny <= quotient <= high + tiny and above(a, quotient - 2 * tiny) >= j and above(a, quotient + 2 * tiny) < j
            if (certain and left <= tiny) or not halved(j):
                break
        values.append(quotient)
        vectors = np.vstack([vectors, x])
    return np.array(values), vectors


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A fit for each width of the distinct vectors x."""
    sums = _sums(fit_list)
    centres = {w: [(2 * s[i, i] + n) // (2 * n) for i in range(w)] for w, (n, s) in sums.items()}
    out = {}
    for width, (n, products) in _sums(fit_list, centres).items() if sums else ():
        total = [sums[width][1][i, i] for i in range(width)]
        rest = [s - n * c for s, c in zip(total, centres[width], strict=True)]
        v = covariance(n, rest, products)
        values, vectors = leading(v, components)
        out[width] = Fit(n, total, values, vectors, float(np.trace(v)))
    return out


def _projected(x: np.ndarray, of: Fit) -> np.ndarray:
    """Whitened values, a column per component. The integer next to the mean is taken off first, exactly."""
    n = of.n
    centre = [(2 * s + n) // (2 * n) for s in of.sums]
    rest = np.array([float(Fraction(s - n * c, n)) for s, c in zip(of.sums, centre, strict=True)])
    return (((x - np.array(centre, np.int64)).astype(float) - rest) @ of.components.T) / np.sqrt(of.values)


def _deviations(x: np.ndarray, of: Fit) -> list[int | None]:
    """The sum over entries of (n * x - S)**2, exact; None beyond 64 bits."""
    most = max(max(abs(of.n * int(x.max()) - s), abs(of.n * int(x.min()) - s)) for s in of.sums)
    if most * most * x.shape[1] < 1 << 63 and of.n * int(np.abs(x).max()) < 1 << 63:
        y = of.n * x - np.array(of.sums, np.int64)
        return (y * y).sum(axis=1).tolist()
    y = of.n * x.astype(object) - np.array(of.sums, object)
    return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]


def identity_errors(fit_list: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """By width, the largest entry of the whitened fit list's covariance less the identity."""
    names = ["width", "i", "j", "n", "mean_i", "mean_j", "product"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for _, batch, width in _by_width(batches, "x"):
            if not len(fits[width].values):
                continue
            w = _projected(_matrix(batch.column("x")), fits[width])
            n, mean = len(w), w.mean(axis=0)
            product = (w - mean).T @ (w - mean)
            if width in held:
                n0, mean0, product0 = held[width]
                apart = mean - mean0
                product = product0 + product + np.outer(apart, apart) * (n0 * n / (n0 + n))
                mean, n = mean0 + apart * (n / (n0 + n)), n0 + n
            held[width] = (n, mean, product)
        for width, (n, mean, product) in held.items():
            i, j = np.triu_indices(len(mean))
            columns = [np.full(len(i), width), i, j, np.full(len(i), n), mean[i], mean[j], product[i, j]]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)

    # a row for each task and pair of components; combined as the tasks combined theirs
    parts = stored(fit_list.mapInArrow(run, "width int, i int, j int, n long, mean_i double, mean_j double, product double"), "parts")
    means = parts.groupBy("width", "i", "j").agg((F.sum(F.col("n") * F.col("mean_i")) / F.sum("n")).alias("mi"), (F.sum(F.col("n") * F.col("mean_j")) / F.sum("n")).alias("mj"))
    joined = parts.join(means, ["width", "i", "j"])
    product = F.sum(F.col("product") + F.col("n") * (F.col("mean_i") - F.col("mi")) * (F.col("mean_j") - F.col("mj"))) / F.sum("n")
    entries = joined.groupBy("width", "i", "j").agg(product.alias("v"))
    error = F.max(F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))
    return {r["width"]: r["error"] for r in entries.groupBy("width").agg(error.alias("error")).collect()}


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector and component."""
    rows = integers(usable(vectors, id_col, vector_col))
    fit_list = stored(rows.select("x").distinct(), "fit")
    fits = fit(fit_list, components)
    errors = identity_errors(fit_list, fits)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = rows.select("vec_id", *[F.lit(None).cast(k).alias(x) for x, k in zip(names[1:], ["int", "long", "long", "double", "double", "double"], strict=True)]).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, batch, width in _by_width(batches, "x"):
            of = fits[width]
            k = len(of.values)
            if not k:
                continue
            x = _matrix(batch.column("x"))
            columns = [
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(at)), k))),
                pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                pa.array(np.full(len(at) * k, of.n), pa.int64()),
                pa.array(_deviations(x, of), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                pa.array(_projected(x, of).reshape(-1), pa.float64()),
                pa.array(np.tile(of.values / of.trace, len(at)), pa.float64()),
                pa.array(np.full(len(at) * k, errors[width]), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select("vec_id", "x").mapInArrow(run, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("vec_id", F.col("vec_id").cast("long"))
