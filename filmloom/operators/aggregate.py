"""Counts, profiles and watermarks of catalog tables and crawl logs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.sources.shared import kept

def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.union, parts)


def key_counts(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct(key) if approximate else F.countDistinct(key)
    return df.agg(F.count("*").alias("total"), distinct.alias("distinct_keys"))


def counts_by(df: DataFrame, *keys: str, top: int | None = None, largest_first: bool = False) -> DataFrame:
    rows = df.groupBy(*keys).agg(F.count("*").alias("n"))
    if top is not None or largest_first:
        rows = rows.orderBy(F.desc("n"), *keys)
    return rows if top is None else rows.limit(top)


#: Keys that the sketch of frequent ones may hold, at most.
TRACKED = 10000


def top_groups(df: DataFrame, *keys: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """The n largest groups and their exact counts, largest first, ties by key, without a shuffle of all keys.

    A mergeable sketch of frequent items names candidates: what is shuffled is a sketch of at most `tracked` keys a task.
    Candidates are then counted exactly. A key that isn't one stands in less than 7 / tracked of the rows (the sketch's
    bound is 3.5 / tracked for what it loses, and as much again for what it holds but can't be sure of). So where the
    last of the n stands more often, or the candidates are all rows, the top is proven; else every key is counted.
    """
    rows = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    asked = rows.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(_h, {tracked}, {tracked})").alias("top")).first()
    hot = df.sparkSession.createDataFrame([(x["item"],) for x in asked["top"] or []], "_h long")
    counted = rows.join(F.broadcast(hot), "_h", "left_semi").groupBy(*keys).agg(F.count("*").alias("n"))
    # all that is counted, and its n largest groups: n rows
    exact = kept(counted, "candidates")
    best = exact.orderBy(F.desc("n"), *keys).limit(n).collect()
    covered = exact.agg(F.sum("n")).first()[0] or 0
    if covered == asked["n"] or (len(best) == n and best[-1]["n"] > 7 * asked["n"] / tracked):
        return exact.orderBy(F.desc("n"), *keys).limit(n)
    return counts_by(df, *keys, top=n)


def average(c: str, positive_only: bool = False) -> Column:
    """The mean without NULLs, rounded to 2; 0 if there is none."""
    x = F.when(F.col(c) > 0, F.col(c)) if positive_only else F.col(c)
    return F.coalesce(F.round(F.avg(x), 2), F.lit(0.0))


def empty_profile(df: DataFrame) -> DataFrame:
    """column_name, n_empty and percent: NULL or blank values of every column, in one pass."""
    made = [F.sum(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), 1).otherwise(0)).alias(c) for c in df.columns]
    one = df.agg(F.count("*").alias("_n"), *made)
    long = one.unpivot(["_n"], df.columns, "column_name", "n_empty")
    return long.select("column_name", "n_empty", F.round(100.0 * F.col("n_empty") / F.greatest("_n", F.lit(1)), 2).alias("percent"))


def total_episodes(df: DataFrame, series: str, source: str) -> DataFrame:
    per = df.groupBy(series, source).agg(F.count("*").alias("n"))
    return per.groupBy(series).agg(F.max("n").alias("total_episodes"))


def completeness(df: DataFrame, key: str, *texts: str) -> DataFrame:
    """Whether a group has any non-empty value in every one of the columns."""
    rows = df.groupBy(key).agg(*[F.max(x).alias(f"_{x}") for x in texts])
    whole = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"_{x}") != "", F.lit(False)) for x in texts])
    return rows.select(key, whole.alias("is_complete"))


def percent(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / F.greatest(whole, F.lit(1)), 2)


def log_totals(df: DataFrame, failed: Column, key: str, time: str) -> DataFrame:
    """requests, failures, unique keys, duplicates and mean time."""
    return df.agg(
        F.count("*").alias("requests"), F.count_if(failed).alias("failures"), F.countDistinct(key).alias("unique_ids"),
        (F.count(key) - F.countDistinct(key)).alias("duplicates"), F.round(F.avg(time), 4).alias("mean_time"),
    )


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """bin and n over equal bins from the least to the largest value; the edges are one row, joined by broadcast."""
    edges = df.agg(F.min(c).alias("_low"), F.max(c).alias("_high"))
    width = (F.col("_high") - F.col("_low")) / bins
    place = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col(c) - F.col("_low")) / width), F.lit(bins - 1)))
    return df.where(F.col(c).isNotNull()).join(F.broadcast(edges)).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))


#: Values that the last step of an exact quantile takes to the driver, at most.
FEW = 4096
#: Accuracy of the sketch: its ranks are off by one part in so many.
ACCURACY = 10000


def exact_percentile(df: DataFrame, c: str, percent: int) -> DataFrame:
    """The value at place int(n * p / 100) of the sorted list, without a sort; no row for an empty list."""
    found = values_at(df, c, lambda n: [min(n * percent // 100, n - 1)])
    return _row(df, c, {f"p{percent}": found[0]} if found else None, [f"p{percent}"])


def exact_median(df: DataFrame, c: str) -> DataFrame:
    """The middle value, or the mean of the two in the middle, without a sort; null for an empty list."""
    found = values_at(df, c, lambda n: [(n - 1) // 2, n // 2])
    return _row(df, c, {"median": _middle(found) if found else None}, ["median"]).withColumn("median", F.col("median").cast("double"))


def latency_profile(df: DataFrame, c: str, percent: int) -> DataFrame:
    """median and p<percent> by the same passes; one row."""
    found = values_at(df, c, lambda n: [(n - 1) // 2, n // 2, min(n * percent // 100, n - 1)])
    return _row(df, c, {"median": _middle(found[:2]) if found else None, f"p{percent}": found[2] if found else None}, ["median", f"p{percent}"])


def _middle(two: list) -> float:
    return two[0] if two[0] == two[1] else (two[0] + two[1]) / 2


def _row(df: DataFrame, c: str, values: dict | None, names: list[str]) -> DataFrame:
    kind = dict(df.dtypes)[c]
    return df.sparkSession.createDataFrame([tuple(values[x] for x in names)] if values else [], ", ".join(f"{x} {'double' if x == 'median' else kind}" for x in names))


def values_at(df: DataFrame, c: str, places: Callable[[int], list[int]], seen: list[int] | None = None) -> list:
    """The values at places (from 0) of the sorted column, nulls left out; places is asked with their number.

    A mergeable quantile sketch names two values around each place. Exact counts tell whether the place lies before,
    at, between or behind them, and the next pass looks there alone: between them lie a few parts of ACCURACY of what
    the pass read, however the values are spread, and a value that is frequent is found as a border. No row is
    shuffled; what is left of FEW values or less goes to the driver, counted. seen gets the size of each stretch left.
    """
    rows = df.select(F.col(c).alias("v")).where(F.col("v").isNotNull())
    n = rows.count()
    if not n:
        return []
    wanted = places(n)
    found: dict[int, object] = {}
    # stretches between two values (None: open), what lies before them, their size and the places wanted there
    open_: dict[tuple, tuple[int, int, list[int]]] = {(None, None): (0, n, sorted(set(wanted)))}
    while open_:
        small = {k: x for k, x in open_.items() if x[1] <= FEW}
        for (low, high), (before, _, ranks) in small.items():
            at = before
            for v, k in sorted((r["v"], r["k"]) for r in rows.where(_between(low, high)).groupBy("v").agg(F.count("*").alias("k")).collect()):
                found |= {r: v for r in ranks if at <= r < at + k}
                at += k
        open_ = _narrowed(rows, {k: x for k, x in open_.items() if k not in small}, found)
        if seen is not None:
            seen.extend(x[1] for x in open_.values())
    return [found[r] for r in wanted]


def _between(low: object, high: object) -> Column:
    above = F.lit(True) if low is None else F.col("v") > F.lit(low)
    return above if high is None else above & (F.col("v") < F.lit(high))


def _narrowed(rows: DataFrame, open_: dict[tuple, tuple[int, int, list[int]]], found: dict[int, object]) -> dict[tuple, tuple[int, int, list[int]]]:
    """One sketch and one count of all open stretches: values found go to found, what is still open is returned."""
    if not open_:
        return {}
    asked = []
    for (low, high), (before, size, ranks) in open_.items():
        shares = [min(1.0, max(0.0, (r - before + 0.5) / size + d * 2 / ACCURACY)) for r in ranks for d in (-1, 1)]
        inside = F.when(_between(low, high), F.col("v"))
        asked.append(F.percentile_approx(inside, F.array(*[F.lit(x) for x in shares]), ACCURACY))
    borders = [sorted(set(x)) for x in rows.agg(*[x.alias(f"s{i}") for i, x in enumerate(asked)]).first()]
    counts = []
    for (low, high), values in zip(open_, borders, strict=True):
        counts += [F.count_if(_between(low, high) & (F.col("v") < F.lit(x))) for x in values] + [F.count_if(F.col("v") == F.lit(x)) for x in values]
    told = iter(rows.agg(*[x.alias(f"c{i}") for i, x in enumerate(counts)]).first())
    left: dict[tuple, tuple[int, int, list[int]]] = {}
    for ((low, high), (before, size, ranks)), values in zip(open_.items(), borders, strict=True):
        less = [before + next(told) for _ in values]
        equal = [next(told) for _ in values]
        edges = [(low, before), *((v, k + e) for v, k, e in zip(values, less, equal, strict=True))]
        ends = [*less, before + size]
        for r in ranks:
            at = [i for i, (k, e) in enumerate(zip(less, equal, strict=True)) if k <= r < k + e]
            if at:
                found[r] = values[at[0]]
                continue
            i = max(i for i, (_, first) in enumerate(edges) if first <= r)
            key = (edges[i][0], values[i] if i < len(values) else high)
            left.setdefault(key, (edges[i][1], ends[i] - edges[i][1], []))[2].append(r)
    return left


def range_profile(df: DataFrame, number: Column, low: int, high: int, top: str) -> DataFrame:
    """The least and largest number, how many lie outside of a range, and the largest value of a column."""
    return df.agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count_if(~number.between(low, high)).alias("outside"), F.max(top).alias("top"))


def outcome_counts(df: DataFrame, key: str, passed: Column, value: str, order: str) -> DataFrame:
    """By key, how many passed and failed, and the last value."""
    return df.groupBy(key).agg(F.count_if(passed).alias("passed"), F.count_if(~passed).alias("failed"), F.max_by(value, order).alias("last_total"))


def high_water(ledger: DataFrame, condition: Column, at: str) -> DataFrame:
    """The last export that counts, 1970 if there is none: one row."""
    return ledger.agg(F.coalesce(F.max(F.when(condition, F.col(at))), F.to_timestamp(F.lit("1970-01-01 00:00:00"))).alias("watermark"))


def since(df: DataFrame, mark: DataFrame, *times: str, inclusive: bool = False) -> DataFrame:
    """Rows of which any time is past the watermark, a one-row frame."""
    late = reduce(lambda a, b: a | b, [(F.col(t) >= F.col("watermark")) if inclusive else (F.col(t) > F.col("watermark")) for t in times])
    return df.join(F.broadcast(mark), late).drop("watermark")


def resume_pages(progress: DataFrame, keys: list[str], page: str, done: Column) -> DataFrame:
    return progress.groupBy(*keys).agg((F.coalesce(F.max(F.when(done, F.col(page))), F.lit(0)) + 1).alias("next_page"))


def verification(df: DataFrame, category: str, valid: Column, gate: float) -> DataFrame:
    """Tallies by category and overall (NULL category), with the share and whether it passes the gate."""
    rows = df.rollup(category).agg(F.count("*").alias("total"), F.count_if(valid).alias("valid"))
    share = F.col("valid") / F.col("total")
    return rows.select(category, "total", "valid", (F.col("total") - F.col("valid")).alias("invalid"), F.round(100.0 * share, 2).alias("percent"), (share >= gate).alias("passed"))
