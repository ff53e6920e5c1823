"""Operators with one hot key, one outlier or one file: the same rows as without, over many tasks."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from filmloom.operators import aggregate, join, window
from filmloom.sources.shared import release


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("kind", ["one beginning", "random", "one value"])
def test_dense_ids_spread(spark, kind):
    """Long common beginnings, random keys and one frequent value: ranges of like size, ids in order."""
    value = {"one beginning": "concat('https://host.example/movies/title/', id)", "random": "md5(cast(id as string))", "one value": "if(id % 10 < 7, 'same', cast(id as string))"}[kind]
    rows = spark.range(40000).selectExpr("id", f"{value} as url")
    dealt = join.in_ranges(rows, "url", "id").groupBy("range").count().collect()
    assert len(dealt) >= 4 and max(r["count"] for r in dealt) < 1.5 * 40000 / len(dealt)
    got = join.surrogate_ids(rows, "id", "url", "n").collect()
    order = sorted(rows.collect(), key=lambda r: (r.url, r.id))
    assert {r.id: r.n for r in got} == {r.id: i for i, r in enumerate(order, 1)}
    release(spark)


def test_dense_ids_of_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, "b"), (3, None), (4, "a")], "id long, url string")
    assert plain(join.surrogate_ids(rows, "id", "url", "n")) == [(1, 1), (2, 4), (3, 2), (4, 3)]
    assert join.surrogate_ids(rows.limit(0), "id", "url", "n").count() == 0


def numbers(kind, n, seed=3):
    rng = random.Random(seed)
    return {
        "outlier": lambda: [rng.random() for _ in range(n)] + [1e12], "heavy tail": lambda: [rng.paretovariate(0.3) for _ in range(n)],
        "few values": lambda: [float(rng.randrange(3)) for _ in range(n)], "one value": lambda: [2.5] * n, "signed": lambda: [rng.gauss(0, 1e9) for _ in range(n)],
    }[kind]()


@pytest.mark.parametrize("kind", ["outlier", "heavy tail", "few values", "one value", "signed"])
@pytest.mark.parametrize("few", [1, 4096])
def test_exact_quantiles(spark, monkeypatch, kind, few):
    monkeypatch.setattr(aggregate, "FEW", few)
    values = numbers(kind, 20000)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    order, n = sorted(values), len(values)
    left = []
    got = aggregate.values_at(df, "v", lambda k: [0, k // 3, k // 2, int(k * 0.95), k - 1], left)
    assert got == [order[i] for i in (0, n // 3, n // 2, int(n * 0.95), n - 1)]
    # no stretch that a pass leaves has more than a hundredth of the rows
    assert max(left, default=0) <= n / 100
    assert aggregate.exact_percentile(df, "v", 95).first()[0] == order[min(n * 95 // 100, n - 1)]
    assert aggregate.exact_median(df, "v").first()[0] == (order[(n - 1) // 2] + order[n // 2]) / 2


def test_quantiles_of_little(spark):
    df = spark.createDataFrame([(None,), (3,), (1,)], "v int")
    assert aggregate.exact_median(df, "v").first()[0] == 2.0 and aggregate.exact_percentile(df, "v", 50).first()[0] == 3
    none = df.where("v > 5")
    assert aggregate.exact_median(none, "v").first()[0] is None and aggregate.exact_percentile(none, "v", 50).count() == 0
    assert tuple(aggregate.latency_profile(df, "v", 95).first()) == (2.0, 3)


def test_quantiles_move_no_row(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 1.0)
    plan = df.agg(F.percentile_approx("v", 0.5, aggregate.ACCURACY))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def seconds_of(n, span, seed=5):
    rng, start = random.Random(seed), datetime.datetime(2024, 1, 1)
    return [(i, "hot" if rng.random() < 0.95 else rng.choice(["a", None]), start + datetime.timedelta(seconds=rng.randrange(span), milliseconds=rng.randrange(1000)), rng.choice([None, 1.0, 2.5, -3.0])) for i in range(n)]


@pytest.mark.parametrize("length", [1, 60, 3600])
def test_trailing_metrics_of_a_hot_group(spark, length):
    rows = seconds_of(1500, 20000)
    df = spark.createDataFrame([*rows, (-1, "hot", None, 1.0)], "id long, g string, ts timestamp, v double").repartition(4)
    asked = {"n": ("count", None), "k": ("count", "v"), "total": ("sum", "v"), "mean": ("mean", "v"), "least": ("min", "v"), "most": ("max", "v")}
    got = {r.id: r for r in window.trailing_metrics(df, "g", "ts", length, asked).collect()}
    assert len(got) == len(rows) + 1 and got[-1].n is None or got[-1].n == 1
    at = {i: int(t.timestamp()) for i, _, t, _ in rows}
    for i, g, _, _ in rows[::7]:
        mine = [v for j, h, _, v in rows if h == g and at[i] - length <= at[j] <= at[i]]
        there = [v for v in mine if v is not None]
        r = got[i]
        assert (r.n, r.k, r.total, r.least, r.most) == (len(mine), len(there), sum(there) if there else None, min(there, default=None), max(there, default=None))
        assert r["mean"] == (pytest.approx(sum(there) / len(there)) if there else None)


def test_trailing_partitions_are_bounded(spark):
    """One group with all rows: no window sees more than its chunk's seconds."""
    df = spark.range(200000).selectExpr("id", "'hot' as g", "timestamp_seconds(1700000000 + id % 100000) as ts")
    got = window.trailing_metrics(df, "g", "ts", 10, {"n": ("count", None)})
    assert got.groupBy("n").count().orderBy("n").tail(1)[0].n == 22
    plan = got._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "Window [" in x)
    assert "_c#" in line.rsplit("], [", 2)[-2]


def test_trailing_work_is_a_few_rows_a_second(spark):
    """No frame that slides, whose rows Spark adds up anew for each row; times before 1970, no time, and an outlier that passes."""
    df = spark.range(5000).selectExpr("id", "id % 2 as g", "if(id % 100 = 7, null, timestamp_seconds(id * 3 - 7000)) as ts", "if(id = 1000, 1e18, id % 10 + 0.1) as v")
    asked = {"n": ("count", None), "total": ("sum", "v"), "least": ("min", "v")}
    got = window.trailing_metrics(df, "g", "ts", 100, asked)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "RangeFrame" not in plan and plan.count("RowFrame, unboundedpreceding") >= 3
    w = Window.partitionBy("g").orderBy(F.unix_timestamp("ts")).rangeBetween(-100, 0)
    want = df.select("*", F.count("*").over(w).alias("n"), F.sum("v").over(w).alias("total"), F.min("v").over(w).alias("least"))
    a, b = ([tuple(r) for r in x.orderBy("id").select("id", "n", F.expr("round(if(total > 1e17, 1e18, total), 6)"), "least").collect()] for x in (got, want))
    assert a == b


def blocks_by_hand(lines):
    out, block, inside = [], 0, []
    for x in [*lines, ""]:
        if x.strip() == "":
            if inside:
                out.append((block, len(inside), *[inside[i] if i < len(inside) else None for i in range(4)]))
            block, inside = block + 1, []
        else:
            inside.append(x)
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1 << 16])
def test_blocks_over_chunks(spark, monkeypatch, size):
    monkeypatch.setattr(window, "LINES", size)
    rng = random.Random(size)
    files = {f: [rng.choice(["", " ", "a", "b", "the c", "d"]) for _ in range(60)] for f in ("x", "y")} | {"none": [""] * 9, "whole": [str(i) for i in range(40)]}
    df = spark.createDataFrame([(f, i + 1, x) for f, lines in files.items() for i, x in enumerate(lines)], "f string, n int, x string").repartition(5)
    got = plain(window.line_blocks(df, "f", "n", "x"))
    assert got == sorted(((f, *b) for f, lines in files.items() for b in blocks_by_hand(lines)), key=repr)
    previous = plain(window.previous_line(df, "f", "n", "x", "the"))
    assert previous == sorted(((f, i + 1, x, lines[i - 1] if i else None) for f, lines in files.items() for i, x in enumerate(lines) if "the" in x), key=repr)


def test_one_file_is_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(window, "LINES", 100)
    df = spark.range(5000).selectExpr("'one' as f", "id as n", "if(id % 50 = 0, '', concat('l', id)) as x")
    inner = window._in_chunks(df, "n").repartition(16, "f", "_c").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(inner) > 8 and max(r["count"] for r in inner) < 1500
    assert window.line_blocks(df, "f", "n", "x").count() == 100


def test_lines_without_text(spark):
    df = spark.createDataFrame([("f", 1, "a"), ("f", 2, None), ("f", 3, "b"), (None, 1, "c")], "f string, n int, x string")
    assert plain(window.line_blocks(df, "f", "n", "x")) == [("f", 0, 2, "a", "b", None, None), (None, 0, 1, "c", None, None, None)]
    assert window.line_blocks(df.limit(0), "f", "n", "x").count() == 0
