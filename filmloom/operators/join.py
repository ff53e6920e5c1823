"""Joins of parents, children and known keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.sources.shared import kept


def parent_child(parents: DataFrame, children: DataFrame, on: Column, columns: list[Column], order: list[Column] | None = None) -> DataFrame:
    rows = parents.join(children, on).select(*columns)
    return rows.orderBy(*order) if order else rows


def one_child(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, value: str, order: Column) -> DataFrame:
    """Every parent with the first of its children's values by an order; aggregated before the join."""
    first = children.groupBy(F.col(child_key).alias("_k")).agg(F.min_by(value, order).alias(value))
    return parents.join(first, F.col(parent_key) == F.col("_k"), "left").drop("_k")


def new_only(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't known. Only the keys of known are read, once each."""
    return rows.join(known.select(*keys).distinct(), keys, "left_anti")


def known_in(rows: DataFrame, key: str, *tables: tuple[DataFrame, str]) -> DataFrame:
    """Rows whose key stands in any of the tables."""
    every = None
    for df, c in tables:
        part = df.select(F.col(c).alias(key))
        every = part if every is None else every.union(part)
    return rows.join(every.distinct(), key, "left_semi")


def refresh_plan(rows: DataFrame, complete: DataFrame, key: str, flag: str) -> DataFrame:
    """action: skip what is known and complete, refetch what is known and incomplete, fetch the rest.

    A key is complete if any of its rows is.
    """
    joined = rows.join(complete.groupBy(key).agg(F.max(flag).alias(flag)), key, "left")
    action = F.when(F.col(flag), "skip").when(F.col(flag).isNotNull(), "refetch").otherwise("new")
    return joined.withColumn("action", action).drop(flag)


def in_ranges(rows: DataFrame, *order: str) -> DataFrame:
    """rows with range and place, the number from 0 of each row in its range, kept in the shared folder.

    Spark draws the ranges' borders from a sample of the whole order, so neither a common beginning nor one frequent
    value makes a large range as long as the last column of the order tells its rows apart.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the id has the partition in its upper bits and counts the sorted rows in the lower 33
    dealt = kept(dealt.withColumn("_m", F.monotonically_increasing_id()), "ranges")
    return dealt.withColumn("range", F.shiftright("_m", 33)).withColumn("place", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m")


def surrogate_ids(rows: DataFrame, key: str, natural: str, name: str) -> DataFrame:
    """key and dense ids from 1 in order of the natural key and the key: places in ranges, behind the rows of the ranges before."""
    dealt = in_ranges(rows.select(key, natural), natural, key)
    # a row per range, of which there are as many as shuffle partitions
    per = dealt.groupBy("range").agg(F.count("*").alias("_k"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("range", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base"))
    return dealt.join(F.broadcast(per), "range").select(key, (F.col("_base") + F.col("place") + 1).alias(name))


def remaining(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return tasks.join(done.select(*keys).distinct(), keys, "left_anti")


def replace_lines(lines: DataFrame, fixes: DataFrame, keys: list[str], text: str = "text", *order: str) -> DataFrame:
    """Lines with the text that a dictionary has for their place, the last of several."""
    last = F.max_by(text, F.struct(*order, text)) if order else F.max(text)
    f = fixes.groupBy(*keys).agg(last.alias("_new"))
    return lines.join(f, keys, "left").withColumn(text, F.coalesce("_new", text)).drop("_new")
