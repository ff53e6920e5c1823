"""Mixing sources to target weights by a low-discrepancy schedule.

A source has as many slots of the schedule as its target has blocks, and the numbers from 0 to all blocks are dealt to
the sources by cumulative weight. Number v stands in slot van_der_corput(v), its bits reversed: so any stretch of slots
holds each source in proportion, and a source of one block has exactly one slot. The r-th slot of a source takes block r
of its shuffled documents, laid end to end and cut to blocks of equal size; when the blocks run out they start over. A
source's last block is cut at its target, so that what is taken is the whole part of the target.

Documents of a source are shuffled by md5 of doc_id. Their places come from two sums: over the first three digits of
the md5, and within one such bucket; a source with most of the rows is spread over 4096 buckets. Slots are made of
each source's numbers, by stretches that are dealt to all tasks, and ranked by stretches likewise. Tables of a row per
source (weights, targets) are ordered in one task; Spark broadcasts them only where its own size threshold allows.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, last in order;
documents without doc_id count like any other; rows that repeat a doc_id are kept apart, by a hash of the text, and by a
number where that is equal too; an empty table gives no row, and sources of size 0 get target 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmloom.llm.common import stored, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK = 1024
STRETCH = 1024
WORD = r"[^\x20\x09-\x0D]+"


#: What tells the rows of a table apart.
ROW = ("doc_id", "source", "tie", "copy")


def numbered(docs: DataFrame) -> DataFrame:
    """docs with `tie`, a hash of the text, and `copy`, the number of a row among those of equal doc_id, source and text."""
    rows = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "tie": F.xxhash64(F.coalesce("text", F.lit("")))})
    if not rows.groupBy("doc_id").count().where("count > 1").take(1):
        return rows.withColumn("copy", F.lit(0))
    order = Window.partitionBy("doc_id", "source", "tie").orderBy(*[x for x in ("lang", "n_chars") if x in docs.columns] or ["doc_id"])
    return rows.withColumn("copy", F.row_number().over(order) - 1)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, tie, copy, size in words, and `place`, the md5 that shuffles."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return numbered(docs).select(*ROW, size.alias("size"), place.alias("place"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """A row per source: source_size, weight, target.

    Shares are given by weight; a source that would pass cap times its size stops there and its excess goes to the
    others. With sources ordered by size over weight, those before some point are full and the rest share by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (k + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, whole = ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(whole) * F.lit(share)
    full = F.coalesce(F.sum("most").over(upto), F.lit(0.0))
    weights_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    per = per.withColumn("level", (total - full) / weights_left)
    per = per.withColumn("open", F.col("level") * F.col("weight") < F.col("most"))
    # the level of the first source that isn't full holds for all that follow
    level = F.min(F.when(F.col("open"), F.struct((F.col("most") / F.col("weight")).alias("at"), "level"))).over(whole)
    target = F.coalesce(F.least(F.col("most"), level["level"] * F.col("weight")), F.col("most"))
    return per.select("source", "source_size", "weight", target.alias("target"))


def schedule(per_source: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, source, source_size, goal (words to take) and rank (the slot's number among those of its source)."""
    goal = F.floor("target").cast("long")
    shares = per_source.where(goal > 0).select("source", "source_size", goal.alias("goal"), F.ceil(goal / block).cast("long").alias("blocks"))
    order = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    shares = shares.withColumn("high", F.sum("blocks").over(order)).withColumn("all", F.sum("blocks").over(Window.partitionBy()))
    shares = shares.withColumn("low", F.col("high") - F.col("blocks"))
    bits = F.greatest(F.ceil(F.log2("all")).cast("int"), F.lit(1))
    # a source's numbers by stretches, which are dealt to all tasks before they are written out
    upto = lambda a, b: F.explode(F.sequence(a, b))
    parts = shares.select("source", "source_size", "goal", "low", "high", bits.alias("bits"), upto(F.floor(F.col("low") / STRETCH), F.floor((F.col("high") - 1) / STRETCH)).alias("part"))
    parts = parts.repartition("part", "source")
    first, last = F.greatest("low", F.col("part") * STRETCH), F.least(F.col("high"), (F.col("part") + 1) * STRETCH) - 1
    slots = parts.select("source", "source_size", "goal", "bits", upto(first, last).alias("number"))
    # van der Corput: the bits of the number, reversed
    slot = F.conv(F.reverse(F.lpad(F.bin("number"), F.col("bits"), F.lit("0"))), 2, 10).cast("long")
    slots = slots.select(slot.alias("slot"), "source", "source_size", "goal").withColumn("stretch", F.floor(F.col("slot") / STRETCH))
    counts = slots.groupBy("source", "stretch").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("source", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "stretch").orderBy("slot")
    ranked = slots.withColumn("within", F.row_number().over(within) - 1)
    same = ranked["source"].eqNullSafe(counts["source"]) & (ranked["stretch"] == counts["stretch"])
    return ranked.join(counts, same).select("slot", ranked["source"], "source_size", "goal", (F.col("within") + F.col("base")).alias("rank"))


def laid_out(sizes: DataFrame) -> DataFrame:
    """Each document's `begin` among the words of its source, in shuffled order."""
    docs = sizes.withColumn("bucket", F.substring("place", 1, 3))
    counts = docs.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("source").alias("of"), F.col("bucket").alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size", "tie", "copy").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    docs = docs.join(counts, docs["source"].eqNullSafe(counts["of"]) & (docs["bucket"] == counts["at"]))
    return docs.withColumn("begin", F.col("inner") + F.col("base")).drop("of", "at", "bucket", "base", "inner")


def mix(sizes: DataFrame, per_source: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, round, the row (doc_id, source, tie, copy), its size, start and length: the words that each slot takes of it.

    A slot's block may run over the end of a source into its next round.
    """
    slots = schedule(per_source, block)
    begin = F.col("rank") * block
    end = F.least(begin + block, F.col("goal"))
    # rounds that a block touches, and in each its stretch of the source
    rounds = F.explode(F.sequence(F.floor(begin / F.col("source_size")), F.floor((end - 1) / F.col("source_size"))))
    slots = slots.select("slot", "source", begin.alias("b"), end.alias("e"), "source_size", rounds.alias("round"))
    offset = F.col("round") * F.col("source_size")
    slots = slots.select(
        "slot", "source", "round",
        F.greatest(F.col("b") - offset, F.lit(0)).alias("low"), F.least(F.col("e") - offset, "source_size").alias("high"),
    )
    stretch = lambda a, b: F.explode(F.sequence(F.floor(a / block), F.floor((b - 1) / block)))
    slots = slots.withColumn("cell", stretch(F.col("low"), F.col("high"))).withColumnRenamed("source", "of")
    docs = laid_out(sizes).where("size > 0").withColumn("at", stretch(F.col("begin"), F.col("begin") + F.col("size")))
    joined = slots.join(docs, F.col("of").eqNullSafe(F.col("source")) & (F.col("cell") == F.col("at")))
    low = F.greatest("low", "begin", F.col("cell") * block)
    high = F.least("high", F.col("begin") + F.col("size"), (F.col("cell") + 1) * block)
    return joined.where(low < high).select("slot", "round", *ROW, "size", (low - F.col("begin")).alias("start"), (high - low).alias("length"))


def taken(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every document with its source's size and target, and the words of it that the mix takes."""
    per = stored(targets(sizes), "targets")
    got = mix(sizes, per, block).groupBy(*ROW).agg(F.sum("length").alias("taken"))
    got = got.select(*[F.col(x).alias(f"{x}_") for x in ROW], "taken")
    same = [F.col(x).eqNullSafe(F.col(f"{x}_")) for x in ROW]
    docs = sizes.join(got, same[0] & same[1] & same[2] & same[3], "left")
    docs = docs.join(per.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return docs.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the texts are read once; all that follows works on sizes
    return taken(stored(sized(table(spark, sf_dir, "documents")), "sizes"))
