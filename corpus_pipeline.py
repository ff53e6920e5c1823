"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm import mixing, near_duplicates, packing, suffix_dedup, toxicity
from filmloom.llm.common import stored, table
from filmloom.llm.tokens import default_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = ("lang", "source", "n_chars")


def _with_absent(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.col("text").isNull().alias("absent"))


def _documents(rows: DataFrame) -> DataFrame:
    """The columns of documents; a text that was null is null again."""
    return rows.withColumn("text", F.when(~F.col("absent"), F.col("text"))).select(*COLUMNS)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples don't call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_with_absent(docs), model, *OTHERS, "absent")
    return _documents(scored.where("predicted = 0"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike by 0.8 or more."""
    result = near_duplicates.near_duplicates(docs)
    dropped = result.where(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes that start earlier in the corpus; n_chars follows the text."""
    rows = suffix_dedup.remove_repeats(_with_absent(docs), 100, "lang", "source", "absent", as_text=True).withColumnRenamed("kept", "text")
    return _documents(rows.withColumn("n_chars", F.length("text").cast("long")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the schedule takes of each document, a row per round of its source.

    Whole documents stay as they are; one that a target cuts keeps the words that are taken, a space between two.
    Rows that repeat a doc_id, or are equal, take their parts each; documents without words are never taken.
    """
    docs = mixing.numbered(docs.select(*COLUMNS))
    sizes = stored(mixing.sized(docs), "sizes")
    per = stored(mixing.targets(sizes), "targets")
    rows = mixing.mix(sizes, per).groupBy(*mixing.ROW, "round", "size").agg(F.min("start").alias("start"), F.sum("length").alias("length"))
    rows = rows.withColumnsRenamed({x: f"{x}_" for x in mixing.ROW})
    same = [F.col(x).eqNullSafe(F.col(f"{x}_")) for x in mixing.ROW]
    joined = docs.join(rows, same[0] & same[1] & same[2] & same[3])
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    part = F.array_join(F.slice(words, (F.col("start") + 1).cast("int"), F.col("length").cast("int")), " ")
    text = F.when(F.col("length") == F.col("size"), F.col("text")).otherwise(part)
    out = joined.select("doc_id", text.alias("text"), "lang", "source")
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, default_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("suffix_dedup", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can't express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
