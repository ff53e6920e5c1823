"""Checks of catalog tables, each as a query with the reason or the count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmloom.functions.values import has_cjk, is_placeholder
from filmloom.functions.keywords import keyword_hits
from filmloom.operators.window import line_blocks


def schema_differences(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """column_name and problem: missing, extra, or another type. The schema is metadata; df's rows aren't read."""
    have = dict(df.dtypes)
    found = [(c, "missing") for c in expected if c not in have]
    found += [(c, "extra") for c in have if c not in expected]
    found += [(c, f"{have[c]} instead of {k}") for c, k in expected.items() if c in have and have[c] != k]
    return df.sparkSession.createDataFrame(found, "column_name string, problem string")


def value_mismatches(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """column_name, kind, n_values and n_bad of each expected column: its values, and those whose text isn't one of the kind. One pass over the rows."""
    have, made = set(df.columns), []
    for c, kind in expected.items():
        value = F.col(c) if c in have else F.lit(None)
        bad = value.isNotNull() & value.cast("string").try_cast(kind).isNull()
        made.append(F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"), F.count(value).alias("n_values"), F.count_if(bad).alias("n_bad")))
    return df.agg(F.array(*made).alias("rows")).select(F.inline("rows"))


def column_difference(df: DataFrame, expected: list[str]) -> DataFrame:
    """column_name, side and n_values: expected columns that df lacks, and columns of df that aren't expected, with how many values they hold.

    An extra column without a value is no difference: it is left out.
    """
    have = df.columns
    lost = [F.struct(F.lit(c).alias("column_name"), F.lit("missing").alias("side"), F.lit(0).cast("long").alias("n_values")) for c in expected if c not in have]
    more = [F.struct(F.lit(c).alias("column_name"), F.lit("extra").alias("side"), F.count(c).alias("n_values")) for c in have if c not in expected]
    if not lost + more:
        return df.sparkSession.createDataFrame([], "column_name string, side string, n_values long")
    return df.agg(F.array(*lost, *more).alias("rows")).select(F.inline("rows")).where("side = 'missing' or n_values > 0")


def empty(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def mandatory(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(empty(F.col(c))).alias(f"{c}_empty") for c in columns], F.count("*").alias("total"))


def format_share(df: DataFrame, condition: Column) -> DataFrame:
    valid = F.count_if(condition)
    return df.agg(F.count("*").alias("total"), valid.alias("valid"), F.round(100.0 * valid / F.greatest(F.count("*"), F.lit(1)), 2).alias("percent"))


def minimum_rows(tables: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n", (F.col("n") >= n).alias("passed")) for t, (df, n) in tables.items()]
    return reduce(DataFrame.union, parts)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """total, unique and repeated_ids, by counts of each key."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.agg(F.sum("n").alias("total"), F.count("*").alias("unique_keys"), F.count_if(F.col("n") > 1).alias("repeated_ids"))


def most_repeated(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), key).limit(n)


def validate_items(df: DataFrame, required: list[str], key: str, content: Column, order: list[str], rules: list[tuple[Column, str]] = ()) -> DataFrame:
    """valid and reason: a missing field, a repeated id, a repeated content, then own rules; the first reason wins.

    Only rows that pass a test enter the next one.
    """
    missing = F.coalesce(F.lit(None).cast("string"), *[F.when(empty(F.col(c)) | (F.col(c).cast("string") == "0"), F.lit(f"missing {c}")) for c in required])
    rows = df.withColumn("_missing", missing).withColumn("_content", F.md5(content.cast("string")))
    # rows that failed are in windows of their own, so that they don't meet
    alone = F.xxhash64(*df.columns)
    by_id = Window.partitionBy(F.when(F.col("_ok"), F.col(key)), F.when(~F.col("_ok"), alone)).orderBy(*order)
    rows = rows.withColumn("_ok", F.col("_missing").isNull()).withColumn("_id", F.col("_ok") & (F.row_number().over(by_id) > 1))
    by_content = Window.partitionBy(F.when(F.col("_fresh"), F.col("_content")), F.when(~F.col("_fresh"), alone)).orderBy(*order)
    rows = rows.withColumn("_fresh", F.col("_ok") & ~F.col("_id")).withColumn("_same", F.col("_fresh") & (F.row_number().over(by_content) > 1))
    reason = F.coalesce(
        F.col("_missing"), F.when(F.col("_id"), "duplicate id"), F.when(F.col("_same"), "duplicate content"), *[F.when(c, r) for c, r in rules]
    )
    rows = rows.withColumn("reason", reason)
    return rows.select(*df.columns, F.col("reason").isNull().alias("valid"), "reason")


def validate_children(df: DataFrame, children: str, required: list[str]) -> DataFrame:
    """valid and reason: the first child that misses a field, counted from 1, with that field."""

    def problem(x: Column) -> Column:
        return F.coalesce(*[F.when(empty(x[c]), F.lit(c)) for c in required])

    problems = F.transform(children, problem)
    first = F.array_position(F.transform(problems, lambda p: p.isNotNull()), True)
    reason = F.when(F.col(children).isNull() | (F.size(children) == 0), F.lit(f"missing {children}")).when(
        first > 0, F.concat(F.lit("child "), first.cast("string"), F.lit(" misses "), F.try_element_at(problems, first.cast("int")))
    )
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def summary(validated: DataFrame) -> DataFrame:
    failed = F.count_if(~F.col("valid"))
    return validated.agg(F.count("*").alias("checks"), failed.alias("failures"), F.count_if(F.col("reason").startswith("duplicate")).alias("duplicates"))


#: A filter of at most so many bytes goes to every task; a larger one is joined by a shuffle.
BROADCAST = 8 << 20


def _word_and_mask(key: str, bits: int, hashes: int) -> tuple[Column, Column]:
    """The 64-bit word of a filter that a key falls in, and its bits in there."""
    text = F.col(key).cast("string")
    word = F.pmod(F.xxhash64(text, F.lit(0)), F.lit(max(1, bits // 64)))
    places = F.xxhash64(text, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(hashes):
        six = F.shiftrightunsigned(places, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), six))
    return word, mask


def bloom_words(keys: DataFrame, key: str, bits: int, hashes: int = 7) -> DataFrame:
    """word and mask: a Bloom filter of so many bits, packed to 64-bit words, all of a key's bits in one of them.

    Bits are joined before the shuffle, so a task passes on a word once however many keys fall in it. With 16 bits a key
    and 7 hashes 445 of 100,000 keys that were never added seemed to be there, with 32 bits 40 (tests/test_sketches.py).
    """
    if not 1 <= hashes <= 10:
        raise ValueError("a key has 1 to 10 bits")
    word, mask = _word_and_mask(key, bits, hashes)
    return keys.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))


def maybe_seen(rows: DataFrame, key: str, words: DataFrame, bits: int, hashes: int = 7) -> DataFrame:
    """Rows with maybe_seen: false only for keys that were never added. One row a key meets one word."""
    word, mask = _word_and_mask(key, bits, hashes)
    side = words.select(F.col("word").alias("_w"), F.col("mask").alias("_m"))
    side = F.broadcast(side) if bits // 8 * 2 <= BROADCAST else side
    asked = rows.withColumns({"_word": word, "_mask": mask}).join(side, F.col("_word") == F.col("_w"), "left")
    return asked.select(*rows.columns, (F.coalesce("_m", F.lit(0)).bitwiseAND(F.col("_mask")) == F.col("_mask")).alias("maybe_seen"))


def seen(rows: DataFrame, key: str, keys: DataFrame, bits: int, hashes: int = 7) -> DataFrame:
    """Rows with seen: whether the key is among the column `key` of keys, exactly; null for a null key.

    Rows that the filter rules out move no further; the rest meet the keys themselves. A filter too small for its keys
    lets more rows through, but changes no result.
    """
    asked = maybe_seen(rows, key, bloom_words(keys, key, bits, hashes), bits, hashes)
    known = keys.select(F.col(key).alias("_k")).where("_k is not null").distinct()
    through = asked.where("maybe_seen").join(known, F.col(key) == F.col("_k"), "left")
    through = through.select(*rows.columns, F.when(F.col(key).isNotNull(), F.col("_k").isNotNull()).alias("seen"))
    return through.union(asked.where("not maybe_seen").select(*rows.columns, F.when(F.col(key).isNotNull(), F.lit(False)).alias("seen")))


def page_verdict(html: Column, invalid: list[str], valid: list[str]) -> Column:
    """verdict and reason: the first invalid word of the list that occurs, else the first valid one, else unknown."""
    pair = lambda v, w: F.struct(F.lit(v).alias("verdict"), w.alias("reason"))
    words = [*invalid, *valid]
    first = F.try_element_at(keyword_hits(F.lower(html), words), F.lit(1))
    word = F.try_element_at(F.array(*[F.lit(x) for x in words]), first) if words else F.lit(None).cast("string")
    out = F.when(html.isNull(), pair("invalid", F.lit("no page"))).when(first <= len(invalid), pair("invalid", word)).when(first.isNotNull(), pair("valid", word))
    return out.otherwise(pair("unknown", F.lit("")))


def orphans(children: DataFrame, child_key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """key and side: children without a parent and parents without a child; a null key is neither.

    Both tables go through one aggregate that holds a key once, with the sides where it occurs.
    """
    c = children.select(F.col(child_key).alias("key"), F.lit(1).alias("_s"))
    p = parents.select(F.col(parent_key).alias("key"), F.lit(2).alias("_s"))
    sides = c.union(p).where("key is not null").groupBy("key").agg(F.bit_or("_s").alias("_s"))
    return sides.where("_s < 3").select("key", F.when(F.col("_s") == 1, "child").otherwise("parent").alias("side"))


def misplaced(df: DataFrame, **signs: Column) -> DataFrame:
    """How many rows show each sign of belonging to another table."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in signs.items()])


def present(df: DataFrame, column: str, wanted: bool = True) -> DataFrame:
    """Rows with, or without, a value in a column."""
    return df.where(~empty(F.col(column)) if wanted else empty(F.col(column)))


def missing_data(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [empty(F.col(c)) for c in columns]))


def missing_translation(lines: DataFrame, file: str, line_no: str, text: str, script: Column | None = None) -> DataFrame:
    """Blocks whose second text line lacks, is a placeholder, or has words but none of the wanted script."""
    rows = line_blocks(lines, file, line_no, text).where("n_lines >= 3")
    foreign = F.col("line2").rlike(r"[\p{L}\p{N}_]") & ~(has_cjk(F.col("line2")) if script is None else script)
    reason = F.when(F.col("n_lines") == 3, "missing line").when(is_placeholder(F.col("line2")), "placeholder").when(foreign, "other script")
    return rows.withColumn("reason", reason).where(F.col("reason").isNotNull())
