"""Rows in order: first and last of a key, runs, quotas, blocks of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def sortable(kind: DataType) -> bool:
    """Whether values of a type have an order."""
    if isinstance(kind, StructType):
        return all(sortable(f.dataType) for f in kind.fields)
    return sortable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def tie_breakers(df: DataFrame, *but: str) -> list[str]:
    """The columns that settle ties: all that have an order, but those named."""
    return [f.name for f in df.schema.fields if f.name not in but and sortable(f.dataType)]


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order; rows that tie are taken by their other columns, the least first."""
    w = Window.partitionBy(*keys).orderBy(*order, *tie_breakers(df, *keys))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def last_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Last write wins, as an aggregate that is combined before the shuffle; of rows that tie the greatest by its other columns."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    by = [*order, *tie_breakers(df, *keys, *order)]
    best = F.max_by(F.struct(*others), F.struct(*by) if by else F.lit(0)).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, "_v.*")


def last_values(df: DataFrame, keys: list[str], columns: list[str], *order: str) -> DataFrame:
    """What a key's rows leave behind when they are applied one after another, each setting the columns that it has a value for.

    Rows are applied in their order, equal ones and those without an order by their values. So a column comes from the
    last row, and from one before it only where the last one's is null or empty.
    """
    place = F.struct(*order, *columns)
    made = []
    for c in columns:
        value = F.when(F.col(c).cast("string") != "", F.col(c))
        made.append(F.max_by(value, F.when(value.isNotNull(), place)).alias(c))
    return df.groupBy(*keys).agg(*made)


def flag_repeats(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("is_repeat", F.row_number().over(w) > 1)


def stop_after_run(pages: DataFrame, category: list[str], page: str, hit: Column, k: int) -> DataFrame:
    """stop_page: the page at which the k-th hit in a row falls, by category; pages is a row per page.

    Runs are pages between misses: a running count of misses names them.
    """
    w = Window.partitionBy(*category).orderBy(page)
    rows = pages.withColumn("_hit", hit).withColumn("_run", F.sum(F.when(F.col("_hit"), 0).otherwise(1)).over(w))
    inner = Window.partitionBy(*category, "_run").orderBy(page)
    rows = rows.withColumn("_n", F.sum(F.when(F.col("_hit"), 1).otherwise(0)).over(inner))
    return rows.where(F.col("_hit") & (F.col("_n") == k)).groupBy(*category).agg(F.min(page).alias("stop_page"))


def until_stop(rows: DataFrame, stops: DataFrame, category: list[str], page: str, keep_stop_page: bool) -> DataFrame:
    joined = rows.join(stops, category, "left")
    inside = F.col(page) <= F.col("stop_page") if keep_stop_page else F.col(page) < F.col("stop_page")
    return joined.where(F.col("stop_page").isNull() | inside).drop("stop_page")


def stop_after_known_items(items: DataFrame, category: list[str], page: str, pos: str, known: Column, k: int) -> DataFrame:
    """stop_page: the first page at whose end at least k items in a row were known.

    Each page is reduced to its number of items and how many of them end it known; the run at a page's end is that
    number, and where all of a page is known, the run before it as well. Only a row per page enters the windows.
    """
    rows = items.withColumn("_known", F.coalesce(known, F.lit(False)))
    missed = F.max(F.when(~F.col("_known"), F.col(pos)))
    last = rows.groupBy(*category, page).agg(missed.alias("_missed"))
    per = rows.join(last.withColumnsRenamed({c: f"_{c}" for c in (*category, page)}), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*category, page)])
    per = per.groupBy(*category, page).agg(F.count_if(F.col("_missed").isNull() | (F.col(pos) > F.col("_missed"))).alias("_tail"), F.first("_missed").isNull().alias("_whole"))
    # runs of pages: a page with a miss starts a new one with its tail, whole pages add to it
    w = Window.partitionBy(*category).orderBy(page)
    per = per.withColumn("_run", F.sum(F.when(F.col("_whole"), 0).otherwise(1)).over(w))
    ends = per.withColumn("_n", F.sum("_tail").over(Window.partitionBy(*category, "_run").orderBy(page)))
    return ends.where(F.col("_n") >= k).groupBy(*category).agg(F.min(page).alias("stop_page"))


def trailing_count(df: DataFrame, group: str, time: str, tie: str, most: int) -> DataFrame:
    """df with n, the rows of its group up to each row in order of time and tie, at most so many.

    Rows are ranked within hours of their group and by the hours before, so a group with most of the rows is spread.
    """
    rows = df.withColumn("_h", F.floor(F.unix_timestamp(time) / 3600))
    per = rows.groupBy(group, "_h").agg(F.count("*").alias("_k"))
    before = Window.partitionBy(group).orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(group).alias("_g"), F.col("_h").alias("_at"), F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base"))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(group, "_h").orderBy(time, tie)))
    rows = rows.join(per, F.col(group).eqNullSafe(F.col("_g")) & F.col("_h").eqNullSafe(F.col("_at")))
    return rows.select(*df.columns, F.least(F.col("_base") + F.col("_r"), F.lit(most)).alias("n"))


_PARTS = {"count": ("count",), "sum": ("sum",), "mean": ("sum", "count"), "min": ("min",), "max": ("max",)}
_JOINED = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}


def _two(part: str, a: Column, b: Column) -> Column:
    """One part of a metric over two stretches, of which the first may be empty."""
    return {"min": F.least, "max": F.greatest}[part](a, b) if part in ("min", "max") else F.coalesce(a + b, a, b)


def trailing_metrics(df: DataFrame, group: str, time: str, seconds: int, asked: dict[str, tuple[str, str | None]]) -> DataFrame:
    """df with metrics over the rows of its group in the seconds up to each row, its own second included.

    asked names for each new column a kind (count, sum, mean, min, max) and a column; count without one counts rows.
    Rows without a time are each other's peers, as in SQL. Rows are reduced to one per group and second before anything
    is ordered. A group's time is cut into chunks that are as long as the trailing stretch, which so is the end of one
    chunk and the beginning of the next: running metrics from a chunk's beginning and from its end, joined in pairs. So
    a second costs the same however long the stretch is, nothing is subtracted, and a window's partition has at most
    2 * (seconds + 1) rows, also where one group has all rows.
    """
    rows = df.withColumn("_t", F.unix_timestamp(time))
    value = lambda c: F.lit(1) if c is None else F.col(c)
    parts = {f"_{name}_{p}": (p, c) for name, (kind, c) in asked.items() for p in _PARTS[kind]}
    per = rows.groupBy(group, "_t").agg(*[getattr(F, p)(value(c)).alias(x) for x, (p, c) in parts.items()])
    per = per.withColumn("_c", F.floor(F.col("_t") / (seconds + 1)))
    chunk = Window.partitionBy(group, "_c")
    running = lambda w: F.struct(*[getattr(F, _JOINED[p])(x).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(x) for x, (p, _) in parts.items()])
    per = per.select(group, "_c", "_t", running(chunk.orderBy("_t")).alias("_from"), running(chunk.orderBy(F.desc("_t"))).alias("_to"))
    # what a second leaves up to its chunk's end counts until it is so many seconds old, in the next chunk
    own = F.struct("_c", "_t", F.lit(True).alias("_own"), "_from", F.lit(None).cast(per.schema["_to"].dataType).alias("_left"))
    later = F.struct((F.col("_c") + 1).alias("_c"), (F.col("_t") + seconds).alias("_t"), F.lit(False).alias("_own"), F.lit(None).cast(per.schema["_from"].dataType).alias("_from"), F.col("_to").alias("_left"))
    both = per.select(group, F.inline(F.when(F.col("_t").isNull(), F.array(own)).otherwise(F.array(own, later))))
    left = F.last("_left", ignorenulls=True).over(chunk.orderBy(F.desc("_t"), "_own").rowsBetween(Window.unboundedPreceding, 0))
    done = both.withColumn("_left", left).where("_own")
    made = []
    for name, (kind, _) in asked.items():
        total = [_two(p, F.col(f"_left._{name}_{p}"), F.col(f"_from._{name}_{p}")) for p in _PARTS[kind]]
        made.append((total[0] / F.nullif(total[1], F.lit(0)) if kind == "mean" else total[0]).alias(name))
    found = done.select(F.col(group).alias("_g"), F.col("_t").alias("_at"), *made)
    return rows.join(found, F.col(group).eqNullSafe(F.col("_g")) & F.col("_t").eqNullSafe(F.col("_at")), "left").select(*df.columns, *asked)


def last_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The n rows that come first in an order: a top-n, of which each task keeps n."""
    return df.orderBy(*order).limit(n)


def take_until_quota(df: DataFrame, kind: str, quotas: dict[str, int], *order: str) -> DataFrame:
    w = Window.partitionBy(kind).orderBy(*order)
    most = F.create_map(*[x for k, n in quotas.items() for x in (F.lit(k), F.lit(n))])
    # a top-n by rank: Spark prunes each partition before the shuffle where the limit is a number
    wide = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max(quotas.values(), default=0))
    return wide.where(F.col("_r") <= F.coalesce(F.try_element_at(most, F.col(kind)), F.lit(0))).drop("_r")


def cap_children(df: DataFrame, parent: list[str], n: int, *order: str) -> DataFrame:
    w = Window.partitionBy(*parent).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


#: Lines of a file that are numbered together.
LINES = 1 << 16


def _in_chunks(lines: DataFrame, line_no: str) -> DataFrame:
    return lines.withColumn("_c", F.floor(F.col(line_no) / LINES))


def _same_chunk(file: str) -> Column:
    return F.col(file).eqNullSafe(F.col("_f")) & (F.col("_c") == F.col("_d"))


def line_blocks(lines: DataFrame, file: str, line_no: str, text: str) -> DataFrame:
    """Blocks between blank lines: block, n_lines, idx, time, line1, line2, by file.

    Lines are counted in chunks of LINES numbers. What a chunk hands on is one row: its blank lines, and how many lines
    its last block has so far. Running sums of these rows number the blocks of a file over all its chunks, so a file is
    as many tasks' work as it has chunks, and a block of any length is counted before it is shuffled.
    """
    rows = _in_chunks(lines.select(file, F.col(line_no).alias("_n"), F.col(text).alias("_x")), "_n")
    blank = F.trim("_x") == ""
    inside = Window.partitionBy(file, "_c").orderBy("_n")
    # blocks and lines so far, within the chunk; a null line is neither blank nor a line
    rows = rows.withColumns({"_b": F.sum(F.when(blank, 1).otherwise(0)).over(inside), "_l": F.sum(F.when(~blank, 1).otherwise(0)).over(inside)})
    # what the block that a line stands in had before it: the lines up to the last blank one
    rows = rows.withColumn("_before", F.max(F.when(blank, F.col("_l"))).over(inside))
    last = F.max_by(F.struct("_b", "_l", "_before"), "_n").alias("_e")
    per = rows.groupBy(F.col(file).alias("_f"), F.col("_c").alias("_d")).agg(last)
    per = per.select("_f", "_d", F.col("_e._b").alias("_blanks"), (F.col("_e._l") - F.coalesce("_e._before", F.lit(0))).alias("_tail"))
    upto = Window.partitionBy("_f").orderBy("_d")
    earlier = upto.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({"_base": F.coalesce(F.sum("_blanks").over(earlier), F.lit(0)), "_run": F.sum(F.when(F.col("_blanks") > 0, 1).otherwise(0)).over(upto)})
    # tails add up over chunks without a blank line; a chunk carries on what the one before it ended with
    per = per.withColumn("_ends", F.sum("_tail").over(Window.partitionBy("_f", "_run").orderBy("_d")))
    per = per.withColumn("_carry", F.coalesce(F.lag("_ends").over(upto), F.lit(0))).select("_f", "_d", "_base", "_carry")
    rows = rows.join(per, _same_chunk(file)).where(~blank)
    place = F.col("_l") - F.coalesce(F.col("_before"), -F.col("_carry"))
    at = lambda i: F.max(F.when(place == i, F.col("_x")))
    rows = rows.groupBy(file, (F.col("_base") + F.col("_b")).alias("block"))
    return rows.agg(F.count("*").cast("int").alias("n_lines"), at(1).alias("idx"), at(2).alias("time"), at(3).alias("line1"), at(4).alias("line2"))


def previous_line(lines: DataFrame, file: str, line_no: str, text: str, marker: str) -> DataFrame:
    """Lines that hold the marker, with the line before each; the last line of a chunk of a file is handed to the next one."""
    rows = _in_chunks(lines, line_no)
    w = Window.partitionBy(file, "_c").orderBy(line_no)
    rows = rows.withColumns({"_p": F.lag(F.struct(F.col(text).alias("x"))).over(w)})
    ends = rows.groupBy(F.col(file).alias("_f"), F.col("_c").alias("_d")).agg(F.max_by(text, line_no).alias("_last"))
    ends = ends.withColumn("_handed", F.lag("_last").over(Window.partitionBy("_f").orderBy("_d"))).drop("_last")
    hit = rows.where(F.contains(F.col(text), F.lit(marker))).join(ends, _same_chunk(file))
    previous = F.when(F.col("_p").isNotNull(), F.col("_p.x")).otherwise(F.col("_handed"))
    return hit.select(*lines.columns, previous.alias("previous"))


def ranked_sample(df: DataFrame, key: str, fraction: float, *within: str) -> DataFrame:
    """An exact share of the rows, the first ones in md5 order of the key, overall or in each group.

    The place to cut is an exact percentile of the hash's first digits; only the ties of that bucket are ranked.
    """
    h = df.withColumn("_h", F.md5(F.col(key).cast("string"))).withColumn("_b", F.substring("_h", 1, 4))
    per = h.groupBy(*within, "_b").agg(F.count("*").alias("_k"))
    before = Window.partitionBy(*within).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_base", F.coalesce(F.sum("_k").over(before), F.lit(0)))
    per = per.withColumn("_want", F.floor(F.sum("_k").over(Window.partitionBy(*within)) * fraction)).where(F.col("_base") < F.col("_want"))
    inner = Window.partitionBy(*within, "_b").orderBy("_h", key)
    rows = h.join(per.drop("_k"), [*within, "_b"]).withColumn("_r", F.col("_base") + F.row_number().over(inner))
    return rows.where(F.col("_r") <= F.col("_want")).select(*df.columns)
