"""Queries over catalog tables: joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmloom.functions import values
from filmloom.operators import aggregate, join, quality, window
from filmloom.plans.registry import query, read

AS_OF = "1999-01-01 00:00:00"


@query("j01_parent_child", "select o_orderkey as series_id, l_returnflag as source, l_linenumber as episode, l_partkey, o_totalprice from orders join lineitem on o_orderkey = l_orderkey")
def j01(spark, d):
    columns = [F.col("o_orderkey").alias("series_id"), F.col("l_returnflag").alias("source"), F.col("l_linenumber").alias("episode"), F.col("l_partkey"), F.col("o_totalprice")]
    order = [F.col("series_id"), F.col("source"), F.col("episode"), F.col("l_partkey")]
    return join.parent_child(read(spark, d, "orders"), read(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), columns, order)


@query("j02_child_parent_title", "select s_suppkey, s_name, n_name as nation from supplier join nation on s_nationkey = n_nationkey")
def j02(spark, d):
    columns = [F.col("s_suppkey"), F.col("s_name"), F.col("n_name").alias("nation")]
    return join.parent_child(read(spark, d, "supplier"), read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), columns)


@query(
    "j03_left_one_child",
    "select o_orderkey, f as l_partkey from orders left join (select l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey)) as f from lineitem group by 1) on o_orderkey = l_orderkey",
)
def j03(spark, d):
    rows = join.one_child(read(spark, d, "orders").select("o_orderkey"), read(spark, d, "lineitem"), "o_orderkey", "l_orderkey", "l_partkey", F.struct("l_linenumber", "l_partkey"))
    return rows


@query("j04_children_of_recent", f"select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderdate > timestamp '{AS_OF}')")
def j04(spark, d):
    recent = read(spark, d, "orders").where(F.col("o_orderdate") > F.lit(AS_OF).cast("timestamp")).select(F.col("o_orderkey").alias("l_orderkey"))
    return read(spark, d, "lineitem").join(recent, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


@query("j05_new_items", "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 400000)")
def j05(spark, d):
    known = read(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return join.new_only(read(spark, d, "customer"), known, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "j06_new_composite",
    """select l_orderkey, l_linenumber, l_suppkey, l_partkey from lineitem a where a.l_returnflag <> 'R' and not exists
       (select 1 from lineitem b where b.l_returnflag = 'R' and a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber and a.l_suppkey = b.l_suppkey)""",
)
def j06(spark, d):
    lines = read(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_suppkey"]
    return join.new_only(lines.where("l_returnflag <> 'R'"), lines.where("l_returnflag = 'R'"), keys).select(*keys, "l_partkey")


@query("j07_known_in_union", "select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 9000 union all select s_suppkey from supplier)")
def j07(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    return join.known_in(orders, "key", (read(spark, d, "customer").where("c_acctbal > 9000"), "c_custkey"), (read(spark, d, "supplier"), "s_suppkey")).select("o_orderkey")


@query(
    "j08_refresh_plan",
    """select o_orderkey, case when c then 'skip' when c is not null then 'refetch' else 'new' end as action from orders left join
       (select l_orderkey, max(l_linestatus) = 'O' as c from lineitem group by 1) on o_orderkey = l_orderkey""",
)
def j08(spark, d):
    done = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg((F.max("l_linestatus") == "O").alias("is_complete"))
    return join.refresh_plan(read(spark, d, "orders").select("o_orderkey"), done.union(done), "o_orderkey", "is_complete")


@query("j09_remaining_work", "select o_orderkey from orders where o_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F') and o_orderkey not in (select l_orderkey from lineitem where l_tax = 0.0)")
def j09(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    left = join.remaining(orders, orders.where("o_orderstatus = 'F'"), ["o_orderkey"])
    recovered = read(spark, d, "lineitem").where("l_tax = 0.0").select(F.col("l_orderkey").alias("o_orderkey"))
    return join.remaining(left, recovered, ["o_orderkey"]).select("o_orderkey")


def lines(spark, d):
    """documents as files of numbered lines, from 1."""
    return read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "text")).select("doc_id", (F.col("p") + 1).alias("line_no"), "text")


LINES = """x as (select doc_id, string_split(text, chr(10)) as l from documents), lines as (select doc_id, unnest(l) as text, cast(generate_subscripts(l, 1) as integer) as line_no from x)"""


@query("j10_replace_lines", f"with {LINES} select doc_id, line_no, case when line_no = 2 and doc_id in (select doc_id from labels) then 'fixed' else text end as text from lines")
def j10(spark, d):
    fixes = read(spark, d, "labels").select("doc_id", F.lit(2).alias("line_no"), F.lit("fixed").alias("text"))
    return join.replace_lines(lines(spark, d), fixes.union(fixes), ["doc_id", "line_no"])


@query("j11_surrogate_lookup", "select o_orderkey, show_id from orders join (select c_custkey, row_number() over (order by c_name, c_custkey) as show_id from customer) on o_custkey = c_custkey")
def j11(spark, d):
    ids = join.surrogate_ids(read(spark, d, "customer"), "c_custkey", "c_name", "show_id")
    return read(spark, d, "orders").join(ids, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "show_id")


@query("j12_cross_join", "select n_name, r_name from nation, region")
def j12(spark, d):
    return read(spark, d, "nation").select("n_name").crossJoin(read(spark, d, "region").select("r_name"))


# aggregates

ALL = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


@query("a01_table_counts", " union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in ALL))
def a01(spark, d):
    return aggregate.table_counts({t: read(spark, d, t) for t in ALL})


@query("a02_key_counts", "select count(*) as total, count(distinct l_orderkey) as distinct_keys from lineitem")
def a02(spark, d):
    return aggregate.key_counts(read(spark, d, "lineitem"), "l_orderkey")


@query("a03_count_by_category", "select event_type, count(*) as n from events group by 1")
def a03(spark, d):
    return aggregate.counts_by(read(spark, d, "events"), "event_type")


@query("a04_count_largest_first", "select event_type, count(*) as n from events group by 1 order by n desc, 1")
def a04(spark, d):
    return aggregate.counts_by(read(spark, d, "events"), "event_type", largest_first=True)


@query("a05_top_groups", "select p_brand, count(*) as n from part group by 1 order by n desc, 1 limit 10")
def a05(spark, d):
    return aggregate.counts_by(read(spark, d, "part"), "p_brand", top=10)


@query("a05_top_words", "select word, count(*) as n from (select unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as word from documents) group by 1 order by n desc, word limit 10")
def a05_words(spark, d):
    """The commonest words of all texts; few of their many words are counted behind the sketch."""
    words = F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return aggregate.top_groups(read(spark, d, "documents").select(words.alias("word")), "word", n=10)


@query("a05_top_pairs", "select l_suppkey, l_returnflag, count(*) as n from lineitem group by 1, 2 order by n desc, 1, 2 limit 10")
def a05_pairs(spark, d):
    return aggregate.top_groups(read(spark, d, "lineitem"), "l_suppkey", "l_returnflag", n=10)


@query("a06_count_by_year", "select cast(year(o_orderdate) as integer) as year, count(*) as n from orders where o_orderdate is not null group by 1 order by 1 desc")
def a06(spark, d):
    rows = read(spark, d, "orders").where("o_orderdate is not null").withColumn("year", F.year("o_orderdate"))
    return aggregate.counts_by(rows, "year").orderBy(F.desc("year"))


@query("a07_min_max", "select cast(min(year(o_orderdate)) as integer) as first_year, cast(max(year(o_orderdate)) as integer) as last_year, max(o_orderdate) as updated from orders")
def a07(spark, d):
    y = F.year("o_orderdate")
    return read(spark, d, "orders").agg(F.min(y).alias("first_year"), F.max(y).alias("last_year"), F.max("o_orderdate").alias("updated"))


@query("a08_average", "select coalesce(round(avg(s_acctbal), 2), 0) as rating, coalesce(round(avg(case when s_acctbal > 0 then s_acctbal end), 2), 0) as positive_rating from supplier")
def a08(spark, d):
    return read(spark, d, "supplier").agg(aggregate.average("s_acctbal").alias("rating"), aggregate.average("s_acctbal", True).alias("positive_rating"))


@query("a09_distinct_counts", "select count(distinct year(o_orderdate)) as years, count(distinct o_custkey) as shows from orders")
def a09(spark, d):
    return read(spark, d, "orders").agg(F.countDistinct(F.year("o_orderdate")).alias("years"), F.countDistinct("o_custkey").alias("shows"))


@query(
    "a10_empty_profile",
    " union all ".join(
        f"select '{c}' as column_name, cast(sum(case when {c} is null or trim(cast({c} as varchar)) = '' then 1 else 0 end) as bigint) as n_empty, round(100.0 * sum(case when {c} is null or trim(cast({c} as varchar)) = '' then 1 else 0 end) / greatest(count(*), 1), 2) as percent from (select event_id, nullif(event_type, 'view') as event_type, value from events)"
        for c in ("event_id", "event_type", "value")
    ),
)
def a10(spark, d):
    return aggregate.empty_profile(read(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("event_type"), "value"))


@query("a11_value_head", "select source, count(*) as n from documents group by 1 order by n desc, 1 limit 5")
def a11(spark, d):
    return aggregate.counts_by(read(spark, d, "documents"), "source", top=5)


@query("a12_total_episodes", "select l_orderkey, max(n) as total_episodes from (select l_orderkey, l_returnflag, count(*) as n from lineitem group by 1, 2) group by 1")
def a12(spark, d):
    return aggregate.total_episodes(read(spark, d, "lineitem"), "l_orderkey", "l_returnflag")


@query("a13_completeness", "select l_orderkey, coalesce(max(case when l_returnflag = 'A' then 'a' else '' end) <> '', false) and coalesce(max(case when l_linestatus = 'O' then 'o' end) <> '', false) as is_complete from lineitem group by 1")
def a13(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_returnflag") == "A", "a").otherwise("").alias("x"), F.when(F.col("l_linestatus") == "O", "o").alias("y"))
    return aggregate.completeness(rows, "l_orderkey", "x", "y")


@query("a14_batch_summary", "select count(*) as total, count(*) filter (event_type <> 'error') as ok, round(100.0 * count(*) filter (event_type <> 'error') / greatest(count(*), 1), 2) as success_percent from events")
def a14(spark, d):
    ok = F.count_if(F.col("event_type") != "error")
    return read(spark, d, "events").agg(F.count("*").alias("total"), ok.alias("ok"), aggregate.percent(ok, F.count("*")).alias("success_percent"))


@query("a15_log_totals", "select count(*) as requests, count(*) filter (event_type = 'error') as failures, count(distinct user_id) as unique_ids, count(user_id) - count(distinct user_id) as duplicates, round(avg(value), 4) as mean_time from events")
def a15(spark, d):
    return aggregate.log_totals(read(spark, d, "events"), F.col("event_type") == "error", "user_id", "value")


@query("a16_log_by_spider", "select event_type as spider, count(*) as n, round(avg(value), 2) as mean_seconds, round(sum(value), 2) as items from events group by 1")
def a16(spark, d):
    return read(spark, d, "events").groupBy(F.col("event_type").alias("spider")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 2).alias("mean_seconds"), F.round(F.sum("value"), 2).alias("items"))


@query("a17_requests_by_hour", "select cast(hour(ts) as integer) as hour, count(*) as n from events group by 1")
def a17(spark, d):
    return aggregate.counts_by(read(spark, d, "events").withColumn("hour", F.hour("ts")), "hour")


@query("a18_histogram", "with e as (select min(value) as lo, max(value) as hi from events) select cast(least(floor((value - lo) / ((hi - lo) / 50)), 49) as integer) as bin, count(*) as n from events, e group by 1")
def a18(spark, d):
    return aggregate.histogram(read(spark, d, "events"), "value", 50)


@query(
    "a19_latency_profile",
    """with r as (select value, row_number() over (order by value) as k, count(*) over () as n from events)
       select (select round(avg(value), 6) from events) as mean, (select median(value) from events) as median, (select min(value) from r where k = least(cast(floor(n * 95 / 100) as bigint), n - 1) + 1) as p95,
       (select count(*) filter (event_type = 'error') * 1.0 / count(*) from events) as error_rate""",
)
def a19(spark, d):
    rows = read(spark, d, "events")
    totals = rows.agg(F.round(F.avg("value"), 6).alias("mean"), (F.count_if(F.col("event_type") == "error") / F.count("*")).alias("error_rate"))
    return totals.join(F.broadcast(aggregate.latency_profile(rows, "value", 95)))


@query("a20_high_water", "select coalesce(max(case when event_type = 'purchase' and value > 10 then ts end), timestamp '1970-01-01 00:00:00') as watermark from events")
def a20(spark, d):
    return aggregate.high_water(read(spark, d, "events"), (F.col("event_type") == "purchase") & (F.col("value") > 10), "ts")


@query("a21_resume_point", "select l_suppkey, cast(year(l_shipdate) as integer) as year, coalesce(max(case when l_linestatus = 'F' then l_linenumber end), 0) + 1 as next_page from lineitem group by 1, 2")
def a21(spark, d):
    rows = read(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    return aggregate.resume_pages(rows, ["l_suppkey", "year"], "l_linenumber", F.col("l_linestatus") == "F")


@query("a22_since_watermark", "select o_orderkey from orders where o_orderdate > (select coalesce(max(case when o_orderpriority = '1-URGENT' then o_orderdate end) - interval 100 day, timestamp '1970-01-01') from orders where year(o_orderdate) < 2000)")
def a22(spark, d):
    rows = read(spark, d, "orders")
    mark = aggregate.high_water(rows.where(F.year("o_orderdate") < 2000), F.col("o_orderpriority") == "1-URGENT", "o_orderdate")
    return aggregate.since(rows, mark.select(F.expr("watermark - interval 100 days").alias("watermark")), "o_orderdate").select("o_orderkey")


@query("a23_last_days", f"select o_orderkey from orders where o_orderdate >= timestamp '{AS_OF}' - interval 30 day and o_orderdate <= timestamp '{AS_OF}'")
def a23(spark, d):
    return read(spark, d, "orders").where(F.expr(f"o_orderdate >= timestamp '{AS_OF}' - interval 30 days and o_orderdate <= timestamp '{AS_OF}'")).select("o_orderkey")


@query("a24_last_page", "select page_id, coalesce(list_max(list_transform(regexp_extract_all(url, '[?&]page=([0-9]+)', 1), lambda x: cast(x as integer))), 1) as last_page from pages")
def a24(spark, d):
    return read(spark, d, "pages").select("page_id", values.last_page(F.col("url")).alias("last_page"))


@query("a25_verification", "select source, count(*) as total, count(*) filter (quality = 1) as valid, count(*) - count(*) filter (quality = 1) as invalid, round(100.0 * (count(*) filter (quality = 1) / count(*)), 2) as percent, count(*) filter (quality = 1) / count(*) >= 0.5 as passed from documents join labels using (doc_id) group by rollup (source)")
def a25(spark, d):
    rows = read(spark, d, "documents").select("doc_id", "source").join(read(spark, d, "labels"), "doc_id")
    return aggregate.verification(rows, "source", F.col("quality") == 1, 0.5)


@query("a26_range_profile", "select cast(min(year(o_orderdate)) as integer) as first_year, cast(max(year(o_orderdate)) as integer) as last_year, count(*) filter (year(o_orderdate) not between 1996 and 2000) as odd_years, max(o_totalprice) as top from orders")
def a26(spark, d):
    profile = aggregate.range_profile(read(spark, d, "orders"), F.year("o_orderdate"), 1996, 2000, "o_totalprice")
    return profile.withColumnsRenamed({"first": "first_year", "last": "last_year", "outside": "odd_years"})


@query("a27_validation_events", "select user_id, count(*) filter (value >= 20) as passed, count(*) filter (value < 20) as failed, arg_max(value, event_id) as last_total from events where event_type = 'signup' group by 1")
def a27(spark, d):
    rows = read(spark, d, "events").where("event_type = 'signup'")
    return aggregate.outcome_counts(rows, "user_id", F.col("value") >= 20, "value", "event_id")


# windows


@query("w01_dedup_first", "select min(doc_id) as doc_id from documents group by text")
def w01(spark, d):
    return window.first_per_key(read(spark, d, "documents"), ["text"], F.col("doc_id")).select("doc_id")


@query("w02_dedup_last", "select user_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(event_type, (ts, event_id)) as event_type from events group by 1")
def w02(spark, d):
    return window.last_per_key(read(spark, d, "events"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


@query("w03_flag_repeats", "select event_id, row_number() over (partition by user_id order by ts, event_id) > 1 as is_repeat from events")
def w03(spark, d):
    return window.flag_repeats(read(spark, d, "events"), ["user_id"], F.col("ts"), F.col("event_id")).select("event_id", "is_repeat")


ORDER_PAGES = "select o_orderkey, o_orderpriority as category, (o_orderkey // 16) as page, o_orderkey % 16 as pos, (o_custkey % 3 > 0) as known from orders"
RUNS = "{x} as (select *, sum(case when hit then 0 else 1 end) over (partition by category order by page) as run from ({src})), {y} as (select *, sum(case when hit then 1 else 0 end) over (partition by category, run order by page) as n from {x}), stops as (select category, min(page) as stop_page from {y} where hit and n = 3 group by 1)"


def order_pages(spark, d):
    k = F.col("o_orderkey")
    return read(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("category"), F.floor(k / 16).alias("page"), (k % 16).alias("pos"), (F.col("o_custkey") % 3 > 0).alias("known"))


@query(
    "w04_stop_after_known_pages",
    f"with p as ({ORDER_PAGES}), {RUNS.format(x='a', y='b', src='select category, page, min(cast(known as int)) = 1 as hit from p group by 1, 2')} select o_orderkey from p left join stops using (category) where stop_page is null or page < stop_page",
)
def w04(spark, d):
    rows = order_pages(spark, d)
    pages = rows.groupBy("category", "page").agg(F.min(F.col("known").cast("int")).alias("all_known"))
    stops = window.stop_after_run(pages, ["category"], "page", F.col("all_known") == 1, 3)
    return window.until_stop(rows, stops, ["category"], "page", False).select("o_orderkey")


@query(
    "w05_stop_after_known_items",
    f"""with p as ({ORDER_PAGES}), a as (select *, sum(case when known then 0 else 1 end) over (partition by category order by page, pos) as run from p),
        b as (select *, sum(case when known then 1 else 0 end) over (partition by category, run order by page, pos) as n from a),
        e as (select category, page, arg_max(n, pos) as n from b group by 1, 2), stops as (select category, min(page) as stop_page from e where n >= 8 group by 1)
        select o_orderkey from p left join stops using (category) where stop_page is null or page <= stop_page""",
)
def w05(spark, d):
    rows = order_pages(spark, d)
    stops = window.stop_after_known_items(rows, ["category"], "page", "pos", F.col("known"), 8)
    return window.until_stop(rows, stops, ["category"], "page", True).select("o_orderkey")


@query(
    "w06_stop_after_empty_pages",
    f"with p as (select event_type as category, cast(floor(epoch(ts) / 3600) as bigint) as page, count(*) filter (value > 60) as items from events group by 1, 2), {RUNS.format(x='a', y='b', src='select category, page, items = 0 as hit from p')} select category, stop_page from stops",
)
def w06(spark, d):
    hour = F.floor(F.unix_timestamp("ts") / 3600).alias("page")
    pages = read(spark, d, "events").groupBy(F.col("event_type").alias("category"), hour).agg(F.count_if(F.col("value") > 60).alias("items"))
    return window.stop_after_run(pages, ["category"], "page", F.col("items") == 0, 3)


@query("w07_take_until_quota", "select event_id, event_type from (select *, row_number() over (partition by event_type order by ts, event_id) as r from events) where (event_type = 'view' and r <= 30) or (event_type = 'click' and r <= 50)")
def w07(spark, d):
    return window.take_until_quota(read(spark, d, "events"), "event_type", {"view": 30, "click": 50}, "ts", "event_id").select("event_id", "event_type")


@query("w08_cap_children", "select l_orderkey, l_linenumber, l_partkey, l_extendedprice from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice) as r from lineitem) where r <= 2")
def w08(spark, d):
    rows = window.cap_children(read(spark, d, "lineitem"), ["l_orderkey"], 2, "l_linenumber", "l_partkey", "l_extendedprice")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("w09_last_n_points", "select count(*) as n, round(avg(value), 6) as mean from (select value from events order by ts desc, event_id desc limit 1000)")
def w09(spark, d):
    last = window.last_rows(read(spark, d, "events"), 1000, F.desc("ts"), F.desc("event_id"))
    return last.agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query("w10_last_hour", "select event_id, count(*) over (partition by user_id order by epoch(ts)::bigint range between 3600 preceding and current row) as n from (select event_id, user_id, ts from (select event_id, user_id, date_trunc('second', ts) as ts from events))")
def w10(spark, d):
    return window.trailing_metrics(read(spark, d, "events"), "user_id", "ts", 3600, {"n": ("count", None)}).select("event_id", "n")


@query(
    "w10_last_hour_of_type",
    """select event_id, count(*) over w as n, round(avg(value) over w, 6) as mean, round(sum(value) over w, 6) as total, max(value) over w as most, min(value) over w as least
       from (select event_id, event_type, value, epoch(ts)::bigint as s from (select * replace (date_trunc('second', ts) as ts) from events)) window w as (partition by event_type order by s range between 3600 preceding and current row)""",
)
def w10_of_type(spark, d):
    """Few groups with nearly all rows each."""
    asked = {"n": ("count", None), "mean": ("mean", "value"), "total": ("sum", "value"), "most": ("max", "value"), "least": ("min", "value")}
    rows = window.trailing_metrics(read(spark, d, "events"), "event_type", "ts", 3600, asked)
    return rows.select("event_id", "n", F.round("mean", 6).alias("mean"), F.round("total", 6).alias("total"), "most", "least")


BLOCK_LINES = f"""with {LINES}, b as (select *, sum(case when trim(text) = '' or line_no % 5 = 0 then 1 else 0 end) over (partition by doc_id order by line_no) as block from lines),
       g as (select doc_id, block, list(text order by line_no) as l from b where trim(text) <> '' and line_no % 5 <> 0 group by 1, 2)"""


def srt_lines(spark, d):
    """document lines with every fifth one blank, as in a subtitle file."""
    return lines(spark, d).withColumn("text", F.when(F.col("line_no") % 5 == 0, "").otherwise(F.col("text")))


@query("w11_srt_blocks", BLOCK_LINES + " select doc_id, cast(block as bigint) as block, cast(len(l) as integer) as n_lines, l[1] as idx, l[2] as time, l[3] as line1, l[4] as line2 from g")
def w11(spark, d):
    return window.line_blocks(srt_lines(spark, d), "doc_id", "line_no", "text")


@query("w12_previous_line", f"with {LINES} select * from (select doc_id, line_no, text, lag(text) over (partition by doc_id order by line_no) as previous from lines) where contains(text, 'the')")
def w12(spark, d):
    return window.previous_line(lines(spark, d), "doc_id", "line_no", "text", "the")


ONE_FILE = f"""with {LINES}, o as (select doc_id * 1000000 + line_no as n, case when (doc_id + line_no) % 7 = 0 then ' ' else text end as text from lines)"""


def one_file(spark, d):
    """All documents as one file; its blank lines follow no rule of the file's."""
    text = F.when((F.col("doc_id") + F.col("line_no")) % 7 == 0, " ").otherwise(F.col("text"))
    return lines(spark, d).select(F.lit("all").alias("file"), (F.col("doc_id") * 1000000 + F.col("line_no")).alias("n"), text.alias("text"))


@query(
    "w11_blocks_of_one_file",
    ONE_FILE + """, b as (select *, sum(case when trim(text) = '' then 1 else 0 end) over (order by n) as block from o)
       select cast(block as bigint) as block, cast(count(*) as bigint) as n_lines, arg_min(text, n) as idx from b where trim(text) <> '' group by 1""",
)
def w11_one_file(spark, d):
    return window.line_blocks(one_file(spark, d), "file", "n", "text").select("block", F.col("n_lines").cast("long").alias("n_lines"), "idx")


@query("w12_previous_of_one_file", ONE_FILE + " select n, text, previous from (select n, text, lag(text) over (order by n) as previous from o) where contains(text, 'the')")
def w12_one_file(spark, d):
    return window.previous_line(one_file(spark, d), "file", "n", "text", "the").select("n", "text", "previous")


# sorts, limits, samples, sets


@query("o01_multi_key_sort", "select p_partkey, p_size, p_retailprice from part order by p_size desc, p_retailprice desc, p_partkey")
def o01(spark, d):
    return read(spark, d, "part").select("p_partkey", "p_size", "p_retailprice").orderBy(F.desc_nulls_last("p_size"), F.desc_nulls_last("p_retailprice"), "p_partkey")


@query("o02_latest_n", "select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey desc limit 25")
def o02(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(25)


@query("o03_random_sample", "select doc_id from documents order by md5(cast(doc_id as varchar)), doc_id limit (select cast(floor(count(*) * 0.1) as bigint) from documents)")
def o03(spark, d):
    return window.ranked_sample(read(spark, d, "documents").select("doc_id"), "doc_id", 0.1)


@query("o04_sorted_distinct", "select distinct url from pages order by url")
def o04(spark, d):
    return read(spark, d, "pages").select("url").distinct().orderBy("url")


@query("o05_first_invalid", "select doc_id from labels where quality = 0 order by doc_id limit 10")
def o05(spark, d):
    return read(spark, d, "labels").where("quality = 0").orderBy("doc_id").select("doc_id").limit(10)


@query("u01_union_tagged", "select c_custkey as item_key, c_name as title, 'customer' as batch from customer union all select s_suppkey, s_name, 'supplier' from supplier")
def u01(spark, d):
    a = read(spark, d, "customer").select(F.col("c_custkey").alias("item_key"), F.col("c_name").alias("title"), F.lit("customer").alias("batch"))
    b = read(spark, d, "supplier").select(F.lit("supplier").alias("batch"), F.col("s_suppkey").alias("item_key"), F.col("s_name").alias("title"))
    return a.unionByName(b)


@query("u02_catalog_union", "select 'a' as site, c_custkey as item_key, c_name as title, c_acctbal as rating from customer union all select 'b', s_suppkey, s_name, s_acctbal from supplier union all select 'c', n_nationkey, n_name, null from nation")
def u02(spark, d):
    from filmloom.operators.extract import conform

    schema = [("site", "string"), ("item_key", "bigint"), ("title", "string"), ("rating", "double")]
    parts = [("customer", "a", {"c_custkey": "item_key", "c_name": "title", "c_acctbal": "rating"}), ("supplier", "b", {"s_suppkey": "item_key", "s_name": "title", "s_acctbal": "rating"}), ("nation", "c", {"n_nationkey": "item_key", "n_name": "title"})]
    frames = [conform(read(spark, d, t), schema, names, {"site": site}) for t, site, names in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2], allowMissingColumns=True)


@query("u03_keys_needing_work", "select distinct o_custkey from orders where o_orderstatus = 'P' and o_custkey is not null")
def u03(spark, d):
    return read(spark, d, "orders").where("o_orderstatus = 'P' and o_custkey is not null").select("o_custkey").distinct()


@query("u04_column_difference", "select column_name from (values ('c_custkey'), ('c_name'), ('c_phone')) t(column_name) where column_name not in (select unnest(map_keys(to_json(customer)::json::map(varchar, json))) from customer) and (select count(*) from customer) > 0")
def u04(spark, d):
    df = read(spark, d, "customer")
    # names are metadata; the table only decides whether there is anything to report
    absent = F.array(*[F.lit(x) for x in ("c_custkey", "c_name", "c_phone") if x not in df.columns]).cast("array<string>")
    return df.agg(F.count("*").alias("n")).where("n > 0").select(F.explode(absent).alias("column_name"))


@query(
    "u04_columns_with_values",
    "select * from (select 'c_phone' as column_name, 'missing' as side, cast(0 as bigint) as n_values union all select 'c_acctbal', 'extra', count(case when c_acctbal > 0 then c_acctbal end) from customer union all select 'c_nationkey', 'extra', count(*) filter (c_nationkey > 1000) from customer) where side = 'missing' or n_values > 0",
)
def u04_values(spark, d):
    """Extra columns count as far as they hold values: one has some, one has none."""
    rows = read(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal"), F.when(F.col("c_nationkey") > 1000, F.col("c_nationkey")).alias("c_nationkey"))
    return quality.column_difference(rows, ["c_custkey", "c_name", "c_phone"])
