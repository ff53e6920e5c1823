"""Whole runs as queries: crawl to flat tables, incremental update with export, maintenance; nested pages and callbacks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from filmloom.functions import urls, values
from filmloom.operators import aggregate, extract, join, markup, quality, route, table, window
from filmloom.plans.q_relational import LINES, ORDER_PAGES, RUNS, lines, order_pages
from filmloom.plans.q_tables import health, rounded, streamed
from filmloom.plans.registry import query, read
from filmloom.sources import readers, writers
from filmloom.sources.shared import new_path
from filmloom.sources.snapshots import Snapshots
from filmloom.streaming import monitor


@query(
    "c01_full_crawl",
    """with a as (select page_id, url, unnest(regexp_extract_all(html, '<li>[\\s\\S]*?</li>')) as card from pages),
       i as (select page_id, regexp_extract(url, '^[a-z]+://([^/]*)', 1) as site, regexp_extract(card, 'href="([^"]*)"', 1) as href, regexp_extract(card, '>([^<>]+)</a>', 1) as title from a),
       k as (select distinct site, href from i where href <> '')
       select site, count(*) as n_items, count(distinct href) as n_urls from k group by site""",
)
def c01(spark, d):
    """Landed list pages to items, items merged with their page's record, new keys inserted, counts by site."""
    rules = [extract.Rule("href", ('href="([^"]*)"',)), extract.Rule("title", (r">([^<>]+)</a>",))]
    pages = read(spark, d, "pages").withColumn("site", urls.host(F.col("url")))
    items = extract.extract_items(pages, r"<li>[\s\S]*?</li>", rules).where("href <> ''").select("page_id", "pos", "site", "href", "title")
    details = pages.select("page_id", F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("page_title"))
    merged = extract.merge_detail(items, details, "page_id", ["page_title"]).select("site", "href", "title", "page_title", "page_id", "pos")
    catalog = table.insert_ignore(merged.limit(0), merged, ["site", "href"], "page_id", "pos")
    return catalog.groupBy("site").agg(F.count("*").alias("n_items"), F.countDistinct("href").alias("n_urls"))


@query(
    "c02_incremental_export",
    f"""with p as ({ORDER_PAGES}), {RUNS.format(x='a', y='b', src='select category, page, min(cast(known as int)) = 1 as hit from p group by 1, 2')},
        kept as (select o_orderkey from p left join stops using (category) where stop_page is null or page < stop_page),
        s as (select o_orderkey, coalesce(c_mktsegment, o_orderpriority) as label from kept join orders using (o_orderkey) left join customer on o_custkey = c_custkey),
        t as (select o_orderkey, o_orderpriority as label from orders where o_orderstatus = 'F'),
        m as (select o_orderkey, coalesce(s.label, t.label) as label, s.o_orderkey is not null as fresh from t full join s using (o_orderkey))
        select 'items' as sheet, o_orderkey, label from m where fresh union all select 'children', o_orderkey, cast(count(*) as varchar) from m join lineitem on l_orderkey = o_orderkey where fresh group by 2""",
)
def c02(spark, d):
    """Pages until three are known, merged with details, upserted, and what is new exported as sheets."""
    rows = order_pages(spark, d)
    pages = rows.groupBy("category", "page").agg(F.min(F.col("known").cast("int")).alias("all_known"))
    stops = window.stop_after_run(pages, ["category"], "page", F.col("all_known") == 1, 3)
    kept = window.until_stop(rows, stops, ["category"], "page", False).select("o_orderkey")
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("label"))
    details = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("label"))
    items = extract.merge_detail(orders.join(kept, "o_orderkey", "left_semi"), details, "o_custkey", ["label"])
    old, new = datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 2)
    known = orders.where("o_orderstatus = 'F'").select("o_orderkey", "label", F.lit(old).alias("updated_at"))
    snapshot = table.upsert(known, items.select("o_orderkey", "label", F.lit(new).alias("updated_at")), ["o_orderkey"], ["updated_at"])
    ledger = spark.createDataFrame([("items", "full", "x", 1, "success", datetime.datetime(2020, 1, 1, 12))], writers.LEDGER)
    fresh = writers.incremental(snapshot, ledger, "items", "updated_at")
    children = fresh.join(read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").groupBy("o_orderkey").agg(F.count("*").cast("string").alias("label"))
    path = new_path(spark, "sheets")
    writers.write_sheets({"items": fresh.select("o_orderkey", "label"), "children": children}, path)
    sheets = [spark.read.parquet(f"{path}/{x}").select(F.lit(x).alias("sheet"), "o_orderkey", "label") for x in ("items", "children")]
    return sheets[0].unionByName(sheets[1])


@query(
    "c03_maintenance",
    """with c as (select p_partkey, trim(replace(p_name, 'red', ''), ' -|') as p_name, case when p_size % 2 = 0 then '' else cast(p_size as varchar) end as size, p_retailprice from part where p_brand <> 'Brand#2'),
       f as (select l_partkey, cast(max(l_quantity) as varchar) as q from lineitem where l_discount < 0.02 group by 1)
       select p_partkey, p_name, coalesce(nullif(size, ''), q) as size from c left join f on l_partkey = p_partkey where coalesce(nullif(size, ''), q) is not null""",
)
def c03(spark, d):
    """Cleanup in one pass, missing values refilled from details, what stays incomplete deleted, the rest exported in order."""
    size = F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_size").cast("string"))
    part = read(spark, d, "part").select("p_partkey", "p_name", "p_brand", size.alias("size"), "p_retailprice")
    clean = table.cleanup(part, F.col("p_brand") == "Brand#2", {"p_name": values.clean_title(F.col("p_name"), ["red"])})
    quantity = read(spark, d, "lineitem").where("l_discount < 0.02").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_quantity").cast("string").alias("size"))
    missing = clean.where("size = ''")
    filled = table.fill_missing(missing, quantity, "p_partkey", ["size"]).drop("changed").unionByName(clean.where("size <> ''"))
    whole = table.delete_where(filled, F.col("size") == "")
    writers.write_sorted(whole, path := new_path(spark, "sorted"), ["p_partkey", "p_name", "size", "p_retailprice"], ["p_retailprice", "p_partkey"])
    return spark.read.parquet(path).select("p_partkey", "p_name", "size")


# the same runs in full, over landed pages and with children


GRID_YEARS = [2020, 2021]


@query(
    "c01_grid_to_children",
    """with l as (select page_id, html, regexp_extract(url, '^[a-z]+://([^/]*)', 1) as site, page_id % 5 as category from pages where page_id % 3 < 2),
       c as (select page_id, site, category, unnest(regexp_extract_all(html, '<li>[\\s\\S]*?</li>')) as card, generate_subscripts(regexp_extract_all(html, '<li>[\\s\\S]*?</li>'), 1) as pos from l),
       i as (select site, href, arg_min(category, (page_id, pos)) as category, arg_min(title, (page_id, pos)) as title from (select *, regexp_extract(card, 'href="([^"]*)"', 1) as href, regexp_extract(html, '<h1>([^<]*)</h1>', 1) as title from c join l using (page_id, site, category)) where href <> '' group by 1, 2),
       s as (select page_id, site, category, 'nav' as source_name, regexp_extract_all(regexp_extract(html, '<nav>[\\s\\S]*?</nav>'), 'href="([^"]*)"', 1) as urls from l
             union all select page_id, site, category, 'page', regexp_extract_all(html, 'href="([^"]*)"', 1) from l),
       e as (select *, unnest(urls) as url, generate_subscripts(urls, 1) as episode from s),
       k as (select site, source_name, url, arg_min(category, (page_id, episode)) as category from e group by 1, 2, 3)
       select 'items' as entity, 'list' as source_name, category, count(*) as n, count(distinct title) as n_titles from i group by 3 union all select 'children', source_name, category, count(*), 0 from k group by 2, 3""",
)
def c01_grid(spark, d):
    """The expected grid meets the landed pages; cards to items with their page's detail, its sources to children, both inserted, counts by category."""
    pages = read(spark, d, "pages")
    category, year, number = F.col("page_id") % 5, F.col("page_id") % 3 + 2020, F.floor(F.col("page_id") / 15) + 1
    template = "https://grid.example/%d/%d/%d"
    landed = pages.select("page_id", "html", urls.host(F.col("url")).alias("site"), F.format_string(template, category, year, number).alias("task"))
    last = pages.agg(F.max("page_id")).first()[0] or 0
    grid = extract.task_grid(spark.range(5).withColumnRenamed("id", "category_id"), GRID_YEARS, last // 15 + 1, template)
    found = grid.select(F.col("category_id").alias("category"), F.col("url").alias("task")).join(landed, "task").drop("task")

    rules = [extract.Rule("href", ('href="([^"]*)"',))]
    items = extract.extract_items(found, r"<li>[\s\S]*?</li>", rules).where("href <> ''").select("category", "site", "href", "page_id", "pos")
    details = extract.extract_fields(found.select("page_id", "html"), [extract.Rule("title", ("<h1>([^<]*)</h1>",))]).select("page_id", "title")
    items = extract.merge_detail(items.withColumn("title", F.lit(None).cast("string")), details, "page_id", ["title"])
    items = table.insert_ignore(items.limit(0), items, ["site", "href"], "page_id", "pos")

    links = lambda html: F.transform(F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1)), lambda x: F.struct(x.alias("url")))
    source = lambda name, html: F.struct(F.lit(name).alias("source_name"), links(html).alias("episodes"))
    nested = found.select("category", "site", "page_id", F.array(source("nav", F.regexp_extract("html", r"<nav>[\s\S]*?</nav>", 0)), source("page", F.col("html"))).alias("sources"))
    children = extract.explode_children(nested)
    children = table.insert_ignore(children.limit(0), children, ["site", "source_name", "url"], "page_id", "episode")

    made = items.groupBy("category").agg(F.count("*").alias("n"), F.countDistinct("title").alias("n_titles")).select(F.lit("items").alias("entity"), F.lit("list").alias("source_name"), "category", "n", "n_titles")
    kinds = aggregate.counts_by(children, "source_name", "category")
    return made.unionByName(kinds.select(F.lit("children").alias("entity"), "source_name", "category", "n", F.lit(0).cast("long").alias("n_titles")))


LINE_URL = "{p} || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"


@query(
    "c02_four_sheets",
    f"""with p as ({ORDER_PAGES}), {RUNS.format(x='a', y='b', src='select category, page, min(cast(known as int)) = 1 as hit from p group by 1, 2')},
        kept as (select o_orderkey from p left join stops using (category) where stop_page is null or page < stop_page),
        fresh as (select o_orderkey, coalesce(c_mktsegment, o_orderpriority) as label from kept join orders using (o_orderkey) left join customer on o_custkey = c_custkey),
        old as (select distinct o_orderkey as parent, {LINE_URL.format(p="'u'")} as url from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F' and o_orderkey not in (select o_orderkey from kept)),
        new as (select distinct o_orderkey as parent, {LINE_URL.format(p="'n'")} as url from lineitem join kept on l_orderkey = o_orderkey where l_linenumber <= 2),
        c as (select * from old union all select * from new)
        select 'overview' as sheet, o_orderkey as item, (select min(url) from c where parent = o_orderkey) as value from fresh union all select 'recent', parent, url from c where parent in (select o_orderkey from fresh)
        union all select 'joined', o_orderkey, label || ' ' || url from fresh join c on parent = o_orderkey union all select 'plain', o_orderkey, label from fresh""",
)
def c02_sheets(spark, d):
    """Pages until three are known, details, upsert and replaced children in versions of their own, one watermark, four sheets."""
    rows = order_pages(spark, d)
    pages = rows.groupBy("category", "page").agg(F.min(F.col("known").cast("int")).alias("all_known"))
    stops = window.stop_after_run(pages, ["category"], "page", F.col("all_known") == 1, 3)
    kept = window.until_stop(rows, stops, ["category"], "page", False).select("o_orderkey")
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("label"))
    details = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("label"))
    items = extract.merge_detail(orders.join(kept, "o_orderkey", "left_semi"), details, "o_custkey", ["label"])
    old, new = datetime.datetime(2020, 1, 1), datetime.datetime(2020, 1, 2)

    url = lambda p: F.concat(F.lit(p), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("url")
    lines = read(spark, d, "lineitem")
    known = orders.where("o_orderstatus = 'F'")
    before = lines.join(known.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi").select(F.col("l_orderkey").alias("parent"), url("u")).distinct()
    fetched = lines.where("l_linenumber <= 2").join(kept.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi").select(F.col("l_orderkey").alias("parent"), url("n")).distinct()

    parents, children = Snapshots(spark, new_path(spark, "parents"), ("o_orderkey",), 8), Snapshots(spark, new_path(spark, "children"), ("parent",), 8)
    parents.commit(known.select("o_orderkey", "label", F.lit(old).alias("updated_at")), 0)
    children.commit(before, 0)
    parents.merge(lambda now: table.upsert(now, items.select("o_orderkey", "label", F.lit(new).alias("updated_at")), ["o_orderkey"], ["updated_at"]))
    children.merge(lambda now: table.replace_children(now, kept.withColumnRenamed("o_orderkey", "parent"), fetched, "parent", "url"))

    # one watermark a run, read before any sheet writes to the ledger
    ledger = spark.createDataFrame([("items", "full", "x", 1, "success", datetime.datetime(2020, 1, 1, 12))], writers.LEDGER)
    fresh, now = writers.incremental(parents.read(), ledger, "items", "updated_at").select("o_orderkey", "label"), children.read()
    recent = now.join(fresh.select(F.col("o_orderkey").alias("parent")), "parent", "left_semi")
    sheets = {
        "overview": join.one_child(fresh.select("o_orderkey"), now, "o_orderkey", "parent", "url", F.col("url")).select(F.col("o_orderkey").alias("item"), F.col("url").alias("value")),
        "recent": recent.select(F.col("parent").alias("item"), F.col("url").alias("value")),
        "joined": join.parent_child(fresh, now, F.col("o_orderkey") == F.col("parent"), [F.col("o_orderkey").alias("item"), F.concat_ws(" ", "label", "url").alias("value")]),
        "plain": fresh.select(F.col("o_orderkey").alias("item"), F.col("label").alias("value")),
    }
    writers.write_sheets(sheets, path := new_path(spark, "sheets"))
    out = None
    for name in sheets:
        part = spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("sheet"), "item", "value")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "c03_refill_pages",
    """with i as (select page_id, url, case when page_id % 2 = 0 then '' else 'own ' || page_id end as title from pages where page_id % 7 <> 0),
       e as (select page_id from pages where html is null or contains(html, 'ad 1') or contains(html, 'not found')),
       d as (select page_id, nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '') as t from pages where page_id not in (select page_id from e))
       select page_id, url, coalesce(nullif(title, ''), t) as title from i left join d using (page_id) where coalesce(nullif(title, ''), t) is not null and not (title = '' and page_id in (select page_id from e))""",
)
def c03_refill(spark, d):
    """Cleanup, the incomplete rows' pages again, error pages and what stays empty deleted, the rest filled and exported in order."""
    pages = read(spark, d, "pages")
    title = F.when(F.col("page_id") % 2 == 0, "").otherwise(F.concat(F.lit("own  "), F.col("page_id").cast("string")))
    items = table.cleanup(pages.select("page_id", "url", title.alias("title")), F.col("page_id") % 7 == 0, {"title": F.regexp_replace("title", " +", " ")})
    asked = quality.missing_data(items, ["title"]).select("page_id")
    landed = pages.select("page_id", "html").join(asked, "page_id", "left_semi").withColumn("failed", route.error_page(F.col("html"), ["ad 1", "not found"]))
    details = extract.extract_fields(landed.where(~F.col("failed")), [extract.Rule("title", ("<h1>([^<]*)</h1>",))]).select("page_id", "title")
    filled = table.fill_missing(table.delete_keys(items, landed.where("failed"), ["page_id"]), details, "page_id", ["title"]).drop("changed")
    writers.write_sorted(table.delete_where(filled, F.col("title") == ""), path := new_path(spark, "sorted"), ["page_id", "url", "title"], ["title", "page_id"])
    return spark.read.parquet(path)


FAMILIES = {
    "region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_name"), "customer": ("c_custkey", "c_name"), "supplier": ("s_suppkey", "s_name"),
    "part": ("p_partkey", "p_name"), "orders": ("o_orderkey", "o_orderpriority"), "lineitem": ("l_orderkey", "l_returnflag"), "events": ("event_id", "event_type"),
    "documents": ("doc_id", "lang"), "pages": ("page_id", "url"), "benchmark": ("item_id", None), "labels": ("doc_id", None), "conversations": ("conv_id", "role"),
}


@query("u02_thirteen_families", " union all ".join(f"select '{t}' as site, cast({k} as bigint) as item_key, {n or 'cast(null as varchar)'} as title from {t}" for t, (k, n) in FAMILIES.items()))
def u02_families(spark, d):
    schema, out = [("site", "string"), ("item_key", "bigint"), ("title", "string")], None
    for t, (k, n) in FAMILIES.items():
        part = extract.conform(read(spark, d, t).select(k, *([n] if n else [])), schema, {k: "item_key"} | ({n: "title"} if n else {}), {"site": t})
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "x05_nested_html",
    """with n as (select page_id, regexp_extract(html, '<nav>[\\s\\S]*?</nav>') as nav, regexp_extract(html, '<article>[\\s\\S]*?</article>') as article from pages)
       select page_id, cast(len(regexp_extract_all(nav, '<a ')) as bigint) as nav_links, cast(len(regexp_extract_all(nav, '<li>')) as bigint) as nav_items, cast(len(regexp_extract_all(article, '<h1>')) as bigint) as headings from n""",
)
def x05(spark, d):
    nodes = markup.elements(read(spark, d, "pages"), "page_id")
    inside = lambda tag, *path: F.count_if((F.col("tag") == tag) & markup.within(F.col("path"), *path))
    return nodes.groupBy("page_id").agg(inside("a", "nav", "li").alias("nav_links"), inside("li", "nav").alias("nav_items"), inside("h1", "article").alias("headings"))


@query(
    "x05_nested_lists",
    """with c as (select page_id, regexp_extract_all(html, '<ul>[\\s\\S]*?</ul>') as blocks from pages),
       b as (select page_id, unnest(blocks) as block, generate_subscripts(blocks, 1) as season from c),
       h as (select page_id, season, regexp_extract_all(block, 'href="([^"]*)"', 1) as links from b)
       select page_id, cast(season as integer) as block, cast(len(list_distinct(links)) as integer) as n,
       array_to_string(list_transform(list_filter(list_transform(range(len(links)), lambda i: struct_pack(i := i, x := links[i + 1])), lambda s: list_position(links, s.x) = s.i + 1), lambda s: s.x), ',') as urls from h""",
)
def x05_lists(spark, d):
    return markup.nested_lists(read(spark, d, "pages"), "page_id", "ul").drop("n_all")


@query(
    "x01_extraction_rules",
    """select page_id, nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '') as title, coalesce(try_cast(nullif(regexp_extract(html, 'track\\(([0-9]+)\\)', 1), '') as integer), -1) as tracked,
       nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') as lang from pages""",
)
def x01(spark, d):
    """A site's fields as data: patterns in order, a type, a default."""
    rules = [
        extract.Rule("title", ("<h1>([^<]*)</h1>",)), extract.Rule("tracked", ('data-track="([0-9]+)"', r"track\(([0-9]+)\)"), "int", -1),
        extract.Rule("lang", ('<html lang="([a-z]+)"',)),
    ]
    return extract.extract_fields(read(spark, d, "pages"), rules).select("page_id", "title", "tracked", "lang")


@query("x03_value_predicate", "select p_partkey from part where p_type in ('PROMO', 'ECONOMY')")
def x03(spark, d):
    return read(spark, d, "part").where(values.is_one_of(F.col("p_type"), ["PROMO", "ECONOMY"])).select("p_partkey")


@query("x04_progress_callback", "select count(*) as n from events")
def x04(spark, d):
    """A callback for each batch, as a foreachBatch function; ProgressCallback is the same for a running session."""
    base = new_path(spark, "stream")

    def on_progress(batch, batch_id):
        batch.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    monitor.upsert_stream(streamed(spark, d).select("event_id"), on_progress, f"{base}/mark").awaitTermination()
    return spark.read.parquet(f"{base}/out").agg(F.sum("n").alias("n"))


@query("s05_read_srt_files", f"with {LINES} select count(*) as n_lines, cast(sum(length(text)) as bigint) as n_chars from lines where text <> ''")
def s05_files(spark, d):
    path = new_path(spark, "srt")
    lines(spark, d).select("text").write.text(path, lineSep="\n")
    return readers.read_srt(spark, path).where("text <> ''").agg(F.count("*").alias("n_lines"), F.sum(F.length("text")).alias("n_chars"))


@query("s07_write_csv_with_mark", "select s_suppkey, s_name from supplier")
def s07_mark(spark, d):
    path = writers.export_path(new_path(spark, "csv"), "supplier", "full", datetime.datetime(2024, 1, 2, 3, 4, 5))
    writers.write_csv(read(spark, d, "supplier").select("s_suppkey", "s_name"), path, mark=True)
    return readers.read_csv(spark, path, "s_suppkey bigint, s_name string")


@query(
    "t03_sliding_windows",
    """with e as (select *, time_bucket(interval 30 minute, ts) as b from events), w as (select b as s, * from e union all select b - interval 30 minute, * from e)
       select s as window_start, s + interval 1 hour as window_end, count(*) as n, round(avg(value / 10), 9) as response_time from w group by 1, 2""",
)
def t03_sliding(spark, d):
    rows, columns = health(spark, d)
    return rounded(monitor.health_by_window(rows, "ts", columns, slide="30 minutes")).select("window_start", "window_end", "n", "response_time")


@query("j08_repeated_flags", "select o_orderkey, case when max(l_linestatus = 'O') then 'skip' when max(l_linestatus = 'O') is not null then 'refetch' else 'new' end as action from orders left join lineitem on o_orderkey = l_orderkey group by 1")
def j08_repeated(spark, d):
    """A key with several rows, as they are in the table of children."""
    flags = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_linestatus") == "O").alias("is_complete"))
    return join.refresh_plan(read(spark, d, "orders").select("o_orderkey"), flags, "o_orderkey", "is_complete")


@query("m07_repeated_details", "select o_orderkey, coalesce((select max(l_returnflag) from lineitem where l_orderkey = o_orderkey and l_linenumber < 4), o_orderstatus) as o_orderstatus from orders")
def m07_repeated(spark, d):
    details = read(spark, d, "lineitem").where("l_linenumber < 4").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("o_orderstatus"))
    return table.fill_missing(read(spark, d, "orders").select("o_orderkey", "o_orderstatus"), details, "o_orderkey", ["o_orderstatus"]).drop("changed")


@query("a19_median_by_buckets", "select median(l_extendedprice) as median from lineitem")
def a19_median(spark, d):
    return aggregate.exact_median(read(spark, d, "lineitem"), "l_extendedprice")
