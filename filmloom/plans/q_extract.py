"""Queries over landed pages and records: extraction, routing and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.functions import urls, values
from filmloom.operators import extract, markup, quality, route
from filmloom.plans.registry import query, read

TITLE = extract.Rule("title", (r"<title>([^<]*)</title>",))
HREFS = "regexp_extract_all(html, '<a[^>]*href=\"([^\"]*)\"', 1)"
ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"
PATH = "regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1)"
FOLDER = f"case when regexp_extract({PATH}, '^(.*/)', 1) = '' then '/' else regexp_extract({PATH}, '^(.*/)', 1) end"
RESOLVED = (
    "case when regexp_matches({h}, '^[a-z]+://') then {h} when starts_with({h}, '//') then 'https:' || {h}"
    f" when starts_with({{h}}, '/') then {ORIGIN} || {{h}} else {ORIGIN} || {FOLDER} || {{h}} end"
)


@query("s01_read_pages", "select page_id, url, length(html) as n_chars from pages where html like '%<article>%'")
def s01(spark, d):
    return read(spark, d, "pages").where(F.contains("html", F.lit("<article>"))).select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query(
    "p01_extract_fields",
    """select page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') as title,
       coalesce(nullif(regexp_extract(html, '<h1 class="none">([^<]*)</h1>', 1), ''), nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '')) as heading,
       coalesce(nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), ''), 'und') as lang,
       try_cast(nullif(regexp_extract(html, 'track\\(([0-9]+)\\)', 1), '') as bigint) as track from pages""",
)
def p01(spark, d):
    rules = [
        TITLE,
        extract.Rule("heading", (r'<h1 class="none">([^<]*)</h1>', r"<h1>([^<]*)</h1>")),
        extract.Rule("lang", (r'<html lang="([a-z]+)"',), default="und"),
        extract.Rule("track", (r"track\(([0-9]+)\)",), "bigint"),
    ]
    return extract.extract_fields(read(spark, d, "pages"), rules).select("page_id", "title", "heading", "lang", "track")


@query(
    "p02_extract_items",
    """with c as (select page_id, regexp_extract_all(html, '<li>(<a[^<]*</a>)</li>', 1) as cards from pages),
       e as (select page_id, unnest(cards) as card, generate_subscripts(cards, 1) - 1 as pos from c)
       select page_id, cast(pos as integer) as pos, nullif(regexp_extract(card, 'href="([^"]*)"', 1), '') as href, nullif(regexp_extract(card, '>([^<]*)<', 1), '') as name from e""",
)
def p02(spark, d):
    rules = [extract.Rule("href", (r'href="([^"]*)"',)), extract.Rule("name", (r"<a[^>]*>([^<]*)<",))]
    return extract.extract_items(read(spark, d, "pages"), r"<li><a[^<]*</a></li>", rules).select("page_id", "pos", "href", "name")


LABELLED = "concat('Director: ', role, '\n', 'Year： ', cast(2000 + turn as {s}), '\n', text)"


@query(
    "p03_extract_labelled",
    f"""with x as (select conv_id, turn, {LABELLED.format(s="varchar")} as text from conversations)
       select conv_id, turn, nullif(regexp_extract(text, '(?i)Director[ \\t]*[:：][ \\t]*([^\\n]+)', 1), '') as director,
       nullif(regexp_extract(text, '(?i)Year[ \\t]*[:：][ \\t]*([^\\n]+)', 1), '') as year, substring(text, 1, 500) as synopsis from x""",
)
def p03(spark, d):
    rows = read(spark, d, "conversations").select("conv_id", "turn", F.expr(LABELLED.format(s="string").replace("\n", "\\n")).alias("text"))
    return extract.extract_labelled(rows, ["Director", "Year"]).select("conv_id", "turn", "director", "year", F.substring("text", 1, 500).alias("synopsis"))


LINKS = """with c as (select page_id, url, regexp_extract_all(html, '<a[^>]*href="[^"]*"[^>]*>[\\s\\S]*?</a>') as a from pages),
       e as (select page_id, url, unnest(a) as anchor, generate_subscripts(a, 1) - 1 as pos from c),
       links as (select page_id, url, cast(pos as integer) as pos, regexp_extract(anchor, 'href="([^"]*)"', 1) as href,
       regexp_replace(regexp_extract(anchor, '<a[^>]*href="[^"]*"[^>]*>([\\s\\S]*?)</a>', 1), '<[^>]*>', '', 'g') as link_text from e)"""


@query("p04_extract_links", LINKS + " select page_id, pos, href, link_text from links where regexp_matches(href, '^/[a-z]')")
def p04(spark, d):
    return extract.extract_links(read(spark, d, "pages"), "^/[a-z]").select("page_id", "pos", "href", "link_text")


@query("p05_conform", "select c_custkey as item_key, c_name as title, cast(null as integer) as year, 'site' as site, cast(c_acctbal as double) as rating from customer")
def p05(spark, d):
    schema = [("item_key", "bigint"), ("title", "string"), ("year", "int"), ("site", "string"), ("rating", "double")]
    return extract.conform(read(spark, d, "customer"), schema, {"c_custkey": "item_key", "c_name": "title", "c_acctbal": "rating"}, {"site": "site"})


@query("p06_with_defaults", "select event_id, coalesce(nullif(event_type, 'error'), 'Movie') as event_type, coalesce(value, 0.0) as value from events")
def p06(spark, d):
    rows = read(spark, d, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return extract.with_defaults(rows, {"event_type": "Movie", "value": 0.0}).select("event_id", "event_type", "value")


@query("p07_null_sentinels", "select o_orderkey, nullif(nullif(o_orderstatus, 'P'), '') as status, nullif(year(o_orderdate) % 2, 0) as odd from orders")
def p07(spark, d):
    rows = read(spark, d, "orders")
    return rows.select("o_orderkey", values.null_sentinels(F.col("o_orderstatus"), "P", "").alias("status"), values.null_sentinels((F.year("o_orderdate") % 2).cast("long"), 0).alias("odd"))


@query(
    "p08_merge_detail",
    """select o_orderkey, o_custkey, coalesce(c_mktsegment, o_orderpriority) as label from
       (select o_orderkey, o_custkey, o_orderpriority from orders) left join (select c_custkey as o_custkey, c_mktsegment from customer where c_custkey % 3 > 0) using (o_custkey)""",
)
def p08(spark, d):
    items = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("label"))
    details = read(spark, d, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("label"))
    return extract.merge_detail(items, details.union(details), "o_custkey", ["label"]).select("o_orderkey", "o_custkey", "label")


@query(
    "p09_zip_sources",
    """with g as (select conv_id, list(role order by turn) as roles, list(length(text) order by turn) as sizes, count(*) as n from conversations group by conv_id),
       e as (select conv_id, roles, unnest(sizes) as items, generate_subscripts(sizes, 1) as i from g)
       select conv_id, cast(i - 1 as integer) as pos, case when i <= 2 then roles[i] else 'Source ' || i end as source_name, cast(items as bigint) as items from e""",
)
def p09(spark, d):
    rows = read(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.length("text").cast("long").alias("n")))).alias("t"))
    rows = rows.select("conv_id", F.slice(F.col("t.role"), 1, 2).alias("tabs"), F.col("t.n").alias("lists"))
    return extract.zip_sources(rows, "tabs", "lists")


@query("p10_map_sources", "select o_orderkey, case o_orderstatus when 'F' then 'first' when 'O' then 'second' else 'unknown' end as source_name from orders")
def p10(spark, d):
    rows = read(spark, d, "orders").withColumn("ids", F.array(F.lit("F"), F.lit("O"))).withColumn("names", F.array(F.lit("first"), F.lit("second")))
    return extract.map_sources(rows, "ids", "names", "o_orderstatus", "unknown").select("o_orderkey", "source_name")


def nested(spark, d):
    """orders as items with their lineitems as episodes of sources."""
    lines = read(spark, d, "lineitem").where("l_orderkey is not null")
    episodes = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_extendedprice"))).alias("episodes")
    sources = lines.groupBy("l_orderkey", "l_returnflag").agg(episodes)
    sources = sources.select("l_orderkey", F.struct(F.col("l_returnflag").alias("source_name"), "episodes").alias("s"))
    grouped = sources.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("s")).alias("sources"))
    return read(spark, d, "orders").join(grouped, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderstatus", "o_totalprice", "sources")


NUMBERED = """select l_orderkey as o_orderkey, l_returnflag as source_name, cast(row_number() over (partition by l_orderkey, l_returnflag
       order by l_linenumber, l_partkey, l_extendedprice) as integer) as episode, l_partkey, l_extendedprice from lineitem"""


@query("p11_explode_children", f"select o_orderkey, source_name, episode, l_partkey, l_extendedprice from ({NUMBERED}) semi join orders using (o_orderkey)")
def p11(spark, d):
    return extract.explode_children(nested(spark, d)).select("o_orderkey", "source_name", "episode", "l_partkey", "l_extendedprice")


@query(
    "p12_denormalise_children",
    f"select o_orderkey, o_orderstatus, source_name, episode, l_partkey, coalesce(l_extendedprice, o_totalprice) as price from ({NUMBERED}) join orders using (o_orderkey)",
)
def p12(spark, d):
    rows = extract.explode_children(nested(spark, d))
    return rows.select("o_orderkey", "o_orderstatus", "source_name", "episode", "l_partkey", F.coalesce("l_extendedprice", "o_totalprice").alias("price"))


@query(
    "p13_seasons_episodes",
    """with c as (select page_id, regexp_extract_all(html, '<ul>[\\s\\S]*?</ul>') as blocks from pages),
       b as (select page_id, unnest(blocks) as block, generate_subscripts(blocks, 1) as season from c),
       h as (select page_id, season, regexp_extract_all(block, 'href="([^"]*)"', 1) as links from b)
       select page_id, cast(season as integer) as season, cast(len(links) as integer) as n_links,
       array_to_string(list_transform(list_filter(list_transform(range(len(links)), lambda i: struct_pack(i := i, x := links[i + 1])), lambda s: list_position(links, s.x) = s.i + 1), lambda s: s.x), ',') as urls from h""",
)
def p13(spark, d):
    blocks = markup.nested_lists(read(spark, d, "pages"), "page_id", "ul")
    return blocks.select("page_id", F.col("block").alias("season"), F.col("n_all").alias("n_links"), "urls")


@query(
    "p13_nested_seasons",
    """with n as (select page_id, regexp_extract_all(regexp_extract(html, '<nav>[\\s\\S]*?</nav>'), '<a [^>]*href="([^"]*)"', 1) as links from pages where html is not null),
       b as (select page_id, links, unnest(range(1, 2 * len(links) + 1)) as i from n)
       select page_id, 1 as season, 'season-' || page_id as season_id, cast(i as integer) as episode, links[(i - 1) % len(links) + 1] as url from b""",
)
def p13_nested(spark, d):
    """Each page's menu put into a season by its id, again in a list within the list, and outside of all seasons."""
    nav = F.regexp_extract("html", r"<nav>[\s\S]*?</nav>", 0)
    wrapped = F.concat(
        F.lit('<div id="season-'), F.col("page_id").cast("string"), F.lit('"><ul class="eps all">'), nav, F.lit("<li><ul>"), nav,
        F.lit('</ul></li></ul></div><div id="season-x"></div><div id="other">'), nav, F.lit("</div>"),
    )
    rows = markup.seasons_episodes(read(spark, d, "pages").select("page_id", wrapped.alias("html")), "page_id", "div[id^=season-]", "ul.eps a[href]")
    return rows.where("season is not null").select("page_id", "season", "season_id", "episode", F.col("value").alias("url"))


SCRIPT = "concat('var player = {\"url\":\"https:\\/\\/h.example\\/', cast(event_id as {s}), '\",\"k\":1};')"


@query("p14_embedded_json", "select event_id, 'https://h.example/' || event_id as play_url, cast(json_extract_string(props, '$.k') as integer) as k from events")
def p14(spark, d):
    page = F.concat(F.lit('<script>var player = {"url":"https:\\/\\/h.example\\/'), F.col("event_id").cast("string"), F.lit('","k":1};</script>'))
    rows = read(spark, d, "events").withColumn("page", page)
    return rows.select("event_id", extract.embedded_json(F.col("page"), "player").alias("play_url"), F.get_json_object("props", "$.k").cast("int").alias("k"))


@query(
    "p15_slash_metadata",
    """select o_orderkey, case when o_orderkey % 2 = 0 then o_orderpriority end as category, case when o_orderkey % 2 = 0 then o_orderstatus end as region,
       case when o_orderkey % 2 = 0 and o_orderkey % 4 > 0 then cast(year(o_orderdate) as integer) end as year from orders""",
)
def p15(spark, d):
    rows = read(spark, d, "orders")
    year = F.when(F.col("o_orderkey") % 4 > 0, F.year("o_orderdate").cast("string")).otherwise("soon")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws(" / ", "o_orderpriority", "o_orderstatus", year)).otherwise(F.col("o_orderpriority"))
    return rows.select("o_orderkey", extract.slash_metadata(text).alias("m")).select("o_orderkey", "m.*")


EDGES = LINKS + f""", r as (select url as src, {RESOLVED.format(h="href")} as dst from links),
       edges as (select distinct src, dst from r where regexp_extract(src, '^[a-z]+://([^/?#]+)', 1) = regexp_extract(dst, '^[a-z]+://([^/?#]+)', 1)
       and not regexp_matches(dst, '(?i)\\.(css|js|png|jpe?g|gif|svg|ico|woff2?|pdf|zip)$'))"""


@query("p16_link_table", EDGES + " select src, dst from edges where dst not in (select url from pages where url is not null)")
def p16(spark, d):
    pages = read(spark, d, "pages")
    return extract.link_table(pages, pages)


@query(
    "p16_crawl_depth",
    EDGES.replace("with ", "with recursive ", 1) + """, seeds as (select distinct url from pages where url is not null and url not in (select dst from edges where src <> dst)),
       reach(url, depth) as (select url, 0 from seeds union select dst, depth + 1 from reach join edges on src = url where depth < 64) select url, min(depth) as depth from reach group by url""",
)
def p16_depth(spark, d):
    pages = read(spark, d, "pages")
    edges = extract.link_table(pages)
    linked = edges.where("src <> dst").select(F.col("dst").alias("url"))
    return extract.crawl_depth(edges, pages.where("url is not null").join(linked, "url", "left_anti"), None)


@query(
    "p17_task_grid",
    """select cast(n_nationkey as bigint) as category_id, y as year, p as page, 'https://site.example/list/' || n_nationkey || '-' || y || '-' || p || '.html' as url
       from nation, (select unnest([1996, 1997, 1998]) as y), (select unnest([1, 2, 3, 4]) as p) where not exists
       (select 1 from orders where year(o_orderdate) = y and o_custkey % 25 = n_nationkey and o_orderkey % 100 = p)""",
)
def p17(spark, d):
    grid = extract.task_grid(read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("category_id")), [1996, 1997, 1998], 4, "https://site.example/list/%d-%d-%d.html")
    landed = read(spark, d, "orders").select((F.col("o_custkey") % 25).alias("category_id"), F.year("o_orderdate").alias("year"), (F.col("o_orderkey") % 100).cast("int").alias("page"))
    return grid.join(landed, ["category_id", "year", "page"], "left_anti").select("category_id", "year", "page", "url")


@query("p18_first_link", f"with f as (select page_id, url, list_filter({HREFS}, lambda x: regexp_matches(x, 'e')) as l from pages) select page_id, case when len(l) > 0 then {RESOLVED.format(h='l[1]')} end as play_url from f")
def p18(spark, d):
    return read(spark, d, "pages").select("page_id", extract.first_link(F.col("html"), "e", F.col("url")).alias("play_url"))


@query("p19_keyword_presence", "select page_id, k as keyword from pages, (select unnest(['article', 'footer', 'iframe', 'middot']) as k) where contains(html, k)")
def p19(spark, d):
    return extract.keyword_presence(read(spark, d, "pages"), ["article", "footer", "iframe", "middot"]).select("page_id", "keyword")


#: A long list: words, beginnings and ends of them, one that nothing has, and one twice.
MANY = [*"article rticle art footer foot iframe middot nav main aside script style header head form button href title span div".split(), "the", "he ", "nowhere", "nav"]


@query("p19_many_keywords", f"select page_id, k as keyword from pages, (select unnest({MANY}) as k) where contains(html, k)")
def p19_many(spark, d):
    return extract.keyword_presence(read(spark, d, "pages"), MANY).select("page_id", "keyword")


@query("r10_many_phrases", "select page_id from pages where html is null or " + " or ".join(f"contains(html, '{x}')" for x in [f"ad {i}" for i in range(1, 40)]))
def r10_many(spark, d):
    return read(spark, d, "pages").where(route.error_page(F.col("html"), [f"ad {i}" for i in range(1, 40)])).select("page_id")


# routing


@query("r01_year_range", "select o_orderkey from orders where year(o_orderdate) between 1996 and 1998")
def r01(spark, d):
    return read(spark, d, "orders").where(route.year_range(F.year("o_orderdate"), 1996, 1998, keep_unknown=True)).select("o_orderkey")


@query("r02_search", "select p_partkey, p_name, p_retailprice from part where p_type = 'ECONOMY' and contains(p_name, 'ring') order by p_retailprice desc, p_partkey limit 20")
def r02(spark, d):
    found = route.search(read(spark, d, "part"), {"p_type": "ECONOMY"}, {"p_name": "ring"}, [F.desc("p_retailprice"), F.col("p_partkey")], 20)
    return found.select("p_partkey", "p_name", "p_retailprice")


@query(
    "r03_route_url_episode",
    "select page_id, case when regexp_matches(u, '(?i)-s[0-9]+e[0-9]+|-[0-9]+x[0-9]+|season-[0-9]+|episode-[0-9]+') then 'tv_episodes' else 'movies' end as target"
    " from (select page_id, case page_id % 4 when 0 then url || '-s01e02' when 1 then url || '-2x03' else url end as u from pages)",
)
def r03(spark, d):
    url = F.when(F.col("page_id") % 4 == 0, F.concat("url", F.lit("-s01e02"))).when(F.col("page_id") % 4 == 1, F.concat("url", F.lit("-2x03"))).otherwise(F.col("url"))
    return read(spark, d, "pages").select("page_id", F.when(route.is_episode_url(url), "tv_episodes").otherwise("movies").alias("target"))


@query(
    "r04_route_badge",
    "select l_orderkey, l_linenumber, l_partkey, case when l_returnflag = 'A' then 'tv' else 'movie' end as kind, case when l_returnflag = 'A' then l_linenumber end as season,"
    " case when l_returnflag = 'A' then cast(l_quantity as integer) end as episode from lineitem",
)
def r04(spark, d):
    text = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("s"), F.col("l_linenumber").cast("string"), F.lit("-e"), F.col("l_quantity").cast("int").cast("string"))).otherwise("HD")
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", route.badge(text).alias("b")).select("l_orderkey", "l_linenumber", "l_partkey", "b.*")


@query("r05_route_category_status", "select event_id, case when event_type in ('view', 'click') then 'tv' when event_type in ('signup') and regexp_matches(props, '7') then 'tv' else 'movie' end as target from events")
def r05(spark, d):
    target = route.by_category_status(F.col("event_type"), F.col("props"), ["signup"], ["view", "click"], "7")
    return read(spark, d, "events").select("event_id", target.alias("target"))


@query(
    "r06_route_rules",
    """with s as (select l_orderkey, count(*) as n, max(l_linenumber) as top, max(c) as per_source from lineitem join (select l_orderkey, l_returnflag, count(*) as c from lineitem group by 1, 2) using (l_orderkey, l_returnflag) group by 1)
       select o_orderkey, case when o_orderpriority = '1-URGENT' then 'tv' when top > 6 or n > 5 then 'tv' when per_source > 2 then 'tv' else 'movie' end as target,
       case when o_orderpriority = '1-URGENT' then 'category' when top > 6 or n > 5 then 'episodes' when per_source > 2 then 'pages' else 'default' end as reason from orders join s on o_orderkey = l_orderkey""",
)
def r06(spark, d):
    numbers = F.flatten(F.transform("sources", lambda s: F.transform(s["episodes"], lambda e: e["l_linenumber"])))
    most = F.array_max(F.transform("sources", lambda s: F.size(s["episodes"])))
    rules = [
        (F.col("o_orderpriority") == "1-URGENT", "tv", "category"),
        ((F.array_max(numbers) > 6) | (F.size(numbers) > 5), "tv", "episodes"),
        (most > 2, "tv", "pages"),
    ]
    rows = nested(spark, d).join(read(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey")
    return rows.select("o_orderkey", route.by_rules(rules, ("movie", "default")).alias("r")).select("o_orderkey", "r.*")


@query("r07_determine_type", "select p_partkey, case when regexp_matches(lower(p_type), 'series|tv|drama') then 'series' when contains(lower(p_name), 'season') then 'series' when p_size > 25 then 'series' else 'movie' end as kind from part")
def r07(spark, d):
    return read(spark, d, "part").select("p_partkey", route.determine_type(F.col("p_type"), F.col("p_name"), F.col("p_size") - 24).alias("kind"))


@query("r08_route_path_segment", "select page_id, contains(url, '/en/') as is_en, cast(len(string_split(regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1), '/')) - 1 as integer) as depth from pages")
def r08(spark, d):
    return read(spark, d, "pages").select("page_id", F.contains("url", F.lit("/en/")).alias("is_en"), route.path_depth(F.col("url")).alias("depth"))


@query("r09_reject_index_pages", "select page_id, case when not regexp_matches(url, '^https?://') then 'not_http' when regexp_matches(url, '/de/|/es/') then 'index_url' end as reason from pages")
def r09(spark, d):
    title = values.first_match(F.col("html"), r"<title>([^<]*)</title>")
    url = F.regexp_replace("url", "/(de|es)/", "/page/")
    return read(spark, d, "pages").select("page_id", route.reject_index(url, title, "Home").alias("reason"))


@query("r10_reject_error_pages", "select page_id from pages where html is null or contains(html, 'ad 1') or contains(html, 'not found')")
def r10(spark, d):
    return read(spark, d, "pages").where(route.error_page(F.col("html"), ["ad 1", "not found"])).select("page_id")


@query("r11_page_echo_check", "select page_id, (try_cast(nullif(regexp_extract(html, 'track\\(([0-9]+)\\)', 1), '') as bigint) = page_id and regexp_matches(html, '<li>')) as valid from pages")
def r11(spark, d):
    return read(spark, d, "pages").select("page_id", route.page_echo(F.col("html"), r"track\(([0-9]+)\)", F.col("page_id"), "<li>").alias("valid"))


PAGED = "select o_orderkey, o_custkey % 50 as page, cast(year(o_orderdate) as integer) as y from orders"


@query("r12_page_mismatch_check", f"with p as ({PAGED}) select o_orderkey from p where page in (select page from p group by page having avg(case when abs(y - 1997) > 2 then 1.0 else 0.0 end) <= 0.35)")
def r12(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("page"), F.year("o_orderdate").alias("y"), F.lit(1997).alias("wanted"))
    return route.off_pages(rows, ["page"], "y", "wanted", 0.35).select("o_orderkey")


@query("r13_redirect_check", "select page_id, (rtrim(url, '/') = 'https://home.example' or not contains(url, '/en/')) as redirected from pages")
def r13(spark, d):
    return read(spark, d, "pages").select("page_id", route.redirected(F.col("url"), F.lit("https://home.example/"), F.lit("/en/")).alias("redirected"))


@query("r14_drop_ads", LINKS + " select page_id, pos, href from links where regexp_matches(href, '^/') and not contains(link_text, 'th')")
def r14(spark, d):
    return extract.extract_links(read(spark, d, "pages"), "^/").where(~F.contains("link_text", F.lit("th"))).select("page_id", "pos", "href")


@query("r15_quality_present", "select p_partkey, p_name from part where p_brand <> '' order by p_partkey limit 10")
def r15(spark, d):
    return quality.present(read(spark, d, "part"), "p_brand").orderBy("p_partkey").select("p_partkey", "p_name").limit(10)


@query("r16_classify_page", "select page_id, case when regexp_matches(html, '\\$\\$\\$') then 'list' when regexp_matches(html, '<footer>&copy; m\\.') then 'movie' when regexp_matches(html, 'lang=\"de\"') then 'series' else 'other' end as kind from pages")
def r16(spark, d):
    return read(spark, d, "pages").select("page_id", route.classify_page(F.col("html"), r"\$\$\$", r"<footer>&copy; m\.", 'lang="de"').alias("kind"))


@query("r17_has_next", "select page_id, (contains(html, 'next page') or contains(url, 'page=2')) as has_next from pages")
def r17(spark, d):
    html = F.concat("html", F.replace("url", F.lit("page=2"), F.lit("page/2")))
    return read(spark, d, "pages").select("page_id", route.has_next(html, "next page", F.lit(1)).alias("has_next"))


# scalar functions


@query("f01_extract_id", "select page_id, coalesce(try_cast(nullif(regexp_extract(url, '/(?:de|es)/([0-9]+)', 1), '') as bigint), try_cast(nullif(regexp_extract(url, '/(?:en|fr)/([0-9]+)', 1), '') as bigint)) as vod_id from pages")
def f01(spark, d):
    return read(spark, d, "pages").select("page_id", urls.extract_id(F.col("url"), [r"/(?:de|es)/([0-9]+)", r"/(?:en|fr)/([0-9]+)"]).alias("vod_id"))


@query("f02_url_resolve", LINKS + f" select page_id, pos, {RESOLVED.format(h='h')} as link from (select *, case pos % 4 when 0 then href when 1 then '/' || href when 2 then substr(href, 2) else url end as h from links)")
def f02(spark, d):
    rows = extract.extract_links(read(spark, d, "pages"))
    h = F.when(F.col("pos") % 4 == 0, F.col("href")).when(F.col("pos") % 4 == 1, F.concat(F.lit("/"), "href")).when(F.col("pos") % 4 == 2, F.substr("href", F.lit(2))).otherwise(F.col("url"))
    return rows.select("page_id", "pos", urls.resolve_url(F.col("url"), h).alias("link"))


@query("f03_url_canonical", "select page_id, string_split(url, '?')[1] as plain, case when ends_with(string_split(url, '?')[1], '#top') then string_split(url, '?')[1] else string_split(url, '?')[1] || '#top' end as with_fragment from pages")
def f03(spark, d):
    return read(spark, d, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("plain"), urls.canonical_url(F.col("url"), "top").alias("with_fragment"))


@query("f04_url_slug", "select page_id, string_split(string_split(url, '?')[1], '/')[-1] as slug, case when page_id % 2 = 0 then cast(1900 + page_id % 100 as integer) end as year from pages")
def f04(spark, d):
    name = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("film-"), (1900 + F.col("page_id") % 100).cast("string"))).otherwise(F.lit("film-x"))
    return read(spark, d, "pages").select("page_id", urls.slug(F.col("url")).alias("slug"), urls.slug_year(name).alias("year"))


@query(
    "f05_extract_year",
    """select doc_id, cast(coalesce(nullif(regexp_extract(text, '\\.((?:19|20)[0-9]{2})\\.', 1), ''), nullif(regexp_extract(text, '(?i)(?:year|年份|año)\\s*[:：/]\\s*((?:19|20)[0-9]{2})', 1), ''),
       nullif(regexp_extract(text, '(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)', 1), '')) as integer) as year from documents""",
)
def f05(spark, d):
    return read(spark, d, "documents").select("doc_id", values.extract_year(F.col("text")).alias("year"))


@query(
    "f06_extract_quality",
    "select p_partkey, case when contains(lower(p_name), 'small') then 'S' when contains(lower(p_name), 'red') then 'R' when contains(lower(p_name), 'ring') then 'G' else 'Unknown' end as quality from part",
)
def f06(spark, d):
    labels = (("small", "S"), ("red", "R"), ("ring", "G"))
    return read(spark, d, "part").select("p_partkey", values.extract_quality(F.col("p_name"), labels).alias("quality"))


@query(
    "f07_season_episode",
    "select l_orderkey, l_partkey, l_linenumber, case when l_linenumber % 5 < 4 then l_linenumber else 1 end as season, case when l_linenumber % 5 < 4 then cast(l_quantity as integer) else 1 end as episode from lineitem",
)
def f07(spark, d):
    s, e = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string")
    forms = [F.concat(F.lit("x-s"), s, F.lit("e"), e), F.concat(F.lit("x-"), s, F.lit("x"), e), F.concat(F.lit("season-"), s, F.lit("-episode-"), e), F.concat(F.lit("a "), s, F.lit(" - "), e)]
    kind = F.col("l_linenumber") % 5
    text = F.when(kind == 0, forms[0]).when(kind == 1, forms[1]).when(kind == 2, forms[2]).when(kind == 3, forms[3]).otherwise("film")
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", values.season_episode(text, (1, 1)).alias("x")).select("l_orderkey", "l_partkey", "l_linenumber", "x.*")


@query("f08_series_title", "select p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') as title from part")
def f08(spark, d):
    slug = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-s01e02-hd"))
    return read(spark, d, "part").select("p_partkey", values.series_title(slug).alias("title"))


@query(
    "f09_normalise_duration",
    """select p_partkey, case p_size % 4 when 0 then p_size // 10 || 'h ' || (10 + p_size) || 'm' when 1 then p_size || ' min' when 2 then '' else cast(p_size as varchar) end as compat,
       case p_size % 4 when 0 then ((p_size // 10) * 60 + 10 + p_size) // 60 || 'h ' || ((p_size // 10) * 60 + 10 + p_size) % 60 || 'm' when 2 then '' else p_size // 60 || 'h ' || p_size % 60 || 'm' end as fixed,
       cast(case p_size % 4 when 0 then (p_size // 10) * 60 + 10 + p_size when 2 then null else p_size end as integer) as minutes from part""",
)
def f09(spark, d):
    size = F.col("p_size")
    clock = F.concat(F.floor(size / 10).cast("string"), F.lit(":"), (size + 10).cast("string"))
    text = F.when(size % 4 == 0, clock).when(size % 4 == 1, F.concat(size.cast("string"), F.lit(" min"))).when(size % 4 == 2, F.lit("N/A")).otherwise(size.cast("string"))
    # a clock's minutes may pass 59 here; compat writes hours and minutes anew
    rows = read(spark, d, "part").withColumn("t", text)
    hm = F.concat(F.floor(size / 10).cast("string"), F.lit("h "), (size + 10).cast("string"), F.lit("m"))
    compat = values.normalise_duration(F.when(size % 4 == 0, hm).otherwise(F.col("t")))
    return rows.select("p_partkey", compat.alias("compat"), values.normalise_duration(F.col("t"), False).alias("fixed"), values.duration_minutes(F.col("t")).alias("minutes"))


@query("f10_parse_rating", "select doc_id, coalesce(try_cast(nullif(regexp_extract(text, '([0-9]+(?:\\.[0-9]+)?)', 1), '') as double), 0.0) as rating from documents")
def f10(spark, d):
    return read(spark, d, "documents").select("doc_id", values.parse_rating(F.col("text")).alias("rating"))


@query("f11_parse_count", "select o_orderkey, o_orderkey * 1000 + 234 as n from orders")
def f11(spark, d):
    mark = F.when(F.col("o_orderkey") % 2 == 0, F.lit(",")).otherwise(F.lit("."))
    return read(spark, d, "orders").select("o_orderkey", values.parse_count(F.concat(F.col("o_orderkey").cast("string"), mark, F.lit("234"))).alias("n"))


@query("f12_count_stars", "select page_id, cast(len(regexp_extract_all(html, '<br>')) as integer) as stars from pages")
def f12(spark, d):
    return read(spark, d, "pages").select("page_id", values.count_matches(F.col("html"), "<br>").alias("stars"))


@query(
    "f13_parse_status",
    "select l_orderkey, l_partkey, l_linenumber, case when l_linenumber % 4 < 2 then l_linenumber end as total, case when l_linenumber % 4 < 3 then l_linenumber end as current from lineitem",
)
def f13(spark, d):
    n, kind = F.col("l_linenumber").cast("string"), F.col("l_linenumber") % 4
    text = F.when(kind == 0, F.concat(F.lit("全"), n, F.lit("集"))).when(kind == 1, F.concat(n, F.lit("集全"))).when(kind == 2, F.concat(F.lit("更新至第"), n, F.lit("集"))).otherwise("HD")
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", values.parse_status(text).alias("s")).select("l_orderkey", "l_partkey", "l_linenumber", "s.*")


@query("f14_episode_number", "select l_orderkey, l_partkey, l_linenumber, case l_linenumber % 5 when 3 then 9999 when 4 then 0 else l_linenumber end as episode from lineitem")
def f14(spark, d):
    n, kind = F.col("l_linenumber").cast("string"), F.col("l_linenumber") % 5
    name = F.when(kind == 0, F.concat(F.lit("第"), n, F.lit("集"))).when(kind == 1, n).when(kind == 3, F.lit("全集")).otherwise("film")
    url = F.when(kind == 2, F.concat(F.lit("https://h.example/play-"), n, F.lit(".html"))).otherwise("https://h.example/")
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", values.episode_number(name, url).alias("episode"))


@query("f15_season_from_title", "select l_orderkey, l_partkey, l_linenumber, case when l_linenumber % 4 < 3 then l_linenumber else 1 end as season from lineitem")
def f15(spark, d):
    n, kind = F.col("l_linenumber").cast("string"), F.col("l_linenumber") % 4
    title = F.when(kind == 0, F.concat(F.lit("剧第"), n, F.lit("季"))).when(kind == 1, F.concat(F.lit("Show Season "), n)).when(kind == 2, F.concat(F.lit("S"), n, F.lit("E01"))).otherwise("film")
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", values.season_from_title(title).alias("season"))


@query("f16_clean_title", "select p_partkey, trim(replace(replace('- ' || p_name || ' |', 'red', ''), 'small', ''), ' -|') as title from part")
def f16(spark, d):
    return read(spark, d, "part").select("p_partkey", values.clean_title(F.concat(F.lit("- "), "p_name", F.lit(" |")), ["red", "small"]).alias("title"))


@query(
    "f17_classify_tokens",
    """with t as (select doc_id, string_split(text, ' ') as t from documents)
       select doc_id, list_filter(t, lambda x: regexp_full_match(x, '(19|20)[0-9]{2}'))[1] as year, list_filter(t, lambda x: regexp_full_match(x, '[0-9]{3,4}p'))[1] as resolution,
       list_filter(t, lambda x: regexp_full_match(x, '[0-9]+(h|m|min)'))[1] as duration from t""",
)
def f17(spark, d):
    return read(spark, d, "documents").select("doc_id", values.classify_tokens(F.split("text", " ")).alias("c")).select("doc_id", "c.*")


@query("f18_join_values", "select user_id, array_to_string(list_sort(list(distinct event_type)), ', ') as types, cast(count(distinct event_type) as integer) as n from events group by user_id")
def f18(spark, d):
    joined = values.join_values(F.collect_set("event_type")).alias("types")
    return read(spark, d, "events").groupBy("user_id").agg(joined).select("user_id", "types", F.size(values.split_values(F.col("types"))).alias("n"))


@query("f19_prefer", "select event_id, coalesce(nullif(case when event_id % 3 = 0 then '' else event_type end, ''), props) as text from events")
def f19(spark, d):
    return read(spark, d, "events").select("event_id", values.prefer(F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")), F.col("props")).alias("text"))


@query("f20_content_hash", "select doc_id, md5(concat_ws('|', 'lang=' || coalesce(lang, ''), 'source=' || coalesce(source, ''), 'text=' || coalesce(text, ''))) as hash from documents")
def f20(spark, d):
    return read(spark, d, "documents").select("doc_id", values.content_hash(["doc_id", "text", "lang", "source"], ("doc_id",)).alias("hash"))


@query("f21_script_test", "select doc_id, regexp_matches(text, '[一-鿿]') as cjk, regexp_matches(text, '[0-9]') as digit, length(regexp_replace(text, '[^\\p{L}\\p{N}_\\s]', '', 'g')) as n_plain from documents")
def f21(spark, d):
    text = F.col("text")
    return read(spark, d, "documents").select("doc_id", values.has_cjk(text).alias("cjk"), text.rlike("[0-9]").alias("digit"), F.length(values.without_punctuation(text)).cast("long").alias("n_plain"))


@query("f22_ms_and_hour", "select event_id, value / 1000.0 as seconds, cast(hour(ts) as integer) as hour from events")
def f22(spark, d):
    return read(spark, d, "events").select("event_id", values.ms_to_s(F.col("value")).alias("seconds"), F.hour("ts").alias("hour"))


TURNS = T.ArrayType(T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType())]))


@query("f23_json_round_trip", "select conv_id, turn, role from conversations")
def f23(spark, d):
    packed = values.json_pack(F.collect_list(F.struct("turn", "role"))).alias("episodes")
    rows = read(spark, d, "conversations").groupBy("conv_id").agg(packed)
    return rows.select("conv_id", F.explode(F.from_json("episodes", TURNS)).alias("e")).select("conv_id", "e.*")


@query("f24_reshape_children", "select conv_id, turn + 1 as episode, coalesce(nullif(role, 'system'), 'unknown') as line from conversations")
def f24(spark, d):
    rows = read(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role")).alias("t"))
    line = lambda x: F.coalesce(F.nullif(x["role"], F.lit("system")), F.lit("unknown"))
    shaped = values.reshape_children(F.col("t"), {"episode": lambda x: x["turn"] + 1, "line": line})
    return rows.select("conv_id", F.explode(shaped).alias("e")).select("conv_id", "e.*")


@query("f25_placeholder_test", "select event_id, event_id % 3 < 2 as placeholder from events")
def f25(spark, d):
    text = F.when(F.col("event_id") % 3 == 0, " ... ").when(F.col("event_id") % 3 == 1, "…").otherwise("text")
    return read(spark, d, "events").select("event_id", values.is_placeholder(text).alias("placeholder"))
