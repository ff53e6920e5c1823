"""Small golden cases of the catalog functions and operators."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from filmloom.functions import urls, values
from filmloom.operators import aggregate, extract, join, markup, quality, route, table, window
from filmloom.sources import readers, shared, writers
from filmloom.streaming import monitor


def column(spark, made, cases):
    """What a column expression on `x` gives for each case."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(made(F.col("x"))).collect()]


def test_season_episode(spark):
    got = column(spark, lambda c: values.season_episode(c), ["show-s01e02", "a-1x02", "season-3-episode-4", "x 1 - 2", "film", None, ""])
    assert [tuple(x) for x in got] == [(1, 2), (1, 2), (3, 4), (1, 2), (None, None), (None, None), (None, None)]
    assert tuple(column(spark, lambda c: values.season_episode(c, (1, 1)), ["film"])[0]) == (1, 1)


def test_duration(spark):
    cases = ["1:40", "1h 22m", "120 min", "N/A", None, "95", "100:40"]
    assert column(spark, values.normalise_duration, cases) == ["1h 40m", "1h 22m", "120 min", "", "", "95", "100:40"]
    assert column(spark, lambda c: values.normalise_duration(c, False), cases) == ["1h 40m", "1h 22m", "2h 0m", "", "", "1h 35m", "100h 40m"]


def test_status_and_numbers(spark):
    got = column(spark, values.parse_status, ["全30集", "30集全", "更新至第12集", "HD"])
    assert [tuple(x) for x in got] == [(30, 30), (30, 30), (None, 12), (None, None)]
    none = F.lit(None).cast("string")
    assert column(spark, lambda c: values.episode_number(c, none), ["第7集", "08", "全集", "第3期", "x"]) == [7, 8, 9999, 3, 0]
    assert column(spark, values.season_from_title, ["剧第2季", "Show Season 3", "S04E01", "x"]) == [2, 3, 4, 1]
    assert column(spark, values.parse_count, ["1.234", "1,234", "x"]) == [1234, 1234, None]
    assert column(spark, values.extract_year, ["A.2023.mkv", "Year: 1999", "in 2001", "12345"]) == [2023, 1999, 2001, None]


def test_urls(spark):
    base = F.lit("http://h.example/a/b?q=1")
    cases = ["https://x/y", "//cdn/x", "/m/1", "p.html"]
    assert column(spark, lambda c: urls.resolve_url(base, c), cases) == ["https://x/y", "https://cdn/x", "http://h.example/m/1", "http://h.example/a/p.html"]
    assert column(spark, lambda c: urls.resolve_url(base, c, None), ["//cdn/x"]) == ["http://cdn/x"]
    assert column(spark, urls.slug_year, ["film-2023", "film-x"]) == [2023, None]


def test_extract_items(spark):
    page = '<ul><li><a href="/movie/123.html">A (2023)</a></li><li><a href="/movie/9.html">B</a></li></ul>'
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    rules = [extract.Rule("href", ('href="([^"]*)"',)), extract.Rule("year", (r"\((\d{4})\)",), "int", 0)]
    got = extract.extract_items(df, "<li>.*?</li>", rules).orderBy("pos").select("page_id", "pos", "href", "year").collect()
    assert [tuple(x) for x in got] == [(1, 0, "/movie/123.html", 2023), (1, 1, "/movie/9.html", 0)]


def test_crawl_depth(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "url string")
    got = {r.url: r.depth for r in extract.crawl_depth(edges, seeds, 3).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_crawl_depth_is_whole(spark, tmp_path):
    from filmloom import catalog_queries

    # a chain of 12 pages, of which the first links to itself too, and a page by itself
    links = {k: [k + 1] for k in range(1, 12)} | {1: [1, 2], 12: [], 20: []}
    rows_ = [(k, f"http://h.example/{k}", "".join(f"<a href=\"/{x}\">x</a>" for x in to)) for k, to in links.items()]
    spark.createDataFrame(rows_, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.url: r.depth for r in catalog_queries.queries()["p16_crawl_depth"](spark, str(tmp_path)).collect()}
    assert got == {f"http://h.example/{k}": 0 if k == 20 else k - 1 for k in links}


def test_routes(spark):
    got = column(spark, route.badge, ["s3-e9", "HD"])
    assert [tuple(x) for x in got] == [("tv", 3, 9), ("movie", None, None)]
    assert column(spark, lambda c: route.reject_index(c, c, "Home"), ["ftp://x", "http://x/page/2", "Home", "http://x/m"]) == ["not_http", "index_url", "not_http", None]


def test_insert_ignore_and_upsert(spark):
    kind = "detail_url string, route_name string, year int"
    old = spark.createDataFrame([("u1", "r1", 2023)], kind)
    new = spark.createDataFrame([("u1", "r1", 1), ("u2", "r2", 2024), ("u2", "r2", 2025)], kind)
    keys = ["detail_url", "route_name"]
    assert {tuple(r) for r in table.insert_ignore(old, new, keys, "year").collect()} == {("u1", "r1", 2023), ("u2", "r2", 2024)}
    assert {tuple(r) for r in table.upsert(old, new, keys, ["year"]).collect()} == {("u1", "r1", 1), ("u2", "r2", 2025)}


def test_durations_are_worked_out_once(spark):
    """A duration is read once however often its text is written: copies of the expression grew to a method that Java leaves uncompiled."""
    cases = [("1:40\n", 100, "1h 40m"), ("99999999999:1", None, "99999999999:1"), ("h", None, "h"), ("1h", 60, "1h 0m"), ("9m 1h", 69, "1h 9m"), (" 95 ", None, "1h 35m"), ("1:4000", 4060, "67h 40m")]
    df = spark.createDataFrame([(t,) for t, _, _ in cases], "t string")
    made = df.select("t", values.duration_minutes(F.col("t")).alias("n"), values.normalise_duration(F.col("t"), False).alias("d"))
    assert [tuple(r) for r in made.collect()] == cases
    plan = df.select(values.normalise_duration(F.col("t"), False).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("regexp_extract(") <= 12


def test_upsert_two_keys_holds_keys_once(spark):
    """The anti-joins take the source's keys as they are: only the reductions of the source aggregate, three in each of its three uses."""
    target = spark.createDataFrame([("a", 1, 0), ("b", 2, 0), ("c", 3, 0), (None, None, 0)], "url string, n int, views int")
    source = spark.createDataFrame([("a", 9, 1), ("a", 9, 2), ("x", 3, 1), (None, 2, 1), ("y", None, 1)], "url string, n int, views int")
    got = table.upsert_two_keys(target, source, "url", ["n"], "views")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [("a", 9, 2), ("x", 3, 1), ("y", None, 1), (None, 2, 1), (None, None, 0)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") <= 9


def test_orphans_are_one_aggregate(spark):
    """Repeated keys once, null keys never, and no join with its sorts, which held both tables' keys in a task a second time."""
    c = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,), (5,)], "k long")
    p = spark.createDataFrame([(2,), (3,), (3,), (None,), (4,)], "id long")
    got = quality.orphans(c, "k", p, "id")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "child"), (3, "parent"), (4, "parent"), (5, "child")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


def test_upsert_two_keys(spark):
    kind = "url string, series string, season int, episode int, views int"
    old = spark.createDataFrame([("s1e1", "S", 1, 1, 100)], kind)
    new = spark.createDataFrame([("s1e1-new", "S", 1, 1, 200)], kind)
    assert [tuple(r) for r in table.upsert_two_keys(old, new, "url", ["series", "season", "episode"]).collect()] == [tuple(new.first())]


def test_validation(spark):
    rows = [(1, 12345, ""), (2, 0, "x"), (3, -1, "y"), (4, 10001, "a"), (5, 10001, "b"), (6, 10002, "a")]
    df = spark.createDataFrame(rows, "i int, vod_id long, title string")
    got = quality.validate_items(df, ["vod_id", "title"], "vod_id", F.col("title"), ["i"]).orderBy("i").collect()
    assert [r.reason for r in got] == ["missing title", "missing vod_id", None, None, "duplicate id", "duplicate content"]
    child = "array<struct<n:int,url:string>>"
    df = spark.createDataFrame([(1, [(1, "u")]), (2, [(1, "u"), (None, None)]), (3, []), (4, None)], f"i int, episodes {child}")
    got = quality.validate_children(df, "episodes", ["n", "url"]).orderBy("i").collect()
    assert [r.reason for r in got] == [None, "child 2 misses n", "missing episodes", "missing episodes"]


def test_duplicates_and_bloom(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 1), (4, 3)], "id int, vod_id int")
    assert tuple(quality.duplicate_keys(df, "vod_id").first()) == (4, 3, 1)
    keys = spark.createDataFrame([(f"item_{i}",) for i in range(50)] + [("",)], "key string")
    probes = spark.createDataFrame([(f"item_{i}",) for i in range(100, 200)], "key string")
    bits = quality.bloom_words(keys, "key", 10_000, 7)
    assert quality.maybe_seen(keys, "key", bits, 10_000, 7).where("maybe_seen").count() == 51
    assert quality.maybe_seen(probes, "key", bits, 10_000, 7).where("maybe_seen").count() < 10


@pytest.mark.parametrize(("keep", "pages"), [(False, 6), (True, 7)])
def test_stop_after_known_pages(spark, keep, pages):
    flags = [False, True, True, False, True, True, True, False]
    df = spark.createDataFrame([("c", i + 1, x) for i, x in enumerate(flags)], "category string, page int, known boolean")
    stops = window.stop_after_run(df, ["category"], "page", F.col("known"), 3)
    assert stops.first().stop_page == 7
    assert window.until_stop(df, stops, ["category"], "page", keep).count() == pages


def test_subtitle_blocks(spark):
    text = "1\n00:01\nHello\n\n2\n00:02\nHi\n...\n\n3\n00:03\nHi\nsame\n\n4\n00:04\nHi\n你好\n\n5\n00:05\nHi\n!!\n\n6\n00:06\n"
    df = spark.createDataFrame([("f", text)], "file string, text string")
    got = quality.missing_translation(readers.split_lines(df, "file", "text"), "file", "line_no", "text")
    assert {r.idx: r.reason for r in got.collect()} == {"1": "missing line", "2": "placeholder", "3": "other script"}


def test_crawl_log(spark):
    lines = [
        '2024-01-01 00:00:00|s|http://h|200|["title","year"]|12345|1|2.5', "2024-01-01 00:00:00|s|http://h|404|[]|None|0|800",
        "2024-01-01 00:00:00|s|http://h|ERROR|[]|None|0|0", "invalid line", "a|b|c|d", "2024-01-01 00:00:00|s|u|invalid_status|[]|1|1|1",
    ]
    got = readers.parse_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.response_status for r in got] == [200, 404, None, None, None, None]
    assert [r.corrupt is not None for r in got] == [False, False, False, True, True, False]
    assert got[0].saved_data_fields == ["title", "year"] and got[1].saved_id is None


def test_health_plan(spark):
    rows = [(5.0, False, False)] * 10 + [(1.0, True, False)] * 10 + [(1.0, False, True)] * 10
    df = spark.createDataFrame(rows, "t double, failed boolean, repeated boolean")
    plan = monitor.health_plan(df.agg(*monitor.metrics("t", F.col("failed"), F.col("repeated")))).first()
    assert plan.actions == ["reduce", "retry", "bloom"] and plan.concurrency == 32
    calm = spark.createDataFrame([(1.0, False, False)] * 10, "t double, failed boolean, repeated boolean")
    assert monitor.health_plan(calm.agg(*monitor.metrics("t", F.col("failed"), F.col("repeated")))).first().actions == []


@pytest.mark.parametrize("n", [1, 2, 20, 101])
def test_exact_percentile(spark, n):
    values_ = [(i * 7919 % 101) / 3 for i in range(n)]
    df = spark.createDataFrame([(x,) for x in values_], "v double")
    assert aggregate.exact_percentile(df, "v", 95).first()[0] == sorted(values_)[min(int(n * 0.95), n - 1)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k long, v double, t timestamp")
    assert window.ranked_sample(none, "k", 0.5).count() == 0
    assert aggregate.high_water(none, F.lit(True), "t").first().watermark == datetime.datetime(1970, 1, 1)
    assert aggregate.histogram(none, "v", 5).count() == 0
    assert table.upsert(none, none, ["k"], ["t"]).count() == 0


def test_streams_take_files_in_any_order(spark, tmp_path):
    from filmloom import catalog_queries

    # 24 files, so three batches, newest first: rows of 1,000 days, with alerts in the last hour also
    for k in range(24):
        rows_ = [(1000 * k + i, f"2024-01-01 {23 - k:02}:{i:02}:00", k, "error" if (k + i) % 7 == 0 else "view", 1.0 + k % 3) for i in range(60)]
        rows_ += [(1000 * k + 100 + i, f"20{21 + i % 3}-03-0{1 + i % 5} 0{(k + i) % 4}:30:00", 100 + k, "click" if i % 9 == 0 else "view", 1.5) for i in range(60)]
        df = spark.createDataFrame(rows_, "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    events = spark.read.parquet(f"{tmp_path}/events.parquet")
    columns = monitor.metrics("value", F.col("event_type") == "error", F.col("event_type") == "click")
    plan = monitor.health_plan(monitor.health_by_window(events, "ts", columns)).where(F.size("actions") > 0)
    wanted = {(r.window_start, ",".join(r.actions)) for r in plan.collect()}
    got = [tuple(r) for r in catalog_queries.queries()["t08_alert_stream"](spark, str(tmp_path)).select("window_start", "actions").collect()]
    assert len(got) == len(set(got)) == len(wanted) > 24 and set(got) == wanted
    assert {r.user_id for r in catalog_queries.queries()["t04_stream_dedup"](spark, str(tmp_path)).collect()} == {*range(24), *range(100, 124)}


def test_repeated_keys_do_not_fan_out(spark):
    target = spark.createDataFrame([("k", ""), ("k", "old"), ("m", "x")], "k string, v string")
    details = spark.createDataFrame([("k", "a", 1), ("k", "", 3), ("k", "b", 2), ("n", "z", 1)], "k string, v string, at int")
    assert sorted(tuple(r) for r in table.fill_missing(target, details, "k", ["v"], "at").collect()) == [("k", "b", True), ("k", "b", True), ("m", "x", False)]
    assert sorted(tuple(r) for r in extract.merge_detail(target, details, "k", ["v"], "at").collect()) == [("k", ""), ("k", ""), ("m", "x")]
    flags = spark.createDataFrame([("k", False), ("k", True), ("m", False), ("m", False)], "k string, done boolean")
    assert sorted(tuple(r) for r in join.refresh_plan(target.select("k").distinct(), flags, "k", "done").collect()) == [("k", "skip"), ("m", "refetch")]
    lines = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "f int, n int, text string")
    fixes = spark.createDataFrame([(1, 2, "x", 1), (1, 2, "y", 2), (1, 2, "a", 0)], "f int, n int, text string, at int")
    assert sorted(tuple(r) for r in join.replace_lines(lines, fixes, ["f", "n"], "text", "at").collect()) == [(1, 1, "a"), (1, 2, "y")]
    rows = details.select("k", "v", "at")
    assert sorted(tuple(r) for r in table.replace_rows(rows.limit(0), rows, ["k"], "at").collect()) == [("k", "", 3), ("n", "z", 1)]
    keyed = spark.createDataFrame([("u", 1, 10), ("u", 2, 20), ("w", 2, 30), (None, 5, 1), (None, 6, 2)], "url string, n int, views int")
    got = table.upsert_two_keys(keyed.limit(0), keyed, "url", ["n"], "views").collect()
    assert sorted((r.url or "", r.n, r.views) for r in got) == [("", 5, 1), ("", 6, 2), ("w", 2, 30)]


def test_known_items_over_pages(spark):
    # page 1 ends with 2 known, page 2 is known as a whole, page 3 breaks the run and ends with 1
    known = {1: [False, True, True], 2: [True, True], 3: [True, False, True]}
    rows = [("c", p, i, k) for p, flags in known.items() for i, k in enumerate(flags)]
    df = spark.createDataFrame(rows, "category string, page int, pos int, known boolean")
    stop = lambda k: [r.stop_page for r in window.stop_after_known_items(df, ["category"], "page", "pos", F.col("known"), k).collect()]
    assert (stop(2), stop(3), stop(4), stop(5)) == ([1], [2], [2], [])


def test_nested_markup(spark):
    page = "<body><ul><li><a href=1>a<li><ul><li><a href=2>b</a><a href=2>c</a></ul><a href=3>d</a></ul><p>x<p>y<br>z</div><ul></ul>"
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "no tags <"), (5, "</p></ul>")], "k long, html string")
    nodes = markup.elements(df, "k")
    assert {r.text for r in nodes.where("tag = 'p'").collect()} == {"x", "yz"} and nodes.where("k > 1").count() == 0
    assert [tuple(r) for r in markup.nested_lists(df, "k", "ul").orderBy("block").collect()] == [(1, 1, 2, "1,3", 2), (1, 2, 1, "2", 2), (1, 3, 0, "", 0)]
    assert markup.elements(df.limit(0), "k").count() == 0


def test_files_read_back(spark, tmp_path):
    srt = "﻿1\r\n00:01\r\nHello\r\n\r\n2\r\n00:02\r\nHi\r\n"
    (tmp_path / "a.srt").write_bytes(srt.encode())
    got = readers.read_srt(spark, str(tmp_path / "a.srt")).orderBy("line_no").collect()
    assert [r.text for r in got] == ["1", "00:01", "Hello", "", "2", "00:02", "Hi", ""] and got[0].file.endswith("a.srt")
    path = writers.export_path(str(tmp_path), "movies", "full", datetime.datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("/movies_full_20240102_030405")
    df = spark.createDataFrame([(1, 'a "b"\nc'), (2, None)], "id long, title string")
    writers.write_csv(df.coalesce(1), path, mark=True)
    assert next(iter(__import__("pathlib").Path(path).glob("part-*"))).read_bytes().startswith(b"\xef\xbb\xbfid,title")
    assert sorted(tuple(r) for r in readers.read_csv(spark, path, "id long, title string").collect()) == [(1, 'a "b"\nc'), (2, None)]
    lines = spark.createDataFrame([("f", 2, "b\tc"), ("f", 1, "a"), ("g", 1, "")], "f string, n int, text string")
    writers.write_lines(lines, str(tmp_path / "lines"), "f", "n", "text")
    assert [tuple(r) for r in readers.read_lines(spark, str(tmp_path / "lines")).where("file = 'f'").collect()] == [("f", "a"), ("f", "b\tc")]


def test_progress_callback(spark, tmp_path):
    seen = []
    listener = monitor.ProgressCallback(lambda batch, rows: seen.append(rows))
    spark.streams.addListener(listener)
    spark.range(50).write.parquet(f"{tmp_path}/in")
    rows = monitor.follow_log(spark, f"{tmp_path}/in", "id long")
    monitor.upsert_stream(rows, lambda batch, batch_id: batch.count(), f"{tmp_path}/mark").awaitTermination()
    for _ in range(50):
        if sum(seen) >= 50:
            break
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    assert sum(seen) >= 50


def test_release_deletes_what_was_written(spark):
    path = shared.new_path(spark, "kept-for-a-while")
    spark.range(3).write.parquet(path)
    assert shared.release(spark) >= 1 and shared.release(spark) == 0
