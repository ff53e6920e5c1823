"""Frequent groups, packed filters, keyword lists and selectors against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from filmloom.functions import keywords
from filmloom.operators import aggregate, extract, markup, quality, route

# frequent groups


@pytest.mark.parametrize("kind", ["heavy", "even", "few", "ties", "none"])
def test_top_groups(spark, kind):
    rng = random.Random(7)
    values = {
        "heavy": [int(rng.paretovariate(0.7)) for _ in range(20000)], "even": [i % 5000 for i in range(20000)], "few": [i % 3 for i in range(100)],
        "ties": [i % 40 for i in range(4000)], "none": [],
    }[kind]
    df = spark.createDataFrame([(v if v % 11 else None, str(v % 7)) for v in values], "a long, b string").repartition(6)
    want = sorted(Counter((v if v % 11 else None, str(v % 7)) for v in values).items(), key=lambda x: (-x[1], x[0][0] is not None, x[0][0] or 0, x[0][1]))
    got = aggregate.top_groups(df, "a", "b", n=10, tracked=256).collect()
    assert [((r.a, r.b), r.n) for r in got] == want[:10]


def test_certain_tops_shuffle_candidates_alone(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(aggregate, "counts_by", lambda *a, **k: calls.append(1))
    df = spark.range(200000).selectExpr("if(id % 3 > 0, id % 12, id) as k")
    got = aggregate.top_groups(df, "k", n=5, tracked=1024).collect()
    assert [r.n for r in got] == [16668, 16668, 16667, 16667, 16667] or min(r.n for r in got) > 16000
    assert not calls  # 66,667 keys stand once or twice; none of them was counted


# packed filters


def test_filter_is_packed_and_never_misses(spark):
    keys = spark.range(20000).selectExpr("concat('k', id) as key")
    probes = spark.range(20000, 120000).selectExpr("concat('k', id) as key", "id")
    for per_key, most in ((16, 0.008), (32, 0.001)):
        bits = 20000 * per_key
        words = quality.bloom_words(keys, "key", bits)
        assert words.count() <= bits // 64 and words.columns == ["word", "mask"]
        assert quality.maybe_seen(keys, "key", words, bits).where(~F.col("maybe_seen")).count() == 0
        seen = quality.maybe_seen(probes, "key", words, bits)
        assert seen.columns == ["key", "id", "maybe_seen"]
        rate = seen.where("maybe_seen").count() / 100000
        assert 0 < rate < most


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_filter_on_either_side_of_the_broadcast_limit(spark, monkeypatch, limit):
    monkeypatch.setattr(quality, "BROADCAST", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.createDataFrame([(None,), ("a",), ("a",), ("b",)], "key string")
        got = quality.maybe_seen(rows, "key", quality.bloom_words(rows.where("key = 'a'"), "key", 1 << 16), 1 << 16)
        assert sorted((r.key or "", r.maybe_seen) for r in got.collect()) == [("", False), ("a", True), ("a", True), ("b", False)]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (limit > 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="1 to 10"):
        quality.bloom_words(rows, "key", 64, 11)


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_membership_is_exact(spark, bits):
    """Also where every bit of the filter is set; repeated and null keys."""
    rows = spark.range(3000).selectExpr("id as key", "id % 7 as other").union(spark.createDataFrame([(None, 1), (4, 2)], "key long, other long"))
    keys = rows.where("key % 2 = 0 or key is null")
    got = quality.seen(rows, "key", keys, bits)
    assert got.columns == ["key", "other", "seen"] and got.count() == 3002
    assert got.where("seen is distinct from (key % 2 = 0)").count() == 0


def test_membership_over_more_keys_than_bits(spark, tmp_path):
    """The query on a table whose keys are too many for a million bits."""
    from filmloom import catalog_queries

    spark.range(400000).selectExpr("id * 3 as c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    got = catalog_queries.queries()["q09_bloom_membership"](spark, str(tmp_path))
    assert got.count() == 400000 and got.where("maybe_seen is distinct from (c_custkey % 2 = 0)").count() == 0


# keyword lists


@pytest.mark.parametrize("n", [0, 1, keywords.CHAIN, keywords.CHAIN + 1, 60])
def test_keyword_lists(spark, n):
    rng = random.Random(n)
    words = [*["he", "she", "hers", "s", "", "é", "he"], *("".join(rng.choices("hers ", k=rng.randrange(1, 5))) for _ in range(60))][:n]
    texts = [None, "", "ushers", "x", "é", *("".join(rng.choices("hers x", k=30)) for _ in range(20))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, html string").repartition(3)
    want = {i: None if x is None else [k for k, w in enumerate(words, 1) if w in x] for i, x in enumerate(texts)}
    assert {r.id: r.hits for r in df.select("id", keywords.keyword_hits(F.col("html"), words).alias("hits")).collect()} == want
    pairs = sorted((r.id, r.keyword) for r in extract.keyword_presence(df, words).collect())
    assert pairs == sorted((i, words[k - 1]) for i, hits in want.items() for k in hits or [])
    assert {r.id for r in df.where(route.error_page(F.col("html"), words)).collect()} == {i for i, hits in want.items() if hits is None or hits}
    verdict = quality.page_verdict(F.upper("html"), words[: n // 2], words[n // 2 :])
    for r in df.select("id", verdict.alias("v")).collect():
        low = None if texts[r.id] is None else texts[r.id].upper().lower()
        bad, good = ([w for w in part if low is not None and w in low] for part in (words[: n // 2], words[n // 2 :]))
        assert tuple(r.v) == (("invalid", "no page") if low is None else ("invalid", bad[0]) if bad else ("valid", good[0]) if good else ("unknown", ""))


# selectors

PAGE = """<div id=season-1 class="box se"><h3>One</h3><ul><li><a href=/1>E <b>1</b></a><li><a href=/2>E2</a><ul><li><a href=/2b>x</a></ul></ul></div>
<div id="season-2"></div><div id='season-3'><p><a href=/3 rel="next up">E3</a><a name=n>no link</a></p></div><a href=/out>out</a><DIV id=extra><a HREF=/4>4</a></div>"""


def found(spark, selector, page=PAGE, container=None):
    df = spark.createDataFrame([(1, page)], "k long, html string")
    return [(r.attributes.get("href") or r.attributes.get("id") or r.tag, r.container) for r in markup.select(df, "k", {"x": selector}, container).orderBy("node").collect()]


@pytest.mark.parametrize(
    ("selector", "hrefs"),
    [
        ("div[id^=season-]", ["season-1", "season-2", "season-3"]), ("#season-1 a", ["/1", "/2", "/2b"]), ("div#season-1 > ul > li > a", ["/1", "/2"]),
        (".se li li a", ["/2b"]), ("div.box.se h3", ["h3"]), ("a[rel~=up]", ["/3"]), ("a[href='/3'], a[href$=b]", ["/2b", "/3"]), ("div > a", ["/4"]),
        ("a[href*=out]", ["/out"]), ("DIV[id|=season] > p a[href]", ["/3"]), ("* ul", ["ul", "ul"]), ("li>a", ["/1", "/2", "/2b"]), ("div div", []), ("a[href^='']", []),
    ],
)
def test_selectors(spark, selector, hrefs):
    assert [x for x, _ in found(spark, selector)] == hrefs


@pytest.mark.parametrize("selector", ["", "> a", "a >", "a > > b", "a:hover", "a[", "b,", "a!b"])
def test_selectors_that_cant_be_read(selector):
    with pytest.raises(ValueError, match="selector|element|nothing|can't read"):
        markup.compiled(selector)


def test_nearest_container(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<ul><a href=z>")], "k long, html string")
    got = markup.seasons_episodes(df, "k", "div[id^=season-]", "a").orderBy("k", "season", "episode").collect()
    assert [(r.season, r.season_id, r.episode, r.value, r.title) for r in got if r.season] == [
        (1, "season-1", 1, "/1", "E 1"), (1, "season-1", 2, "/2", "E2"), (1, "season-1", 3, "/2b", "x"), (3, "season-3", 1, "/3", "E3"),
    ]
    assert sorted(r.value for r in got if r.season is None) == ["/4", "/out", "z"]
    lists = markup.nested_lists(df, "k", "ul", "li > a[href]").orderBy("k", "block").collect()
    assert [(r.k, r.block, r.n, r.urls) for r in lists] == [(1, 1, 2, "/1,/2"), (1, 2, 1, "/2b"), (3, 1, 0, "")]


def test_within_means_whole_tags(spark):
    df = spark.createDataFrame([("article/b/i",), ("a/x/b/i",), ("a/b",), ("body/a/b/c",), ("ab/b/i",)], "path string")
    got = {r.path: (r.x, r.y) for r in df.select("path", markup.within(F.col("path"), "a", "b").alias("x"), markup.within(F.col("path"), "b").alias("y")).collect()}
    assert got == {"article/b/i": (False, True), "a/x/b/i": (True, True), "a/b": (False, False), "body/a/b/c": (True, True), "ab/b/i": (False, True)}


# columns and their values


def test_columns_and_values(spark):
    df = spark.createDataFrame([("1", None, 2.5), ("x", None, None), (None, None, 1.0)], "a string, b string, c double")
    assert [tuple(r) for r in quality.value_mismatches(df, {"a": "int", "b": "int", "c": "int", "z": "int"}).collect()] == [("a", "int", 2, 1), ("b", "int", 0, 0), ("c", "int", 2, 2), ("z", "int", 0, 0)]
    assert [tuple(r) for r in quality.column_difference(df, ["a", "q"]).collect()] == [("q", "missing", 0), ("c", "extra", 2)]
    assert quality.column_difference(df, ["a", "b", "c"]).count() == 0 == quality.column_difference(df.limit(0), ["a"]).count()
