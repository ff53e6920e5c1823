"""Field and item extraction over columns of landed HTML (rule-driven, set at a time)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.functions.keywords import keyword_hits
from filmloom.functions.urls import first_match, host, resolve_url
from filmloom.sources.shared import shared_folder

ANCHOR = r'<a[^>]*href="([^"]*)"[^>]*>([\s\S]*?)</a>'
STATIC = r"(?i)\.(css|js|png|jpe?g|gif|svg|ico|woff2?|pdf|zip)$"


class Rule(NamedTuple):
    """A field: patterns in order, the first that matches wins; then a type and a default."""

    name: str
    patterns: tuple[str, ...]
    kind: str = "string"
    default: object = None


def extract_fields(df: DataFrame, rules: list[Rule], source: str = "html") -> DataFrame:
    made = {}
    for r in rules:
        found = F.coalesce(*[first_match(F.col(source), p) for p in r.patterns]).try_cast(r.kind)
        made[r.name] = found if r.default is None else F.coalesce(found, F.lit(r.default))
    return df.withColumns(made)


def extract_items(df: DataFrame, card: str, rules: list[Rule], source: str = "html") -> DataFrame:
    """One row per match of the card pattern, with pos from 0 and the rules' fields of the fragment."""
    cards = df.select("*", F.posexplode(F.regexp_extract_all(source, F.lit(card), F.lit(0))).alias("pos", "card"))
    return extract_fields(cards, rules, "card").drop("card")


def extract_labelled(df: DataFrame, labels: list[str], source: str = "text") -> DataFrame:
    """A column per label: what follows `label:` up to the line's end."""
    pattern = "{}[ \\t]*[:：][ \\t]*([^\\n]+)"
    return df.withColumns({x.lower(): first_match(F.col(source), "(?i)" + pattern.format(x)) for x in labels})


def extract_links(df: DataFrame, keep: str | None = None, source: str = "html") -> DataFrame:
    """One row per anchor, in page order: pos, href and its text without markup."""
    every = F.regexp_extract_all(source, F.lit(ANCHOR), F.lit(0))
    rows = df.select("*", F.posexplode(every).alias("pos", "anchor"))
    rows = rows.withColumns({
        "href": F.regexp_extract("anchor", ANCHOR, 1),
        "link_text": F.regexp_replace(F.regexp_extract("anchor", ANCHOR, 2), "<[^>]*>", ""),
    }).drop("anchor")
    return rows.where(F.col("href").rlike(keep)) if keep else rows


def first_link(html: Column, keep: str, base: Column) -> Column:
    """The first href that matches, made absolute; NULL if none does."""
    hrefs = F.regexp_extract_all(html, F.lit(r'<a[^>]*href="([^"]*)"'), F.lit(1))
    return resolve_url(base, F.try_element_at(F.filter(hrefs, lambda x: x.rlike(keep)), F.lit(1)))


def conform(df: DataFrame, schema: list[tuple[str, str]], renames: dict[str, str] | None = None, defaults: dict[str, object] | None = None) -> DataFrame:
    """Rename, add what is missing with its default, cast, and put columns in the schema's order."""
    df = df.withColumnsRenamed(renames or {})
    have, defaults = set(df.columns), defaults or {}
    return df.select(*[(F.col(n) if n in have else F.lit(defaults.get(n))).cast(k).alias(n) for n, k in schema])


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(x)) for c, x in defaults.items()})


def merge_detail(items: DataFrame, details: DataFrame, key: str, columns: list[str], *order: str) -> DataFrame:
    """A list record overlaid by its detail record, whose columns win where they are present.

    Several details of a key are laid over each other in their order, or by their values where none is given, so that
    the last one's columns count and an earlier one's only where the last one's are null.
    """
    have = [c for c in columns if c in details.columns]
    place = F.struct(*order, *have)
    d = details.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_{c}") for c in have])
    joined = items.join(d, key, "left")
    mine = set(items.columns)
    made = {c: F.coalesce(f"_{c}", c) if c in mine else F.col(f"_{c}") for c in have}
    return joined.withColumns(made).drop(*[f"_{c}" for c in have])


def zip_sources(df: DataFrame, tabs: str, lists: str, label: str = "Source ") -> DataFrame:
    """The n-th name belongs to the n-th list; a missing name is the label and its number."""
    named = F.posexplode_outer(F.arrays_zip(F.col(tabs).alias("tab"), F.col(lists).alias("list"))).alias("pos", "pair")
    rows = df.select("*", named)
    name = F.coalesce(F.col("pair.tab"), F.concat(F.lit(label), (F.col("pos") + 1).cast("string")))
    return rows.select(*df.columns, "pos", name.alias("source_name"), F.col("pair.list").alias("items")).drop(tabs, lists)


def map_sources(df: DataFrame, ids: str, names: str, wanted: str, default: str) -> DataFrame:
    """A source's name by its element's id."""
    return df.withColumn("source_name", F.coalesce(F.try_element_at(F.map_from_arrays(ids, names), F.col(wanted)), F.lit(default)))


def explode_children(df: DataFrame, sources: str = "sources", episodes: str = "episodes") -> DataFrame:
    """item x source x episode from nested arrays; an episode's number is its place from 1."""
    others = [c for c in df.columns if c != sources]
    rows = df.select(*others, F.explode(sources).alias("_s"))
    rows = rows.select(*others, F.col("_s.source_name").alias("source_name"), F.posexplode(f"_s.{episodes}").alias("_p", "_e"))
    return rows.select(*others, "source_name", (F.col("_p") + 1).alias("episode"), "_e.*")


def embedded_json(source: Column, variable: str, path: str = "$.url") -> Column:
    """A field of the JSON object that a script assigns, with slashes unescaped."""
    js = F.regexp_extract(source, variable + r"\s*=\s*(\{[^}]*\})", 1)
    return F.replace(F.get_json_object(js, path), F.lit("\\/"), F.lit("/"))


def slash_metadata(text: Column) -> Column:
    """category, region, year of `a / b / 2023`; all NULL with fewer than three parts."""
    parts = F.split(text, "/")
    enough = F.size(parts) >= 3
    at = lambda i: F.when(enough, F.trim(F.try_element_at(parts, F.lit(i))))
    return F.struct(at(1).alias("category"), at(2).alias("region"), at(3).try_cast("int").alias("year"))


def link_table(pages: DataFrame, visited: DataFrame | None = None) -> DataFrame:
    """src, dst: resolved links within a page's domain, without static files and what is visited."""
    rows = extract_links(pages).select(F.col("url").alias("src"), resolve_url(F.col("url"), F.col("href")).alias("dst"))
    rows = rows.where((host(F.col("src")) == host(F.col("dst"))) & ~F.col("dst").rlike(STATIC)).distinct()
    return rows if visited is None else rows.join(visited.select(F.col("url").alias("dst")), "dst", "left_anti").select("src", "dst")


def crawl_depth(edges: DataFrame, seeds: DataFrame, most: int | None = 4) -> DataFrame:
    """url, depth: breadth-first from seeds over edges (src, dst), by a bounded number of joins, or until no page is new.

    Each step's result is checkpointed to the shared folder, so lineage doesn't grow with the depth.
    """
    shared_folder(edges.sparkSession)
    edges = edges.checkpoint()  # links are read from the pages once
    seen = seeds.select("url").distinct().withColumn("depth", F.lit(0))
    edge = seen
    if most is None:
        seen = seen.checkpoint()
        edge, depth = seen, 0
        while not edge.isEmpty():
            depth += 1
            step = edges.join(edge.select(F.col("url").alias("src")), "src", "left_semi").select(F.col("dst").alias("url")).distinct()
            edge = step.join(seen, "url", "left_anti").withColumn("depth", F.lit(depth)).checkpoint()
            seen = seen.union(edge).checkpoint() if depth % 8 == 0 else seen.union(edge)
        return seen
    for depth in range(1, most + 1):
        step = edges.join(edge.select(F.col("url").alias("src")), "src", "left_semi").select(F.col("dst").alias("url")).distinct()
        edge = step.join(seen, "url", "left_anti").withColumn("depth", F.lit(depth))
        seen = seen.union(edge)
        if depth % 2 == 0:
            seen = seen.checkpoint()
            edge = seen.where(F.col("depth") == depth)
    return seen


def task_grid(categories: DataFrame, years: list[int], pages: int, template: str) -> DataFrame:
    """Expected pages, newest year first, with their URL. categories is a dimension: a row per category."""
    rows = categories.select("*", F.explode(F.array(*[F.lit(y) for y in sorted(years, reverse=True)])).alias("year"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("page"))
    return rows.withColumn("url", F.format_string(template, F.col("category_id"), F.col("year"), F.col("page")))


def keyword_presence(df: DataFrame, keywords: list[str], source: str = "html") -> DataFrame:
    """A row for each of the keywords that occurs in the text, in the list's order."""
    if not keywords:
        return df.withColumn("keyword", F.lit("")).where(F.lit(False))
    word = F.element_at(F.array(*[F.lit(x) for x in keywords]), F.col("_place"))
    return df.select("*", F.explode(keyword_hits(F.col(source), keywords)).alias("_place")).withColumn("keyword", word).drop("_place")
