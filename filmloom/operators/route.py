"""Predicates that filter records or send them to a table, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.functions.keywords import keyword_hits
from filmloom.functions.urls import first_match

EPISODE_URL = r"(?i)-s\d+e\d+|-\d+x\d+|season-\d+|episode-\d+"
BADGE = r"^s(\d+)-e(\d+)"


def year_range(year: Column, low: int, high: int, keep_unknown: bool = False) -> Column:
    inside = year.between(low, high)
    return inside | year.isNull() | (year == 0) if keep_unknown else inside


def search(df: DataFrame, equal: dict[str, object] | None = None, contains: dict[str, str] | None = None, order: list[Column] | None = None, limit: int | None = None) -> DataFrame:
    """All filters that are given, in the given order, with a limit."""
    for c, x in (equal or {}).items():
        df = df.where(F.col(c) == x)
    for c, x in (contains or {}).items():
        df = df.where(F.contains(F.col(c), F.lit(x)))
    df = df.orderBy(*order) if order else df
    return df if limit is None else df.limit(limit)


def is_episode_url(url: Column) -> Column:
    return url.rlike(EPISODE_URL)


def badge(text: Column) -> Column:
    """kind, season and episode of a card's badge such as `s3-e9`."""
    tv = text.rlike(BADGE)
    number = lambda i: F.when(tv, F.regexp_extract(text, BADGE, i).cast("int"))
    return F.struct(F.when(tv, "tv").otherwise("movie").alias("kind"), number(1).alias("season"), number(2).alias("episode"))


def by_category_status(category: Column, status: Column, movies: list[object], series: list[object], running: str) -> Column:
    """The category decides, but a film whose status speaks of episodes is a series; unknown ones are films."""
    return F.when(category.isin(series), "tv").when(category.isin(movies) & status.rlike(running), "tv").otherwise("movie")


def by_rules(rules: list[tuple[Column, str, str]], default: tuple[str, str]) -> Column:
    """target and reason of the first rule (condition, target, reason) that holds."""
    out = None
    for condition, target, reason in rules:
        pair = F.struct(F.lit(target).alias("target"), F.lit(reason).alias("reason"))
        out = F.when(condition, pair) if out is None else out.when(condition, pair)
    return out.otherwise(F.struct(F.lit(default[0]).alias("target"), F.lit(default[1]).alias("reason")))


def determine_type(genre: Column, title: Column, n_episodes: Column) -> Column:
    return (
        F.when(F.lower(genre).rlike("series|tv|drama"), "series")
        .when(F.contains(F.lower(title), F.lit("season")), "series")
        .when(n_episodes > 1, "series")
        .otherwise("movie")
    )


def path_depth(url: Column) -> Column:
    """Slashes after the host."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/]+(/[^?#]*)", 1)
    return F.size(F.split(path, "/")) - 1


def reject_index(url: Column, title: Column, home_title: str) -> Column:
    """Why a record is an index page, or NULL."""
    return (
        F.when(~url.rlike("^https?://"), "not_http")
        .when(url.rlike("/page/|/year/"), "index_url")
        .when(title == home_title, "home_title")
    )


def error_page(html: Column, phrases: list[str]) -> Column:
    """Whether there is no page, or it holds one of the phrases."""
    return html.isNull() | (F.size(keyword_hits(html, phrases)) > 0)


def off_pages(df: DataFrame, page: list[str], value: str, wanted: str, most: float = 0.5, slack: int = 2) -> DataFrame:
    """Rows of the pages of which at most a share is off the wanted value by more than the slack."""
    off = F.when(F.abs(F.col(value) - F.col(wanted)) > slack, 1.0).otherwise(0.0)
    share = df.groupBy(*page).agg(F.avg(off).alias("off_share")).where(F.col("off_share") <= most)
    return df.join(share.select(*page), page, "left_semi")


def page_echo(html: Column, shown: str, wanted: Column, card: str) -> Column:
    """Whether a page shows the number that was asked for, and has any card."""
    return (first_match(html, shown).try_cast("bigint") == wanted) & html.rlike(card)


def redirected(final_url: Column, base: Column, segment: Column) -> Column:
    """Whether a fetch ended at the home page or lost its path segment."""
    return (F.rtrim(final_url, F.lit("/")) == F.rtrim(base, F.lit("/"))) | ~F.contains(final_url, segment)


def classify_page(html: Column, card: str, lines: str, detail: str) -> Column:
    return F.when(html.rlike(card), "list").when(html.rlike(lines), "movie").when(html.rlike(detail), "series").otherwise("other")


def has_next(html: Column, label: str, page: Column) -> Column:
    return F.contains(html, F.lit(label)) | F.contains(html, F.concat(F.lit("page/"), (page + 1).cast("string")))
