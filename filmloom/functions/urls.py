"""Column functions on URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """A regular expression's group, NULL where it doesn't match or is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def extract_id(url: Column, patterns: list[str]) -> Column:
    """The number that the first matching pattern captures."""
    return F.coalesce(*[first_match(url, p).try_cast("bigint") for p in patterns])


def host(url: Column) -> Column:
    return first_match(url, r"^[a-z]+://([^/?#]+)")


def resolve_url(base: Column, href: Column, scheme: str | None = "https") -> Column:
    """An absolute URL: full ones stay; `//x` takes the scheme (None: the base's); `/x` the base's host; others its folder."""
    origin = F.regexp_extract(base, r"^([a-z]+://[^/?#]+)", 1)
    own = F.regexp_extract(base, r"^([a-z]+:)//", 1) if scheme is None else F.lit(f"{scheme}:")
    path = F.regexp_extract(base, r"^[a-z]+://[^/?#]+([^?#]*)", 1)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(href.rlike(r"^[a-z]+://"), href)
        .when(href.startswith("//"), F.concat(own, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(origin, folder, href))
    )


def canonical_url(url: Column, fragment: str | None = None) -> Column:
    """Without its query; with a fragment at its end if it has none of that name."""
    cut = F.substring_index(url, "?", 1)
    if fragment is None:
        return cut
    return F.when(cut.endswith(f"#{fragment}"), cut).otherwise(F.concat(cut, F.lit(f"#{fragment}")))


def slug(url: Column) -> Column:
    """What follows the last slash, the query left out."""
    return F.element_at(F.split(F.substring_index(url, "?", 1), "/"), -1)


def slug_year(name: Column) -> Column:
    """A year of four digits after the last hyphen."""
    last = F.element_at(F.split(name, "-"), -1)
    return F.when(last.rlike(r"^\d{4}$"), last.cast("int"))
