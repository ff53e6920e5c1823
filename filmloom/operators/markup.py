"""Nested HTML to rows: every element of a page with its place in the tree, or those that selectors match."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end a sibling of their own kind.
SIBLINGS = frozenset("p li dt dd tr td th option".split())
ELEMENT = "array<struct<node:int,parent:int,depth:int,tag:string,path:string,attributes:map<string,string>,text:string>>"


class _Walk(HTMLParser):
    """The open elements of a page, in page order; an end tag closes what is open within it, a stray one is ignored."""

    def __init__(self) -> None:
        super().__init__()
        self.found: list[dict] = []
        self.open: list[dict] = []

    def begin(self, tag: str, attributes: dict[str, str]) -> dict:
        """What is kept of an element while it is open, at least its tag."""
        raise NotImplementedError

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open and tag in SIBLINGS and self.open[-1]["tag"] == tag:
            self.open.pop()
        element = self.begin(tag, {k: v or "" for k, v in attrs})
        if tag not in VOID:
            self.open.append(element)

    def handle_endtag(self, tag: str) -> None:
        if any(x["tag"] == tag for x in self.open):
            while self.open.pop()["tag"] != tag:
                pass


class _Tree(_Walk):
    """Every element with its parent, path and own text."""

    def begin(self, tag: str, attributes: dict[str, str]) -> dict:
        parent = self.open[-1] if self.open else None
        path = f"{parent['path']}/{tag}" if parent else tag
        node = {"node": len(self.found), "parent": parent["node"] if parent else None, "depth": len(self.open), "tag": tag, "path": path}
        self.found.append(node | {"attributes": attributes, "text": ""})
        return self.found[-1]

    def handle_data(self, data: str) -> None:
        if self.open:
            self.open[-1]["text"] += data


_PART = re.compile(r"(?P<tag>\*|[\w-]+)|#(?P<id>[\w-]+)|\.(?P<name>[\w-]+)|\[\s*(?P<key>[\w:-]+)\s*(?:(?P<how>[~^$*|]?=)\s*(?P<value>\"[^\"]*\"|'[^']*'|[^\]\s]+)\s*)?\]")
_HOW = {
    "=": lambda a, b: a == b, "~=": lambda a, b: b in a.split(), "^=": lambda a, b: b != "" and a.startswith(b),
    "$=": lambda a, b: b != "" and a.endswith(b), "*=": lambda a, b: b != "" and b in a, "|=": lambda a, b: a == b or a.startswith(b + "-"),
}


class Compound(NamedTuple):
    """One element of a selector: whether it must be the child of the one before, its tag, and tests of its attributes."""

    child: bool
    tag: str
    tests: tuple[tuple[str, str, str], ...]

    def fits(self, tag: str, attributes: dict[str, str]) -> bool:
        if self.tag not in ("*", tag):
            return False
        return all(k in attributes and (how == "" or _HOW[how](attributes[k], v)) for k, how, v in self.tests)


def compiled(selector: str) -> list[tuple[Compound, ...]]:
    """Selectors between commas: tags, #id, .class and [attribute] tests (=, ~=, ^=, $=, *=, |=), within or > child of others."""
    out = []
    for one in re.split(r",(?![^\[]*\])", selector):
        if one.count("[") != one.count("]"):
            raise ValueError(f"can't read {one!r} in {selector!r}")
        chain, child = [], False
        for word in re.findall(r">|(?:\[[^\]]*\]|[^\s>\[])+", one):
            if word == ">":
                if child or not chain:
                    raise ValueError(f"nothing before > in {selector!r}")
                child = True
                continue
            tag, tests, at = "*", [], 0
            while at < len(word):
                m = _PART.match(word, at)
                if not m or (m["tag"] and at):
                    raise ValueError(f"can't read {word[at:]!r} in {selector!r}")
                at = m.end()
                if m["tag"]:
                    tag = m["tag"].lower()
                elif m["id"]:
                    tests.append(("id", "=", m["id"]))
                elif m["name"]:
                    tests.append(("class", "~=", m["name"]))
                else:
                    tests.append((m["key"].lower(), m["how"] or "", (m["value"] or "").strip("\"'")))
            chain.append(Compound(child, tag, tuple(tests)))
            child = False
        if not chain or child:
            raise ValueError(f"no element at the end of {selector!r}")
        out.append(tuple(chain))
    return out


class _Matcher(_Walk):
    """Elements that selectors match, in one pass: each open element knows which beginnings of each selector end at it or above it."""

    def __init__(self, wanted: dict[str, list[tuple[Compound, ...]]], container: list[tuple[Compound, ...]]):
        super().__init__()
        self._chains = [(name, chain) for name, chains in [*wanted.items(), (None, container)] for chain in chains]
        self._node = 0

    def begin(self, tag: str, attributes: dict[str, str]) -> dict:
        parent = self.open[-1] if self.open else None
        own, above, names = [], [], []
        for i, (name, chain) in enumerate(self._chains):
            here, around = (parent["own"][i], parent["above"][i]) if parent else (0, 0)
            mask = 0
            for k, part in enumerate(chain):
                before = 1 << k >> 1
                if (k == 0 or (here if part.child else around) & before) and part.fits(tag, attributes):
                    mask |= 1 << k
            own.append(mask)
            above.append(around | mask)
            if mask >> (len(chain) - 1) and name not in names:
                names.append(name)
        box = parent["box"] if parent else None
        element = {"tag": tag, "own": own, "above": above, "box": self._node if None in names else box, "rows": parent["rows"] if parent else []}
        rows = [{"name": x, "node": self._node, "container": box, "tag": tag, "attributes": list(attributes.items()), "text": []} for x in names if x is not None]
        self.found += rows
        element["rows"] = element["rows"] + rows
        self._node += 1
        return element

    def handle_data(self, data: str) -> None:
        for row in self.open[-1]["rows"] if self.open else ():
            row["text"].append(data)


def elements(pages: DataFrame, key: str, source: str = "html") -> DataFrame:
    """key, node, parent, depth, tag, path, attributes and own text of every element; a null page has none.

    Parsing needs a program, so it is one Arrow step; what follows (children of a list, seasons with their episodes)
    are joins and aggregates over parent and path.
    """
    rows = pages.select(key, F.coalesce(F.col(source), F.lit("")).alias("_html"))
    schema = rows.select(key).withColumn("found", F.lit(None).cast(ELEMENT)).schema
    fields = [("node", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("path", pa.string())]
    kind = pa.list_(pa.struct([*fields, ("attributes", pa.map_(pa.string(), pa.string())), ("text", pa.string())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, found = batch.slice(at, 64), []
                for page in part.column("_html").to_pylist():
                    tree = _Tree()
                    tree.feed(page)
                    tree.close()
                    found.append([x | {"attributes": list(x["attributes"].items())} for x in tree.found])
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(found, kind)], names=[key, "found"])

    return rows.mapInArrow(run, schema).select(key, F.inline("found"))


def select(pages: DataFrame, key: str, wanted: dict[str, str], container: str | None = None, source: str = "html") -> DataFrame:
    """key, name, node, container, tag, attributes and text of every element that one of the selectors matches, in one pass a page.

    wanted has a selector for each name. node counts a page's elements from 0; container is the node of the nearest element
    around that the container's selector matches. text is all text within, its white space as one space each.
    """
    chains, box = {n: compiled(x) for n, x in wanted.items()}, compiled(container) if container else []
    rows = pages.select(key, F.coalesce(F.col(source), F.lit("")).alias("_html"))
    item = "array<struct<name:string,node:int,container:int,tag:string,attributes:map<string,string>,text:string>>"
    schema = rows.select(key).withColumn("found", F.lit(None).cast(item)).schema
    fields = [("name", pa.string()), ("node", pa.int32()), ("container", pa.int32()), ("tag", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("text", pa.string())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, found = batch.slice(at, 64), []
                for page in part.column("_html").to_pylist():
                    matcher = _Matcher(chains, box)
                    matcher.feed(page)
                    matcher.close()
                    found.append([x | {"text": " ".join("".join(x["text"]).split())} for x in matcher.found])
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(found, pa.list_(pa.struct(fields)))], names=[key, "found"])

    return rows.mapInArrow(run, schema).select(key, F.inline("found"))


def seasons_episodes(pages: DataFrame, key: str, season: str, episode: str, attribute: str = "href", source: str = "html") -> DataFrame:
    """key, season, season_id, episode, value and title: each element that matches `episode`, by the season's element around it.

    Seasons are numbered from 1 in page order, episodes from 1 within their season; season_id is the element's id. An
    episode belongs to the nearest season around it, and one outside of all seasons to none.
    """
    found = select(pages, key, {"season": season, "episode": episode}, season, source)
    seasons = found.where("name = 'season'").select(F.col(key).alias("_k"), F.col("node").alias("_box"), F.col("attributes").getItem("id").alias("season_id"))
    seasons = seasons.withColumn("season", F.row_number().over(Window.partitionBy("_k").orderBy("_box")))
    value = F.col("attributes").getItem(attribute)
    items = found.where((F.col("name") == "episode") & value.isNotNull()).select(key, "node", "container", value.alias("value"), F.col("text").alias("title"))
    items = items.withColumn("episode", F.row_number().over(Window.partitionBy(key, "container").orderBy("node")))
    joined = items.join(seasons, F.col(key).eqNullSafe(F.col("_k")) & (F.col("container") == F.col("_box")), "left")
    return joined.select(key, "season", "season_id", "episode", "value", "title")


def within(path: Column, *tags: str) -> Column:
    """Whether an element lies in these elements, the outermost first, at any depth."""
    return F.concat(F.lit("/"), path).rlike("/" + "/(?:[^/]+/)*".join(re.escape(x) for x in tags) + "/")


def nested_lists(pages: DataFrame, key: str, container: str, item: str = "a[href]", attribute: str = "href", source: str = "html") -> DataFrame:
    """key, block (the number of a container from 1), n, urls: its items' values in page order, distinct and joined by commas.

    container and item are selectors. An item belongs to the innermost container around it, also where lists nest.
    """
    found = select(pages, key, {"box": container, "item": item}, container, source)
    boxes = found.where("name = 'box'").select(key, F.col("node").alias("_box"))
    boxes = boxes.withColumn("block", F.row_number().over(Window.partitionBy(key).orderBy("_box")))
    value = F.col("attributes").getItem(attribute)
    items = found.where((F.col("name") == "item") & value.isNotNull()).groupBy(F.col(key).alias("_k"), F.col("container").alias("_c"))
    items = items.agg(F.sort_array(F.collect_list(F.struct("node", value.alias("v")))).alias("_l"))
    joined = boxes.join(items, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_box") == F.col("_c")), "left")
    values = F.coalesce(F.array_distinct(F.col("_l.v")), F.array().cast("array<string>"))
    return joined.select(key, "block", F.size(values).alias("n"), F.array_join(values, ",").alias("urls"), F.coalesce(F.size("_l"), F.lit(0)).alias("n_all"))
