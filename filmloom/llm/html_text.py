"""Main text of web pages by template deduction over the pages of a host.

1. A page is read to tokens: opening tags by role (their path of block elements with classes) and text blocks. Over
   the pages of a host, each token has an occurrence vector: how often it stands on which pages. An aggregate that can
   be combined before the shuffle (xor of hashes of page and count) names the vector, so no page list is gathered.
   Pages of equal html are one page of their host, so copies are no evidence of a template.
2. Tokens with equal vectors form an equivalence class. A class is valid when it has CLASS_TOKENS tokens on CLASS_PAGES
   pages and on the share SHARE of the host's; valid classes nest in the one that stands on all pages, and together
   they are the host's template. The text blocks in it are boilerplate, and between its tags lie the slots. Tags of the
   template that stand once on a page nest by their paths: the innermost that holds HELD of the slot text, and
   the template's main heading, is the container.
3. Of each page the slots in the container are kept if they are half of the page's or more, else all. Of these, those of
   its article are kept alone where it holds at least half of them or has the role that holds most of the host's. An
   article whose text is template for half or more is a copy, and kept whole.
4. Elements that are menus, headers, footers, sidebars, notices, adverts, scripts or comments by name, role or class don't
   count, nor do forms. A form or a class doesn't count as such where it is around the page's article or around most of
   the slot text (of classes, those of comments never are, and those of adverts only around an article). Runs of words
   within an article's blocks or a paragraph stay, whatever their class, unless they are hidden.

Templates are joined to the pages; they are broadcast only below BROADCAST bytes, else joined by host.
Defined cases: a null or empty page has no text; a null url is a host of its own; a host with few pages has no
template; rows that repeat a page_id are read each; an empty table gives no row.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import sized_slices, stored, table

#: A class has so many tokens on so many pages; template text stands on this share of a host's pages.
CLASS_TOKENS, CLASS_PAGES, SHARE = 3, 5, 0.5
#: The share of a host's slot text that the template's container holds at least.
HELD = 0.75
BROADCAST = 32 << 20
#: Elements that end a run of text, that hold no page text, and that aren't part of an article.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table"
    " tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title noscript template iframe noembed noframes canvas audio video".split())
#: Of these, those that reach to the page's end where their end tag is missing.
UNCLOSED = frozenset("script style textarea title".split())
ASIDE = frozenset("nav header footer aside form button select menu dialog search head fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice"
    " notices notification alert sidebar widget related share sharing social newsletter subscribe subscription signup popup modal overlay"
    " menu navbar nav navigation breadcrumb breadcrumbs pagination pager footer comment comments disqus reply replies respond toolbar"
    " masthead login hidden skip".split()
)
#: Words that may stand before or after a name in a class or id word, and words that make it tell of something else.
HEADS = frozenset(
    "site page top bottom main left right side primary secondary global post article entry blog user mobile desktop sticky fixed floating"
    " my the js wp block inner outer google text is mc live section content".split()
)
TAILS = frozenset(
    "list box container wrapper wrap block area section bar links link item items button buttons btn icon icons form inner outer content"
    " body top bottom left right main primary secondary header title toggle panel group row col column slot unit text message this post"
    " posts article articles story stories news media videos products trail tab tabs count thread dropdown desktop mobile fixed sticky".split()
)
OTHER = frozenset("has no not non with without".split())
#: Names of what may hold more text than the article, and of what is never put around a page.
TALK = frozenset("comment comments disqus reply replies respond".split())
FIRM = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr".split())
#: What keeps an article element from being one, and names that are page furniture only outside of one.
NO_ARTICLE = frozenset("ad ads advert advertisement sponsored promo comment comments reply related".split())
OUTSIDE = frozenset("header masthead".split())
INSIDE = NAMES - OUTSIDE
HEADERS = frozenset(("header", "site-header", "page-header", "top-bar"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_CLOSES = {x: re.compile(f"</{x}", re.I) for x in RAW}
_PART = re.compile(r"[^a-z0-9]+")
_DIGITS = re.compile(r"[0-9]+")


class Block(NamedTuple):
    role: str
    article: int
    text: str
    marks: tuple[int, ...] = ()
    fixed: bool = False


class Mark(NamedTuple):
    """An element that looks like furniture by its class, or is a form: it counts unless it holds the page's own text."""

    kind: str
    article: int


class _Open(NamedTuple):
    tag: str
    role: str
    aside: bool
    article: int
    marks: tuple[int, ...]


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


@lru_cache(65536)
def _named(word: str, names: frozenset[str]) -> str | None:
    """The name that a class or id word is, by itself or with known words before or after it."""
    parts = [x for x in _PART.split(word) if x and not x.isdigit()]
    found = [x for x in parts if x in names]
    if not found or not OTHER.isdisjoint(parts):
        return None
    at = parts.index(found[0])
    end = len(parts) - parts[::-1].index(found[-1])
    return found[0] if HEADS.issuperset(parts[:at]) and (names | TAILS).issuperset(parts[at:end] + parts[end:]) else None


def _apart(tag: str, given: dict[str, str], article: bool, sentence: bool = False) -> str:
    """How an element is no part of an article: "aside" by its name, role or state, or as a mark (form, class, firm or talk)."""
    if tag in ASIDE and tag not in ("form", "fieldset") and not (article and tag == "header"):
        return "aside"
    role = given.get("role", "")
    if "hidden" in given or given.get("aria-hidden") == "true" or role in ROLES and role != "form":
        return "aside"
    if "display:none" in given.get("style", "").replace(" ", "").lower():
        return "aside"
    if sentence and tag not in BLOCKS:
        return ""  # a run of words within a text of its own
    words = f"{given.get('class', '')} {given.get('id', '')}".lower().split()
    kind = "form" if tag in ("form", "fieldset") or role == "form" else ""
    if not article and any(x in HEADERS for x in words):
        return "class"
    if tag in ("html", "body", "main"):
        return kind
    names = NO_ARTICLE if tag == "article" else INSIDE if article else NAMES
    found = [x for x in (_named(w, names) for w in words if len(w) < 100) if x]
    if found:
        return "talk" if not TALK.isdisjoint(found) else "firm" if not FIRM.isdisjoint(found) else "class"
    return kind


def read_page(page: str) -> tuple[list[Block], Counter[str], list[Mark], list[tuple[int, ...]]]:
    """The text blocks outside of what is no part of an article, the count of each opening tag's role, the marks, and those
    that each outermost article lies in."""
    blocks: list[Block] = []
    roles: Counter[str] = Counter()
    marks: list[Mark] = []
    articles: list[tuple[int, ...]] = []
    stack = [_Open("", "", False, 0, ())]
    run: list[str] = []

    def flush() -> None:
        if run:
            top = stack[-1]
            text = " ".join(entities.unescape("".join(run)).split())
            if text and not top.aside:
                blocks.append(Block(top.role, top.article, text, top.marks))
            run.clear()

    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[2] is None:
            if m[0][0] != "<" or m[0] == "<":
                run.append(m[0])
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                run.append(" ")
            elif any(x.tag == tag for x in stack):
                flush()
                while stack.pop().tag != tag:
                    pass
            continue
        if tag in RAW:
            if not m[3].endswith("/") or tag in ("script", "style"):
                end = _CLOSES[tag].search(page, at)
                if end:
                    close = page.find(">", end.start())
                    at = len(page) if close < 0 else close + 1
                elif tag in UNCLOSED:
                    at = len(page)
            continue
        if tag in ("br", "wbr"):
            run.append(" " * (tag == "br"))
            continue
        given = _attributes(m[3]) if m[3].strip(" /") else {}
        top = stack[-1]
        if tag in BLOCKS:
            flush()
            while (stack[-1].tag == "p") or (tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].tag == tag):
                stack.pop()
            top = stack[-1]
        apart = "aside" if top.aside else _apart(tag, given, top.article > 0, top.article > 0 or top.tag == "p")
        aside = apart == "aside"
        if tag in VOID:
            continue
        article = top.article
        if not article and not (tag == "article" and apart) and (tag in ("article", "main") or given.get("role") == "main" or given.get("itemprop") == "articleBody"):
            articles.append(top.marks)
            article = len(articles)
        if tag in BLOCKS or apart and not top.aside:
            if tag not in BLOCKS:
                flush()
            role = f"{top.role}/{tag}" + "".join(f".{_DIGITS.sub('0', x)}" for x in sorted(given.get("class", "").split()))
            roles[role] += 1
            inner = top.marks
            if apart and not aside:
                inner += (len(marks),)
                marks.append(Mark(apart, top.article))
            stack.append(_Open(tag, role, aside, article, inner))
    flush()
    return blocks, roles, marks, articles


def _mass(blocks: Iterable[Block]) -> int:
    return sum(len(b.text) for b in blocks)


def unmarked(blocks: list[Block], marks: list[Mark], articles: list[tuple[int, ...]]) -> list[Block]:
    """The blocks that aren't furniture: a mark is void where it holds the page's article, or most of its slot text."""
    mass: Counter[int] = Counter()  # by mark; -1 is the page
    within: dict[int, Counter[int]] = {k: Counter() for k in range(-1, len(marks))}
    for b in blocks:
        if not b.fixed and not any(marks[m].kind == "talk" for m in b.marks):
            for k in (-1, *b.marks):
                mass[k] += len(b.text)
                if b.article:
                    within[k][b.article] += len(b.text)
    held = Counter(m for x in articles for m in x)
    void = set()
    for k, mark in enumerate(marks):
        if mark.kind == "talk":
            continue
        many = 2 * mass[k] > mass[-1]
        if mark.article:
            holds = many and mark.kind != "firm"
        else:
            other = within[-1].total() - within[k].total()
            # a lone article, or one with more text than stands outside, is the page's; several small ones are links
            holds = bool(within[k]) and max(within[k].values()) > other and (other > 0 or held[k] == 1 or many)
            holds |= many and (mark.kind == "form" or mark.kind == "class" and held[k] == len(articles))
        if holds:
            void.add(k)
    return [b for b in blocks if void.issuperset(b.marks)]


def host_of(url: str | None) -> str:
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or "").split("/")[0].split("?")[0].split("#")[0].lower()


def _key(kind: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{text}".encode()) - (1 << 63)


def text_key(block: Block) -> int:
    return _key("text " + block.role, block.text)


def deduce_templates(pages: DataFrame) -> DataFrame:
    """host, boilerplate (keys of template text), main (the role with most slot text) and container (the role of the innermost
    tag of the template that holds most slot text), for hosts with a template."""
    kinds = "host string, token long, page long, n long, role string, chars long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_slices(batches, "html"):
            rows = []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                host, (blocks, roles, _, _) = host_of(url), read_page(page)
                mark = xxhash.xxh64_intdigest(page.encode()) >> 1
                counts = Counter((text_key(b), b.role.rpartition("/")[0], 0 if b.marks else len(b.text)) for b in blocks)
                rows += [(host, k, mark, n, role, chars * n) for (k, role, chars), n in counts.items()]
                # tags have no text: chars tells them apart
                rows += [(host, _key("tag", role), mark, n, role, -1) for role, n in roles.items()]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), types, strict=True)], names=names) if rows else _none(names, types)

    names = [x.split()[0] for x in kinds.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    # equal pages of a host count once, however many rows or urls they have
    tokens = pages.mapInArrow(run, kinds).groupBy("host", "token", "page").agg(*[F.max(x).alias(x) for x in ("n", "role", "chars")])
    vector = F.bit_xor(F.xxhash64("page", "n")).alias("vector")
    tokens = stored(tokens.groupBy("host", "token").agg(vector, F.count("*").alias("pages"), F.sum("n").alias("n"), F.max("role").alias("role"), F.sum("chars").alias("chars")), "tokens")
    classes = tokens.groupBy("host", "vector", "pages", "n").agg(F.count("*").alias("size"))
    host_pages = tokens.groupBy("host").agg(F.max("pages").alias("all_pages"))
    valid = classes.where((F.col("size") >= CLASS_TOKENS) & (F.col("pages") >= CLASS_PAGES)).select("host", "vector", "pages")
    valid = valid.join(host_pages, "host").where(F.col("pages") >= SHARE * F.col("all_pages")).select("host", "vector").distinct()
    marked = tokens.where("chars >= 0").join(valid.withColumn("fixed", F.lit(True)), ["host", "vector"], "left")
    text = marked.where("fixed").groupBy("host").agg(F.collect_list("token").alias("boilerplate"))
    slots = marked.where("fixed is null").groupBy("host", "role").agg(F.sum("chars").alias("chars"))
    main = slots.groupBy("host").agg(F.max_by("role", F.struct("chars", "role")).alias("main"))
    # tags of the template that stand once on a page nest by their paths; the innermost that holds most slot text is the container
    parts = F.split("role", "/")
    around = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    held = slots.where("role != ''").select("host", "chars", F.explode(around).alias("tag")).groupBy("host", "tag").agg(F.sum("chars").alias("held"))
    total = slots.groupBy("host").agg(F.sum("chars").alias("total"))
    once = tokens.where((F.col("chars") < 0) & (F.col("n") == F.col("pages"))).join(valid, ["host", "vector"], "left_semi").select("host", F.col("role").alias("tag"))
    # the page's heading, where the template has one, lies in the container
    heads = once.where(F.col("tag").rlike(r"/h1(\.[^/]*)?$")).groupBy("host").agg(F.collect_list("tag").alias("heads"))
    nested = once.join(held, ["host", "tag"]).join(total, "host").join(heads, "host", "left").where(F.col("held") >= HELD * F.col("total"))
    nested = nested.where(F.coalesce(F.forall("heads", lambda x: F.startswith(x, F.concat("tag", F.lit("/")))), F.lit(True)))
    container = nested.groupBy("host").agg(F.max_by("tag", F.struct(F.size(F.split("tag", "/")), "held", "tag")).alias("container"))
    known = valid.select("host").distinct()
    empty = F.array().cast("array<long>")
    out = known.join(text, "host", "left").join(main, "host", "left").join(container, "host", "left")
    return out.select("host", F.coalesce("boilerplate", empty).alias("boilerplate"), "main", "container")


def _none(names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], k) for k in types], names=names)


def main_text(page: str, boilerplate: frozenset[int], main: str | None, container: str | None = None) -> str:
    """The page's slots: of those in the template's container, if it holds most of them, those of the page's article where
    this holds most of them or has the host's main role, else all."""
    blocks, _, marks, articles = read_page(page)
    if boilerplate:
        blocks = [b._replace(fixed=text_key(b) in boilerplate) for b in blocks]
    if marks:
        blocks = unmarked(blocks, marks, articles)
    article = [b for b in blocks if b.article]
    slots = [b for b in blocks if not b.fixed]
    inner = [b for b in slots if b.article]
    if 2 * _mass(inner) <= _mass(article):
        # most of the article stands on other pages too: a copy rather than a template
        slots, inner = [b for b in blocks if b.article or not b.fixed], article
    held = [b for b in slots if container and f"{b.role}/".startswith(f"{container}/")]
    if held and 2 * _mass(held) >= _mass(slots):
        slots, inner = held, [b for b in inner if b in held]
    if inner and (2 * _mass(inner) >= _mass(slots) or any(b.role.rpartition("/")[0] == main for b in inner)):
        slots = inner
    return "\n\n".join(b.text for b in slots)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    templates = stored(deduce_templates(rows), "templates")
    size = templates.agg(F.sum(8 * F.size("boilerplate") + F.length("host") + F.length("main") + F.coalesce(F.length("container"), F.lit(0)) + 64)).first()[0] or 0
    host = F.lower(F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), r"[/?#][\s\S]*", ""))
    templates = templates.withColumnRenamed("host", "of")
    joined = rows.withColumn("host", host).join(F.broadcast(templates) if size < BROADCAST else templates, F.col("host") == F.col("of"), "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, frozenset[int]] = {}
        for batch in sized_slices(batches, "html"):
            out = []
            for page, name, fixed, main, container in zip(*(batch.column(x).to_pylist() for x in ("html", "host", "boilerplate", "main", "container")), strict=True):
                if name not in sets:
                    sets[name] = frozenset(fixed or ())
                out.append(main_text(page, sets[name], main, container))
            sizes = pa.array([len(x) for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    columns = ["page_id", "url", "html", "host", "boilerplate", "main", "container"]
    return joined.select(*columns).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
