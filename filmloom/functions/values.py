"""Column functions that normalise values of catalog records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from filmloom.functions.urls import first_match

#: Keywords of a quality label, the first that occurs wins.
QUALITIES = (("2160p", "4K"), ("4k", "4K"), ("1080p", "1080p"), ("720p", "720p"), ("bluray", "BluRay"), ("web", "WEB"), ("hd", "HD"))
#: Fixed value: the number of a film in one piece among episodes.
WHOLE = 9999


def extract_year(*texts: Column) -> Column:
    """The first of: `.2023.` in the first text, a labelled year, any year from 1900 to 2099 in the others."""
    tries = [first_match(texts[0], r"\.((?:19|20)\d{2})\.")]
    tries += [first_match(x, r"(?i)(?:year|年份|año)\s*[:：/]\s*((?:19|20)\d{2})") for x in texts]
    tries += [first_match(x, r"(?:^|[^0-9])((?:19|20)\d{2})(?:[^0-9]|$)") for x in texts]
    return F.coalesce(*tries).cast("int")


def url_year(url: Column) -> Column:
    return F.coalesce(first_match(url, r"/year/(\d{4})"), first_match(url, r"-(\d{4})\.html")).cast("int")


def extract_quality(text: Column, labels: tuple[tuple[str, str], ...] = QUALITIES, default: str = "Unknown") -> Column:
    """The label of the first keyword, in the order of the list, that the text holds."""
    lower = F.lower(text)
    out = F.when(F.contains(lower, F.lit(labels[0][0])), labels[0][1])
    for word, label in labels[1:]:
        out = out.when(F.contains(lower, F.lit(word)), label)
    return out.otherwise(default)


def season_episode(text: Column, default: tuple[int, int] | None = None) -> Column:
    """season and episode of `s01e02`, `1x02`, `season-1-episode-2` or `1 - 2`; else the default pair or NULLs."""
    patterns = (r"(?i)s(\d+)e(\d+)", r"(?:^|[^0-9])(\d+)x(\d+)", r"(?i)season-(\d+)-episode-(\d+)", r"(?:^|[^0-9])(\d+) - (\d+)")
    pair = lambda s, e: F.struct(s.cast("int").alias("season"), e.cast("int").alias("episode"))
    found = [F.when(text.rlike(p), pair(F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2))) for p in patterns]
    fallback = pair(F.lit(default[0]), F.lit(default[1])) if default else pair(F.lit(None), F.lit(None))
    return F.coalesce(*found, fallback)


def series_title(slug: Column) -> Column:
    """A slug without its episode suffix, hyphens as spaces, words capitalised."""
    cut = F.regexp_replace(slug, r"(?i)-?s\d+e\d+.*$", "")
    cut = F.regexp_replace(cut, r"(?i)-season-\d+.*$", "")
    cut = F.regexp_replace(cut, r"-\d+x\d+.*$", "")
    return F.initcap(F.trim(F.replace(cut, F.lit("-"), F.lit(" "))))


_CLOCK = r"^(\d+):(\d+)$"


def _clock_minutes(text: Column) -> Column:
    return F.regexp_extract(text, _CLOCK, 1).try_cast("int") * 60 + F.regexp_extract(text, _CLOCK, 2).try_cast("int")


def duration_minutes(text: Column) -> Column:
    """Minutes of `1:40`, `1h 22m`, `95 min` or `95`."""
    # nothing found is null before the cast: try_cast raises and catches for each text that isn't a number
    hours, minutes = (first_match(text, rf"(\d+)\s*{x}").try_cast("int") for x in "hm")
    clock = F.when(text.rlike(_CLOCK), _clock_minutes(text))
    return F.coalesce(clock, hours * 60 + F.coalesce(minutes, F.lit(0)), minutes, first_match(text, r"^(\d+)$").try_cast("int"))


def _with(value: Column, made: Callable[[Column], Column]) -> Column:
    """made of a value that is worked out once, however often made names it; else each name is a copy of its expression."""
    return F.try_element_at(F.transform(F.array(value), made), F.lit(1))


def _hours_and_minutes(n: Column) -> Column:
    return F.concat(F.floor(n / 60).cast("string"), F.lit("h "), (n % 60).cast("string"), F.lit("m"))


def normalise_duration(text: Column, compat: bool = True) -> Column:
    """`1:40` as `1h 40m`; NULL and `N/A` as ''. compat leaves what holds an h or m as it is, so `120 min` stays."""

    def written(plain: Column) -> Column:
        out = F.when((plain == "") | (F.lower(plain) == "n/a"), "")
        if compat:
            clock = (F.length(plain) <= 5) & plain.rlike(_CLOCK)
            return out.when(F.lower(plain).rlike("[hm]"), plain).when(clock, _with(_clock_minutes(plain), _hours_and_minutes)).otherwise(plain)
        return out.otherwise(F.coalesce(_with(duration_minutes(plain), _hours_and_minutes), plain))

    return _with(F.coalesce(F.trim(text), F.lit("")), written)


def parse_rating(text: Column, default: float | None = 0.0) -> Column:
    found = first_match(text, r"(\d+(?:\.\d+)?)").try_cast("double")
    return found if default is None else F.coalesce(found, F.lit(default))


def parse_count(text: Column) -> Column:
    return F.regexp_replace(text, "[.,]", "").try_cast("bigint")


def parse_status(text: Column) -> Column:
    """total and current: `全N集` or `N集全` is complete, `更新至第N集` is at N of an unknown total."""
    whole = F.coalesce(first_match(text, r"全(\d+)集"), first_match(text, r"(\d+)集全")).cast("int")
    now = first_match(text, r"更新至(?:第)?(\d+)集").cast("int")
    return F.struct(whole.alias("total"), F.coalesce(whole, now).alias("current"))


def episode_number(name: Column, url: Column) -> Column:
    """`第N集` or `第N期`, bare digits, then the URL's `-N.html`; WHOLE for collections; else 0."""
    tries = [first_match(name, r"第(\d+)[集期]"), first_match(name, r"^\s*(\d+)\s*$"), first_match(url, r"-(\d+)\.html$")]
    number = F.coalesce(*[x.try_cast("int") for x in tries], F.lit(0))
    return F.when(name.rlike("全集|完结|合集"), F.lit(WHOLE)).otherwise(number)


def season_from_title(title: Column) -> Column:
    tries = [first_match(title, r"第(\d+)季"), first_match(title, r"(?i)season\s*(\d+)"), first_match(title, r"(?i)s(\d+)e")]
    return F.coalesce(*[x.try_cast("int") for x in tries], F.lit(1))


def clean_title(title: Column, phrases: list[str]) -> Column:
    """Phrases removed one after another, then spaces, hyphens and bars off both ends."""
    for x in phrases:
        title = F.replace(title, F.lit(x), F.lit(""))
    return F.regexp_replace(title, r"^[ \-|]+|[ \-|]+$", "")


def classify_tokens(tokens: Column) -> Column:
    """year, resolution and duration among unordered tokens: the first of each kind."""
    pick = lambda p: F.try_element_at(F.filter(tokens, lambda x: x.rlike(p)), F.lit(1))
    return F.struct(
        pick(r"^(19|20)\d{2}$").alias("year"), pick(r"^\d{3,4}p$").alias("resolution"), pick(r"^\d+(h|m|min)$").alias("duration")
    )


def prefer(*columns: Column) -> Column:
    """The first column that isn't NULL or empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def null_sentinels(c: Column, *sentinels: object) -> Column:
    for x in sentinels:
        c = F.nullif(c, F.lit(x))
    return c


def content_hash(columns: list[str], exclude: tuple[str, ...] = ()) -> Column:
    """md5 over name=value pairs in order of name; NULL is written as nothing."""
    names = sorted(x for x in columns if x not in exclude)
    return F.md5(F.concat_ws("|", *[F.concat(F.lit(f"{x}="), F.coalesce(F.col(x).cast("string"), F.lit(""))) for x in names]))


def is_one_of(c: Column, known: list[str]) -> Column:
    """A per-value predicate as a column: the trimmed value is one of a list, in any case."""
    return F.upper(F.trim(c)).isin([x.upper() for x in known])


def count_matches(text: Column, pattern: str) -> Column:
    """How often a pattern occurs, such as the images of lit stars."""
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def join_values(items: Column, separator: str = ", ") -> Column:
    return F.array_join(F.sort_array(items), separator)


def split_values(text: Column, separator: str = ", ") -> Column:
    return F.split(text, separator)


def ms_to_s(ms: Column) -> Column:
    return ms / 1000.0


def json_pack(children: Column) -> Column:
    """An array of structs as JSON text, in order."""
    return F.to_json(F.sort_array(children))


def reshape_children(children: Column, fields: dict[str, Callable[[Column], Column]]) -> Column:
    """An array of structs as an array of other structs, each field made of the old element."""
    return F.transform(children, lambda x: F.struct(*[f(x).alias(name) for name, f in fields.items()]))


def last_page(url: Column) -> Column:
    """The largest page number in a URL, 1 without any."""
    numbers = F.transform(F.regexp_extract_all(url, F.lit(r"[?&]page=([0-9]+)"), F.lit(1)), lambda x: x.try_cast("int"))
    return F.coalesce(F.array_max(numbers), F.lit(1))


def has_cjk(text: Column) -> Column:
    return text.rlike("[一-鿿]")


def without_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}\p{N}_\s]", "")


def is_placeholder(text: Column) -> Column:
    return F.trim(text).isin("...", "…")


def strip_unprintable(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x1f\x7f-\x9f]", "")
