"""Licence and rights notices by ordered signature rules, with DataFrame functions only.

A text is lower-cased (A-Z) and cut to words; rules are regular expressions over the words, one space between two. A
rule is tried only where its keyword occurs. Detections are intervals of words. They are taken by falling priority, the
longer one first among equals, and one that overlaps a detection already taken is suppressed, whether it lies within it,
around it or across its border: a specific name wins over a general sentence around it. What is left gives the labels,
and its best confidence the score. All of it is one expression per row, so no row ever leaves its task. Texts of more
than STRETCH words are scanned by stretches, with MARGIN words on either side, so the work grows with the text's length.

Base phrases are counted apart from the rules, overlaps included, and their labels always stay.

Defined cases: a null or empty text has no words, counts of 0, null places, empty labels and score 0; rows that repeat
a doc_id each get their own result; an empty table gives no row.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmloom.llm.common import ascii_lower, table, texts

#: Words of a text in which A-Z aren't lower-cased yet.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Words that are scanned at once, and those before and after them that are looked at as well; no rule is longer.
STRETCH, MARGIN = 4096, 96
_KIND = "array<struct<begin:int,end:int,priority:int,label:string,confidence:double>>"


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


def _versions(*numbers: str) -> list[tuple[str, str]]:
    """Label suffix and pattern of each version; a whole number is written with or without a zero after it."""
    return [(f"-{x}", x.replace(".", " ") if not x.endswith(".0") else f"{x[:-2]}(?: 0)?") for x in numbers]


def rules() -> list[Rule]:
    """The signatures: families of licences, each with its names, versions and usual sentences."""
    out: list[Rule] = []

    def add(label: str, keyword: str, pattern: str, priority: int, confidence: float) -> None:
        out.append(Rule(label, keyword, f"(?<= )(?:{pattern})(?= )", priority, confidence))

    licence, version = "licen[cs]e", "(?:(?:version|v|ver) ?)?"
    # Creative Commons: its elements, short and long names, versions, and ports to countries
    elements = {
        "by": "attribution",
        "by sa": "attribution share ?alike",
        "by nc": "attribution non ?commercial",
        "by nd": "attribution no ?deriv(?:ative)?s?(?: works)?",
        "by nc sa": "attribution non ?commercial share ?alike",
        "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",
    }
    for short, long in elements.items():
        label = f"cc-{short.replace(' ', '-')}"
        add(label, " cc by", f"cc {short}", 60 + len(short), 0.8)
        add(label, "creative commons", f"creative commons {long}(?: international| unported| generic)?(?: (?:public )?{licence})?", 60 + len(short), 0.9)
        for suffix, number in _versions("1.0", "2.0", "2.5", "3.0", "4.0"):
            add(label + suffix, " cc by", f"cc {short} {version}{number}", 70 + len(short), 0.95)
            add(label + suffix, "creative commons", f"creative commons {long} {version}{number}(?: (?:international|unported|generic))?(?: (?:public )?{licence})?", 70 + len(short), 0.97)
    add("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", 70, 0.95)
    add("cc0", "creative commons zero", f"creative commons zero(?: {licence})?", 70, 0.95)
    add("cc", "creative commons", f"creative commons(?: {licence})?", 30, 0.6)
    # GNU: names, versions, "or later" and "only"
    gnu = {
        "gpl": ("general public", "(?:gnu )?general public"),
        "lgpl": ("er general public", "(?:gnu )?lesser general public"),
        "agpl": ("affero", "(?:gnu )?affero general public"),
        "gfdl": ("free documentation", "(?:gnu )?free documentation"),
    }
    for label, (keyword, long) in gnu.items():
        add(label, keyword, f"{long} {licence}", 60 + len(label), 0.85)
        add(label, label, f"(?:gnu )?{label}", 50, 0.7)
        for suffix, number in _versions("1.0", "2.0", "2.1", "3.0"):
            later = {"-or-later": "(?: or(?: \\(?at your option\\)?)?(?: any)? later(?: version)?)", "-only": " only", "": ""}
            for end, words in later.items():
                add(label + suffix + end, keyword, f"{long} {licence} {version}{number}{words}", 70 + len(label + end), 0.96)
                add(label + suffix + end, label, f"(?:gnu )?{label} ?{version}{number}{words}", 65 + len(end), 0.9)
    add("lgpl", "library general public", f"(?:gnu )?library general public {licence}(?: {version}2(?: 0)?)?", 66, 0.9)
    # licences with a name and versions: keyword, name, versions
    named = {
        "apache": ("apache", "apache(?: software)?", ("1.0", "1.1", "2.0")),
        "mpl": ("mozilla", "mozilla public", ("1.0", "1.1", "2.0")),
        "epl": ("eclipse", "eclipse public", ("1.0", "2.0")),
        "cddl": ("common development", "common development and distribution", ("1.0", "1.1")),
        "eupl": ("european union", "european union public", ("1.0", "1.1", "1.2")),
        "osl": ("open software", "open software", ("1.0", "2.0", "2.1", "3.0")),
        "afl": ("academic free", "academic free", ("1.1", "1.2", "2.0", "2.1", "3.0")),
        "artistic": ("artistic", "(?:perl )?artistic", ("1.0", "2.0")),
        "ofl": ("open font licen", "(?:sil )?open font", ("1.0", "1.1")),
        "lppl": ("latex", "latex project public", ("1.0", "1.1", "1.2", "1.3")),
        "php": (" php licen", "php", ("3.0", "3.01")),
        "psf": ("python", "python(?: software foundation)?", ("2.0",)),
        "bsl": ("boost", "boost software", ("1.0",)),
        "busl": ("business source", "business source", ("1.0", "1.1")),
        "sspl": ("server side", "server side public", ("1.0",)),
        "cecill": ("cecill", "cecill(?: free software)?", ("1.0", "1.1", "2.0", "2.1")),
        "ms-pl": ("microsoft public", "microsoft public", ()),
        "ms-rl": ("microsoft reciprocal", "microsoft reciprocal", ()),
        "ipl": (" ibm public", "ibm public", ("1.0",)),
        "cpl": ("common public", "common public", ("1.0",)),
        "zpl": ("zope", "zope public", ("1.1", "2.0", "2.1")),
        "qpl": (" q public", "q public", ("1.0",)),
        "isc": (" isc licen", "isc", ()),
        "mit": (" mit licen", "(?:the )?mit", ()),
        "expat": (" expat licen", "(?:the )?expat", ()),
        "x11": (" x11 licen", "(?:the )?x11", ()),
        "zlib": ("zlib", "zlib(?: libpng)?", ()),
        "wtfpl": ("fuck you want", "do what the fuck you want to public", ("1.0", "2.0")),
        "odbl": ("database", "open (?:data commons open )?database", ("1.0",)),
        "odc-by": ("open data commons", "open data commons attribution", ("1.0",)),
        "pddl": ("dedication and", "public domain dedication and", ("1.0",)),
        "ogl": ("open government", "open government", ("1.0", "2.0", "3.0")),
        "bsd": (" bsd licen", "(?:modified |new |simplified |revised )?bsd", ()),
        "ncsa": ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", ()),
        "upl": ("universal permissive", "universal permissive", ("1.0",)),
        "ecl": ("educational community", "educational community", ("1.0", "2.0")),
    }
    for label, (keyword, name, versions) in named.items():
        add(label, keyword, f"{name} {licence}", 58, 0.85)
        add(label, keyword, f"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}(?: {licence})?", 55, 0.92)
        for suffix, number in _versions(*versions):
            add(label + suffix, keyword, f"{name} {licence} {version}{number}", 68, 0.96)
    for clauses, words in (("2", "2|two"), ("3", "3|three"), ("4", "4|four"), ("0", "0|zero")):
        add(f"bsd-{clauses}-clause", "bsd", f"(?:(?:{words}) clause bsd|bsd (?:{words}) clause)(?: {licence})?", 66, 0.95)
    # sentences of licence texts and of the notices that point to them
    add("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software", 80, 0.99)
    add("mit", "copies or substantial portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 80, 0.98)
    add("isc", "permission to use", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee", 80, 0.98)
    add("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted", 75, 0.97)
    add("bsd-2-clause", "redistributions of source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 76, 0.9)
    add("bsd-3-clause", "neither the name", "neither the name of (?:\\S+ ){1,12}may be used to endorse or promote products", 78, 0.97)
    add("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 78, 0.98)
    add("apache-2.0", "except in compliance", "you may not use (?:this file|these files|the work) except in compliance with the license", 80, 0.95)
    add("apache-2.0", "apache org licenses", "(?:http )?(?:www )?apache org licenses license 2 0", 79, 0.97)
    add("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license v 2 0", 80, 0.99)
    add("mpl-2.0", "mozilla org mpl", "mozilla org mpl 2 0", 79, 0.95)
    add("epl-2.0", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)?(?: 2 0)?", 80, 0.97)
    add("gpl", "free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 80, 0.98)
    add("lgpl", "free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 81, 0.98)
    add("agpl", "free software", "you can redistribute it and or modify it under the terms of the gnu affero general public license", 81, 0.98)
    add("gpl", "copy of the gnu general public", "you should have received a copy of the gnu general public license along with", 78, 0.95)
    add("gpl", "gnu org licenses", "(?:http )?(?:www )?gnu org licenses gpl(?: [0-9] [0-9])?", 76, 0.9)
    add("gfdl", "invariant sections", "with no invariant sections no front cover texts and no back cover texts", 80, 0.97)
    add("bsl", "boost software license", "distributed under the boost software license version 1 0", 80, 0.98)
    add("zlib", "without any express or implied", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", 80, 0.95)
    add("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 80, 0.99)
    add("unlicense", "unlicense org", "(?:refer to )?(?:http )?unlicense org", 60, 0.9)
    add("wtfpl", "fuck you want", "you just do what the fuck you want to", 80, 0.97)
    add("ofl", "font software", "this font software is licensed under the sil open font license", 80, 0.98)
    add("openssl", "openssl", "this product includes software developed by the openssl project", 80, 0.97)
    add("beerware", "ware license", "beer ?ware license", 75, 0.9)
    add("beerware", "beer in return", "you can buy me a beer in return", 75, 0.9)
    add("cc0", "person who associated a work", "the person who associated a work with this deed has dedicated the work to the public domain", 80, 0.98)
    add("cc-by", "creativecommons org", "creativecommons org licenses by(?: [0-9] [0-9])?", 78, 0.95)
    add("cc-by-sa", "creativecommons org", "creativecommons org licenses by sa(?: [0-9] [0-9])?", 79, 0.96)
    add("cc-by-nc", "creativecommons org", "creativecommons org licenses by nc(?: [0-9] [0-9])?", 79, 0.96)
    add("cc-by-nd", "creativecommons org", "creativecommons org licenses by nd(?: [0-9] [0-9])?", 79, 0.96)
    add("cc-by-nc-sa", "creativecommons org", "creativecommons org licenses by nc sa(?: [0-9] [0-9])?", 80, 0.96)
    add("cc-by-nc-nd", "creativecommons org", "creativecommons org licenses by nc nd(?: [0-9] [0-9])?", 80, 0.96)
    add("cc0", "creativecommons org", "creativecommons org publicdomain zero(?: 1 0)?", 80, 0.97)
    add("cc", "some rights", "some rights reserved(?: under (?:a )?creative commons)?", 40, 0.5)
    add("spdx", "spdx license", "spdx license identifier \\S+(?: [0-9](?: [0-9])?)?", 52, 0.9)
    add("no-warranty", "warrant", "(?:provided |is provided )?as is without warrant(?:y|ies) of any kind", 40, 0.6)
    add("no-warranty", "merchantability", "(?:implied )?warranties of merchantability(?: and)? fitness for a particular purpose", 40, 0.6)
    add("public-domain", "public domain", "(?:released (?:in)?to|dedicated to|placed in|in) the public domain", 60, 0.85)
    add("public-domain", "public domain", "public domain", 30, 0.5)
    # rights notices
    add("reserved", "rights reserved", "(?:all|some|no) rights reserved", 50, 0.7)
    add("reserved", "copyright", "copyright (?:c )?(?:[0-9]{4}(?: [0-9]{4})* )?(?:by )?(?:\\S+ ){0,6}all rights reserved", 56, 0.9)
    add("reserved", "may be reproduced", "no part of this (?:book|publication|work|document|site|website) may be reproduced", 60, 0.9)
    add("reserved", "unauthori", "unauthori[sz]ed (?:copying|reproduction|use|distribution)(?: or (?:copying|reproduction|use|distribution))? (?:\\S+ ){0,6}prohibited", 60, 0.85)
    add("reserved", "written permission", "without (?:the )?(?:prior |express )?(?:prior |express )?written permission", 40, 0.6)
    add("copyright", "copyright", "copyright (?:c )?[0-9]{4}(?: [0-9]{4})?", 45, 0.6)
    add("proprietary", "proprietary", "(?:proprietary and confidential|confidential and proprietary|proprietary licen[cs]e)", 60, 0.85)
    add("proprietary", "trade secret", "(?:contains|constitutes) (?:proprietary|confidential) (?:information and )?trade secrets?", 60, 0.85)
    add("non-commercial", "commercial use", "(?:for )?(?:personal and )?non ?commercial use only", 45, 0.7)
    add("commercial", "commercial licen", f"commercial {licence}(?: agreement)?", 50, 0.7)
    add("commercial", "end user licen", f"end user {licence}(?: agreement)?", 50, 0.8)
    add("commercial", "enterprise licen", f"enterprise {licence}(?: agreement)?", 50, 0.7)
    # what no rule above names; the least priority of all
    add("licensed", "licen", f"(?:licensed|released|distributed|published) under (?:the|an?) (?:\\S+ ){{0,4}}{licence}", 20, 0.5)
    return out


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _detections(words: Column, known: list[Rule]) -> Column:
    """Intervals of the rules' matches in ` word word `, by falling priority. One pass of its expression for each rule tried."""
    # one literal, which Spark folds to an array once
    kind = "array<struct<label:string,keyword:string,pattern:string,priority:int,confidence:double>>"
    table_ = F.from_json(F.lit(json.dumps([r._asdict() for r in known])), kind)
    # words hold no control characters, so these mark a match's begin and end
    first, last = "\x01", "\x02"

    def spans(r: Column) -> Column:
        pieces = F.split(F.regexp_replace(words, r["pattern"], F.lit(f"{first}$0{last}")), first)

        def step(state: Column, piece: Column) -> Column:
            # a match and what follows up to the next; `at` is the number of the word that follows the last match
            begin = state["at"] + state["gap"] - 1
            end = begin + _spaces(F.substring_index(piece, last, 1)) + 1
            span = F.struct(begin.alias("begin"), end.alias("end"))
            return F.struct(end.alias("at"), _spaces(F.substring_index(piece, last, -1)).alias("gap"), F.concat(state["spans"], F.array(span)).alias("spans"))

        def places(x: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), _spaces(x[0]).alias("gap"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))
            return F.aggregate(F.slice(x, 2, F.size(x)), start, step)["spans"]

        return F.transform(
            _let(pieces, places),
            lambda s: F.struct(
                (-r["priority"]).alias("rank"), (s["begin"] - s["end"]).alias("back"), s["begin"].alias("begin"),
                r["label"].alias("label"), r["confidence"].alias("confidence"),
            ),
        )

    tried = F.filter(table_, lambda r: F.contains(words, r["keyword"]))
    ordered = F.array_sort(F.flatten(F.transform(tried, spans)))
    return F.transform(
        ordered,
        lambda x: F.struct(
            x["begin"].alias("begin"), (x["begin"] - x["back"]).alias("end"), (-x["rank"]).alias("priority"), x["label"].alias("label"), x["confidence"].alias("confidence")
        ),
    )


def _kept(detections: Column) -> Column:
    """Detections, the first of those that overlap, in order of their places."""

    def step(kept: Column, x: Column) -> Column:
        meets = F.exists(kept, lambda y: (y["begin"] < x["end"]) & (x["begin"] < y["end"]))
        return F.when(meets, kept).otherwise(F.concat(kept, F.array(x)))

    return F.array_sort(F.aggregate(detections, F.array().cast(_KIND), step))


def _by_stretches(words: Column, n_words: Column, known: list[Rule]) -> Column:
    """The detections that stand, of a text of any length; begin and end are numbers of words.

    Long texts are matched by stretches, each with what lies around it; which of the detections stand is then decided
    over the whole text, since one that goes may let another one stand, however long such a chain is.
    """

    def stretch(parts: Column, i: Column) -> Column:
        core = i * STRETCH
        low = F.greatest(core - MARGIN, F.lit(0))
        text = F.concat(F.lit(" "), F.array_join(F.slice(parts, low + 1, core + STRETCH + MARGIN - low), " "), F.lit(" "))
        found = _let(text, lambda x: _detections(x, known))
        # as the sort of _detections: by falling priority, the longest and then the first ones first
        placed = F.transform(
            found,
            lambda x: F.struct((-x["priority"]).alias("rank"), (x["begin"] - x["end"]).alias("back"), (x["begin"] + low).alias("begin"), x["label"].alias("label"), x["confidence"].alias("confidence")),
        )
        return F.filter(placed, lambda x: (x["begin"] >= core) & (x["begin"] < core + STRETCH))

    count = F.ceil(n_words / STRETCH).cast("int")
    found = _let(F.split(F.trim(words), " "), lambda parts: F.array_sort(F.flatten(F.transform(F.sequence(F.lit(0), count - 1), lambda i: stretch(parts, i)))))
    long = F.transform(
        found,
        lambda x: F.struct(x["begin"].alias("begin"), (x["begin"] - x["back"]).alias("end"), (-x["rank"]).alias("priority"), x["label"].alias("label"), x["confidence"].alias("confidence")),
    )
    return F.when(n_words <= STRETCH, _kept(_detections(words, known))).otherwise(_kept(long))


def scan(docs: DataFrame, known: list[Rule] | None = None) -> DataFrame:
    """One row per document: counts and places of the base phrases, labels, score and the kept detections."""
    known = rules() if known is None else known
    # lower() lower-cases more than A-Z, so the gate may only let more texts through; it is much faster than translate()
    rows = texts(docs).select("doc_id", "text", F.lower("text").alias("low"))
    # a text with none of these words holds neither a base phrase nor a keyword; short ones must begin a word
    needles = {max(x.split(), key=len) for x in (*BASE, *(r.keyword for r in known))}
    short = sorted(x for x in needles if len(x) < 4)
    gate = F.regexp_like("low", F.lit(f"(?<![a-z0-9])(?:{'|'.join(short)})")) if short else F.lit(False)
    for x in sorted(needles - {*short}):
        if not any(y != x and y in x for y in needles - {*short}):
            gate = gate | F.contains("low", F.lit(x))
    # without a gate, the text of the words is empty and costs nothing further
    words = F.when(gate, F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(F.col("text")), BETWEEN, " ")), F.lit(" "))).otherwise(F.lit(""))
    rows = rows.select("doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), words.alias("words"))

    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE.items():
        n = F.regexp_count("words", F.lit(f"(?<= ){phrase}(?= )"))
        padded = f" {phrase} "
        place = F.instr("words", padded)
        back = F.instr(F.reverse("words"), padded[::-1])
        counts.append(n)
        firsts.append(F.when(place > 0, _spaces(F.substring(F.col("words"), F.lit(1), place)) - 1))
        end = F.length("words") - back + 1 - len(padded) + 1
        lasts.append(F.when(back > 0, _spaces(F.substring(F.col("words"), F.lit(1), end)) - 1))
        labels.append(F.when(place > 0, F.lit(label)))
    found = F.when(F.length("words") > 0, _by_stretches(F.col("words"), F.col("n_words"), known)).otherwise(F.array().cast(_KIND))
    rows = rows.select(
        "doc_id", "n_words", sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base"), found.alias("detections"),
    )
    every = F.array_sort(F.array_union("base", F.transform("detections", lambda x: x["label"])))
    best = F.coalesce(F.array_max(F.transform("detections", lambda x: x["confidence"])), F.lit(0.0))
    score = F.greatest(best, F.when(F.size("base") > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"), score.alias("score"), "detections",
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("detections")
