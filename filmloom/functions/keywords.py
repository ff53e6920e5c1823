"""Which words of a list occur in a text."""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lists up to this length are a chain of built-in tests; longer ones are one automaton.
CHAIN = 16


@lru_cache(maxsize=8)
def _automaton(words: tuple[str, ...]) -> tuple[ahocorasick.Automaton, tuple[int, ...]]:
    """All words at once, each with its places in the list, and the places of the empty word."""
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words, 1):
        places.setdefault(w, []).append(i)
    empty = tuple(places.pop("", []))
    automaton = ahocorasick.Automaton()
    for w, at in places.items():
        automaton.add_word(w, tuple(at))
    automaton.make_automaton()
    return automaton, empty


def keyword_hits(text: Column, words: list[str]) -> Column:
    """The places, from 1 and rising, of the words of a list that occur in a text; null for a null text.

    A long list is one automaton that reads each text once, so a thousand words cost what twenty do; it runs on Arrow
    batches. A short list stays a chain of contains() in the JVM. Both give the same.
    """
    if len(words) <= CHAIN:
        found = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(i)) for i, w in enumerate(words, 1)])) if words else F.array().cast("array<int>")
        return F.when(text.isNotNull(), found)
    every = tuple(words)

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        automaton, empty = _automaton(every)
        hits = lambda x: sorted({*empty, *(i for _, at in automaton.iter(x) for i in at)}) if len(automaton) else list(empty)
        return pd.Series([None if x is None else hits(x) for x in texts], dtype=object)

    return run(text)
