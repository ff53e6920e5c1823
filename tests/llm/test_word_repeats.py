"""Repeated windows of words and collocations against brute force, with the odd cases that their docstrings define."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from filmloom.llm import block_repeats, collocations

LENGTH = 35


def brute_repeats(texts, length=LENGTH):
    words = [re.findall(r"[^\x20\x09-\x0D]+", x or "") for x in texts]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(w), sum(gone), " ".join(x for x, y in zip(w, gone, strict=True) if not y)))
    return out


def digest(rows):
    return [(r.n_words, sum(x.end - x.begin for x in r.removed), r.kept) for r in rows]


def passages(seed, n=40):
    """Texts that share passages at any offset: whole copies, near copies, one passage many times, repeats within a text."""
    rng = random.Random(seed)
    new = lambda k: [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(k)]
    shared = [new(k) for k in (34, 35, 36, 60, 200)]
    texts = []
    for _ in range(n):
        words = new(rng.choice([0, 3, 17, 18, 40, 90]))
        for _ in range(rng.randrange(3)):
            words += rng.choice(shared) + new(rng.choice([0, 1, 5, 30]))
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    return [*texts, *texts[:5], " ".join(shared[4] * 3), " ".join(["x"] * 36), "y " * 35]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_brute_force(documents, monkeypatch, seed):
    monkeypatch.setattr(block_repeats, "PACK", 2000)  # several packs
    monkeypatch.setattr(block_repeats, "FOLD", 64)
    texts = passages(seed)
    got = block_repeats.remove_repeated_windows(documents(texts)).orderBy("doc_id").collect()
    assert digest(got) == brute_repeats(texts)


@pytest.mark.parametrize("length", [1, 2, 5, 36])
def test_other_lengths(documents, monkeypatch, length):
    monkeypatch.setattr(block_repeats, "PACK", 500)
    texts = passages(4, 12)
    got = block_repeats.remove_repeated_windows(documents(texts), length).orderBy("doc_id").collect()
    assert digest(got) == brute_repeats(texts, length)


def test_odd_texts(documents):
    long = " ".join(str(i) for i in range(60))
    texts = [None, "", " \n", "one", long, " ".join("abc") + " " + long, "\x1c " * 40, long.replace(" ", "\r\n\v\f\t ")]
    rows = [(None if i == 4 else 7 if i > 5 else i, x) for i, x in enumerate(texts)]
    got = block_repeats.remove_repeated_windows(documents(rows), LENGTH, "source", "key").collect()
    assert Counter(digest(got)) == Counter(brute_repeats(texts))
    assert {r.doc_id for r in got} == {0, 1, 2, 3, None, 5, 7} and {r.key for r in got} == {"k"}
    assert all(x.begin % 1 == 0 and x.end - x.begin >= LENGTH for r in got for x in r.removed)


def test_nothing_to_read(documents):
    got = block_repeats.remove_repeated_windows(documents([]))
    assert got.count() == 0 and got.columns == ["doc_id", "n_words", "removed", "kept"]


def test_one_passage_in_all_documents(documents, monkeypatch):
    monkeypatch.setattr(block_repeats, "PACK", 1500)
    line = " ".join(f"w{i}" for i in range(40))
    texts = [f"{'a ' * (i % 20)}{line} n{i}" for i in range(300)]
    got = block_repeats.remove_repeated_windows(documents(texts)).orderBy("doc_id").collect()
    assert digest(got) == brute_repeats(texts)


@pytest.mark.parametrize("keys", [[], [0], [2**32 - 1], [0, 1, 2**31, 2**32 - 1], list(range(0, 10**6, 77))])
def test_keys_round_trip(keys):
    assert block_repeats.expanded(block_repeats.squeezed(np.array(keys, "<u4").tobytes())).tolist() == keys


def test_known_windows_tell_each_pack_once():
    known, told = block_repeats._Known(), defaultdict(list)
    for pack, keys in enumerate([[1, 2, 3], [2, 9], [2, 3], [9, 10], [10]]):
        for p, x in [*known.add(np.array(keys, "<u8"), pack), *(known.fold() if pack % 2 else [])]:
            told[p] += x.tolist()
    for p, x in known.fold():
        told[p] += x.tolist()
    assert {p: sorted(x) for p, x in told.items()} == {0: [2, 3], 1: [2, 9], 2: [2, 3], 3: [9, 10], 4: [10]}


# collocations


def brute_collocations(rows, least, longest=5, share=100, top=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    longer = defaultdict(int)
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = (lang, words[i : i + k])
                longer[key] = max(longer[key], a)
    out = defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * longer[lang, words] >= share * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {
        (lang, rank, w.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for rank, (s, a, w, left, right) in enumerate(sorted(x)[:top], 1)
    }


def languages(spark, rows):
    return spark.createDataFrame([(i, lang, text, 1.0, "k") for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, score double, w1 string").repartition(3)


def chatter(seed, n=60):
    rng = random.Random(seed)
    fixed = ["new york", "per cent of the", "a b c d e", "a b c d e f g", "a b", "x x x", "of the", "der die das", "É é", "🙂 漢字"]
    text = lambda: "".join(rng.choice([*fixed, "The", "of", "rare" + str(rng.randrange(300))]) + rng.choice([" ", " ", "\t ", ". ", "\n", ",", " "]) for _ in range(40))
    return [(rng.choice(["en", "de", None, "und"]), text()) for _ in range(n)]


@pytest.mark.parametrize(("least", "longest", "share", "top"), [(3, 5, 100, 2000), (2, 3, 60, 2000), (5, 5, 100, 7), (300, 5, 100, 2000)])
def test_collocations_equal_brute_force(spark, least, longest, share, top):
    rows = [*chatter(least), (None, None), ("en", ""), ("fr", " \n."), ("en", "a" * 3000 + " b"), *chatter(9, 3) * 2]
    got = collocations.collocations(languages(spark, rows), least, longest, share, top).collect()
    assert {tuple(r) for r in got} == brute_collocations(rows, least, longest, share, top) and len(got) == len({(r.lang, r["rank"]) for r in got})


def test_windows_end_before_rare_words_only(spark):
    """The sketch changes no count that is asked for: it lets every frequent phrase through, whatever shares its bucket."""
    rows = chatter(11)
    wanted = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            wanted.update((lang or "und", " ".join(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    counts, totals = collocations.phrase_counts(languages(spark, rows), 4)
    assert {(r.lang, r.phrase): r.f for r in counts.collect()} == {x: n for x, n in wanted.items() if n >= 4}
    assert sum(r.n for r in totals.collect()) == sum(n for (_, x), n in wanted.items() if " " not in x)


def test_counts_beyond_64_bits(spark):
    got = spark.range(1).selectExpr("cast(4e12 as bigint) a", "cast(9e13 as bigint) n", "cast(5e12 as bigint) l", "cast(6e12 as bigint) r")
    exact = 1000 * 4 * 10**12 * 9 * 10**13 // (5 * 10**12 * 6 * 10**12)
    assert got.selectExpr(f"{collocations.SCORE} as s").first().s == exact


def test_no_text(spark):
    assert collocations.collocations(languages(spark, [])).count() == 0
