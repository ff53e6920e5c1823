"""Operators against brute force on small tables, with the odd cases that their docstrings define."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from filmloom.llm import components as comps
from filmloom.llm import (
    fingerprints,
    html_text,
    license_scan,
    mixing,
    near_duplicates,
    neighbours,
    packing,
    suffix_dedup,
    token_codes,
    tokens,
    toxicity,
)
from filmloom.llm.common import new_path
from tests.llm.conftest import ODD

PATH = tokens.default_path()
SF = "/root/testdata/sf0.001"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@lru_cache
def tokenizer():
    return Tokenizer.from_file(PATH)


def direct(text, end):
    return np.array(tokenizer().encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(sample):
    return [(r.doc_id, r.text or "") for r in sample.orderBy("doc_id").collect()]


# tokens, files and packing


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab 's\n\t 　é漢.1\x1c<|endoftext|>"), max_size=40))
def test_pieces_are_the_whole_text(text):
    ids, sizes = tokens.encoder(PATH).encode(pa.array(["one two", text, "", text]))
    whole = [direct(x, 0)[:-1].tolist() for x in ("one two", text, "", text)]
    assert sizes.tolist() == [len(x) for x in whole] and ids.tolist() == [i for x in whole for i in x]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=1500))
def test_codes_round_trip(ids):
    chunks, bitmaps, ranks = token_codes.encode_codes(np.array(ids, "<u4"))
    assert token_codes.decode_codes(chunks, bitmaps).tolist() == ids
    for place in {0, len(ids) - 1, len(ids) // 2}:
        assert token_codes.token_at(chunks, bitmaps, ranks, place) == ids[place]


def test_token_files(spark, odd):
    path = new_path(spark, "codes")
    token_codes.write_token_files(odd, path, PATH)
    got = token_codes.document_digests(token_codes.read_token_files(spark, path)).orderBy("doc_id").collect()
    start = 0
    assert len(got) == len(ODD)
    for r, text in zip(got, ODD, strict=True):
        ids = direct(text, 2)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_nothing(spark, odd):
    path = new_path(spark, "codes")
    token_codes.write_token_files(odd.limit(0), path, PATH)
    assert token_codes.document_digests(token_codes.read_token_files(spark, path)).count() == 0


def unpack(got, texts):
    place, sequences = defaultdict(int), defaultdict(list)
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        ids = direct(texts[r.doc_id], 1)
        assert r.start == place[r.doc_id] and r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        place[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length, r.doc_id))
    assert all(place[i] == len(direct(t, 1)) for i, t in texts.items())
    used = lost = 0
    for pieces in sequences.values():
        pieces.sort()
        end = 0
        for offset, length, _ in pieces:
            assert offset == end
            end += length
        assert end <= packing.WINDOW and [x[2] for x in pieces] == sorted(x[2] for x in pieces)
        used, lost = used + end, lost + packing.padding(end)
    return used, lost


def test_packing(odd, sample, rows):
    unpack(packing.pack(odd, PATH).collect(), dict(enumerate(ODD)))
    used, lost = unpack(packing.pack(sample, PATH).collect(), dict(rows))
    assert lost < 0.02 * used
    assert packing.pack(odd.limit(0), PATH).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 8), st.sampled_from([0.0, 1.0, 5.0])), min_size=1, max_size=25))
def test_cuts_are_best(steps):
    places, penalties = np.cumsum([x[0] for x in steps]).tolist(), [x[1] for x in steps]
    penalty = dict(zip(places, penalties, strict=True))

    def cost(cuts):
        edges = [0, *cuts]
        return sum(10 - (j - i) + penalty[j] for i, j in zip(edges[:-1], edges[1:], strict=True))

    best = {0: 0.0}
    for p in places:
        best[p] = min(best[q] + 10 - (p - q) + penalty[p] for q in best if p - q <= 10)
    cuts = packing.best_cuts(places, penalties, 10)
    assert cuts[-1] == places[-1] and math.isclose(cost(cuts), best[places[-1]])


@pytest.mark.parametrize("n", [1, 5, 1000, 1024, 2047, 2048])
def test_tail(n):
    cuts = packing.tail_cuts(n, 2048)
    assert cuts[-1] == n and sum(packing.padding(b - a) for a, b in zip([0, *cuts[:-1]], cuts, strict=True)) <= packing.padding(n)


# repeated passages


def brute_repeats(texts, length):
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        hit = [False] * len(data)
        for i in range(len(data) - length + 1):
            if (w := data[i : i + length]) in seen:
                hit[i : i + length] = [True] * length
            seen.add(w)
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((len(data), sum(hit), spans, bytes(x for x, h in zip(data, hit, strict=True) if not h)))
    return out


def removed(docs):
    got = suffix_dedup.remove_repeats(docs).orderBy("doc_id").collect()
    return [(r.n_bytes, sum(x.end - x.begin for x in r.removed), len(r.removed), bytes(r.kept)) for r in got]


def test_repeated_passages(documents, odd):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcé", k=rng.randint(1, 6))) for _ in range(40)]
    shared = [" ".join(rng.choices(words, k=30)) for _ in range(4)]
    texts = [" ".join(rng.choices([*words, *shared], k=rng.randint(0, 60))) for _ in range(60)]
    texts += [shared[0]] * 5 + ["ab" * 400, "ab" * 300, "x" * 99, "x" * 100, "x" * 101]
    # one line in many contexts: more spans of a seed than HOT needs
    assert removed(documents(texts)) == brute_repeats(texts, 100)
    assert removed(odd) == brute_repeats(ODD, 100)
    assert removed(odd.limit(0)) == []


def test_frequent_line(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    rng = random.Random(2)
    line = "a line that stands in very many documents and is over one hundred bytes long, so that windows of it repeat."
    some = lambda: "".join(rng.choices("abcdefgh ", k=80))
    texts = [some() + line + some() for _ in range(12)] + [some() + line[:70] + some() for _ in range(12)]
    assert removed(documents(texts)) == brute_repeats(texts, 100)


def test_repeats_with_repeated_ids(documents):
    text = "abcdefghij" * 15
    got = suffix_dedup.remove_repeats(documents([(1, text), (1, text), (None, text)])).collect()
    assert sorted((r.doc_id is None, len(r.kept)) for r in got) == [(False, 0), (False, 10), (True, 150)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 1, 255]), min_size=20, max_size=20), min_size=1, max_size=40))
def test_deep_shallow_sorts(rows_):
    data = np.array(rows_, np.uint8)
    # a common beginning drives rows past the shallow depth
    data = np.concatenate([np.full((len(data), 30), 7, np.uint8), data], axis=1)
    order, group = suffix_dedup.deep_shallow(data)
    got = [bytes(data[i]) for i in order]
    assert got == sorted(got)
    for a, b in zip(range(len(got) - 1), range(1, len(got)), strict=True):
        assert (group[a] == group[b]) == (got[a] == got[b])


# near-duplicates


def brute_components(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    least = {i: i for i in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in combinations(sets, 2):
        same = len(sets[a] & sets[b])
        if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
            x, y = sorted((find(a), find(b)))
            least[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates(documents, odd):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(120)] for _ in range(6)]
    texts = [edited(rng, base[k % 6], rng.randint(0, 5)) for k in range(90)] + [None, "", "A b", "a B", "a b c", "a b c d"]
    for docs, whole in ((documents(texts), texts), (odd, ODD)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(docs, 4).collect()}
        assert got == brute_components(dict(enumerate(whole)), 4, 80)
    assert near_duplicates.near_duplicates(odd.limit(0)).count() == 0


def test_near_duplicates_by_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", 500)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts = [edited(rng, base, rng.randint(1, 3)) for _ in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(documents(texts), 4).collect()}
    assert got == brute_components(dict(enumerate(texts)), 4, 80)


def test_near_duplicates_by_blocks_of_signatures(documents, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_SIGNATURES", 4)
    rng = random.Random(5)
    # two groups that share a part, so that they meet in buckets but are far apart
    shared = [f"s{rng.randrange(10**6)}" for _ in range(60)]
    bases = [[*shared, *(f"w{rng.randrange(10**6)}" for _ in range(60))] for _ in range(4)]
    texts = [edited(rng, bases[k % 4], rng.randint(0, 4)) for k in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(documents(texts), 4).collect()}
    assert got == brute_components(dict(enumerate(texts)), 4, 80)


def test_long_words_stay_apart(documents):
    # running sums modulo a power of two can't tell this word from its complement
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    got = near_duplicates.near_duplicates(documents([word, other, f"{word} x", f"{other} x", word.upper()])).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == [0, 1, 2, 3, 0]


def test_documents_without_id(documents):
    got = near_duplicates.near_duplicates(documents([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")])).collect()
    assert sorted((str(r.component_id), r.kept) for r in got) == [("1", True), ("1", True), ("None", True)]


def test_keys_meet_within_limit():
    rng = np.random.default_rng(5)
    for _ in range(200):
        one = rng.integers(0, 1 << 16, near_duplicates.SYMBOLS).astype("<u2")
        two = one.copy()
        at = rng.permutation(near_duplicates.SYMBOLS)[: near_duplicates.LIMIT]
        two[at] ^= np.uint16(1)
        a, b = near_duplicates.bucket_keys(np.stack([one, two]))
        assert set(a.tolist()) & set(b.tolist())


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)]
    least = {x: x for pair in links for x in pair}
    for _ in range(200):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    got = {r.node: r.component for r in comps.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[x] == least[x] for x in got) and all(a in got for a, b in links if a != b)


# fingerprints


def test_fingerprints(odd, sample, rows):
    for docs, texts in ((odd, list(enumerate(ODD))), (sample, rows)):
        texts = [(i, t or "") for i, t in reversed(texts)]
        got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
        assert len(got) == len(texts)
        for k, (i, text) in enumerate(texts):
            after = texts[(k + 1) % len(texts)][1]
            cut = len(text) // 3
            new = text[: len(text) - cut] + after[:cut]
            mine, other, third = (fingerprints.fingerprint(x.encode()) for x in (text, new, after))
            assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
            assert got[i].fingerprint == fingerprints.written(mine)
            assert (got[i].near_edited, got[i].near_next) == (fingerprints.likeness(mine, other), fingerprints.likeness(mine, third))
    assert fingerprints.fingerprints(odd.limit(0)).count() == 0
    long = [g for i, g in got.items() if g.n_chars > 2000]
    assert np.mean([g.near_edited for g in long]) > 0.55 and np.mean([g.near_next for g in long]) < 0.1


def test_single_document_is_its_own_neighbour(documents):
    r = fingerprints.fingerprints(documents(["only one text here"])).first()
    assert r.near_next == 1.0


@settings(max_examples=30, deadline=None)
@given(st.binary(min_size=3000, max_size=6000), st.binary(min_size=1, max_size=40))
def test_chunks_resist_shifts(data, head):
    ends = fingerprints.chunk_ends(np.frombuffer(data, np.uint8))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= fingerprints.MOST and (sizes[:-1] >= fingerprints.LEAST).all()


# toxicity


def test_exact_neighbours():
    rng = random.Random(7)
    examples = [(i, rng.randrange(2), Counter(rng.choices(range(60), k=rng.randint(1, 6)))) for i in range(700)]
    idf = np.array([1 + rng.random() for _ in range(60)])
    index = toxicity.build_index([(i, y, dict(c)) for i, y, c in examples], idf)
    by_id = {i: toxicity.weighted(dict(c), idf) for i, _, c in examples}
    for _ in range(60):
        query = dict(Counter(rng.choices(range(60), k=4)))
        at, q = toxicity.weighted(query, idf)
        cosine = sorted((round(sum(w * dict(zip(at.tolist(), q, strict=True)).get(f, 0) for f, w in zip(*map(list, v), strict=True)), 9) for v in by_id.values()), reverse=True)[:10]
        places, got = toxicity.nearest(index, query)
        assert [round(x, 9) for x in got.tolist()] == [x for x in cosine if x > 0][: len(places)]


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    hits = sum(r.predicted and r.toxic for r in got)
    assert hits >= 0.6 * sum(r.toxic for r in got) and hits >= 0.85 * sum(r.predicted for r in got)
    assert all(0 <= r.score <= 1 for r in got)


def test_whole_scores_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    marked = {}
    for r in labels.collect():
        if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id in texts:
            marked[r.doc_id] = max(r.toxic, marked.get(r.doc_id, 0))

    def vector(text):
        # counts of the model's terms, by going through all terms of the text
        words = Counter(re.findall(r"[a-z\x80-\U0010ffff]+", text.lower()))
        counts = Counter(words)
        for w, n in words.items():
            counts.update({w[:size] + "-": n for size in toxicity.STEMS if len(w) > size})
        every = {x: n for x, n in counts.items()} | {f"{x}{level}": n for x, n in counts.items() for level in toxicity.LEVELS if n >= level}
        out = {i: (1 + math.log(every[x])) * model.index.idf[i] for x, i in model.features.items() if x in every}
        norm = math.sqrt(sum(x * x for x in out.values()))
        return {i: x / norm for i, x in out.items()} if norm else {}

    examples = {i: v for i in marked if (v := vector(texts[i]))}
    got = toxicity.score(docs, model).collect()
    assert {r.score for r in got if not vector(texts[r.doc_id])} == {model.alone}
    for r in got:
        mine = vector(texts[r.doc_id])
        cosine = {i: sum(x * v.get(k, 0.0) for k, x in mine.items()) for i, v in examples.items()}
        best = sorted((x for x in cosine.values() if x > 1e-12), reverse=True)[: toxicity.K]
        assert [round(x.cosine, 8) for x in r.evidence] == [round(x, 8) for x in best]
        assert all(math.isclose(cosine[x.doc_id], x.cosine, abs_tol=1e-9) and x.toxic == marked[x.doc_id] for x in r.evidence)
        if best:
            weights = [(x.cosine**2, x.toxic) for x in r.evidence]
            share = sum(w * y for w, y in weights) / (sum(w for w, _ in weights) + toxicity.DOUBT)
            assert math.isclose(r.score, float(np.interp(share, model.votes, model.scores)), abs_tol=1e-9)
        assert r.predicted == (r.score >= 0.7)


def test_toxicity_without_labels(odd, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int, text string")
    got = toxicity.score(odd, toxicity.fit(odd, none)).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.0}
    marked = spark.createDataFrame([(i, i % 2) for i in range(len(ODD))] + [(1, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.fit(odd, marked)).count() == len(ODD)
    assert toxicity.fit(odd.limit(0), marked) is None


def test_calibration_rises():
    votes, scores, alone = toxicity.calibration({(0, 0): 50.0, (5, 1): 3.0, (5, 0): 1.0, (10, 0): 2.0, (20, 1): 9.0, (-1, 0): 10.0})
    assert scores == sorted(scores) and votes == sorted(votes) and alone == 0.0


# neighbours


def test_neighbours_recall(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(6000, 32))
    points[:500] = points[0]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "vec_id long, embedding array<double>")
    rows_ = neighbours.usable(df)
    got = defaultdict(list)
    for r in neighbours.search(rows_, rows_.where("vec_id % 100 = 0")).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    found = 0
    assert len(got) == 60
    for q, many in got.items():
        apart = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        apart[q] = np.inf
        wanted = np.lexsort((np.arange(6000), apart))[:10].tolist()
        many.sort()
        assert [x[0] for x in many] == list(range(1, 11)) and all(math.isclose(s, apart[v], abs_tol=1e-9) for _, v, s in many)
        found += len({v for _, v, _ in many} & set(wanted))
    assert found >= 0.9 * 600


def test_recall_on_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows_ = neighbours.usable(df)
    whole = rows_.collect()
    ids, points = np.array([r.vec_id for r in whole]), np.array([r.vector for r in whole])
    found = asked = 0
    got = defaultdict(set)
    for r in neighbours.search(rows_, rows_.where("vec_id % 100 = 0")).collect():
        got[r.query_id].add(r.vec_id)
    for q in ids[ids % 100 == 0].tolist():
        apart = np.sqrt(((points - points[ids == q][0]) ** 2).sum(axis=1))
        apart[ids == q] = np.inf
        wanted = set(ids[np.lexsort((ids, apart))[:10]].tolist())
        asked, found = asked + len(wanted), found + len(wanted & got[q])
    assert found >= 0.9 * asked


def test_bound_tightens():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(5000, 32))
    got = neighbours.scan_block(np.arange(5000), points, np.array([7]), points[7:8])
    apart = np.sqrt(((points - points[7]) ** 2).sum(axis=1))
    apart[7] = np.inf
    wanted = np.argsort(apart)[:10]
    assert len({x[1] for x in got} & set(wanted.tolist())) >= 9
    # with a bound from elsewhere only what is nearer is returned
    near = neighbours.scan_block(np.arange(5000), points, np.array([7]), points[7:8], np.array([apart[wanted[3]]]))
    assert {x[1] for x in near} <= set(wanted[:4].tolist()) and len(near) >= 3


def test_neighbours_odd_rows(spark):
    rows_ = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [2.0, 0.0]), (7, [1.0])]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>")
    use = neighbours.usable(df)
    got = neighbours.search(use, use.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 100, 0.0), (0, 6, 1.0), (100, 0, 0.0), (100, 6, 1.0)]
    none = neighbours.usable(df.limit(0))
    assert neighbours.search(none, none).count() == 0


# web pages


def test_main_text():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Menu</li></ul></nav><div class='cookie-notice'>We use</div>"
        "<article><h1>Head &amp; tail</h1><p>One <b>two<br>three<p>Four&nbsp;&#x41;</p><div class='ad'>Buy</div><script>var x='</p>'</script>"
        "<ul><li>a<li>b</ul><section id='comments'><p>First!</p></section></article><aside>Side</aside><footer>Foot</footer>"
    )
    assert html_text.main_text(page, frozenset(), None) == "Head & tail\n\nOne two three\n\nFour A\n\na\n\nb"
    page = (
        "<body class='has-sidebar'><article class='post'><header class='post-header'><h1>H</h1></header><video src=x><p>kept</p><iframe src=y/></article>"
        "<div class='comment-list'><article><p>no</p></article></div><article class='comment'><p>nor this</p></article></body>"
    )
    assert html_text.main_text(page, frozenset(), None) == "H\n\nkept"
    page = "<div><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p><object><p>In place of it</p></object><p class='a b c share-price'>9.5</p></div>"
    assert html_text.main_text(page, frozenset(), None) == "Let x=2 be\n\nIn place of it\n\n9.5"
    for odd_page in ("", "<", "plain", "<p", "<!-- open", "<script>never closed", "</div></p>text", "<a href='x>y</a>"):
        html_text.main_text(odd_page, frozenset(), None)


def test_templates(spark):
    frame = "<div class='top'>Welcome to us</div><div class='hint'>Read on</div><div class='body'><p>{}</p><p>{}</p></div><div class='low'>All of it</div>"
    rows_ = [(i, f"http://h.example/{i}", frame.format(f"text {i} " * 9, f"more {i * i} " * 9)) for i in range(12)]
    rows_ += [(50, None, None), (51, "http://h.example/x", ""), (52, "http://k.example/", frame.format("a", "b")), (3, "http://h.example/3", rows_[3][2])]
    df = spark.createDataFrame(rows_, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit("x"))
    got = {r.page_id: r for r in html_text.extract_text(df).collect()}
    assert html_text.extract_text(df).count() == len(rows_)
    for i in range(12):
        assert got[i].text == f"{('text %d ' % i) * 9}".strip() + "\n\n" + f"{('more %d ' % (i * i)) * 9}".strip()
    assert got[50].text == "" and got[51].n_chars == 0
    assert html_text.extract_text(df.limit(0)).count() == 0


def extracted(spark, pages, host="http://h.example/"):
    df = spark.createDataFrame([(i, f"{host}{i}", x) for i, x in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_text.extract_text(df).collect()}


def test_template_within_articles(spark):
    page = "<div class='low'>Fixed end</div><article><h1>Head {0}</h1><p>Tell your friends</p><p>{1}</p><div class='x'>Read also this</div></article>"
    got = extracted(spark, [page.format(i, f"word {i} " * 20) for i in range(8)])
    for i in range(8):
        assert got[i] == f"Head {i}\n\n" + (f"word {i} " * 20).strip()
    # the same article on half of the pages is a copy, and no template
    got = extracted(spark, [f"<p>{i}</p><article><h1>Copied</h1><p>All of this</p><p>and that.</p></article>" for i in range(8)])
    assert all(x == "Copied\n\nAll of this\n\nand that." for x in got.values())


def test_teaser_is_not_the_page():
    page = "<div class='text'><h1>Head</h1><p>" + "long text " * 20 + "</p></div><article class='card'><p>Teaser</p></article>"
    assert html_text.main_text(page, frozenset(), None).startswith("Head\n\nlong text")


def test_all_slots_without_article(spark):
    page = (
        "<div class='top'>Welcome</div><div class='post-{0}'><h1>Head {0}</h1><div class='intro'><p>Intro {0}</p></div><div class='body'><p>{1}</p></div>"
        "<div class='more-{0}'><p>Last {0}</p></div></div><div class='low'>All of it</div><div class='lower'>Ours</div>"
    )
    got = extracted(spark, [page.format(i, f"word {i} " * 20) for i in range(8)])
    for i in range(8):
        assert got[i] == f"Head {i}\n\nIntro {i}\n\n" + (f"word {i} " * 20).strip() + f"\n\nLast {i}"
    # text that repeats under a class with a number is template too
    page = "<div class='post-{0}'><h1>Head {0}</h1><p>Share this</p><p>Print this</p><p>Keep this</p></div>"
    assert extracted(spark, [page.format(i) for i in range(8)]) == {i: f"Head {i}" for i in range(8)}


def test_wrappers_are_not_furniture():
    inner = "<article><h1>Head</h1><p>Some text of the page</p></article>"
    for name in ("layout has-sidebar", "no-sidebar", "with-related", "page-with-ads", "sidebar-left", "site-header-adjacent", "ad"):
        assert html_text.main_text(f"<div class='{name}'>{inner}</div>", frozenset(), None) == "Head\n\nSome text of the page"
        assert html_text.main_text(f"<div id='{name}'>{inner}</div><p>x</p>", frozenset(), None) == "Head\n\nSome text of the page"
    form = "<form id=aspnetForm><nav>Menu</nav><div class=widget>Side</div>{}<div id=comments><p>First! " + "me too " * 99 + "</p></div></form>"
    for text in (inner, inner.replace("article", "div"), inner.replace("article", "main")):
        assert html_text.main_text(form.format(text), frozenset(), None) == "Head\n\nSome text of the page"
    for name in ("sidebar", "widget-area", "footer-links", "related-posts", "menu_2", "site-navigation", "ad-box", "social share", "comment-list"):
        assert html_text.main_text(f"{inner}<div class='{name}'><p>Other</p></div>", frozenset(), None) == "Head\n\nSome text of the page"
    teasers = "<div class='related'><article>one</article><article>two</article></div>"
    assert html_text.main_text(inner + teasers, frozenset(), None) == html_text.main_text(inner.replace("article", "div") + teasers, frozenset(), None) == "Head\n\nSome text of the page"
    assert html_text.main_text("<article></article><div class='ad'>Buy</div><div class='related'>More</div>", frozenset(), None) == ""


def test_copies_are_no_template(spark):
    page = "<div class='a'><h1>One head</h1></div><div class='b'><p>First {0}.</p><p>Second {0}.</p></div>"
    rows_ = [(i, f"http://h.example/{i}", page.format("copy")) for i in range(6)] + [(6, "http://h.example/6", page.format("other"))]
    rows_ += [(10 + i, None, page.format("null")) for i in range(6)]
    df = spark.createDataFrame(rows_, "page_id long, url string, html string").repartition(3)
    assert html_text.deduce_templates(df).count() == 0
    got = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
    for i, _, html in rows_:
        assert got[i].endswith(f"First {re.search('First (.*?)[.]', html)[1]}.\n\nSecond {re.search('Second (.*?)[.]', html)[1]}.")


def test_article_pages(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|h2|div|ul|li)\b[^>]*>", re.sub(r"<br\s*/?>", " ", inner))
        wanted = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        assert got[r.page_id] == "\n\n".join(x for x in wanted if x)


# licences


def brute_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    places, labels = [], set()
    for phrase, label in license_scan.BASE.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENCES = [
    "CC BY cc by CC-BY 4.0", "GNU General Public License, version 3.", "All rights\nreserved. all RIGHTS reserved", "cc byte", "acc by",
    "Licensed under the Apache License, Version 2.0.", "licensed under CC BY-NC 4.0", "released under the MIT License", "in the public\ndomain",
]


def test_licences(documents):
    texts = [*ODD, *LICENCES, " ".join(LICENCES) * 50]
    got = license_scan.scan(documents(texts)).orderBy("doc_id").collect()
    for r, text in zip(got, texts, strict=True):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licences(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    by_text = {t: r.labels for r, t in zip(got, texts, strict=True)}
    assert by_text["licensed under CC BY-NC 4.0"] == "cc-by,cc-by-nc-4.0"
    assert by_text["Licensed under the Apache License, Version 2.0."] == "apache-2.0"
    assert "public-domain" in by_text["in the public\ndomain"]
    assert license_scan.scan(documents(texts).limit(0)).count() == 0


def brute_detections(text, known):
    """All matches of all rules; the first of those that overlap, by priority, length and place."""
    words = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))) + " "
    found = []
    for r in known:
        for m in re.finditer(r.pattern, words) if r.keyword in words else ():
            begin = words[: m.start()].count(" ") - 1
            found.append((-r.priority, -(m[0].count(" ") + 1), begin, r.label, r.confidence))
    kept = []
    for x in sorted(found):
        if all(x[2] >= y[2] - y[1] or y[2] >= x[2] - x[1] for y in kept):
            kept.append(x)
    return sorted((x[2], x[2] - x[1], -x[0], x[3], x[4]) for x in kept)


def test_suppression(documents):
    rule = lambda label, words, priority, confidence: license_scan.Rule(label, "beta", f"(?<= )(?:{words})(?= )", priority, confidence)
    known = [rule("around", "alpha beta gamma", 1, 0.9), rule("within", "beta", 9, 0.5), rule("equal", "alpha beta gamma", 5, 0.4), rule("across", "gamma delta beta", 7, 0.3)]
    r = license_scan.scan(documents(["x alpha beta gamma y alpha beta z", "alpha beta gamma delta beta"]), known[:1] + known[2:]).orderBy("doc_id").collect()
    assert [x.labels for x in r] == ["equal", "across"]
    r = license_scan.scan(documents(["x alpha beta gamma y", "beta beta beta"]), known).orderBy("doc_id").collect()
    assert [x.labels for x in r] == ["within", "within"] and len(r[1].detections) == 3


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("licensed under the Creative Commons Attribution License", "cc-by"),
        ("licensed under the Creative Commons Attribution-ShareAlike License", "cc-by-sa"),
        ("distributed under the GNU Affero General Public License", "agpl"),
        ("released under the GNU General Public License", "gpl"),
        ("published under the European Union Public Licence", "eupl"),
    ],
)
def test_specific_names_win(documents, text, label):
    r = license_scan.scan(documents([f"This work is {text}, as it says."])).first()
    assert label in r.labels.split(",") and "licensed" not in r.labels.split(",") and r.score >= 0.85


def test_detections_against_brute_force(documents, monkeypatch):
    known = license_scan.rules()
    rng = random.Random(11)
    parts = [*LICENCES, "licensed under the Creative Commons Attribution-NonCommercial 4.0 International License", "or any later version", "GNU", "license",
             "Copyright (c) 2019 Some One. All rights reserved.", "some words", "that are no notice", "the Mozilla Public License", "public domain"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(40)]
    long = " ".join(rng.choices(parts, k=1500))
    for stretch in (license_scan.STRETCH, 300):
        monkeypatch.setattr(license_scan, "STRETCH", stretch)
        got = license_scan.scan(documents([*texts, long])).orderBy("doc_id").collect()
        for r, text in zip(got, [*texts, long], strict=True):
            wanted = brute_detections(text, known)
            assert [tuple(x) for x in r.detections] == wanted
            labels = {x[3] for x in wanted} | set(filter(None, r.base_labels.split(",")))
            assert r.labels == ",".join(sorted(labels)) and r.score == max([x[4] for x in wanted] + [0.5 * bool(r.base_labels), 0.0])


# mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        full |= {s: 2.0 * sizes[s] for s in over}


def test_mixing(documents):
    rng = random.Random(9)
    names = ["a", "b", None, "z", "B"]
    texts = ["w " * rng.randint(0, 400) for _ in range(150)] + [None]
    sources = [rng.choices(names, [30, 1, 5, 5, 5])[0] for _ in texts]
    sizes = mixing.sized(documents(texts, sources))
    got = mixing.taken(sizes).collect()
    again = mixing.taken(mixing.sized(documents(texts, sources).repartition(7))).collect()
    assert len(got) == len(texts) and {tuple(r) for r in got} == {tuple(r) for r in again}
    per = Counter()
    for text, s in zip(texts, sources, strict=True):
        per[s] += len((text or "").split())
    wanted, took = brute_targets(per), Counter()
    for r in got:
        assert r.size == len((texts[r.doc_id] or "").split()) and r.source_size == per[r.source]
        assert math.isclose(r.target, wanted[r.source], rel_tol=1e-9) and 0 <= r.taken <= 2 * r.size
        took[r.source] += r.taken
    assert all(abs(took[s] - wanted[s]) <= 1 for s in wanted)
    assert mixing.taken(sizes.limit(0)).count() == 0


def test_mix_covers_what_is_taken(documents):
    texts = ["w " * (7 * k % 90) for k in range(60)]
    sizes = mixing.sized(documents(texts, [f"s{k % 4}" for k in range(60)]))
    seen = defaultdict(list)
    for r in mixing.mix(sizes, mixing.targets(sizes), 64).collect():
        seen[r.doc_id, r.round].append((r.start, r.start + r.length))
    total = Counter()
    for (i, _), many in seen.items():
        many.sort()
        assert all(a[1] == b[0] for a, b in zip(many[:-1], many[1:], strict=True))
        total[i] += sum(b - a for a, b in many)
    assert {r.doc_id: r.taken for r in mixing.taken(sizes, 64).collect() if r.taken} == dict(total)


def test_schedule_is_even(documents):
    sizes = mixing.sized(documents(["w " * 500] * 40, ["a", "b"] * 20))
    slots = [r.source for r in mixing.schedule(mixing.targets(sizes), 64).orderBy("slot").collect()]
    share = slots.count("a") / len(slots)
    for n in range(20, len(slots), 20):
        assert abs(slots[:n].count("a") - share * n) < 6


def test_schedule_with_a_tiny_source(spark):
    per = spark.createDataFrame([("big", 10**7, 1.4e7), ("tiny", 1, 2.0), ("none", 0, 0.0), (None, 3000, 2048.0)], "source string, source_size long, target double")
    blocks = {"big": -(-14_000_000 // 1024), "tiny": 1, None: 2}
    got = mixing.schedule(per).collect()
    assert Counter(r.source for r in got) == blocks and len({r.slot for r in got}) == len(got) <= max(r.slot for r in got) + 1 < 2 * len(got)
    for name, n in blocks.items():
        mine = sorted((r.slot, r.rank) for r in got if r.source == name)
        assert [x[1] for x in mine] == list(range(n))


def test_rows_alike(documents):
    got = mixing.taken(mixing.sized(documents([(1, "a b c"), (1, "a b c"), (None, "d"), (None, None)]))).collect()
    assert len(got) == 4 and all(r.taken <= 2 * r.size for r in got)
    got = mixing.taken(mixing.sized(documents([(7, "a b c d e")] * 4 + [(8, "x")]))).collect()
    assert sum(r.taken for r in got) == 31 and all(r.size <= r.taken <= 2 * r.size for r in got)
