"""Null and repeated ids, very long texts and clashing columns, as the operators' docstrings define them."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from filmloom.llm import fingerprints, html_text, license_scan, near_duplicates, neighbours, packing, suffix_dedup, token_codes, tokens, toxicity
from filmloom.llm.common import new_path, stored
from tests.llm.test_operators import PATH, brute_components, brute_repeats, direct, edited, removed, unpack

SF = "/root/testdata/sf0.001"
#: Rows without an id, and ids that stand several times, with equal and different texts.
ROWS = [(None, "no id at all"), (None, None), (3, "same text here"), (3, "same text here"), (3, "another text of it"), (1, ""), (1, None), (7, "CC BY all rights reserved")]


def test_codes_of_repeated_ids(spark, documents):
    path = new_path(spark, "codes")
    token_codes.write_token_files(documents(ROWS), path, PATH)
    got = token_codes.document_digests(token_codes.read_token_files(spark, path)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((x[0] for x in ROWS), key=lambda x: (x is not None, x))
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter((i, zlib.crc32(direct(t, 2).tobytes())) for i, t in ROWS)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_codes_over_several_segments(spark, documents, monkeypatch):
    monkeypatch.setattr(token_codes, "SEGMENT_TOKENS", 500)
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["one", "zwei", "trois", "x" * 30], k=rng.choice([0, 5, 400, 1500]))) for _ in range(30)]
    path = new_path(spark, "codes")
    token_codes.write_token_files(documents(texts), path, PATH)
    segments = token_codes.read_token_files(spark, path)
    assert segments.count() > 10
    got = token_codes.document_digests(segments).orderBy("doc_id").collect()
    start = 0
    for r, text in zip(got, texts, strict=True):
        ids = direct(text, 2)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_packing_of_repeated_ids(documents):
    got = packing.pack(documents(ROWS), PATH).collect()
    # a document may be cut to pieces; each has one first piece
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == Counter((i, len(direct(t, 1))) for i, t in ROWS)
    assert sum(r.length for r in got) == sum(len(direct(t, 1)) for _, t in ROWS)
    pieces = {(r.sequence_id, r.offset) for r in got}
    assert len(pieces) == len(got)


def test_packing_over_several_chunks(documents, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_TOKENS", 3000)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["one.", "zwei", "trois", "!"], k=n)) for n in (9000, 0, 10, 2500, 4000, 1, 7000, 30)]
    used, lost = unpack(packing.pack(documents(texts), PATH).collect(), dict(enumerate(texts)))
    assert lost < 0.05 * used


def test_pieces_in_batches_of_any_size(monkeypatch):
    # fewer pieces kept than met: the rest is encoded each time
    monkeypatch.setattr(tokens, "PIECES_KEPT", 3)
    coder = tokens.Encoder(PATH)
    for _ in range(2):
        for batch in (["a b c d e f g", "b b  b"], [], [" \n x", "", "e f g h"], ["h " * 50]):
            ids, sizes = coder.ended(pa.array(batch, pa.string()), 9)
            whole = [direct(x, 9).tolist() for x in batch]
            assert sizes.tolist() == [len(x) for x in whole] and ids.tolist() == [i for x in whole for i in x]


def test_fingerprints_of_repeated_ids(documents):
    got = fingerprints.fingerprints(documents(ROWS)).collect()
    order = sorted(((i, t or "") for i, t in ROWS), key=lambda x: (x[0] is not None, x[0] or 0, x[1]), reverse=True)
    wanted = Counter()
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        wanted[i, len(text), hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == wanted


@pytest.mark.parametrize("n", [0, 1, 2, 5, 16, 50])
def test_parts_by_two_steps(spark, n):
    edges = sorted(random.Random(n).sample(range(1000), n), reverse=True)
    ids = [None, *range(-1, 1001, 7), *edges]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r.doc_id: r.part for r in df.withColumn("part", fingerprints._part(edges)).collect()}
    assert got == {i: n if i is None else sum(i < x for x in edges) for i in ids}


def test_licences_of_repeated_ids(documents):
    got = license_scan.scan(documents(ROWS)).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, len((t or "").split())) for i, t in ROWS)
    assert [r.base_labels for r in got if r.doc_id == 7] == ["cc-by,reserved"]


def test_toxicity_of_repeated_ids(spark, documents):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    got = toxicity.score(documents(ROWS), toxicity.fit(docs, labels)).collect()
    assert Counter(r.doc_id for r in got) == Counter(x[0] for x in ROWS)
    assert all(not r.held_out for r in got if r.doc_id is None) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert len({r.score for r in got if r.doc_id == 1}) == 1


def test_repeats_over_several_blocks(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdef", k=rng.randint(1, 7))) for _ in range(60)]
    shared = " ".join(rng.choices(words, k=40))
    texts = [" ".join([*rng.choices(words, k=rng.randint(0, 500)), shared, *rng.choices(words, k=rng.randint(0, 500))]) for _ in range(8)]
    assert removed(documents(texts)) == brute_repeats(texts, 100)


def test_near_duplicates_of_repeated_ids(documents):
    words = [f"w{i}" for i in range(40)]
    rows = [(5, " ".join(words)), (5, "something else than that one"), (2, " ".join(words[:-1])), (9, "something else than that one"), (None, " ".join(words)), (4, None), (4, "")]
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_duplicates.near_duplicates(documents(rows)).collect())
    # of 5 the least text speaks, "something ..."
    assert got == Counter({(5, 5, True): 2, (9, 5, False): 1, (2, 2, True): 1, (None, None, True): 1, (4, 4, True): 2})


def test_near_duplicates_by_blocks_and_groups(documents, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", 150)
    rng = random.Random(6)
    # a chain: neighbours are alike, the ends are not, so many members aren't linked with their hub
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[4 * k : 4 * k + 60]) for k in range(40)] + [edited(rng, words[:60], 2) for _ in range(6)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(documents(texts), 4).collect()}
    assert got == brute_components(dict(enumerate(texts)), 4, 80)


def test_neighbours_of_repeated_ids(spark):
    rows = [(0, [0.0, 1.0]), (1, [0.0, 2.0]), (1, [0.0, 3.0]), (100, [0.0, 4.0]), (100, [0.0, 4.0])]
    use = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = neighbours.search(use, use.where("vec_id % 100 = 0")).collect()
    assert sorted((r.vec_id, r.score) for r in got if r.query_id == 0) == [(1, 1.0), (1, 2.0), (100, 3.0), (100, 3.0)]
    assert sorted((r.vec_id, r.score) for r in got if r.query_id == 100) == [(0, 3.0), (1, 1.0), (1, 2.0)]


def test_pages_of_repeated_ids(spark):
    frame = "<div class='top'>Welcome</div><div class='hint'>Read on</div><div class='body'><p>{}</p></div><div class='low'>All of it</div>"
    rows = [(i, f"http://h.example/{i}", frame.format(f"text {i} " * 9)) for i in range(10)] + [(2, "http://h.example/2b", frame.format("other " * 9)), (20, "http://h.example/20", None), (21, None, "<p>alone</p>"), (None, "http://h.example/n", frame.format("no id"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "host": F.lit("x"), "boilerplate": F.lit(2), "main": F.lit(3)})
    got = html_text.extract_text(df).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, u) for i, u, _ in rows)
    by_url = {r.url: r.text for r in got}
    assert by_url["http://h.example/2b"] == ("other " * 9).strip() and by_url["http://h.example/20"] == "" and by_url[None] == "alone" and by_url["http://h.example/n"] == "no id"


@pytest.mark.parametrize("name", [x for x, _ in corpus_pipeline.STAGES])
def test_stages_take_repeated_ids(spark, documents, name):
    words = " ".join(f"w{i}" for i in range(50))
    docs = documents([*ROWS, (8, words), (8, words), (9, words + " end"), (None, words)], ["s", None] * 6)
    out = stored(dict(corpus_pipeline.STAGES)[name](spark, docs, SF), "stage")
    got = {r.doc_id for r in out.collect()}
    assert got <= {None, 1, 3, 7, 8, 9} and {3, 7, 8} <= got
    if name != "packing":
        assert sorted(out.columns) == sorted(corpus_pipeline.COLUMNS)


def test_container_of_the_template(spark):
    """No name tells what is the article, and the rest differs on every page: the template's tags decide."""
    page = "<body><div class='qa'>Today {0} and {1}</div><div class='qb'><h1>Head {0}</h1><p>{2}</p><p>End <span class='share'>shares {0} fell</span> today</p></div><div class='qc'><p>See {1} next</p></div></body>"
    rows = [(i, f"http://h.example/{i}", page.format(i, i * 7 + 3, f"word {i} " * (20 + i))) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    templates = html_text.deduce_templates(df).collect()
    assert [(r.host, r.container) for r in templates] == [("h.example", "/body/div.qb")]
    got = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
    for i, _, x in rows:
        text = f"Head {i}\n\n" + (f"word {i} " * (20 + i)).strip() + f"\n\nEnd shares {i} fell today"
        assert html_text.main_text(x, frozenset(), None) != text
        assert got[i] == text


def test_long_page(spark):
    page = "<article><h1>Long</h1>" + "".join(f"<p>part {i} of it</p>" for i in range(30000)) + "</article>"
    df = spark.createDataFrame([(1, "http://h.example/1", page)], "page_id long, url string, html string")
    got = html_text.extract_text(df).first()
    assert got.text.count("\n\n") == 30000 and got.n_chars == len(got.text) and got.text.endswith("part 29999 of it")


@pytest.mark.parametrize("before", [0, license_scan.STRETCH - 150, license_scan.STRETCH - 1])
def test_chain_of_overlaps_over_a_border(documents, before):
    """150 rules of three words, each meeting the next one in a word: every second one stands, wherever the chain lies."""
    rule = lambda i: license_scan.Rule(f"r{i:03}", f"c{2 * i} ", f"(?<= )(?:c{2 * i} c{2 * i + 1} c{2 * i + 2})(?= )", 1000 - i, 0.5)
    text = "word " * before + " ".join(f"c{i}" for i in range(301)) + " word" * (license_scan.STRETCH if before else 5)
    got = license_scan.scan(documents([text]), [rule(i) for i in range(150)]).first()
    assert [x.label for x in got.detections] == [f"r{i:03}" for i in range(0, 150, 2)]
    assert [x.begin for x in got.detections] == [before + 2 * i for i in range(0, 150, 2)]
