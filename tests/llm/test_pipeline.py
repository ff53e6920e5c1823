"""The pipeline's stages against what brute force decides on their own inputs."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from filmloom.llm import mixing, toxicity
from filmloom.llm.common import stored
from tests.llm.test_operators import brute_components, brute_repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), name))
    return docs


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    assert all(sorted(x.columns) == sorted(corpus_pipeline.COLUMNS) for x in steps[:-1])


def test_toxic_documents_go(spark, steps):
    before, after = texts(steps[0]), texts(steps[1])
    model = toxicity.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(steps[0], model).where("predicted = 1").collect()}
    assert after == {i: t for i, t in before.items() if i not in bad}


def test_one_of_each_group_stays(steps):
    before, after = texts(steps[1]), texts(steps[2])
    found = brute_components(before, 5, 80)
    assert after == {i: t for i, t in before.items() if found[i][1] == i}


def test_repeats_are_removed(steps):
    before, after = texts(steps[2]), texts(steps[3])
    order = sorted(before)
    for i, (_, _, _, kept) in zip(order, brute_repeats([before[i] for i in order], 100), strict=True):
        assert after[i] == kept.decode("utf-8", "ignore")


def test_mix_follows_targets(steps):
    sizes = mixing.sized(steps[3])
    wanted = {(r.doc_id): r.taken for r in mixing.taken(sizes).collect()}
    got = steps[4].groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {i: n for i, n in wanted.items() if n}
    before = texts(steps[3])
    for r in steps[4].collect():
        words = re.findall(mixing.WORD, before[r.doc_id])
        mine = re.findall(mixing.WORD, r.text)
        assert r.text == before[r.doc_id] or " ".join(mine) in " ".join(words)


def test_mix_of_rows_alike(spark, documents):
    rows = [(7, "a b c d e")] * 4 + [(8, "a  b c"), (8, "a  b c"), (8, "x y z"), (None, "n"), (None, "n"), (9, None)]
    docs = documents(rows)
    wanted = sum(r.taken for r in mixing.taken(mixing.sized(docs)).collect())
    got = corpus_pipeline.mixed(spark, docs, SF).collect()
    assert sum(len(re.findall(mixing.WORD, r.text)) for r in got) == wanted == 1.5 * 31 // 1
    assert all(r.text in {7: "a b c d e", 8: "a  b c x y z", None: "n"}[r.doc_id] or r.text in ("a", "a b") for r in got)
    # no row is taken more than twice
    assert max(Counter(r.doc_id for r in got).values()) <= 8


def test_packed(steps):
    rows = steps[5].collect()
    assert sum(r.length for r in rows) > 0
    once = {i for i, n in steps[4].groupBy("doc_id").count().collect() if n == 1}
    whole = {i: t for i, t in texts(steps[4]).items() if i in once}
    assert {i for i in whole} <= {r.doc_id for r in rows}
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        pieces.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(pieces[:-1], pieces[1:], strict=True)) and sum(x[1] for x in pieces) <= 2048


def test_odd_documents(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
    assert docs.count() > 0
    docs = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
    assert docs.count() == 0
