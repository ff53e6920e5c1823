"""Whitening against dense algebra, with the odd cases that the docstring defines."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filmloom.llm import whitening

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<double>, n long, x array<int>, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, [1], "c") for i, v in rows], KIND).repartition(3)


def brute(rows, k=16):
    """deviation, whitened up to sign, explained, by vec_id and component, of vectors of one width."""
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in rows]
    fit = [list(t) for t in dict.fromkeys(map(tuple, x))]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = (n * np.array(fit, object) - np.array(sums, object)).astype(float) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for (i, _), t in zip(rows, x, strict=True):
        apart = [n * a - s for a, s in zip(t, sums, strict=True)]
        w = (np.array(apart, float) / n) @ vectors / np.sqrt(values)
        for c in range(len(values)):
            out[i, c + 1] = (n, sum(a * a for a in apart), w[c], values[c] / np.trace(v))
    return out


def same(got, want):
    assert len(got) == len(want) and {(r.vec_id, r.component) for r in got} == set(want)
    for c in {r.component for r in got}:
        mine = [r for r in got if r.component == c]
        r = max(mine, key=lambda r: abs(r.whitened))
        sign = math.copysign(1, r.whitened * want[r.vec_id, c][2])
        for r in mine:
            n, deviation, w, explained = want[r.vec_id, c]
            assert (r.n, r.deviation) == (n, deviation)
            assert abs(sign * r.whitened - w) < 1e-7 and abs(r.explained - explained) < 1e-9 and r.identity_error < 1e-9


def test_embeddings(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None]
    same(whitening.op11_whitening(spark, SF).collect(), brute(rows))


def test_repeats_count_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * [4, 3, 2, 1, 0.5, 0.2]).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(90)]  # a third and more are one vector
    same(whitening.whiten(frame(spark, rows)).collect(), brute(rows))


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=3).tolist()) for i in range(20)] + [(None, [0.5, 0.25, -1.0]), (3, [1.0, 1.0, 1.0])]
    odd = [(50, None), (51, [1.0, None, 2.0]), (52, [math.nan, 0.0, 1.0]), (53, [math.inf, 0.0, 1.0]), (54, [])]
    got = whitening.whiten(frame(spark, good + odd)).collect()
    assert len(got) == 3 * len(good) and {r.n for r in got} == {22}
    w = np.array([[r.whitened for r in sorted((r for r in got if r.component == c), key=lambda r: r.deviation)] for c in (1, 2, 3)])
    assert np.abs(np.cov(w, bias=True) - np.eye(3)).max() < 1e-9


def test_another_width_is_a_space_of_its_own(spark):
    rng = np.random.default_rng(5)
    two = [(i, rng.normal(size=2).tolist()) for i in range(15)]
    four = [(100 + i, rng.normal(size=4).tolist()) for i in range(25)]
    got = whitening.whiten(frame(spark, two + four)).collect()
    same([r for r in got if r.vec_id < 100], brute(two))
    same([r for r in got if r.vec_id >= 100], brute(four))


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_varies(spark, rows):
    got = whitening.whiten(frame(spark, rows))
    assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_flat_directions_are_left_out(spark):
    rng = np.random.default_rng(6)
    flat = rng.normal(size=(30, 2)).round(2)
    got = whitening.whiten(frame(spark, [(i, [a, b, 5.0, -1.0]) for i, (a, b) in enumerate(flat.tolist())])).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-9
    assert abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-9


def test_huge_entries(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0]), (4, [2.0**40, 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} >= {1} and all(r.deviation is None or r.deviation >= 0 for r in got)
    assert {r.deviation for r in got if r.vec_id in (1, 2)} == {None}


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 14), st.integers(0, 10**6), st.sampled_from(["random", "equal", "near", "zero", "rank"]))
def test_leading_against_dense_algebra(width, seed, kind):
    rng = np.random.default_rng(seed)
    values = {
        "random": rng.random(width) * 10, "equal": np.repeat(3.0, width), "near": 1 + 1e-9 * np.arange(width),
        "zero": np.zeros(width), "rank": np.where(np.arange(width) < 2, 5.0 + np.arange(width), 0),
    }[kind]
    turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
    a = (turn * values) @ turn.T
    a = (a + a.T) / 2
    got, vectors = whitening.leading(a, 6)
    want = np.sort(values)[::-1][:6]
    want = want[want > 1e-8]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-12, atol=1e-12)
    assert np.allclose(vectors @ vectors.T, np.eye(len(got)), atol=1e-10)
    assert np.abs(a @ vectors.T - vectors.T * got).max(initial=0) < 1e-11


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6), st.floats(-5, 5))
def test_counts_of_inertia(width, seed, shift):
    a = np.random.default_rng(seed).integers(-3, 4, (width, width)).astype(float)
    a = a + a.T
    values = np.linalg.eigvalsh(a)
    if np.abs(values - shift).min() > 1e-9:
        assert whitening.above(a, shift) == (values > shift).sum()


def test_covariance_is_exact():
    n, y = 3, [[1, 0], [0, 1], [1, 1]]
    v = whitening.covariance(n, [2, 2], {(0, 0): 2, (0, 1): 1, (1, 1): 2})
    assert np.array_equal(v, np.cov(np.array(y).T, bias=True).round(15)) or np.allclose(v, np.cov(np.array(y).T, bias=True), atol=1e-16)
    big = 10**9
    assert whitening.covariance(2, [0, 0], {(0, 0): 2 * big**2, (0, 1): -2 * big**2, (1, 1): 2 * big**2}).tolist() == [[big**2, -(big**2)], [-(big**2), big**2]]
