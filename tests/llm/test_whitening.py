"""Whitening against a plain eigenvalue solver."""

import math

import numpy as np
import pytest

from rollcall.llm import whitening
from rollcall.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, ID string, component string"


def whole(vectors):
    return np.floor(64 * np.asarray(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000


def check(rows, vectors, ids, most=32, wanted=None):
    """``rows`` are right for ``vectors``; ``wanted`` components."""
    x = whole(vectors)
    n, sums = len(x), x.sum(0)
    d = x - sums / n
    v = d.T @ d / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(most, len(e)) if wanted is None else wanted
    assert len(rows) == n * k
    dev = ((n * x - sums) ** 2).sum(1)
    by = {}
    for r in rows:
        by.setdefault(r.component, {}).setdefault(r.vec_id, r)
    assert sorted(by) == list(range(1, k + 1))
    made = np.zeros((n, k))
    for c, got in by.items():
        for i, one in enumerate(ids):
            r = got[one]
            made[i, c - 1] = r.whitened
            assert (r.n, r.deviation) == (n, dev[i])
            assert r.explained == pytest.approx(e[c - 1] / np.trace(v), rel=1e-6)
            assert r.identity_error <= 1e-4
        gap = min(abs(e[c - 1] - o) for j, o in enumerate(e) if j != c - 1) if len(e) > 1 else 1
        if gap > 1e-4 * e[0]:
            want = d @ q[:, c - 1] / math.sqrt(e[c - 1])
            assert min(np.abs(made[:, c - 1] - s * want).max() for s in (1, -1)) < 1e-6
    made -= made.mean(0)
    assert np.abs(made.T @ made / n - np.eye(k)).max() < 1e-4


def run(spark, table):
    return whitening.whiten(table, whitening.fit(table)).collect()


def test_principal_against_eigh():
    rng = np.random.default_rng(1)
    for n, kind in ((1, "r"), (2, "r"), (40, "r"), (64, "geometric"), (50, "repeated"),
                    (30, "low"), (20, "identity"), (12, "zero"), (100, "close")):
        q = np.linalg.qr(rng.standard_normal((n, n)))[0]
        e = {"r": rng.random(n), "geometric": 0.5 ** np.arange(n),
             "repeated": np.repeat(rng.random(5), 10)[:n], "low": np.r_[1, 0.5, np.zeros(n - 2)]
             if n > 2 else np.ones(n), "identity": np.ones(n), "zero": np.zeros(n),
             "close": 1 + 1e-13 * np.arange(n)}[kind]
        a = (q * e) @ q.T
        a = (a + a.T) / 2
        got, v = whitening.principal(a, n)
        assert np.abs(np.sort(got) - np.sort(e)).max() < 1e-12, kind
        assert np.abs(v.T @ v - np.eye(n)).max() < 1e-11, kind
        assert np.abs(a @ v - v * got).max() < 1e-12, kind
        top, _ = whitening.principal(a, min(5, n))
        assert np.abs(top - np.sort(e)[::-1][:5]).max() < 1e-12, kind


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    e = np.r_[10.0 ** -np.arange(15), -(10.0 ** -np.arange(15))]
    u = whitening.polar((q * e) @ q.T)
    assert np.abs(u @ u - np.eye(30)).max() < 1e-12


def test_against_eigh(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((700, 40)) * np.linspace(3, 0.3, 40) + 5).astype(np.float32)
    table = spark.createDataFrame(
        [(i, v.tolist(), "x", "y") for i, v in enumerate(vectors)], SCHEMA).repartition(5)
    check(run(spark, table), vectors, range(700))


def test_hot_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    hot, far = [1.0, 2.0, 3.0], [1e4, -1e4, 0.5]
    good = [hot] * 200 + [far] + rng.standard_normal((100, 3)).tolist()
    rows = [(i, v, "x", "y") for i, v in enumerate(good)]
    odd = [(900, None, "x", "y"), (901, [1.0, None, 2.0], "x", "y"),
           (902, [math.nan, 1.0, 2.0], "x", "y"), (903, [1.0, math.inf, 2.0], "x", "y"),
           (904, [], "x", "y"), (905, [1.0, 2.0], "x", "y")]
    table = spark.createDataFrame(rows + odd, SCHEMA).repartition(4)
    check(run(spark, table), good, range(len(good)))


def test_null_and_repeated_ids_stay(spark):
    rows = [(None, [1.0, 0.0]), (None, [0.0, 1.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0])]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = run(spark, table)
    assert sorted(str(r.vec_id) for r in got) == ["7"] * 4 + ["None"] * 4


def test_constant_direction_is_left_out(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(a), 2.0, float(b)] for a, b in rng.standard_normal((60, 2))]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in enumerate(vectors)], SCHEMA)
    check(run(spark, table), vectors, range(60), wanted=2)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, "x", "y")], [(1, [1.0, 2.0], "x", "y")], [(1, [], "x", "y")],
                 [(i, [1.0, 2.0], "x", "y") for i in range(9)]):
        assert run(spark, spark.createDataFrame(rows, SCHEMA)) == []


def test_huge_entries(spark):
    rows = [(i, [float(i), 1e30 * (i % 2)], "x", "y") for i in range(10)]
    got = run(spark, spark.createDataFrame(rows, SCHEMA))
    assert {r.deviation for r in got} == {None}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op12_whitening"](spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(got.collect(), [r.embedding for r in rows], [r.vec_id for r in rows])
