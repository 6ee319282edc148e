import numpy as np
import pytest
from helpers import empty_documents, odd_documents, words

from rollcall.llm import components, ngram_join
from rollcall.llm.common import id_filter, passing, table


def shingles(text):
    import re
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = [x for x in re.split("[\x20\x09-\x0d]+", low) if x]
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else
                     [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in sets}


def clusters(rng):
    """Near copies at all distances round the threshold, a large cluster, a shared passage."""
    docs, passage = [], words(rng, 30)
    for _ in range(25):
        base = words(rng, int(rng.integers(6, 150)), 5000)
        for _ in range(int(rng.integers(1, 7))):
            copy = list(base)
            for _ in range(int(rng.integers(0, max(2, len(base) // 15)))):
                copy[int(rng.integers(len(copy)))] = f"x{int(rng.integers(10_000))}"
            docs.append(copy)
    base = words(rng, 100, 5000)
    for _ in range(120):
        copy = list(base)
        for _ in range(int(rng.integers(0, 4))):
            copy[int(rng.integers(len(copy)))] = f"y{int(rng.integers(10_000))}"
        docs.append(copy)
    docs += [base] * 40
    for _ in range(60):
        docs.append(words(rng, int(rng.integers(3, 60)), 5000) + passage)
    docs += [passage[:k] for k in range(1, 30)]
    order = rng.permutation(len(docs))
    return [(int(i), " ".join(docs[k])) for i, k in enumerate(order)]


@pytest.mark.parametrize("hot", [2, 24])
def test_components_equal_all_pairs(spark, hot):
    rows = clusters(np.random.default_rng(3))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
                          hot=hot)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}
    assert got == brute(rows)


def test_given_documents_equal_all_pairs(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    assert got == brute(rows)


def high_text(rng, n, start=()):
    """Words after ``start`` so that the n shingles have no element of the low part."""
    while True:
        out = list(start)
        while len(out) < n + 4:
            out += words(rng, 1, 100_000)
            if len(out) >= 5 and ngram_join.low_count(ngram_join.shingle_set(" ".join(out[-5:]))):
                out.pop()
        s = ngram_join.shingle_set(" ".join(out))
        if len(s) == n and not ngram_join.low_count(s):
            return out


def test_different_sets_without_low_elements(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(6):
        for part in (high_text(rng, 8), high_text(rng, 8)):
            rows.append(part)
        rows.append(high_text(rng, 9, rows[-1]))
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) == 12


def test_unlike_sets_of_a_group_are_not_all_compared(spark, monkeypatch):
    """Short texts, and texts that share all their low elements, but no text resembles another."""
    rng, asked = np.random.default_rng(6), []
    short = [high_text(rng, 1) for _ in range(150)]
    while True:
        passage = words(rng, 7, 100_000)
        if ngram_join.low_count(ngram_join.shingle_set(" ".join(passage))) == 3:
            break
    alike = []
    while len(alike) < 120:
        new = passage + words(rng, 5, 100_000)
        s = ngram_join.shingle_set(" ".join(new))
        if (len(s), ngram_join.low_count(s)) == (8, 3):
            alike.append(new)
    verified = ngram_join.verified

    def counting(docs, pairs, reps, name):
        asked.append(pairs.where("x <> y").distinct().count())
        return verified(docs, pairs, reps, name)

    monkeypatch.setattr(ngram_join, "verified", counting)
    rows = [(i, " ".join(r)) for i, r in enumerate(short + alike)]
    got = {r.doc_id: r.component_id for r in ngram_join.join(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i for i in range(270)}
    assert sum(asked) <= 2 * 270


def test_odd_rows(spark):
    got = sorted(map(tuple, ngram_join.join(odd_documents(spark)).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0))
    assert [r for r in got if r[0] in (1, 2, 3, 5, 6)] == [
        (1, 0, 1), (2, 0, 2), (3, 1, 3), (3, 1, 3), (5, 0, 5), (6, 1, 6)]
    assert got[-1][0] is None and got[-1][2] is None and len(got) == 8
    assert ngram_join.join(empty_documents(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(
        spark.createDataFrame(pairs, "x long, y long")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, **{k: 100 for k in range(101, 160)}}


def test_filter_holds_what_was_put_in(spark):
    ids = spark.range(0, 5000, 7).toDF("id")
    docs = spark.range(5000).selectExpr("id as doc_id", "'t' as text")
    held = {r.doc_id for r in passing(docs, id_filter(ids)).collect()}
    assert held >= set(range(0, 5000, 7)) and len(held) < 1000
