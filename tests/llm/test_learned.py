import numpy as np
import pytest
from helpers import empty_documents, odd_documents, words
from pyspark.sql import functions as F

from rollcall.llm import ann, language, linear, quality, toxicity
from rollcall.llm.common import in_fold, table
from rollcall.llm.textgrams import Distinct, word_features

SF = "/root/testdata/sf0.01"


def test_hinge_machine_separates():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for i in range(200):
        y.append(1.0 if i % 2 else -1.0)
        idx = np.concatenate(([3 if i % 2 else 5], rng.integers(10, 50, 5)))
        rows.append((np.unique(idx), np.ones(len(np.unique(idx)))))
    w = linear.dual_coordinate_descent(rows, np.array(y), 50, np.full(200, 1.0))
    margin = np.array([w[i] @ v + w[-1] for i, v in rows])
    assert (np.sign(margin) == y).all()
    a, b = linear.logistic_1d(margin, np.array(y))
    assert a > 0 and ((linear.sigmoid(a * margin + b) > 0.5) == (np.array(y) > 0)).all()


def test_ordinal_weights_are_shared_and_thresholds_ordered():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(600):
        k = int(rng.integers(0, 4))
        rows.append(np.concatenate((rng.choice(10, k, replace=False), [10 + rng.integers(10)])))
        grades.append(k)
    w, theta = toxicity.fit_ordinal(rows, np.array(grades), 20, 3)
    assert (np.diff(theta) > 0).all() and w[:10].min() > abs(w[10:]).max()
    model = toxicity.Model(np.arange(20, dtype=np.int32), w, theta)
    severity = [model.chances(np.arange(k, dtype=np.int32)).sum() for k in range(4)]
    assert severity == sorted(severity) and severity[0] < 0.5 and severity[3] > 2.5


def test_distinct_and_word_features():
    d = Distinct(20)
    for text in ("", "one", "Scum scum chllaso chllave", None):
        f = word_features(text, 20)
        assert sorted(d(f)) == sorted(set(f.tolist()))
    a, b = (set(word_features(t, 20).tolist()) for t in ("chllaso", "chllave"))
    assert len(a & b) == 2                                 # two common beginnings


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def test_toxicity_on_given_labels(spark):
    large = "/root/testdata/sf0.1"             # the smaller tables mark too few rows as toxic
    docs, labels = table(spark, large, "documents"), table(spark, large, "labels")
    even = labels.where(in_fold(F.col("doc_id"), 4, 0))
    model = toxicity.fit(docs, labels.where(~in_fold(F.col("doc_id"), 4, 0)))
    got = toxicity.grade(docs, model).join(even, "doc_id").where("quality = 1").select(
        "toxicity.*", "toxic").toPandas()
    caught = got["chance"] >= toxicity.REJECT
    assert caught[got["toxic"] == 1].mean() > 0.6 and caught[got["toxic"] == 0].mean() < 0.03
    assert got["severity"][got["toxic"] == 1].mean() > got["severity"][got["toxic"] == 0].mean()


def test_quality_on_held_out_labels(spark, docs):
    labels = table(spark, SF, "labels")
    model = quality.fit(quality.label_rows(docs, labels.where(~in_fold(F.col("doc_id"), 5, 0)),
                                           "quality"))
    got = quality.score(docs, model).join(
        labels.where(in_fold(F.col("doc_id"), 5, 0)), "doc_id").toPandas()
    assert ((got["score"] >= 0.3) == (got["quality"] == 1)).mean() > 0.95
    assert got["score"].between(0, 1).all()


def test_language_on_held_out_rows(spark, docs):
    held = in_fold(F.col("doc_id"), 3, 1)
    model = language.fit(docs.where(~held))
    got = language.predict(docs.where(held), model).toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97
    assert model.within.keys() == {"germanic", "romance"}
    odd = {r["doc_id"]: (r["lang_pred"], r["score"])
           for r in language.predict(odd_documents(spark), model).collect()}
    assert odd[1] == odd[2] == odd[5] == odd[6] == ("und", 0.0) and odd[4][0] != "und"
    assert language.predict(empty_documents(spark), model).count() == 0


def test_nothing_to_learn_from(spark):
    rows = odd_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(3, None, None), (4, 1, 0), (None, 0, 1)],
                                "doc_id long, quality int, toxic int")
    for labels in (none, one):
        tox = toxicity.grade(rows, toxicity.fit(rows, labels)).collect()
        assert len(tox) == 8 and all(r["toxicity"]["grade"] == 0 for r in tox)
        model = quality.fit(quality.label_rows(rows, labels, "quality"))
        assert quality.score(rows, model).where("score between 0 and 1").count() == 8
    model = language.fit(rows.limit(0))
    assert {r["lang_pred"] for r in language.predict(rows, model).collect()} == {"und"}


def brute(rows, k):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            own = sorted((-float(np.dot(np.float64(v), np.float64(w))), i)
                         for i, w in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in own]
    return out


def test_neighbours_of_few_vectors_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]            # a hot vector
    bad = [(20, None), (40, [0.0] * 8), (2000, [1.0, None] + [0.0] * 6),
           (2020, [float("nan")] + [1.0] * 7), (2040, [float("inf")] * 8), (None, [1.0] * 8),
           (2060, [1.0, 2.0]), (2080, [])]
    rows = [r for r in rows if r[0] not in (20, 40)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, lambda key: key % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows, 20)
    assert got.keys() == want.keys()
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [v for _, v, _ in found] == [v for v, _ in want[q]]
        assert np.allclose([s for _, _, s in found], [s for _, s in want[q]], rtol=0, atol=1e-12)
    few = ann.nearest(df.where("vec_id < 10"), lambda key: key % 5 == 0).collect()
    assert len(few) == 18
    assert ann.nearest(df.limit(0), lambda key: key % 5 == 0).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    v = centres[rng.integers(40, size=4000)] + 0.5 * rng.normal(size=(4000, 32))
    v *= rng.uniform(0.5, 2.0, size=(4000, 1))                     # lengths differ
    graph = ann.Graph(ann.augmented(v)).build()
    assert (graph.edges >= 0).sum(axis=1).max() <= ann.DEGREE
    q = v[:200]
    near, _ = graph.search(q, ann.BEAM, ann.scaled(v))
    true = np.argsort(-(q @ v.T), axis=1)[:, :20]
    hit = [len(set(t) & set(np.array(n)[np.argsort(-(v[n] @ x))][:20]))
           for t, n, x in zip(true, near, q)]
    assert np.mean(hit) / 20 >= 0.9


@pytest.mark.parametrize("lengths", ["given", "stretched", "log-normal", "one very long", "huge"])
def test_recall_of_nearest(spark, lengths):
    rng = np.random.default_rng(8)
    n = 6000
    centres = rng.normal(size=(60, 24))
    v = centres[rng.integers(60, size=n)] + 0.6 * rng.normal(size=(n, 24))
    v /= np.linalg.norm(v, axis=1)[:, None]
    if lengths == "stretched":
        v *= rng.uniform(0.2, 5.0, size=(n, 1))
    elif lengths == "log-normal":
        v *= rng.lognormal(0, 1.5, size=(n, 1))
    elif lengths == "one very long":
        v[4321] *= 1e4
    elif lengths == "huge":
        v *= 10.0 ** rng.integers(-60, 60, size=(n, 1))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)],
                               "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, lambda key: key % 40 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert len(got) == n // 40
    hit = 0
    for q, found in got.items():
        s = v @ v[q]
        s[q] = -np.inf
        hit += len(found & set(np.argsort(-s, kind="stable")[:20].tolist()))
    assert hit >= 0.95 * 20 * len(got)


def test_samples_are_bounded_by_rows_whatever_is_repeated(spark):
    from pyspark.sql import functions as F

    from rollcall.llm import language, quality

    one = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, 7).alias("doc_id"), F.lit("the very same text").alias("text"),
        (F.col("id") % 3 == 0).cast("int").alias("y"))
    rest = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("text number "), F.col("id")).alias("text"), (F.col("id") % 2).cast("int").alias("y"))
    rows = one.unionByName(rest)
    got = quality.sample_features(rows, quality.quality_features, 12, 50)
    assert sorted(got.groupby("y").size()) == [50, 50]
    sent = []
    real = language.train_pairs
    language.train_pairs = lambda names, vectors, kind: (sent.append(len(vectors)), real(names, vectors, kind))[1]
    try:
        docs = rows.withColumn("lang", F.when(F.col("doc_id") == 7, "en").otherwise("fr"))
        model = language.fit(docs, per_language=40)
    finally:
        language.train_pairs = real
    assert max(sent) == 80 and model.predict("the very same text")[0] == "en"


def test_long_runs_of_letters_are_read_whole():
    from rollcall.llm import textgrams

    long = "".join(chr(0x4E00 + i) for i in range(300))
    seen = set(textgrams.word_features(long, 20))
    assert len(seen) > 30 and seen != set(textgrams.word_features(long[:-40], 20))
