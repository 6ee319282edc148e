import subprocess
import sys
from pathlib import Path

import corpus_pipeline as pipeline
from helpers import empty_documents, odd_documents

from rollcall.llm import decontam, ngram_join, secrets
from rollcall.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    fox = table(spark, SF, "benchmark").first()["text"]
    more = spark.createDataFrame(
        [(9000, f"Before this. {fox} And after.", "en", "s", 1),
         (9001, 'password = "hunter2hunter2" ' + " ".join(f"q{i}" for i in range(60)), "en", "s",
          1), (9002, docs.first()["text"], "en", "s", 1)], docs.schema)
    docs = docs.union(more)
    first = docs
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == first.columns and after.count() <= docs.count(), name
        docs = after
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 9000 not in left and "hunter2" not in left[9001] and 9002 not in left
    assert not any(r["leaks"] for r in decontam.find(docs, table(spark, SF, "benchmark")).collect())
    found = ngram_join.join(docs)
    assert found.where("component_id <> doc_id").count() == 0
    assert secrets.scan(docs).where("found.n_assign + found.n_hex > 0").count() == 0
    pieces = pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in pieces.collect()} == left.keys()


def test_odd_rows_pass_the_filtering_stages(spark):
    docs = odd_documents(spark)
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    rows = docs.collect()
    assert docs.columns == odd_documents(spark).columns
    assert sorted(r["doc_id"] or 0 for r in rows) == [0, 1, 2, 3, 4, 5, 6]
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty_documents(spark), SF).count() == 0


def test_the_rest_stands_without_this_package(tmp_path):
    root = Path(__file__).resolve().parents[2]
    code = ("import sys\nsys.path.insert(0, sys.argv[1])\nimport __spark_entry__ as e\n"
            "assert 'merge_domains' in e.queries() and 'pipeline' not in e.queries()")
    (tmp_path / "rollcall").mkdir()
    for p in (root / "rollcall").iterdir():
        if p.name != "llm":
            (tmp_path / "rollcall" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").symlink_to(root / "__spark_entry__.py")
    run = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=tmp_path,
                         capture_output=True, text=True, timeout=100)
    assert run.returncode == 0, run.stderr


def test_unlike_texts_of_one_id_all_stay(spark):
    import random

    rng = random.Random(5)

    def text(n=40):
        return " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(n))

    a, b, c, d = text(), text(), text(), text()
    near = a + " and one more"
    rows = [(5, None), (5, a), (5, b), (5, b), (5, b), (6, near), (7, c), (8, c), (8, d), (9, near),
            (9, a), (None, a), (None, a), (10, ""), (10, "")]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", 1) for k, (i, t) in enumerate(rows)],
                                 table(spark, SF, "documents").schema)
    got = pipeline.keep_one_of_each_group(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in got.collect()) == sorted([
        (5, ""), (5, a), (5, b), (7, c), (8, d), (0, a), (0, a), (10, ""), (10, "")])
