"""Records of bounded size, scoring in batches, and warnings."""

import random

from pyspark.sql import functions as F

from rollcall.operators import assemble, verdicts

ELEMENTS = "tenant string, email string, first_seq long, first_pos int, element string"


def test_records_hold_all_elements_in_order_whatever_the_key_holds(spark):
    rng = random.Random(1)
    rows = [("t", "hot", i // 3, i % 3, f"e{i:05}") for i in range(9000)]
    rows += [("t", f"k{i}", i, 0, "only") for i in range(20)]
    rng.shuffle(rows)
    got = assemble.packed(spark.createDataFrame(rows, ELEMENTS), ["tenant", "email"],
                          F.col("element"), 1000).collect()
    hot = sorted((r.part, r["items"]) for r in got if r.email == "hot")
    assert [p for p, _ in hot] == list(range(9)) and {len(v) for _, v in hot} == {1000}
    assert [e for _, v in hot for e in v] == [f"e{i:05}" for i in range(9000)]
    assert sum(r.email != "hot" for r in got) == 20
    first = assemble.packed(spark.createDataFrame(rows, ELEMENTS), ["tenant", "email"],
                            F.col("element"), 5, first_only=True).collect()
    assert [r["items"] for r in first if r.email == "hot"] == [[f"e{i:05}" for i in range(5)]]


def test_places_across_cells(spark):
    rows = [("t", "a", s, p, "x") for s in (0, 5, 4095, 4096, 9000, 123456) for p in (0, 1)]
    got = assemble.placed(spark.createDataFrame(rows, ELEMENTS), ["tenant", "email"], "first_seq",
                          "first_pos").orderBy("first_seq", "first_pos").collect()
    assert [r.place for r in got] == list(range(12))


def test_exposure_records_of_addresses_without_findings(spark):
    heads = spark.createDataFrame([("t", "a", ["s"]), ("t", "b", [])],
                                  "tenant string, email string, services array<string>")
    rows = spark.createDataFrame([("t", "a", 1, 0, '{"source":"s","data":[1,{"type":"T","data":"d"}]}'),
                                  ("t", "a", 2, 0, "broken {"), ("t", "a", 3, 0, '"text"')], ELEMENTS)
    got = {r.email: r for r in assemble.exposure_records(heads, rows).collect()}
    assert [(f.kind, f.data) for f in got["a"].findings][:2] == [("raw_event", "1"), ("raw_event", '"d"')]
    assert ("unknown", '"text"') in [(f.kind, f.data) for f in got["a"].findings]
    assert (got["b"].part, got["b"].findings) == (0, [])


def test_sections_of_unequal_length(spark):
    schema = "tenant string, first_seq long, first_pos int, value string"
    long = spark.createDataFrame([("t", i, 0, str(i)) for i in range(5)], schema)
    short = spark.createDataFrame([("t", 1, 0, "s"), ("u", 1, 0, "u")], schema)
    got = {(r.tenant, r.part): (r.long, r.short)
           for r in assemble.records_of({"long": long, "short": short}, ["tenant"], 2).collect()}
    assert got == {("t", 0): (["0", "1"], ["s"]), ("t", 1): (["2", "3"], []), ("t", 2): (["4"], []),
                   ("u", 0): ([], ["u"])}


# --- scoring ----------------------------------------------------------------------------------

RECORDS = "tenant string, batch long, record string, n long"


def test_the_scorer_runs_once_a_batch_and_failures_keep_their_records(spark, tmp_path):
    calls = str(tmp_path)

    def scorer(batch):
        import pandas as pd
        import uuid

        with open(f"{calls}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(batch)))
        if (batch["n"] == 13).any():
            raise ValueError("thirteen")
        return pd.DataFrame({"identifier": batch["record"], "keep": batch["n"] % 2 == 0, "seq": batch["n"]})

    rows = [("t" if i < 90 else "u", i // 10, f"r{i}", i) for i in range(100)] + [(None, 99, "r100", 100)]
    records = spark.createDataFrame(rows, RECORDS).repartition(7)
    scores, failed = verdicts.score_batches(
        records, scorer, "identifier string, keep boolean, seq long", ["record", "n"], ["tenant", "batch"])
    judged = verdicts.attach_verdicts(
        records, scores.withColumn("note", F.lit("n")), "record", ["note"]).collect()
    warned = verdicts.failed_batch_warnings(failed, "emails", "batch").collect()
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sorted(sizes) == [1] + [10] * 10
    assert {r.record for r in judged if r.keep} >= {f"r{i}" for i in range(10, 20)}
    assert [(r.tenant, r.warning) for r in warned] == [
        ("t", "[emails] Batch 1 failed (thirteen): keeping 10 record(s) unfiltered")]


def test_verdicts_keep_their_batch_whatever_a_scorer_returns(spark):
    """Verdicts may be fewer or more than the records of a batch."""
    def scorer(batch):
        import pandas as pd

        times = int(batch["n"].iloc[0]) // 10 % 3
        one = pd.DataFrame({"identifier": batch["record"], "keep": True, "seq": batch["n"]})
        return one.loc[one.index.repeat(times)]

    rows = [("t", i // 10, f"r{i}", i) for i in range(300)]
    scores, failed = verdicts.score_batches(
        spark.createDataFrame(rows, RECORDS).coalesce(1), scorer,
        "identifier string, keep boolean, seq long", ["record", "n"], ["tenant", "batch"])
    got = sorted((r.tenant, r.batch, r.identifier) for r in scores.collect())
    assert got == sorted(("t", i // 10, f"r{i}") for i in range(300) for _ in range(i // 10 % 3))
    assert failed.count() == 0


def test_scoring_nothing(spark):
    scores, failed = verdicts.score_batches(
        spark.createDataFrame([], RECORDS), lambda b: b, "identifier string, keep boolean, seq long",
        ["record", "n"], ["tenant", "batch"])
    assert scores.count() == failed.count() == 0


def test_grounding_warnings_are_per_tenant_and_category(spark):
    shaped = spark.createDataFrame([("t", "emails", "A@x.io"), ("t", "domains", "x.io")],
                                   "tenant string, category string, identifier string")
    given = spark.createDataFrame(
        [("t", "emails", " a@X.io"), ("u", "emails", "a@x.io"), ("t", "domains", "a@x.io"), ("t", "emails", " ")],
        "tenant string, category string, identifier string")
    got = sorted((r.tenant, r.category, r.warning)
                 for r in verdicts.grounding_warnings(given, shaped).collect())
    assert got == [("t", "domains", "identifier not present in input"),
                   ("t", "emails", "missing identifier"),
                   ("u", "emails", "identifier not present in input")]
