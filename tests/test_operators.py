"""Golden rows and properties of the operators."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import classify, dedup, joins, report, review, store, verdicts
from rollcall.streaming import upserts

RECORD = ("tier string, entity string, tenant string, record_key string, data string, "
          "updated_at timestamp, seq bigint")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def shuffled(spark, data, schema, seed):
    mixed = list(data)
    random.Random(seed).shuffle(mixed)
    return spark.createDataFrame(mixed, schema).repartition(3)


# --- dedup ------------------------------------------------------------------------------------

def test_addresses_last_candidate_then_validated_sources(spark):
    cand = spark.createDataFrame(
        [("t", "A@x.com ", "old", ["a"], 0), ("t", "a@x.com", "new", ["b"], 1), ("t", "", "n", ["z"], 2)],
        "tenant string, email string, employee string, sources array<string>, seq bigint")
    val = spark.createDataFrame(
        [("t", "a@x.com", None, ["c"], "deliverable", None, True, 0)],
        "tenant string, email string, employee string, sources array<string>, "
        "validation_status string, confidence double, is_catch_all boolean, seq bigint")
    assert rows(dedup.merge_addresses(cand, val)) == [
        ("t", "a@x.com", "new", ["b", "c"], "deliverable", 0.0, True)]


def test_documents_prefer_the_first_verified(spark):
    docs = spark.createDataFrame(
        [("t", "d", "f", False, 0), ("t", "d", "f", True, 1), ("t", "d", "f", True, 2),
         ("t", "d", "g", None, 3), ("t", "d", "g", False, 4), ("t", None, "", True, 5)],
        "tenant string, source_domain string, filename string, content_verified boolean, seq bigint")
    got = dedup.merge_documents(docs).select("filename", "seq")
    assert rows(got) == [("f", 1), ("g", 3)]


def test_methods_keep_duplicates_of_the_first(spark):
    schema = "tenant string, filename string, seq bigint"
    one = spark.createDataFrame([("t", "a", 0), ("t", "a", 1)], schema)
    two = spark.createDataFrame([("t", "a", 2), ("t", "b", 4), ("t", "b", 3)], schema)
    assert rows(dedup.merge_document_methods(one, two)) == [("t", "a", 0), ("t", "a", 1), ("t", "b", 3)]


@pytest.mark.parametrize("seed", range(3))
def test_order_of_input_rows_does_not_matter(spark, seed):
    data = [("t", f"k{i % 7}", [f'{{"a":{i % 3},"b":1}}', f'{{"b":1,"a":{i % 3}}}', "7"], i)
            for i in range(60)]
    schema = "tenant string, email string, els array<string>, seq bigint"
    got = dedup.distinct_elements(shuffled(spark, data, schema, seed), ["tenant", "email"], "els", "seq")
    want, seen = [], set()
    for tenant, key, els, seq in data:
        firsts = list(dict.fromkeys([f'{{"a":{seq % 3},"b":1}}', "7"]))
        for pos, e in enumerate(firsts):
            if (key, e) not in seen:
                seen.add((key, e))
                want.append((tenant, key, e, seq, pos))
    assert rows(got) == sorted(want, key=str)
    top = dedup.first_elements(got, ["tenant", "email"], 2)
    assert all(len(r.elements) == 2 for r in top.collect()) and top.count() == 7


def test_first_and_last_wins(spark):
    data = [("a", i, f"v{i}") for i in range(20)] + [("b", 3, "x")]
    df = shuffled(spark, data, "k string, seq bigint, v string", 1)
    assert rows(dedup.last_wins(df, ["k"], "seq")) == [("a", 19, "v19"), ("b", 3, "x")]
    assert rows(dedup.first_wins(df, ["k"], "seq")) == [("a", 0, "v0"), ("b", 3, "x")]


def test_patterns(spark):
    inv = spark.createDataFrame([("t", "j.doe@x.com"), ("t", "j_roe@x.com"), ("t", "k@y.com")],
                                "tenant string, email string")
    targets = spark.createDataFrame([("t", "x.com")], "tenant string, domain string")
    got = {r.pattern for r in dedup.observed_patterns(inv, targets).collect()}
    assert got == {"{first}.{last}", "{first}_{last}", "{first}{last}", "{f}{last}", "{f}.{last}"}


# --- joins ------------------------------------------------------------------------------------

@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("k"), F.col("id").alias("seq"))
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    plain = facts.join(lookup, "k", how)
    salted = joins.salted_join(facts, lookup, ["k"], "seq", how, hot_rows=250)
    assert rows(salted.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("how", ["right", "full"])
def test_salted_join_refuses_to_keep_unmatched_lookup_rows(spark, how):
    df = spark.createDataFrame([("a", 1)], "k string, seq int")
    with pytest.raises(ValueError, match="not " + how):
        joins.salted_join(df, df, ["k"], "seq", how)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from rollcall.plans.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf)
    with pytest.raises(ValueError, match="share"):
        checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))


def test_salted_join_spreads_the_hot_key(spark):
    facts = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"))
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.salted_join(facts, lookup, ["k"], "seq", hot_rows=60)
        parts = out.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1


def test_unfolded_names_are_never_expected(spark):
    people = spark.createDataFrame([("t", "Zoé", "Ann", None, 0), ("t", None, " ", "Al Bo", 1)],
                                   "tenant string, first_name string, last_name string, name string, seq bigint")
    patterns = spark.createDataFrame([("t", "{first}.{last}")], "tenant string, pattern string")
    expected = joins.expected_local_parts(people, patterns)
    inv = spark.createDataFrame(
        [("t", "zoe.ann@x.com", ["s"]), ("t", "al.bo@x.com", ["s"]), ("t", "al.bo@mail.x.com", ["s"])],
        "tenant string, email string, sources array<string>")
    assert rows(joins.reconcile_expected(inv, expected)) == [
        ("t", "al.bo@mail.x.com", None, ["s"]),
        ("t", "al.bo@x.com", "Al Bo", ["Inferred-Pattern", "s"]),
        ("t", "zoe.ann@x.com", None, ["s"])]


def test_best_address(spark):
    kept = spark.createDataFrame(
        [("t", "xdoe@d", "X", 0), ("t", "x.doe@d", "X", 1), ("t", "x_doe@d", "X", 2), ("t", "a@d", None, 3)],
        "tenant string, email string, employee string, seq bigint")
    assert rows(report.best_addresses(kept)) == [("t", "d", "-", "a@d"), ("t", "d", "X", "x.doe@d")]


# --- tiers ------------------------------------------------------------------------------------

def tier_of(spark, current, history, domain="bts.com.tn", name="Banque Tunisienne"):
    pos = "array<struct<title:string,company_name:string,end_date:string>>"
    df = spark.createDataFrame(
        [(domain, name, current, history)],
        f"matched_domain string, company_name string, current_position {pos}, all_positions {pos}")
    r = classify.classify(df).first()
    return r.employee_tier, r.tier_reason


@pytest.mark.parametrize("title,want", [
    ("International Sales Director", "intern"), ("Events Coordinator", "leadership"),
    ("Factory Worker", "leadership"), ("Software Engineer", "current_employee"),
    ("Vice-Président", "leadership"), (None, "current_employee")])
def test_current_titles(spark, title, want):
    assert tier_of(spark, [(title, "B-T_S Bank", None)], [])[0] == want


@pytest.mark.parametrize("end,want", [("2020", "former_employee"), (" Present ", "current_employee"),
                                      (None, "current_employee"), ("", "current_employee")])
def test_history_end_dates(spark, end, want):
    assert tier_of(spark, None, [("Engineer", "BTS", end)])[0] == want


def test_no_match_is_a_reject_and_reason_quotes_the_first_title(spark):
    assert tier_of(spark, [("Boss", "Other", None)], None)[0] == "reject"
    assert tier_of(spark, [(None, "BTS", None), (" Clerk ", "bts sa", None)], [])[1] == (
        "Current employee at target company (Clerk).")


def test_keyword_across_titles(spark):
    """Titles are joined by a space before the test, so 'Head' + 'of Sales' holds 'head of'."""
    assert tier_of(spark, [("Head", "BTS", None), ("of Sales", "BTS", None)], [])[0] == "leadership"


# --- verdicts ---------------------------------------------------------------------------------

def verdict_table(spark, data):
    df = spark.createDataFrame(data, "identifier string, k string, tier string, note string, seq bigint")
    return df.withColumn("keep", F.parse_json("k")).drop("k").withColumn("tenant", F.lit("t"))


def test_grounding_and_fail_open(spark):
    recs = spark.createDataFrame([("A",), ("b",), ("c",), ("",), (None,)], "id string").withColumn(
        "tenant", F.lit("t"))
    v = verdict_table(spark, [(" a ", "false", None, "n", 0), ("zz", "true", None, None, 1),
                              ("b", '"no"', None, "m", 2), ("", "false", None, None, 3)])
    got = {r.id: (r.keep, r.note) for r in verdicts.attach_verdicts(recs, v, "id").collect()}
    fail_open = (True, "not_evaluated_by_model_fail_open")
    assert got == {"A": (False, "n"), "b": (True, "m"), "c": fail_open, "": fail_open, None: fail_open}
    warned = verdicts.verdict_warnings(v, recs, "id", "x")
    assert sorted(r.identifier for r in warned.collect()) == ["", "zz"]


def test_a_verdict_stays_with_its_tenant(spark):
    """Two tenants with one name: neither verdicts nor grounding cross over."""
    recs = spark.createDataFrame([("a", "John Smith"), ("b", "John Smith"), ("b", "Only B")],
                                 "tenant string, id string")
    v = verdict_table(spark, [("john smith", "false", None, "a's", 9), ("only b", "true", None, "", 8)])
    v = v.withColumn("tenant", F.lit("a")).unionByName(
        verdict_table(spark, [("john smith", "true", None, "b's", 1)]).withColumn("tenant", F.lit("b")))
    got = {(r.tenant, r.id): (r.keep, r.note) for r in verdicts.attach_verdicts(recs, v, "id").collect()}
    assert got == {("a", "John Smith"): (False, "a's"), ("b", "John Smith"): (True, "b's"),
                   ("b", "Only B"): (True, "not_evaluated_by_model_fail_open")}
    warned = verdicts.verdict_warnings(v, recs, "id", "x").collect()
    assert [(w.tenant, w.identifier) for w in warned] == [("a", "only b")]


EMAIL = ("email string, sources array<string>, validation_status string, confidence double, "
         "keep boolean, tier string, note string")


def corrected(spark, *row):
    df = spark.createDataFrame([row], EMAIL)
    return verdicts.reconcile_guesses(
        verdicts.enforce_catch_all(verdicts.enforce_tier_rules(df))).first()


def test_address_corrections(spark):
    guess = ["Pattern-Generation"]
    assert corrected(spark, "a@x", ["s"], "unknown", 0.5, True, "confirmed", None).tier == "likely"
    assert corrected(spark, "a@x", ["s"], "unknown", 0.0, True, "confirmed", None).tier == "speculative"
    r = corrected(spark, "a@x", guess, "smtp_inconclusive_catchall", 0.0, True, None, "open")
    assert (r.tier, r.keep, r.catchall_unverifiable) == ("speculative", False, True)
    assert r.note.startswith("open Reconciled") and len(r.warnings) == 2
    assert corrected(spark, "a@x", guess, "unknown", 0.0, True, None, None).keep
    assert corrected(spark, "a@x", guess + ["s"], "unknown", 0.0, True, "noise", None).keep
    assert not corrected(spark, "a@x", guess, "unknown", None, True, "noise", None).keep


def test_structural_exclusion_at_a_catch_all_becomes_speculative(spark):
    df = spark.createDataFrame(
        [("a@mail.x.com", ["s"], "smtp_inconclusive_catchall", 0.0)],
        "email string, sources array<string>, validation_status string, confidence double")
    df = df.withColumn("tenant", F.lit("t"))
    r = verdicts.filter_addresses(df, verdict_table(spark, [("q", "true", None, None, 0)])).first()
    assert (r.keep, r.tier) == (False, "speculative")


def test_scorer_batches_and_failures(spark):
    def scorer(part):
        if (part["n"] == 13).any():
            raise ValueError("bad luck")
        return part.assign(identifier=part["id"], keep=len(part) == 4, seq=part["n"])[
            ["identifier", "keep", "seq"]]

    recs = spark.range(16).coalesce(1).select(F.col("id").cast("string").alias("id"), F.col("id").alias("n"))
    out = verdicts.score(recs, scorer, "identifier string, keep boolean, seq bigint", ["id", "n"], 4)
    done = out.collect()
    assert sum(r.error is not None for r in done) == 1 and len(done) == 13
    assert all(r.keep for r in done if r.error is None)


# --- store and review -------------------------------------------------------------------------

def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("t", "k", "v1"), ("t", "z", "v0")], "tenant string, record_key string, data string")
    batch = spark.createDataFrame([("t", "k", "v2", 0), ("t", "k", "v3", 1), ("u", "k", "n", 2)],
                                  "tenant string, record_key string, data string, seq bigint")
    keys = ["tenant", "record_key"]
    once = store.upsert(old, batch, keys)
    assert rows(once) == [("t", "k", "v3"), ("t", "z", "v0"), ("u", "k", "n")]
    assert rows(store.upsert(once, batch, keys)) == rows(once)


def test_null_keys_are_rejected_and_unknown_entities_refused(spark):
    df = spark.createDataFrame([("t", "a.com"), ("t", None)], "tenant string, domain string")
    good, bad = store.to_records(df, "raw", "domains")
    assert good.count() == 1 and bad.count() == 1
    with pytest.raises(ValueError):
        store.check_entity("passwords")


def at(n):
    import datetime

    return datetime.datetime(2024, 1, 1, 0, 0, n)


def test_store_versions_replay_late_rows_and_compaction(spark, tmp_path):
    path = str(tmp_path / "s")
    store.init_store(spark, path)
    store.init_store(spark, path)

    def rec(key, data, when, seq=0):
        return ("raw", "domains", "t", key, data, at(when), seq)

    def batch(*r):
        return spark.createDataFrame(list(r), RECORD)

    store.write_version(batch(rec("a", "1", 1), rec("b", "1", 5)), path, 1)
    store.write_version(batch(rec("a", "2", 2, 0), rec("a", "3", 2, 1)), path, 2)
    want = [("a", "3"), ("b", "1")]
    assert rows(store.current(spark, path).select("record_key", "data")) == want
    store.write_version(batch(rec("a", "2", 2, 0), rec("a", "3", 2, 1)), path, 2)
    assert rows(store.current(spark, path).select("record_key", "data")) == want
    folded = str(tmp_path / "f")
    store.compact(spark, path, folded)
    store.write_version(batch(rec("b", "late", 3), rec("c", "new", 4)), folded, 1)
    assert rows(store.current(spark, folded).select("record_key", "data")) == want + [("c", "new")]


def test_stream_equals_batch(spark, tmp_path):
    data = [("raw", "domains", f"t{i % 2}", f"k{i % 5}", f"v{i}", at(i), i) for i in range(40)]
    src, path = str(tmp_path / "in"), str(tmp_path / "s")
    for part in (data[20:], data[:20]):
        spark.createDataFrame(part, RECORD).coalesce(1).write.mode("append").parquet(src)
    for _ in range(2):  # the second run has nothing new to do
        stream = upserts.observation_stream(spark, src, RECORD, 1)
        upserts.stream_upserts(stream, path, str(tmp_path / "c")).awaitTermination()
    want = dedup.last_wins(spark.createDataFrame(data, RECORD), store.KEYS, "seq").drop("seq")
    assert rows(store.current(spark, path).select(*want.columns)) == rows(want)


def merge_records(spark):
    return spark.createDataFrame(
        [("raw", "domains", "s", k) for k in "123"] + [("raw", "domains", "t", k) for k in "34"]
        + [("raw", "domains", "other", "1")], "tier string, entity string, tenant string, record_key string")


def test_merge_preview_and_conservation(spark):
    recs = merge_records(spark)
    p = review.preview_merge(recs, "s", "t").first()
    assert (p.would_move, p.collisions, p.moving) == (3, 1, 2)
    assert [r.record_key for r in review.merge_collisions(recs, "s", "t").collect()] == ["3"]
    out = review.execute_merge(recs, "s", "t")
    assert rows(out.groupBy("tenant").agg(F.sort_array(F.collect_list("record_key")))) == [
        ("other", ["1"]), ("s", ["3"]), ("t", ["1", "2", "3", "4"])]
    same = review.preview_merge(recs, "s", "s").first()
    assert (same.would_move, same.collisions) == (3, 3)
    assert rows(review.execute_merge(recs, "s", "s")) == rows(recs)


def test_approval_takes_edits_and_needs_a_raw_row(spark):
    now = F.timestamp_seconds(F.lit(0))
    recs = spark.createDataFrame(
        [("raw", "dns_infra", "t", "a", "A", at(1)), ("reviewed", "infrastructure", "t", "b", "old", at(1))],
        RECORD.replace(", seq bigint", ""))
    asks = spark.createDataFrame(
        [("dns_infra", "t", "a", None, 0), ("dns_infra", "t", "b", "edited", 1), ("dns_infra", "t", "x", None, 2)],
        "entity string, tenant string, record_key string, edited_data string, seq bigint")
    done = review.resolve_approvals(recs, asks)
    assert [r.record_key for r in done.where("not ok").collect()] == ["x"]
    after = review.approve(recs, done, now).where("tier = 'reviewed'")
    assert rows(after.select("entity", "record_key", "data")) == [
        ("infrastructure", "a", "A"), ("infrastructure", "b", "edited")]


# --- compact records without and with limits ---------------------------------------------------

def test_compact_records_are_whole_unless_limited(spark):
    from rollcall.operators import compact

    group = "parse_json('{\"type\": \"T\", \"data\": [1, 2, 3, 4, 5, 6, 7]}')"
    df = spark.range(1).select(F.expr(f"array_repeat({group}, 8)").alias("g"))
    whole = df.select(F.size(compact.exposure_findings(F.col("g")))).first()[0]
    some = df.select(F.size(compact.exposure_findings(F.col("g"), 5, 5, 10))).first()[0]
    assert (whole, some) == (56, 25)
    person = spark.createDataFrame(
        [("x", "n", "j", "d", "t", "r", "a" * 900, list("abcdefgh"))],
        "public_identifier string, name string, job_title string, matched_domain string, "
        "employee_tier string, tier_reason string, about string, services_offered array<string>")
    position = ("array_repeat(named_struct('title', 't', 'company_name', 'c', 'start_date', 's', "
                "'end_date', 'e'), 9)")
    person = person.withColumn("all_positions", F.expr(position))
    for limits, want in (((), (9, 900, 8)), ((6, 400, 6), (6, 400, 6))):
        r = compact.compact_person(person, *limits).first()
        assert (len(r.recent_positions), len(r.about_excerpt), len(r.services_offered)) == want
