"""Queries over the record store, review decisions, tenant merges and run reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rollcall.functions import variants
from rollcall.operators import commits, dedup, edits, report, review, store, verdicts
from rollcall.plans import queries_addresses as QA
from rollcall.plans import queries_documents as QD
from rollcall.plans import queries_events as QE
from rollcall.plans import queries_hosts as QH
from rollcall.plans import queries_people as QP
from rollcall.plans import views
from rollcall.plans.registry import query, sql
from rollcall.plans.session import checkpoint_dir, written
from rollcall.streaming import upserts

C = F.col


def _now():
    return F.timestamp_seconds(F.lit(1_700_000_000))


# --- upsert -----------------------------------------------------------------------------------

def _existing(spark, sf):
    return views.table(spark, sf, "orders").select(
        C("o_custkey").alias("tenant"), C("o_orderkey").alias("record_key"),
        C("o_orderpriority").alias("data"))


def _batch(spark, sf):
    """Line items as new versions of orders, some of them for orders not seen before."""
    return views.table(spark, sf, "lineitem").join(
        views.table(spark, sf, "orders"), C("o_orderkey") == C("l_orderkey")
    ).select(
        C("o_custkey").alias("tenant"),
        F.when(C("l_linestatus") == "F", C("l_orderkey")).otherwise(-C("l_orderkey") - 1)
        .alias("record_key"),
        F.concat_ws("/", "l_partkey", "l_suppkey", "l_linenumber").alias("data"),
        (C("l_linenumber") * 10000000000 + C("l_partkey") * 10000 + C("l_suppkey")).alias("seq"),
        "l_returnflag")


BATCH = """
    batch AS (
        SELECT o_custkey AS tenant, CASE l_linestatus WHEN 'F' THEN l_orderkey ELSE -l_orderkey - 1 END
                   AS record_key,
               l_partkey || '/' || l_suppkey || '/' || l_linenumber AS data,
               l_linenumber * 10000000000 + l_partkey * 10000 + l_suppkey AS seq, l_returnflag
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    newest AS (SELECT tenant, record_key, arg_max(data, seq) AS data FROM batch GROUP BY 1, 2),
    after AS (
        SELECT o_custkey AS tenant, o_orderkey AS record_key, o_orderpriority AS data FROM orders
        WHERE (o_custkey, o_orderkey) NOT IN (SELECT (tenant, record_key) FROM newest)
        UNION ALL SELECT * FROM newest)"""


@query("upsert", f"WITH {BATCH} SELECT * FROM after")
def _(spark, sf):
    return store.upsert(_existing(spark, sf), _batch(spark, sf).drop("l_returnflag"),
                        ["tenant", "record_key"])


def _folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("store_upsert", f"""
    WITH {BATCH},
    last AS (SELECT tenant, record_key, arg_max(data, (l_returnflag, seq)) AS data FROM batch
             WHERE l_returnflag <> 'N' GROUP BY 1, 2)
    SELECT o_custkey AS tenant, o_orderkey AS record_key, o_orderpriority AS data FROM orders
    WHERE (o_custkey, o_orderkey) NOT IN (SELECT (tenant, record_key) FROM last)
          AND (o_custkey, o_orderkey) NOT IN (SELECT (tenant, record_key) FROM batch)
    UNION ALL SELECT * FROM last
    UNION ALL SELECT tenant, record_key, arg_max(data, seq) FROM batch
    WHERE (tenant, record_key) NOT IN (SELECT (tenant, record_key) FROM last) GROUP BY 1, 2""")
def _(spark, sf):
    """Orders as base of a bucketed table, line items as commits by return flag, one repeated."""
    path, table = _folder(spark, "store_upsert"), {"orders": commits.Table(
        "tenant bigint, record_key bigint, data string", ["tenant", "record_key"], 16)}
    commits.create(spark, path, table)
    commits.load(spark, path, {"orders": _existing(spark, sf)})
    for number, flag in enumerate("NARA"):
        rows = _batch(spark, sf).where(C("l_returnflag") == flag).drop("l_returnflag")
        commits.commit(spark, path, {"orders": rows}, writer="line items",
                       number=min(number, 2))
    return commits.read(spark, commits.snapshot(spark, path), "orders")


@query("to_records", """
    SELECT 'raw' AS tier, 'emails' AS entity, c_mktsegment AS tenant,
           CASE WHEN c_acctbal > 0 THEN c_name END AS record_key,
           '{' || CASE WHEN c_acctbal > 0 THEN '"email":"' || c_name || '",' ELSE '' END
               || '"nation":' || c_nationkey || '}' AS data,
           c_acctbal > 0 AS accepted
    FROM customer""")
def _(spark, sf):
    c = views.table(spark, sf, "customer").select(
        C("c_mktsegment").alias("tenant"),
        F.when(C("c_acctbal") > 0, C("c_name")).alias("email"), C("c_nationkey").alias("nation"))
    good, bad = store.to_records(c, "raw", "emails", _now())
    return good.withColumn("accepted", F.lit(True)).unionByName(
        bad.withColumn("accepted", F.lit(False))).drop("updated_at")


@query("flatten_map", """
    SELECT n_regionkey AS tenant, n_name AS domain, n_nationkey AS n, length(n_name) AS width FROM nation
    UNION ALL SELECT n_regionkey, r_name, r_regionkey, 0 FROM nation JOIN region ON r_regionkey = n_regionkey""")
def _(spark, sf):
    def value(a, b):
        return F.struct(a.alias("n"), b.alias("width"))

    n = views.table(spark, sf, "nation").join(
        views.table(spark, sf, "region"), C("r_regionkey") == C("n_regionkey"))
    m = n.select(C("n_regionkey").alias("tenant"), F.create_map(
        C("n_name"), value(C("n_nationkey"), F.length("n_name")),
        C("r_name"), value(C("r_regionkey"), F.lit(0))).alias("by_domain"))
    return store.flatten_map(m, "by_domain", "domain")


EVENT_RECORDS = """
    SELECT 'raw' AS tier, CASE WHEN event_type = 'view' THEN 'domains' ELSE 'emails' END AS entity,
           't' || (user_id // 10) AS tenant, user_id::VARCHAR AS record_key,
           arg_max(props, event_id) AS data
    FROM events GROUP BY ALL"""


def _event_records(e):
    return e.select(
        F.lit("raw").alias("tier"),
        F.when(C("event_type") == "view", "domains").otherwise("emails").alias("entity"),
        F.concat(F.lit("t"), F.expr("user_id div 10").cast("string")).alias("tenant"),
        C("user_id").cast("string").alias("record_key"), C("props").alias("data"),
        F.timestamp_seconds("event_id").alias("updated_at"), C("event_id").alias("seq"))


@query("stream_upserts", EVENT_RECORDS)
def _(spark, sf):
    """The events as a stream of files in any order, some of which come twice; the final state."""
    base = _folder(spark, "stream_upserts")
    schema = "tier string, entity string, tenant string, record_key string, data string, " \
        "updated_at timestamp, seq bigint"
    e = _event_records(views.table(spark, sf, "events"))
    shuffled = e.withColumn("_part", F.pmod(F.xxhash64("seq"), F.lit(8))).repartition(8, "_part")
    shuffled.drop("_part").write.parquet(f"{base}/in")
    shuffled.where("_part < 3").drop("_part").write.mode("append").parquet(f"{base}/in")
    table = commits.Table(schema, store.KEYS, 8, order="seq")
    commits.create(spark, f"{base}/store", {"records": table})
    first = e.where("seq % 10 = 0")                      # what the store held before
    commits.load(spark, f"{base}/store", {"records": dedup.last_wins(first, store.KEYS, "seq")})
    arriving = upserts.observation_stream(spark, f"{base}/in", schema, files_per_trigger=4)
    upserts.stream_commits(arriving, f"{base}/store", "records", f"{base}/checkpoint",
                           "events").awaitTermination()
    snap = commits.snapshot(spark, f"{base}/store")
    return commits.read(spark, snap, "records").drop("updated_at", "seq")


# --- review -----------------------------------------------------------------------------------

@query("review_rows", sql("records", "status", body="""
    SELECT entity, r.tenant, r.record_key, data, coalesce(s.status, 'pending') AS status
    FROM records r LEFT JOIN status s ON s.tenant = r.tenant AND s.record_key = r.record_key
         AND s.source_table = 'raw_' || entity
    WHERE tier = 'raw'"""))
def _(spark, sf):
    return review.review_rows(views.records(spark, sf), views.review_status(spark, sf)).select(
        "entity", "tenant", "record_key", "data", "status")


@query("list_with_status", sql("records", "status", body="""
    SELECT tier, entity, r.tenant, r.record_key, s.status
    FROM records r LEFT JOIN status s ON s.tenant = r.tenant AND s.record_key = r.record_key
         AND s.source_table = 'raw_' || entity
    WHERE tier = 'raw'"""))
def _(spark, sf):
    return review.list_with_status(views.records(spark, sf), views.review_status(spark, sf)).select(
        "tier", "entity", "tenant", "record_key", "status")


def _decisions(spark, sf):
    """Customers decide on address records and on things that do not exist."""
    c = views.table(spark, sf, "customer")
    key = F.concat("c_mktsegment", F.lit("-"), F.floor(C("c_acctbal") / 1000).cast("string"))
    return c.select(
        F.when(C("c_nationkey") == 3, "passwords").otherwise("emails").alias("entity"),
        F.concat(F.lit("src"), C("c_nationkey").cast("string")).alias("tenant"),
        F.when(C("c_acctbal") < 1000, F.concat(key, F.lit("?"))).otherwise(key)
        .alias("record_key"),
        F.when(C("c_mktsegment") == "BUILDING", F.concat(
            F.lit('{"edited":'), C("c_custkey").cast("string"), F.lit("}"))).alias("edited_data"),
        C("c_custkey").alias("seq"))


DECISIONS = """
    decisions AS (
        SELECT CASE WHEN c_nationkey = 3 THEN 'passwords' ELSE 'emails' END AS entity,
               'src' || c_nationkey AS tenant,
               c_mktsegment || '-' || floor(c_acctbal / 1000)::INT
                   || CASE WHEN c_acctbal < 1000 THEN '?' ELSE '' END AS record_key,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '{"edited":' || c_custkey || '}' END AS edited_data,
               c_custkey AS seq FROM customer)"""


@query("known_decisions", f"""
    WITH {DECISIONS} SELECT entity, tenant, record_key, entity <> 'passwords' AS known FROM decisions""")
def _(spark, sf):
    good, bad = review.known_decisions(_decisions(spark, sf))
    return good.withColumn("known", F.lit(True)).unionByName(
        bad.withColumn("known", F.lit(False))).select("entity", "tenant", "record_key", "known")


RESOLVED = DECISIONS + """,
    resolved AS (
        SELECT d.*, coalesce(edited_data, r.data) AS data
        FROM decisions d LEFT JOIN records r ON r.tier = 'raw' AND r.entity = d.entity
             AND r.tenant = d.tenant AND r.record_key = d.record_key
        WHERE d.entity <> 'passwords')"""


def _resolved(spark, sf):
    good, _ = review.known_decisions(_decisions(spark, sf))
    return review.resolve_approvals(views.records(spark, sf), good)


@query("resolve_approvals", sql("records", body=f"""
    WITH {RESOLVED}
    SELECT entity, tenant, record_key, seq, data, data IS NOT NULL AS ok FROM resolved"""))
def _(spark, sf):
    return _resolved(spark, sf).select("entity", "tenant", "record_key", "seq", "data", "ok")


@query("approve", sql("records", body=f"""
    WITH {RESOLVED}
    SELECT tier, entity, tenant, record_key, data FROM records
    UNION ALL
    SELECT 'reviewed', 'emails', tenant, record_key, arg_max(data, seq) FROM resolved
    WHERE data IS NOT NULL GROUP BY tenant, record_key"""))
def _(spark, sf):
    return review.approve(views.records(spark, sf), _resolved(spark, sf), _now()).drop("updated_at")


@query("decide", sql("status", body=f"""
    WITH {DECISIONS},
    r AS (SELECT DISTINCT tenant, record_key FROM decisions WHERE entity <> 'passwords'),
    d AS (SELECT source AS tenant, lang || '-' || (n_chars // 100) AS record_key
          FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
    SELECT * FROM status WHERE (tenant, record_key) NOT IN (SELECT (tenant, record_key) FROM d)
    UNION ALL SELECT DISTINCT 'raw_documents', tenant, record_key, 'rejected' FROM d
    UNION ALL SELECT 'raw_emails', tenant, record_key, 'rejected' FROM r"""))
def _(spark, sf):
    good, _ = review.known_decisions(_decisions(spark, sf))
    docs = views.docs(spark, sf).where("toxic = 1").select(
        F.lit("documents").alias("entity"), "tenant",
        F.concat("lang", F.lit("-"), F.expr("n_chars div 100").cast("string")).alias("record_key"),
        F.lit(None).cast("string").alias("edited_data"), "seq")
    return review.decide(views.review_status(spark, sf), good.unionByName(docs), "rejected",
                         _now()).drop("reviewed_at")


def _stored(spark, sf, name):
    """A store that holds the records and statuses; creating it again changes nothing."""
    path = _folder(spark, name)
    review.create_store(spark, path, buckets=8)
    commits.load(spark, path, {"records": views.records(spark, sf),
                               "review_status": views.review_status(spark, sf)})
    review.create_store(spark, path, buckets=8)
    return path


@query("create_store", sql("records", "status", body=f"""
    WITH t AS (SELECT unnest([{", ".join(f"'{t} {e}'" for t, e in review.ENTITY_COLUMNS)}]) AS name),
    r AS (SELECT tier || ' ' || entity AS name, count(*) AS n FROM records GROUP BY 1)
    SELECT name, coalesce(n, 0) AS rows FROM t LEFT JOIN r USING (name)
    UNION ALL SELECT 'review_status', count(*) FROM status"""))
def _(spark, sf):
    snap = commits.snapshot(spark, _stored(spark, sf, "create_store"))
    found = commits.read(spark, snap, "records").groupBy(
        F.concat_ws(" ", "tier", "entity").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    every = spark.createDataFrame([(f"{t} {e}",) for t, e in review.ENTITY_COLUMNS], "name string")
    return every.join(found, "name", "left").fillna(0).unionByName(
        commits.read(spark, snap, "review_status").agg(
            F.lit("review_status").alias("name"), F.count(F.lit(1)).alias("rows")))


def _rejections(spark, sf):
    return views.docs(spark, sf).where("toxic = 1").select(
        F.lit("documents").alias("entity"), "tenant",
        F.concat("lang", F.lit("-"), F.expr("n_chars div 100").cast("string")).alias("record_key"),
        F.lit(None).cast("string").alias("edited_data"), "seq")


AFTER_DECISIONS = RESOLVED + """,
    copies AS (
        SELECT tenant, record_key, arg_max(data, seq) AS data FROM resolved WHERE data IS NOT NULL
        GROUP BY 1, 2),
    gone AS (SELECT source AS tenant, lang || '-' || (n_chars // 100) AS record_key
             FROM documents JOIN labels USING (doc_id) WHERE toxic = 1),
    after AS (
        SELECT 'records' AS place, tier || ' ' || entity AS kind, tenant, record_key, data FROM records
        UNION ALL SELECT 'records', 'reviewed emails', * FROM copies
        UNION ALL SELECT 'status', 'raw_emails', tenant, record_key, 'approved' FROM copies
        UNION ALL SELECT DISTINCT 'status', 'raw_documents', tenant, record_key, 'rejected' FROM gone
        UNION ALL SELECT 'status', source_table, tenant, record_key, status FROM status
                  WHERE (tenant, record_key) NOT IN (SELECT (tenant, record_key) FROM gone))"""


def _decided(spark, sf, name):
    path = _stored(spark, sf, name)
    for _ in range(2):                                   # the second time does nothing
        review.approve_in_store(spark, path, _decisions(spark, sf), _now(), writer="people",
                                number=1)
        review.reject_in_store(spark, path, _rejections(spark, sf), _now(), writer="people",
                               number=2)
    return path


def _both_tables(spark, snap):
    records, status = (commits.read(spark, snap, n) for n in ("records", "review_status"))
    return records.select(
        F.lit("records").alias("place"), F.concat_ws(" ", "tier", "entity").alias("kind"), "tenant",
        "record_key", "data").unionByName(status.select(
            F.lit("status").alias("place"), C("source_table").alias("kind"), "tenant", "record_key",
            C("status").alias("data")))


@query("approve_commit", sql("records", "status", body=f"WITH {AFTER_DECISIONS} SELECT * FROM after"))
def _(spark, sf):
    path = _decided(spark, sf, "approve_commit")
    return _both_tables(spark, commits.snapshot(spark, path))


@query("snapshot_reads", sql("records", "status", body=f"""
    WITH {AFTER_DECISIONS},
    before AS (
        SELECT 'records' AS place, tier || ' ' || entity AS kind, tenant FROM records
        UNION ALL SELECT 'status', source_table, tenant FROM status)
    SELECT 'before' AS at, place, kind, tenant, count(*) AS rows FROM before GROUP BY ALL
    UNION ALL SELECT 'approved', place, kind, tenant, count(*) FROM (
        SELECT place, kind, tenant FROM before
        UNION ALL SELECT 'records', 'reviewed emails', tenant FROM copies
        UNION ALL SELECT 'status', 'raw_emails', tenant FROM copies) GROUP BY ALL
    UNION ALL SELECT 'last', place, kind, tenant, count(*) FROM after GROUP BY ALL"""))
def _(spark, sf):
    """What readers of three versions see after all commits and a compaction."""
    path = _decided(spark, sf, "snapshot_reads")
    commits.compact(spark, path)
    out = None
    for at, version in (("before", 1), ("approved", 2), ("last", None)):
        rows = _both_tables(spark, commits.snapshot(spark, path, version)).groupBy(
            F.lit(at).alias("at"), "place", "kind", "tenant").agg(F.count(F.lit(1)).alias("rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("set_path", """
    SELECT o_orderkey, o_totalprice + 1 AS number, o_orderstatus = 'O' AS flag,
           o_custkey || 'x' AS second_name, 'b' AS first_name, o_orderpriority AS tags
    FROM orders""")
def _(spark, sf):
    o = views.table(spark, sf, "orders")
    rec = F.struct(
        F.struct(F.lit(0.0).alias("score"), F.lit(False).alias("ok")).alias("meta"),
        F.array(F.struct(F.lit("b").alias("name")), F.struct(F.lit("c").alias("name")))
        .alias("items"),
        F.array(F.lit("old")).alias("tags"))
    price = (C("o_totalprice") + 1).cast("string")
    rec = review.set_path(rec, "meta.score", review.edited_value(price, "number"))
    rec = review.set_path(rec, "meta.ok", review.edited_value(
        F.when(C("o_orderstatus") == "O", "true").otherwise("no"), "boolean"))
    rec = review.set_path(rec, "items[1].name", F.concat(C("o_custkey").cast("string"), F.lit("x")))
    rec = review.set_path(rec, "tags", review.edited_value(
        F.concat(F.lit(" "), C("o_orderpriority"), F.lit(" , ,")), "list"))
    r = o.select("o_orderkey", rec.alias("r"))
    return r.select(
        "o_orderkey", C("r.meta.score").alias("number"), C("r.meta.ok").alias("flag"),
        F.get("r.items", F.lit(1))["name"].alias("second_name"),
        F.get("r.items", F.lit(0))["name"].alias("first_name"),
        F.array_join("r.tags", ",").alias("tags"))


# kind of edit: path, type of the field, value; then the record's text after it, and the note
EDITS = [
    ("meta.score", "number", "{n}.50", """{"items":[{"name":"b"},{"name":"c"}],"meta":{"ok":false,"score":{n}.5},"tags":["old"]}"""),
    ("meta.ok", "boolean", "true", """{"items":[{"name":"b"},{"name":"c"}],"meta":{"ok":true,"score":0},"tags":["old"]}"""),
    ("items[1].name", "text", "x{n}", """{"items":[{"name":"b"},{"name":"x{n}"}],"meta":{"ok":false,"score":0},"tags":["old"]}"""),
    ("items[3].note.by", "text", "x{n}", """{"items":[{"name":"b"},{"name":"c"},null,{"note":{"by":"x{n}"}}],"meta":{"ok":false,"score":0},"tags":["old"]}"""),
    ("tags", "array-primitive", " x{n} , ,y", """{"items":[{"name":"b"},{"name":"c"}],"meta":{"ok":false,"score":0},"tags":["x{n}","y"]}"""),
    ("new.parents.here", "number", "{n}", """{"items":[{"name":"b"},{"name":"c"}],"meta":{"ok":false,"score":0},"new":{"parents":{"here":{n}}},"tags":["old"]}"""),
    ("meta.score.inner", "text", "x{n}", """{"items":[{"name":"b"},{"name":"c"}],"meta":{"ok":false,"score":0},"tags":["old"]}"""),
]
EDITED = " ".join(f"WHEN {i} THEN '{after}'" for i, (*_, after) in enumerate(EDITS))


@query("edit_records", f"""
    SELECT o_orderkey, replace(CASE o_orderkey % 7 {EDITED} END, '{{n}}', o_custkey::VARCHAR) AS data,
           CASE WHEN o_orderkey % 7 = 6 THEN 'a path leads through a value' END AS edit_problem
    FROM orders""")
def _(spark, sf):
    """Every order is a record, and its own row tells which place of it is edited, and how."""
    o = views.table(spark, sf, "orders")
    kind, n = (C("o_orderkey") % 7).cast("int"), C("o_custkey").cast("string")
    texts = [F.get(F.array(*[F.lit(e[i]) for e in EDITS]), kind) for i in range(3)]
    rows = o.select("o_orderkey", F.lit(1).alias("seq"), texts[0].alias("path"),
                    texts[1].alias("data_type"), F.replace(texts[2], F.lit("{n}"), n).alias("value"))
    records = o.select("o_orderkey", F.lit(
        '{"tags": ["old"], "meta": {"score": 0, "ok": false}, "items": [{"name": "b"}, {"name": "c"}]}')
        .alias("data"))
    after = edits.apply_edits(records, rows, ["o_orderkey"])
    return after.withColumn("data", variants.canonical(C("data")))


# --- tenants ----------------------------------------------------------------------------------

SUMMARY_COLUMNS = ", ".join(
    f"count(*) FILTER (tier = '{t}' AND entity = '{e}') AS {t}_{e}" for t, e in review.ENTITY_COLUMNS)


@query("tenant_summary", sql("records", body=f"""
    SELECT tenant, {SUMMARY_COLUMNS}, count(*) FILTER (tier = 'raw') AS total_raw,
           count(*) FILTER (tier = 'reviewed') AS total_reviewed
    FROM records GROUP BY tenant HAVING count(*) FILTER (tier = 'raw') > 0"""))
def _(spark, sf):
    return review.tenant_summary(views.records(spark, sf))


@query("merge_collisions", sql("records", body="""
    SELECT tier, entity, record_key FROM records s WHERE tenant = 'src1' AND EXISTS (
        SELECT 1 FROM records t WHERE t.tenant = 'src2' AND t.tier = s.tier AND t.entity = s.entity
        AND t.record_key = s.record_key)"""))
def _(spark, sf):
    return review.merge_collisions(views.records(spark, sf), "src1", "src2")


@query("preview_merge", sql("records", body="""
    SELECT s.tier, s.entity, count(s.record_key) AS would_move, count(t.record_key) AS collisions,
           count(s.record_key) - count(t.record_key) AS moving
    FROM (SELECT DISTINCT tier, entity, record_key FROM records WHERE tenant IN ('src1', 'src2')) k
    LEFT JOIN (SELECT * FROM records WHERE tenant = 'src1') s USING (tier, entity, record_key)
    LEFT JOIN (SELECT * FROM records WHERE tenant = 'src2') t ON t.tier = s.tier
         AND t.entity = s.entity AND t.record_key = s.record_key
    WHERE s.tier IS NOT NULL GROUP BY s.tier, s.entity"""))
def _(spark, sf):
    return review.preview_merge(views.records(spark, sf), "src1", "src2")


@query("merge_breakdown", sql("records", body=f"""
    WITH t AS (SELECT unnest([{", ".join(f"'{t} {e}'" for t, e in review.ENTITY_COLUMNS)}]) AS name),
    s AS (SELECT tier || ' ' || entity AS name, record_key FROM records WHERE tenant = 'src1'),
    o AS (SELECT tier || ' ' || entity AS name, record_key FROM records WHERE tenant = 'src2'),
    n AS (SELECT s.name, count(*) AS would_move, count(o.name) AS collisions
          FROM s LEFT JOIN o ON o.name = s.name AND o.record_key = s.record_key GROUP BY 1)
    SELECT split_part(name, ' ', 1) AS tier, split_part(name, ' ', 2) AS entity,
           coalesce(would_move, 0) AS would_move, coalesce(collisions, 0) AS collisions,
           coalesce(would_move - collisions, 0) AS moving
    FROM t LEFT JOIN n USING (name)"""))
def _(spark, sf):
    return review.merge_breakdown(views.records(spark, sf), "src1", "src2")


MERGED_TENANTS = """
    taken AS (SELECT DISTINCT tier, entity, record_key, TRUE AS yes FROM records WHERE tenant = 'src2'),
    after AS (
        SELECT s.tier, s.entity, CASE WHEN s.tenant = 'src1' AND t.yes IS NULL THEN 'src2'
                                      ELSE s.tenant END AS tenant, s.record_key, s.data
        FROM records s LEFT JOIN taken t ON t.tier = s.tier AND t.entity = s.entity
             AND t.record_key = s.record_key)"""


@query("execute_merge", sql("records", body=f"WITH {MERGED_TENANTS} SELECT * FROM after"))
def _(spark, sf):
    return review.execute_merge(views.records(spark, sf), "src1", "src2").drop("updated_at")


@query("merge_commit", sql("records", body=f"WITH {MERGED_TENANTS} SELECT * FROM after"))
def _(spark, sf):
    path = _stored(spark, sf, "merge_commit")
    for _ in range(2):
        review.merge_in_store(spark, path, "src1", "src2", writer="merge", number=1)
    return commits.read(spark, commits.snapshot(spark, path), "records").drop("updated_at")


@query("move_status", sql("status", body="""
    SELECT source_table, CASE WHEN tenant = 'src1' AND record_key NOT IN
               (SELECT record_key FROM status WHERE tenant = 'src2') THEN 'src2' ELSE tenant END AS tenant,
           record_key, status
    FROM status"""))
def _(spark, sf):
    return review.move_status(views.review_status(spark, sf), "src1", "src2").drop("reviewed_at")


# --- run reports ------------------------------------------------------------------------------

@query("run_counts", sql("hosts", "addr", "docs", body=f"""
    WITH {QA.MERGED}, {QP.ITEMS}, {QE.HEADS},
    ed AS (SELECT tenant, {QA.DOMAIN} AS domain, bool_or(validation_status = 'smtp_inconclusive_catchall'
                  OR is_catch_all) AS ca FROM merged GROUP BY 1, 2),
    c AS (
        SELECT tenant, 'Domains' AS measure, count(DISTINCT host) AS value FROM hosts GROUP BY 1
        UNION ALL SELECT tenant, 'Emails', count(*) FROM merged GROUP BY 1
        UNION ALL SELECT tenant, 'deliverable', count(*) FILTER (validation_status = 'deliverable')
                  FROM merged GROUP BY 1
        UNION ALL SELECT tenant, 'catch-all domains', count(*) FILTER (ca) FROM ed GROUP BY 1
        UNION ALL SELECT tenant, 'Documents', count(*) FROM docs GROUP BY 1
        UNION ALL SELECT tenant, 'found on disk', count(*) FILTER (labelled) FROM docs GROUP BY 1
        UNION ALL SELECT tenant, 'content verified', count(*) FILTER (content_verified) FROM docs GROUP BY 1
        UNION ALL SELECT tenant, 'Employees', count(*) FROM tiered GROUP BY 1
        UNION ALL SELECT tenant, x, count(*) FILTER (tier = x) FROM tiered,
                  (SELECT unnest(['leadership', 'current_employee', 'intern', 'former_employee', 'reject']) AS x)
                  GROUP BY 1, 2
        UNION ALL SELECT 't', 'Dark web targets scanned', count(*) FROM h
        UNION ALL SELECT 't', 'with mentions found', count(*) FILTER (n > 0) FROM h
        UNION ALL SELECT 't', 'Breach records', count(DISTINCT user_id) FROM events
        UNION ALL SELECT tenant, 'Infrastructure raw targets', count(*) FROM hosts GROUP BY 1
        UNION ALL SELECT tenant, 'DNS infra raw targets', count(*) FROM hosts WHERE scheme = 'https' GROUP BY 1)
    SELECT * FROM c"""))
def _(spark, sf):
    merged = written(QA._merged(spark, sf).select("tenant", "email", "validation_status", "is_catch_all"),
                     "merged")
    h = views.hosts(spark, sf)
    return report.run_counts({
        "domains": QH._domain_table(spark, sf),
        "emails": merged,
        "email_domains": dedup.summarize_address_domains(merged),
        "documents": views.docs(spark, sf).withColumnRenamed("labelled", "file_exists"),
        "employees": QP.classify.classify(QP._named(spark, sf)),
        "breaches": dedup.merge_exposures(QE._exposures(spark, sf))[0],
        "darkweb": QE._counted(spark, sf),
        "infrastructure_raw": h,
        "dns_infra_raw": h.where("scheme = 'https'"),
    })


def _shaped(spark, sf, filtered=None, counted=None):
    filtered = QA._filtered(spark, sf) if filtered is None else filtered
    domains = QH._domain_table(spark, sf).withColumn("keep", ~F.array_contains("sources", "fr")) \
        .withColumn("tier", F.element_at("sources", 1))
    infrastructure = verdicts.attach_verdicts(
        QH._infrastructure(spark, sf), QH._host_verdicts(spark, sf), "domain", ["note"])
    return verdicts.output_shape(
        {"domains": domains, "emails": filtered,
         "employees": QP._judged(spark, sf), "breaches": QE._judged_exposures(spark, sf),
         "darkweb": QE._judged_mentions(spark, sf, counted), "infrastructure": infrastructure},
        {"domains": "domain", "emails": "email", "employees": "identifier", "breaches": "email",
         "darkweb": "target_key", "infrastructure": "domain"})


SHAPED = f"""{QA.MERGED}, {QA.TIERED}, {QA.FILTERED}, {QH.DOMAIN_TABLE},
    bv AS (SELECT user_id, arg_max(value, event_id) AS value FROM events WHERE event_type = 'error' GROUP BY 1),
    shaped AS (
        SELECT tenant, 'domains' AS category, domain AS identifier, NOT list_contains(sources, 'fr') AS keep,
               NULL AS note, sources[1] AS tier FROM domain_table
        UNION ALL SELECT tenant, 'emails', email, keep, note, tier FROM filtered
        UNION ALL SELECT DISTINCT 't', 'breaches', 'u' || user_id || '@x.example.com',
               coalesce(bv.value < 20, true),
               CASE WHEN bv.user_id IS NULL THEN 'not_evaluated_by_model_fail_open' END, NULL
        FROM events LEFT JOIN bv USING (user_id)
        UNION ALL SELECT * FROM (WITH {QP.ITEMS}, {QP.JUDGED}
            SELECT tenant, 'employees', identifier, keep, note, tier FROM judged)
        UNION ALL SELECT * FROM (WITH {QE.JUDGED}
            SELECT 't', 'darkweb', target || '||' || target_type, keep, note, NULL FROM j)
        UNION ALL SELECT * FROM (WITH {QH.HOST_VERDICTS}
            SELECT i.tenant, 'infrastructure', i.domain, coalesce(keep, true),
                   coalesce(note, 'not_evaluated_by_model_fail_open'), NULL
            FROM (SELECT DISTINCT tenant, host AS domain FROM hosts) i
            LEFT JOIN hv USING (tenant, domain)))"""


@query("output_shape", sql("hosts", "addr", body=f"WITH {SHAPED} SELECT * FROM shaped"))
def _(spark, sf):
    return _shaped(spark, sf)


STATS = """
    stats AS (
        SELECT tenant, category || '_kept' AS measure, count(*) FILTER (keep) AS value FROM shaped
        GROUP BY tenant, category
        UNION ALL SELECT tenant, category || '_excluded', count(*) FILTER (NOT keep) FROM shaped
        GROUP BY tenant, category)"""


@query("filter_stats", sql("hosts", "addr", body=f"WITH {SHAPED}, {STATS} SELECT * FROM stats"))
def _(spark, sf):
    return report.filter_stats(_shaped(spark, sf))


# --- scoring ----------------------------------------------------------------------------------

def keep_by_price(batch):
    """A scorer for the test: verdicts from the price; a batch with a dear row fails as a whole."""
    import pandas as pd

    if batch["price"].max() > 440000:
        raise ValueError("too dear")
    return pd.DataFrame({
        "identifier": batch["record"], "keep": batch["price"] > 150000,
        "tier": None, "note": "scored", "seq": batch["seq"]})


def _batched(spark, sf):
    """Orders in batches of neighbouring keys, and how they are scored."""
    records = views.table(spark, sf, "orders").select(
        C("o_orderkey").alias("seq"), F.concat(F.lit("o"), C("o_orderkey").cast("string")).alias("record"),
        C("o_totalprice").alias("price"), C("o_orderstatus").alias("tenant"),
        F.expr("o_orderkey div 64").alias("batch"))
    return (records, keep_by_price,
            "identifier string, keep boolean, tier string, note string, seq bigint",
            ["seq", "record", "price"], ["tenant", "batch"])


def _scored(spark, sf):
    """(records, verdicts, failed batches)."""
    given = _batched(spark, sf)
    return given[0], *verdicts.score_batches(*given)


BATCHES = """
    batches AS (
        SELECT o_orderstatus AS tenant, o_orderkey // 64 AS batch, max(o_totalprice) > 440000 AS failed,
               count(*) AS n FROM orders GROUP BY 1, 2)"""


@query("score", f"""
    WITH {BATCHES}
    SELECT 'o' || o_orderkey AS record, failed OR o_totalprice > 150000 AS keep,
           CASE WHEN failed THEN 'not_evaluated_by_model_fail_open' ELSE 'scored' END AS note
    FROM orders JOIN batches ON tenant = o_orderstatus AND batch = o_orderkey // 64""")
def _(spark, sf):
    records, scores, _ = _scored(spark, sf)
    return verdicts.attach_verdicts(records, scores, "record").select("record", "keep", "note")


BATCH_WARNINGS = BATCHES + """,
    batch_warned AS (
        SELECT tenant, 'emails' AS category, NULL AS identifier,
               '[emails] Batch ' || batch || ' failed (too dear): keeping ' || n
                   || ' record(s) unfiltered' AS warning
        FROM batches WHERE failed)"""


@query("failed_batches", f"WITH {BATCH_WARNINGS} SELECT * FROM batch_warned")
def _(spark, sf):
    return verdicts.failed_batch_warnings(_scored(spark, sf)[2], "emails", "batch")


# --- warnings and the audit log ---------------------------------------------------------------

def _all_verdicts(spark, sf, addresses=None):
    """(tenant, category, identifier) of every verdict of a run but those on documents."""
    addresses = QA._verdicts(spark, sf) if addresses is None else addresses
    hosts = QH._host_verdicts(spark, sf)
    out = None
    for category, given in (("domains", hosts), ("infrastructure", hosts),
                            ("emails", addresses), ("employees", QP._verdicts(spark, sf)),
                            ("breaches", QE._exposure_verdicts(spark, sf)),
                            ("darkweb", QE._mention_verdicts(spark, sf))):
        rows = given.select("tenant", F.lit(category).alias("category"), "identifier")
        out = rows if out is None else out.unionByName(rows)
    return out


GROUNDED = """
    own AS (
        SELECT tenant, unnest(['domains', 'infrastructure']) AS category, upper(host) AS identifier
        FROM hosts WHERE lang <> 'es'
        UNION ALL SELECT DISTINCT tenant, 'emails', upper(email) FROM addr
                  WHERE o_orderpriority <> '4-NOT SPECIFIED'
        UNION ALL SELECT lower(c_mktsegment), 'employees', 'p-' || o_custkey
                  FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority <> '2-HIGH'
        UNION ALL SELECT DISTINCT 't', 'breaches', 'u' || user_id || '@X.example.com' FROM events
                  WHERE event_type = 'error'
        UNION ALL SELECT DISTINCT 't', 'darkweb', 'U' || user_id || '||view' FROM events
                  WHERE event_type = 'view'),
    given AS (SELECT * FROM own UNION ALL SELECT 'elsewhere', category, identifier FROM own),
    known AS (SELECT DISTINCT tenant, category, lower(identifier) AS id, TRUE AS yes FROM shaped),
    grounded AS (
        SELECT g.tenant, g.category, g.identifier, 'identifier not present in input' AS warning
        FROM given g LEFT JOIN known k ON k.tenant = g.tenant AND k.category = g.category
             AND k.id = lower(g.identifier)
        WHERE yes IS NULL)"""


def _inputs(spark, sf):
    """(tenant, category, identifier) of every record that a run judges, but documents."""
    return verdicts.input_identifiers(
        {"domains": QH._domain_table(spark, sf), "emails": QA._merged(spark, sf),
         "employees": QP._people(spark, sf),
         "breaches": dedup.merge_exposures(QE._exposures(spark, sf))[0],
         "darkweb": dedup.merge_mentions(QE._mentions(spark, sf))[0],
         "infrastructure": QH._infrastructure(spark, sf)},
        {"domains": C("domain"), "emails": C("email"), "employees": verdicts.person_identifier(),
         "breaches": C("email"), "darkweb": verdicts.target_key(), "infrastructure": C("domain")})


def _addresses(spark, sf):
    """(verdicts on addresses, judged addresses), written: the log reads both more than once."""
    observed = QA._observed(spark, sf)
    given = written(QA._verdicts(spark, sf, observed), "address-verdicts")
    return given, written(QA._filtered(spark, sf, given, observed), "filtered")


def _run(spark, sf, counted=None):
    """What a filter run leaves: what is read more than once here is made once and written.

    ``outcome`` and ``warnings`` are not written: the audit log reads each of them once.
    """
    addresses, filtered = _addresses(spark, sf)
    shaped = written(_shaped(spark, sf, filtered, counted), "shaped")
    outcome = QD._outcome(spark, sf).select("tenant", "filename", "error", "summary")
    documents = verdicts.verdict_warnings(
        QD._verdict_rows(spark, sf), QD._doc_records(spark, sf), "record", "documents").drop("seq")
    warned = documents.unionByName(verdicts.address_warnings(filtered)).unionByName(
        verdicts.grounding_warnings(_all_verdicts(spark, sf, addresses), shaped)).unionByName(
        verdicts.failed_batch_warnings(
            verdicts.failed_batches(*_batched(spark, sf)), "emails", "batch"))
    return {"shaped": shaped, "outcome": outcome, "warnings": warned}


@query("grounding_warnings", sql("hosts", "addr", body=f"WITH {SHAPED}, {GROUNDED} SELECT * FROM grounded"))
def _(spark, sf):
    return verdicts.grounding_warnings(_all_verdicts(spark, sf), _inputs(spark, sf))


def _audit(spark, sf):
    run = _run(spark, sf)
    return report.audit_log(run["shaped"], run["outcome"], run["warnings"])


def _labels(spark, sf):
    """The log as its counts need it: no reasons (so people meet no verdicts), and of warnings their tenants."""
    addresses, filtered = _addresses(spark, sf)
    shaped = written(_shaped(spark, sf, filtered).select("tenant", "category", "identifier", "keep"), "shaped")
    documents = verdicts.verdict_warnings(
        QD._verdict_rows(spark, sf), QD._doc_records(spark, sf), "record", "documents")
    warned = verdicts.ungrounded_tenants(_all_verdicts(spark, sf, addresses), shaped)
    for rows in (documents, filtered.where(F.size("warnings") > 0),
                 verdicts.failed_batches(*_batched(spark, sf))):
        warned = warned.unionByName(rows.select("tenant"))
    return report.audit_labels(shaped, QD._outcome(spark, sf).select("tenant", "error"), warned)


AUDIT = f"""{SHAPED}, {QD.OUTCOME}, {QD.WARNED}, {GROUNDED}, {BATCH_WARNINGS},
    correction AS (
        SELECT tenant, email AS identifier, unnest([{QA.TIER_WARNING}, {QA.CATCH_ALL_WARNING},
            CASE WHEN guess THEN '[emails] ' || {QA.RECONCILED} || ' (' || email || ')' END]) AS w
        FROM corrected),
    audit AS (
        SELECT tenant, CASE category WHEN 'domains' THEN 'Domains excluded' WHEN 'emails' THEN 'Emails excluded'
                   WHEN 'employees' THEN 'Employees excluded' WHEN 'darkweb' THEN 'Dark web targets excluded'
                   ELSE 'Breach records excluded' END AS label, identifier,
               coalesce(note, tier, '-') AS reason
        FROM shaped WHERE NOT keep AND category <> 'infrastructure'
        UNION ALL SELECT tenant, 'Documents not usable', filename, error FROM outcome WHERE error <> ''
        UNION ALL SELECT tenant, 'Pipeline Warnings', identifier, warning FROM warned
        UNION ALL SELECT tenant, 'Pipeline Warnings', identifier, warning FROM grounded
        UNION ALL SELECT tenant, 'Pipeline Warnings', identifier, warning FROM batch_warned
        UNION ALL SELECT tenant, 'Pipeline Warnings', identifier, w FROM correction WHERE w IS NOT NULL)"""


MEASURES = f"""{AUDIT},
    hit AS (
        SELECT tenant, category || CASE WHEN keep THEN '_kept' ELSE '_excluded' END AS m FROM shaped
        UNION ALL SELECT 't', 'darkweb_with_mentions' FROM (WITH {QE.HEADS} SELECT n FROM h) WHERE n > 0
        UNION ALL SELECT tenant, 'documents_summarized' FROM outcome WHERE summary <> ''
        UNION ALL SELECT tenant, 'documents_errored' FROM outcome WHERE error <> ''
        UNION ALL SELECT tenant, 'warning_count' FROM audit WHERE label = 'Pipeline Warnings'),
    name AS (SELECT unnest(['domains_kept', 'domains_excluded', 'emails_kept', 'emails_excluded',
        'employees_kept', 'employees_excluded', 'breaches_kept', 'breaches_excluded', 'darkweb_kept',
        'darkweb_excluded', 'darkweb_with_mentions', 'infrastructure_kept', 'infrastructure_excluded',
        'documents_summarized', 'documents_errored', 'warning_count']) AS measure),
    measured AS (SELECT tenant, measure, count(*) FILTER (m = measure) AS value FROM hit, name GROUP BY ALL)"""


def _measures(spark, sf):
    counted = written(QE._counted(spark, sf), "targets")
    run = _run(spark, sf, counted)
    return report.filter_measures(run["shaped"], counted, written(run["outcome"], "outcome"), run["warnings"])


@query("filter_measures", sql("hosts", "addr", "docs", body=f"WITH {MEASURES} SELECT * FROM measured"))
def _(spark, sf):
    return _measures(spark, sf)


@query("summary_table", sql("hosts", "addr", "docs", body=f"""
    WITH {MEASURES}
    SELECT tenant, CASE measure WHEN 'domains_kept' THEN 'Domains identified'
               WHEN 'emails_kept' THEN 'Email addresses identified'
               WHEN 'employees_kept' THEN 'Employees / associated individuals identified'
               WHEN 'breaches_kept' THEN 'Accounts with confirmed breach exposure'
               WHEN 'darkweb_with_mentions' THEN 'Dark web targets with mentions found'
               ELSE 'Public documents reviewed' END AS label, value
    FROM measured WHERE measure IN ('domains_kept', 'emails_kept', 'employees_kept', 'breaches_kept',
                                    'darkweb_with_mentions', 'documents_summarized')"""))
def _(spark, sf):
    return report.summary_table(_measures(spark, sf))


@query("audit_log", sql("hosts", "addr", "docs", body=f"WITH {AUDIT} SELECT * FROM audit"))
def _(spark, sf):
    return _audit(spark, sf)


@query("exclusion_counts", sql("hosts", "addr", "docs", body=f"""
    WITH {AUDIT},
    l AS (SELECT unnest(['Domains excluded', 'Emails excluded', 'Employees excluded', 'Breach records excluded',
                         'Dark web targets excluded', 'Documents not usable']) AS measure)
    SELECT tenant, measure, count(*) FILTER (label = measure) AS value FROM audit, l GROUP BY 1, 2"""))
def _(spark, sf):
    return report.exclusion_counts(_labels(spark, sf))
