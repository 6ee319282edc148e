"""Queries over collected files: large JSON arrays and objects, read by many tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rollcall.plans import views
from rollcall.plans.registry import query
from rollcall.plans.session import checkpoint_dir
from rollcall.sources import artifacts
from rollcall.sources.files import Folder

C = F.col
TRICKY = '"},{ \\[é'


def _files(spark, rows, name, head, tail, tenants):
    """``<root>/<tenant>/<name>.json``, one file each: head, the rows' lines in order, tail."""
    root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    every = rows.select("tenant", F.lit(1).alias("kind"), "seq", "line")
    known = rows.select("tenant").distinct()
    for kind, line in ((0, head), (2, tail)):
        every = every.unionByName(known.select(
            "tenant", F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("seq"),
            F.lit(line).alias("line")))
    every.repartition(tenants, "tenant").sortWithinPartitions("tenant", "kind", "seq").select(
        "tenant", "line").write.partitionBy("tenant").text(f"{root}/written")
    folder = Folder(spark, root)
    for place in folder.names("written"):                     # one file per tenant
        if place.startswith("tenant="):
            part, = [n for n in folder.names(f"written/{place}") if n.startswith("part-")]
            tenant = place.removeprefix("tenant=")
            folder.write(f"{tenant}/.folder", "")
            folder.move(f"written/{place}/{part}", f"{tenant}/{name}.json")
    return root


@query("scan_arrays", """
    WITH o AS (SELECT 't' || o_custkey % 25 AS tenant, * FROM orders)
    SELECT DISTINCT tenant, 0::BIGINT AS seq, NULL AS email, NULL AS employee, NULL AS sources FROM o
    UNION ALL
    SELECT tenant, row_number() OVER (PARTITION BY tenant ORDER BY o_orderkey),
           'o' || o_orderkey || '@x.example', '"},{ \\[é' || o_orderstatus,
           o_orderpriority || '|' || o_orderstatus || '"},{ \\[é'
    FROM o""")
def _(spark, sf):
    """Orders as arrays of candidate addresses, whose texts are full of brackets and quotes."""
    rows = views.table(spark, sf, "orders").select(
        F.concat(F.lit("t"), (C("o_custkey") % 25).cast("string")).alias("tenant"),
        C("o_orderkey").alias("seq"), F.concat(F.lit(","), F.to_json(F.struct(
            F.concat(F.lit("o"), C("o_orderkey").cast("string"), F.lit("@x.example")).alias("email"),
            F.concat(F.lit(TRICKY), "o_orderstatus").alias("employee"),
            F.array("o_orderpriority", F.concat("o_orderstatus", F.lit(TRICKY))).alias("sources"))))
        .alias("line"))
    root = _files(spark, rows, "candidate_emails", "[null", "]", 25)
    return artifacts.scan_array(spark, root, "candidate_emails").withColumn(
        "sources", F.when(C("sources").isNotNull(), F.array_join("sources", "|")))


@query("scan_maps", """
    WITH p AS (SELECT replace(p_brand, '#', '') AS tenant, * FROM part)
    SELECT DISTINCT tenant, 'head' AS domain, 0 AS n, NULL AS subdomain, NULL AS sources FROM p
    UNION ALL
    SELECT tenant, 'p' || p_partkey || '.example', 1 + p_size % 2, p_name || '"},{ \\[é', p_type FROM p""")
def _(spark, sf):
    """Parts as objects of hosts by domain; a key that comes again replaces the one before."""
    host = F.struct(F.concat("p_name", F.lit(TRICKY)).alias("subdomain"),
                    F.array("p_type").alias("sources"))
    hosts = F.when(C("p_size") % 2 == 0, F.array(host)).otherwise(F.array(host, host))
    p = views.table(spark, sf, "part").select(
        F.regexp_replace("p_brand", "#", "").alias("tenant"), C("p_partkey").alias("seq"),
        F.concat(F.lit(',"p'), C("p_partkey").cast("string"), F.lit('.example":')).alias("key"),
        F.to_json(hosts).alias("value"))
    rows = p.select("tenant", "seq", F.concat("key", F.lit("[]"), "key", "value").alias("line"))
    root = _files(spark, rows, "dns_infra", '{"head":[]', "}", 25)
    first = F.get("value", F.lit(0))
    return artifacts.scan_map(spark, root, "dns_infra").select(
        "tenant", "domain", F.size("value").alias("n"), first["subdomain"].alias("subdomain"),
        F.get(first["sources"], F.lit(0)).alias("sources"))
