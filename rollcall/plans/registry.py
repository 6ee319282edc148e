"""Registered queries and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.plans.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Observation tables written as SQL over the given tables (see views.py for the Spark form).
CTES = {
    "hosts": r"""
        SELECT page_id AS seq, url, html,
               regexp_extract(url, 'example\.(com|net|org)', 1) AS tenant,
               regexp_extract(url, '^https?://[^/]*/([a-z]+)/', 1) AS lang,
               regexp_extract(url, '^(https?)://', 1) AS scheme,
               regexp_extract(url, '^https?://([^/?#]*)', 1) AS authority,
               regexp_replace(regexp_extract(lower(url), '^https?://([^/?#]*)', 1), '^www\.', '')
                   AS host
        FROM pages""",
    "persons": r"""
        SELECT c_custkey, lower(c_mktsegment) AS tenant, c_nationkey,
               split_part(p_name, ' ', 1) AS first_name,
               split_part(p_name, ' ', 2) || c_nationkey AS last_name,
               split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) || c_nationkey
                   AS name,
               c_acctbal, p_type, p_brand, c_mktsegment
        FROM customer JOIN part ON p_partkey = c_custkey""",
    "addr": r"""
        SELECT o_orderkey AS seq, tenant, name AS employee, first_name, last_name,
               CASE o_orderpriority
                    WHEN '1-URGENT' THEN 'Info' WHEN '2-HIGH' THEN first_name || '.' || last_name
                    WHEN '3-MEDIUM' THEN first_name || '_' || last_name
                    WHEN '4-NOT SPECIFIED' THEN first_name || last_name
                    ELSE substr(first_name, 1, 1) || last_name END
               || '@' || CASE o_orderpriority WHEN '1-URGENT' THEN 'mail.' ELSE '' END
               || tenant || '.example.'
               || CASE o_orderstatus WHEN 'O' THEN 'com' WHEN 'F' THEN 'net' ELSE 'org' END AS email,
               CASE o_orderpriority
                    WHEN '1-URGENT' THEN 'harvest' WHEN '2-HIGH' THEN 'scan'
                    WHEN '3-MEDIUM' THEN 'Pattern-Generation'
                    WHEN '4-NOT SPECIFIED' THEN 'Manual-Generation'
                    ELSE 'Inferred-Pattern' END AS tag,
               CASE WHEN o_totalprice > 400000 THEN 'risky' WHEN o_orderstatus = 'O' THEN 'deliverable'
                    WHEN o_orderstatus = 'F' THEN 'unknown'
                    ELSE 'smtp_inconclusive_catchall' END AS validation_status,
               CASE WHEN o_orderstatus = 'O' THEN 0.9 WHEN o_totalprice > 250000 THEN 0.5
                    ELSE 0.0 END::DOUBLE AS confidence,
               o_orderstatus = 'P' AS is_catch_all, o_orderstatus, o_orderpriority, o_totalprice,
               c_custkey
        FROM orders JOIN persons ON c_custkey = o_custkey""",
    "lines": r"""
        SELECT event_id, user_id, event_type, value, props,
               CASE event_type
                    WHEN 'signup' THEN '{"type": "EMAILADDR_COMPROMISED", "module": "m", "data": '
                                       || props || '}'
                    WHEN 'purchase' THEN '[{"type": "DARKNET_MENTION_URL", "data": "u' || user_id
                                       || '"}, {"type": "Username", "data": "x"}, 7]'
                    WHEN 'view' THEN '  {"type": "DARKNET_MENTION_CONTENT", "data": "v' || event_id
                                       || '"} '
                    WHEN 'click' THEN 'log: possible Breach on the DarkNet at ' || event_id
                    WHEN 'error' THEN CASE WHEN value > 10 THEN '   '
                         ELSE '{"type": "LEAKSITE_CONTENT", "data": "e' || event_id || '"}' END
               END AS line
        FROM events""",
    "docs": r"""
        SELECT documents.doc_id AS seq, source AS tenant, text, lang, n_chars,
               source || '.example.com' AS source_domain,
               lang || '-' || (n_chars // 100)
                   || CASE lang WHEN 'en' THEN '.pdf' WHEN 'fr' THEN '.docx' WHEN 'de' THEN '.doc'
                      ELSE '.pptx' END AS filename,
               CASE lang WHEN 'en' THEN 'metagoofil' WHEN 'es' THEN 'other' ELSE 'apify-google' END
                   AS discovery_method,
               quality = 1 AS content_verified, quality, toxic,
               labels.doc_id IS NOT NULL AS labelled
        FROM documents LEFT JOIN labels ON labels.doc_id = documents.doc_id""",
    "records": r"""
        SELECT 'raw' AS tier, 'documents' AS entity, source AS tenant,
               lang || '-' || (n_chars // 100) AS record_key,
               '{"doc":' || max(doc_id) || '}' AS data, max(doc_id) AS stamp
        FROM documents GROUP BY ALL
        UNION ALL
        SELECT 'reviewed', 'documents', source, lang || '-' || (n_chars // 100),
               '{"doc":' || max(doc_id) || ',"ok":true}', max(doc_id)
        FROM documents JOIN labels USING (doc_id) WHERE quality = 1
        GROUP BY source, lang || '-' || (n_chars // 100)
        UNION ALL
        SELECT 'raw', 'emails', 'src' || c_nationkey,
               c_mktsegment || '-' || floor(c_acctbal / 1000)::INT,
               '{"email":' || max(c_custkey) || '}', max(c_custkey)
        FROM customer GROUP BY c_nationkey, c_mktsegment, floor(c_acctbal / 1000)
        UNION ALL
        SELECT 'reviewed', 'infrastructure', 'only' || r_regionkey, r_name, '{}', 0 FROM region""",
    "status": r"""
        SELECT 'raw_documents' AS source_table, source AS tenant,
               lang || '-' || (n_chars // 100) AS record_key,
               CASE arg_max(quality, doc_id) WHEN 1 THEN 'approved' ELSE 'rejected' END AS status
        FROM documents JOIN labels USING (doc_id) GROUP BY ALL""",
}
NEEDS = {"addr": ("persons",)}


def sql(*ctes: str, body: str) -> str:
    """SQL over the named observation tables; a body may start with more of its own."""
    wanted: list[str] = []
    for c in ctes:
        wanted += [n for n in NEEDS.get(c, ()) if n not in wanted]
        if c not in wanted:
            wanted.append(c)
    head = ",\n".join(f"{c} AS ({CTES[c]})" for c in wanted)
    body = body.strip()
    if not head:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def query(name: str, oracle: str | None = None):
    """Register a query, with its SQL unless it cannot be said in SQL."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
