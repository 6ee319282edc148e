"""Queries of bounded nested records."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators import assemble, compact, dedup
from rollcall.plans import queries_addresses as QA
from rollcall.plans import queries_events as QE
from rollcall.plans import views
from rollcall.plans.registry import query, sql
from rollcall.plans.session import written

C = F.col
PER_RECORD = 7

FOUND = f"""{QE.EXPOSED},
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY email ORDER BY first_seq, first_pos) - 1 AS place,
               CASE WHEN starts_with(element, '"') THEN 'unknown ' || element ELSE 'empty ' END AS shown
        FROM el),
    heads AS (SELECT 'u' || user_id || '@x.example.com' AS email,
                     string_agg(DISTINCT CASE event_type WHEN 'click' THEN 'legacy' ELSE event_type END, ','
                         ORDER BY CASE event_type WHEN 'click' THEN 'legacy' ELSE event_type END) AS services
              FROM events GROUP BY user_id)"""


def _shown(df):
    text = F.transform("findings", lambda f: F.concat_ws(" ", f["kind"], F.coalesce(
        f["data"], F.lit(""))))
    return df.select("tenant", "email", "part", F.array_join("services", ",").alias("services"),
                     F.array_join(text, "; ").alias("findings"))


@query("exposure_records", f"""
    WITH {FOUND},
    parts AS (SELECT email, place // {PER_RECORD} AS part, string_agg(shown, '; ' ORDER BY place) AS findings
              FROM placed GROUP BY 1, 2)
    SELECT 't' AS tenant, email, coalesce(part, 0) AS part, services, coalesce(findings, '') AS findings
    FROM heads LEFT JOIN parts USING (email)""")
def _(spark, sf):
    """All findings of every address, a few per record."""
    heads, elements = dedup.merge_exposures(QE._exposures(spark, sf))
    return _shown(assemble.exposure_records(heads, elements, PER_RECORD))


@query("exposure_records_first", f"""
    WITH {FOUND},
    parts AS (SELECT email, string_agg(shown, '; ' ORDER BY place) AS findings
              FROM placed WHERE place < 5 GROUP BY 1)
    SELECT 't' AS tenant, email, 0 AS part, services, coalesce(findings, '') AS findings
    FROM heads LEFT JOIN parts USING (email)""")
def _(spark, sf):
    """The first five groups of every address, what a scorer is shown."""
    heads, elements = dedup.merge_exposures(QE._exposures(spark, sf))
    return _shown(assemble.exposure_records(heads, elements, 5, True, items=5, details=10))


def _host_sections(spark, sf):
    h = views.hosts(spark, sf)

    def rows(df, value):
        return df.select("tenant", C("host").alias("target_domain"), C("seq").alias("first_seq"),
                         F.lit(0).alias("first_pos"), value.alias("value"))

    issuer = F.struct(F.lit("").alias("friendly_name"), F.concat(F.lit("CN="), "tenant").alias("name"))
    record = F.struct(F.array("host").alias("dns_names"), issuer.alias("issuer"),
                      C("lang").alias("not_before"), C("scheme").alias("not_after"),
                      (C("scheme") == "http").alias("revoked"))
    return {
        "harvester": rows(h, F.to_json(F.struct("url"))),
        "amass_hits": rows(h.where("scheme = 'https'"), F.to_json(F.struct("authority", "lang"))),
        "certificates": rows(h.where("lang <> 'es'"), F.to_json(F.get(
            compact.compact_certificates(F.array(record)), F.lit(0)))),
        "network": rows(h.where("lang = 'en'"), F.to_json(F.struct("host", C("lang").alias("asn")))),
    }


@query("infrastructure_records", sql("hosts", body="""
    WITH e AS (
        SELECT tenant, host, seq, 'harvester' AS section, '{"url":"' || url || '"}' AS value FROM hosts
        UNION ALL SELECT tenant, host, seq, 'amass_hits',
                         '{"authority":"' || authority || '","lang":"' || lang || '"}'
                  FROM hosts WHERE scheme = 'https'
        UNION ALL SELECT tenant, host, seq, 'certificates',
                         '{"dns_names":["' || host || '"],"issuer":"CN=' || tenant || '","not_before":"' || lang
                         || '","not_after":"' || scheme || '","revoked":' || (scheme = 'http') || '}'
                  FROM hosts WHERE lang <> 'es'
        UNION ALL SELECT tenant, host, seq, 'network', '{"host":"' || host || '","asn":"' || lang || '"}'
                  FROM hosts WHERE lang = 'en'),
    p AS (SELECT *, (row_number() OVER (PARTITION BY tenant, host, section ORDER BY seq) - 1) // 3 AS part
          FROM e)
    SELECT tenant, host AS target_domain, part,
           coalesce(string_agg(value, ' ' ORDER BY seq) FILTER (section = 'harvester'), '') AS harvester,
           coalesce(string_agg(value, ' ' ORDER BY seq) FILTER (section = 'amass_hits'), '') AS amass_hits,
           coalesce(string_agg(value, ' ' ORDER BY seq) FILTER (section = 'certificates'), '') AS certificates,
           coalesce(string_agg(value, ' ' ORDER BY seq) FILTER (section = 'network'), '') AS network
    FROM p GROUP BY 1, 2, 3"""))
def _(spark, sf):
    sections = _host_sections(spark, sf)
    out = assemble.infrastructure_records(sections, 3)
    return out.select("tenant", "target_domain", "part",
                      *[F.array_join(n, " ").alias(n) for n in sections])


def _slim_sections(spark, sf):
    def rows(df, seq, value):
        return df.select("tenant", seq.cast("long").alias("first_seq"), F.lit(0).alias("first_pos"),
                         value.alias("value"))

    a = views.addresses(spark, sf).groupBy("tenant", F.lower("email").alias("email")).agg(
        F.min("seq").alias("seq"))
    merged = written(compact.slim_addresses(QA._merged(spark, sf)), "slim-addresses")
    targets = compact.slim_mentions(QE._counted(spark, sf))
    return {
        "domains": rows(views.hosts(spark, sf).groupBy("tenant", "host").agg(
            F.min("seq").alias("seq")), C("seq"), C("host")),
        "emails": rows(merged.join(a, ["tenant", "email"]), C("seq"), F.to_json(F.struct(
            "email", "validation_status"))),
        "documents": rows(views.docs(spark, sf), C("seq"), C("filename")),
        "targets": rows(targets, F.crc32(F.concat("target", "target_type")), F.concat(
            "target", F.lit(" "), "target_type", F.lit(" "), C("mention_count").cast("string"))),
    }


@query("slim_views", sql("hosts", "addr", "docs", body=f"""
    WITH {QA.MERGED}, {QE.HEADS},
    n AS (
        SELECT tenant, 'domains' AS section, count(DISTINCT host) AS n FROM hosts GROUP BY 1
        UNION ALL SELECT tenant, 'emails', count(*) FROM merged GROUP BY 1
        UNION ALL SELECT tenant, 'documents', count(*) FROM docs GROUP BY 1
        UNION ALL SELECT 't', 'targets', count(*) FROM h WHERE n > 0
        UNION ALL SELECT 't', 'breaches', count(DISTINCT user_id) FROM events),
    w AS (
        SELECT tenant, max(CASE section WHEN 'domains' THEN n ELSE 0 END) AS domains,
               max(CASE section WHEN 'emails' THEN n ELSE 0 END) AS emails,
               max(CASE section WHEN 'documents' THEN n ELSE 0 END) AS documents,
               max(CASE section WHEN 'targets' THEN n ELSE 0 END) AS targets,
               max(CASE section WHEN 'breaches' THEN n ELSE 0 END) AS breaches
        FROM n GROUP BY tenant),
    item AS (
        SELECT tenant, 'domains' AS section, host AS value, min(seq) AS seq FROM hosts GROUP BY 1, 2, 3
        UNION ALL SELECT m.tenant, 'emails', '{{"email":"' || m.email || '","validation_status":"'
                         || m.validation_status || '"}}', a.seq
                  FROM merged m JOIN (SELECT tenant, lower(email) AS email, min(seq) AS seq FROM addr
                                      GROUP BY 1, 2) a ON a.tenant = m.tenant AND a.email = m.email
        UNION ALL SELECT tenant, 'documents', filename, seq FROM docs),
    p AS (SELECT *, (row_number() OVER (PARTITION BY tenant, section ORDER BY seq) - 1) // 50 AS part FROM item),
    e AS (SELECT tenant, part,
                 coalesce(string_agg(value, ' ' ORDER BY seq) FILTER (section = 'domains'), '') AS domains,
                 coalesce(string_agg(value, ' ' ORDER BY seq) FILTER (section = 'emails'), '') AS emails,
                 coalesce(string_agg(value, ' ' ORDER BY seq) FILTER (section = 'documents'), '') AS documents
          FROM p GROUP BY 1, 2
          UNION ALL SELECT 't', unnest(range((count(*) + 49) // 50)), '', '', '' FROM h WHERE n > 0)
    SELECT w.tenant, coalesce(part, 0)::INT AS part, coalesce(e.domains, '') AS domains,
           coalesce(e.emails, '') AS emails, coalesce(e.documents, '') AS documents,
           breaches AS breach_count,
           concat_ws(',', w.domains, w.emails, w.documents, w.targets, breaches) AS counts,
           greatest(0, least(50, w.targets - 50 * coalesce(part, 0))) AS n_targets
    FROM w LEFT JOIN e USING (tenant)"""))
def _(spark, sf):
    heads, _ = dedup.merge_exposures(QE._exposures(spark, sf))
    out = assemble.slim_views(_slim_sections(spark, sf), heads, 50)
    shown = [F.array_join(n, " ").alias(n) for n in ("domains", "emails", "documents")]
    return out.select("tenant", "part", *shown, "breach_count", F.concat_ws(
        ",", *[C(f"counts.{n}").cast("string") for n in (
            "domains", "emails", "documents", "targets", "breaches")]).alias("counts"),
        F.size("targets").cast("long").alias("n_targets"))
