"""Queries over host observations (pages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import hosts as H
from rollcall.functions import names as N
from rollcall.operators import compact, dedup, joins, report, verdicts
from rollcall.plans import views
from rollcall.plans.registry import query, sql
from rollcall.sources import eventlines, references

C = F.col
SYNTAX = r"'^([a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,}$'"


def joined(c: str):
    """Arrays are shown as text, so that both engines print them alike."""
    return F.array_join(c, ",").alias(c)


# --- scalar functions -------------------------------------------------------------------------

@query("normalize_host", sql("hosts", body="""
    SELECT seq, host,
           regexp_replace(split_part(split_part(lower(authority), '@', -1), ':', 1), '^www\\.', '') AS bare
    FROM hosts"""))
def _(spark, sf):
    h = views.hosts(spark, sf)
    odd = F.concat(F.lit(" User:pw@"), F.upper("authority"), F.lit(":8443/a?b#c\t"))
    return h.select("seq", "host", H.normalize_host(odd).alias("bare"))


@query("valid_host", sql("hosts", body=f"""
    SELECT seq, regexp_matches(host, {SYNTAX}) AS whole,
           regexp_matches(lang, {SYNTAX}) AS one_label,
           regexp_matches('a_' || host, {SYNTAX}) AS underscore,
           regexp_matches(lang || '-.' || host, {SYNTAX}) AS edge_hyphen
    FROM hosts"""))
def _(spark, sf):
    return views.hosts(spark, sf).select(
        "seq",
        H.valid_host(C("host")).alias("whole"),
        H.valid_host(C("lang")).alias("one_label"),
        H.valid_host(F.concat(F.lit("a_"), "host")).alias("underscore"),
        H.valid_host(F.concat("lang", F.lit("-."), "host")).alias("edge_hyphen"),
    )


@query("subdomain_of", sql("hosts", body=f"""
    WITH found AS (
        SELECT seq, trim(regexp_extract(
                   lower('see *.' || authority || '.evil.org ' || url),
                   '([a-z0-9._-]+\\.example\\.' || tenant || ')', 1), '.') AS s
        FROM hosts)
    SELECT seq, CASE WHEN regexp_matches(s, {SYNTAX}) THEN s END AS subdomain FROM found"""))
def _(spark, sf):
    line = F.concat(F.lit("see *."), F.upper("authority"), F.lit(".evil.org "), "url")
    root = F.concat(F.lit("example."), "tenant")
    return views.hosts(spark, sf).select("seq", H.subdomain_of(line, root).alias("subdomain"))


@query("host_matches_name", sql("hosts", body=r"""
    WITH x AS (
        SELECT *, regexp_replace(lower('Th-' || lang), '[^a-z0-9]', '', 'g') AS plain,
               regexp_replace(split_part(host, '.', 1), '[^a-z0-9]', '', 'g') AS label
        FROM hosts)
    SELECT seq, contains(plain, label) OR contains(label, plain)
                OR contains(host, lang) AS with_abbreviation,
           contains(plain, label) OR contains(label, plain) AS by_name
    FROM x"""))
def _(spark, sf):
    name = F.concat(F.lit("Th-"), F.upper("lang"))
    return views.hosts(spark, sf).select(
        "seq",
        H.host_matches_name(C("host"), name, F.upper("lang")).alias("with_abbreviation"),
        H.host_matches_name(C("host"), name, F.lit("")).alias("by_name"),
    )


@query("denylisted", sql("hosts", body=r"""
    SELECT seq, regexp_matches(replace(host, '.example.', 'x.'), 'x\.com$') AS denied,
           regexp_matches(replace(host, '.example.', 'x.'), '(^|\.)x\.com$') AS denied_at_label
    FROM hosts"""))
def _(spark, sf):
    odd = F.replace("host", F.lit(".example."), F.lit("x."))
    return views.hosts(spark, sf).select(
        "seq", H.denylisted(odd).alias("denied"),
        H.denylisted(odd, label_boundary=True).alias("denied_at_label"),
    )


@query("infrastructure_host", sql("hosts", body=r"""
    SELECT seq, regexp_matches(lower(authority), '^(mail|smtp|mx|webmail|autodiscover|ns|www)\.')
               AS infrastructure
    FROM hosts"""))
def _(spark, sf):
    return views.hosts(spark, sf).select(
        "seq", H.infrastructure_host(F.upper("authority")).alias("infrastructure")
    )


@query("host_keyword", sql("hosts", body="""
    WITH p AS (SELECT seq, string_split('portal.' || lower(authority), '.') AS parts FROM hosts)
    SELECT seq, parts[list_filter(range(1, len(parts) + 1), lambda i:
               i >= len(parts) - 1 OR NOT list_contains(
                   ['www','mail','webmail','smtp','mx','ftp','m','portal','intranet','vpn'],
                   parts[i]))[1]] AS keyword
    FROM p"""))
def _(spark, sf):
    h = F.concat(F.lit("Portal."), "authority")
    return views.hosts(spark, sf).select("seq", H.host_keyword(h).alias("keyword"))


@query("query_from_host", sql("hosts", body="""
    WITH w AS (SELECT seq, string_split(regexp_replace(split_part(host, '.', 1), '[-_]+', ' ', 'g'),
                                        ' ') AS ws FROM hosts)
    SELECT seq, list_aggregate(list_transform(ws, lambda x: upper(x[1]) || x[2:]),
                               'string_agg', ' ') AS search
    FROM w"""))
def _(spark, sf):
    return views.hosts(spark, sf).select("seq", N.query_from_host(C("host")).alias("search"))


# --- filters and gates ------------------------------------------------------------------------

@query("lexical_candidates", sql("hosts", body=r"""
    SELECT DISTINCT tenant, h AS host
    FROM (SELECT tenant, replace(host, '.example.', 'x.') AS h FROM hosts)
    WHERE NOT regexp_matches(h, 'x\.com$')
      AND (contains('th' || tenant, regexp_replace(split_part(h, '.', 1), '[^a-z0-9]', '', 'g'))
           OR contains(regexp_replace(split_part(h, '.', 1), '[^a-z0-9]', '', 'g'), 'th' || tenant)
           OR contains(h, 'ther'))"""))
def _(spark, sf):
    h = views.hosts(spark, sf)
    found = h.select("tenant", F.replace("host", F.lit(".example."), F.lit("x.")).alias("host"))
    orgs = h.select("tenant").distinct().select(
        "tenant", F.concat(F.lit("Th "), "tenant").alias("name"),
        F.lit("THER").alias("abbreviation"),
    )
    return joins.lexical_candidates(found, orgs)


@query("personal_mailbox_domains", sql("hosts", body=r"""
    SELECT DISTINCT tenant, authority AS domain FROM hosts h
    WHERE NOT starts_with(authority, 'www.')
       OR EXISTS (SELECT 1 FROM hosts c WHERE c.scheme = 'https' AND c.tenant = h.tenant
                  AND c.authority = h.authority)"""))
def _(spark, sf):
    h = views.hosts(spark, sf).select("tenant", C("authority").alias("domain"), "scheme")
    return joins.personal_mailbox_domains(
        h.select("tenant", "domain").distinct(), h.where("scheme = 'https'")
    )


@query("valid_targets", sql("hosts", body="""
    SELECT seq, host AS domain FROM hosts WHERE lang IN ('en', 'fr') OR scheme = 'http'"""))
def _(spark, sf):
    status = views.case("lang", {"en": "valid", "fr": ""}, "stale")
    h = views.hosts(spark, sf).select(
        "seq", C("host").alias("domain"),
        F.when((C("scheme") == "https") | (C("lang") == "en"), status)
        .otherwise(F.lit(None)).alias("status"),
        F.when(C("lang") == "fr", "confirmed").otherwise(F.lit(None)).alias("validation_status"),
    )
    return joins.valid_targets(h).select("seq", "domain")


@query("not_refused_targets", sql("hosts", body="""
    SELECT seq, host AS domain FROM hosts WHERE lang = 'en' OR scheme = 'https'"""))
def _(spark, sf):
    h = views.hosts(spark, sf).select(
        "seq", C("host").alias("domain"),
        F.when(C("lang") != "en", C("scheme") == "https").alias("validated"),
    )
    return joins.not_refused_targets(h).select("seq", "domain")


# --- domain tables ----------------------------------------------------------------------------

@query("merge_domains", sql("hosts", body="""
    SELECT tenant, host AS domain,
           list_aggregate(list_sort(list_distinct(list(lang) ||
               coalesce(list(scheme) FILTER (scheme = 'https'), []))), 'string_agg', ',') AS sources,
           bool_or(scheme = 'https') AS dns_validated
    FROM hosts GROUP BY tenant, host"""))
def _(spark, sf):
    h = views.hosts(spark, sf).withColumnRenamed("host", "domain")
    candidates = h.withColumn("sources", F.array("lang"))
    validated = h.where("scheme = 'https'").withColumn("sources", F.array("scheme"))
    out = dedup.merge_domains(candidates, validated)
    return out.select("tenant", "domain", joined("sources"), "dns_validated")


def _tool_finds(h):
    return h.select("tenant", C("url").alias("raw_host"), C("lang").alias("tool"))


def _roots(h):
    return h.select("tenant", F.concat(F.lit("Example."), "tenant").alias("domain")).distinct()


@query("collect_candidates", sql("hosts", body="""
    SELECT tenant, domain, list_aggregate(list_sort(list(DISTINCT tool)), 'string_agg', ',') AS sources
    FROM (SELECT DISTINCT tenant, 'Example.' || tenant AS domain, 'Stage1-Root' AS tool FROM hosts
          UNION ALL SELECT tenant, host, lang FROM hosts)
    GROUP BY tenant, domain"""))
def _(spark, sf):
    h = views.hosts(spark, sf)
    return dedup.collect_candidates(_roots(h), _tool_finds(h)).select(
        "tenant", "domain", joined("sources"))


@query("candidate_counts", sql("hosts", body="""
    SELECT tenant, count(DISTINCT url || ' ' || lang) AS raw_candidates,
           count(DISTINCT host) + 1 AS unique_candidates
    FROM hosts GROUP BY tenant"""))
def _(spark, sf):
    h = views.hosts(spark, sf)
    finds = _tool_finds(h)
    return dedup.candidate_counts(finds, dedup.collect_candidates(_roots(h), finds))


@query("keep_resolved", sql("hosts", body="""
    SELECT tenant, host AS domain,
           list_aggregate(list_sort(list(DISTINCT lang)), 'string_agg', ',') AS sources
    FROM hosts WHERE host IN (SELECT host FROM hosts WHERE scheme = 'https')
    GROUP BY tenant, host"""))
def _(spark, sf):
    h = views.hosts(spark, sf)
    found = h.select("tenant", C("host").alias("raw_host"), C("lang").alias("tool"))
    none = _roots(h).where(F.lit(False))
    candidates = dedup.collect_candidates(none, found)
    resolved = h.where("scheme = 'https'").select(C("host").alias("domain"))
    return dedup.keep_resolved(candidates, resolved).select("tenant", "domain", joined("sources"))


def _subdomains(h):
    tool = F.when(C("scheme") == "https", "CertSpotter").otherwise("Amass")
    return h.select("tenant", F.concat(F.lit("example."), "tenant").alias("parent"),
                    C("authority").alias("subdomain"), tool.alias("tool"))


@query("merge_subdomains", sql("hosts", body="""
    SELECT tenant, 'example.' || tenant AS parent, authority AS subdomain,
           list_aggregate(list_sort(list(DISTINCT CASE scheme WHEN 'https' THEN 'CertSpotter'
                                                  ELSE 'Amass' END)), 'string_agg', ',') AS sources
    FROM hosts GROUP BY ALL"""))
def _(spark, sf):
    return dedup.merge_subdomains(_subdomains(views.hosts(spark, sf))).select(
        "tenant", "parent", "subdomain", joined("sources"))


@query("subdomain_stats", sql("hosts", body="""
    SELECT tenant, 'example.' || tenant AS parent, count(DISTINCT authority) AS total,
           count(DISTINCT authority) FILTER (scheme = 'https') AS certspotter,
           count(DISTINCT authority) FILTER (scheme = 'http') AS amass
    FROM hosts GROUP BY tenant"""))
def _(spark, sf):
    merged = dedup.merge_subdomains(_subdomains(views.hosts(spark, sf)))
    return dedup.subdomain_stats(merged, {"certspotter": "CertSpotter", "amass": "Amass"})


# --- infrastructure ---------------------------------------------------------------------------

def _edge_text(h):
    record = F.when(C("lang") == "de", "cname_record").otherwise(
        F.when(C("scheme") == "https", "a_record").otherwise("aaaa_record"))
    ip = F.concat(F.lit("10.0.0."), F.length("host").cast("string"))
    return h.select("seq", "tenant", F.concat(
        F.lit("  "), "authority", F.lit(" (FQDN) --> "), record, F.lit(" --> "), ip,
        F.lit(" (IPAddress)")).alias("line"))


EDGES = """
    edges AS (
        SELECT seq, tenant, authority AS hostname,
               CASE scheme WHEN 'https' THEN 'a_record' ELSE 'aaaa_record' END AS record_type,
               '10.0.0.' || length(host) AS ip
        FROM hosts WHERE lang <> 'de')"""


@query("edge_lines", sql("hosts", body=f"""
    WITH {EDGES}
    SELECT *, hostname || ' (FQDN) --> ' || record_type || ' --> ' || ip || ' (IPAddress)' AS raw_line
    FROM edges"""))
def _(spark, sf):
    return eventlines.edge_lines(_edge_text(views.hosts(spark, sf)), "line")


@query("hosts_per_ip", sql("hosts", body=f"""
    WITH {EDGES}
    SELECT tenant, ip, hostname, min(seq) AS first_seq FROM edges GROUP BY ALL"""))
def _(spark, sf):
    return dedup.hosts_per_ip(eventlines.edge_lines(_edge_text(views.hosts(spark, sf)), "line"))


@query("enrich_ips", sql("hosts", body=f"""
    WITH {EDGES}
    SELECT DISTINCT ip, 'AS' || s_suppkey AS asn, n_name AS description, r_name AS cidr
    FROM edges
    LEFT JOIN (supplier JOIN nation ON n_nationkey = s_nationkey
               JOIN region ON r_regionkey = n_regionkey) ON '10.0.0.' || s_suppkey = ip"""))
def _(spark, sf):
    edges = eventlines.edge_lines(_edge_text(views.hosts(spark, sf)), "line")
    lookup = (
        views.table(spark, sf, "supplier")
        .join(views.table(spark, sf, "nation"), C("n_nationkey") == C("s_nationkey"))
        .join(views.table(spark, sf, "region"), C("r_regionkey") == C("n_regionkey"))
        .select(F.concat(F.lit("10.0.0."), C("s_suppkey").cast("string")).alias("ip"),
                F.concat(F.lit("AS"), C("s_suppkey").cast("string")).alias("asn"),
                C("n_name").alias("description"), C("r_name").alias("cidr"))
    )
    return joins.enrich_ips(edges, lookup)


@query("certificate_names", sql("hosts", body="""
    SELECT DISTINCT tenant, unnest([host, replace(authority, 'm.', ''), 'a.' || lang]) AS subdomain
    FROM (SELECT tenant, host, authority, lang FROM hosts WHERE authority NOT LIKE 'm.%')
    UNION
    SELECT DISTINCT tenant, unnest([host, authority, 'a.' || lang]) FROM hosts
    WHERE authority LIKE 'm.%'"""))
def _(spark, sf):
    h = views.hosts(spark, sf).select("tenant", F.array(
        F.concat(F.lit("*."), "host"),
        F.when(C("authority").startswith("m."), C("authority"))
        .otherwise(F.replace("authority", F.lit("m."), F.lit(""))),
        F.concat(F.lit("a.*."), "lang")).alias("dns_names"))
    return eventlines.certificate_names(h, "dns_names")


@query("merge_infrastructure", sql("hosts", body="""
    WITH a AS (SELECT tenant, host AS domain, max(url) AS harvest FROM hosts
               WHERE scheme = 'https' GROUP BY ALL),
         b AS (SELECT tenant, host AS domain, max(authority) AS raw_hits, count(*) AS n_certificates
               FROM hosts WHERE lang = 'en' OR scheme <> 'https' GROUP BY ALL)
    SELECT coalesce(a.tenant, b.tenant) AS tenant, coalesce(a.domain, b.domain) AS domain,
           harvest, raw_hits, coalesce(n_certificates, 0) AS n_certificates
    FROM a FULL JOIN b ON a.tenant = b.tenant AND a.domain = b.domain"""))
def _(spark, sf):
    return _infrastructure(spark, sf).withColumn(
        "n_certificates", F.coalesce("n_certificates", F.lit(0).cast("bigint")))


def _infrastructure(spark, sf):
    h = views.hosts(spark, sf).withColumnRenamed("host", "domain")
    a = h.where("scheme = 'https'").groupBy("tenant", "domain").agg(F.max("url").alias("harvest"))
    b = h.where("lang = 'en' or scheme <> 'https'").groupBy("tenant", "domain").agg(
        F.max("authority").alias("raw_hits"), F.count("*").alias("n_certificates"))
    return joins.merge_infrastructure(a, b, ["harvest"], ["raw_hits", "n_certificates"])


HOST_VERDICTS = """
    hv AS (SELECT tenant, host AS domain, arg_max(lang, seq) AS note,
                  arg_max(scheme, seq) = 'https' AS keep
           FROM hosts WHERE lang <> 'es' GROUP BY ALL)"""


def _host_verdicts(spark, sf):
    return views.with_strangers(views.hosts(spark, sf).where("lang <> 'es'").select(
        "tenant", F.upper("host").alias("identifier"), (C("scheme") == "https").alias("keep"),
        C("lang").alias("note"), "seq"))


@query("filter_infrastructure", sql("hosts", body=f"""
    WITH {HOST_VERDICTS},
    i AS (SELECT DISTINCT tenant, host AS domain FROM hosts)
    SELECT tenant, i.domain, coalesce(keep, true) AS keep,
           coalesce(note, 'not_evaluated_by_model_fail_open') AS note
    FROM i LEFT JOIN hv USING (tenant, domain)"""))
def _(spark, sf):
    return verdicts.attach_verdicts(
        _infrastructure(spark, sf), _host_verdicts(spark, sf), "domain", ["note"]
    ).select("tenant", "domain", "keep", "note")


@query("filter_domains", sql("hosts", body=f"""
    WITH {HOST_VERDICTS}
    SELECT DISTINCT hosts.tenant, host AS domain, coalesce(keep, true) AS keep,
           coalesce(note, 'not_evaluated_by_model_fail_open') AS note
    FROM hosts LEFT JOIN hv ON hv.domain = host AND hv.tenant = hosts.tenant"""))
def _(spark, sf):
    return verdicts.attach_verdicts(
        _domain_table(spark, sf), _host_verdicts(spark, sf), "domain", ["note"]
    ).select("tenant", "domain", "keep", "note")


@query("compact_certificates", sql("hosts", body="""
    SELECT seq, host AS dns_names, CASE lang WHEN 'en' THEN 'Friendly ' || tenant
               ELSE 'CN=' || tenant END AS issuer, lang AS not_before, scheme = 'http' AS revoked
    FROM hosts"""))
def _(spark, sf):
    issuer = F.struct(
        F.when(C("lang") == "en", F.concat(F.lit("Friendly "), "tenant")).otherwise("")
        .alias("friendly_name"),
        F.concat(F.lit("CN="), "tenant").alias("name"))
    record = F.struct(
        C("seq").alias("id"), F.array("host").alias("dns_names"), issuer.alias("issuer"),
        C("lang").alias("not_before"), C("scheme").alias("not_after"),
        (C("scheme") == "http").alias("revoked"))
    out = views.hosts(spark, sf).select(
        "seq", F.inline(compact.compact_certificates(F.array(record), 15)))
    return out.select("seq", joined("dns_names"), "issuer", "not_before", "revoked")


# --- tool output ------------------------------------------------------------------------------

@query("host_events", sql("hosts", body=r"""
    SELECT DISTINCT seq, host FROM (
        SELECT seq, host FROM hosts WHERE scheme = 'https'
        UNION ALL
        SELECT seq, unnest(regexp_extract_all(
            regexp_replace(lower(html), '[^\pL\pN_.-]', '  ', 'g'),
            '(?:^|[^\pL\pN_])((?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,})(?:[^\pL\pN_]|$)',
            1)) AS host
        FROM hosts WHERE scheme = 'http')"""))
def _(spark, sf):
    events = F.concat(
        F.lit('[{"type": "DOMAIN_NAME", "data": "'), "host",
        F.lit('"}, {"type": "OTHER", "data": "x.example.com"}, 3]'))
    h = views.hosts(spark, sf).select(
        "seq", F.when(C("scheme") == "https", events).otherwise(C("html")).alias("output"))
    return eventlines.host_events(h, "output")


@query("unparsed_lines", sql("hosts", body=r"""
    SELECT seq, line_no - 1 AS line_no, md5(unparsed_line) AS line_hash FROM (
        SELECT seq, unnest(l) AS unparsed_line, unnest(range(1, len(l) + 1)) AS line_no
        FROM (SELECT seq, string_split_regex(html, '\r\n|\n|\r') AS l FROM hosts))
    WHERE trim(unparsed_line) <> ''"""))
def _(spark, sf):
    h = views.hosts(spark, sf).select("seq", "html")
    return eventlines.unparsed_lines(h, "html").select(
        "seq", "line_no", F.md5("unparsed_line").alias("line_hash"))


@query("host_list", sql("hosts", body="""
    SELECT seq, unnest([host, authority]) AS host FROM hosts"""))
def _(spark, sf):
    text = F.concat(F.lit('["'), "host", F.lit('", {"hostname": "'), "authority",
                    F.lit('"}, {"ip": "1"}, 5]'))
    h = views.hosts(spark, sf).select("seq", F.parse_json(text).alias("hosts"))
    return eventlines.host_list(h, "hosts")


REFS = r"""
    refs AS (
        SELECT seq, tenant, authority AS source_domain,
               CASE lang WHEN 'en' THEN base || ' a+b.PDF' WHEN 'fr' THEN base || '%zz.docx'
                    WHEN 'de' THEN base || '.doc' END AS filename,
               CASE lang WHEN 'en' THEN 'pdf' WHEN 'fr' THEN 'docx' WHEN 'de' THEN 'doc' END
                   AS extension
        FROM (SELECT *, regexp_extract(url, '^https?://[^/]*/[a-z]+/([0-9]+)', 1) AS base FROM hosts)
        WHERE lang <> 'es')"""


def _references(spark, sf):
    stem = F.regexp_extract("url", r"^(https?://[^/]*/[a-z]+/[0-9]+)", 1)
    tail = views.case("lang", {
        "en": "%20a+b.PDF?x=1#top", "fr": "%zz.docx", "de": ".doc;v=2?q"}, ".txt")
    h = views.hosts(spark, sf).select("seq", "tenant", F.concat(stem, tail).alias("url"))
    return references.document_references(h, "url").drop("url")


@query("document_references", sql("hosts", body=f"WITH {REFS} SELECT * FROM refs"))
def _(spark, sf):
    return _references(spark, sf)


@query("unseen_documents", sql("hosts", body=f"""
    WITH {REFS}
    SELECT tenant, filename, min(seq) AS seq, arg_min(source_domain, seq) AS source_domain,
           arg_min(extension, seq) AS extension
    FROM refs WHERE (tenant, filename) NOT IN (
        SELECT (tenant, filename) FROM refs r JOIN hosts h USING (seq, tenant)
        WHERE h.scheme = 'https' AND extension = 'pdf')
    GROUP BY tenant, filename"""))
def _(spark, sf):
    refs = _references(spark, sf)
    https = views.hosts(spark, sf).where("scheme = 'https'").select("seq")
    seen = refs.where("extension = 'pdf'").join(https, "seq", "left_semi")
    return references.unseen_documents(refs, seen, ["tenant", "filename"], "seq")


# --- views and rows ---------------------------------------------------------------------------

def _domain_table(spark, sf):
    h = views.hosts(spark, sf).withColumnRenamed("host", "domain")
    return dedup.merge_domains(
        h.withColumn("sources", F.array("lang")),
        h.where("scheme = 'https'").withColumn("sources", F.array("scheme")))


DOMAIN_TABLE = """
    domain_table AS (
        SELECT tenant, host AS domain,
               list_sort(list_distinct(list(lang) ||
                   coalesce(list(scheme) FILTER (scheme = 'https'), []))) AS sources,
               bool_or(scheme = 'https') AS dns_validated
        FROM hosts GROUP BY tenant, host)"""


@query("compact_domain", sql("hosts", body=f"""
    WITH {DOMAIN_TABLE}
    SELECT domain, list_aggregate(sources, 'string_agg', ',') AS sources, dns_validated
    FROM domain_table"""))
def _(spark, sf):
    return compact.compact_domain(_domain_table(spark, sf)).withColumn(
        "sources", F.array_join("sources", ","))


@query("domain_rows", sql("hosts", body=f"""
    WITH {DOMAIN_TABLE}
    SELECT tenant, domain, list_aggregate(sources, 'string_agg', ', ') AS sources,
           CASE WHEN dns_validated THEN 'Yes' ELSE 'No' END AS dns_validated,
           CASE WHEN list_contains(sources, 'de') THEN '' ELSE 'seen' END AS note
    FROM domain_table WHERE NOT list_contains(sources, 'fr')"""))
def _(spark, sf):
    judged = _domain_table(spark, sf).withColumn(
        "keep", ~F.array_contains("sources", "fr")
    ).withColumn("note", F.when(~F.array_contains("sources", "de"), "seen"))
    return report.domain_rows(judged)
