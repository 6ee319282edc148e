"""Queries over documents, pages and free text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rollcall.constants import DEAD_PAGE_PHRASES
from rollcall.functions import names as N
from rollcall.functions import text as X
from rollcall.functions import variants as V
from rollcall.operators import classify, compact, dedup, joins, report, store, verdicts
from rollcall.plans import views
from rollcall.plans.registry import query, sql
from rollcall.plans.session import checkpoint_dir
from rollcall.sources import artifacts, eventlines

C = F.col
FOLD = "regexp_replace(strip_accents({}), '[^\\x00-\\x7F]', '', 'g')"


def fold(c: str) -> str:
    return FOLD.format(c)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- text functions over whole texts ----------------------------------------------------------

@query("fold_accents", f"""
    SELECT doc_id, md5({fold('text')}) AS folded, md5(lower({fold('text')})) AS for_match
    FROM documents""")
def _(spark, sf):
    return views.spread(spark, views.table(spark, sf, "documents")).select(
        "doc_id", F.md5(X.fold_accents(C("text"))).alias("folded"),
        F.md5(X.fold_for_match(C("text"))).alias("for_match"),
    )


@query("slugify", f"""
    SELECT conv_id, turn, coalesce(nullif(trim(
        regexp_replace(lower({fold('text')}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'default') AS slug
    FROM conversations""")
def _(spark, sf):
    return views.table(spark, sf, "conversations").select(
        "conv_id", "turn", X.slugify(C("text")).alias("slug"))


@query("abbreviation", f"""
    SELECT conv_id, turn, coalesce(list_aggregate(list_transform(list_filter(
        string_split_regex({fold('text')}, '[\\s\\-]+'),
        lambda w: w <> '' AND lower(w) NOT IN
            ('de','du','des','la','le','les','et','the','and','of','for')),
        lambda w: upper(w[1])), 'string_agg', ''), '') AS abbreviation
    FROM conversations""")
def _(spark, sf):
    return views.table(spark, sf, "conversations").select(
        "conv_id", "turn", X.abbreviation(C("text")).alias("abbreviation"))


@query("acronym", f"""
    SELECT conv_id, turn, coalesce(list_aggregate(list_transform(list_filter(
        string_split_regex(lower({fold('text')}), '\\s+'), lambda w: w <> ''),
        lambda w: w[1]), 'string_agg', ''), '') AS acronym
    FROM conversations""")
def _(spark, sf):
    return views.table(spark, sf, "conversations").select(
        "conv_id", "turn", X.acronym(C("text")).alias("acronym"))


@query("truncate_text", """
    WITH f AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)
    SELECT doc_id, left(t, 400) AS text, length(t) > 400 AS truncated FROM f""")
def _(spark, sf):
    return views.spread(spark, views.table(spark, sf, "documents")).select(
        "doc_id", X.truncate_text(C("text"), 400).alias("cut")
    ).select("doc_id", "cut.text", "cut.truncated")


@query("format_timestamp", """
    SELECT event_id, CASE event_type WHEN 'error' THEN 'unknown' WHEN 'click' THEN 'at ' || user_id
           ELSE strftime(ts, '%B %d, %Y at %H:%M UTC') END AS shown
    FROM events""")
def _(spark, sf):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    text = views.case("event_type", {
        "error": "", "click": F.concat(F.lit("at "), C("user_id").cast("string"))}, iso)
    return views.table(spark, sf, "events").select(
        "event_id", X.format_timestamp(text).alias("shown"))


@query("split_name", """
    SELECT p_partkey,
           CASE WHEN p_brand = 'Brand#1' THEN NULL WHEN p_size > 25
                THEN split_part(p_name, ' ', 1) || 'e-x'
                ELSE split_part(p_name, ' ', 1) END AS first,
           CASE WHEN p_brand = 'Brand#1' THEN NULL WHEN p_size > 25
                THEN regexp_replace(lower(p_brand), '[^a-z-]', '', 'g')
                ELSE split_part(p_name, ' ', 2) END AS last
    FROM part""")
def _(spark, sf):
    big = C("p_size") > 25
    no = C("p_brand") == "Brand#1"
    word = F.split("p_name", " ")
    first = F.when(no, None).when(big, F.concat(F.upper(word[0]), F.lit("É-'x 1")))
    last = F.when(no, None).when(big, C("p_brand")).otherwise("Undefined")
    full = F.when(no, word[0]).otherwise(F.concat_ws(" ", word[0], F.lit("12 "), F.upper(word[1])))
    return views.table(spark, sf, "part").select(
        "p_partkey", N.split_name(first, last, full).alias("n")
    ).select("p_partkey", "n.first", "n.last")


@query("query_variants", """
    SELECT p_partkey, replace(replace(p_name, '-', ' '), '_', ' ') || ' ' || p_type AS spaced,
           replace(p_name, ' ', '-') || '_' || p_type AS hyphened, 2 AS n_variants, 1 AS n_single
    FROM part""")
def _(spark, sf):
    v = N.query_variants(F.concat(F.lit(" "), "p_name", F.lit("_"), "p_type"))
    out = views.table(spark, sf, "part").select(
        "p_partkey", v.alias("v"), F.size(N.query_variants(C("p_type"))).alias("n_single"))
    return out.select(
        "p_partkey", F.get("v", F.lit(0)).alias("spaced"),
        F.regexp_replace(F.get("v", F.lit(1)), "^-", "").alias("hyphened"),
        F.size("v").alias("n_variants"), "n_single")


@query("page_is_live", sql("hosts", body=f"""
    WITH p AS (SELECT seq, lower(trim(html)) AS low, length(trim(html)) AS n, lang,
                      regexp_extract(host, '^[a-z]+', 0) AS name FROM hosts)
    SELECT seq, CASE WHEN lang = 'es' THEN true WHEN n < 40 THEN false
         WHEN {' OR '.join(f'contains(low, {quoted(p)})' for p in DEAD_PAGE_PHRASES)} THEN false
         ELSE length(name) < 3 OR contains(low, name) END AS live FROM p"""))
def _(spark, sf):
    h = views.hosts(spark, sf)
    name = F.regexp_extract("host", "^[a-z]+", 0)
    text = F.when(C("lang") != "es", C("html"))
    return h.select("seq", classify.page_is_live(text, C("lang"), name).alias("live"))


@query("address_events", """
    SELECT DISTINCT doc_id, email FROM (
        SELECT doc_id, lower(unnest(regexp_extract_all(text,
            '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+'))) AS email FROM documents
        UNION ALL SELECT doc_id, 'd' || doc_id || '@x.example.com' FROM documents)""")
def _(spark, sf):
    event = F.concat(
        F.lit('\n{"type": "EMAILADDR", "data": " D'), C("doc_id").cast("string"),
        F.lit('@X.example.com "}\n{"type": "OTHER", "data": "no@x.example.com"}\n["l@x.example.com"]'))
    d = views.spread(spark, views.table(spark, sf, "documents")).select(
        "doc_id", F.concat(F.coalesce("text", F.lit("")), event).alias("output"))
    found = eventlines.address_events(eventlines.split_lines(d, "output"), "line")
    return found.select("doc_id", "email").distinct()


# --- document tables --------------------------------------------------------------------------

@query("merge_documents", sql("docs", body="""
    SELECT tenant, source_domain, filename,
           arg_min(seq, (CASE WHEN content_verified THEN 0 ELSE 1 END) * 100000000 + seq) AS seq,
           bool_or(coalesce(content_verified, false)) AS content_verified
    FROM docs GROUP BY ALL"""))
def _(spark, sf):
    d = views.docs(spark, sf).select(
        "tenant", "source_domain", "filename", "seq",
        F.coalesce("content_verified", F.lit(False)).alias("content_verified"))
    return dedup.merge_documents(d)


@query("merge_document_methods", sql("docs", body="""
    WITH f AS (SELECT seq, tenant, discovery_method, lang || '-' || (n_chars // 100) AS filename
               FROM docs)
    SELECT seq, tenant, filename, discovery_method FROM f WHERE discovery_method = 'metagoofil'
    UNION ALL
    SELECT min(seq), tenant, replace(filename, 'fr', 'en'), arg_min(discovery_method, seq) FROM f
    WHERE discovery_method <> 'metagoofil'
      AND (tenant, replace(filename, 'fr', 'en')) NOT IN
          (SELECT (tenant, filename) FROM f WHERE discovery_method = 'metagoofil')
    GROUP BY 2, 3"""))
def _(spark, sf):
    stem = F.concat(F.replace("lang", F.lit("fr"), F.lit("en")), F.lit("-"),
                    F.expr("n_chars div 100").cast("string"))
    d = views.docs(spark, sf).select("seq", "tenant", stem.alias("filename"), "discovery_method")
    return dedup.merge_document_methods(
        d.where("discovery_method = 'metagoofil'"), d.where("discovery_method <> 'metagoofil'"))


def _with_path(d):
    return d.withColumn("filepath", artifacts.document_path(
        C("tenant"), C("discovery_method"), C("source_domain"), C("filename")))


DOC_PATH = """CASE discovery_method WHEN 'metagoofil' THEN tenant || '/metagoofil/'
        WHEN 'apify-google' THEN tenant || '/apify/' END || source_domain || '/' || filename"""


@query("document_path", sql("docs", body=f"SELECT seq, {DOC_PATH} AS filepath FROM docs"))
def _(spark, sf):
    return _with_path(views.docs(spark, sf)).select("seq", "filepath")


@query("attach_file_exists", sql("docs", body=f"""
    WITH d AS (SELECT *, {DOC_PATH} AS filepath FROM docs)
    SELECT seq, filepath, coalesce(filepath IN (SELECT filepath FROM d
           WHERE labelled AND filepath IS NOT NULL), false) AS file_exists
    FROM d"""))
def _(spark, sf):
    d = _with_path(views.docs(spark, sf))
    return artifacts.attach_file_exists(d.select("seq", "filepath"), d.where("labelled"))


@query("signature_ok", """
    SELECT page_id, (page_html = 'pdf' AND lang = 'fr') OR (page_html <> 'pdf' AND lang = 'de')
                 OR lang = 'es' AS ok
    FROM (SELECT page_id, CASE WHEN starts_with(url, 'https') THEN 'pdf' ELSE 'docx' END AS page_html,
                 regexp_extract(url, '^https?://[^/]*/([a-z]+)/', 1) AS lang FROM pages)""")
def _(spark, sf):
    head = views.case("lang", {"fr": "%PDF", "de": "PK\x03\x04"}, "")
    content = F.concat(F.encode(head, "UTF-8"), F.encode("html", "UTF-8"))
    ext = F.when(C("scheme") == "https", "PDF").otherwise("docx")
    kind = F.when(C("lang") == "es", "application/MSWord").otherwise("text/html")
    return views.hosts(spark, sf).select(
        C("seq").alias("page_id"), artifacts.signature_ok(content, ext, kind).alias("ok"))


@query("documents_mentioning", """
    WITH org AS (
        SELECT 'src' || item_id AS tenant, lower(text) AS name, 'src' || item_id || '.example.com' AS domain,
               list_filter(string_split_regex(lower(text), '[^\\pL\\pN_]+'),
                           lambda w: length(w) >= 3) AS words
        FROM benchmark)
    SELECT doc_id AS seq, source AS tenant, coalesce(contains(lower(text), name)
           OR contains(lower(text), domain)
           OR len(list_filter(words, lambda w: contains(lower(text), w))) > 0, false) AS content_verified
    FROM documents LEFT JOIN org ON org.tenant = source""")
def _(spark, sf):
    orgs = views.table(spark, sf, "benchmark").select(
        F.concat(F.lit("src"), C("item_id").cast("string")).alias("tenant"), C("text").alias("name"),
        F.concat(F.lit("SRC"), C("item_id").cast("string"), F.lit(".example.com")).alias("domain"),
    )
    d = views.table(spark, sf, "documents").select(
        C("doc_id").alias("seq"), C("source").alias("tenant"), "text")
    return joins.documents_mentioning(d, orgs).select("seq", "tenant", "content_verified")


@query("merge_metadata", sql("docs", body="""
    SELECT seq, coalesce(CASE WHEN labelled THEN 'q' || quality END, lang) AS kept, n_chars::VARCHAR AS size,
           CASE WHEN labelled THEN 't' || toxic END AS flag
    FROM docs"""))
def _(spark, sf):
    d = views.docs(spark, sf)
    parsed = F.when(C("labelled"), F.create_map(
        F.lit("kept"), F.concat(F.lit("q"), C("quality").cast("string")),
        F.lit("flag"), F.concat(F.lit("t"), C("toxic").cast("string")),
    )).otherwise(F.create_map().cast("map<string,string>"))
    found = F.create_map(F.lit("kept"), C("lang"), F.lit("size"), C("n_chars").cast("string"))
    m = d.select("seq", joins.merge_metadata(found, parsed).alias("m"))
    return m.select("seq", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("kept", "size", "flag")])


@query("latest_artifact", """
    SELECT lower(c_mktsegment) AS tenant, max(strftime(o_orderdate, '%Y-%m-%d')) AS report_date,
           max('report_' || lower(c_mktsegment) || '_' || strftime(o_orderdate, '%Y-%m-%d') || '.docx')
               AS name
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O' GROUP BY 1""")
def _(spark, sf):
    o = views.table(spark, sf, "orders").join(
        views.table(spark, sf, "customer"), C("c_custkey") == C("o_custkey"))
    tenant = F.lower("c_mktsegment")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    name = F.concat(F.lit("report_"), tenant, F.lit("_"), date,
                    views.case("o_orderstatus", {"O": ".docx", "F": "_fr.docx"}, ".doc"))
    return artifacts.latest_artifact(o.select(tenant.alias("tenant"), name.alias("name")),
                                     "tenant", "name")


# --- verdicts over documents ------------------------------------------------------------------

def _verdict_rows(spark, sf):
    """Labels as verdicts: twice for some, under odd spellings, and for unknown or blank ids."""
    lab = views.docs(spark, sf).where("labelled").withColumnRenamed("seq", "doc_id")
    keep = F.when(C("toxic") == 1, F.lit('"no"')).when(C("quality") == 1, F.lit("true")) \
        .otherwise("false")
    note = F.concat(F.lit("q"), C("quality").cast("string"))
    base = lab.select(
        "tenant", F.concat(F.lit(" D"), C("doc_id").cast("string"), F.lit("\t")).alias("identifier"),
        F.parse_json(keep).alias("keep"), F.lit(None).cast("string").alias("tier"),
        note.alias("note"), C("doc_id").alias("seq"))
    later = lab.where("quality = 0 and toxic = 0").select(
        "tenant", F.concat(F.lit("d"), C("doc_id").cast("string")).alias("identifier"),
        F.parse_json(F.lit("false")).alias("keep"), F.lit("late").alias("tier"),
        F.lit("again").alias("note"), (C("doc_id") + 1000000000).alias("seq"))
    lost = lab.where("toxic = 1").select(
        "tenant", F.when(C("quality") == 1, F.lit("  ")).otherwise(
            F.concat(F.lit("zz"), C("doc_id").cast("string"))).alias("identifier"),
        F.parse_json(F.lit("true")).alias("keep"), F.lit(None).cast("string").alias("tier"),
        F.lit("lost").alias("note"), (C("doc_id") + 2000000000).alias("seq"))
    strange = lab.where("toxic = 1").select(
        F.lit("elsewhere").alias("tenant"),
        F.concat(F.lit("d"), C("doc_id").cast("string")).alias("identifier"),
        F.parse_json(F.lit("false")).alias("keep"), F.lit("noise").alias("tier"),
        F.lit("not theirs").alias("note"), (C("doc_id") + 3000000000).alias("seq"))
    return base.unionByName(later).unionByName(lost).unionByName(strange)


def _doc_records(spark, sf):
    return views.docs(spark, sf).select(
        "seq", F.concat(F.lit("d"), C("seq").cast("string")).alias("record"), "tenant", "lang")


@query("attach_verdicts", sql("docs", body="""
    SELECT seq, 'd' || seq AS record, tenant, lang,
           NOT labelled OR toxic = 1 OR quality = 1 AS keep,
           CASE WHEN quality = 0 AND toxic = 0 THEN 'late' END AS tier,
           CASE WHEN NOT labelled THEN 'not_evaluated_by_model_fail_open'
                WHEN quality = 0 AND toxic = 0 THEN 'again' ELSE 'q' || quality END AS note
    FROM docs"""))
def _(spark, sf):
    return verdicts.attach_verdicts(
        _doc_records(spark, sf), _verdict_rows(spark, sf), "record")


WARNED = """
    warned AS (
        SELECT tenant, 'documents' AS category, seq + 2000000000 AS seq,
               CASE WHEN quality = 1 THEN '  ' ELSE 'zz' || seq END AS identifier,
               CASE WHEN quality = 1 THEN 'missing identifier'
                    ELSE 'identifier not present in input' END AS warning
        FROM docs WHERE toxic = 1
        UNION ALL SELECT 'elsewhere', 'documents', seq + 3000000000, 'd' || seq,
                         'identifier not present in input' FROM docs WHERE toxic = 1)"""


@query("verdict_warnings", sql("docs", body=f"WITH {WARNED} SELECT * FROM warned"))
def _(spark, sf):
    return verdicts.verdict_warnings(
        _verdict_rows(spark, sf), _doc_records(spark, sf), "record", "documents")


def _outcome(spark, sf):
    d = _with_path(views.docs(spark, sf))
    return verdicts.document_outcome(d.select(
        "seq", "tenant", "filename", "source_domain",
        F.when(C("labelled"), F.concat(F.lit("https://"), "source_domain")).alias("url"),
        (C("discovery_method") != "other").alias("file_exists"),
        F.when(C("n_chars") < 300, "Extraction failed: short").alias("extract_error"),
        F.when(C("toxic") == 1, " \n ").otherwise(C("text")).alias("text"),
        F.when(~C("labelled"), "no verdict").alias("verdict_error"),
        F.when(C("quality") == 1, F.concat(F.lit("Summary of "), "filename"))
        .alias("verdict_summary"),
        F.when(C("n_chars") > 2000, "high").when(C("n_chars") > 1000, "great")
        .otherwise("low").alias("verdict_usability"),
        (C("quality") == 1).alias("verdict_mentions"),
    )).drop("text")


OUTCOME = """
    outcome AS (
        SELECT *, CASE WHEN error IS NULL AND quality = 1 THEN 'Summary of ' || filename END AS summary,
               CASE WHEN error IS NOT NULL THEN 'unusable' WHEN n_chars > 2000 THEN 'high'
                    WHEN n_chars > 1000 THEN 'unusable' ELSE 'low' END AS usability,
               CASE WHEN error IS NULL THEN quality = 1 END AS mentions_target_company,
               CASE WHEN labelled THEN 'https://' || source_domain END AS url
        FROM (SELECT *, CASE
                  WHEN discovery_method = 'other'
                      THEN 'File not found on disk - skipped LLM summarization.'
                  WHEN lang = 'de' THEN 'Unsupported file type for extraction: .doc'
                  WHEN n_chars < 300 THEN 'Extraction failed: short'
                  WHEN toxic = 1
                      THEN 'No extractable text (empty or scanned/image-only document).'
                  WHEN NOT labelled THEN 'LLM summarization failed: no verdict' END AS error
              FROM docs))"""


@query("document_outcome", sql("docs", body=f"""
    WITH {OUTCOME}
    SELECT seq, tenant, filename, error, summary, usability,
           coalesce(mentions_target_company::VARCHAR, '-') AS mentions
    FROM outcome"""))
def _(spark, sf):
    return _outcome(spark, sf).select(
        "seq", "tenant", "filename", "error", "summary", "usability",
        F.coalesce(C("mentions_target_company").cast("string"), F.lit("-")).alias("mentions"))


@query("save_json", "SELECT conv_id, turn, role, text FROM conversations")
def _(spark, sf):
    """Written as JSON and read back: nulls stay, text of any alphabet survives."""
    path = f"{checkpoint_dir(spark)}/save_json-{uuid.uuid4().hex}"
    c = views.table(spark, sf, "conversations")
    store.save_json(c, path)
    return store.read_json(spark, path, c.schema)


@query("usable_documents", sql("docs", body=f"""
    WITH {OUTCOME} SELECT seq, true AS usable FROM outcome WHERE summary <> ''
    UNION ALL SELECT seq, false FROM outcome WHERE error <> ''"""))
def _(spark, sf):
    o = _outcome(spark, sf)
    return report.usable_documents(o).select("seq", F.lit(True).alias("usable")).unionByName(
        report.errored_documents(o).select("seq", F.lit(False).alias("usable")))


@query("document_rows", sql("docs", body=f"""
    WITH {OUTCOME}
    SELECT tenant, filename, source_domain, coalesce(url, '-') AS url,
           upper(usability[1]) || usability[2:] AS usability, summary
    FROM outcome WHERE summary <> ''"""))
def _(spark, sf):
    return report.document_rows(_outcome(spark, sf))


@query("document_filter_stats", sql("docs", body=f"""
    WITH {OUTCOME}
    SELECT tenant, 'documents_summarized' AS measure, count(*) FILTER (summary <> '') AS value
    FROM outcome GROUP BY tenant
    UNION ALL SELECT tenant, 'documents_errored', count(*) FILTER (error <> '')
    FROM outcome GROUP BY tenant"""))
def _(spark, sf):
    return report.document_filter_stats(_outcome(spark, sf))


@query("document_stats", sql("docs", body="""
    SELECT tenant, count(*) AS total, count(*) FILTER (lang = 'en') AS metagoofil,
           count(*) FILTER (lang IN ('fr', 'de')) AS apify_google,
           count(*) FILTER (quality = 1) AS content_verified
    FROM docs GROUP BY tenant"""))
def _(spark, sf):
    return report.document_stats(views.docs(spark, sf))


@query("slim_documents", sql("docs", body=f"""
    SELECT tenant, filename, {DOC_PATH} AS filepath, labelled AS file_exists, source_domain
    FROM docs"""))
def _(spark, sf):
    return compact.slim_documents(
        _with_path(views.docs(spark, sf)).withColumnRenamed("labelled", "file_exists"))


# --- values of unknown shape ------------------------------------------------------------------

@query("as_list", """
    SELECT event_id, CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 2 ELSE 1 END AS n,
           CASE event_type WHEN 'signup' THEN '' WHEN 'view' THEN user_id || ',"x"'
                WHEN 'click' THEN user_id::VARCHAR ELSE replace(props, ' ', '') END AS items
    FROM events""")
def _(spark, sf):
    u = C("user_id").cast("string")
    text = views.case("event_type", {
        "signup": "null", "view": F.concat(F.lit("["), u, F.lit(', "x"]')), "click": u}, C("props"))
    e = views.table(spark, sf, "events").select(
        "event_id", V.as_list(F.parse_json(text)).alias("l"))
    return e.select("event_id", F.size("l").alias("n"),
                    F.array_join(F.transform("l", lambda x: F.to_json(x)), ",").alias("items"))
