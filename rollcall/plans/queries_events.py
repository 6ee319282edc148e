"""Queries over lines of tool output and what is merged from them (events)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions.variants import canonical
from rollcall.operators import compact, dedup, joins, report, verdicts
from rollcall.plans import views
from rollcall.plans.queries_hosts import joined
from rollcall.plans.registry import query, sql
from rollcall.sources import eventlines

C = F.col

BREACH = """
    b AS (SELECT event_id, user_id,
                 CASE event_type WHEN 'signup' THEN 'EMAILADDR_COMPROMISED' WHEN 'error' THEN 'LEAKSITE_CONTENT'
                      WHEN 'purchase' THEN 'unparsed-list' ELSE 'unparsed' END AS type,
                 CASE event_type WHEN 'signup' THEN 'm' END AS module,
                 CASE event_type WHEN 'signup' THEN replace(props, ' ', '') WHEN 'error' THEN '"e' || event_id || '"'
                      WHEN 'purchase' THEN '[{"data":"u' || user_id
                           || '","type":"DARKNET_MENTION_URL"},{"data":"x","type":"Username"},7]'
                      ELSE '"' || line || '"' END AS data
          FROM lines WHERE event_type <> 'view' AND NOT (event_type = 'error' AND value > 10))"""
MENTION = """
    m AS (SELECT event_id, user_id, event_type,
                 CASE event_type WHEN 'purchase' THEN 'DARKNET_MENTION_URL'
                      WHEN 'view' THEN 'DARKNET_MENTION_CONTENT' ELSE 'unparsed' END AS type,
                 CASE event_type WHEN 'purchase' THEN '"u' || user_id || '"'
                      WHEN 'view' THEN '"v' || event_id || '"' ELSE '"' || line || '"' END AS data
          FROM lines WHERE event_type IN ('purchase', 'view', 'click'))"""


def _lines(spark, sf):
    return views.lines(spark, sf).select("event_id", "user_id", "event_type", "line")


@query("breach_events", sql("lines", body=f"""
    WITH {BREACH} SELECT * FROM b"""))
def _(spark, sf):
    return eventlines.breach_events(_lines(spark, sf).drop("event_type"), "line")


@query("mention_events", sql("lines", body=f"""
    WITH {MENTION} SELECT event_id, type, data FROM m"""))
def _(spark, sf):
    return eventlines.mention_events(_lines(spark, sf), "line").select("event_id", "type", "data")


@query("mention_elements", sql("lines", body=f"""
    WITH {MENTION}
    SELECT 't' AS tenant, 'u' || user_id AS target, 'HUMAN_NAME' AS target_type, type, data,
           'sfp_ahmia,sfp_torch,sfp_onionsearchengine' AS module_hint,
           'u' || user_id AS triggering_target
    FROM m"""))
def _(spark, sf):
    found = eventlines.mention_events(_lines(spark, sf), "line").select(
        F.lit("t").alias("tenant"), F.concat(F.lit("u"), C("user_id").cast("string")).alias("target"),
        F.lit("HUMAN_NAME").alias("target_type"), "type", "data")
    return joins.mention_elements(found)


@query("canonical", """
    SELECT count(DISTINCT props) AS n_values, count(*) AS n_rows FROM events""")
def _(spark, sf):
    body = F.expr("substr(props, 2, length(props) - 2)")
    a = F.concat(F.lit('{"z": {"b": 2, "a": 1.0}, '), body, F.lit("}"))
    b = F.concat(F.lit("{"), body, F.lit(', "z":{"a":1,"b":2.0}}'))
    either = F.when(C("event_type") == "view", a).otherwise(b)
    return views.table(spark, sf, "events").agg(
        F.count_distinct(canonical(either)).alias("n_values"), F.count("*").alias("n_rows"))


# --- exposures --------------------------------------------------------------------------------

def _exposures(spark, sf):
    """Per event a row of exposure elements, as JSON text, for the user's address."""
    e = views.table(spark, sf, "events")
    return e.select(
        F.lit("t").alias("tenant"),
        F.concat(F.lit(" U"), C("user_id").cast("string"), F.lit("@x.example.com")).alias("email"),
        F.when(C("event_type") == "view", F.array().cast("array<string>")).otherwise(F.array(
            C("props"), F.replace("props", F.lit(" "), F.lit("")), F.concat(F.lit('"'), "event_type", F.lit('"')),
        )).alias("breaches"),
        F.when(C("event_type") != "click", F.array("event_type", F.lit(""))).alias("services_checked"),
        F.when(C("event_type") == "click", "legacy").alias("service"),
        C("event_id").alias("seq"))


@query("merge_exposures", """
    SELECT 't' AS tenant, 'u' || user_id || '@x.example.com' AS email,
           string_agg(DISTINCT CASE event_type WHEN 'click' THEN 'legacy' ELSE event_type END, ','
                      ORDER BY CASE event_type WHEN 'click' THEN 'legacy' ELSE event_type END) AS services
    FROM events GROUP BY user_id""")
def _(spark, sf):
    heads, _ = dedup.merge_exposures(_exposures(spark, sf))
    return heads.select("tenant", "email", joined("services"))


EXPOSED = """
    x AS (SELECT 'u' || user_id || '@x.example.com' AS email, replace(props, ' ', '') AS element,
                 event_id AS s, 0 AS p FROM events WHERE event_type <> 'view'
          UNION ALL SELECT 'u' || user_id || '@x.example.com', '"' || event_type || '"', event_id, 1
          FROM events WHERE event_type <> 'view'),
    el AS (SELECT email, element, min(s) AS first_seq, arg_min(p, s) AS first_pos FROM x GROUP BY 1, 2)"""


@query("merge_exposure_elements", f"""
    WITH {EXPOSED} SELECT 't' AS tenant, * FROM el""")
def _(spark, sf):
    return dedup.merge_exposures(_exposures(spark, sf))[1]


@query("first_elements", f"""
    WITH {EXPOSED},
    r AS (SELECT *, row_number() OVER (PARTITION BY email ORDER BY first_seq, first_pos) AS n FROM el)
    SELECT email, string_agg(element, ',' ORDER BY n) AS elements FROM r WHERE n <= 5 GROUP BY email""")
def _(spark, sf):
    elements = dedup.merge_exposures(_exposures(spark, sf))[1]
    return dedup.first_elements(elements, ["email"], 5).select("email", joined("elements"))


@query("exposure_findings", """
    SELECT event_id, 0 AS i, 'apify' AS source,
           CASE event_type WHEN 'signup' THEN 'structured_breach_report' WHEN 'view' THEN 'empty'
                WHEN 'purchase' THEN 'unknown' ELSE 'raw_event' END AS kind,
           CASE event_type WHEN 'error' THEN 'inner' WHEN 'signup' THEN NULL WHEN 'purchase' THEN NULL
                ELSE 'T' END AS type,
           CASE event_type WHEN 'error' THEN replace(props, ' ', '') WHEN 'click' THEN '"c"'
                WHEN 'purchase' THEN '"p' || user_id || '"' END AS data,
           CASE event_type WHEN 'signup' THEN user_id::VARCHAR END AS breach_count,
           CASE event_type WHEN 'signup' THEN 1 ELSE -1 END AS n_details
    FROM events WHERE event_type <> 'purchase'
    UNION ALL SELECT event_id, 0, NULL, 'unknown', NULL, '"p' || user_id || '"', NULL, -1
    FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT event_id, 1, 'apify', 'raw_event', 'T', '"d"', NULL, -1
    FROM events WHERE event_type = 'click'""")
def _(spark, sf):
    u = C("user_id").cast("string")
    t = '"type": "T", "source": "apify"'
    group = views.case("event_type", {
        "signup": F.concat(
            F.lit('{"source": "", "type": "apify", "data": {"status": "breached", "breachCount": '), u,
            F.lit(', "breachDetails": [{"breach": "B", "verified": true}, 4]}}')),
        "view": F.lit("{" + t + ', "data": []}'),
        "purchase": F.concat(F.lit('"p'), u, F.lit('"')),
        "click": F.lit("{" + t + ', "data": ["c", "d"]}'),
        "error": F.concat(F.lit("{" + t + ', "data": {"type": "inner", "data": '), "props", F.lit("}}")),
    })
    groups = F.array(F.parse_json(group))
    out = views.table(spark, sf, "events").select(
        "event_id", F.posexplode(compact.exposure_findings(groups, 5, 5, 10)).alias("i", "f"))
    return out.select(
        "event_id", "i", "f.source", "f.kind", "f.type", "f.data",
        C("f.report.breach_count").alias("breach_count"),
        F.coalesce(F.size("f.details"), F.lit(-1)).alias("n_details"))


def _exposure_verdicts(spark, sf):
    v = views.table(spark, sf, "events").where("event_type = 'error'").groupBy("user_id").agg(
        F.max_by("props", "event_id").alias("p"), F.max("event_id").alias("seq"),
        F.max_by("value", "event_id").alias("value"))
    v = v.select(F.lit("t").alias("tenant"), F.concat(F.lit("u"), C("user_id").cast("string"), F.lit("@X.example.com")).alias("identifier"),
                 (C("value") < 20).alias("keep"), F.lit(None).cast("string").alias("note"),
                 F.when(C("value") < 10, C("p")).alias("exposure_summary"), "seq")
    return views.with_strangers(v)


def _judged_exposures(spark, sf):
    heads, _ = dedup.merge_exposures(_exposures(spark, sf))
    return verdicts.attach_verdicts(heads, _exposure_verdicts(spark, sf), "email",
                                    ["note", "exposure_summary"])


@query("exposure_rows", """
    WITH s AS (SELECT user_id, string_agg(DISTINCT CASE event_type WHEN 'click' THEN 'legacy' ELSE event_type END,
                      ', ' ORDER BY CASE event_type WHEN 'click' THEN 'legacy' ELSE event_type END) AS services
               FROM events GROUP BY 1),
         v AS (SELECT user_id, arg_max(props, event_id) AS p, arg_max(value, event_id) AS value
               FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT 't' AS tenant, 'u' || s.user_id || '@x.example.com' AS email, services,
           CASE WHEN value < 10 THEN p ELSE '-' END AS exposure_summary
    FROM s LEFT JOIN v USING (user_id) WHERE coalesce(value < 20, true)""")
def _(spark, sf):
    return report.exposure_rows(_judged_exposures(spark, sf))


# --- mentions ---------------------------------------------------------------------------------

def _mentions(spark, sf):
    """Per event a scanned target; clicks name no target and errors found nothing."""
    e = views.table(spark, sf, "events")
    t = C("event_type")
    return e.select(
        F.lit("t").alias("tenant"),
        F.when(t == "click", "").otherwise(F.concat(F.lit("u"), C("user_id").cast("string"))).alias("target"),
        F.when(t == "error", "HUMAN_NAME").otherwise(F.upper("event_type")).alias("target_type"),
        F.when(t != "error", F.array("props")).alias("mentions"),
        F.array(F.lit("ahmia"), t).alias("modules_checked"), C("event_id").alias("seq"))


HEADS = """
    h AS (SELECT 'u' || user_id AS target, CASE event_type WHEN 'error' THEN 'HUMAN_NAME' ELSE upper(event_type) END
                     AS target_type,
                 'ahmia,' || event_type AS modules_checked,
                 count(DISTINCT CASE WHEN event_type <> 'error' THEN props END) AS n
          FROM events WHERE event_type <> 'click' GROUP BY user_id, event_type)"""


@query("merge_mentions", f"""
    WITH {HEADS} SELECT 't' AS tenant, target, target_type, modules_checked, n FROM h""")
def _(spark, sf):
    heads, elements = dedup.merge_mentions(_mentions(spark, sf))
    out = dedup.mention_counts(heads, elements, ["tenant", "target", "target_type"])
    return out.select("tenant", "target", "target_type", joined("modules_checked"), "n")


@query("merge_mention_elements", """
    SELECT 't' AS tenant, 'u' || user_id AS target, upper(event_type) AS target_type,
           replace(props, ' ', '') AS element, min(event_id) AS first_seq, 0 AS first_pos
    FROM events WHERE event_type NOT IN ('click', 'error') GROUP BY user_id, event_type, props""")
def _(spark, sf):
    return dedup.merge_mentions(_mentions(spark, sf))[1]


@query("compact_mentions", f"""
    WITH {HEADS},
    f AS (SELECT 'u' || user_id AS target, upper(event_type) AS target_type, replace(props, ' ', '') AS e,
                 min(event_id) AS s FROM events WHERE event_type NOT IN ('click', 'error') GROUP BY 1, 2, 3),
    r AS (SELECT *, row_number() OVER (PARTITION BY target, target_type ORDER BY s) AS k FROM f)
    SELECT h.target || '||' || h.target_type AS target_key, modules_checked,
           coalesce(string_agg(e, ',' ORDER BY k) FILTER (k <= 10), '') AS mentions
    FROM h LEFT JOIN r ON r.target = h.target AND r.target_type = h.target_type GROUP BY 1, 2""")
def _(spark, sf):
    heads, elements = dedup.merge_mentions(_mentions(spark, sf))
    ten = dedup.first_elements(elements, ["tenant", "target", "target_type"], 10)
    return compact.compact_mentions(heads, ten).select(
        "target_key", joined("modules_checked"), joined("mentions"))


def _counted(spark, sf):
    heads, elements = dedup.merge_mentions(_mentions(spark, sf))
    return dedup.mention_counts(heads, elements, ["tenant", "target", "target_type"])


def _mention_verdicts(spark, sf):
    v = views.table(spark, sf, "events").where("event_type = 'view'").groupBy("user_id").agg(
        F.max("event_id").alias("seq"), F.max_by("value", "event_id").alias("value"))
    v = v.select(
        F.lit("t").alias("tenant"), F.concat(F.lit("U"), C("user_id").cast("string"), F.lit("||view")).alias("identifier"),
        (C("value") < 20).alias("keep"), F.lit("seen").alias("note"),
        C("value").cast("int").cast("string").alias("exposure_summary"), "seq")
    return views.with_strangers(v)


def _judged_mentions(spark, sf, counted=None):
    counted = _counted(spark, sf) if counted is None else counted
    return verdicts.filter_mentions(counted, _mention_verdicts(spark, sf), "n",
                                    ("note", "exposure_summary"))


JUDGED = f"""{HEADS},
    v AS (SELECT 'u' || user_id AS target, 'VIEW' AS target_type, arg_max(value, event_id) AS value
          FROM events WHERE event_type = 'view' GROUP BY 1),
    j AS (SELECT h.*, n = 0 OR coalesce(value < 20, true) AS keep,
                 CASE WHEN n = 0 THEN 'no_dark_web_mentions_found'
                      WHEN value IS NULL THEN 'not_evaluated_by_model_fail_open' ELSE 'seen' END AS note,
                 trunc(value)::INT::VARCHAR AS exposure_summary
          FROM h LEFT JOIN v USING (target, target_type))"""


@query("filter_mentions", f"WITH {JUDGED} SELECT target, target_type, keep, note, exposure_summary FROM j")
def _(spark, sf):
    return _judged_mentions(spark, sf).select(
        "target", "target_type", "keep", "note", "exposure_summary")


@query("mention_rows", f"""
    WITH {JUDGED}
    SELECT 't' AS tenant, target, target_type, coalesce(exposure_summary, '-') AS exposure_summary
    FROM j WHERE keep AND note <> 'no_dark_web_mentions_found'""")
def _(spark, sf):
    return report.mention_rows(_judged_mentions(spark, sf))


@query("mention_stats", f"""
    WITH {HEADS} SELECT 't' AS tenant, count(*) AS checked, count(*) FILTER (n > 0) AS with_mentions FROM h""")
def _(spark, sf):
    return report.mention_stats(_counted(spark, sf))


@query("slim_mentions", f"""
    WITH {HEADS} SELECT 't' AS tenant, target, target_type, n AS mention_count FROM h WHERE n > 0""")
def _(spark, sf):
    return compact.slim_mentions(_counted(spark, sf))


@query("scan_targets", sql("hosts", "persons", body="""
    SELECT tenant, host AS target, 'INTERNET_NAME' AS target_type FROM hosts
    UNION ALL SELECT lower(r_name), r_name, 'COMPANY_NAME' FROM region
    UNION ALL SELECT tenant, CASE WHEN c_nationkey > 12 THEN name ELSE first_name END, 'HUMAN_NAME' FROM persons"""))
def _(spark, sf):
    h = views.hosts(spark, sf).select("tenant", C("host").alias("domain"))
    orgs = views.table(spark, sf, "region").select(
        F.lower("r_name").alias("tenant"), C("r_name").alias("name"))
    big = C("c_nationkey") > 12
    people = views.persons(spark, sf).select(
        "tenant", F.when(big, C("name")).otherwise("").alias("full_name"), "first_name",
        F.when(big, C("last_name")).alias("last_name"))
    return joins.scan_targets(h, orgs, people)
