"""Queries over raw profile items (orders) and the people made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.operators import classify, compact, dedup, joins, profiles, report, verdicts
from rollcall.plans import views
from rollcall.plans.queries_hosts import joined
from rollcall.plans.registry import query, sql

C = F.col

TITLE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Sales Director' WHEN '2-HIGH' THEN 'International Clerk'
    WHEN '3-MEDIUM' THEN 'Software Engineer' WHEN '4-NOT SPECIFIED' THEN 'Factory Worker'
    ELSE 'Events Coordinator' END"""
ITEMS = f"""
    items AS (
        SELECT o_orderkey AS seq, p.tenant, o_custkey, o_orderstatus AS st, o_orderpriority AS pr,
               o_totalprice > 250000 AS rich, {TITLE} AS title, p.first_name, p.last_name,
               CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' THEN p.name END AS name,
               p_type, p_brand, c_mktsegment, c_nationkey,
               'https://People.example/in/' || o_custkey || '/?ref=' || o_orderpriority AS linkedin_url,
               CASE WHEN o_orderstatus = 'O' THEN 'P-' || o_custkey END AS public_identifier,
               'www.' || p.tenant || '.example.com' AS matched_domain
        FROM orders JOIN persons p ON c_custkey = o_custkey),
    people AS (
        SELECT *, CASE st WHEN 'F' THEN p_type ELSE title END AS job_title,
               CASE WHEN rich THEN c_mktsegment || '-Works' END AS now_company,
               'The ' || c_mktsegment || '_Group' AS past_company,
               CASE st WHEN 'O' THEN 'Present' WHEN 'F' THEN '1998' ELSE '' END AS end_date
        FROM items WHERE name IS NOT NULL),
    tiered AS (
        SELECT *, CASE WHEN NOT rich AND st = 'F' THEN 'former_employee'
                       WHEN title = 'International Clerk' THEN 'intern'
                       WHEN title = 'Software Engineer' THEN 'current_employee'
                       ELSE 'leadership' END AS tier FROM people)"""
REASON = """CASE tier WHEN 'former_employee' THEN 'Former employee at target company (' || title || ').'
    WHEN 'intern' THEN 'Current intern/trainee at target company (' || title || ').'
    WHEN 'leadership' THEN 'Current employee in a senior/leadership role at target company (' || title || ').'
    ELSE 'Current employee at target company (' || title || ').' END"""
RANK = """CASE tier WHEN 'leadership' THEN 0 WHEN 'current_employee' THEN 1 WHEN 'intern' THEN 2
    WHEN 'former_employee' THEN 3 ELSE 4 END"""


def _items(spark, sf):
    return views.profile_items(spark, sf)


def _people(spark, sf):
    return profiles.flatten_profiles(_items(spark, sf))


def _named(spark, sf):
    """People with the name of the organisation they are looked for at."""
    return _people(spark, sf).withColumn("company_name", F.upper("tenant"))


@query("flatten_profiles", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT seq, tenant, name, job_title, linkedin_url, public_identifier,
           CASE st WHEN 'F' THEN c_mktsegment ELSE p_brand END AS location_text,
           'N' || c_nationkey AS country, p_type AS about, first_name || '@x.example.com' AS emails,
           title AS now_title, now_company, 2 AS n_positions, past_company, '1995' AS start_date, end_date,
           p_brand AS school, pr || ',' || p_type AS services_offered
    FROM people"""))
def _(spark, sf):
    now, past = F.get("current_position", F.lit(0)), F.get("all_positions", F.lit(0))
    items = profiles.typed_items(views.profile_json(spark, sf), "raw")
    return profiles.flatten_profiles(items).select(
        "seq", "tenant", "name", "job_title", "linkedin_url", "public_identifier",
        C("location.text").alias("location_text"), C("location.country").alias("country"), "about",
        joined("emails"), now["title"].alias("now_title"), now["company_name"].alias("now_company"),
        F.size("all_positions").alias("n_positions"), past["company_name"].alias("past_company"),
        past["start_date"].alias("start_date"), past["end_date"].alias("end_date"),
        F.get("education", F.lit(0))["school_name"].alias("school"), joined("services_offered"))


@query("merge_people", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT tenant, coalesce(public_identifier, linkedin_url) AS person_key, max(seq) AS seq,
           min(seq) AS first_seq, arg_max(name, seq) AS name, arg_max(job_title, seq) AS job_title
    FROM people GROUP BY 1, 2"""))
def _(spark, sf):
    p = _people(spark, sf).select(
        "tenant", "seq", "name", "job_title", "linkedin_url", "public_identifier")
    return dedup.merge_people(p).select(
        "tenant", "person_key", "seq", "first_seq", "name", "job_title"
    ).orderBy("tenant", *dedup.people_order())


@query("fall_back_to_raw", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT i.tenant, seq, coalesce(public_identifier, linkedin_url) AS person_key,
           CASE WHEN st <> 'P' THEN name END AS name,
           CASE st WHEN 'F' THEN p_type ELSE title END AS job_title, matched_domain,
           'raw-linkedin-search' AS source, 'current_employee' AS employee_tier,
           'Raw discovery data only; position history unavailable to assess target-company tenure.'
               AS tier_reason
    FROM items i
    WHERE i.tenant NOT IN (SELECT tenant FROM persons WHERE tenant > 'g')"""))
def _(spark, sf):
    items = _items(spark, sf).withColumn("search_target", C("matched_domain"))
    enriched = views.persons(spark, sf).where("tenant > 'g'")
    raw = dedup.fall_back_to_raw(enriched, profiles.raw_people(items))
    return classify.tier_raw_people(raw).select(
        "tenant", "seq", "person_key", "name", "job_title", "matched_domain", "source",
        "employee_tier", "tier_reason")


@query("dedup_people", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT tenant, CASE WHEN public_identifier IS NOT NULL THEN 'pid:' || lower(public_identifier)
           ELSE 'url:https://people.example/in/' || o_custkey END AS identity,
           min(seq) AS seq, arg_min(name, seq) AS name
    FROM people GROUP BY 1, 2"""))
def _(spark, sf):
    return dedup.dedup_people(_people(spark, sf).select(
        "tenant", "seq", "name", "linkedin_url", "linkedin_profile_url", "public_identifier"
    )).select("tenant", "identity", "seq", "name")


@query("classify", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT seq, tenant, tier AS employee_tier, {RANK} AS employee_tier_rank, {REASON} AS tier_reason
    FROM tiered"""))
def _(spark, sf):
    return classify.classify(_named(spark, sf)).select(
        "seq", "tenant", "employee_tier", "employee_tier_rank", "tier_reason")


@query("classify_whole_words", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT seq, CASE WHEN NOT rich AND st = 'F' THEN 'former_employee'
                     WHEN title = 'Sales Director' THEN 'leadership' ELSE 'current_employee' END
               AS employee_tier
    FROM people"""))
def _(spark, sf):
    return classify.classify(_named(spark, sf), whole_word=True).select("seq", "employee_tier")


@query("position_matches", """
    SELECT p_partkey, contains(replace(lower(p_name || p_type), ' ', ''), 'ring') AS by_keyword,
           list_contains(string_split(p_name, ' '), 'bolt') AS by_name,
           lower(p_type[1]) || 'x' = 'ex' AS by_initials,
           p_size > 25 AS ongoing
    FROM part""")
def _(spark, sf):
    none = F.lit(None).cast("string")
    company = F.concat_ws("_", F.upper("p_name"), C("p_type"))
    return views.table(spark, sf, "part").select(
        "p_partkey",
        classify.position_matches(F.replace(company, F.lit("_"), F.lit("")), F.lit("ring"), classify.name_keys(none))
        .alias("by_keyword"),
        classify.position_matches(F.replace(C("p_name"), F.lit(" "), F.lit("-")), F.lit("zzz"),
                                  classify.name_keys(F.lit(" Bôlt "))).alias("by_name"),
        classify.position_matches(F.lit("The EX Bank"), F.lit(""),
                                  classify.name_keys(F.concat("p_type", F.lit(" Xylo")))).alias("by_initials"),
        classify.ongoing(F.when(C("p_size") > 40, None).when(C("p_size") > 25, " PRESENT ")
                         .otherwise("2001")).alias("ongoing"))


@query("with_current_position", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT seq, title, CASE WHEN pr = '1-URGENT' THEN past_company ELSE now_company END AS company_name
    FROM people"""))
def _(spark, sf):
    none = F.array().cast("array<struct<title:string,company_name:string>>")
    p = _people(spark, sf).withColumn(
        "current_position",
        F.when(F.array_contains("services_offered", "1-URGENT"), none).otherwise(F.transform(
            "current_position", lambda x: F.struct(x["title"].alias("title"),
                                                   x["company_name"].alias("company_name")))))
    return classify.with_current_position(p).select("seq", "position_now.*")


@query("compact_person", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT coalesce(public_identifier, name) AS identifier, name, job_title, matched_domain,
           tier AS employee_tier, {REASON} AS tier_reason, 2 AS n_positions, end_date,
           left(p_type, 400) AS about_excerpt, pr || ',' || p_type AS services_offered
    FROM tiered"""))
def _(spark, sf):
    out = compact.compact_person(classify.classify(_named(spark, sf)), 6, 400, 6)
    return out.select(
        "identifier", "name", "job_title", "matched_domain", "employee_tier", "tier_reason",
        F.size("recent_positions").alias("n_positions"),
        F.get("recent_positions", F.lit(0))["end_date"].alias("end_date"),
        "about_excerpt", joined("services_offered"))


@query("slim_people", sql("persons", body=f"""
    WITH {ITEMS}
    SELECT tenant, name, job_title, linkedin_url, 0 AS n_profiles, matched_domain, tier AS employee_tier
    FROM tiered"""))
def _(spark, sf):
    p = classify.classify(_named(spark, sf)).withColumn("additional_profiles", F.array())
    return compact.slim_people(p).withColumn(
        "n_profiles", F.size("additional_profiles")).drop("additional_profiles")


def _verdicts(spark, sf):
    last = views.table(spark, sf, "orders").where("o_orderpriority <> '2-HIGH'").join(
        views.table(spark, sf, "customer"), C("o_custkey") == C("c_custkey")).select(
        F.lower("c_mktsegment").alias("tenant"), F.concat(F.lit("p-"), C("o_custkey").cast("string")).alias("identifier"),
        F.lit(False).alias("keep"), F.lit("noise").alias("tier"),
        C("o_orderpriority").alias("note"), C("o_orderstatus").alias("connection_to_target"),
        C("o_orderkey").alias("seq"))
    return views.with_strangers(last)


def _judged(spark, sf):
    people = classify.classify(_named(spark, sf))
    rejected = people.withColumn(
        "employee_tier", F.when(C("job_title") == "Factory Worker", "reject")
        .otherwise(C("employee_tier")))
    return verdicts.filter_people(rejected, _verdicts(spark, sf),
                                  ["tier", "note", "connection_to_target"])


JUDGED = f"""
    v AS (SELECT 'P-' || o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS note,
                 arg_max(o_orderstatus, o_orderkey) AS link
          FROM orders WHERE o_orderpriority <> '2-HIGH' GROUP BY 1),
    judged AS (
        SELECT t.* REPLACE (CASE WHEN job_title = 'Factory Worker' THEN 'reject' ELSE tier END AS tier),
               coalesce(public_identifier, name) AS identifier, job_title <> 'Factory Worker' AS keep,
               CASE WHEN job_title = 'Factory Worker' THEN {REASON}
                    WHEN v.id IS NULL THEN 'not_evaluated_by_model_fail_open' ELSE v.note END AS note,
               CASE WHEN job_title <> 'Factory Worker' THEN link END AS connection_to_target
        FROM tiered t LEFT JOIN v ON v.id = public_identifier)"""


@query("filter_people", sql("persons", body=f"""
    WITH {ITEMS}, {JUDGED}
    SELECT seq, tenant, identifier, keep, tier, note, connection_to_target FROM judged"""))
def _(spark, sf):
    return _judged(spark, sf).select(
        "seq", "tenant", "identifier", "keep", "tier", "note", "connection_to_target")


@query("person_rows", sql("persons", body=f"""
    WITH {ITEMS}, {JUDGED}
    SELECT tenant, seq, name, {RANK} AS rank, CASE tier WHEN 'leadership' THEN 'Leadership'
               WHEN 'current_employee' THEN 'Current Employee' WHEN 'intern' THEN 'Intern'
               ELSE 'Former Employee' END AS tier_label
    FROM judged WHERE keep"""))
def _(spark, sf):
    return report.person_rows(_judged(spark, sf))


# --- profiles elsewhere -----------------------------------------------------------------------

@query("tag_search", """
    SELECT p_partkey, p_brand AS search_target,
           unnest([replace(p_name, '-', ' '), replace(p_name, ' ', '-')]) AS search_query
    FROM part""")
def _(spark, sf):
    return profiles.tag_search(views.table(spark, sf, "part"), "p_name", "p_brand").select(
        "p_partkey", "search_target", "search_query")


def _hits(spark, sf):
    """Line items as site hits of an order's person."""
    li = views.table(spark, sf, "lineitem")
    o = views.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    s = C("l_suppkey").cast("string")
    return li.join(o, C("o_orderkey") == C("l_orderkey")).select(
        C("o_orderstatus").alias("tenant"), C("l_orderkey").alias("person"),
        C("l_linestatus").alias("pattern"), F.concat(F.lit("site"), s).alias("site"),
        F.concat(F.lit("https://s/"), s).alias("url"),
        F.when(C("l_returnflag") == "R", "Available").otherwise("Claimed").alias("status"))


HITS = """
    hits AS (
        SELECT DISTINCT o_orderstatus AS tenant, l_orderkey AS person, l_linestatus AS pattern,
               'site' || l_suppkey AS site, 'https://s/' || l_suppkey AS url
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R'),
    packed AS (SELECT tenant, person, pattern, string_agg(site || '=' || url, ',' ORDER BY site, url)
                      AS platforms FROM hits GROUP BY 1, 2, 3)"""


@query("profile_hits", f"WITH {HITS} SELECT * FROM packed")
def _(spark, sf):
    out = joins.profile_hits(_hits(spark, sf))
    return out.withColumn("platforms", F.array_join(F.transform(
        "platforms", lambda p: F.concat_ws("=", p["site"], p["url"])), ","))


def _profiles(spark, sf):
    hits = joins.profile_hits(_hits(spark, sf))
    return hits.groupBy("person").agg(F.array_sort(F.collect_list(F.struct(
        C("pattern").alias("matched_pattern"), "platforms"))).alias("additional_profiles"))


@query("attach_profiles", f"""
    WITH {HITS}
    SELECT o_orderkey AS person, coalesce(n, 0) AS n_patterns
    FROM orders LEFT JOIN (SELECT person, count(*) AS n FROM packed GROUP BY 1) ON person = o_orderkey""")
def _(spark, sf):
    people = views.table(spark, sf, "orders").select(C("o_orderkey").alias("person"))
    out = joins.attach_profiles(people, _profiles(spark, sf), ["person"])
    return out.select("person", F.size("additional_profiles").cast("bigint").alias("n_patterns"))


@query("people_with_profiles", f"""
    WITH {HITS}
    SELECT o_orderstatus AS tenant, count(*) AS people,
           count(*) FILTER (o_orderkey IN (SELECT person FROM packed)) AS with_profiles
    FROM orders GROUP BY 1""")
def _(spark, sf):
    people = views.table(spark, sf, "orders").select(
        C("o_orderkey").alias("person"), C("o_orderstatus").alias("tenant"))
    out = joins.attach_profiles(people, _profiles(spark, sf), ["person"])
    return out.groupBy("tenant").agg(
        F.count("*").alias("people"),
        F.count_if(F.size("additional_profiles") > 0).alias("with_profiles"))


@query("profile_links", f"""
    WITH {HITS},
    l AS (SELECT person, site, url, min(pattern) AS pattern FROM hits GROUP BY ALL)
    SELECT o_orderkey AS person,
           'LinkedIn: https://s/1' || coalesce(',' || string_agg(site || ': ' || url, ',' ORDER BY pattern, site, url)
               FILTER (url <> 'https://s/1'), '') AS links
    FROM orders LEFT JOIN l ON person = o_orderkey GROUP BY 1""")
def _(spark, sf):
    people = views.table(spark, sf, "orders").select(C("o_orderkey").alias("person"))
    out = joins.attach_profiles(people, _profiles(spark, sf), ["person"])
    return out.select("person", F.array_join(profiles.profile_links(
        F.lit("https://s/1"), C("additional_profiles")), ",").alias("links"))
