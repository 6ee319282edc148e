"""Queries over address observations (orders of invented people)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import addresses as A
from rollcall.operators import compact, dedup, joins, report, verdicts
from rollcall.plans import views
from rollcall.plans.queries_hosts import joined
from rollcall.plans.registry import query, sql
from rollcall.plans.session import written

C = F.col
DOMAIN = "lower(substr(email, strpos(email, '@') + 1))"


# --- scalar functions -------------------------------------------------------------------------

@query("valid_address", sql("addr", body=r"""
    SELECT seq, lower(email) AS normal, true AS plain,
           o_orderpriority <> '2-HIGH' AS odd
    FROM addr"""))
def _(spark, sf):
    a = views.addresses(spark, sf)
    odd = F.when(C("o_orderpriority") == "2-HIGH", F.concat(F.lit("é"), "email")) \
        .otherwise(F.concat(F.lit(" \t"), "email", F.lit("　")))
    return a.select(
        "seq", A.normalize_address(F.concat(F.lit(" "), "email", F.lit("\n"))).alias("normal"),
        A.valid_address(C("email")).alias("plain"), A.valid_address(odd).alias("odd"))


@query("address_domain", sql("addr", body=f"""
    SELECT seq, {DOMAIN} || '@x.org' AS first_at, 'x.org' AS last_at, '' AS none FROM addr"""))
def _(spark, sf):
    twice = F.concat("email", F.lit("@X.org "))
    return views.addresses(spark, sf).select(
        "seq", A.address_domain(twice).alias("first_at"),
        F.lower(F.trim(A.mailbox_domain(twice))).alias("last_at"),
        A.address_domain(C("tag")).alias("none"))


@query("mailbox_domains", sql("addr", body=f"""
    SELECT DISTINCT {DOMAIN} AS domain FROM addr"""))
def _(spark, sf):
    return views.addresses(spark, sf).select(A.mailbox_domain(C("email")).alias("domain")).distinct()


@query("address_in_domain", sql("addr", body=f"""
    SELECT seq, {DOMAIN} = tenant || '.example.com' AS inside FROM addr"""))
def _(spark, sf):
    return views.addresses(spark, sf).select("seq", A.address_in_domain(
        C("email"), F.concat("tenant", F.lit(".example.com"))).alias("inside"))


@query("local_part_rank", sql("addr", body="""
    SELECT seq, CASE o_orderpriority WHEN '2-HIGH' THEN 0 WHEN '3-MEDIUM' THEN 1 ELSE 2 END AS rank,
           CASE o_orderpriority WHEN '2-HIGH' THEN '{first}.{last}' WHEN '3-MEDIUM' THEN '{first}_{last}'
                ELSE '{f}{last}' END AS pattern
    FROM addr"""))
def _(spark, sf):
    return views.addresses(spark, sf).select(
        "seq", A.local_part_rank(C("email")).alias("rank"),
        A.inferred_pattern(C("email")).alias("pattern"))


@query("guess_only", sql("addr", body="""
    SELECT seq, tag IN ('Pattern-Generation', 'Manual-Generation') AS one,
           tag IN ('Pattern-Generation', 'Manual-Generation') AND o_orderstatus = 'P' AS two,
           false AS none
    FROM addr"""))
def _(spark, sf):
    second = F.when(C("o_orderstatus") == "P", " PATTERN-generation ").otherwise("scan")
    return views.addresses(spark, sf).select(
        "seq", A.guess_only(F.array("tag")).alias("one"),
        A.guess_only(F.array(C("tag"), second)).alias("two"),
        A.guess_only(F.array().cast("array<string>")).alias("none"))


@query("checkable", sql("addr", body="""
    SELECT seq, validation_status <> 'unknown' AS checkable FROM addr"""))
def _(spark, sf):
    return views.addresses(spark, sf).select(
        "seq", A.checkable(C("validation_status")).alias("checkable"))


VERIFIER_WORD = {"signup": "VALID", "view": "accept_all", "click": "disposable", "error": "odd"}


@query("verifier_status", """
    SELECT event_id,
           CASE event_type WHEN 'signup' THEN 'deliverable' WHEN 'view' THEN 'risky'
                WHEN 'click' THEN 'invalid' ELSE 'unknown' END AS status,
           CASE event_type WHEN 'signup' THEN 0.9 WHEN 'view' THEN 0.5 WHEN 'click' THEN 0.1
                ELSE 0.0 END::DOUBLE AS confidence
    FROM events""")
def _(spark, sf):
    e = views.table(spark, sf, "events")
    return e.select("event_id", A.verifier_status(views.case("event_type", VERIFIER_WORD))
                    .alias("r")).select("event_id", "r.*")


@query("reachability_status", """
    SELECT event_id,
           CASE event_type WHEN 'signup' THEN 'deliverable' WHEN 'view' THEN 'risky'
                WHEN 'click' THEN 'invalid' ELSE 'unknown' END AS status,
           CASE event_type WHEN 'signup' THEN 1.0 WHEN 'view' THEN 0.5 ELSE 0.0 END::DOUBLE
                AS confidence
    FROM events""")
def _(spark, sf):
    word = views.case("event_type", {"signup": "safe", "view": "risky", "click": "invalid"})
    return views.table(spark, sf, "events").select(
        "event_id", A.reachability_status(word).alias("r")).select("event_id", "r.*")


@query("mentions_account", """
    SELECT event_id, event_type <> 'error' AS told, event_type IN ('signup', 'view') AS told_strictly
    FROM events""")
def _(spark, sf):
    text = views.case("event_type", {
        "signup": "Account seen", "view": "was FOUND", "click": "invalid", "purchase": "accounts"},
        C("props"))
    return views.table(spark, sf, "events").select(
        "event_id", A.mentions_account(text).alias("told"),
        A.mentions_account(text, whole_word=True).alias("told_strictly"))


# --- address tables ---------------------------------------------------------------------------

def _observed(spark, sf):
    """The observations, made and written once for the verdicts and for both sides of the merge."""
    return written(views.addresses(spark, sf).select(
        "tenant", "email", "employee", "tag", "validation_status", "confidence", "is_catch_all", "seq",
        "o_orderstatus", "o_orderpriority", "o_totalprice"), "observed")


def _merged(spark, sf, observed=None):
    a = views.addresses(spark, sf) if observed is None else observed
    candidates = a.select("tenant", "email", "employee", "seq", F.array("tag").alias("sources"))
    validated = a.where("o_orderstatus <> 'F'").select(
        "tenant", F.upper("email").alias("email"), F.lit(None).cast("string").alias("employee"),
        F.array(F.lit("checked"), C("o_orderstatus")).alias("sources"),
        "validation_status", F.when(C("o_totalprice") > 100000, C("confidence")).alias("confidence"),
        "is_catch_all", "seq")
    return dedup.merge_addresses(candidates, validated)


MERGED = """
    merged AS (
        SELECT tenant, lower(email) AS email, arg_max(employee, seq) AS employee,
               list_sort(list_distinct([arg_max(tag, seq)]
                   || CASE WHEN bool_or(o_orderstatus <> 'F') THEN ['checked', max(o_orderstatus)]
                      ELSE [] END)) AS sources,
               coalesce(arg_max(validation_status, seq) FILTER (o_orderstatus <> 'F'), 'unknown')
                   AS validation_status,
               coalesce(arg_max(confidence, seq) FILTER (o_orderstatus <> 'F'
                   AND o_totalprice > 100000), 0.0)::DOUBLE AS confidence,
               coalesce(arg_max(is_catch_all, seq) FILTER (o_orderstatus <> 'F'), false) AS is_catch_all
        FROM addr GROUP BY tenant, lower(email))"""


@query("merge_addresses", sql("addr", body=f"""
    WITH {MERGED}
    SELECT * REPLACE (list_aggregate(sources, 'string_agg', ',') AS sources) FROM merged"""))
def _(spark, sf):
    return _merged(spark, sf).withColumn("sources", F.array_join("sources", ","))


@query("sorted_addresses", sql("addr", body=f"""
    WITH {MERGED}
    SELECT tenant, email, validation_status, confidence FROM merged
    ORDER BY tenant, CASE WHEN validation_status = 'deliverable' THEN 0 ELSE 1 END,
             confidence DESC, email"""))
def _(spark, sf):
    return _merged(spark, sf).select(
        "tenant", "email", "validation_status", "confidence"
    ).orderBy("tenant", *dedup.address_order())


@query("summarize_address_domains", sql("addr", body=f"""
    WITH {MERGED}
    SELECT tenant, {DOMAIN} AS domain, count(*) AS candidate_count,
           bool_or(validation_status = 'smtp_inconclusive_catchall' OR is_catch_all)
               AS confirmed_catch_all,
           bool_or(starts_with({DOMAIN}, 'mail.')) AS is_infrastructure_hostname
    FROM merged GROUP BY 1, 2"""))
def _(spark, sf):
    return dedup.summarize_address_domains(_merged(spark, sf))


@query("catch_all_domains", sql("addr", body=f"""
    SELECT DISTINCT {DOMAIN} AS domain FROM addr WHERE is_catch_all"""))
def _(spark, sf):
    a = views.addresses(spark, sf)
    probes = a.select(A.mailbox_domain(C("email")).alias("domain"), "is_catch_all")
    return joins.catch_all_domains(a, probes)


@query("apply_catch_all", sql("addr", body=f"""
    SELECT seq, email,
           CASE WHEN is_catch_all THEN 'smtp_inconclusive_catchall' ELSE validation_status END
               AS validation_status,
           CASE WHEN is_catch_all THEN 0.0 ELSE confidence END::DOUBLE AS confidence,
           is_catch_all
    FROM addr"""))
def _(spark, sf):
    a = views.addresses(spark, sf)
    probes = a.select(A.mailbox_domain(C("email")).alias("domain"), "is_catch_all")
    plain = a.select("seq", "email", "validation_status", "confidence",
                     F.lit(False).alias("is_catch_all"))
    return joins.apply_catch_all(plain, joins.catch_all_domains(a, probes))


@query("resolve_precedence", sql("addr", body="""
    SELECT seq, email,
           CASE WHEN o_orderstatus = 'O' THEN 'deliverable' WHEN o_orderpriority = '2-HIGH' THEN 'risky'
                WHEN o_orderpriority <> '5-LOW' THEN 'deliverable' ELSE 'unknown' END AS validation_status,
           CASE WHEN o_orderstatus = 'O' THEN 1.0 WHEN o_orderpriority = '2-HIGH' THEN 0.5
                WHEN o_orderpriority <> '5-LOW' THEN 0.8 ELSE 0.0 END::DOUBLE AS confidence,
           CASE WHEN o_orderstatus = 'O' THEN o_orderpriority = '1-URGENT'
                ELSE o_orderpriority = '2-HIGH' END AS is_catch_all,
           CASE WHEN o_orderstatus <> 'O' AND o_orderpriority = '2-HIGH' THEN 'hunter_verifier' END
               AS fallback_source
    FROM addr"""))
def _(spark, sf):
    a = views.addresses(spark, sf)
    one = a.groupBy("email").agg(F.any_value("o_orderstatus").alias("s"),
                                 F.any_value("o_orderpriority").alias("p"))
    primary = one.select("email", F.when(C("s") == "O", "safe").otherwise("unknown")
                         .alias("is_reachable"), (C("p") == "1-URGENT").alias("is_catch_all"))
    second = one.where("p <> '5-LOW'").select(
        "email", F.when(C("p") == "2-HIGH", "accept_all").otherwise("blocked").alias("status"),
        F.lit(True).alias("accept_all"))
    third = one.where("p <> '1-URGENT' or s <> 'x'").select(
        "email", F.when(C("p") == "5-LOW", "nothing").otherwise("Not Found").alias("output"))
    return joins.resolve_precedence(a.select("seq", "email"), primary, second, third)


@query("address_inventory", sql("addr", body=f"""
    SELECT tenant, lower(email) AS email,
           list_aggregate(list_sort(list(DISTINCT tag)), 'string_agg', ',') AS sources
    FROM addr WHERE {DOMAIN} = tenant || '.example.com' GROUP BY 1, 2"""))
def _(spark, sf):
    return _inventory(spark, sf).select("tenant", "email", joined("sources"))


def _inventory(spark, sf):
    found = views.addresses(spark, sf).select(
        "tenant", F.concat("tenant", F.lit(".example.com")).alias("target"), "email",
        C("tag").alias("tool"))
    return dedup.address_inventory(found)


def _targets(spark, sf):
    return views.persons(spark, sf).select(
        "tenant", F.concat(
            F.when(C("c_nationkey") == 0, "mail.").otherwise(""), "tenant",
            F.lit(".example.com")).alias("domain")).distinct()


@query("observed_patterns", sql("addr", body=f"""
    SELECT DISTINCT tenant, '{{first}}_{{last}}' AS pattern FROM addr
    WHERE {DOMAIN} = tenant || '.example.com' AND o_orderpriority = '3-MEDIUM'
    UNION SELECT tenant, unnest(['{{first}}.{{last}}', '{{first}}{{last}}', '{{f}}{{last}}', '{{f}}.{{last}}'])
    FROM persons"""))
def _(spark, sf):
    return dedup.observed_patterns(_inventory(spark, sf), _targets(spark, sf))


def _people(spark, sf):
    return views.persons(spark, sf).select(
        "tenant", C("c_custkey").alias("seq"), "first_name",
        F.when(C("c_nationkey") > 12, C("last_name")).otherwise(" ").alias("last_name"), "name")


EXPECTED = """
    expected AS (
        SELECT tenant, unnest([f || '.' || l, f || l, f[1] || l, f[1] || '.' || l, f || '_' || l]) AS local_part,
               upper(f[1]) || f[2:] || ' ' || upper(l[1]) || l[2:] AS employee, c_custkey
        FROM (SELECT tenant, first_name AS f, last_name AS l, c_custkey FROM persons)),
    last_expected AS (
        SELECT tenant, local_part, arg_max(employee, c_custkey) AS employee FROM expected GROUP BY 1, 2)"""


def _expected(spark, sf, inventory=None):
    inventory = _inventory(spark, sf) if inventory is None else inventory
    patterns = dedup.observed_patterns(inventory, _targets(spark, sf))
    return joins.expected_local_parts(_people(spark, sf), patterns)


@query("expected_local_parts", sql("addr", body=f"WITH {EXPECTED} SELECT * FROM last_expected"))
def _(spark, sf):
    return _expected(spark, sf)


@query("reconcile_expected", sql("addr", body=f"""
    WITH {EXPECTED},
    inv AS (SELECT tenant, lower(email) AS email, split_part(lower(email), '@', 1) AS local_part,
                   list(DISTINCT tag) AS tags
            FROM addr WHERE {DOMAIN} = tenant || '.example.com' GROUP BY 1, 2, 3)
    SELECT inv.tenant, email, employee,
           list_aggregate(list_sort(list_distinct(CASE WHEN employee IS NULL THEN tags
               ELSE tags || ['Inferred-Pattern'] END)), 'string_agg', ',') AS sources
    FROM inv LEFT JOIN last_expected e ON e.tenant = inv.tenant AND e.local_part = inv.local_part"""))
def _(spark, sf):
    inventory = written(_inventory(spark, sf), "inventory")      # the patterns come from it too
    out = joins.reconcile_expected(inventory, _expected(spark, sf, inventory))
    return out.select("tenant", "email", "employee", joined("sources"))


@query("role_inventory", sql("addr", body=f"""
    SELECT tenant, email, list_aggregate(list_sort(list(DISTINCT tag)), 'string_agg', ',') AS sources
    FROM (SELECT tenant, lower(email) AS email, tag FROM addr WHERE {DOMAIN} = tenant || '.example.com'
          UNION ALL
          SELECT tenant, unnest(['contact','info','support','sales','hr','admin','careers','jobs',
                 'marketing','press','help','billing','office']) || '@' || tenant || '.example.com',
                 'Role-Based-Generation' FROM (SELECT DISTINCT tenant FROM persons))
    GROUP BY 1, 2"""))
def _(spark, sf):
    out = dedup.role_inventory(_inventory(spark, sf), _targets(spark, sf))
    return out.select("tenant", "email", joined("sources"))


# --- verdicts on addresses --------------------------------------------------------------------

def _verdicts(spark, sf, observed=None):
    """One verdict per address that has an order on time; tiers follow the last order."""
    a = views.addresses(spark, sf) if observed is None else observed
    last = a.where("o_orderpriority <> '4-NOT SPECIFIED'").groupBy(
        "tenant", "email").agg(F.max_by("o_totalprice", "seq").alias("price"),
                               F.max("seq").alias("seq"))
    p = C("price")
    return views.with_strangers(last.select(
        "tenant", F.upper("email").alias("identifier"), (p > 60000).alias("keep"),
        F.when(p > 350000, "confirmed").when(p > 200000, "likely").when(p > 120000, "noise")
        .alias("tier"),
        F.when(p > 200000, "judged").alias("note"), "seq"))


TIERED = """
    v AS (SELECT tenant, lower(email) AS email, arg_max(o_totalprice, seq) AS p FROM addr
          WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1, 2),
    j AS (SELECT m.*, p IS NULL AS unseen, starts_with(split_part(m.email, '@', 2), 'mail.') AS infra,
                 coalesce(p > 60000, true) AS keep0,
                 CASE WHEN p > 350000 THEN 'confirmed' WHEN p > 200000 THEN 'likely'
                      WHEN p > 120000 THEN 'noise' END AS tier0,
                 CASE WHEN p IS NULL THEN 'not_evaluated_by_model_fail_open'
                      WHEN p > 200000 THEN 'judged' END AS note0
          FROM merged m LEFT JOIN v USING (tenant, email)),
    t AS (SELECT *, CASE WHEN tier0 = 'confirmed' AND validation_status <> 'deliverable'
                              THEN CASE WHEN confidence = 0 THEN 'speculative' ELSE 'likely' END
                         WHEN tier0 = 'likely' AND confidence = 0 THEN 'speculative'
                         ELSE tier0 END AS tier1 FROM j),
    c AS (SELECT *, CASE WHEN validation_status = 'smtp_inconclusive_catchall' THEN 'speculative'
                         ELSE tier1 END AS tier2 FROM t),
    g AS (SELECT *, keep0 AND coalesce(tier2 IN ('speculative', 'noise'), false) AND confidence = 0
                    AND len(list_filter(sources, lambda s: s NOT IN
                        ('Pattern-Generation', 'Manual-Generation'))) = 0 AS guess FROM c)"""


TIER_WARNING = """CASE WHEN tier1 IS DISTINCT FROM tier0 THEN
    CASE tier0 WHEN 'confirmed' THEN '[emails] Downgraded ''' || email
        || ''' from tier=confirmed to tier=' || tier1 || ': validation_status is '''
        || validation_status || ''', not ''deliverable''.'
    ELSE '[emails] Downgraded ''' || email || ''' from tier=likely to tier=speculative: confidence '
        || 'is 0 (unvalidated / SMTP inconclusive), regardless of naming pattern.' END END"""
CATCH_ALL_WARNING = """CASE WHEN tier2 IS DISTINCT FROM tier1 THEN '[emails] Downgraded ''' || email
    || ''' from tier=' || coalesce(tier1, 'None') || ' to tier=speculative: domain is confirmed '
    || 'catch-all, so SMTP validation is fundamentally inconclusive for every candidate at it.' END"""


def _judged(spark, sf):
    return verdicts.attach_verdicts(_merged(spark, sf), _verdicts(spark, sf), "email")


@query("enforce_tier_rules", sql("addr", body=f"""
    WITH {MERGED}, {TIERED}
    SELECT tenant, email, tier1 AS tier, keep0 AS keep, note0 AS note,
           coalesce({TIER_WARNING}, '') AS warnings
    FROM t"""))
def _(spark, sf):
    out = verdicts.enforce_tier_rules(_judged(spark, sf))
    return out.select("tenant", "email", "tier", "keep", "note", joined("warnings"))


@query("enforce_catch_all", sql("addr", body=f"""
    WITH {MERGED}, {TIERED}
    SELECT tenant, email, tier2 AS tier, validation_status = 'smtp_inconclusive_catchall'
               AS catchall_unverifiable,
           concat_ws(',', {TIER_WARNING}, {CATCH_ALL_WARNING}) AS warnings
    FROM c"""))
def _(spark, sf):
    out = verdicts.enforce_catch_all(verdicts.enforce_tier_rules(_judged(spark, sf)))
    return out.select("tenant", "email", "tier", "catchall_unverifiable", joined("warnings"))


RECONCILED = """'Reconciled from kept to excluded: tier=' || tier2
    || ', confidence=0, and every source is pattern-generated ([''' || list_aggregate(sources,
    'string_agg', ''', ''') || ''']) - no independent discovery confirms this address exists.'"""
GUESS_NOTE = f"CASE WHEN guess THEN concat_ws(' ', note0, {RECONCILED}) ELSE note0 END"


@query("reconcile_guesses", sql("addr", body=f"""
    WITH {MERGED}, {TIERED}
    SELECT tenant, email, keep0 AND NOT guess AS keep, tier2 AS tier, {GUESS_NOTE} AS note FROM g"""))
def _(spark, sf):
    out = verdicts.reconcile_guesses(
        verdicts.enforce_catch_all(verdicts.enforce_tier_rules(_judged(spark, sf))))
    return out.select("tenant", "email", "keep", "tier", "note")


INFRA_NOTE = (
    "'Candidate generated against an infrastructure/mail-server hostname, not a domain the "
    "company issues personal mailboxes under - structurally invalid regardless of validation "
    "result.'"
)
FILTERED = f"""
    filtered AS (
        SELECT tenant, email, employee, sources, validation_status, confidence, is_catch_all,
               NOT infra AND keep0 AND NOT guess AS keep,
               CASE WHEN infra AND validation_status = 'smtp_inconclusive_catchall' THEN 'speculative'
                    WHEN infra THEN 'noise' ELSE tier2 END AS tier,
               CASE WHEN infra THEN {INFRA_NOTE} ELSE {GUESS_NOTE} END AS note
        FROM g),
    corrected AS (
        SELECT * REPLACE (CASE WHEN infra THEN 'noise' ELSE tier0 END AS tier0,
                          CASE WHEN infra THEN 'noise' ELSE tier1 END AS tier1,
                          CASE WHEN infra AND tier2 <> 'speculative' THEN 'noise'
                               WHEN infra AND validation_status <> 'smtp_inconclusive_catchall' THEN 'noise'
                               WHEN infra AND tier2 IS NULL THEN 'noise' ELSE tier2 END AS tier2,
                          guess AND NOT infra AS guess) FROM g)"""


def _filtered(spark, sf, given=None, observed=None):
    """The merged addresses are read once for each half of the chain, so they are made once."""
    given = _verdicts(spark, sf, observed) if given is None else given
    return verdicts.filter_addresses(written(_merged(spark, sf, observed), "merged"), given)


@query("filter_addresses", sql("addr", body=f"""
    WITH {MERGED}, {TIERED}, {FILTERED} SELECT tenant, email, keep, tier, note FROM filtered"""))
def _(spark, sf):
    return _filtered(spark, sf).select("tenant", "email", "keep", "tier", "note")


@query("exclude_infrastructure", sql("addr", body=f"""
    SELECT seq, email, CASE WHEN o_orderpriority = '1-URGENT' THEN 'false' ELSE '-' END AS keep,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'noise' END AS tier,
           CASE WHEN o_orderpriority = '1-URGENT' THEN {INFRA_NOTE} END AS note
    FROM addr"""))
def _(spark, sf):
    out = verdicts.exclude_infrastructure(views.addresses(spark, sf).select("seq", "email"))
    return out.withColumn("keep", F.coalesce(C("keep").cast("string"), F.lit("-")))


# --- report rows ------------------------------------------------------------------------------

@query("address_rows", sql("addr", body=f"""
    WITH {MERGED}, {TIERED}, {FILTERED}
    SELECT tenant, email, coalesce(employee, '-') AS employee, validation_status,
           coalesce(tier, '-') AS tier
    FROM filtered WHERE keep"""))
def _(spark, sf):
    return report.address_rows(_filtered(spark, sf))


def _split(spark, sf):
    kept = _filtered(spark, sf).where("keep")
    return joins.split_catch_all(kept, dedup.summarize_address_domains(_merged(spark, sf)))


SPLIT = f"""
    domains AS (SELECT tenant, {DOMAIN} AS domain FROM merged
                WHERE validation_status = 'smtp_inconclusive_catchall' OR is_catch_all GROUP BY ALL),
    split AS (SELECT *, (tenant, {DOMAIN}) IN (SELECT (tenant, domain) FROM domains) AS at_catch_all
              FROM filtered WHERE keep)"""


@query("split_catch_all", sql("addr", body=f"""
    WITH {MERGED}, {TIERED}, {FILTERED}, {SPLIT} SELECT tenant, email, at_catch_all FROM split"""))
def _(spark, sf):
    return _split(spark, sf).select("tenant", "email", "at_catch_all")


@query("catch_all_notes", sql("addr", body=f"""
    WITH {MERGED}, {TIERED}, {FILTERED}, {SPLIT}
    SELECT tenant, {DOMAIN} AS domain, count(*) AS candidates FROM split WHERE at_catch_all GROUP BY 1, 2"""))
def _(spark, sf):
    return report.catch_all_notes(_split(spark, sf))


@query("best_addresses", sql("addr", body=f"""
    SELECT tenant, {DOMAIN} AS domain,
           CASE WHEN o_totalprice > 300000 THEN '-' ELSE employee END AS employee,
           arg_min(email, (CASE o_orderpriority WHEN '2-HIGH' THEN 0 WHEN '3-MEDIUM' THEN 1 ELSE 2 END)
                          * 1000000000 + seq) AS email
    FROM addr GROUP BY 1, 2, 3"""))
def _(spark, sf):
    kept = views.addresses(spark, sf).withColumn(
        "employee", F.when(C("o_totalprice") > 300000, "").otherwise(C("employee")))
    return report.best_addresses(kept)


@query("validation_stats", sql("addr", body="""
    SELECT tenant, count(*) FILTER (validation_status = 'deliverable') AS deliverable,
           count(*) FILTER (validation_status = 'risky') AS risky, 0 AS invalid,
           count(*) FILTER (validation_status = 'unknown') AS unknown,
           count(*) FILTER (validation_status = 'smtp_inconclusive_catchall') AS smtp_inconclusive_catchall,
           count(*) FILTER (o_totalprice < 50000) AS smtp_connect_failures
    FROM addr GROUP BY tenant"""))
def _(spark, sf):
    return report.validation_stats(views.addresses(spark, sf).withColumn(
        "smtp_connect_failed", C("o_totalprice") < 50000))


@query("slim_addresses", sql("addr", body=f"""
    WITH {MERGED} SELECT tenant, email, employee, validation_status, confidence FROM merged"""))
def _(spark, sf):
    return compact.slim_addresses(_merged(spark, sf))


@query("compact_address", sql("addr", body=f"""
    WITH {MERGED}
    SELECT email, employee, list_aggregate(sources, 'string_agg', ',') AS sources, validation_status,
           confidence, is_catch_all FROM merged"""))
def _(spark, sf):
    return compact.compact_address(_merged(spark, sf)).withColumn(
        "sources", F.array_join("sources", ","))


# --- exposure checks --------------------------------------------------------------------------

def _checked(spark, sf):
    return joins.checked_addresses(views.addresses(spark, sf))


CHECKED = """
    last AS (SELECT tenant, email, arg_max(validation_status, seq) AS validation_status
             FROM addr GROUP BY 1, 2),
    checked AS (SELECT tenant, email, seq, last.validation_status
                FROM addr JOIN last USING (tenant, email) WHERE addr.validation_status <> 'unknown')"""


@query("checked_addresses", sql("addr", body=f"WITH {CHECKED} SELECT * FROM checked"))
def _(spark, sf):
    return _checked(spark, sf)


def _reports(spark, sf):
    """Events as report rows: the address stands in one of three fields."""
    p = views.persons(spark, sf)
    e = views.table(spark, sf, "events").join(p, C("c_custkey") == C("user_id"))
    address = F.concat("first_name", F.lit("."), "last_name", F.lit("@"), "tenant",
                       F.lit(".example.com"))
    t = C("event_type")
    return e.select(
        "event_id", "tenant", "event_type", C("props").alias("data"),
        F.when(t == "signup", address).otherwise("").alias("email"),
        F.when(t.isin("view", "signup"), address).alias("email_alt"),
        F.when(t == "click", address).when(t == "error", F.concat(address, F.lit("x")))
        .alias("input"))


REPORTS = """
    rep AS (SELECT event_id, tenant, event_type, props AS data,
                   CASE event_type WHEN 'purchase' THEN NULL ELSE first_name || '.' || last_name || '@'
                        || tenant || '.example.com' || CASE event_type WHEN 'error' THEN 'x' ELSE '' END
                   END AS email_key
            FROM events JOIN persons ON c_custkey = user_id),
    routed AS (SELECT *, coalesce((tenant, email_key) IN (SELECT (tenant, email) FROM checked), false)
                   AS matched FROM rep)"""


def _routed(spark, sf, checked=None):
    checked = _checked(spark, sf) if checked is None else checked
    return joins.route_reports(_reports(spark, sf), checked, ["email", "email_alt", "input"])


@query("route_reports", sql("addr", body=f"""
    WITH {CHECKED}, {REPORTS} SELECT event_id, tenant, email_key, matched FROM routed"""))
def _(spark, sf):
    return _routed(spark, sf).select("event_id", "tenant", "email_key", "matched")


def _elements(spark, sf, checked=None):
    routed = _routed(spark, sf, checked).where("matched").withColumn("email", C("email_key"))
    events = views.addresses(spark, sf).where("validation_status = 'risky'").select(
        "tenant", "email", F.lit("LEAKSITE_CONTENT").alias("type"),
        C("o_orderpriority").alias("data"))
    return joins.exposure_elements(events, routed)


ELEMENTS = """
    el AS (SELECT tenant, email, 'LEAKSITE_CONTENT' AS type, o_orderpriority AS data, 'spiderfoot' AS source
           FROM addr WHERE validation_status = 'risky'
           UNION ALL SELECT tenant, email_key, 'apify-breach', data, 'apify' FROM routed WHERE matched)"""


@query("exposure_elements", sql("addr", body=f"WITH {CHECKED}, {REPORTS}, {ELEMENTS} SELECT * FROM el"))
def _(spark, sf):
    return _elements(spark, sf)


EXPOSED = """
    exposed AS (SELECT c.*, coalesce(n, 0) AS n_exposures,
                       coalesce(n, 0) > 0 AND validation_status = 'smtp_inconclusive_catchall'
                           AS catchall_confirmed_by_breach
                FROM checked c LEFT JOIN (SELECT tenant, email, count(*) AS n FROM el GROUP BY 1, 2) x
                USING (tenant, email))"""


def _exposed(spark, sf):
    checked = written(_checked(spark, sf), "checked")
    return joins.attach_exposure(checked, _elements(spark, sf, checked))


@query("attach_exposure", sql("addr", body=f"""
    WITH {CHECKED}, {REPORTS}, {ELEMENTS}, {EXPOSED} SELECT * FROM exposed"""))
def _(spark, sf):
    return _exposed(spark, sf)


@query("exposure_stats", sql("addr", body=f"""
    WITH {CHECKED}, {REPORTS}, {ELEMENTS}, {EXPOSED}
    SELECT tenant, count(*) AS checked, count(*) FILTER (n_exposures > 0) AS exposed,
           count(*) FILTER (catchall_confirmed_by_breach) AS catchall_confirmed
    FROM exposed GROUP BY tenant"""))
def _(spark, sf):
    return report.exposure_stats(_exposed(spark, sf))
