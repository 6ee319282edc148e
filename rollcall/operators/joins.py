"""Enrichment joins and lookups.

Physical choices are left to Spark (a side is broadcast only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``), with the large side always on the left so that AQE can
split a hot key.  :func:`salted_join` is the explicit form for lookups on coarse keys such as
the tenant, where one key may hold a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.constants import (
    CATCH_ALL_STATUS,
    CLAIMED_STATUS,
    INFERRED_TAG,
    MENTION_MODULES,
    TARGET_TYPES,
    VALID_TARGET_STATUSES,
)
from rollcall.functions.addresses import (
    address_domain,
    checkable,
    fill_pattern,
    infrastructure_address,
    mailbox_domain,
    mentions_account,
    reachability_status,
    valid_address,
    verifier_status,
)
from rollcall.functions.hosts import denylisted, host_matches_name, infrastructure_host, valid_host
from rollcall.functions.names import capitalize, name_terms, person_parts
from rollcall.functions.text import first_truthy, let, strip_space

HOT_ROWS = 1_000_000
NULL_SALTS = 1024
SALTED_KINDS = ("left", "inner", "left_semi", "left_anti")


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread_by: str,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join whose hot keys are spread over tasks of about ``hot_rows`` rows each.

    Keys with more rows are found by a column-pruned count; there are at most rows / ``hot_rows``
    of them, and Spark broadcasts their list only while it is small.  A key gets as many salts as
    its count asks for, and its lookup rows are copied once per salt, which is why joins that keep
    unmatched lookup rows are refused.  Null keys match nothing and are spread as they are.
    ``spread_by`` must differ between rows of one key.  The count reads ``facts`` once more, so use
    it where ``facts`` is (close to) a scan.
    """
    if how not in SALTED_KINDS:
        raise ValueError(f"salted_join supports {', '.join(SALTED_KINDS)}, not {how}")
    hot = (
        facts.select(*on).groupBy(*on).agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= hot_rows)
        .select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )
    spread = F.xxhash64(spread_by)
    blank = F.lit(False)
    for key in on:
        blank = blank | F.col(key).isNull()
    left = facts.join(hot, on, "left").withColumn(
        "_salt", F.when(blank, -1 - F.pmod(spread, F.lit(NULL_SALTS)))
        .otherwise(F.coalesce(F.pmod(spread, F.col("_salts")), F.lit(0))).cast("int")
    ).drop("_salts")
    right = lookup.join(hot, on, "left").withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)),
    ).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


# --- organisations ----------------------------------------------------------------------------

def lexical_candidates(found: DataFrame, organisations: DataFrame, label_boundary: bool = False) -> DataFrame:
    """Distinct valid, not denied hosts that lexically match their tenant's name.

    ``found(tenant, host, seq)``; ``organisations(tenant, name, abbreviation)``.  Hosts are made
    distinct first, which also takes a hot host out of the join.
    """
    hosts = found.where(
        valid_host(F.col("host")) & ~denylisted(F.col("host"), label_boundary)
    ).select("tenant", "host").distinct()
    return hosts.join(organisations, "tenant").where(
        host_matches_name(F.col("host"), F.col("name"), F.col("abbreviation"))
    ).select("tenant", "host")


def documents_mentioning(documents: DataFrame, organisations: DataFrame) -> DataFrame:
    """``content_verified``: the whole lower-cased text has the tenant's name, domain or a word.

    A document belongs to a tenant, so this is an equi-join on it, not texts x terms.
    """
    terms = organisations.select(
        "tenant",
        F.filter(
            F.concat(F.array(F.lower("name"), F.lower("domain")), name_terms(F.col("name"))),
            lambda t: F.coalesce(t != "", F.lit(False)),
        ).alias("terms"),
    )
    joined = salted_join(documents, terms, ["tenant"], "seq")
    found = let(F.lower("text"), lambda low: F.exists("terms", lambda t: F.contains(low, t)))
    return joined.withColumn(
        "content_verified", F.coalesce(found, F.lit(False))
    ).drop("terms")


def personal_mailbox_domains(domains: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Domains confirmed to take personal mail, or not named like an infrastructure host.

    Only infrastructure-named domains need the lookup, so only they are joined.
    """
    infra = infrastructure_host(F.col("domain"))
    sure = confirmed.select("tenant", "domain").distinct()
    return domains.where(~infra).unionByName(
        domains.where(infra).join(sure, ["tenant", "domain"], "left_semi")
    )


# --- infrastructure ---------------------------------------------------------------------------

def merge_infrastructure(left: DataFrame, right: DataFrame, left_cols, right_cols) -> DataFrame:
    """Full outer merge per (tenant, domain) as one aggregation over the union.

    Each side has one row per key (they are maps), so each column has at most one value to take.
    A full outer join cannot be split when a key is hot; the union pre-aggregates instead.
    """
    cols = [*left_cols, *right_cols]
    have = dict(left.dtypes) | dict(right.dtypes)

    def side(df, mine):
        return df.select(
            "tenant", "domain",
            *[F.col(c) if c in mine else F.lit(None).cast(have[c]).alias(c) for c in cols],
        )

    return side(left, left_cols).unionByName(side(right, right_cols)).groupBy(
        "tenant", "domain"
    ).agg(*[F.any_value(c, F.lit(True)).alias(c) for c in cols])


def enrich_ips(ips: DataFrame, lookup: DataFrame, key: str = "ip") -> DataFrame:
    """Distinct addresses with what a supplied lookup knows; unknown ones keep nulls."""
    return ips.select(key).distinct().join(lookup, key, "left")


def catch_all_domains(addresses: DataFrame, probes: DataFrame) -> DataFrame:
    """Distinct address domains (after the LAST '@') that the supplied probes call catch-all."""
    domains = addresses.where(F.col("email").contains("@")).select(
        mailbox_domain(F.col("email")).alias("domain")
    ).distinct()
    return domains.join(probes.where("is_catch_all").select("domain").distinct(),
                        "domain", "left_semi")


def apply_catch_all(addresses: DataFrame, domains: DataFrame) -> DataFrame:
    """Addresses at a catch-all domain: status forced, confidence 0.

    The addresses are the outcome of a chain, so they are not counted first; the domains are few,
    Spark broadcasts them by their size, and AQE splits a hot domain on the left otherwise.
    """
    flagged = addresses.withColumn("_d", mailbox_domain(F.col("email"))).join(
        domains.select(F.col("domain").alias("_d"), F.lit(True).alias("_c")), "_d", "left")
    hit = F.coalesce("_c", F.lit(False))
    return (
        flagged
        .withColumn("validation_status",
                    F.when(hit, CATCH_ALL_STATUS).otherwise(F.col("validation_status")))
        .withColumn("confidence", F.when(hit, 0.0).otherwise(F.col("confidence")))
        .withColumn("is_catch_all", F.when(hit, True).otherwise(F.col("is_catch_all")))
        .drop("_d", "_c")
    )


def split_catch_all(addresses: DataFrame, confirmed: DataFrame) -> DataFrame:
    """``at_catch_all`` for each kept address: one flag, not two copies of the data.

    The addresses are the outcome of a long chain, so they are not counted first as
    :func:`salted_join` would do; AQE splits a hot domain on the left of this join.
    """
    keyed = addresses.withColumn("_d", address_domain(F.col("email")))
    flags = confirmed.where("confirmed_catch_all").select(
        "tenant", F.col("domain").alias("_d"), F.lit(True).alias("_c")
    ).distinct()
    return keyed.join(flags, ["tenant", "_d"], "left").withColumn(
        "at_catch_all", F.coalesce("_c", F.lit(False))
    ).drop("_d", "_c")


# --- checked addresses ------------------------------------------------------------------------

def checked_addresses(validated: DataFrame) -> DataFrame:
    """Addresses worth an exposure check, duplicates kept, each with the LAST status on record."""
    last = validated.where(F.col("email") != "").groupBy("tenant", "email").agg(
        F.max_by("validation_status", "seq").alias("validation_status")
    )
    wanted = validated.where(
        (F.col("email") != "") & checkable(F.col("validation_status"))
    ).select("tenant", "email", "seq")
    return wanted.join(last, ["tenant", "email"], "left")


def route_reports(reports: DataFrame, checked: DataFrame, fields: list[str]) -> DataFrame:
    """``email_key`` of each report (first non-blank of its address fields), ``matched`` or not.

    Unmatched reports stay, with ``matched`` false: they are the warnings.
    """
    keyed = reports.withColumn(
        "email_key", first_truthy(*[F.col(f) for f in fields])
    )
    known = checked.select("tenant", F.col("email").alias("email_key"),
                           F.lit(True).alias("_m")).distinct()
    return keyed.join(known, ["tenant", "email_key"], "left").withColumn(
        "matched", F.coalesce("_m", F.lit(False))
    ).drop("_m")


def exposure_elements(events: DataFrame, reports: DataFrame) -> DataFrame:
    """One row per exposure: events as found, reports wrapped under a fixed type."""
    return events.select(
        "tenant", "email", "type", "data", F.lit("spiderfoot").alias("source")
    ).unionByName(reports.select(
        "tenant", "email", F.lit("apify-breach").alias("type"), "data",
        F.lit("apify").alias("source"),
    ))


def mention_elements(events: DataFrame) -> DataFrame:
    """One row per mention: the event with the target that triggered it and the module list."""
    return events.select(
        "tenant", "target", "target_type", "type", "data",
        F.lit(MENTION_MODULES).alias("module_hint"),
        F.col("target").alias("triggering_target"),
    )


def attach_exposure(checked: DataFrame, elements: DataFrame) -> DataFrame:
    """Checked addresses with exposure counts and the catch-all confirmation."""
    n = elements.groupBy("tenant", "email").agg(F.count("*").alias("n_exposures"))
    out = checked.join(n, ["tenant", "email"], "left").withColumn(
        "n_exposures", F.coalesce("n_exposures", F.lit(0).cast("bigint"))
    )
    return out.withColumn(
        "catchall_confirmed_by_breach",
        (F.col("n_exposures") > 0)
        & F.coalesce(F.col("validation_status") == CATCH_ALL_STATUS, F.lit(False)),
    )


def resolve_precedence(
    addresses: DataFrame, primary: DataFrame, second: DataFrame, third: DataFrame,
    whole_word: bool = False,
) -> DataFrame:
    """Status of each address from three result tables in order of trust.

    ``primary(email, is_reachable, is_catch_all)`` decides when conclusive; else
    ``second(email, status, accept_all)`` when its word maps to anything but unknown; else the
    text of ``third(email, output)``, whose result replaces the row's wholly.  Each table has at
    most one row per address.
    """
    p = primary.select("email", "is_reachable", F.col("is_catch_all").alias("_pc"))
    s = second.select("email", F.col("status").alias("_ss"), "accept_all")
    t = third.select("email", F.col("output").alias("_to"))
    j = addresses.join(p, "email", "left").join(s, "email", "left").join(t, "email", "left")
    first = reachability_status(F.col("is_reachable"))
    hunted = verifier_status(F.col("_ss"))
    conclusive = F.coalesce(F.col("is_reachable").isin("safe", "risky", "invalid"), F.lit(False))
    known = F.col("_ss").isNotNull() & (hunted["status"] != "unknown")
    told = mentions_account(F.col("_to"), whole_word)
    pc = F.coalesce("_pc", F.lit(False))
    return j.select(
        *addresses.columns,
        F.when(conclusive, first["status"]).when(known, hunted["status"])
        .when(told, "deliverable").otherwise("unknown").alias("validation_status"),
        F.when(conclusive, first["confidence"]).when(known, hunted["confidence"])
        .when(told, 0.8).otherwise(0.0).alias("confidence"),
        F.when(conclusive, pc).when(known, pc | F.coalesce("accept_all", F.lit(False)))
        .otherwise(False).alias("is_catch_all"),
        F.when(~conclusive & known, "hunter_verifier").alias("fallback_source"),
    )


# --- people and addresses ---------------------------------------------------------------------

def expected_local_parts(people: DataFrame, patterns: DataFrame) -> DataFrame:
    """Local parts each person's name gives under the tenant's patterns; the last person wins.

    Linear in people (a tenant has at most five patterns, packed into one row); names are not
    folded, so names with accents give addresses that no valid address equals.
    """
    packed = patterns.groupBy("tenant").agg(
        F.array_sort(F.collect_set("pattern")).alias("patterns")
    )
    parts = people.withColumn(
        "_n", person_parts(F.col("first_name"), F.col("last_name"), F.col("name"))
    ).where(F.col("_n").isNotNull())
    spread = salted_join(parts, packed, ["tenant"], "seq", "inner").select(
        "tenant", "seq", "_n", F.explode("patterns").alias("pattern")
    )
    n = F.col("_n")
    return spread.select(
        "tenant",
        fill_pattern(F.col("pattern"), n["first"], n["last"]).alias("local_part"),
        F.concat(capitalize(n["first"]), F.lit(" "), capitalize(n["last"])).alias("employee"),
        "seq",
    ).groupBy("tenant", "local_part").agg(F.max_by("employee", "seq").alias("employee"))


def reconcile_expected(inventory: DataFrame, expected: DataFrame) -> DataFrame:
    """Observed addresses that a person's name explains: tagged, and given that person.

    The join is on (tenant, local part) against what was OBSERVED; people are never multiplied
    by domains.  Infrastructure hosts are not expected to hold personal mailboxes.
    """
    keyed = inventory.withColumn("local_part", F.substring_index("email", "@", 1))
    hit = F.col("_e").isNotNull() & ~infrastructure_address(F.col("email")) \
        & valid_address(F.col("email"))
    return keyed.join(
        expected.withColumnRenamed("employee", "_e"), ["tenant", "local_part"], "left"
    ).select(
        "tenant", "email",
        F.when(hit, F.col("_e")).alias("employee"),
        F.when(hit, F.array_sort(F.array_union("sources", F.array(F.lit(INFERRED_TAG)))))
        .otherwise(F.array_sort("sources")).alias("sources"),
    )


def attach_profiles(people: DataFrame, profiles: DataFrame, keys: list[str]) -> DataFrame:
    """Every person with a list of extra profiles, empty when there is none."""
    out = people.join(profiles, keys, "left")
    empty = F.array().cast(dict(out.dtypes)["additional_profiles"])
    return out.withColumn("additional_profiles", F.coalesce("additional_profiles", empty))


def profile_hits(hits: DataFrame) -> DataFrame:
    """``hits(tenant, person, pattern, site, url, status)``: claimed hits per person and pattern.

    A person has a few patterns and a pattern one hit per known site, so the sets are bounded by
    the list of sites and partly merged before the shuffle.
    """
    return hits.where(F.col("status") == CLAIMED_STATUS).groupBy(
        "tenant", "person", "pattern"
    ).agg(F.array_sort(F.collect_set(F.struct("site", "url"))).alias("platforms"))


def merge_metadata(left: Column, right: Column) -> Column:
    """Union of two maps, the right one wins on a shared key."""
    return F.map_zip_with(
        left, right, lambda k, a, b: F.when(F.map_contains_key(right, k), b).otherwise(a)
    )


# --- targets ----------------------------------------------------------------------------------

def valid_targets(domains: DataFrame) -> DataFrame:
    """Domains whose status is absent or one of the accepted words (mention lookups)."""
    status = first_truthy(F.col("status"), F.col("validation_status"))
    return domains.where(
        (F.col("domain") != "") & (status.isNull() | status.isin(*VALID_TARGET_STATUSES))
    )


def not_refused_targets(domains: DataFrame) -> DataFrame:
    """Domains not explicitly marked as failing validation (address checks)."""
    return domains.where((F.col("domain") != "") & F.coalesce("validated", F.lit(True)))


def scan_targets(domains: DataFrame, organisations: DataFrame, people: DataFrame) -> DataFrame:
    """Everything to look mentions up for: domains, the organisation, its people."""
    named = people.withColumn("_n", F.coalesce(
        F.nullif(F.col("full_name"), F.lit("")),
        F.nullif(strip_space(F.concat_ws(" ", "first_name", "last_name")), F.lit("")),
    )).where(F.col("_n").isNotNull())

    def tagged(df, column, kind):
        return df.select("tenant", F.col(column).alias("target"),
                         F.lit(TARGET_TYPES[kind]).alias("target_type"))

    return (
        tagged(domains, "domain", "domain")
        .unionByName(tagged(organisations, "name", "company"))
        .unionByName(tagged(named, "_n", "person"))
    )
