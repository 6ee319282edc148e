"""Deduplication on natural keys.

Order matters everywhere here, so each input carries ``seq``, the place of the observation.  The
winners are picked by ``min_by``/``max_by``: partial aggregation shrinks a hot key to one row per
task before anything is shuffled.  Unions of unbounded lists come back as one row per element
(key, element, first place) rather than as one array per key, so a hot key never has to fit
into one task; only source tags, whose vocabulary is the handful of tools, are packed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.constants import CATCH_ALL_STATUS, ROLE_TAG, ROOT_SOURCE, STANDARD_PATTERNS
from rollcall.functions.addresses import (
    address_in_domain,
    inferred_pattern,
    normalize_address,
    raw_address_domain,
    role_addresses,
    valid_address,
)
from rollcall.functions.hosts import infrastructure_host, normalize_host, valid_host
from rollcall.functions.names import dedup_key
from rollcall.functions.text import first_truthy
from rollcall.functions.variants import canonical


# --- generic forms ----------------------------------------------------------------------------

def _pick(df: DataFrame, keys: list[str], picked: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(picked.alias("_w")).select(
        *keys, *[F.col("_w").getField(c).alias(c) for c in rest]
    ).select(*df.columns)


def _payload(df: DataFrame, keys: list[str]) -> Column:
    return F.struct(*[c for c in df.columns if c not in keys])


def last_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The latest row of each key."""
    return _pick(df, keys, F.max_by(_payload(df, keys), F.col(seq)))


def first_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The earliest row of each key."""
    return _pick(df, keys, F.min_by(_payload(df, keys), F.col(seq)))


def preferred_first(df: DataFrame, keys: list[str], preferred: Column, seq: str) -> DataFrame:
    """The earliest preferred row of each key, else the earliest row."""
    order = F.struct((~F.coalesce(preferred, F.lit(False))).alias("late"), F.col(seq))
    return _pick(df, keys, F.min_by(_payload(df, keys), order))


def union_tags(tag: Column) -> Column:
    """Sorted distinct tags; the vocabulary of tags is small, whatever the data."""
    return F.array_sort(F.collect_set(tag))


def distinct_elements(df: DataFrame, keys: list[str], elements: str, seq: str) -> DataFrame:
    """Distinct elements per key with the place each was first seen: one row per element.

    ``elements`` is an array of JSON texts; equality ignores the order of object keys.  Repeats
    inside one array go first, so the rest is a hash aggregation over plain numbers:
    ``first_pos`` counts the distinct elements of the array.
    """
    flat = df.select(*keys, F.col(seq).alias("_s"), F.posexplode(
        F.array_distinct(F.transform(elements, canonical))).alias("_p", "element"))
    return flat.groupBy(*keys, "element").agg(
        F.min("_s").alias("first_seq"), F.min_by("_p", "_s").alias("first_pos")
    )


def first_elements(elements: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` elements of each key, packed in order; ``k`` bounds every group."""
    w = Window.partitionBy(*keys).orderBy("first_seq", "first_pos")
    top = elements.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k)
    packed = F.array_sort(F.collect_list(F.struct("_n", "element")))
    return top.groupBy(*keys).agg(
        F.transform(packed, lambda s: s.getField("element")).alias("elements")
    )


# --- hosts ------------------------------------------------------------------------------------

def merge_domains(candidates: DataFrame, validated: DataFrame, keys=("tenant", "domain")) -> DataFrame:
    """Sorted union of sources per domain, and whether the validated list had it."""
    keys = list(keys)
    cols = [*keys, "sources"]
    both = candidates.select(*cols, F.lit(False).alias("_v")).unionByName(
        validated.select(*cols, F.lit(True).alias("_v"))
    )
    return (
        both.where(F.col("domain") != "")
        .select(*keys, "_v", F.explode_outer("sources").alias("_s"))
        .groupBy(*keys)
        .agg(union_tags(F.col("_s")).alias("sources"), F.bool_or("_v").alias("dns_validated"))
    )


def collect_candidates(targets: DataFrame, found: DataFrame) -> DataFrame:
    """Candidate hosts with sorted sources: targets as they are, tool finds once normalised.

    ``targets(tenant, domain)``; ``found(tenant, raw_host, tool)``.
    """
    roots = targets.select("tenant", "domain", F.lit(ROOT_SOURCE).alias("tool"))
    finds = found.select(
        "tenant", normalize_host(F.col("raw_host")).alias("domain"), "tool"
    ).where(valid_host(F.col("domain")))
    return roots.unionByName(finds).groupBy("tenant", "domain").agg(
        union_tags(F.col("tool")).alias("sources")
    )


def candidate_counts(found: DataFrame, candidates: DataFrame) -> DataFrame:
    """Raw finds (distinct per target and tool, as the tools report sets) and unique hosts."""
    raw = found.select("tenant", "raw_host", "tool").distinct().groupBy("tenant").agg(
        F.count("*").alias("n"))
    uniq = candidates.groupBy("tenant").agg(F.count("*").alias("n"))
    return (
        raw.select("tenant", F.col("n").alias("r"), F.lit(0).cast("bigint").alias("u"))
        .unionByName(uniq.select("tenant", F.lit(0).cast("bigint").alias("r"), F.col("n").alias("u")))
        .groupBy("tenant")
        .agg(F.sum("r").alias("raw_candidates"), F.sum("u").alias("unique_candidates"))
    )


def keep_resolved(candidates: DataFrame, resolved: DataFrame, keys=("domain",)) -> DataFrame:
    """Candidates on the supplied list of resolving hosts, sources sorted."""
    live = resolved.select(*keys).distinct()
    return candidates.join(live, list(keys), "left_semi").withColumn(
        "sources", F.array_sort("sources")
    )


def merge_subdomains(found: DataFrame) -> DataFrame:
    """``found(tenant, parent, subdomain, tool)`` -> sorted distinct tools per subdomain."""
    return found.groupBy("tenant", "parent", "subdomain").agg(
        union_tags(F.col("tool")).alias("sources")
    )


def subdomain_stats(merged: DataFrame, tools: dict[str, str]) -> DataFrame:
    """Per parent: all subdomains, and those each tool saw (column name -> tool)."""
    return merged.groupBy("tenant", "parent").agg(
        F.count("*").alias("total"),
        *[F.count_if(F.array_contains("sources", t)).alias(c) for c, t in tools.items()],
    )


def hosts_per_ip(edges: DataFrame, keys=("tenant", "ip"), seq: str = "seq") -> DataFrame:
    """Distinct host names per address with the place each was first seen, one row per host."""
    return edges.groupBy(*keys, "hostname").agg(F.min(seq).alias("first_seq"))


# --- addresses --------------------------------------------------------------------------------

def merge_addresses(candidates: DataFrame, validated: DataFrame) -> DataFrame:
    """One row per (tenant, address): last candidate row, overridden field by field.

    The validated side overrides a field whenever it has one (null stands for absent), in order;
    its sources are added.  Candidate duplicates replace one another, sources included.  Both
    sides go through ONE aggregation: no join, one shuffle, partial merge before it.
    """
    cols = ["employee", "sources", "validation_status", "confidence", "is_catch_all"]

    def side(df: DataFrame, is_validated: bool) -> DataFrame:
        have = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols]
        return df.select(
            "tenant", normalize_address(F.col("email")).alias("email"), "seq",
            *have, F.lit(is_validated).alias("_v"),
        )

    both = side(candidates, False).unionByName(side(validated, True))
    v, c = F.col("_v"), F.col("seq")

    def latest(name: str) -> Column:
        return F.max_by(name, F.when(v & F.col(name).isNotNull(), c))

    merged = both.where(F.col("email") != "").groupBy("tenant", "email").agg(
        F.max_by(F.struct("employee", "sources"), F.when(~v, c)).alias("_cand"),
        F.collect_set(F.when(v, F.col("sources"))).alias("_extra"),
        *[latest(n).alias("_" + n) for n in cols if n != "sources"],
    )
    none = F.array().cast("array<string>")
    return merged.select(
        "tenant", "email",
        F.coalesce("_employee", "_cand.employee").alias("employee"),
        F.when(F.size("_extra") == 0, F.array_sort(F.coalesce("_cand.sources", none)))
        .otherwise(F.array_sort(F.concat(
            F.coalesce("_cand.sources", none),
            F.array_except(F.flatten("_extra"), F.coalesce("_cand.sources", none)),
        ))).alias("sources"),
        F.coalesce("_validation_status", F.lit("unknown")).alias("validation_status"),
        F.coalesce("_confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce("_is_catch_all", F.lit(False)).alias("is_catch_all"),
    )


def address_order() -> list[Column]:
    """Deliverable first, then confidence, then the address."""
    return [
        F.when(F.col("validation_status") == "deliverable", 0).otherwise(1),
        F.coalesce("confidence", F.lit(0.0)).desc(),
        F.col("email"),
    ]


def summarize_address_domains(addresses: DataFrame) -> DataFrame:
    """Per domain (after the first '@'): candidates, confirmed catch-all, infrastructure host."""
    flag = (F.col("validation_status") == CATCH_ALL_STATUS) | F.col("is_catch_all")
    return (
        addresses.withColumn("domain", raw_address_domain(F.col("email")))
        .where(F.col("domain").isNotNull())
        .groupBy("tenant", "domain")
        .agg(
            F.count("*").alias("candidate_count"),
            F.coalesce(F.bool_or(flag), F.lit(False)).alias("confirmed_catch_all"),
        )
        .withColumn("is_infrastructure_hostname", infrastructure_host(F.col("domain")))
    )


def address_inventory(found: DataFrame) -> DataFrame:
    """``found(tenant, target, email, tool)``: valid addresses of the target, tools united."""
    email = normalize_address(F.col("email"))
    return (
        found.withColumn("email", email)
        .where(address_in_domain(F.col("email"), F.col("target")) & valid_address(F.col("email")))
        .groupBy("tenant", "email")
        .agg(union_tags(F.col("tool")).alias("sources"))
    )


def observed_patterns(inventory: DataFrame, targets: DataFrame) -> DataFrame:
    """Naming patterns per tenant: those seen at a target domain plus the standard ones."""
    at_target = (
        inventory.select("tenant", "email", raw_address_domain(F.col("email")).alias("domain"))
        .where(F.col("domain").isNotNull())
        .join(targets.select("tenant", "domain").distinct(), ["tenant", "domain"], "left_semi")
        .select("tenant", inferred_pattern(F.col("email")).alias("pattern"))
    )
    standard = targets.select("tenant").distinct().select(
        "tenant", F.explode(F.array(*map(F.lit, STANDARD_PATTERNS))).alias("pattern")
    )
    return at_target.unionByName(standard).distinct()


def role_inventory(inventory: DataFrame, targets: DataFrame) -> DataFrame:
    """Inventory with the role mailboxes of every target that is no infrastructure host.

    A mailbox already known only gains the tag.
    """
    roles = (
        targets.where(~infrastructure_host(F.col("domain")))
        .select("tenant", F.explode(role_addresses(F.col("domain"))).alias("email"))
        .where(valid_address(F.col("email")))
        .select("tenant", "email", F.array(F.lit(ROLE_TAG)).alias("sources"))
    )
    return (
        inventory.select("tenant", "email", "sources").unionByName(roles)
        .select("tenant", "email", F.explode("sources").alias("_s"))
        .groupBy("tenant", "email")
        .agg(union_tags(F.col("_s")).alias("sources"))
    )


# --- documents --------------------------------------------------------------------------------

def merge_documents(documents: DataFrame) -> DataFrame:
    """One row per (tenant, domain, file name): the earliest verified, else the earliest."""
    named = documents.where(F.col("filename") != "").withColumn(
        "source_domain", F.coalesce("source_domain", F.lit(""))
    )
    return preferred_first(
        named, ["tenant", "source_domain", "filename"], F.col("content_verified"), "seq"
    )


def merge_document_methods(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of the first method; of the second, the earliest row of each NEW file name."""
    keys = ["tenant", "filename"]
    fresh = second.join(first.select(*keys).distinct(), keys, "left_anti")
    return first.unionByName(first_wins(fresh, keys, "seq"))


# --- people -----------------------------------------------------------------------------------

def person_key() -> Column:
    return first_truthy(F.col("public_identifier"), F.col("linkedin_url"), F.col("name"))


def merge_people(people: DataFrame) -> DataFrame:
    """Last row of each person, with the place the person was first seen (for stable order)."""
    keyed = people.withColumn("person_key", person_key()).where(
        F.col("person_key").isNotNull()
    )
    rest = [c for c in keyed.columns if c not in ("tenant", "person_key")]
    return keyed.groupBy("tenant", "person_key").agg(
        F.max_by(F.struct(*rest), "seq").alias("_w"), F.min("seq").alias("first_seq")
    ).select("tenant", "person_key", *[F.col("_w").getField(c).alias(c) for c in rest], "first_seq")


def people_order() -> list[Column]:
    """By name, then by first appearance."""
    return [F.coalesce("name", F.lit("")), F.col("first_seq")]


def fall_back_to_raw(enriched: DataFrame, raw: DataFrame) -> DataFrame:
    """Raw rows only of tenants that have no enriched row at all."""
    have = enriched.select("tenant").distinct()
    return raw.join(have, "tenant", "left_anti")


def dedup_people(people: DataFrame) -> DataFrame:
    """First row of each identity (public id, else URL, else name)."""
    key = dedup_key(
        F.col("public_identifier"), F.col("linkedin_url"),
        F.col("linkedin_profile_url"), F.col("name"),
    )
    return first_wins(people.withColumn("identity", key), ["tenant", "identity"], "seq")


# --- exposures and mentions -------------------------------------------------------------------

def merge_exposures(observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(addresses with sorted services, distinct exposure elements) of exposure rows.

    ``observed(tenant, email, breaches array<string>, services_checked, service, seq)`` with
    elements as JSON text.
    """
    rows = observed.withColumn("email", normalize_address(F.col("email"))).where(
        F.col("email") != ""
    )
    services = F.coalesce(
        "services_checked", F.array(F.nullif(F.col("service"), F.lit("")))
    )
    heads = rows.select("tenant", "email", F.explode_outer(services).alias("_s")).groupBy(
        "tenant", "email"
    ).agg(union_tags(F.nullif(F.col("_s"), F.lit(""))).alias("services"))
    return heads, distinct_elements(rows, ["tenant", "email"], "breaches", "seq")


def merge_mentions(observed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(targets with sorted modules, distinct mention elements) of mention rows."""
    keys = ["tenant", "target", "target_type"]
    rows = observed.where((F.col("target") != "") & (F.col("target_type") != ""))
    heads = rows.select(*keys, F.explode_outer("modules_checked").alias("_m")).groupBy(
        *keys
    ).agg(union_tags(F.col("_m")).alias("modules_checked"))
    return heads, distinct_elements(rows, keys, "mentions", "seq")


def mention_counts(heads: DataFrame, elements: DataFrame, keys: list[str]) -> DataFrame:
    """Heads with the number of their distinct elements (0 when none)."""
    n = elements.groupBy(*keys).agg(F.count("*").alias("n"))
    return heads.join(n, keys, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


