"""Counts, best candidates and audit rows: the queries behind a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.constants import (
    DOCUMENTS_NOT_USABLE,
    EXCLUSION_LABELS,
    FILTER_MEASURES,
    NO_MENTIONS_NOTE,
    STAT_STATUSES,
    SUMMARY_LABELS,
    TIER_LABELS,
)
from rollcall.functions.addresses import address_domain, local_part_rank
from rollcall.functions.names import capitalize
from rollcall.functions.text import first_truthy


def dashed(c: Column) -> Column:
    """'-' for blank."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("-"))


# --- rows -------------------------------------------------------------------------------------

def domain_rows(df: DataFrame) -> DataFrame:
    return df.where("keep").select(
        "tenant", "domain", F.array_join("sources", ", ").alias("sources"),
        F.when(F.coalesce("dns_validated", F.lit(False)), "Yes").otherwise("No")
        .alias("dns_validated"),
        F.coalesce("note", F.lit("")).alias("note"),
    )


def address_rows(df: DataFrame) -> DataFrame:
    return df.where("keep").select(
        "tenant", F.coalesce("email", F.lit("")).alias("email"),
        dashed(F.col("employee")).alias("employee"),
        F.coalesce("validation_status", F.lit("-")).alias("validation_status"),
        F.coalesce("tier", F.lit("-")).alias("tier"),
    )


def usable_documents(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce("summary", F.lit("")) != "")


def errored_documents(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce("error", F.lit("")) != "")


def document_rows(df: DataFrame) -> DataFrame:
    return usable_documents(df).select(
        "tenant", "filename", "source_domain", dashed(F.col("url")).alias("url"),
        capitalize(dashed(F.col("usability"))).alias("usability"),
        dashed(F.col("summary")).alias("summary"),
    )


def exposure_rows(df: DataFrame) -> DataFrame:
    return df.where("keep").select(
        "tenant", "email", F.array_join("services", ", ").alias("services"),
        dashed(F.col("exposure_summary")).alias("exposure_summary"),
    )


def genuine_mentions(df: DataFrame) -> DataFrame:
    """Kept targets that are not merely without mentions."""
    return df.where(
        F.col("keep") & (F.coalesce("note", F.lit("")) != NO_MENTIONS_NOTE)
    )


def mention_rows(df: DataFrame) -> DataFrame:
    return genuine_mentions(df).select(
        "tenant", "target", "target_type",
        dashed(F.col("exposure_summary")).alias("exposure_summary"),
    )


def person_rows(df: DataFrame) -> DataFrame:
    """Kept people in tier order, then in input order."""
    tier = F.coalesce(first_truthy(F.col("employee_tier"), F.col("tier")), F.lit(""))
    rank = tier_sort_rank(tier)
    label = None
    for name, shown in TIER_LABELS.items():
        label = (F if label is None else label).when(tier == name, F.lit(shown))
    return df.where("keep").select(
        "tenant", "seq", "name", rank.alias("rank"), label.otherwise(tier).alias("tier_label")
    ).orderBy("rank", "seq")


def tier_sort_rank(tier: Column) -> Column:
    out = None
    for i, name in enumerate(TIER_LABELS):
        out = (F if out is None else out).when(tier == name, i)
    return out.otherwise(len(TIER_LABELS))


# --- best candidate ---------------------------------------------------------------------------

def best_addresses(kept: DataFrame) -> DataFrame:
    """Per (domain, employee) the address with the preferred local part, earliest on ties."""
    order = F.struct(local_part_rank(F.col("email")).alias("r"), F.col("seq"))
    return kept.select(
        "tenant", address_domain(F.col("email")).alias("domain"),
        dashed(F.col("employee")).alias("employee"),
        F.coalesce("email", F.lit("")).alias("email"), "seq",
    ).groupBy("tenant", "domain", "employee").agg(F.min_by("email", order).alias("email"))


def catch_all_notes(kept: DataFrame) -> DataFrame:
    """Candidates per confirmed catch-all domain."""
    return kept.where("at_catch_all").groupBy(
        "tenant", address_domain(F.col("email")).alias("domain")
    ).agg(F.count("*").alias("candidates"))


# --- counts -----------------------------------------------------------------------------------

def validation_stats(addresses: DataFrame) -> DataFrame:
    """Per tenant one count per known status, zeros included, and failed connections."""
    return addresses.groupBy("tenant").agg(
        *[F.count_if(F.col("validation_status") == s).alias(s) for s in STAT_STATUSES],
        F.count_if("smtp_connect_failed").alias("smtp_connect_failures"),
    )


def exposure_stats(checked: DataFrame) -> DataFrame:
    return checked.groupBy("tenant").agg(
        F.count("*").alias("checked"),
        F.count_if(F.col("n_exposures") > 0).alias("exposed"),
        F.count_if("catchall_confirmed_by_breach").alias("catchall_confirmed"),
    )


def mention_stats(targets: DataFrame) -> DataFrame:
    return targets.groupBy("tenant").agg(
        F.count("*").alias("checked"), F.count_if(F.col("n") > 0).alias("with_mentions")
    )


def document_stats(documents: DataFrame) -> DataFrame:
    return documents.groupBy("tenant").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("discovery_method") == "metagoofil").alias("metagoofil"),
        F.count_if(F.col("discovery_method") == "apify-google").alias("apify_google"),
        F.count_if("content_verified").alias("content_verified"),
    )


def long_counts(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """(tenant, measure, value): one aggregation, then one row per measure."""
    wide = df.groupBy("tenant").agg(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
    rows = F.array(*[
        F.struct(F.lit(name).alias("measure"), F.col(f"m{i}").cast("bigint").alias("value"))
        for i, name in enumerate(measures)
    ])
    return wide.select("tenant", F.inline(rows))


def run_counts(entities: dict[str, DataFrame]) -> DataFrame:
    """The measures of a run per tenant, over whichever entity tables are given."""
    n = F.count("*")

    def tier(name):
        return F.count_if(F.col("employee_tier") == name)

    measures = {
        "domains": {"Domains": n},
        "emails": {
            "Emails": n,
            "deliverable": F.count_if(F.col("validation_status") == "deliverable"),
        },
        "email_domains": {"catch-all domains": F.count_if("confirmed_catch_all")},
        "documents": {
            "Documents": n,
            "found on disk": F.count_if("file_exists"),
            "content verified": F.count_if("content_verified"),
        },
        "employees": {
            "Employees": n,
            **{t: tier(t) for t in (*TIER_LABELS, "reject")},
        },
        "breaches": {"Breach records": n},
        "darkweb": {
            "Dark web targets scanned": n,
            "with mentions found": F.count_if(F.col("n") > 0),
        },
        "infrastructure_raw": {"Infrastructure raw targets": n},
        "dns_infra_raw": {"DNS infra raw targets": n},
    }
    out = None
    for name, df in entities.items():
        part = long_counts(df, measures[name])
        out = part if out is None else out.unionByName(part)
    return out


def filter_stats(shaped: DataFrame) -> DataFrame:
    """(tenant, measure, value): kept and excluded per category, from the fixed output shape."""
    n = shaped.groupBy("tenant", "category").agg(
        F.count_if("keep").alias("_k"), F.count_if(~F.col("keep")).alias("_x")
    )
    return n.select("tenant", F.inline(F.array(
        F.struct(F.concat("category", F.lit("_kept")).alias("measure"), F.col("_k").alias("value")),
        F.struct(F.concat("category", F.lit("_excluded")).alias("measure"),
                 F.col("_x").alias("value")),
    )))


def filter_measures(
    shaped: DataFrame, targets: DataFrame, documents: DataFrame, warnings: DataFrame
) -> DataFrame:
    """(tenant, measure, value): all measures of a filter run, zeros included.

    Every countable row gives the measure it counts for, and one aggregation counts them all;
    ``targets`` has the number of mentions ``n``.
    """
    kept = F.concat("category", F.when(F.col("keep"), "_kept").otherwise("_excluded"))
    hits = shaped.select("tenant", kept.alias("measure"))
    for df, measure in (
        (targets.where(F.col("n") > 0), "darkweb_with_mentions"),
        (documents.where(F.coalesce("summary", F.lit("")) != ""), "documents_summarized"),
        (errored_documents(documents), "documents_errored"),
        (warnings, "warning_count"),
    ):
        hits = hits.unionByName(df.select("tenant", F.lit(measure).alias("measure")))
    return long_counts(hits, {m: F.count_if(F.col("measure") == m) for m in FILTER_MEASURES})


def document_filter_stats(documents: DataFrame) -> DataFrame:
    return long_counts(documents, {
        "documents_summarized": F.count_if(F.coalesce("summary", F.lit("")) != ""),
        "documents_errored": F.count_if(F.coalesce("error", F.lit("")) != ""),
    })


def summary_table(stats: DataFrame) -> DataFrame:
    """The labelled counts of the summary, measures without a count left out."""
    label = None
    for key, shown in SUMMARY_LABELS:
        label = (F if label is None else label).when(F.col("measure") == key, F.lit(shown))
    return stats.withColumn("label", label).where(F.col("label").isNotNull()).select(
        "tenant", "label", "value"
    )


def _exclusion_label() -> Column:
    label = None
    for key, shown in EXCLUSION_LABELS:
        label = (F if label is None else label).when(F.col("category") == key, F.lit(shown))
    return label


def _excluded(shaped: DataFrame) -> DataFrame:
    return shaped.where(~F.col("keep")).withColumn("label", _exclusion_label()).where(
        F.col("label").isNotNull()
    )


def excluded_rows(shaped: DataFrame) -> DataFrame:
    """Every excluded record with its reason: note, else tier, else '-'."""
    return _excluded(shaped).select(
        "tenant", "label", F.coalesce("identifier", F.lit("-")).alias("identifier"),
        F.coalesce(first_truthy(F.col("note"), F.col("tier")), F.lit("-")).alias("reason"),
    )


def audit_log(shaped: DataFrame, documents: DataFrame, warnings: DataFrame) -> DataFrame:
    """Excluded records, unusable documents and warnings as one table of (label, id, reason)."""
    bad = errored_documents(documents).select(
        "tenant", F.lit(DOCUMENTS_NOT_USABLE).alias("label"),
        F.coalesce("filename", F.lit("")).alias("identifier"), F.col("error").alias("reason"),
    )
    warned = warnings.select(
        "tenant", F.lit("Pipeline Warnings").alias("label"), "identifier",
        F.col("warning").alias("reason"),
    )
    return excluded_rows(shaped).unionByName(bad).unionByName(warned)


def audit_labels(shaped: DataFrame, documents: DataFrame, warned: DataFrame) -> DataFrame:
    """(tenant, label) for the counts of the audit log, which need no reason and no identifier.

    Warnings count for no exclusion label, but their tenants have counts: ``warned`` names each of
    these tenants, however often.
    """
    return _excluded(shaped).select("tenant", "label").unionByName(
        errored_documents(documents).select("tenant", F.lit(DOCUMENTS_NOT_USABLE).alias("label"))
    ).unionByName(warned.select("tenant", F.lit("Pipeline Warnings").alias("label")))


def exclusion_counts(audit: DataFrame) -> DataFrame:
    """Rows per tenant and exclusion label, zeros included; of the log it reads tenant and label."""
    labels = [shown for _, shown in EXCLUSION_LABELS] + [DOCUMENTS_NOT_USABLE]
    return long_counts(audit, {name: F.count_if(F.col("label") == name) for name in labels})
