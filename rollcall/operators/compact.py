"""Small views of records: what a scorer or a reader gets to see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.constants import BREACH_REPORT_FIELDS, DETAIL_FIELDS, REPORT_FIELDS
from rollcall.functions.text import first_truthy
from rollcall.functions.variants import as_list, kind, text_of

def compact_domain(df: DataFrame) -> DataFrame:
    return df.select("domain", "sources", "dns_validated")


def compact_address(df: DataFrame) -> DataFrame:
    return df.select(
        "email", "employee", "sources", "validation_status", "confidence", "is_catch_all"
    )


def slim_addresses(df: DataFrame) -> DataFrame:
    return df.select("tenant", "email", "employee", "validation_status", "confidence")


def slim_documents(df: DataFrame) -> DataFrame:
    return df.select("tenant", "filename", "filepath", "file_exists", "source_domain")


def slim_people(df: DataFrame) -> DataFrame:
    return df.select("tenant", "name", "job_title", "linkedin_url", "additional_profiles",
                     "matched_domain", "employee_tier")


def slim_mentions(counts: DataFrame) -> DataFrame:
    """Targets that have mentions, with their number."""
    return counts.where(F.col("n") > 0).select(
        "tenant", "target", "target_type", F.col("n").alias("mention_count")
    )


def _first(items: Column, n: int | None) -> Column:
    """The first ``n`` elements; all without a limit."""
    return items if n is None else F.slice(items, 1, n)


def compact_person(
    df: DataFrame, positions: int | None = None, characters: int | None = None,
    services: int | None = None,
) -> DataFrame:
    """Identifier, positions in four fields, text and services; limits are the caller's choice."""
    about = F.coalesce("about", F.lit(""))
    short = F.transform(
        _first(F.col("all_positions"), positions),
        lambda p: F.struct(p["title"].alias("title"), p["company_name"].alias("company_name"),
                           p["start_date"].alias("start_date"), p["end_date"].alias("end_date")),
    )
    none = F.array()
    return df.select(
        first_truthy(F.col("public_identifier"), F.col("name")).alias("identifier"),
        "name", "job_title", "matched_domain", "employee_tier", "tier_reason",
        F.coalesce(short, none.cast(
            "array<struct<title:string,company_name:string,start_date:string,end_date:string>>"
        )).alias("recent_positions"),
        (about if characters is None else F.left(about, F.lit(characters))).alias("about_excerpt"),
        F.coalesce(_first(F.col("services_offered"), services), none.cast("array<string>"))
        .alias("services_offered"),
    )


def _is_report(data: Column) -> Column:
    """A breach report: an object with at least one of the telling fields."""
    names = F.json_object_keys(F.to_json(data))
    return (kind(data) == "OBJECT") & F.arrays_overlap(
        names, F.array(*map(F.lit, BREACH_REPORT_FIELDS))
    )


def exposure_findings(
    elements: Column, groups: int | None = None, items: int | None = None,
    details: int | None = None,
) -> Column:
    """Array of findings from exposure groups given as an array of VARIANT.

    ``groups``, ``items`` of a group and ``details`` of a report may be limited to the first ones.

    Each finding is struct(source, kind, type, module, data, report, details) with JSON text in
    ``data``; ``kind`` is structured_breach_report, empty, raw_event or unknown.
    """

    def finding(source=None, what="unknown", type_=None, module=None, data=None, report=None,
                listed=None) -> Column:
        def text(x):
            return (F.lit(None) if x is None else x).cast("string")

        report_type = "struct<" + ",".join(f"{k}:string" for k in REPORT_FIELDS) + ">"
        detail_type = "array<struct<" + ",".join(f"{k}:string" for k in DETAIL_FIELDS) + ">>"
        return F.struct(
            text(source).alias("source"), F.lit(what).alias("kind"), text(type_).alias("type"),
            text(module).alias("module"), text(data).alias("data"),
            (F.lit(None) if report is None else report).cast(report_type).alias("report"),
            (F.lit(None) if listed is None else listed).cast(detail_type).alias("details"),
        )

    def report_of(data: Column) -> Column:
        return F.struct(*[text_of(data, f"$.{v}").alias(k) for k, v in REPORT_FIELDS.items()])

    def details_of(data: Column) -> Column:
        listed = _first(as_list(F.try_variant_get(data, "$.breachDetails", "variant")), details)
        return F.transform(
            F.filter(listed, lambda d: kind(d) == "OBJECT"),
            lambda d: F.struct(*[text_of(d, f"$.{f}").alias(f) for f in DETAIL_FIELDS]),
        )

    def group_findings(g: Column) -> Column:
        type_ = text_of(g, "$.type")
        source = first_truthy(text_of(g, "$.source"), type_)
        data = F.try_variant_get(g, "$.data", "variant")
        shown = _first(as_list(data), items)

        def event(i: Column) -> Column:
            is_obj = kind(i) == "OBJECT"
            names = F.json_object_keys(F.to_json(i))
            inner = F.try_variant_get(i, "$.data", "variant")
            return finding(
                source, "raw_event",
                F.when(is_obj & F.array_contains(names, "type"), text_of(i, "$.type"))
                .otherwise(type_),
                F.when(is_obj, text_of(i, "$.module")),
                F.when(is_obj & F.array_contains(names, "data"), F.to_json(inner))
                .otherwise(F.to_json(i)),
            )

        return (
            F.when(kind(g) != "OBJECT", F.array(finding(data=F.to_json(g))))
            .when(F.coalesce(_is_report(data), F.lit(False)), F.array(finding(
                source, "structured_breach_report", report=report_of(data),
                listed=details_of(data))))
            .when(F.size(shown) == 0, F.array(finding(source, "empty", type_)))
            .otherwise(F.transform(shown, event))
        )

    return F.flatten(F.transform(_first(elements, groups), group_findings))


def compact_mentions(heads: DataFrame, first_ten: DataFrame) -> DataFrame:
    """Target key, modules and the first ten mentions (see ``dedup.first_elements``)."""
    keys = ["tenant", "target", "target_type"]
    out = heads.join(first_ten, keys, "left")
    return out.select(
        *keys,
        F.concat(F.col("target"), F.lit("||"), F.col("target_type")).alias("target_key"),
        "modules_checked",
        F.coalesce("elements", F.array().cast("array<string>")).alias("mentions"),
    )


def compact_certificates(issuances: Column, limit: int | None = None) -> Column:
    """Certificate records without hash and id fields; issuer by its friendly name."""
    return F.transform(
        _first(issuances, limit),
        lambda e: F.struct(
            e["dns_names"].alias("dns_names"),
            first_truthy(e["issuer"]["friendly_name"], e["issuer"]["name"]).alias("issuer"),
            e["not_before"].alias("not_before"),
            e["not_after"].alias("not_after"),
            e["revoked"].alias("revoked"),
        ),
    )
