"""Raw profile items to person rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.constants import MAIN_PROFILE_LABEL, PROFILE_SOURCE, RAW_PROFILE_SOURCE
from rollcall.functions.names import full_or_joined_name, query_variants
from rollcall.functions.text import first_truthy, truthy
from rollcall.schemas import CURRENT_POSITION, EDUCATION, POSITION, RAW_PROFILE


def _list(arr: Column, item, empty: str) -> Column:
    return F.coalesce(F.transform(arr, item), F.array().cast(empty))


def _renamed(x: Column, names: dict[str, str]) -> Column:
    """Struct with new field names; a dotted source reaches into a nested struct."""

    def at(path: str) -> Column:
        out = x
        for part in path.split("."):
            out = out[part]
        return out

    return F.struct(*[at(src).alias(dst) for dst, src in names.items()])


# fixed values: output field -> raw field
POSITION_FIELDS = {
    "title": "position", "company_name": "companyName",
    "company_linkedin_url": "companyLinkedinUrl", "employment_type": "employmentType",
    "workplace_type": "workplaceType", "location": "location", "start_date": "startDate.text",
    "end_date": "endDate.text", "duration": "duration", "description": "description",
}
EDUCATION_FIELDS = {
    "school_name": "schoolName", "school_linkedin_url": "schoolLinkedinUrl", "degree": "degree",
    "field_of_study": "fieldOfStudy", "start_date": "startDate.text",
    "end_date": "endDate.text", "period": "period",
}


def position_of(p: Column) -> Column:
    """A history entry under its output names."""
    return _renamed(p, POSITION_FIELDS)


def education_of(e: Column) -> Column:
    return _renamed(e, EDUCATION_FIELDS)


def current_position_of(p: Column) -> Column:
    return F.struct(
        p["position"].alias("title"),
        first_truthy(p["companyName"], p["company"]["name"]).alias("company_name"),
        p["companyLinkedinUrl"].alias("company_linkedin_url"),
        p["company"]["website"].alias("company_website"),
        p["employmentType"].alias("employment_type"),
        p["workplaceType"].alias("workplace_type"),
        p["duration"].alias("duration"),
    )


def typed_items(df: DataFrame, raw: str) -> DataFrame:
    """Raw items given as JSON text, with their fields as columns."""
    rest = [c for c in df.columns if c != raw]
    return df.select(*rest, F.inline(F.array(F.from_json(raw, RAW_PROFILE))))


def flatten_profiles(items: DataFrame) -> DataFrame:
    """Person rows of raw nested items; blank fields fall through, nameless items are dropped."""
    c = F.col
    current = _list(c("currentPosition"), current_position_of, f"array<{CURRENT_POSITION}>")
    history = _list(c("experience"), position_of, f"array<{POSITION}>")
    education = _list(c("education"), education_of, f"array<{EDUCATION}>")
    emails = F.filter(F.transform(c("emails"), lambda e: e["email"]),
                      lambda e: F.coalesce(e != "", F.lit(False)))
    sites = F.filter(F.transform(c("companyWebsites"), lambda w: w["url"]),
                     lambda u: F.coalesce(u != "", F.lit(False)))
    none = F.array().cast("array<string>")
    parsed = c("location.parsed")
    return (
        items.withColumn("_name", full_or_joined_name(c("name"), c("firstName"), c("lastName")))
        .where(c("_name") != "")
        .select(
            "tenant", "seq", c("_name").alias("name"),
            c("firstName").alias("first_name"), c("lastName").alias("last_name"),
            first_truthy(c("position"), c("headline")).alias("job_title"),
            c("linkedinUrl").alias("linkedin_url"),
            c("linkedinProfileUrl").alias("linkedin_profile_url"),
            c("publicIdentifier").alias("public_identifier"),
            F.struct(
                first_truthy(parsed["text"], c("location.linkedinText")).alias("text"),
                parsed["city"].alias("city"),
                first_truthy(parsed["countryFull"], parsed["country"]).alias("country"),
            ).alias("location"),
            first_truthy(c("about"), c("summary")).alias("about"),
            F.coalesce(emails, none).alias("emails"),
            F.coalesce(c("websites"), none).alias("personal_websites"),
            F.coalesce(sites, none).alias("company_websites"),
            current.alias("current_position"),
            history.alias("all_positions"),
            education.alias("education"),
            c("topSkills").alias("top_skills"),
            c("connectionsCount").alias("connections_count"),
            c("followerCount").alias("follower_count"),
            c("openToWork").alias("open_to_work"),
            F.coalesce(c("services.servicesList"), none).alias("services_offered"),
            "matched_domain",
            F.lit(PROFILE_SOURCE).alias("source"),
        )
    )


def raw_people(items: DataFrame) -> DataFrame:
    """Person rows of raw items where nothing enriched exists; rows without a key are dropped."""
    c = F.col
    return items.withColumn(
        "person_key", first_truthy(c("publicIdentifier"), c("linkedinUrl"), c("id"))
    ).where(c("person_key").isNotNull()).select(
        "tenant", "seq", "person_key", "name",
        first_truthy(c("position"), c("headline")).alias("job_title"),
        c("linkedinUrl").alias("linkedin_url"),
        c("publicIdentifier").alias("public_identifier"),
        c("search_target").alias("matched_domain"),
        F.lit(RAW_PROFILE_SOURCE).alias("source"),
    )


def tag_search(items: DataFrame, query: str, target: str) -> DataFrame:
    """Each raw item once per query variant, tagged with target and variant."""
    return items.withColumn("search_target", F.col(target)).withColumn(
        "search_query", F.explode(query_variants(F.col(query)))
    )


def profile_links(main_url: Column, profiles: Column) -> Column:
    """'site: url' lines: main profile first, then the platforms, one line per URL in order."""
    main = F.when(
        truthy(main_url).isNotNull(),
        F.array(F.struct(F.lit(MAIN_PROFILE_LABEL).alias("site"), main_url.alias("url"))),
    ).otherwise(F.array().cast("array<struct<site:string,url:string>>"))
    others = F.flatten(F.transform(profiles, lambda p: p["platforms"]))
    others = F.coalesce(others, F.array().cast("array<struct<site:string,url:string>>"))
    links = F.filter(F.concat(main, others), lambda x: F.coalesce(x["url"] != "", F.lit(False)))
    urls = F.transform(links, lambda x: x["url"])
    firsts = F.filter(links, lambda x, i: F.array_position(urls, x["url"]) == i + 1)
    return F.transform(
        firsts,
        lambda x: F.concat(F.coalesce(truthy(x["site"]), F.lit("Profile")), F.lit(": "), x["url"]),
    )
