"""Schemas of the artifacts and of the record store, as Spark DDL."""

from __future__ import annotations

POSITION = (
    "struct<title:string,company_name:string,company_linkedin_url:string,employment_type:string,"
    "workplace_type:string,location:string,start_date:string,end_date:string,duration:string,"
    "description:string>"
)
CURRENT_POSITION = (
    "struct<title:string,company_name:string,company_linkedin_url:string,company_website:string,"
    "employment_type:string,workplace_type:string,duration:string>"
)
EDUCATION = (
    "struct<school_name:string,school_linkedin_url:string,degree:string,field_of_study:string,"
    "start_date:string,end_date:string,period:string>"
)
PROFILES = (
    "array<struct<username:string,matched_pattern:string,"
    "platforms:array<struct<site:string,url:string>>,source:string>>"
)

# array artifacts: one element = one observation
ARTIFACTS = {
    "candidate_domains": "domain string, sources array<string>",
    "domains": "domain string, sources array<string>",
    "candidate_emails": "email string, employee string, sources array<string>",
    "validated_emails": (
        "email string, employee string, sources array<string>, validation_status string, "
        "confidence double, is_catch_all boolean, fallback_source string"
    ),
    "documents": (
        "filename string, source_domain string, discovery_method string, url string, "
        "extracted_metadata map<string,string>, content_verified boolean"
    ),
    "employees": (
        "name string, first_name string, last_name string, job_title string, "
        "linkedin_url string, linkedin_profile_url string, public_identifier string, "
        "location struct<text:string,city:string,country:string>, about string, "
        "emails array<string>, personal_websites array<string>, "
        f"company_websites array<string>, current_position array<{CURRENT_POSITION}>, "
        f"all_positions array<{POSITION}>, education array<{EDUCATION}>, "
        "top_skills variant, connections_count bigint, follower_count bigint, "
        "open_to_work boolean, services_offered array<string>, matched_domain string, "
        f"source string, additional_profiles {PROFILES}"
    ),
    "employees_raw": "search_target string, search_query string, raw variant",
    "breaches": (
        "email string, validation_status string, "
        "breaches array<struct<type:string,data:variant,source:string>>, "
        "services_checked array<string>, service string, catchall_confirmed_by_breach boolean"
    ),
    "darkweb": (
        "target string, target_type string, mentions array<struct<type:string,data:variant,"
        "module_hint:string,triggering_target:string,target_type:string>>, "
        "modules_checked array<string>"
    ),
}
# map artifacts: one entry = one key and its value
MAP_ARTIFACTS = {
    "domain_discovery_raw": (
        "struct<theHarvester:variant,"
        "SpiderFoot:array<struct<type:string,module:string,data:variant>>>"
    ),
    "dns_infra": "array<struct<subdomain:string,sources:array<string>>>",
    "dns_infra_raw": (
        "struct<surfaced_network_footprint:map<string,struct<related_hostnames:array<string>,"
        "asn:string,description:string,cidr:string>>,raw_amass_records:array<struct<"
        "hostname:string,record_type:string,ip:string,raw_line:string>>,"
        "raw_certspotter_issuances:array<struct<dns_names:array<string>,"
        "issuer:struct<friendly_name:string,name:string>,not_before:string,not_after:string,"
        "revoked:boolean>>>"
    ),
}
RECORDS = (
    "tier string, entity string, tenant string, record_key string, data string, "
    "updated_at timestamp"
)
REVIEW_STATUS = (
    "source_table string, tenant string, record_key string, status string, "
    "reviewed_at timestamp"
)
VERDICTS = (
    "tenant string, category string, identifier string, keep variant, tier string, note string, "
    "exposure_summary string, connection_to_target string, key_facts array<string>, "
    "ips array<string>, asns array<string>, whois_data array<string>, "
    "banners_and_tech array<string>"
)
WARNINGS = "tenant string, category string, identifier string, warning string"
# a raw profile item as the search tool returns it
_DATE = "struct<text:string>"
RAW_PROFILE = (
    "id string, name string, firstName string, lastName string, position string, "
    "headline string, linkedinUrl string, linkedinProfileUrl string, publicIdentifier string, "
    "location struct<linkedinText:string,parsed:struct<text:string,city:string,country:string,"
    "countryFull:string>>, about string, summary string, emails array<struct<email:string>>, "
    "websites array<string>, companyWebsites array<struct<url:string>>, "
    "currentPosition array<struct<position:string,companyName:string,companyLinkedinUrl:string,"
    "company:struct<name:string,website:string>,employmentType:string,workplaceType:string,"
    "duration:string>>, "
    "experience array<struct<position:string,companyName:string,companyLinkedinUrl:string,"
    f"employmentType:string,workplaceType:string,location:string,startDate:{_DATE},"
    f"endDate:{_DATE},duration:string,description:string>>, "
    "education array<struct<schoolName:string,schoolLinkedinUrl:string,degree:string,"
    f"fieldOfStudy:string,startDate:{_DATE},endDate:{_DATE},period:string>>, "
    "topSkills variant, connectionsCount bigint, followerCount bigint, openToWork boolean, "
    "services struct<servicesList:array<string>>"
)
