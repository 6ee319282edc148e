"""Names and the search terms made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import fold_for_match, strip_space, words


def split_name(first: Column, last: Column, full: Column) -> Column:
    """struct(first, last) from the name fields, else from the full name, else null."""
    f = F.regexp_replace(fold_for_match(first), "[^a-z-]", "")
    n = F.regexp_replace(fold_for_match(last), "[^a-z-]", "")
    by_fields = (
        (first != "") & (last != "") & (F.lower(last) != "undefined") & (f != "") & (n != "")
    )
    cleaned = F.regexp_replace(fold_for_match(full), r"[^a-z\s\x1c-\x1f-]", "")
    tokens = words(cleaned)
    by_full = F.size(tokens) >= 2
    return F.when(
        F.coalesce(by_fields, F.lit(False)),
        F.struct(f.alias("first"), n.alias("last")),
    ).when(
        by_full,
        F.struct(
            F.get(tokens, F.lit(0)).alias("first"), F.element_at(tokens, -1).alias("last")
        ),
    )


def person_parts(first: Column, last: Column, full: Column) -> Column:
    """As :func:`split_name` but WITHOUT folding: the form addresses are expected under."""
    f = F.lower(strip_space(F.coalesce(first, F.lit(""))))
    n = F.lower(strip_space(F.coalesce(last, F.lit(""))))
    tokens = words(F.lower(F.coalesce(full, F.lit(""))))
    return F.when((f != "") & (n != ""), F.struct(f.alias("first"), n.alias("last"))).when(
        F.size(tokens) >= 2,
        F.struct(
            F.get(tokens, F.lit(0)).alias("first"), F.element_at(tokens, -1).alias("last")
        ),
    )


def capitalize(c: Column) -> Column:
    """First character upper, the rest lower."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def title_case(c: Column) -> Column:
    """Every run of letters capitalised; ``initcap`` only looks at spaces."""
    runs = F.regexp_extract_all(c, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, capitalize), "")


def query_from_host(host: Column) -> Column:
    label = F.substring_index(host, ".", 1)
    return title_case(F.regexp_replace(label, "[-_]+", " "))


def query_variants(c: Column) -> Column:
    """Spaced and hyphenated spelling, empty and repeated ones dropped."""
    spaced = strip_space(F.regexp_replace(c, "[-_]+", " "))
    hyphened = strip_space(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", "-"))
    return F.array_distinct(F.filter(F.array(spaced, hyphened), lambda v: v != ""))


def full_or_joined_name(full: Column, first: Column, last: Column) -> Column:
    """Full name, else first and last joined by a space, else ''."""
    joined = strip_space(F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit(""))))
    return F.coalesce(F.nullif(full, F.lit("")), joined, F.lit(""))


def name_terms(name: Column) -> Column:
    """Lower-cased words of three characters or more."""
    parts = F.split(name, r"(?U)\W+")
    return F.transform(F.filter(parts, lambda w: F.length(w) >= 3), F.lower)


def dedup_key(public_id: Column, url: Column, alt_url: Column, name: Column) -> Column:
    """Identity of a person record: public id, else profile URL, else name."""
    pid = F.lower(strip_space(public_id))
    link = F.coalesce(F.nullif(url, F.lit("")), F.nullif(alt_url, F.lit("")))
    link = F.rtrim(F.substring_index(F.lower(strip_space(link)), "?", 1), F.lit("/"))
    fallback = F.coalesce(F.lower(strip_space(name)), F.lit(""))
    return (
        F.when(pid != "", F.concat(F.lit("pid:"), pid))
        .when(link != "", F.concat(F.lit("url:"), link))
        .otherwise(F.concat(F.lit("name:"), fallback))
    )
