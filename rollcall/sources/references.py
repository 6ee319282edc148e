"""Search results to document references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.constants import SEARCH_FILE_TYPES


def document_references(results: DataFrame, url: str, file_types=SEARCH_FILE_TYPES) -> DataFrame:
    """source_domain, filename and extension of the results that point at a document.

    The base name is URL-decoded ('+' is no space, a bad escape leaves the name raw), characters
    unsafe in a file name become '_'.
    """
    u = F.col(url)
    netloc = F.regexp_extract(u, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_replace(u, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?|[?#].*$", "")
    base = F.regexp_replace(F.substring_index(path, "/", -1), ";.*$", "")
    decoded = F.coalesce(F.try_url_decode(F.replace(base, F.lit("+"), F.lit("%2B"))), base)
    name = F.translate(decoded, "/\\\x00", "___")
    ext = F.lower(F.regexp_extract(name, r"^\.*[^.].*\.([^.]*)$", 1))
    return (
        results.where(F.coalesce(u, F.lit("")) != "")
        .withColumn("source_domain", F.coalesce(F.nullif(netloc, F.lit("")), F.lit("web")))
        .withColumn("filename", name)
        .withColumn("extension", ext)
        .where(F.col("extension").isin(*file_types))
    )


def unseen_documents(refs: DataFrame, seen: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """References whose file name was not seen before, the earliest row of each name."""
    from rollcall.operators.dedup import first_wins

    fresh = refs.join(seen.select(*keys).distinct(), keys, "left_anti")
    return first_wins(fresh, keys, seq)
