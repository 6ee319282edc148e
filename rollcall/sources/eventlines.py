"""Tolerant scans of tool output: lines that are mostly, but not always, JSON events.

Every scan takes a DataFrame with one text column and keeps the other columns.  JSON is parsed
once per line; the rest is predicates on the parsed value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.constants import (
    ADDRESS_EVENT_TYPE,
    ADDRESS_IN_TEXT,
    BREACH_EVENT_TYPES,
    EDGE_LINE,
    HOST_EVENT_TYPES,
    HOST_IN_TEXT,
    MENTION_EVENT_TYPES,
)
from rollcall.functions.addresses import normalize_address
from rollcall.functions.text import LINE_BREAK, bind, contains_any, strip_space
from rollcall.functions.variants import kind, parse_whole, text_of


def split_lines(df: DataFrame, text: str, out: str = "line", place: str = "line_no") -> DataFrame:
    """One row per line of a text column, with its place."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(F.split(text, LINE_BREAK)).alias(place, out))


def _parsed(df: DataFrame, line: str) -> tuple[DataFrame, list[str]]:
    """Non-blank lines with their parsed value ``_v`` and its kind ``_k``, parsed once each."""
    rest = [c for c in df.columns if c != line]
    lines = df.withColumn(line, strip_space(F.col(line))).where(F.col(line) != "")
    return bind(lines, parse_whole(F.col(line)), lambda v: {"_v": v, "_k": kind(v)}), rest


def _event(v: Column) -> list[Column]:
    return [
        text_of(v, "$.type").alias("type"),
        F.try_variant_get(v, "$.module", "string").alias("module"),
        F.to_json(F.try_variant_get(v, "$.data", "variant")).alias("data"),
    ]


def _marked(line: Column, types, word: str) -> Column:
    return contains_any(line, types) | F.lower(line).contains(word)


def breach_events(df: DataFrame, line: str) -> DataFrame:
    """type, module, data (JSON text) of exposure events.

    Objects of a known type are kept, a list is kept WHOLE as 'unparsed-list', a line that is not
    JSON is kept as 'unparsed' when it names an event type or a breach.
    """
    parsed, rest = _parsed(df, line)
    v, k = F.col("_v"), F.col("_k")
    obj_type, module, data = _event(v)
    is_obj = (k == "OBJECT") & text_of(v, "$.type").isin(*BREACH_EVENT_TYPES)
    is_text = k.isNull() & _marked(F.col(line), BREACH_EVENT_TYPES, "breach")
    return parsed.where(is_obj | (k == "ARRAY") | is_text).select(
        *rest,
        F.when(k == "OBJECT", obj_type).when(k == "ARRAY", "unparsed-list")
        .otherwise("unparsed").alias("type"),
        F.when(k == "OBJECT", module).alias("module"),
        F.when(k == "OBJECT", data).when(k == "ARRAY", F.to_json(v))
        .otherwise(F.to_json(F.to_variant_object(F.array(line)))).alias("data"),
    ).withColumn(
        "data",
        F.when(F.col("type") == "unparsed", F.expr("substr(data, 2, length(data) - 2)"))
        .otherwise(F.col("data")),
    )


def mention_events(df: DataFrame, line: str) -> DataFrame:
    """As :func:`breach_events` for mention types, but a list is UNWRAPPED item by item."""
    parsed, rest = _parsed(df, line)
    v, k = F.col("_v"), F.col("_k")
    items = (
        F.when(k == "ARRAY", F.try_variant_get(v, "$", "array<variant>"))
        .when(k == "OBJECT", F.array(v))
        .when(k.isNull() & _marked(F.col(line), MENTION_EVENT_TYPES, "darknet"),
              F.array(F.to_variant_object(F.named_struct(
                  F.lit("type"), F.lit("unparsed"), F.lit("data"), F.col(line)))))
    )
    wanted = MENTION_EVENT_TYPES + ("unparsed",)
    out = parsed.select(*rest, k.alias("_k"), F.posexplode(items).alias("item_no", "_item"))
    item = F.col("_item")
    return out.where(
        (kind(item) == "OBJECT")
        & text_of(item, "$.type").isin(*wanted)
        & ((text_of(item, "$.type") != "unparsed") | F.col("_k").isNull())
    ).select(*rest, "item_no", *_event(item))


def host_events(df: DataFrame, text: str) -> DataFrame:
    """Host names out of a whole tool output: events of host types, else host-shaped text."""
    rest = [c for c in df.columns if c != text]
    parsed = bind(df, parse_whole(F.col(text)), lambda v: {"_v": v, "_k": kind(v)})
    items = F.when(F.col("_k") == "ARRAY", F.try_variant_get("_v", "$", "array<variant>"))
    from_events = F.transform(
        F.filter(items, lambda e: (kind(e) == "OBJECT")
                 & text_of(e, "$.type").isin(*HOST_EVENT_TYPES)),
        lambda e: F.coalesce(text_of(e, "$.data"), F.lit("")),
    )
    from_text = F.regexp_extract_all(F.lower(text), F.lit("(?U)" + HOST_IN_TEXT), F.lit(0))
    hosts = F.when(F.col("_k").isNull(), from_text).otherwise(from_events)
    return parsed.select(*rest, F.explode(F.array_distinct(hosts)).alias("host"))


def unparsed_lines(df: DataFrame, text: str) -> DataFrame:
    """The non-blank lines of outputs that are not JSON at all, kept so that nothing is lost."""
    raw = df.where(parse_whole(F.col(text)).isNull())
    return split_lines(raw, text, "unparsed_line").where(
        strip_space(F.col("unparsed_line")) != ""
    )


def address_events(df: DataFrame, line: str) -> DataFrame:
    """Normalised addresses per line: the data of address events, else address-shaped text.

    A line that is a JSON list, or an object of another type, is no match.
    """
    parsed, rest = _parsed(df, line)
    v, k = F.col("_v"), F.col("_k")
    found = F.when(
        (k == "OBJECT") & (text_of(v, "$.type") == ADDRESS_EVENT_TYPE),
        F.array(F.coalesce(text_of(v, "$.data"), F.lit(""))),
    ).when(~F.coalesce(k.isin("OBJECT", "ARRAY"), F.lit(False)), F.regexp_extract_all(F.col(line), F.lit(ADDRESS_IN_TEXT), F.lit(0)))
    return parsed.select(*rest, F.explode(found).alias("_a")).select(
        *rest, normalize_address(F.col("_a")).alias("email")
    )


def edge_lines(df: DataFrame, line: str) -> DataFrame:
    """hostname, record_type, ip, raw_line of 'host (FQDN) --> a_record --> ip (IPAddress)'."""
    rest = [c for c in df.columns if c != line]
    raw = strip_space(F.col(line))
    part = [strip_space(F.regexp_extract(raw, EDGE_LINE, i)) for i in (1, 2, 3)]
    return df.where(F.regexp_like(raw, F.lit(EDGE_LINE))).select(
        *rest,
        part[0].alias("hostname"), part[1].alias("record_type"), part[2].alias("ip"),
        raw.alias("raw_line"),
    )


def host_list(df: DataFrame, hosts: str) -> DataFrame:
    """Elements of a VARIANT list that are text, or objects with a ``hostname``."""
    rest = [c for c in df.columns if c != hosts]
    items = F.when(kind(F.col(hosts)) == "ARRAY",
                   F.try_variant_get(hosts, "$", "array<variant>"))
    out = df.select(*rest, F.explode(items).alias("_h"))
    h = F.col("_h")
    return out.select(
        *rest,
        F.when(kind(h) == "STRING", F.try_variant_get(h, "$", "string"))
        .when(kind(h) == "OBJECT", text_of(h, "$.hostname")).alias("host"),
    ).where(F.col("host").isNotNull())


def certificate_names(df: DataFrame, names: str) -> DataFrame:
    """Distinct names of certificate records; every '*.' goes, wherever it stands."""
    rest = [c for c in df.columns if c != names]
    return df.select(*rest, F.explode(names).alias("_n")).select(
        *rest, F.replace("_n", F.lit("*."), F.lit("")).alias("subdomain")
    ).distinct()
