"""Observation tables derived from the given tables: the inputs of the registered queries.

Each one is a plain projection (or an equi-join) of whole tables, so its size grows with theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.hosts import normalize_host
from rollcall.schemas import RAW_PROFILE

C = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, df: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """Rows of a scan of fewer partitions than cores, dealt out before costly per-row work.

    Decided from the partitions of the scan (``df`` itself unless it is a join on one): a table of
    many files is left as it is, so at scale this adds no shuffle.
    """
    cores = spark.sparkContext.defaultParallelism
    found = (df if scan is None else scan).rdd.getNumPartitions()
    return df.repartition(cores) if found * 2 <= cores else df


def case(column: str, values: dict[str, object], default=None) -> Column:
    """CASE over one column; values may be Columns or literals."""
    out = None
    for key, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        out = (F if out is None else out).when(C(column) == key, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(default)


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as host observations: tenant is the top-level domain, tags are language and scheme."""
    p = spread(spark, table(spark, sf_dir, "pages"))
    return p.select(
        C("page_id").alias("seq"), "url", "html",
        F.regexp_extract("url", r"example\.(com|net|org)", 1).alias("tenant"),
        F.regexp_extract("url", r"^https?://[^/]*/([a-z]+)/", 1).alias("lang"),
        F.regexp_extract("url", r"^(https?)://", 1).alias("scheme"),
        F.regexp_extract("url", r"^https?://([^/?#]*)", 1).alias("authority"),
        normalize_host(C("url")).alias("host"),
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as invented people, named after parts and nations."""
    word = F.split("p_name", " ")
    last = F.concat(word[1], C("c_nationkey").cast("string"))
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "part"), C("p_partkey") == C("c_custkey"))
        .select(
            "c_custkey", F.lower("c_mktsegment").alias("tenant"), "c_nationkey",
            word[0].alias("first_name"), last.alias("last_name"),
            F.concat_ws(" ", word[0], last).alias("name"),
            "c_acctbal", "p_type", "p_brand", "c_mktsegment",
        )
    )


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as address observations of people."""
    f, n = C("first_name"), C("last_name")
    local = case("o_orderpriority", {
        "1-URGENT": "Info", "2-HIGH": F.concat(f, F.lit("."), n),
        "3-MEDIUM": F.concat(f, F.lit("_"), n), "4-NOT SPECIFIED": F.concat(f, n),
    }, F.concat(F.left(f, F.lit(1)), n))
    email = F.concat(
        local, F.lit("@"), case("o_orderpriority", {"1-URGENT": "mail."}, ""), C("tenant"),
        F.lit(".example."), case("o_orderstatus", {"O": "com", "F": "net"}, "org"),
    )
    tag = case("o_orderpriority", {
        "1-URGENT": "harvest", "2-HIGH": "scan", "3-MEDIUM": "Pattern-Generation",
        "4-NOT SPECIFIED": "Manual-Generation",
    }, "Inferred-Pattern")
    price = C("o_totalprice")
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(persons(spark, sf_dir), C("c_custkey") == C("o_custkey"))
    return (
        spread(spark, joined, orders)
        .select(
            C("o_orderkey").alias("seq"), "tenant", C("name").alias("employee"),
            "first_name", "last_name", email.alias("email"), tag.alias("tag"),
            F.when(price > 400000, "risky").otherwise(case("o_orderstatus", {
                "O": "deliverable", "F": "unknown"}, "smtp_inconclusive_catchall"))
            .alias("validation_status"),
            F.when(C("o_orderstatus") == "O", 0.9).when(price > 250000, 0.5).otherwise(0.0)
            .alias("confidence"),
            (C("o_orderstatus") == "P").alias("is_catch_all"),
            "o_orderstatus", "o_orderpriority", "o_totalprice", "c_custkey",
        )
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as lines of tool output: objects, lists, log text, blanks."""
    e, u = C("event_id").cast("string"), C("user_id").cast("string")
    line = case("event_type", {
        "signup": F.concat(
            F.lit('{"type": "EMAILADDR_COMPROMISED", "module": "m", "data": '), "props",
            F.lit("}")),
        "purchase": F.concat(
            F.lit('[{"type": "DARKNET_MENTION_URL", "data": "u'), u,
            F.lit('"}, {"type": "Username", "data": "x"}, 7]')),
        "view": F.concat(
            F.lit('  {"type": "DARKNET_MENTION_CONTENT", "data": "v'), e, F.lit('"} ')),
        "click": F.concat(F.lit("log: possible Breach on the DarkNet at "), e),
        "error": F.when(C("value") > 10, "   ").otherwise(F.concat(
            F.lit('{"type": "LEAKSITE_CONTENT", "data": "e'), e, F.lit('"}'))),
    })
    return spread(spark, table(spark, sf_dir, "events")).select(
        "event_id", "user_id", "event_type", "value", "props", line.alias("line")
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as downloaded files; labels are the checks some of them got."""
    labels = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    ext = case("lang", {"en": ".pdf", "fr": ".docx", "de": ".doc"}, ".pptx")
    documents = table(spark, sf_dir, "documents")
    return spread(spark, documents.join(labels, "doc_id", "left"), documents).select(
        C("doc_id").alias("seq"), C("source").alias("tenant"), "text", "lang", "n_chars",
        F.concat("source", F.lit(".example.com")).alias("source_domain"),
        F.concat("lang", F.lit("-"), F.expr("n_chars div 100").cast("string"), ext)
        .alias("filename"),
        case("lang", {"en": "metagoofil", "es": "other"}, "apify-google")
        .alias("discovery_method"),
        (C("quality") == 1).alias("content_verified"), "quality", "toxic",
        F.coalesce("labelled", F.lit(False)).alias("labelled"),
    )


def _shaped(kind: T.DataType, given) -> Column:
    """A value of a nested type from the parts that are given; the other fields are null."""
    if isinstance(given, dict):
        return F.struct(*[_shaped(f.dataType, given.get(f.name)).alias(f.name) for f in kind])
    if isinstance(given, list):
        return F.array(*[_shaped(kind.elementType, g) for g in given])
    return (F.lit(None) if given is None else given).cast(kind)


def profile_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw profile items: nested history made from the order's own row."""
    st, pr = C("o_orderstatus"), C("o_orderpriority")
    present = case("o_orderstatus", {"O": "Present", "F": "1998"}, "")
    title = case("o_orderpriority", {
        "1-URGENT": "Sales Director", "2-HIGH": "International Clerk",
        "3-MEDIUM": "Software Engineer", "4-NOT SPECIFIED": "Factory Worker",
    }, "Events Coordinator")
    key = C("o_custkey").cast("string")
    item = {
        "id": F.concat(F.lit("id"), C("o_orderkey").cast("string")),
        "name": F.when(st != "P", C("name")),
        "firstName": F.when(pr != "5-LOW", C("first_name")),
        "lastName": F.when(pr != "5-LOW", C("last_name")),
        "position": F.when(st == "F", "").otherwise(title),
        "headline": C("p_type"),
        "linkedinUrl": F.concat(F.lit("https://People.example/in/"), key, F.lit("/?ref="), pr),
        "publicIdentifier": F.when(st == "O", F.concat(F.lit("P-"), key)),
        "location": {
            "linkedinText": C("c_mktsegment"),
            "parsed": {
                "text": F.when(st == "F", "").otherwise(C("p_brand")), "city": C("p_type"),
                "country": F.concat(F.lit("N"), C("c_nationkey").cast("string")),
            },
        },
        "summary": C("p_type"),
        "emails": [{"email": F.concat(C("first_name"), F.lit("@x.example.com"))},
                   {"email": F.lit("")}],
        "currentPosition": [{
            "position": title, "companyName": F.lit(""),
            "company": {
                "name": F.when(C("o_totalprice") > 250000,
                               F.concat(C("c_mktsegment"), F.lit("-Works"))),
                "website": F.lit("w"),
            },
        }],
        "experience": [
            {"position": title,
             "companyName": F.concat(F.lit("The "), C("c_mktsegment"), F.lit("_Group")),
             "startDate": {"text": F.lit("1995")}, "endDate": {"text": present}},
            {"position": F.lit("Stagiaire"), "companyName": C("p_brand"),
             "startDate": {"text": F.lit("1990")}, "endDate": {"text": F.lit("1991")}},
        ],
        "education": [{"schoolName": C("p_brand"), "startDate": {"text": F.lit("1985")}}],
        "services": {"servicesList": F.array(pr, C("p_type"))},
    }
    raw = T._parse_datatype_string(f"struct<{RAW_PROFILE}>")
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(persons(spark, sf_dir), C("c_custkey") == C("o_custkey"))
    return (
        spread(spark, joined, orders)
        .select(
            "tenant", C("o_orderkey").alias("seq"),
            F.concat(F.lit("www."), "tenant", F.lit(".example.com")).alias("matched_domain"),
            *[_shaped(f.dataType, item.get(f.name)).alias("_" + f.name) for f in raw],
        )
        .withColumnsRenamed({"_" + f.name: f.name for f in raw})
    )


def profile_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same items as JSON text, the form a search tool returns them in."""
    items = profile_items(spark, sf_dir)
    own = ["tenant", "seq", "matched_domain"]
    return items.select(*own, F.to_json(F.struct(*[c for c in items.columns if c not in own]))
                        .alias("raw"))


def _doc_key() -> Column:
    return F.concat("lang", F.lit("-"), F.expr("n_chars div 100").cast("string"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record store: documents raw and reviewed, customers as raw addresses, some more."""
    d = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")

    def rows(df, tier, entity, tenant, key, number, head, tail):
        n = F.max(number)
        return df.groupBy(tenant.alias("tenant"), key.alias("record_key")).agg(
            F.concat(F.lit(head), n.cast("string"), F.lit(tail)).alias("data"), n.alias("stamp")
        ).select(F.lit(tier).alias("tier"), F.lit(entity).alias("entity"), "tenant",
                 "record_key", "data", F.timestamp_seconds("stamp").alias("updated_at"))

    email_key = F.concat("c_mktsegment", F.lit("-"),
                         F.floor(C("c_acctbal") / 1000).cast("string"))
    region = table(spark, sf_dir, "region").select(
        F.lit("reviewed").alias("tier"), F.lit("infrastructure").alias("entity"),
        F.concat(F.lit("only"), C("r_regionkey").cast("string")).alias("tenant"),
        C("r_name").alias("record_key"), F.lit("{}").alias("data"),
        F.timestamp_seconds(F.lit(0)).alias("updated_at"))
    return (
        rows(d, "raw", "documents", C("source"), _doc_key(), "doc_id", '{"doc":', "}")
        .unionByName(rows(d.join(good, "doc_id", "left_semi"), "reviewed", "documents",
                          C("source"), _doc_key(), "doc_id", '{"doc":', ',"ok":true}'))
        .unionByName(rows(table(spark, sf_dir, "customer"), "raw", "emails",
                          F.concat(F.lit("src"), C("c_nationkey").cast("string")), email_key,
                          "c_custkey", '{"email":', "}"))
        .unionByName(region)
    )


def review_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as review decisions already taken."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return d.groupBy(C("source").alias("tenant"), _doc_key().alias("record_key")).agg(
        F.when(F.max_by("quality", "doc_id") == 1, "approved").otherwise("rejected")
        .alias("status")
    ).select(F.lit("raw_documents").alias("source_table"), "tenant", "record_key", "status",
             F.timestamp_seconds(F.lit(0)).alias("reviewed_at"))


def with_strangers(verdicts: DataFrame) -> DataFrame:
    """The verdicts, and their opposites under a tenant that has none of the records.

    The same identifiers then stand under two tenants with different verdicts, the strangers' ones
    later; they must decide nothing.
    """
    boolean = dict(verdicts.dtypes)["keep"] == "boolean"
    strange = C("_strange")
    other = {"tenant": F.lit("elsewhere"), "seq": C("seq") + 5_000_000_000,
             "keep": ~C("keep") if boolean else F.parse_json(F.lit("false"))}
    # a flag per copy, not a union: the verdicts are made once
    both = verdicts.withColumn("_strange", F.explode(F.array(F.lit(False), F.lit(True))))
    return both.select(*[F.when(strange, other[c]).otherwise(C(c)).alias(c) if c in other else c
                         for c in verdicts.columns])
