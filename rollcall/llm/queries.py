"""Registered queries of this package, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    ann,
    decontam,
    language,
    licenses,
    mincut,
    ngram_join,
    packing,
    quality,
    secrets,
    sharding,
    toxicity,
    trie,
    whitening,
)
from rollcall.llm.common import in_fold, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.grade(docs, model).select(
        "doc_id", "toxicity.severity", "toxicity.grade", "toxicity.chance",
        (F.col("toxicity.chance") >= toxicity.REJECT).cast("int").alias("toxic"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs).select("doc_id", "found.*")


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", F.explode("licenses").alias("found")).select(
        "doc_id", "found.*")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = in_fold(F.col("doc_id"), 5, 0)
    labels = table(spark, sf_dir, "labels").where(~held)
    model = quality.fit(quality.label_rows(docs, labels, "quality"))
    return quality.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        quality.predicted(F.col("score")).alias("predicted"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


@query
def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = written(table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("content")), "shard-input")
    return sharding.shard(docs, F.col("content"), ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = in_fold(F.col("doc_id"), 3, 1)
    model = language.fit(docs.where(~held))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, lambda key: key % 20 == 0)


@query
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return mincut.extract(pages, out="text").select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, whitening.fit(vectors))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    return trie.build(
        table(spark, sf_dir, "conversations"), donor=conv - conv % 100,
        cut=F.pmod(F.crc32(conv.cast("string")), F.lit(6)), most=5).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")


ORACLES["op13_prefix_trie"] = """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
crc_table AS (
    SELECT list(list_reduce(list_prepend(b, list_transform(range(8), lambda z: z)),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
        ORDER BY b) AS t FROM range(256) AS r(b)),
cuts AS (
    SELECT conv_id, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
                                                        lambda z: ord(z)::BIGINT)),
        lambda c, z: xor(c >> 8, t[(xor(c, z) & 255) + 1])), 4294967295) % 6 AS h
    FROM ids, crc_table),
turns AS (
    SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list({'r': r, 'x': x} ORDER BY i) AS l FROM turns GROUP BY conv_id),
made AS (
    SELECT a.conv_id, list_concat(coalesce(b.l[1:h], []), a.l[h + 1:]) AS s
    FROM own a JOIN cuts USING (conv_id) LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
steps AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM made),
path AS (
    SELECT conv_id, d, d = len(s) AS ends, md5(to_json(s[1:d])::VARCHAR) AS k,
           CASE WHEN d > 0 THEN md5(to_json(s[1:d - 1])::VARCHAR) END AS up,
           CASE WHEN d > 0 THEN length(s[d].x) ELSE 0 END AS n
    FROM steps),
node AS (
    SELECT k, min(up) AS up, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * min(n) AS cost,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                           FILTER (WHERE ends), '')) AS ends_sha256
    FROM path GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up),
pairs AS (
    SELECT DISTINCT a.k AS k, b.k AS y FROM path a JOIN path b USING (conv_id) WHERE b.d >= a.d),
below AS (
    SELECT pairs.k, sum(cost) AS saved_tokens, count(*) FILTER (WHERE kids.k IS NULL) AS n_leaves
    FROM pairs JOIN node ON node.k = y LEFT JOIN kids ON kids.k = y GROUP BY pairs.k)
SELECT node.conv_id, node.depth, above.conv_id AS parent_conv_id, node.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
       node.ends_sha256
FROM node JOIN below USING (k) LEFT JOIN kids USING (k) LEFT JOIN node above ON above.k = node.up
"""
