"""The corpus pipeline: toxic documents go, one document of each group of near copies stays,
documents with benchmark passages go, secrets are replaced, and what is left is packed.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``.

Defined results: rows without an id, and null or empty texts, are kept by the filtering stages;
rows that share an id are told apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import decontam, ngram_join, packing, secrets, toxicity
from rollcall.llm.common import free_name, id_filter, marked, table, written

ORACLE_SQL = None        # classifiers, edit matching and packing have no SQL form


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    slot = free_name(docs, "toxicity")
    return toxicity.grade(docs, model, out=slot).where(
        F.col(slot)["chance"] < toxicity.REJECT).drop(slot)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of links the row with the smallest id (and, of texts that share it, hash).

    Rows are judged by id and text, so unlike texts under one id all stay.  Most documents stay,
    and the filter of fixed size tells most of them without a join; only the others are shuffled.
    """
    found = written(ngram_join.roots_of(docs), "near-copies").where("root is not null")
    groups = found.groupBy("root").agg(
        F.min(F.struct("doc_id", "h")).alias("first"), F.count(F.lit(1)).alias("rows"))
    judged = written(found.select("root", "doc_id", "h").join(
        groups.where("rows > 1"), "root").groupBy(F.col("doc_id").alias("id"), F.col("h").alias("_h"))
        .agg(F.min((F.struct("doc_id", "h") == F.col("first")).cast("int")).alias("stays")), "judged")
    flat = id_filter(judged.select("id"))
    asked, h = free_name(docs, "_asked"), free_name(docs, "_text")
    every = marked(docs, flat, asked)
    clear = every.where(~F.col(asked)).drop(asked)
    rest = every.where(F.col(asked)).drop(asked).withColumn(h, F.xxhash64("text"))
    met = rest.join(judged, (F.col("doc_id") == F.col("id")) & (F.col(h) == F.col("_h")), "left")
    alone = met.where(F.col("stays").isNull()).select(docs.columns)
    # rows equal in id and text: one of them, chosen by partial aggregation
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = met.where("stays = 1").groupBy("doc_id", h).agg(F.min_by(
        whole, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    kept = one.select(*[F.col("row")[c].alias(c) for c in docs.columns])
    return clear.unionByName(alone).unionByName(kept)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    slot = free_name(docs, "leaks")
    return decontam.find(docs, table(spark, sf_dir, "benchmark"), out=slot).where(
        F.size(slot) == 0).drop(slot)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(
        F.char_length("text").cast(kind), F.col("n_chars"))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", keep_one_of_each_group),
    ("decontamination", drop_leaks),
    ("secrets", replace_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
