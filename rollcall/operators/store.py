"""Record store: upsert of keyed records, on DataFrames and on disk.

On disk the store is plain Parquet, partitioned by ``version, tier, entity``.  An upsert appends
one version holding only the rows it brings, so its cost follows the batch and not the table; a
replay of a version overwrites exactly that version.  :func:`current` reads the latest row per
key, :func:`compact` folds the versions when there are many.  Versions are written in full before
they are read, so a lost executor costs a task retry and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.constants import RAW_KEY_FIELDS, RAW_TO_REVIEWED, REVIEWED_KEY_FIELDS
from rollcall.operators.dedup import last_wins
from rollcall.schemas import RECORDS, REVIEW_STATUS

KEYS = ["tier", "entity", "tenant", "record_key"]
MAX_TEXT = 2**31 - 1  # the longest text a value can have


def check_entity(entity: str) -> str:
    """Raw entity names are a closed list."""
    if entity not in RAW_TO_REVIEWED:
        raise ValueError(f"unknown or unmapped raw entity: {entity!r}")
    return entity


def key_field(tier: str, entity: str) -> str:
    return (RAW_KEY_FIELDS if tier == "raw" else REVIEWED_KEY_FIELDS)[entity]


def to_records(
    df: DataFrame, tier: str, entity: str, now: Column | None = None, key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(records, rejected rows) of an entity table; a null key is rejected, not stored as text."""
    key = key or key_field(tier, entity)
    body = [c for c in df.columns if c not in ("tenant", "seq")]
    made = df.select(
        F.lit(tier).alias("tier"), F.lit(entity).alias("entity"), "tenant",
        F.col(key).cast("string").alias("record_key"),
        F.to_json(F.struct(*body)).alias("data"),
        (F.current_timestamp() if now is None else now).alias("updated_at"),
        *(["seq"] if "seq" in df.columns else []),
    )
    return made.where(F.col("record_key").isNotNull()), made.where(F.col("record_key").isNull())


def flatten_map(df: DataFrame, entries: str, key: str) -> DataFrame:
    """One row per entry of a map of structs: the key and the fields of its value."""
    rest = [c for c in df.columns if c != entries]
    return df.select(*rest, F.explode(entries).alias(key, "_v")).select(*rest, key, "_v.*")


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Existing rows not in the batch, plus the last row of each batch key (whole-row replace).

    The anti-join leaves the choice to Spark: a small batch is broadcast and the existing table
    is only streamed through, a large one is shuffled on the key.
    """
    newest = last_wins(batch, keys, seq).select(*existing.columns)
    return existing.join(newest.select(*keys), keys, "left_anti").unionByName(newest)


# --- on disk ----------------------------------------------------------------------------------

def init_store(spark: SparkSession, path: str) -> None:
    """An empty first version, when the store does not exist yet."""
    from rollcall.sources.artifacts import path_exists

    if not path_exists(spark, f"{path}/records"):
        write_version(spark.createDataFrame([], RECORDS + ", seq bigint"), path, 0)
    if not path_exists(spark, f"{path}/review_status"):
        spark.createDataFrame([], REVIEW_STATUS).write.parquet(f"{path}/review_status")


def write_version(batch: DataFrame, path: str, version: int) -> None:
    """Write (or rewrite) one version: the last row per key of the batch."""
    newest = last_wins(batch, KEYS, "seq").drop("seq")
    (
        newest.write.mode("overwrite").partitionBy("tier", "entity")
        .parquet(f"{path}/records/version={version}")
    )


def current(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every key over all versions.

    Latest is by ``updated_at``, then by version, so files that arrive late change nothing.  Only
    the versions since the last :func:`compact` are aggregated; against them the base (version 0)
    is anti-joined, which streams it through without a shuffle while they are small.
    """
    rows = spark.read.option("basePath", f"{path}/records").schema(
        f"{RECORDS}, version bigint"
    ).parquet(f"{path}/records")
    base = rows.where("version = 0").drop("version")
    placed = rows.where("version > 0").withColumn("_at", F.struct("updated_at", "version"))
    newest = last_wins(placed.drop("version"), KEYS, "_at").drop("_at")
    # the few new rows that are older than what the base has (late arrivals)
    late = base.select(*KEYS, F.col("updated_at").alias("_u")).join(newest, KEYS).where(
        F.col("_u") > F.col("updated_at")
    ).select(*KEYS)
    fresh = newest.join(late, KEYS, "left_anti").select(*base.columns)
    return base.join(fresh.select(*KEYS), KEYS, "left_anti").unionByName(fresh)


def compact(spark: SparkSession, path: str, out: str) -> None:
    """Fold all versions into version 0 of a store at a NEW path."""
    current(spark, path).write.partitionBy("tier", "entity").parquet(f"{out}/records/version=0")


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of :func:`save_json`, texts of any length; a line that cannot be read is an error.

    Left to itself the reader makes a row of nulls of each line with more than 20 million characters in a text.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST").option(
        "maxStringLen", MAX_TEXT).json(path)
