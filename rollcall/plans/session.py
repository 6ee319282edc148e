"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the plans need to give right answers, and what lets AQE split hot keys at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # groups a task keeps in memory before it sorts; the groups here are a few small values
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the cluster's own setting first.

    Only a local master, where driver and executors share one disk, may do without the setting.
    """
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        found = spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def written(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back, for what several results are made from.

    A lost executor costs a task retry, never the rows: nothing is kept in executors.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rollcall")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
