"""Incremental upsert: a stream of observation files into the record store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rollcall.operators import commits
from rollcall.operators.store import write_version


def observation_stream(spark: SparkSession, path: str, schema: str,
                       files_per_trigger: int = 1000) -> DataFrame:
    """New files below ``path`` as they arrive."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def stream_upserts(
    records: DataFrame, store: str, checkpoint: str, first_version: int = 1
) -> StreamingQuery:
    """Each micro-batch becomes one version of the store.

    The version is the batch id, so a replayed batch overwrites its own version and the store
    ends the same.  ``records`` has the record columns and ``seq``.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, store, first_version + batch_id)

    return (
        records.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_commits(
    rows: DataFrame, path: str, table: str, checkpoint: str, writer: str, seq: str = "seq"
) -> StreamingQuery:
    """Each micro-batch, of however many files, becomes one commit to a table of a store.

    A batch that is run again is known by its number.  With a table that is ordered by ``seq``,
    rows that come late or again, in whatever batch, change nothing: the state is the table itself,
    so no watermark cuts them off, and no state store has to hold all keys.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        commits.commit(batch.sparkSession, path, {table: batch}, seq, writer, batch_id)

    return (
        rows.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
