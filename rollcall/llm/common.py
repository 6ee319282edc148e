"""Helpers the operators of this package share."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rollcall.plans.session import checkpoint_dir


FILTER_BITS = 26          # 8 MB


# What a Python worker is given at once: texts are long, and two workers share an executor's memory.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
           "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def bounded(spark: SparkSession) -> SparkSession:
    """The session with batches no larger than ``BATCHES``; smaller ones stay."""
    for key, most in BATCHES.items():
        now = spark.conf.get(key, None)
        try:
            if now is not None and 0 < int(now) <= most:
                continue
        except ValueError:                           # a size with a unit
            pass
        spark.conf.set(key, str(most))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, survives lost executors.

    Spark removes the shuffle files of a plan once the driver's garbage collector has found it
    unused.  It is asked to look here, as work in many rounds would else keep all of them to its end.
    """
    spark = bounded(df.sparkSession)
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or the first ``wanted_`` ... that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` with the fields of ``ddl`` after its own."""
    return StructType(df.schema.fields + StructType.fromDDL(ddl).fields)


def with_struct(df: DataFrame, name: str, ddl: str) -> StructType:
    return StructType([*df.schema.fields, StructField(name, StructType.fromDDL(ddl))])


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))


def per_batch(make):
    """``mapInArrow`` body from ``make() -> (RecordBatch -> RecordBatch)``; state lives per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            if batch.num_rows:
                fn = fn or make()
                yield fn(batch)

    return run


def handed_out(df: DataFrame, value):
    """A function that gives ``value`` inside tasks; it is broadcast, so its size must be bounded."""
    held = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str, per_task: int) -> DataFrame:
    """Adds ``rank``, 0-based and gapless within ``group``, in the order of a hash of ``order``.

    A group may hold a third of all rows: it is cut into cells of about ``per_task`` rows by the
    hash, cells are counted (partially aggregated), a running sum over the *counts* places each
    cell, and rows are numbered within their cell only.  ``order`` should tell rows apart; rows
    equal in all of it get one number each, in any order.
    """
    h, cells, cell, base = (free_name(df, n) for n in ("_h", "_cells", "_cell", "_base"))
    sizes = df.groupBy(*group).agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / per_task)).cast("long").alias(cells))
    keyed = df.withColumn(h, F.xxhash64(*[F.col(c) for c in order]))
    on = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    out = keyed.alias("l").join(sizes.alias("r"), cond, "left").select(
        *[F.col(f"l.{c}") for c in keyed.columns], F.col(f"r.{cells}"))
    out = out.withColumn(cell, F.pmod(F.col(h), F.col(cells))).drop(cells)
    counts = out.groupBy(*group, cell).agg(F.count(F.lit(1)).alias(base))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    within = Window.partitionBy(*group, cell).orderBy(h, *order)
    out = out.withColumn(rank, F.row_number().over(within) - 1)
    on = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in [*group, cell]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return out.alias("l").join(starts.alias("r"), cond, "left").select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col(f"l.{rank}") + F.col(f"r.{base}")).cast("long").alias(rank))


def id_filter(ids: DataFrame, bits: int = FILTER_BITS):
    """Filter of fixed size over the single long column of ``ids``: inside tasks, an array of
    64-bit words; see ``may_hold``."""
    col = F.col(ids.columns[0])
    places = F.array(*[F.pmod(F.xxhash64(col, F.lit(k)), F.lit(1 << bits)) for k in range(3)])
    at = ids.select(F.explode(places).alias("at"), col.alias("id"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("b"))
    got = words.toPandas()                                  # at most 2^bits / 64 rows
    flat = np.zeros(1 << (bits - 6), np.int64)
    flat[got["word"].to_numpy()] = got["b"].to_numpy()
    return flat


def marked(docs: DataFrame, flat: np.ndarray, out: str, bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with whether the filter may hold the doc_id; false for a null one."""
    give = handed_out(docs, flat)

    @F.pandas_udf("boolean")
    def may_hold(first, second, third):
        words = give()
        ok = np.ones(len(first), bool)
        for p in (first, second, third):
            at = p.to_numpy()
            ok &= (words[at >> 6] >> (at & 63)) & 1 == 1
        return type(first)(ok)

    return docs.withColumn(out, F.col("doc_id").isNotNull() & may_hold(*_places(bits)))


def _places(bits: int) -> list[Column]:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    return [F.pmod(F.xxhash64(doc, F.lit(k)), F.lit(1 << bits)) for k in range(3)]


def map_passing(docs: DataFrame, flat: np.ndarray, run, ddl: str,
                bits: int = FILTER_BITS) -> DataFrame:
    """``docs.mapInArrow(run, ddl)`` over the rows whose doc_id the filter may hold.

    The filter is looked at in the same Python worker as ``run``: one that is a step of its own
    would need another worker per task.
    """
    give, columns = handed_out(docs, flat), docs.columns
    names = [free_name(docs, n) for n in ("_a", "_b", "_c", "_known")]

    def body(batches):
        words = give()

        def kept():
            for batch in batches:
                ok = batch.column(names[3]).to_numpy(zero_copy_only=False).copy()
                for name in names[:3]:
                    at = batch.column(name).to_numpy()
                    ok &= (words[at >> 6] >> (at & 63)) & 1 == 1
                if ok.any():
                    yield batch.filter(pa.array(ok)).select(columns)

        yield from run(kept())

    more = [c.alias(n) for c, n in zip([*_places(bits), F.col("doc_id").isNotNull()], names)]
    return docs.select("*", *more).mapInArrow(body, ddl)


def passing(docs: DataFrame, flat: np.ndarray) -> DataFrame:
    """Rows whose doc_id the filter may hold; the others end in the scan."""
    slot = free_name(docs, "_asked")
    return marked(docs, flat, slot).where(F.col(slot)).drop(slot)
