"""Human review over the record store, in bulk: decisions come as a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.constants import RAW_TO_REVIEWED
from rollcall.operators import commits
from rollcall.operators.store import KEYS, upsert
from rollcall.plans.session import written
from rollcall.schemas import RECORDS, REVIEW_STATUS

ENTITY_COLUMNS = [("raw", r) for r in RAW_TO_REVIEWED] + [
    ("reviewed", r) for r in RAW_TO_REVIEWED.values()
]
STATUS_KEYS = ["source_table", "tenant", "record_key"]


def _raw_table() -> Column:
    return F.concat(F.lit("raw_"), F.col("entity"))


def list_with_status(records: DataFrame, status: DataFrame) -> DataFrame:
    """Raw records with their review status; null status = pending."""
    raw = records.where(F.col("tier") == "raw").withColumn("source_table", _raw_table())
    return raw.join(status.select(*STATUS_KEYS, "status", "reviewed_at"), STATUS_KEYS, "left")


def review_rows(records: DataFrame, status: DataFrame) -> DataFrame:
    """What a review page shows: the record and 'pending', 'approved' or 'rejected'."""
    return list_with_status(records, status).withColumn(
        "status", F.coalesce("status", F.lit("pending"))
    )


def known_decisions(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decisions on known raw entities, the others)."""
    known = F.col("entity").isin(*RAW_TO_REVIEWED)
    return decisions.where(known), decisions.where(~F.coalesce(known, F.lit(False)))


def _reviewed_entity() -> Column:
    out = None
    for raw, reviewed in RAW_TO_REVIEWED.items():
        out = (F if out is None else out).when(F.col("entity") == raw, F.lit(reviewed))
    return out


def resolve_approvals(records: DataFrame, approvals: DataFrame) -> DataFrame:
    """Approvals with the data they publish: the edited text, else the raw record's.

    ``ok`` is false when there is neither; an edited approval does not ask for a raw row.
    """
    raw = records.where(F.col("tier") == "raw").select(
        "entity", "tenant", "record_key", F.col("data").alias("_raw")
    )
    found = approvals.join(raw, ["entity", "tenant", "record_key"], "left")
    data = F.coalesce("edited_data", "_raw")
    return found.withColumn("data", data).withColumn("ok", data.isNotNull()).drop("_raw")


def reviewed_copies(resolved: DataFrame, now: Column, seq: str = "seq") -> DataFrame:
    """The reviewed rows that approvals publish."""
    return resolved.where("ok").select(
        F.lit("reviewed").alias("tier"), _reviewed_entity().alias("entity"), "tenant",
        "record_key", "data", now.alias("updated_at"), seq,
    )


def status_rows(decisions: DataFrame, outcome: str, now: Column, seq: str = "seq") -> DataFrame:
    return decisions.select(
        _raw_table().alias("source_table"), "tenant", "record_key",
        F.lit(outcome).alias("status"), now.alias("reviewed_at"), seq,
    )


def approve(records: DataFrame, resolved: DataFrame, now: Column, seq: str = "seq") -> DataFrame:
    """Records after the approvals: reviewed copies inserted or replaced, raw rows untouched."""
    return upsert(records, reviewed_copies(resolved, now, seq), KEYS, seq)


def decide(status: DataFrame, decisions: DataFrame, outcome: str, now: Column,
           seq: str = "seq") -> DataFrame:
    """Review status after decisions with one outcome ('approved' or 'rejected').

    A rejection changes nothing but the status: an earlier reviewed copy stays.
    """
    return upsert(status, status_rows(decisions, outcome, now, seq), STATUS_KEYS, seq)


# --- tenants ----------------------------------------------------------------------------------

def tenant_summary(records: DataFrame) -> DataFrame:
    """Rows per (tier, entity) as columns and in total, for tenants seen in raw tables.

    One aggregation of counters: the tenant filter is a count too, not a join.
    """
    cols = [
        F.count_if((F.col("tier") == t) & (F.col("entity") == e)).alias(f"{t}_{e}")
        for t, e in ENTITY_COLUMNS
    ]
    wide = records.where(F.col("tenant") != "").groupBy("tenant").agg(*cols)

    def total(tier):
        return reduce(lambda a, b: a + b,
                      [F.col(f"{t}_{e}") for t, e in ENTITY_COLUMNS if t == tier])

    return wide.withColumn("total_raw", total("raw")).withColumn(
        "total_reviewed", total("reviewed")
    ).where("total_raw > 0")


def merge_collisions(records: DataFrame, source: str, target: str) -> DataFrame:
    """Keys of the source tenant that the target tenant has too, one row each."""
    s, t = F.count_if(F.col("tenant") == source), F.count_if(F.col("tenant") == target)
    return (
        records.where(F.col("tenant").isin(source, target))
        .groupBy("tier", "entity", "record_key")
        .agg(s.alias("_s"), t.alias("_t"))
        .where("_s > 0 and _t > 0")
        .select("tier", "entity", "record_key")
    )


def preview_merge(records: DataFrame, source: str, target: str) -> DataFrame:
    """Per entity table: rows of the source, how many collide, how many would move."""
    s, t = F.count_if(F.col("tenant") == source), F.count_if(F.col("tenant") == target)
    per_key = (
        records.where(F.col("tenant").isin(source, target))
        .groupBy("tier", "entity", "record_key").agg(s.alias("_s"), t.alias("_t"))
    )
    return per_key.groupBy("tier", "entity").agg(
        F.sum("_s").alias("would_move"),
        F.count_if((F.col("_s") > 0) & (F.col("_t") > 0))
        .alias("collisions"),
    ).withColumn("moving", F.col("would_move") - F.col("collisions"))


def merge_breakdown(records: DataFrame, source: str, target: str) -> DataFrame:
    """:func:`preview_merge` for every table there is, with zeros for those without rows."""
    spark = records.sparkSession
    every = spark.createDataFrame(ENTITY_COLUMNS, "tier string, entity string")
    found = preview_merge(records, source, target)
    numbers = ["would_move", "collisions", "moving"]
    return every.join(found, ["tier", "entity"], "left").select(
        "tier", "entity", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers])


def execute_merge(records: DataFrame, source: str, target: str) -> DataFrame:
    """Source rows re-keyed to the target unless their key is taken; nothing else changes.

    Only the two tenants' rows are joined, the rest pass through.  Review status is not moved
    (see :func:`move_status`).
    """
    keys = ["tier", "entity", "record_key"]
    taken = records.where(F.col("tenant") == target).select(*keys).distinct().withColumn(
        "_taken", F.lit(True))
    moved = records.where(F.col("tenant") == source).join(taken, keys, "left").withColumn(
        "tenant", F.when(F.col("_taken"), F.col("tenant")).otherwise(F.lit(target))
    ).select(*records.columns)
    return records.where(~F.col("tenant").eqNullSafe(source)).unionByName(moved)


def move_status(status: DataFrame, source: str, target: str) -> DataFrame:
    """Optional companion of a merge: status rows follow, unless the target has its own."""
    keys = ["source_table", "record_key"]
    taken = status.where(F.col("tenant") == target).select(*keys).distinct()
    mine = status.where(F.col("tenant") == source)
    follow = mine.join(taken, keys, "left_anti").withColumn("tenant", F.lit(target))
    stay = mine.join(taken, keys, "left_semi")
    rest = status.where(~F.col("tenant").eqNullSafe(source))
    return rest.unionByName(follow.select(*status.columns)).unionByName(
        stay.select(*status.columns)
    )


# --- in a store of several tables -------------------------------------------------------------

STORE_TABLES = {
    "records": commits.Table(RECORDS, KEYS, commits.BUCKETS),
    "review_status": commits.Table(REVIEW_STATUS, STATUS_KEYS, commits.BUCKETS),
}


def create_store(spark: SparkSession, path: str, buckets: int = commits.BUCKETS) -> commits.Snapshot:
    """The record and status tables, where they do not exist yet."""
    return commits.create(spark, path, {
        n: commits.Table(t.schema, t.keys, buckets) for n, t in STORE_TABLES.items()})


def approve_in_store(spark: SparkSession, path: str, decisions: DataFrame, now: Column,
                     seq: str = "seq", writer: str | None = None, number: int = 0) -> DataFrame:
    """Publish approved copies and the status 'approved' in ONE version; the decisions left over.

    Left over are those on unknown entities and those with neither an edit nor a raw record, which
    change nothing.  If anything is published meanwhile, the copies are worked out anew.
    """
    known, unknown = known_decisions(decisions)
    while True:
        snap = commits.snapshot(spark, path)
        resolved = written(resolve_approvals(commits.read(spark, snap, "records"), known),
                           "approvals")
        fits = resolved.where("ok")
        try:
            commits.commit(
                spark, path, {"records": reviewed_copies(fits, now, seq),
                              "review_status": status_rows(fits, "approved", now, seq)},
                seq, writer, number, based_on=snap)
        except commits.Conflict:
            continue
        return unknown.unionByName(resolved.where("not ok").select(*unknown.columns))


def reject_in_store(spark: SparkSession, path: str, decisions: DataFrame, now: Column,
                    seq: str = "seq", writer: str | None = None, number: int = 0) -> None:
    """Publish the status 'rejected' of decisions on known entities; records stay as they are."""
    known, _ = known_decisions(decisions)
    commits.commit(spark, path, {"review_status": status_rows(known, "rejected", now, seq)},
                   seq, writer, number)


def merge_in_store(spark: SparkSession, path: str, source: str, target: str,
                   writer: str | None = None, number: int = 0) -> None:
    """Re-key the source tenant's rows to the target in one version, but for taken keys."""
    keys = ["tier", "entity", "record_key"]
    while True:
        snap = commits.snapshot(spark, path)
        records = commits.read(spark, snap, "records")
        taken = records.where(F.col("tenant") == target).select(*keys)
        moving = records.where(F.col("tenant") == source).join(taken, keys, "left_anti").select(
            *records.columns)
        both = F.explode(F.array(
            F.struct(F.lit(source).alias("t"), F.lit(True).alias("g")),
            F.struct(F.lit(target).alias("t"), F.lit(False).alias("g")))).alias("x")
        rows = moving.select("*", both).withColumn("tenant", F.col("x.t")).withColumn(
            commits.GONE, F.col("x.g")).drop("x")
        try:
            commits.commit(spark, path, {"records": rows}, writer=writer, number=number,
                           based_on=snap)
        except commits.Conflict:
            continue
        return


# --- edits ------------------------------------------------------------------------------------

def edited_value(text: Column, kind: str) -> Column:
    """Form text as a value: number, boolean, comma list (trimmed, empties dropped), or text."""
    if kind == "number":
        return text.try_cast("double")
    if kind == "boolean":
        return text == "true"
    if kind == "list":
        return F.filter(F.transform(F.split(text, ","), lambda s: F.trim(s)), lambda s: s != "")
    return text


def set_path(root: Column, path: str, value: Column) -> Column:
    """Copy of a nested column with the value at ``a.b[0].c`` replaced."""
    steps = [p for p in path.replace("]", "").replace("[", ".#").split(".") if p]

    def put(node: Column, rest: list[str]) -> Column:
        if not rest:
            return value
        head, tail = rest[0], rest[1:]
        if head.startswith("#"):
            at = int(head[1:])
            return F.transform(
                node, lambda x, i: F.when(i == at, put(x, tail)).otherwise(x)
            )
        return node.withField(head, put(node[head], tail))

    return put(root, steps)
