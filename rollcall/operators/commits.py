"""A store of several tables that change together.

A store is a folder: ``data/<table>/<commit>`` holds Parquet files that never change once they are
published, ``log/v<number>`` one manifest per version, which names the folders every table is made
of.  A commit writes its folders first and then publishes the next manifest by one rename, so a
reader sees all tables before it or all after it, and a reader that holds a :class:`Snapshot` goes
on seeing its version whatever is committed meanwhile.  Two writers cannot both publish a version:
whoever finds the other's manifest in place tries again on top of it.  (The file system must rename
folders in one step, as HDFS and local disks do.)

A table is a base, bucketed by its key, and the changes since.  Reading picks the newest change of
each key and removes the changed keys from the base by an anti-join that takes the buckets as they
are: the base is streamed and never shuffled, however large it is.  :func:`compact` folds the
changes into a new base.

A repeated commit does nothing: a writer numbers its commits, and the manifest keeps the last
number of every writer.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.dedup import last_wins
from rollcall.sources.files import Folder

GONE = "_gone"             # a change with this flag removes its key
BUCKETS = 32               # of a base; a bucket should hold a few hundred MB


class Conflict(RuntimeError):
    """Another commit was published since the snapshot this one is based on."""


@dataclass(frozen=True)
class Table:
    """``order``: a column that says which row of a key is newest; by default the last commit's is."""

    schema: str
    keys: list[str]
    buckets: int
    order: str | None = None
    base: str | None = None
    changes: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Snapshot:
    path: str
    version: int
    commit: str
    tables: dict[str, Table]
    writers: dict[str, int]


# --- the log ----------------------------------------------------------------------------------

def _name(version: int) -> str:
    return f"log/v{version:012d}"


def _versions(folder: Folder) -> list[int]:
    return sorted(int(n[1:]) for n in folder.names("log") if n.startswith("v"))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The store at a version, by default the last one."""
    folder = Folder(spark, path)
    if version is None:
        found = _versions(folder)
        if not found:
            raise FileNotFoundError(f"no store at {path}")
        version = found[-1]
    held = json.loads(folder.read(f"{_name(version)}/manifest.json"))
    tables = {n: Table(**t) for n, t in held.pop("tables").items()}
    return Snapshot(path=path, tables=tables, **held)


def _publish(spark: SparkSession, new: Snapshot) -> bool:
    """Whether ``new`` became the manifest of its version."""
    folder = Folder(spark, new.path)
    held = {k: v for k, v in asdict(new).items() if k != "path"}
    mine = f"log/.{new.commit}"
    folder.write(f"{mine}/manifest.json", json.dumps(held))
    target = _name(new.version)
    if not folder.has(target):
        folder.move(mine, target)
    won = json.loads(folder.read(f"{target}/manifest.json"))["commit"] == new.commit
    if not won:
        folder.remove(mine)
    return won


def create(spark: SparkSession, path: str, tables: dict[str, Table]) -> Snapshot:
    """Make the tables that are not there; a store that has them all is left as it is."""
    while True:
        folder = Folder(spark, path)
        if not _versions(folder):
            head, missing = Snapshot(path, -1, "", {}, {}), tables
        else:
            head = snapshot(spark, path)
            missing = {n: t for n, t in tables.items() if n not in head.tables}
        if not missing:
            return head
        new = replace(head, version=head.version + 1, commit=uuid.uuid4().hex,
                      tables={**head.tables, **missing})
        if _publish(spark, new):
            return new


# --- reading ----------------------------------------------------------------------------------

def _base(spark: SparkSession, snap: Snapshot, name: str) -> DataFrame:
    """The base with its buckets, which only a catalog table can tell; its entry goes at once."""
    t = snap.tables[name]
    if t.base is None:
        return spark.createDataFrame([], t.schema)
    entry = f"base_{uuid.uuid4().hex}"
    keys = ", ".join(t.keys)
    spark.sql(f"CREATE TABLE {entry} ({t.schema}) USING parquet CLUSTERED BY ({keys}) "
              f"SORTED BY ({keys}) INTO {t.buckets} BUCKETS LOCATION '{snap.path}/{t.base}'")
    found = spark.table(entry)
    found.schema  # noqa: B018 - resolved before the entry goes; the files stay
    spark.sql(f"DROP TABLE {entry}")
    return found


def changed(spark: SparkSession, snap: Snapshot, name: str) -> DataFrame:
    """The newest change of every key since the base, removals among them."""
    t = snap.tables[name]
    schema = f"{t.schema}, {GONE} boolean"
    if not t.changes:
        return spark.createDataFrame([], schema)
    places = F.create_map(*[F.lit(v) for i, c in enumerate(t.changes) for v in (c, i)])
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/[^/]+)/[^/]+$", 1)
    rows = spark.read.schema(schema).parquet(*[f"{snap.path}/{c}" for c in t.changes])
    placed = rows.withColumn("_at", places[folder])
    if t.order:
        placed = placed.withColumn("_at", F.struct(t.order, "_at"))
    return last_wins(placed, t.keys, "_at").drop("_at")


def read(spark: SparkSession, snap: Snapshot, name: str) -> DataFrame:
    """The rows of a table at a snapshot."""
    t, base = snap.tables[name], _base(spark, snap, name)
    if not t.changes:
        return base
    new, rest = changed(spark, snap, name), base
    if t.base is not None:
        # built from the changed keys of a bucket, so that the base is not even sorted
        small = new.select(*t.keys, *([F.col(t.order).alias("_new")] if t.order else [])).hint(
            "shuffle_hash")
        if t.order:
            met = base.join(small, t.keys)
            late = met.where(F.col(t.order) > F.col("_new")).select(*t.keys)
            new = new.join(late, t.keys, "left_anti")            # few: rows that came too late
            same = base[t.keys[0]] == small[t.keys[0]]
            for k in t.keys[1:]:
                same = same & (base[k] == small[k])
            rest = base.join(small, same & (base[t.order] <= small["_new"]), "left_anti")
        else:
            rest = base.join(small, t.keys, "left_anti")
    return rest.select(*base.columns).unionByName(
        new.where(~F.col(GONE)).select(*base.columns))


# --- writing ----------------------------------------------------------------------------------

def commit(spark: SparkSession, path: str, changes: dict[str, DataFrame], seq: str = "seq",
           writer: str | None = None, number: int = 0,
           based_on: Snapshot | None = None) -> Snapshot:
    """Publish rows of several tables as one version.

    A row replaces the row of its key, of several rows of a key the one with the greatest ``seq``;
    a row with ``_gone`` removes it.  ``writer`` and ``number`` make a repeated commit a no-op.
    With ``based_on`` the commit is refused if anything was published since that snapshot, for
    changes that were worked out from what it holds.
    """
    made, first, mine = uuid.uuid4().hex, True, {}
    while True:
        head = snapshot(spark, path)
        if writer is not None and head.writers.get(writer, -1) >= number:
            return head
        if based_on is not None and head.commit != based_on.commit:
            raise Conflict(f"version {head.version} was published after {based_on.version}")
        if first:
            for name, rows in changes.items():
                mine[name] = f"data/{name}/{made}"
                _write_changes(rows, head.tables[name], seq, f"{path}/{mine[name]}")
            first = False
        tables = dict(head.tables)
        for name, folder in mine.items():
            tables[name] = replace(tables[name], changes=[*tables[name].changes, folder])
        writers = head.writers if writer is None else {**head.writers, writer: number}
        new = Snapshot(path, head.version + 1, made, tables, writers)
        if _publish(spark, new):
            return new
        time.sleep(0.05)


def _write_changes(rows: DataFrame, t: Table, seq: str, folder: str) -> None:
    if GONE not in rows.columns:
        rows = rows.withColumn(GONE, F.lit(False))
    wanted = [c for c in rows.columns if c != seq or c == t.order]
    newest = last_wins(rows, t.keys, seq) if seq in rows.columns else rows
    newest.select(*wanted).write.parquet(folder)


def _write_base(rows: DataFrame, t: Table, folder: str) -> None:
    entry = f"base_{uuid.uuid4().hex}"
    rows.repartition(t.buckets, *t.keys).write.format("parquet").bucketBy(
        t.buckets, *t.keys).sortBy(*t.keys).option("path", folder).saveAsTable(entry)
    rows.sparkSession.sql(f"DROP TABLE {entry}")


def load(spark: SparkSession, path: str, rows: dict[str, DataFrame]) -> Snapshot:
    """Publish whole tables as new bases, in one version; keys must be unique."""
    made, head = uuid.uuid4().hex, snapshot(spark, path)
    tables = dict(head.tables)
    for name, df in rows.items():
        folder = f"data/{name}/{made}"
        _write_base(df, head.tables[name], f"{path}/{folder}")
        tables[name] = replace(head.tables[name], base=folder, changes=[])
    new = replace(head, version=head.version + 1, commit=made, tables=tables)
    if not _publish(spark, new):
        raise Conflict(f"version {new.version} was published meanwhile")
    return new


def compact(spark: SparkSession, path: str) -> Snapshot:
    """Fold the changes of every table into a new base; nothing that is read changes."""
    head = snapshot(spark, path)
    due = {n: read(spark, head, n) for n, t in head.tables.items() if t.changes}
    return load(spark, path, due) if due else head


def vacuum(spark: SparkSession, path: str, keep: int = 10, hours: float = 24.0) -> list[str]:
    """Remove what only versions before the last ``keep`` need; the folders that went.

    Folders younger than ``hours`` stay: they may belong to a commit that is on its way.
    """
    folder = Folder(spark, path)
    versions = _versions(folder)
    kept = versions[-keep:]
    needed = set()
    for v in kept:
        for t in snapshot(spark, path, v).tables.values():
            needed |= {*t.changes, *([t.base] if t.base else [])}
    before, gone = (time.time() - hours * 3600) * 1000, []
    for name in folder.names("data"):
        for made, at in folder.names(f"data/{name}").items():
            place = f"data/{name}/{made}"
            if place not in needed and at <= before:
                folder.remove(place)
                gone.append(place)
    for v in versions[:-keep]:
        folder.remove(_name(v))
    return sorted(gone)
