"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py [sf] [name...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "~" if v != v else repr(round(v, 9))
    if hasattr(v, "item"):
        return _cell(v.item())
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_cell(r[i]) for i in order) for r in rows
    )


def compare(spark, con, sf_dir: str, name: str):
    """None when equal, else a message."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    oracle = entry.oracle_sql().get(name)
    if oracle is None:
        return None if got else "no rows"
    cur = con.execute(oracle)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        a = [r for r in got if r not in set(want)][:3]
        b = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} vs {len(want)}\n   spark only {a}\n   sql only   {b}"
    if not got:
        return "both empty"
    return None


def main(argv):
    from rollcall.plans.session import local_session

    sf = argv[0] if argv else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    import __spark_entry__ as entry

    names = argv[1:] or list(entry.queries())
    spark, con, bad = local_session(8), connect(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - t:5.1f}s {name}"
              + ("" if problem is None else f": {problem}"), flush=True)
    print(f"{len(names)} queries, {bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
