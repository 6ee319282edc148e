"""The prefix trie against plain dictionaries."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from rollcall.llm import trie
from rollcall.llm.common import written
from rollcall.llm.queries import QUERIES

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, HI string, w string"


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(own.get(c - c % 100, [])[:h]) + tuple(turns[h:])
    members, ends = {}, {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    kids, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + (
            (len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        if node:
            up = node[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), kids.get(n, 0), leaves[n],
         saved[n], hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
        for n, m in members.items())


def built(spark, rows):
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    conv = F.col("conv_id")
    got = trie.build(table, donor=conv - conv % 100,
                     cut=F.pmod(F.crc32(conv.cast("string")), F.lit(6)))
    assert [c for c in got.columns] and set(COLUMNS) == set(got.columns)
    return sorted(tuple(-1 if v is None else v for v in r) for r in got.select(*COLUMNS).collect())


def test_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice("ua"), "x" * rng.randint(0, 2))
            for c in range(0, 340) for t in range(rng.randint(1, 9)) if c % 100 or c != 200]
    rng.shuffle(rows)
    assert built(spark, rows) == brute_force(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "u", "lost"), (100, None, None, None), (100, None, None, None),
        (100, 2, "u", "é" * 70_000), (101, 1, "u", "b"), (101, 1, "u", "a"), (101, 1, "a", "a"),
        (7, 0, None, "own"), (-5, 3, "u", "before"), (-5, 1, "u", ""), (300, 0, "", ""),
        (301, 0, "", None), (301, 0, "", None),
    ]
    assert built(spark, rows) == brute_force(rows)


def test_long_conversation_is_cut_and_put_together(spark):
    rows = [(5, t, "u", f"{t % 3}") for t in range(3000)]
    rows += [(6, t, "u", f"{t % 3}") for t in range(2500)]
    rows += [(c, 0, "u", "hello") for c in range(100, 400)]
    rows += [(9, 4, "u", "same")] * 500
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert len(trie.bases_of(written(trie.turns_in_order(table), "t"))) > 1
        assert built(spark, rows) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert trie.build(table).collect() == []
    one = spark.createDataFrame([(3, 0, "u", "hi", "x", "y")], SCHEMA)
    assert trie.build(one).count() == 2


def test_chunks_of_ids(spark):
    found = spark.range(9000).select(
        F.col("id").alias("conv_id"), (F.col("id") % 2).alias("f_hi"), F.lit(0).alias("f_lo"))
    got = {r.hi: r.ends_sha256 for r in trie.end_digests(found).collect()}
    for k in (0, 1):
        text = ",".join(str(i) for i in range(9000) if i % 2 == k)
        assert got[k] == hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_prefix_trie"](spark, sf)
    assert tuple(got.columns) == COLUMNS
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got.collect()) == \
        brute_force(rows)
