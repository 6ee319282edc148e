"""Sharding: consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of 2^32 places; a row's place is the hash of its key,
and it belongs to the shard whose point comes next clockwise.  A shard holds no more rows than its
bound; rows that find it full go on clockwise to the next shard that has room.  With the bounds
``ceil``/``floor`` of rows / shards (law ``rows``), counts differ by one at most.

How it is spread: rows are counted per arc (between two points), which gives ``shards * vnodes``
numbers at any input size.  The driver lets the *counts* flow clockwise in rounds and gets, per
arc, how many of its rows stay and how many go on to which shard: the portions, of which there are
at most ``shards`` per arc.  Rows get a gapless rank within their arc, from counts of hash cells,
and the portion that holds the rank names shard and slot.  No row travels to the driver, and a key
that a third of all rows share is one arc whose cells are numbered apart.

Defined results: a null key hashes as an empty text; equal keys share a place and so a shard as
far as its bound goes; repeated rows take one slot each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, ranked

RING = 1 << 32
ROWS_PER_CELL = 1024


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted points, shard of each); where points coincide the smaller shard keeps the place."""
    at: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            at.setdefault(xxhash.xxh64_intdigest(f"{shard}:{v}") % RING, shard)
    points = np.array(sorted(at), dtype=np.int64)
    return points, np.array([at[p] for p in points.tolist()], dtype=np.int64)


def owner(points: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Number of the arc that ends at the next point clockwise."""
    return np.searchsorted(points, places, side="left") % len(points)


def flow(counts: np.ndarray, shard_of: np.ndarray, bounds: np.ndarray):
    """Portions (arc, first rank, end rank, shard, first slot) under the bounds.

    In each round every arc offers its rows to the shard it has come to; shards take in ring order
    while there is room, and what is left goes on to the next shard clockwise.
    """
    n = len(counts)
    room = bounds.astype(np.int64).copy()
    filled = np.zeros_like(room)
    left = counts.astype(np.int64).copy()
    taken = np.zeros(n, np.int64)
    at = np.arange(n)
    out = []
    while left.any():
        for arc in np.flatnonzero(left):
            shard = shard_of[at[arc]]
            k = min(left[arc], room[shard])
            if k:
                out.append((int(arc), int(taken[arc]), int(taken[arc] + k), int(shard),
                            int(filled[shard])))
                taken[arc] += k
                left[arc] -= k
                room[shard] -= k
                filled[shard] += k
        for arc in np.flatnonzero(left):
            at[arc] = (at[arc] + 1) % n
            while not room[shard_of[at[arc]]]:
                at[arc] = (at[arc] + 1) % n
    return out


def bounds_for(rows: int, shards: int) -> np.ndarray:
    """Bounds that sum to ``rows``: the first ``rows % shards`` shards may hold one more."""
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], np.int64)


def shard(df: DataFrame, key: Column, order: list[str], shards: int = 16, vnodes: int = 64,
          out: str = "shard", slot: str = "slot") -> DataFrame:
    """``df`` with its shard and its slot there (gapless from 0); ``order`` tells rows apart.

    Names that ``df`` has already get underscores.
    """
    spark = df.sparkSession
    out, slot = free_name(df, out), free_name(df, slot)
    points, shard_of = ring(shards, vnodes)

    @F.pandas_udf("int")
    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series(owner(points, place.to_numpy()).astype(np.int32))

    arc, rank = free_name(df, "_arc"), free_name(df, "_rank")
    place = F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(RING))
    placed = df.withColumn(arc, arc_of(place))
    counts = np.zeros(len(points), np.int64)
    for r in placed.groupBy(arc).count().collect():     # at most shards * vnodes numbers
        counts[r[0]] = r[1]
    portions = flow(counts, shard_of, bounds_for(int(counts.sum()), shards))
    names = [free_name(df, n) for n in ("_in", "_lo", "_hi", "_shard", "_first")]
    small = spark.createDataFrame(portions, ", ".join(f"{n} long" for n in names))
    numbered = ranked(placed, [arc], order, rank, ROWS_PER_CELL)
    got = numbered.join(F.broadcast(small),             # at most shards^2 * vnodes rows
                        (F.col(arc) == F.col(names[0])) & (F.col(rank) >= F.col(names[1]))
                        & (F.col(rank) < F.col(names[2])))
    return got.select(*[F.col(f"`{c}`") for c in df.columns],
                      F.col(names[3]).cast("int").alias(out),
                      (F.col(rank) - F.col(names[1]) + F.col(names[4])).alias(slot))
