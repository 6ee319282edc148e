"""Approximate nearest neighbours by largest inner product: robust-pruned directed graphs.

Equal vectors are collapsed into one node first (a vector that a third of all rows hold is one
node).  Nodes are dealt to shards of bounded size by their length, in half octaves, and within such a
band by a hash of the vector.  Per shard a graph is
built in batches: greedy beam searches over the graph so far propose neighbours, and pruning with
relaxed distances keeps the nearest candidate, drops those that are ``ALPHA`` times nearer to it
than to the node, and so on, which leaves diverse edges.  Inner products become Euclidean distances
by one more coordinate, sqrt(longest^2 - |x|^2), which stays of the size of the others as no vector
of a shard is much shorter than its longest.  One task per shard reads its graph once and lets all
queries stream past it in batches; the beam search ranks by inner products in double precision,
exact scores are taken on the original vectors, and the shards' lists are merged.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do rows without an id or vectors of another length than most; rows equal in id and vector
count once; ties go to the smaller id; a query with fewer candidates than asked for gets all (a
shard no larger than the beam is searched whole); an empty table gives no rows.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import written

DEGREE = 32
BEAM = 96
ALPHA = 1.2
BATCH = 512
SHARD_ROWS = 100_000
LEAST_SHARDS = 6
ENTRIES = 8


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Distinct (id, v) rows that take part; ``v`` is the vector in double precision."""
    v = F.col(vector)
    ok = df.where(F.col(key).isNotNull() & v.isNotNull()).where(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))
    return ok.select(F.col(key).cast("long").alias("id"), v.cast("array<double>").alias("v"))


def nodes(rows: DataFrame, keep: int) -> DataFrame:
    """(v, members): the distinct vectors with the ``keep`` smallest ids that hold each.

    No more of them can be among a query's ``keep - 1`` nearest; the ranking window is limited
    before the shuffle, so a hot vector does not gather its rows in one task.
    """
    first = Window.partitionBy("v").orderBy("id")
    few = rows.dropDuplicates(["id", "v"]).withColumn("k", F.row_number().over(first)).where(
        F.col("k") <= keep)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("members"))


class Graph:
    """Directed graph over the rows of ``x`` (augmented), searched by beams in lockstep."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, seed: int = 7):
        self.x, self.degree = x, degree
        n = len(x)
        rng = np.random.default_rng(seed)
        self.edges = np.full((n, degree), -1, np.int32)
        self.sq = np.einsum("ij,ij->i", x, x)
        middle = int(np.argmin(self.sq - 2 * x @ x.mean(axis=0)))
        self.entries = np.unique(np.concatenate(
            ([middle], rng.choice(n, min(n, ENTRIES), replace=False)))).astype(np.int32)

    def search(self, q: np.ndarray, beam: int,
               v: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, distances) of each query's beam, nearest first; -1 fills up.

        With ``v``, the vectors of the nodes, the nearest are those of the largest inner product.
        """
        x, sq = (self.x, self.sq) if v is None else (v, np.zeros(len(v), v.dtype))
        b, n = len(q), len(x)
        starts = np.arange(n, dtype=np.int32) if n <= beam else self.entries
        ids = np.full((b, beam), -1, np.int32)
        dist = np.full((b, beam), np.inf, x.dtype)
        done = np.ones((b, beam), bool)
        seen = np.zeros((b, n), bool)
        k = min(len(starts), beam)
        first = sq[starts] - 2 * q @ x[starts].T
        order = np.argsort(first, axis=1)[:, :k]
        ids[:, :k] = starts[order]
        dist[:, :k] = np.take_along_axis(first, order, 1)
        done[:, :k] = n <= beam
        seen[:, starts] = True
        live = np.arange(b)
        while len(live):
            open_ = ~done[live]
            has = open_.any(axis=1)
            live, open_ = live[has], open_[has]
            if not len(live):
                break
            at = open_.argmax(axis=1)
            done[live, at] = True
            near = self.edges[ids[live, at]]                       # (live, degree)
            fresh = (near >= 0) & ~seen[live[:, None], near]
            rows, cols = np.nonzero(fresh)
            seen[live[rows], near[rows, cols]] = True
            d = np.full(near.shape, np.inf, x.dtype)
            to = near[rows, cols]
            d[rows, cols] = sq[to] - 2 * np.einsum("ij,ij->i", q[live[rows]], x[to])
            all_d = np.concatenate((dist[live], d), axis=1)
            all_i = np.concatenate((ids[live], np.where(fresh, near, -1)), axis=1)
            all_done = np.concatenate((done[live], ~fresh), axis=1)
            best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            dist[live] = np.take_along_axis(all_d, best, 1)
            ids[live] = np.take_along_axis(all_i, best, 1)
            done[live] = np.take_along_axis(all_done, best, 1)
        return ids, dist

    def prune(self, own: np.ndarray, cand: np.ndarray, alpha: float) -> np.ndarray:
        """Edges of the nodes ``own`` out of their candidates (-1 fills up), by robust pruning."""
        cand = np.where(cand == own[:, None], -1, cand)
        cand = np.sort(cand, axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        v = self.x[cand]
        size = self.sq[cand]
        d = size + self.sq[own][:, None] - 2 * np.einsum("bcd,bd->bc", v, self.x[own])
        between = size[:, :, None] + size[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
        d = np.maximum(d, 0)
        alive = cand >= 0
        out = np.full((len(own), self.degree), -1, np.int32)
        rows = np.arange(len(own))
        for k in range(self.degree):
            masked = np.where(alive, d, np.inf)
            pick = masked.argmin(axis=1)
            ok = alive[rows, pick]
            if not ok.any():
                break
            out[ok, k] = cand[ok, pick[ok]]
            # squared distances: the factor counts twice
            alive &= alpha * alpha * between[rows, pick] > d
            alive[rows, pick] = False
        return out

    def insert(self, own: np.ndarray, beam: int, alpha: float) -> None:
        found, _ = self.search(self.x[own], beam)
        self.edges[own] = self.prune(own, np.concatenate((found, self.edges[own]), axis=1), alpha)
        src = np.repeat(own, self.degree)
        dst = self.edges[own].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        to, first, count = np.unique(dst, return_index=True, return_counts=True)
        place = np.arange(len(dst)) - np.repeat(first, count)
        room = 2 * self.degree
        for lo in range(0, len(to), BATCH):                        # bounded memory
            hi = min(lo + BATCH, len(to))
            part = slice(first[lo], first[hi] if hi < len(to) else len(dst))
            width = min(int(count[lo:hi].max()), room)
            new = np.full((hi - lo, width), -1, np.int32)
            ok = place[part] < width
            row = np.repeat(np.arange(hi - lo), count[lo:hi])
            new[row[ok], place[part][ok]] = src[part][ok]
            both = np.concatenate((self.edges[to[lo:hi]], new), axis=1)
            self.edges[to[lo:hi]] = self.prune(to[lo:hi], both, alpha)

    def build(self, beam: int = 64, alpha: float = ALPHA, seed: int = 11) -> Graph:
        n = len(self.x)
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate((self.entries, order[~np.isin(order, self.entries)]))
        for turn, factor in enumerate((1.0, alpha)):
            at = 0
            while at < n:
                # the first batches are small, so that later ones find a graph to search
                size = BATCH if turn else min(BATCH, max(16, at // 2))
                self.insert(order[at:at + size].astype(np.int32), beam, factor)
                at += size
        return self


def scaled(v: np.ndarray) -> np.ndarray:
    """``v`` over the length of its longest row (nearly), so that nothing overflows."""
    v = v / np.abs(v).max(initial=1e-300)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v).max(initial=1e-300))


def augmented(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    sq = np.einsum("ij,ij->i", v, v)
    more = np.sqrt(np.maximum(sq.max(initial=0.0) - sq, 0.0))
    return np.concatenate((v, more[:, None]), axis=1).astype(np.float32)


def band(v: Column) -> Column:
    """Number of the half octave of a vector's length; lengths near 1 are in the middle of one.
    Doubles have about 4,200 of them."""
    top = F.array_max(F.transform(v, F.abs))
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + (x / top) * (x / top))
    return F.floor(2 * F.log2(top) + F.log2(square) + 0.5).cast("int")


def dealt(points: DataFrame) -> tuple[DataFrame, int]:
    """(points with their shard, number of shards): a band has as many as its nodes ask for.

    Neighbouring bands of no more than ``BEAM`` nodes together share one, which is searched whole.
    """
    banded = points.withColumn("band", band(F.col("v")))
    counts = sorted((r["band"], r["count"]) for r in banded.groupBy("band").count().collect())
    room = max(1, min(SHARD_ROWS, math.ceil(sum(n for _, n in counts) / LEAST_SHARDS)))
    plan, shards, together = [], 0, BEAM
    for number, n in counts:
        if together + n <= BEAM:
            plan.append((number, shards - 1, 1))
            together += n
        else:
            plan.append((number, shards, math.ceil(n / room)))
            shards += plan[-1][2]
            together = n
    first = points.sparkSession.createDataFrame(plan, "band int, first int, many int")
    shard = F.col("first") + F.pmod(F.xxhash64("v"), F.col("many"))
    return banded.join(F.broadcast(first), "band").select(
        "v", "members", shard.cast("int").alias("shard")), shards


def index(points: DataFrame) -> DataFrame:
    """(shard, graph): one graph per shard over all nodes (v, members, shard), as written arrays."""

    def build(table: pa.Table) -> pa.Table:
        v = np.array(table.column("v").to_pylist(), np.float64)
        order = np.lexsort(v.T[::-1])                              # same graph on every attempt
        v = v[order]
        members = [table.column("members")[int(i)].as_py() for i in order]
        graph = Graph(augmented(v)).build()
        raw = io.BytesIO()
        np.savez(raw, v=v, edges=graph.edges, entries=graph.entries,
                 ids=np.concatenate(members).astype(np.int64),
                 ends=np.cumsum([len(m) for m in members]))
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
                         "graph": pa.array([raw.getvalue()], pa.binary())})

    return points.groupBy("shard").applyInArrow(build, "shard int, graph binary")


class Searcher:
    """The graph of one shard, as ``index`` writes it, ready for queries."""

    def __init__(self, raw: bytes):
        data = np.load(io.BytesIO(raw))
        self.v, self.ends, self.members = data["v"], data["ends"], data["ids"]
        self.starts = np.concatenate(([0], self.ends[:-1]))
        self.plain = scaled(self.v)
        self.graph = Graph(augmented(self.v))
        self.graph.edges, self.graph.entries = data["edges"], data["entries"]

    def best(self, own: np.ndarray, q: np.ndarray, k: int, beam: int):
        """(query ids, vector ids, scores): the ``k`` best found for each query."""
        unit = q / np.abs(q).max(axis=1, keepdims=True)
        unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
        near, _ = self.graph.search(unit, beam, self.plain)
        ids, found, scores = [], [], []
        for i, row in enumerate(near):
            row = row[row >= 0]
            exact = self.v[row] @ q[i]
            cand = np.concatenate([self.members[self.starts[r]:self.ends[r]] for r in row])
            s = np.repeat(exact, self.ends[row] - self.starts[row])
            cand, s = cand[cand != own[i]], s[cand != own[i]]
            top = np.lexsort((cand, -s))[:k]
            ids.append(np.full(len(top), own[i]))
            found.append(cand[top])
            scores.append(s[top])
        return np.concatenate(ids), np.concatenate(found), np.concatenate(scores)


def search(graphs: DataFrame, queries: DataFrame, shards: int, k: int,
           beam: int = BEAM) -> DataFrame:
    """(query_id, vec_id, score): each shard's best ``k`` for each query (id, v).

    A shard is one partition, sorted so that its graph comes before the queries.
    """

    def run(batches):
        searcher = None
        for batch in batches:
            held = batch.column("graph").is_valid().to_numpy(zero_copy_only=False)
            for lo, hi in _pieces(held):
                if held[lo]:
                    searcher = Searcher(batch.column("graph")[lo].as_py())
                    continue
                part = batch.slice(lo, hi - lo)
                v = np.array(part.column("v").to_pylist(), np.float64)
                ids, found, scores = searcher.best(part.column("id").to_numpy(), v, k, beam)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.astype(np.int64)), pa.array(found.astype(np.int64)),
                     pa.array(scores.astype(np.float64))], names=["query_id", "vec_id", "score"])

    each = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = queries.select("id", "v", each, F.lit(None).cast("binary").alias("graph"))
    held = graphs.select(F.lit(None).cast("long").alias("id"),
                         F.lit(None).cast("array<double>").alias("v"), "shard", "graph")
    both = held.unionByName(asked).withColumn("turn", F.col("graph").isNull().cast("int"))
    streams = both.repartitionById(shards, "shard").sortWithinPartitions("shard", "turn")
    return streams.mapInArrow(run, "query_id long, vec_id long, score double")


def _pieces(held: np.ndarray):
    """(first, end) of single graph rows and of runs of at most ``BATCH`` query rows."""
    at = 0
    while at < len(held):
        end = at + 1
        if not held[at]:
            later = np.flatnonzero(held[at:at + BATCH])
            end = at + (int(later[0]) if len(later) else min(BATCH, len(held) - at))
        yield at, end
        at = end


def nearest(df: DataFrame, is_query, k: int = 20, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest of every row that ``is_query`` (of the id) marks."""
    rows = written(usable(df, key, vector), "vectors")
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if widths is None:
        return df.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == widths[0])
    points, shards = dealt(written(nodes(rows, k + 1), "nodes"))
    graphs = written(index(points), "graphs")
    asked = rows.where(is_query(F.col("id"))).dropDuplicates(["id", "v"])
    found = search(graphs, asked, shards, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
