"""Embedding whitening by spectral divide and conquer on QDWH polar decompositions.

Sums and the covariance are gathered by Spark: every task adds up its own rows, centred before they
are multiplied, and returns one matrix.  The driver splits the covariance, whose size is that of a
vector and not of the table: the polar factor of the shifted matrix is its sign, half of that plus
half the identity projects on the eigenvectors above the shift, and both parts are split again until
single components are left.  The components travel to the tasks as a broadcast (vector length times
components) and every row is whitened where it is read.

Defined results: vectors that are null or hold null or non-finite entries take no part; of several
lengths only the most frequent one does (of two as frequent ones, the longer), and empty vectors
give no rows.  Entries are clamped to +-2^60 after scaling.  Rows with a null or repeated id are
rows like others.  Components with a variance of at most ``LEAST`` times the largest (constant
directions) cannot be whitened and are left out, so equal vectors, or one alone, give no rows.  A
deviation that no long can hold is null.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import handed_out, written

COMPONENTS = 32
LEAST = 1e-11
SLICE = 1 << 20              # entries of vectors a task works on at once
EPS = np.finfo(float).eps


# --- eigenvectors by polar decompositions -----------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix: QR-based dynamically weighted Halley steps,
    Cholesky-like ones once the matrix is well conditioned."""
    n = len(a)
    x = a / np.abs(a).sum(0).max()
    r = np.linalg.qr(x, mode="r")
    with np.errstate(all="ignore"):
        try:
            low = 1 / np.linalg.norm(np.linalg.inv(r))
        except np.linalg.LinAlgError:
            low = EPS
    low = min(1.0, max(float(low) if np.isfinite(low) else EPS, EPS))
    eye = np.eye(n)
    for _ in range(12):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
            step = (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            step = (wa - wb / wc) * np.linalg.solve(eye + wc * x.T @ x, x.T).T
        new = wb / wc * x + step
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if moved < np.cbrt(4 * EPS) and abs(1 - low) < 10 * EPS:
            break
    return x


def split(a: np.ndarray, rng: np.random.Generator, scale: float):
    """Orthonormal bases of the invariant subspaces above and below a shift, and whether they are:
    the best of a few shifts."""
    n, best = len(a), None
    diagonal = np.diag(a)
    mean = diagonal.mean()
    shifts = [float(np.median(diagonal)), float(mean)]
    shifts += [float(mean + t * np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n))
               for t in (0.31, -0.29, 0.07, -0.05, 0.003, -0.002)]
    for shift in shifts:
        moved = a - shift * np.eye(n)
        if not moved.any():
            continue
        above = (polar(moved) + np.eye(n)) / 2
        k = int(round(np.trace(above)))
        if not 0 < k < n:
            continue
        q = np.linalg.qr(above @ rng.standard_normal((n, k)), mode="complete")[0]
        q = np.linalg.qr(above @ q[:, :k], mode="complete")[0]
        off = np.linalg.norm(q[:, k:].T @ a @ q[:, :k])
        if best is None or off < best[0]:
            best = off, q[:, :k], q[:, k:]
        if off <= 10 * n * EPS * scale:
            break
    return best


def principal(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, eigenvectors as columns) of a symmetric matrix, ``wanted`` at most.

    The upper half is split first, and lower halves not at all once there are enough.
    """
    rng, scale = np.random.default_rng(0), np.linalg.norm(a)
    todo, values, vectors = [(a, np.eye(len(a)))], [], []
    while todo and len(values) < wanted:
        part, basis = todo.pop()
        n = len(part)
        off = part - np.diag(np.diag(part))
        flat = n == 1 or np.linalg.norm(off) <= 4 * n * EPS * scale
        halves = None if flat else split(part, rng, scale)
        if halves is None:
            order = np.argsort(-np.diag(part), kind="stable")
            values.extend(np.diag(part)[order])
            vectors.extend(basis[:, order].T)
            continue
        for half in (halves[2], halves[1]):                     # the upper one is next
            inner = half.T @ part @ half
            todo.append(((inner + inner.T) / 2, np.linalg.qr(basis @ half)[0]
                         if len(todo) % 8 == 7 else basis @ half))
    v = np.array(vectors).T
    e = np.einsum("ij,ij->j", v, a @ v)
    order = np.argsort(-e, kind="stable")[:wanted]
    return e[order], v[:, order]


# --- gathered by Spark ------------------------------------------------------------------------

@dataclass
class Model:
    n: int
    floor: np.ndarray          # whole part of the mean, and what it lacks
    lacking: np.ndarray
    sums: np.ndarray           # sums less n times ``floor``
    scale: float
    shift: int
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(vector)
    return df.where(v.isNotNull()).where(F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).select(
        F.col(key).alias("id"), v.cast("array<double>").alias("v"))


def slices(batch: pa.RecordBatch, scale: float, shift: int,
           length: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their whole-number vectors), one length at a time, in slices."""
    lists = batch.column("v")
    at = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(at)
    for size in np.unique(sizes) if length is None else [length]:
        rows = np.flatnonzero(sizes == size)
        step = max(1, SLICE // max(1, int(size)))
        for part in (rows[i:i + step] for i in range(0, len(rows), step)):
            c = flat[at[part][:, None] + np.arange(size)]
            x = np.clip(np.floor(c * scale), -2.0 ** 60, 2.0 ** 60).astype(np.int64) + shift
            yield part, x


def sums_of(vectors: DataFrame, scale: float, shift: int) -> DataFrame:
    """Rows and sums of every place, per length of vector; sums in two halves, which are exact."""

    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for part, x in slices(batch, scale, shift, None):
                size = x.shape[1]
                got = held.setdefault(size, [0, np.zeros(size, np.int64), np.zeros(size, np.int64)])
                got[0] += len(part)
                got[1] += (x >> 31).sum(0)
                got[2] += (x & 0x7FFFFFFF).sum(0)
        for size, (n, high, low) in held.items():
            yield pa.RecordBatch.from_pydict({
                "size": pa.array([size] * size, pa.int32()),
                "place": pa.array(range(size), pa.int32()),
                "n": pa.array([n] * size, pa.int64()), "high": pa.array(high), "low": pa.array(low)})

    def whole(c):
        return F.sum(F.col(c).cast("decimal(20,0)")).alias(c)

    return vectors.select("v").mapInArrow(
        add, "size int, place int, n long, high long, low long").groupBy("size", "place").agg(
        F.sum("n").alias("n"), whole("high"), whole("low"))


def covariance(vectors: DataFrame, model: Model) -> np.ndarray:
    """Divisor n; a task returns one row of its matrix at a time, which are added up by row."""
    give, size = handed_out(vectors, model), len(model.floor)
    ddl = "place int, line array<double>"

    def lines(total):
        return pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            names=["place", "line"])

    def multiply(batches):
        m, total = give(), None
        for batch in batches:
            for _, x in slices(batch, m.scale, m.shift, size):
                d = (x - m.floor).astype(float) - m.lacking
                total = d.T @ d if total is None else total + d.T @ d
        if total is not None:
            yield lines(total)

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, line in zip(batch.column(0).to_pylist(), batch.column(1)):
                line = line.values.to_numpy()
                held[place] = held[place] + line if place in held else line
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()),
                 pa.array(list(held.values()), pa.list_(pa.float64()))], names=["place", "line"])

    got = vectors.select("v").mapInArrow(multiply, ddl).repartition("place").mapInArrow(
        add, ddl).collect()                                  # vector length squared
    out = np.zeros((size, size))
    for place, line in got:
        out[place] = line
    return (out + out.T) / (2 * model.n)


def fit(df: DataFrame, components: int = COMPONENTS, scale: float = 64.0, shift: int = 1_000_000,
        key: str = "vec_id", vector: str = "embedding") -> Model | None:
    """Mean, components and variances of ``floor(scale * entry) + shift``; None without any."""
    vectors = usable(df, key, vector)
    sums = written(sums_of(vectors, scale, shift), "whitening-sums")
    size = sums.where("place = 0").orderBy(F.desc("n"), F.desc("size")).select("size").head()
    if size is None:
        return None
    got = sums.where(F.col("size") == size[0]).orderBy("place").collect()
    n = got[0].n
    totals = [(int(r.high) << 31) + int(r.low) for r in got]
    floor = [t // n for t in totals]
    rest = [t - f * n for t, f in zip(totals, floor)]
    none = np.zeros(0)
    model = Model(n, np.array(floor, np.int64), np.array([r / n for r in rest]),
                  np.array(rest, np.int64), scale, shift, none, none, none, 0.0)
    v = covariance(vectors, model)
    e, q = principal(v, components)
    keep = e > LEAST * max(e[0], 0)
    e, q = e[keep], q[:, keep]
    if not len(e):
        return None
    w = q / np.sqrt(e)
    model.values, model.vectors, model.explained = e, q, e / np.trace(v)
    # what whitening gives as covariance is w' V w, however many rows there are
    model.identity_error = float(np.abs(w.T @ v @ w - np.eye(len(e))).max())
    return model


def deviations(x: np.ndarray, m: Model) -> pa.Array:
    """Sum over places of (n * x - S)^2, exact; null beyond a long."""
    d = x - m.floor
    rough = ((d.astype(float) * m.n - m.sums) ** 2).sum(1)
    exact: list | np.ndarray
    if rough.max(initial=0) < 2.0 ** 62:
        exact = ((d * m.n - m.sums) ** 2).sum(1)
        return pa.array(exact, pa.int64())
    sums = [int(s) for s in m.sums]
    exact = [sum((int(a) * m.n - s) ** 2 for a, s in zip(row, sums)) for row in d]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(df: DataFrame, model: Model | None, key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """One row per vector and component."""
    kind = df.schema[key].dataType.simpleString()
    ddl = (f"`{key}` {kind}, component int, n long, deviation long, whitened double, "
           "explained double, identity_error double")
    if model is None:
        return df.sparkSession.createDataFrame([], ddl)
    give, names = handed_out(df, model), [f.split()[0].strip("`") for f in ddl.split(", ")]

    def run(batches):
        m = give()
        w, k = m.vectors / np.sqrt(m.values), len(m.values)
        for batch in batches:
            for part, x in slices(batch, m.scale, m.shift, len(m.floor)):
                made = ((x - m.floor).astype(float) - m.lacking) @ w
                rows = len(part)
                each = np.repeat(np.arange(rows), k)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(part[each])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, m.n)), deviations(x, m).take(pa.array(each)),
                    pa.array(made.ravel()), pa.array(np.tile(m.explained, rows)),
                    pa.array(np.full(rows * k, m.identity_error))], names=names)

    return usable(df, key, vector).mapInArrow(run, ddl)
