"""Toxicity: cumulative-link ordinal regression over sparse text features.

P(grade >= k) = sigmoid(w.x - theta_k), with one weight vector shared by all thresholds
theta_1 < theta_2 < ...; the expected severity is the sum of these over k.  Features are words and
word beginnings.  Those that toxic rows have significantly more often (z of the log odds ratio,
counted over ALL labelled rows, at least ``LEAST_Z``; the ``KEPT`` strongest) enter the model; it
is fitted on a bounded sample (``SAMPLE`` rows of each class by hash of the id), weighted back to
the classes' shares.

The labels only say toxic or not, so the grades of toxic rows are derived: the third (1, 2, 3) of
toxic rows a row is in by its number of distinct indicative features.  ``fit_ordinal`` itself takes
any grades.

Defined results: null and empty texts have no feature and get the severity of the intercept (a
grade of 0 unless most labels are toxic); without toxic labels every severity is 0; ids labelled
several times count once with their highest label; repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, handed_out, per_batch, with_struct
from rollcall.llm.linear import sigmoid
from rollcall.llm.quality import feature_counts, label_rows, sample_features
from rollcall.llm.textgrams import Distinct, word_features

BITS = 20
KEPT = 4096
LEAST_Z = 4.0
SAMPLE = 10_000
REJECT = 0.5           # rejected when P(grade >= 1) is at least this


@dataclass
class Model:
    features: np.ndarray       # sorted feature numbers
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, idx: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return sigmoid(self.weights[self.known(idx)].sum() - self.thresholds)

    def known(self, idx: np.ndarray) -> np.ndarray:
        if not len(self.features):
            return np.empty(0, np.int64)
        at = np.searchsorted(self.features, idx)
        at[at == len(self.features)] = 0
        return at[self.features[at] == idx]


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, dims: int, top: int,
                weight: np.ndarray | None = None, ridge: float = 2e-5,
                steps: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the weighted likelihood, by Adam over all rows."""
    lengths = np.array([len(r) for r in rows])
    col = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), lengths)
    weight = np.ones(len(rows)) if weight is None else weight
    weight = weight / weight.sum()
    share = np.array([weight[grades >= k].sum() for k in range(1, top + 1)]).clip(1e-4, 1 - 1e-4)
    start = -np.log(share / (1 - share))
    # thresholds = first, then the logs of the gaps, so that they stay in order
    free = np.concatenate(([start[0]], np.log(np.maximum(np.diff(start), 0.05))))
    w = np.zeros(dims)
    m = np.zeros(dims + top)
    v = np.zeros(dims + top)
    for t in range(1, steps + 1):
        theta = free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))
        s = np.bincount(row, w[col], len(rows)) if len(col) else np.zeros(len(rows))
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        lo, hi = edges[grades] - s, edges[grades + 1] - s      # P(grade) = F(hi) - F(lo)
        f_lo, f_hi = sigmoid(lo), sigmoid(hi)
        p = np.maximum(f_hi - f_lo, 1e-12)
        ds = -(f_hi + f_lo - 1.0) * weight                    # of the loss by the score
        d_hi, d_lo = -f_hi * (1 - f_hi) / p * weight, f_lo * (1 - f_lo) / p * weight
        d_theta = (np.bincount(grades, d_hi, top + 1)[:top]
                   + np.bincount(grades, d_lo, top + 1)[1:top + 1])
        d_free = np.concatenate((
            [d_theta.sum()],
            [d_theta[k:].sum() * np.exp(free[k]) for k in range(1, top)]))
        d_w = (np.bincount(col, ds[row], dims) if len(col) else np.zeros(dims)) + ridge * w / 10
        g = np.concatenate((d_w, d_free))
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w -= step[:dims]
        free -= step[dims:]
    return w, free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))


def thirds(hits: np.ndarray) -> np.ndarray:
    """Grades 1 to 3 by the thirds of ``hits``; equal counts share a grade."""
    if not len(hits):
        return np.empty(0, np.int64)
    a, b = np.quantile(hits, [1 / 3, 2 / 3])
    return 1 + (hits > a).astype(np.int64) + (hits > b)


def fit(docs: DataFrame, labels: DataFrame, mark: str = "toxic", per_class: int = SAMPLE) -> Model:
    rows = label_rows(docs, labels, mark, lowest=False)
    counts = feature_counts(rows.where("first"), word_features, BITS)
    hit, once = F.col("y") > 0, F.col("first")
    n1, n0, all1, all0 = rows.agg(
        F.count_if(hit & once), F.count_if(~hit & once), F.count_if(hit), F.count_if(~hit)).first()
    none = Model(np.empty(0, np.int32), np.zeros(0), np.full(3, 40.0))
    if not n1:
        return none
    a, b = F.col("n1") + 0.5, F.col("n0") + 0.5
    z = F.log((a / (n1 + 1.0)) / (b / (n0 + 1.0))) / F.sqrt(1 / a + 1 / b)
    best = counts.withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(
        F.desc("z"), "feature").limit(KEPT).select("feature").toPandas()
    kept = np.sort(best["feature"].to_numpy().astype(np.int32))
    model = Model(kept, np.zeros(len(kept)), np.zeros(3))
    only = set_features(kept)
    sample = sample_features(rows, only, BITS, per_class)
    hit = (sample["y"] > 0).to_numpy()
    idx = [model.known(np.frombuffer(r, np.int32)) for r in sample["idx"]]
    grades = np.zeros(len(idx), np.int64)
    grades[hit] = thirds(np.array([len(i) for i in np.array(idx, dtype=object)[hit]]))
    weight = np.where(hit, all1 / max(hit.sum(), 1), all0 / max((~hit).sum(), 1))
    w, theta = fit_ordinal(idx, grades, len(kept), 3, weight)
    return Model(kept, w, theta)


def set_features(kept: np.ndarray):
    """Word features restricted to the sorted numbers ``kept``."""

    def features(text, bits):
        idx = word_features(text, bits)
        if not len(kept):
            return idx[:0]
        at = np.searchsorted(kept, idx)
        at[at == len(kept)] = 0
        return idx[kept[at] == idx]

    return features


def grade(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with a struct: expected severity, chance of any toxicity, likeliest grade."""
    slot = free_name(df, out)
    shared = handed_out(df, model)      # at most KEPT features

    def make():
        model, distinct = shared(), Distinct(BITS)
        kind = pa.struct([("severity", pa.float64()), ("chance", pa.float64()),
                          ("grade", pa.int32())])

        def run(batch):
            rows = []
            for t in batch.column(text).to_pylist():
                c = model.chances(distinct(word_features(t, BITS)))
                likely = -np.diff(np.concatenate(([1.0], c, [0.0])))
                rows.append({"severity": float(c.sum()), "chance": float(c[0]),
                             "grade": int(np.argmax(likely))})
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)],
                                              names=[*batch.schema.names, slot])
        return run

    return df.mapInArrow(per_batch(make),
                         with_struct(df, slot, "severity double, chance double, grade int"))
