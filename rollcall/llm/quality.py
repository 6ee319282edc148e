"""Quality classifier: naive Bayes support vectors.

n-gram indicators are scaled by class log-count ratios, r = log((p / |p|) / (q / |q|)), taken over
ALL labelled training rows; a linear hinge-loss model over the scaled indicators is then fitted by
dual coordinate descent on a bounded sample (``SAMPLE`` rows of each class, smallest hash of the
id first).  Margins become scores by a logistic curve fitted on the same sample.

Defined results: a null or empty text has no feature and gets the curve's value at the bias; ids
labelled several times count once, with their lowest label; null labels are no labels; without a
labelled row of each class every score is the share of label 1 (0.5 if there is none); repeated
rows are scored alike; texts are scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm import linear
from rollcall.llm.common import (
    free_name,
    handed_out,
    id_filter,
    passing,
    per_batch,
    with_fields,
    written,
)
from rollcall.llm.textgrams import Distinct, quality_features

BITS = 18
SAMPLE = 3000
COST = 1.0


@dataclass
class Model:
    weights: np.ndarray        # log-count ratio times weight, per feature
    ratio: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, idx: np.ndarray) -> float:
        """Margin of a text with the distinct features ``idx`` (unit length after scaling)."""
        size = float(np.sqrt(np.square(self.ratio[idx]).sum()))
        return (float(self.weights[idx].sum()) / size if size else 0.0) + self.bias


def label_rows(docs: DataFrame, labels: DataFrame, mark: str, lowest: bool = True) -> DataFrame:
    """(doc_id, text, y, first) of the documents that ``labels`` marks, written once.

    ``first`` is true for one row of each label and wording, so that copies can be counted once.
    Most texts without a label end in the scan, by a filter of fixed size; the rest meet the marks
    in one shuffle, with the large side on the left.
    """
    marks = labels.where(F.col(mark).isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        "doc_id").agg((F.min if lowest else F.max)(mark).cast("int").alias("y"))
    rows = passing(docs.select("doc_id", "text"), id_filter(marks.select("doc_id")))
    hashes = rows.select("doc_id", F.xxhash64("text").alias("h")).join(marks, "doc_id")
    first = hashes.groupBy("h", "y").agg(F.min("doc_id").alias("doc_id")).select(
        "doc_id", F.lit(True).alias("first")).distinct()
    marks = marks.join(first, "doc_id", "left").withColumn(
        "first", F.coalesce("first", F.lit(False)))
    # marks have no bound: never broadcast, so the plan is the same at every size
    return written(rows.join(marks.hint("merge"), "doc_id"), "labelled")


def feature_counts(rows: DataFrame, features, bits: int) -> DataFrame:
    """(feature, n0, n1): documents with the feature by label, counted over all rows.

    Counts are summed per task first; the task's memory is two arrays of 2^bits.
    """

    def run(batches):
        counts = np.zeros((2, 1 << bits), np.int64)
        distinct = Distinct(bits)
        for batch in batches:
            for y, t in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                counts[int(y > 0)][distinct(features(t, bits))] += 1
        seen = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(seen), 50_000):
            part = seen[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(counts[0][part]),
                 pa.array(counts[1][part])], names=["feature", "n0", "n1"])

    parts = rows.select("y", "text").mapInArrow(run, "feature int, n0 long, n1 long")
    return parts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def sample_features(rows: DataFrame, features, bits: int, per_class: int) -> pd.DataFrame:
    """(y, idx bytes) of at most ``per_class`` rows of each class, by the hash of id and text.

    The bound is one of rows, however often an id or a whole row is repeated: what the threshold
    lets through is cut once more before it comes to the driver.
    """

    def make():
        distinct = Distinct(bits)

        def run(batch):
            idx = [distinct(features(t, bits)).tobytes()
                   for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("h"), pa.array(idx, pa.binary())],
                names=["y", "h", "idx"])
        return run

    h = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    picked = []
    for y in (0, 1):
        one = h.where((F.col("y") > 0) == bool(y))
        ids = one.select("h").orderBy("h").limit(per_class)
        top = ids.agg(F.max("h")).first()[0]
        if top is not None:
            picked.append(one.where(F.col("h") <= top).select("y", "h", "text")
                          .mapInArrow(per_batch(make), "y int, h long, idx binary")
                          .orderBy("h", "y").limit(per_class))
    if not picked:
        return pd.DataFrame({"y": [], "h": [], "idx": []})
    out = picked[0] if len(picked) == 1 else picked[0].unionByName(picked[1])
    return out.toPandas().sort_values(["h", "y"]).reset_index(drop=True)


def fit(rows: DataFrame, features=quality_features, bits: int = BITS,
        per_class: int = SAMPLE, cost: float = COST) -> Model:
    """Model from (doc_id, text, y) rows."""
    counts = feature_counts(rows, features, bits).toPandas()      # at most 2^bits rows
    sample = sample_features(rows, features, bits, per_class)
    n = [(sample["y"] <= 0).sum(), (sample["y"] > 0).sum()]
    if not n[0] or not n[1]:
        share = 0.5 if not sum(n) else n[1] / sum(n)
        zero = np.zeros(1 << bits)
        return Model(zero, zero, 0.0, 1.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    p, q = np.ones(1 << bits), np.ones(1 << bits)
    p[counts["feature"]] += counts["n1"]
    q[counts["feature"]] += counts["n0"]
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    ratio[np.setdiff1d(np.arange(1 << bits), counts["feature"].to_numpy())] = 0.0
    vectors, y = [], np.where(sample["y"] > 0, 1.0, -1.0)
    for raw in sample["idx"]:
        idx = np.frombuffer(raw, np.int32)
        size = float(np.sqrt(np.square(ratio[idx]).sum())) or 1.0
        vectors.append((idx, ratio[idx] / size))
    w = linear.dual_coordinate_descent(vectors, y, 1 << bits,
                                       np.where(y > 0, cost, cost) * 10.0)
    margin = np.array([float(w[i] @ v) + w[-1] for i, v in vectors])
    slope, offset = linear.logistic_1d(margin, y)
    return Model(w[:-1] * ratio, ratio, float(w[-1]), slope, offset)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score",
          features=quality_features, bits: int = BITS) -> DataFrame:
    """``df`` with the score of each whole text."""
    slot = free_name(df, out)
    shared = handed_out(df, model)      # two arrays of 2^bits

    def make():
        m, distinct = shared(), Distinct(bits)

        def run(batch):
            got = [m.margin(distinct(features(t, bits))) for t in batch.column(text).to_pylist()]
            p = linear.sigmoid(m.slope * np.array(got) + m.offset)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)],
                                              names=[*batch.schema.names, slot])
        return run

    return df.mapInArrow(per_batch(make), with_fields(df, f"`{slot}` double"))


def predicted(score_col: Column, least: float = 0.3) -> Column:
    return (score_col >= least).cast("int")
