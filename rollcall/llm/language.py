"""Language identification by hierarchical discrimination.

The family is predicted first; within it, one-versus-one linear support vector machines separate
the languages and vote.  Both levels use hashed 1- to 4-byte windows (log frequency, unit length)
and are fitted by dual coordinate descent on a bounded sample: ``SAMPLE`` rows of each language,
smallest hash of the id first.

Defined results: ``und`` with score 0 for a null text or one without a letter, and when nothing
could be learned; with one learned language every other text gets it, with score 1; equal votes go
to the larger sum of margins, then the name that sorts first; repeated rows are predicted alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm import linear
from rollcall.llm.common import free_name, handed_out, per_batch, with_fields
from rollcall.llm.textgrams import language_features

BITS = 18
SAMPLE = 1000            # rows a language; up to here Spark cuts each task's rows before the shuffle
HAS_LETTER = re.compile(r"[^\W\d_]")
# Families by language code; a language that is not listed forms the family "other" with its like.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "indo-iranian": ("bn", "fa", "gu", "hi", "ku", "mr", "ne", "pa", "ps", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "ug", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "austronesian": ("id", "jv", "ms", "tl"),
}


def family_of(lang: str, families=None) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    for name, members in (families or FAMILIES).items():
        if code in members:
            return name
    return "other"


@dataclass
class Machines:
    """One-versus-one machines over ``names``; column k of ``weights`` belongs to pair k."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None

    def choose(self, idx: np.ndarray, val: np.ndarray) -> tuple[str, float]:
        if len(self.names) == 1:
            return self.names[0], 1.0
        margin = val @ self.weights[idx] + self.bias
        votes, sums = np.zeros(len(self.names)), np.zeros(len(self.names))
        for k, (a, b) in enumerate(self.pairs):
            votes[a if margin[k] >= 0 else b] += 1
            sums[a] += margin[k]
            sums[b] -= margin[k]
        best = min(range(len(self.names)), key=lambda i: (-votes[i], -sums[i], self.names[i]))
        own = [margin[k] if a == best else -margin[k]
               for k, (a, b) in enumerate(self.pairs) if best in (a, b)]
        return self.names[best], float(linear.sigmoid(2.0 * min(own)))


@dataclass
class Model:
    families: Machines
    within: dict[str, Machines]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families.names or not HAS_LETTER.search(text):
            return "und", 0.0
        idx, val = vector(language_features(text, BITS))
        family, p = self.families.choose(idx, val)
        lang, q = self.within[family].choose(idx, val)
        return lang, p * q


def vector(features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    idx, count = np.unique(features, return_counts=True)
    val = np.log1p(count)
    size = float(np.sqrt(val @ val)) or 1.0
    return idx, (val / size).astype(np.float32)


def train_pairs(names: list[str], rows: list, kind: np.ndarray, cost: float = 5.0) -> Machines:
    out = Machines(names, list(combinations(range(len(names)), 2)))
    if len(names) < 2:
        return out
    weights = []
    for a, b in out.pairs:
        own = np.flatnonzero((kind == a) | (kind == b))
        y = np.where(kind[own] == a, 1.0, -1.0)
        costs = np.full(len(own), cost)
        weights.append(linear.dual_coordinate_descent([rows[i] for i in own], y, 1 << BITS, costs,
                                                      epochs=8))
    w = np.stack(weights, axis=1)
    out.weights, out.bias = w[:-1].astype(np.float32), w[-1]
    return out


def fit(docs: DataFrame, per_language: int = SAMPLE, families=None) -> Model:
    """Model from rows (doc_id, text, lang); rows without text or language teach nothing."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    first = Window.partitionBy("lang").orderBy("h")

    def least(df):
        return df.withColumn("k", F.row_number().over(first)).where(
            F.col("k") <= per_language).drop("k")

    edge = least(hashed.select("lang", "h")).groupBy("lang").agg(F.max("h").alias("edge"))
    # one row a language, whose size Spark checks; the texts are not shuffled by their language
    picked = hashed.join(edge, "lang").where(F.col("h") <= F.col("edge")).select("lang", "h", "text")

    def make():
        def run(batch):
            vec = [vector(language_features(t, BITS)) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("h"),
                 pa.array([i.tobytes() for i, _ in vec], pa.binary()),
                 pa.array([v.tobytes() for _, v in vec], pa.binary())],
                names=["lang", "h", "idx", "val"])
        return run

    sample = picked.mapInArrow(per_batch(make), "lang string, h long, idx binary, val binary")
    # rows that are equal share a hash: cut once more, so that a language sends so many rows at most
    sample = least(sample).toPandas().sort_values(["h", "lang"]).reset_index(drop=True)
    vectors = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32).astype(np.float64))
               for i, v in zip(sample["idx"], sample["val"])]
    langs = sorted(set(sample["lang"]))
    family = {g: family_of(g, families) for g in langs}
    names = sorted(set(family.values()))
    kin = np.array([names.index(family[g]) for g in sample["lang"]], dtype=np.int64)
    top = train_pairs(names, vectors, kin)
    within = {}
    for k, name in enumerate(names):
        own = [g for g in langs if family[g] == name]
        at = np.flatnonzero(kin == k)
        kind = np.array([own.index(sample["lang"][i]) for i in at], dtype=np.int64)
        within[name] = train_pairs(own, [vectors[i] for i in at], kind)
    return Model(top, within)


def predict(df: DataFrame, model: Model, text: str = "text", out: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its score."""
    slots = [free_name(df, out), free_name(df, score)]
    shared = handed_out(df, model)      # arrays of 2^bits

    def make():
        model = shared()

        def run(batch):
            got = [model.predict(t) for t in batch.column(text).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g for g, _ in got], pa.string()),
                 pa.array([s for _, s in got], pa.float64())],
                names=[*batch.schema.names, *slots])
        return run

    return df.mapInArrow(per_batch(make),
                         with_fields(df, f"`{slots[0]}` string, `{slots[1]}` double"))
