"""Packing: cutting-stock column generation over the histogram of piece lengths.

Texts become token ids and are cut into pieces of at most ``CAPACITY`` ids.  Lengths are counted in
buckets of ``UNIT`` ids (rounded up), ``CAPACITY / UNIT`` numbers at any input size.  On the driver
a linear program over patterns (how many pieces of each bucket fill one sequence) is solved by
column generation: the basis gives each bucket a price, an unbounded knapsack by dynamic
programming finds the pattern worth most at these prices, and it enters while it is worth more
than one sequence.  Uses are rounded down; what is left over is filled largest first.  Pieces get
a gapless rank within their bucket from counts (no row travels to the driver), and the rank names
pattern copy and slot.

Defined results: a null text has no ids but the closing one; every id lies in one piece; pieces of
a sequence follow one another gaplessly from 0; repeated rows are packed each; an empty table
gives no rows; a text of any length is encoded whole.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ranked, written

CAPACITY = 4096
UNIT = 16
CLOSING_ID = 2
VOCABULARY = "word_bpe_49k.json"
KEPT_WORDS = 200_000         # encodings a worker remembers, and as many from before
TOGETHER = 500_000
ROWS_PER_CELL = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Texts of these characters, without the vocabulary's special marks, are lower-cased, composed and
# split by Python as by the vocabulary file.
PLAIN = [*map(chr, range(9, 14)), *map(chr, range(32, 127)), *map(chr, range(0xA0, 0x180))]


def splitter() -> tuple[re.Pattern, re.Pattern]:
    """(pattern of a part, pattern of a character that is not plain).

    Fixed value: the vocabulary file splits by 's|'t|'re|'ve|'m|'ll|'d|\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+;
    letters begin no other alternative and may come first, where they are found sooner.
    """
    kinds: dict[str, str] = {"L": "", "N": "", "": ""}
    for c in PLAIN:
        if not c.isspace():
            kind = unicodedata.category(c)[0]
            kinds[kind if kind in "LN" else ""] += re.escape(c)
    part = f"[{kinds['L']}]+|'s|'t|'re|'ve|'m|'ll|'d|[{kinds['N']}]|[{kinds['']}]+"
    return re.compile(part), re.compile(f"[^{re.escape(''.join(PLAIN))}]")


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, with the encodings of words remembered.

    The vocabulary lower-cases, splits and encodes the parts one by one; the parts of a text are
    looked up, new ones encoded together.  Texts with other than ``PLAIN`` characters or with a
    special mark are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # for parts, which need no more lower-casing and splitting
        self.parts = Tokenizer.from_file(path)
        self.parts.normalizer = normalizers.Sequence([])
        self.parts.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False,
                                                            use_regex=False)
        part, odd = splitter()
        self.split, self.odd = part.findall, odd.search
        self.last = np.zeros(self.parts.get_vocab_size(), bool)
        self.last[[i for word, i in self.parts.get_vocab().items() if word.endswith("</w>")]] = True
        self.kept: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> bytes:
        return next(self.each([text]))

    def each(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of the texts in turn; new words are encoded for ``TOGETHER`` characters at once."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size >= TOGETHER:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)

    def _together(self, texts: list[str | None]) -> Iterator[bytes]:
        parts = [self._parts(t) for t in texts]
        words = set().union(*[p for p in parts if p is not None])
        if len(self.kept) > KEPT_WORDS:              # words that are used again move on
            self.kept, self.before = {}, self.kept
        kept, before = self.kept, self.before
        new = [w for w in words if w not in kept]
        if before:
            kept.update((w, before[w]) for w in new if w in before)
            new = [w for w in new if w not in before]
        kept.update(zip(new, self._encoded(new)))
        for text, own in zip(texts, parts):
            if own is None:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                yield struct.pack(f"<{len(ids)}I", *ids)
            else:
                yield b"".join(map(kept.__getitem__, own))

    def _encoded(self, parts: list[str]) -> Iterator[bytes]:
        for lo in range(0, len(parts), 1000):
            some = parts[lo:lo + 1000]
            ids = np.array(self.parts.encode_batch_fast(
                [some], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1      # a part's last id says so
            if len(ends) != len(some):
                for e in self.parts.encode_batch_fast(some, add_special_tokens=False):
                    yield np.array(e.ids, "<u4").tobytes()
                continue
            raw, at = ids.tobytes(), 0
            for end in (4 * ends).tolist():
                yield raw[at:end]
                at = end

    def _parts(self, text: str | None) -> list[str] | None:
        """Parts as the vocabulary would split; none where Python may differ."""
        if not text:
            return []
        if "<|" in text or "\u0130" in text or self.odd(text):
            return None
        return self.split(text.lower())


def encoder(path: str) -> Encoder:
    """The encoder of this worker process.  Spark keeps a worker for many tasks, and functions of this
    package are rebuilt for each, so it hangs on a module of its own; losing it costs time only."""
    home = sys.modules.setdefault("_rollcall_encoders", types.ModuleType("_rollcall_encoders"))
    if path not in vars(home):
        setattr(home, path, Encoder(path))
    return vars(home)[path]


def cut(df: DataFrame, path: str, capacity: int = CAPACITY, closing: int = CLOSING_ID) -> DataFrame:
    """Pieces of the documents (doc_id, text): start, length, checksum, the document's ids."""
    names = [f.split()[0] for f in PIECES.split(", ")]
    last = np.array([closing], "<u4").tobytes()

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            out = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(),
                                encode.each(batch.column("text").to_pylist())):
                raw = memoryview(ids + last)
                total = len(raw) // 4
                for start in range(0, total, capacity):
                    piece = raw[4 * start:4 * (start + capacity)]
                    out.append((doc, start, len(piece) // 4, zlib.crc32(piece), total))
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=names)

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_pattern(price: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """(worth, counts) of the pattern of sizes 1..len(price) worth most within ``room`` units."""
    n = len(price)
    best = np.zeros(room + 1)
    pick = np.zeros(room + 1, np.int64)
    back = price[::-1]
    for c in range(1, room + 1):
        k = min(c, n)                                    # sizes k..1 leave c-k..c-1 units
        worth = best[c - k:c] + back[n - k:]
        at = int(np.argmax(worth))
        if worth[at] > best[c - 1] + 1e-12:
            best[c], pick[c] = worth[at], k - at
        else:
            best[c] = best[c - 1]
    counts = np.zeros(n, np.int64)
    c = room
    while c > 0:
        if pick[c]:
            counts[pick[c] - 1] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[room]), counts


def column_generation(demand: np.ndarray, rounds: int = 4000) -> list[tuple[np.ndarray, float]]:
    """[(pattern, uses)] of the linear program; size i + 1 has ``demand[i]`` pieces."""
    room = len(demand)
    types = np.flatnonzero(demand)
    if not len(types):
        return []
    # One row per size.  Plain array arithmetic: the matrices are small and a threaded library call
    # on them costs more than it saves.
    columns = np.diag((room // (types + 1)).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    uses = demand[types] / np.diag(columns)
    for _ in range(rounds):
        price = np.zeros(room)
        price[types] = np.maximum(inverse.sum(axis=0), 0.0)
        worth, pattern = best_pattern(price, room)
        if worth <= 1 + 1e-6:
            break
        new = pattern[types].astype(float)
        along = (inverse * new).sum(axis=1)
        ahead = np.flatnonzero(along > 1e-9)
        ratio = uses[ahead] / along[ahead]
        leave = int(ahead[np.argmin(ratio)])
        step = max(float(ratio.min()), 0.0)
        uses = np.maximum(uses - step * along, 0.0)
        uses[leave] = step
        columns[:, leave] = new
        row = inverse[leave] / along[leave]
        inverse -= along[:, None] * row
        inverse[leave] = row
    out = []
    for j in range(len(types)):
        full = np.zeros(room, np.int64)
        full[types] = np.rint(columns[:, j]).astype(np.int64)
        out.append((full, float(max(uses[j], 0.0))))
    return out


def rounded(demand: np.ndarray, program) -> list[tuple[np.ndarray, int]]:
    """Whole uses of patterns that hold exactly the demand."""
    left = demand.astype(np.int64).copy()
    plan = []
    for pattern, uses in sorted(program, key=lambda p: -p[1]):
        held = pattern > 0
        n = min(int(uses + 1e-6), int((left[held] // pattern[held]).min()) if held.any() else 0)
        if n > 0:
            plan.append((pattern, n))
            left -= n * pattern
    room = len(demand)
    while left.any():
        pattern, free = np.zeros(room, np.int64), room
        for i in np.flatnonzero(left)[::-1]:
            k = min(int(left[i]), free // (i + 1))
            pattern[i] = k
            free -= k * (i + 1)
        held = pattern > 0
        n = int((left[held] // pattern[held]).min())
        plan.append((pattern, n))
        left -= n * pattern
    return plan


def portions(plan) -> list[tuple[int, int, int, int, int]]:
    """(bucket, first rank, end rank, first sequence, pieces of the bucket per sequence)."""
    out, used, base = [], {}, 0
    for pattern, n in plan:
        for i in np.flatnonzero(pattern):
            lo = used.get(int(i), 0)
            hi = lo + n * int(pattern[i])
            out.append((int(i) + 1, lo, hi, base, int(pattern[i])))
            used[int(i)] = hi
        base += n
    return out


def pack(df: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         unit: int = UNIT) -> DataFrame:
    """One row per piece of the documents (doc_id, text): its sequence and offset there."""
    spark = df.sparkSession
    pieces = written(cut(df, path or vocabulary_path(), capacity).withColumn(
        "bucket", F.ceil(F.col("length") / unit).cast("int")), "pieces")
    demand = np.zeros(capacity // unit, np.int64)
    for bucket, n in pieces.groupBy("bucket").count().collect():   # capacity / unit numbers
        demand[bucket - 1] = n
    plan = portions(rounded(demand, column_generation(demand)))
    small = spark.createDataFrame(
        plan, "p_bucket int, lo long, hi long, base long, each long")
    numbered = ranked(pieces, ["bucket"], ["doc_id", "start", "length", "ids_crc32"], "rank",
                      ROWS_PER_CELL)
    # as many rows as patterns hold buckets, which the number of buckets bounds
    placed = numbered.join(F.broadcast(small), (F.col("bucket") == F.col("p_bucket"))
                           & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    slot = (F.col("rank") - F.col("lo"))
    placed = placed.withColumn("sequence_id", F.col("base") + F.floor(slot / F.col("each"))) \
        .withColumn("slot", slot % F.col("each"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("bucket"), "slot").rowsBetween(
        Window.unboundedPreceding, -1)                   # a sequence holds `capacity` ids at most
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))
