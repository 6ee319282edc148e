"""Benchmark decontamination: pigeonhole edit matching.

A test item of m characters (letters and digits lower-cased, everything else one blank) may occur
with up to k = floor(``RATE`` * m) edits.  Cut into k + 1 pieces, at least one piece must then
occur exactly; the pieces of a block of items are looked for in one pass over each whole text, and
every hit is verified by Myers' bit-parallel distance in the window around the place the item
would have.  Items are handled in blocks of about ``BLOCK_CHARS`` characters, chosen by a hash, so
what a task gets is bounded; each block is one more step over the same rows, without a shuffle.

Defined results: null and empty texts and items without a letter or digit match nothing; items of
fewer than ``LEAST`` characters are no evidence inside a text and must be the whole of it; items
with the same wording are reported under the smallest id; null item ids are reported as null;
repeated rows are searched alike; texts are searched whole.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, handed_out, per_batch

RATE = 0.06
LEAST = 24
BLOCK_CHARS = 2_000_000
_OTHER = re.compile(r"[\W_]+")
FOUND = "array<struct<item_id: bigint, start: bigint, edits: int>>"


def plain(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pieces(item: str, rate: float = RATE) -> list[tuple[int, str]]:
    """(offset, piece) of the budget-plus-one pieces."""
    k = int(len(item) * rate)
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def closest(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(edits, end) of the best occurrence of ``pattern`` in ``text`` with at most ``most`` edits.

    Columns of the distance matrix are bit vectors of vertical differences.
    """
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    pv, mv, score = mask, 0, m
    best = None
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
        ph, mh = ph << 1 & mask, mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return best


class Searcher:
    """Finds a block of items (id, plain wording) in plain texts."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        import ahocorasick

        self.items, self.rate = items, rate
        self.whole: dict[str, list[int]] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, item) in enumerate(items):
            if len(item) < LEAST:
                self.whole.setdefault(item, []).append(i)
                continue
            for at, piece in pieces(item, rate):
                places.setdefault(piece, []).append((i, at))
        self.machine = ahocorasick.Automaton()
        for piece, where in places.items():
            self.machine.add_word(piece, (len(piece), where))
        self.ready = bool(places)
        if self.ready:
            self.machine.make_automaton()

    def __call__(self, raw: str | None) -> list[tuple[int | None, int, int]]:
        """(item id, start in the plain text, edits), the best occurrence of each item."""
        text = plain(raw)
        if not text:
            return []
        best: dict[int, tuple[int, int]] = {i: (0, 0) for i in self.whole.get(text, ())}
        failed: set[tuple[int, int]] = set()
        if self.ready:
            for end, (size, where) in self.machine.iter(text):
                for i, at in where:
                    if i in best and best[i][0] == 0:
                        continue
                    start = end - size + 1 - at
                    if (i, start) in failed:
                        continue
                    failed.add((i, start))
                    item = self.items[i][1]
                    if text.startswith(item, start) and start >= 0:
                        best[i] = (0, start)
                        continue
                    k = int(len(item) * self.rate)
                    lo = max(0, start - k)
                    got = closest(item, text[lo:max(0, start) + len(item) + k], k)
                    if got and (i not in best or got[0] < best[i][0]):
                        best[i] = (got[0], max(0, start))
        return [(self.items[i][0], at, edits) for i, (edits, at) in sorted(best.items())]


def blocks_of(items: DataFrame, key: str, text: str, chars: int) -> list:
    """The items' (id, wording) in blocks, one collected at a time; smallest id per wording."""
    rows = items.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where(
        "t is not null")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / chars))
    part = F.pmod(F.xxhash64("t"), F.lit(n))
    for b in range(n):
        held: dict[str, int | None] = {}
        for r in rows.where(part == b).orderBy(F.asc_nulls_last("k"), "t").toLocalIterator():
            held.setdefault(plain(r["t"]), r["k"])
        yield [(k, t) for t, k in held.items() if t]


def find(df: DataFrame, items: DataFrame, text: str = "text", out: str = "leaks",
         item_key: str = "item_id", item_text: str = "text", rate: float = RATE,
         chars: int = BLOCK_CHARS) -> DataFrame:
    """``df`` with the array ``out`` of (item_id, start, edits) found in each text."""
    slot = free_name(df, out)
    result = df
    for block in blocks_of(items, item_key, item_text, chars):
        result = _one_block(result, block, text, slot, rate)
    return result


def _one_block(df: DataFrame, block: list, text: str, slot: str, rate: float) -> DataFrame:
    give = handed_out(df, block)                        # about BLOCK_CHARS characters
    base = df if slot in df.columns else df.withColumn(slot, F.array().cast(FOUND))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()),
                               ("edits", pa.int32())]))

    def make():
        search = Searcher(give(), rate)

        def run(batch):
            before = batch.column(slot).to_pylist()
            got = [(old or []) + [{"item_id": i, "start": at, "edits": e}
                                  for i, at, e in search(t)]
                   for old, t in zip(before, batch.column(text).to_pylist())]
            at = batch.schema.names.index(slot)
            cols = list(batch.columns)
            cols[at] = pa.array(got, kind)
            return pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
        return run

    return base.mapInArrow(per_batch(make), base.schema)
