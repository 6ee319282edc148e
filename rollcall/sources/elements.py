"""Elements of large JSON files, read by many tasks.

A file that holds one array (or object) of many elements has no lines to split it by.  Spark's text
reader can split at any separator, so files are read as pieces that end in ``}``, which every object
has.  Where a split begins, it is not known whether it lies in a string nor how deep; two passes
tell:

1. every split says what it does to both possible beginnings (in a string or not): how it ends and
   how the depth changes.  These summaries, one row of fixed size per split, are put together in
   order on the driver, which gives each split its true beginning;
2. every split, knowing it, cuts its text at the commas of depth one and numbers the elements from
   its own beginning; its last row tells how many it closed.  Sums of these, again one row per
   split, give the number of its first element.  The element on the border of two splits comes in
   parts, which are joined by (file, number).

No task holds more than a batch of pieces and one element.  An array of plain values without any
``}`` is one piece.  Strings, escapes and nesting are respected; a file that is not a well-formed
array (object), or in which any element is malformed, gives no rows, as if read whole.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.plans.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of it

ESCAPED = re.compile(rb"\\.", re.S)
QUOTE, COMMA = 34, 44
STEP = np.zeros(256, np.int32)
STEP[[ord("["), ord("{")]] = 1
STEP[[ord("]"), ord("}")]] = -1
SUMMARY = ("file string, start long, size long, pieces long, bytes long, first string, odd boolean, "
           "depth array<long>, least array<long>")
ELEMENT = "file string, seq long, part long, whole boolean, text string"


def pieces(spark: SparkSession, pattern: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "}").text(pattern).select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("start"),
        meta["file_size"].alias("size"))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int, int], list[str]]]:
    """The pieces of a batch by split, in order."""
    values, files, starts, sizes = (c.to_pylist() for c in batch.columns)
    at = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or (files[i], starts[i]) != (files[at], starts[at]):
            yield (files[at], starts[at], sizes[at]), values[at:i]
            at = i


def structure(raw: bytes, inside: bool):
    """(bytes, which lie outside strings, whether the end lies in one)."""
    a = np.frombuffer(ESCAPED.sub(b"__", raw), np.uint8)
    quotes = np.cumsum(a == QUOTE)
    within = (quotes + inside) & 1
    return a, within == 0, bool(within[-1]) if len(a) else inside


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row():
        return pa.RecordBatch.from_pylist([{
            "file": key[0], "start": key[1], "size": key[2], "pieces": n, "bytes": size,
            "first": first, "odd": odd, "depth": depth, "least": least}], schema=SUMMARY_ARROW)

    key = None
    for batch in batches:
        for now, values in runs(batch):
            if now != key:
                if key is not None:
                    yield row()
                key, n, size, first, odd = now, 0, 0, None, False
                depth, least = [0, 0], [0, 0]
            raw = "}".join(values).encode() + b"}"
            n, size = n + len(values), size + len(raw)
            first = first or (raw.strip()[:1].decode("utf-8", "replace") or None)
            for begin in (0, 1):
                a, outside, _ = structure(raw, bool(begin) ^ odd)
                at = depth[begin] + np.cumsum(np.where(outside, STEP[a], 0), dtype=np.int64)
                least[begin] = min(least[begin], int(at.min()))
                depth[begin] = int(at[-1])
            odd ^= bool((a == QUOTE).sum() & 1)
    if key is not None:
        yield row()


SUMMARY_ARROW = pa.schema([
    ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("pieces", pa.int64()),
    ("bytes", pa.int64()), ("first", pa.string()), ("odd", pa.bool_()),
    ("depth", pa.list_(pa.int64())), ("least", pa.list_(pa.int64()))])


def beginnings(rows: list, root: str) -> dict[tuple[str, int], dict]:
    """What holds where each split of the well-formed files begins.

    ``closed`` says that the root is behind, and ``open_end`` that no ``}`` follows the last piece.
    """
    out: dict[tuple[str, int], dict] = {}
    by_file: dict[str, list] = {}
    for r in rows:
        by_file.setdefault(r.file, []).append(r)
    for file, splits in by_file.items():
        splits.sort(key=lambda r: r.start)
        inside, depth, mine, fine = False, 0, {}, splits[0].first == root
        extra = sum(r.bytes for r in splits) - splits[0].size   # a last } that is not there
        for part, r in enumerate(splits):
            mine[file, r.start] = {"inside": inside, "depth": depth, "part": part,
                                   "closed": part > 0 and depth == 0, "open_end": False}
            last = part == len(splits) - 1
            fine &= extra in (0, 1) and (depth + r.least[inside] >= (-1 if last and extra else 0))
            depth, inside = depth + r.depth[inside], inside ^ r.odd
        mine[file, splits[-1].start]["open_end"] = extra == 1
        if fine and not inside and depth + extra == 0:
            out.update(mine)
    return out


def cut(begin_of, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ELEMENT, numbered within their split; text outside the root's brackets makes a row
    with seq -1, the end of a split one without text whose seq is the number of elements closed."""
    begins = begin_of()
    names = [f.split()[0] for f in ELEMENT.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    key, begin, held, state = None, None, [], None

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def tail():
        """The element that is open where a split ends, and the end."""
        text = b"".join(held)
        end = [(key[0], state["seq"], begin["part"], False, None)]
        if state["depth"] > 0:
            return [(key[0], state["seq"], begin["part"], False, text.decode()), *end]
        return [(key[0], -1, begin["part"], False, text.decode()), *end] if text.strip() else end

    def take(raw: bytes) -> list[tuple]:
        nonlocal held
        rows = []
        a, outside, inside = structure(raw, state["inside"])
        step = np.where(outside, STEP[a], 0)
        depth = state["depth"] + np.cumsum(step, dtype=np.int64)
        marks = np.flatnonzero(
            (outside & (a == COMMA) & (depth == 1)) | ((step == 1) & (depth == 1))
            | ((step == -1) & (depth == 0)))
        at = 0
        for m in marks.tolist():
            held.append(raw[at:m])
            text, held = b"".join(held), []
            at = m + 1
            if step[m] == 1:                             # the root opens
                if text.strip() or state["closed"]:
                    rows.append((key[0], -1, begin["part"], False, text.decode()))
            else:
                rows.append((key[0], state["seq"], begin["part"], state["fresh"], text.decode()))
                state["seq"] += int(step[m] == 0)
                state["closed"] = bool(step[m] == -1)
            state["fresh"] = True
        held.append(raw[at:])
        state["inside"], state["depth"] = inside, int(depth[-1]) if len(depth) else state["depth"]
        return rows

    for batch in batches:
        rows = []
        for now, values in runs(batch):
            if now != key:
                if begin is not None:
                    held = [b"".join(held).removesuffix(b"}")] if begin["open_end"] else held
                    rows += tail()
                key, held, begin = now, [], begins.get(now[:2])
                if begin is not None:
                    state = {**begin, "seq": 0, "fresh": False}
            if begin is not None:
                rows += take("}".join(values).encode() + b"}")
        if rows:
            yield batch_of(rows)
    if begin is not None:
        held = [b"".join(held).removesuffix(b"}")] if begin["open_end"] else held
        if rows := tail():
            yield batch_of(rows)


def elements(spark: SparkSession, pattern: str, root: str) -> DataFrame:
    """(file, seq, text) of the elements of the files' arrays (``root`` is ``[``) or entries of
    their objects (``{``)."""
    found = pieces(spark, pattern)
    begins = beginnings(found.mapInArrow(summaries, SUMMARY).collect(), root)   # one row per split
    held = spark.sparkContext.broadcast(begins)
    cuts = written(found.mapInArrow(lambda b: cut(lambda: held.value, b), ELEMENT), "elements")
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = written(cuts.where("text is null").select(
        "file", "part", F.coalesce(F.sum("seq").over(before), F.lit(0)).alias("first")), "firsts")
    rows = cuts.where("text is not null").join(firsts, ["file", "part"]).withColumn(
        "seq", F.when(F.col("seq") >= 0, F.col("seq") + F.col("first")).otherwise(F.col("seq")))
    joined = rows.where("not whole and seq >= 0").groupBy("file", "seq").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))),
                                 lambda x: x["text"]), "").alias("text"))
    every = rows.where("whole").select("file", "seq", "text").unionByName(joined)
    whole = F.col("text") if root == "[" else F.concat(F.lit("{"), F.col("text"), F.lit("}"))
    # one blank element is an empty array; any other blank or malformed one spoils its file
    shown = every.withColumn("blank", F.trim(F.regexp_replace("text", r"\s", "")) == "").withColumn(
        "text", whole)
    made = F.try_parse_json(F.concat(F.lit("["), "text", F.lit("]")))   # nothing may follow it
    right = F.coalesce(F.regexp_like(F.schema_of_variant(made), F.lit(
        "^ARRAY<(OBJECT|VOID)" if root == "[" else "^ARRAY<OBJECT")), F.lit(False))
    bad = shown.where(F.when(F.col("blank"), F.col("seq") > 0).otherwise(~right)).select("file")
    later = shown.where("seq > 0").select("file").distinct()
    first_blank = shown.where("blank and seq = 0").select("file").join(later, "file", "left_semi")
    spoiled = bad.union(first_blank).union(rows.where("seq < 0").select("file")).distinct()
    return shown.where("not blank").drop("blank").join(spoiled, "file", "left_anti")
