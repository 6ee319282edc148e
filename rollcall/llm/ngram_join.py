"""N-gram Jaccard self-join: grouped prefix join, and the components of its links.

A document's set: the distinct 5-word shingles (63-bit hashes).  Two sets whose Jaccard similarity
is at least 3/4 share one of the first p = n - ceil(3n/4) + 1 elements of each, in any one order of
all elements.  The order here: (0) elements of the low part of the hash range that at most ``HOT``
groups hold, (1) such elements of the high part, (2) hot elements.

* Sets of one size with identical low elements, at least p of them, are collapsed into one *group*;
  a set with fewer is a group by itself.  Exact copies are one set, however many.
* Round 1 deals the groups' low elements to tasks, which read them sorted: a cold element gives the
  pairs of its groups that pass the size filter, a hot one only the count of hot elements per
  group.  Shared elements are counted per pair, and a pair is kept only if the count, with
  everything that was not counted, could still reach 3/4.
* Groups with fewer than p cold low elements do the same with the high elements of all their sets
  in round 2, among themselves; a pair with any other group has met in round 1 already.
* Sets of which 3/4 are hot (large clusters of near copies) may share hot elements only.  They are
  joined on their first p elements, those rarest among them first, but never all pairs: every set
  is compared with a few pivots, and then only sets of different components within an element.
* Candidates are verified on the member sets, best partner first, then whatever still lies in
  different components.  Links within one component need no check: they change nothing.
* Of groups of several sets, and of their partners, what is not in one component by then is joined
  like the hot sets, on shared elements rarest first; a group's sets are never paired outright.

Nothing per document comes to the driver.  Which documents to read again is told to the scans by a
filter of fixed size (``common.FILTER_BITS``); what it lets through wrongly does no harm.

Defined results: a null or wordless text has no set, size 0 and its own component; fewer than five
words are one shingle; rows without an id link with nothing and have a null component; repeated
rows are equal sets; texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import id_filter, map_passing, written
from rollcall.llm.components import components

WORDS = 5
LOW = 0.30                 # share of the hash range that is "low"
HOT = 24                   # an element of more groups is hot
TOGETHER = 500_000         # elements a task sorts at once, and those of one more document
PIVOTS, PIVOT_ELEMENTS = 2, 4

_A = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9),
      np.uint64(0x27D4EB2F165667C5), np.uint64(0x85EBCA77C2B2AE63)]
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h ^= h >> np.uint64(29)
    h = h * _MIX
    return (h ^ (h >> np.uint64(32))) >> np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words)) >> 1],
                        np.int64)
    w = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    h = np.zeros(len(w) - WORDS + 1, np.uint64)
    for k in range(WORDS):
        h += w[k:len(w) - WORDS + 1 + k] * _A[k]
    return np.unique(_mixed(h)).astype(np.int64)


EDGE = int(LOW * 2.0 ** 63)


def low_count(s: np.ndarray) -> int:
    return int(np.searchsorted(s, EDGE))


def prefix_size(n):
    return n - -(-3 * n // 4) + 1


def set_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) >> 1


def group_id(s: np.ndarray) -> int:
    """Of the low elements and the size, or of the whole set if these are fewer than p."""
    if low_count(s) < prefix_size(len(s)):
        return set_id(s)
    return xxhash.xxh3_64_intdigest(s[:low_count(s)].tobytes(), seed=len(s)) >> 1


def _columns(batch: pa.RecordBatch):
    return zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())


def members(docs: DataFrame) -> DataFrame:
    """(doc_id, n, low, fp, g, h) of every row; fp and g are null without a set or an id, ``h`` is
    Spark's hash of the text."""

    def run(batches):
        for batch in batches:
            rows = []
            for (doc, text), h in zip(_columns(batch), batch.column("h").to_pylist()):
                s = shingle_set(text)
                known = len(s) and doc is not None
                rows.append((doc, len(s), low_count(s), set_id(s) if known else None,
                             group_id(s) if known else None, h))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["doc_id", "n", "low", "fp", "g", "h"])

    return docs.withColumn("h", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, n long, low long, fp long, g long, h long")


def element_rows(docs: DataFrame, part: str, hot: int, flat=None) -> DataFrame:
    """(element, g, n) of the groups' low or high elements; of documents that ``flat`` may hold.

    A group's sets share their low elements, so one of them tells all; of the high ones each set
    sends its own, and what is counted for the group is at least what any of its sets has.

    Elements hot among ``TOGETHER`` ones are certainly hot: they send one marker (n = -1) for the others
    to see, and their groups' counts go on spread by group (negative element, n = 0), so that a
    very common element does not gather its rows in one task.
    """

    def rows_of(toks, gs, ns):
        tok, g, n = np.concatenate(toks), np.concatenate(gs), np.concatenate(ns)
        order = np.lexsort((g, tok))
        tok, g, n = tok[order], g[order], n[order]
        fresh = np.concatenate(([True], (tok[1:] != tok[:-1]) | (g[1:] != g[:-1])))
        tok, g, n = tok[fresh], g[fresh], n[fresh]
        _, first, count = np.unique(tok, return_index=True, return_counts=True)
        common = np.repeat(count > hot, count)
        if common.any():
            marks = tok[first[count > hot]]
            far = -1 - (g[common] ^ tok[common])
            tok = np.concatenate((tok[~common], marks, far))
            n = np.concatenate((n[~common], np.full(len(marks), -1, np.int32),
                                np.zeros(len(far), np.int32)))
            g = np.concatenate((g[~common], np.full(len(marks), -1, np.int64), g[common]))
        for at in range(0, len(tok), 100_000):
            part_ = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tok[part_]), pa.array(g[part_]), pa.array(n[part_])],
                names=["element", "g", "n"])

    def run(batches):
        seen, toks, gs, ns, size = set(), [], [], [], 0
        for batch in batches:
            for doc, text in _columns(batch):
                s = shingle_set(text)
                if not len(s) or doc is None:
                    continue
                g = group_id(s)
                key = g if part == "low" else set_id(s)
                if key in seen:
                    continue
                own = s[:low_count(s)] if part == "low" else s[low_count(s):]
                if not len(own):
                    continue
                seen.add(key)
                toks.append(own)
                gs.append(np.full(len(own), g, np.int64))
                ns.append(np.full(len(own), len(s), np.int32))
                size += len(own)
                if size >= TOGETHER:
                    yield from rows_of(toks, gs, ns)
                    seen, toks, gs, ns, size = set(), [], [], [], 0
        if toks:
            yield from rows_of(toks, gs, ns)

    ddl = "element long, g long, n int"
    return docs.mapInArrow(run, ddl) if flat is None else map_passing(docs, flat, run, ddl)


def similar_sizes(a, b):
    return 4 * np.minimum(a, b) >= 3 * np.maximum(a, b)


def runs_to_pairs(g: np.ndarray, n: np.ndarray, first: np.ndarray, count: np.ndarray):
    """Pairs (smaller, larger) within the runs, sizes permitting."""
    out = []
    for size in np.unique(count):
        if size < 2:
            continue
        at = first[count == size]
        i, j = np.triu_indices(int(size), 1)
        step = max(1, 400_000 // len(i))
        for lo in range(0, len(at), step):
            rows = at[lo:lo + step, None] + np.arange(size)
            a, b = rows[:, i].ravel(), rows[:, j].ravel()
            ok = similar_sizes(n[a], n[b])
            x, y = g[a[ok]], g[b[ok]]
            out.append((np.minimum(x, y), np.maximum(x, y)))
    return out


def met(hot: int):
    """Task body: sorted (element, g, n) to (a, b) pairs of cold and (g, -1) of hot elements."""

    def batch_of(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = g = np.empty(0, np.int64)
        n = np.empty(0, np.int32)
        hot_now = None                                   # the hot element whose rows go by
        held: list = []                                  # no more than a few batches
        done = False
        source = iter(batches)
        while not done:
            batch = next(source, None)
            done = batch is None
            if not done:
                held.append((batch.column("element").to_numpy(), batch.column("g").to_numpy(),
                             batch.column("n").to_numpy()))
                if sum(len(h[0]) for h in held) < 100_000:
                    continue
            t, gg, nn = (np.concatenate([c, *[h[k] for h in held]])
                         for k, c in enumerate((tok, g, n)))
            held = []
            if not len(t):
                continue
            fresh = np.concatenate(([True], (t[1:] != t[:-1]) | (gg[1:] != gg[:-1])))
            t, gg, nn = t[fresh], gg[fresh], nn[fresh]
            if hot_now is not None:
                go = t == hot_now
                if go.any():
                    yield batch_of(gg[go & (nn > 0)], np.full((go & (nn > 0)).sum(), -1))
                    t, gg, nn = t[~go], gg[~go], nn[~go]
                if not len(t):
                    tok, g, n = t, gg, nn
                    continue
            spread_ = t < 0
            if spread_.any():
                yield batch_of(gg[spread_], np.full(spread_.sum(), -1))
                t, gg, nn = t[~spread_], gg[~spread_], nn[~spread_]
                if not len(t):
                    tok, g, n = t, gg, nn
                    continue
            edge = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            count = np.diff(np.concatenate((edge, [len(t)])))
            weight = np.add.reduceat(np.where(nn < 0, hot + 1, 1), edge)
            open_last = not done and weight[-1] <= hot
            upto = len(edge) - 1 if open_last else len(edge)
            is_hot = weight[:upto] > hot
            if not open_last and not done:
                hot_now = t[-1]
            if is_hot.any():
                rows = np.repeat(is_hot, count[:upto])
                own = gg[:len(rows)][rows & (nn[:len(rows)] > 0)]
                yield batch_of(own, np.full(len(own), -1))
            for a, b in runs_to_pairs(gg, nn, edge[:upto][~is_hot], count[:upto][~is_hot]):
                if len(a):
                    yield batch_of(a, b)
            keep = slice(edge[-1], None) if open_last else slice(len(t), None)
            tok, g, n = t[keep], gg[keep], nn[keep]

    return run


def meetings(docs: DataFrame, part: str, hot: int, name: str, flat=None) -> DataFrame:
    """(a, b, shared) of group pairs, and (g, -1, hot elements) of groups; written."""
    rows = element_rows(docs, part, hot, flat)
    sorted_ = rows.repartition("element").sortWithinPartitions("element", "g")
    out = sorted_.mapInArrow(met(hot), "a long, b long")
    return written(out.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")), name)


def verified(docs: DataFrame, pairs: DataFrame, reps: DataFrame, name: str) -> DataFrame:
    """The pairs (x, y) of set ids that link; ``reps`` gives each set's document (fp, doc_id)."""
    pairs = written(pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
                    .where("x <> y").distinct(), f"{name}-pairs")
    needed = pairs.select(F.col("x").alias("fp")).union(pairs.select("y")).distinct()
    chosen = reps.join(needed, "fp").select("doc_id")

    def sets(batches):
        for batch in batches:
            own = [shingle_set(t) for t in batch.column("text").to_pylist()]
            own = [s for s in own if len(s)]
            for at in range(0, len(own), 500):
                some = own[at:at + 500]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(s) for s in some], pa.int64()),
                     pa.array([s.tobytes() for s in some], pa.binary())], names=["fp", "s"])

    held = map_passing(docs, id_filter(chosen), sets, "fp long, s binary")

    def check(batches):
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("sx"), batch.column("sy")):
                a, b = np.frombuffer(a.as_buffer(), np.int64), np.frombuffer(b.as_buffer(),
                                                                             np.int64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(7 * both >= 3 * (len(a) + len(b)))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("x").filter(keep),
                                              batch.column("y").filter(keep)], names=["x", "y"])

    one = pairs.join(held.select(F.col("fp").alias("x"), F.col("s").alias("sx")), "x")
    two = one.join(held.select(F.col("fp").alias("y"), F.col("s").alias("sy")), "y")
    links = two.select("x", "y", "sx", "sy").mapInArrow(check, "x long, y long").distinct()
    return written(links, f"{name}-links")


def _p(n):
    return n - F.ceil(n * 3 / 4) + 1


def set_elements(docs: DataFrame, flat, name: str) -> DataFrame:
    """(element, fp, n, first, last): shared ones of the first p elements of each set, of the documents
    that ``flat`` may hold.

    The order is by how many of these sets have the element, then by hash, so that what very many
    share comes last.  Elements that no other set has need no row.  ``first`` and ``last`` number
    a set's rows from either end.
    """

    def run(batches):
        for batch in batches:
            seen = set()
            for text in batch.column("text").to_pylist():
                s = shingle_set(text)
                if not len(s):
                    continue
                fp = set_id(s)
                if fp in seen:
                    continue
                seen.add(fp)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s), pa.array(np.full(len(s), fp)),
                     pa.array(np.full(len(s), len(s)))], names=["element", "fp", "n"])

    rows = written(map_passing(docs, flat, run, "element long, fp long, n long").distinct(),
                   f"{name}-sets")
    counts = rows.groupBy("element").agg(F.count(F.lit(1)).alias("df"))
    place = Window.partitionBy("fp").orderBy("df", "element")       # within one set
    ranked_ = rows.join(counts, "element").withColumn("k", F.row_number().over(place) - 1).where(
        (F.col("k") < _p(F.col("n"))) & (F.col("df") > 1))
    up, down = (Window.partitionBy("fp").orderBy(o) for o in (F.asc("k"), F.desc("k")))
    return written(ranked_.withColumn("first", F.row_number().over(up) - 1).withColumn(
        "last", F.row_number().over(down) - 1).drop("df", "k"), f"{name}-elements")


def _reach(a: str, b: str, shared):
    """Whether ``shared`` of both first p elements can still be 3/4 with all that come after.

    Whatever else is shared comes after the end of the prefix that ends first in the common order,
    so it is among the rest of that set, whichever it is.
    """
    n = [F.col(f"{side}.n") for side in (a, b)]
    after = F.greatest(*[x - _p(x) for x in n])
    return (4 * F.least(*n) >= 3 * F.greatest(*n)) & (7 * (shared + after) >= 3 * (n[0] + n[1]))


def _may_link(a: str, b: str, first: bool):
    """Whether two rows of one element (the first they share, or any) allow their sets to link."""
    after = F.least(f"{a}.last", f"{b}.last") + 1
    return _reach(a, b, after if first else after + F.least(f"{a}.first", f"{b}.first"))


def pivot_pairs(rows: DataFrame) -> DataFrame:
    """(x, y): each set with a few pivots of its rarest and of its most common elements.

    One pivot is the set with the fewest elements of its own, which most copies resemble; the others
    have the least hash of element, set and seed, so that elements of the same sets differ in them.
    """
    some = rows.where((F.col("first") < PIVOT_ELEMENTS) | (F.col("last") < PIVOT_ELEMENTS))
    out = None
    for seed in range(PIVOTS):
        h = F.xxhash64("fp", "element", F.lit(seed))
        own = F.lit(0) if seed else -(F.col("first") + F.col("last"))
        pivot = rows.groupBy("element").agg(
            F.min(F.struct(own.alias("own"), h.alias("h"), "fp", "n", "first", "last")).alias("p"))
        pivot = pivot.select("element", "p.*")
        met_ = some.alias("l").join(
            pivot.alias("r"), F.col("l.element") == F.col("r.element")).where(
            (F.col("l.fp") != F.col("r.fp")) & _may_link("l", "r", first=False)).select(
            F.col("l.fp").alias("x"), F.col("r.fp").alias("y"))
        out = met_ if out is None else out.union(met_)
    return out


def across(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(x, y) of sets in different components that share an element.

    Within an element the largest component's sets are never paired with each other, nor are
    elements of one component touched at all.  A pair meets only at elements that can be the first
    they share, going by how many of each set's rows come after.
    """
    own = rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    own = written(own, "hot-roots")
    per = own.groupBy("element", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = per.groupBy("element").agg(
        F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("m")).where(
        "m > 1").select("element", F.col("top.root").alias("top"))
    inside = own.join(mixed, "element")
    few = inside.where("root <> top")
    return inside.alias("l").join(
        few.alias("r"), F.col("l.element") == F.col("r.element")).where(
        (F.col("l.root") != F.col("r.root"))
        & ((F.col("l.root") == F.col("l.top")) | (F.col("l.fp") < F.col("r.fp")))
        & _may_link("l", "r", first=True)).select(F.col("l.fp").alias("x"), F.col("r.fp").alias("y"))


def join(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    return roots_of(docs, hot).select("doc_id", "n_shingles", "component_id")


def roots_of(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, h, n_shingles, component_id, root) of every row of (doc_id, text).

    ``h`` is Spark's hash of the text; ``root`` tells components apart where ids are repeated, and
    is null for rows without a set or an id, which link with nothing.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = written(members(docs), "members")
    known = every.where(F.col("fp").isNotNull())
    classes = written(known.groupBy("fp", "g", "n", "low").agg(F.min("doc_id").alias("doc_id")),
                      "classes")
    reps = classes.select("fp", "doc_id")
    group = classes.groupBy("g").agg(F.first("n").alias("n"), F.first("low").alias("low"),
                                     F.min("fp").alias("rep"), F.count(F.lit(1)).alias("sets"))

    one = meetings(docs, "low", hot, "round1")
    hots = one.where("b = -1").select(F.col("a").alias("g"), F.col("shared").alias("hot1"))
    group = written(group.join(hots, "g", "left").withColumn(
        "hot1", F.coalesce("hot1", F.lit(0))), "groups")
    short = written(group.where(F.col("low") - F.col("hot1") < _p(F.col("n"))), "short-groups")
    two = meetings(docs, "high", hot, "round2", id_filter(reps_of(classes, short)))
    hots = two.where("b = -1").select(F.col("a").alias("g"), F.col("shared").alias("hot2"))
    short = short.join(hots, "g", "left").select("g", F.coalesce("hot2", F.lit(0)).alias("hot2"))
    group = written(group.join(short, "g", "left"), "groups2")

    pairs = one.where("b <> -1").select("a", "b", "shared", F.lit(0).alias("more")).union(
        two.where("b <> -1").select("a", "b", F.lit(0).alias("shared"), "shared")).groupBy(
        "a", "b").agg(F.sum("shared").alias("shared"), F.sum("more").alias("more"))
    a, b = (group.select([F.col(c).alias(f"{s}_{c}") for c in group.columns]) for s in "ab")
    n = F.col("a_n") + F.col("b_n")
    counted = F.col("shared") + F.least("a_hot1", "b_hot1") + F.when(
        F.col("a_hot2").isNotNull() & F.col("b_hot2").isNotNull(),
        F.col("more") + F.least("a_hot2", "b_hot2")).otherwise(
        F.least(F.col("a_n") - F.col("a_low"), F.col("b_n") - F.col("b_low")))
    pairs = written(
        pairs.join(a, F.col("a") == F.col("a_g")).join(b, F.col("b") == F.col("b_g")).where(
            7 * counted >= 3 * n).select(
            "a", "b", F.col("a_rep").alias("x"), F.col("b_rep").alias("y"),
            ((F.col("a_sets") > 1) | (F.col("b_sets") > 1)).alias("many"),
            ((F.col("shared") + F.col("more")) / n).alias("close")), "group-pairs")

    full = group.where(F.col("hot1") + F.col("hot2") >= F.ceil(F.col("n") * 3 / 4))
    hot_rows = set_elements(docs, id_filter(reps_of(classes, full)), "hot")

    # first: the best partner of each group, each group's sets with its first, and the pivots
    ends = pairs.select("x", "y", "close").union(
        pairs.select(F.col("y").alias("x"), F.col("x").alias("y"), "close"))
    best = ends.groupBy("x").agg(F.max(F.struct("close", "y")).alias("m")).select("x", "m.y")
    within = classes.join(group.where("sets > 1").select("g", "rep"), "g").where(
        "fp <> rep").select(F.col("rep").alias("x"), F.col("fp").alias("y"))
    links = verified(docs, best.union(within).union(pivot_pairs(hot_rows)), reps, "first")
    roots = components(links)

    # then: whatever could link and still lies in different components
    loose = written(unsettled(pairs, classes, group, roots), "loose-groups")
    loose_rows = set_elements(docs, id_filter(reps_of(classes, loose)), "loose")
    rest = apart(pairs.select("x", "y"), roots).union(
        across(loose_rows, roots)).union(across(hot_rows, roots))
    links = links.union(verified(docs, rest, reps, "then"))
    roots = components(links)

    of_set = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    ids = of_set.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = of_set.join(ids, "root").select("fp", "component_id", "root")
    return every.join(named, "fp", "left").select(
        "doc_id", "h", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "root")


def reps_of(classes: DataFrame, groups: DataFrame) -> DataFrame:
    return classes.join(groups.select("g"), "g").select("doc_id")


def unsettled(pairs: DataFrame, classes: DataFrame, group: DataFrame,
              roots: DataFrame) -> DataFrame:
    """(g) of groups whose sets may link with others, of their group or a pair, in other components.

    A group's home is its first set's component.  A group with all sets at home needs nothing
    within, nor with a group that has the same home and all its sets there.
    """
    several = group.where("sets > 1").select("g", "rep")
    home = group.select("g", "rep").join(roots.withColumnRenamed("node", "rep"), "rep",
                                         "left").select("g", F.coalesce("root", "rep").alias("h"))
    sets = classes.select("g", "fp").join(
        roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    away = sets.join(several.join(home, "g").select("g", "h"), "g").where("root <> h").select(
        "g").distinct()
    at = home.join(away.withColumn("away", F.lit(True)), "g", "left")
    both = pairs.where("many").select("a", "b").join(
        at.select(F.col("g").alias("a"), F.col("h").alias("ha"), F.col("away").alias("wa")),
        "a").join(
        at.select(F.col("g").alias("b"), F.col("h").alias("hb"), F.col("away").alias("wb")),
        "b").where("ha <> hb or wa or wb")
    return away.union(both.select("a")).union(both.select("b")).distinct()


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    l, r = (roots.select(F.col("node").alias(n), F.col("root").alias(f"root_{n}"))
            for n in ("x", "y"))
    return pairs.join(l, "x", "left").join(r, "y", "left").where(
        F.coalesce("root_x", "x") != F.coalesce("root_y", "y")).select("x", "y")
