"""Conversation prefix trie by whole-sequence collapse.

Conversations are rebuilt (the first turns of a donor, then the own turns after as many), identical
ones are collapsed into one weighted sequence with a list of ends, the sequences that are proper
prefixes of others are dropped by an anti-join to find the leaves, and weighted prefixes are
aggregated into the nodes of the trie.

A prefix is known by a polynomial hash modulo 2^127 - 1 over hashes of its turns.  Such hashes can
be joined end to end, so a conversation that holds a third of all rows is cut over the partitions
of a sort and put together from one summary per partition.  Sums over subtrees need no walk: see
:func:`nodes_of`.

Defined results: rows without ``conv_id`` are dropped; null roles and texts are empty; turns are
ordered by ``turn`` (null first), then by the first characters of role and text, then by a hash of
both; repeated rows are turns of their own.  No conversations give no nodes, not even the root.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import handed_out, with_fields, written

MODULUS = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix trie").digest()[:15], "big")
IDS_PER_CHUNK = 4096
ROOT = 0                   # hash of the empty sequence
NONE = -1                  # upper half of a parent that is not there; others are not negative
LOW = (1 << 64) - 1

LOCAL = ("conv_id long, part int, at long, h_hi long, h_lo long, p_hi long, p_lo long, "
         "n long, total long, last boolean")
PLACED = "conv_id long, pos long, h_hi long, h_lo long, p_hi long, p_lo long, before long, n long"
PATH = ("s long, w long, len long, total long, depth long, hi long, lo long, p_hi long, p_lo long, "
        "before long, n long")


def halves(value: int) -> tuple[int, int]:
    low = value & LOW
    return value >> 64, low - (1 << 64) if low >> 63 else low


def whole(hi: int, lo: int) -> int:
    return (hi << 64) | (lo & LOW)


class Powers:
    """BASE to the power of small exponents from a list, of others by squaring."""

    def __init__(self, most: int = 1 << 14):
        self.most, self.known = most, [1]

    def __call__(self, k: int) -> int:
        if k >= self.most:
            return pow(BASE, k, MODULUS)
        while len(self.known) <= k:
            self.known.append(self.known[-1] * BASE % MODULUS)
        return self.known[k]


def turn_hash(role: str, text: str) -> int:
    head = role.encode()
    made = hashlib.blake2b(len(head).to_bytes(8, "big") + head + text.encode(), digest_size=16)
    return int.from_bytes(made.digest(), "big") % (MODULUS - 1) + 1


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


# --- turns in order ---------------------------------------------------------------------------

def local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to running hashes and lengths within (conversation, partition)."""
    schema, part = arrow_schema(LOCAL), TaskContext.get().partitionId()
    held, conv, at, run, total = None, None, 0, ROOT, 0
    for batch in batches:
        rows = []
        for key, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if held is not None:
                rows.append((*held, key != conv))
            if held is None or key != conv:
                conv, at, run, total = key, 0, ROOT, 0
            before, run = run, (run * BASE + turn_hash(role, text)) % MODULUS
            at, total = at + 1, total + len(text)
            held = (conv, part, at, *halves(run), *halves(before), len(text), total)
        yield batch_of(rows, schema)
    if held is not None:
        yield batch_of([(*held, True)], schema)


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """Hashes of the turns; conversations are cut where a partition of the sort ends."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), role.alias("role"), text.alias("text"),
        F.col("turn").alias("turn"), F.substring(role, 1, 64).alias("a"),
        F.substring(text, 1, 64).alias("b"), F.xxhash64(role, text).alias("c"),
        F.monotonically_increasing_id().alias("d"))         # spreads rows equal in all the others
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), *map(F.col, "abcd")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("conv_id", "role", "text").mapInArrow(local_runs, LOCAL)


def bases_of(local: DataFrame) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(turns, hash, code points) before each part of a conversation that was cut.

    A partition begins and ends with at most one such conversation, so at most two rows per
    partition come to the driver, whatever the number of rows.
    """
    lasts = local.where("last").select("conv_id", "part", "at", "h_hi", "h_lo", "total")
    cut = lasts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")
    bases, power = {}, Powers()
    key, pos, run, total = None, 0, ROOT, 0
    for r in sorted(lasts.join(cut, "conv_id").collect(), key=lambda r: (r.conv_id, r.part)):
        if r.conv_id != key:
            key, pos, run, total = r.conv_id, 0, ROOT, 0
        bases[r.conv_id, r.part] = pos, run, total
        run = (run * power(r["at"]) + whole(r.h_hi, r.h_lo)) % MODULUS
        pos, total = pos + r["at"], total + r.total
    return bases


def placed(local: DataFrame, give: Callable[[], dict]) -> DataFrame:
    """Rows of ``local`` with their place in, and the hash of, the whole conversation."""

    def run(batches):
        bases, power, schema = give(), Powers(), arrow_schema(PLACED)
        for batch in batches:
            rows = []
            for key, part, at, hi, lo, p_hi, p_lo, n, total, _ in zip(
                    *(c.to_pylist() for c in batch.columns)):
                base = bases.get((key, part))
                if base is None or not base[0]:
                    rows.append((key, at, hi, lo, p_hi, p_lo, total - n, n))
                    continue
                pos, start, before = base
                h = (start * power(at) + whole(hi, lo)) % MODULUS
                p = (start * power(at - 1) + whole(p_hi, p_lo)) % MODULUS
                rows.append((key, pos + at, *halves(h), *halves(p), before + total - n, n))
            yield batch_of(rows, schema)

    return local.mapInArrow(run, PLACED)


# --- rebuilt conversations --------------------------------------------------------------------

def rebuilt(local: DataFrame, give, donor: Column, cut: Column, most: int) -> DataFrame:
    """One row per conversation: hash, turns and code points of its rebuilt form, and how to get
    the hashes of its prefixes from those of its own turns (``delta``, ``moved``)."""
    heads = placed(local.where(F.col("at") <= most), give).where(F.col("pos") <= most).groupBy(
        "conv_id").agg(F.array_sort(F.collect_list(                      # at most ``most``
            F.struct("pos", "h_hi", "h_lo", "p_hi", "p_lo", "before", "n"))).alias("heads"))
    ends = placed(local.where("last"), give).groupBy("conv_id").agg(
        F.max(F.struct("pos", "h_hi", "h_lo", "before", "n")).alias("end"))
    own = ends.join(heads, "conv_id", "left").withColumn("donor", donor).withColumn(
        "cut", cut.cast("int"))
    given = heads.select(F.col("conv_id").alias("donor"), F.col("heads").alias("given"))
    both = own.join(given, "donor", "left").withColumn(
        "given", F.slice(F.coalesce("given", F.expr("array()")), F.lit(1), F.col("cut")))
    taken = F.size("given")
    last, at = F.try_element_at("given", taken), F.try_element_at("heads", F.col("cut"))
    last = F.when(taken > 0, last)
    at = F.when(F.col("cut") > 0, at)
    flat = both.select(
        "conv_id", "cut", "given", F.col("end.pos").alias("turns"), "end.h_hi", "end.h_lo",
        (F.col("end.before") + F.col("end.n")).alias("size"),
        *[F.coalesce(v[c], F.lit(0).cast("long")).alias(f"{name}_{c[-2:]}")
          for name, v in (("g", last), ("o", at)) for c in ("h_hi", "h_lo")],
        F.coalesce(last["before"] + last["n"], F.lit(0)).alias("g_size"),
        F.coalesce(at["before"] + at["n"], F.lit(0)).alias("o_size"))
    hashed = flat.mapInArrow(
        whole_hashes, with_fields(flat, "f_hi long, f_lo long, d_hi long, d_lo long"))
    longer = F.col("turns") > F.col("cut")
    moved = F.col("g_size") - F.col("o_size")
    return hashed.select(
        "conv_id", "f_hi", "f_lo", "cut", "given", "d_hi", "d_lo", moved.alias("moved"),
        (F.size("given") + F.when(longer, F.col("turns") - F.col("cut")).otherwise(0)).cast(
            "long").alias("len"),
        F.when(longer, F.col("size") + moved).otherwise(F.col("g_size")).alias("total"))


def whole_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    power = Powers()
    names = ("cut", "turns", "h_hi", "h_lo", "g_hi", "g_lo", "o_hi", "o_lo")
    for batch in batches:
        made = []
        for cut, turns, h_hi, h_lo, g_hi, g_lo, o_hi, o_lo in zip(
                *(batch.column(n).to_pylist() for n in names)):
            given = whole(g_hi, g_lo)
            delta = (given - whole(o_hi, o_lo)) % MODULUS
            full = given if turns <= cut else (
                whole(h_hi, h_lo) + delta * power(turns - cut)) % MODULUS
            made.append((*halves(full), *halves(delta)))
        more = [pa.array(c, pa.int64()) for c in zip(*made)] if made else [
            pa.array([], pa.int64())] * 4
        yield pa.RecordBatch.from_arrays(
            batch.columns + more, names=[*batch.schema.names, "f_hi", "f_lo", "d_hi", "d_lo"])


# --- prefixes and nodes -----------------------------------------------------------------------

def prefixes(local: DataFrame, give, found: DataFrame, seqs: DataFrame) -> DataFrame:
    """The path of every distinct sequence, one row per prefix, from its smallest member."""
    reps = seqs.select(F.col("s").alias("conv_id"), "w").join(found, "conv_id")
    zero, none = F.lit(ROOT).cast("long"), F.lit(NONE).cast("long")

    def step(x):
        return F.struct(
            x["pos"].alias("depth"), x["h_hi"].alias("hi"), x["h_lo"].alias("lo"),
            *[x[c].alias(c) for c in ("p_hi", "p_lo", "before", "n")])

    root = F.struct(zero.alias("depth"), zero.alias("hi"), zero.alias("lo"), none.alias("p_hi"),
                    none.alias("p_lo"), zero.alias("before"), zero.alias("n"))
    shared = F.col("conv_id").alias("s"), "w", "len", "total"
    begun = reps.select(*shared, F.explode(F.concat(
        F.array(root), F.transform("given", step))).alias("x")).select(
        "s", "w", "len", "total", "x.*")

    def follow(batches):
        power, schema = Powers(), arrow_schema(PATH)
        for batch in batches:
            rows = []
            for (s, pos, hi, lo, p_hi, p_lo, before, n, w, length, total, cut, taken, d_hi, d_lo,
                 moved) in zip(*(c.to_pylist() for c in batch.columns)):
                delta = whole(d_hi, d_lo)
                node = (whole(hi, lo) + delta * power(pos - cut)) % MODULUS
                up = (whole(p_hi, p_lo) + delta * power(pos - 1 - cut)) % MODULUS
                rows.append((s, w, length, total, taken + pos - cut, *halves(node), *halves(up),
                             before + moved, n))
            yield batch_of(rows, schema)

    own = placed(local, give).join(
        reps.select("conv_id", "w", "len", "total", "cut", F.size("given").alias("taken"), "d_hi",
                    "d_lo", "moved"), "conv_id").where(F.col("pos") > F.col("cut"))
    return begun.unionByName(own.mapInArrow(follow, PATH))


def nodes_of(paths: DataFrame, seqs: DataFrame) -> DataFrame:
    """The nodes with their counts; ``saved`` sums (n_convs - 1) times the last text over subtrees.

    Let T be the length of a sequence and ``before`` that of the turns above a node, which all its
    members share.  Members counted with weight, the subtree of a node has
    sum(w * T) - n_convs * before.  Counted once each, its turns are those of its leaves, where
    every node belongs to its leaf with the smallest id (``owner``).  What a leaf owns is the end
    of its path from ``q`` on, so the turns are sum(T - q) over the leaves, plus q of the node's
    owner, less ``before``.
    """
    node = ["hi", "lo"]
    proper = paths.where("depth < len").select(*node).distinct()
    leaves = seqs.join(proper, (F.col("f_hi") == F.col("hi")) & (F.col("f_lo") == F.col("lo")),
                       "left_anti").select("s", F.lit(1).alias("leaf"))
    marked = written(paths.join(leaves, "s", "left").withColumn(
        "leaf", F.coalesce("leaf", F.lit(0))), "trie-paths")
    nodes = written(marked.groupBy(*node, "depth", "p_hi", "p_lo", "before", "n").agg(
        F.sum("w").alias("n_convs"), F.min("s").alias("conv_id"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("w") * F.col("total")).alias("weighted"),
        F.min(F.when(F.col("leaf") == 1, F.col("s"))).alias("owner")), "trie-nodes")
    starts = written(nodes.groupBy("owner").agg(F.min("before").alias("q")), "trie-starts")
    once = marked.where("leaf = 1").join(
        starts.withColumnRenamed("owner", "s"), "s").groupBy(*node).agg(
        F.sum(F.col("total") - F.col("q")).alias("once"))
    kids = nodes.where("depth > 0").groupBy("p_hi", "p_lo").agg(
        F.count(F.lit(1)).alias("n_children")).withColumnsRenamed({"p_hi": "hi", "p_lo": "lo"})
    above = nodes.select(F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"),
                         F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(once, node).join(kids, node, "left").join(starts, "owner")
        .join(above, ["p_hi", "p_lo"], "left")
        .select(
            *node, "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
            (F.col("weighted") - F.col("n_convs") * F.col("before")
             - (F.col("once") + F.col("q") - F.col("before"))).alias("saved_tokens")))


# --- ends -------------------------------------------------------------------------------------

def id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sequence, id) rows to texts of at most ``IDS_PER_CHUNK`` ids."""
    schema = arrow_schema("hi long, lo long, first long, ids string")
    key, ids = None, []
    for batch in batches:
        rows = []
        for hi, lo, one in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (key != (hi, lo) or len(ids) == IDS_PER_CHUNK):
                rows.append((*key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = hi, lo
            ids.append(one)
        yield batch_of(rows, schema)
    if ids:
        yield batch_of([(*key, ids[0], ",".join(map(str, ids)))], schema)


def chunk_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("hi long, lo long, ends_sha256 string")
    key, made = None, None
    for batch in batches:
        rows = []
        for hi, lo, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key == (hi, lo):
                made.update(b",")
            else:
                if key is not None:
                    rows.append((*key, made.hexdigest()))
                key, made = (hi, lo), hashlib.sha256()
            made.update(ids.encode())
        yield batch_of(rows, schema)
    if key is not None:
        yield batch_of([(*key, made.hexdigest())], schema)


def end_digests(found: DataFrame) -> DataFrame:
    """SHA-256 over the ids of the conversations that end in a node.

    The digest of one list is made in order by nature; a list is first joined into chunks over the
    partitions of a sort, so the task that ends it reads one row for 4096 ids, and streams them.
    """
    ids = found.select(F.col("f_hi").alias("hi"), F.col("f_lo").alias("lo"), "conv_id")
    chunks = ids.repartitionByRange("hi", "lo", "conv_id").sortWithinPartitions(
        "hi", "lo", "conv_id").mapInArrow(id_chunks, "hi long, lo long, first long, ids string")
    return chunks.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first").mapInArrow(
        chunk_digests, "hi long, lo long, ends_sha256 string")


# --- the whole --------------------------------------------------------------------------------

def build(conversations: DataFrame, donor: Column | None = None, cut: Column | None = None,
          most: int = 5) -> DataFrame:
    """The trie over rebuilt conversations: one row per node.

    ``donor`` and ``cut`` (columns over ``conv_id``) say from which conversation the first turns
    come and how many are replaced, ``most`` at most; by default none are.
    """
    donor = F.lit(None).cast("long") if donor is None else donor
    cut = F.lit(0) if cut is None else cut
    local = written(turns_in_order(conversations), "trie-turns")
    give = handed_out(local, bases_of(local))
    found = written(rebuilt(local, give, donor, cut, most), "trie-conversations")
    seqs = written(found.groupBy("f_hi", "f_lo", "len", "total").agg(
        F.count(F.lit(1)).alias("w"), F.min("conv_id").alias("s")), "trie-sequences")
    nodes = nodes_of(prefixes(local, give, found, seqs), seqs)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(end_digests(found), ["hi", "lo"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", nothing)).drop("hi", "lo")
