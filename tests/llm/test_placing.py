import zlib

import numpy as np
import pytest
from helpers import empty_documents, odd_documents, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.llm import packing, sharding
from rollcall.llm.common import ranked


def walk(counts, shard_of, bounds):
    """Row by row: every row goes on clockwise until a shard has room, in rounds."""
    room = list(bounds)
    waiting = [(arc, arc) for arc, n in enumerate(counts) for _ in range(n)]
    got = [[0] * len(bounds) for _ in counts]
    while waiting:
        later = []
        for arc, at in waiting:
            if room[shard_of[at]]:
                room[shard_of[at]] -= 1
                got[arc][shard_of[at]] += 1
            else:
                later.append((arc, (at + 1) % len(counts)))
        waiting = later
        waiting.sort()
    return got


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=6, max_size=12))
def test_flow_places_every_row_within_bounds(counts):
    shard_of = np.array([i % 3 for i in range(len(counts))])
    bounds = sharding.bounds_for(sum(counts), 3)
    out = sharding.flow(np.array(counts), shard_of, bounds)
    held = {}
    for arc, lo, hi, shard, first in out:
        held.setdefault(shard, []).append((first, first + hi - lo))
    for shard, parts in held.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert parts[-1][1] == bounds[shard]
    for arc, n in enumerate(counts):
        own = sorted((lo, hi) for a, lo, hi, _, _ in out if a == arc)
        assert sum(hi - lo for lo, hi in own) == n


def test_rows_that_fit_stay_with_their_owner():
    counts, shard_of = np.array([5, 1, 1, 5]), np.array([0, 1, 0, 1])
    out = sharding.flow(counts, shard_of, np.array([6, 6]))
    assert {(a, s, hi - lo) for a, lo, hi, s, _ in out} == {(0, 0, 5), (1, 1, 1), (2, 0, 1),
                                                           (3, 1, 5)}
    assert walk(counts, shard_of, [6, 6]) == [[5, 0], [0, 1], [1, 0], [0, 5]]


def test_owner_is_next_clockwise():
    points = np.array([10, 20, 30])
    assert sharding.owner(points, np.array([5, 10, 11, 30, 31])).tolist() == [0, 0, 1, 2, 0]


def test_one_more_shard_takes_rows_only_into_itself():
    places = np.random.default_rng(1).integers(0, sharding.RING, 5000)
    points, own = sharding.ring(16, 64)
    more, own2 = sharding.ring(17, 64)
    before = own[sharding.owner(points, places)]
    after = own2[sharding.owner(more, places)]
    assert set(after[before != after]) == {16}


def test_shards_of_odd_rows(spark):
    docs = odd_documents(spark, [(50 + i, "the same text", "en", "s", 1, "x") for i in range(300)])
    docs = docs.withColumn("Shard", F.lit(99)).withColumn("slot", F.lit("own"))
    rows = sharding.shard(docs, F.col("text"), ["doc_id", "text"], shards=7).collect()
    assert len(rows) == docs.count() and {(r["Shard"], r["slot"]) for r in rows} == {(99, "own")}
    for s in range(7):
        slots = sorted(r["slot_"] for r in rows if r["shard_"] == s)
        assert slots == list(range(len(slots))) and len(slots) in (44, 45, 43)
    assert sharding.shard(empty_documents(spark), F.col("text"), ["doc_id"]).count() == 0


@pytest.mark.parametrize("per_task", [3, 1000])
def test_ranks_are_gapless_in_a_hot_group(spark, per_task):
    df = spark.range(500).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 50 as string)) as g")
    df = df.union(spark.createDataFrame([(7000, None), (7001, None)], "id long, g string"))
    got = {}
    for r in ranked(df, ["g"], ["id"], "rank", per_task).collect():
        got.setdefault(r["g"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values()) and len(got[None]) == 2


TOKENIZER = None


def ids_of(text):
    global TOKENIZER
    from tokenizers import Tokenizer
    TOKENIZER = TOKENIZER or Tokenizer.from_file(packing.vocabulary_path())
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_encoder_equals_the_tokenizer(texts):
    encode = packing.Encoder(packing.vocabulary_path())
    for text, raw in zip(texts, encode.each(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("text", [
    "It's <|endoftext|> we'll 123 ÀÉ", "a\x1cb\x85c\xa0d", "Ǆ İi ΑΣ Σ", "é ﬁ 漢字 ½"])
def test_encoder_on_odd_texts(text):
    raw = packing.Encoder(packing.vocabulary_path())(text)
    assert np.frombuffer(raw, "<u4").tolist() == ids_of(text)


def best_by_search(price, room):
    best = [0.0] * (room + 1)
    for c in range(1, room + 1):
        best[c] = max([best[c - 1]] + [best[c - k] + price[k - 1]
                                       for k in range(1, min(c, len(price)) + 1)])
    return best[room]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0, 1), min_size=12, max_size=12))
def test_knapsack(price):
    worth, counts = packing.best_pattern(np.array(price), 12)
    assert abs(worth - best_by_search(price, 12)) < 1e-9
    assert (counts * np.arange(1, 13)).sum() <= 12
    assert abs((counts * np.array(price)).sum() - worth) < 1e-6


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=16, max_size=16))
def test_patterns_hold_the_demand_in_few_sequences(demand):
    demand = np.array(demand)
    program = packing.column_generation(demand)
    plan = packing.rounded(demand, program)
    assert (sum((n * p for p, n in plan), np.zeros(16, int)) == demand).all()
    assert all((p * np.arange(1, 17)).sum() <= 16 for p, _ in plan)
    used, lower = sum(n for _, n in plan), sum(u for _, u in program)
    assert used <= lower + 9


def test_packing_is_an_exact_round_trip(spark):
    rng = np.random.default_rng(2)
    more = [(100 + i, " ".join(words(rng, int(rng.integers(1, 3000)))), "en", "s", 1, "x")
            for i in range(60)] + [(300 + i, "equal rows", "en", "s", 1, "x") for i in range(200)]
    docs = odd_documents(spark, more)
    rows = packing.pack(docs).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(ids_of(r["text"]) + [2])
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == texts.keys()
    for doc, wanted in texts.items():
        assert sum(r["length"] for r in pieces[doc]) == sum(map(len, wanted))
        if len(wanted) == 1:
            own = sorted(pieces[doc], key=lambda r: r["start"])
            at = 0
            for r in own:
                ids = np.array(wanted[0][at:at + r["length"]], "<u4")
                assert (r["start"], r["doc_tokens"]) == (at, len(wanted[0]))
                assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
                at += r["length"]
            assert at == len(wanted[0])
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) <= packing.CAPACITY
    assert sum(r["length"] for r in rows) >= 0.9 * packing.CAPACITY * (len(held) - 1)
    assert packing.pack(empty_documents(spark)).count() == 0
