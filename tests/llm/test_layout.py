"""Sharding, packing and mixing: laws, plans and round trips."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from boreflow.llm import mixing, packing, sharding
from boreflow.llm.common import store, table

from .helpers import TEXTS, empty, fixture

SF = "/root/testdata/sf0.01"


def brute_shards(rows, shards=8, seed=17):
    """(doc_id, size, crc, shard, slot) by sorting everything in one place."""
    strata = defaultdict(list)
    for i, t, s in rows:
        raw = (t or "").encode()
        key = hashlib.md5(f"{seed}:{i if i is not None else chr(0)}".encode()).hexdigest()
        strata["" if s is None else "=" + s].append((key, len(raw) + 1, zlib.crc32(raw), i))
    order = []
    for s, found in strata.items():
        for r, x in enumerate(sorted(found, key=lambda x: x[:3]), 1):
            order.append(((2 * r - 1) / (2 * len(found)), s, *x))
    order.sort(key=lambda x: x[:4])
    out, slots = Counter(), Counter()
    for g, (_, _, _, size, crc, i) in enumerate(order):
        k = g * shards // len(order)
        out[(i, size, crc, k, slots[k])] += 1
        slots[k] += 1
    return out


@pytest.mark.parametrize("source", ["fixture", "documents"])
def test_shards(spark, source):
    docs = fixture(spark) if source == "fixture" else table(spark, SF, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    out = sharding.interleave(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in out) == brute_shards(rows)
    counts = Counter(r.shard for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(r.law == "rows" and r.grown_shard is None for r in out)
    for k, n in counts.items():
        assert sorted(r.slot for r in out if r.shard == k) == list(range(n))
    by_source = Counter(r.source for r in out)
    here = Counter((r.shard, r.source) for r in out)
    for (k, s), n in here.items():
        assert abs(n - by_source[s] / 8) <= 2


def test_fewer_rows_than_shards(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "a", "x")], "doc_id long, text string, source string")
    out = sharding.interleave(docs).collect()
    assert sorted(r["size"] for r in out) == [1, 2] and all(r.slot == 0 for r in out)
    assert sharding.interleave(empty(spark)).count() == 0


# --- packing -------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=40))
def test_plan_uses_every_count_once(counts):
    patterns = packing.plan(counts, 64)
    used = Counter()
    for lengths, times in patterns:
        assert sum(lengths) <= 64 and times > 0
        for x in lengths:
            used[x] += times
    assert used == Counter(counts)
    places = set()
    for length, low, high, copies, sequence, offset in packing.plan_rows(patterns):
        for r in range(high - low):
            for token in range(length):
                place = (sequence + r // copies, offset + r % copies * length + token)
                assert place not in places
                places.add(place)
    assert len(places) == sum(k * n for k, n in counts.items())


def test_exact_complements_are_found():
    assert packing.plan({1000: 5, 24: 5}) == [([1000, 24], 5)]
    assert packing.plan({600: 3, 400: 3, 24: 3}) == [([600, 400, 24], 3)]
    assert packing.plan({700: 2, 200: 2, 100: 2, 24: 2}) == [([700, 200, 100, 24], 2)]


def test_cuts():
    assert packing.cuts(1, 1024) == [(0, 1)]
    assert packing.cuts(1024, 1024) == [(0, 1024)]
    assert packing.cuts(1030, 1024) == [(0, 6), (6, 1024)]
    assert packing.cuts(2048, 1024) == [(0, 1024), (1024, 1024)]


PLAIN = "\n" + "".join(map(chr, range(32, 127))) + "".join(chr(x) for x in range(0xA1, 0x180) if x != 0xAD)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(alphabet=PLAIN), st.text(alphabet=" \n'dlmstvre09.,aéß"), st.text()))
def test_both_encoders_agree(text):
    whole, plain = packing.encoders(None, None)
    assert packing.encode(text, whole, plain).tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("source", ["fixture", "documents"])
def test_packed(spark, source):
    docs = fixture(spark) if source == "fixture" else table(spark, SF, "documents")
    whole, _ = packing.encoders(None, None)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        for p, (s, n) in enumerate(packing.cuts(len(ids), 1024)):
            want[(r.doc_id, p, s, n, zlib.crc32(ids[s : s + n].tobytes()))] += 1
    rows = packing.packed(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    placed = defaultdict(list)
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    bound = math.ceil(sum(r.length for r in rows) / 1024)
    assert bound <= len(placed) <= 1.03 * bound + 1


def test_sequences_hold_the_ids(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    pieces = store(packing.tokenized_pieces(docs), "test-pieces")
    placed = packing.pack(pieces.select("doc_id", "piece", "length"))
    ids = {(r.doc_id, r.piece): bytes(r.ids) for r in pieces.collect()}
    rows = sorted(placed.collect(), key=lambda r: (r.sequence_id, r.offset))
    want = defaultdict(bytes)
    for r in rows:
        want[r.sequence_id] += ids[r.doc_id, r.piece]
    assert {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces, placed).collect()} == want


def test_packing_nothing(spark):
    assert packing.packed(empty(spark)).count() == 0


# --- mixing ---------------------------------------------------------------------------


def test_solve():
    sizes = {"a": 1000, "b": 100, "c": 10}
    exponent, weights = mixing.solve(sizes, max_epochs=2.0)
    reads = mixing.epochs(sizes, weights, None)
    assert math.isclose(min(reads.values()), 1) and math.isclose(max(reads.values()), 2, rel_tol=1e-9)
    assert math.isclose(exponent, 1 - math.log(2) / math.log(100), rel_tol=1e-9)
    _, weights = mixing.solve(sizes, None, entropy=0.9)
    assert math.isclose(mixing.entropy_of(weights), 0.9, rel_tol=1e-9)
    assert mixing.solve(sizes, max_epochs=1000)[0] == 0
    assert mixing.solve({"a": 5}) [1] == {"a": 1.0}
    with pytest.raises(ValueError):
        mixing.solve(sizes, max_epochs=2.0, budget=5000)


@pytest.mark.parametrize("source", ["fixture", "documents"])
def test_mix(spark, source):
    docs = fixture(spark) if source == "fixture" else table(spark, SF, "documents")
    out = mixing.mix(docs)
    assert out.columns == docs.columns + ["mix_tokens", "mix_epoch", "mix_weight", "mix_position", "mix_at"]
    rows = out.select("doc_id", "text", "source", "mix_tokens", "mix_epoch", "mix_weight", "mix_position", "mix_at").collect()
    given_rows = docs.select("doc_id", "text", "source").collect()
    size = Counter()
    for r in given_rows:
        size[r.source] += len((r.text or "").replace("\x1c", "_").split()) + 1
    _, weights = mixing.solve({str(s): n for s, n in size.items()})
    reads = mixing.epochs({str(s): n for s, n in size.items()}, weights, None)
    once = Counter((r.doc_id, r.text, r.source) for r in given_rows)
    assert Counter((r.doc_id, r.text, r.source) for r in rows if r.mix_epoch == 0) == once
    assert not Counter((r.doc_id, r.text, r.source) for r in rows if r.mix_epoch == 1) - once
    for s, n in size.items():
        own = sorted((r.mix_position, r.mix_tokens) for r in rows if r.source == s)
        target, at = reads[str(s)] * n, 0
        for position, tokens in own:  # read end to end, until the budget is used up
            assert position == at
            at += tokens
        assert at >= target - 1e-6 and own[-1][0] < target
        assert all(math.isclose(r.mix_weight, weights[str(s)]) for r in rows if r.source == s)


def test_mix_down_to_a_budget(spark):
    docs = table(spark, SF, "documents")
    rows = mixing.mix(docs, max_epochs=4.0, budget=50_000).collect()
    assert abs(sum(r.mix_tokens for r in rows) - 50_000) < 25 * max(r.mix_tokens for r in rows)
    assert mixing.mix(empty(spark)).count() == 0
    assert len(TEXTS) == mixing.mix(fixture(spark), max_epochs=1.0).count()
