"""Best-fit decreasing: the plan against one-by-one placement, and the packed rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from boreflow.llm import best_fit, packing
from boreflow.llm.common import table

from .helpers import empty, fixture

SF = "/root/testdata/sf0.01"


def one_by_one(counts, capacity):
    """The contents of the sequences, each piece put into the tightest window by trying all."""
    windows = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        fits = [w for w in windows if capacity - sum(w) >= length]
        if fits:
            min(fits, key=lambda w: capacity - sum(w)).append(length)
        else:
            windows.append([length])
    return Counter(tuple(w) for w in windows)


def contents(places):
    """sequence -> lengths in order of offset, checked for overlaps and gaps."""
    found, ranks = defaultdict(list), defaultdict(set)
    for length, low, high, copies, sequence, offset in places:
        for r in range(high - low):
            assert low + r not in ranks[length]
            ranks[length].add(low + r)
            found[sequence + r // copies].append((offset + r % copies * length, length))
    for w in found.values():
        w.sort()
        assert all(o == sum(x for _, x in w[:k]) for k, (o, _) in enumerate(w))
    return found, {x: len(r) for x, r in ranks.items()}


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=30))
def test_plan_is_best_fit_decreasing(counts):
    found, used = contents(best_fit.plan(counts, 50))
    assert used == counts
    assert Counter(tuple(x for _, x in w) for w in found.values()) == one_by_one(counts, 50)


def test_tree_finds_the_tightest():
    rng = np.random.default_rng(3)
    for capacity in (1, 7, 8, 50):
        w, rooms = best_fit.Windows(capacity), set()
        for room in rng.integers(1, capacity + 1, 20).tolist():
            w.add(room, 0, 1)
            rooms.add(room)
            for length in range(1, capacity + 1):
                assert w.tightest(length) == min((r for r in rooms if r >= length), default=None)


def test_cuts():
    assert best_fit.cuts(1, 2048) == [(0, 1)]
    assert best_fit.cuts(2048, 2048) == [(0, 2048)]
    assert best_fit.cuts(5000, 2048) == [(0, 2048), (2048, 2048), (4096, 904)]


@pytest.mark.parametrize("source", ["fixture", "documents"])
def test_packed(spark, source):
    docs = fixture(spark) if source == "fixture" else table(spark, SF, "documents")
    whole, _ = packing.encoders(None, None)
    want, tokens = Counter(), 0
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        tokens += len(ids)
        for s, n in best_fit.cuts(len(ids), 2048):
            want[(r.doc_id, s, n, zlib.crc32(ids[s : s + n].tobytes()), len(ids))] += 1
    rows = best_fit.packed(docs).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for w in by_sequence.values():
        w.sort()
        assert all(o == sum(x for _, x in w[:k]) for k, (o, _) in enumerate(w)) and sum(x for _, x in w) <= 2048
    lengths = Counter(r.length for r in rows)
    assert len(by_sequence) == sum(one_by_one(lengths, 2048).values())
    if source == "documents":
        assert len(by_sequence) * 2048 - tokens < 0.002 * tokens


def test_copies_without_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "the same text")] * 500, "doc_id long, text string")
    rows = best_fit.packed(docs).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 500
    pieces = best_fit.tokenized(docs.coalesce(1)).collect()
    assert len({r.nth for r in pieces}) == 500
    assert best_fit.packed(empty(spark)).collect() == []
