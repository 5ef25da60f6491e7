"""Periodic runs against a scan of every period."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from boreflow.llm import periodic
from boreflow.llm.common import table

from .helpers import WORD, empty, fixture

SF = "/root/testdata/sf0.01"


def scan(x):
    """(start, length, period) of every run, by comparing the sequence with itself at every distance."""
    n, out = len(x), {}
    for q in range(1, n // 3 + 1):
        same = np.concatenate(([False], x[:-q] == x[q:], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            if b - a >= max(24, 3 * q):
                out.setdefault((a, b), q)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def brute(doc_id, text, plant):
    words = re.findall(WORD, text or "")
    n = len(words)
    if plant and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    known = {}
    found = scan(np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64))
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = sorted(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (
        "".join(f"{s},{m},{q}\n" for s, m, q in found), " ".join(w for i, w in enumerate(words) if i not in dropped))]
    return (doc_id, len(found), *(best[0] if best else (None,) * 3), best[0][1] * 1000 // best[0][2] if best else None, *sha)


def test_transform_is_exact():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, periodic.PRIME, (3, 64)).astype(np.uint64)
    assert (periodic.restore(periodic.transform(rows)) == rows).all()
    blocks = rng.integers(1, 3, (20, 8)).astype(np.uint64)
    windows = rng.integers(1, 3, (20, 22)).astype(np.uint64)
    found = set(zip(*(v.tolist() for v in periodic.zero_mismatch(blocks, windows, 15))))
    assert found == {(i, t) for i in range(20) for t in range(15) if (windows[i, t : t + 8] == blocks[i]).all()}


def test_random_sequences():
    rng = random.Random(11)
    for _ in range(400):
        letters, n, x = rng.choice([1, 2, 3, 50]), rng.randint(0, 400), []
        while len(x) < n:
            unit = [rng.randint(1, letters) for _ in range(rng.randint(1, rng.choice([3, 20, 80])))]
            x += (unit * rng.randint(1, 9))[: rng.randint(1, 250)]
        x = np.array(x[:n], dtype=np.uint64)
        assert periodic.runs(x) == scan(x.astype(np.int64))


@pytest.mark.parametrize("period", range(1, 40))
def test_least_lengths_at_every_start(period):
    length = max(24, 3 * period)
    for before in range(17):
        for n, want in ((length, 1), (length - 1, 0)):
            run = [1 + i % period for i in range(n)]
            x = np.array([1000 + i for i in range(before)] + run + [5000 + i for i in range(9)], dtype=np.uint64)
            assert periodic.runs(x) == [(before, n, period)][:want]


def test_long_sequences():
    x = np.tile(np.random.default_rng(1).integers(1, 5000, 30_000).astype(np.uint64), 4)
    assert periodic.runs(x) == [(0, 120_000, 30_000)]
    assert periodic.runs(np.ones(100_000, np.uint64)) == [(0, 100_000, 1)]


@pytest.mark.parametrize("plant", [False, True])
@pytest.mark.parametrize("source", ["fixture", "documents"])
def test_rows(spark, source, plant):
    docs = fixture(spark) if source == "fixture" else table(spark, SF, "documents")
    rows = docs.select("doc_id", "text").collect()
    out = periodic.periodic_runs(docs, plant=plant)
    assert Counter(tuple(r) for r in out.collect()) == Counter(brute(r.doc_id, r.text, plant) for r in rows)


def test_query_and_empty_table(spark):
    out = periodic.query(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert out.filter("n_runs > 0").count() > 0
    assert periodic.periodic_runs(empty(spark)).collect() == []
