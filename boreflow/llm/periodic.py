"""Periodic run detection (operator 12): block convolution at dyadic scales.

The words of a document are numbered by identity, and at every scale B = 8, 16,
32, ... its number sequence is cut into blocks of B words. The squared
differences between a block and every place of the window that follows it are
one convolution, computed exactly by a number-theoretic transform modulo
``PRIME``; a place with the value zero is where the block occurs again, and its
distance from the block is a candidate period. Scale 8 covers distances 1 to
15, scale B the distances B to 2B - 1. A run of period q and length at least
max(24, 3q) holds an aligned block of the scale of q together with its copy q
words on, so none is missed. A value that is zero modulo ``PRIME`` only is
harmless: each seed is extended to both sides by comparing the words, which
alone decides. Seeds inside a known run, at a multiple of its period, are left
out; so are blocks whose rarest word does not occur again in their window,
which cannot match there.

Every document is worked on by itself in the task that reads it: no shuffle,
and memory for one batch of texts and one block of transforms.

Defined cases
* A NULL or empty text has no words: no runs, empty collapsed text.
* Rows with NULL ids are taken as they are (``planted`` leaves them unchanged).
* Very long texts are searched whole: the transforms run over groups of blocks
  of at most ``GROUP`` numbers (a single block if that is longer).
* Ties for the strongest run go to the smallest start, then period. Repeated
  rows each get their result; an empty table gives no rows; further columns
  are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import prepare_workers, table

LEAST, TIMES = 24, 3
FIRST = 8
#: 15 * 2**27 + 1, with the primitive root 31: transforms of up to 2**27 numbers,
#: more than the words of the longest text that a column can hold need.
PRIME, GENERATOR = 2013265921, 31
GROUP = 1 << 18

_P = np.uint64(PRIME)


# --- number-theoretic transform -------------------------------------------------


@lru_cache(maxsize=64)
def _roots(size: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. size/2 - 1 of a primitive root of unity of order ``size``."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(size // 2, np.uint64)
    have = 1
    while have < len(out):
        step = np.uint64(pow(root, have, PRIME))
        out[have : 2 * have] = out[:have] * step % _P
        have *= 2
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """Transform of every row (a power of two long), in bit-reversed order."""
    n, size = rows.shape
    a, half = rows, size // 2
    while half:
        a = a.reshape(n, -1, 2, half)
        low, high = a[:, :, 0], a[:, :, 1]
        total = low + high
        spread = (low + (_P - high)) * _roots(2 * half, False) % _P
        a = np.stack((np.where(total >= _P, total - _P, total), spread), axis=2)
        half //= 2
    return a.reshape(n, size)


def restore(rows: np.ndarray) -> np.ndarray:
    """Inverse of ``transform``."""
    n, size = rows.shape
    a, half = rows, 1
    while half < size:
        a = a.reshape(n, -1, 2, half)
        low, high = a[:, :, 0], a[:, :, 1] * _roots(2 * half, True) % _P
        total, spread = low + high, low + (_P - high)
        a = np.stack((np.where(total >= _P, total - _P, total), np.where(spread >= _P, spread - _P, spread)), axis=2)
        half *= 2
    return a.reshape(n, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % _P


def zero_mismatch(blocks: np.ndarray, windows: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, place) pairs at which the sum of squared differences is zero modulo PRIME.

    ``blocks`` (n, B) and ``windows`` (n, places + B - 1) hold numbers below PRIME.
    """
    n, width = blocks.shape
    size = 1 << (windows.shape[1] - 1).bit_length()
    x, y = np.zeros((n, size), np.uint64), np.zeros((n, size), np.uint64)
    # a reversed block makes the convolution a correlation
    x[:, :width] = blocks[:, ::-1]
    y[:, : windows.shape[1]] = windows
    cross = restore(transform(x) * transform(y) % _P)[:, width - 1 : width - 1 + places]
    own = (blocks * blocks % _P).sum(axis=1) % _P
    sums = np.zeros((n, windows.shape[1] + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=sums[:, 1:])
    theirs = (sums[:, width : width + places] - sums[:, :places]) % _P
    return np.nonzero((own[:, None] + theirs) % _P == cross * np.uint64(2) % _P)


# --- runs of one sequence -------------------------------------------------------


def _seeds(numbers: np.ndarray, width: int, low: int, high: int, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block start, distance) with low <= distance <= high, for the given block numbers."""
    places = high - low + 1
    span = places + width - 1
    padded = np.concatenate((numbers, np.zeros(low + span, np.uint64)))
    step = max(1, GROUP // (1 << (span - 1).bit_length()))
    for at in range(0, len(blocks), step):
        starts = blocks[at : at + step].astype(np.int64) * width
        found, place = zero_mismatch(
            padded[starts[:, None] + np.arange(width)], padded[(starts + low)[:, None] + np.arange(span)], places
        )
        yield starts[found], place + low


def _possible(numbers: np.ndarray, order: np.ndarray, ranked: np.ndarray, counts: np.ndarray, width: int, low: int, high: int) -> np.ndarray:
    """Blocks whose rarest word occurs again ``low`` to ``high`` words on."""
    n = len(numbers) // width
    rarity = counts[: n * width].reshape(n, width)
    nth = rarity.argmin(axis=1)
    blocks = np.flatnonzero(rarity[np.arange(n), nth] > 1)
    at = blocks * width + nth[blocks]
    total = np.int64(len(numbers) + 1)
    word = numbers[at].astype(np.int64)
    following = np.searchsorted(ranked, word * total + at + low)
    here = following < len(ranked)
    blocks, at, word, following = blocks[here], at[here], word[here], following[here]
    position = order[following]
    return blocks[(numbers[position].astype(np.int64) == word) & (position <= at + high)]


def _reach(numbers: np.ndarray, start: int, distance: int) -> tuple[int, int]:
    """The stretch [a, b) around ``start`` whose words ``distance`` apart are identical."""
    a, step = start, 64
    while a:
        low = max(0, a - step)
        differ = np.flatnonzero(numbers[low:a] != numbers[low + distance : a + distance])
        if len(differ):
            a = low + int(differ[-1]) + 1
            break
        a, step = low, 4 * step
    b, step, last = start, 64, len(numbers) - distance
    while b < last:
        high = min(last, b + step)
        differ = np.flatnonzero(numbers[b:high] != numbers[b + distance : high + distance])
        if len(differ):
            b += int(differ[0])
            break
        b, step = high, 4 * step
    return a, b + distance


def runs(numbers: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period.

    ``numbers`` are positive and equal where words are equal. ``least`` must be
    at least 3 * FIRST and ``times`` at least 3, which the scales rely on.
    """
    n = len(numbers)
    if n < least:
        return []
    order = np.argsort(numbers, kind="stable")
    sizes = np.bincount(numbers.astype(np.int64))
    counts = sizes[numbers.astype(np.int64)]
    ranked = numbers[order].astype(np.int64) * np.int64(n + 1) + order
    known: dict[tuple[int, int], int] = {}
    width = FIRST
    while width == FIRST or width * times <= n:
        low, high = (1, 2 * FIRST - 1) if width == FIRST else (width, 2 * width - 1)
        blocks = _possible(numbers, order, ranked, counts, width, low, high)
        if len(blocks):
            # a block inside a run of a shorter period matches there at its multiples only
            starts, open_ = blocks * width, np.ones(len(blocks), bool)
            for (a, b), q in known.items():
                if q <= width:
                    open_ &= ~((starts >= a) & (starts + width + high <= b))
            blocks = blocks[open_]
        for starts, distances in _seeds(numbers, width, low, high, blocks):
            while len(starts):
                k = np.lexsort((starts, distances))[0]
                start, d = int(starts[k]), int(distances[k])
                a, b = _reach(numbers, start, d)
                # the stretch reached explains these seeds: its period's and, if it is a run, all multiples inside
                done = (distances == d) & (starts >= a) & (starts + width + d <= b)
                done[k] = True
                if b - a >= max(least, times * d):
                    known.setdefault((a, b), d)
                    done |= (distances % d == 0) & (starts >= a) & (starts + width + distances <= b)
                starts, distances = starts[~done], distances[~done]
        width *= 2
    return sorted((a, b - a, q) for (a, b), q in known.items())


# --- documents --------------------------------------------------------------------


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The words of the contract: in one document of ten a part is replaced by a repetition."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A positive number for every word, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.uint64, len(words))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without those that repeat a run's first period."""
    if found:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
    return b" ".join(words)


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


_FIELDS = [
    ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
]


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_runs, the strongest run, digests
    of all runs and of the collapsed text. ``plant`` inserts the contract's repetitions first."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # bytes.split cuts at \x20 and \x09-\x0D
                words = (text.as_py() or "").encode().split()
                if plant:
                    words = planted(doc_id, words)
                found = runs(word_numbers(words)) if len(words) >= LEAST else []
                best = strongest(found)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                rows.append((
                    len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, found)).hexdigest(),
                ))
            made = list(zip(*rows)) if rows else [()] * len(_FIELDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(v), t) for v, (_, t) in zip(made, _FIELDS))], ["doc_id", *(n for n, _ in _FIELDS)]
            )

    prepare_workers(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        search, f"doc_id {id_type}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document."""
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)
