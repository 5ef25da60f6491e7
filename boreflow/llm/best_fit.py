"""Packing (operator 13): best-fit decreasing over a segment tree of open windows.

A document's ids and its end id are cut into full windows of ``capacity``
tokens as long as it is longer than one; what remains is one piece. Pieces are
placed from the longest down, each into the open window with the least
remaining room that still holds it. A segment tree over the capacities 1 ..
``capacity`` holds the open windows by their remaining room, so the tightest
is found in its depth. Pieces of one length are alike, and so are windows with
the same room: placements are made for whole groups of windows at once, exactly
as one by one, from the histogram of lengths (``capacity`` counters whatever
the size of the corpus).

The plan is a list of places for ranks of lengths, bounded by ``capacity`` and
so broadcast; the rank of a piece in its length is made without sorting a length
in one task.

Defined cases
* A NULL or empty text is one piece that holds the end id only.
* Very long texts are tokenised whole and cut; no piece is over ``capacity``.
* Repeated rows, ties and equal or NULL ids: every row gets places of its own;
  a row is told from its copies by its number in the task that tokenised it.
* An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_count, key_bucket, prepare_workers, rank_in_buckets, shuffle_key, store, table
from .packing import encode, encoders

CAPACITY = 2048
END_ID = 1
FLUSH = 8 << 20


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length): full windows, then what remains."""
    return [(s, min(capacity, n - s)) for s in range(0, n, capacity)]


def tokenized(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, json_path: str | None = None, ranks_path: str | None = None
) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens and nth
    (number of the document in its task) of every piece."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, plain = encoders(json_path, ranks_path)
        nth = 0
        for batch in batches:

            def made(rows):
                at, start, length, ids, tokens, number = zip(*rows)
                cols = [batch.column(0).take(pa.array(at)), *(pa.array(v, pa.int64()) for v in (start, length)), pa.array(ids, pa.binary()), *(pa.array(v, pa.int64()) for v in (tokens, number))]
                return pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "length", "ids", "doc_tokens", "nth"])

            rows, held = [], 0
            for i, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or "", whole, plain), np.array([end_id], dtype="<u4")).astype("<u4")
                rows += [(i, s, n, ids[s : s + n].tobytes(), len(ids), nth) for s, n in cuts(len(ids), capacity)]
                nth, held = nth + 1, held + 4 * len(ids)
                if held > FLUSH:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    prepare_workers(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tokenize, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, nth long")


# --- plan ---------------------------------------------------------------------


class Windows:
    """Groups of open windows, found by remaining room through a segment tree.

    A group is (first sequence, number of windows); all windows of a group have
    the same room; of equal rooms the first opened comes first. The tree's node k covers its children 2k and 2k + 1 and
    says whether any window below it is open.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)
        self.groups: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _mark(self, room: int) -> None:
        k = self.size + room
        self.open[k] = bool(self.groups[room])
        while k > 1:
            k //= 2
            self.open[k] = self.open[2 * k] or self.open[2 * k + 1]

    def add(self, room: int, first: int, n: int) -> None:
        if room and n:
            heapq.heappush(self.groups[room], (first, n))
            self._mark(room)

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` with an open window."""
        k = self.size + length
        while not self.open[k]:
            # up until a sibling to the right is open
            while k & 1 or not self.open[k + 1]:
                k //= 2
                if k <= 1:
                    return None
            k += 1
            while k < self.size:
                k = 2 * k if self.open[2 * k] else 2 * k + 1
        return k - self.size

    def take(self, room: int) -> tuple[int, int]:
        group = heapq.heappop(self.groups[room])
        self._mark(room)
        return group


Place = tuple[int, int, int, int, int, int]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Place]:
    """Places for ``counts`` pieces of every length.

    A place is (length, from_rank, to_rank, copies, sequence, offset): the pieces
    of ``length`` with these ranks go, ``copies`` at a time, into consecutive
    sequences, one behind the other from ``offset``.
    """
    windows, places, sequences = Windows(capacity), [], 0
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = windows.tightest(length)
            if room is None:
                room = capacity
                copies = room // length
                first, n = sequences, -(-left // copies)
                sequences += n
            else:
                copies = room // length
                first, n = windows.take(room)
            # one by one, a window takes pieces of this length until it has no room for another
            full = min(n, left // copies)
            if full:
                places.append((length, rank, rank + full * copies, copies, first, capacity - room))
                windows.add(room - copies * length, first, full)
                rank, left = rank + full * copies, left - full * copies
            if full < n and left:
                rest = min(left, copies)
                places.append((length, rank, rank + rest, rest, first + full, capacity - room))
                windows.add(room - rest * length, first + full, 1)
                rank, left, full = rank + rest, left - rest, full + 1
            if full < n:
                windows.add(room, first + full, n - full)
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY, seed: int = 13) -> DataFrame:
    """``pieces`` (doc_id, start, length, nth, ...; stored, as they are read three
    times) with sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = pieces.sparkSession.createDataFrame(
        plan(histogram, capacity), "_length long, _from long, _to long, _copies long, _sequence long, _offset long"
    )
    buckets = bucket_count(sum(histogram.values()))
    rows = pieces.withColumn("_key", shuffle_key(seed, "doc_id", "start", "nth"))
    rows = rows.withColumn("_bucket", key_bucket(F.col("_key"), buckets))
    ranked = rank_in_buckets(rows, ["length"], "_bucket", ["_key"], "_rank", "_total")
    # bounded: a length opens or splits at most two groups of windows, and a group is
    # taken at most log2(capacity) times before it has no room
    joined = ranked.join(
        F.broadcast(places),
        (F.col("length") == F.col("_length")) & (F.col("_rank") > F.col("_from")) & (F.col("_rank") <= F.col("_to")),
    )
    turn = F.col("_rank") - 1 - F.col("_from")
    return joined.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(turn / F.col("_copies"))).alias("sequence_id"),
        (F.col("_offset") + (turn % F.col("_copies")) * F.col("length")).alias("offset"),
    )


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    made = tokenized(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "nth")
    return pack(store(made, "windows")).drop("nth")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packed(table(spark, sf_dir, "documents"))
