"""Best-fit packing (operator 7): exact-complement hashing over the length histogram.

Documents are tokenised, ended with one id and cut into pieces of at most
``capacity`` tokens. How pieces are packed depends on their lengths only, so
the plan is made from the histogram of lengths (``capacity`` counters whatever
the size of the corpus): for every length, from the largest down, single, pair
and triple sums of other lengths that fill its gap exactly are consumed as
often as the counts allow; what remains is packed best-fit. The plan is a list
of patterns (which lengths, how many sequences). Each piece finds its place
from its rank among the pieces of its length; the ranks are made without
sorting a length in one task, and the plan, whose size ``capacity`` bounds,
is broadcast.

Token ids are those of the ``tokenizers`` file. Texts made only of characters
of ``PLAIN`` are encoded by ``tiktoken`` with the same vocabulary, which gives
the same ids in a quarter of the time; all others by ``tokenizers`` itself.

Defined cases
* A NULL or empty text is one piece that holds the end id only.
* Documents over the capacity are cut so that all pieces but the first are full.
* Repeated rows and equal ids: each row gets its own places. NULL ids stay.
* An empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_count, key_bucket, rank_in_buckets, shuffle_key, store, table

CAPACITY = 1024
END_ID = 2
#: Characters on which both encoders are tested to agree; others go to ``tokenizers``.
NOT_PLAIN = re.compile("[^\n\x20-\x7e¡-¬®-ſ]|<\\|endoftext\\|>")
FLUSH = 8 << 20


@lru_cache(maxsize=2)
def encoders(json_path: str | None, ranks_path: str | None):
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return whole, plain


def encode(text: str, whole, plain) -> np.ndarray:
    if NOT_PLAIN.search(text):
        return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
    return np.asarray(plain.encode_to_numpy(text, disallowed_special=()), dtype="<u4")


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of n ids."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenized_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, json_path: str | None = None, ranks_path: str | None = None
) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, plain = encoders(json_path, ranks_path)
        for batch in batches:
            names = ["doc_id", "piece", "start", "length", "ids"]

            def made(rows):
                at, piece, start, length, ids = zip(*rows)
                cols = [batch.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
                return pa.RecordBatch.from_arrays(cols, names)

            rows, held = [], 0
            for i, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or "", whole, plain), np.array([end_id], dtype="<u4")).astype("<u4")
                for p, (s, n) in enumerate(cuts(len(ids), capacity)):
                    rows.append((i, p, s, n, ids[s : s + n].tobytes()))
                held += 4 * len(ids)
                if held > FLUSH:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tokenize, f"doc_id {id_type}, piece int, start long, length long, ids binary")


# --- plan ---------------------------------------------------------------------


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths, number of sequences) that use every count exactly."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[list[int], int]] = []

    def take(lengths: list[int]) -> int:
        times = min(left[x] // k for x, k in Counter(lengths).items())
        if times:
            for x in lengths:
                left[x] -= times
            out.append((lengths, int(times)))
        return times

    def complements(gap: int, parts: int, most: int) -> Iterator[list[int]]:
        """Available lengths, largest first, at most ``parts``, that sum to ``gap``."""
        if parts == 1:
            if gap <= most and left[gap]:
                yield [gap]
            return
        for a in range(min(gap - 1, most), -(-gap // parts) - 1, -1):
            if not left[a]:
                continue
            if parts == 2:
                if left[gap - a]:
                    yield [a, gap - a]
                continue
            rest = gap - a
            b = np.arange(min(a, rest - 1), -(-rest // 2) - 1, -1)
            for x in b[(left[b] > 0) & (left[rest - b] > 0)].tolist():
                yield [a, x, rest - x]
                if not left[a]:
                    break

    for length in range(capacity, 0, -1):
        if length == capacity:
            take([length])
            continue
        for parts in (1, 2, 3):
            if left[length] and capacity - length >= parts:
                for rest in complements(capacity - length, parts, capacity - length):
                    take([length, *rest])
                    if not left[length]:
                        break
    # the rest: best fit, the largest length that still fits, until none does
    for length in range(capacity, 0, -1):
        while left[length]:
            lengths, gap, used = [length], capacity - length, Counter([length])
            while gap:
                fits = np.flatnonzero(left[1 : gap + 1])[::-1] + 1
                best = next((int(x) for x in fits if left[x] > used[int(x)]), None)
                if best is None:
                    break
                lengths.append(best)
                used[best] += 1
                gap -= best
            take(lengths)
    return out


def plan_rows(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from_rank, to_rank, copies, first_sequence, offset): which ranks of
    a length go where; a sequence takes ``copies`` consecutive ranks of it."""
    rows, next_rank, sequence = [], Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for x, k in sorted(Counter(lengths).items(), reverse=True):
            rows.append((x, next_rank[x], next_rank[x] + times * k, k, sequence, offset))
            next_rank[x] += times * k
            offset += x * k
        sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, seed: int = 5) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...; stored, as they are read three times)
    with sequence_id and offset."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(
        plan_rows(plan(histogram, capacity)),
        "_length long, _from long, _to long, _copies long, _sequence long, _offset long",
    )
    buckets = bucket_count(sum(histogram.values()))
    rows = pieces.withColumn("_key", shuffle_key(seed, "doc_id", "piece"))
    rows = rows.withColumn("_bucket", key_bucket(F.col("_key"), buckets))
    ranked = rank_in_buckets(rows, ["length"], "_bucket", ["_key"], "_rank", "_total")
    # bounded: a plan has at most a few patterns for each of ``capacity`` lengths
    joined = ranked.join(
        F.broadcast(places),
        (F.col("length") == F.col("_length")) & (F.col("_rank") > F.col("_from")) & (F.col("_rank") <= F.col("_to")),
    )
    nth = F.col("_rank") - 1 - F.col("_from")
    return joined.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(nth / F.col("_copies"))).alias("sequence_id"),
        (F.col("_offset") + (nth % F.col("_copies")) * F.col("length")).alias("offset"),
    )


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id and its ids, end to end. ``pieces`` hold
    the ids, ``placed`` the places; (doc_id, piece) must be unique."""
    where = placed.select(F.col("doc_id").alias("_doc"), F.col("piece").alias("_piece"), "sequence_id", "offset")
    joined = pieces.join(where, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("piece") == F.col("_piece")))
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["ids"])).alias("ids")
    )


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all documents."""
    made = tokenized_pieces(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(store(made, "pieces"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packed(table(spark, sf_dir, "documents"))
