"""Spelling variant grouping (operator 11): pivotal bigrams, one edit.

Words are counted over all documents, and two are near if one letter inserted,
deleted or replaced turns one into the other. The search for near words:

* Bigrams are ordered by how rare they are in the vocabulary. A word's *prefix*
  is its ``PREFIX`` rarest bigrams with their positions; two disjoint ones of
  the prefix, with the least total frequency, are its *pivots*, chosen by
  dynamic programming.
* One edit touches at most one of two disjoint bigrams. Of two near words, let s
  be the one whose prefix ends at the rarer bigram: one of its pivots is in
  the other word, and there in the prefix. Which one also says where the edit
  is: if it touches the second pivot p2 or is behind it, the first one is
  preserved with all letters before it; else p2 is preserved with all letters
  behind it. So the pivots are indexed by (side, the letters up to or from
  the pivot, length of the other word), and every word looks up the letters up
  to and from each bigram of its prefix, under its own length. This is the
  position limit in its sharpest form.
* Letters shared by many words would make long lists. How many share them is
  estimated from the bigram table (bounded by the square of the alphabet, so
  it is broadcast); over ``LIST`` words the list is split by the letters on the
  other side, where the one edit must be: by what is left of them when one
  letter (in long words: one of ``SEGMENTS`` segments) is taken out. The
  estimate decides the cost only; no pair is lost for it.
* Pairs on a list are verified by their edit distance.

Lists are joined by key in plain shuffles. Words are counted in each task before
the shuffle, so a very frequent word is one row per task.

Defined cases
* NULL and empty texts have no words. A NULL id counts as an empty one in the
  checksum. Repeated rows count as often as they occur.
* Very long texts are read whole; very long words are handled in time and memory
  proportional to their length.
* Ties for the form go to the word that is smaller by code points. A word with
  no near word has none, and is its own root.
* An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare_workers, store, table

LETTERS = "A-Za-zÀ-ÿ"
LEAST, OCCURRENCES, DROP, FACTOR = 7, 2, 31, 10
#: One edit destroys at most two bigrams, so three hold two disjoint ones of which one survives.
GRAM, EDITS = 2, 1
PREFIX = GRAM * EDITS + 1
LIST = 30
SHORT, SEGMENTS = 16, 8
FLUSH_WORDS, FLUSH_BYTES = 100_000, 8 << 20


# --- vocabulary -----------------------------------------------------------------


def altered(seed: int, word: str, drop: int = DROP) -> str:
    """The run with one letter less if ``drop`` divides its checksum; ``seed`` is that of ``<doc_id>:``."""
    h = zlib.crc32(word.encode(), seed)
    if h % drop:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(docs: DataFrame, least: int = LEAST, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): words of at least ``least`` letters that occur ``occurrences`` times."""
    # shorter runs cannot give a word, and a greedy match of a longer one is the whole run
    pattern = f"[{LETTERS}]{{{least},}}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, total = re.compile(pattern), Counter()

        def made():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # bytes.lower changes A-Z only
                found = Counter(run.findall((text.as_py() or "").encode().lower().decode()))
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    word = altered(seed, word)
                    if len(word) >= least:
                        total[word] += n
                if len(total) > FLUSH_WORDS:
                    yield made()
                    total.clear()
        yield made()

    prepare_workers(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


# --- pivots and prefixes ----------------------------------------------------------


def _grams(word: str) -> list[str]:
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def gram_counts(words: DataFrame) -> Counter:
    """Bigrams, "^" + first and "$" + last letters with their numbers over the vocabulary.

    At most (letters + 2) * letters entries, whatever the size of the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                total.update(_grams(word))
                total.update(("^" + word[0], "$" + word[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["gram", "n"])

    counted = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return Counter({r["gram"]: r["n"] for r in counted.collect()})


class Lists:
    """The keys under which a word is indexed by its pivots, and under which it looks up others."""

    def __init__(self, counts: Counter, limit: int = LIST):
        grams = {g: n for g, n in counts.items() if g[0] not in "^$"}
        self.count = grams
        self.rank = {g: i for i, (g, _) in enumerate(sorted(grams.items(), key=lambda x: (x[1], x[0])))}
        after, before = Counter(), Counter()
        for g, n in grams.items():
            after[g[0]] += n
            before[g[1]] += n
        # thousandths of a natural logarithm, as integers: both sides of a pair must agree on an estimate
        self.start = {g[1]: round(1000 * math.log(n)) for g, n in counts.items() if g[0] == "^"}
        self.end = {g[1]: round(1000 * math.log(n)) for g, n in counts.items() if g[0] == "$"}
        self.forward = {g: round(1000 * math.log(n / after[g[0]])) for g, n in grams.items()}
        self.backward = {g: round(1000 * math.log(n / before[g[1]])) for g, n in grams.items()}
        self.limit = round(1000 * math.log(limit))

    def prefix(self, word: str, more: int = 0) -> tuple[int, list[int]]:
        """Rank of the last bigram of the prefix, and the positions in it, with up
        to ``more`` further occurrences of the last one."""
        ranks = [(self.rank[g], i) for i, g in enumerate(_grams(word))]
        first = heapq.nsmallest(PREFIX + more, ranks)
        last = first[PREFIX - 1][0]
        return last, sorted(i for r, i in first if r <= last)

    def pivots(self, word: str, positions: list[int]) -> list[int]:
        """EDITS + 1 disjoint positions with the least total frequency.

        ``best[k]`` is the cheapest choice of k disjoint bigrams among the positions so far.
        """
        best: list[list[tuple[int, list[int]] | None]] = []
        for i, p in enumerate(positions):
            fit = i
            while fit and positions[fit - 1] > p - GRAM:
                fit -= 1
            row = list(best[i - 1]) if i else [(0, [])] + [None] * (EDITS + 1)
            source = best[fit - 1] if fit else [(0, [])] + [None] * (EDITS + 1)
            cost = self.count[word[p : p + GRAM]]
            for k in range(1, EDITS + 2):
                found = source[k - 1]
                if found is not None and (row[k] is None or found[0] + cost < row[k][0]):
                    row[k] = (found[0] + cost, [*found[1], p])
            best.append(row)
        return best[-1][EDITS + 1][1]

    def sides(self, word: str) -> tuple[list[int], list[int]]:
        """Estimated numbers (logarithms) of words with the same letters up to and from each bigram."""
        grams = _grams(word)
        up, down = [self.start[word[0]]], [self.end[word[-1]]]
        for g in grams:
            up.append(up[-1] + self.forward[g])
        for g in reversed(grams):
            down.append(down[-1] + self.backward[g])
        return up[1:], down[:0:-1]

    def index_keys(self, word: str) -> tuple[int, list[bytes]]:
        last, positions = self.prefix(word)
        first, second = self.pivots(word, positions)
        up, down = self.sides(word)
        n, keys = len(word), []
        for head, long_list in ((_up(word, first), up[first] > self.limit), (_down(word, second), down[second] > self.limit)):
            side, part, rest = head
            if not long_list:
                keys += [_key(side, part, "n", n + d) for d in (-1, 0, 1)]
                continue
            m = len(rest)
            if m <= SHORT + 1:
                keys += [_key(side, part, "d", x) for x in _without_one(rest)]
            for other in (m - 1, m, m + 1):
                if other > SHORT:
                    keys += [
                        _key(side, part, f"s{other}.{j}", rest[:a] + rest[b + m - other :]) for j, (a, b) in enumerate(_segments(other))
                    ]
        return last, keys

    def lookup_keys(self, word: str) -> tuple[int, list[bytes]]:
        # an edit shifts a bigram among equal ones by the number it destroys or makes at most
        last, positions = self.prefix(word, GRAM * EDITS)
        up, down = self.sides(word)
        n, keys = len(word), []
        for p in positions:
            for (side, part, rest), long_list in ((_up(word, p), up[p] > self.limit), (_down(word, p), down[p] > self.limit)):
                m = len(rest)
                if not long_list:
                    keys.append(_key(side, part, "n", n))
                elif m <= SHORT:
                    keys += [_key(side, part, "d", x) for x in _without_one(rest)]
                else:
                    keys += [_key(side, part, f"s{m}.{j}", rest[:a] + rest[b:]) for j, (a, b) in enumerate(_segments(m))]
        return last, keys


def _up(word: str, p: int) -> tuple[str, str, str]:
    return "<", word[: p + GRAM], word[p + GRAM :]


def _down(word: str, p: int) -> tuple[str, str, str]:
    return ">", word[p:], word[:p]


def _key(side: str, part: str, kind: str, rest: str | int) -> bytes:
    return f"{side}{part}\0{kind}\0{rest}".encode()


def _without_one(rest: str) -> set[str]:
    """``rest`` and all that is left of it when one letter goes: two strings one edit apart share one of these."""
    return {rest, *(rest[:i] + rest[i + 1 :] for i in range(len(rest)))}


def _segments(m: int) -> list[tuple[int, int]]:
    return [(m * j // SEGMENTS, m * (j + 1) // SEGMENTS) for j in range(SEGMENTS)]


def keyed(words: DataFrame, lists: Lists, index: bool) -> DataFrame:
    """(key, word, n, last): the lists a word is on (``index``) or those it looks up."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        def made(rows):
            at, key, last = zip(*rows)
            at = pa.array(at, pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([k - (1 << 63) for k in key], pa.int64()), batch.column(0).take(at), batch.column(1).take(at), pa.array(last, pa.int32())],
                ["key", "word", "n", "last"],
            )

        for batch in batches:
            rows, held = [], 0
            for i, word in enumerate(batch.column(0).to_pylist()):
                last, keys = lists.index_keys(word) if index else lists.lookup_keys(word)
                rows += [(i, k, last) for k in {xxh64_intdigest(k) for k in keys}]
                held += len(keys) * (len(word) + 24)
                if held > FLUSH_BYTES:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    return words.select("word", "n").mapInArrow(make, "key long, word string, n long, last int")


def near_pairs(words: DataFrame, limit: int = LIST) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words one edit apart, once.

    ``words`` (word, n; stored, as it is read three times) has one row per word,
    of at least 2 * GRAM * EDITS + GRAM letters.
    """
    lists = Lists(gram_counts(words), limit)
    index = keyed(words, lists, True).toDF("key", "a", "an", "alast")
    look = keyed(words, lists, False).toDF("_key", "b", "bn", "blast")
    on = (F.col("key") == F.col("_key")) & (F.col("alast") <= F.col("blast")) & (F.levenshtein("a", "b", 1) == 1)
    found = store(index.join(look, on).select("a", "an", "b", "bn"), "near")
    both = found.union(found.select("b", "bn", "a", "an")).toDF("word", "n", "near", "near_n")
    return both.distinct()


# --- groups -----------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row (word, form): the last word that forms lead to.

    Pointers are doubled, so the rounds are the logarithm of the longest chain;
    a form occurs ``FACTOR`` times as often as its word, so chains are short.
    """
    links = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.toDF("_word", "_root")
        moved = links.join(ahead, F.col("root") == F.col("_word"), "left")
        links = store(moved.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(docs: DataFrame, least: int = LEAST, occurrences: int = OCCURRENCES, factor: int = FACTOR, limit: int = LIST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = store(vocabulary(docs, least, occurrences), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_pairs(words, limit).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("best.less") >= factor * F.col("n")
    near = store(
        near.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "forms"
    )
    last = roots(near.filter(F.col("form").isNotNull())).toDF("_root_of", "_root")
    found = near.join(last, F.col("word") == F.col("_root_of"), "left").select(F.col("word").alias("_word"), "form", "form_n", "n_near", "_root")
    joined = words.join(found, F.col("word") == F.col("_word"), "left")
    return joined.select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of ``documents`` with its near words' number, form and root."""
    return variants(table(spark, sf_dir, "documents"))
