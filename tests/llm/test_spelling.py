"""Spelling variants against a search of all pairs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from boreflow.llm import spelling
from boreflow.llm.common import store, table

from .helpers import empty, fixture

SF = "/root/testdata/sf0.01"


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(words):
    """(word, form, root, n, n_near, form_n) from all words that share what is left without one letter."""
    index, near = defaultdict(set), defaultdict(set)
    for w in words:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            index[x].add(w)
    for group in index.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                form[w] = best
    out = Counter()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[(w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None)] += 1
    return out


def rows(df):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("source", ["fixture", "documents"])
def test_variants(spark, source):
    docs = fixture(spark) if source == "fixture" else table(spark, SF, "documents")
    want = brute(counted([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert rows(spelling.variants(docs)) == want


@pytest.mark.parametrize("limit", [1, 30, 10**9])
def test_dense_words_and_every_limit(spark, limit):
    """Words of three letters, and long ones on both sides of SHORT: lists of all kinds, nothing lost."""
    rng = random.Random(limit)
    words = set()
    for letters, n in (("abé", 8), ("abc", 18), ("abc", 20), ("ab", 40)):
        for _ in range(60):
            w = "".join(rng.choice(letters) for _ in range(n + rng.randint(-1, 1)))
            words.add(w)
            for _ in range(3):
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice(letters), w[k] + rng.choice(letters)]) + w[k + 1 :]
                words.add(w)
    words = {w: rng.choice([2, 3, 20, 200, 2000]) for w in words if len(w) >= 7}
    made = store(spark.createDataFrame(list(words.items()), "word string, n long"), "words")
    pairs = Counter((r.word, r.n, r.near, r.near_n) for r in spelling.near_pairs(made, limit).collect())
    assert pairs == Counter((a, n, b, m) for a, n in words.items() for b, m in words.items() if one_edit(a, b))


def test_pivots_are_disjoint_and_cheapest():
    lists = spelling.Lists(Counter({"ab": 5, "bc": 1, "cd": 4, "de": 3, "ef": 9, "^a": 1, "$f": 1}))
    last, positions = lists.prefix("abcdef")
    assert positions == [1, 2, 3] and last == lists.rank["cd"]
    assert lists.pivots("abcdef", positions) == [1, 3]


def test_chain_ties_and_altered_runs(spark):
    assert spelling.altered(zlib.crc32(b"5:"), "wordwords", 1) == "wordwords"[: (h := zlib.crc32(b"5:wordwords") % 9)] + "wordwords"[h + 1 :]
    words = {"kettleson": 2, "kettlesoon": 20, "kettlesoons": 200, "kettlesom": 3, "bottling": 50, "battling": 50, "bettling": 5}
    made = store(spark.createDataFrame(list(words.items()), "word string, n long"), "words")
    near = {(r.word, r.near) for r in spelling.near_pairs(made).collect()}
    assert ("kettleson", "kettlesoon") in near and ("bettling", "battling") in near and ("bottling", "battling") in near
    text = [(None, " ".join([w] * n)) for w, n in words.items()]
    docs = spark.createDataFrame(text, "doc_id long, text string")
    got = rows(spelling.variants(docs))
    assert got == brute(counted(text))


def test_long_words_and_empty_table(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(60_000))
    words = [long, long[:30_000] + long[30_001:], long[:50] + "z" + long[51:], long + "q"]
    made = store(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), "words")
    near = {(r.word, r.near) for r in spelling.near_pairs(made).collect()}
    assert near == {(a, b) for a in words for b in words if one_edit(a, b)} and len(near) == 6
    assert spelling.variants(empty(spark)).collect() == []
