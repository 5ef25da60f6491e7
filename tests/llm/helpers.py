"""Fixtures by hand and brute-force versions of the operators."""

import re
from collections import Counter, defaultdict

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, kept boolean, row string, _id long, _key string, size int"

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
PASSAGE = "one line of it\nthen a second line\nand the third line\nand a fourth"
BASE = [f"token{i}" for i in range(200)]


def edited(k: int) -> str:
    words = list(BASE)
    for j in range(2):
        words[(37 * k + 91 * j) % 200] = f"edit{k}_{j}"
    return " ".join(words)


TEXTS = [
    (1, "Hello  World\tagain and again and so on", "en", "a"),
    (2, "Hello World again and again and so on", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, "   \t\n ", "en", None),
    (None, "an id is missing here, twice over", "en", "a"),
    (None, "an id is missing here, twice over", "en", "a"),
    (7, "short one", "de", "b"),
    (8, "short one", "de", "b"),
    (9, "repeated row of some words in it", "de", "b"),
    (9, "repeated row of some words in it", "de", "b"),
    (10, LONG, "en", "a"),
    (11, LONG + " tail", "en", "c"),
    (12, "head\n" + PASSAGE + "\ntail", "en", "a"),
    (13, PASSAGE, "en", "c"),
    (14, "x\nx\nx\nx\nx\nx", "en", "c"),
    (15, "Grüße, señor — 你好 🎉 naïve <|endoftext|> café\x0b\x1c  done", "de", "c"),
    (16, "write to a.b+c@ex-ample.co.uk or +1 (555) 123-4567, 10.0.0.255, 4111 1111-1111 1111.", "en", "c"),
    *[(100 + k, edited(k), "en", "a") for k in range(30)],
    (200, " ".join(BASE), "en", "a"),
]


def fixture(spark):
    rows = [(i, t, lang, s, None if t is None else len(t), "x", True, "r", 5, "k", 3) for i, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def near_groups(rows):
    """Per row: (doc_id, set size, smallest reachable id), by all links through an inverted index."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first, index = {}, defaultdict(list)
    for j, s in enumerate(sets):
        if not s:
            continue
        if s in first:
            parent[find(j)] = find(first[s])
            continue
        first[s] = j
        shared = Counter()
        for sh in s:
            shared.update(index[sh])
            index[sh].append(j)
        for o, c in shared.items():
            if 100 * c >= 75 * (len(s) + len(sets[o]) - c):
                parent[find(j)] = find(o)
    least = defaultdict(list)
    for j, (i, _) in enumerate(rows):
        if i is not None:
            least[find(j)].append(i)
    return Counter((i, len(sets[j]), min(least[find(j)], default=None) if sets[j] else i) for j, (i, _) in enumerate(rows))
