"""Toxicity (operator 1): weak supervision.

Voters are small lexicons (fixed ones, and word beginnings mined from labelled
training rows) and patterns. A generative label model with one latent class
explains their votes on a sample: each voter depends on the class and on one
other voter (a Chow-Liu tree over the voters, so strongly correlated lexicons
are not counted twice); accuracies and correlations are fitted by expectation
maximisation, in which labelled training rows keep their label. A linear
classifier is then trained on the posterior labels and scores every document.

What is learnt comes from samples of bounded size, taken by a hash of the id:
``LABELLED`` labelled rows of the training folds and ``UNLABELLED`` documents
without use of their labels. Counts are made in tasks; the driver gets at most
``TERMS`` terms and the votes of the samples. Scoring reads every whole text.

Labels, lang, source and doc_id are no inputs of a score.

Defined cases
* A NULL text counts as empty; empty texts get the score of a text without cue.
* NULL ids are never labelled and are not held out. Ids with contradicting
  labels, and labels that are not 0 or 1, are not learnt from.
* Without labels only the fixed lexicons and patterns vote. Repeated rows get
  equal scores; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_bucket, shuffle_key, store, table, temporary
from .near_dedup import near_groups

LABELLED, UNLABELLED, TERMS = 16_000, 16_000, 200
THRESHOLD = 0.3
VOTERS, GROUPS = 40, 6
PRIOR = 0.05
#: How much rarer than one lucky term among all that are tried luck must be, in nats.
MARGIN = 3.0
PREFIXES = (4, 5, 6)
WORDS = re.compile(r"[^\W\d_]+")

# Everyday insults by language, and patterns of heated text.
LEXICONS = {
    "en": "idiot idiots moron morons stupid scum trash loser losers worthless pathetic disgusting clown dumb imbecile".split(),
    "de": "idiot trottel dumm dummkopf abschaum versager widerlich erbärmlich wertlos arschloch".split(),
    "fr": "idiot imbécile stupide crétin débile ordure minable pathétique dégoûtant connard".split(),
    "es": "idiota imbécil estúpido basura escoria perdedor inútil patético asqueroso payaso".split(),
}
PATTERNS = {
    "you": re.compile(r"\byou(?:'re| are) (?:an? |such |so |all )*\w+", re.I),
    "exclaim": re.compile(r"!!|\?!|!\?"),
    "starred": re.compile(r"\b\w+\*+\w+\b"),
}


@dataclass
class Model:
    """Lexicon terms (``=word`` or a beginning), weights and the label model's findings."""

    terms: list[str]
    weights: np.ndarray
    bias: float
    accuracies: dict[str, float] = field(default_factory=dict)
    correlated: list[tuple[str, str]] = field(default_factory=list)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# --- what a text shows ------------------------------------------------------------


def terms_of(words: set[str]) -> set[str]:
    out = {"=" + w for w in words if len(w) > 2}
    for k in PREFIXES:
        out |= {w[:k] for w in words if len(w) >= k}
    return out


class Reader:
    """Term hits and the dense features of a text."""

    DENSE = ["seeds", "hits", "share", *PATTERNS]

    def __init__(self, terms: list[str]):
        self.index = {t: i for i, t in enumerate(terms)}
        self.whole = {t[1:]: i for t, i in self.index.items() if t[0] == "="}
        self.starts = {k: {t: i for t, i in self.index.items() if t[0] != "=" and len(t) == k} for k in PREFIXES}
        self.seeds = [(name, frozenset(words)) for name, words in LEXICONS.items()]

    def __call__(self, text: str | None) -> tuple[list[int], list[float], list[int]]:
        """(term indices, dense features, fired fixed voters)."""
        text = text or ""
        found = WORDS.findall(text.lower())
        words = set(found)
        hits = [self.whole[w] for w in words & self.whole.keys()]
        for k, known in self.starts.items():
            if known:
                hits += [known[p] for p in {w[:k] for w in words if len(w) >= k} & known.keys()]
        seeds = [bool(words & lexicon) for _, lexicon in self.seeds]
        patterns = [bool(p.search(text)) for p in PATTERNS.values()]
        dense = [float(sum(seeds)), math.log1p(len(hits)), min(1.0, 20 * len(hits) / (len(found) + 20)), *map(float, patterns)]
        return hits, dense, [i for i, on in enumerate(seeds + patterns) if on]


# --- mining and samples -------------------------------------------------------------


def _by_hash(df: DataFrame, bound: int, seed: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of doc_id."""
    n = df.count()
    if n <= bound:
        return df
    fine = 1 << 20
    return df.filter(key_bucket(shuffle_key(seed, "doc_id"), fine) < F.lit(int(fine * bound / n)))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(text, toxic) of the labelled sample, of equal and nearly equal texts one per
    label: copies of one toxic text would make every word in it look like a cue."""
    known = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).filter("toxic = _most")
    known = _by_hash(known.select(F.col("doc_id"), "toxic"), bound, 7).withColumnRenamed("doc_id", "_id")
    # the sample's size is bounded, so its ids and labels are
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    rows = rows.select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    rows = store(rows.select(F.sha2("text", 256).alias("doc_id"), "text", "toxic"), "sample")
    # texts that share a passage stay; of near copies one of each label stays, the one of the least digest
    texts = store(rows.groupBy("doc_id").agg(F.min("text").alias("text")), "texts")
    groups = near_groups(texts).select(F.col("doc_id").alias("_id"), "component_id")
    sides = rows.select("doc_id", "toxic").distinct().join(groups, F.col("doc_id") == F.col("_id"))
    first = sides.groupBy("component_id", F.col("toxic").cast("int").alias("toxic")).agg(F.min("doc_id").alias("_id")).select("_id", "toxic")
    return texts.join(first, F.col("doc_id") == F.col("_id")).select("text", "toxic")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(counts):
        terms = sorted(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (counts[1], counts[0]))], ["term", "toxic", "clean"]
        )

    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part, counts = batch.slice(at, 2000), (Counter(), Counter())
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counts[toxic].update(terms_of(set(WORDS.findall(text.lower()))))
            yield made(counts)


def surprise(hits: int, misses: int, rate: float) -> float:
    """Log-odds bound of seeing so many toxic rows by chance (Chernoff)."""
    n = hits + misses
    p = hits / n
    return n * (p * math.log(p / rate) + ((1 - p) * math.log((1 - p) / (1 - rate)) if misses else 0.0))


def precision_bound(hits: int, misses: int, z: float = 1.64) -> float:
    """Wilson's lower bound of a voter's precision."""
    n = hits + misses
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def mine(training: DataFrame, most: int) -> list[str]:
    """The terms whose presence points to toxic text, best first."""
    rate = training.agg(F.avg("toxic")).first()[0]
    if not rate:
        return []
    counts = training.select("text", "toxic").mapInArrow(_count_terms, "term string, toxic long, clean long")
    counts = store(counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "terms")
    # as many terms are tried, so chance must be that much less likely
    luck = math.log(2 * max(1, counts.filter("toxic + clean >= 3").count()))
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    rows = counts.filter((F.col("toxic") >= 3) & (share >= max(0.3, min(0.9, 3 * rate)))).orderBy(F.desc(F.col("toxic") * share), "term").limit(10 * most).collect()
    rows = [r for r in rows if surprise(r["toxic"], r["clean"], rate) > luck + MARGIN]
    scored = sorted(((precision_bound(r["toxic"], r["clean"]), r["toxic"], r["term"]) for r in rows), key=lambda x: (-round(x[0], 2), -x[1], len(x[2]), x[2]))
    chosen: dict[str, None] = {}
    for bound, _, term in scored:
        core = term.lstrip("=")
        # a longer term adds nothing to a beginning of it that is as precise
        if bound >= min(0.9, 2 * rate) and not any(core[:k] in chosen for k in PREFIXES if k <= len(core)):
            chosen[term] = None
        if len(chosen) == most:
            break
    return list(chosen)


def read_sample(rows: DataFrame, terms: list[str]) -> list[tuple[list[int], list[float], list[int], int | None]]:
    """Hits, dense features, fixed votes and label of the rows of a bounded sample."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms)
        for batch in batches:
            hits, dense, fired = zip(*map(reader, batch.column(0).to_pylist())) if batch.num_rows else ((), (), ())
            cols = [pa.array(hits, pa.list_(pa.int32())), pa.array(dense, pa.list_(pa.float64())), pa.array(fired, pa.list_(pa.int32())), batch.column(1)]
            yield pa.RecordBatch.from_arrays(cols, ["hits", "dense", "fired", "toxic"])

    kind = "hits array<int>, dense array<double>, fired array<int>, toxic int"
    got = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(read, kind).toArrow().to_pylist()
    return sorted(((r["hits"], r["dense"], r["fired"], r["toxic"]) for r in got), key=repr)


# --- the label model ------------------------------------------------------------------


def votes(sample, n_terms: int) -> tuple[np.ndarray, list[str]]:
    """Voter matrix: the best terms alone, the rest in groups, lexicons, patterns, no cue."""
    fixed = [f"lexicon {x}" for x in LEXICONS] + [f"pattern {x}" for x in PATTERNS]
    single = min(VOTERS, n_terms)
    names = [f"term {i}" for i in range(single)] + [f"terms {g}" for g in range(GROUPS)] + fixed + ["no cue"]
    v = np.zeros((len(sample), len(names)), bool)
    for row, (hits, _, fired, _) in enumerate(sample):
        for h in hits:
            v[row, h if h < single else single + (h - single) * GROUPS // max(1, n_terms - single)] = True
        v[row, [single + GROUPS + i for i in fired]] = True
        v[row, -1] = not hits and not any(i < len(LEXICONS) for i in fired)
    return v, names


def chow_liu(v: np.ndarray, q: np.ndarray, trust: np.ndarray) -> list[int]:
    """Parent of each voter (-1: none): the spanning tree of largest mutual
    information given the class."""
    m, info = v.shape[1], 0
    for weight in (q * trust, (1 - q) * trust):
        total = weight.sum() + 1
        x = v.astype(float)
        both = (x * weight[:, None]).T @ x / total
        p = np.diag(both)
        part = np.zeros((m, m))
        for a, b, joint in ((p[:, None], p[None, :], both), (p[:, None], 1 - p[None, :], p[:, None] - both), (1 - p[:, None], p[None, :], p[None, :] - both), (1 - p[:, None], 1 - p[None, :], 1 - p[:, None] - p[None, :] + both)):
            joint = np.clip(joint, 1e-12, None)
            part += joint * np.log(joint / np.clip(a * b, 1e-12, None))
        info = info + part * total
    parent, best, link = [-1] * m, np.full(m, -np.inf), np.full(m, -1)
    left, at = set(range(1, m)), 0
    while left:
        for j in left:
            if info[at, j] > best[j]:
                best[j], link[j] = info[at, j], at
        at = max(left, key=lambda j: (best[j], -j))
        left.remove(at)
        # a chance correlation is worth less than the parameters it costs
        parent[at] = int(link[at]) if best[at] > math.log(trust.sum() + 1) else -1
    return parent


def label_model(v: np.ndarray, known: np.ndarray, prior: float, turns: int = 12) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(posterior of class 1, P(class 1 | voter fires), parents). ``known``: 0, 1 or -1."""
    cue = ~v[:, -1]
    q = np.where(known >= 0, known, np.where(cue, 0.5, prior / 2)).astype(float)
    parent, told = [-1] * v.shape[1], known >= 0
    enough = min((known == 0).sum(), (known == 1).sum()) >= 20
    for turn in range(turns):
        # the first turn learns from labelled rows alone, where there are enough
        trust = told.astype(float) if enough and turn == 0 else np.ones(len(v))
        if turn == (0 if enough else 2):
            parent = chow_liu(v, q, trust)
        log = np.stack([np.full(len(v), math.log(1 - prior)), np.full(len(v), math.log(prior))], axis=1)
        for j, up in enumerate(parent):
            state = v[:, up].astype(int) if up >= 0 else np.zeros(len(v), int)
            for y, weight in enumerate(((1 - q) * trust, q * trust)):
                base = (weight @ v[:, j] + 0.5) / (weight.sum() + 1)
                for s in (0, 1):
                    here = state == s
                    if here.any():
                        p = (weight[here] @ v[here, j] + base) / (weight[here].sum() + 1)
                        log[here, y] += np.log(np.where(v[here, j], p, 1 - p))
        q = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -60, 60)))
        q = np.where(known >= 0, known, q)
        prior = float(np.clip(q.mean(), 1e-3, 0.5))
    fires = v.sum(axis=0)
    return q, (q @ v + prior) / (fires + 1), parent


def train(x: np.ndarray, q: np.ndarray, ridge: float = 1.0, turns: int = 20) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - q) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED, most_terms: int = TERMS) -> Model:
    with temporary(docs.sparkSession):  # all that is read later is on the driver
        training = store(training_rows(docs, labels, labelled), "training")
        terms = mine(training, most_terms)
        other = _by_hash(docs.select("doc_id", "text"), unlabelled, 13).select("text", F.lit(None).cast("int").alias("toxic"))
        sample = read_sample(training.select("text", "toxic"), terms) + read_sample(other, terms)
    n_dense = len(Reader.DENSE)
    if not sample:
        return Model(terms, np.zeros(len(terms) + n_dense), math.log(PRIOR / (1 - PRIOR)))
    known = np.array([-1 if r[3] is None else r[3] for r in sample])
    prior = float(np.clip(known[known >= 0].mean(), 0.005, 0.5)) if (known >= 0).any() else PRIOR
    v, names = votes(sample, len(terms))
    q, accuracy, parent = label_model(v, known, prior)
    x = np.zeros((len(sample), len(terms) + n_dense), np.float32)
    for row, (hits, dense, _, _) in enumerate(sample):
        x[row, hits] = 1
        x[row, len(terms) :] = dense
    weights, bias = train(x, q)
    return Model(terms, weights, bias, dict(zip(names, accuracy.round(4).tolist())), [(names[j], names[u]) for j, u in enumerate(parent) if u >= 0])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every document."""
    weights, dense_weights, bias = model.weights[: len(model.terms)].tolist(), model.weights[len(model.terms) :].tolist(), model.bias
    terms = model.terms

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms)
        for batch in batches:
            out = []
            for text in batch.column(1):
                hits, dense, _ = reader(text.as_py())
                total = bias + sum(weights[h] for h in sorted(hits)) + sum(w * x for w, x in zip(dense_weights, dense))
                out.append(1 / (1 + math.exp(-max(-60.0, min(60.0, total)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rated = docs.select("doc_id", "text").mapInArrow(rate, f"doc_id {id_type}, score double")
    return rated.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = fit(docs, labels)
    weights, terms = model.weights, model.terms
    cut = math.log(THRESHOLD / (1 - THRESHOLD))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms)
        for batch in batches:
            mask = []
            for text in batch.column("text"):
                hits, dense, _ = reader(text.as_py())
                mask.append(model.bias + weights[hits].sum() + weights[len(terms) :] @ np.array(dense) < cut)
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fold, score and prediction."""
    docs = table(spark, sf_dir, "documents")
    rated = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return rated.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
