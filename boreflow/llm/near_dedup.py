"""MinHash near-dedup (operator 2): LSH forest.

Documents are sets of five-word shingles. Equal sets form one class, so copies
cost one row. A class has ``TREES`` signature orders of ``DEPTH`` minimum
hashes each; in every order, classes that share a prefix are neighbours, and
the depth adapts to the region: a prefix shared by at most ``REGION`` classes
is settled at once, a more common one is followed deeper, through the hashes of
the next order too, until its regions are that small. Prefix counts are hash
aggregates, so no task holds a region.

A crowded region is not cut off: on every depth at which it is too large, each
of its members is also a candidate of the region's centre, the member whose
own prefixes are the most common (in a group of edited copies: the text they
come from), on the last such depth also of a member picked by hash, and regions
that are crowded at full depth are dealt by hash into small groups, differently
in every order.

Members of crowded regions have a second path, which does not go by hash: of each
set the rarest shingles are taken (by how many sets of crowded regions hold them,
counted exactly), as many as it can miss of one at the threshold and one more (a
prefix filter). Sets that share one held by at most ``RARE`` of them are candidates of
each other at once; the others serve the completion below.

Candidates are checked on the full sets, recomputed from the whole texts, in
two rounds: first each class with its most similar candidate; then, after
merging what those links connect, every other candidate whose ends are still
apart. Candidates whose signatures agree in under ``AGREE`` of the places are
left out: a pair at the threshold falls below that with a probability of about
1e-7. Components come from contraction (``components``).

What these rounds leave apart in crowded regions is completed exactly (``apart_pairs``),
with no bound on regions or groups: two sets at the threshold share one of the taken
shingles of each. At the first one they share, no more than what follows it in the
order can be common to both, so sets that differ in enough rarer shingles are no pair
however many hold the shingle; shingles whose holders are connected already are left
out, and of the other holders' pairs those inside one component. All pairs that are
left are checked on the full sets. Classes that share no crowded region meet in every
region they share; a pair at the threshold shares none with a probability of about 2e-6.

Links are confirmed exactly: a document is never linked below the threshold.

Defined cases
* NULL and empty texts, and texts without words: no shingles, own component,
  linked with nothing. Texts under five words: the whole sequence is one shingle.
* NULL ids: they count as largest; a component with only NULL ids has NULL.
  ``kept`` compares ids null-safely, so repeated rows of the kept id are all kept.
* Repeated rows are equal sets, so one class. An empty table gives no rows;
  further columns are ignored (``drop_near_copies`` carries them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import few, prepare_workers, store, table, temporary, wrapped
from .components import components, merged

WORDS = 5
TREES, DEPTH = 16, 8
#: Prefix lengths in turn; a crowded region goes on with the next order's hashes after DEPTH.
DEPTHS = [2, 3, 4, 6, 8, 10, 12, 16]
REGION = 12
#: A shingle that at most so many classes of crowded regions hold joins them before the completion.
RARE = 32
AGREE = 0.55
MATCH, OF = 75, 100
#: A row with a set weighs so many plain rows where tasks are sized.
HEAVY = 16
CACHE = 200_000
BLOCK = 4096

_RNG = np.random.default_rng(20240229)
_POSITION = _RNG.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _RNG.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text."""

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        known = self.words
        if len(known) > CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower changes A-Z only; bytes.split cuts at \x20 and \x09-\x0D
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h, n = self._hashes(words), min(len(words), WORDS)
        total = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            total += h[i : len(h) - n + 1 + i] * _POSITION[i]
        return np.unique(_mix(total + np.uint64(n)))


def signature(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), BLOCK):
        part = low[at : at + BLOCK]
        np.minimum(out, ((part[None, :] ^ _XOR[:, None]) * _MUL[:, None]).min(axis=1), out=out)
    return out


def _set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingler()
    for batch in batches:
        n, node, mins = [], [], []
        for text in batch.column(1):
            s = shingle(text.as_py())
            n.append(len(s))
            node.append(_set_id(s) if len(s) else None)
            mins.append(signature(s).astype(">u4").tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(mins, pa.binary())],
            ["doc_id", "own", "n_shingles", "node", "mins"],
        )


def text_hash(text) -> Column:
    """Tells rows apart that share an id, or have none."""
    return F.xxhash64(text).alias("own")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, own (hash of the text), n_shingles, node (digest of the set), mins (big-endian 32-bit)."""
    prepare_workers(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_hash("text")).mapInArrow(_sign, f"doc_id {id_type}, own long, n_shingles long, node binary, mins binary")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingler()
    for batch in batches:
        rows, held = [], 0
        for text in batch.column(0):
            s = shingle(text.as_py())
            rows.append((_set_id(s), s.tobytes()))
            held += s.nbytes
            if held > 8 << 20:
                yield _set_batch(rows)
                rows, held = [], 0
        if rows:
            yield _set_batch(rows)


def _set_batch(rows):
    node, members = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(members, pa.binary())], ["node", "members"])


# --- candidates ---------------------------------------------------------------


def _prefix(depth: int):
    return F.substring("key", 1, 4 * depth)


def forest(classes: DataFrame) -> DataFrame:
    """One row per class and order: tree, node, n, key (the order's hashes)."""
    orders = [F.struct(F.lit(t).alias("tree"), F.substring("mins", 4 * DEPTH * t + 1, 4 * DEPTH).alias("key")) for t in range(TREES)]
    return classes.select("node", "n_shingles", F.explode(F.array(*orders)).alias("o")).select("o.tree", "node", "n_shingles", "o.key")


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, members in zip(batch.column(0), batch.column(1)):
            values = pa.array(np.frombuffer(members.as_buffer(), np.int64))
            for at in range(0, len(values), BLOCK):
                part = values.slice(at, BLOCK)
                same = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(part), np.int32)), pa.array([node.as_py()], pa.binary())).dictionary_decode()
                yield pa.RecordBatch.from_arrays([part, same, pa.array(np.full(len(part), len(values), np.int64))], ["shingle", "node", "n"])


def first_shingles(sets: DataFrame) -> DataFrame:
    """(shingle, node, n, c, rest): of each set, the rarest shingles, as many as one at the
    threshold can miss and one more; those that no other set holds take their place but are
    left out. ``c`` sets hold the shingle; ``rest`` shingles of the set come from it on."""
    held = sets.mapInArrow(_shingles, "shingle long, node binary, n long")
    many = sets.agg(F.sum(F.length("members"))).first()[0] or 0
    many //= 8
    counts = held.groupBy(F.col("shingle").alias("_s")).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    # stored, so that the join's sides are plain shuffles: a common shingle has many rows on the left
    counts = store(few(counts, many), "counts")
    shared = held.join(counts, F.col("shingle") == F.col("_s")).select("shingle", "node", "n", F.col("_c").alias("c"))
    by_set = shared.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("c", "shingle"))).alias("s"))
    can_miss = F.col("n") - F.ceil(F.col("n") * MATCH / OF)
    taken = F.slice("s", F.lit(1), F.greatest(F.lit(0), can_miss + 1 - (F.col("n") - F.size("s"))).cast("int"))
    places = by_set.select("node", "n", F.size("s").alias("_size"), F.posexplode(taken).alias("_at", "s"))
    return store(few(places.select("s.shingle", "node", "n", "s.c", (F.col("_size") - F.col("_at")).cast("long").alias("rest")), many), "first")


def rare_pairs(held: DataFrame, rare: int = RARE) -> DataFrame:
    """Distinct pairs (a, b) of the sets that share one of their first shingles, held by at most ``rare`` sets."""
    members = F.array_sort(F.collect_list(F.struct("node", "n", "rest")))
    groups = held.filter(F.col("c") <= rare).groupBy("shingle").agg(members.alias("m")).filter(F.size("m") > 1)
    fits = lambda y: (y["node"] > F.col("x.node")) & _near("x", y) & _enough(F.col("x.n"), y["n"], F.col("x.rest"), y["rest"])
    close = groups.select(F.explode("m").alias("x"), "m").select("x", F.explode(F.filter("m", fits)).alias("y"))
    return close.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


class Forest(NamedTuple):
    """Classes and the rows of their ``forest`` that share a prefix, with ``c``, how many share the first one."""

    classes: DataFrame
    rows: DataFrame


def shared_forest(classes: DataFrame) -> Forest:
    rows, first = forest(classes), _prefix(DEPTHS[0])
    # counts are stored before each join: its sides are then plain shuffles, and the
    # run-time planner can split a prefix that a large part of all classes share
    shared = rows.groupBy(F.col("tree").alias("_tree"), first.alias("_p")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    many = TREES * classes.count()
    shared = store(few(shared, many), "prefixes")
    return Forest(classes, store(few(rows.join(shared, (F.col("tree") == F.col("_tree")) & (first == F.col("_p"))).drop("_tree", "_p"), many), "forest"))


def crowded_nodes(shared: Forest, region: int = REGION) -> DataFrame:
    """(n) of every class in a crowded region of some order."""
    return store(few(shared.rows.filter(F.col("c") > region).select(F.col("node").alias("n")).distinct(), shared.rows.count()), "crowded")


def candidates(shared: Forest, region: int = REGION) -> DataFrame:
    """Distinct pairs (a, b) of classes that are neighbours in some order."""
    classes, rows = shared
    first, last = DEPTHS[0], DEPTHS[-1]
    settled = rows.filter(F.col("c") <= region).select("tree", F.lit(first).alias("depth"), _prefix(first).alias("p"), F.lit(0).cast("long").alias("part"), "node", "n_shingles")
    large = rows.filter(F.col("c") > region)
    many = large.count()
    # how common a class's full prefixes are, over all orders: largest at a centre
    deep = store(few(large.groupBy(F.col("tree").alias("_tree"), F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_c")), many), "prefixes")
    common = large.join(deep, (F.col("tree") == F.col("_tree")) & (F.col("key") == F.col("_key"))).groupBy(F.col("node").alias("_node")).agg(F.sum("_c").alias("_common"))
    large = large.join(common, F.col("node") == F.col("_node")).drop("_node")
    # crowded classes are followed through the next order's hashes as well
    mins = classes.select(F.col("node").alias("_node"), "mins")
    following = F.expr(f"substring(mins, {4 * DEPTH} * ((tree + 1) % {TREES}) + 1, {4 * DEPTH})")
    large = large.join(mins, F.col("node") == F.col("_node")).withColumn("key", F.concat("key", following)).drop("_node", "mins")
    large = store(few(large.select("tree", "node", "n_shingles", "key", "_common"), many), "crowded")
    # the crowded prefixes of all depths at once, each with its centre and a member picked by hash
    at, p = large.withColumn("depth", F.explode(F.array(*map(F.lit, DEPTHS)))), F.expr("substring(key, 1, 4 * depth)")
    found = at.groupBy(F.col("tree").alias("_tree"), F.col("depth").alias("_depth"), p.alias("_p")).agg(
        F.count(F.lit(1)).alias("_c"),
        F.max(F.struct("_common", "node", "n_shingles")).alias("_m"),
        F.min(F.struct(F.xxhash64("tree", "node").alias("h"), "node", "n_shingles")).alias("_r"),
    )
    found = store(few(found.filter(F.col("_c") > region), len(DEPTHS) * many), "prefixes")

    def member(c: str):
        return F.struct(F.col(f"{c}.node").alias("node"), F.col(f"{c}.n_shingles").alias("n"))

    met = at.drop("_common").join(found, (F.col("tree") == F.col("_tree")) & (F.col("depth") == F.col("_depth")) & (p == F.col("_p")))
    # a prefix is at most as common as a shorter one, so the depths that are crowded come first
    counted = met.groupBy("tree", "node", "n_shingles", "key").agg(
        F.max("depth").alias("_crowded"), F.max(F.when(F.col("depth") == last, F.col("_c"))).alias("_crowd"),
        F.collect_list(member("_m")).alias("_centres"), F.max_by(member("_r"), "depth").alias("_picked"),
    )
    depth = F.coalesce(*[F.when(F.col("_crowded") == d, F.lit(then)) for d, then in zip(DEPTHS, DEPTHS[1:])], F.lit(last))
    part = F.when(F.col("_crowd") > region, F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("_crowd") * 2 / region))).otherwise(F.lit(0).cast("long"))
    centres = F.array_distinct(F.array_append("_centres", F.col("_picked")))
    counted = store(few(counted.select("tree", "node", "n_shingles", "key", depth.alias("depth"), part.alias("part"), centres.alias("centres")), len(DEPTHS) * many), "regions")
    deeper = counted.select("tree", "depth", F.expr("substring(key, 1, 4 * depth)").alias("p"), "part", "node", "n_shingles")
    stars = (
        counted.select("node", "n_shingles", F.explode("centres").alias("c"))
        .filter("node != c.node")
        .select(F.struct("node", F.col("n_shingles").alias("n")).alias("x"), F.struct("c.node", "c.n").alias("y"))
    )
    members = F.array_sort(F.collect_list(F.struct("node", F.col("n_shingles").alias("n"))))
    groups = settled.union(deeper).groupBy("tree", "depth", "p", "part").agg(members.alias("m")).filter(F.size("m") > 1)
    close = groups.select(F.explode("m").alias("x"), "m").select("x", F.explode(F.filter("m", lambda y: (y["node"] > F.col("x.node")) & _near("x", y))).alias("y"))
    pairs = close.union(stars.filter(_near("x", F.col("y"))))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _near(x: str, y):
    """Sizes that allow a similarity of MATCH / OF."""
    nx, ny = F.col(f"{x}.n"), y["n"]
    return (F.least(nx, ny) * OF >= F.greatest(nx, ny) * MATCH)


def _enough(nx: Column, ny: Column, rx: Column, ry: Column) -> Column:
    """Whether sets whose first common shingle has so many after it, itself included, can have the similarity."""
    return F.least(rx, ry) * (OF + MATCH) >= (nx + ny) * MATCH


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u4").reshape(batch.num_rows, -1) for i in (2, 3))
            same = (x == y).sum(axis=1)
            keep = pa.array(same >= AGREE * x.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same.astype(np.int32))], ["a", "b", "same"]).filter(keep)


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidates (a, b) whose signatures agree enough, with the places that agree."""
    mins = classes.select("node", "mins")
    joined = pairs.join(mins.toDF("_a", "_ma"), F.col("a") == F.col("_a")).join(mins.toDF("_b", "_mb"), F.col("b") == F.col("_b"))
    return joined.select("a", "b", "_ma", "_mb").mapInArrow(_agreement, "a binary, b binary, same int")


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(OF * both >= MATCH * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets have the similarity."""
    joined = pairs.join(sets.toDF("_a", "_sa"), F.col("a") == F.col("_a")).join(sets.toDF("_b", "_sb"), F.col("b") == F.col("_b"))
    return joined.select("a", "b", "_sa", "_sb").mapInArrow(_overlap, "a binary, b binary")


def apart_pairs(held: DataFrame, labels: DataFrame) -> DataFrame:
    """Every pair (a, b) of sets in different components (``labels``) that can be at the
    threshold, from their ``first_shingles``."""
    of = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    many = held.count()
    held = store(few(held.join(of, F.col("node") == F.col("_node"), "left").select("shingle", "node", "n", "rest", F.coalesce("_label", "node").alias("label")), many), "labelled")
    # of a shingle's holders, those of its largest component meet others only
    per = held.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("_c"), F.min("n").alias("_n"), F.max("rest").alias("_r"))
    open_ = per.groupBy(F.col("shingle").alias("_s")).agg(
        F.max(F.struct("_c", "label"))["label"].alias("_most"), F.count(F.lit(1)).alias("_labels"), F.min("_n").alias("_least"), F.max("_r").alias("_rest")
    ).filter("_labels > 1")
    # what no holder can be near enough to is out: no partner is smaller than the least holder, or has more left than any
    smallest = F.greatest(F.col("_least"), F.ceil(F.col("n") * MATCH / OF))
    held = held.join(store(few(open_, many), "open"), F.col("shingle") == F.col("_s")).filter(_enough(F.col("n"), smallest, F.col("rest"), F.col("_rest")))
    held = store(few(held.select("shingle", "node", "n", "rest", "label", (F.col("label") == F.col("_most")).alias("most")), many), "apart")
    other = held.select(*[F.col(c).alias(f"_{c}") for c in held.columns])
    on = (
        (F.col("shingle") == F.col("_shingle")) & (F.col("label") != F.col("_label")) & (F.col("_most") | (F.col("node") < F.col("_node")))
        & (F.least("n", "_n") * OF >= F.greatest("n", "_n") * MATCH) & _enough(F.col("n"), F.col("_n"), F.col("rest"), F.col("_rest"))
    )
    pairs = held.filter(~F.col("most")).join(other, on)
    return pairs.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()


def full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, members): the sets of the classes ``nodes`` (n), from their texts."""
    many = HEAVY * docs.count()  # the join takes in all texts
    nodes = nodes.select(F.col("n").alias("_n"))
    wanted = classes.join(nodes, F.col("node") == F.col("_n"), "left_semi").select(F.col("doc_id").alias("_id")).distinct()
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    made = texts.mapInArrow(_sets, "node binary, members binary")
    # an id that several rows share can bring sets nobody asked for, or one twice
    made = store(few(made, many), "sets")
    twice = made.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return made if twice.isEmpty() else store(few(made.dropDuplicates(["node"]), many), "sets")


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, label) of every class that a confirmed link reaches."""
    shared, many = shared_forest(classes), classes.count()
    crowded = crowded_nodes(shared)
    in_crowds = full_sets(docs, classes, crowded)
    # an id that several rows share brings sets of other classes too
    in_crowds = in_crowds.join(crowded, F.col("node") == F.col("n"), "left_semi")
    held = first_shingles(in_crowds)
    pairs = candidates(shared).union(rare_pairs(held)).distinct()
    # a class has a few candidates, each with two signatures
    pairs = store(few(likely(pairs, classes), HEAVY * many), "pairs")
    tried = HEAVY * pairs.count()
    others = pairs.select(F.col("a").alias("n")).union(pairs.select("b")).distinct().join(crowded.toDF("_c"), F.col("n") == F.col("_c"), "left_anti")
    others = store(few(others, many), "others")
    outside = full_sets(docs, classes, others).join(others, F.col("node") == F.col("n"), "left_semi")
    sets = in_crowds.union(outside)
    sided = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "same").union(pairs.select("b", "a", "same"))
    best = sided.groupBy("x").agg(F.max(F.struct("same", "y")).alias("m"))
    best = best.select(F.least("x", "m.y").alias("a"), F.greatest("x", "m.y").alias("b")).distinct()
    sure = store(few(confirmed(best, sets), tried), "links")
    labels = components(sure, sure.count())
    # what the first links connect needs no further check
    of = labels.toDF("_node", "_label")
    rest = pairs.join(best.toDF("_ba", "_bb"), (F.col("a") == F.col("_ba")) & (F.col("b") == F.col("_bb")), "left_anti")
    rest = rest.join(of.toDF("_na", "_la"), F.col("a") == F.col("_na"), "left").join(of.toDF("_nb", "_lb"), F.col("b") == F.col("_nb"), "left")
    rest = rest.filter(~F.col("_la").eqNullSafe(F.col("_lb")) | F.col("_la").isNull()).select("a", "b")
    more = store(few(confirmed(rest, sets), tried), "links")
    found = more.count()
    labels = merged(labels, more, found) if found else labels
    # checked pairs that were no link need not be checked again
    left = store(few(apart_pairs(held, labels).join(pairs.toDF("_a", "_b", "_same"), (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti"), tried), "left")
    unchecked = left.count()
    if not unchecked:
        return labels
    last = store(few(confirmed(left, in_crowds), HEAVY * unchecked), "links")
    found = last.count()
    return merged(labels, last, found) if found else labels


def labelled(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, own, n_shingles, label (of its component; NULL without shingles)."""
    signed = store(signatures(docs), "signatures")
    many = signed.count()
    # equal sets have equal signatures, so these group by the node alone
    classes = store(
        few(signed.filter(F.col("node").isNotNull()).groupBy("node", "n_shingles", "mins").agg(F.min("doc_id").alias("doc_id")), many), "classes"
    )
    with temporary(docs.sparkSession):
        labels = store(few(links(docs, classes).toDF("_node", "_label"), many), "components", keep=True)
    joined = signed.filter(F.col("node").isNotNull()).join(labels, F.col("node") == F.col("_node"), "left")
    joined = joined.select("doc_id", "own", "n_shingles", F.coalesce("_label", "node").alias("label"))
    # documents without shingles stand alone: kept out of the joins, where their NULL would be one key
    return store(few(joined.union(signed.filter(F.col("node").isNull()).select("doc_id", "own", "n_shingles", "node")), many), "labelled")


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = labelled(docs)
    linked, alone = rows.filter(F.col("label").isNotNull()), rows.filter(F.col("label").isNull())
    # stored before the join, so that its sides are plain shuffles and a large group can be split
    least = store(few(linked.groupBy(F.col("label").alias("_label")).agg(F.min("doc_id").alias("component_id")), rows.count()), "least")
    found = linked.join(least, F.col("label") == F.col("_label")).select("doc_id", "n_shingles", "component_id")
    found = found.union(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id (NULL
    last; ties by a hash of the text). Repeated rows of it are all kept."""
    with temporary(docs.sparkSession):
        rows = labelled(docs)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "own")).alias("m")
        kept = rows.filter(F.col("label").isNotNull()).groupBy("label").agg(first).select("m.doc_id", "m.own")
        kept = kept.union(rows.filter(F.col("label").isNull()).select("doc_id", "own")).distinct()
        kept = store(few(kept.toDF("_id", "_own"), rows.count()), "kept", keep=True)
    tagged = wrapped(docs).withColumn("own", text_hash(F.col("row.text")))
    on = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_own"))
    return tagged.join(kept, on, "left_semi").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies and whether it stays."""
    return near_groups(table(spark, sf_dir, "documents"))
