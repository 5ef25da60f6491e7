"""Exact, near and line dedup against brute force, with every edge case of the docstrings."""

import hashlib
import random
import re
import sys
from collections import Counter, defaultdict

import duckdb

from boreflow.llm import exact_dedup, line_dedup, near_dedup
from boreflow.llm.common import shared_path, table
from boreflow.llm.components import components, merged

from .helpers import BASE, SCHEMA, TEXTS, edited, empty, fixture, near_groups

SF = "/root/testdata/sf0.001"


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_groups(spark):
    got = Counter(tuple(r) for r in exact_dedup.exact_groups(fixture(spark)).collect())
    groups = defaultdict(list)
    for i, t, *_ in TEXTS:
        groups[norm(t)].append(i)
    want = Counter()
    for i, t, *_ in TEXTS:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want[(i, hashlib.sha256(norm(t).encode()).hexdigest(), keep, len(ids), i == keep)] += 1
    assert got == want


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    docs = fixture(spark)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len({norm(t) for _, t, *_ in TEXTS})
    assert {norm(r.text) for r in rows} == {norm(t) for _, t, *_ in TEXTS}
    assert 2 not in {r.doc_id for r in rows} and 1 in {r.doc_id for r in rows}


def test_index_persists_and_adding_again_changes_nothing(spark):
    path = shared_path(spark, "index")
    index = exact_dedup.DigestIndex(spark, path, buckets=4)
    first = spark.createDataFrame([(5, "a"), (6, "b"), (7, "a")], "doc_id long, digest string")
    second = spark.createDataFrame([(1, "a"), (9, "c"), (8, "c")], "doc_id long, digest string")
    index.add(first)
    index.add(first)
    spark.sql(f"DROP TABLE {index.name}")  # the files stay: another application opens them
    again = exact_dedup.DigestIndex(spark, path, buckets=4)
    again.add(second)
    assert sorted(map(tuple, again.read().collect())) == [("a", 5), ("b", 6), ("c", 8)]
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in again.resolve(second).collect()) == [(1, 5, False), (8, 8, True), (9, 8, False)]


def test_index_side_is_not_shuffled(spark):
    index = exact_dedup.DigestIndex(spark, shared_path(spark, "index"), buckets=4)
    plan = index.read().hint("merge").join(index.read().select("digest"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_near_groups(spark):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(fixture(spark)).collect())
    assert got == near_groups([(i, t) for i, t, *_ in TEXTS])


def test_near_groups_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    out = near_dedup.near_groups(table(spark, sf, "documents")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == near_groups(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_copies_linked_only_through_their_source(spark):
    """Copies at 0.75..0.8 of one text, below 0.75 of each other, in a crowded region."""
    rng = random.Random(1)
    rows = [(1000, " ".join(BASE))]
    for k in range(150):
        words = list(BASE)
        for j in rng.sample(range(0, 200, 6), 5):
            words[j] = f"new{k}_{j}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs).collect())
    assert got == near_groups(rows)


def test_linked_pairs_in_a_template_crowd_are_found(spark):
    """Members 0.68 alike by their template, linked in pairs at 0.754 only."""
    template = [f"form{i}" for i in range(166)]
    rows = []
    for k in range(0, 600, 2):
        for side, places in enumerate([(2, 14, 26), (8, 20, 35)]):
            own = [f"edit{k}_{side}_{i}" if i in places else f"own{k}_{i}" for i in range(38)]
            rows.append((k + side, " ".join(template + own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs).collect())
    assert got == Counter((i, 200, i - i % 2) for i in range(600))


def test_links_that_no_region_shows_are_found(spark, monkeypatch):
    """Candidates of hash regions and of rare shingles switched off: the exact completion finds every link."""
    rng = random.Random(5)
    none = "a binary, b binary"
    monkeypatch.setattr(near_dedup, "candidates", lambda classes: spark.createDataFrame([], none))
    monkeypatch.setattr(near_dedup, "rare_pairs", lambda sets: spark.createDataFrame([], none))
    rows = []
    for k in range(60):
        words = list(BASE)  # one crowd: all share most shingles, only some are at the threshold
        for j in rng.sample(range(0, len(words), 6), rng.randrange(1, 12)):
            words[j] = f"new{k}_{j}"
        rows.append((k, " ".join(words)))
    rows += [(100 + i, t) for i, t in enumerate(["", "one", "one", "a b c d e f", "A b c d e f g", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs).collect())
    assert got == near_groups(rows)


def test_drop_near_copies(spark):
    docs = fixture(spark)
    out = near_dedup.drop_near_copies(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert 100 in ids and not any(x in ids for x in range(101, 130)) and 3 in ids and 4 in ids


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[find(a)] = find(b)
    assert got.keys() == nodes
    pairs = {(find(x), got[x]) for x in nodes}
    assert len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs})


def test_stars_and_crowds_contract_in_one_round(spark, monkeypatch):
    """Each round is several shuffles: a hub's links, in whatever order its links fall, need one."""
    module, rounds = sys.modules[components.__module__], []
    monkeypatch.setattr(module, "store", lambda df, name, f=module.store: rounds.append(name) or f(df, name))
    edges = [(0, i) for i in range(1, 400)] + [(1000 + i, 1000 + j) for i in range(30) for j in range(i)]
    labels = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert rounds.count("hops") == 1
    assert len(labels) == 430 and len({r.label for r in labels}) == 2 and len({(r.node < 1000, r.label) for r in labels}) == 2


def test_further_edges_contract_only_what_is_apart(spark, monkeypatch):
    module, sizes = sys.modules[components.__module__], []
    frame = lambda e: spark.createDataFrame(e, "a long, b long")
    labels = components(frame([(0, i) for i in range(1, 50)] + [(100, 101), (101, 102), (200, 201)])).checkpoint()
    monkeypatch.setattr(module, "store", lambda df, name, f=module.store: sizes.append((name, df.count())) or f(df, name))
    # inside one component, between two (three times), new nodes alone and with a component, a loop
    more = [(3, 4), (5, 100), (6, 101), (7, 102), (300, 301), (302, 200), (9, 9)]
    got = {r.node: r.label for r in merged(labels, frame(more)).collect()}
    groups = Counter(got.values())
    assert sorted(groups.values()) == [2, 3, 53] and len(got) == 58
    assert len({got[i] for i in (0, 49, 100, 102)}) == 1 and got[302] == got[201] and got[300] == got[301]
    assert sizes[0] == ("edges", 3)


def test_crowded_regions_of_all_depths_take_one_pass(spark, monkeypatch):
    """A crowd's prefixes are counted for all depths together, and its centre and deepest regions are as before."""
    stored = []
    monkeypatch.setattr(near_dedup, "store", lambda df, name, keep=False, f=near_dedup.store: stored.append(name) or f(df, name, keep))
    docs = spark.createDataFrame([(k, edited(k)) for k in range(60)] + [(200, " ".join(BASE)), (201, "a text far from the others")], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs).collect())
    assert got == near_groups([tuple(r) for r in docs.collect()])
    assert stored.count("prefixes") == 3 and stored.count("forest") == 1


def brute_lines(rows):
    seen, covered = {}, defaultdict(set)
    docs = sorted({(i is None, i or 0, hashlib.md5(t.encode()).hexdigest(), t) for i, t in rows if t is not None})
    for key in docs:
        lines = key[3].split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if w in seen:
                covered[key].update((k, k + 1, k + 2))
            seen.setdefault(w, key)
    out = Counter()
    for i, t in rows:
        if t is None:
            out[(i, None, 0, 0)] += 1
            continue
        gone = covered[(i is None, i or 0, hashlib.md5(t.encode()).hexdigest(), t)]
        lines = t.split("\n")
        out[(i, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))] += 1
    return out


def test_drop_lines(spark):
    docs = fixture(spark)
    out = line_dedup.drop_lines(docs)
    assert out.columns == docs.columns + ["n_lines", "n_removed"]
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect())
    assert got == brute_lines([(i, t) for i, t, *_ in TEXTS])
    again = {r.doc_id: r.text for r in line_dedup.drop_lines(out.drop("n_lines")).collect()}
    assert again[12] == "head\n" + "\n".join(TEXTS[14][1].split("\n")) + "\ntail"


def test_registered_dedup_queries_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for module in (exact_dedup, line_dedup):
        df = module.query(spark, SF)
        want = con.sql(module.SQL)
        order = sorted(df.columns)
        assert order == sorted(want.columns)
        got = Counter(tuple(r[c] for c in order) for r in df.collect())
        assert got == Counter(con.sql(f"SELECT {', '.join(order)} FROM ({module.SQL})").fetchall())


def test_empty_tables(spark):
    none = empty(spark)
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
    assert near_dedup.near_groups(none).count() == 0
    assert line_dedup.drop_lines(none).count() == 0
    assert spark.createDataFrame([(1, edited(1))], "doc_id long, text string").transform(near_dedup.drop_near_copies).count() == 1
    assert SCHEMA


def test_near_copies_without_ids_and_with_shared_ids(spark):
    """One row of a component stays, also if no row of it has an id or an id has two texts."""
    far = " ".join(f"other{i}" for i in range(100))
    rows = [(None, edited(1)), (None, edited(2)), (None, far), (7, "a text of its own that nothing else here is like"), (7, edited(40) + " x"), (3, far)]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, own string").repartition(3)
    out = near_dedup.drop_near_copies(docs)
    assert out.columns == ["doc_id", "text", "own"]
    got = {(r.doc_id, r.text) for r in out.collect()}
    # the edited texts are one component: its only row with an id stays; of the far ones the row with an id
    assert got == {rows[3], rows[4], rows[5]}
    alone = spark.createDataFrame([(None, edited(1)), (None, edited(2))], "doc_id long, text string")
    assert alone.transform(near_dedup.drop_near_copies).count() == 1


def test_apart_sets_are_joined_only_where_they_can_be_near(spark):
    """Sets that share most shingles with a large group but differ in enough rare ones are
    no candidates of its members; those that do not are, as are small components of each other."""
    template, group, rows = [f"t{i}" for i in range(100)], 300, []

    def holders(k: int, own: int, words: int, label: str):
        rest = words - own  # all rarer shingles come before the shared one
        return [(1, f"{label}{k}".encode(), words, rest, label.encode())]

    for k in range(group):
        rows += holders(k, 5, len(template), "grp")
    rows += [x for k in range(50) for x in holders(k, 20, len(template), f"far{k}-")]
    rows += holders(0, 10, len(template), "near") + holders(0, 12, len(template), "too")
    held = spark.createDataFrame([(s, bytes(n), c, r) for s, n, c, r, _ in rows], "shingle long, node binary, n long, rest long")
    labels = spark.createDataFrame([(bytes(n), bytes(label)) for _, n, _, _, label in rows if label == b"grp"], "node binary, label binary")
    got = {(bytes(r.a), bytes(r.b)) for r in near_dedup.apart_pairs(held, labels).collect()}
    alone = {b"near0", b"too0"}
    want = {tuple(sorted((x, f"grp{k}".encode()))) for x in alone for k in range(group)} | {tuple(sorted(alone))}
    assert got == want


def test_first_shingles_count_exactly_and_keep_their_place(spark):
    """Unique shingles take places of the prefix; common ones come last, by exact counts."""
    import numpy as np

    def member(k: int, own: int):
        s = np.sort(np.array([*range(10_000, 10_100 - own), *(50_000 + 100 * k + i for i in range(own))], np.uint64))
        return bytes([k]), s.tobytes()

    sets = spark.createDataFrame([member(k, own) for k, own in enumerate([0, 10, 24, 30])], "node binary, members binary")
    got = near_dedup.first_shingles(sets).collect()
    taken = Counter(bytes(r.node)[0] for r in got)
    assert taken == {0: 16, 1: 16, 2: 2}
    assert {r.rest for r in got if bytes(r.node)[0] == 1} == set(range(75, 91))


def test_small_results_are_written_by_few_tasks(spark):
    """However many partitions the shuffles have: each file of a small table is a task of this and of later steps."""
    settings = {"spark.sql.shuffle.partitions": "150", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    most = 2 * spark.sparkContext.defaultParallelism
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        labels = components(spark.createDataFrame([(i, i + 1 + i % 3) for i in range(2000)], "a long, b long"))
        docs = spark.createDataFrame([(k, edited(k)) for k in range(300)], "doc_id long, text string")
        classes = near_dedup.signatures(docs).select("node", "n_shingles", "mins").checkpoint()
        shared = near_dedup.shared_forest(classes)
        files = [len(x.inputFiles()) for x in (labels, shared.rows, near_dedup.crowded_nodes(shared))]
        assert labels.count() == 2002 and shared.rows.count() > 150
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert max(files) <= most < 150
