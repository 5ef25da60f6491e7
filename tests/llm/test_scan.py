"""PII spans, toxicity scores, WARC archives and neighbour search."""

import base64
import hashlib
import math
import re
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boreflow.llm import neighbours, pii, toxicity, warc
from boreflow.llm.common import shared_path, store, table

from .helpers import TEXTS, empty, fixture

SF = "/root/testdata/sf0.01"

# --- PII ------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    found = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m.group())]
    return sorted(found, key=lambda x: (x[1], pii.BASE_KINDS.index(x[0])))


ANCHORS = pii.automaton()
CARDS = st.sampled_from(["4111 1111 1111 1111", "4111111111111111", "0" * 12, "5500-0000-0000-0004", "10.1.2.255", "a.b@c.d", "+1 (555) 123-45"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="0123456789.. --@@+()aB_%é\n:/=", max_size=20), CARDS), max_size=6).map("".join))
def test_base_spans_are_the_patterns_matches(text):
    assert [s for s in pii.spans(text, ANCHORS) if s[0] in pii.BASE_KINDS] == base_spans(text)


def test_added_kinds():
    text = 'see https://ex.org/a?b=1, password=abc12345 and token = "f83046fe"; IBAN DE89 3704 0044 0532 0130 00.'
    got = [(k, text[s:e]) for k, s, e in pii.spans(text, ANCHORS) if k not in pii.BASE_KINDS]
    assert got == [("url", "https://ex.org/a?b=1"), ("secret", "abc12345"), ("secret", "f83046fe"), ("iban", "DE89 3704 0044 0532 0130 00")]
    assert pii.redact_text("mail a@b.cd now", ANCHORS) == "mail [email] now"
    assert pii.redact_text(None, ANCHORS) is None


@pytest.mark.parametrize(
    "number", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
)
@pytest.mark.parametrize("after", ["", ".", " Please pay", " BIC COBADEFFXXX", " 12 EUR", " 2024", " A", "\nX", " I AM HERE AND THERE"])
def test_iban_ends_where_its_country_says(number, after):
    text = f"IBAN {number}{after}"
    assert [(k, text[s:e]) for k, s, e in pii.spans(text, ANCHORS) if k == "iban"] == [("iban", number)]
    assert pii.redact_text(text, ANCHORS) == f"IBAN [iban]{after}"


def test_iban_of_an_unlisted_country():
    body = "1234567890123456"
    number = f"ZZ{98 - int(body + '353500') % 97:02}{body}"
    for after in ("", " Pay"):
        assert [text[s:e] for text in (f"IBAN {number}{after}",) for k, s, e in pii.spans(text, ANCHORS) if k == "iban"] == [number]
    assert not [k for k, *_ in pii.spans("IBAN DE88 3704 0044 0532 0130 00 Please", ANCHORS) if k == "iban"]


@pytest.mark.parametrize("source", ["fixture", "documents"])
def test_pii_query_columns(spark, source, monkeypatch):
    docs = fixture(spark) if source == "fixture" else table(spark, SF, "documents")
    monkeypatch.setattr(pii, "table", lambda *_: docs)
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.query(spark, SF).collect())
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        found = base_spans(r.text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        want[(r.doc_id, *(sum(x[0] == k for x in found) for k in PATTERNS), hashlib.sha256(joined.encode()).hexdigest())] += 1
    assert got == want


def test_redact_keeps_columns(spark):
    docs = fixture(spark)
    out = pii.redact(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert "[email]" in texts[16] and "[phone]" in texts[16] and "[ip]" in texts[16] and "[card]" in texts[16] and texts[3] is None
    assert pii.find_spans(empty(spark)).count() == 0


# --- toxicity ---------------------------------------------------------------------------


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def average_precision(pairs):
    hits, total = 0, 0.0
    for n, (_, toxic) in enumerate(sorted(pairs, key=lambda x: -x[0]), 1):
        if toxic:
            hits += 1
            total += hits / n
    return total / hits


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in toxicity.query(spark, sf).collect()}
    assert len(rows) == table(spark, sf, "documents").count()
    labels = [(r.doc_id, r.toxic) for r in table(spark, sf, "labels").collect() if is_held_out(r.doc_id)]
    assert all(rows[i].held_out == is_held_out(i) for i in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    assert average_precision([(rows[i].score, t) for i, t in labels]) > 0.85
    clean = [rows[i].predicted for i, t in labels if not t]
    assert sum(clean) / len(clean) < 0.02


def test_held_out_labels_and_other_columns_are_not_used(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    twisted = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    plain = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("x"))
    a = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    b = {r.doc_id: r.score for r in toxicity.score(plain, toxicity.fit(plain, twisted)).collect()}
    assert a == b


def test_training_rows_that_share_a_footer_stay(spark):
    """Half of every text is a common footer; near copies go, one of each label stays, whatever the order."""
    footer = " ".join(f"licence{i}" for i in range(60))
    ids = [i for i in range(1, 400) if not is_held_out(i)]
    own = {i: " ".join(f"own{i}x{j}" for j in range(60)) for i in ids}
    toxic = {i: int(n % 3 == 0) for n, i in enumerate(ids)}
    copies = ids[:40]
    for i in copies:
        own[i] = own[ids[0]] + f" edit{i}"
    rows = [(i, f"{own[i]} {footer}") for i in ids]
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    got = []
    for some in (rows, rows[::-1]):
        docs = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
        got.append(sorted((r.text, r.toxic) for r in toxicity.training_rows(docs, labels, 16_000).collect()))
    want = Counter(toxic[i] for i in ids[40:]) + Counter({0: 1, 1: 1})
    assert Counter(t for _, t in got[0]) == want and got[0] == got[1]


def test_toxicity_edges(spark):
    docs = fixture(spark)
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (7, None), (9, 7)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        rows = toxicity.score(docs, toxicity.fit(docs, some)).collect()
        assert Counter(r.doc_id for r in rows) == Counter(t[0] for t in TEXTS)
        assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(empty(spark), toxicity.fit(empty(spark), labels)).count() == 0
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns


def test_label_model_recovers_accuracies_and_correlation():
    rng = np.random.default_rng(0)
    n = 20_000
    y = rng.random(n) < 0.1
    rates = [(0.8, 0.01), (0.6, 0.02), (0.7, 0.05), (0.5, 0.01)]
    v = np.stack([np.where(y, rng.random(n) < a, rng.random(n) < b) for a, b in rates], axis=1)
    twin = np.where(rng.random(n) < 0.97, v[:, 0], ~v[:, 0])  # says what voter 0 says
    v = np.column_stack([v, twin, ~v.any(axis=1)])
    known = np.where(rng.random(n) < 0.1, y, -1)
    q, accuracy, parent = toxicity.label_model(v, known, 0.1)
    assert parent[4] == 0 or parent[0] == 4
    true = [(v[:, j] & y).sum() / v[:, j].sum() for j in range(4)]
    assert np.abs(accuracy[:4] - true).max() < 0.12
    assert ((q > 0.5) == y).mean() > 0.955


# --- WARC ---------------------------------------------------------------------------------

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (5, "http://a/5", "<p>one</p>"), (9, "http://a/9\r\nX-Bad: 1", "<p>one</p>"),
    (2, None, None), (3, "http://a/3", ""), (4, "http://ä/4", "Grüße 🎉\r\n\r\nWARC/1.1\r\n"),
    (None, "http://a/n", "only nulls"), (None, "http://a/m", "only nulls"), (6, "u", "twice"), (6, "u", "twice"), (10, "u", "twice"),
    (11, "u", "top twice"), (11, "u", "top twice"), (12, "long", "x" * 3_000_000),
]


def pages_frame(spark):
    return spark.createDataFrame([(*p, "k", 1, "s") for p in PAGES], "page_id long, url string, html string, sha1 string, revisit int, _keeper string")


def expected_pages():
    best = {}
    for i, _, h in PAGES:
        if i is not None:
            best[h or ""] = max(best.get(h or "", i), i)
    out = Counter()
    for i, _, h in PAGES:
        raw = (h or "").encode()
        top = best.get(h or "")
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out[(i, len(raw), digest, "response" if i == top else "revisit", None if i == top else top)] += 1
    return out


def test_warc_query(spark, monkeypatch):
    monkeypatch.setattr(warc, "table", lambda *_: pages_frame(spark))
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.query(spark, SF).collect())
    assert got == expected_pages()


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_are_zip_files_of_whole_records(spark, zip64):
    folder = shared_path(spark, "warc-test")
    manifest = warc.write_archives(warc.resolve_pages(pages_frame(spark)), folder, zip64).collect()
    assert sum(r.records for r in manifest) == len(PAGES)
    seen = Counter()
    for r in manifest:
        fs, _ = warc.open_fs(folder)
        with fs.open_input_file(r.path) as f:
            raw = f.read()
        with zipfile.ZipFile(pa.BufferReader(raw)) as z:
            assert z.testzip() is None and z.namelist() == [warc.DATA_MEMBER, warc.INDEX_MEMBER]
            assert all(m.compress_type == zipfile.ZIP_STORED for m in z.infolist())
            data, index = z.read(warc.DATA_MEMBER), z.read(warc.INDEX_MEMBER)
        for line in index.split(b"\n")[:-1]:
            at, size = map(int, line.split())
            seen[warc.parse_record(zlib.decompress(data[at : at + size], 31))["url"]] += 1
        walked = list(warc.members(data[i : i + 1000] for i in range(0, len(data), 1000)))
        assert len(walked) == r.records
    assert sum(seen.values()) == len(PAGES) and seen["http://a/9%0D%0AX-Bad:%201"] == 1 and seen["urn:page:none"] == 1


def test_payloads_come_back_whole_and_without_an_index(spark):
    folder = shared_path(spark, "warc-test")
    manifest = warc.write_archives(warc.resolve_pages(pages_frame(spark)), folder)
    ranges = store(warc.record_ranges(manifest, folder, split=100), "ranges")
    assert ranges.count() > manifest.count()
    whole = ranges.groupBy("path").agg(F.min("start").alias("start"), F.sum("size").alias("size"))
    whole = whole.withColumn("offsets", F.lit(None).cast("array<long>"))
    for parts in (ranges, whole):
        rows = warc.read_records(parts, folder).collect()
        assert all(r.digest == r.payload_digest for r in rows if r.record_type == "response")
        texts = {bytes(r.payload).decode() for r in rows if r.record_type == "response"}
        assert texts == {h or "" for _, _, h in PAGES}


def test_warc_empty_table_and_real_pages(spark):
    assert warc.archive_pages(pages_frame(spark).limit(0)).count() == 0
    pages = [(r.page_id, r.html) for r in table(spark, SF, "pages").collect()]
    got = {r.page_id: r for r in warc.query(spark, SF).collect()}
    assert len(got) == len(pages)
    for i, h in pages:
        assert got[i].payload_bytes == len((h or "").encode())


# --- neighbours -----------------------------------------------------------------------------


def brute_neighbours(rows, queries, k=10):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        order = np.lexsort((ids, d))[:k]
        out[q] = [(int(ids[j]), float(d[j])) for j in order if np.isfinite(d[j])]
    return out


def recall(got, want):
    found = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    return found / sum(map(len, want.values()))


def lists(frame):
    out = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    want = brute_neighbours(rows, [i for i, _ in rows if i % 100 == 0])
    got = lists(neighbours.query(spark, sf))
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (x[1], x[0]))
        assert all(math.isclose(s, math.sqrt(((vectors[q] - vectors[v]) ** 2).sum()), rel_tol=1e-12) for v, s in found)


def test_many_equal_vectors_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], 0) for i in range(0, 400)]
    rows += [(1000 + i, [float(i), 1.0], 0) for i in range(100)]
    odd = [(2000, None, 0), (2001, [], 0), (2002, [0.0, 0.0], 0), (2003, [nan, 1.0], 0), (2004, [inf, 1.0], 0), (2005, [None, 1.0], 0), (2006, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0)]
    vectors = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>, leaf int")
    want = brute_neighbours([r[:2] for r in rows], [i for i, *_ in rows if i % 100 == 0])
    got = lists(neighbours.search(vectors, F.col("vec_id") % 100 == 0, sample=64, leaf=8, recall=1.0))
    assert got.keys() == want.keys()
    assert got[0] == want[0] and got[100] == want[100] and got[1000] == want[1000]
    few = lists(neighbours.search(vectors.filter("vec_id < 3"), F.col("vec_id") == 0))
    assert few == {0: [(1, 0.0), (2, 0.0)]}
    assert neighbours.search(vectors.limit(0), F.lit(True)).count() == 0
    assert neighbours.search(vectors.filter("vec_id = 1"), F.lit(True)).count() == 0
