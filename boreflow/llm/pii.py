"""PII (operator 5): anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs,
digits, URL schemes and identifier cues. Local parsers then expand each
anchor to its boundaries and validate it. The parsers look at the text around
an anchor only and move forward, so a text is read in linear time; a task
holds one Arrow batch of texts.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are the leftmost,
non-overlapping matches of their fixed patterns. The method adds ``url``
(scheme and the non-space text after it), ``secret`` (the value assigned to a
cue such as ``password=``) and ``iban`` (an account number after the cue
``IBAN`` whose check digits hold). Spans are in code points, end exclusive.

Defined cases
* A NULL or empty text has no spans; ``redact`` keeps NULL as NULL.
* Spans of different kinds may overlap; ``redact`` joins overlapping spans and
  names the first kind.
* Rows are treated one by one: repeated rows give repeated results, NULL ids
  stay NULL, an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Kinds in their order, characters of the patterns, schemes, cues.
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "url", "secret", "iban"]
DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
PHONE_TAIL = re.compile(r"[\x20().0-9-]+")
SCHEMES = ["http", "https", "ftp", "ftps", "ssh", "s3"]
URL_TAIL = re.compile(r"[^\s\"'<>\\^`{|}]+")
CUES = ["password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "access_key"]
CUE_VALUE = re.compile(r"[ \t]*[=:][ \t]*[\"']?([A-Za-z0-9_./+~-]{6,})")
IBAN_VALUE = re.compile(r"[ \t:#]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
#: Length of an account number by the country code it begins with.
_BY_LENGTH = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LENGTHS = {code: n for n, codes in _BY_LENGTH.items() for code in codes.split()}

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,value:string>>"


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for d in DIGITS:
        found.add_word(d, "digit")
    found.add_word("@", "at")
    found.add_word("+", "plus")
    found.add_word("://", "scheme")
    for cue in CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, "cue")
    for form in ("IBAN", "iban", "Iban"):
        found.add_word(form, "iban")
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def phone_at(text: str, plus: int) -> tuple[int, int] | None:
    if not (plus + 1 < len(text) and text[plus + 1] in DIGITS):
        return None
    tail = PHONE_TAIL.match(text, plus + 2)
    if not tail:
        return None
    end = tail.end()
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= plus + 3:
        return None
    n = sum(c in DIGITS for c in text[plus:end])
    return (plus, end) if 9 <= n <= 15 else None


def ips(text: str, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Four digit runs with single dots between, taken from the left."""
    i = 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:])):
            # a part of over three digits without leading zeros is over 255
            if all(len(p) <= 3 and int(p) <= 255 for p in ((text[s:e].lstrip("0") or "0") for s, e in four)):
                yield four[0][0], four[3][1]
            i += 4
        else:
            i += 1


def cards(text: str, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Chains of digit runs with one space or hyphen between."""
    i = 0
    while i < len(runs):
        j, n = i, runs[i][1] - runs[i][0]
        while j + 1 < len(runs) and runs[j + 1][0] == runs[j][1] + 1 and text[runs[j][1]] in " -":
            j += 1
            n += runs[j][1] - runs[j][0]
        if 12 <= n <= 19 and luhn("".join(text[s:e] for s, e in runs[i : j + 1])):
            yield runs[i][0], runs[j][1]
        i = j + 1


def url_at(text: str, colon: int, floor: int) -> tuple[int, int] | None:
    start = colon
    while start > floor and colon - start < 6 and text[start - 1].isascii() and text[start - 1].isalnum():
        start -= 1
    tail = URL_TAIL.match(text, colon + 3)
    if text[start:colon].lower() not in SCHEMES or not tail:
        return None
    end = colon + 3 + len(tail.group().rstrip(".,;:!?)]"))
    return (start, end) if end > colon + 3 else None


def iban_at(text: str, after: int) -> tuple[int, int] | None:
    """The text may go on in capitals or digits: the number is as long as its country
    says, for other codes the longest whose check digits hold."""
    value = IBAN_VALUE.match(text, after)
    if not value:
        return None
    start = value.start(1)
    places = [i for i in range(start, value.end(1)) if text[i] != " "]
    plain = "".join(text[i] for i in places)
    fixed = IBAN_LENGTHS.get(plain[:2])
    for n in [fixed] if fixed else range(len(plain), 14, -1):
        if n <= len(plain):
            number = "".join(str(int(c, 36)) for c in plain[4:n] + plain[:4])
            if int(number) % 97 == 1:
                return start, places[n - 1] + 1
    return None


def spans(text: str | None, anchors) -> list[tuple[str, int, int]]:
    """All spans of a text, ordered by start, then by kind as listed."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    runs: list[tuple[int, int]] = []
    ends = dict.fromkeys(KINDS, 0)
    run_end = -1
    n = len(text)
    for last, what in anchors.iter(text):
        if what == "digit":
            if last >= run_end:
                run_end = last + 1
                while run_end < n and text[run_end] in DIGITS:
                    run_end += 1
                runs.append((last, run_end))
            continue
        span, kind = None, what
        if what == "at":
            kind = "email"
            span = email_at(text, last, ends[kind]) if last >= ends[kind] else None
        elif what == "plus":
            kind = "phone"
            span = phone_at(text, last)
        elif what == "scheme":
            kind = "url"
            span = url_at(text, last - 2, ends[kind]) if last >= ends[kind] else None
        elif what == "cue":
            kind = "secret"
            value = CUE_VALUE.match(text, last + 1) if last >= ends[kind] else None
            span = value.span(1) if value else None
        elif last >= ends["iban"]:
            span = iban_at(text, last + 1)
        if span:
            out.append((kind, *span))
            ends[kind] = span[1]
    out += [("ip", *x) for x in ips(text, runs)]
    out += [("card", *x) for x in cards(text, runs)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
    for batch in batches:
        found = []
        for text in batch.column(1):
            text = text.as_py()
            found.append([{"kind": k, "start": s, "end": e, "value": text[s:e]} for k, s, e in spans(text, anchors)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end, value)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_find, f"doc_id {id_type}, spans {SPAN_TYPE}")


def redact_text(text: str | None, anchors) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end in spans(text, anchors):
        if start >= at:
            out.append(f"{text[at:start]}[{kind}]")
        at = max(at, end)
    return "".join(out) + text[at:]


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        clean = pa.array([redact_text(t.as_py(), anchors) for t in batch.column("text")], pa.string())
        i = batch.schema.get_field_index("text")
        yield batch.set_column(i, pa.field("text", pa.string()), clean)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets."""
    return docs.mapInArrow(_redact, docs.schema)


def _joined(spans_col):
    return F.array_join(F.transform(spans_col, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, their digest and all spans, per document."""
    found = find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
