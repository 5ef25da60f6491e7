"""Line dedup (operator 6): overlapping windows of three lines.

Each document is cut at line feeds; every three consecutive lines are hashed.
A window that occurs more than once stays where it occurs first, in order of
(doc_id, line); the lines that any later occurrence covers are removed, so
that overlapping windows merge into one passage whatever its length.

Windows travel as (document, line, digest) rows. First occurrences come from a
hash aggregate with map-side partials and only windows that occur again are
joined back, so a passage that a third of all documents share costs one row
per task in the aggregate, and the join's hot digest can be split by AQE.

Defined cases
* Documents with fewer than three lines hold no window and stay as they are;
  a NULL text stays NULL (0 lines), an empty text is one empty line.
* Empty lines are lines. Where a window repeats inside one document, its later
  occurrences go, also the lines they share with the first one's tail.
* Rows with equal id and equal text are one document and get the same result;
  rows with equal id and different texts are ordered by the text's digest. NULL
  ids come after all others.
* An empty table gives no rows; further columns are kept by ``drop_lines``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store, table, wrapped

WINDOW = 3


def document_key(doc_id="doc_id", text="text"):
    doc_id, text = F.col(doc_id), F.col(text)
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), F.md5(text.cast("binary")).alias("md5"))


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc, line, window): one row per window; doc is (id is null, id, text digest)."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.md5(x.cast("binary")))
    rows = docs.filter(F.col("text").isNotNull()).select(document_key().alias("doc"), lines.alias("lines"))
    rows = rows.filter(F.size("lines") >= size)
    spans = F.transform(
        F.sequence(F.lit(1), F.size("lines") - (size - 1)),
        lambda i: F.unhex(F.md5(F.array_join(F.slice("lines", i, size), "").cast("binary"))),
    )
    return rows.select("doc", F.posexplode(spans).alias("line", "window"))


def covered_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc, covered): the line numbers, from 0, that later occurrences cover."""
    found = store(windows(docs, size), "line-windows")
    again = (
        found.groupBy("window")
        .agg(F.min(F.struct("doc", "line")).alias("first"), F.max(F.struct("doc", "line")).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select(F.col("window").alias("_window"), "first")
    )
    later = found.join(again, F.col("window") == F.col("_window")).filter(F.struct("doc", "line") != F.col("first"))
    # copies without an id are one document here: its lines count once
    return later.select("doc", "line").distinct().groupBy("doc").agg(
        F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("line"), F.col("line") + (size - 1))))).alias("covered")
    )


def drop_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated lines removed from ``text``; all columns stay,
    ``n_lines`` and ``n_removed`` are added (replaced if they exist)."""
    covered = covered_lines(docs, size).select(F.col("doc").alias("_doc"), "covered")
    text = F.col("row.text")
    split = F.split(text, "\n")
    joined = wrapped(docs).withColumn("_own", document_key("row.doc_id", "row.text")).join(
        covered,
        (F.col("_own.no_id") == F.col("_doc.no_id"))
        & F.coalesce(F.col("_own.id"), F.lit(0)).eqNullSafe(F.coalesce(F.col("_doc.id"), F.lit(0)))
        & (F.col("_own.md5") == F.col("_doc.md5")),
        "left",
    )
    kept = F.array_join(F.filter(split, lambda x, i: ~F.array_contains("covered", i)), "\n")
    cleaned = F.when(F.col("covered").isNull(), text).otherwise(kept)
    others = [F.col("row").getField(c).alias(c) if c != "text" else cleaned.alias("text") for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *others,
        F.when(text.isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.when(F.col("covered").isNull(), 0).otherwise(F.size("covered")).cast("long").alias("n_removed"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed lines and the digest of the cleaned text."""
    out = drop_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


SQL = r"""
WITH l AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), n AS (
    SELECT doc_id, lines, unnest(range(len(lines))) AS i FROM l WHERE text IS NOT NULL
), w AS (
    SELECT doc_id, i, md5(lines[i + 1] || chr(10) || lines[i + 2] || chr(10) || lines[i + 3]) AS h
    FROM n WHERE i + 3 <= len(lines)
), o AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM w
), cov AS (
    SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM o WHERE k > 1
), kept AS (
    SELECT n.doc_id, count(cov.i) AS n_removed,
           coalesce(string_agg(n.lines[n.i + 1], chr(10) ORDER BY n.i) FILTER (cov.i IS NULL), '') AS cleaned
    FROM n LEFT JOIN cov ON n.doc_id = cov.doc_id AND n.i = cov.i GROUP BY n.doc_id
)
SELECT l.doc_id, CAST(coalesce(len(l.lines), 0) AS BIGINT) AS n_lines,
       coalesce(kept.n_removed, 0) AS n_removed, md5(coalesce(kept.cleaned, '')) AS text_md5
FROM l LEFT JOIN kept ON l.doc_id = kept.doc_id
"""
