"""WARC (operator 10): archives packaged as ZIP, read by range without extraction.

Writing: every task streams its records into one ZIP whose members are stored
(not compressed by ZIP): ``archive/data.warc.gz``, each record a gzip member of
its own, and ``indexes/index.cdx`` with offset and length of each record.
ZIP64 structures are used where sizes need them. A task attempt writes a file
of its own name and returns it in the manifest; only files in the manifest are
read, so a lost or repeated attempt leaves nothing that counts.

Reading: the end record, the ZIP64 records and the central directory are read
from the file's tail, stored archive and index members are located, and the
index is cut into stretches of about ``SPLIT`` bytes; each stretch is one range
read in some task. An archive without index is read as one stream in bounded
pieces. Files are reached through ``pyarrow.fs`` by the URI of the folder.

Of pages with equal payloads the one with the largest page_id is a response,
the others revisit it (``revisit`` records carry no payload).

Defined cases
* NULL html is an empty payload; empty payloads are equal to each other.
* A NULL page_id counts as smallest; where a payload has only NULL ids, and
  for repeated rows with the largest id, each row is a response.
* NULL urls become ``urn:page:none``; line breaks and other controls in urls are
  percent-encoded. An empty table gives no archives and no rows.
* Further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, store, table

SPLIT = 16 << 20
CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"

# Fixed values of the ZIP format: signatures, sizes, the field's "see ZIP64" mark.
LOCAL_SIG, CENTRAL_SIG, END_SIG, END64_SIG, LOCATOR_SIG, DESCRIPTOR_SIG = (
    0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50, 0x08074B50,
)
LOCAL, CENTRAL, END = struct.Struct("<IHHHHHIIIHH"), struct.Struct("<IHHHHHHIIIHHHHHII"), struct.Struct("<IHHHHIIH")
END64, LOCATOR = struct.Struct("<IQHHIIQQQQ"), struct.Struct("<IIQI")
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


def open_fs(uri: str):
    """(file system, path) of a URI or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- ZIP --------------------------------------------------------------------


class ZipStream:
    """Writes stored members to a stream that cannot seek."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.entries, self.zip64 = out, 0, [], zip64

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.entry = {"name": raw, "offset": self.at, "crc": 0, "size": 0}
        # bit 3: checksum and size follow the data; bit 11: the name is UTF-8
        self._put(LOCAL.pack(LOCAL_SIG, 45, 0x808, 0, 0, 0x21, 0, 0, 0, len(raw), 0) + raw)

    def write(self, data: bytes) -> None:
        self.entry["crc"] = zlib.crc32(data, self.entry["crc"])
        self.entry["size"] += len(data)
        self._put(data)

    def finish(self) -> None:
        e = self.entry
        large = self.zip64 or e["size"] >= FULL32
        self._put(struct.pack("<IIQQ" if large else "<III" + "I", DESCRIPTOR_SIG, e["crc"], e["size"], e["size"]))
        self.entries.append(e)

    def close(self) -> None:
        start = self.at
        for e in self.entries:
            large = self.zip64 or e["size"] >= FULL32 or e["offset"] >= FULL32
            extra = struct.pack("<HHQQQ", 1, 24, e["size"], e["size"], e["offset"]) if large else b""
            size, offset = (FULL32, FULL32) if large else (e["size"], e["offset"])
            self._put(CENTRAL.pack(CENTRAL_SIG, 45, 45, 0x808, 0, 0, 0x21, e["crc"], size, size, len(e["name"]), len(extra), 0, 0, 0, 0, offset) + e["name"] + extra)
        size, n = self.at - start, len(self.entries)
        if self.zip64 or start >= FULL32 or n >= FULL16:
            at = self.at
            self._put(END64.pack(END64_SIG, END64.size - 12, 45, 45, 0, 0, n, n, size, start))
            self._put(LOCATOR.pack(LOCATOR_SIG, 0, at, 1))
            self._put(END.pack(END_SIG, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))
        else:
            self._put(END.pack(END_SIG, 0, 0, n, n, size, start, 0))


def range_read(f, at: int, size: int) -> bytes:
    f.seek(at)
    return f.read(size)


def directory(f, length: int) -> list[dict]:
    """The members of a ZIP file: name, method, size and where their data starts."""
    tail_at = max(0, length - (END.size + FULL16 + LOCATOR.size))
    tail = range_read(f, tail_at, length - tail_at)
    at = tail.rfind(struct.pack("<I", END_SIG))
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    _, _, _, _, n, size, start, _ = END.unpack_from(tail, at)
    if FULL32 in (size, start) or n == FULL16:
        found = at >= LOCATOR.size and LOCATOR.unpack_from(tail, at - LOCATOR.size)
        if found and found[0] == LOCATOR_SIG:
            _, _, _, _, _, _, _, n, size, start = END64.unpack(range_read(f, found[2], END64.size))
    raw, at, members = range_read(f, start, size), 0, []
    for _ in range(n):
        sig, _, _, flags, method, _, _, crc, packed, plain, n_name, n_extra, n_comment, _, _, _, offset = CENTRAL.unpack_from(raw, at)
        if sig != CENTRAL_SIG:
            raise ValueError("broken central directory")
        at += CENTRAL.size
        name, extra = raw[at : at + n_name], raw[at + n_name : at + n_name + n_extra]
        at += n_name + n_extra + n_comment
        wide = zip64_extra(extra)
        plain, packed, offset = (next(wide) if x == FULL32 else x for x in (plain, packed, offset))
        members.append({"name": name.decode("utf-8" if flags & 0x800 else "cp437"), "method": method, "size": packed, "crc": crc, "offset": offset})
    for m in members:
        head = LOCAL.unpack(range_read(f, m["offset"], LOCAL.size))
        m["data"] = m["offset"] + LOCAL.size + head[9] + head[10]
    return members


def zip64_extra(extra: bytes) -> Iterator[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            yield from struct.unpack_from(f"<{size // 8}Q", extra, at + 4)
        at += 4 + size


# --- WARC -------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha1: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{sha1}')}"


def header_safe(value: str) -> str:
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page: dict) -> bytes:
    """One WARC record of a page (page_id, url, html, sha1, refers_to, revisit)."""
    payload = (page["html"] or "").encode()
    fields = [
        ("WARC-Type", "revisit" if page["revisit"] else "response"),
        ("WARC-Record-ID", f"<{record_id(page['page_id'], page['sha1'])}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", header_safe(page["url"]) if page["url"] else "urn:page:none"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
    ]
    if page["page_id"] is not None:
        fields.append(("X-Page-ID", str(page["page_id"])))
    if page["revisit"]:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(page['refers_to'], page['sha1'])}>")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if page["revisit"] else http + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields and payload of one record's bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    page = fields.get("x-page-id")
    return {
        "page_id": None if page is None else int(page),
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id", "").strip("<>"),
        "refers_to_id": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "url": fields.get("warc-target-uri"),
        "payload": payload,
        "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
    }


def members(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The gzip members, decompressed, of a stream that comes in pieces."""
    unzip, out = None, io.BytesIO()
    for data in pieces:
        while data:
            unzip = unzip or zlib.decompressobj(31)
            out.write(unzip.decompress(data))
            data = unzip.unused_data
            if not unzip.eof:
                break
            yield out.getvalue()
            unzip, out = None, io.BytesIO()


# --- jobs -------------------------------------------------------------------


def resolve_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, html, sha1, revisit, refers_to: which page keeps a payload."""
    rows = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha1"))
    first = rows.groupBy("sha1").agg(F.max("page_id").alias("_keeper")).withColumnRenamed("sha1", "_sha1")
    # stored, so that both sides of the join are plain shuffles and a payload that
    # very many pages share can be split at run time
    first = store(first, "warc-keepers")
    joined = rows.join(first, F.col("sha1") == F.col("_sha1"))
    revisit = ~F.col("page_id").eqNullSafe(F.col("_keeper"))
    return joined.select(
        "page_id", "url", "html", "sha1", revisit.alias("revisit"), F.when(revisit, F.col("_keeper")).alias("refers_to")
    )


def write_archives(records: DataFrame, folder: str, zip64: bool = False) -> DataFrame:
    """Write one archive per task; returns the stored manifest (path, records, bytes)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        path, out, index, n = f"{root}/pages-{uuid.uuid4().hex}.zip", None, [], 0
        for batch in batches:
            for page in batch.to_pylist():
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(path)
                    zipped = ZipStream(out, zip64)
                    zipped.begin(DATA_MEMBER)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = packer.compress(record(page)) + packer.flush()
                index.append(f"{zipped.entry['size']} {len(raw)}\n")
                zipped.write(raw)
                n += 1
        if out is None:
            return
        zipped.finish()
        zipped.begin(INDEX_MEMBER)
        zipped.write("".join(index).encode())
        zipped.finish()
        zipped.close()
        out.close()
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [zipped.at]})

    return store(records.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def record_ranges(manifest: DataFrame, folder: str, split: int = SPLIT) -> DataFrame:
    """(path, start, size, offsets): stretches of whole records in each archive.
    ``offsets`` are the records' starts in the stretch; NULL without an index."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with fs.open_input_file(path) as f:
                    found = directory(f, f.size())
                    stored = {m["name"]: m for m in found if m["method"] == 0}
                    index = next((m for k, m in stored.items() if k.startswith("indexes/")), None)
                    data = [m for k, m in stored.items() if k.startswith("archive/")]
                    lines = range_read(f, index["data"], index["size"]).split(b"\n") if index and len(data) == 1 else None
                out = {"path": [], "start": [], "size": [], "offsets": []}

                def put(start, size, offsets):
                    for k, v in zip(out, (path, start, size, offsets)):
                        out[k].append(v)

                if lines is None:
                    for m in data:
                        put(m["data"], m["size"], None)
                else:
                    base, start, size, offsets = data[0]["data"], 0, 0, []
                    for line in filter(None, lines):
                        at, length = map(int, line.split())
                        if offsets and size + length > split:
                            put(base + start, size, offsets)
                            start, size, offsets = at, 0, []
                        offsets.append(at - start)
                        size += length
                    if offsets:
                        put(base + start, size, offsets)
                yield pa.RecordBatch.from_pydict(out, pa.schema([("path", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("offsets", pa.list_(pa.int64()))]))

    return manifest.select("path").mapInArrow(locate, "path string, start long, size long, offsets array<long>")


def read_records(ranges: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the given ranges; the payload's digest is computed anew."""
    cols = "page_id long, record_type string, record_id string, refers_to_id string, url string, payload binary, digest string, payload_bytes long, payload_digest string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        kinds = pa.schema([("page_id", pa.int64()), *((k, pa.string()) for k in ("record_type", "record_id", "refers_to_id", "url")), ("payload", pa.binary()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

        def raw_records(f, part: dict) -> Iterator[bytes]:
            if part["offsets"] is None:
                f.seek(part["start"])
                pieces = (f.read(min(CHUNK, part["size"] - at)) for at in range(0, part["size"], CHUNK))
                yield from members(pieces)
                return
            data = range_read(f, part["start"], part["size"])
            for a, b in zip(part["offsets"], [*part["offsets"][1:], part["size"]]):
                yield zlib.decompress(data[a:b], 31)

        for batch in batches:
            for part in batch.to_pylist():
                rows, held = [], 0
                with fs.open_input_file(part["path"]) as f:
                    for raw in raw_records(f, part):
                        r = parse_record(raw)
                        r |= {"payload_bytes": len(r["payload"]), "payload_digest": payload_digest(r["payload"])}
                        held += len(raw) if with_payload else 256
                        rows.append(r if with_payload else r | {"payload": None})
                        if held > SPLIT:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    return ranges.mapInArrow(read, cols)


def archive_pages(pages: DataFrame, folder: str | None = None, with_payload: bool = True, zip64: bool = False) -> DataFrame:
    """Write ``pages`` to archives and read every record back from them."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    manifest = write_archives(resolve_pages(pages), folder, zip64)
    ranges = store(record_ranges(manifest, folder), "warc-ranges")
    # one stretch is one range read; they are dealt evenly whatever the archives' sizes
    dealt = ranges.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path", "start")
    return read_records(dealt, folder, with_payload)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's record as read back from the archives; a revisit's size and
    digest are those of the response that it refers to."""
    found = store(archive_pages(table(spark, sf_dir, "pages"), with_payload=False).drop("payload"), "warc-records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    revisit = F.col("record_type") == "revisit"
    kept = found.filter(~revisit).select("record_id", *columns)
    # stored, so that both sides of the join are plain shuffles and a response that
    # very many pages revisit can be split at run time
    of = store(kept.dropDuplicates(["record_id"]).select(F.col("record_id").alias("_of"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")), "warc-responses")
    again = found.filter(revisit).join(of, F.col("refers_to_id") == F.col("_of"))
    again = again.select("page_id", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"), "record_type", F.col("_page").alias("refers_to"))
    return kept.select(*columns, F.lit(None).cast("long").alias("refers_to")).union(again)
