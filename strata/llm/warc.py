"""WARC archives in seekable Zstandard bundles (operator 9).

A bundle is one file: independent Zstandard frames of whole records, a
skippable frame that maps record identifiers to frame-relative offsets, and
the footer seek table of the seekable format (a skippable frame with the
compressed and plain size of every frame). A reader takes the footer, looks a
record up in the map and decompresses one frame.

Bundles are written by Spark's text writer, one row a file, so they commit
like any table and lie on whatever store the path names. A bundle's last
three bytes, the end of the seekable magic number, are the UTF-8 form of
U+A48F: the writer adds them as the line end.

Defined results: null payloads are empty, null URLs are left out of the
record; a null id is written as ``null`` and never refers to or is referred
to; rows that share the largest id of their group are all responses; an empty
table gives no bundle and no row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import dealt_join, whole

# Fixed values of the seekable format: skippable frame magic, seek table magic.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
LINE_END = "꒏"
MIN_REVISIT = 1000      # bytes; smaller payloads are always stored
FRAME_BYTES = 1 << 18   # plain bytes after which a frame is closed
BUNDLE_BYTES = 1 << 22  # compressed bytes after which a bundle is closed
RECORD_DATE = "2024-01-01T00:00:00Z"

RECORD = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, url string, payload binary")
INDEX = "bundle string, page_id bigint, frame int, offset bigint, length bigint"


# --- records ----------------------------------------------------------------

def _urn(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _id(urn: str):
    value = urn[len("<urn:page:"):-1]
    return None if value == "null" else int(value)


def record_bytes(page_id, url, payload: bytes, sha1: str, refers_to, length: int) -> bytes:
    """One WARC/1.1 record; a revisit has no block and names the length it leaves out."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}", f"X-Payload-Length: {length}"]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode() + payload + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple:
    """``(page_id, payload_bytes, sha1, type, refers_to, url, payload)``; raises on a damaged record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    payload = rest[:length]
    if len(payload) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("record length does not match its header")
    kind, sha1 = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != sha1:
        raise ValueError("payload digest does not match")
    refers = fields.get("WARC-Refers-To")
    return (_id(fields["WARC-Record-ID"]), int(fields.get("X-Payload-Length", length)), sha1, kind,
            None if refers is None else _id(refers), fields.get("WARC-Target-URI"), payload)


# --- bundles ----------------------------------------------------------------

class Bundle:
    """Frames of records; ``close`` appends the record map and the seek table."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.limit, self.compressor = frame_bytes, zstandard.ZstdCompressor(level=3)
        self.frames, self.sizes, self.places = [], [], []
        self.open, self.filled, self.size = [], 0, 0

    def add(self, page_id, record: bytes) -> None:
        self.places.append((page_id, len(self.sizes), self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= self.limit:
            self._frame()

    def _frame(self) -> None:
        if self.open:
            data = self.compressor.compress(b"".join(self.open))
            self.frames.append(data)
            self.sizes.append((len(data), self.filled))
            self.size += len(data)
            self.open, self.filled = [], 0

    def close(self) -> bytes:
        self._frame()
        names = self.compressor.compress(json.dumps(self.places).encode())
        chart = struct.pack("<II", SKIPPABLE, len(names)) + names
        sizes = [*self.sizes, (len(chart), 0)]
        table = b"".join(struct.pack("<II", *s) for s in sizes)
        foot = struct.pack("<IBI", len(sizes), 0, SEEKABLE)
        return b"".join(self.frames) + chart + struct.pack("<II", SEEK_TABLE, len(table) + len(foot)) \
            + table + foot


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """``(start, compressed size, plain size)`` of every frame, from the footer."""
    count, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at, start, out = len(bundle) - 9 - count * width, 0, []
    for i in range(count):
        packed, plain = struct.unpack_from("<II", bundle, at + i * width)
        out.append((start, packed, plain))
        start += packed
    return out


def record_map(bundle: bytes) -> list[tuple]:
    """``(page_id, frame, offset in the frame, length)`` of every record."""
    start, size, _ = seek_table(bundle)[-1]
    return [tuple(x) for x in json.loads(
        zstandard.ZstdDecompressor().decompress(bundle[start + 8:start + size]))]


def read_frame(bundle: bytes, frame: int) -> bytes:
    start, size, plain = seek_table(bundle)[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[start:start + size],
                                                   max_output_size=plain)


def bundle_records(bundle: bytes, wanted: set | None = None) -> Iterator[tuple]:
    """Parsed records, all or those whose id is wanted; other frames stay packed."""
    now, data = None, b""
    for page_id, frame, offset, length in record_map(bundle):
        if wanted is not None and page_id not in wanted:
            continue
        if frame != now:
            now, data = frame, read_frame(bundle, frame)
        yield parse_record(data[offset:offset + length])


# --- Spark ------------------------------------------------------------------

def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 payload_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, url, payload, sha1, refers_to)``; a null ``refers_to`` is a response.

    Equal payloads share length, SHA-1 and SHA-256. Only digests are grouped
    (partial aggregate) and only groups of two or more ids are joined back. The
    join deals its rows anew, so that a hot payload's partition can be split;
    payloads too short to be revisited, the empty page too, do not move.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"),
                        F.col(f"`{url_col}`").cast("string").alias("url"),
                        whole(payload_col).cast("binary").alias("payload"))
    keyed = rows.select("*", F.sha1("payload").alias("sha1"),
                        F.sha2("payload", 256).alias("sha256"),
                        F.octet_length("payload").alias("n"))
    names = ["sha256", "sha1", "n"]
    long = keyed.where(F.col("n") >= min_revisit)
    groups = long.groupBy(*names).agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("rows")) \
        .where("rows > 1 and top is not null").drop("rows")
    out = dealt_join(long, groups, names, "left").unionByName(
        keyed.where(F.col("n") < min_revisit).withColumn("top", F.lit(None).cast("bigint")))
    return out.select("page_id", "url", "payload", "sha1",
                      F.when(F.col("page_id") < F.col("top"), F.col("top")).alias("refers_to"))


def write_bundles(records: DataFrame, path: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> str:
    """Writes planned records as bundles below ``path``; a task holds one open bundle."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, any_ = Bundle(frame_bytes), False

        def done():
            body = bundle.close()[:-len(LINE_END.encode())]
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["value"])

        for batch in batches:
            cols = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                page_id, url, payload, sha1, refers = (c[i].as_py() for c in cols)
                bundle.add(page_id, record_bytes(page_id, url, payload, sha1, refers, len(payload)))
                any_ = True
                if bundle.size >= bundle_bytes:
                    yield done()
                    bundle, any_ = Bundle(frame_bytes), False
        if any_:
            yield done()

    records.select("page_id", "url", "payload", "sha1", "refers_to") \
        .mapInArrow(run, "value binary").select(F.col("value").cast("string")) \
        .write.option("lineSep", LINE_END).option("compression", "none") \
        .option("maxRecordsPerFile", 1).text(path)
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path) \
        .select("path", "content")


def read_bundles(spark: SparkSession, path: str, ids: Iterable[int] | None = None,
                 payloads: bool = True) -> DataFrame:
    """``RECORD`` rows of all bundles, or of the wanted ids (other frames stay packed).

    Every record is cut out by its place in the map, its length is checked,
    and a response's payload must have the digest that its header names.
    """
    wanted = None if ids is None else set(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url",
                 "payload"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
                 pa.binary()]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names)

        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for r in bundle_records(batch.column(1)[i].as_py(), wanted):
                    rows.append(r if payloads else (*r[:6], None))
                    size += len(r[6]) if payloads else 100
                    if size > 1 << 22:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    return _files(spark, path).mapInArrow(run, RECORD)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``INDEX`` rows: where every record lies, without unpacking a frame."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                rows = [(name, *r) for r in record_map(batch.column(1)[i].as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [
                        pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()])],
                    ["bundle", "page_id", "frame", "offset", "length"])

    return _files(spark, path).mapInArrow(run, INDEX)


def archive(pages: DataFrame, folder: str, **columns) -> DataFrame:
    """Writes ``pages`` to a new folder below ``folder`` and reads the archives back (no payloads)."""
    path = f"{folder.rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_bundles(plan_records(pages, **columns), path)
    return read_bundles(pages.sparkSession, path, payloads=False)
