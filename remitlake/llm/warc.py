"""WARC records in seekable Zstandard bundles.

A bundle is a row of a table in shared storage: independent frames of whole records, then a skippable
frame with the seek table (compressed and plain size of each frame). An index table beside it maps a
record identifier to its bundle, its frame and the offset inside the frame. The index is sorted by
identifier and every bundle is a row group, so looking up one record reads one bundle and unpacks one
frame of it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.scratch import scratch_path

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
REVISIT_BYTES = 100
LEVEL = 3
# Fixed values of the seekable format: skippable frame, end mark.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

# Fixed value: a revisit that has the payload of another record.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLE_SCHEMA = "bundle_id string, bundle binary, entries array<struct<record_id:string,page_id:long,digest:string,frame:int,start:long,size:long>>"
RECORD_SCHEMA = "page_id long, record_id string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
#: A row group for each bundle.
BY_BUNDLE = {"parquet.block.row.count.limit": "1"}


def record_uri(page_id: int | None, seq: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{seq}"


def make_record(uri: str, url: str, kind: str, date: str, size: int, digest: str, refers_to: str | None, payload: bytes) -> bytes:
    """One WARC/1.1 record. Header values have their line ends replaced, so no value can add a header."""
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{uri}>", f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{refers_to}>"]
    head.append(f"Content-Length: {len(body)}")
    lines = (" ".join(x.splitlines()) for x in head)
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:] if ": " in x)
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('WARC-Record-ID')} does not end where it says")
    return fields, rest[:size]


class BundleWriter:
    def __init__(self) -> None:
        self._packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self._open, self._open_size = [], 0
        self.frames: list[tuple[bytes, int]] = []
        self.entries: list[dict] = []
        self.size = 0

    def add(self, record_id: str, page_id: int | None, digest: str, record: bytes) -> None:
        self.entries.append({"record_id": record_id, "page_id": page_id, "digest": digest, "frame": len(self.frames), "start": self._open_size, "size": len(record)})
        self._open.append(record)
        self._open_size += len(record)
        if self._open_size >= FRAME_BYTES:
            self._end_frame()

    def _end_frame(self) -> None:
        if self._open:
            data = b"".join(self._open)
            self.frames.append((self._packer.compress(data), len(data)))
            self.size += len(self.frames[-1][0])
            self._open, self._open_size = [], 0

    def close(self) -> bytes:
        self._end_frame()
        table = b"".join(struct.pack("<II", len(f), n) for f, n in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        return b"".join(f for f, _ in self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


class BundleReader:
    """Frames of a bundle by number, found through its seek table."""

    def __init__(self, bundle: bytes):
        count, flags, mark = struct.unpack("<IBI", bundle[-9:])
        if mark != SEEKABLE or flags:
            raise ValueError("the bundle has no seek table of the known kind")
        table = bundle[-9 - 8 * count : -9]
        self._bundle, self._at, at = bundle, [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self._at.append((at, packed, plain))
            at += packed

    def __len__(self) -> int:
        return len(self._at)

    def frame(self, i: int) -> bytes:
        at, packed, plain = self._at[i]
        return zstandard.ZstdDecompressor().decompress(self._bundle[at : at + packed], max_output_size=plain)


def _write(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    """Bundles of the rows; ``refers_to`` is the identifier of the record that a revisit points to."""
    writer, task, n = BundleWriter(), uuid.uuid4().hex, 0
    for batch in batches:
        for row in range(batch.num_rows):
            r = {n: batch.column(i)[row].as_py() for i, n in enumerate(batch.schema.names)}
            kind = "revisit" if r["refers_to"] is not None else "response"
            uri = record_uri(r["page_id"], uuid.uuid4().hex)
            writer.add(uri, r["page_id"], r["payload_digest"], make_record(uri, r["url"], kind, date, r["payload_bytes"], r["payload_digest"], r["refers_to"], r["payload"]))
            if writer.size >= BUNDLE_BYTES:
                yield _bundle(writer, f"{task}-{n:08d}")
                writer, n = BundleWriter(), n + 1
    if writer.entries:
        yield _bundle(writer, f"{task}-{n:08d}")


def _bundle(writer: BundleWriter, name: str) -> pa.RecordBatch:
    data = writer.close()
    kind = pa.list_(pa.struct([("record_id", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()), ("frame", pa.int32()), ("start", pa.int64()), ("size", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary()), pa.array([writer.entries], kind)], names=["bundle_id", "bundle", "entries"])


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    for batch in batches:
        for bundle, entries in zip(batch.column("bundle"), batch.column("entries"), strict=True):
            reader, open_frame, data, rows, held = BundleReader(bundle.as_py()), -1, b"", [], 0
            for e in entries.as_py():
                if e["frame"] != open_frame:
                    open_frame, data = e["frame"], reader.frame(e["frame"])
                fields, body = parse_record(data[e["start"] : e["start"] + e["size"]])
                if fields["WARC-Record-ID"] != f"<{e['record_id']}>":
                    raise ValueError(f"the index points {e['record_id']} at another record")
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"the payload of {e['record_id']} does not have its digest")
                page = fields["WARC-Record-ID"].split(":")[2]
                target = fields.get("WARC-Refers-To")
                rows.append((int(page) if page else None, e["record_id"], int(fields["X-Payload-Length"]), digest, kind, int(target[1:-1].split(":")[2]) if target else None, body if payloads else None))
                held += len(body) * payloads
                if held > BUNDLE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its size and digest, and refers_to for payloads met at a smaller page_id.

    Only digests are grouped, the smallest id of each formed before the shuffle. The pages are joined to
    the digests met twice: payloads are shuffled once by digest, unless those are few enough to be sent
    to the pages; a digest with a third of the pages is split. A page with a null id never is a target;
    rows that repeat the target's id are responses as well.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url"), F.lit("")).alias("url"), payload.alias("payload"))
    own = own.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    large = own.where(F.col("payload_bytes") >= REVISIT_BYTES)
    met = large.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("target"), F.count("*").alias("n")).where("n > 1 AND target IS NOT NULL")
    joined = own.join(met.drop("n"), ["payload_digest", "payload_bytes"], "left")
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(~F.col("page_id").eqNullSafe(F.col("target")), F.col("target")).alias("refers_to"))


def write_bundles(pages: DataFrame, path: str, date: dt.datetime | None = None) -> None:
    """Write the archive of ``pages`` (page_id, url, html): tables ``bundles`` and ``index`` under ``path``.

    Null html is an empty payload, null url an empty target; ``date`` (UTC, now by default) is the date of
    all records. Responses are written first; revisits carry no payload and take the identifier they refer
    to from the responses' index, so every reference names a record. The tables are written by Spark, so
    ``path`` may be in any store; a task that is run again replaces its own bundles only. A payload is one
    value: up to 2 GB. No pages give empty tables.
    """
    spark = pages.sparkSession
    stamp = f"{date or dt.datetime.now(dt.UTC):%Y-%m-%dT%H:%M:%SZ}"
    marked = with_revisits(pages)
    write = lambda rows, mode: rows.mapInArrow(lambda it: _write(it, stamp), BUNDLE_SCHEMA).write.options(**BY_BUNDLE).mode(mode).parquet(f"{path}/bundles")
    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"]
    write(marked.where("refers_to IS NULL").withColumn("refers_to", F.lit(None).cast("string")).select(*columns), "errorifexists")
    named = entries(spark.read.parquet(f"{path}/bundles")).groupBy("digest").agg(F.min("record_id").alias("refers_to"))
    again = marked.where("refers_to IS NOT NULL").drop("payload", "refers_to").withColumnRenamed("payload_digest", "digest")
    again = again.join(named, "digest").withColumnRenamed("digest", "payload_digest").withColumn("payload", F.lit(None).cast("binary"))
    write(again.select(*columns), "append")
    index = entries(spark.read.parquet(f"{path}/bundles")).select("record_id", "bundle_id", "frame", "start", "size")
    index.repartitionByRange("record_id").sortWithinPartitions("record_id").write.parquet(f"{path}/index")


def entries(bundles: DataFrame) -> DataFrame:
    """bundle_id and the entry of every record, without reading the bundles themselves."""
    return bundles.select("bundle_id", F.explode("entries").alias("e")).select("bundle_id", "e.*")


def read_records(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles, checked against index and digest. RECORD_SCHEMA."""
    return bundles.select("bundle", "entries").mapInArrow(lambda it: _read(it, payloads), RECORD_SCHEMA)


def record_place(spark: SparkSession, path: str, record_id: str) -> DataFrame:
    """bundle, frame, start and size of one record: from the index, and the one bundle it names."""
    at = spark.read.parquet(f"{path}/index").where(F.col("record_id") == record_id).head()
    bundles = spark.read.parquet(f"{path}/bundles").select("bundle_id", "bundle")
    if at is None:
        return bundles.limit(0)
    place = {n: F.lit(at[n]) for n in ("frame", "start", "size")}
    return bundles.where(F.col("bundle_id") == at["bundle_id"]).withColumns(place)


def find_record(spark: SparkSession, path: str, record_id: str) -> tuple[dict[str, str], bytes] | None:
    """One record by identifier, header fields and block; a revisit has no block of its own."""
    at = record_place(spark, path, record_id).head()
    if at is None:
        return None
    frame = BundleReader(bytes(at["bundle"])).frame(at["frame"])
    return parse_record(frame[at["start"] : at["start"] + at["size"]])


def find_payload(spark: SparkSession, path: str, record_id: str) -> bytes | None:
    """The payload of a record, of a revisit that of the record it refers to."""
    found = find_record(spark, path, record_id)
    if found is None:
        return None
    fields, body = found
    target = fields.get("WARC-Refers-To")
    return body if target is None else find_payload(spark, path, target[1:-1])


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the archive to the shared folder, read it back, and describe each page's record.

    Empty tables give an empty result; pages of equal id are separate records; extra columns are
    ignored.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_bundles(pages, path)
    return read_records(spark.read.parquet(f"{path}/bundles"), payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
