"""WARC archives: written by tasks in parallel, read back by a splittable reader.

The writer puts one gzip member per record (WARC/1.1). Pages with equal payloads of at least
``REVISIT_BYTES`` bytes are stored once: the record of the smallest ``page_id`` is the response, the
others are revisits that name it. Every task writes its own files under an attempt-specific name and
returns them as rows of a manifest; only files named there are read, so the files of lost or
repeated attempts do no harm.

The reader cuts the files into byte ranges. A task scans its range for the gzip magic, takes a
candidate for a member only if it decodes to a WARC header, and owns the records that start inside
its range, reading beyond its end where the last one does. No index is needed and no file goes
through one task. No record is lost in silence: a member that begins like a WARC record and cannot
be read to its end, or whatever else stands where the next member should begin, is an error, and
``resolved`` compares the records read of each file with the number its writer noted.

Archives are opened with pyarrow's file systems: local folders, ``hdfs://``, ``s3://`` (``s3a://`` is
read as such) and ``gs://``.

Defined cases: a null html is an empty payload. A null ``page_id`` sorts after every other and is
read back as null; a null url has no target header. Rows that repeat the smallest ``page_id`` of a
payload are each a response. Extra columns are ignored. An empty table gives no record.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BUCKETS, staged
from tessera.session import work_path

REVISIT_BYTES = 100
FILE_BYTES = 256 << 20
SPLIT_BYTES = 32 << 20
MAX_TASKS = 100_000
_READ = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = b"\x1f\x8b\x08"


class ArchiveError(RuntimeError):
    """An archive that does not hold the records it should."""


def file_system(uri: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


# --- writing -----------------------------------------------------------------------------------

def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool,
           date: str) -> bytes:
    """One compressed WARC record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest)),
            ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=-._~")))
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest))]
        if refers_to is not None:
            head.append(("Refers-To-Page-ID", str(refers_to)))
    head.append(("Content-Length", str(len(block))))
    plain = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(4, zlib.DEFLATED, 31)
    return gz.compress(plain) + gz.flush()


def marked(pages: DataFrame) -> DataFrame:
    """Pages with ``_digest`` (hex SHA-256 of the payload), ``_first`` (the response's page) and
    ``_revisit``. Only payloads that may be shared are shuffled, with a bounded broadcast of hash
    buckets telling which."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("_digest", F.sha2("html", 256))
    shared = (rows.filter(F.octet_length("html") >= REVISIT_BYTES).groupBy("_digest")
              .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"))
    shared = staged(pages.sparkSession, shared, "shared")
    bucket = F.pmod(F.xxhash64("_digest"), F.lit(BUCKETS)).alias("_bucket")
    spots = F.broadcast(shared.select(bucket).distinct())
    tagged = rows.withColumn("_bucket", bucket)
    some = tagged.join(spots, "_bucket", "left_semi").join(shared, "_digest", "left")
    rest = tagged.join(spots, "_bucket", "left_anti").withColumn("_first", F.lit(None).cast("long"))
    known = F.col("_first").isNotNull()
    return some.unionByName(rest.select(some.columns)).select(
        "page_id", "url", "html", "_digest", "_first",
        (known & ~F.col("page_id").eqNullSafe(F.col("_first"))).alias("_revisit"))


def write_archives(spark: SparkSession, pages: DataFrame, date: str = "2024-01-01T00:00:00Z",
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` under the shared work folder; returns the manifest: ``path``, ``bytes``,
    ``records``."""
    folder = work_path(spark, "llm-warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, made, size, count = None, [], 0, 0
        for batch in batches:
            for page_id, url, text, digest, first, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = f"{base}/{name}-{len(made):04d}.warc.gz"
                    out, size, count = fs.open_output_stream(path, compression=None), 0, 0
                data = record(page_id, url, text.encode("utf-8", "surrogatepass"), digest, first, revisit, date)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    out.close()
                    made.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            made.append((path, size, count))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[(f"{folder}/{p.rpartition('/')[2]}", s, n) for p, s, n in made])],
                                             names=["path", "bytes", "records"])

    return staged(spark, marked(pages).mapInArrow(write, "path string, bytes long, records long"), "manifest")


# --- reading -----------------------------------------------------------------------------------

class Member:
    """One gzip member, decoded from a file at an offset."""

    def __init__(self, handle, offset: int, size: int):
        self.handle, self.at, self.size = handle, offset, size
        self.gz = zlib.decompressobj(31)

    def decode(self, least: int | None = None) -> bytes:
        """At least so many bytes of the content, or all of it."""
        out = bytearray()
        while not self.gz.eof and (least is None or len(out) < least):
            if self.at >= self.size:
                raise zlib.error("the file ends within a member")
            self.handle.seek(self.at)
            data = self.handle.read(min(_READ if least is None else 4096, self.size - self.at))
            out += self.gz.decompress(data)
            self.at += len(data) - len(self.gz.unused_data)
        return bytes(out)


_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n", re.I)


def parse_record(plain: bytes) -> dict | None:
    """The headers and payload of a decoded member, or None if it is no whole WARC record."""
    head, found, rest = plain.partition(b"\r\n\r\n")
    length = _LENGTH.search(head + b"\r\n")
    if not found or not head.startswith(b"WARC/1.") or not length or len(rest) != int(length[1]) + 4:
        return None
    block = rest[:-4]
    out = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    http, _, payload = block.partition(b"\r\n\r\n")
    out["payload"] = payload if out.get("warc-type") == "response" else None
    return out


def records_in(handle, size: int, start: int, end: int) -> Iterator[dict]:
    """The records that start in [start, end) of an archive."""
    at, sure = start, False
    while at < min(end, size):
        if not sure:  # look for the next magic; it may lie across two reads
            handle.seek(at)
            data = handle.read(min(_READ, min(end, size) - at) + 2)
            hit = data.find(_MAGIC)
            if hit < 0:
                at += max(1, len(data) - 2)
                continue
            at += hit
            if at >= end:
                return
        try:
            begins = Member(handle, at, size).decode(7)[:7] == b"WARC/1."
        except zlib.error:
            begins = False
        if not begins:
            if sure:
                raise ArchiveError(f"no record at byte {at}, where the one before ends")
            at += 1
            continue
        member = Member(handle, at, size)
        try:
            found = parse_record(member.decode())
        except zlib.error as e:
            raise ArchiveError(f"the record at byte {at} cannot be read: {e}") from e
        if found is None:
            raise ArchiveError(f"the record at byte {at} is not whole")
        yield found
        at, sure = member.at, True


_FIELDS = [("path", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()),
           ("refers_to", pa.int64()), ("payload", pa.binary())]


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per record: ``path`` (its file), ``page_id``, ``record_type``, ``url``,
    ``payload_digest`` (as its header says), ``refers_to``, ``payload`` (null for revisits). There are
    as many partitions as byte ranges, up to ``MAX_TASKS``; the number is given, so that small
    manifest rows are not put together in one task."""
    schema = pa.schema(_FIELDS)
    tasks = manifest.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / F.lit(split_bytes))), F.lit(0))).first()[0]
    splits = manifest.filter("bytes > 0").select("path", "bytes", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def number(x):
            return None if x is None else int(x)
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, name = file_system(path)
                with fs.open_input_file(name) as handle:
                    if handle.size() != size:
                        raise ArchiveError(f"{path} has {handle.size()} bytes, its writer noted {size}")
                    rows, held = [], 0
                    for r in records_in(handle, size, start, start + split_bytes):
                        url = r.get("warc-target-uri")
                        rows.append((path, number(r.get("page-id")), r.get("warc-type"), None if url is None else unquote(url),
                                     r.get("warc-payload-digest", "").rpartition(":")[2], number(r.get("refers-to-page-id")), r["payload"]))
                        held += len(r["payload"] or b"")
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return splits.repartition(max(1, min(int(tasks), MAX_TASKS))).mapInArrow(
        read, "path string, page_id long, record_type string, url string, payload_digest string, refers_to long, payload binary")


def counted(records: DataFrame, manifest: DataFrame) -> None:
    """Raise unless every file of the manifest gave as many records as its writer noted."""
    read = records.groupBy("path").agg(F.count("*").alias("read"))
    off = manifest.join(read, "path", "left").filter(F.col("records") != F.coalesce("read", F.lit(0))).limit(5).collect()
    if off:
        raise ArchiveError("; ".join(f"{r['path']}: {r['read'] or 0} records read, {r['records']} written" for r in off))


def resolved(spark: SparkSession, records: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Per record ``page_id``, ``payload_bytes``, ``payload_digest`` (bare hex), ``record_type``,
    ``refers_to``; digests and sizes are those of the payloads as read, a revisit's from the
    response that it names. With ``manifest`` the records of each file are counted first."""
    narrow = staged(spark, records.select(
        "path", "page_id", "record_type", "refers_to", F.col("payload_digest").alias("named"),
        F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")), "records")
    if manifest is not None:
        counted(narrow, manifest)
    full = narrow.filter("record_type = 'response'")
    target = (full.filter(F.col("payload_bytes") >= REVISIT_BYTES)
              .select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")).distinct())
    again = (narrow.filter("record_type = 'revisit'")
             .join(target, (F.col("refers_to") == F.col("_id")) & (F.col("named") == F.col("_digest")))
             .select("page_id", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"), "record_type", "refers_to"))
    return full.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").unionByName(again)
