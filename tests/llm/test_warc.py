import hashlib
import random

import pyarrow as pa
import pytest

from tessera.llm.warc import ArchiveError, read_archives, record, records_in, resolved, write_archives


def rows():
    rng = random.Random(1)
    long = ["x" * 100, "é" * 50, "y" * 99, "z" * 200_000, "".join(chr(rng.randrange(32, 1000)) for _ in range(60_000))]
    out = [(i, f"http://h/{i} ü\n", rng.choice([*long, "", None, f"page {i} " * 40])) for i in range(80)]
    return out + [(None, None, "x" * 100), (200, None, "n" * 150), (None, "u", "m" * 150), (None, "u", "m" * 150), (3, out[3][1], out[3][2])]


def want(data):
    body = lambda t: (t or "").encode()
    out = []
    for i, _, t in data:
        ids = [j for j, _, u in data if body(u) == body(t) and j is not None]
        first = min(ids) if ids else None
        again = len(body(t)) >= 100 and first is not None and i != first
        out.append((i, len(body(t)), hashlib.sha256(body(t)).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    data = rows()
    pages = spark.createDataFrame([(*r, "a", "b") for r in data],
                                  "page_id long, url string, html string, payload string, record_type string").repartition(3)
    manifest = write_archives(spark, pages, file_bytes=20_000)
    assert manifest.count() > 3
    for split in (1 << 30, 3_000):
        records = read_archives(manifest, split)
        assert sorted(map(tuple, resolved(spark, records).collect()), key=str) == want(data)
    got = {(r.page_id, r.url) for r in records.collect()}
    assert got == {(i, u) for i, u, _ in data}


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert resolved(spark, read_archives(write_archives(spark, pages))).count() == 0


def test_every_cut_owns_each_record_once():
    rng = random.Random(2)
    parts = [record(i, None, bytes(rng.randrange(256) for _ in range(rng.randrange(3000))) + b"\x1f\x8b\x08", "d", None, False, "x")
             for i in range(12)]
    data = b"\x1f\x8b\x08 junk" + b"".join(parts)
    handle = pa.BufferReader(data)
    for step in (37, 100, 1000, 5000, len(data)):
        seen = [r["page-id"] for s in range(0, len(data), step) for r in records_in(handle, len(data), s, s + step)]
        assert seen == [str(i) for i in range(12)]


def archive(spark, file_bytes=256 << 20):
    rng = random.Random(4)
    pages = spark.createDataFrame([(i, "http://h/a%20b%2Fc d", "".join(chr(rng.randrange(32, 1000)) for _ in range(3000))) for i in range(40)],
                                  "page_id long, url string, html string").coalesce(1)
    manifest = write_archives(spark, pages, file_bytes=file_bytes)
    return manifest, [r.path.removeprefix("file:") for r in manifest.collect()]


def read_all(spark, manifest, split):
    return resolved(spark, read_archives(manifest, split), manifest).count()


def test_escaped_urls_come_back(spark):
    manifest, _ = archive(spark)
    assert {r.url for r in read_archives(manifest).collect()} == {"http://h/a%20b%2Fc d"}


@pytest.mark.parametrize("split", [1 << 30, 5_000])
@pytest.mark.parametrize("at", [0.0, 0.3, 0.5, 0.9])
def test_a_flipped_byte_is_an_error(spark, split, at):
    manifest, (path,) = archive(spark)
    data = bytearray(open(path, "rb").read())
    data[int(at * len(data))] ^= 0x55
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="ArchiveError|records read"):
        read_all(spark, manifest, split)


def test_truncated_and_missing_records_are_errors(spark):
    manifest, (path,) = archive(spark)
    whole = open(path, "rb").read()
    open(path, "wb").write(whole[:-100])
    with pytest.raises(Exception, match="its writer noted"):
        read_all(spark, manifest, 1 << 30)
    open(path, "wb").write(whole)
    more = manifest.withColumn("records", manifest["records"] + 1)
    with pytest.raises(ArchiveError, match="40 records read, 41 written"):
        read_all(spark, more, 5_000)
    assert read_all(spark, manifest, 5_000) == 40


def test_many_tasks_read(spark):
    from pyspark.sql import functions as F
    manifest, paths = archive(spark, file_bytes=20_000)
    records = read_archives(manifest, 10_000).withColumn("task", F.spark_partition_id())
    assert len(paths) > 3 and records.select("task").distinct().count() >= len(paths) and records.count() == 40
