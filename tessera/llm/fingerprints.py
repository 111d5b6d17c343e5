"""Document fingerprints as threshold-scaled sketches.

A text's sketch keeps every hash of its five-word shingles that lies below a fixed share ``SHARE`` of
all hash values. It therefore grows with the text, the sketch of two texts together is what their
sketches hold together, and the share of one sketch's hashes found in another estimates how much of
one document the other contains, however unequal they are. A text none of whose shingles lies below
keeps its smallest hash instead; ``merged`` drops such a hash once a lower one is there, so sketches
stay mergeable. Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z; a text of one to four
words is one shingle. Words and shingles are known by 64-bit hashes: two given different shingles
fall together with a chance of 2**-64.

``compare`` needs the next document beside every document. Documents are dealt into slices of
consecutive ids and about equal length, whose first ids (at most ``SLICES``) are all that reaches the
driver. Each text is shuffled once, to its slice; the first document of a slice goes to the slice
before it too. A slice is sorted and read as a stream that holds two texts at a time.

Defined cases: a null text is empty, has no shingle and an empty fingerprint; two empty sketches are
alike (1.0), an empty and another one are not (0.0). A document of no or one code point replaces
nothing. A sole document is its own next one. Null doc_ids come first; rows with an equal doc_id go
by a hash of their text, then by the text. Repeated rows are rows of their own. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.words import batch_shingles, batch_words

SHINGLE = 5
SHARE = 4  # one in so many hashes is kept
SLICE_CHARS = 2_000_000
SLICES = 20_000
_RUN = 1_000_000  # characters whose shingles are hashed together
_LIMIT = np.uint64((1 << 64) // SHARE)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The sorted distinct hashes below the threshold, or the smallest one."""
    low = np.unique(hashes[hashes < _LIMIT])
    return low if len(low) or not len(hashes) else hashes.min(keepdims=True)


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The sketch of each text, hashed in runs of about ``_RUN`` characters."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        run, size = [], 0
        while at < len(texts) and (not run or size + len(texts[at]) <= _RUN):
            run.append(texts[at].encode("utf-8", "surrogatepass"))
            size += len(texts[at])
            at += 1
        words, doc, _, _, _ = batch_words(run)
        h, of = batch_shingles(words, doc, len(run), SHINGLE)
        ends = np.searchsorted(of, np.arange(len(run) + 1))
        out += [sketch(h[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two texts together."""
    return sketch(np.concatenate([a, b]))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of either text that both have."""
    if not len(a) and not len(b):
        return 1.0
    both = shared(a, b)
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the first text's shingles that the second has."""
    return shared(a, b) / len(a) if len(a) else 1.0


def to_text(s: np.ndarray) -> str:
    """A sketch as hex digits, 16 per hash, ascending."""
    return s.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as many first code points of ``after``, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


_KEY = ["known", "id", "h"]


def _slice_starts(spark: SparkSession, keys: DataFrame) -> list[tuple]:
    """The first key of every slice: a slice begins where the running number of characters, in the
    order of the keys, passes a multiple of the slice length. Range partitions keep running numbers
    of their own; their totals, a row for each, are all that is added up in one place."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(spark, keys.groupBy(*_KEY).agg(F.sum("n_chars").alias("n_chars")).repartitionByRange(n, *_KEY)
                    .withColumn("piece", F.spark_partition_id()), "fingerprint-keys")
    sums = sorted(ranged.groupBy("piece").agg(F.sum("n_chars")).collect())
    if not sums:
        return []
    long = max(SLICE_CHARS, -(-sum(s for _, s in sums) // SLICES))
    offsets, before = [], 0
    for piece, s in sums:
        offsets.append((piece, before))
        before += s
    ahead = F.sum("n_chars").over(Window.partitionBy("piece").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, -1))
    at = F.floor((F.col("before") + F.coalesce(ahead, F.lit(0))) / F.lit(long))
    placed = ranged.join(F.broadcast(spark.createDataFrame(offsets, "piece int, before long")), "piece").select(*_KEY, at.alias("at"))
    return sorted(tuple(r["first"]) for r in placed.groupBy("at").agg(F.min(F.struct(*_KEY)).alias("first")).collect())


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, contained_edited double, contained_next double")


def _compared(rows: list[tuple[int | None, str]], after: str) -> pa.RecordBatch:
    """Output rows of (id, text), each followed by the next one and the last by ``after``."""
    texts = [t for _, t in rows] + [after]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    marks, new = sketches(texts), sketches(changed)
    columns = [
        [i for i, _ in rows], [len(t) for t in texts[:-1]],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        [to_text(m) for m in marks[:-1]], [to_text(m) for m in new],
        [likeness(a, b) for a, b in zip(marks, new)], [likeness(a, b) for a, b in zip(marks, marks[1:])],
        [containment(a, b) for a, b in zip(marks, new)], [containment(a, b) for a, b in zip(marks, marks[1:])]]
    kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in _OUT.split(", ")])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slice, guest, doc_id, text) in order; a guest ends its slice."""
    run: list[tuple[int | None, str]] = []
    size = 0
    for batch in batches:
        for first in range(0, batch.num_rows, 64):
            part = batch.slice(first, 64)
            for guest, doc_id, text in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                if run and (guest or size > _RUN):
                    yield _compared(run, text)
                    run, size = [], 0
                if not guest:
                    run.append((doc_id, text))
                    size += len(text)


def fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` (likeness), ``contained_edited``,
    ``contained_next`` (containment of its text in the edited and in the next one)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = plain.select("doc_id", "text", F.col("doc_id").isNotNull().alias("known"),
                         F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("h"))
    starts = spark.sparkContext.broadcast(_slice_starts(spark, keyed.select(*_KEY, F.length("text").cast("long").alias("n_chars"))))

    @F.pandas_udf("array<int>")
    def slices(known: pd.Series, id: pd.Series, h: pd.Series) -> pd.Series:
        """A row's slice and, for the first row of a slice, the one before it (before the first: the last)."""
        keys, out = starts.value, []
        for key in zip(known.tolist(), id.tolist(), h.tolist()):
            at = bisect_right(keys, key) - 1
            out.append([at, (at - 1) % len(keys)] if keys[at] == key else [at])
        return pd.Series(out)

    dealt = keyed.select("doc_id", "text", *_KEY, F.posexplode(slices(*_KEY)).alias("guest", "slice"))
    order = ["slice", "guest", *_KEY, "text"]
    return (dealt.repartition("slice").sortWithinPartitions(*order).select("slice", "guest", "doc_id", "text")
            .mapInArrow(_stream, _OUT))
