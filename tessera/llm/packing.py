"""Best-fit-decreasing packing of tokenised documents into windows of a fixed length.

Documents are tokenised in parallel and cut into full windows plus a remainder. Best-fit decreasing
sees lengths only, so it runs on the histogram of lengths (one count per length, however many
documents there are): lengths are taken in decreasing order and a segment tree indexed by remaining
capacity finds the tightest open windows. Windows that hold the same lengths stay together as one
run, so a step places thousands of equal pieces at once and the result is that of the
piece-by-piece algorithm over the whole corpus. Each piece then finds its place from its rank
among the pieces of its length, which is a per-partition rank plus the counts of the partitions
before it.

Defined cases: a null or empty text is one piece holding the end id. Repeated rows are separate
documents. A null ``doc_id`` is kept. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tessera.llm.common import staged

WINDOW = 1024
END_ID = 0
#: Rows up to which a table of places or counts is broadcast (under 64 MB); larger ones are joined
#: by shuffle.
BROADCAST_ROWS = 1_000_000


# --- tokenising --------------------------------------------------------------------------------

class Encoder:
    """Token ids of a text as little-endian uint32 bytes.

    A byte-level pre-tokenizer always cuts before a space that a non-space follows, so a text
    without longer runs of white space after a space is encoded chunk by chunk, and frequent chunks
    come from a bounded cache. New chunks are encoded many at a time, as one text: a token's bytes
    are known, so the ids of each chunk are told apart by their lengths.
    """

    CACHE = 600_000
    JOINED = 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        self.by_space = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True)
                         and pre.get("use_regex", True) and not spec.get("normalizer"))
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each token
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.cache: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: list[str]) -> dict[str, bytes]:
        inner = [c for c in chunks if c[0] == " "] if self.by_space else []
        whole = [c for c in chunks if c[0] != " "] if self.by_space else chunks
        found = {c: ids.tobytes() for c, ids in zip(whole, self._ids(whole))}
        runs = [inner[i:i + self.JOINED] for i in range(0, len(inner), self.JOINED)]
        for run, ids in zip(runs, self._ids(["".join(run) for run in runs])):
            ends = np.cumsum(self.width[ids])
            wanted = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in run])
            data, at = ids.tobytes(), 0
            for c, end in zip(run, (np.searchsorted(ends, wanted) + 1) * 4):
                found[c] = data[at:end]
                at = end
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        cut: list[list[str]] = []
        missing: dict[str, None] = {}
        cache = self.cache
        for text in texts:
            if self.by_space and text and text[0] != " " and text[-1] != " " and not _WIDE.search(text):
                parts = text.split(" ")
                parts[1:] = [" " + p for p in parts[1:]]
                missing.update((p, None) for p in parts if p not in cache)
            else:
                parts = []
            cut.append(parts)
        found = self._chunks(list(missing))
        if len(cache) < self.CACHE:
            cache.update((k, v) for k, v in found.items() if len(k) <= 64)
        rest = iter(self._ids([t for t, parts in zip(texts, cut) if not parts]))
        get = cache.get
        return [b"".join([get(p) or found[p] for p in parts]) if parts else next(rest).tobytes() for parts in cut]


_WIDE = re.compile(r" \s")
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_PIECES = ("doc_id long, start long, length long, doc_tokens long, part int, rank long, ids binary")


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece; ``rank`` counts the pieces of its length in its partition ``part``."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("part", pa.int32()), ("rank", pa.int64()), ("ids", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                out: list[tuple] = []
                for doc, data in zip(ids[at:at + 256], enc.encode([t or "" for t in texts[at:at + 256]])):
                    data += end
                    total = len(data) // 4
                    for start in range(0, total, window):
                        n = min(window, total - start)
                        out.append((doc, start, n, total, part, seen[n], data[4 * start:4 * (start + n)]))
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(cut, _PIECES)


# --- best fit decreasing -----------------------------------------------------------------------

class OpenWindows:
    """Runs of equal open windows, in a segment tree indexed by remaining capacity."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.any = [0] * (2 * self.size)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, capacity: int) -> None:
        at = self.size + capacity
        self.any[at] = 1 if self.runs.get(capacity) else 0
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def add(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.runs.setdefault(capacity, []).append((first, count))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        run = self.runs[capacity].pop()
        self._mark(capacity)
        return run

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need`` that an open window has."""
        at = self.size + need
        if self.any[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Places as (length, first rank, pieces, first sequence, pieces per sequence, first offset).

    The tightest window stays the tightest after a piece went in while the next equal piece still
    fits, so each window of a run takes as many as fit before the next one is touched.
    """
    open_, places, sequences = OpenWindows(window), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = open_.tightest(length)
            if capacity is None:
                capacity = window
                need = -(-left // (window // length))
                first, count = sequences, need
                sequences += need
            else:
                first, count = open_.take(capacity)
            each = capacity // length
            full = min(count, left // each)
            if full:
                places.append((length, rank, full * each, first, each, window - capacity))
                open_.add(capacity - each * length, first, full)
                rank, left, first, count = rank + full * each, left - full * each, first + full, count - full
            if count and left:  # fewer pieces than the next window of the run would take
                places.append((length, rank, left, first, each, window - capacity))
                open_.add(capacity - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            open_.add(capacity, first, count)
    return places


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, window: int = WINDOW,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids`` (little-endian
    uint32), ``sequence_id``, ``offset``."""
    cut = staged(spark, pieces(docs, tokenizer_path, window, end_id), "pieces")
    counts = staged(spark, cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= window rows
    places = spark.createDataFrame(
        best_fit_decreasing(totals, window),
        "_length long, _rank long, _n long, _sequence long, _each long, _offset long")
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    if counts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    if places.count() <= BROADCAST_ROWS:
        places = F.broadcast(places)
    at = F.col("_before") + F.col("rank")
    ranked = cut.join(firsts, ["part", "length"]).withColumn("_at", at)
    placed = ranked.join(places, (F.col("length") == F.col("_length")) & (F.col("_at") >= F.col("_rank"))
                         & (F.col("_at") < F.col("_rank") + F.col("_n")))
    k = F.col("_at") - F.col("_rank")
    return placed.select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        (F.col("_sequence") + F.floor(k / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (k % F.col("_each")) * F.col("length")).alias("offset"))


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The packed windows: ``sequence_id``, ``n_tokens`` and ``ids`` (array of int), padded to
    ``window`` unless the length is a power of two. A group holds one window at most."""
    def assemble(key, pdf):
        import pandas as pd

        data = b"".join(pdf.sort_values("offset")["ids"])
        ids = np.frombuffer(data, "<u4").astype(np.int32)
        n = len(ids)
        if n & (n - 1):
            ids = np.pad(ids, (0, window - n), constant_values=pad_id)
        return pd.DataFrame({"sequence_id": [key[0]], "n_tokens": [n], "ids": [ids]})

    schema = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(assemble, schema)
