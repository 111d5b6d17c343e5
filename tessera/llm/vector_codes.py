"""Vector code compression (product codes) with active-entry Lloyd rounds, exact in integers.

Vectors become integers floor(scale * x) and are cut into equal parts; each part position has a
codebook. A pass stores, for every part, its entry and the exact squared distance to it. After the
entries are replaced by their parts' means, some have moved and some have not. A part whose entry
stayed fixed still has its stored distance, and no other fixed entry can have come closer, so it is
compared with the moved entries only; a part whose entry moved is compared with all. Of equal
distances the lower index wins in both cases, as in a whole scan.

A pass writes the new state and, from the same read, one row of exact sums for each used entry and
task. Codebooks (parts x entries rows) are all that moves between driver and tasks.

Defined cases: rows with a null vector or a null or non-finite component are left out. The parts are
cut for the commonest length of the others (of equally common ones the smallest), if that is a
positive multiple of the number of parts; a vector of another length stays with null code and error.
With fewer vectors than entries the codebooks are shorter; without vectors there is no row. Repeated
vec_ids are rows of their own (starts: by vec_id, null ones last, then components). Extra columns are
ignored. Components whose distances could overflow a long stop the job with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.vectors import check_range, finite, floored, lists, matrix, squared_distances, with_group_total
from tessera.session import work_path

_STATE = ("vec_id long, label int, x array<long>, codes array<short>, dists array<long>, "
          "slot int, n long, total array<long>, kind int")
_ROWS, _SUMS = 0, 1
_SLICE = 4096


def rescan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest index of the nearest entry, its squared distance) by comparing with all entries."""
    d = squared_distances(x, book)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


def reassign(x: np.ndarray, book: np.ndarray, moved: np.ndarray, at: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Entries and distances of parts after ``moved`` entries changed, and the comparisons made."""
    at, dist = at.copy(), dist.copy()
    lost, active = np.flatnonzero(moved[at]), np.flatnonzero(moved)
    fixed = np.flatnonzero(~moved[at])
    if len(active) and len(fixed):
        near, d = rescan(x[fixed], book[active])
        near = active[near]
        better = (d < dist[fixed]) | ((d == dist[fixed]) & (near < at[fixed]))
        at[fixed[better]], dist[fixed[better]] = near[better], d[better]
    if len(lost):
        at[lost], dist[lost] = rescan(x[lost], book)
    return at, dist, len(fixed) * len(active) + len(lost) * len(book)


def _pass(spark: SparkSession, state: DataFrame, books: np.ndarray, moved: np.ndarray | None, sums: bool) -> tuple[DataFrame, DataFrame]:
    """(new state, sums per used entry): assign every part to ``books`` (parts, entries, width)."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for big in batches:
            for first in range(0, big.num_rows, _SLICE):
                batch = big.slice(first, _SLICE)
                x = matrix(batch.column(2), parts * width)
                check_range(x)
                cut = x.reshape(len(x), parts, width)
                if moved is None:
                    codes, dists = np.empty((len(x), parts), np.int16), np.empty((len(x), parts), np.int64)
                else:
                    codes, dists = matrix(batch.column(3), parts).copy(), matrix(batch.column(4), parts).copy()
                for p in range(parts):
                    if moved is None:
                        codes[:, p], dists[:, p] = rescan(cut[:, p], books[p])
                    elif moved[p].any():
                        codes[:, p], dists[:, p], _ = reassign(cut[:, p], books[p], moved[p], codes[:, p], dists[:, p])
                if sums:
                    slot = (np.arange(parts) * entries + codes).ravel()
                    n += np.bincount(slot, minlength=len(n))
                    np.add.at(total, slot, cut.reshape(-1, width))
                yield _batch(len(x), vec_id=batch.column(0), label=batch.column(1), x=batch.column(2),
                             codes=lists(codes, pa.int16()), dists=lists(dists, pa.int64()), kind=_ROWS)
        used = np.flatnonzero(n)
        if len(used):
            yield _batch(len(used), slot=pa.array(used.astype(np.int32)), n=pa.array(n[used]),
                         total=lists(total[used], pa.int64()), kind=_SUMS)

    path = work_path(spark, "llm-codes")
    state.mapInArrow(run, _STATE).write.partitionBy("kind").parquet(path, compression="zstd")
    back = spark.read.schema(_STATE).parquet(path)
    return (back.filter(F.col("kind") == _ROWS).select("vec_id", "label", "x", "codes", "dists"),
            back.filter(F.col("kind") == _SUMS).select("slot", "n", "total"))


_KINDS = {"vec_id": pa.int64(), "label": pa.int32(), "x": pa.list_(pa.int64()), "codes": pa.list_(pa.int16()),
          "dists": pa.list_(pa.int64()), "slot": pa.int32(), "n": pa.int64(), "total": pa.list_(pa.int64())}


def _batch(size: int, kind: int, **columns: pa.Array) -> pa.RecordBatch:
    whole = [columns.get(c, pa.nulls(size, t)) for c, t in _KINDS.items()]
    return pa.RecordBatch.from_arrays([*whole, pa.array(np.full(size, kind, np.int32))], names=[*_KINDS, "kind"])


def compress(spark: SparkSession, df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2,
             scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id``, ``label``, ``code``, ``error`` of each usable vector of ``df`` (``vec_id``,
    ``embedding``, ``label``), the codebooks (parts, entries, width))."""
    kept = df.filter(finite(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        floored(F.col("embedding"), scale).alias("x"))
    common = kept.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = common["dims"] if common and common["dims"] % parts == 0 else 0
    others = kept.filter(F.size("x") != dims) if dims else kept
    odd = others.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not dims:
        return odd, np.zeros((parts, 0, 0), np.int64)
    state = kept.filter(F.size("x") == dims)
    first = state.select(F.col("vec_id").isNull().alias("last"), "vec_id", "x").orderBy("last", "vec_id", "x").limit(entries).collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2).copy()
    state, moved = state.withColumns({"codes": F.lit(None).cast("array<short>"), "dists": F.lit(None).cast("array<long>")}), None
    for at in range(rounds + 1):
        state, sums = _pass(spark, state, books, moved, at < rounds)
        if at < rounds:
            whole = (sums.select("slot", "n", F.posexplode("total").alias("at", "v")).groupBy("slot", "at")
                     .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.sum("n").alias("n")).collect())
            new = books.copy()
            for r in whole:
                new[r["slot"] // books.shape[1], r["slot"] % books.shape[1], r["at"]] = int(r["v"]) // r["n"]
            moved, books = (new != books).any(2), new
    code = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")))
    error = F.aggregate("dists", F.lit(0).cast("long"), lambda a, b: a + b)
    return state.select("vec_id", "label", code.alias("code"), error.alias("error")).unionByName(odd), books


def codes(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per usable vector: ``vec_id``, ``code``, ``error``, ``label_error`` (null if no vector
    of the label has a code), ``codebooks_sha256``."""
    rows, books = compress(spark, df)
    rows = with_group_total(spark, staged(spark, rows, "coded"), "label", "error", "label_error")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
