"""Centroid clustering with PCA-rotated filtering, exact in integers.

Vectors become integers floor(scale * x). A first pass sums their second moments; the leading
eigenvectors of that (dims x dims) matrix are the rotation. Every vector is staged with its leading
rotated coordinates and the norm of what the rotation leaves out (the residual). Since

    |v - c|^2  >=  |projected v - projected c|^2 + (residual norm of v - residual norm of c)^2

a vector needs whole distances only to centroids whose bound, less a margin for rounding, does not
exceed the distance of the centroid with the lowest bound. These survivors are compared in integers,
so neither the rotation nor its rounding touches the result; ties go to the smaller number.

Centroids, k rows, are all that moves between driver and tasks; a task returns one row of exact sums
for each centroid.

Defined cases: vectors of another length than ``dims``, null ones, and ones with a null or non-finite
component are left out. With fewer than k vectors there are as many centroids as vectors, and no
vector, no row. Repeated vec_ids are rows of their own (equal start hashes: by components); a null
vec_id is clustered and never a start. Extra columns are ignored. Components whose distances could
overflow a long stop the job with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.vectors import check_range, finite, floored, lists, matrix

#: Rounding in doubles is below 1e-12 of the squared norms; the bound gives way by this share.
MARGIN = 1e-9


def kept_vectors(df: DataFrame, scale: int, dims: int) -> DataFrame:
    """``vec_id``, ``x``: the usable vectors as integers."""
    usable = (F.size("embedding") == dims) & finite(F.col("embedding"))
    return df.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"), floored(F.col("embedding"), scale).alias("x"))


def starts(kept: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``1:<vec_id>``, in that order."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = kept.filter("vec_id IS NOT NULL").select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return np.array([r["x"] for r in first], np.int64)


def principal_axes(kept: DataFrame, dims: int, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean rounded to integers, dims x leading axes) of all vectors, from sums that tasks add up."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = matrix(batch.column(0), dims).astype(np.float64)
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        if total[dims, dims]:
            at = np.arange(dims + 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(at, dims + 1)), pa.array(np.tile(at, dims + 1)),
                                              pa.array(total.ravel())], names=["i", "j", "v"])

    sums = np.zeros((dims + 1, dims + 1))
    for r in kept.select("x").mapInArrow(moments, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r["i"], r["j"]] = r["v"]
    n = max(1.0, sums[dims, dims])
    mean = sums[dims, :dims] / n
    _, axes = np.linalg.eigh(sums[:dims, :dims] / n - np.outer(mean, mean))
    return np.rint(mean).astype(np.int64), np.ascontiguousarray(axes[:, ::-1][:, :leading])


def rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leading coordinates, residual norm) of integer rows."""
    y = (x - mean).astype(np.float64)
    lead = y @ axes
    return lead, np.linalg.norm(y - lead @ axes.T, axis=1)


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, c: np.ndarray, c_lead: np.ndarray,
            c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, squared distance, centroids compared in integers) of each row."""
    own = (lead * lead).sum(1) + rest * rest
    other = (c_lead * c_lead).sum(1) + c_rest * c_rest
    bound = ((lead[:, None, :] - c_lead) ** 2).sum(2) + (rest[:, None] - c_rest) ** 2 - MARGIN * (own[:, None] + other)
    at = bound.argmin(1)
    diff = x - c[at]
    best, compared, first = (diff * diff).sum(1), np.ones(len(x), np.int32), at.copy()
    for j in range(len(c)):
        rows = np.flatnonzero((bound[:, j] <= best) & (first != j))
        diff = x[rows] - c[j]
        d = (diff * diff).sum(1)
        better = (d < best[rows]) | ((d == best[rows]) & (j < at[rows]))
        at[rows[better]], best[rows[better]] = j, d[better]
        compared[rows] += 1
    return at, best, compared


def cluster(spark: SparkSession, df: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64,
            leading: int = 32) -> DataFrame:
    """One row per usable vector of ``df`` (``vec_id``, ``embedding``): ``vec_id``, ``cluster``,
    ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``, ``n_compared`` (centroids it
    was compared with in integers in the last assignment)."""
    kept = kept_vectors(df, scale, dims)
    mean, axes = principal_axes(kept, dims, leading)
    shape = "vec_id long, x array<long>, lead array<double>, rest double"

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dims)
            check_range(x)
            lead, rest = rotated(x, mean, axes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(lead, pa.float64()), pa.array(rest)],
                                             names=["vec_id", "x", "lead", "rest"])

    rows = staged(spark, kept.mapInArrow(rotate, shape), "rotated", codec="zstd")
    c = starts(rows, k)

    def assigned(batch: pa.RecordBatch, c: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray):
        x = matrix(batch.column(1), dims)
        return x, nearest(x, matrix(batch.column(2), axes.shape[1]), batch.column(3).to_numpy(), c, c_lead, c_rest)

    for _ in range(rounds if len(c) else 0):
        c_lead, c_rest = rotated(c, mean, axes)

        def sums(batches: Iterator[pa.RecordBatch], c=c, c_lead=c_lead, c_rest=c_rest) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(c.shape, np.int64), np.zeros(len(c), np.int64)
            for batch in batches:
                x, (at, _, _) = assigned(batch, c, c_lead, c_rest)
                n += np.bincount(at, minlength=len(c))
                np.add.at(total, at, x)
            used = np.flatnonzero(n)
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), lists(total[used], pa.int64())],
                                                 names=["cluster", "n", "total"])

        partial = rows.mapInArrow(sums, "cluster long, n long, total array<long>")
        whole = (partial.select("cluster", "n", F.posexplode("total").alias("at", "v")).groupBy("cluster", "at")
                 .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.sum("n").alias("n")).collect())
        c = c.copy()
        for r in whole:
            c[r["cluster"], r["at"]] = int(r["v"]) // r["n"]

    c_lead, c_rest = rotated(c, mean, axes) if len(c) else (None, None)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if len(c) else ():
            _, (at, d, compared) = assigned(batch, c, c_lead, c_rest)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int32)), pa.array(d), pa.array(compared)],
                                             names=["vec_id", "cluster", "distance", "n_compared"])

    done = staged(spark, rows.mapInArrow(last, "vec_id long, cluster int, distance long, n_compared int"), "clustered")
    sizes = {r["cluster"]: int(r["d"]) for r in done.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    facts = [(j, d, sum(sizes.values()), hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest())
             for j, d in sizes.items()]
    told = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_compared")
