"""Vectors as exact integers: what the two vector operators share."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged

#: A group with more than this share of the rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def finite(vector: Column) -> Column:
    """True for a vector without a null, NaN or infinite component; false for a null vector."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(ok, F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """Every component x as the integer floor(scale * x), with x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column without nulls, all lists ``width`` long, as rows of an array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The reverse of ``matrix``."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.ravel(), kind))


def check_range(x: np.ndarray) -> None:
    """Squared distances are longs: components that could overflow one are refused by name."""
    most = isqrt((2**63 - 1) // max(1, x.shape[1])) // 2
    if x.size and (x.max() > most or x.min() < -most):
        raise ValueError(f"a component is beyond {most}: squared distances would not fit a long")


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (long) of integer rows ``x`` to integer rows ``c``. Where every sum
    stays below 2**52 the products are taken in doubles, which is as exact and much faster."""
    most = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if 4 * int(most) ** 2 * x.shape[1] < 2**52:
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(c)), np.int64)
    for j, row in enumerate(c):
        d = x - row
        out[:, j] = (d * d).sum(1)
    return out


def with_group_total(spark: SparkSession, rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``rows`` (staged) with the sum of ``value`` over all rows of an equal ``key``, null keys
    together. Totals of hot keys, of which there are at most ``1 / HOT_SHARE``, are broadcast; the
    other rows meet theirs in a shuffle, in which no key has more than ``HOT_SHARE`` of them."""
    n = rows.count()
    totals = staged(spark, rows.groupBy(F.col(key).alias("_key")).agg(
        F.sum(F.col(value).cast("decimal(38,0)")).cast("long").alias(out), F.count("*").alias("_n")), "group-totals")
    hot = F.broadcast(totals.filter(F.col("_n") > n * HOT_SHARE).drop("_n"))
    cold = totals.filter(F.col("_n") <= n * HOT_SHARE).drop("_n")
    same = F.col(key).eqNullSafe(F.col("_key"))
    return (rows.join(hot, same).drop("_key")
            .unionByName(rows.join(hot, same, "left_anti").join(cold, same).drop("_key")))
