"""Exact dedup of a new batch against immutable snapshots of earlier batches.

Every snapshot carries static binary-fuse filters over its digests, one per bucket. A new batch is
reduced to distinct digests (its own duplicates are grouped apart, map-side first), screened by the
snapshot's filters, and only the positives are joined with the snapshot's exact buckets. Texts
that share a digest are then compared byte by byte; where they differ (a digest collision) rows are
grouped by their full text instead.

Defined cases: a null text counts as the empty text. Of equal texts the smallest ``doc_id`` stays;
a null ``doc_id`` sorts after every other. Rows that repeat both text and ``doc_id`` are separate
rows of the group, of which one stays. Empty tables give an empty result. Extra columns are
ignored by ``exact_groups`` and carried through by ``drop_duplicates_exact``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, fresh, maybe_in, split_by, staged
from tessera.llm.words import mix

#: Digests a bucket holds on average, which bounds what one filter task keeps in memory.
BUCKET_DIGESTS = 50_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, " ")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


# --- binary-fuse filter -----------------------------------------------------------------------

def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> np.ndarray:
    """Three slots per key, in three consecutive segments."""
    h = mix(keys ^ np.uint64(seed))
    start = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    g = mix(h + np.uint64(0x632BE59BD9B4E019))
    mask = np.uint64(segment - 1)
    return np.stack([
        (start + np.uint64(j)) * np.uint64(segment) + ((g >> np.uint64(20 * j)) & mask)
        for j in range(3)]).astype(np.int64)


def _prints(keys: np.ndarray, seed: int) -> np.ndarray:
    return (mix(keys + np.uint64(seed) * np.uint64(3)) >> np.uint64(40)).astype(np.uint16)


def _shape(n: int) -> tuple[int, int]:
    segment = 1 << int(min(18, max(2, np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    size = n * max(1.125, 0.875 + 0.25 * np.log(1_000_000) / np.log(max(n, 2))) + 8
    return segment, max(1, int(np.ceil(size / segment)))


def build_fuse(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, start segments, 16-bit slots) of the distinct 64-bit ``keys``.

    Peeling takes all slots with one key at a time, round by round; the slots are then filled in
    the reverse order of the rounds. A seed that does not peel is replaced by the next one.
    """
    keys = np.unique(np.asarray(keys, np.uint64))
    segment, segments = _shape(len(keys))
    for seed in range(1, 200):
        if seed % 20 == 0:
            segments += max(1, segments // 4)
        with np.errstate(over="ignore"):
            at, prints = _places(keys, seed, segment, segments), _prints(keys, seed)
        slots = (segments + 2) * segment
        count = np.bincount(at.ravel(), minlength=slots)
        acc = np.zeros(slots, np.int64)  # xor of the key numbers in each slot
        for j in range(3):
            np.bitwise_xor.at(acc, at[j], np.arange(len(keys)))
        rounds, alone, left = [], np.flatnonzero(count == 1), len(keys)
        while len(alone):
            owner = acc[alone]
            owner, first = np.unique(owner, return_index=True)
            rounds.append((owner, alone[first]))
            left -= len(owner)
            touched = at[:, owner]
            np.subtract.at(count, touched.ravel(), 1)
            for j in range(3):
                np.bitwise_xor.at(acc, touched[j], owner)
            near = np.unique(touched)
            alone = near[count[near] == 1]
        if left == 0:
            table = np.zeros(slots, np.uint16)
            for owner, slot in reversed(rounds):
                p = at[:, owner]
                table[slot] = 0
                table[slot] = prints[owner] ^ table[p[0]] ^ table[p[1]] ^ table[p[2]]
            return seed, segment, segments, table.tobytes()
    raise RuntimeError("no seed peels these keys")


def in_fuse(keys: np.ndarray, seed: int, segment: int, segments: int, table: bytes) -> np.ndarray:
    """True for every key of the filter, and for about one other key in 65,536."""
    keys, slots = np.asarray(keys, np.uint64), np.frombuffer(table, np.uint16)
    with np.errstate(over="ignore"):
        at = _places(keys, seed, segment, segments)
        return _prints(keys, seed) == slots[at[0]] ^ slots[at[1]] ^ slots[at[2]]


# --- snapshots ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Snapshot:
    """Exact buckets (``_key``, ``_digest``, ``_min_id``, ``_n``) and one filter per bucket."""

    exact: DataFrame
    filters: DataFrame
    buckets: int


def _keyed(digests: DataFrame) -> DataFrame:
    return digests.withColumn("_key", F.xxhash64("_digest"))


def _grouped(keys: DataFrame) -> DataFrame:
    return keys.groupBy("_digest").agg(F.min("_id").alias("_min_id"), F.count("*").alias("_n"))


def build_snapshot(spark: SparkSession, keys: DataFrame, expected: int) -> Snapshot:
    """An immutable snapshot of rows (``_id``, ``_digest``). ``expected`` is the number of rows on
    the larger of the two sides; it sets how many buckets there are."""
    buckets = max(1, -(-expected // BUCKET_DIGESTS))
    exact = staged(spark, _keyed(_grouped(keys)), "snapshot")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, slots = build_fuse(pdf["_key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"_bucket": [pdf["_bucket"].iloc[0]], "_seed": [seed],
                             "_segment": [segment], "_segments": [segments], "_slots": [slots]})

    by_bucket = exact.select("_key", F.pmod("_key", F.lit(buckets)).alias("_bucket"))
    filters = by_bucket.groupBy("_bucket").applyInPandas(
        build, "_bucket long, _seed long, _segment long, _segments long, _slots binary")
    return Snapshot(exact, staged(spark, filters, "fuse"), buckets)


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The distinct digests of the batch that the snapshot's filters cannot rule out."""
    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return left.iloc[:0][["_key", "_digest", "_min_id", "_n"]]
        f = right.iloc[0]
        hit = in_fuse(left["_key"].to_numpy().view(np.uint64), int(f["_seed"]),
                      int(f["_segment"]), int(f["_segments"]), f["_slots"])
        return left.loc[hit, ["_key", "_digest", "_min_id", "_n"]]

    keyed = batch.withColumn("_bucket", F.pmod("_key", F.lit(snapshot.buckets)))
    return keyed.groupBy("_bucket").cogroup(snapshot.filters.groupBy("_bucket")).applyInPandas(
        probe, "_key long, _digest string, _min_id long, _n long")


# --- dedup -------------------------------------------------------------------------------------

def digest_groups(spark: SparkSession, snapshot_keys: DataFrame, batch_keys: DataFrame,
                  expected: int) -> DataFrame:
    """One row per digest over both sides: ``_digest``, ``_min_id``, ``_n``."""
    snapshot = build_snapshot(spark, snapshot_keys, expected)
    batch = staged(spark, _keyed(_grouped(batch_keys)), "batch")
    positives = screen(batch, snapshot).select(
        "_digest", F.col("_min_id").alias("_b_min"), F.col("_n").alias("_b_n"))
    met = staged(spark, positives.join(snapshot.exact, "_digest").select(
        "_digest", F.least("_min_id", "_b_min").alias("_min_id"),
        (F.col("_n") + F.col("_b_n")).alias("_n")), "positives")
    known = met.select("_digest")
    return (snapshot.exact.join(known, "_digest", "left_anti").select("_digest", "_min_id", "_n")
            .unionByName(batch.join(known, "_digest", "left_anti").select("_digest", "_min_id", "_n"))
            .unionByName(met))


def exact_groups(spark: SparkSession, docs: DataFrame, digest=sha256_hex) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    The lower half of the id range is taken as the snapshot of earlier batches, the rest (and
    rows without an id) as the new batch; both are deduplicated whole.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), normalised(F.col("text")).alias("_norm"))
    keys = staged(spark, rows.select("_id", digest(F.col("_norm")).alias("_digest"),
                                     sha256_hex(F.col("_norm")).alias("_sha")), "digests")
    low, high, expected = keys.agg(F.min("_id"), F.max("_id"), F.count("*")).first()
    cut = 0 if low is None else low + (high - low) // 2
    old = F.coalesce(F.col("_id") <= F.lit(cut), F.lit(False))
    groups = staged(spark, digest_groups(
        spark, keys.filter(old).select("_id", "_digest"), keys.filter(~old).select("_id", "_digest"),
        expected), "groups")

    many = staged(spark, _colliding(rows, groups, digest), "colliding")
    if many.isEmpty():
        by, group_key = keys.withColumn("_group", F.col("_digest")), groups.withColumnRenamed("_digest", "_group")
    else:  # digests that stand for several texts: group their rows by the text itself
        texts = (rows.withColumn("_digest", digest(F.col("_norm"))).join(many, "_digest", "left_semi")
                 .select("_id", F.col("_norm").alias("_group"), sha256_hex(F.col("_norm")).alias("_sha")))
        plain = keys.join(many, "_digest", "left_anti").select("_id", F.col("_digest").alias("_group"), "_sha")
        group_key = (groups.join(many, "_digest", "left_anti").select(F.concat(F.lit("d"), "_digest").alias("_group"), "_min_id", "_n")
                     .unionByName(texts.groupBy(F.concat(F.lit("t"), "_group").alias("_group"))
                                  .agg(F.min("_id").alias("_min_id"), F.count("*").alias("_n"))))
        by = (plain.withColumn("_group", F.concat(F.lit("d"), "_group"))
              .unionByName(texts.withColumn("_group", F.concat(F.lit("t"), "_group"))))

    # Rows that repeat (group, id) are counted first, so that exactly one of them stays.
    single = by.groupBy("_group", "_id", "_sha").agg(F.count("*").alias("_copies"))
    out = single.join(group_key, "_group").select(
        F.col("_id").alias("doc_id"), F.col("_min_id").alias("keep_id"),
        F.col("_n").alias("group_size"), F.col("_id").eqNullSafe(F.col("_min_id")).alias("_stays"),
        F.col("_sha").alias("text_sha256"), F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
    return out.select("doc_id", "keep_id", "group_size",
                      (F.col("_stays") & (F.col("_copy") == 1)).alias("kept"), "text_sha256")


def _colliding(rows: DataFrame, groups: DataFrame, digest) -> DataFrame:
    """Byte check of the shared digests: those that stand for more than one text. Texts are grouped
    by all their bytes, copies map-side first, so a hot text costs one row per task."""
    shared = groups.filter("_n > 1").select("_digest")
    texts = maybe_in(rows.select(digest(F.col("_norm")).alias("_digest"), "_norm"), "_digest", shared).distinct()
    return texts.groupBy("_digest").agg(F.count("*").alias("_texts")).filter("_texts > 1").select("_digest")


def drop_duplicates_exact(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Pipeline form: of equal texts the row with the smallest ``doc_id`` stays, columns as given."""
    groups = staged(spark, exact_groups(spark, docs), "exact")
    stays = groups.filter("kept AND group_size > 1").select(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_keep_sha"))
    sha, id_ = fresh(docs, "sha"), fresh(docs, "id")
    tagged = docs.withColumn(sha, sha256_hex(normalised(F.col("text")))).withColumn(id_, F.col("doc_id").cast("long"))
    shared, alone = split_by(tagged, sha, stays.select("_keep_sha"))
    same = shared[id_].eqNullSafe(stays["_keep"]) & (shared[sha] == stays["_keep_sha"])
    single = groups.filter("group_size = 1").select(F.col("text_sha256").alias("_keep_sha"))
    kept = shared.join(stays, same, "left_semi").dropDuplicates([id_, sha]).unionByName(
        shared.join(maybe_in(single, "_keep_sha", stays.select("_keep_sha")), shared[sha] == F.col("_keep_sha"), "left_semi"))
    return alone.unionByName(kept).drop(sha, id_)
