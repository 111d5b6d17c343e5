"""Exact n-gram Jaccard self-join by grouped prefix filtering.

A document's set holds its distinct 5-word shingles. Two documents link when the sets' Jaccard
similarity is 0.8 or more. Shingles are ordered by how common they are (a hashed count over all
documents, levelled; then by hash), so the prefixes, which two similar sets must share a shingle
of, hold rare shingles. Then:

1. Documents with the same whole set collapse into one *member*, members with the same size and
   prefix into one *group*.
2. Group pairs that share a prefix shingle pass the length and the positional filter.
3. Pairs that remain are expanded to their members, bounded by hash bitmaps of the sets, and
   verified on the whole sets.

Only components are needed, so pairs are met in two steps: every group against the foremost group
of each of its lists (linear in the postings), and then the pairs whose components are still apart.
A large set of near copies is settled by the first step. Every pair that the filters cannot rule
out is either verified or already connected, so no link between components is lost.

Rows are numbered once and staged with their numbers; every later job reads that table, so numbers
stay whatever the splits of ``docs`` are when a job reads it.

Defined cases: a text with fewer than five words is one shingle, its whole word sequence; null,
empty and white texts have the empty set and link with nothing. Repeated rows and repeated
``doc_id`` are separate rows. A null ``doc_id`` is kept; its component is the smallest non-null id
of the component, or null. Extra columns are ignored by ``near_groups`` and carried through by
``keep_one_per_group``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import fresh, maybe_in, staged, without
from tessera.llm.components import components
from tessera.llm.words import batch_shingles, batch_words, mix

SHINGLE_WORDS = 5
#: Buckets of the hashed shingle count: at least so many, and at most so many (one byte each when
#: broadcast, so 64 MB bound what an executor receives).
MIN_BUCKETS, MAX_BUCKETS = 1 << 18, 1 << 26
#: Bits of the hash bitmap that bounds the overlap of two sets.
BITMAP = 2048
_CHUNK = 1 << 16


def _batches(column: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(shingle hashes, text, number of texts) in slices of at most 512 texts and about 4 MB, so
    that working arrays stay small whatever the batch."""
    for first in range(0, len(column), 512):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in column.slice(first, 512).to_pylist()]
        at = 0
        while at < len(raw):
            end, size = at, 0
            while end < len(raw) and (end == at or size + len(raw[end]) <= 4_000_000):
                size += len(raw[end])
                end += 1
            words, doc, *_ = batch_words(raw[at:end])
            yield *batch_shingles(words, doc, end - at, k), end - at
            at = end


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for hashes, doc, n in _batches(column, k):
        cut = np.searchsorted(doc, np.arange(n + 1))
        for i in range(n):
            s = np.sort(hashes[cut[i]:cut[i + 1]])
            yield s[np.flatnonzero(np.diff(s, prepend=~s[:1]))] if len(s) else s


def _packed(chunk: int, counts: np.ndarray) -> tuple[int, int, int, bytes]:
    """A chunk of counts in the fewest bytes per count, compressed."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or counts.max() < 1 << 8 * w)
    return int(chunk), int(counts.sum()), width, zlib.compress(counts.astype(f"<u{width}").tobytes(), 1)


def count_sketch(docs: DataFrame, buckets: int, k: int) -> DataFrame:
    """(``chunk``, ``total``, ``width``, ``counts``): how often shingles of each hash bucket occur. Partitions
    are added up locally first and send one compressed row per chunk of buckets; they meet in two
    steps, so that a share of the partials is in one task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.uint32)
        for batch in batches:
            for hashes, _, _ in _batches(batch.column(0), k):
                np.add.at(total, (hashes & np.uint64(buckets - 1)).astype(np.int64), np.uint32(1))
        for at in range(0, buckets, _CHUNK):
            if total[at:at + _CHUNK].any():
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in _packed(at // _CHUNK, total[at:at + _CHUNK])],
                                                 names=["chunk", "total", "width", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), f"<u{w}").astype(np.uint64) for w, c in zip(pdf["width"], pdf["counts"]))
        return pd.DataFrame([_packed(pdf["chunk"].iloc[0], total)], columns=["chunk", "total", "width", "counts"])

    kind = "chunk long, total long, width long, counts binary"
    partial = docs.select("text").mapInArrow(count, kind).withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(16)))
    return partial.groupBy("chunk", "part").applyInPandas(add, kind).groupBy("chunk").applyInPandas(add, kind)


def shingle_levels(docs: DataFrame, buckets: int, k: int) -> np.ndarray:
    """One byte per bucket: 0 for a count near or below the mean, then the doublings above it."""
    sketch = staged(docs.sparkSession, count_sketch(docs, buckets, k), "sketch")
    unit = 2 * (sketch.agg(F.sum("total")).first()[0] or 0) / buckets + 16
    levels = np.zeros(buckets, np.uint8)
    for row in sketch.toLocalIterator():
        part = np.frombuffer(zlib.decompress(row["counts"]), f"<u{row['width']}")
        levels[row["chunk"] * _CHUNK:][:len(part)] = np.log2(np.maximum(part / unit, 0.5)) + 1
    return levels


def prefix_length(n: int, percent: int) -> int:
    """A set of ``n`` shares one of so many foremost shingles with every set it links with."""
    return n - (n * percent + 99) // 100 + 1


def _fingerprint(values: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(mix(values + np.uint64(len(values))).sum(dtype=np.uint64, keepdims=True))[0].astype(np.int64))


def _front(s: np.ndarray, level: np.ndarray, p: int) -> tuple[np.ndarray, int]:
    """The ``p`` foremost shingles of a set and how many of them have level 0. Levels come first,
    then scrambled hashes, which are distinct: the order is total and the same for every set."""
    cold = s[level == 0]
    if len(cold) < p:
        rank = np.lexsort((mix(s), level))
        return s[rank[:p]], len(cold)
    rank = mix(cold)
    first = np.argpartition(rank, p - 1)[:p]
    return cold[first[np.argsort(rank[first])]], p


def _bitmap(s: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITMAP, np.uint8)
    bits[(s >> np.uint64(64 - BITMAP.bit_length() + 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def signatures(docs: DataFrame, levels, buckets: int, percent: int, k: int) -> DataFrame:
    """One row per document: ``row``, ``id``, ``n``, ``set_fp`` (of the whole set), ``group_fp``
    (of size and prefix), ``prefix``, ``cold`` (prefix shingles of level 0) and ``bits``, the hash
    bitmap of the set. ``levels`` is the broadcast of ``shingle_levels``."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in batches:
            n, sets, groups, prefixes, cold, bits = [], [], [], [], [], []
            for s in _sets(batch.column(2), k):
                front, c = _front(s, level[(s & np.uint64(buckets - 1)).astype(np.int64)],
                                  prefix_length(len(s), percent)) if len(s) else (s, 0)
                n.append(len(s))
                sets.append(_fingerprint(s))
                groups.append(_fingerprint(np.append(front, np.uint64(len(s)))))
                prefixes.append(front.view(np.int64))
                cold.append(c)
                bits.append(_bitmap(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(sets, pa.int64()),
                 pa.array(groups, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(cold, pa.int32()),
                 pa.array(bits, pa.list_(pa.int64()))],
                names=["row", "id", "n", "set_fp", "group_fp", "prefix", "cold", "bits"])

    return docs.select("row", "id", "text").mapInArrow(
        sign, "row long, id long, n int, set_fp long, group_fp long, prefix array<long>, cold int, bits array<long>")


def _alike(both, percent: int):
    return both * (100 + percent) >= F.lit(percent) * (F.col("xn") + F.col("yn"))


def _verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs of rows (``a``, ``b``) whose whole sets reach the threshold.

    The bitmaps bound the overlap first: a bit that only one set has is an element that only this
    set has. The sets of the rows that remain are built anew from their texts."""
    spark = pairs.sparkSession
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()

    def side(end: str, letter: str) -> DataFrame:
        return sets.select(F.col("row").alias(end), F.col("n").alias(letter + "n"), F.col("bits").alias(letter + "bits"))

    def only(own: str, other: str):
        return F.aggregate(F.zip_with(own, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))),
                           F.lit(0), lambda total, x: total + x)
    most = F.least(F.col("xn") - only("xbits", "ybits"), F.col("yn") - only("ybits", "xbits"))
    close = staged(spark, pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").filter(_alike(most, percent))
                   .select("a", "b", "xn", "yn"), "close")
    wanted = close.select(F.col("a").alias("row")).unionByName(close.select(F.col("b").alias("row"))).distinct()
    texts = maybe_in(docs.select("row", "text"), "row", wanted)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = [s.view(np.int64) for s in _sets(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(full, pa.list_(pa.int64()))], names=["row", "s"])

    full = staged(spark, texts.mapInArrow(build, "row long, s array<long>").join(wanted, "row", "left_semi"), "full")
    both = F.size(F.array_intersect("sa", "sb"))
    return (close.join(full.select(F.col("row").alias("a"), F.col("s").alias("sa")), "a")
            .join(full.select(F.col("row").alias("b"), F.col("s").alias("sb")), "b")
            .filter(_alike(both, percent)).select("a", "b"))


def _passes(percent: int):
    """The length and the positional filter on two postings of one shingle (``x`` and ``y``)."""
    fits = F.lit(100) * F.least("xn", "yn") >= F.lit(percent) * F.greatest("xn", "yn")
    return fits & _alike(F.least(F.col("xn") - F.col("xpos"), F.col("yn") - F.col("ypos")), percent)


def _lists(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The postings of the prefix shingles that two groups or more share: ``shingle``, ``grp``,
    ``n``, ``pos``, ``front`` (the ``pos``, ``n``, ``grp`` of the list's foremost group: the one
    with the fewest shingles of its own before this one, so the likely original of near copies).

    A level-0 shingle occurs a bounded number of times (by the hashed count), so its list is made
    by one shuffle. Lists of commoner shingles have no such bound: they are counted map-side first
    and met again by a join that Spark can split."""
    leaders = sets.join(members.filter("row = grp").select("row"), "row", "left_semi")
    fields = [F.col("row").alias("grp"), "n"]
    rare = leaders.select(*fields, F.posexplode(F.expr("slice(prefix, 1, cold)")).alias("pos", "shingle"))
    own = W.partitionBy("shingle")
    rare = rare.withColumn("df", F.count("*").over(own)).withColumn("front", F.min(F.struct("pos", "n", "grp")).over(own)).filter("df > 1")
    common = leaders.filter("cold < size(prefix)").select(
        *fields, F.posexplode(F.expr("slice(prefix, cold + 1, size(prefix))")).alias("at", "shingle"), "cold") \
        .select("grp", "n", (F.col("at") + F.col("cold")).alias("pos"), "shingle")
    sizes = common.groupBy("shingle").agg(F.count("*").alias("df"), F.min(F.struct("pos", "n", "grp")).alias("front")).filter("df > 1")
    cols = ["shingle", "grp", "n", "pos", "front"]
    return rare.select(*cols).unionByName(common.join(sizes, "shingle").select(*cols))


def links(spark: SparkSession, sets: DataFrame, docs: DataFrame, percent: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(``members``, ``labels``): a member is a distinct non-empty set, named by its smallest row;
    ``grp`` is the smallest member with its size and prefix. ``labels`` (``node``, ``label``) gives
    the component of every member that links with another one."""
    distinct = sets.filter("n > 0").groupBy("set_fp", "n", "group_fp").agg(F.min("row").alias("row"))
    groups = distinct.groupBy("group_fp").agg(F.min("row").alias("grp"))
    members = staged(spark, distinct.join(groups, "group_fp").select("row", "n", "set_fp", "grp"), "members")
    lists = staged(spark, _lists(members, sets), "postings")

    # First every group against the foremost one of each of its lists, and members with leaders.
    star = lists.select(F.col("grp").alias("a"), F.col("n").alias("xn"), F.col("pos").alias("xpos"),
                        F.col("front.grp").alias("b"), F.col("front.n").alias("yn"), F.col("front.pos").alias("ypos")) \
        .filter("a <> b").filter(_passes(percent)).select("a", "b")
    inner = members.filter("row <> grp").select(F.col("grp").alias("a"), F.col("row").alias("b"))
    first = staged(spark, _verify(star.unionByName(inner), sets, docs, percent, k), "links")
    labels = components(spark, first)

    # Then all pairs of a list whose components are still apart.
    node = staged(spark, members.join(labels.withColumnRenamed("node", "row"), "row", "left").select(
        "row", "grp", F.coalesce("label", "row").alias("label")), "nodes")
    spans = node.groupBy("grp").agg(F.min("label").alias("label"), F.max("label").alias("top"))
    tagged = staged(spark, lists.drop("front").join(spans, "grp"), "tagged")
    apart = (tagged.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("top").alias("hi"))
             .filter("lo <> hi").select("shingle"))
    open_lists = staged(spark, tagged.join(apart, "shingle", "left_semi"), "open")
    x, y = (open_lists.select(F.col("shingle").alias(side + "s"), *[F.col(c).alias(side + c) for c in ("grp", "n", "pos", "label", "top")])
            for side in "xy")
    differ = F.least("xlabel", "ylabel") != F.greatest("xtop", "ytop")
    cross = x.join(y, (F.col("xs") == F.col("ys")) & (F.col("xgrp") < F.col("ygrp")) & differ & _passes(percent)) \
        .select("xgrp", "ygrp").distinct()
    pairs = (cross.join(node.select(F.col("grp").alias("xgrp"), F.col("row").alias("a"), F.col("label").alias("la")), "xgrp")
             .join(node.select(F.col("grp").alias("ygrp"), F.col("row").alias("b"), F.col("label").alias("lb")), "ygrp")
             .filter("la <> lb").select("a", "b"))
    # Within a group whose members did not all meet its leader.
    split = node.join(spans.filter("label <> top").select("grp"), "grp", "left_semi")
    own = (split.select(F.col("row").alias("a"), "grp", F.col("label").alias("la"))
           .join(split.select(F.col("row").alias("b"), "grp", F.col("label").alias("lb")), "grp")
           .filter("a < b AND la <> lb").select("a", "b"))
    more = staged(spark, _verify(pairs.unionByName(own), sets, docs, percent, k), "more")
    return members, labels if more.isEmpty() else components(spark, first.unionByName(more))


def near_rows(spark: SparkSession, docs: DataFrame, percent: int = 80, k: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(staged rows with ``row``, ``id``, ``text``; one row per document: ``row``, ``id``, ``n``,
    ``component`` as the smallest id of the linked documents)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    numbered = staged(spark, rows.withColumn("row", F.monotonically_increasing_id()), "rows", "zstd")
    return numbered, _near(spark, numbered, percent, k)


def _near(spark: SparkSession, numbered: DataFrame, percent: int, k: int) -> DataFrame:
    rows = numbered.select("id", "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 << int(np.clip(int(chars // 60).bit_length(), MIN_BUCKETS.bit_length() - 1, MAX_BUCKETS.bit_length() - 1))
    levels = spark.sparkContext.broadcast(shingle_levels(rows, buckets, k))
    sets = staged(spark, signatures(numbered, levels, buckets, percent, k), "sets")
    members, labels = links(spark, sets, numbered, percent, k)

    member = members.join(labels.withColumnRenamed("node", "row"), "row", "left").select(
        "set_fp", F.col("n").alias("mn"), F.coalesce("label", "row").alias("label"))
    rows_ = sets.select("row", "id", "n", F.col("set_fp").alias("fp"))
    placed = rows_.join(member, (F.col("fp") == F.col("set_fp")) & (F.col("n") == F.col("mn")), "left").select(
        "row", "id", "n", F.coalesce("label", "row").alias("label"), F.col("n").eqNullSafe(0).alias("alone"))
    placed = staged(spark, placed, "placed")
    least = placed.filter("NOT alone").groupBy("label").agg(F.min("id").alias("low"))
    out = placed.filter("NOT alone").join(least, "label").select("row", "id", "n", F.col("low").alias("component"), "label")
    lone = placed.filter("alone").select("row", "id", "n", F.col("id").alias("component"), F.lit(None).cast("long").alias("label"))
    return out.unionByName(lone)


def near_groups(spark: SparkSession, docs: DataFrame, percent: int = 80, k: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``."""
    _, rows = near_rows(spark, docs, percent, k)
    return rows.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                       F.col("component").alias("component_id"))


def keep_one_per_group(spark: SparkSession, docs: DataFrame, percent: int = 80, k: int = SHINGLE_WORDS) -> DataFrame:
    """Pipeline form: of each component the document with the smallest id stays (a null id last;
    of rows that repeat the id, one), columns as given. Documents without words all stay."""
    row = fresh(docs, "row")
    tagged = staged(spark, docs.withColumn(row, F.monotonically_increasing_id()), "rows", "zstd")
    numbered = tagged.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.col(row).alias("row"))
    rows = staged(spark, _near(spark, numbered, percent, k), "near")
    first = rows.filter("label IS NOT NULL").groupBy("label").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")).select(F.col("first.row").alias("_stay"))
    dropped = rows.filter("label IS NOT NULL").join(first, rows["row"] == first["_stay"], "left_anti").select(F.col("row").alias("_gone"))
    return without(tagged, row, staged(spark, dropped, "dropped")).drop(row)
