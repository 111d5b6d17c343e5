"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Documents and benchmark items are turned into words. Numbers, units and names (capitalised words
within a sentence) become typed placeholders, so a question whose numbers or names were changed has
the same template. Windows of ``WINDOW`` template words are hashed and the documents' windows are
hash-joined with those of the benchmark; only windows with at least ``MIN_PLAIN`` plain words count.
For every document and item that meet, the slots (the words behind the placeholders) are compared
within one occurrence: a match is consistent when each value of the item is replaced by one value
throughout. Occurrences are the windows of one diagonal (place in the document less place in the
item), those of diagonals at most ``SHIFT`` apart (words put in or left out), and, for an item that
is torn apart, all windows of the document. A document is contaminated by an item when the
consistent windows of any occurrence reach ``SHARE`` of the item's windows, or ``RUN`` of them.

The benchmark's windows are broadcast only below ``BROADCAST_ROWS`` rows; beyond that the join is a
shuffle whose hot windows Spark can split.

An item that stands in a document word by word, but for case and edge punctuation, contaminates it
whatever its template: its rarest window of up to ``WINDOW`` lower-cased words is hash-joined and
the whole item is compared there.

A text's matches depend on the text alone, so they are kept by its digest and copies share them.

Defined cases: null and empty texts, and items of fewer than ``MIN_PLAIN`` words, match nothing.
Items shorter than a window, or without a window of
``MIN_PLAIN`` plain words, are met word by word. Rows of ``item_id`` that repeat, with equal or other texts,
each count as an item text of that id; a null ``item_id`` is kept. Every document row, repeated or
with a null ``doc_id``, is judged by its own text. Empty tables match nothing. Extra columns are
ignored by ``contaminated`` and carried through by ``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import WHITE, fresh, maybe_in, staged, without

WINDOW = 8
MIN_PLAIN = 4
SHARE = 0.5
RUN = 6
SHIFT = 4
BROADCAST_ROWS = 500_000

# Units of measure that a placeholder replaces.
UNITS = ("mm cm m km in ft yd mi mg g kg t oz lb ml l gal s ms min h hr hrs hour hours day days week weeks month "
         "months year years minute minutes second seconds meter meters metre metres kilometer kilometers "
         "gram grams kilogram kilograms liter liters litre litres mile miles foot feet inch inches pound "
         "pounds ounce ounces dollar dollars cent cents euro euros percent degrees celsius fahrenheit").split()

_NUMBER = r"^[$€£+-]?\d[\d.,:/]*(%|st|nd|rd|th)?$"
_NAME = r"^\p{Lu}[\p{Ll}'-]+$"
_EDGE = "\"'()[]{}«»“”.,;:!?"
_STOP = r"[.!?:]['\")»”]*$"


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def with_template(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``w``, the words of ``text`` without edge punctuation, and ``t``, their template."""
    words = F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), WHITE), lambda x: x != "")
    bare = rows.withColumn("raw", words).withColumn("w", F.transform("raw", lambda x: F.btrim(x, F.lit(_EDGE))))

    def typed(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("raw", i - 1))
        plain = (F.when(x.rlike(_NUMBER), "<num>")
                 .when(x.isin(UNITS) & before.rlike(r"\d"), "<unit>").otherwise(x))
        name = F.when(x.rlike(_NAME) & before.isNotNull() & ~before.rlike(_STOP), "<name>").otherwise(F.lower(x))
        return F.when(x == F.lower(x), plain).otherwise(name)
    return bare.withColumn("t", F.transform("w", typed)).drop("raw")


def _starts(t: str) -> Column:
    return F.when(F.size(t) > 0, F.sequence(F.lit(0), F.greatest(F.size(t) - WINDOW, F.lit(0))))


def _is_slot(x: Column) -> Column:
    return x.isin("<num>", "<unit>", "<name>")


def _slots(words: str, at: Column) -> Column:
    """What stands behind the placeholders of the window at ``at``, as (type, word)."""
    pair = F.arrays_zip(F.slice("t", at + 1, WINDOW).alias("t"), F.slice(words, at + 1, WINDOW).alias("w"))
    return F.transform(F.filter(pair, lambda p: _is_slot(p["t"])), lambda p: F.struct(p["t"].alias("t"), F.lower(p["w"]).alias("w")))


def _items(benchmark: DataFrame) -> DataFrame:
    """Distinct (``item_id``, ``text``) with ``item``, the digest of both."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("item", _digest(F.concat(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))))
    return items.dropDuplicates(["item"])


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """One row per countable window of each item: ``h``, ``item_id``, ``item`` (digest of its
    id and text), ``item_at``, ``item_slots`` and ``needed``, the windows that make a match."""
    rows = with_template(_items(benchmark), "text").select("item_id", "item", "t", "w", F.explode_outer(_starts("t")).alias("item_at")).filter("item_at IS NOT NULL")
    cut = F.slice("t", F.col("item_at") + 1, WINDOW)
    rows = rows.select("item_id", "item", "item_at", F.xxhash64(cut).alias("h"), _slots("w", F.col("item_at")).alias("item_slots"),
                       F.size(F.filter(cut, lambda x: ~_is_slot(x))).alias("plain")).filter(F.col("plain") >= MIN_PLAIN).drop("plain")
    needed = rows.groupBy("item").agg(F.least(F.lit(RUN), F.ceil(F.count("*") * SHARE)).alias("needed"))
    return rows.join(needed, "item").select("h", "item_id", "item", "item_at", "item_slots", "needed")


def _occurrences(found: DataFrame) -> DataFrame:
    """Every window once for each occurrence that it belongs to, named by ``occ``: the document, its
    diagonal, and the chain of diagonals at most ``SHIFT`` apart. A text's windows of one item meet."""
    of = W.partitionBy("text_md5", "item").orderBy("diagonal")
    placed = found.withColumn("diagonal", F.col("at") - F.col("item_at"))
    placed = placed.withColumn("far", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(of) > SHIFT, F.lit(True)).cast("int"))
    placed = placed.withColumn("chain", F.sum("far").over(of))
    kinds = [F.struct(F.lit(k).alias("kind"), F.lit(v).cast("long").alias("at") if v == 0 else F.col(v).cast("long").alias("at"))
             for k, v in enumerate((0, "diagonal", "chain"))]
    return placed.withColumn("occ", F.explode(F.array(*kinds))).drop("diagonal", "far", "chain")


def _words(text: str) -> Column:
    """The lower-cased words of a text without edge punctuation."""
    raw = F.filter(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), WHITE), lambda x: x != "")
    return F.filter(F.transform(raw, lambda x: F.btrim(x, F.lit(_EDGE))), lambda x: x != "")


def _hashes(k: int) -> Column:
    """Hashes of the windows of ``k`` words of ``l``; none if there are fewer."""
    return F.when(F.size("l") >= k, F.transform(F.sequence(F.lit(0), F.size("l") - k), lambda i: F.xxhash64(F.lit(k), F.slice("l", i + 1, k))))


def verbatim(spark: SparkSession, texts: DataFrame, benchmark: DataFrame, counted: DataFrame) -> DataFrame:
    """(``text_md5``, ``item_id``, ``n_windows``) of texts that hold all words of an item in a row;
    ``n_windows`` is that of ``counted`` (by ``item``), at least 1."""
    items = _items(benchmark).withColumn("l", _words("text")).withColumn("size", F.size("l")).filter(F.col("size") >= MIN_PLAIN)
    keys = items.withColumn("k", F.least("size", F.lit(WINDOW))).withColumn("hs", F.coalesce(*[F.when(F.col("k") == k, _hashes(k)) for k in range(MIN_PLAIN, WINDOW + 1)]))
    keys = keys.select("item_id", "item", "k", "size", F.array_join("l", " ").alias("said"), F.posexplode("hs").alias("off", "h"))
    # The window that the fewest items have stands for the item.
    shared = keys.groupBy("h").agg(F.count("*").alias("n"))
    rarest = keys.join(shared, "h").groupBy("item_id", "item", "k", "size", "said").agg(F.min(F.struct("n", "off", "h")).alias("r"))
    keys = staged(spark, rarest.join(counted, "item", "left").select(
        "item_id", "k", "size", "said", F.coalesce("n_windows", F.lit(1)).alias("n_windows"), F.col("r.off").alias("off"), F.col("r.h").alias("h")), "verbatim")
    lengths = sorted(r["k"] for r in keys.select("k").distinct().collect())
    if not lengths:
        return spark.createDataFrame([], "text_md5 string, item_id long, n_windows long")
    joined = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    hashed = texts.withColumn("l", _words("text")).select("text_md5", F.array(*[_hashes(k) for k in lengths]).alias("all"))
    met = (hashed.select("text_md5", F.explode_outer("all").alias("hs")).select("text_md5", F.posexplode_outer("hs").alias("at", "h"))
           .join(joined, "h").select("text_md5", "item_id", "size", "said", "n_windows", (F.col("at") - F.col("off")).alias("start"))
           .filter("start >= 0").distinct())
    met = staged(spark, met, "met")
    again = maybe_in(texts, "text_md5", met.select("text_md5")).dropDuplicates(["text_md5"]).select("text_md5", _words("text").alias("l"))
    whole = F.array_join(F.slice("l", F.col("start") + 1, F.col("size")), " ") == F.col("said")
    return met.join(again, "text_md5").filter(whole).select("text_md5", "item_id", "n_windows").distinct()


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per text and item that it contains: ``text_md5``, ``item_id``, ``n_windows``."""
    bench = staged(spark, benchmark_windows(benchmark), "benchmark")
    keys = F.broadcast(bench) if bench.count() <= BROADCAST_ROWS else bench
    texts = docs.select(F.col("text").cast("string").alias("text")).withColumn("text_md5", _digest(F.col("text")))
    hashed = with_template(texts, "text").select(
        "text_md5", F.transform(_starts("t"), lambda i: F.xxhash64(F.slice("t", i + 1, WINDOW))).alias("hs"))
    found = (hashed.select("text_md5", F.posexplode_outer("hs").alias("at", "h")).join(keys, "h")
             .select("text_md5", "at", "item_id", "item", "item_at", "item_slots", "needed").distinct())
    found = staged(spark, found, "windows")

    # (posexplode_outer: with posexplode the optimizer copies the whole template expression into a
    # filter on its size, where it runs once per word.)
    # Slot values of the windows that have any: the texts in question are read again.
    slotted = found.filter(F.size("item_slots") > 0)
    again = maybe_in(texts, "text_md5", slotted.select("text_md5")).join(slotted.select("text_md5").distinct(), "text_md5", "left_semi").dropDuplicates(["text_md5"])
    values = (with_template(again, "text").join(
        slotted.groupBy("text_md5").agg(F.collect_set("at").alias("ats")), "text_md5")
        .select("text_md5", F.explode_outer(F.transform("ats", lambda i: F.struct(i.alias("at"), _slots("w", i).alias("slots")))).alias("v"))
        .select("text_md5", "v.at", "v.slots"))
    pairs = _occurrences(found).join(values, ["text_md5", "at"]).filter(F.size("item_slots") > 0).select(
        "text_md5", "item", "occ", "at", "item_at", F.explode_outer(F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))).alias("p")) \
        .select("text_md5", "item", "occ", "at", "item_at", F.col("p.i").alias("i"), F.col("p.d").alias("d"))
    # Each value of the item stands for the value that replaces it most often (ties: the smallest).
    votes = pairs.groupBy("text_md5", "item", "occ", "i", "d").agg(F.count("*").alias("n"))
    chosen = votes.groupBy("text_md5", "item", "occ", "i").agg(F.min(F.struct(-F.col("n"), F.col("d"))).alias("best"))
    broken = (pairs.join(chosen, ["text_md5", "item", "occ", "i"]).filter(F.col("d") != F.col("best.d"))
              .select("text_md5", "item", "occ", "at", "item_at").distinct())
    kept = _occurrences(found).join(broken, ["text_md5", "item", "occ", "at", "item_at"], "left_anti")
    near = (kept.groupBy("text_md5", "item_id", "item", "needed", "occ").agg(F.count_distinct("item_at").alias("n_windows"))
            .filter("n_windows >= needed").select("text_md5", "item_id", "n_windows"))
    same = verbatim(spark, texts, benchmark, bench.groupBy("item").agg(F.count("*").alias("n_windows")))
    return near.unionByName(same).groupBy("text_md5", "item_id").agg(F.max("n_windows").alias("n_windows"))


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item that it contains: ``doc_id``, ``item_id``,
    ``n_windows`` (distinct windows of the item that the document holds consistently)."""
    hits = staged(spark, matches(spark, docs, benchmark), "matches")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest(F.col("text")).alias("text_md5"))
    return ids.join(hits, "text_md5").select("doc_id", "item_id", "n_windows")


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline form: documents that contain an item go, columns as given."""
    hits = staged(spark, matches(spark, docs, benchmark).select("text_md5").distinct(), "matches")
    key = fresh(docs, "md5")
    tagged = docs.withColumn(key, _digest(F.col("text")))
    return without(tagged, key, hits).drop(key)
