"""Language-model scoring with a log-bilinear neural model.

Tokens are lower-cased words and one end per document. The model predicts *units*: the
``HEAD`` commonest tokens stand for themselves, all others for one of ``BUCKETS`` units by their
last two bytes. A unit's score is the product of its vector with the position-weighted sum of the
vectors of the two units before it, plus a bias; batched matrix products over all unit pairs give
the normalisers, so log-probabilities are exact. Within a bucket a second level tells the tokens apart:
every token with at least ``MIN_COUNT`` occurrences (the ``MEMBERS`` commonest, a bound on what is
broadcast) has a vector of its own, all others of the bucket share one slot. A slot's score is the
product of its vector with that of the context, plus the logarithm of its share of the bucket's count,
and a softmax over the bucket's slots normalises it exactly. So the vocabulary with vectors grows with
the corpus. In the shared slot a token gets its share of the slot's count; a Good-Turing share is left
to tokens that training never saw.

Training is noise-contrastive estimation in numpy over all training documents: in every round each
partition takes steps on its share of the documents from the common parameters, and the partitions'
parameters are averaged by a two-level sum in Spark. Token counts are a distributed sum over all
training documents; only the ``HEAD`` and ``TABLE`` commonest are sent around, the rest is joined.

Defined cases: a null or empty text is one end token. A null ``doc_id`` is not held out. Repeated
rows are separate documents. Without training documents every token is unknown and the model is
uniform over units. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.words import batch_words, mix

HEAD, BUCKETS = 768, 256
UNITS = HEAD + BUCKETS
START = UNITS  # the unit before a document
#: At most so many of the commonest tokens have their counts broadcast (16 bytes each); rarer ones are
#: joined by shuffle.
TABLE = 1 << 18
SIZE = 24
ROUNDS = 2
NOISE, BATCH, RATE = 64, 4096, 0.15
MIN_COUNT, MEMBERS = 20, 1 << 12
SLOT_NOISE, SLOT_RATE = 4, 0.03
#: Parameters are added up in pieces of so many numbers, each in tasks of its own.
PIECE = 1 << 16
END = np.uint64(1)  # the hash of the end token


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# --- tokens and counts -------------------------------------------------------------------------

def token_batches(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(token hash, bucket, text, number of texts) in slices of about 4 MB; every text ends with
    the end token."""
    for part in range(0, len(texts), 512):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts[part:part + 512]]
        at = 0
        while at < len(raw):
            stop, size = at, 0
            while stop < len(raw) and (stop == at or size + len(raw[stop]) <= 4_000_000):
                size += len(raw[stop])
                stop += 1
            yield _tokens(raw[at:stop])
            at = stop


def _tokens(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    words, doc, start, end, data = batch_words(raw)
    last = data[end - 1].astype(np.uint64)
    before = np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    bucket = (mix(last * np.uint64(256) + before) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)
    n = len(raw)
    ends = np.searchsorted(doc, np.arange(n), side="right")
    return np.insert(words, ends, END), np.insert(bucket, ends, 0), np.insert(doc, ends, np.arange(n)), n


def token_counts(docs: DataFrame) -> DataFrame:
    """``h``, ``bucket``, ``c`` of every token of the texts; partitions add up locally first, in
    bounded memory."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def merged():
            h, b, c = (np.concatenate(x) for x in zip(*held))
            u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return u, b[first], np.bincount(inverse, weights=c, minlength=len(u)).astype(np.int64)

        def rows(h, b, c):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(b), pa.array(c)], names=["h", "bucket", "c"])
        for batch in batches:
            for h, b, _, _ in token_batches(batch.column(0).to_pylist()):
                held.append((h, b, np.ones(len(h))))
                size += len(h)
                if size > 2_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1_000_000:
                        yield rows(*held[0])
                        held, size = [], 0
        if held:
            yield rows(*merged())

    partial = docs.select("text").mapInArrow(count, "h long, bucket int, c long")
    return partial.groupBy("h").agg(F.first("bucket").alias("bucket"), F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """What every task needs of the counts; all parts are bounded by parameters."""

    total: int
    types: int
    head: np.ndarray  # sorted hashes
    head_unit: np.ndarray
    table: np.ndarray  # sorted hashes of the commonest tokens
    table_count: np.ndarray
    unigram: np.ndarray  # probability of each unit
    bucket_total: np.ndarray
    unseen: np.ndarray  # share of each bucket that is left to unseen tokens
    member: np.ndarray  # sorted hashes of the tokens with a slot
    member_slot: np.ndarray
    slot_end: np.ndarray  # a bucket's slots end here; the last one is shared
    slot_share: np.ndarray  # share of the slot in its bucket

    def units(self, h: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.head, h), len(self.head) - 1)
        return np.where(self.head[at] == h, self.head_unit[at], HEAD + bucket)

    def slots(self, h: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The slot of each token of a bucket."""
        shared = self.slot_end[place] - 1
        if not len(self.member):
            return shared
        at = np.minimum(np.searchsorted(self.member, h), len(self.member) - 1)
        return np.where(self.member[at] == h, self.member_slot[at], shared)

    def counts(self, h: np.ndarray) -> np.ndarray:
        if not len(self.table):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.table, h), len(self.table) - 1)
        return np.where(self.table[at] == h, self.table_count[at], 0)


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the commonest tokens: all whose count reaches the least power of 2**(1/8) that
    no more tokens reach. The counts of counts, some hundreds of rows, tell it, so that no task sorts
    or sends more than its share."""
    step = F.floor(F.log2("c") * 8).cast("int")
    sizes = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, seen = None, 0
    for at, n in sizes:
        seen += n
        if seen > most:
            break
        least = at
    return counts.filter(step >= F.lit(least)) if least is not None else counts.limit(0)


def vocabulary(counts: DataFrame) -> Vocabulary:
    first = counts.orderBy(F.desc("c"), "h").limit(HEAD).select("h", "c").toPandas()
    top = pd.concat([first, frequent(counts, TABLE).select("h", "c").toPandas()]).drop_duplicates("h")
    h, c = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
    head = np.concatenate([np.array([END], np.uint64), first["h"].to_numpy().view(np.uint64)])
    head = head[np.sort(np.unique(head, return_index=True)[1])][:HEAD]
    spot = np.argsort(head)
    order = np.argsort(h)
    is_head = F.col("h").isin([int(x) for x in head.view(np.int64)])
    tail = counts.filter(~is_head).groupBy("bucket").agg(
        F.sum("c").alias("s"), F.sum((F.col("c") == 1).cast("long")).alias("n1")).collect()
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    bucket_total, unseen = np.zeros(BUCKETS), np.ones(BUCKETS)
    for r in tail:
        bucket_total[r["bucket"]], unseen[r["bucket"]] = r["s"], (r["n1"] + 1) / (r["s"] + 2)
    by_head = np.zeros(HEAD)
    known = dict(zip(h.tolist(), c.tolist()))
    by_head[:len(head)] = [known.get(x, 0) for x in head.tolist()]
    unigram = np.concatenate([by_head, bucket_total]) + 0.5
    own = frequent(counts.filter(~is_head & (F.col("c") >= MIN_COUNT)), MEMBERS).toPandas().sort_values(["bucket", "h"])
    sizes = np.bincount(own["bucket"].to_numpy(), minlength=BUCKETS) + 1  # and the shared slot
    slot_end = np.cumsum(sizes)
    slot = np.arange(len(own)) + own["bucket"].to_numpy()
    share = np.zeros(slot_end[-1])
    b = own["bucket"].to_numpy()
    share[slot] = (1 - unseen[b]) * own["c"].to_numpy() / np.maximum(bucket_total[b], 1)
    share[slot_end - 1] = 1 - np.bincount(b, share[slot], BUCKETS)
    member = own["h"].to_numpy().view(np.uint64)
    by_hash = np.argsort(member)
    return Vocabulary(int(total), int(types), head[spot], spot.astype(np.int64), h[order], c[order],
                      unigram / unigram.sum(), bucket_total, unseen, member[by_hash], slot[by_hash].astype(np.int64), slot_end, share)


# --- the model ---------------------------------------------------------------------------------

def initial(unigram: np.ndarray) -> list[np.ndarray]:
    """Context vectors, weights of the two positions, target vectors, biases."""
    rng = np.random.default_rng(7)
    return [rng.normal(0, 0.1, (UNITS + 1, SIZE)).astype(np.float32), np.ones((2, SIZE), np.float32),
            rng.normal(0, 0.1, (UNITS, SIZE)).astype(np.float32), np.log(unigram).astype(np.float32)]


def _scatter(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, rows.shape[1]), np.float32)
    order = np.argsort(index, kind="stable")
    own, first = np.unique(index[order], return_index=True)
    out[own] = np.add.reduceat(rows[order], first, axis=0)
    return out


class SlotTrainer:
    """Noise-contrastive steps for the slots of buckets: the noise of a token is drawn from its bucket,
    and only the vectors that a batch touches move. The contexts' vectors are taken as they are."""

    def __init__(self, vectors: np.ndarray, vocab: Vocabulary, rng: np.random.Generator):
        self.vectors, self.vocab, self.rng = vectors.copy(), vocab, rng
        self.squares = np.full(vectors.shape, 1e-8, np.float32)
        start = np.concatenate([[0], vocab.slot_end[:-1]])
        place = np.repeat(np.arange(BUCKETS), vocab.slot_end - start)
        upto = np.cumsum(vocab.slot_share)
        self.cumulative = place + upto - (upto - vocab.slot_share)[start][place]  # bucket b: from b to b + 1

    def step(self, p: np.ndarray, slot: np.ndarray, place: np.ndarray, n: int) -> None:
        if not len(slot):
            return
        drawn = np.searchsorted(self.cumulative, place[:, None] + self.rng.random((len(slot), SLOT_NOISE)), side="right")
        start = np.where(place > 0, self.vocab.slot_end[place - 1], 0)
        drawn = np.clip(drawn, start[:, None], self.vocab.slot_end[place][:, None] - 1)
        all_of = np.concatenate([slot[:, None], drawn], 1)
        score = np.einsum("ij,ikj->ik", p, self.vectors[all_of]) - np.float32(np.log(SLOT_NOISE))
        side = -1 / (1 + np.exp(np.clip(-score, -30, 30)))
        side[:, 0] += 1
        grads = (side[:, :, None] * p[:, None, :] / n).reshape(-1, p.shape[1]).astype(np.float32)
        flat = all_of.ravel()
        order = np.argsort(flat, kind="stable")
        own, first = np.unique(flat[order], return_index=True)
        g = np.add.reduceat(grads[order], first, axis=0)
        squares = self.squares[own] + g * g
        self.squares[own] = squares
        self.vectors[own] += SLOT_RATE * g / np.sqrt(squares)


class Trainer:
    """Noise-contrastive steps with per-weight rates; the noise of a batch is shared."""

    def __init__(self, params: list[np.ndarray], unigram: np.ndarray, seed: int):
        self.params = [p.copy() for p in params]
        self.squares = [np.full(p.shape, 1e-8, np.float32) for p in params]
        self.noise_log = np.log(NOISE * unigram).astype(np.float32)
        self.cumulative = np.cumsum(unigram)
        self.rng = np.random.default_rng(seed)

    def step(self, first: np.ndarray, second: np.ndarray, target: np.ndarray) -> None:
        r, c, q, b = self.params
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), UNITS - 1)
        r1, r2, n = r[first], r[second], len(target)
        p = r1 * c[0] + r2 * c[1]
        own = (p * q[target]).sum(1) + b[target] - self.noise_log[target]
        other = p @ q[noise].T + (b[noise] - self.noise_log[noise])
        up = (1 / (1 + np.exp(np.clip(own, -30, 30)))) / n
        down = (-1 / (1 + np.exp(np.clip(-other, -30, 30)))) / n
        gp = up[:, None] * q[target] + down @ q[noise]
        gq = _scatter(target, up[:, None] * p, UNITS)
        np.add.at(gq, noise, down.T @ p)
        gb = np.bincount(target, up, UNITS).astype(np.float32)
        np.add.at(gb, noise, down.sum(0))
        gr = _scatter(np.concatenate([first, second]), np.concatenate([gp * c[0], gp * c[1]]), UNITS + 1)
        gc = np.stack([(gp * r1).sum(0), (gp * r2).sum(0)])
        for w, s, g in zip(self.params, self.squares, (gr, gc, gq, gb)):
            s += g * g
            w += RATE * g / np.sqrt(s)


def contexts(units: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The unit before each token and the one before that, within the text."""
    def shifted(k: int) -> np.ndarray:
        out = np.full(len(units), START)
        same = doc[k:] == doc[:-k] if len(doc) > k else np.zeros(0, bool)
        out[k:][same] = units[:-k][same]
        return out
    return shifted(1), shifted(2)


def train(spark: SparkSession, docs: DataFrame, vocab: Vocabulary) -> list[np.ndarray]:
    """Parameters after ``ROUNDS`` rounds that together see every document of ``docs`` once; the last
    are the vectors of the slots."""
    params = [*initial(vocab.unigram), np.zeros((len(vocab.slot_share), SIZE), np.float32)]
    shapes = [p.shape for p in params]
    if not vocab.total:
        return params
    shared = spark.sparkContext.broadcast(vocab)
    for turn in range(ROUNDS):
        now = spark.sparkContext.broadcast(params)

        def run(batches: Iterator[pa.RecordBatch], turn=turn, now=now) -> Iterator[pd.DataFrame]:
            part = TaskContext.get().partitionId()
            vocab = shared.value
            trainer, seen = Trainer(now.value[:4], vocab.unigram, 1000 * turn + part), 0
            inner = SlotTrainer(now.value[4], vocab, np.random.default_rng(1000 * turn + part + 500))
            for batch in batches:
                for h, bucket, doc, _ in token_batches(batch.column(0).to_pylist()):
                    units = vocab.units(h, bucket)
                    one, two = contexts(units, doc)
                    order = trainer.rng.permutation(len(units))
                    for at in range(0, len(order), BATCH):
                        pick = order[at:at + BATCH]
                        trainer.step(one[pick], two[pick], units[pick])
                        low = pick[units[pick] >= HEAD]
                        r, c, _, _ = trainer.params
                        place = units[low] - HEAD
                        inner.step(r[one[low]] * c[0] + r[two[low]] * c[1], vocab.slots(h[low], place), place, len(pick))
                    seen += len(units)
            if seen:
                flat = (np.concatenate([p.ravel() for p in [*trainer.params, inner.vectors]]) * np.float32(seen / 1e6)).astype("<f4")
                for piece, at in enumerate(range(0, len(flat), PIECE)):
                    yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([part % 32], pa.int32()), pa.array([seen / 1e6]),
                                                      pa.array([flat[at:at + PIECE].tobytes()], pa.binary())], names=["piece", "part", "weight", "flat"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in pdf["flat"])
            return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "part": [0], "weight": [pdf["weight"].sum()], "flat": [total.astype("<f4").tobytes()]})

        kind = "piece int, part int, weight double, flat binary"
        share = docs.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn).select("text")
        parts = share.mapInArrow(run, kind).groupBy("piece", "part").applyInPandas(add, kind)  # one row per part: all say 0
        sums = sorted(parts.groupBy("piece").applyInPandas(add, kind).collect())
        if sums:
            flat = np.concatenate([np.frombuffer(x["flat"], "<f4") for x in sums]) / np.float32(sums[0]["weight"])
            cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
            params = [x.reshape(s).copy() for x, s in zip(np.split(flat, cuts), shapes)]
    return params


def normalisers(spark: SparkSession, params: list[np.ndarray]) -> np.ndarray:
    """log Z for every pair (unit before, unit before that), by batched matrix products in tasks;
    the result has a fixed size."""
    shared = spark.sparkContext.broadcast(params[:4])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r, c, q, b = shared.value[:4]
        for pdf in batches:
            for one in pdf["id"]:
                s = (r[one] * c[0] + r * c[1]) @ q.T + b
                top = s.max(1, keepdims=True)
                z = np.log(np.exp(s - top).sum(1)) + top[:, 0]
                yield pd.DataFrame({"id": [one], "z": [z.astype("<f4").tobytes()]})

    rows = spark.range(0, UNITS + 1, 1, 32).mapInPandas(run, "id long, z binary").collect()
    out = np.zeros((UNITS + 1, UNITS + 1), np.float32)
    for row in rows:
        out[row["id"]] = np.frombuffer(row["z"], "<f4")
    return out


def slot_scores(p: np.ndarray, slot: np.ndarray, place: np.ndarray, vectors: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Log-probability of each token's slot among those of its bucket."""
    out = np.empty(len(slot))
    order = np.argsort(place, kind="stable")
    own, first = np.unique(place[order], return_index=True)
    log_share = np.log(np.maximum(vocab.slot_share, 1e-12)).astype(np.float32)
    for b, at, end in zip(own, first, [*first[1:], len(order)]):
        rows = order[at:end]
        start, stop = (vocab.slot_end[b - 1] if b else 0), vocab.slot_end[b]
        s = p[rows] @ vectors[start:stop].T + log_share[start:stop]
        top = s.max(1)
        out[rows] = s[np.arange(len(rows)), slot[rows] - start] - top - np.log(np.exp(s - top[:, None]).sum(1))
    return out


# --- scoring -----------------------------------------------------------------------------------

def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-half unigram) and ``score`` (the model), both log10 of the whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    training = rows.filter(~held_out(F.col("doc_id")))
    counts = staged(spark, token_counts(training), "counts")
    vocab = vocabulary(counts)
    params = train(spark, training, vocab)
    vectors = params[4] if len(params) > 4 else np.zeros((len(vocab.slot_share), SIZE), np.float32)
    shared = spark.sparkContext.broadcast((vocab, params[:4], vectors, normalisers(spark, params)))
    floor = np.log10(vocab.total + 0.5 * (vocab.types + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, (r, c, q, b), vectors, z = shared.value
        with np.errstate(divide="ignore"):
            left = np.log10(np.maximum(vocab.slot_share[vocab.slot_end - 1], 1e-12))
            unseen, rest = np.log10(vocab.unseen), np.log10((1 - vocab.unseen) / np.maximum(vocab.bucket_total, 1))
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for h, bucket, doc, n in token_batches(batch.column(1).to_pylist()):
                units = vocab.units(h, bucket)
                one, two = contexts(units, doc)
                logp = np.empty(len(units))
                in_bucket = units >= HEAD
                place = np.where(in_bucket, units - HEAD, 0)
                slot = vocab.slots(h, place)
                for s in range(0, len(units), 131_072):
                    e = slice(s, s + 131_072)
                    p = r[one[e]] * c[0] + r[two[e]] * c[1]
                    logp[e] = (p * q[units[e]]).sum(1) + b[units[e]] - z[one[e], two[e]]
                    low = np.flatnonzero(in_bucket[e])
                    logp[s + low] += slot_scores(p[low], slot[s + low], place[s + low], vectors, vocab)
                logp /= np.log(10)
                found = vocab.counts(h)
                shares = in_bucket & (slot == vocab.slot_end[place] - 1)
                logp += np.where(shares, np.where(found > 0, rest[place] + np.log10(np.maximum(found, 1)), unseen[place]) - left[place], 0)
                base = np.log10(found + 0.5) - floor
                # Tokens beyond the table: counted as unseen here, put right by the join.
                tail = np.flatnonzero(found == 0)
                pair = np.unique(np.stack([doc[tail].astype(np.uint64), h[tail]], 1), axis=0, return_counts=True) if len(tail) else \
                    (np.zeros((0, 2), np.uint64), np.zeros(0, np.int64))
                cut = np.searchsorted(pair[0][:, 0], np.arange(n + 1))
                offsets = pa.array(cut.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(key + np.arange(n)), pa.array(ids[at:at + n], pa.int64()), pa.array(np.bincount(doc, minlength=n)),
                    pa.array(np.bincount(doc[found > 0], minlength=n)), pa.array(np.bincount(doc, base, n)), pa.array(np.bincount(doc, logp, n)),
                    pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(pair[0][:, 1]).view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(pair[1].astype(np.int32)))],
                    names=["key", "doc_id", "n_tokens", "n_known", "base", "model", "tail", "times"])
                key, at = key + n, at + n

    first = staged(spark, rows.mapInArrow(
        run, "key long, doc_id long, n_tokens long, n_known long, base double, model double, tail array<long>, times array<int>"), "scores")
    buckets = spark.createDataFrame([(i, float(vocab.bucket_total[i]), float(vocab.unseen[i])) for i in range(BUCKETS)],
                                    "bucket int, s double, u double")
    rare = counts.join(F.broadcast(buckets), "bucket").select(
        "h", (F.log10(F.col("c") + 0.5) - F.log10(F.lit(0.5))).alias("base_more"),
        F.when(F.col("s") > 0, F.log10((1 - F.col("u")) * F.col("c") / F.col("s")) - F.log10("u")).otherwise(0.0).alias("model_more"))
    tail = first.select("key", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("key", F.col("x.tail").alias("h"), F.col("x.times").alias("m"))
    more = tail.join(rare, "h").groupBy("key").agg(
        F.sum("m").alias("known"), F.sum(F.col("m") * F.col("base_more")).alias("base_more"), F.sum(F.col("m") * F.col("model_more")).alias("model_more"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return first.drop("tail", "times").join(more, "key", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_known") + zero("known")).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("base") + zero("base_more")).alias("base_score"),
        (F.col("model") + zero("model_more")).alias("score"))
