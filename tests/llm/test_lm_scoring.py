import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lm_scoring as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def base(rows):
    c = Counter(t for i, text in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return {(i, text): (len(tokens(text)), sum(c[t] > 0 for t in tokens(text)), n,
                        sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(text))) for i, text in rows}


@pytest.mark.parametrize("table", [L.TABLE, 5])
def test_given_documents(spark, monkeypatch, table):
    """Counts and the base score against a plain count; the model beats it on held-out text."""
    monkeypatch.setattr(L, "TABLE", table)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = base(rows)
    texts = dict(rows)
    got = L.score(spark, docs).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, score = want[(r.doc_id, texts[r.doc_id])]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_defined_cases(spark, docs_of):
    rows = [(i, f"a b c w{i % 7} d") for i in range(40)] + [(50, None), (51, ""), (None, "A b"), (52, "x " * 60_000), (3, "a b c w3 d")]
    want = base(rows)
    got = L.score(spark, docs_of(rows, "doc_id long, text string, key string, score string")).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == sorted(
        (str(i), *want[(i, t)][:2], round(want[(i, t)][3], 6)) for i, t in rows)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_nothing_to_learn_from(spark, docs_of):
    assert L.score(spark, docs_of([], "doc_id long, text string")).count() == 0
    one = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = L.score(spark, docs_of([(one, "a b")], "doc_id long, text string")).collect()[0]
    assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0) and np.isfinite(r.score)


def test_frequent_tokens_are_bounded(spark):
    rng = np.random.default_rng(1)
    counts = spark.createDataFrame([(i, int(c)) for i, c in enumerate(rng.zipf(1.5, 3000) % 10**6 + 1)], "h long, c long")
    for most in (0, 1, 10, 500, 3000):
        got = {r.h: r.c for r in L.frequent(counts, most).collect()}
        assert len(got) <= most
        rest = [r.c for r in counts.collect() if r.h not in got]
        assert not got or not rest or min(got.values()) > max(rest)
    assert len(L.frequent(counts, 3000).collect()) == 3000


def test_training_beats_the_untrained_network(spark, monkeypatch):
    """Log-probability per held-out token: the trained network against the same one untrained."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trained = [r for r in L.score(spark, docs).collect() if r.held_out]
    monkeypatch.setattr(L, "train", lambda spark, docs, vocab: L.initial(vocab.unigram))
    untrained = [r for r in L.score(spark, docs).collect() if r.held_out]
    n = sum(r.n_tokens for r in trained)
    gain = (sum(r.score for r in trained) - sum(r.score for r in untrained)) / n
    assert gain > 0.05


@pytest.mark.parametrize("least", [1, 3])
def test_score_by_hand(spark, docs_of, monkeypatch, least):
    """The model's score recomputed token by token from its parameters and the counts, with few words
    for themselves so that buckets have slots."""
    monkeypatch.setattr(L, "MIN_COUNT", least)
    words = "the quick brown fox jumps over a lazy dog and runs far away from it".split()
    rows = [(i, " ".join(words[(i * k) % len(words)] for k in range(12)) + f" rare{i}x") for i in range(60)]
    docs = docs_of(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in L.score(spark, docs).collect()}
    training = docs.filter(~L.held_out(docs["doc_id"]))
    counts = L.token_counts(training)
    known = {np.uint64(np.int64(r.h)): r.c for r in counts.collect()}
    vocab = L.vocabulary(counts)
    r, c, q, b, vectors = L.train(spark, training, vocab)
    for i, text in rows[:20]:
        h, bucket, _, _ = next(L.token_batches([text]))
        units, total = vocab.units(h, bucket), 0.0
        for n, u in enumerate(units):
            one, two = (units[n - 1] if n else L.START), (units[n - 2] if n > 1 else L.START)
            s = (r[one] * c[0] + r[two] * c[1]) @ q.T + b
            total += float(s[u] - s.max() - np.log(np.exp(s - s.max()).sum())) / math.log(10)
            if u >= L.HEAD:
                k = u - L.HEAD
                first, end = (vocab.slot_end[k - 1] if k else 0), vocab.slot_end[k]
                inner = np.log(vocab.slot_share[first:end]) + vectors[first:end] @ (r[one] * c[0] + r[two] * c[1])
                slot = int(vocab.slots(h[n:n + 1], np.array([k]))[0]) - first
                total += float(inner[slot] - inner.max() - np.log(np.exp(inner - inner.max()).sum())) / math.log(10)
                if slot == end - first - 1:
                    unseen, own = vocab.unseen[k], known.get(h[n], 0)
                    share = (1 - unseen) * own / vocab.bucket_total[k] if own else unseen
                    total += math.log10(share / vocab.slot_share[end - 1])
        assert got[i] == pytest.approx(total, rel=1e-3)


def test_slots_grow_with_the_corpus(spark):
    """The tokens with a vector of their own are all above the count, and every bucket's shares are one."""
    sizes = []
    for sf in ("0.001", "0.01"):
        counts = L.token_counts(spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("text"))
        vocab = L.vocabulary(counts)
        common = counts.filter(f"c >= {L.MIN_COUNT}").count()
        sizes.append(len(vocab.member))
        assert len(vocab.member) == max(0, common - L.HEAD) or common <= L.HEAD + len(vocab.member)
        start = np.concatenate([[0], vocab.slot_end[:-1]])
        assert np.add.reduceat(vocab.slot_share, start) == pytest.approx(1)
    assert sizes[1] > sizes[0]


def test_units_sum_to_one(spark):
    params = L.initial(np.full(L.UNITS, 1 / L.UNITS))
    z = L.normalisers(spark, params)
    r, c, q, b = params
    for one, two in ((0, 1), (L.START, L.START), (700, 1000)):
        s = (r[one] * c[0] + r[two] * c[1]) @ q.T + b - z[one, two]
        assert np.exp(s).sum() == pytest.approx(1, abs=1e-4)
