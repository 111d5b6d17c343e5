import random

import pytest

from tessera.llm.ngram_join import keep_one_per_group, near_groups
from tests_llm_brute import brute_components as brute

def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocab) for _ in range(40)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(3, 90))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        if rng.random() < 0.3:
            w = common + w
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w) if rng.random() < 0.9 else " ".join(w).upper()))
    return rows


@pytest.mark.parametrize("seed", [1])
def test_equals_brute_force(spark, docs_of, seed):
    rows = corpus(seed)
    got = near_groups(spark, docs_of(rows))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_defined_cases(spark, docs_of):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (3, "a b"), (4, "A  B"), (None, "a b"), (None, None), (1, long),
            (2, long + " tail"), (2, long + " tail"), (9, "y" * 100_000), (8, "y" * 100_000), (10, "b a")]
    got = near_groups(spark, docs_of(rows, "doc_id long, text string, component long, row long, label string, n long"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_keeps_one_row_of_each_group(spark, docs_of):
    rows = corpus(4, 80) + [(500, None), (501, ""), (0, corpus(4, 80)[0][1])]
    docs = docs_of(rows, "doc_id long, text string, _row string, label string")
    kept = keep_one_per_group(spark, docs)
    assert kept.columns == docs.columns
    want = sorted({c for _, n, c in brute(rows) if n} | {500, 501})
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_empty(spark, docs_of):
    docs = docs_of([], "doc_id long, text string")
    assert near_groups(spark, docs).count() == 0
    assert keep_one_per_group(spark, docs).count() == 0


def test_other_splits_between_jobs(spark, docs_of, monkeypatch):
    """Rows keep their numbers when the input is split in another way from job to job."""
    from tessera.llm import ngram_join
    key, stage, calls = "spark.sql.files.maxPartitionBytes", ngram_join.staged, []

    def shifting(*args):
        calls.append(args)
        out = stage(*args)
        spark.conf.set(key, "2k" if len(calls) % 2 else "128m")
        return out
    monkeypatch.setattr(ngram_join, "staged", shifting)
    rows = corpus(4, 80)
    docs = docs_of(rows, "doc_id long, text string")
    before = spark.conf.get(key)
    try:
        kept = sorted(r.doc_id for r in keep_one_per_group(spark, docs).collect())
    finally:
        spark.conf.set(key, before)
    assert kept == sorted({c for _, n, c in brute(rows) if n})
