import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import build_fuse, drop_duplicates_exact, exact_groups, in_fuse


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        free = True
        for i in sorted(ids, key=lambda x: (x is None, x)):
            stays = free and i == keep
            free = free and not stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def sample(seed):
    rng = random.Random(seed)
    texts = ["", None, " ", "a b", "a  b", "a\tb", "á b", "x" * 50_000] + [f"t{rng.randrange(60)}" for _ in range(200)]
    rows = [(i if rng.random() < 0.95 else None, t) for i, t in enumerate(texts)]
    return rows + [(3, "a b"), (3, "a b"), (9, "x" * 50_000)]


@pytest.mark.parametrize("seed", [1])
def test_equals_brute_force(spark, docs_of, seed):
    rows = sample(seed)
    got = exact_groups(spark, docs_of(rows, "doc_id long, text string, kept string, _digest string"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_colliding_digests_are_told_apart_by_bytes(spark, docs_of):
    rows = sample(3)
    got = exact_groups(spark, docs_of(rows), digest=lambda c: F.pmod(F.crc32(c), F.lit(5)).cast("string"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_drop_keeps_the_smallest_id(spark, docs_of):
    rows = sample(4)
    docs = docs_of(rows, "doc_id long, text string, _sha string, _id string")
    kept = drop_duplicates_exact(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, norm(r.text)) for r in kept.collect() if r.doc_id is not None) == sorted(
        {(min(i for i, u in rows if norm(u) == norm(t) and i is not None), norm(t)) for i, t in rows
         if any(i is not None for i, u in rows if norm(u) == norm(t))})
    assert len({norm(r.text) for r in kept.collect()}) == kept.count()


def test_empty(spark, docs_of):
    docs = docs_of([], "doc_id long, text string")
    assert exact_groups(spark, docs).count() == 0 and drop_duplicates_exact(spark, docs).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300, 20_000])
def test_filter_has_every_key_and_few_others(n):
    rng = np.random.default_rng(n)
    keys, others = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, 50_000).astype(np.uint64)
    built = build_fuse(np.concatenate([keys, keys]))
    assert in_fuse(keys, *built).all() and in_fuse(others, *built).mean() < 0.001
