"""Fingerprints against plain Python; sketches against whole shingle sets."""

import hashlib
import random

import numpy as np
import pytest

import tessera.llm.fingerprints as fp
from tests_llm_brute import shingles


def brute(rows):
    """(doc_id, n_chars, edited_sha256) of rows (doc_id, text) without equal ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for at, (i, t) in enumerate(rows):
        half, after = len(t) // 2, rows[(at + 1) % len(rows)][1]
        changed = t[:len(t) - half] + after[:half]
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), t, changed, after))
    return out


def words(rng, n, of="abcdefgh"):
    return " ".join("".join(rng.choice(of) for _ in range(4)) for _ in range(n))


@pytest.mark.parametrize("slice_chars", [200, 2_000_000])
def test_rows_equal_brute_force(spark, docs_of, monkeypatch, slice_chars):
    monkeypatch.setattr(fp, "SLICE_CHARS", slice_chars)
    rng = random.Random(1)
    rows = [(i * 7 - 40, words(rng, rng.randrange(0, 120))) for i in range(60)]
    rows += [(None, "no id"), (1000, None), (1001, ""), (1002, "é"), (1003, "naïve ćafé 日本 語 " * 20), (1004, "a b"),
             (1005, words(rng, 60_000)), (1006, rows[3][1]), (1007, rows[3][1])]
    docs = docs_of([(*r, "x", "y") for r in rows], "doc_id long, text string, slice string, guest string", parts=5)
    got = {r.doc_id: r for r in fp.fingerprints(spark, docs).collect()}
    want = brute(rows)
    assert len(got) == len(rows) == len(want)
    for i, n, sha, text, changed, after in want:
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, sha), i
        marks = fp.sketches([text, changed, after])
        assert r.fingerprint == fp.to_text(marks[0]) and r.edited_fingerprint == fp.to_text(marks[1])
        assert r.near_edited == fp.likeness(marks[0], marks[1]) and r.near_next == fp.likeness(marks[0], marks[2])
    assert got[1006].fingerprint == got[1007].fingerprint == got[rows[3][0]].fingerprint
    assert got[1006].near_next == 1.0 and got[1000].near_next == 1.0 and got[1000].fingerprint == ""


def test_equal_ids_and_repeated_rows(spark, docs_of):
    docs = docs_of([(1, "a b c d e f"), (1, "a b c d e f"), (1, "g h"), (None, None), (None, None), (2, "z")], "doc_id long, text string")
    got = fp.fingerprints(spark, docs).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "1", "2", "None", "None"]
    assert len({r.fingerprint for r in got if r.n_chars == 11}) == 1


def test_empty_and_sole(spark, docs_of):
    assert fp.fingerprints(spark, docs_of([], "doc_id long, text string")).count() == 0
    one = fp.fingerprints(spark, docs_of([(5, "abcd")], "doc_id long, text string", parts=1)).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == [(5, hashlib.sha256(b"abab").hexdigest(), 1.0)]


def test_estimates_are_close_to_the_sets(spark):
    rng = random.Random(2)
    for n, part in ((4000, 400), (4000, 4000), (800, 3000)):
        a = words(rng, n)
        b = " ".join(a.split()[:part]) + " " + words(rng, 500)
        sa, sb = shingles(a), shingles(b)
        x, y = fp.sketches([a, b])
        for got, all_of in ((fp.likeness(x, y), sa | sb), (fp.containment(x, y), sa)):
            share = len(sa & sb) / len(all_of)  # within four standard deviations of a sample of 1 in SHARE
            assert abs(got - share) <= 4 * (share * (1 - share) * fp.SHARE / len(all_of)) ** 0.5
        assert abs(len(x) - len(sa) / fp.SHARE) < 5 * (len(sa) / fp.SHARE) ** 0.5


def test_sketches_merge():
    """The sketch of two texts' shingles together is the merge of theirs, small ones included."""
    rng = np.random.default_rng(3)
    for n, m in ((0, 0), (1, 0), (1, 1), (2, 3), (5, 900), (300, 400)):
        a, b = (rng.integers(0, 2**64, k, np.uint64) for k in (n, m))
        assert (fp.merged(fp.sketch(a), fp.sketch(b)) == fp.sketch(np.concatenate([a, b]))).all()
    s = fp.sketch(rng.integers(0, 2**64, 500, np.uint64))
    assert (fp.from_text(fp.to_text(s)) == s).all() and (s < 2**64 // fp.SHARE).all()


def test_edited_texts_are_nearer_than_the_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = fp.fingerprints(spark, docs).collect()
    long = [r for r in rows if r.n_chars >= 300]
    assert len(rows) == docs.count() and sum(r.near_edited > r.near_next for r in long) >= 0.97 * len(long)
