import random
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.packing import best_fit_decreasing, encoder, pack, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(lengths, window):
    """Piece by piece: the fullest window that still has room."""
    windows = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, used in enumerate(windows) if used + n <= window]
        if fits:
            best = max(fits, key=lambda i: windows[i])
            windows[best] += n
        else:
            windows.append(n)
    return sorted(windows)


@pytest.mark.parametrize("seed", range(12))
def test_run_lengths_equal_piece_by_piece(seed):
    rng = random.Random(seed)
    window = rng.choice([7, 16, 100, 1024])
    lengths = [rng.randint(1, rng.choice([window, max(1, window // 3)])) for _ in range(rng.randint(0, 400))]
    used, taken = Counter(), Counter()
    for length, rank, n, first, each, offset in best_fit_decreasing(Counter(lengths), window):
        assert rank == taken[length]
        taken[length] += n
        for k in range(n):
            assert used[first + k // each] == offset + (k % each) * length
            used[first + k // each] += length
    assert taken == Counter(lengths)
    assert sorted(used.values()) == plain_best_fit(lengths, window)


@pytest.mark.parametrize("text", ["", " ", "a  b", " lead", "trail ", "it's  John's\n\n x", "a\n b \t c", "é ü  x", "<|endoftext|> a",
                                  "don't stop 12 3", "  ", "a " * 50 + "\n", "日本 語 x", "x" * 500 + " y", "a\n \nb", "a \nb c", "a\n\n b\n c", "x \u00a0y z", "é\u2003 b",
                                  " ".join(f"ü{i}é.\nZ{i}," for i in range(300))])
def test_chunked_ids_equal_the_tokenizer(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    assert list(np.frombuffer(encoder(PATH).encode([text, text])[1], "<u4")) == t.encode(text, add_special_tokens=False).ids


def test_pack_covers_every_id_once(spark, docs_of):
    rng = random.Random(5)
    words = ["alpha", "beta", "gam", "12", "x\n"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 50, 700, 2500])))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "a b"), (7, rows[7][1]), (102, "z " * 30_000)]
    docs = docs_of(rows, "doc_id long, text string, part string, length long, ids string")
    packed = pack(spark, docs, PATH)
    got = packed.select("*", F.crc32("ids").alias("crc")).collect()
    t = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        want[(i, len(ids))] += 1
        mine = [r for r in got if r.doc_id == i and r.doc_tokens == len(ids)]
        for r in mine:
            assert r.crc == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    for (i, n), times in want.items():
        starts = Counter()
        for r in got:
            if r.doc_id == i and r.doc_tokens == n:
                starts[(r.start, r.length)] += 1
        assert sum(length * c for (_, length), c in starts.items()) == n * times
        assert set(starts.values()) == {times}
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in got)
    assert len(by) == len(plain_best_fit([r.length for r in got], 1024))
    full = sequences(packed).collect()
    assert sum(r.n_tokens for r in full) == total
    assert all(len(r.ids) == 1024 or len(r.ids) == r.n_tokens and (r.n_tokens & (r.n_tokens - 1)) == 0 for r in full)


def test_empty(spark, docs_of):
    assert pack(spark, docs_of([], "doc_id long, text string"), PATH).count() == 0
