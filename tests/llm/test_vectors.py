"""The two vector operators against plain Python over all centroids and entries."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm.centroids import cluster, nearest, rotated
from tessera.llm.vector_codes import codes, reassign, rescan
from tessera.llm.vectors import squared_distances

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, x string, code string, _key string"


def make(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(parts)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def lloyd(points, books, rounds):
    """(entry, distance) of each point and the books after the rounds, by whole scans."""
    def assign():
        return [min((distance(p, b), j) for j, b in enumerate(books)) for p in points]
    books = list(books)
    for _ in range(rounds):
        at = assign()
        for j in range(len(books)):
            own = [p for p, (_, k) in zip(points, at) if k == j]
            if own:
                books[j] = tuple(sum(c) // len(own) for c in zip(*own))
    return [(j, d) for d, j in assign()], books


def brute_cluster(rows, k=16, rounds=3):
    kept = [(i, tuple(math.floor(64 * np.float64(np.float32(c))) for c in v)) for i, v, _ in rows if usable(v) and len(v) == 64]
    key = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    first = sorted((key(i), v) for i, v in kept if i is not None)[:k]
    got, books = lloyd([v for _, v in kept], [v for _, v in first], rounds)
    inertia = defaultdict(int)
    for j, d in got:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, books[j])).encode()).hexdigest())
                   for (i, _), (j, d) in zip(kept, got)), key=str)


def brute_codes(rows, width):
    kept = [(i, tuple(math.floor(256 * np.float64(np.float32(c))) for c in v), lab) for i, v, lab in rows if usable(v)]
    fit = [r for r in kept if len(r[1]) == 16 * width]
    first = sorted(fit, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]
    code, error, books = [""] * len(fit), [0] * len(fit), []
    for p in range(16):
        cut = slice(p * width, (p + 1) * width)
        got, book = lloyd([v[cut] for _, v, _ in fit], [v[cut] for _, v, _ in first], 2)
        books += book
        for n, (j, d) in enumerate(got):
            code[n] += f"{j:02x}"
            error[n] += d
    per = defaultdict(int)
    for (_, _, lab), e in zip(fit, error):
        per[lab] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for c in b).encode()).hexdigest()
    out = [(i, c, e, per[lab], sha) for (i, _, lab), c, e in zip(fit, code, error)]
    out += [(i, None, None, per.get(lab), sha) for i, v, lab in kept if len(v) != 16 * width]
    return sorted(out, key=str)


def vectors(n, dims, seed, hot=0):
    rng = random.Random(seed)
    centers = [[rng.uniform(-0.4, 0.4) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centers[0 if i < hot else rng.randrange(6)]
        rows.append((i * 3 + 1, [float(np.float32(x + rng.gauss(0, 0.1))) for x in c], rng.choice([1, 2, None])))
    return rows


def odd_rows(dims):
    base = [0.25] * dims
    return [(500_000, None, 1), (500_001, [], 1), (500_002, base[:-1] + [None], 1), (500_003, base[:-1] + [float("nan")], 1),
            (500_004, base[:-1] + [float("inf")], 2), (500_005, base[:-1] + [float("-inf")], 2), (None, base, 2),
            (500_006, base[:-1], 77), (500_007, base, 1), (500_007, base, 1), (500_008, [-x for x in base], None)]


def tied(n, dims):
    """Few distinct values, so that many distances are equal."""
    rng = random.Random(5)
    return [(i, [rng.choice([-0.5, 0.0, 0.5])] * dims, i % 3) for i in range(n)]


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


CLUSTER = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
CODES = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("rows", [vectors(150, 64, 1, hot=50) + odd_rows(64), tied(60, 64), vectors(5, 64, 2), []],
                         ids=["usual", "ties", "few", "empty"])
def test_clusters_equal_brute_force(spark, rows):
    assert rows_of(cluster(spark, make(spark, rows)), CLUSTER) == brute_cluster(rows)


@pytest.mark.parametrize("rows,width", [(vectors(150, 64, 3, hot=60) + odd_rows(64), 4), (tied(100, 16), 1), (vectors(9, 32, 4), 2), ([], 4)],
                         ids=["usual", "ties", "few", "empty"])
def test_codes_equal_brute_force(spark, rows, width):
    assert rows_of(codes(spark, make(spark, rows)), CODES) == brute_codes(rows, width)


def test_no_length_can_be_cut(spark):
    got = codes(spark, make(spark, [(1, [0.5] * 15, 1), (2, [], None)])).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == [(1, None, None, None), (2, None, None, None)]


def test_active_entries_equal_a_whole_scan():
    """Whatever entries move, comparing fixed parts with the moved ones only finds the same entries;
    with few moved entries it takes far fewer comparisons."""
    rng = np.random.default_rng(7)
    x, book = rng.integers(-3, 4, (3000, 2)), rng.integers(-3, 4, (64, 2))
    at, dist = rescan(x, book)
    for n_moved in (0, 1, 5, 40, 64):
        new, moved = book.copy(), np.zeros(64, bool)
        moved[rng.choice(64, n_moved, replace=False)] = True
        new[moved] += rng.integers(-2, 3, (n_moved, 2))
        got, d, compared = reassign(x, new, moved, at, dist)
        want, e = rescan(x, new)
        assert (got == want).all() and (d == e).all()
        assert compared <= len(x) * 64 and (n_moved > 5 or compared < len(x) * 64 / 2)


def test_the_bound_spares_comparisons():
    rng = np.random.default_rng(8)
    c = rng.integers(-40, 40, (16, 64))
    x = c[rng.integers(0, 16, 2000)] + rng.integers(-3, 4, (2000, 64))
    _, axes = np.linalg.eigh(np.cov(x.T))
    mean, axes = np.rint(x.mean(0)).astype(np.int64), axes[:, ::-1][:, :16]
    at, d, compared = nearest(x, *rotated(x, mean, axes), c, *rotated(c, mean, axes))
    whole = squared_distances(x, c)
    assert (at == whole.argmin(1)).all() and (d == whole.min(1)).all() and compared.mean() < 2


def test_large_components():
    x = np.array([[2**27, -(2**27)], [5, 7]], np.int64)
    d = (2**27 - 5) ** 2 + (2**27 + 7) ** 2
    assert squared_distances(x, x).tolist() == [[0, d], [d, 0]]


def test_overflow_is_refused(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        codes(spark, make(spark, [(1, [1e30] * 16, 1)])).collect()


def test_retried_tasks_change_nothing(spark):
    """Sums of a task are of the rows it holds: any split of the rows gives the same result."""
    rows = vectors(120, 64, 9)
    one, many = (rows_of(cluster(spark, make(spark, rows, n)), CLUSTER) for n in (1, 7))
    assert one == many
