"""Words of a batch of texts as 64-bit hashes, in numpy.

A word is a run of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. Both rules touch ASCII bytes
only, so they hold byte by byte on UTF-8. A word's hash is a polynomial of its bytes modulo 2**64,
taken from prefix sums and then mixed; every step is a whole-array operation.
"""

from __future__ import annotations

import numpy as np

_P = 0x9DDFEA08EB382D69 | 1
_BLOCK = 1 << 16
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, _U)
    out[0] = 1
    out[1:] = base
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


_POW = _powers(_P, _BLOCK)
_INV = _powers(_inverse(_P), _BLOCK)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(32))
        x = x * _U(0xD6E8FEB86659FD93)
        x = x ^ (x >> _U(32))
        x = x * _U(0xD6E8FEB86659FD93)
        return x ^ (x >> _U(32))


def batch_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, doc, start, end, data): one entry per word over all texts, in order; ``start`` and
    ``end`` index the lower-cased bytes ``data`` of all texts joined by single spaces."""
    data = _LOWER[np.frombuffer(b" ".join(texts), np.uint8)]
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    firsts = np.zeros(len(texts), np.int64)
    np.cumsum(lens[:-1] + 1, out=firsts[1:])
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~_SPACE[data]
    edges = np.diff(solid)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    doc = np.searchsorted(firsts, start, side="right") - 1
    return word_hashes(data, start, end), doc, start, end, data


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), _U)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(start):
            lo = int(start[first])
            last = int(np.searchsorted(end, lo + _BLOCK, side="right"))
            if last <= first:  # one word longer than a block: fold it block by block
                h = 0
                for at in range(lo, int(end[first]), _BLOCK):
                    piece = data[at:min(at + _BLOCK, int(end[first]))].astype(_U) + _U(1)
                    h = int(mix(np.array([h ^ int((piece * _POW[:len(piece)]).sum())], _U))[0])
                out[first] = h
                first += 1
                continue
            span = data[lo:int(end[last - 1])].astype(_U) + _U(1)
            sums = np.zeros(len(span) + 1, _U)
            np.cumsum(span * _POW[:len(span)], out=sums[1:])
            s, e = start[first:last] - lo, end[first:last] - lo
            out[first:last] = mix((sums[e] - sums[s]) * _INV[s])
            first = last
    return out


_ODD = mix(np.arange(1, 65, dtype=_U)) | _U(1)


def batch_shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the ``k``-word shingles of a batch, in order of the texts; a text with fewer
    words is one shingle."""
    with np.errstate(over="ignore"):
        n = max(0, len(words) - k + 1)
        whole = doc[:n] == doc[k - 1:]
        h = np.zeros(n, _U)
        for j in range(k if n else 0):
            h += words[j:j + n] * _ODD[j]
        h, at = mix(h[whole] + _U(k)), doc[:n][whole]
        counts = np.bincount(doc, minlength=n_docs)
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            first = np.searchsorted(doc, short)
            own = np.array([(words[f:f + c] * _ODD[:c]).sum() + _U(c) for f, c in zip(first, counts[short])], _U)
            into = np.searchsorted(at, short)
            h, at = np.insert(h, into, mix(own)), np.insert(at, into, short)
    return h, at
