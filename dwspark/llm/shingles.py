"""Word-shingle sets and MinHash signatures of texts, in numpy.

Words are runs of anything but ASCII white space, A-Z lower-cased. A shingle is
a 64-bit hash of five words in a row; a text of fewer words is one shingle, a
text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SEGMENT = 1 << 21           # bytes hashed at a time
VALUE_BITS = 0x3FFF7FFF7FFF7FFF      # of four values packed in a long
U = np.uint64

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_codes = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_base = 0x2545F4914F6CDD1D
_powers = [np.ones(1, U), np.ones(1, U)]     # of the base and of its inverse modulo 2^64; grown as needed


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, b in enumerate((_base, pow(_base, -1, 2**64))):
            p = np.full(n, b, U)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=U)
    return _powers


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words in ``data`` (bytes that end in white space)."""
    space, found, at, n = _space[data], [], [], len(data)
    ends = np.flatnonzero(space)
    lo = 0
    while lo < n:
        # a segment ends in white space, so no word is cut
        k = np.searchsorted(ends, min(lo + SEGMENT, n) - 1)
        hi = int(ends[min(k, len(ends) - 1)]) + 1
        s, low = space[lo:hi], _lower[data[lo:hi]]
        first = np.flatnonzero(~s & np.concatenate(([True], s[:-1])))
        stop = np.flatnonzero(s & np.concatenate(([False], ~s[:-1])))
        up, down = _power(hi - lo + 1)
        total = np.concatenate((np.zeros(1, U), np.cumsum(_codes[low] * up[:hi - lo], dtype=U)))
        found.append(mix((total[stop] - total[first]) * down[first]))
        at.append(first + lo)
        lo = hi
    return (np.concatenate(found), np.concatenate(at)) if found else (np.zeros(0, U), np.zeros(0, np.int64))


def shingle_sets(texts: Iterable[str | None], width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    held, size = [], 0
    for t in texts:
        held.append((t or "").encode())
        size += len(held[-1])
        if size >= SEGMENT:
            yield from _sets(held, width)
            held, size = [], 0
    yield from _sets(held, width)


def _sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    words, at = word_hashes(data)
    bounds = np.searchsorted(at, np.cumsum([len(t) + 1 for t in texts]))
    chain = words.copy()
    for k in range(1, width):
        chain[:len(words) - k] = chain[:len(words) - k] * U(0x9FB21C651E98DF25) + words[k:]
    chain = mix(chain)
    lo = 0
    for hi in bounds:
        n = hi - lo
        if n >= width:
            yield np.unique(chain[lo:hi - width + 1])
        elif n:
            x = U(n)
            with np.errstate(over="ignore"):
                for w in words[lo:hi]:
                    x = x * U(0x9FB21C651E98DF25) + w
            yield mix(np.array([x], U))
        else:
            yield np.zeros(0, U)
        lo = hi


def signatures(sets: list[np.ndarray], n_values: int) -> np.ndarray:
    """Some bits of each of ``n_values`` minhashes of each set, four to a long (see VALUE_BITS); zeros for an empty set."""
    out = np.zeros((len(sets), n_values), np.uint16)
    rows = [i for i, s in enumerate(sets) if len(s)]
    multipliers = mix(np.arange(1, n_values + 1, dtype=U) * U(0xA0761D6478BD642F)) | U(1)
    lo = 0
    while lo < len(rows):
        hi, n = lo, 0
        while hi < len(rows) and (n < 200_000 or hi == lo):
            n += len(sets[rows[hi]])
            hi += 1
        some = [sets[i] for i in rows[lo:hi]]
        flat = np.concatenate(some)
        begin = np.concatenate(([0], np.cumsum([len(s) for s in some])[:-1]))
        for j, m in enumerate(multipliers):
            out[rows[lo:hi], j] = (mix(np.minimum.reduceat(flat * m, begin)) >> U(48)).astype(np.uint16)
        lo = hi
    return out.view(np.int64) & np.int64(VALUE_BITS)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as a matrix; ``width`` shared shingles are counted at a time."""
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[a:b], column[a:b] - lo] = 1
        out += (m @ m.T).astype(np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out
