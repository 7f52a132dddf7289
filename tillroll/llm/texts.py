"""Vectorised views of Arrow text columns: words, word hashes and shingles.

All of it works on UTF-8 bytes with numpy, over whole batches at once. Words
are maximal runs of bytes other than 0x20 and 0x09-0x0D; only A-Z are
lower-cased (UTF-8 continuation bytes never collide with either set). Hashes
are 64 bits wide and do not depend on the process or machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_RNG = np.random.Generator(np.random.PCG64(20240601))
RAW_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_CODE = RAW_CODE[_LOWER]
_WEIGHT = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _RNG.integers(1, 2**63, 64, dtype=np.uint64)

#: Bytes hashed at a time; a longer run without a space is taken whole.
SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SEGMENT + 4096)
        _powers[:] = [
            np.cumprod(np.where(np.arange(size) == 0, np.uint64(1), np.uint64(b)), dtype=np.uint64)
            for b in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, a bijection of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column, most: int = 2 << 20):
    """(first row, end row) of runs of rows with about ``most`` bytes of text each."""
    _, offsets = flat(column)
    n = len(offsets) - 1
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray = RAW_CODE) -> np.ndarray:
    """Hash of each of some spans of ``data`` in order; equal bytes (as told apart
    by ``codes``) have equal hashes wherever they stand."""
    hashes = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):  # whole spans, about SEGMENT bytes at a time
        last = max(at + 1, int(np.searchsorted(end, start[at] + SEGMENT, "right")))
        lo, hi = int(start[at]), int(end[last - 1])
        power, inverse = _power_tables(hi - lo)
        terms = codes[data[lo:hi]]
        terms *= power[: hi - lo]
        total = np.empty(hi - lo + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(terms, out=total[1:])
        s, e = start[at:last] - lo, end[at:last] - lo
        hashes[at:last] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = last
    return hashes


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and hash of each word, in order."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    inside = ~_SPACE[data]
    rows = offsets[:-1][offsets[:-1] < n]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[rows] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[rows[rows > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    hashes = span_hashes(data, start, end, _CODE)
    row = np.searchsorted(offsets, start, "right") - 1
    return start, end, row, hashes


def shingles(row: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``k`` words of a row; a row with fewer words
    has its whole sequence as one; a row without words has none."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n >= k:
        whole = row[: n - k + 1] == row[k - 1 :]
        run = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            run += hashes[j : n - k + 1 + j] * _WEIGHT[j]
        run, at = mix(run[whole]), row[: n - k + 1][whole]
    else:
        run, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.append(first, n))
    short = size < k
    if short.any():
        f, m = first[short], size[short]
        own = _SHORT[m].copy()
        for j in range(k - 1):
            has = m > j
            own[has] += hashes[f[has] + j] * _WEIGHT[j]
        run, at = np.concatenate([run, mix(own)]), np.concatenate([at, row[f]])
        order = np.argsort(at, kind="stable")
        run, at = run[order], at[order]
    return run, at


def distinct(run: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), sorted by row, then hash."""
    if not len(run):
        return run, at
    run = run.copy()
    edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        run[a:b].sort()
    new = np.concatenate([[True], (run[1:] != run[:-1]) | (at[1:] != at[:-1])])
    return run[new], at[new]


def shingle_sets(column, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row of a string column, with their rows."""
    data, offsets = flat(column)
    _, _, row, hashes = words(data, offsets)
    return distinct(*shingles(row, hashes, k))
