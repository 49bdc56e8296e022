"""Words of whole texts as 64-bit hashes, many texts at a time.

Words are runs of bytes other than ASCII white space (space, tab to carriage
return) in UTF-8. A word's hash is a polynomial in its bytes modulo 2^64
over a table of random byte values, so all words of a slice come from one
running sum.
"""

from __future__ import annotations

import numpy as np

from promolens.llm.common import text_bytes
from promolens.llm.token_index import mix64

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
_ODD = _U(0x2545F4914F6CDD1D | 1)
_BYTES = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
BLOCK = 1 << 20
_POWERS: list[np.ndarray] = []


def powers(n: int, odd: np.uint64 = _ODD) -> np.ndarray:
    out = np.full(n, odd, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def inverse(odd: np.uint64) -> np.uint64:
    return _U(pow(int(odd), -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK + 1)
        _POWERS[:] = [powers(size), powers(size, inverse(_ODD))]
    return _POWERS[0], _POWERS[1]


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; no word spans two texts."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = SPACE[raw]
    edge = off[(off > 0) & (off < n)]
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    before[edge] = True
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    after[edge - 1] = True
    return np.flatnonzero(before & ~space), np.flatnonzero(after & ~space) + 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hash of each word (``fold``: A-Z as a-z), in blocks of bounded size
    (one longer word is a block of its own)."""
    out, table, i = np.empty(len(starts), _U), _FOLDED if fold else _BYTES, 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        pw, inv = _powers(int(ends[j - 1] - lo))
        run = np.zeros(ends[j - 1] - lo + 1, _U)
        np.cumsum(table[raw[lo: ends[j - 1]]] * pw[: ends[j - 1] - lo], out=run[1:])
        out[i:j] = (run[ends[i:j] - lo] - run[starts[i:j] - lo]) * inv[starts[i:j] - lo]
        i = j
    return mix64(out)


def words(arr, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, for each text where its words begin and the end)."""
    raw, off = text_bytes(arr)
    starts, ends = word_spans(raw, off)
    return word_hashes(raw, starts, ends, fold), np.searchsorted(starts, off)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words (over all texts on end)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = hashes[:n].copy()
    for j in range(1, size):
        out *= _ODD
        out += hashes[j: j + n]
    return mix64(out)


def shingle_sets(arr, size: int, fold: bool = True) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; fewer words: the whole sequence
    as one, hashed apart; no word: none."""
    h, at = words(arr, fold)
    all_runs, out = shingles(h, size), []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(all_runs[a: b - size + 1]))
        elif b > a:
            out.append(mix64(shingles(h[a:b], b - a) + _U(b - a)))
        else:
            out.append(np.zeros(0, _U))
    return out
