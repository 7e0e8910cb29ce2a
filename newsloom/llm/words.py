"""Words, shingles and their hashes, in numpy batches; shared by the operators on similar texts.

A word is a maximal run of letters and digits of the lower-cased text. A shingle is a run of k
words. Hashes are 64 bits; the same text gives the same hashes on every machine.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_MOST = 1_000_000
_known: dict[str, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A full avalanche of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words in order; hashes met before come from a bounded memo."""
    words = WORD.findall(text.lower())
    try:
        return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_known) > _MOST:
            _known.clear()
        for w in words:
            if w not in _known:
                _known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, in order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = (h ^ (h >> np.uint64(29))) * _A + words[j : j + n] * _B + _C
    return mix(h)


def shingle_set(text: str, k: int) -> tuple[int, np.ndarray]:
    """(number of words, sorted distinct shingle hashes)."""
    w = word_hashes(text)
    return len(w), np.unique(shingles(w, k))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets, exact."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def jaccard_at_least(a: np.ndarray, b: np.ndarray, t: float) -> bool:
    both = common(a, b)
    return both > 0 and both >= t * (len(a) + len(b) - both) - 1e-9


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """Distinct fingerprints: the least hash of every window of w, so that any run of w equal
    shingles leaves an equal fingerprint in both texts."""
    if len(h) < w:
        return np.array([h.min()], np.uint64) if len(h) else h
    return np.unique(np.lib.stride_tricks.sliding_window_view(h, w).min(axis=1))


def word_lists(texts: list, least_words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows kept, word hashes of each): null texts and those of fewer than ``least_words`` are left out."""
    rows, words = [], []
    for i, x in enumerate(texts):
        if x is not None:
            w = word_hashes(x)
            if len(w) >= least_words:
                rows.append(i), words.append(w)
    return np.array(rows, np.int64), words


def slice_sets(h: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of the slices h[at : at + n], as (where each begins, values)."""
    out = np.concatenate([h[a : a + k] for a, k in zip(at.tolist(), n.tolist())])
    ends = np.cumsum(n)
    begin = ends - n
    for a, z in zip(begin.tolist(), ends.tolist()):
        out[a:z].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[begin] = True
    return np.concatenate([[0], np.cumsum(np.add.reduceat(keep.astype(np.int64), begin))]), out[keep]


def sets_of_words(words: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of many word lists of k words or more: (where each begins, hashes)."""
    if not words:
        return np.zeros(1, np.int64), np.empty(0, np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    h = shingles(np.concatenate(words), k)  # those that run over a text's end are never sliced out
    return slice_sets(h, np.cumsum(size) - size, size - k + 1)


def winnowed_words(words: list[np.ndarray], k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """``winnow`` of the k-word shingles of many word lists of k words or more: (where each begins, hashes)."""
    if not words:
        return np.zeros(1, np.int64), np.empty(0, np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.cumsum(size) - size
    h = shingles(np.concatenate(words), k)
    n = size - k + 1
    low = np.lib.stride_tricks.sliding_window_view(h, w).min(axis=1) if len(h) >= w else np.empty(0, np.uint64)
    short = np.flatnonzero(n < w)
    m = np.maximum(n - w + 1, 1)
    if len(short):  # fewer shingles than a window: the least of them all
        low = np.concatenate([low, np.zeros(max(0, len(h) - len(low)), np.uint64)])
        for i in short:
            low[at[i]] = h[at[i] : at[i] + n[i]].min()
    return slice_sets(low, at, m)


def shingle_sets(texts: list, k: int, least_words: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles of many texts at once: (rows kept, where each begins, hashes).

    Null texts and those of fewer than ``least_words`` (or k) words are left out."""
    rows, words = word_lists(texts, max(least_words, k))
    return rows, *sets_of_words(words, k)
