"""Word shingles of whole texts as 64-bit fingerprints, vectorized per batch.

Words are runs of ASCII letters and digits and of characters beyond ASCII, in
lower case.  A text with fewer than ``width`` words has one shingle of all of
them; a text without words has none.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np

WIDTH = 5
BATCH_CHARS = 1 << 17  # texts are joined up to about this size; some ten arrays of 8 bytes each stay near the CPU

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD = np.zeros(256, np.uint8)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finalizer of a public generator, SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers


def _hashes(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints in text order, bounds of each text)."""
    encoded = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([b"", *encoded, b""]), np.uint8)
    edge = np.flatnonzero(np.diff(_WORD[data])) + 1
    starts, ends = edge[::2], edge[1::2]
    forward, backward = (p[: len(data)] for p in _power(len(data)))
    sums = np.cumsum(data * forward, dtype=np.uint64)
    words = mix((sums[ends - 1] - sums[starts - 1]) * backward[starts])
    text_ends = np.cumsum([len(e) + 1 for e in encoded])
    word_bounds = np.searchsorted(starts, np.concatenate([[0], text_ends]))
    counts = np.diff(word_bounds)
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    total = np.zeros(len(words), np.uint64)
    factor = _BASE
    for j in range(width):
        total += padded[j : j + len(words)] * factor
        factor = factor * _BASE
    at = np.repeat(word_bounds[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
    out = total[at]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        factor, h = _BASE, np.uint64(0)
        for w in words[word_bounds[i] : word_bounds[i + 1]]:
            h, factor = h + w * factor, factor * _BASE
        out[bounds[i]] = h + np.uint64(counts[i])
    return mix(out), bounds


def of_texts(texts: list[str], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The fingerprints of each text, repeated shingles included."""
    at, size = 0, 0
    with np.errstate(over="ignore"):
        for i, t in enumerate(texts):
            size += len(t)
            if size >= BATCH_CHARS or i == len(texts) - 1:
                hashes, bounds = _hashes(texts[at : i + 1], width)
                for a, b in zip(bounds[:-1], bounds[1:]):
                    yield hashes[a:b]
                at, size = i + 1, 0


def counted(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ascending, occurrences)."""
    s = np.sort(fingerprints)
    if not len(s):
        return s, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.diff(np.concatenate([first, [len(s)]]))


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(lens)
    return np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)


def give_back() -> None:
    """Returns freed memory to the system: a worker process outlives its task and
    would hold, idle, what its largest arrays took.  Without glibc nothing happens."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
