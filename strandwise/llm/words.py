"""Words of many texts at once, as 64-bit hashes in numpy arrays, for use inside tasks."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that belong to words: ASCII letters and digits, and all of other characters.
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salt(n: int) -> np.uint64:
    """The n-th of a series of well spread constants."""
    return np.uint64(n * int(ODD) & (2**64 - 1))


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.multiply.accumulate(np.full(max(n, 64), ODD))
    return _powers


def hashed_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in lower case, and where each text's words begin (one more than texts)."""
    raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    inside = IN_WORD[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    texts_at = np.cumsum([0, *[len(r) + 1 for r in raw]])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    lengths = ends - starts
    places = np.flatnonzero(inside)
    within = np.arange(len(places)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    summed = np.add.reduceat(data[places].astype(np.uint64) * powers(int(lengths.max()))[within], np.cumsum(lengths) - lengths)
    return mix(summed), np.searchsorted(starts, texts_at)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, also across texts: callers leave out the last k - 1 of each text."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = mix(out * ODD + words[i : i + len(out)])
    return out


def gram_places(bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, place among all words) of every k-gram that lies within one text."""
    counts = np.maximum(np.diff(bounds) - k + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return text, np.arange(counts.sum()) - np.repeat(first - bounds[:-1], counts)
