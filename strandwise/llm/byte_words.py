"""Words of many texts at once on their UTF-8 bytes, for use inside tasks.

Only A-Z change case, and all separators are ASCII, so bytes tell words apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .words import mix, powers

#: Bytes of texts that are worked on at a time; a longer text comes alone.
CHUNK = 3 << 20
#: Bytes of words that are hashed at a time.
SLICE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags that are set in the closed ranges."""
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


@dataclass
class Words:
    """Words of texts in one lower-case buffer: where they start and end, their hashes, and the words of text i from bounds[i] to bounds[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def hash_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes."""
    lengths = ends - starts
    out, before = np.zeros(len(starts), np.uint64), np.cumsum(lengths) - lengths
    cuts = np.unique(np.searchsorted(before, np.arange(0, int(lengths.sum()) + SLICE, SLICE))).tolist()
    for lo, hi in zip(cuts, [*cuts[1:], len(starts)]):
        if lo < hi:
            n, first = lengths[lo:hi], before[lo:hi] - before[lo]
            within = np.arange(int(n.sum())) - np.repeat(first, n)
            values = data[np.repeat(starts[lo:hi], n) + within].astype(np.uint64)
            out[lo:hi] = np.add.reduceat((values + np.uint64(1)) * powers(int(n.max()))[within], first)
    return mix(out)


def words_of(texts: list[bytes], inside: np.ndarray) -> Words:
    """Words are the longest stretches of bytes of the set. A line feed, outside of it, stands between texts."""
    data = LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)] if texts else np.zeros(0, np.uint8)
    edge = np.flatnonzero(np.diff(inside[data], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    texts_at = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return Words(data, starts, ends, hash_slices(data, starts, ends), np.searchsorted(starts, texts_at))


def chunks(batches: Iterator[pa.RecordBatch], text: str, *others: str, size: int = CHUNK) -> Iterator[tuple[list[bytes], list[list]]]:
    """(texts as bytes, other columns as lists) of about ``size`` bytes of text at a time. A null text is empty."""
    held, columns, n = [], [[] for _ in others], 0
    for batch in batches:
        rest = [batch[c].to_pylist() for c in others]
        for i, t in enumerate(batch[text].cast(pa.binary())):
            t = t.as_py() or b""
            if held and n + len(t) > size:
                yield held, columns
                held, columns, n = [], [[] for _ in others], 0
            held.append(t)
            for own, values in zip(columns, rest):
                own.append(values[i])
            n += len(t) + 1
    if held:
        yield held, columns


def joined(words: Words, first: np.ndarray, n: int) -> list[str]:
    """The n words from each of the given ones on, with one space between them."""
    of = (first[:, None] + np.arange(n)[None, :]).ravel()
    starts, lengths = words.starts[of], words.ends[of] - words.starts[of]
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    buffer = np.full(int(at[-1]), 32, np.uint8)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    buffer[np.repeat(at[:-1], lengths) + within] = words.data[np.repeat(starts, lengths) + within]
    raw, cuts = buffer.tobytes(), at[::n].tolist()
    return [raw[a : b - 1].decode("utf-8") for a, b in zip(cuts, cuts[1:])]
