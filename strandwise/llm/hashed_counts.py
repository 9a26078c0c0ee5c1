"""Counts of hashed things in packed pieces, Misra-Gries summaries of them, and bit tables of what survives.

A hash partition is a range of hashes. Tasks send one row for each partition
and piece of their input, so that rows stay few and compress well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hash partitions for each partition of a shuffle, so that their sizes even out.
FINER = 8
#: Counters of a summary at least.
LEAST_CAPACITY = 1 << 15
#: Bits of a table for each entry, and the logarithm of the most that it may have (32 MB); beyond that more entries share a bit.
SPARE, MOST_BITS = 256, 28

PIECE = pa.schema([("part", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
PIECE_DDL = "part int, hashes binary, counts binary"


def added_up(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and their summed counts."""
    if counts is None:
        return np.unique(hashes, return_counts=True)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], (np.add.reduceat(counts, first) if len(first) else counts)


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes, then all second ones: high bytes are mostly zero and compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def pieces(hashes: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """A packed row for each partition that has any of the distinct, ordered hashes."""
    part = part_of(hashes, parts)
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    rows = []
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]):
        steps = np.diff(hashes[lo:hi], prepend=np.uint64(0))
        rows.append((int(part[lo]), planes(steps), planes(counts[lo:hi].astype(np.int64))))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(PIECE)], schema=PIECE)


def unpacked(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(from_planes(hashes, np.uint64), dtype=np.uint64), from_planes(counts, np.int64)


class Summary:
    """A Misra-Gries summary of weighted entries with so many counters.

    When there are more, all lose as much as the largest that has to go. Whatever comes
    in has its true count within ``lost`` above its counter, or of ``lost`` at most
    without a counter; ``lost`` is at most the mass by the number of counters and one.
    A summary is merged by putting in its counters and adding what it lost.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost, self.mass = capacity, 0, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def put(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((hashes, counts))
        self._held += len(hashes)
        self.mass += int(counts.sum())
        if self._held > self.capacity:
            self.settle()

    def settle(self) -> None:
        """Put in what waits, and trim."""
        if self._waiting:
            waiting = [(self.hashes, self.counts), *self._waiting]
            self.hashes, self.counts = added_up(*(np.concatenate(x) for x in zip(*waiting)))
            self._waiting, self._held = [], 0
        over = len(self.counts) - self.capacity
        if over > 0:
            cut = int(np.partition(self.counts, over - 1)[over - 1])
            self.lost += cut
            kept = self.counts > cut
            self.hashes, self.counts = self.hashes[kept], self.counts[kept] - cut

    def merge(self, other: Summary) -> None:
        other.settle()
        mass = self.mass
        self.put(other.hashes, other.counts)
        self.mass, self.lost = mass + other.mass, self.lost + other.lost


FOUND = pa.schema([("part", pa.int32()), ("lost", pa.int64()), ("mass", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary())])
FOUND_DDL = "part int, lost long, mass long, n long, hashes binary"


def summarised(packed: DataFrame, threshold: int, capacity: int) -> DataFrame:
    """(part, lost, mass, n, hashes) of each hash partition: all hashes that may count ``threshold``, if lost stays below it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, Summary] = {}
        for batch in batches:
            for part, hashes, counts in zip(*(batch[c].to_pylist() for c in ("part", "hashes", "counts"))):
                open_.setdefault(part, Summary(capacity)).put(*unpacked(hashes, counts))
        for part, s in open_.items():
            s.settle()
            kept = s.hashes[s.counts + s.lost >= threshold]
            row = [[part], [s.lost], [s.mass], [len(kept)], [kept.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, FOUND)], schema=FOUND)

    return packed.repartition(partitions(packed), "part").mapInArrow(run, FOUND_DDL)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class BitTable:
    """Bits of the leading digits of hashes. ``has`` is true for all that were put in, and for few others."""

    def __init__(self, log: int, raw: bytes):
        self.log, self.raw = log, raw

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.log)
        return (np.frombuffer(self.raw, np.uint8)[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def bit_table(found: DataFrame) -> BitTable:
    """The table of the hashes of found (n, hashes). Tasks make stretches of it, so the driver holds no more than its bits."""
    n = found.agg(F.sum("n")).first()[0] or 0
    log = min(MOST_BITS, max(10, int(np.ceil(np.log2(max(1, n) * SPARE)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch["hashes"].to_pylist():
                if raw:
                    at = np.unique(np.frombuffer(raw, np.uint64) >> np.uint64(64 - log)).astype(np.int64)
                    first = int(at[0]) >> 3
                    bits = np.zeros((int(at[-1]) // 8 - first + 1) * 8, np.uint8)
                    bits[at - first * 8] = 1
                    yield pa.RecordBatch.from_pydict({"first": pa.array([first]), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    table = np.zeros(1 << log >> 3, np.uint8)
    for row in found.select("hashes").mapInArrow(run, "first long, bits binary").toLocalIterator():
        own = np.frombuffer(row.bits, np.uint8)
        table[row.first : row.first + len(own)] |= own
    return BitTable(log, table.tobytes())
