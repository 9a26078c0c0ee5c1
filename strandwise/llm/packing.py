"""Packing documents into fixed training sequences: bounded-space online best fit.

Each partition keeps a fixed number of open windows. A piece goes to the window
that it fills best; when none has room, the fullest is emitted and a new one
opens. What is still open at the end of a partition is merged with the left
windows of other partitions, in tasks of bounded size.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, materialize, small_batches

SEQUENCE_TOKENS = 2048
OPEN_WINDOWS = 64
END_ID = 1
#: Marks that the vocabulary splits off the end of a word, as one run.
PUNCTUATION = ".,;:!?\"#$%&()*+-/=@[]_{}~"
#: Words whose ids a Python worker remembers; beyond it, the memory starts anew.
REMEMBERED_WORDS = 700_000
#: Left windows that one merging task gets, on average.
MERGE_WINDOWS = 512

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_tokenizers: dict = {}


class WordIds:
    """Token ids of texts, as bytes of little-endian unsigned 32-bit numbers.

    The vocabulary splits at white space before it merges, so a text's ids are
    those of its words in order, and a word goes through the tokenizer once.
    Plain Latin words are also looked up without case and final points and
    other marks, which this vocabulary lower-cases and splits off. The vocabulary's
    special tokens are found in a text before all else, so it is split at them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {x.content: np.asarray([i], "<u4").tobytes() for i, x in self.tokenizer.get_added_tokens_decoder().items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {"": b""}

    def each(self, words: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in got]

    def learn_cores(self, cores: list[str]) -> None:
        """Many words at a time, told apart by the ids that end a word."""
        groups = [cores[i : i + 64] for i in range(0, len(cores), 64)]
        for group, got in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.asarray(got.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(group):
                raw = ids.tobytes()
                self.cores.update(zip(group, (raw[4 * i : 4 * j] for i, j in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)), strict=True))
            else:
                self.cores.update(zip(group, self.each(group), strict=True))

    def learn(self, words: list[str]) -> None:
        known, cores = self.known, self.cores
        bare = [w.rstrip(PUNCTUATION) for w in words]
        plain = [b.isalpha() and max(b) < "\u0250" and "\u0130" not in b for b in bare]
        low = [b.lower() for b in bare]
        tails = [w[len(b) :] for w, b in zip(words, bare, strict=True)]
        if new := list(set(tails).difference(cores)):
            cores.update(zip(new, self.each(new), strict=True))
        if new := list(set(compress(low, plain)).difference(cores)):
            self.learn_cores(new)
        known.update((w, cores[c] + cores[t]) for w, c, t in compress(zip(words, low, tails, strict=True), plain))
        if other := [w for w, p in zip(words, plain, strict=True) if not p]:
            known.update(zip(other, self.each(other), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.special or not any(x in t for x in self.special for t in texts):
            return self.encode_plain(texts)
        parts = [self.at_special.split(t) for t in texts]  # plain text and special tokens by turns
        plain = iter(self.encode_plain([x for part in parts for x in part[::2]]))
        return [b"".join(self.special[x] if i % 2 else next(plain) for i, x in enumerate(part)) for part in parts]

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > REMEMBERED_WORDS:
            self.known = {"": b""}
        if len(self.cores) > REMEMBERED_WORDS:
            self.cores = {"": b""}
        new = list(set().union(*split).difference(self.known))
        for i in range(0, len(new), 20_000):
            self.learn(new[i : i + 20_000])
        of = self.known.__getitem__
        return [b"".join(map(of, words)) for words in split]


def word_ids(path: str) -> WordIds:
    """The worker's own encoder, kept from task to task."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


class Windows:
    """Open windows, found by room: sorted (room, number) pairs."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.open: list[tuple[int, int]] = []
        self.held: dict[int, list] = {}
        self.made = 0

    def place(self, length: int, item) -> tuple[int, int, list]:
        """(window, offset, items of windows emitted); the caller's items are kept with their offsets."""
        done = []
        k = bisect_left(self.open, (length, -1))
        if k < len(self.open):
            room, number = self.open.pop(k)
        else:
            if len(self.open) >= self.limit:
                done.append(self.emit(0))
            room, number = self.size, self.made
            self.made += 1
            self.held[number] = []
        self.held[number].append((self.size - room, item))
        insort(self.open, (room - length, number))
        if room == length:
            done.append(self.emit(0))
        return number, self.size - room, done

    def emit(self, k: int):
        _, number = self.open.pop(k)
        return number, self.held.pop(number)


def cut(ids: bytes, size: int) -> list[tuple[int, int, int]]:
    """(start, length, crc) of pieces of at most size ids."""
    n = len(ids) // 4
    return [(s, min(size, n - s), zlib.crc32(ids[4 * s : 4 * min(n, s + size)])) for s in range(0, n, size)]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


FIRST = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("left", pa.int64())])


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, windows: int = OPEN_WINDOWS, merge_windows: int = MERGE_WINDOWS) -> DataFrame:
    """One row for each piece of a document, with its sequence and place there.

    A null or empty text is the end id alone. A text longer than a sequence is
    cut into full ones and a rest. Repeated rows and repeated ids are packed
    row by row; an empty table gives no pieces; other columns are ignored.
    The first pass is written to the shared folder: it holds a few numbers for
    each piece, and a lost executor only repeats its own partition.
    """
    small_batches(docs.sparkSession)

    def first(batches):
        encoder, part = word_ids(tokenizer_path), TaskContext.get().partitionId()
        bins, rows, extra = Windows(size, windows), [], 1 << 31

        def put(done):
            for number, items in done:
                rows.extend((*piece, (part << 32) + number, offset, None) for offset, piece in items)

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                piece_of = batch.slice(lo, 512).to_pydict()
                for doc, ids in zip(piece_of["doc_id"], encoder.encode(piece_of["text"]), strict=True):
                    ids += END_ID.to_bytes(4, "little")
                    n = len(ids) // 4
                    for start, length, crc in cut(ids, size):
                        piece = (doc, start, length, crc, n)
                        if length == size:
                            rows.append((*piece, (part << 32) + extra, 0, None))
                            extra += 1
                        else:
                            put(bins.place(length, piece)[2])
                if len(rows) >= 5000:
                    yield _batch(rows, FIRST)
                    rows.clear()
        while bins.open:
            room, number = bins.open[0]
            rows += [(*piece, (part << 32) + number, offset, size - room) for offset, piece in bins.emit(0)[1]]
        if rows:
            yield _batch(rows, FIRST)

    made = materialize(docs.select("doc_id", body().alias("text")).mapInArrow(first, PIECES + ", left long"), "pack-pieces")
    whole = made.where("left is null").drop("left")
    left = made.where("left is not null")
    tasks = max(1, -(-left.where("offset = 0").count() // merge_windows))

    def merge(table: pa.Table) -> pa.Table:
        """Left windows are packed anew, the largest first; their pieces move along."""
        if not table.num_rows:
            return table.drop_columns(["left", "task"])
        frame = table.to_pandas().sort_values(["left", "sequence_id", "offset"], ascending=[False, True, True], kind="stable")
        task, bins, moved = int(frame["task"].iloc[0]), Windows(size, 1 << 40), {}
        for number, length in frame[["sequence_id", "left"]].drop_duplicates("sequence_id").itertuples(index=False):
            moved[number] = bins.place(int(length), None)[:2]
        frame["offset"] += frame["sequence_id"].map(lambda x: moved[x][1])
        frame["sequence_id"] = frame["sequence_id"].map(lambda x: (1 << 62) + (task << 32) + moved[x][0])
        return pa.Table.from_pandas(frame.drop(columns=["left", "task"]), preserve_index=False)

    merged = left.withColumn("task", F.pmod(F.xxhash64("sequence_id"), F.lit(tasks))).groupBy("task").applyInArrow(merge, PIECES)
    return whole.unionByName(merged)
