"""Repeated passages by a sparse suffix array.

Suffixes are kept only at content-selected places: the smallest k-gram hash of
each window of k-grams. Equal passages select the same places, so any passage
of at least MIN_WORDS words that repeats has one in common. Kept suffixes are
sorted by their words; neighbours in that order share the longest beginnings,
and matches are extended left and right from there. Where more suffixes begin
alike than are compared, hashes of all runs of MIN_WORDS words decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, join_counted, materialize, small_batches, stand_ins, without_stand_ins
from .words import ODD, grams, hashed_words, mix

MIN_WORDS = 50
GRAM = 10
#: Earlier neighbours that a suffix is compared to.
NEIGHBOURS = 3


def minimisers(value: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of each window, in order; of all, if there are fewer."""
    if not len(value):
        return np.zeros(0, np.int64)
    if len(value) <= window:
        return np.array([int(value.argmin())])
    return np.unique(selected(value, window))


def selected(value: np.ndarray, window: int) -> np.ndarray:
    """Place of the smallest hash of each window; there is one window at least."""
    views = np.lib.stride_tricks.sliding_window_view(value, window)
    out = [views[i : i + 4096].argmin(axis=1) + np.arange(i, min(i + 4096, len(views))) for i in range(0, len(views), 4096)]
    return np.concatenate(out)


def select_suffixes(docs: DataFrame, k: int, window: int) -> DataFrame:
    """(doc_id, pos, gram) at the selected places."""
    schema = pa.schema([("doc_id", pa.int64()), ("pos", pa.int32()), ("gram", pa.int64())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                words, bounds = hashed_words(part["text"].to_pylist())
                all_grams = grams(words, k)
                ids, places, values = [], [], []
                for i in range(part.num_rows):
                    own = all_grams[bounds[i] : max(bounds[i], bounds[i + 1] - k + 1)]
                    at = minimisers(own, window)
                    ids.append(np.full(len(at), i))
                    places.append(at)
                    values.append(own[at])
                ids = np.concatenate(ids)
                yield pa.RecordBatch.from_arrays([part["doc_id"].take(pa.array(ids, pa.int64())), pa.array(np.concatenate(places), pa.int32()), pa.array(np.concatenate(values).view(np.int64))], schema=schema)

    return docs.mapInArrow(run, "doc_id long, pos int, gram long")


SUFFIX = "doc_id long, pos int, gram long, r1 long, r2 long, r3 long, r4 long, left binary, right binary"


def with_context(chosen: DataFrame, docs: DataFrame, k: int, reach: int) -> DataFrame:
    """Suffixes with their sort key (hashes of the following k-grams) and word hashes around."""
    schema = pa.schema([("doc_id", pa.int64()), ("pos", pa.int32()), *[(c, pa.int64()) for c in ("gram", "r1", "r2", "r3", "r4")], ("left", pa.binary()), ("right", pa.binary())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                words, bounds = hashed_words(part["text"].to_pylist())
                short = (words >> np.uint64(32)).astype("<u4")
                rows = [[] for _ in schema]
                for i, (doc, places) in enumerate(zip(part["doc_id"].to_pylist(), part["places"].to_pylist(), strict=True)):
                    own, brief = words[bounds[i] : bounds[i + 1]], short[bounds[i] : bounds[i + 1]]
                    value = grams(own, k)
                    places = np.sort(np.array(places, np.int64))
                    places = places[places < len(value)]
                    if not len(places):
                        continue
                    keys = np.stack([np.where(places + j * k < len(value), value[np.minimum(places + j * k, len(value) - 1)], np.uint64(0)) for j in range(5)], axis=1).view(np.int64)
                    for p, key in zip(places.tolist(), keys.tolist(), strict=True):
                        for column, x in zip(rows, (doc, p, *key, brief[max(0, p - reach) : p].tobytes(), brief[p : p + reach].tobytes()), strict=True):
                            column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

    return _with_places(chosen, docs).mapInArrow(run, SUFFIX)


def _with_places(chosen: DataFrame, docs: DataFrame) -> DataFrame:
    places = chosen.groupBy("doc_id").agg(F.collect_set("pos").alias("places"))
    return docs.join(places, "doc_id").select("doc_id", "places", "text")


def windows(chosen: DataFrame, docs: DataFrame, k: int, min_words: int) -> DataFrame:
    """(doc_id, s, key): first word and hash of every run of min_words words whose selected place is chosen."""
    schema = pa.schema([("doc_id", pa.int64()), ("s", pa.int32()), ("key", pa.int64())])
    steps = [*range(0, min_words - k, k), min_words - k]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                words, bounds = hashed_words(part["text"].to_pylist())
                all_grams = grams(words, k)
                of, firsts, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for i, places in enumerate(part["places"].to_pylist()):
                    own = all_grams[bounds[i] : max(bounds[i], bounds[i + 1] - k + 1)]
                    n = len(own) - (min_words - k)
                    if n <= 0:
                        continue
                    wanted = np.zeros(len(own), bool)
                    wanted[[p for p in places if p < len(own)]] = True
                    s = np.flatnonzero(wanted[selected(own, min_words - k + 1)])
                    key = np.zeros(len(s), np.uint64)
                    for step in steps:
                        key = mix(key * ODD + own[s + step])
                    of.append(np.full(len(s), i))
                    firsts.append(s)
                    keys.append(key)
                of = np.concatenate(of)
                yield pa.RecordBatch.from_arrays([part["doc_id"].take(pa.array(of)), pa.array(np.concatenate(firsts), pa.int32()), pa.array(np.concatenate(keys).view(np.int64))], schema=schema)

    return _with_places(chosen, docs).mapInArrow(run, "doc_id long, s int, key long")


def _common(a: bytes, b: bytes, backwards: bool) -> int:
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    n = min(len(x), len(y))
    if not n:
        return 0
    same = x[-n:][::-1] == y[-n:][::-1] if backwards else x[:n] == y[:n]
    return n if same.all() else int(same.argmin())


def matches(rows: list[tuple], min_words: int, neighbours: int) -> list[tuple]:
    """(doc_id, first word, end) of both sides of each long match among sorted (doc_id, pos, gram, left, right)."""
    out = []
    for i, (doc, pos, gram, left, right) in enumerate(rows):
        for other in rows[max(0, i - neighbours) : i]:
            if other[2] != gram or other[0] == doc:
                continue
            before, after = _common(left, other[3], True), _common(right, other[4], False)
            if before + after >= min_words:
                out += [(doc, pos - before, pos + after), (other[0], other[1] - before, other[1] + after)]
    return out


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, k: int = GRAM, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, spans, repeated_words): passages of at least min_words words that stand in another document too.

    Spans are [first word, end) of maximal stretches. Documents without any have
    no row, and so have null, empty and short texts and an empty table. Rows of
    one doc_id count as one document; a row without doc_id is a document of its own.
    Other columns are ignored.

    A gram with up to ``neighbours`` + 1 places is sorted with its suffixes in one
    task, where each is compared to all before it. For one with more, the runs
    of min_words words around its places are looked up by their hashes, so that
    no number of neighbours decides, and every place gets its span.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs, stand_in = stand_ins(docs.select("doc_id", body().alias("text")))
    window = min_words - k + 1
    suffixes = materialize(select_suffixes(docs, k, window), "suffixes")
    twice = suffixes.groupBy("gram").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a <> b").select("gram", "n")
    twice = materialize(twice.withColumn("few", F.col("n") <= neighbours + 1), "repeated-grams")
    chosen = materialize(join_counted(suffixes, twice, "gram").select("doc_id", "pos", "few"), "places")
    rows = with_context(chosen.where("few"), docs, k, min_words)
    order = ["gram", "r1", "r2", "r3", "r4", "doc_id", "pos"]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = pa.schema([("doc_id", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])

    def run(batches):
        tail = []
        for batch in batches:
            given = list(zip(*[batch[c].to_pylist() for c in ("doc_id", "pos", "gram", "left", "right")], strict=True))
            found = set(matches(tail + given, min_words, neighbours))
            tail = (tail + given)[-neighbours:]
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in found], pa.int64()) for i in range(3)], schema=schema)

    compared = rows.repartition(parts, "gram").sortWithinPartitions(*order).mapInArrow(run, "doc_id long, s long, e long")
    looked = materialize(windows(chosen.where("not few"), docs, k, min_words), "windows")
    shared = looked.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a <> b").select("key", "n")
    again = join_counted(looked, materialize(shared, "shared-windows"), "key").select("doc_id", F.col("s").cast("long").alias("s"), (F.col("s") + min_words).cast("long").alias("e"))
    spans = materialize(compared.unionByName(again), "spans")
    pairs = spans.groupBy("doc_id").agg(F.collect_set(F.struct("s", "e")).alias("found"))
    span = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def merge(batches):
        for batch in batches:
            out, total = [], []
            for found in batch["found"]:
                s, e = (found.values.field(c).to_numpy(zero_copy_only=False) for c in ("s", "e"))
                at = np.argsort(s, kind="stable")
                s, e = s[at], np.maximum.accumulate(e[at])
                first = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
                s, e = s[first], e[np.append(first[1:], len(e)) - 1]
                out.append([{"s": x, "e": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)])
                total.append(int((e - s).sum()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, span), pa.array(total, pa.int64())], names=["doc_id", "spans", "repeated_words"])

    return without_stand_ins(pairs.mapInArrow(merge, "doc_id long, spans array<struct<s:bigint,e:bigint>>, repeated_words long"), stand_in)
