"""Benchmark decontamination: rare two-word seeds, then Smith-Waterman alignment.

A seed is a pair of words that stand next to each other in an item. Every copy that
the alignment accepts has so many of an item's pairs, next to each other or one apart
(``least_pairs``), that an item needs its rarest pairs as seeds only: as many as
leave fewer than that out, and a few more, of which every copy then has a few more. How rare
a pair is comes from a count over all documents. Seeds are joined with the places where
documents have them. Around those, where a text has enough of them, the
item is aligned word by word where there are pairs enough. Items too short for that are
looked up whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import body, materialize, small_batches
from .hashed_counts import BitTable, added_up, bit_table
from .words import ODD, gram_places, grams, hashed_words, mix, salt

#: Items of fewer words match where all their words stand next to each other, without alignment.
GRAM = 4
#: Score of a mismatch and of a gap, where a match scores 1.
PENALTY = 0.5
#: Share of an item's words that the alignment has to score.
LEAST_SCORE = 0.5
#: Seeds of an item beyond those of which every copy has one. Every copy has so many more, so texts that meet an item by chance drop out before they are shuffled.
MORE_SEEDS = 2
#: Texts whose words are hashed at a time.
TEXTS_AT_ONCE = 64
#: Items that one task aligns with one text at most; a text that meets more goes to several tasks.
ITEMS_A_TASK = 2000


def pair_hashes(words: np.ndarray, bounds: np.ndarray, steps=(1, 2)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place of the first word in it, hash) of every two words of a text that are so many apart."""
    texts, places, values = [], [], []
    for step in steps:
        text, place = gram_places(bounds, step + 1)
        texts.append(text)
        places.append(place - bounds[text])
        values.append(mix(mix(words[place] * ODD) + words[place + step]))
    return np.concatenate(texts), np.concatenate(places), np.concatenate(values)


def least_pairs(n: int, least: float, penalty: float) -> int:
    """How many pairs of neighbouring words of an item of n words any accepted alignment has, next to each other or one apart in the text.

    With M matches the edits E are (M - least n) / penalty at most. D of them leave out a
    word of the item, which breaks two pairs, and two insertions break one. D is E at
    most, and n - M; more of it is always worse.
    """
    m = np.arange(int(np.ceil(least * n - 1e-9)), n + 1)
    edits = np.floor((m - least * n) / penalty + 1e-9)
    out = np.minimum(edits, n - m)
    return max(1, int((m - 1 - out - (edits - out) // 2).min()))


def reach_of(n: int, least: float, penalty: float) -> int:
    """Words of a text that an accepted copy of an item of n words takes at most: one edit a match, as far as the score allows."""
    return int(np.ceil(n * (1 + (1 - least) / penalty)))


def align(item: np.ndarray, words: np.ndarray, penalty: float) -> tuple[float, int]:
    """Best local alignment score, and where in words it ends. One row of the matrix at a time."""
    n = len(words)
    slope = penalty * np.arange(n + 1)
    above, best, end = np.zeros(n + 1), 0.0, 0
    for w in item:
        row = np.maximum(above - penalty, 0.0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(words == w, 1.0, -penalty))
        row = np.maximum.accumulate(row + slope) - slope
        if row.max() > best:
            best, end = float(row.max()), int(row.argmax())
        above = row
    return best, end


def whole_seed(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n words in a row, unlike those of pairs."""
    return mix(grams(words, n) + salt(100 + n))


def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(lo, TEXTS_AT_ONCE)
            yield part, *hashed_words(part["text"].to_pylist())


ITEM = pa.schema([("item", pa.int64()), ("words", pa.binary()), ("size", pa.int32()), ("least_pairs", pa.int32()), ("reach", pa.int32()), ("seeds", pa.list_(pa.int64()))])
ITEM_DDL = "item long, words binary, size int, least_pairs int, reach int, seeds array<long>"


def item_words(items: DataFrame, k: int, least: float, penalty: float) -> DataFrame:
    """Items (item, text) as hashes of words, with all the pairs that may be seeds; an item of fewer than k words is one seed."""

    def run(batches):
        for part, words, bounds in by_text(batches):
            rows = []
            for i, item in enumerate(part["item"].to_pylist()):
                own = words[bounds[i] : bounds[i + 1]]
                n = len(own)
                if n >= k:
                    seeds = pair_hashes(own, np.array([0, n]), (1,))[2]
                    rows.append((item, own.tobytes(), n, least_pairs(n, least, penalty), reach_of(n, least, penalty), seeds.view(np.int64)))
                elif n:
                    rows.append((item, own.tobytes(), n, 0, n, whole_seed(own, n).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(ITEM)], schema=ITEM)

    return items.mapInArrow(run, ITEM_DDL)


def seed_table(seeds: DataFrame) -> BitTable:
    """A table of bounded size that all seeds pass, and few other hashes."""

    def run(batches):
        for batch in batches:
            own = np.unique(batch["seed"].to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(own)]), "hashes": pa.array([own.tobytes()], pa.binary())})

    return bit_table(seeds.select("seed").mapInArrow(run, "n long, hashes binary"))


def seed_counts(docs: DataFrame, table: BitTable) -> DataFrame:
    """(seed, n): how often documents have what the table lets through."""
    sent = docs.sparkSession.sparkContext.broadcast(table)
    schema = pa.schema([("seed", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            found = []
            for _, words, bounds in by_text(iter([batch])):
                value = pair_hashes(words, bounds)[2]
                found.append(value[sent.value.has(value)])
            value, n = added_up(np.concatenate(found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], schema=schema)

    return docs.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))


def rarest(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, seed, reach, weight, needed): of each item the rarest pairs, so many that every accepted copy has needed of them; pairs that no document has stay out besides.

    ``weight`` is how many of these pairs of the item are the seed. An item has size - 1 pairs and a copy lacks
    all but least_pairs of them at most, so of size - least_pairs + more pairs it has more + 1.
    """
    every = items.select("item", "size", "least_pairs", "reach", F.posexplode("seeds").alias("place", "seed")).join(counts, "seed", "left")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.coalesce("n", F.lit(0)), "seed", "place"))
    more = F.greatest(F.lit(0), F.least(F.lit(MORE_SEEDS), F.col("least_pairs") - 1))
    few = (F.col("least_pairs") == 0) | (F.col("n").isNotNull() & (F.col("rank") <= F.col("size") - F.col("least_pairs") + more))
    return every.withColumn("rank", rank).where(few).groupBy("item", "seed", "reach", (more + 1).alias("needed")).agg(F.count("*").alias("weight"))


def seed_places(docs: DataFrame, table: BitTable, sizes: list[int]) -> DataFrame:
    """(h1, h2, seed, place, first) where documents have what the table lets through, and at one place of a text's seed that it is the first; the first place only of items that are looked up whole, of these sizes."""
    sent = docs.sparkSession.sparkContext.broadcast(table)
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("seed", pa.int64()), ("place", pa.int32()), ("first", pa.bool_())])

    def run(batches):
        for part, words, bounds in by_text(batches):
            found = [pair_hashes(words, bounds)]
            for n in sizes:
                text, place = gram_places(bounds, n)
                value = whole_seed(words, n)[place]
                kept = np.flatnonzero(sent.value.has(value))
                _, first = np.unique(np.stack((text[kept].astype(np.uint64), value[kept])), axis=1, return_index=True)
                kept = kept[first]
                found.append((text[kept], place[kept] - bounds[text[kept]], value[kept]))
            text, place, value = (np.concatenate(x) for x in zip(*found))
            kept = sent.value.has(value)
            text, place, value = text[kept], place[kept], value[kept]
            order = np.lexsort((place, value, text))
            text, place, value = text[order], place[order], value[order]
            first = np.append(True, (text[1:] != text[:-1]) | (value[1:] != value[:-1]))[: len(text)]
            h1, h2 = (part[c].to_numpy()[text] for c in ("h1", "h2"))
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(value.view(np.int64)), pa.array(place.astype(np.int32)), pa.array(first)], schema=schema)

    return docs.select("h1", "h2", "text").mapInArrow(run, "h1 long, h2 long, seed long, place int, first boolean")


def met_items(places: DataFrame, seeds: DataFrame) -> DataFrame:
    """(h1, h2, item, spans): texts that have as many seeds of an item as its copies have, each seed counted once, and where they are.

    Equal texts are one text here, and each of them counts its seeds; that only lets more through.
    """
    part = F.floor(F.col("place") / F.col("reach")).alias("part")
    met = places.join(seeds, "seed").groupBy("h1", "h2", "item", "needed", part).agg(
        F.struct(F.min("place").alias("first"), F.max("place").alias("last")).alias("span"), F.sum(F.when(F.col("first"), F.col("weight")).otherwise(0)).alias("met")
    )
    found = met.groupBy("h1", "h2", "item", "needed").agg(F.collect_list("span").alias("spans"), F.sum("met").alias("met"))
    return found.where("met >= needed").drop("needed", "met")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, h2, text) of documents whose h1 is among those of wanted, and of few others: the rest is not shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(seed_table(wanted.select(F.col("h1").alias("seed"))))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(sent.value.has(batch["h1"].to_numpy().view(np.uint64))))

    return docs.select("h1", "h2", "text").mapInArrow(run, "h1 long, h2 long, text string")


def best_copy(own: np.ndarray, item: np.ndarray, spans: list[tuple[int, int]], needed: int, reach: int, penalty: float) -> tuple[float, int]:
    """Best alignment of the item within reach of places (first, last) of its seeds, where there are enough of its pairs; and where it ends."""
    ranges: list[list[int]] = []
    for first, last in sorted(spans):
        a, z = max(0, first - reach), last + reach + 2
        if ranges and a <= ranges[-1][1]:
            ranges[-1][1] = max(z, ranges[-1][1])
        else:
            ranges.append([a, z])
    pairs = pair_hashes(item, np.array([0, len(item)]), (1,))[2]
    best, end = 0.0, 0
    for a, z in ranges:
        part = own[a:z]
        there = pair_hashes(part, np.array([0, len(part)]))[2]
        if np.isin(pairs, there).sum() >= needed:
            score, stop = align(item, part, penalty)
            if score > best:
                best, end = score, a + stop
    return best, end


FOUND = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("item", pa.int64()), ("score", pa.float64()), ("end_word", pa.int64())])
FOUND_DDL = "h1 long, h2 long, item long, score double, end_word long"


def aligned(rows: DataFrame, least: float, penalty: float) -> DataFrame:
    """Accepted copies, from rows of one text and its candidates after it: the text first, as its item is null."""

    def run(batches):
        own = np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["item"] is None:
                    own = hashed_words([row["text"]])[0]
                    continue
                words = np.frombuffer(row["words"], np.uint64)
                if row["least_pairs"] == 0:
                    out.append((row["h1"], row["h2"], row["item"], 1.0, min(s["first"] for s in row["spans"]) + len(words)))
                    continue
                best, end = best_copy(own, words, [(s["first"], s["last"]) for s in row["spans"]], row["least_pairs"], row["reach"], penalty)
                if best >= least * len(words):
                    out.append((row["h1"], row["h2"], row["item"], best / len(words), end))
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], f.type) for c, f in enumerate(FOUND)], schema=FOUND)

    return rows.mapInArrow(run, FOUND_DDL)


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = GRAM, least: float = LEAST_SCORE, penalty: float = PENALTY) -> DataFrame:
    """(doc_id, item_id, score, end_word): documents that hold a copy of an item, also an edited one.

    ``score`` is the alignment score by the item's words. An item shorter than k
    words matches where it stands whole, with score 1. Null and empty texts match
    nothing. ``end_word`` is the end of the first match with the best score. Rows of one item_id or
    doc_id count as one, and so do those without; the best of them counts. An
    empty table on either side gives none. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    text = ["h1", "h2"]
    keyed = lambda df: df.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    docs = keyed(docs.select("doc_id", body().alias("text")))
    known = materialize(benchmark.select("item_id", body().alias("text")).withColumn("item", F.monotonically_increasing_id()), "items")
    items = materialize(item_words(known.select("item", "text"), k, least, penalty), "item-words")
    pairs = items.where("least_pairs > 0").select(F.explode("seeds").alias("seed"))
    seeds = materialize(rarest(items, seed_counts(docs, seed_table(pairs))), "seeds")
    sizes = [r[0] for r in items.where("least_pairs = 0").select("size").distinct().collect()]
    found = materialize(met_items(seed_places(docs, seed_table(seeds), sizes), seeds), "candidates")
    parts = found.groupBy(*text).agg(F.ceil(F.count("*") / ITEMS_A_TASK).cast("int").alias("parts"))
    candidates = found.join(items.drop("seeds", "size"), "item").join(parts, text)
    candidates = candidates.withColumn("dealt", F.pmod(F.xxhash64("item"), "parts").cast("int")).withColumn("text", F.lit(None).cast("string")).drop("parts")
    needed = parts.join(texts_of(docs, parts), text).groupBy(*text, "parts").agg(F.any_value("text").alias("text"))
    texts = needed.withColumn("dealt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    rows = texts.unionByName(candidates, allowMissingColumns=True).repartition(*text, "dealt").sortWithinPartitions(*text, "dealt", F.col("item").asc_nulls_first())
    copies = materialize(aligned(rows, least, penalty), "copies")
    best = F.max(F.struct("score", (-F.col("end_word")).alias("end"))).alias("best")
    named = copies.join(known.select("item", "item_id"), "item").join(docs.select("doc_id", *text), text)
    return named.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.score", (-F.col("best.end")).alias("end_word"))
