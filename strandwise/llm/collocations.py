"""Phrase collocations by language, from Misra-Gries summaries of hashed n-grams.

First pass: each hash partition of the n-grams has a summary with more counters
than its mass by the threshold, so every frequent n-gram survives. It goes by
length, single words, pairs, longer phrases, as all parts of a frequent phrase are frequent.
Second pass: what survived is counted exactly. Scores come from exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashed_counts as H
from .byte_words import Words, byte_set, chunks, joined, words_of
from .common import body, materialize, small_batches
from .words import ODD, mix

#: Bytes that part pieces, and those that part the words of a piece.
BREAKS = byte_set((0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"])
IN_WORD = ~(BREAKS | byte_set((0x20, 0x20), (0x09, 0x09)))
LONGEST = 5
THRESHOLD = 100
TOP = 2000


def salted(langs: list[str]) -> np.ndarray:
    """A number for each text's language, the same in all tasks."""
    known = {x: int.from_bytes(blake2b(x.encode("utf-8", "replace"), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def language_words(texts: list[bytes], langs: list[str]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their hashes by language, and the piece that each belongs to."""
    words = words_of(texts, IN_WORD)
    own = mix(words.hashes + np.repeat(salted(langs), np.diff(words.bounds)))
    return words, own, np.cumsum(BREAKS[words.data])[words.starts]


@dataclass
class Tables:
    """What is known to be frequent so far, as tables that all frequent n-grams of a length pass: single words, pairs, and longer ones."""

    words: H.BitTable | None = None
    pairs: H.BitTable | None = None
    longer: H.BitTable | None = None


def phrases(own: np.ndarray, piece: np.ndarray, known: Tables, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, hash, first word) of all stretches of k words within a piece, for k from 2, of which all words, and all pairs, pass the tables."""
    value, allowed = own, known.words.has(own)
    for k in range(2, longest + 1):
        if len(own) < k:
            return
        value = mix(value[:-1] * ODD + own[k - 1 :])
        allowed = allowed[:-1] & allowed[1:]
        if k == 2 and known.pairs:
            at = np.flatnonzero(allowed)
            allowed[at] = known.pairs.has(value[at])
        at = np.flatnonzero(allowed & (piece[: len(value)] == piece[k - 1 :]))
        yield k, value[at], at


def frequent(docs: DataFrame, mass: int, threshold: int, longest: int, known: Tables, least_capacity: int) -> tuple[H.BitTable, int]:
    """The table of what may count the threshold, and the mass of all: single words, then pairs of these, then the longer phrases of these pairs, by what is known.

    The number of counters follows from a bound of the mass. Few heavy n-grams can
    make one partition's mass larger than its share, so what summaries lost is
    looked at, and there are more counters if that could have cost an n-gram.
    """
    parts = H.FINER * H.partitions(docs)
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for texts, (langs,) in chunks(batches, "text", "lang"):
            _, own, piece = language_words(texts, langs)
            known = sent.value
            if known.words is None:
                found = [own]
            else:
                found = [value for k, value, _ in phrases(own, piece, known, longest if known.pairs else 2) if k > 2 or not known.pairs]
            yield H.pieces(*H.added_up(np.concatenate([np.zeros(0, np.uint64), *found])), parts)

    packed = docs.mapInArrow(run, H.PIECE_DDL)
    capacity = max(least_capacity, 2 * mass // (threshold * parts) + 1)
    while True:
        found = materialize(H.summarised(packed, threshold, capacity), "frequent")
        lost, total = found.agg(F.max("lost"), F.sum("mass")).first()
        if (lost or 0) < threshold:
            return H.bit_table(found), total or 0
        capacity *= 2


COUNTED = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
PACKED = pa.schema([("part", pa.int32()), *[(f.name, pa.list_(f.type)) for f in COUNTED]])
#: Phrases whose counts a task holds at a time, before they are shuffled.
HELD = 300_000


def packed_counts(docs: DataFrame, known: Tables, longest: int, parts: int) -> DataFrame:
    """(part, lang, k, phrase, n) as arrays: what a task has counted of all that the tables let through, a row for each hash partition. k is 0 for the number of words."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def given(held: dict[int, list]) -> pa.RecordBatch:
        by_part: dict[int, list] = {}
        for h, row in held.items():
            by_part.setdefault(((h >> 32) * parts) >> 32, []).append(row)
        columns = [[[r[c] for r in rows] for rows in by_part.values()] for c in range(len(COUNTED))]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([list(by_part), *columns], PACKED)], schema=PACKED)

    def run(batches):
        known = sent.value
        # By hash, so that a phrase is spelt out once however many pieces have it.
        held: dict[int, list] = {}
        for texts, (langs,) in chunks(batches, "text", "lang"):
            words, own, piece = language_words(texts, langs)
            text_of = words.text_of()
            for lang, h, n in zip(langs, salted(langs).tolist(), np.diff(words.bounds).tolist()):
                held.setdefault(h, [lang, 0, "", 0])[3] += n
            single = np.flatnonzero(known.words.has(own))
            for k, value, at in [(1, own[single], single), *phrases(own, piece, known, longest)]:
                if k > 2:
                    kept = known.longer.has(value)
                    value, at = value[kept], at[kept]
                value, first, n = np.unique(value, return_index=True, return_counts=True)
                new = []
                for i, (h, count) in enumerate(zip(value.tolist(), n.tolist())):
                    if (row := held.get(h)) is not None:
                        row[3] += count
                    else:
                        new.append(i)
                at = at[first[new]]
                for h, text, phrase, count in zip(value[new].tolist(), text_of[at].tolist(), joined(words, at, k), n[new].tolist()):
                    held[h] = [langs[text], k, phrase, count]
            if len(held) > HELD:
                yield given(held)
                held = {}
        if held:
            yield given(held)

    return docs.mapInArrow(run, "part int, lang array<string>, k array<int>, phrase array<string>, n array<long>")


def exact_counts(docs: DataFrame, known: Tables, longest: int, threshold: int) -> DataFrame:
    """(lang, k, phrase, n) of all phrases that count the threshold, by their words and not by hashes; k is 0 for the number of words.

    A hash partition holds about as many phrases as its summary had counters.
    """

    def run(batches):
        total: dict[tuple, int] = {}
        for batch in batches:
            for lang, k, phrase, n in zip(*(batch[c].to_pylist() for c in COUNTED.names)):
                for key, count in zip(zip(lang, k, phrase), n):
                    total[key] = total.get(key, 0) + count
        rows = [(*key, n) for key, n in total.items() if n >= threshold or key[1] == 0]
        for lo in range(0, len(rows), 20_000):
            some = rows[lo : lo + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in some], f.type) for c, f in enumerate(COUNTED)], schema=COUNTED)

    packed = packed_counts(docs, known, longest, H.FINER * H.partitions(docs))
    return packed.repartition(H.partitions(docs), "part").mapInArrow(run, "lang string, k int, phrase string, n long")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, least_capacity: int = H.LEAST_CAPACITY) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``longest`` words with a count a of ``threshold`` at least.

    A cut of a phrase scores floor(1000 a n / (l r)), where l and r count its parts and n
    all words of the language; the lowest counts, the first of equal ones. Phrases that lie
    in a longer candidate as frequent as they are go. Null texts are empty, and a null lang
    is ``und``. Rows of one doc_id count each. A language without candidates, and an
    empty table, give no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(body().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    known = Tables()
    known.words, n_words = frequent(docs, size // 2, threshold, longest, known, least_capacity)
    known.pairs, n_pairs = frequent(docs, n_words, threshold, longest, known, least_capacity)
    known.longer, _ = frequent(docs, (longest - 2) * n_pairs, threshold, longest, known, least_capacity)
    counts = materialize(exact_counts(docs, known, longest, threshold), "phrase-counts")
    candidates = counts.where("k > 1").withColumn("words", F.split("phrase", " ", -1)).withColumnRenamed("n", "a")
    part = lambda name, n: counts.where("k > 0").select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    text = lambda at, n: F.array_join(F.slice("words", at, n), " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = candidates.select("lang", "phrase", "k", "a", "words", cut).withColumns({"left": text(F.lit(1), F.col("cut")), "right": text(F.col("cut") + 1, F.col("k") - F.col("cut"))})
    cuts = cuts.drop("words").join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    cuts = cuts.join(counts.where("k = 0").select("lang", "n"), "lang")
    exact = "CAST(1000 * CAST(a AS DECIMAL(18, 0)) * CAST(n AS DECIMAL(16, 0)) AS DECIMAL(38, 0)) div CAST(CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)) AS DECIMAL(38, 0))"
    scored = cuts.withColumn("score", F.expr(exact))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best")).select("lang", "phrase", "best.*")
    size, at = F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"), F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at")
    inner = candidates.where("k > 2").select("lang", "k", "words", "a", size).select("*", at)
    inner = inner.groupBy("lang", text(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where("longer is null or longer < a")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
