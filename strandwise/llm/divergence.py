"""How the sources of each language differ in their words: one-hot level products.

The distance of two sources sums, over all terms, how far the terms' shares lie
apart; and a share depends on a count alone. So what is needed of two sources is
their joint table: how many terms have count x in the one and y in the other. A
block of terms has an indicator column for each (source, count level), and the
product of these columns with their transpose holds the joint tables of all pairs
of sources. Each table is priced by the shares of its levels; prices of blocks add up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashed_counts as H
from .byte_words import byte_set, chunks, joined, words_of
from .collocations import salted
from .common import body, materialize, small_batches
from .words import mix

#: Bytes of terms: letters, and all of other characters.
IN_TERM = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LEAST_DOCUMENTS = 30
#: Added to every count.
SMOOTHING = 5
UNIT = 1_000_000_000
TOP = 50
#: Terms and sources of a block; products of one-hot columns stay exact in 32-bit floats.
TERMS, SOURCES = 1024, 32


def in_documents(texts: list[bytes], langs: list[str]):
    """Words, and (hash by language, document, occurrences, first place) of each distinct term of each document."""
    words = words_of(texts, IN_TERM)
    text = words.text_of()
    own = mix(words.hashes + salted(langs)[text] if len(text) else words.hashes)
    order = np.lexsort((own, text))
    own, text = own[order], text[order]
    first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (text[1:] != text[:-1]))) if len(own) else np.zeros(0, np.int64)
    return words, own[first], text[first], np.diff(np.append(first, len(own))), order[first]


def often_used(docs: DataFrame, least: int, least_capacity: int) -> H.BitTable:
    """The table of terms that may stand in ``least`` documents of a language, by Misra-Gries summaries of (term, document)."""
    parts = H.FINER * H.partitions(docs)
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0

    def run(batches):
        for texts, (langs,) in chunks(batches, "text", "lang"):
            yield H.pieces(*H.added_up(in_documents(texts, langs)[1]), parts)

    packed = docs.select("text", "lang").mapInArrow(run, H.PIECE_DDL)
    capacity = max(least_capacity, 2 * size // (4 * least * parts) + 1)
    while True:
        found = materialize(H.summarised(packed, least, capacity), "often-used")
        if (found.agg(F.max("lost")).first()[0] or 0) < least:
            return H.bit_table(found)
        capacity *= 2


COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


#: Counts that a task holds at a time.
HELD = 500_000


def by_group(group: np.ndarray, own: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (group, hash), and the sums of their counts."""
    order = np.lexsort((own, group))
    group, own = group[order], own[order]
    first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (group[1:] != group[:-1]))) if len(own) else np.zeros(0, np.int64)
    return group[first], own[first], *(np.add.reduceat(c[order], first) if len(first) else c for c in counts)


def term_counts(docs: DataFrame, table: H.BitTable) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term, of all terms that the table lets through.

    A task adds up what its pieces of text have before it spells the terms out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        index: dict[tuple[str, str], int] = {}
        names: dict[int, str] = {}
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]

        def given():
            groups = list(index)
            for lo in range(0, len(held[0]), 20_000):
                group, own, n, in_docs = (x[lo : lo + 20_000] for x in held)
                of = [groups[g] for g in group.tolist()]
                columns = [[g[0] for g in of], [g[1] for g in of], [names[h] for h in own.tolist()], n, in_docs]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COUNTED)], schema=COUNTED)

        for texts, (langs, sources) in chunks(batches, "text", "lang", "source"):
            words, own, text, n, place = in_documents(texts, langs)
            kept = sent.value.has(own)
            own, text, n, place = own[kept], text[kept], n[kept], place[kept]
            group = np.array([index.setdefault(g, len(index)) for g in zip(langs, sources)], np.int64)[text]
            terms, first = np.unique(own, return_index=True)
            new = [i for i, h in enumerate(terms.tolist()) if h not in names]
            names.update(zip(terms[new].tolist(), joined(words, place[first[new]], 1)))
            piece = by_group(group, own, n, np.ones(len(own), np.int64))
            held = list(by_group(*(np.concatenate(x) for x in zip(held, piece))))
            if len(held[0]) > HELD:
                yield from given()
                held, names = [x[:0] for x in held], {}
        yield from given()

    counted = docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> str:
    """SQL of 1 + floor(UNIT (count + SMOOTHING) / (total + SMOOTHING terms)), in decimals, as products may pass 64 bits."""
    above = f"CAST(CAST({UNIT} AS DECIMAL(10, 0)) * (CAST({count} AS DECIMAL(18, 0)) + {SMOOTHING}) AS DECIMAL(38, 0))"
    return f"1 + {above} div CAST(CAST({total} AS DECIMAL(18, 0)) + {SMOOTHING} * CAST({terms} AS DECIMAL(18, 0)) AS DECIMAL(38, 0))"


def priced(cells: DataFrame) -> DataFrame:
    """(lang, i, j, value): distances of sources i < j of each block of rows (lang, block, x, y).

    Rows are one source's shares at its levels in the block, with term -1, and one
    term's level in one source. A term without a row for a source has level 0 there.
    """
    schema = pa.schema([("lang", pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("value", pa.int64())])

    def joint(levels: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((len(levels), n), np.float32)
        out[np.arange(len(levels)), levels] = 1
        return out

    def block(key: tuple, table: pa.Table) -> pa.Table:
        lang, x, y = key[0].as_py(), key[2].as_py(), key[3].as_py()
        group, count, price, term = (table[c].to_numpy() for c in ("grp", "n", "price", "term"))
        listed = term < 0
        n_terms = int(table["terms"][0].as_py())
        columns: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for g in np.unique(group[listed]).tolist():
            at = listed & (group == g)
            order = np.argsort(count[at])
            levels, prices = count[at][order], price[at][order]
            own = ~listed & (group == g)
            level = np.full(n_terms, np.searchsorted(levels, 0))
            level[term[own]] = np.searchsorted(levels, count[own])
            columns[g] = joint(level, len(levels)), prices
        out = []
        for i in columns:
            for j in columns:
                if i < j and i // SOURCES == x and j // SOURCES == y:
                    (a, pa_), (b, pb) = columns[i], columns[j]
                    tables = (a.T @ b).astype(np.int64)
                    out.append((lang, i, j, int((tables * np.abs(pa_[:, None] - pb[None, :])).sum())))
        return pa.table([pa.array([o[c] for o in out], f.type) for c, f in enumerate(schema)], schema=schema)

    blocks = cells.groupBy("lang", "block", "x", "y").applyInArrow(block, "lang string, i int, j int, value long")
    return blocks.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, least_capacity: int = H.LEAST_CAPACITY) -> DataFrame:
    """(lang, source, part, item, value, rank) of how the sources of each language differ.

    Part ``pair``: each other source of the language and its distance, the sum over all
    kept terms of how far the smoothed shares lie apart, in billionths. Part ``term``: the
    terms that a source uses more than its language does, the ``top`` ones by the
    difference. Kept terms stand in ``least`` documents of the language at least. Null
    texts, languages and sources are empty strings and make groups of their own; a group
    without terms has shares of the smoothing alone, and without any kept terms all
    distances are 0. Rows of one doc_id count each. An empty table gives no rows. Other
    columns are ignored.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(*[body(c).alias(c) for c in ("text", "lang", "source")])
    group = ["lang", "source"]
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = docs.select(*group).distinct().withColumn("grp", number.cast("int"))
    counted = materialize(term_counts(docs, often_used(docs, least, least_capacity)), "term-counts")
    by_term = counted.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least)
    # The terms of a block are about equally frequent, so that most blocks have few levels.
    by_term = materialize(by_term.withColumn("size", F.floor(F.log2("all_n"))), "kept-terms")
    dealt = by_term.groupBy("lang", "size").agg(F.ceil(F.count("*") / TERMS).alias("blocks"))
    by_term = by_term.join(dealt, ["lang", "size"]).withColumn("block", F.col("size") * (1 << 40) + F.pmod(F.xxhash64("term"), "blocks"))
    at = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    by_term = materialize(by_term.select("lang", "term", "all_n", "block", at.cast("int").alias("at")), "placed-terms")
    of_lang = by_term.groupBy("lang").agg(F.sum("all_n").alias("lang_n"), F.count("*").alias("terms"))
    kept = counted.drop("docs").join(by_term, ["lang", "term"])
    of_group = kept.groupBy(*group).agg(F.sum("n").alias("group_n"))
    groups = groups.join(of_lang, "lang", "left").join(of_group, group, "left").na.fill(0, ["lang_n", "terms", "group_n"])
    groups = materialize(groups, "groups")
    rows = kept.join(groups, group).withColumn("price", F.expr(share("n", "group_n", "terms")))
    rows = materialize(rows.withColumn("usual", F.expr(share("all_n", "lang_n", "terms"))), "shares")

    better = rows.where("price > usual").select(*group, F.col("term").alias("item"), (F.col("price") - F.col("usual")).alias("value"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("value"), "item")))
    terms = ranked(better).where(F.col("rank") <= top).withColumn("part", F.lit("term"))

    blocks = by_term.groupBy("lang", "block").agg(F.count("*").alias("in_block"))
    none = F.expr(share("0", "group_n", "terms"))
    absent = blocks.join(groups, "lang").select("lang", "block", "grp", F.lit(0).cast("long").alias("n"), none.alias("price"), F.lit(-1).alias("term"))
    levels = rows.select("lang", "block", "grp", "n", "price").distinct().withColumn("term", F.lit(-1))
    cells = rows.select("lang", "block", "grp", "n", "price", F.col("at").alias("term")).unionByName(levels).unionByName(absent)
    own = F.floor(F.col("grp") / SOURCES).cast("int")
    last = groups.groupBy("lang").agg(F.floor(F.max("grp") / SOURCES).cast("int").alias("last"))
    pair = F.transform(F.sequence(F.lit(0), F.col("last")), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    cells = cells.join(last, "lang").withColumn("pair", F.explode(pair)).join(blocks, ["lang", "block"])
    cells = cells.select("lang", "block", "pair.x", "pair.y", "grp", "n", "price", "term", F.col("in_block").alias("terms"))
    distances = materialize(priced(cells), "distances")
    a, b = (groups.select("lang", F.col("source").alias(s), F.col("grp").alias(g)) for s, g in (("source", "i"), ("item", "j")))
    both = a.join(b, "lang").where("i <> j").select("*", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
    both = both.join(distances.select("lang", F.col("i").alias("lo"), F.col("j").alias("hi"), "value"), ["lang", "lo", "hi"], "left")
    pairs = ranked(both.select(*group, "item", F.coalesce("value", F.lit(0)).alias("value"))).withColumn("part", F.lit("pair"))
    columns = [*group, "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return pairs.select(*columns).unionByName(terms.select(*columns))
