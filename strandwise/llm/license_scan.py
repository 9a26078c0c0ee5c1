"""Licence scan by diagonal voting.

All rolling word k-gram hashes of all documents are joined to the positions of
the same k-grams in licence templates. Hits with the same offset between
document and template lie on one diagonal; neighbouring diagonals merge, so a
word put in or left out does not split a match. Every vote is verified word by
word, and what covers enough of a template labels the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrays import let
from .common import body
from .license_texts import PHRASES, TEMPLATES

#: What separates words, after A-Z became a-z.
BREAK = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

GRAM = 3
#: Diagonals that differ by no more than this belong to one match.
DIAGONAL_SLACK = 3
#: Share of a template's words that a match has to hold.
MIN_COVER = 0.6
#: Score of a phrase that stands without the wording of a template.
PHRASE_SCORE = 0.5
#: Words of a document that one row of the scan holds, so that long texts are cut up.
BLOCK = 64


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), f"[{BREAK}]+"), "")


def grams(words: Column, k: int) -> Column:
    """Hashes of all runs of k words, in order; empty where there are fewer words."""

    def hashed(w: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
        return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), at)).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashed)


def blocks(words: Column, k: int) -> Column:
    """array<struct<at, b>>: stretches of the words that overlap by k - 1, so each run of k lies in just one."""

    def cut(w: Column) -> Column:
        last = F.floor((F.size(w) - k) / BLOCK).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((i * BLOCK).alias("at"), F.slice(w, i * BLOCK + 1, F.lit(BLOCK + k - 1)).alias("b")))
        return F.when(F.size(w) >= k, parts).otherwise(F.array().cast("array<struct<at:int,b:array<string>>>"))

    return let(words, cut)


def template_table(spark: SparkSession, templates, k: int) -> DataFrame:
    """(template, label, t_words, t_pos, gram, t_run): as many rows as the templates have words, whatever the corpus."""
    rows = [(i, label, text.split()) for i, (label, text) in enumerate(templates)]
    given = spark.createDataFrame(rows, "template int, label string, words array<string>")
    placed = given.select("template", "label", "words", F.size("words").alias("t_words"), F.posexplode(grams(F.col("words"), k)).alias("t_pos", "gram"))
    return placed.select("template", "label", "t_words", "t_pos", "gram", F.slice("words", F.col("t_pos") + 1, k).alias("t_run"))


def base_places(words: Column) -> Column:
    """Starts and labels of the phrases, as array<struct<p, label>> by start."""

    def starts(w: Column, joined: Column, phrase: str) -> Column:
        parts = phrase.split()

        def same(i: Column) -> Column:
            equal = F.get(w, i) == parts[0]
            for j, part in enumerate(parts[1:], 1):
                equal = equal & (F.get(w, i + j) == part)
            return equal

        found = F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), same)
        places = F.transform(found, lambda p: F.struct(p.alias("p"), F.lit(PHRASES[phrase]).alias("label")))
        return F.when(joined.contains(f" {phrase} "), places).otherwise(F.array().cast("array<struct<p:int,label:string>>"))

    def all_of(w: Column) -> Column:
        joined = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
        return let(joined, lambda j: F.array_sort(F.concat(*[starts(w, j, x) for x in PHRASES])))

    return let(words, all_of)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, k: int = GRAM, slack: int = DIAGONAL_SLACK, min_cover: float = MIN_COVER) -> DataFrame:
    """One row for each document, with base facts, labels and a score.

    A null or empty text has no words and no labels, and score 0. Repeated rows
    get the same result each. An empty table gives none. Other columns of docs
    are ignored. ``score`` is the largest share of a template that a verified
    match covers, and PHRASE_SCORE at least where a base phrase stands. Templates
    of fewer than k words match nothing. Texts go through the join in blocks of
    words, so the work of one text grows with its length.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body(text)).alias("text_hash"), words_of(body(text)).alias("w"))
    known = F.broadcast(template_table(docs.sparkSession, templates, k))
    parts = rows.select("doc_id", "text_hash", F.explode(blocks(F.col("w"), k)).alias("part"))
    parts = parts.select("doc_id", "text_hash", "part.at", "part.b", grams(F.col("part.b"), k).alias("g"))
    hits = parts.select("doc_id", "text_hash", "at", "b", F.posexplode("g").alias("i", "gram")).join(known, "gram")
    own = ["doc_id", "text_hash", "template"]
    # Verification looks at the words themselves, so an equal hash of other words gets no
    # vote. Within coalesce it is no key of the join, and only hits come to it.
    equal = F.coalesce(F.slice("b", F.col("i") + 1, k) == F.col("t_run"), F.lit(False))
    pos = F.col("at") + F.col("i")
    votes = hits.where(equal).select(*own, "label", "t_words", "t_pos", pos.alias("pos"), (pos - F.col("t_pos")).alias("diagonal"))
    lines = votes.groupBy(*own, "label", "t_words", "diagonal").agg(F.collect_set("t_pos").alias("held"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    by_diagonal = Window.partitionBy(*own).orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    lines = lines.withColumn("match", F.sum(F.when(gap <= slack, 0).otherwise(1)).over(by_diagonal))
    merged = lines.groupBy(*own, "label", "t_words", "match").agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"), F.min("first").alias("first"), (F.max("last") + k).alias("end"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("held", lambda p: F.sequence(p, p + k - 1)))))
    merged = merged.withColumn("cover", covered / F.col("t_words")).where(F.col("cover") >= min_cover)
    found = merged.groupBy("doc_id", "text_hash").agg(
        F.collect_set("label").alias("more"),
        F.max("cover").alias("cover"),
        F.array_sort(F.collect_set(F.struct("first", "end", "label"))).alias("spans"),
    )
    base = rows.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), base_places(F.col("w")).alias("places"))
    joined = base.alias("b").join(found.alias("f"), F.col("b.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("b.text_hash") == F.col("f.text_hash")), "left")
    labels = F.array_distinct(F.transform("places", lambda x: x.label))
    both = F.array_union(labels, F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        "b.doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda x: x.p)).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda x: x.p)).cast("long").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.greatest(F.when(F.size("places") > 0, PHRASE_SCORE).otherwise(0.0), F.coalesce("cover", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,end:int,label:string>>")).alias("spans"),
    )
