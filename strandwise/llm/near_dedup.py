"""Near duplicates by ProbMinHash.

A document is a weighted set of five-word shingles, each as heavy as it is
frequent there. Every shingle sends arrivals of a Poisson process of its weight
to random registers; the earliest arrival at each register is the signature, and
a shingle stops as soon as it is later than all registers. Two signatures agree
in a register with the probability Jaccard similarity. Texts with repeats have a
second signature of their unweighted set. Bands of registers propose pairs, the pairs are verified on whole texts, and verified links make classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import body, join_counted, materialize, small_batches, stand_ins
from .words import ODD, gram_places, grams, hashed_words, mix, salt

SHINGLE = 5
THRESHOLD = 0.8
#: 30 bands of 5 registers: a pair at 0.8 shares none with probability 7e-6.
BANDS, ROWS = 30, 5
#: Rounds in which each bucket compares its members to one of them.
STAR_ROUNDS = 3
TEXTS_AT_ONCE = 512


def weighted_shingles(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight), by text and shingle. A shorter text is one shingle, an empty one has none."""
    words, bounds = hashed_words(texts)
    text, place = gram_places(bounds, k)
    value = grams(words, k)[place]
    counts = np.diff(bounds)
    for i in np.flatnonzero((counts < k) & (counts > 0)):
        whole = grams(words[bounds[i] : bounds[i + 1]], int(counts[i])) ^ ODD
        text, value = np.append(text, i), np.append(value, whole)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return text[at], value[at], np.diff(np.append(at, len(text))).astype(float)


def prob_minhash(text: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Signatures, n x registers. Texts without shingles keep zeros."""
    earliest, owner = np.full(n * registers, np.inf), np.zeros(n * registers, np.uint64)
    time, latest = np.zeros(len(value)), np.zeros(n)
    arrival = 0
    while len(value):
        arrival += 1
        random = mix(value + salt(arrival))
        time = time - np.log1p(-(random >> np.uint64(11)).astype(float) * 2.0**-53) / weight
        to = text * registers + (mix(random + ODD) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, to, time)
        first = time == earliest[to]
        owner[to[first]] = value[first]
        live = text[np.diff(text, prepend=-1) > 0]
        latest[live] = earliest.reshape(n, registers)[live].max(axis=1)
        on = time < latest[text]
        text, value, weight, time = text[on], value[on], weight[on], time[on]
    return owner.reshape(n, registers)


def fingerprints(text: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's weighted set: equal for equal sets only, but for chance."""
    out = []
    for n_hash in (1, 2):
        x = mix(mix(value + salt(n_hash)) + weight.astype(np.uint64))
        total = np.zeros(n, np.uint64)
        np.add.at(total, text, x)
        out.append(mix(total).view(np.int64))
    return out[0], out[1]


def similarities(ta, va, wa, tb, vb, wb, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Probability Jaccard and plain Jaccard of the pairs (text i of a, text i of b)."""
    weighted, plain = np.zeros(n), np.zeros(n)
    a_at, b_at = np.searchsorted(ta, np.arange(n + 1)), np.searchsorted(tb, np.arange(n + 1))
    for i in range(n):
        x, y = va[a_at[i] : a_at[i + 1]], vb[b_at[i] : b_at[i + 1]]
        if not len(x) or not len(y):
            continue
        _, ix, iy = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        if not len(ix):
            continue
        plain[i] = len(ix) / (len(x) + len(y) - len(ix))
        p, q = wa[a_at[i] : a_at[i + 1]], wb[b_at[i] : b_at[i + 1]]
        # Sum over shared d of 1 / sum of max(p_e / p_d, q_e / q_d): with ratios r = q_e / p_e
        # sorted, the maxima are p_e / p_d below r_d and q_e / q_d above it.
        r = q[iy] / p[ix]
        order = np.argsort(r, kind="stable")
        r, pd, qd = r[order], p[ix][order], q[iy][order]
        below = np.concatenate(([0.0], np.cumsum(pd)))[np.searchsorted(r, r, "right")] + p.sum() - pd.sum()
        above = qd.sum() - np.concatenate(([0.0], np.cumsum(qd)))[np.searchsorted(r, r, "right")] + q.sum() - qd.sum()
        weighted[i] = (1.0 / (below / pd + above / qd)).sum()
    return weighted, plain


def band_keys(owner: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band of the signatures, n x bands."""
    keys = np.zeros((len(owner), bands), np.uint64)
    for i in range(rows):
        keys = mix(keys * ODD + owner[:, i::rows][:, :bands])
    return mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * ODD).view(np.int64)


def sign(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, fp1, fp2, bands) of every document; bands is null without shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                n = part.num_rows
                text, value, weight = weighted_shingles(part["text"].to_pylist(), k)
                fp1, fp2 = fingerprints(text, value, weight, n)
                sizes = np.bincount(text, minlength=n)
                even = np.bincount(text, weight, n) == sizes
                # A lone shingle owns all registers. Sets of up to three shingles meet by one key
                # where they are equal but for weights, and by bands where weights make unequal ones close.
                lone = sizes[text] == 1
                owner = prob_minhash(text[~lone], value[~lone], weight[~lone], n, bands * rows)
                owner[text[lone]] = value[lone][:, None]
                whole, _ = fingerprints(text, value, np.ones(len(value)), n)
                keys = band_keys(owner, bands, rows)
                # Plain links need bands of the unweighted set; without repeats they are the same bands.
                odd = ~even[text] & (sizes[text] > 3)
                plain = band_keys(prob_minhash(text[odd], value[odd], np.ones(int(odd.sum())), n, bands * rows), bands, rows)
                lists = []
                for i in range(n):
                    row = keys[i] if even[i] or sizes[i] <= 3 else np.union1d(keys[i], plain[i])
                    lists.append(None if not sizes[i] else row if sizes[i] > 3 else np.append(row, whole[i]))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(fp1), pa.array(fp2), pa.array(lists, pa.list_(pa.int64()))], schema=schema)

    return docs.mapInArrow(run, "doc_id long, fp1 long, fp2 long, bands array<long>")


def _with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    a = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    b = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")


def verify(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Add to (a, b) ``sim``: the larger of probability and plain Jaccard of the whole texts."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sim", pa.float64())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                x, y = (weighted_shingles(part[c].to_pylist(), k) for c in ("ta", "tb"))
                yield pa.RecordBatch.from_arrays([part["a"], part["b"], pa.array(np.maximum(*similarities(*x, *y, part.num_rows)))], schema=schema)

    return _with_texts(pairs, docs).mapInArrow(run, "a long, b long, sim double")


def differences(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Add to (a, b) ``size``, the number of a's shingles, and ``apart``, those that just one of a and b has."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("size", pa.int64()), ("apart", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                (tx, vx, _), (ty, vy, _) = (weighted_shingles(part[c].to_pylist(), k) for c in ("ta", "tb"))
                apart = [np.setxor1d(vx[tx == i], vy[ty == i], assume_unique=True).view(np.int64) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part["a"], part["b"], pa.array(np.bincount(tx, minlength=part.num_rows)), pa.array(apart, pa.list_(pa.int64()))], schema=schema)

    return _with_texts(pairs, docs).mapInArrow(run, "a long, b long, size long, apart array<long>")


def close_pairs(members: DataFrame, docs: DataFrame, k: int, threshold: float) -> DataFrame:
    """(a, b) among members (node, center, label, sim) of one center with different labels, one of which at least is not within reach of it: all of plain Jaccard >= threshold, few others.

    Two sets differ in as many shingles as their differences from the center
    do. A pair within the threshold has differences of sizes m and n with at
    least o in common, where m + n - 2 o is at most what the threshold leaves to
    differ. In one order for all, the first common one then has a rank of at
    most m - o + 1 and n - o + 1. The order goes from rare to frequent, so what
    just one member has comes first and meets nothing, however large the group.
    """
    of = ["node", "center"]
    found = differences(members.select(F.col("node").alias("a"), F.col("center").alias("b")), docs, k)
    found = materialize(found.dropDuplicates(["a", "b"]), "differences").select(F.col("a").alias("node"), F.col("b").alias("center"), "size", F.size("apart").alias("n"), "apart")
    single = found.select("node", "center", "size", "n", F.explode("apart").alias("shingle"))
    often = single.groupBy("center", "shingle").agg(F.count("*").alias("f"))
    rank = F.row_number().over(Window.partitionBy(*of).orderBy("f", "shingle"))
    ranked = single.join(often, ["center", "shingle"]).withColumn("rank", rank)
    ranked = ranked.where((F.col("f") > 1) & (F.col("rank") <= F.col("size") * (1 / threshold - 1) + 1))
    ranked = materialize(ranked.join(members.select(*of, "label", (F.col("sim") >= threshold).alias("near")), of), "ranked")
    x, y = ranked.where("not near").alias("x"), ranked.alias("y")
    common = (F.col("x.n") + F.col("y.n") - (F.col("x.size") + F.col("y.size")) * ((1 - threshold) / (1 + threshold))) / 2 - 1e-6
    early = (F.col("x.rank") <= F.col("x.n") - common + 1) & (F.col("y.rank") <= F.col("y.n") - common + 1)
    once = F.col("y.near") | (F.col("x.node") < F.col("y.node"))
    same = (F.col("x.center") == F.col("y.center")) & (F.col("x.shingle") == F.col("y.shingle"))
    return x.join(y, same & (F.col("x.label") != F.col("y.label")) & once & early).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(v, label) for links (a, b): the smallest id of each connected component.

    Each round takes the smallest label among neighbours and then the label of
    that label. Labels are written every round, so lineage stays short.
    """
    edges = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(edges.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("label")).select("v", F.least("v", "label").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        step = labels.join(near, "v").select("v", F.col("label").alias("was"), F.least("label", "near").alias("to"))
        jump = step.join(labels.select(F.col("v").alias("to"), F.col("label").alias("then")), "to", "left")
        done = materialize(jump.select("v", "was", F.least("to", F.coalesce("then", "to")).alias("label")), "labels")
        labels = done.select("v", "label")
        if done.where("label < was").isEmpty():
            return labels


def joined_classes(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The classes that further links make of labelled ones."""
    stars = labels.select(F.col("v").alias("a"), F.col("label").alias("b")).where("a <> b")
    return components(stars.unionByName(links.select("a", "b")))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id): documents of one class are linked by similarities of at least the threshold.

    Equal weighted sets are one class at once. Of different ones, each bucket of
    a band first compares its members to its smallest; those that fail form the
    bucket anew, for some rounds, as long as it holds several classes. Links so far
    make classes. Then members that failed are compared to those of the same first
    center with which they have enough of their differences from it in common
    (``close_pairs``), where the classes still differ. This last step is exact for
    plain Jaccard; links by probability Jaccard alone are those to centers of the
    buckets (some thirty of them) that a pair shares.

    Null and empty texts have no shingles and are one class; texts shorter than k
    words are one shingle. Rows of one doc_id count as one document. A row without
    doc_id is a document of its own, which every doc_id precedes: a class that has no
    other rows has no class_id. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs, stand_in = stand_ins(docs.select("doc_id", body().alias("text")))
    signed = materialize(sign(docs, k, bands, rows), "signatures")
    fp = ["fp1", "fp2"]
    sets = materialize(signed.groupBy(*fp).agg(F.min("doc_id").alias("node"), F.min_by("bands", "doc_id").alias("bands")), "sets")
    keyed = materialize(sets.select("node", F.explode("bands").alias("key")), "bands")

    def centred(rows: DataFrame) -> DataFrame:
        """Rows in buckets of several members, with the smallest one as ``center``."""
        shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("center")).where("n > 1")
        return materialize(join_counted(rows, materialize(shared, "buckets"), "key"), "members")

    first_members = centred(keyed)
    # Only texts that share a bucket move from here on.
    met = first_members.select(F.col("node").alias("doc_id")).distinct()
    texts = materialize(docs.join(met, "doc_id", "left_semi"), "candidates")

    def compare(pairs: DataFrame) -> DataFrame:
        return materialize(verify(pairs.where("a <> b").distinct(), texts, k), "similarities")

    def judged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        sims = compare(rows.select(F.col("node").alias("a"), F.col("center").alias("b")))
        best = sims.groupBy(F.col("a").alias("node"), F.col("b").alias("center")).agg(F.max("sim").alias("sim"))
        return sims.where(F.col("sim") >= threshold).select("a", "b"), rows.where("node <> center").select("key", "node", "center").join(best, ["node", "center"])

    def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
        known = rows.join(labels.withColumnRenamed("v", "node"), "node", "left")
        return materialize(known.withColumn("label", F.coalesce("label", "node")), "labelled")

    def still_open(known: DataFrame, key: str) -> DataFrame:
        """Labelled rows whose key holds several classes."""
        mixed = known.groupBy(key).agg(F.count("*").alias("n"), F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select(key, "n")
        return materialize(join_counted(known, materialize(mixed, "open-keys"), key), "open")

    links, first = judged(first_members)
    first = materialize(first.select("key", "node", "center", "sim"), "judged")
    labels = components(links)
    rest = first.where(F.col("sim") < threshold).select("key", "node")
    for _ in range(1, STAR_ROUNDS):
        rest = still_open(labelled(rest, labels), "key").select("key", "node")
        if rest.isEmpty():
            break
        more, again = judged(centred(rest))
        labels = joined_classes(labels, more)
        rest = materialize(again.where(F.col("sim") < threshold).select("key", "node"), "rest")
    members = still_open(labelled(first.select("node", "center", "sim").distinct(), labels), "center")
    if not members.isEmpty():
        late = compare(close_pairs(members, texts, k, threshold)).where(F.col("sim") >= threshold)
        labels = joined_classes(labels, late)
    classes = materialize(sets.select(*fp, "node").join(labels, F.col("node") == F.col("v"), "left").select(*fp, F.coalesce("label", "node").alias("class_id")), "classes")
    out = signed.select("doc_id", *fp).join(classes, fp).select("doc_id", "class_id")
    return out if stand_in is None else out.select(*[F.when(F.col(c) < stand_in, F.col(c)).alias(c) for c in ("doc_id", "class_id")])
