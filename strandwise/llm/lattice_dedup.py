"""Near duplicates among embeddings by lattice hashing.

Random projections take a vector to eight dimensions, where its cell is that of
the nearest point of the E8 lattice. A table keeps each vector in its own cell
and looks for it in the nearest cells around as well; several tables make up for
what one misses. Vectors that meet in a cell are compared by cosine, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches
from .near_dedup import components
from .words import ODD, mix, salt

THRESHOLD = 0.95
#: Standard deviation of a projected coordinate of a random unit vector, where the lattice has one point in a unit of volume.
SCALE = 1.0
#: Tables, and cells of each that a vector is looked for in, its own included. A pair of cosine 0.95 meets in one table with probability 0.63.
TABLES, PROBES = 5, 8
#: Vectors of a cell that are compared at a time; larger cells are split into blocks, and each two blocks are one comparison.
BLOCK = 1024

#: The shortest vectors of E8.
NEIGHBOURS = np.array(
    [[x if k == i else y if k == j else 0 for k in range(8)] for i, j in combinations(range(8), 2) for x, y in product((1.0, -1.0), repeat=2)]
    + [list(signs) for signs in product((0.5, -0.5), repeat=8) if np.prod(signs) > 0]
)


def nearest_point(y: np.ndarray) -> np.ndarray:
    """The nearest point of E8: integers of even sum, or those moved by a half in every coordinate."""

    def even(v: np.ndarray) -> np.ndarray:
        near = np.rint(v)
        off = v - near
        worst, row = np.abs(off).argmax(axis=1), np.arange(len(v))
        near[row, worst] += np.where(near.sum(axis=1) % 2 == 0, 0, np.where(off[row, worst] < 0, -1, 1))
        return near

    whole, half = even(y), even(y - 0.5) + 0.5
    closer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def projections(dimensions: int, tables: int, scale: float) -> np.ndarray:
    """dimensions x 8 tables, fixed for these numbers: orthonormal in each table where there are eight dimensions or more."""
    random = np.random.default_rng(dimensions)
    out = []
    for _ in range(tables):
        wide = random.standard_normal((max(dimensions, 8), 8))
        out.append(np.linalg.qr(wide)[0][:dimensions])
    return np.hstack(out) * (scale * np.sqrt(dimensions))


def cells(unit: np.ndarray, tables: int, probes: int, scale: float) -> np.ndarray:
    """Keys of the cells of unit vectors, n x tables x probes; the first is the own one."""
    # Row by row in one order of sums, so that a vector has the same cells in every batch.
    places = np.einsum("nd,dk->nk", unit, projections(unit.shape[1], tables, scale))
    keys = np.zeros((len(unit), tables, probes), np.uint64)
    for t in range(tables):
        y = places[:, 8 * t : 8 * t + 8]
        own = nearest_point(y)
        around = np.argsort(-((y - own) @ NEIGHBOURS.T), axis=1, kind="stable")[:, : probes - 1]
        points = np.concatenate((own[:, None, :], own[:, None, :] + NEIGHBOURS[around]), axis=1)
        key = np.full(points.shape[:2], salt(t + 1) + np.uint64(unit.shape[1]))
        for c in range(8):
            key = mix(key * ODD + (2 * points[:, :, c]).astype(np.int64).astype(np.uint64))
        keys[:, t] = key
    return keys


def unit_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) of each number of dimensions."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        v = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, int(d)).astype(float)
        v = v / np.abs(v).max(axis=1, keepdims=True)
        yield at, v / np.linalg.norm(v, axis=1, keepdims=True)


def keyed(nodes: DataFrame, tables: int, probes: int, scale: float) -> DataFrame:
    """(key, owner, node, n, embedding): a row for each cell that a vector is in or looked for in."""
    schema = pa.schema([("key", pa.int64()), ("tab", pa.int32()), ("owner", pa.bool_()), ("node", pa.int64())])

    def run(batches):
        for batch in batches:
            for at, unit in unit_vectors(batch["embedding"]):
                keys = cells(unit, tables, probes, scale)
                node = np.repeat(batch["node"].to_numpy()[at], tables * probes)
                cell = np.tile(np.arange(tables * probes), len(at))
                columns = keys.ravel().view(np.int64), (cell // probes).astype(np.int32), cell % probes == 0, node
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return nodes.select("node", "embedding").mapInArrow(run, "key long, tab int, owner boolean, node long")


def first_met(lo: np.ndarray, hi: np.ndarray, keys: np.ndarray, table: int, in_lo: np.ndarray) -> np.ndarray:
    """Whether pairs of rows (lo, hi) meet in this cell first: no earlier table joins them, nor, if the cell is that of hi, the cell of lo in this table."""
    first = np.ones(len(lo), bool)
    for t in range(table + 1):
        met_lo = (keys[lo, t, :1] == keys[hi, t]).any(axis=1)
        if t == table:
            return first & (in_lo | ~met_lo)
        first &= ~met_lo & ~(keys[hi, t, :1] == keys[lo, t]).any(axis=1)
    return first


def labels_of(hits: np.ndarray) -> np.ndarray:
    """The first index of each connected component of a symmetric matrix of links."""
    label = np.arange(len(hits))
    while True:
        near = np.where(hits, label[None, :], len(hits)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compared(rows: DataFrame, threshold: float, tables: int, probes: int, scale: float) -> DataFrame:
    """(node, links, label): what each vector links to in each pair of blocks (key, x, y).

    ``links`` counts vectors that it meets here first, ``label`` is the smallest node among those joined here.
    """
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("label", pa.int64())])

    def one(node, owner, n, side, unit, two_blocks: bool) -> tuple | None:
        order = np.argsort(node)
        node, owner, n, side, unit = node[order], owner[order], n[order], side[order], unit[order]
        hits = unit @ unit.T >= threshold
        hits &= owner[:, None] | owner[None, :]
        np.fill_diagonal(hits, False)
        if two_blocks:
            hits &= side[:, None] != side[None, :]
        met = hits.any(axis=1)
        if not met.any():
            return None
        node, owner, n, unit, hits = node[met], owner[met], n[met], unit[met], hits[np.ix_(met, met)]
        return node, owner, n, unit, hits

    def counted(table: int, node, owner, n, unit, hits):
        keys = cells(unit, tables, probes, scale)
        links = np.zeros(len(node), np.int64)
        for lo in range(len(node)):
            hi = lo + 1 + np.flatnonzero(hits[lo, lo + 1 :])
            new = hi[first_met(np.full(len(hi), lo), hi, keys, table, np.full(len(hi), owner[lo]))]
            links[lo] += n[new].sum()
            links[new] += n[lo]
        return node, links, node[labels_of(hits)]

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None

        def done(held):
            table = pa.Table.from_batches(held)
            out = []
            id_ = [table[c].to_numpy() for c in ("key", "x", "y")]
            cuts = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in id_], axis=0)))
            node, owner, n, side, tab = (table[c].to_numpy() for c in ("node", "owner", "n", "side", "tab"))
            embedding = table["embedding"].combine_chunks()
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(node)]):
                if hi - lo > 1 and owner[lo:hi].any():
                    (at, unit), *_ = unit_vectors(embedding.slice(lo, hi - lo))
                    found = one(*(c[lo:hi][at] for c in (node, owner, n, side)), unit, bool(id_[1][lo] != id_[2][lo]))
                    if found:
                        out.append(counted(int(tab[lo]), *found))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last block of a batch may go on in the next one.
            id_ = [batch[c].to_numpy() for c in ("key", "x", "y")]
            ends = np.flatnonzero(np.any([c[1:] != c[:-1] for c in id_], axis=0)) if batch.num_rows > 1 else np.zeros(0, np.int64)
            begins = tuple(c[0] for c in id_)
            if held and begins != last:
                yield from done(held)
                held = []
            if len(ends):
                yield from done([*held, batch.slice(0, int(ends[-1]) + 1)])
                held = []
            held.append(batch.slice(int(ends[-1]) + 1) if len(ends) else batch)
            last = tuple(c[-1] for c in id_)
        if held:
            yield from done(held)

    return rows.mapInArrow(run, "node long, links long, label long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of vectors (vec_id, embedding).

    Links are pairs of cosine ``threshold`` or more, in double precision, among vectors of
    one number of dimensions that meet in a cell. Equal vectors are one from the start
    and all link to each other. Null, empty and zero vectors, and those with null or
    non-finite components, link with nothing. ``component_id`` is the smallest vec_id that
    links reach. Each row counts as a vector, also with a vec_id that others have; rows
    without one have links, and are named by the others of their component, or null. An
    empty table gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    e = F.col("embedding")
    x = lambda v: v.cast("double")
    proper = ~F.exists(e, lambda v: v.isNull() | F.isnan(x(v)) | (F.abs(x(v)) == float("inf"))) & F.exists(e, lambda v: x(v) != 0)
    rows = vectors.select("vec_id", F.when(proper, e).alias("embedding"))
    keys = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    rows = rows.select("vec_id", "embedding", *keys)
    nodes = rows.where("embedding is not null").groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.any_value("embedding").alias("embedding"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    at = materialize(keyed(nodes, tables, probes, scale), "cells")
    crowded = at.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > block)
    crowded = materialize(crowded.select("key", F.ceil(F.col("members") / block).cast("int").alias("blocks")), "crowded")
    own = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).cast("int")
    dealt = at.join(crowded, "key", "left").withColumn("side", own)
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    dealt = dealt.select("key", "tab", "owner", "node", "side", other.alias("other"))
    dealt = dealt.select("key", "tab", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "owner", "node", "side")
    full = dealt.join(nodes.select("node", "n", "embedding"), "node")
    met = full.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    found = materialize(compared(met, threshold, tables, probes, scale), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.where("label <> node").select(F.col("node").alias("a"), F.col("label").alias("b")))
    known = nodes.join(labels.withColumnRenamed("v", "node"), "node", "left").join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = materialize(known.select("h1", "h2", "n", "least", "label", F.coalesce("links", F.lit(0)).alias("links")), "known")
    names = known.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = known.join(names, "label").select("h1", "h2", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.where("embedding is not null").select("vec_id", "h1", "h2").join(classes, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("embedding is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
