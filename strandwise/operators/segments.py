"""Merging sorted intervals into clusters, with window functions.

A row joins the open cluster when it starts within max_gap of the furthest end
so far, and either keeps the cluster's flag or does not extend it. The furthest
end is a running maximum, the flag that of the last extending row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored


#: Stretches that are sent to all tasks (some 100 bytes each, more as a table in memory); more are joined by a
#: shuffle. One query sends up to sixteen such tables, and the driver holds all of them.
SENT_STRETCHES = 20_000

#: Rows of a key that one task may take whole.
WHOLE = 1 << 18


def fits(tables, keys, most: int = WHOLE) -> bool:
    """Whether no value of the keys has over ``most`` rows in one of the tables."""
    return all(df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > most).isEmpty() for df in tables)


def _opened(refseq, s, reached, last, max_gap: int):
    return F.coalesce(reached.isNull() | (s > reached + max_gap) | (last != refseq), F.lit(False))


def numbered(df: DataFrame, part, max_gap: int, order, first: bool = False) -> DataFrame:
    """df with what its rows are within their part, as if nothing came before it.

    ``_lm`` is the furthest end before a row, ``_rec`` whether it extends that, ``_own``
    whether it then opens a cluster, and ``_n`` how many were opened so far. All windows
    have one order, so rows are dealt and sorted once. With ``first``, the first row of a
    part opens a cluster too.
    """
    w = Window.partitionBy(*part).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("refseq", F.coalesce("refseq", F.lit(False))).withColumn("_lm", F.max("e").over(before))
    df = df.withColumn("_rec", F.col("_lm").isNull() | (F.col("e") > F.col("_lm") + 1))
    last = F.last(F.when(F.col("_rec"), F.col("refseq")), ignorenulls=True).over(before)
    df = df.withColumn("_last", last)
    own = F.col("_rec") & F.col("_lm").isNotNull() & _opened(F.col("refseq"), F.col("s"), F.col("_lm"), F.col("_last"), max_gap)
    df = df.withColumn("_own", own | F.col("_lm").isNull() if first else own)
    return df.drop("_last").withColumn("_n", F.sum(F.col("_own").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def sent(stretches: DataFrame) -> DataFrame:
    """A written table of stretches, broadcast if its number of rows allows it."""
    return F.broadcast(stretches) if stretches.count() <= SENT_STRETCHES else stretches


def carried(rows: DataFrame, keys, max_gap: int) -> DataFrame:
    """What each stretch (keys, _blk) of numbered rows takes over from earlier ones: a prefix scan over summaries of stretches.

    The summary of a stretch is its furthest end, then, for the end M that is carried
    in, its rows that extend M too: they are the last of those that extend within the
    stretch, so the first and the last of them tell everything else. Only the first can
    depend on the flag that is carried in. ``_m`` is M, ``_first`` the end of the first
    such row, ``_at`` its _n, ``_head`` whether it opens a cluster, ``_ahead`` the number
    of clusters opened before the stretch.
    """
    keys = list(keys)
    part = [*keys, "_blk"]
    earlier = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    ends = stored(rows.groupBy(*part).agg(F.max("e").alias("_end")), "stretch-ends")
    ends = ends.select(*part, F.max("_end").over(earlier).alias("_m"))
    beyond = rows.where("_rec").join(sent(ends), part).where("_m is null or e > _m + 1")
    first = F.min_by(F.struct("e", "_n", "refseq", "s", F.greatest("_lm", "_m").alias("reached")), "e").alias("_f")
    found = beyond.groupBy(*part).agg(first, F.max_by("refseq", "e").alias("_flag"), F.max("_n").alias("_last_n"))
    table = ends.join(found, part, "left").withColumn("_in", F.last("_flag", ignorenulls=True).over(earlier))
    opens = F.col("_f").isNotNull() & _opened(F.col("_f.refseq"), F.col("_f.s"), F.col("_f.reached"), F.col("_in"), max_gap)
    table = table.withColumn("_head", opens.cast("long")).withColumn("_at", F.col("_f._n"))
    ahead = F.sum(F.col("_head") + F.coalesce(F.col("_last_n") - F.col("_at"), F.lit(0))).over(earlier)
    return stored(table.select(*part, "_m", F.col("_f.e").alias("_first"), "_at", "_head", F.coalesce(ahead, F.lit(0)).alias("_ahead")), "stretches")


def last_seen(rows: DataFrame, keys, position: str, order, value: str, name: str, block: int | None = None) -> DataFrame:
    """rows with ``name``: the last value that is not null at or before each row, in the order of the columns, which goes by position first.

    An as-of look-up for a union of both sides. With ``block``, windows run within
    stretches of so many positions, and the last value of each stretch is carried on
    over the table of stretches.
    """
    keys = list(keys)
    if not block:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))
    part = [*keys, "_blk"]
    rows = rows.withColumn("_blk", F.floor(F.col(position) / block))
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = stored(rows.withColumn(name, F.last(value, ignorenulls=True).over(w)), "swept")
    earlier = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(*part).agg(F.max_by(name, F.struct(*order)).alias("_end"))
    carry = stored(ends.select(*part, F.last("_end", ignorenulls=True).over(earlier).alias("_in")), "stretches")
    return rows.join(sent(carry), part).withColumn(name, F.coalesce(name, "_in")).drop("_in", "_blk")


def cluster_rows(df: DataFrame, keys, max_gap: int = 0, order=("s", "e"), block: int | None = None) -> DataFrame:
    """df (s, e, refseq) with each row's ``cluster``, numbered by key, ``opens`` it or not, and ``reached``, the furthest end before it.

    A null refseq counts as false. With ``block``, no key's rows go to one task:
    rows are numbered within stretches of that many positions of the first order
    column and written, once; what crosses from one stretch to the next comes from
    the much smaller table of stretches (``carried``).
    """
    keys = list(keys)
    if not block:
        rows = numbered(df, keys, max_gap, order, first=True)
        return rows.withColumnsRenamed({"_lm": "reached", "_own": "opens", "_n": "cluster"}).drop("_rec")
    part = [*keys, "_blk"]
    df = df.withColumn("_blk", F.floor(F.col(order[0]) / block))
    rows = stored(numbered(df, part, max_gap, order), "numbered")
    rows = rows.join(sent(carried(rows, keys, max_gap)), part).withColumn("reached", F.greatest("_lm", "_m"))
    extends = F.col("_rec") & (F.col("_m").isNull() | (F.col("e") > F.col("_m") + 1))
    opens = extends & F.when(F.col("e") == F.col("_first"), F.col("_head") == 1).otherwise(F.col("_own"))
    # From the first row that extends what is carried in, the furthest end is past that row's own.
    since = F.when(F.greatest("_lm", "e") >= F.col("_first"), F.col("_head") + F.col("_n") - F.col("_at")).otherwise(0)
    rows = rows.withColumns({"opens": opens, "cluster": F.col("_ahead") + since})
    return rows.drop("_blk", "_lm", "_rec", "_own", "_n", "_m", "_first", "_at", "_head", "_ahead")


def clusters_of(rows: DataFrame, keys) -> DataFrame:
    """(keys, cluster, s, e, refseq, n, tag_count, gaps, first_s) of numbered rows; a start is clipped to what earlier clusters reach."""
    clipped = F.greatest(F.coalesce(F.col("reached") + 1, F.col("s")), F.col("s"))
    return rows.groupBy(*keys, "cluster").agg(
        F.max(F.when(F.col("opens"), clipped)).alias("s"),
        F.max("e").alias("e"),
        F.max(F.when(F.col("opens"), F.col("refseq"))).alias("refseq"),
        F.count("*").alias("n"),
        F.sum("tag_count").alias("tag_count"),
        F.sum((~F.col("opens") & (F.col("s") > F.col("reached"))).cast("long")).alias("gaps"),
        F.min("s").alias("first_s"),
    )


def segment(df: DataFrame, keys, max_gap: int = 0, order=("s", "e"), block: int | None = None) -> DataFrame:
    """(keys, s, e, refseq, n, tag_count, gaps, first_s) of each cluster of df (s, e, refseq, tag_count)."""
    return clusters_of(cluster_rows(df, keys, max_gap, order, block), keys).drop("cluster")
