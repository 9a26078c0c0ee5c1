"""Sharding by minimax contiguous partition.

Equal texts form an atomic group. Groups stand in the order of their digest; a
shard is a contiguous run of them. The smallest capacity for which a greedy
fill needs at most the wanted number of shards is found by binary search. No shard
is larger than it. Where one large group makes it far larger than the mean, the greedy
cuts would leave the last shards empty, so every cut moves to the group's end nearest
to a fair share that still keeps within the capacity (``even``).

The search never sees all groups at once. Summaries of running sizes bound
every greedy fill from below and above; only the stretches where the bounds
disagree are looked at again, more finely. What comes to the driver at a time
is at most POINTS numbers, whatever the input.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import body, materialize

#: Running sizes that one step of the search brings to the driver, at most.
POINTS = 50_000
#: Row headers and length fields of a document in a shard file.
ROW_BYTES = 16
#: Stretches of digests whose sizes are summed apart, and of rows numbered apart.
STRETCHES = 4096
SLOT_STRETCHES = 1024


def text_key(text: str = "text") -> Column:
    """Digest that names a group of equal texts; null counts as empty."""
    return F.md5(body(text).cast("binary"))


def running_sizes(groups: DataFrame) -> DataFrame:
    """(key, size) -> (key, size, upto): total size in digest order, the row included.

    Digests are even, so stretches of them hold alike many groups; a window runs
    within each stretch, and one over the table of stretches carries totals on.
    """
    stretch = F.conv(F.substring("key", 1, 3), 16, 10).cast("int")
    groups = groups.withColumn("stretch", stretch)
    before = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = groups.groupBy("stretch").agg(F.sum("size").alias("s")).select("stretch", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("carried"))
    within = Window.partitionBy("stretch").orderBy("key")
    return groups.withColumn("upto", F.sum("size").over(within)).join(F.broadcast(carried), "stretch").select("key", "size", (F.col("upto") + F.col("carried")).alias("upto"))


def greedy(capacity: int, shards: int, total: int, reach) -> list[int] | None:
    """Ends of the shards of a greedy fill, or None if they are not enough."""
    ends, at = [], 0
    for _ in range(shards):
        if at < total:
            to = reach(at + capacity)
            if to <= at:
                return None
            at = to
        ends.append(at)
    return ends if at >= total else None


def even(points: list[int], capacity: int, shards: int) -> list[int]:
    """Ends for the given capacity, moved among known group ends so that shards get like sizes.

    A large group can fix the capacity far above the mean; then the greedy fill
    would leave the last shards empty. Each cut goes next to its fair share, as
    long as the rest still fits behind it.
    """
    total = points[-1]
    behind = [0] * shards + [total]  # the least end of shard j with which the rest fits
    for j in range(shards - 1, 0, -1):
        if behind[j + 1] > capacity:
            behind[j] = points[bisect_left(points, behind[j + 1] - capacity)]
    ends, at = [], 0
    for j in range(1, shards):
        fair, top = at + (total - at) / (shards - j + 1), at + capacity
        k = bisect_right(points, fair)
        near = [*points[max(0, k - 1) : k + 1], points[max(0, bisect_right(points, top) - 1)], behind[j], at]
        at = min((p for p in near if max(at, behind[j]) <= p <= top), key=lambda p: abs(p - fair))
        ends.append(at)
    return [*ends, total]


def minimax_cuts(sizes: DataFrame, shards: int) -> list[int]:
    """Running sizes at which the shards end, for the smallest feasible capacity."""
    total, largest = sizes.agg(F.max("upto"), F.max("size")).first()
    if not total:
        return [0] * shards
    points, exact = [total], False
    low, high = max(largest, -(-total // shards)) - 1, total
    spans = [(0, total)]
    while True:
        width = max(1, -(-sum(b - a for a, b in spans) // POINTS))
        inside = F.lit(False)
        for a, b in spans:
            inside = inside | F.col("upto").between(a, b)
        found = sizes.where(inside)
        exact = width == 1 or found.count() <= POINTS
        found = found.select("upto") if exact else found.groupBy(F.floor(F.col("upto") / width)).agg(F.max("upto").alias("upto"))
        points = sorted({total, *points, *(r.upto for r in found.collect())})

        def least(target: int) -> int:  # a group's end at or below the target
            k = bisect_right(points, target)
            return points[k - 1] if k else 0

        def most(target: int) -> int:  # no group's end below the target is beyond this
            k = bisect_right(points, target)
            return least(target) if exact and any(a <= target <= b for a, b in spans) or k == len(points) else min(target, points[k] - 1)

        lo, hi = low, high  # smallest capacity that surely suffices
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if greedy(mid, shards, total, least) else (mid, hi)
        high = hi
        lo, hi = low, high  # smallest that may suffice
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if greedy(mid, shards, total, most) else (mid, hi)
        low = lo
        a, b = greedy(high, shards, total, least), greedy(high, shards, total, most)
        if exact or (low + 1 == high and a == b):
            return even(points, high, shards)
        first = greedy(low + 1, shards, total, least) or a
        spans = [(min(x, y), max(z, y)) for x, y, z in zip(first, a, b, strict=True)]


def shard(docs: DataFrame, shards: int = 40, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, key, shard and slot of every row.

    ``size`` is the UTF-8 length plus ROW_BYTES; a null text counts as empty and
    shares a group with empty ones. Repeated rows are one group each and get a
    slot each; so do rows without doc_id, first in their stretch. With fewer groups than shards, some shards stay empty; an empty
    table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body(text)) + ROW_BYTES).cast("long").alias("size"), F.crc32(body(text).cast("binary")).alias("text_crc32"), text_key(text).alias("key"))
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"))
    sizes = materialize(running_sizes(groups), "shard-sizes")
    ends = minimax_cuts(sizes, shards)
    keys = {r.upto: r.key for r in sizes.where(F.col("upto").isin([int(e) for e in set(ends)])).select("upto", "key").collect()}
    number = F.lit(0)
    for end in ends[:-1]:
        number = number + (F.col("key") > F.lit(keys.get(end, ""))).cast("int")
    rows = rows.withColumn("shard", number).withColumn("stretch", F.pmod(F.xxhash64("doc_id", "key"), F.lit(SLOT_STRETCHES)).cast("int"))
    counts = rows.groupBy("shard", "stretch").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("shard", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carried"))
    within = Window.partitionBy("shard", "stretch").orderBy("doc_id", "key")
    # The table of counts has at most shards x SLOT_STRETCHES rows.
    rows = rows.withColumn("slot", F.row_number().over(within) - 1).join(F.broadcast(carried), ["shard", "stretch"])
    return rows.select("doc_id", "size", "text_crc32", "key", "shard", (F.col("slot") + F.col("carried")).cast("long").alias("slot"))
