"""Errors of a called transcript set against reference annotation.

A reference interval is broken when, among called ones of its chromosome and
strand in order, the first to end at or past its start ends within it, the last to start
at or before its end starts within it, and they are two. Both are as-of look-ups in
a union of both sides: the last in order of starts, and the first among those that
end further than all before them, in which starts and ends go alike. No pairs of
overlapping intervals are made. Where the rows of every chromosome and strand fit a
task, they are dealt once for both look-ups of both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .segments import cluster_rows, fits, last_seen

KEYS = ("chr", "strand")
#: Positions of a stretch.
BLOCK = 1 << 20


def normalize_intervals(df: DataFrame, more=()) -> DataFrame:
    """(chr, strand, s, e) of rows (chr, start, end, strand); + and - become 0 and 1, a name without ``chr`` raises."""
    named = F.when(F.col("chr").startswith("chr"), F.col("chr")).otherwise(F.raise_error("a chromosome name does not begin with chr").cast("string"))
    sign = F.col("strand").cast("string")
    strand = F.when(sign == "-", 1).when(sign == "+", 0).otherwise(sign.try_cast("int"))
    return df.select(*more, named.alias("chr"), strand.alias("strand"), F.col("start").cast("long").alias("s"), F.col("end").cast("long").alias("e"))


def broken_intervals(whole: DataFrame, breaking: DataFrame, keys=KEYS, block: int | None = BLOCK) -> DataFrame:
    """(keys, s, e, n): intervals of whole that breaking ones break, with the number of equal rows.

    Equal rows of breaking are different intervals. Rows with a null in a key or end, or with e < s, take no part.
    Windows run within stretches of ``block`` positions; None takes whole keys.
    """
    keys = list(keys)
    proper = " and ".join([f"{k} is not null" for k in keys] + ["s <= e"])
    rows, parts = (df.where(proper).groupBy(*keys, "s", "e").agg(F.count("*").alias("n")) for df in (whole, breaking))
    parts = cluster_rows(parts.withColumn("refseq", F.lit(False)), keys, 0, ("s", "e"), block)
    parts = stored(parts.select(*keys, "s", "e", "n", (F.col("reached").isNull() | (F.col("e") > F.col("reached"))).alias("further")), "breaking")

    def union(of: DataFrame, position: str, sign: int, at: str) -> DataFrame:
        """Breaking intervals by one end, before whole ones by the other at the same position."""
        a = of.select(*keys, F.struct("s", "e", "n").alias("_part"), (F.col(position) * sign).alias("_at"), F.lit(0).alias("_kind"), F.col("e").alias("_then"))
        b = rows.select(*keys, (F.col(at) * sign).alias("_at"), F.lit(1).alias("_kind"), "s", "e", "n")
        return a.unionByName(b, allowMissingColumns=True)

    order = ["_at", "_kind", "_then"]
    first = last_seen(union(parts.where("further"), "e", -1, "s"), keys, "_at", order, "_part", "first", block).where("_kind = 1")
    last = last_seen(union(parts, "s", 1, "e"), keys, "_at", order, "_part", "last", block).where("_kind = 1")
    both = first.select(*keys, "s", "e", "n", "first").join(last.select(*keys, "s", "e", "last"), [*keys, "s", "e"])
    two = (F.col("first.s") != F.col("last.s")) | (F.col("first.e") != F.col("last.e")) | (F.col("first.n") > 1)
    return both.where((F.col("first.e") <= F.col("e")) & (F.col("last.s") >= F.col("s")) & two).select(*keys, "s", "e", "n")


def count_broken(reference: DataFrame, target: DataFrame, by=(), block: int | None = BLOCK) -> DataFrame:
    """n: reference intervals that target ones break, for each value of the columns ``by``."""
    return _total(broken_intervals(reference, target, (*by, *KEYS), block), by, F.sum("n"))


def count_run_together(reference: DataFrame, target: DataFrame, by=(), block: int | None = BLOCK) -> DataFrame:
    """n: target intervals that run reference ones together."""
    return count_broken(target, reference, by, block)


def _total(df: DataFrame, by, total: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.coalesce(total, F.lit(0)).cast("long").alias("n"))


def _errors_by_key(known: DataFrame, target: DataFrame, by) -> DataFrame:
    """``summed_error`` where the rows of a key fit a task: rows are dealt once, and both look-ups of both sides are windows over the two ends of each row."""
    keys = [*by, *KEYS]
    side = lambda df, k: df.select(*keys, F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"), F.lit(k).alias("_side"))
    rows = side(known, 0).unionByName(side(target, 1)).repartition(*keys).groupBy(*keys, "_side", "s", "e").agg(F.count("*").alias("n"))
    proper = F.expr(" and ".join([f"{k} is not null" for k in keys] + ["coalesce(s <= e, false)"]))
    before = Window.partitionBy(*keys, "_side", "_proper").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_proper", proper).withColumn("_reached", F.max("e").over(before))
    further = F.col("_reached").isNull() | (F.col("e") > F.col("_reached"))
    rows = rows.select("*", further.alias("_further"), F.explode(F.array(F.lit(0), F.lit(1))).alias("_end")).withColumn("_at", F.when(F.col("_end") == 0, F.col("s")).otherwise(F.col("e")))
    part, w = F.struct("s", "e", "n"), Window.partitionBy(*keys)
    forth, back = (w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow) for order in (["_at", "_end", "e"], [F.desc("_at"), F.desc("_end"), "e"]))
    seen = lambda k, end, more, over: F.last(F.when((F.col("_side") == k) & (F.col("_end") == end) & F.col("_proper") & more, part), ignorenulls=True).over(over)
    of_other = lambda end, more, over: F.when(F.col("_end") != end, F.when(F.col("_side") == 0, seen(1, end, more, over)).otherwise(seen(0, end, more, over)))
    rows = rows.withColumn("last", of_other(0, F.lit(True), forth)).withColumn("first", of_other(1, F.col("_further"), back))
    ends = {f"{x}_{c}": F.max(f"{x}.{c}").alias(f"{x}_{c}") for x, c in (("first", "s"), ("first", "e"), ("first", "n"), ("last", "s"), ("last", "e"))}
    rows = rows.groupBy(*keys, "_side", "s", "e", "n", "_proper").agg(*ends.values())
    two = (F.col("first_s") != F.col("last_s")) | (F.col("first_e") != F.col("last_e")) | (F.col("first_n") > 1)
    broken = F.col("_proper") & (F.col("first_e") <= F.col("e")) & (F.col("last_s") >= F.col("s")) & two
    total = lambda k, more=F.lit(True): F.coalesce(F.sum(F.when((F.col("_side") == k) & more, F.col("n"))), F.lit(0)).cast("double")
    return rows.groupBy(*by).agg((F.try_divide(total(0, broken), total(0)) + F.try_divide(total(1, broken), total(1))).alias("error"))


def summed_error(reference: DataFrame, target: DataFrame, by=(), block: int | None = BLOCK) -> DataFrame:
    """error: share of broken reference intervals and share of targets that run some together, added.

    Only reference rows whose chromosome and strand have targets count. With
    ``by``, columns of target name sets that are scored apart.
    """
    target = stored(target.select(*by, *KEYS, "s", "e"), "targets")
    groups = target.select(*by, *KEYS).distinct()
    known = reference.join(groups, list(KEYS))
    if block is None or fits((reference,), KEYS) and fits((target,), [*by, *KEYS]):
        return _errors_by_key(known, target, by)
    parts = {
        "broken": count_broken(known, target, by, block),
        "references": _total(known, by, F.count("*")),
        "together": count_run_together(known, target, by, block),
        "targets": _total(target, by, F.count("*")),
    }
    counts = None
    for name, df in parts.items():
        one = df.select(*by, F.lit(name).alias("what"), "n")
        counts = one if counts is None else counts.unionByName(one)
    n = {name: F.coalesce(F.sum(F.when(F.col("what") == name, F.col("n"))), F.lit(0)) for name in parts}
    share = lambda a, b: F.try_divide(n[a].cast("double"), n[b].cast("double"))
    return counts.groupBy(*by).agg((share("broken", "references") + share("together", "targets")).alias("error"))


def compare_sets(first: DataFrame, second: DataFrame, block: int | None = BLOCK) -> DataFrame:
    """forward and backward error of two transcript sets, each against the other."""
    forward = summed_error(first, second, block=block).withColumnRenamed("error", "forward")
    return forward.crossJoin(F.broadcast(summed_error(second, first, block=block).withColumnRenamed("error", "backward")))


def grid_error_matrix(reference: DataFrame, candidates: DataFrame, row: str, column: str, values: list, block: int | None = BLOCK, expected: DataFrame | None = None) -> DataFrame:
    """Errors of many candidate sets: one line for each value of row, one column for each of values; null without a set.

    ``expected`` (row, column) has all settings that were tried, so that a line also comes where none of its sets is there.
    """
    errors = summed_error(reference, candidates, (row, column), block)
    if expected is not None:
        errors = expected.select(row, column).distinct().join(errors, [row, column], "left")
    return errors.groupBy(row).pivot(column, values).agg(F.first("error"))


def best_setting(matrix: DataFrame, row: str, values: list) -> DataFrame:
    """(row, column, error) of the smallest error of a matrix, the lowest row and the first column of equals; no row without any error."""
    cells = F.explode(F.array(*[F.struct(F.col(str(x)).alias("error"), F.lit(i).alias("place"), F.lit(str(x)).alias("column")) for i, x in enumerate(values)])).alias("cell")
    found = matrix.select(row, cells).where("cell.error is not null")
    least = found.agg(F.min(F.struct(F.col("cell.error").alias("error"), F.col(row), F.col("cell.place").alias("place"), F.col("cell.column").alias("column"))).alias("m"))
    return least.where("m is not null").select(f"m.{row}", "m.column", "m.error")
