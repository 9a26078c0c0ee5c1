"""Joins of intervals and of points as equi-joins on bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import overlaps

#: Near the median length of the longer side's intervals.
BIN = 1000
#: Bins of its own class that an interval spans at most but for one, and the factor between the bins of two classes.
SPAN = 8
#: Classes of length; the last takes everything longer than SPAN^CLASSES bins.
CLASSES = 12


def _class_of(length: Column, width: int) -> Column:
    """0 up to SPAN bins of ``width``, 1 up to SPAN bins of SPAN widths, and so on."""
    return sum(((length > F.lit(width * SPAN ** (k + 1)).cast("long")).cast("int") for k in range(CLASSES)), F.lit(0))


def size_of(level: Column, width: int) -> Column:
    """Width of a bin of a class."""
    return F.element_at(F.array(*[F.lit(width * SPAN**k).cast("long") for k in range(CLASSES + 1)]), level + 1)


def bins_of(s: Column, e: Column, size: Column) -> Column:
    return F.sequence(F.floor(s / size), F.floor(e / size))


def _flat(df: DataFrame, side: str) -> list[Column]:
    """Columns under names of their own: structs that go through explode lose fields in the optimizer's pruning."""
    return [F.col(c).alias(f"_{side}_{c}") for c in df.columns]


def _packed(df: DataFrame, left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
    """The columns of both sides as structs l and r."""
    pack = lambda side, of: F.struct(*[F.col(f"_{side}_{c}").alias(c) for c in of.columns]).alias(side)
    return df.select(pack("l", left), pack("r", right), *more)


def _levels(df: DataFrame, level: Column, name: str) -> DataFrame:
    """One row with the array of classes that occur in df."""
    return F.broadcast(df.agg(F.collect_set(level).alias(name)))


def interval_class(width: int, s: Column | None = None, e: Column | None = None) -> Column:
    """The class of an interval, [s, e] of its row if not given."""
    return _class_of((F.col("e") if e is None else e) - (F.col("s") if s is None else s) + 1, width)


def cells_of(side: DataFrame, other: DataFrame, width: int, own: int) -> DataFrame:
    """side (with _level) with a row for each cell (_tag, _at, _bin) in which it may meet other; both have s and e.

    An interval lies in bins of its own class and, where the other side has longer
    classes, in the one or two bins of each of these. Cells of tag 0 are for pairs whose
    left interval is of a longer or equal class, those of tag 1 for the rest, so that no pair is met
    in the cells of both. ``own`` is the tag of the cells in which this side is the longer one.
    """
    level = F.col("_level")
    longer = lambda x: (x > level) if own == 0 else (x >= level)
    cell = lambda tag, at: F.struct(F.lit(tag).alias("_tag"), at.alias("_at"))
    mine = F.transform(F.filter(F.array(level), lambda _: F.exists("_others", lambda x: ~longer(x))), lambda x: cell(own, x))
    at = F.concat(mine, F.transform(F.filter("_others", longer), lambda x: cell(1 - own, x)))
    rows = side.crossJoin(_levels(other.where("s <= e"), interval_class(width), "_others")).withColumn("_cell", F.explode(at)).drop("_others")
    return rows.select("*", "_cell._tag", "_cell._at", F.explode(bins_of(F.col("s"), F.col("e"), size_of(F.col("_cell._at"), width))).alias("_bin")).drop("_cell")


def _dealt(rows: DataFrame, parts: DataFrame, by: list[str], mine: str, other: str) -> DataFrame:
    """rows with a salt for each side: dealt by their hash on their own, copied over the other."""
    one = lambda c: F.coalesce(F.col(c), F.lit(1))
    own = [c for c in rows.columns if c.startswith(f"_{mine}_")]
    rows = rows.join(parts, by, "left").withColumn(f"_salt_{mine}", F.pmod(F.xxhash64(*own), one(f"_parts_{mine}")))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), one(f"_parts_{other}").cast("long") - 1))
    return rows.withColumn(f"_salt_{other}", copies).drop("_parts_l", "_parts_r")


def crowded(a: DataFrame, b: DataFrame, by: list[str], split: int) -> DataFrame:
    """(by, _parts_l, _parts_r) of cells with over ``split`` rows on a side: a histogram of the cells, which are rows / split at most."""
    n = lambda df, l, r: df.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > split).select(*by, *[F.ceil(F.lit(x) * F.col("n") / split).cast("long").alias(f"_parts_{s}") for s, x in (("l", l), ("r", r))])
    both = n(a, 1, 0).unionByName(n(b, 0, 1))
    return both.groupBy(*by).agg(*[F.greatest(F.max(f"_parts_{s}"), F.lit(1)).alias(f"_parts_{s}") for s in "lr"])


def overlap_pairs(left: DataFrame, right: DataFrame, keys=("chr",), width: int = BIN, condition: Column | None = None, split: int | None = None) -> DataFrame:
    """Pairs of overlapping closed intervals, as structs ``l`` and ``r``, each pair once.

    Intervals fall into classes by length, each with bins of its own width, so that an
    interval makes few rows however long it is; classes meet in the bins of the longer
    one. A pair counts in its first shared bin only, so nothing is made distinct. Rows
    with a null in a key or end, or with e < s, have no pairs. With ``split``, cells of
    more rows than that on a side are found by a histogram and dealt to as many parts as it takes;
    adaptive execution splits large partitions further.
    """

    def prepared(df: DataFrame, side: str) -> DataFrame:
        named = [F.col(k).alias(f"_{k}") for k in keys]
        return df.where("s <= e").select(*_flat(df, side), *named, "s", "e", interval_class(width).alias("_level"))

    by = ["_tag", "_at", "_bin", *[f"_{k}" for k in keys]]
    a, b = (df.drop("s", "e", "_level") for df in (cells_of(prepared(left, "l"), right, width, 0), cells_of(prepared(right, "r"), left, width, 1)))
    if split:
        parts = crowded(a, b, by, split)
        a, b = _dealt(a, parts, by, "l", "r"), _dealt(b, parts, by, "r", "l")
        by = [*by, "_salt_l", "_salt_r"]
    pairs = _packed(a.join(b, by), left, right, "_bin", "_at")
    first = F.col("_bin") == F.floor(F.greatest("l.s", "r.s") / size_of(F.col("_at"), width))
    pairs = pairs.where(overlaps("l", "r") & first)
    return (pairs if condition is None else pairs.where(condition)).select("l", "r")


def having_overlap(left: DataFrame, right: DataFrame, key: str = "id", how: str = "left_semi", **options) -> DataFrame:
    """Rows of left with (left_semi) or without (left_anti) an overlapping row; key names rows of left."""
    met = overlap_pairs(left, right, **options).select(F.col(f"l.{key}").alias(key)).distinct()
    return left.join(met, key, how)


def circle_class(radius: Column, least: float) -> Column:
    """0 for radii up to ``least``, 1 up to twice that, and so on."""
    return F.when(radius > least, F.ceil(F.log2(radius / F.lit(least)))).otherwise(0).cast("int")


def largest_radius(level: Column, least: float) -> Column:
    return F.lit(least) * F.pow(F.lit(2.0), level)


def near_points(left: DataFrame, right: DataFrame, keys, least: float) -> DataFrame:
    """(l, r) of circles and the points of the squares that they touch, each once, as a circle touches a point's square once.

    Circles fall into classes by radius, up to ``least`` and twice that of the one before, each with a grid of squares of its largest radius.
    """
    level, side = circle_class(F.col("radius"), least), largest_radius(F.col("_level"), least)
    named = [F.col(k).alias(f"_{k}") for k in keys]
    circles = left.where("radius >= 0").select(*_flat(left, "l"), *named, "x", "y", "radius", level.alias("_level"))
    span = lambda c: F.sequence(F.floor((F.col(c) - F.col("radius")) / side), F.floor((F.col(c) + F.col("radius")) / side))
    a = circles.withColumn("_cx", F.explode(span("x"))).withColumn("_cy", F.explode(span("y"))).drop("x", "y", "radius")
    points = right.select(*_flat(right, "r"), *named, "x", "y").crossJoin(_levels(left.where("radius >= 0"), level, "_all"))
    b = points.withColumn("_level", F.explode("_all")).select(*[f"_r_{c}" for c in right.columns], *[f"_{k}" for k in keys], "_level", F.floor(F.col("x") / side).alias("_cx"), F.floor(F.col("y") / side).alias("_cy"))
    return _packed(a.join(b, ["_level", "_cx", "_cy", *[f"_{k}" for k in keys]]), left, right)


def circle_pairs(left: DataFrame, right: DataFrame, keys=("chr",), least: float = 16.0, condition: Column | None = None) -> DataFrame:
    """Pairs of a circle of left (x, y, radius) and a point of right (x, y) in it, as structs ``l`` and ``r``, each pair once.

    A circle touches nine squares of its grid at most, and a point lies in one of each
    grid that has circles, so what is compared stays within a constant of what lies
    near in both directions. Circles with a null or negative radius, and rows with a
    null in a key or place, have no pairs.
    """
    dx, dy, radius = F.col("r.x") - F.col("l.x"), F.col("r.y") - F.col("l.y"), F.col("l.radius")
    pairs = near_points(left, right, keys, least).where(dx * dx + dy * dy <= radius * radius)
    return (pairs if condition is None else pairs.where(condition)).select("l", "r")
