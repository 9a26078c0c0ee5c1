"""Text formats of reads, annotation and peaks, read with built-in expressions.

Tag readers give (strand_char, chromosome, start, sequence), as
``normalize_tags`` takes them. Rows that a format cannot hold are left out. A
reader that leaves rows out takes an ``Observation``, which after the scan that reads the rows has
the number of lines (headers of SAM aside) and of those left out for each reason, the first that holds.
``sam_rejects`` shows such lines for SAM.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .shared import address, paths_like

#: Names of chromosomes that are kept.
CHROMOSOME = "^chr[A-Za-z0-9]+$"
UNMAPPED, SECONDARY, REVERSE = 4, 0x100, 0x10


def _fields(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """``f``: the fields of each line that is not blank."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.split("value", sep).alias("f"))


def _at(i: int, kind: str = "string") -> Column:
    field = F.trim(F.get("f", F.lit(i)))
    return field if kind == "string" else field.try_cast(kind)


def _sound(rows: DataFrame, reasons: dict[str, Column], counts: Observation | None) -> DataFrame:
    """Rows for which no reason, which is never null, holds; ``counts`` sees all of them on the way."""
    why = F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in reasons.items()])
    rows = rows.withColumn("_why", why)
    if counts:
        rows = rows.observe(counts, F.count(F.lit(1)).alias("lines"), *[F.count_if(F.coalesce(F.col("_why") == name, F.lit(False))).alias(name) for name in reasons])
    return rows.where("_why is null").drop("_why")


def _without(*names: str) -> Column:
    """One of the columns is null."""
    return F.greatest(*[F.col(n).isNull() for n in names]) if len(names) > 1 else F.col(names[0]).isNull()


def _other(holds: Column) -> Column:
    """It does not hold, or is null."""
    return ~F.coalesce(holds, F.lit(False))


def _sam(spark: SparkSession, path) -> tuple[DataFrame, Column]:
    rows = _fields(spark, path).where(~F.get("f", F.lit(0)).startswith("@"))
    return rows, (F.size("f") >= 10) & _at(1, "int").isNotNull() & _at(3, "long").isNotNull() & _at(4, "int").isNotNull()


def read_sam(spark: SparkSession, path, min_map_quality: int = 10, counts: Observation | None = None) -> DataFrame:
    """Primary alignments of at least the quality; positions become 0-based. Supplementary ones stay."""
    rows, sound = _sam(spark, path)
    flag = _at(1, "int")
    reasons = {"malformed": _other(sound), "unmapped": flag == UNMAPPED, "secondary": flag.bitwiseAND(SECONDARY) != 0, "low_quality": _at(4, "int") < min_map_quality}
    kept = _sound(rows, reasons, counts)
    strand = F.when(flag.bitwiseAND(REVERSE) != 0, "-").otherwise("+")
    return kept.select(strand.alias("strand_char"), _at(2).alias("chromosome"), (_at(3, "long") - 1).alias("start"), _at(9).alias("sequence"))


def sam_rejects(spark: SparkSession, path) -> DataFrame:
    """Lines with too few fields or with text where numbers belong."""
    rows, sound = _sam(spark, path)
    return rows.where(~sound).select(F.array_join("f", "\t").alias("line"))


def read_bowtie(spark: SparkSession, path, counts: Observation | None = None) -> DataFrame:
    return _tags(_fields(spark, path), F.size("f") >= 6, 1, counts)


def read_tags4(spark: SparkSession, path, counts: Observation | None = None) -> DataFrame:
    return _tags(_fields(spark, path), F.size("f") == 4, 0, counts)


def _tags(rows: DataFrame, whole: Column, first: int, counts: Observation | None) -> DataFrame:
    names = [_at(first).alias("strand_char"), _at(first + 1).alias("chromosome"), _at(first + 2, "long").alias("start"), _at(first + 3).alias("sequence")]
    return _sound(rows, {"malformed": ~whole, "no_position": _at(first + 2, "long").isNull()}, counts).select(*names)


TAG_FORMATS = {"sam": read_sam, "bowtie": read_bowtie, "tags": read_tags4}


def read_tags(spark: SparkSession, path: str, fmt: str | None = None, counts: Observation | None = None) -> DataFrame:
    """By named format, or by the path's suffix (without .gz); others are read as four columns."""
    name = fmt or path.removesuffix(".gz").rsplit(".", 1)[-1].lower()
    if name == "bam":
        raise ValueError("convert to SAM first")
    if fmt and fmt not in TAG_FORMATS:
        raise ValueError(f"unknown format {fmt}")
    return TAG_FORMATS.get(name, read_tags4)(spark, path, counts=counts)


def read_refgene(spark: SparkSession, path) -> DataFrame:
    """(identifier, chromosome, strand_char, s, e)."""
    return _fields(spark, path).select(_at(1).alias("identifier"), _at(2).alias("chromosome"), _at(3).alias("strand_char"), _at(4, "long").alias("s"), _at(5, "long").alias("e"))


def read_bed_regions(spark: SparkSession, path) -> DataFrame:
    """As read_refgene; a path that does not exist gives no rows."""
    try:
        rows = _fields(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], "f array<string>")
    return rows.select(_at(3).alias("identifier"), _at(0).alias("chromosome"), _at(5).alias("strand_char"), _at(1, "long").alias("s"), _at(2, "long").alias("e"))


def read_ncrna_summary(spark: SparkSession, path, species: str, counts: Observation | None = None) -> DataFrame:
    """(id, description, type, source) of rows whose organism contains the species, at most 255 characters each; header lines are left out."""
    names = ["id", "acc", "description", "so_name", "organism", "xref", "length"]
    rows = spark.read.csv(path, quote='"', escape='"', schema=", ".join(f"{n} string" for n in names))
    reasons = {"no_id": _other(F.trim("id") != ""), "header": F.col("id") == "ID", "other_species": _other(F.col("organism").contains(species))}
    kept = _sound(rows, reasons, counts)
    short = lambda c, name: F.substring(c, 1, 255).alias(name)
    return kept.select(short("id", "id"), short("description", "description"), short("so_name", "type"), short("xref", "source"))


def read_chromosomes(spark: SparkSession, path, counts: Observation | None = None) -> DataFrame:
    """(id, name, length) of lines (name, last base): sequences with a plain name, numbered in the order of the file.

    A genome has few sequences, so numbering them takes one task.
    """
    rows = _fields(spark, path).select(F.monotonically_increasing_id().alias("place"), _at(0).alias("name"), (_at(1, "long") + 1).alias("length"))
    kept = _sound(rows, {"other_name": _other(F.col("name").rlike(CHROMOSOME)), "no_length": _without("length")}, counts)
    return kept.select(F.row_number().over(Window.orderBy("place")).cast("long").alias("id"), "name", "length")


def read_intervals(spark: SparkSession, path, counts: Observation | None = None) -> DataFrame:
    """(chr, start, end, strand, file) of BED-like files; lines without numbers, as headers, are left out."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f"), F.input_file_name().alias("file"))
    named = rows.select(_at(0).alias("chr"), _at(1, "long").alias("start"), _at(2, "long").alias("end"), _at(5).alias("strand"), "file")
    return _sound(named, {"no_position": _without("start", "end")}, counts)


def read_interval_sets(spark: SparkSession, template: str, values: dict[str, list], counts: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Interval files of a grid of settings, and which of them there are.

    The template is a path with a field in braces for each key of ``values``, as
    ``calls/{penalty}_{shape}.bed``; it may name files or folders of them. Files of settings that
    are not asked for are not opened. The first table is (keys, chr, start, end,
    strand) of all files in one scan, with keys from their names, the second one (keys, found) of
    every setting. A file that is there without any interval is found.
    """
    names = list(values)
    if sorted(re.findall(r"\{(\w+)\}", template)) != sorted(names):
        raise ValueError("the fields of the template are not the given keys")
    settings = list(itertools.product(*values.values()))
    if not settings:
        raise ValueError("a key has no values")
    there = paths_like(spark, re.sub(r"\{\w+\}", "*", template))
    paths = [template.format(**dict(zip(names, one))) for one in settings]
    places = [address(spark, path) for path in paths]
    asked = spark.createDataFrame([(*one, place, place in there) for one, place in zip(settings, places)], [*names, "_place", "found"])
    present = [path for path, place in zip(paths, places) if place in there]
    lines = spark.read.text(present) if present else spark.createDataFrame([], "value string").withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    file = F.regexp_replace("_metadata.file_path", "^([a-z0-9]+):/+", "$1:/")
    fields = lines.select(F.split("value", "\t").alias("f"), F.array(file, F.regexp_replace(file, "/[^/]*$", "")).alias("_at"))
    rows = fields.select(_at(0).alias("chr"), _at(1, "long").alias("start"), _at(2, "long").alias("end"), _at(5).alias("strand"), "_at")
    sound = _sound(rows, {"no_position": _without("start", "end")}, counts).withColumn("_place", F.explode("_at"))
    sets = sound.join(F.broadcast(asked.drop("found")), "_place").select(*names, "chr", "start", "end", "strand")
    return sets, asked.drop("_place")


def _parts(number: Column, name: str) -> list[Column]:
    """A number as text with an exponent, in two columns."""
    p = F.split(F.lower(number), "e")
    return [F.get(p, F.lit(0)).try_cast("decimal(6,4)").alias(name), F.coalesce(F.get(p, F.lit(1)).try_cast("int"), F.lit(0)).alias(f"{name}_exp")]


def _on_known(rows: DataFrame, chromosomes: DataFrame, counts: Observation | None) -> DataFrame:
    """chr in place of the name; rows elsewhere are left out. Ends stay half-open."""
    names = chromosomes.select(F.col("id").alias("chr"), F.col("name").alias("chromosome"))
    reasons = {"other_name": _other(F.col("chromosome").rlike(CHROMOSOME)), "no_position": _without("s", "e"), "unknown_chromosome": _without("chr")}
    both = rows.join(names, "chromosome", "left")
    return _sound(both.select("chr", *[c for c in rows.columns if c != "chromosome"], "chromosome"), reasons, counts).drop("chromosome")


def _place(first: int = 0) -> list[Column]:
    return [_at(first).alias("chromosome"), _at(first + 1, "long").alias("s"), _at(first + 2, "long").alias("e")]


def read_macs(spark: SparkSession, path, chromosomes: DataFrame, counts: Observation | None = None) -> DataFrame:
    more = [_at(3, "long").alias("length"), _at(4, "long").alias("summit"), *[_at(i, "decimal(10,2)").alias(n) for i, n in ((5, "tag_count"), (6, "log_ten_p_value"), (7, "fold_enrichment"))]]
    return _on_known(_fields(spark, path).select(*_place(), *more), chromosomes, counts)


def read_sicer(spark: SparkSession, path, chromosomes: DataFrame, counts: Observation | None = None) -> DataFrame:
    more = [(_at(2, "long") - _at(1, "long")).alias("length"), _at(3, "decimal(10,2)").alias("tag_count"), *_parts(_at(5), "p_value"), _at(6, "decimal(10,2)").alias("fold_enrichment"), *_parts(_at(7), "fdr_threshold")]
    return _on_known(_fields(spark, path).select(*_place(), *more), chromosomes, counts)


def read_bed_peaks(spark: SparkSession, path, chromosomes: DataFrame, counts: Observation | None = None) -> DataFrame:
    """A chromosome that is not known raises."""
    rows = _fields(spark, path).select(*_place(), (_at(2, "long") - _at(1, "long")).alias("length"), _at(4, "decimal(8,2)").alias("score"))
    names = chromosomes.select(F.col("id").alias("chr"), F.col("name").alias("chromosome"))
    known = F.when(F.col("chr").isNull(), F.raise_error(F.concat(F.lit("unknown chromosome "), "chromosome")).cast("long")).otherwise(F.col("chr"))
    placed = _sound(rows, {"no_position": _without("s", "e")}, counts)
    return placed.join(F.broadcast(names), "chromosome", "left").withColumn("chr", known).drop("chromosome")


def read_homer(spark: SparkSession, path, chromosomes: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Columns by the names in the line that starts ``#PeakID``; its absence raises."""
    header = spark.read.text(path).where(F.col("value").startswith("#PeakID")).first()
    if header is None:
        raise ValueError("no line starts with #PeakID")
    names = [n.strip() for n in header.value.split("\t")]

    def named(*wanted: str) -> Column:
        return next((_at(names.index(n)) for n in wanted if n in names), F.lit(None).cast("string"))

    score = named("findPeaks Score").try_cast("decimal(8,2)") if "findPeaks Score" in names else F.lit(0).cast("decimal(8,2)")
    s, e = named("start").try_cast("long"), named("end").try_cast("long")
    rows = _fields(spark, path).where(~F.get("f", F.lit(0)).startswith("#")).select(
        named("chr").alias("chromosome"),
        s.alias("s"),
        e.alias("e"),
        F.when(named("strand") == "-", 1).otherwise(0).alias("strand"),
        (e - s).alias("length"),
        named("Normalized Tag Count").try_cast("decimal(10,2)").alias("tag_count"),
        score.alias("score"),
        *_parts(named("p-value vs Control", "p-value vs Local"), "p_value"),
        named("Fold Change vs Control", "Fold Change vs Local").try_cast("decimal(10,2)").alias("fold_enrichment"),
    )
    return _on_known(rows, chromosomes, counts)
