"""Tables of reference annotation: identifiers, gene and non-coding regions, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .transcripts import Parameters, allowed_edge, collapse_tags, proto_transcripts, set_density, stitch


def _strand() -> Column:
    return F.when(F.col("strand_char") == "-", 1).otherwise(0).alias("strand")


def _names(chromosomes: DataFrame) -> DataFrame:
    return chromosomes.select(F.col("id").alias("chr"), F.col("name").alias("chromosome"))


def sequence_identifiers(genes: DataFrame) -> DataFrame:
    """Distinct identifiers with the type that their prefix tells; null for other prefixes."""
    prefix = F.substring("identifier", 1, 2)
    return genes.select("identifier", F.when(prefix == "NM", "mRNA").when(prefix == "NR", "RNA").alias("type")).distinct()


def gene_regions(genes: DataFrame, identifiers: DataFrame, chromosomes: DataFrame, margin: int = 1000) -> DataFrame:
    """Genes (identifier, chromosome, strand_char, s, e) on known chromosomes, with a window about the whole and about the start.

    The start of a gene on the reverse strand is its end.
    """
    rows = genes.join(identifiers, "identifier").join(_names(chromosomes), "chromosome")
    site = F.when(F.col("strand_char") == "-", F.col("e")).otherwise(F.col("s"))
    windows = [(F.col("s") - margin).alias("wide_s"), (F.col("e") + margin).alias("wide_e"), (site - margin).alias("site_s"), (site + margin).alias("site_e")]
    return rows.select("identifier", "type", "chr", _strand(), "s", "e", *windows)


def noncoding_rna(summary: DataFrame, regions: DataFrame) -> DataFrame:
    """(type, description, source) of summary rows whose id names a region; the id leads the description."""
    named = regions.select(F.col("identifier").alias("id"))
    return _described(summary).join(named, "id", "left_semi").select("type", "description", "source")


def noncoding_regions(regions: DataFrame, summary: DataFrame, rna: DataFrame, chromosomes: DataFrame) -> DataFrame:
    """(type, description, chr, strand, s, e) of regions on known chromosomes whose summary row is among rna."""
    rows = regions.withColumnRenamed("identifier", "id").join(_described(summary).select("id", "description"), "id")
    return rows.join(rna, "description").join(_names(chromosomes), "chromosome").select("type", "description", "chr", _strand(), "s", "e")


def _described(summary: DataFrame) -> DataFrame:
    return summary.withColumn("description", F.concat("id", F.lit(": "), "description"))


def run_registry(tags: DataFrame, annotation: str = "gene_regions") -> DataFrame:
    """(id, source_table, total_tags) of each run, and a pseudo-run 0 for the annotation, without a total."""
    runs = tags.groupBy(F.col("run_id").alias("id")).agg(F.count("*").alias("total_tags"))
    runs = runs.select("id", F.concat(F.lit("run_"), F.col("id").cast("string")).alias("source_table"), "total_tags")
    pseudo = tags.sparkSession.createDataFrame([(0, annotation, None)], "id int, source_table string, total_tags long")
    return runs.unionByName(pseudo)


def consolidated_genes(regions: DataFrame, p: Parameters) -> DataFrame:
    """Gene regions (chr, strand, s, e) merged as if they were the tags of one run, with density and edge."""
    tags = regions.select(F.lit(0).alias("run_id"), "chr", "strand", "s", "e", F.lit(True).alias("refseq"))
    stitched, sources = stitch(proto_transcripts(collapse_tags(tags), p), p)
    return allowed_edge(set_density(stitched, sources, p), regions, p, extend=False).select("id", "chr", "strand", "s", "e", "refseq", "density", "edge")


def first_regions(regions: DataFrame, key: str) -> DataFrame:
    """For each key, the region (id, chr, strand, s, e) that starts first; the lowest id of equals."""
    row = F.struct("id", "chr", "strand", "s", "e")
    return regions.groupBy(key).agg(F.min_by(row, F.struct("s", "id")).alias("_r")).select(key, "_r.*")
