"""Analyst queries over an atlas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import length, rpkm
from .joins import having_overlap, overlap_pairs


class Analysis:
    """Queries over transcripts t with sources, annotation, regions and runs.

    ``scored`` are transcripts of at least min_score without a parent. genes and noncoding may
    be functions that make these tables, for queries that read them.
    """

    def __init__(self, transcripts, sources, genes, noncoding, regions, runs, min_score=1.0, margin=1000, width=1000):
        self.t, self.sources, self._genes, self._noncoding = transcripts, sources, genes, noncoding
        self.regions, self.runs, self.margin, self.width = regions, runs, margin, width
        self.expressed = transcripts.where(F.col("score") >= min_score)
        self.scored = self.expressed.where("parent_id is null")

    @property
    def genes(self) -> DataFrame:
        return self._genes() if callable(self._genes) else self._genes

    @property
    def noncoding(self) -> DataFrame:
        return self._noncoding() if callable(self._noncoding) else self._noncoding

    def one(self, df: DataFrame) -> DataFrame:
        return df.agg(F.countDistinct("id").alias("n"))

    def without_annotation(self, df: DataFrame) -> DataFrame:
        for known in (self.genes, self.noncoding):
            df = df.join(known.select(F.col("transcript_id").alias("id")), "id", "left_anti")
        return df

    def starts(self) -> DataFrame:
        """Regions with ts, te: a margin about the start of transcription."""
        site = F.when(F.col("strand") == 0, F.col("s")).otherwise(F.col("e"))
        return self.regions.withColumns({"ts": site - self.margin, "te": site + self.margin})

    def major_genes(self, df: DataFrame) -> DataFrame:
        return df.join(self.genes.where("major").select(F.col("transcript_id").alias("id"), "region_id"), "id")

    def bases_per_strand(self) -> DataFrame:
        return self.t.groupBy("strand").agg(F.sum(length()).alias("bases"))

    def totals(self) -> DataFrame:
        n = lambda c, name: F.count(F.when(F.col("parent_id").isNull() & c, 1)).alias(name)
        return self.t.agg(n(F.lit(True), "n_all"), n(F.col("score") >= 1, "n_1"), n(F.col("score") >= 0.75, "n_75"))

    def refseq_major_minor(self) -> DataFrame:
        hit = self.scored.join(self.genes.select(F.col("transcript_id").alias("id"), "major"), "id")
        return hit.groupBy("major").agg(F.countDistinct("id").alias("n"))

    def has_ncrna(self) -> DataFrame:
        return self.one(self.scored.join(self.noncoding.select(F.col("transcript_id").alias("id")), "id"))

    def unannotated(self) -> DataFrame:
        return self.one(self.without_annotation(self.scored))

    def proximal(self) -> DataFrame:
        return self.one(self.without_annotation(self.scored).where("not distal"))

    def distal(self) -> DataFrame:
        return self.one(self.without_annotation(self.scored).where("distal"))

    def _opposite(self, antisense: bool) -> DataFrame:
        """Pairs of unannotated proximal transcripts and genes of the other strand, at its start or in its body."""
        t = self.without_annotation(self.scored).where("not distal").select("id", "chr", "strand", "s", "e")
        regions = self.starts()
        at_start = (F.col("l.s") <= F.col("r.te")) & (F.col("r.ts") <= F.col("l.e"))
        if antisense:
            return overlap_pairs(t, regions, ("chr",), self.width, (F.col("l.strand") != F.col("r.strand")) & ~at_start)
        sites = regions.select("id", "chr", "strand", F.col("ts").alias("s"), F.col("te").alias("e"))
        return overlap_pairs(t, sites, ("chr",), self.width, F.col("l.strand") != F.col("r.strand"))

    def opposite(self, antisense: bool, expressed_gene: bool) -> DataFrame:
        pairs = self._opposite(antisense).select(F.col("l.id").alias("id"), F.col("r.id").alias("region_id"))
        if expressed_gene:
            pairs = pairs.join(self.major_genes(self.scored).select("region_id").distinct(), "region_id", "left_semi")
        return self.one(pairs)

    def distal_peak(self, peaks: DataFrame, how: str = "left_semi", pad: int = 0, any_parent: bool = False) -> DataFrame:
        """Peaks are half-open."""
        t = self.without_annotation(self.expressed if any_parent else self.scored).where("distal")
        near = peaks.select("chr", (F.col("s") - pad).alias("s"), (F.col("e") + pad - 1).alias("e"))
        return self.one(having_overlap(t, near, how=how, width=self.width))

    def post_gene(self) -> DataFrame:
        g = self.expressed.select(F.col("id").alias("parent_id"), F.col("s").alias("gene_start"), F.col("e").alias("gene_end"), F.col("score").alias("gene_score"))
        both = self.expressed.join(g, "parent_id")
        return both.select("id", "chr", F.least("s", "gene_start").alias("min_start"), F.greatest("e", "gene_end").alias("max_end"), F.col("parent_id").alias("gene_id"), "gene_start", "gene_end", F.round("gene_score", 6).alias("gene_score"))

    def expressed_widest(self) -> DataFrame:
        r = self.regions.select(F.col("id").alias("region_id"), "identifier", (F.col("e") - F.col("s")).alias("reg_width"))
        widest = Window.partitionBy("id").orderBy(F.desc("reg_width"), "region_id")
        ranked = self.major_genes(self.scored).join(r, "region_id").withColumn("k", F.row_number().over(widest))
        return ranked.where("k = 1").select("id", "chr", "s", "e", "region_id", "identifier", "reg_width")

    def vectors(self) -> DataFrame:
        return self.t.select("id", F.round("score", 6).alias("score"), F.round("rpkm", 6).alias("rpkm"), length().alias("length")).orderBy("id")

    def tags_by_gene(self, run: str) -> DataFrame:
        one = self.runs.where(F.col("source_table") == run).select(F.col("id").alias("run_id"))
        r = self.regions.where("type = 'mRNA'").select(F.col("id").alias("region_id"), "identifier")
        rows = self.sources.join(one, "run_id").join(self.genes.select(F.col("transcript_id").alias("id"), "region_id"), "id").join(r, "region_id")
        return rows.groupBy("identifier").agg(F.sum("tag_count").alias("tags")).orderBy("identifier")

    def in_run(self, run: str, name: str) -> DataFrame:
        one = self.runs.where(F.col("source_table") == run).select(F.col("id").alias("run_id"), "total_tags")
        rows = self.scored.select("id", "s", "e").join(self.sources, "id").join(one, "run_id")
        return rows.select("id", rpkm("s", "e", "tag_count", "total_tags").alias(name))

    def two_runs(self, first: str, second: str) -> DataFrame:
        return self.in_run(first, "rpkm1").join(self.in_run(second, "rpkm2"), "id")

    def fold_change(self, first: str, second: str) -> DataFrame:
        return self.two_runs(first, second).withColumn("log_fold_change", F.log2(F.col("rpkm1") / F.col("rpkm2")))

    def gene_fold_change(self, first: str, second: str) -> DataFrame:
        r = self.regions.select(F.col("id").alias("region_id"), "identifier")
        rows = self.fold_change(first, second).where(F.abs("log_fold_change") > 1)
        return rows.join(self.genes.select(F.col("transcript_id").alias("id"), "region_id"), "id").join(r, "region_id").drop("region_id")

    def expressed_genes(self) -> DataFrame:
        r = self.regions.select(F.col("id").alias("region_id"), "identifier")
        return self.major_genes(self.scored).join(r, "region_id").select("id", "identifier", F.round("score", 6).alias("score"))

    def rows_per_chromosome(self) -> DataFrame:
        return self.t.groupBy("chr").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "chr")


def bed_rows(transcripts: DataFrame, chromosomes: DataFrame, min_score: float = 1.0) -> DataFrame:
    """Lines of a browser track, and the strand whose file they belong to. Scores are in 1000ths of the highest of both strands."""
    shown = transcripts.where(F.col("score") >= min_score)
    top = F.broadcast(shown.agg(F.max("score").alias("top")))
    c = chromosomes.select(F.col("id").alias("chr"), "name", "length")
    rows = shown.crossJoin(top).join(c, "chr")
    start, end = F.greatest("s", F.lit(0)), F.least("e", "length")
    sign = F.when(F.col("strand") == 0, "+").otherwise("-")
    colour = F.when(F.col("strand") == 0, "0,0,255").otherwise("0,255,0")
    level = F.round(F.col("score") / F.col("top") * 1000, 6)
    line = F.concat_ws("\t", "name", start, end, F.concat(F.lit("Transcript_"), F.col("id")), level, sign, start, end, colour)
    return rows.select("strand", "chr", F.col("s").alias("start"), line.alias("line"))


def write_bed(transcripts: DataFrame, chromosomes: DataFrame, path: str, name: str, min_score: float = 1.0) -> None:
    """A folder of text for each strand: a track line, then its transcripts by chromosome and start.

    Rows are dealt out by ranges, so the files of a folder, in the order of their names, are the track.
    """
    rows = bed_rows(transcripts, chromosomes, min_score)
    track = lambda strand, sign: f'track name={name}_{strand} description="Transcripts, {sign} strand" useScore=1 itemRgb=On'
    heads = transcripts.sparkSession.createDataFrame([(s, None, None, track(s, sign)) for s, sign in enumerate("+-")], rows.schema)
    order = ["strand", F.col("chr").asc_nulls_first(), "start", "line"]
    lines = rows.unionByName(heads).repartitionByRange(*order).sortWithinPartitions(*order)
    lines.select("strand", F.col("line").alias("value")).write.partitionBy("strand").text(path)
