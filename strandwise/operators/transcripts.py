"""From tags to scored transcripts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import contains, length, place_id
from .joins import circle_pairs, overlap_pairs
from .segments import cluster_rows, clusters_of, segment


@dataclass(frozen=True)
class Parameters:
    """Defaults suit a mammalian genome. Windows run within stretches of ``block`` positions; None takes whole strands.

    Overlap joins have bins of ``bin`` positions at least and deal out those of over ``split`` rows; None leaves that to adaptive execution.
    """

    max_gap: int = 0
    tag_extension: int = 0
    max_edge: int = 500
    density_multiplier: int = 10000
    edge_scaling_factor: float = 5
    extension_percent: float = 0.2
    min_one_run_tags: int = 3
    min_score: float = 1
    post_gene_distance: int = 500
    gene_margin: int = 1000
    count_pseudo_run: bool = True
    block: int | None = 1 << 20
    bin: int = 1000
    split: int | None = 1 << 20


def normalize_tags(raw: DataFrame, chromosomes: DataFrame, flip: bool = False) -> DataFrame:
    """Tags (strand_char, chromosome, start, sequence) on known chromosomes, as closed intervals."""
    names = chromosomes.select(F.col("id").alias("chr"), F.col("name").alias("chromosome"))
    strand = F.when(F.col("strand_char") == ("+" if flip else "-"), 1).otherwise(0)
    return raw.join(names, "chromosome").select("chr", strand.alias("strand"), F.col("start").alias("s"), (F.col("start") + F.length("sequence")).alias("e"))


def collapse_tags(tags: DataFrame, keys=("run_id", "chr", "strand")) -> DataFrame:
    """Identical tags become one row with their number."""
    flag = [F.bool_or("refseq").alias("refseq")] if "refseq" in tags.columns else []
    return tags.groupBy(*keys, "s", "e").agg(F.count("*").alias("tag_count"), *flag)


def flag_refseq(tags: DataFrame, genes: DataFrame, width: int = 1000, split: int | None = None) -> DataFrame:
    """refseq: whether a gene on the same chromosome and strand overlaps."""
    keys = ["chr", "strand", "s", "e"]
    places = tags.select(*keys).distinct()
    met = overlap_pairs(places, genes.select(*keys), ("chr", "strand"), width, split=split).select("l.*").distinct()
    return tags.join(met.withColumn("_met", F.lit(True)), keys, "left").withColumn("refseq", F.coalesce("_met", F.lit(False))).drop("_met")


def extend_tags(tags: DataFrame, chromosomes: DataFrame, by: int) -> DataFrame:
    """Lengthen tags downstream, within their chromosome."""
    lengths = chromosomes.select(F.col("id").alias("chr"), F.col("length").alias("_length"))
    s = F.when(F.col("strand") == 1, F.col("s") - by).otherwise(F.col("s"))
    e = F.when(F.col("strand") == 0, F.col("e") + by).otherwise(F.col("e"))
    out = tags.join(lengths, "chr").withColumns({"s": F.greatest(s, F.lit(0)), "e": F.least(e, F.col("_length") - 1)})
    return out.drop("_length")


def union_of_runs(tags: DataFrame) -> DataFrame:
    """Distinct places (chr, s, e, sign) over all runs, in the order of their starts."""
    sign = F.when(F.col("strand") == 0, "+").otherwise("-").alias("sign")
    return tags.select("chr", "s", "e", sign).distinct().orderBy("s")


def in_range(tags: DataFrame, start: int | None = None, end: int | None = None, strand: int | None = None) -> DataFrame:
    """Tags that overlap the closed range, on one strand if given."""
    for condition, given in ((F.col("e") >= F.lit(start), start), (F.col("s") <= F.lit(end), end), (F.col("strand") == F.lit(strand), strand)):
        tags = tags if given is None else tags.where(condition)
    return tags


def proto_transcripts(tags: DataFrame, p: Parameters, chromosomes: DataFrame | None = None) -> DataFrame:
    """Tags of each run merged into proto-transcripts, with the run's density.

    Where tag_extension is set, tags are lengthened within their chromosome first, and
    keep the order of their own starts and ends.
    """
    order = ("s", "e")
    if p.tag_extension:
        if chromosomes is None:
            raise ValueError("extending tags takes the lengths of chromosomes")
        order = ("own_s", "own_e")
        tags = extend_tags(tags.withColumns({"own_s": F.col("s"), "own_e": F.col("e")}), chromosomes, p.tag_extension)
    out = segment(tags, ("run_id", "chr", "strand"), p.max_gap, order, p.block).drop("n", "first_s")
    return out.withColumn("run_density", F.lit(float(p.density_multiplier)) * F.col("tag_count") / length())


def check_protos(protos: DataFrame) -> DataFrame:
    """The same rows; a row that ends before it starts or has no tags raises."""
    wrong = (F.col("e") <= F.col("s")) | (F.col("tag_count") <= 0)
    return protos.withColumn("e", F.when(wrong, F.raise_error("transcript without length or tags").cast("long")).otherwise(F.col("e")))


def stitch_rows(protos: DataFrame, p: Parameters) -> DataFrame:
    """Proto-transcripts of all runs, each with the number of the cluster that it joins on its strand."""
    return cluster_rows(protos, ("chr", "strand"), 0, ("s", "e", "run_id"), p.block)


def stitched_transcripts(rows: DataFrame) -> DataFrame:
    """(id, chr, strand, s, e, refseq, n, cluster) of numbered rows. A cluster of one keeps its own start, also where the rule would clip it."""
    found = clusters_of(rows, ("chr", "strand"))
    found = found.withColumn("id", place_id("e")).withColumn("s", F.when(F.col("n") == 1, F.col("first_s")).otherwise(F.col("s")))
    return found.select("id", "chr", "strand", "s", "e", "refseq", "n", "cluster")


def lineage(rows: DataFrame, stitched: DataFrame) -> DataFrame:
    """(id, chr, strand, run_id, s, e): the proto-transcripts of each stitched one, row by row, however many there are."""
    ids = stitched.select("id", "chr", "strand", "cluster")
    return rows.join(ids, ["chr", "strand", "cluster"]).select("id", "chr", "strand", "run_id", "s", "e")


def source_rows(rows: DataFrame, stitched: DataFrame) -> DataFrame:
    """Tags and gaps of stitched transcripts by run. Sums come before the join, so only one row for each run and cluster meets its id."""
    keys = ["chr", "strand", "cluster"]
    sums = rows.groupBy(*keys, "run_id").agg(F.sum("tag_count").alias("tag_count"), F.sum("gaps").alias("gaps"))
    return sums.join(stitched.select("id", *keys), keys).select("id", "chr", "run_id", "tag_count", "gaps")


def stitch(protos: DataFrame, p: Parameters) -> tuple[DataFrame, DataFrame]:
    """Proto-transcripts of all runs merged; and their source rows by run."""
    rows = stitch_rows(protos, p)
    stitched = stitched_transcripts(rows)
    return stitched, source_rows(rows, stitched)


def set_density(stitched: DataFrame, sources: DataFrame, p: Parameters, null_only: bool = False) -> DataFrame:
    """density: tags by run and length. With null_only, a density that is there already stays."""
    sums = sources.groupBy("id").agg(F.sum("tag_count").alias("_tags"), F.count("run_id").alias("_runs"))
    density = F.greatest(F.lit(0.0), F.lit(float(p.density_multiplier)) * F.col("_tags") / (F.col("_runs") * length()))
    if null_only:
        density = F.coalesce(F.col("density"), density)
    return stitched.join(sums, "id").withColumn("density", density).drop("_tags", "_runs")


def sparse_edge(p: Parameters) -> Column:
    return F.lit(float(p.max_edge)) * F.least(F.col("density") / F.lit(float(p.edge_scaling_factor)), F.lit(1.0))


def reach_in(gene_s: Column, gene_e: Column, end: Column, p: Parameters) -> Column:
    """How far a transcript with its end in a gene may reach."""
    return F.least(gene_e - end + 1, (gene_e - gene_s + 1) * F.lit(float(p.extension_percent)))


def edge_of(reach: Column, p: Parameters) -> Column:
    """The edge, by the furthest reach in a gene; null outside genes."""
    return F.when(reach.isNotNull(), F.greatest(F.lit(float(p.max_edge)), reach)).otherwise(sparse_edge(p))


def allowed_edge(transcripts: DataFrame, genes: DataFrame, p: Parameters, extend: bool = True) -> DataFrame:
    """edge: how far a transcript reaches; further inside a gene, less where it is sparse."""
    if not extend:
        return transcripts.withColumn("edge", sparse_edge(p))
    ends = transcripts.select("id", "chr", "strand", F.col("e").alias("s"), "e")
    reach = reach_in(F.col("r.s"), F.col("r.e"), F.col("l.e"), p)
    inside = overlap_pairs(ends, genes.select("chr", "strand", "s", "e"), ("chr", "strand"), p.bin, split=p.split).groupBy(F.col("l.id").alias("id")).agg(F.max(reach).alias("_o"))
    return transcripts.join(inside, "id", "left").withColumn("edge", edge_of(F.col("_o"), p)).drop("_o")


def above_threshold(transcripts: DataFrame, sources: DataFrame, p: Parameters) -> DataFrame:
    means = sources.groupBy("id").agg(F.avg("tag_count").alias("a"), F.count("run_id").alias("c"))
    kept = means.where((F.col("a") > 1) & ((F.col("c") > 1) | (F.col("a") >= p.min_one_run_tags))).select("id")
    return transcripts.join(kept, "id", "left_semi")


def close_transcripts(prep: DataFrame, p: Parameters) -> DataFrame:
    """max_end: the furthest end among downstream transcripts within reach in length and density."""
    around = prep.select("id", "chr", "strand", "refseq", F.col("s").alias("from"), F.col("e").alias("x"), F.col("density").alias("y"), F.col("edge").alias("radius"))
    points = prep.select("chr", "strand", "refseq", F.col("s").alias("x"), F.col("e").alias("end"), F.col("density").alias("y"))
    near = circle_pairs(around, points, ("chr", "strand", "refseq"), condition=F.col("l.from") <= F.col("r.x"))
    found = near.groupBy(F.col("l.id").alias("id")).agg(F.max("r.end").alias("_far"))
    return prep.join(found, "id", "left").withColumn("max_end", F.greatest("_far", "e")).drop("_far")


def draw_edges(close: DataFrame, p: Parameters) -> DataFrame:
    """Transcripts within reach merged into final ones; the first row gives the flag, and flags keep none apart."""
    rows = close.select("chr", "strand", "s", F.col("max_end").alias("e"), "id", F.col("refseq").alias("own"), F.lit(False).alias("refseq"))
    rows = cluster_rows(rows, ("chr", "strand"), 0, ("s", "e", "id"), p.block)
    out = rows.groupBy("chr", "strand", "cluster").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.max(F.when(F.col("opens"), F.col("own"))).alias("refseq"))
    return out.drop("cluster").withColumn("id", place_id("s"))


def final_sources(final: DataFrame, prep: DataFrame, sources: DataFrame, p: Parameters) -> DataFrame:
    """Tags and gaps of final transcripts by run, from all prep rows they contain."""
    cols = ["id", "chr", "strand", "s", "e"]
    within = overlap_pairs(final.select(*cols), prep.select(*cols), ("chr", "strand"), p.bin, contains("l", "r"), p.split).select(F.col("l.id").alias("final_id"), F.col("r.id").alias("id"))
    return within.join(sources.drop("chr"), "id").groupBy(F.col("final_id").alias("id"), "run_id").agg(F.sum("tag_count").alias("tag_count"), (F.count("*") - 1).alias("gaps"))


def annotate(final: DataFrame, regions: DataFrame, p: Parameters) -> DataFrame:
    """(transcript_id, region_id, relationship, major) of overlaps; regions without a strand fit both."""
    cols = ["id", "chr", "strand", "s", "e"]
    fits = F.col("r.strand").isNull() | (F.col("l.strand") == F.col("r.strand"))
    relation = (
        F.when((F.col("l.s") == F.col("r.s")) & (F.col("l.e") == F.col("r.e")), "is equal to")
        .when(contains("l", "r"), "contains")
        .when(contains("r", "l"), "is contained by")
        .otherwise("overlaps with")
    )
    shared = F.least("l.e", "r.e") - F.greatest("l.s", "r.s") + 1
    pairs = overlap_pairs(final.select(*cols), regions.select(*cols), ("chr",), p.bin, fits, p.split)
    return pairs.select(F.col("l.id").alias("transcript_id"), F.col("r.id").alias("region_id"), relation.alias("relationship"), (shared * 2 > F.col("r.e") - F.col("r.s") + 1).alias("major"))


def distal_flag(final: DataFrame, genes: DataFrame, p: Parameters) -> DataFrame:
    wide = genes.select("chr", (F.col("s") - p.gene_margin).alias("s"), (F.col("e") + p.gene_margin).alias("e"))
    met = overlap_pairs(final.select("id", "chr", "s", "e"), wide, ("chr",), p.bin, split=p.split).select(F.col("l.id").alias("id")).distinct()
    return final.join(met.withColumn("_met", F.lit(True)), "id", "left").withColumn("distal", F.col("_met").isNull()).drop("_met")


def link_post_gene(final: DataFrame, p: Parameters) -> DataFrame:
    """parent_id: the nearest gene transcript that a transcript follows; the lowest id of equals."""
    d = p.post_gene_distance
    genes = final.where("refseq").select("id", "chr", "strand", F.when(F.col("strand") == 0, F.col("e")).otherwise(F.col("s") - d).alias("s"), F.when(F.col("strand") == 0, F.col("e") + d - 1).otherwise(F.col("s") - 1).alias("e"), F.col("s").alias("gs"), F.col("e").alias("ge"))
    rest = final.where("not refseq").select("id", "chr", "strand", "s", "e")
    gap = F.when(F.col("l.strand") == 0, F.col("l.s") - F.col("r.ge")).otherwise(F.col("r.gs") - F.col("l.e"))
    found = overlap_pairs(rest, genes, ("chr", "strand"), p.bin, split=p.split).groupBy(F.col("l.id").alias("id")).agg(F.min(F.struct(gap.alias("gap"), F.col("r.id").alias("parent"))).alias("_m"))
    return final.join(found, "id", "left").withColumn("parent_id", F.col("_m.parent")).drop("_m")


def moments(final: DataFrame, sources: DataFrame, runs: DataFrame) -> DataFrame:
    """final with what its scores are made of, whatever runs come later: tags, and sum (a) and sum of squares (b) of its tags by ten million of each run.

    Absent runs count as zero, so they are never made rows. The three add up over runs.
    """
    x = F.coalesce(F.col("tag_count") / F.col("total_tags") * 1e7, F.lit(0.0))
    known = sources.join(runs.select(F.col("id").alias("run_id"), "total_tags"), "run_id", "left")
    return final.join(known.groupBy("id").agg(F.sum("tag_count").alias("tags"), F.sum(x).alias("a"), F.sum(x * x).alias("b")), "id", "left")


def run_count(runs: DataFrame, p: Parameters) -> DataFrame:
    """One row: n_runs, the number of runs that a mean goes over."""
    return (runs if p.count_pseudo_run else runs.where("total_tags is not null")).agg(F.count("*").alias("n_runs"))


def scored(facts: DataFrame, totals: DataFrame) -> DataFrame:
    """rpkm over all prep tags, length-weighted score, and standard error of the mean over runs, from the moments and one row of totals (total_tags, n_runs)."""
    out = facts.crossJoin(F.broadcast(totals))
    rpkm = F.col("tags") / (length() / 1000.0) / (F.col("total_tags") / F.lit(1e6))
    out = out.withColumn("rpkm", rpkm)
    out = out.withColumn("score", F.col("rpkm") * F.log(F.greatest(F.lit(1.0), (length() - 200).cast("double"))) / F.log(F.lit(100.0)))
    n, a, b = F.col("n_runs"), F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    variance = F.greatest(F.lit(0.0), (b - a * a / n) / (n - 1))
    error = F.when(n > 1, F.sqrt(variance) / F.sqrt(n)).otherwise(F.lit(0.0))
    return out.withColumn("standard_error", error).drop("tags", "a", "b", "total_tags", "n_runs")
