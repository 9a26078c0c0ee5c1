"""The steps from tags to final transcripts where every strand fits a task.

Genomes in many pieces have many strands of few rows. Where none has over ``segments.WHOLE`` rows, rows are dealt by
strand once and all windows and sums of a step run there, without stretches and what they carry. Overlaps whose
answer is one value are as-of look-ups in a sorted union of both sides. Results equal those of ``transcripts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import length, place_id
from .joins import bins_of, circle_class, interval_class, largest_radius, size_of
from .segments import cluster_rows
from .transcripts import Parameters, collapse_tags, edge_of, reach_in

STRAND = ["chr", "strand"]


def _up_to(keys, *order) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _beside(rows: DataFrame, regions: DataFrame, keys, start: Column, end: Column) -> DataFrame:
    """rows by their ends (_kind 1) and regions by their starts (_kind 0), which have no null key, as one table dealt by the keys."""
    proper = regions.where(start <= end).select(*[F.col(k).try_cast(rows.schema[k].dataType).alias(k) for k in keys], start.alias("_at"), F.lit(0).alias("_kind"), end.alias("_end"))
    rows = rows.select("*", F.col("e").alias("_at"), F.lit(1).alias("_kind"))
    return rows.unionByName(proper.dropna(subset=list(keys)), allowMissingColumns=True).repartition(*keys)


def _met(keys) -> Column:
    """Whether a row of ``_beside`` overlaps a region: of those that start by its end, the furthest end is not before its start."""
    return F.coalesce((F.col("s") <= F.col("e")) & (F.max("_end").over(_up_to(keys, "_at", "_kind")) >= F.col("s")), F.lit(False))


def flagged_tags(tags: DataFrame, genes: DataFrame) -> DataFrame:
    """Identical tags as one row with their number, and whether a gene of the strand overlaps."""
    rows = _beside(tags.select("run_id", *STRAND, "s", "e"), genes, STRAND, F.col("s"), F.col("e"))
    return collapse_tags(rows.withColumn("refseq", _met(STRAND)).where("_kind = 1"))


def stitched_with_runs(protos: DataFrame, p: Parameters) -> DataFrame:
    """Stitched transcripts with density, tags (_tags) and ``runs``, their (run_id, tag_count, gaps) by run."""
    rows = cluster_rows(protos, STRAND, 0, ("s", "e", "run_id"))
    clipped = F.greatest(F.coalesce(F.col("reached") + 1, F.col("s")), F.col("s"))
    by_run = rows.groupBy(*STRAND, "cluster", "run_id").agg(
        F.max(F.when(F.col("opens"), clipped)).alias("s"), F.max("e").alias("e"), F.max(F.when(F.col("opens"), F.col("refseq"))).alias("refseq"),
        F.count("*").alias("n"), F.min("s").alias("first_s"), F.sum("tag_count").alias("tag_count"), F.sum("gaps").alias("gaps"),
    )
    found = by_run.groupBy(*STRAND, "cluster").agg(
        F.max("s").alias("s"), F.max("e").alias("e"), F.max("refseq").alias("refseq"), F.sum("n").alias("n"), F.min("first_s").alias("first_s"),
        F.sum("tag_count").alias("_tags"), F.count("run_id").alias("_runs"), F.collect_list(F.struct("run_id", "tag_count", "gaps")).alias("runs"),
    )
    found = found.withColumns({"id": place_id("e"), "s": F.when(F.col("n") == 1, F.col("first_s")).otherwise(F.col("s"))})
    density = F.greatest(F.lit(0.0), F.lit(float(p.density_multiplier)) * F.col("_tags") / (F.col("_runs") * length()))
    return found.select("id", *STRAND, "s", "e", "refseq", "n", density.alias("density"), "_tags", "runs")


def source_rows(kept: DataFrame) -> DataFrame:
    """(id, chr, run_id, tag_count, gaps) of a table with runs."""
    return kept.select("id", "chr", F.explode("runs").alias("_r")).select("id", "chr", "_r.*")


def above_threshold(kept: DataFrame, p: Parameters) -> DataFrame:
    mean, runs = F.col("_tags") / F.size("runs"), F.size(F.filter("runs", lambda r: r.run_id.isNotNull()))
    return kept.where((mean > 1) & ((runs > 1) | (mean >= p.min_one_run_tags))).drop("_tags", "runs")


def _dealt_beside(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """rows and, as _gene (s, e), the proper regions of known strands, as one table that windows over strands deal once."""
    proper = regions.where("s <= e").select(*[F.col(k).try_cast(rows.schema[k].dataType).alias(k) for k in STRAND], F.struct(F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e")).alias("_gene"))
    return rows.unionByName(proper.dropna(subset=STRAND), allowMissingColumns=True)


def _as_before(rows: DataFrame, columns, name: str) -> DataFrame:
    """One row for each id again, with the largest ``name`` of its rows."""
    return rows.groupBy(*STRAND, "id").agg(*[F.max(c).alias(c) for c in columns if c not in (*STRAND, "id")], F.max(name).alias(name))


def allowed_edge(transcripts: DataFrame, genes: DataFrame, p: Parameters) -> DataFrame:
    """transcripts with the edge of ``transcripts.allowed_edge``. Ends and genes meet in the bins of their strand, as they are dealt by it, without a join."""
    rows = _dealt_beside(transcripts, genes)
    level = interval_class(p.bin, F.col("_gene.s"), F.col("_gene.e"))
    rows = rows.withColumn("_levels", F.collect_set(F.when(F.col("_gene").isNotNull(), level)).over(Window.partitionBy(*STRAND)))
    at = F.when(F.col("_gene").isNotNull(), F.array(level)).otherwise(F.col("_levels"))
    rows = rows.withColumn("_at", F.explode_outer(at)).drop("_levels")
    size = size_of(F.col("_at"), p.bin)
    rows = rows.withColumn("_bin", F.explode_outer(bins_of(F.coalesce("_gene.s", "e"), F.coalesce("_gene.e", "e"), size)))
    inside = F.collect_list("_gene").over(Window.partitionBy(*STRAND, "_at", "_bin"))
    rows = rows.withColumn("_genes", inside).where("_gene is null")
    here = F.filter("_genes", lambda g: (g.s <= F.col("e")) & (F.col("e") <= g.e))
    rows = rows.withColumn("_reach", F.array_max(F.transform(here, lambda g: reach_in(g.s, g.e, F.col("e"), p))))
    return _as_before(rows, transcripts.columns, "_reach").withColumn("edge", edge_of(F.col("_reach"), p)).drop("_reach")


def squares(rows: DataFrame, least: float = 16.0) -> DataFrame:
    """rows of transcripts (_kind 0), with one for each square (_level, _cx, _cy) that its circle touches (1) and for each grid of its strand's circles (2), by its start.

    A grid has squares of twice its largest radius, so a circle touches four of them at most.
    """
    known = F.col("chr").isNotNull() & F.col("strand").isNotNull()
    radius, level = F.col("edge"), circle_class(F.col("edge"), least)
    side = lambda at: 2 * largest_radius(at, least)
    square = lambda kind, at, x, y: F.struct(F.lit(kind).alias("_kind"), at.alias("_level"), x.cast("long").alias("_cx"), y.cast("long").alias("_cy"))
    span = lambda low, high: F.sequence(F.floor(low / side(level)), F.floor(high / side(level)))
    columns, lines = span(F.greatest(F.col("s"), F.col("e") - radius), F.col("e") + radius), span(F.col("density") - radius, F.col("density") + radius)
    touched = F.flatten(F.transform(columns, lambda x: F.transform(lines, lambda y: square(1, level, x, y))))
    reached = F.transform("_levels", lambda at: square(2, at, F.floor(F.col("s") / side(at)), F.floor(F.col("density") / side(at))))
    none = F.lit(None)
    own = F.array(square(0, none.cast("int"), none, none))
    within = known & (F.col("s") <= F.col("e") + radius)
    parts = F.concat(own, F.when(within & (radius >= 0), F.coalesce(touched, F.array())).otherwise(F.array()), F.when(known, F.coalesce(reached, F.array())).otherwise(F.array()))
    rows = rows.withColumn("_levels", F.collect_set(F.when(radius >= 0, level)).over(Window.partitionBy(*STRAND)))
    return rows.withColumn("_square", F.explode(parts)).drop("_levels").select(*rows.columns[:-1], "_square.*")


def close_transcripts(above: DataFrame) -> DataFrame:
    """above with max_end. Circles and starts meet in the squares of their strand, as they are dealt by it, without a join."""
    starts = F.collect_list(F.when(F.col("_kind") == 2, F.struct(F.col("s").alias("x"), F.col("e").alias("end"), F.col("density").alias("y"))))
    rows = squares(above).withColumn("_starts", starts.over(Window.partitionBy(*STRAND, "refseq", "_level", "_cx", "_cy"))).where("_kind < 2")

    def near(r):
        dx, dy = r.x - F.col("e"), r.y - F.col("density")
        return (F.col("s") <= r.x) & (r.end > F.col("e")) & (dx * dx + dy * dy <= F.col("edge") * F.col("edge"))

    far = F.when(F.col("_kind") == 1, F.array_max(F.transform(F.filter("_starts", near), lambda r: r.end))).otherwise(F.col("e"))
    return _as_before(rows.withColumn("max_end", far).where("max_end is not null"), above.columns, "max_end")


def final_with_runs(drawn: DataFrame, kept: DataFrame, runs: DataFrame, p: Parameters) -> DataFrame:
    """Final transcripts, which share no position, with parent_id, the moments of ``transcripts.moments`` and ``runs``, from all kept rows that they contain.

    What may contain a row is the last final transcript that starts by its start, and what one may follow is the nearest gene transcript on one side.
    """
    rows = drawn.select(*STRAND, "s", F.lit(0).alias("_kind"), F.struct("id", "s", "e", "refseq").alias("_final"))
    rows = rows.unionByName(kept.where("s <= e").select(*STRAND, "s", "e", "runs", F.lit(1).alias("_kind")), allowMissingColumns=True).repartition(*STRAND)
    rows = rows.withColumn("_final", F.last("_final", ignorenulls=True).over(_up_to(STRAND, "s", "_kind"))).where("_kind = 1 and e <= _final.e")
    rows = rows.select(*STRAND, "_final.id", "_final.s", "_final.e", "_final.refseq", F.explode("runs").alias("_r"))
    own = [*STRAND, "id", "s", "e", "refseq"]
    sums = rows.groupBy(*own, F.col("_r.run_id").alias("run_id")).agg(F.sum("_r.tag_count").alias("tag_count"), (F.count("*") - 1).alias("gaps"))
    sums = sums.join(F.broadcast(runs.select(F.col("id").alias("run_id"), "total_tags")), "run_id", "left")
    x = F.coalesce(F.col("tag_count") / F.col("total_tags") * 1e7, F.lit(0.0))
    out = sums.groupBy(*own).agg(F.sum("tag_count").alias("tags"), F.sum(x).alias("a"), F.sum(x * x).alias("b"), F.collect_list(F.struct("run_id", "tag_count", "gaps")).alias("runs"))
    gene = F.when(F.col("refseq"), F.struct("id", "s", "e"))
    w = Window.partitionBy(*STRAND).orderBy("s")
    out = out.withColumn("_before", F.last(gene, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    out = out.withColumn("_after", F.first(gene, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    d = p.post_gene_distance
    follows = F.when(F.col("strand") == 0, F.when(F.col("s") < F.col("_before.e") + d, F.col("_before.id"))).otherwise(F.when(F.col("e") >= F.col("_after.s") - d, F.col("_after.id")))
    known = F.col("chr").isNotNull() & F.col("strand").isNotNull() & ~F.col("refseq")
    return out.withColumn("parent_id", F.when(known, follows)).drop("_before", "_after")


def distal_flag(final: DataFrame, genes: DataFrame, p: Parameters) -> DataFrame:
    """distal: no gene of either strand within the margin. Rows are dealt by chromosome."""
    rows = _beside(final, genes, ["chr"], F.col("s") - p.gene_margin, F.col("e") + p.gene_margin)
    return rows.withColumn("distal", ~_met(["chr"])).where("_kind = 1").drop("_at", "_kind", "_end")
