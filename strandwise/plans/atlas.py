"""The whole way from tags and annotation to a scored atlas."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import strands as S
from ..operators import transcripts as T
from ..operators.segments import fits
from ..operators.transcripts import Parameters
from ..sources.shared import stored


@dataclass
class Atlas:
    """Output tables and the steps on the way. ``facts`` are final transcripts with what their scores are made of, ``transcripts`` have the scores."""

    prep: DataFrame
    prep_sources: DataFrame
    above: DataFrame
    close: DataFrame
    facts: DataFrame
    transcripts: DataFrame
    sources: DataFrame
    genes: DataFrame
    noncoding: DataFrame


def finish_prep(stitched: DataFrame, sources: DataFrame, genes: DataFrame, p: Parameters) -> DataFrame:
    """Stitched transcripts with density and edge."""
    return T.allowed_edge(T.set_density(stitched.drop("cluster"), sources, p), genes, p)


def build_prep(tags: DataFrame, genes: DataFrame, p: Parameters, chromosomes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Stitched transcripts with density and edge, and their source rows. Tables that several steps read are written once."""
    flagged = T.flag_refseq(T.collapse_tags(tags), genes, p.bin, p.split)
    rows = T.stitch_rows(T.proto_transcripts(flagged, p, chromosomes), p)
    stitched = stored(T.stitched_transcripts(rows), "stitched")
    sources = stored(T.source_rows(rows, stitched), "prep-sources")
    return stored(finish_prep(stitched, sources, genes, p), "prep"), sources


def build_final(prep: DataFrame, prep_sources: DataFrame, genes: DataFrame, noncoding: DataFrame, runs: DataFrame, p: Parameters) -> Atlas:
    above = T.above_threshold(prep, prep_sources, p)
    close = T.close_transcripts(above, p)
    drawn = stored(T.draw_edges(close, p), "drawn")
    sources = stored(T.final_sources(drawn, prep, prep_sources, p), "sources")
    final = T.link_post_gene(T.distal_flag(drawn, genes, p), p)
    facts = stored(T.moments(final, sources, runs), "facts")
    totals = prep_sources.agg(F.sum("tag_count").alias("total_tags")).crossJoin(T.run_count(runs, p))
    return Atlas(prep, prep_sources, above, close, facts, T.scored(facts, totals), sources, T.annotate(final, genes, p), T.annotate(final, noncoding, p))


def build_by_strand(tags: DataFrame, genes: DataFrame, noncoding: DataFrame, runs: DataFrame, p: Parameters, chromosomes: DataFrame | None = None) -> Atlas:
    """The atlas where every strand fits a task. Edges come after the threshold, so those of all prep transcripts are made for who asks for them."""
    p = replace(p, block=None)
    protos = T.proto_transcripts(S.flagged_tags(tags, genes), p, chromosomes)
    kept = stored(S.stitched_with_runs(protos, p), "stitched")
    above = S.allowed_edge(S.above_threshold(kept, p), genes, p)
    close = S.close_transcripts(above)
    final = S.final_with_runs(T.draw_edges(close, p), kept, runs, p)
    facts = stored(S.distal_flag(final, genes, p), "facts")
    totals = kept.agg(F.sum("_tags").alias("total_tags")).crossJoin(T.run_count(runs, p))
    prep, known = T.allowed_edge(kept.drop("_tags", "runs"), genes, p), facts.drop("runs")
    sources = S.source_rows(facts).drop("chr")
    return Atlas(prep, S.source_rows(kept), above, close, known, T.scored(known, totals), sources, T.annotate(known, genes, p), T.annotate(known, noncoding, p))


def build_atlas(tags: DataFrame, genes: DataFrame, noncoding: DataFrame, runs: DataFrame, p: Parameters | None = None, chromosomes: DataFrame | None = None) -> Atlas:
    """Prep and final tables; where p extends tags, chromosomes (id, name, length) are needed."""
    p = p or Parameters()
    if fits((tags, genes), S.STRAND):
        return build_by_strand(tags, genes, noncoding, runs, p, chromosomes)
    return build_final(*build_prep(tags, genes, p, chromosomes), genes, noncoding, runs, p)
