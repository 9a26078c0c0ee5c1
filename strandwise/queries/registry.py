"""All registered queries of the interval library, and their SQL."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..operators import annotation as N
from ..operators import evaluation as E
from ..operators import strands as S
from ..operators import transcripts as T
from ..operators.analysis import Analysis, bed_rows, write_bed
from ..operators.segments import fits
from ..plans.store import AtlasStore, add_runs, rebuild_final, save_atlas
from ..plans.views import open_store, open_views
from ..sources import readers
from ..sources.shared import scratch, stored, stored_text
from .fixtures import PARAMETERS as P
from .fixtures import VIEWS, atlas, kept_atlas, view
from .templates import TEMPLATES

RUN1, RUN2 = "run_1", "run_2"


def _analysis(spark, d) -> Analysis:
    a = kept_atlas(spark, d)
    return Analysis(a.transcripts, a.sources, lambda: a.genes, lambda: a.noncoding, view(spark, d, "gene_region"), view(spark, d, "run"), P.min_score, P.gene_margin, P.bin)


#: Where the views of the registered queries do not take the names of a user's.
VIEW_PREFIX = "atlas_"


def _sql(spark, text, **given):
    """A template over the views of VIEW_PREFIX, with the parameters that it names."""
    names = "|".join(["transcript(?:_source|_gene|_noncoding|_cell)?", "(?:gene|noncoding)_region(?:_cell)?", "gene_site_cell", "run", "peak"])
    text = re.sub(rf"\b(FROM|JOIN) ({names})\b", rf"\1 {VIEW_PREFIX}\2", text)
    return spark.sql(text, args={k: v for k, v in given.items() if f":{k}" in text})


def _templated(name, pad=0):
    """A template as SQL over those views of the kept atlas that it names."""

    def run(spark, d):
        a = kept_atlas(spark, d)
        own = {"transcript": "transcripts", "transcript_source": "sources", "transcript_gene": "genes", "transcript_noncoding": "noncoding"}
        given = {"gene_region": "gene_region", "noncoding_region": "noncoding", "run": "run", "peak": "peak"}
        text = TEMPLATES[name].replace("gene_site_cell", "gene_region")
        longest = view(spark, d, "chromosome").agg(F.max("length")).first()[0]
        named = lambda k: re.search(rf"\b{k}(_cell)?\b", text)
        open_views({k: getattr(a, v) for k, v in own.items() if named(k)} | {k: view(spark, d, v) for k, v in given.items() if named(k)}, VIEW_PREFIX, P.gene_margin, longest)
        return _sql(spark, TEMPLATES[name], min_score=P.min_score, run1=RUN1, run2=RUN2, pad=pad)

    return run


def _stored_sql(spark, d):
    """A template over the stricter of two stored final sets; rows of runs come from the state."""
    store = _rebuilt(spark, d)
    open_store(store, view(spark, d, "gene_region"), view(spark, d, "noncoding"), key="strict", prefix=VIEW_PREFIX, margin=P.gene_margin)
    return _sql(spark, TEMPLATES["expressed_genes"], min_score=P.min_score)


def _round(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def _flagged(spark, d):
    return T.flag_refseq(T.collapse_tags(view(spark, d, "tag")), view(spark, d, "gene_region"), P.bin)


def _by_strand(spark, d):
    """Whether every strand fits a task."""
    return fits((view(spark, d, "tag"), view(spark, d, "gene_region")), S.STRAND)


def _protos(spark, d):
    if _by_strand(spark, d):
        return T.proto_transcripts(S.flagged_tags(view(spark, d, "tag"), view(spark, d, "gene_region")), replace(P, block=None))
    return T.proto_transcripts(_flagged(spark, d), P)


def _stitch_rows(spark, d):
    return T.stitch_rows(_protos(spark, d), P)


def _stitched(spark, d):
    if _by_strand(spark, d):
        kept = stored(S.stitched_with_runs(_protos(spark, d), P), "stitched")
        return kept.drop("density", "_tags", "runs"), S.source_rows(kept)
    rows = _stitch_rows(spark, d)
    stitched = T.stitched_transcripts(rows)
    return stitched, T.source_rows(rows, stitched)


def _lineage(spark, d):
    rows = _stitch_rows(spark, d)
    return T.lineage(rows, T.stitched_transcripts(rows))


def _density(spark, d):
    if _by_strand(spark, d):
        return S.stitched_with_runs(_protos(spark, d), P).drop("_tags", "runs")
    return T.set_density(*_stitched(spark, d), P)


def _density_of_null_only(spark, d):
    stitched, sources = _stitched(spark, d)
    return T.set_density(stitched.withColumn("density", F.when(F.col("n") == 1, 0.5)), sources, P, null_only=True)


FINAL = ["id", "chr", "strand", "s", "e", "refseq"]


NAME = "concat('chr', chr - 1)"
SIGN = "if(strand = 1, '-', '+')"
SEQ = "repeat('A', CAST(e - s AS INT))"
#: Lines of text formats, from the interval tables; a tag's sequence is as long as the tag. Flags are those of unmapped,
#: secondary and supplementary reads beside plain ones, some lines are short and some are headers.
LINES = {
    "sam": ("tag", f"""CASE WHEN s % 97 = 0 THEN concat('@CO\t', s) WHEN s % 11 = 0 THEN concat_ws('\t', 'q', 0, {NAME}) ELSE concat_ws('\t', 'q',
        strand * 16 + CASE s % 7 WHEN 0 THEN 4 WHEN 1 THEN 256 WHEN 2 THEN 2048 ELSE 0 END, {NAME}, s + 1, s % 40, '*', '*', 0, 0, {SEQ}, '*') END"""),
    "bowtie": ("tag", f"concat_ws('\t', 'q', {SIGN}, {NAME}, s, {SEQ}, '*')"),
    "tags": ("tag", f"concat_ws('\t', {SIGN}, {NAME}, s, {SEQ})"),
    "chrominfo": ("chromosome", "concat_ws('\t', if(id % 9 = 0, concat(name, '_random'), name), length - 1, 'path')"),
    "refgene": ("gene_region", f"concat_ws('\t', id, identifier, {NAME}, {SIGN}, s, e)"),
    "bed": ("gene_region", f"concat_ws('\t', {NAME}, s, e, identifier, 0, {SIGN})"),
    "bed_rna": ("noncoding", f"if(id % 3 = 0, null, concat_ws('\t', {NAME}, s, e, concat('FR', id), 0, {SIGN}))"),
    "summary": ("noncoding", """concat('"FR', id, '",a,"', description, ', note",', type, ',', if(id % 4 = 0, 'Homo sapiens', 'Mus musculus (mouse)'), ',src', id % 5, ',9')"""),
    "macs": ("peak", f"concat_ws('\t', {NAME}, s, e, e - s, s + 100, id % 1000, id % 70, id % 30)"),
    "sicer": ("peak", f"concat_ws('\t', {NAME}, s, e, id % 1000, id % 9, concat('1.5e-', id % 50), id % 30, '0.25')"),
    "bed_peaks": ("peak", f"concat_ws('\t', {NAME}, s, e, id, id % 1000)"),
    "homer": ("peak", f"concat_ws('\t', concat('p', id), {NAME}, s, e, if(id % 2 = 0, '+', '-'), id % 1000, 0.5, id % 90, concat('2.5e-', id % 40), id % 30)"),
}
HEADS = {
    "summary": "ID,acc,Description,SO name,Organism,Xref,Length",
    "bed": "chrom\tstart\tend\tname\tscore\tstrand",
    "homer": "#PeakID\tchr\tstart\tend\tstrand\tNormalized Tag Count\tfocus ratio\tfindPeaks Score\tp-value vs Local\tFold Change vs Local",
}


def _text(spark, d, name):
    source, line = LINES[name]
    lines = view(spark, d, source)
    if name == "chrominfo":  # one file, as ids go by its order
        lines = lines.orderBy("id").coalesce(1)
    lines = lines.select(F.expr(line).alias("value")).where("value is not null")
    if name in HEADS and name != "bed":
        lines = lines.unionByName(spark.createDataFrame([(HEADS[name],)], lines.schema))
    return stored_text(lines, name)


def _intervals(spark, d):
    """Intervals of a file with a header line."""
    source, line = LINES["bed"]
    lines = view(spark, d, source).select(F.expr(line).alias("value"))
    return readers.read_intervals(spark, stored_text(lines.unionByName(spark.createDataFrame([(HEADS["bed"],)], lines.schema)), "intervals"))


def _rna(spark, d):
    regions, summary = readers.read_bed_regions(spark, _text(spark, d, "bed_rna")), readers.read_ncrna_summary(spark, _text(spark, d, "summary"), "Mus musculus")
    return regions, summary, N.noncoding_rna(summary, regions)


def _rna_regions(spark, d):
    return N.noncoding_regions(*_rna(spark, d), view(spark, d, "chromosome"))


def _gene_regions(spark, d):
    genes = readers.read_refgene(spark, _text(spark, d, "refgene"))
    return N.gene_regions(genes, N.sequence_identifiers(genes), view(spark, d, "chromosome"), P.gene_margin)


#: Thresholds of a second final set over the prep tables of the first.
STRICTER = replace(P, min_one_run_tags=5)


def _saved(spark, d):
    store = AtlasStore(spark, scratch(spark, "atlas"))
    save_atlas(store, atlas(spark, d), view(spark, d, "run"), P)
    return store


def _rebuilt(spark, d):
    """A stricter final set beside the first."""
    store = _saved(spark, d)
    rebuild_final(store, *(view(spark, d, x) for x in ("gene_region", "noncoding")), STRICTER, "strict")
    return store


def _kept_sets(spark, d):
    plain = lambda key: store.transcripts(key).select("chr", "strand", "s", "e")
    store = _rebuilt(spark, d)
    return E.compare_sets(plain("final"), plain("strict"), P.block)


def _grown(spark, d):
    """Two runs first, then the third, and that once more, as after a lost answer."""
    store, flagged = AtlasStore(spark, scratch(spark, "atlas")), stored(_flagged(spark, d), "flagged")
    for runs in ("run_id < 3", "run_id = 3", "run_id = 3"):
        add_runs(store, flagged.where(runs), P, view(spark, d, "gene_region"), view(spark, d, "noncoding"))
    return store


def _track(spark, d):
    path = scratch(spark, "track")
    write_bed(kept_atlas(spark, d).transcripts, view(spark, d, "chromosome"), path, "transcripts", P.min_score)
    return spark.read.text(path).select(F.col("strand").cast("int").alias("strand"), F.col("value").alias("line"))


def _tags4(spark, d, flip=False):
    return T.normalize_tags(readers.read_tags4(spark, _text(spark, d, "tags")), view(spark, d, "chromosome"), flip)


def _peaks(read, name, *numbers):
    def run(spark, d):
        found = read(spark, _text(spark, d, name), view(spark, d, "chromosome"))
        return found.withColumns({n: F.col(n).cast("double") for n in numbers})

    return run


#: Least numbers of tags by which the evaluation queries draw candidate sets from proto-transcripts.
LEAST_TAGS = [1, 2, 3]


def _evaluated(f):
    """f of reference genes and of the final transcripts."""

    def run(spark, d):
        plain = lambda df: df.select("chr", "strand", "s", "e")
        return f(plain(view(spark, d, "gene_region")), plain(kept_atlas(spark, d).transcripts))

    return run


def _matrix(spark, d):
    sets = _protos(spark, d).withColumn("least", F.explode(F.array(*map(F.lit, LEAST_TAGS)))).where("tag_count >= least")
    return E.grid_error_matrix(view(spark, d, "gene_region"), sets, "run_id", "least", LEAST_TAGS, P.block)


def _error_matrix(spark, d):
    return _matrix(spark, d).select("run_id", *[F.round(F.col(str(x)), 6).alias(f"error_{x}") for x in LEAST_TAGS])


def _files_matrix(spark, d):
    """Candidate sets as folders of BED lines by run and least number of tags; those of run 2 with 3 tags, and all of run 4, are not there."""
    root = scratch(spark, "calls")
    sets = _protos(spark, d).withColumn("least", F.explode(F.array(*map(F.lit, LEAST_TAGS)))).where("tag_count >= least and not (run_id = 2 and least = 3)")
    line = F.concat_ws("\t", F.expr(NAME), "s", "e", F.lit("."), F.lit("."), F.expr(SIGN))
    sets.select("run_id", "least", line.alias("value")).write.partitionBy("run_id", "least").text(root)
    found, expected = readers.read_interval_sets(spark, f"{root}/run_id={{run_id}}/least={{least}}", {"run_id": [1, 2, 3, 4], "least": LEAST_TAGS})
    reference = view(spark, d, "gene_region").withColumn("chr", F.expr(NAME))
    matrix = E.grid_error_matrix(reference, E.normalize_intervals(found, ["run_id", "least"]), "run_id", "least", LEAST_TAGS, P.block, expected)
    return matrix.select("run_id", *[F.round(F.col(str(x)), 6).alias(f"error_{x}") for x in LEAST_TAGS])


def _by_suffix(spark, d):
    """The same tags in files of three formats, told by their suffixes."""
    found = None
    for kind, suffix in (("sam", "sam"), ("bowtie", "bowtie"), ("tags", "txt")):
        path = f"{scratch(spark, kind)}.{suffix}"
        source, line = LINES[kind]
        view(spark, d, source).select(F.expr(line).alias("value")).where("value is not null").write.text(path)
        one = readers.read_tags(spark, path).groupBy("strand_char", "chromosome").agg(F.count("*").alias("n"), F.sum("start").alias("starts")).withColumn("kind", F.lit(kind))
        found = one if found is None else found.unionByName(one)
    return found


def _line_counts(spark, d):
    """Lines of four formats and those left out, by reason, each from the scan that writes the rows."""
    named = {
        "sam": lambda c: readers.read_sam(spark, _text(spark, d, "sam"), counts=c),
        "summary": lambda c: readers.read_ncrna_summary(spark, _text(spark, d, "summary"), "Mus musculus", counts=c),
        "chrominfo": lambda c: readers.read_chromosomes(spark, _text(spark, d, "chrominfo"), counts=c),
        "macs": lambda c: readers.read_macs(spark, _text(spark, d, "macs"), view(spark, d, "chromosome").where("id % 3 <> 0"), counts=c),
    }
    rows = []
    for kind, read in named.items():
        counts = Observation()
        read(counts).write.format("noop").mode("overwrite").save()
        rows += [(kind, reason, n) for reason, n in counts.get.items()]
    return spark.createDataFrame(rows, "kind string, reason string, n long")


def queries() -> dict:
    def tags(f):
        return lambda spark, d: f(view(spark, d, "tag"), spark, d)

    def on(f):
        return lambda spark, d: f(kept_atlas(spark, d))

    def q(name, *args, rounded=(), **kw):
        return lambda spark, d: _round(getattr(_analysis(spark, d), name)(*args, **kw), *rounded)

    def peak(**kw):
        return lambda spark, d: _analysis(spark, d).distal_peak(view(spark, d, "peak"), **kw)

    def whole(t):
        return _round(t, "rpkm", "score", "standard_error").select(*FINAL, "distal", "parent_id", "rpkm", "score", "standard_error")

    proto = ["run_id", "chr", "strand", "s", "e", "refseq", "tag_count", "gaps"]
    gapped = replace(P, max_gap=5, block=500)
    return {
        "run_registry": tags(lambda t, *_: N.run_registry(t)),
        "collapse_tags": tags(lambda t, *_: T.collapse_tags(t)),
        "union_runs_distinct": tags(lambda t, *_: T.union_of_runs(t)),
        "extend_tags": tags(lambda t, spark, d: T.extend_tags(t, view(spark, d, "chromosome"), 200).select("run_id", "chr", "strand", "s", "e")),
        "segment_in_range": tags(lambda t, *_: T.in_range(t, 1000, 3000, 1)),
        "flag_refseq": _flagged,
        "proto_transcripts": lambda spark, d: _protos(spark, d).select(*proto),
        "proto_transcripts_gap": lambda spark, d: T.check_protos(T.proto_transcripts(_flagged(spark, d), gapped)).select(*proto),
        "proto_transcripts_extended": lambda spark, d: T.proto_transcripts(_flagged(spark, d), replace(P, tag_extension=200), view(spark, d, "chromosome")).select(*proto),
        "proto_source": lambda spark, d: _round(_protos(spark, d), "run_density").select("run_id", "chr", "strand", "e", "tag_count", "run_density"),
        "stitch_transcripts": lambda spark, d: _stitched(spark, d)[0].select(*FINAL, "n"),
        "stitched_source": lambda spark, d: _stitched(spark, d)[1],
        "cluster_lineage": lambda spark, d: _lineage(spark, d).select("id", "run_id", "s", "e"),
        "incremental_stitch": lambda spark, d: _grown(spark, d).read("prep").select(*FINAL, "n"),
        "incremental_source": lambda spark, d: _grown(spark, d).read("prep_sources").select("id", "chr", "run_id", "tag_count", "gaps"),
        "incremental_atlas": lambda spark, d: whole(_grown(spark, d).transcripts()),
        "kept_sets": lambda spark, d: _round(_kept_sets(spark, d), "forward", "backward"),
        "stored_range": lambda spark, d: _round(_saved(spark, d).read_range("prep", 3, 1000, 3000), "density", "edge").select(*FINAL, "density", "edge"),
        "flag_refseq_split": lambda spark, d: T.flag_refseq(T.collapse_tags(view(spark, d, "tag")), view(spark, d, "gene_region"), 10, 20),
        "set_density": lambda spark, d: _round(_density(spark, d), "density").select("id", "density"),
        "set_density_null_only": lambda spark, d: _round(_density_of_null_only(spark, d), "density").select("id", "density"),
        "allowed_edge": lambda spark, d: _round(T.allowed_edge(_density(spark, d), view(spark, d, "gene_region"), P), "edge").select("id", "edge"),
        "allowed_edge_no_ext": lambda spark, d: _round(T.allowed_edge(_density(spark, d), view(spark, d, "gene_region"), P, extend=False), "edge").select("id", "edge"),
        "above_threshold": on(lambda a: a.above.select("id")),
        "close_transcripts": on(lambda a: a.close.select("id", "max_end")),
        "draw_edges": on(lambda a: a.transcripts.select(*FINAL)),
        "final_source": on(lambda a: a.sources),
        "annotate_genes": on(lambda a: a.genes),
        "annotate_noncoding": on(lambda a: a.noncoding),
        "distal_flag": on(lambda a: a.transcripts.select("id", "distal")),
        "link_post_gene": on(lambda a: a.transcripts.select("id", "parent_id")),
        "rpkm": on(lambda a: _round(a.transcripts, "rpkm").select("id", "rpkm")),
        "atlas_score": on(lambda a: _round(a.transcripts, "score").select("id", "score")),
        "standard_error": on(lambda a: _round(a.transcripts, "standard_error").select("id", "standard_error")),
        "filtered_transcripts": on(lambda a: a.transcripts.where(F.col("score") >= P.min_score).select(*FINAL)),
        "atlas_pipeline": lambda spark, d: whole(atlas(spark, d).transcripts),
        "persisted_atlas": lambda spark, d: whole(_saved(spark, d).transcripts()),
        "rebuilt_final": lambda spark, d: whole(_rebuilt(spark, d).transcripts("strict")),
        "q_bases_per_strand": q("bases_per_strand"),
        "q_totals": q("totals"),
        "q_refseq_major_minor": q("refseq_major_minor"),
        "q_has_ncrna": q("has_ncrna"),
        "q_unannotated": q("unannotated"),
        "q_proximal": q("proximal"),
        "q_parna": q("opposite", False, False),
        "q_parna_gene": q("opposite", False, True),
        "q_antisense": q("opposite", True, False),
        "q_antisense_gene": q("opposite", True, True),
        "q_distal": q("distal"),
        "q_distal_peak": peak(any_parent=True),
        "q_distal_no_peak": peak(how="left_anti"),
        "q_distal_near_peak": peak(pad=2000),
        "q_post_gene": q("post_gene"),
        "q_expressed_widest": q("expressed_widest"),
        "q_vectors": q("vectors"),
        "q_tags_by_gene": q("tags_by_gene", RUN1),
        "q_rpkm_one_run": q("in_run", RUN1, "rpkm1", rounded=["rpkm1"]),
        "q_rpkm_two_runs": q("two_runs", RUN1, RUN2, rounded=["rpkm1", "rpkm2"]),
        "q_fold_change": q("fold_change", RUN1, RUN2, rounded=["rpkm1", "rpkm2", "log_fold_change"]),
        "q_gene_fold_change": q("gene_fold_change", RUN1, RUN2, rounded=["rpkm1", "rpkm2", "log_fold_change"]),
        "q_expressed_genes": q("expressed_genes"),
        "q_rows_per_chromosome": q("rows_per_chromosome"),
        **{f"sql_{name}": _templated(name, 2000 if name == "distal_near_peak" else 0) for name in TEMPLATES},
        "sql_stored_genes": _stored_sql,
        "read_sam": lambda spark, d: readers.read_tags(spark, _text(spark, d, "sam"), "sam"),
        "read_bowtie": lambda spark, d: readers.read_tags(spark, _text(spark, d, "bowtie"), "bowtie"),
        "read_tags4": lambda spark, d: readers.read_tags(spark, _text(spark, d, "tags")),
        "normalize_tags": _tags4,
        "normalize_tags_flipped": lambda spark, d: _tags4(spark, d, True),
        "load_chromosome": lambda spark, d: readers.read_chromosomes(spark, _text(spark, d, "chrominfo")),
        "load_ncrna_summary": lambda spark, d: readers.read_ncrna_summary(spark, _text(spark, d, "summary"), "Mus musculus"),
        "read_intervals": lambda spark, d: _intervals(spark, d).drop("file"),
        "normalize_intervals": lambda spark, d: E.normalize_intervals(_intervals(spark, d)),
        "gene_regions": _gene_regions,
        "noncoding_rna": lambda spark, d: _rna(spark, d)[2],
        "noncoding_regions": _rna_regions,
        "refseq_transcripts": lambda spark, d: _round(N.consolidated_genes(view(spark, d, "gene_region"), P), "density", "edge"),
        "first_region": lambda spark, d: N.first_regions(view(spark, d, "gene_region"), "identifier"),
        "first_noncoding_region": lambda spark, d: N.first_regions(view(spark, d, "noncoding"), "type"),
        "load_refgene": lambda spark, d: readers.read_refgene(spark, _text(spark, d, "refgene")),
        "load_bed_regions": lambda spark, d: readers.read_bed_regions(spark, _text(spark, d, "bed")),
        "peaks_macs": _peaks(readers.read_macs, "macs", "tag_count", "log_ten_p_value", "fold_enrichment"),
        "peaks_sicer": _peaks(readers.read_sicer, "sicer", "tag_count", "p_value", "fold_enrichment", "fdr_threshold"),
        "peaks_bed": _peaks(readers.read_bed_peaks, "bed_peaks", "score"),
        "peaks_homer": _peaks(readers.read_homer, "homer", "tag_count", "score", "p_value", "fold_enrichment"),
        "count_broken": _evaluated(lambda g, t: E.count_broken(g, t, block=P.block)),
        "count_run_together": _evaluated(lambda g, t: E.count_run_together(g, t, block=P.block)),
        "summed_error": _evaluated(lambda g, t: _round(E.summed_error(g, t, block=P.block), "error")),
        "compare_sets": _evaluated(lambda g, t: _round(E.compare_sets(g, t, P.block), "forward", "backward")),
        "grid_error_matrix": _error_matrix,
        "grid_from_files": _files_matrix,
        "read_tags_by_suffix": _by_suffix,
        "line_counts": _line_counts,
        "grid_best_setting": lambda spark, d: _round(E.best_setting(_matrix(spark, d), "run_id", LEAST_TAGS), "error"),
        "sequence_identifiers": lambda spark, d: N.sequence_identifiers(readers.read_refgene(spark, _text(spark, d, "refgene"))),
        "bed_track": _track,
        "bed_rows": lambda spark, d: bed_rows(kept_atlas(spark, d).transcripts, view(spark, d, "chromosome"), P.min_score),
    }


def _fold(name: str, source: str, keys: str, order: str, gap: int, members: str) -> str:
    """Common table expressions of the merging rule over source(keys, s, e, refseq, tag_count)."""
    w = f"(PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""{name}1 AS (SELECT *, max(e) OVER {w} AS m FROM {source}),
{name}2 AS (SELECT *, last_value(CASE WHEN m IS NULL OR e > m + 1 THEN refseq END IGNORE NULLS) OVER {w} AS pref FROM {name}1),
{name}3 AS (SELECT *, coalesce(m IS NULL OR s > m + {gap} OR (e > m + 1 AND pref <> refseq), false) AS brk FROM {name}2),
{name}4 AS (SELECT *, sum(CAST(brk AS INT)) OVER (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS cid FROM {name}3),
{name} AS (SELECT {keys}, max(CASE WHEN brk THEN greatest(coalesce(m + 1, s), s) END) AS s, max(e) AS e, bool_or(brk AND refseq) AS refseq,
  CAST(sum(tag_count) AS BIGINT) AS tag_count, CAST(sum(CASE WHEN NOT brk AND s > m THEN 1 ELSE 0 END) AS BIGINT) AS gaps, count(*) AS n, min(s) AS first_s{members} FROM {name}4 GROUP BY {keys}, cid)"""


ID = "CAST((chr * 2 + strand) * 1000000000000 + {} AS BIGINT)"
LEN = "(e - s + 1)"


def _final_sql(name: str, least_tags: int) -> str:
    """Common table expressions from prep to the final set ``name``; the one named final has thr and clos without a suffix."""
    x = "" if name == "final" else f"_{name}"
    w = "(PARTITION BY chr, strand ORDER BY s, max_end, id ROWS"
    return f"""thr{x} AS (SELECT * FROM prep WHERE id IN (SELECT id FROM ssource GROUP BY id HAVING avg(tag_count) > 1 AND (count(*) > 1 OR avg(tag_count) >= {least_tags}))),
clos{x} AS (SELECT a.id, a.chr, a.strand, a.s, a.refseq, greatest(max(b.e), a.e) AS max_end FROM thr{x} a LEFT JOIN thr{x} b ON a.chr = b.chr AND a.strand = b.strand AND a.refseq = b.refseq AND a.s <= b.s
  AND (b.s - a.e) * (b.s - a.e) + (b.density - a.density) * (b.density - a.density) <= a.edge * a.edge GROUP BY a.id, a.chr, a.strand, a.s, a.refseq, a.e),
dr{x} AS (SELECT *, coalesce(s > max(max_end) OVER {w} BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS b FROM clos{x}),
dr2{x} AS (SELECT *, sum(CAST(b AS INT)) OVER {w} UNBOUNDED PRECEDING) AS c FROM dr{x}),
{name} AS (SELECT {ID.format("min(s)")} AS id, chr, strand, min(s) AS s, max(max_end) AS e, bool_or(b AND refseq) AS refseq FROM dr2{x} GROUP BY chr, strand, c)"""


def _prelude(least_tags: int = 3) -> str:
    views = ",\n".join(f"{k} AS ({v})" for k, v in VIEWS.items())
    return f"""WITH {views},
flagged AS (SELECT run_id, chr, strand, s, e, count(*) AS tag_count, EXISTS (SELECT 1 FROM gene_region g WHERE g.chr = t.chr AND g.strand = t.strand AND g.s <= t.e AND t.s <= g.e) AS refseq
  FROM tag t GROUP BY run_id, chr, strand, s, e),
{_fold("proto", "flagged", "run_id, chr, strand", "s, e", 0, "")},
{_fold("protogap", "flagged", "run_id, chr, strand", "s, e", 5, "")},
extended AS (SELECT run_id, chr, strand, f.s AS own_s, f.e AS own_e, greatest(CASE WHEN strand = 1 THEN f.s - 200 ELSE f.s END, 0) AS s, least(CASE WHEN strand = 0 THEN f.e + 200 ELSE f.e END, length - 1) AS e, refseq, tag_count
  FROM flagged f JOIN chromosome c ON c.id = f.chr),
{_fold("protoext", "extended", "run_id, chr, strand", "own_s, own_e", 0, "")},
{_fold("merged", "(SELECT 0 AS run_id, chr, strand, s, e, true AS refseq, count(*) AS tag_count FROM gene_region GROUP BY chr, strand, s, e)", "run_id, chr, strand", "s, e", 0, "")},
{_fold("st", "(SELECT run_id, chr, strand, s, e, refseq, tag_count, gaps AS g FROM proto)", "chr, strand", "s, e, run_id", 0, "")},
stitched AS (SELECT {ID.format("e")} AS id, chr, strand, CASE WHEN n = 1 THEN first_s ELSE s END AS s, e, refseq, n FROM st),
ssource AS (SELECT {ID.format("ce")} AS id, chr, run_id, CAST(sum(tag_count) AS BIGINT) AS tag_count, CAST(sum(g) AS BIGINT) AS gaps
  FROM (SELECT *, max(e) OVER (PARTITION BY chr, strand, cid) AS ce FROM st4) GROUP BY chr, strand, ce, run_id),
dens AS (SELECT t.*, greatest(0.0, 1000.0::DOUBLE * x.tags / (x.runs * {LEN})) AS density FROM stitched t JOIN (SELECT id, sum(tag_count) AS tags, count(*) AS runs FROM ssource GROUP BY id) x USING (id)),
reach AS (SELECT t.id, max(least(g.e - t.e + 1, (g.e - g.s + 1) * 0.2::DOUBLE)) AS o FROM dens t JOIN gene_region g ON g.chr = t.chr AND g.strand = t.strand AND t.e BETWEEN g.s AND g.e GROUP BY t.id),
prep AS (SELECT t.*, CASE WHEN o IS NOT NULL THEN greatest(60.0::DOUBLE, o) ELSE 60.0::DOUBLE * least(density / 25.0::DOUBLE, 1.0::DOUBLE) END AS edge FROM dens t LEFT JOIN reach USING (id)),
{_final_sql("final", least_tags)},
{_final_sql("strict", STRICTER.min_one_run_tags)},
fsource AS (SELECT f.id, x.run_id, CAST(sum(x.tag_count) AS BIGINT) AS tag_count, count(*) - 1 AS gaps FROM final f JOIN prep p ON p.chr = f.chr AND p.strand = f.strand AND f.s <= p.s AND p.e <= f.e JOIN ssource x ON x.id = p.id GROUP BY f.id, x.run_id),
annall AS (SELECT f.id AS transcript_id, g.id AS region_id, g.kind, CASE WHEN f.s = g.s AND f.e = g.e THEN 'is equal to' WHEN f.s <= g.s AND g.e <= f.e THEN 'contains' WHEN g.s <= f.s AND f.e <= g.e THEN 'is contained by' ELSE 'overlaps with' END AS relationship,
  (least(f.e, g.e) - greatest(f.s, g.s) + 1) * 2 > g.e - g.s + 1 AS major
  FROM final f JOIN (SELECT id, chr, strand, s, e, 'g' AS kind FROM gene_region UNION ALL SELECT id, chr, strand, s, e, 'n' FROM noncoding) g ON g.chr = f.chr AND g.s <= f.e AND f.s <= g.e AND (g.strand IS NULL OR g.strand = f.strand)),
anng AS (SELECT transcript_id, region_id, relationship, major FROM annall WHERE kind = 'g'),
annn AS (SELECT transcript_id, region_id, relationship, major FROM annall WHERE kind = 'n'),
par AS (SELECT t.id, arg_min(g.id, CASE WHEN t.strand = 0 THEN t.s - g.e ELSE g.s - t.e END * 1000000000000000000::HUGEINT + g.id) AS parent_id FROM final t JOIN final g ON t.chr = g.chr AND t.strand = g.strand AND NOT t.refseq AND g.refseq
  AND t.s <= CASE WHEN g.strand = 0 THEN g.e + 59 ELSE g.s - 1 END AND t.e >= CASE WHEN g.strand = 0 THEN g.e ELSE g.s - 60 END GROUP BY t.id),
nrun AS (SELECT count(*) AS n FROM run),
se AS (SELECT x.id, sqrt(greatest(0, (sum(v * v) - sum(v) * sum(v) / max(n)) / (max(n) - 1))) / sqrt(max(n)) AS se FROM (SELECT x.id, x.tag_count / r.total_tags * 1e7 AS v FROM fsource x JOIN run r ON r.id = x.run_id) x, nrun GROUP BY x.id),
scored0 AS (SELECT f.*, NOT EXISTS (SELECT 1 FROM gene_region g WHERE g.chr = f.chr AND g.s - 1000 <= f.e AND f.s <= g.e + 1000) AS distal, par.parent_id,
  x.tags / ((f.e - f.s + 1) / 1000.0::DOUBLE) / ((SELECT sum(tag_count) FROM ssource) / 1e6) AS rpkm, coalesce(se.se, 0) AS standard_error
  FROM final f LEFT JOIN par ON par.id = f.id LEFT JOIN se ON se.id = f.id LEFT JOIN (SELECT id, sum(tag_count)::DOUBLE AS tags FROM fsource GROUP BY id) x ON x.id = f.id),
t AS (SELECT *, rpkm * ln(greatest(1.0::DOUBLE, {LEN} - 200)) / ln(100.0::DOUBLE) AS score FROM scored0),
ok AS (SELECT * FROM t WHERE score >= 1 AND parent_id IS NULL),
bare AS (SELECT * FROM ok WHERE id NOT IN (SELECT transcript_id FROM annall)),
sites AS (SELECT *, CASE WHEN strand = 0 THEN s ELSE e END - 1000 AS ts, CASE WHEN strand = 0 THEN s ELSE e END + 1000 AS te FROM gene_region),
expr AS (SELECT region_id FROM anng JOIN ok ON ok.id = transcript_id WHERE major),
r1 AS (SELECT ok.id, x.tag_count / ((e - s + 1) / 1000.0::DOUBLE) / (r.total_tags / 1000000.0::DOUBLE) AS rpkm1 FROM ok JOIN fsource x ON x.id = ok.id JOIN run r ON r.id = x.run_id AND r.source_table = 'run_1'),
r2 AS (SELECT ok.id, x.tag_count / ((e - s + 1) / 1000.0::DOUBLE) / (r.total_tags / 1000000.0::DOUBLE) AS rpkm2 FROM ok JOIN fsource x ON x.id = ok.id JOIN run r ON r.id = x.run_id AND r.source_table = 'run_2'),
fc AS (SELECT id, rpkm1, rpkm2, log2(rpkm1 / rpkm2) AS log_fold_change FROM r1 JOIN r2 USING (id))
"""


def _broken_sql(whole: str, parts: str, by: str = "") -> str:
    """Rows of whole, each with whether the first part that ends past its start and the last that starts before its end break it."""
    keys = f"{by}chr, strand"
    same = " AND ".join(f"p.{k} = w.{k}" for k in keys.split(", "))
    return f"""(SELECT w.*, coalesce(f.k <> l.k AND f.e <= w.e AND l.s >= w.s, false) AS broken FROM (SELECT {keys}, s, e FROM {whole}) w
  LEFT JOIN LATERAL (SELECT arg_min(struct_pack(k := k, s := s, e := e), k) AS x FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY s, e) AS k FROM {parts}) p WHERE {same} AND p.e >= w.s) f0 ON true
  LEFT JOIN LATERAL (SELECT arg_max(struct_pack(k := k, s := s, e := e), k) AS x FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY s, e) AS k FROM {parts}) p WHERE {same} AND p.s <= w.e) l0 ON true,
  LATERAL (SELECT f0.x.k AS k, f0.x.e AS e) f, LATERAL (SELECT l0.x.k AS k, l0.x.s AS s) l)"""


def _error_sql(reference: str, target: str) -> str:
    known = f"(SELECT * FROM {reference} WHERE (chr, strand) IN (SELECT (chr, strand) FROM {target}))"
    return f"((SELECT avg(CAST(broken AS DOUBLE)) FROM {_broken_sql(known, target)}) + (SELECT avg(CAST(broken AS DOUBLE)) FROM {_broken_sql(target, known)}))"


def _matrix_sql(digits: int = 6) -> str:
    sets = "(SELECT run_id, least, chr, strand, s, e FROM proto, (VALUES (1), (2), (3)) v(least) WHERE tag_count >= least)"
    known = f"(SELECT x.run_id, x.least, g.chr, g.strand, g.s, g.e FROM gene_region g JOIN (SELECT DISTINCT run_id, least, chr, strand FROM {sets}) x ON x.chr = g.chr AND x.strand = g.strand)"
    share = lambda a, b: f"(SELECT run_id, least, avg(CAST(broken AS DOUBLE)) AS x FROM {_broken_sql(a, b, 'run_id, least, ')} GROUP BY run_id, least)"
    cells = ", ".join(f"round(max(a.x + b.x) FILTER (a.least = {x}), {digits}) AS error_{x}" for x in LEAST_TAGS)
    return f"SELECT a.run_id, {cells} FROM {share(known, sets)} a JOIN {share(sets, known)} b USING (run_id, least) GROUP BY a.run_id"


def oracle_sql() -> dict[str, str]:
    final = ", ".join(FINAL)
    proto = "run_id, chr, strand, s, e, refseq, tag_count, gaps"
    overlap = "p.chr = b.chr AND p.{0} <= b.e AND b.s <= p.{1}"
    count = "SELECT count(DISTINCT id) AS n FROM "
    opposite = "bare b JOIN sites g ON g.chr = b.chr AND g.strand <> b.strand AND NOT b.distal AND "
    start, inside = "b.s <= g.te AND g.ts <= b.e", "b.s <= g.e AND g.s <= b.e AND NOT (b.s <= g.te AND g.ts <= b.e)"
    sign, chrom = "CASE WHEN strand = 1 THEN '-' ELSE '+' END AS strand_char", "concat('chr', chr - 1) AS chromosome"
    tag = f"SELECT {sign}, {chrom}, s AS start, repeat('A', e - s) AS sequence FROM tag"
    region = f"SELECT identifier, {chrom}, {sign}, s, e FROM gene_region"
    whole = f"SELECT {final}, distal, parent_id, round(rpkm, 6) AS rpkm, round(score, 6) AS score, round(standard_error, 6) AS standard_error FROM t"
    score = "round(score / (SELECT max(score) FROM t) * 1000, 6)"
    line = f"""concat_ws(chr(9), name, greatest(s, 0), least(e, length), concat('Transcript_', b.id), {score},
  CASE WHEN strand = 0 THEN '+' ELSE '-' END, greatest(s, 0), least(e, length), CASE WHEN strand = 0 THEN '0,0,255' ELSE '0,255,0' END) AS line FROM t b JOIN chromosome c ON c.id = b.chr WHERE score >= 1"""
    rna = "concat('FR', id, ': ', description, ', note') AS description"
    in_sam = "s % 40 >= 10 AND s % 97 <> 0 AND s % 11 <> 0 AND s % 7 <> 1 AND NOT (s % 7 = 0 AND strand = 0)"
    lines, unmapped = "tag WHERE s % 97 <> 0", "s % 7 = 0 AND strand = 0"
    counted = [
        ("sam", "lines", 0, lines),
        ("sam", "malformed", 0, f"{lines} AND s % 11 = 0"),
        ("sam", "unmapped", 0, f"{lines} AND s % 11 <> 0 AND {unmapped}"),
        ("sam", "secondary", 0, f"{lines} AND s % 11 <> 0 AND s % 7 = 1"),
        ("sam", "low_quality", 0, f"{lines} AND s % 11 <> 0 AND s % 7 <> 1 AND NOT ({unmapped}) AND s % 40 < 10"),
        ("summary", "lines", 1, "noncoding"),
        ("summary", "no_id", 0, "noncoding WHERE false"),
        ("summary", "header", 1, "noncoding WHERE false"),
        ("summary", "other_species", 0, "noncoding WHERE id % 4 = 0"),
        ("chrominfo", "lines", 0, "chromosome"),
        ("chrominfo", "other_name", 0, "chromosome WHERE id % 9 = 0"),
        ("chrominfo", "no_length", 0, "chromosome WHERE false"),
        ("macs", "lines", 0, "peak"),
        ("macs", "other_name", 0, "peak WHERE false"),
        ("macs", "no_position", 0, "peak WHERE false"),
        ("macs", "unknown_chromosome", 0, "peak WHERE chr % 3 = 0"),
    ]
    own = {
        "read_sam": f"{tag} WHERE {in_sam}",
        "load_chromosome": "SELECT row_number() OVER (ORDER BY id) AS id, name, length FROM chromosome WHERE id % 9 <> 0",
        "load_ncrna_summary": "SELECT concat('FR', id) AS id, concat(description, ', note') AS description, type, concat('src', id % 5) AS source FROM noncoding WHERE id % 4 <> 0",
        "read_intervals": f"SELECT concat('chr', chr - 1) AS chr, s AS start, e AS \"end\", {sign.replace('strand_char', 'strand')} FROM gene_region",
        "normalize_intervals": "SELECT concat('chr', chr - 1) AS chr, strand, s, e FROM gene_region",
        "gene_regions": "SELECT identifier, type, chr, strand, s, e, s - 1000 AS wide_s, e + 1000 AS wide_e, ts AS site_s, te AS site_e FROM sites",
        "noncoding_rna": f"SELECT type, {rna}, concat('src', id % 5) AS source FROM noncoding WHERE id % 4 <> 0 AND id % 3 <> 0",
        "noncoding_regions": f"SELECT type, {rna}, chr, CASE WHEN strand = 1 THEN 1 ELSE 0 END AS strand, s, e FROM noncoding WHERE id % 4 <> 0 AND id % 3 <> 0",
        "refseq_transcripts": f"SELECT * REPLACE (round(density, 6) AS density), round(60.0::DOUBLE * least(density / 25.0::DOUBLE, 1.0::DOUBLE), 6) AS edge FROM (SELECT {ID.format('e')} AS id, chr, strand, s, e, refseq, 1000.0::DOUBLE * tag_count / {LEN} AS density FROM merged)",
        "first_region": "SELECT identifier, id, chr, strand, s, e FROM gene_region QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY s, id) = 1",
        "first_noncoding_region": "SELECT type, id, chr, strand, s, e FROM noncoding QUALIFY row_number() OVER (PARTITION BY type ORDER BY s, id) = 1",
        "proto_transcripts_extended": f"SELECT {proto} FROM protoext",
        "cluster_lineage": f"SELECT {ID.format('ce')} AS id, run_id, s, e FROM (SELECT *, max(e) OVER (PARTITION BY chr, strand, cid) AS ce FROM st4)",
        "incremental_stitch": f"SELECT {final}, n FROM stitched",
        "incremental_source": "SELECT * FROM ssource",
        "incremental_atlas": whole,
        "kept_sets": f"SELECT round({_error_sql('final', 'strict')}, 6) AS forward, round({_error_sql('strict', 'final')}, 6) AS backward",
        "stored_range": f"SELECT {final}, round(density, 6) AS density, round(edge, 6) AS edge FROM prep WHERE chr = 3 AND s <= 3000 AND e >= 1000",
        "flag_refseq_split": "SELECT * FROM flagged",
        "set_density_null_only": "SELECT id, round(CASE WHEN n = 1 THEN 0.5::DOUBLE ELSE density END, 6) AS density FROM dens",
        "persisted_atlas": whole,
        "rebuilt_final": whole,
        "peaks_homer": "SELECT chr, s, e, CASE WHEN id % 2 = 0 THEN 0 ELSE 1 END AS strand, e - s AS length, CAST(id % 1000 AS DOUBLE) AS tag_count, CAST(id % 90 AS DOUBLE) AS score, 2.5::DOUBLE AS p_value, CAST(-(id % 40) AS INT) AS p_value_exp, CAST(id % 30 AS DOUBLE) AS fold_enrichment FROM peak",
        "grid_best_setting": f"SELECT run_id, col AS column, round(error, 6) AS error FROM (UNPIVOT (SELECT run_id, error_1 AS \"1\", error_2 AS \"2\", error_3 AS \"3\" FROM ({_matrix_sql(20)})) ON \"1\", \"2\", \"3\" INTO NAME col VALUE error) ORDER BY error, run_id, col LIMIT 1",
        "bed_track": f"SELECT strand, line FROM (SELECT strand, {line}) UNION ALL SELECT v.strand, concat('track name=transcripts_', v.strand, ' description=\"Transcripts, ', CASE WHEN v.strand = 0 THEN '+' ELSE '-' END, ' strand\" useScore=1 itemRgb=On') FROM (VALUES (0), (1)) v(strand)",
        "read_bowtie": tag,
        "read_tags4": tag,
        "normalize_tags": "SELECT chr, strand, s, e FROM tag",
        "normalize_tags_flipped": "SELECT chr, 1 - strand AS strand, s, e FROM tag",
        "load_refgene": region,
        "load_bed_regions": region,
        "peaks_macs": "SELECT chr, s, e, e - s AS length, s + 100 AS summit, CAST(id % 1000 AS DOUBLE) AS tag_count, CAST(id % 70 AS DOUBLE) AS log_ten_p_value, CAST(id % 30 AS DOUBLE) AS fold_enrichment FROM peak",
        "peaks_sicer": "SELECT chr, s, e, e - s AS length, CAST(id % 1000 AS DOUBLE) AS tag_count, 1.5::DOUBLE AS p_value, CAST(-(id % 50) AS INT) AS p_value_exp, CAST(id % 30 AS DOUBLE) AS fold_enrichment, 0.25::DOUBLE AS fdr_threshold, 0 AS fdr_threshold_exp FROM peak",
        "peaks_bed": "SELECT chr, s, e, e - s AS length, CAST(id % 1000 AS DOUBLE) AS score FROM peak",
        "run_registry": "SELECT r AS id, concat('run_', r) AS source_table, (SELECT count(*) FROM tag WHERE run_id = r) AS total_tags FROM (VALUES (1), (2), (3)) v(r) UNION ALL SELECT 0, 'gene_regions', NULL",
        "collapse_tags": "SELECT run_id, chr, strand, s, e, count(*) AS tag_count FROM tag GROUP BY ALL",
        "union_runs_distinct": "SELECT DISTINCT chr, s, e, CASE WHEN strand = 0 THEN '+' ELSE '-' END AS sign FROM tag",
        "extend_tags": "SELECT run_id, chr, strand, greatest(CASE WHEN strand = 1 THEN s - 200 ELSE s END, 0) AS s, least(CASE WHEN strand = 0 THEN e + 200 ELSE e END, length - 1) AS e FROM tag JOIN chromosome c ON c.id = chr",
        "segment_in_range": "SELECT * FROM tag WHERE e >= 1000 AND s <= 3000 AND strand = 1",
        "flag_refseq": "SELECT * FROM flagged",
        "proto_transcripts": f"SELECT {proto} FROM proto",
        "proto_transcripts_gap": f"SELECT {proto} FROM protogap",
        "proto_source": f"SELECT run_id, chr, strand, e, tag_count, round(1000.0::DOUBLE * tag_count / {LEN}, 6) AS run_density FROM proto",
        "stitch_transcripts": f"SELECT {final}, n FROM stitched",
        "stitched_source": "SELECT * FROM ssource",
        "set_density": "SELECT id, round(density, 6) AS density FROM dens",
        "allowed_edge": "SELECT id, round(edge, 6) AS edge FROM prep",
        "allowed_edge_no_ext": "SELECT id, round(60.0::DOUBLE * least(density / 25.0::DOUBLE, 1.0::DOUBLE), 6) AS edge FROM dens",
        "above_threshold": "SELECT id FROM thr",
        "close_transcripts": "SELECT id, max_end FROM clos",
        "draw_edges": f"SELECT {final} FROM final",
        "final_source": "SELECT * FROM fsource",
        "annotate_genes": "SELECT * FROM anng",
        "annotate_noncoding": "SELECT * FROM annn",
        "distal_flag": "SELECT id, distal FROM t",
        "link_post_gene": "SELECT id, parent_id FROM t",
        "rpkm": "SELECT id, round(rpkm, 6) AS rpkm FROM t",
        "atlas_score": "SELECT id, round(score, 6) AS score FROM t",
        "standard_error": "SELECT id, round(standard_error, 6) AS standard_error FROM t",
        "filtered_transcripts": f"SELECT {final} FROM t WHERE score >= 1",
        "atlas_pipeline": whole,
        "q_bases_per_strand": f"SELECT strand, CAST(sum{LEN} AS BIGINT) AS bases FROM t GROUP BY strand",
        "q_totals": "SELECT count(*) AS n_all, count(*) FILTER (score >= 1) AS n_1, count(*) FILTER (score >= 0.75) AS n_75 FROM t WHERE parent_id IS NULL",
        "q_refseq_major_minor": "SELECT major, count(DISTINCT id) AS n FROM ok JOIN anng ON transcript_id = id GROUP BY major",
        "q_has_ncrna": count + "ok JOIN annn ON transcript_id = id",
        "q_unannotated": count + "bare",
        "q_proximal": count + "bare WHERE NOT distal",
        "q_parna": f"SELECT count(DISTINCT b.id) AS n FROM {opposite} {start}",
        "q_parna_gene": f"SELECT count(DISTINCT b.id) AS n FROM {opposite} {start} WHERE g.id IN (SELECT region_id FROM expr)",
        "q_antisense": f"SELECT count(DISTINCT b.id) AS n FROM {opposite} {inside}",
        "q_antisense_gene": f"SELECT count(DISTINCT b.id) AS n FROM {opposite} {inside} WHERE g.id IN (SELECT region_id FROM expr)",
        "q_distal": count + "bare WHERE distal",
        "q_distal_peak": f"SELECT count(DISTINCT b.id) AS n FROM t b JOIN peak p ON {overlap.format('s', 'e - 1')} WHERE b.score >= 1 AND b.distal AND b.id NOT IN (SELECT transcript_id FROM annall)",
        "q_distal_no_peak": f"SELECT count(*) AS n FROM bare b WHERE distal AND NOT EXISTS (SELECT 1 FROM peak p WHERE {overlap.format('s', 'e - 1')})",
        "q_distal_near_peak": f"SELECT count(DISTINCT b.id) AS n FROM bare b JOIN peak p ON {overlap.format('s - 2000', 'e + 1999')} WHERE distal",
        "q_post_gene": "SELECT a.id, a.chr, least(a.s, g.s) AS min_start, greatest(a.e, g.e) AS max_end, g.id AS gene_id, g.s AS gene_start, g.e AS gene_end, round(g.score, 6) AS gene_score FROM t a JOIN t g ON g.id = a.parent_id WHERE a.score >= 1 AND g.score >= 1",
        "q_expressed_widest": "SELECT id, chr, s, e, region_id, identifier, reg_width FROM (SELECT ok.*, g.id AS region_id, g.identifier, g.e - g.s AS reg_width, row_number() OVER (PARTITION BY ok.id ORDER BY g.e - g.s DESC, g.id) AS k FROM ok JOIN anng ON transcript_id = ok.id AND major JOIN gene_region g ON g.id = region_id) WHERE k = 1",
        "q_vectors": f"SELECT id, round(score, 6) AS score, round(rpkm, 6) AS rpkm, {LEN} AS length FROM t ORDER BY id",
        "q_tags_by_gene": "SELECT identifier, CAST(sum(x.tag_count) AS BIGINT) AS tags FROM fsource x JOIN run r ON r.id = x.run_id AND r.source_table = 'run_1' JOIN anng ON transcript_id = x.id JOIN gene_region g ON g.id = region_id AND g.type = 'mRNA' GROUP BY identifier ORDER BY identifier",
        "q_rpkm_one_run": "SELECT id, round(rpkm1, 6) AS rpkm1 FROM r1",
        "q_rpkm_two_runs": "SELECT id, round(rpkm1, 6) AS rpkm1, round(rpkm2, 6) AS rpkm2 FROM r1 JOIN r2 USING (id)",
        "q_fold_change": "SELECT id, round(rpkm1, 6) AS rpkm1, round(rpkm2, 6) AS rpkm2, round(log_fold_change, 6) AS log_fold_change FROM fc",
        "q_gene_fold_change": "SELECT fc.id, round(rpkm1, 6) AS rpkm1, round(rpkm2, 6) AS rpkm2, round(log_fold_change, 6) AS log_fold_change, identifier FROM fc JOIN anng ON transcript_id = fc.id JOIN gene_region g ON g.id = region_id WHERE abs(log_fold_change) > 1",
        "q_expressed_genes": "SELECT ok.id, identifier, round(score, 6) AS score FROM ok JOIN anng ON transcript_id = ok.id AND major JOIN gene_region g ON g.id = region_id",
        "q_rows_per_chromosome": "SELECT chr, count(*) AS n FROM t GROUP BY chr ORDER BY n DESC, chr",
        "count_broken": f"SELECT count(*) FILTER (broken) AS n FROM {_broken_sql('gene_region', 'final')}",
        "count_run_together": f"SELECT count(*) FILTER (broken) AS n FROM {_broken_sql('final', 'gene_region')}",
        "summed_error": f"SELECT round({_error_sql('gene_region', 'final')}, 6) AS error",
        "compare_sets": f"SELECT round({_error_sql('gene_region', 'final')}, 6) AS forward, round({_error_sql('final', 'gene_region')}, 6) AS backward",
        "grid_error_matrix": _matrix_sql(),
        "sequence_identifiers": "SELECT DISTINCT identifier, CASE substr(identifier, 1, 2) WHEN 'NM' THEN 'mRNA' WHEN 'NR' THEN 'RNA' END AS type FROM gene_region",
        "grid_from_files": f"SELECT * REPLACE (CASE WHEN run_id <> 2 THEN error_3 END AS error_3) FROM ({_matrix_sql()}) UNION ALL SELECT 4, NULL, NULL, NULL",
        "read_tags_by_suffix": " UNION ALL ".join(f"SELECT '{k}' AS kind, {sign}, {chrom}, count(*) AS n, CAST(sum(s) AS BIGINT) AS starts FROM tag WHERE {w} GROUP BY ALL" for k, w in (("sam", in_sam), ("bowtie", "true"), ("tags", "true"))),
        "line_counts": " UNION ALL ".join(f"SELECT '{k}' AS kind, '{r}' AS reason, count(*) + {more} AS n FROM {w}" for k, r, more, w in counted),
        "bed_rows": f"SELECT strand, chr, s AS start, {line}",
    }
    own |= {f"sql_{name}": own[f"q_{name}"] for name in TEMPLATES} | {"sql_stored_genes": own["q_expressed_genes"]}
    heads = dict.fromkeys(["rebuilt_final", "sql_stored_genes"], _prelude(STRICTER.min_one_run_tags))
    head = _prelude()
    return {k: heads.get(k, head) + v for k, v in own.items()}
