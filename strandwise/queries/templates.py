"""Analyst queries as SQL text over the views of ``plans.views``.

Named parameters: min_score, run1, run2 and pad. ``LONE`` is a transcript that
counts: scored, without a parent. ``BARE`` is one that no gene or other RNA overlaps.
"""

from __future__ import annotations

LONE = "t.score >= :min_score AND t.parent_id IS NULL"
NAMELESS = """NOT EXISTS (SELECT 1 FROM transcript_gene g WHERE g.transcript_id = t.id)
  AND NOT EXISTS (SELECT 1 FROM transcript_noncoding x WHERE x.transcript_id = t.id)"""
BARE = f"{LONE} AND {NAMELESS}"
#: Regions that have an expressed transcript over most of them.
TOLD = f"SELECT a.region_id FROM transcript_gene a JOIN transcript t ON t.id = a.transcript_id WHERE a.major AND {LONE}"
PEAKS = "SELECT chr, s - :pad AS s, e + :pad - 1 AS e FROM peak"
#: Peaks are half-open, so their last position is e - 1.
NEAR = f"near AS (SELECT p.*, right_cells(s, e) AS cells FROM ({PEAKS}) p), near_cell AS (SELECT chr, s, e, cell FROM near LATERAL VIEW explode(cells) x AS cell)"
BY_PEAK = "SELECT t.id FROM transcript_cell t JOIN near_cell p ON p.chr = t.chr AND p.cell = t.cell AND meets(t.s, t.e, p.s, p.e, t.cell)"


def _count(where: str, source: str = "transcript t") -> str:
    return f"SELECT count(DISTINCT t.id) AS n FROM {source} WHERE {where}"


def _facing(cells: str, s: str, e: str, more: str = "") -> str:
    """Proximal transcripts without annotation that meet regions of the other strand."""
    met = f"transcript_cell t JOIN {cells} r ON r.chr = t.chr AND r.cell = t.cell AND r.strand <> t.strand AND meets(t.s, t.e, r.{s}, r.{e}, t.cell)"
    return _count(f"{BARE} AND NOT t.distal{more}", met)


def _in_run(k: int) -> str:
    return f"JOIN transcript_source s{k} ON s{k}.id = t.id JOIN run run{k} ON run{k}.id = s{k}.run_id AND run{k}.source_table = :run{k}"


def _rpkm(k: int) -> str:
    return f"rpkm(t.s, t.e, s{k}.tag_count, run{k}.total_tags)"


BODY = " AND NOT overlaps(t.s, t.e, r.site_s, r.site_e)"
HEARD = f" AND r.id IN ({TOLD})"
BOTH_RUNS = f"SELECT t.id, {_rpkm(1)} AS rpkm1, {_rpkm(2)} AS rpkm2 FROM transcript t {_in_run(1)} {_in_run(2)} WHERE {LONE}"
CHANGES = f"SELECT *, log2(rpkm1 / rpkm2) AS log_fold_change FROM ({BOTH_RUNS})"
ROUNDED = "round(rpkm1, 6) AS rpkm1, round(rpkm2, 6) AS rpkm2"
MAJOR = "JOIN transcript_gene a ON a.transcript_id = t.id AND a.major JOIN gene_region g ON g.id = a.region_id"

TEMPLATES = {
    "bases_per_strand": "SELECT strand, sum(bases(s, e)) AS bases FROM transcript GROUP BY strand",
    "totals": "SELECT count(*) AS n_all, count_if(score >= 1) AS n_1, count_if(score >= 0.75) AS n_75 FROM transcript WHERE parent_id IS NULL",
    "refseq_major_minor": f"SELECT a.major, count(DISTINCT t.id) AS n FROM transcript t JOIN transcript_gene a ON a.transcript_id = t.id WHERE {LONE} GROUP BY a.major",
    "has_ncrna": _count(LONE, "transcript t JOIN transcript_noncoding a ON a.transcript_id = t.id JOIN noncoding_region r ON r.id = a.region_id"),
    "unannotated": _count(BARE),
    "proximal": _count(f"{BARE} AND NOT t.distal"),
    "parna": _facing("gene_site_cell", "site_s", "site_e"),
    "parna_gene": _facing("gene_site_cell", "site_s", "site_e", HEARD),
    "antisense": _facing("gene_region_cell", "s", "e", BODY),
    "antisense_gene": _facing("gene_region_cell", "s", "e", BODY + HEARD),
    "distal": _count(f"{BARE} AND t.distal"),
    "distal_peak": f"WITH {NEAR} {_count(f't.score >= :min_score AND {NAMELESS} AND t.distal AND t.id IN ({BY_PEAK})')}",
    "distal_no_peak": f"WITH {NEAR} {_count(f'{BARE} AND t.distal AND NOT EXISTS (SELECT 1 FROM ({BY_PEAK}) b WHERE b.id = t.id)')}",
    "distal_near_peak": f"WITH {NEAR} {_count(f'{BARE} AND t.distal AND t.id IN ({BY_PEAK})')}",
    "post_gene": """SELECT t.id, t.chr, least(t.s, g.s) AS min_start, greatest(t.e, g.e) AS max_end, g.id AS gene_id, g.s AS gene_start, g.e AS gene_end,
  round(g.score, 6) AS gene_score FROM transcript t JOIN transcript g ON g.id = t.parent_id WHERE t.score >= :min_score AND g.score >= :min_score""",
    "expressed_widest": f"""SELECT id, chr, s, e, region_id, identifier, reg_width FROM (SELECT t.id, t.chr, t.s, t.e, g.id AS region_id, g.identifier, g.e - g.s AS reg_width,
  row_number() OVER (PARTITION BY t.id ORDER BY g.e - g.s DESC, g.id) AS place FROM transcript t {MAJOR} WHERE {LONE}) WHERE place = 1""",
    "vectors": "SELECT id, round(score, 6) AS score, round(rpkm, 6) AS rpkm, bases(s, e) AS length FROM transcript ORDER BY id",
    "tags_by_gene": f"""SELECT g.identifier, sum(s1.tag_count) AS tags FROM transcript t {_in_run(1)} JOIN transcript_gene a ON a.transcript_id = t.id
  JOIN gene_region g ON g.id = a.region_id AND g.type = 'mRNA' GROUP BY g.identifier ORDER BY g.identifier""",
    "rpkm_one_run": f"SELECT t.id, round({_rpkm(1)}, 6) AS rpkm1 FROM transcript t {_in_run(1)} WHERE {LONE}",
    "rpkm_two_runs": f"SELECT id, {ROUNDED} FROM ({BOTH_RUNS})",
    "fold_change": f"SELECT id, {ROUNDED}, round(log_fold_change, 6) AS log_fold_change FROM ({CHANGES})",
    "gene_fold_change": f"""SELECT c.id, {ROUNDED}, round(log_fold_change, 6) AS log_fold_change, g.identifier FROM ({CHANGES}) c
  JOIN transcript_gene a ON a.transcript_id = c.id JOIN gene_region g ON g.id = a.region_id WHERE abs(log_fold_change) > 1""",
    "expressed_genes": f"SELECT t.id, g.identifier, round(t.score, 6) AS score FROM transcript t {MAJOR} WHERE {LONE}",
    "rows_per_chromosome": "SELECT chr, count(*) AS n FROM transcript GROUP BY chr ORDER BY n DESC, chr",
}
