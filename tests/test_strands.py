"""Strands that fit a task: the same tables as by single steps, and rows dealt once."""

import random

import pytest

from strandwise.operators import strands as S
from strandwise.operators import transcripts as T
from strandwise.operators.segments import fits
from strandwise.plans.atlas import build_by_strand, build_final, build_prep

P = T.Parameters(max_edge=60, density_multiplier=1000, edge_scaling_factor=25, post_gene_distance=60, gene_margin=100, bin=100, block=None)
TAG, GENE = "run_id int, chr long, strand int, s long, e long", "id long, chr long, strand int, s long, e long"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    tags = [(rng.randrange(1, 4), rng.randrange(3), rng.randrange(2), s := rng.randrange(1500), s + rng.randrange(1, 40)) for _ in range(900)]
    tags += tags[:60]
    place = lambda i, none: (i, rng.randrange(3), rng.choice([0, 1, None] if none else [0, 1]), s := rng.randrange(1400), s + rng.choice([-5, 30, 90, 300]))
    runs = [(r, sum(t[0] == r for t in tags)) for r in (1, 2, 3)] + [(0, None)]
    genes, noncoding = ([place(i, none) for i in range(9)] for none in (False, True))
    return [spark.createDataFrame(*x) for x in ((tags, TAG), (genes, GENE), (noncoding, GENE), (runs, "id int, total_tags long"))]


def rows(df, *names):
    return sorted(tuple(f"{x:.10g}" if isinstance(x, float) else repr(x) for x in r) for r in df.select(*names).collect())


def test_an_atlas_by_strand_equals_one_by_single_steps(tables):
    tags, genes, noncoding, runs = tables
    mine, other = build_by_strand(*tables, P), build_final(*build_prep(tags, genes, P), genes, noncoding, runs, P)
    final = ["id", "chr", "strand", "s", "e", "refseq", "distal", "parent_id", "rpkm", "score", "standard_error"]
    assert {r[7] for r in rows(mine.transcripts, *final)} > {"None"}
    for name, columns in {"prep": ["id", "s", "e", "refseq", "n", "density", "edge"], "prep_sources": ["id", "chr", "run_id", "tag_count", "gaps"], "above": ["id"], "close": ["id", "max_end"],
                          "transcripts": final, "facts": ["id", "tags", "a", "b"], "sources": ["id", "run_id", "tag_count", "gaps"], "genes": ["transcript_id", "region_id", "relationship", "major"], "noncoding": ["transcript_id", "region_id"]}.items():
        assert rows(getattr(mine, name), *columns) == rows(getattr(other, name), *columns), name


def test_tags_are_dealt_once_on_the_way_to_stitched_transcripts(spark, tables):
    tags, genes = tables[:2]
    protos = T.proto_transcripts(S.flagged_tags(tags, genes), T.Parameters(block=None))
    plan = S.stitched_with_runs(protos, P)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("+- == Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_a_crowded_strand_does_not_fit(spark):
    df = spark.range(100).selectExpr("id % 9 as chr", "0 as strand")
    assert fits((df,), S.STRAND, 12) and not fits((df.limit(5), df), S.STRAND, 11)


def test_stitched_transcripts_are_dealt_once_on_the_way_to_drawn_ones(spark, tables):
    kept = spark.createDataFrame([(1, 1, 0, 5, 90, False, 1, 4.0)], "id long, chr long, strand int, s long, e long, refseq boolean, n long, density double")
    plan = T.draw_edges(S.close_transcripts(S.allowed_edge(kept, tables[1], P)), P)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("+- == Initial Plan")[0].count("Exchange") == 1


def test_a_circle_touches_four_squares_at_most_and_meets_each_start_once(spark):
    rng = random.Random(8)
    above = [(i, 1, 0, s := 40 * i + rng.randrange(9), s + rng.randrange(1, 30), False, rng.uniform(0, 90), rng.choice([0.0, 3.0, 16.0, 50.0, 400.0])) for i in range(150)]
    df = spark.createDataFrame(above, "id long, chr long, strand int, s long, e long, refseq boolean, density double, edge double")
    assert max(r[1] for r in S.squares(df).where("_kind = 1").groupBy("id").count().collect()) <= 4
    far = {a[0]: max([a[4]] + [b[4] for b in above if b[3] >= a[3] and b[4] > a[4] and (b[3] - a[4]) ** 2 + (b[6] - a[6]) ** 2 <= a[7] ** 2]) for a in above}
    assert {r.id: r.max_end for r in S.close_transcripts(df).collect()} == far and any(far[a[0]] > a[4] for a in above)
