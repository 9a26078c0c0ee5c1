"""SQL functions and views of an atlas."""

import random

from strandwise.plans import views as V


def test_cells_meet_each_overlapping_pair_once(spark):
    rng = random.Random(11)
    draw = lambda n: [(i, rng.randrange(2), (s := rng.randrange(-3000, 300000)), s + rng.choice([0, 50, 900, 9000, 70000, 600000]) + rng.randrange(9)) for i in range(n)]
    left, right = draw(120), draw(150)
    odd = [(900, 0, None, 5), (901, 0, 9, 5), (902, None, 1, 5)]
    for name, rows in (("transcript", left + odd), ("peak", right + odd)):
        V.open_views({name: spark.createDataFrame(rows, "id long, chr int, s long, e long")}, "t_")
    met = spark.sql("SELECT l.id, r.id FROM t_transcript_cell l JOIN t_peak_cell r ON r.chr = l.chr AND r.cell = l.cell AND meets(l.s, l.e, r.s, r.e, l.cell)")
    want = sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3])
    assert sorted(map(tuple, met.collect())) == want


def test_cells_do_not_grow_with_length(spark):
    V.create_functions(spark)
    rows = spark.sql("SELECT size(left_cells(0, e)) + size(right_cells(0, e)) AS n FROM VALUES (10L), (10000L), (1000000L), (100000000L) v(e)").collect()
    assert max(r.n for r in rows) <= 2 * (9 + 2 * V.LEVELS)


def test_cells_up_to_a_length_are_few_and_meet_longer_intervals_too(spark):
    rng = random.Random(12)
    draw = lambda n: [(i, (s := rng.randrange(-9000, 40000)), s + rng.choice([50, 900, 9000, 70000])) for i in range(n)]
    left, right = draw(40), draw(50)
    tables = {name: spark.createDataFrame(rows, "id long, s long, e long").selectExpr("*", "1 as chr") for name, rows in (("transcript", left), ("peak", right))}
    V.open_views(tables, "u_", longest=10000)
    met = spark.sql("SELECT l.id, r.id FROM u_transcript_cell l JOIN u_peak_cell r ON r.chr = l.chr AND r.cell = l.cell AND meets(l.s, l.e, r.s, r.e, l.cell)")
    assert sorted(map(tuple, met.collect())) == sorted((a[0], b[0]) for a in left for b in right if a[1] <= b[2] and b[1] <= a[2])
    assert spark.sql("SELECT size(left_cells(10L, 90L)) + size(right_cells(10L, 90L))").first()[0] == 2 + 3
    V.create_functions(spark)
    assert spark.sql("SELECT size(left_cells(10L, 90L)) + size(right_cells(10L, 90L))").first()[0] == 6 + 7


def test_functions_are_inlined_and_sites_have_margins(spark):
    genes = spark.createDataFrame([(1, 1, 0, 5000, 9000), (2, 1, 1, 5000, 9000), (3, 1, None, None, None)], "id long, chr int, strand int, s long, e long")
    names = V.open_views({"gene_region": genes}, "g_", margin=100)
    assert set(names) == {"g_gene_region", "g_gene_region_cell", "g_gene_site_cell"}
    assert {tuple(r) for r in spark.sql("SELECT id, site_s, site_e FROM g_gene_region").collect()} == {(1, 4900, 5100), (2, 8900, 9100), (3, None, None)}
    plan = spark.sql("SELECT id FROM g_gene_region WHERE overlaps(s, e, 1, 6000)")._jdf.queryExecution().optimizedPlan().toString()
    assert "overlaps" not in plan and "<= 6000" in plan
    assert spark.sql("SELECT rpkm(1, 1000, 5, 1000000)").first()[0] == 5.0


def test_antisense_template(spark):
    """Regions of the other strand: met in the body, at the start, on the same strand, under a named transcript."""
    from strandwise.queries.templates import TEMPLATES

    t = [(i, 1, 1, s, s + 100, 5.0, None, False) for i, s in ((1, 6000), (2, 100), (3, 26000), (4, 6200))]
    V.open_views(
        {
            "transcript": spark.createDataFrame(t, "id long, chr int, strand int, s long, e long, score double, parent_id long, distal boolean"),
            "transcript_gene": spark.createDataFrame([(4, 7, True)], "transcript_id long, region_id long, major boolean"),
            "transcript_noncoding": spark.createDataFrame([], "transcript_id long, region_id long"),
            "gene_region": spark.createDataFrame([(7, 1, 0, 0, 9000), (8, 1, 1, 25000, 29000)], "id long, chr int, strand int, s long, e long"),
        }
    )
    counts = {name: spark.sql(TEMPLATES[name], args={"min_score": 1.0}).first().n for name in ("antisense", "antisense_gene", "parna", "unannotated")}
    assert counts == {"antisense": 1, "antisense_gene": 1, "parna": 1, "unannotated": 3}
