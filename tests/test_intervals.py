"""Segmentation against the row-by-row rule, and bin joins against the plain condition."""

import random

import pytest

from strandwise.operators.joins import having_overlap, overlap_pairs
from strandwise.operators.segments import segment


def fold(rows, max_gap):
    out, cur = [], None
    for s, e, flag in sorted(rows):
        if cur and cur["e"] + max_gap >= s and (cur["flag"] == flag or cur["e"] + 1 >= e):
            cur["gaps"] += s > cur["e"]
            cur["flag"] = flag if e > cur["e"] + 1 else cur["flag"]
            cur["e"] = max(cur["e"], e)
            cur["n"] += 1
        else:
            cur = {"s": max(cur["e"] + 1, s) if cur else s, "e": e, "flag": flag, "n": 1, "gaps": 0, "at": s}
            out.append(cur)
    return sorted((c["s"], c["e"], c["n"], c["gaps"]) for c in out)


@pytest.mark.parametrize(("gap", "block"), [(0, None), (5, None), (0, 13), (5, 40)])
def test_segments_equal_the_fold(spark, gap, block):
    rng = random.Random(gap * 100 + (block or 0))
    groups = {g: sorted({(s := rng.randrange(300), s + rng.randrange(1, 25)) for _ in range(rng.randrange(1, 40))}) for g in range(30)}
    rows = [(g, s, e, rng.random() < 0.4) for g, xs in groups.items() for s, e in xs]
    df = spark.createDataFrame([(*r, 1) for r in rows], "g int, s long, e long, refseq boolean, tag_count long")
    got = {}
    for r in segment(df, ["g"], gap, block=block).collect():
        got.setdefault(r.g, []).append((r.s, r.e, r.n, r.gaps))
    for g in groups:
        assert sorted(got[g]) == fold([r[1:] for r in rows if r[0] == g], gap)


def test_extended_tags_keep_their_order(spark):
    from strandwise.operators.transcripts import Parameters, proto_transcripts

    tags = spark.createDataFrame([(1, 1, 0, 10, 20, False, 1), (1, 1, 0, 30, 40, False, 2), (1, 1, 1, 90, 98, True, 1)], "run_id int, chr int, strand int, s long, e long, refseq boolean, tag_count long")
    chromosomes = spark.createDataFrame([(1, "chr1", 100)], "id int, name string, length long")
    with pytest.raises(ValueError, match="lengths"):
        proto_transcripts(tags, Parameters(tag_extension=10))
    for block in (None, 7):
        got = {(r.strand, r.s, r.e, r.tag_count) for r in proto_transcripts(tags, Parameters(tag_extension=10, block=block), chromosomes).collect()}
        assert got == {(0, 10, 50, 3), (1, 80, 98, 1)}


def test_rows_are_dealt_and_sorted_once(spark):
    from strandwise.operators.segments import numbered

    df = spark.range(1000).selectExpr("id % 7 as g", "id % 5 as _blk", "id as s", "id + 9 as e", "id % 3 = 0 as refseq", "1 as tag_count")
    df.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/dealt-once")
    plan = numbered(spark.read.parquet(path), ["g", "_blk"], 0, ("s", "e"))._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("+- == Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_a_tracks_files_in_order_are_the_track(spark, tmp_path):
    from strandwise.operators.analysis import write_bed

    rng = random.Random(6)
    rows = [(i, c := rng.randrange(1, 4), rng.randrange(2), s := rng.randrange(-5, 900), s + 200, 1 + rng.random()) for i in range(300)]
    t = spark.createDataFrame(rows, "id long, chr int, strand int, s long, e long, score double")
    chromosomes = spark.createDataFrame([(c, f"chr{c}", 1000) for c in (1, 2, 3)], "id int, name string, length long")
    write_bed(t, chromosomes, str(tmp_path / "bed"), "mine")
    for strand in (0, 1):
        lines = [x for f in sorted((tmp_path / "bed" / f"strand={strand}").glob("part-*")) for x in f.read_text().splitlines()]
        assert lines[0].startswith(f"track name=mine_{strand} ") and len(lines) == 1 + sum(r[2] == strand for r in rows)
        cells = [x.split("\t") for x in lines[1:]]
        assert [(c[0], int(c[3][11:])) for c in cells] == [(f"chr{r[1]}", r[0]) for r in sorted((r for r in rows if r[2] == strand), key=lambda r: (r[1], r[3], f"chr{r[1]}\t{max(r[3], 0)}\t{min(r[4], 1000)}\tTranscript_{r[0]}"))]
        assert all(0 <= int(c[1]) and int(c[2]) <= 1000 for c in cells)


def intervals(spark, rng, n, longest, start=100):
    rows = [(i, 1, s := rng.randrange(start), s + rng.randrange(1 << rng.randrange(longest))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, chr int, s long, e long")


@pytest.mark.parametrize(("width", "split"), [(1, None), (3, 2), (200, 7)])
def test_classes_of_length_and_split_cells_give_the_same_pairs(spark, width, split):
    rng = random.Random(width)
    (a, x), (b, y) = intervals(spark, rng, 90, 14, 4000), intervals(spark, rng, 80, 7, 4000)
    for (p, l), (q, r) in (((a, x), (b, y)), ((b, y), (a, x))):
        want = sorted((i[0], j[0]) for i in p for j in q if i[2] <= j[3] and j[2] <= i[3])
        assert sorted((z.l.id, z.r.id) for z in overlap_pairs(l, r, width=width, split=split).collect()) == want


def test_rows_of_an_interval_do_not_grow_with_its_length(spark):
    from pyspark.sql import functions as F

    from strandwise.operators.joins import CLASSES, SPAN, _class_of, cells_of

    df = spark.createDataFrame([(i, 3, 3 + 7**i) for i in range(12)], "id int, s long, e long").withColumn("_level", _class_of(F.col("e") - F.col("s") + 1, 10))
    for own in (0, 1):
        most = max(r[1] for r in cells_of(df, df, 10, own).groupBy("id").count().collect())
        assert most <= SPAN + 1 + 2 * CLASSES
    levels = {r.id: r._level for r in df.collect()}
    assert levels[0] == 0 and levels[11] == 9 and list(levels.values()) == sorted(levels.values())


def test_a_bin_with_a_tenth_of_all_rows_is_split(spark):
    from pyspark.sql import functions as F

    from strandwise.operators.joins import crowded

    rows = spark.range(2000).select(F.when(F.col("id") < 200, 5).otherwise(F.col("id")).alias("bin"))
    got = crowded(rows, rows.where("bin > 5"), ["bin"], 50).collect()
    assert [tuple(r) for r in got] == [(5, 4, 1)]


def test_points_in_circles_equal_the_plain_condition(spark):
    from strandwise.operators.joins import circle_pairs

    rng = random.Random(9)
    circles = [(i, i % 2, rng.randrange(-300, 300), rng.uniform(-50, 50), rng.choice([0.0, 0.5, 3.0, 16.0, 40.0, 300.0, None, -1.0])) for i in range(120)]
    points = [(i, i % 2, rng.randrange(-300, 300), rng.uniform(-50, 50)) for i in range(200)] + [(500 + c[0], c[1], c[2], c[3]) for c in circles[:40]]
    want = sorted((c[0], p[0]) for c in circles for p in points if c[1] == p[1] and c[4] is not None and c[4] >= 0 and (p[2] - c[2]) ** 2 + (p[3] - c[3]) ** 2 <= c[4] ** 2)
    x = spark.createDataFrame(circles, "id int, chr int, x long, y double, radius double")
    y = spark.createDataFrame(points, "id int, chr int, x long, y double")
    for least in (0.5, 16.0, 1000.0):
        assert sorted((r.l.id, r.r.id) for r in circle_pairs(x, y, least=least).collect()) == want


def test_a_dense_locus_compares_near_densities_only(spark):
    """What the grid compares stays within a constant of the true pairs where all positions are near each other."""
    from strandwise.operators.joins import circle_pairs, near_points

    df = spark.range(2000).selectExpr("id", "1 as chr", "id % 50 as x", "double(id) as y", "double(20) as radius")
    true, compared = circle_pairs(df, df.drop("radius")).count(), near_points(df, df.drop("radius"), ("chr",), 16.0).count()
    assert true <= compared <= 12 * true and 20 * compared < 2000 * 2000


@pytest.mark.parametrize("width", [1, 7, 100, 5000])
def test_overlap_join_equals_the_plain_condition(spark, width):
    rng = random.Random(width)
    make = lambda n: [(i, rng.randrange(2), s := rng.randrange(-50, 400), s + rng.randrange(0, 120)) for i in range(n)]
    a, b = make(60), make(60)
    schema = "id int, chr int, s long, e long"
    x, y = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] == q[1] and p[2] <= q[3] and q[2] <= p[3])
    got = sorted((r.l.id, r.r.id) for r in overlap_pairs(x, y, width=width).collect())
    assert got == want
    assert {r.id for r in having_overlap(x, y, how="left_anti", width=width).collect()} == {p[0] for p in a} - {i for i, _ in want}


def test_only_few_stretches_are_sent_to_all_tasks(spark):
    """A query of evaluation sends up to sixteen tables of stretches through the driver, so one has to be small."""
    from strandwise.operators.segments import sent

    rows = spark.range(30_000).selectExpr("id as chr", "id as _blk")
    hinted = lambda df: "Hint" in df._jdf.queryExecution().logical().toString()
    assert hinted(sent(rows.where("chr < 10"))) and not hinted(sent(rows))
