"""Broken and run-together intervals: fixed layouts, and random ones against a plain loop."""

import random

import pytest

from strandwise.operators import evaluation as E

GENES = [("chr1", 100, 200, "+"), ("chr1", 300, 500, "+"), ("chr1", 600, 700, "-"), ("chr1", 600, 800, "-"), ("chr2", 300, 500, "+")]
SCHEMA = "chr string, start long, end long, strand string"

CASES = [
    ([("chr1", 800, 900, "+")], 0, 0),
    ([("chr1", 50, 150, "+")], 0, 0),
    ([("chr1", 125, 175, "+")], 0, 0),
    ([("chr1", 50, 150, "-"), ("chr1", 175, 250, "-")], 0, 0),
    ([("chr2", 50, 150, "+"), ("chr2", 175, 250, "+")], 0, 0),
    ([("chr1", 50, 150, "+"), ("chr1", 175, 250, "+")], 1, 0),
    ([("chr1", 50, 125, "+"), ("chr1", 130, 150, "+"), ("chr1", 175, 250, "+")], 1, 0),
    ([("chr1", 50, 100, "+"), ("chr1", 200, 250, "+")], 1, 0),
    ([("chr1", 150, 350, "+")], 0, 1),
    ([("chr1", 550, 650, "-"), ("chr1", 675, 850, "-")], 2, 0),
]


@pytest.mark.parametrize("target,broken,together", CASES)
def test_layouts(spark, target, broken, together):
    ref, got = (E.normalize_intervals(spark.createDataFrame(x, SCHEMA)) for x in (GENES, target))
    assert (E.count_broken(ref, got, block=None).first().n, E.count_run_together(ref, got, block=None).first().n) == (broken, together)


def test_random_layouts_equal_a_loop(spark):
    rng = random.Random(4)
    draw = lambda n: [(k, (s := rng.randrange(120)), s + rng.randrange(1, 30)) for k in range(60) for _ in range(rng.randrange(n))]
    whole, parts = draw(5), draw(7)
    want = dict.fromkeys(range(60), 0)
    for k, s, e in whole:
        b = sorted(x[1:] for x in parts if x[0] == k)
        f = next((i for i, x in enumerate(b) if x[1] >= s), None)
        last = max((i for i, x in enumerate(b) if x[0] <= e), default=None)
        want[k] += f is not None and last is not None and f != last and b[f][1] <= e and b[last][0] >= s
    df = [spark.createDataFrame([(f"chr{k}", s, e, "+") for k, s, e in x], SCHEMA) for x in (whole, parts)]
    for block in (7, None):
        rows = E.broken_intervals(*(E.normalize_intervals(x) for x in df), block=block).groupBy("chr").sum("n").collect()
        assert {int(r[0][3:]): r[1] for r in rows} == {k: n for k, n in want.items() if n}


def test_errors_by_key_equal_those_by_stretches(spark, monkeypatch):
    rng = random.Random(8)
    draw = lambda n, sets: [(rng.randrange(sets), f"chr{rng.randrange(5)}", rng.randrange(2), s := rng.randrange(150), s + rng.randrange(-1, 30)) for _ in range(n)]
    schema = "set int, chr string, strand int, s long, e long"
    ref, got = spark.createDataFrame(draw(70, 1), schema).drop("set"), spark.createDataFrame(draw(240, 3) + [(1, None, 0, 1, 5), (2, "chr1", None, 1, 5)], schema)
    one = {tuple(r) for r in E.summed_error(ref, got, ["set"], 50).collect()}
    plan = E._errors_by_key(ref.crossJoin(got.select("set").distinct()), got, ["set"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    monkeypatch.setattr(E, "fits", lambda *_: False)
    assert len(one) == 3 and all(e > 0 for _, e in one) and one == {tuple(r) for r in E.summed_error(ref, got, ["set"], 50).collect()}


def test_names_without_prefix_raise(spark):
    with pytest.raises(Exception, match="chromosome"):
        E.normalize_intervals(spark.createDataFrame([("1", 1, 2, "+")], SCHEMA)).collect()
