"""Stored atlases: runs added once, states that break off, readers that keep theirs, ranges of positions."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strandwise.operators.transcripts import Parameters
from strandwise.plans import store as S
from strandwise.plans.atlas import build_atlas, build_final

P = Parameters(max_edge=30, density_multiplier=1000, edge_scaling_factor=25, min_one_run_tags=2, post_gene_distance=40, gene_margin=50, bin=20, block=50, split=None)
TAG = "run_id int, chr long, strand int, s long, e long, refseq boolean, tag_count long"
REGION = "id long, chr long, strand int, s long, e long"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    rows = [(1 + i % 2, c, i % 2, s := rng.randrange(300), s + rng.randrange(1, 30)) for i in range(80) for c in (1, 2, 3)]
    rows += [(3, c, 0, s := rng.randrange(400), s + 20) for c in (2, 4) for _ in range(25)]
    genes = spark.createDataFrame([(i, 1 + i % 4, i % 2, s := rng.randrange(300), s + rng.randrange(20, 90)) for i in range(16)], REGION)
    noncoding = spark.createDataFrame([(i, 1 + i % 4, None, s := rng.randrange(300), s + 15) for i in range(12)], REGION)
    from strandwise.operators import transcripts as T

    tags = spark.createDataFrame(rows, "run_id int, chr long, strand int, s long, e long")
    flagged = T.flag_refseq(T.collapse_tags(tags), genes, P.bin).select(*[c.split()[0] for c in TAG.split(", ")])
    return tags, spark.createDataFrame(flagged.collect(), TAG), genes, noncoding


def run_rows(tags):
    runs = tags.groupBy(F.col("run_id").alias("id")).agg(F.count("*").alias("total_tags"))
    return runs.unionByName(tags.sparkSession.createDataFrame([(0, None)], "id int, total_tags long"))


def rows(df):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def full(tables):
    """The atlas of all runs, built from all tags at once."""
    tags, _, genes, noncoding = tables
    return build_atlas(tags, genes, noncoding, run_rows(tags), P)


def test_runs_are_added_once_or_not_at_all(spark, tables, full, tmp_path, monkeypatch):
    _, flagged, genes, noncoding = tables
    store = S.AtlasStore(spark, str(tmp_path / "atlas"))
    add = lambda which: S.add_runs(store, flagged.where(which), P, genes, noncoding)
    add("run_id < 3")
    first, pinned = store.manifest(), store.pinned()
    before = rows(pinned.transcripts())
    # A writer breaks off after its first write, or at the rename itself: the old state stands.
    writes, put = S.AtlasStore.write, S.put_new

    def lost(*args, **kw):
        raise OSError("lost")

    def write(self, *args, **kw):
        writes(self, *args, **kw)
        lost()

    for where, what in ((S.AtlasStore, {"write": write}), (S, {"put_new": lost})):
        for name, instead in what.items():
            monkeypatch.setattr(where, name, instead)
        with pytest.raises(OSError, match="lost"):
            add("run_id = 3")
        monkeypatch.setattr(S.AtlasStore, "write", writes)
        monkeypatch.setattr(S, "put_new", put)
        assert store.manifest() == first
    # Run 2 is there already, and all runs are after it: they are not added again.
    add("run_id >= 2")
    again = store.manifest()
    add("run_id > 0")
    assert store.manifest() == again and again.number == first.number + 1 and set(again.runs) == {"1", "2", "3"}
    # Only chromosomes 2 and 4, which run 3 touches, have new folders.
    for name in ("prep", "prep_sources", "final.facts"):
        assert {c for c in again.tables[name] if again.tables[name][c] != first.tables[name].get(c)} == {"2", "4"}
    # A reader that began before keeps its state, scores included.
    assert rows(pinned.transcripts()) == before

    def same():
        assert rows(store.transcripts()) == rows(full.transcripts) != before
        for name in ("sources", "genes", "noncoding"):
            want = getattr(full, name)
            assert rows(store.read(f"final.{name}").select(*want.columns)) == rows(want)

    same()
    with pytest.raises(ValueError, match="runs 3 have"):
        add("run_id = 3 and s > 100")
    folders = lambda: sum(len(list(t.iterdir())) for t in (tmp_path / "atlas" / "data").iterdir())
    many = folders()
    store.clean()
    assert folders() < many and store.numbers() == [again.number]
    same()


def test_two_writers_of_one_state(spark, tables, tmp_path):
    store = S.AtlasStore(spark, str(tmp_path / "atlas"))
    state = store.manifest()
    store.commit(state)
    with pytest.raises(S.Conflict):
        store.commit(state)
    assert store.numbers() == [1]


def test_sets_with_other_parameters_stand_side_by_side(spark, tables, full, tmp_path):
    tags, _, genes, noncoding = tables
    store = S.AtlasStore(spark, str(tmp_path / "atlas"))
    S.save_atlas(store, full, run_rows(tags), P)
    stricter = replace(P, min_one_run_tags=4, max_edge=5)
    S.rebuild_final(store, genes, noncoding, stricter, "strict")
    assert rows(store.transcripts()) == rows(full.transcripts)
    strict = rows(store.transcripts("strict"))
    assert strict == rows(build_final(full.prep, full.prep_sources, genes, noncoding, run_rows(tags), stricter).transcripts) != rows(full.transcripts)


def test_a_range_opens_few_row_groups(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(S, "GROUP_BYTES", 20_000)
    df = spark.range(60_000).selectExpr("id", "1L as chr", "id * 3 as s", "id * 3 + 5 + id % 7 as e")
    store = S.AtlasStore(spark, str(tmp_path / "atlas"))
    store.commit(store.write(store.manifest(), "prep", df))
    found = store.read_range("prep", 1, 90_000, 90_200)
    want = df.where("s <= 90200 and e >= 90000")
    assert rows(found) == rows(want) and "PushedFilters: [IsNotNull(s)" in found._jdf.queryExecution().executedPlan().toString()
    longest = store.manifest().longest["prep"]
    groups = [g.column(i).statistics for f in (tmp_path / "atlas" / "data" / "prep").rglob("*.parquet") for m in [pq.ParquetFile(f).metadata] for g in map(m.row_group, range(m.num_row_groups)) for i in range(g.num_columns) if g.column(i).path_in_schema == "s"]
    opened = sum(x.min <= 90_200 and x.max >= 90_000 - longest for x in groups)
    assert len(groups) >= 8 and opened <= 2
    assert store.read_range("prep", 2, 0, 10).count() == 0


def test_files_of_one_name_are_written_once(spark, tmp_path):
    from strandwise.sources.shared import names_in, put_new

    path = str(tmp_path / "m" / "1.json")
    assert put_new(spark, path, "é1") and not put_new(spark, path, "2")
    assert (tmp_path / "m" / "1.json").read_text() == "é1" and [n for n in names_in(spark, str(tmp_path / "m")) if not n.startswith(".")] == ["1.json"]


def test_folders_do_not_grow_with_chromosomes(spark, tmp_path):
    """Fixed parts hold any number of chromosomes; a range of one of them has no rows of another in its part."""
    df = spark.range(6_000).selectExpr("id", "id % 300 as chr", "id as s", "id + 4 as e")
    store = S.AtlasStore(spark, str(tmp_path / "atlas"))
    state = store.commit(store.write(store.manifest(), "prep", df))
    [folder] = (tmp_path / "atlas" / "data" / "prep").iterdir()
    assert len(list(folder.glob("_part=*"))) == len(state.tables["prep"]) == S.PARTS
    assert rows(store.read("prep")) == rows(df)
    assert rows(store.read_range("prep", 33, 1_000, 4_000)) == rows(df.where("chr = 33 and s <= 4000 and e >= 1000"))
    # Parts that are replaced keep none of their rows, the others all.
    again = store.commit(store.write(state, "prep", df.where("chr = 33"), parts={"1"}))
    assert rows(store.read("prep", again)) == rows(df.where("chr % 32 <> 1 or chr = 33"))


def test_a_layout_of_earlier_versions_is_told(spark, tmp_path):
    from strandwise.sources.shared import put_new

    put_new(spark, str(tmp_path / "manifests" / "00000001.json"), '{"number": 1}')
    with pytest.raises(ValueError, match="save its atlas anew"):
        S.AtlasStore(spark, str(tmp_path)).manifest()
