"""Some registered queries against their SQL in another engine, at the smallest size."""

import os

import pytest

from strandwise.queries import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["proto_transcripts_gap", "stitch_transcripts", "allowed_edge", "atlas_pipeline", "q_antisense_gene", "q_distal_no_peak", "compare_sets", "read_sam", "normalize_tags_flipped", "peaks_sicer", "grid_error_matrix", "sequence_identifiers", "bed_rows", "proto_transcripts_extended", "cluster_lineage", "incremental_stitch", "rebuilt_final", "bed_track", "noncoding_regions", "refseq_transcripts", "grid_best_setting", "run_registry", "sql_antisense_gene", "grid_from_files", "line_counts", "read_tags_by_suffix", "sql_distal_no_peak", "sql_fold_change"])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in ("customer", "supplier", "part", "lineitem", "events"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    want = sorted(repr(tuple(dict(zip(names, row))[c] for c in sorted(names))) for row in found.fetchall())
    df = registry.queries()[name](spark, DATA)
    assert sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect()) == want


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_a_query_of_the_kept_atlas_stores_only_what_it_reads(spark):
    from strandwise.queries import fixtures

    fixtures.forget()
    registry.queries()["q_totals"](spark, DATA)
    assert not {"close", "genes", "noncoding"} & set(vars(fixtures.kept_atlas(spark, DATA)))
    registry.queries()["sql_expressed_genes"](spark, DATA)
    assert {"close", "genes", "noncoding"} & set(vars(fixtures.kept_atlas(spark, DATA))) == {"genes"}
