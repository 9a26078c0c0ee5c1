"""Text formats, with malformed lines."""

import pytest

from strandwise.sources import readers as R


@pytest.fixture()
def write(tmp_path):
    def put(name, *rows):
        path = tmp_path / name
        path.write_text("\n".join("\t".join(map(str, r)) for r in rows) + "\n")
        return str(path)

    return put


@pytest.fixture(scope="module")
def chromosomes(spark):
    return spark.createDataFrame([(1, "chr1", 1000), (2, "chrX", 500)], "id long, name string, length long")


def sam(flag, quality=30, pos=11):
    return ("q", flag, "chr1", pos, quality, "4M", "*", 0, 0, "ACGT", "IIII")


def test_sam(spark, write):
    path = write("a.sam", ("@HD", "VN:1"), sam(0), sam(4), sam(0x100), sam(0x10, 10, 21), sam(0, 9), sam(0x800), ("q", 0, "chr1"), sam("x"), ("",))
    assert sorted(map(tuple, R.read_tags(spark, path).collect())) == [("+", "chr1", 10, "ACGT"), ("+", "chr1", 10, "ACGT"), ("-", "chr1", 20, "ACGT")]
    assert R.sam_rejects(spark, path).count() == 2
    with pytest.raises(ValueError, match="SAM"):
        R.read_tags(spark, "a.bam")


def test_other_tags(spark, write):
    bowtie = write("a.bowtie", ("n", "-", "chr1", 5, "AC", "II", "x"), ("n", "-", "chr1", 5))
    four = write("a.txt", ("+", "chr2", 7, "ACG"), ("+", "chr2", "x", "ACG"))
    assert list(map(tuple, R.read_tags(spark, bowtie).collect())) == [("-", "chr1", 5, "AC")]
    assert list(map(tuple, R.read_tags(spark, four).collect())) == [("+", "chr2", 7, "ACG")]


def test_annotation(spark, write, tmp_path):
    gene = write("refGene.txt", (1, "NM_1", "chr1", "+", 10, 20, "x"))
    assert tuple(R.read_refgene(spark, gene).first()) == ("NM_1", "chr1", "+", 10, 20)
    bed = write("a.bed", ("chr1", 3, 9, "rna", 0, "-"))
    assert tuple(R.read_bed_regions(spark, bed).first()) == ("rna", "chr1", "-", 3, 9)
    assert R.read_bed_regions(spark, str(tmp_path / "none")).count() == 0
    summary = tmp_path / "s.csv"
    summary.write_text('ID,acc,Description,SO name,Organism,Xref,Length\n"r1",a,"one, two",x,"Mus musculus (mouse)",y,3\n"",a,b,x,Mus musculus,y,3\nr2,a,b,x,Homo sapiens,y,3\n')
    assert list(map(tuple, R.read_ncrna_summary(spark, str(summary), "Mus musculus").collect())) == [("r1", "one, two", "x", "y")]
    info = write("chromInfo.txt", ("chrX", 9, "p"), ("chr1_random", 5, "p"), ("chr1", 19, "p"))
    assert list(map(tuple, R.read_chromosomes(spark, info).collect())) == [(1, "chrX", 10), (2, "chr1", 20)]
    assert tuple(R.read_intervals(spark, write("g.bed", ("chr", "start", "end"), ("chr1", 1, 5, ".", ".", "+"))).first())[:4] == ("chr1", 1, 5, "+")


def test_peaks(spark, write, chromosomes):
    macs = R.read_macs(spark, write("m", ("chr", "start"), ("chr1", 1, 9, 8, 4, 2.5, 30.1, 7), ("chr_un", 1, 2, 1, 1, 1, 1, 1)), chromosomes).collect()
    assert [(r.chr, r.s, r.e, r.length, r.summit, float(r.tag_count)) for r in macs] == [(1, 1, 9, 8, 4, 2.5)]
    row = R.read_sicer(spark, write("s", ("chrX", 1, 9, 5, 2, "1.34e-12", 3, "0.5")), chromosomes).first()
    assert (row.chr, float(row.p_value), row.p_value_exp, float(row.fdr_threshold), row.fdr_threshold_exp) == (2, 1.34, -12, 0.5, 0)
    assert float(R.read_bed_peaks(spark, write("b", ("chr1", 1, 9, "n", 4.5)), chromosomes).first().score) == 4.5
    with pytest.raises(Exception, match="unknown chromosome"):
        R.read_bed_peaks(spark, write("b2", ("chr7", 1, 9, "n", 4.5)), chromosomes).collect()
    head = ("#PeakID", "chr", "start", "end", "strand", "Normalized Tag Count", "p-value vs Local", "Fold Change vs Local")
    row = R.read_homer(spark, write("h", ("# note",), head, ("p", "chr1", 2, 8, "-", 3.2, "1e-5", 2)), chromosomes).first()
    assert (row.strand, row.length, float(row.score), float(row.p_value), row.p_value_exp, float(row.fold_enrichment)) == (1, 6, 0.0, 1.0, -5, 2.0)


def test_counts_by_reason_come_from_the_scan_of_the_rows(spark, write, chromosomes):
    from pyspark.sql import Observation

    def counted(read):
        counts = Observation()
        rows = read(counts).count()
        return rows, {k: v for k, v in counts.get.items() if v}

    path = write("c.sam", ("@HD", "VN:1"), sam(0), sam(4), sam(0x100), sam(0, 9), ("q", 0, "chr1"), sam("x"))
    assert counted(lambda c: R.read_sam(spark, path, counts=c)) == (1, {"lines": 6, "malformed": 2, "unmapped": 1, "secondary": 1, "low_quality": 1})
    four = write("c.txt", ("+", "chr2", 7, "ACG"), ("+", "chr2", "x", "ACG"), ("+", "chr2"))
    assert counted(lambda c: R.read_tags(spark, four, counts=c)) == (1, {"lines": 3, "malformed": 1, "no_position": 1})
    macs = write("c.xls", ("chr", "start"), ("chr1", 1, 9, 8, 4, 2.5, 30.1, 7), ("chr9", 1, 2, 1, 1, 1, 1, 1), ("chr_un", 1, 2, 1, 1, 1, 1, 1))
    # The header's name has the form of a chromosome's but for what follows "chr".
    assert counted(lambda c: R.read_macs(spark, macs, chromosomes, c)) == (1, {"lines": 4, "other_name": 2, "unknown_chromosome": 1})
    peaks = write("c.bed", ("chr1", 1, 9, "n", 4.5), ("chr1", "x", 9, "n", 4.5))
    assert counted(lambda c: R.read_bed_peaks(spark, peaks, chromosomes, c)) == (1, {"lines": 2, "no_position": 1})


def test_interval_sets_of_a_grid(spark, write, tmp_path):
    from strandwise.operators import evaluation as E

    calls = lambda *rows: [("chr1", s, e, ".", ".", "+") for s, e in rows]
    write("calls_-100_5.bed", *calls((50, 150), (175, 250)))
    write("calls_-100_10.bed", ("chr", "start", "end"), *calls((90, 260)))
    write("calls_-300_5.bed", *calls((1, 2)))
    (tmp_path / "calls_-200_10.bed").write_text("")
    sets, expected = R.read_interval_sets(spark, f"{tmp_path}/calls_{{penalty}}_{{shape}}.bed", {"penalty": [-100, -200], "shape": [5, 10, 15]})
    assert sorted(map(tuple, sets.collect())) == [(-100, 5, "chr1", 50, 150, "+"), (-100, 5, "chr1", 175, 250, "+"), (-100, 10, "chr1", 90, 260, "+")]
    assert {tuple(r) for r in expected.where("found").collect()} == {(-100, 5, True), (-100, 10, True), (-200, 10, True)}
    reference = E.normalize_intervals(spark.createDataFrame([("chr1", 100, 200, "+")], "chr string, start long, end long, strand string"))
    matrix = E.grid_error_matrix(reference, E.normalize_intervals(sets, ["penalty", "shape"]), "shape", "penalty", [-100, -200], expected=expected)
    assert {r.shape: (r["-100"], r["-200"]) for r in matrix.collect()} == {5: (1.0, None), 10: (0.0, None), 15: (None, None)}
    nothing, _ = R.read_interval_sets(spark, f"{tmp_path}/none/{{a}}.bed", {"a": [1]})
    assert nothing.collect() == []
    with pytest.raises(ValueError, match="fields"):
        R.read_interval_sets(spark, "x/{a}.bed", {"b": [1]})
