"""An atlas as session views, with SQL functions that the optimizer inlines.

``open_views`` names the tables of an atlas in the session; ``open_store`` does so for a final
set of a store, pinned to one state, so that a later commit changes no query under way.
Overlap in SQL is an equality of cells: ``left_cells`` of one side and ``right_cells`` of
the other, exploded, meet where intervals may overlap, and ``meets`` tells whether they do,
each pair in one cell only. Without cells, a join on overlap would compare all
intervals of a chromosome with each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BIN
from .store import AtlasStore, Manifest, run_table

#: Classes of length in cells, each eight times the one before it; the last takes everything longer.
LEVELS = 6
CELL = "STRUCT<tag INT, size BIGINT, bin BIGINT>"


def levels_up_to(longest: int | None) -> int:
    """Classes that intervals of up to that many positions have."""
    found = LEVELS if longest is None else 1
    while found < LEVELS and longest > BIN * 8**found:
        found += 1
    return found


def _cells(own_tag: int, levels: int) -> str:
    """Cells of [s, e]: in its own class under one tag, in each longer class under the other.

    Under tag 0 the left interval is of the longer or equal class, under tag 1 the right
    one is of the longer, so under either tag one side has only its own class. Classes are written
    out one by one, and one or two cells without a lambda, as those are evaluated without generated code.
    """
    fits = lambda k: f"e - s + 1 <= {BIN * 8 ** (k + 1)}L" if k < levels - 1 else "TRUE"

    def at(k: int, tag: int) -> str:
        size = BIN * 8**k
        first, last = (f"(({x} - pmod({x}, {size}L)) div {size}L)" for x in "se")
        cell = lambda b: f"struct({tag} AS tag, {size}L AS size, {b} AS bin)"
        return f"CASE {last} - {first} WHEN 0L THEN array({cell(first)}) WHEN 1L THEN array({cell(first)}, {cell(last)}) ELSE transform(sequence({first}, {last}), b -> {cell('b')}) END"

    own = " ".join(f"WHEN {fits(k)} THEN {at(k, own_tag)}" for k in range(levels))
    longer = [(k, "FALSE" if k == 0 else fits(k - 1)) if own_tag == 0 else (k, fits(k)) for k in range(levels)]
    parts = [f"CASE {own} END", *[f"CASE WHEN {c} THEN {at(k, 1 - own_tag)} ELSE CAST(array() AS ARRAY<{CELL}>) END" for k, c in longer if c != "FALSE"]]
    return f"CASE WHEN s <= e THEN concat({', '.join(parts)}) END"


#: Functions of the session: their arguments, what they return, and the expression.
FUNCTIONS = {
    "overlaps": ("s1 BIGINT, e1 BIGINT, s2 BIGINT, e2 BIGINT", "BOOLEAN", "s1 <= e2 AND s2 <= e1"),
    "contains_interval": ("s1 BIGINT, e1 BIGINT, s2 BIGINT, e2 BIGINT", "BOOLEAN", "s1 <= s2 AND e2 <= e1"),
    "bases": ("s BIGINT, e BIGINT", "BIGINT", "e - s + 1"),
    "site": ("strand INT, s BIGINT, e BIGINT", "BIGINT", "CASE WHEN strand = 0 THEN s ELSE e END"),
    "rpkm": ("s BIGINT, e BIGINT, tags BIGINT, total BIGINT", "DOUBLE", "tags / ((e - s + 1) / CAST(1000 AS DOUBLE)) / (total / CAST(1000000 AS DOUBLE))"),
    "meets": (f"s1 BIGINT, e1 BIGINT, s2 BIGINT, e2 BIGINT, cell {CELL}", "BOOLEAN", "s1 <= e2 AND s2 <= e1 AND cell.bin = (greatest(s1, s2) - pmod(greatest(s1, s2), cell.size)) div cell.size"),
}


def create_functions(spark: SparkSession, levels: int = LEVELS) -> None:
    """The functions, in place of functions of the session of the same names; cells in so many classes of length."""
    cells = {name: ("s BIGINT, e BIGINT", f"ARRAY<{CELL}>", _cells(tag, levels)) for tag, name in enumerate(("left_cells", "right_cells"))}
    for name, (arguments, kind, body) in (FUNCTIONS | cells).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")


def with_cells(rows: DataFrame, function: str, s: str = "s", e: str = "e") -> DataFrame:
    """rows with a line for each of its cells; rows with a null end or with e < s have none."""
    # A plain explode has its array made once more for a filter on its size.
    rows = rows.withColumn("_cells", F.call_function(function, F.col(s).cast("long"), F.col(e).cast("long")))
    return rows.withColumn("cell", F.explode_outer("_cells")).drop("_cells").where("cell is not null")


def open_views(tables: dict[str, DataFrame], prefix: str = "", margin: int = 1000, longest: int | None = None) -> list[str]:
    """Name the tables as views of their session, and give the names.

    ``tables`` may have transcript, transcript_source, transcript_gene, transcript_noncoding,
    gene_region, noncoding_region, run, chromosome and others with chr, s and e. Genes get
    site_s and site_e, a margin about the start of transcription. Each table with intervals has a
    view <name>_cell for the right side of an overlap join; transcripts have theirs for the left
    side, and gene sites one as gene_site_cell. With a prefix several atlases can be open together.

    Where hardly an interval is longer than ``longest``, cells of longer classes are left out; results stay right, but
    longer intervals then have more cells. What is joined by cells has to be opened, and its functions made, with one ``longest``.
    """
    spark = next(iter(tables.values())).sparkSession
    create_functions(spark, levels_up_to(longest))
    views = dict(tables)
    if "gene_region" in views:
        site = F.call_function("site", F.col("strand").cast("int"), F.col("s").cast("long"), F.col("e").cast("long"))
        views["gene_region"] = views["gene_region"].withColumn("_site", site).withColumns({"site_s": F.col("_site") - margin, "site_e": F.col("_site") + margin}).drop("_site")
        views["gene_site_cell"] = with_cells(views["gene_region"], "right_cells", "site_s", "site_e")
    for name, df in tables.items():
        if {"chr", "s", "e"} <= set(df.columns):
            views[f"{name}_cell"] = with_cells(views[name], "left_cells" if name == "transcript" else "right_cells")
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]


def open_store(store: AtlasStore, genes: DataFrame, noncoding: DataFrame, runs: DataFrame | None = None, key: str = "final", prefix: str = "", margin: int = 1000, more: dict[str, DataFrame] | None = None) -> Manifest:
    """Views of a final set as it is now; the state that they stay with."""
    state = store.manifest()
    own = {
        "transcript": store.transcripts(key, state),
        "transcript_source": store.read(f"{key}.sources", state),
        "transcript_gene": store.read(f"{key}.genes", state),
        "transcript_noncoding": store.read(f"{key}.noncoding", state),
        "gene_region": genes,
        "noncoding_region": noncoding,
        "run": run_table(store, state) if runs is None else runs,
    }
    open_views(own | (more or {}), prefix, margin)
    return state
