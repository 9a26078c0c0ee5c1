"""Interval tables made from the driver's tables, and the atlas over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.transcripts import Parameters
from ..plans.atlas import Atlas, build_atlas
from ..sources.shared import stored

#: A chromosome of the fixtures has 10,000 positions, so reaches are short.
PARAMETERS = Parameters(max_edge=60, density_multiplier=1000, edge_scaling_factor=25, post_gene_distance=60, bin=100, block=1000, split=None)

TAG_E = "(l_orderkey*37 + l_partkey*11) % 9800 + 20 + CAST(l_quantity AS BIGINT)"
#: Valid in Spark and DuckDB; later views read earlier ones.
VIEWS = {
    "chromosome": "SELECT s_suppkey + 1 AS id, concat('chr', CAST(s_suppkey AS STRING)) AS name, CAST(10000 AS BIGINT) AS length FROM supplier",
    "tag": f"""SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS run_id, l_suppkey + 1 AS chr,
      l_linenumber % 2 AS strand, (l_orderkey*37 + l_partkey*11) % 9800 AS s, {TAG_E} AS e FROM lineitem""",
    "run": """SELECT run_id AS id, concat('run_', CAST(run_id AS STRING)) AS source_table, count(*) AS total_tags FROM tag GROUP BY run_id
      UNION ALL SELECT 0, 'gene_regions', CAST(NULL AS BIGINT)""",
    "gene_region": """SELECT p_partkey AS id, concat(CASE p_partkey % 3 WHEN 0 THEN 'NM_' WHEN 1 THEN 'NR_' ELSE 'XX_' END, CAST(p_partkey AS STRING)) AS identifier,
      CASE p_partkey % 3 WHEN 0 THEN 'mRNA' WHEN 1 THEN 'RNA' END AS type, p_partkey % (SELECT count(*) FROM supplier) + 1 AS chr, p_size % 2 AS strand,
      (p_partkey*53) % 9000 AS s, (p_partkey*53) % 9000 + 50 + p_size*60 AS e FROM part WHERE p_size <= 10""",
    "noncoding": """SELECT c_custkey AS id, c_mktsegment AS type, c_name AS description, c_custkey % (SELECT count(*) FROM supplier) + 1 AS chr,
      CASE c_nationkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS strand, (c_custkey*71) % 9500 AS s, (c_custkey*71) % 9500 + 20 + c_nationkey AS e FROM customer""",
    "peak": """SELECT event_id AS id, event_id % (SELECT count(*) FROM supplier) + 1 AS chr, (event_id*101) % 9500 AS s, (event_id*101) % 9500 + 200 AS e,
      value AS tag_count FROM events WHERE event_type = 'purchase'""",
}
NEEDS = {"chromosome": ["supplier"], "tag": ["lineitem"], "run": ["lineitem"], "gene_region": ["part", "supplier"], "noncoding": ["customer", "supplier"], "peak": ["events", "supplier"]}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    with_tag = f"WITH tag AS ({VIEWS['tag']}) " if name == "run" else ""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in NEEDS[name]}
    for t in tables:
        sql, with_tag = (x.replace(f"FROM {t}", f"FROM {{{t}}}") for x in (sql, with_tag))
    return spark.sql(with_tag + sql, **tables)


def atlas(spark: SparkSession, sf_dir: str, p: Parameters = PARAMETERS) -> Atlas:
    return build_atlas(*(view(spark, sf_dir, x) for x in ("tag", "gene_region", "noncoding", "run")), p)


class KeptAtlas:
    """The tables of an atlas. Those that take joins beyond the final transcripts are stored when they are first asked for."""

    STORED = ("close", "genes", "noncoding")

    def __init__(self, made: Atlas) -> None:
        self._made = made

    def __getattr__(self, name: str) -> DataFrame:
        found = getattr(self._made, name)
        if name in self.STORED:
            found = stored(found, name)
            setattr(self, name, found)
        return found


_kept: dict[tuple[str, str], KeptAtlas] = {}


def kept_atlas(spark: SparkSession, sf_dir: str) -> KeptAtlas:
    """The atlas of a folder, built by the first query of an application and read from the shared folder by later ones."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _kept:
        _kept[key] = KeptAtlas(atlas(spark, sf_dir))
    return _kept[key]


def forget() -> None:
    """The next query builds its atlas anew."""
    _kept.clear()
