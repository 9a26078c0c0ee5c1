"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words in quality rules (a Java and RE2 character class body).
SPACE = r"\x20\x09-\x0D"

#: Bytes of one Arrow batch sent to a Python worker, so that long texts do not pile up in it.
ARROW_BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def body(column: str = "text") -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what ``spark.checkpoint.dir`` names. Only a local session, where one
    machine runs everything, gets a folder of its own when that is unset.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and (existing := sc._jsc.sc().getCheckpointDir()).isDefined():
        found = existing.get()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strandwise-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back.

    Later jobs then start from a table that survives the loss of executors,
    and nothing above it is computed twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key is heavy if it has over one row in so many; there are at most so many heavy keys.
HEAVY = 1000


def join_counted(rows: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """rows.join(counted, key), where counted has each key once, with its number of rows, n.

    Heavy keys, of which HEAVY bounds the number at any size of the input, are named to
    the driver: their rows stay where they are and meet a broadcast of these keys only.
    The others are shuffled. Both sides are read several times, so they should be
    written tables or cheap.
    """
    often = F.col("n") * HEAVY > rows.count()
    names = [r[0] for r in counted.where(often).select(key).collect()]
    if not names:
        return rows.join(counted.drop("n"), key)
    heavy = F.col(key).isin(names)
    rest = rows.where(~heavy).join(counted.where(~heavy).drop("n"), key)
    return rows.where(heavy).join(F.broadcast(counted.where(heavy).drop("n")), key).unionByName(rest)


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds; rows may be very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def where_computed(df: DataFrame, condition: str) -> DataFrame:
    """df.where(condition) for a condition on columns that took much to compute.

    The optimizer pushes filters below projections and writes the columns out in
    them, again and again where one builds on another. It leaves a filter in place
    that also needs a row number.
    """
    kept = df.withColumn("_row", F.monotonically_increasing_id()).where(f"({condition}) and _row >= 0")
    return kept.drop("_row")


def stand_ins(docs: DataFrame) -> tuple[DataFrame, int | None]:
    """docs with a doc_id of its own, above all others, for each row without one; and the lowest of these.

    Docs without such rows are returned as they are, with None. Others are
    written first, so that every reader sees the same numbers.
    """
    n, top = docs.agg(F.count_if(F.col("doc_id").isNull()), F.max("doc_id")).first()
    if not n:
        return docs, None
    first = max(0, -1 if top is None else top) + 1
    return materialize(docs.withColumn("doc_id", F.coalesce("doc_id", F.monotonically_increasing_id() + first)), "stand-ins"), first


def without_stand_ins(docs: DataFrame, first: int | None) -> DataFrame:
    return docs if first is None else docs.withColumn("doc_id", F.when(F.col("doc_id") < first, F.col("doc_id")))
