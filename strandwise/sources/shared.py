"""Tables and small files in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; a local session without it gets a folder of its own."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and (known := context._jsc.sc().getCheckpointDir()).isDefined():
        found = known.get()
    if not found:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="atlas-"))
        found = context._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


#: Folders of tables that are only steps on the way, of each ``transient`` block that is open.
_open: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _open:
        _open[-1].append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df once and read it back, so that several later steps share it and lost executors do not repeat it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_text(lines: DataFrame, name: str) -> str:
    """The path of a folder of text files with the lines (value)."""
    path = scratch(lines.sparkSession, name)
    lines.write.text(path)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """The path for the JVM's file system calls, and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; one that is not there is no error."""
    found, fs = hadoop_path(spark, path)
    fs.delete(found, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of files and folders in a folder; none if it is not there."""
    found, fs = hadoop_path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(found)) if fs.exists(found) else []


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole under a name that must be new; False if somebody else has it.

    The text goes to a file of its own first, and one rename, which no file system
    does by halves, gives it the name.
    """
    own, fs = hadoop_path(spark, f"{path}.{uuid.uuid4().hex[:12]}")
    out = fs.create(own, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    target, _ = hadoop_path(spark, path)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(kinds, 1)
    none[0] = kinds.NONE
    try:
        context.rename(own, target, none)
    except Exception:
        if not fs.exists(target):
            raise
        fs.delete(own, False)
        return False
    return True


@contextmanager
def transient(spark: SparkSession):
    """Tables that are stored within the block are deleted at its end; what it makes for later has to be written elsewhere."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            delete(spark, path)


def _address(qualified) -> str:
    """A path as ``_metadata.file_path`` has it, with one slash after the scheme."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", qualified.toUri().toString())


def address(spark: SparkSession, path: str) -> str:
    """What tells a file or folder from all others."""
    found, fs = hadoop_path(spark, path)
    return _address(fs.makeQualified(found))


def paths_like(spark: SparkSession, pattern: str) -> set[str]:
    """Addresses of the files and folders that a pattern with asterisks matches."""
    found, fs = hadoop_path(spark, pattern)
    return {_address(x.getPath()) for x in fs.globStatus(found) or ()}
