"""Table, stage and document sinks. Every writer works partition by partition."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The file of a published folder that names its current version.
POINTER = "CURRENT"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()) -> str:
    """Write without an index column; CSV gets a header."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Materialise a hand-over table as Parquet and read it back: a short lineage that survives lost executors."""
    path = write_table(df, f"{folder.rstrip('/')}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_json_docs(df: DataFrame, path: str) -> str:
    """One JSON document per line."""
    df.write.mode("overwrite").json(path)
    return path


def publish_replace(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Replace everything published at ``path`` with ``df`` at once, and return what readers now see.

    The rows go to a version folder of their own. Only when they are complete a small pointer file is renamed over the old
    one, so a failed or half-written job leaves readers with the rows before it. The version before stays for readers that
    started earlier, all others go; one writer at a time.
    """
    spark, name = df.sparkSession, f"version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write_table(df, f"{path}/{name}", fmt, mode="error")
    hadoop, fs, root = spark._jvm.org.apache.hadoop.fs, *_file_system(spark, path)
    before, fresh = _pointed(spark, path), hadoop.Path(root, f"{POINTER}.{name}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(root.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, hadoop.Path(root, POINTER), over)
    for status in fs.listStatus(root):
        old = status.getPath().getName()
        if old.startswith("version-") and old not in (name, before):
            fs.delete(status.getPath(), True)
    return read_published(spark, path, df.schema, fmt)


def read_published(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The version that the pointer of ``path`` names; an error when nothing was published yet."""
    name = _pointed(spark, path)
    if name is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(f"{path}/{name}")


def _pointed(spark: SparkSession, path: str) -> str | None:
    fs, root = _file_system(spark, path)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(root, POINTER)
    if not fs.exists(pointer):
        return None
    held = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
    finally:
        held.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whichever file system it is; nothing happens when it is not there."""
    fs, root = _file_system(spark, path)
    fs.delete(root, True)


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(root)
