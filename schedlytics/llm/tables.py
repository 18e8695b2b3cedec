"""Reading inputs, staging hand-over tables and Arrow batches shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from schedlytics.session import work_dir
from schedlytics.sources.sinks import stage

# Rows that one Arrow batch holds at most, and UTF-8 bytes that one working block holds (a longer text is a block of its own).
BATCH_ROWS = 1000
BLOCK_BYTES = 1 << 17


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the input folder; any path that Spark's readers can open."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker receives at once: the session's Arrow batches get ``BATCH_ROWS`` rows at most."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) <= 0 or int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def staged(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared work folder and read it back; a lost executor re-reads the files."""
    return stage(df, folder or work_dir(df.sparkSession), name)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove staged tables that nothing reads any more, in whichever file system the folder is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return memory that a Python worker no longer uses to the system: Spark keeps workers, and what they hold, between stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column without nulls (null: empty) as 64-bit offset strings."""
    return pc.fill_null(batch.column(name).cast(pa.large_string()), "")


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together hold about ``limit`` bytes."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)
