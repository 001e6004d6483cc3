"""Shared folder, scratch tables and expressions used by the operators of this folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that word contracts name: space, tab, LF, VT, FF, CR.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONG_MAX = 2**63 - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset, a
    temporary folder on a local master and the warehouse on any other."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.startswith("local"):
            found = tempfile.mkdtemp(prefix="roadmill-")
        else:
            found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_written: list[tuple[str, str]] = []
#: Rows and bytes of whole texts that go to a Python worker at once.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


@contextmanager
def small_batches(spark: SparkSession):
    """Actions inside send few rows and bytes to a Python worker at once, as long texts need."""
    before = {k: spark.conf.get(k) for k in _BATCHES}
    try:
        for k, v in _BATCHES.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def scratch(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df written to the shared folder and read back. It cuts lineage, fixes row numbers as data, and
    gives the planner the true size. A table with a path of its own is no scratch table: `sweep` leaves it."""
    spark, at = df.sparkSession, path or f"{shared_dir(df.sparkSession)}/scratch/{uuid.uuid4().hex}-{name}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(at)
    if not path:
        _written.append((spark.sparkContext.applicationId, at))
    return spark.read.schema(df.schema).parquet(at)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def sweep(spark: SparkSession) -> None:
    """Deletes this application's scratch tables. Call it only when every result that was made from them
    has been written elsewhere."""
    for item in [x for x in _written if x[0] == spark.sparkContext.applicationId]:
        remove(spark, item[1])
        _written.remove(item)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


_user: tuple[str, Callable[[], object]] | None = None


def use_worker(name: str, clear: Callable[[], object]) -> None:
    """Called by a function that starts in a Python worker: what another operator has cached in it is cleared."""
    global _user
    if _user and _user[0] != name:
        _user[1]()
        gc.collect()
    _user = name, clear


def pieces(batch, *columns: str, rows: int = 256):
    """Lists of a record batch's columns, a few rows at a time, so that few texts are Python objects at once."""
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        yield tuple(part.column(c).to_pylist() for c in columns)
