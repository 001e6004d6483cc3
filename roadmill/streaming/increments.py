"""Increments of staged entities: a stream of new rows brings a keyed table up to date, batch by batch.

The input appends extracts to a staging table; as a stream, each micro-batch of rows replaces those with the same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, by order."""
    by = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order))
    return rows.withColumn("__n", F.row_number().over(by)).where("__n = 1").drop("__n")


def apply_increments(stream: DataFrame, table: str, key: list[str], order: list[str], checkpoint: str) -> DataStreamWriter:
    """A writer that keeps `table`, a folder of Parquet versions, as the latest rows by key. Each batch writes the next
    version from the last one, so a batch that is run again writes the same version again. The first batch starts from
    nothing; a later one whose last version is gone fails, as its rows would be lost."""

    def batch(new: DataFrame, number: int) -> None:
        spark = new.sparkSession
        last = f"{table}/v{number - 1}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(last)
        there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        if number and not there:
            raise FileNotFoundError(f"{last}: the version before batch {number} is gone")
        rows = spark.read.parquet(last).unionByName(new) if there else new
        latest(rows, key, order).write.mode("overwrite").parquet(f"{table}/v{number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).outputMode("append")
