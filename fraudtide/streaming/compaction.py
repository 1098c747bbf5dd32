"""Fewer, larger files out of a stream: bounded per batch, then per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fraudtide.operators.clustering import clustered

FILE = "_metadata.file_path"


def batch_writer(df: DataFrame, target: str, columns: list[str], files: int) -> DataStreamWriter:
    """Write each batch to its own folder ``batch=<id>`` in at most ``files`` files, clustered by ``columns``.

    A batch that is run again replaces its own folder, so repeats add nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = clustered(batch, columns, files)
        rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={batch_id}")

    return df.writeStream.outputMode("append").foreachBatch(write)


def compact(spark: SparkSession, source: str, target: str, day: Column, columns: list[str], files: int = 1) -> None:
    """Rewrite a table by day, every day in at most ``files`` files sorted by ``columns``.

    Only the days that ``source`` has are replaced in ``target``, by what it has of them: running it again
    changes nothing. A day is dealt to ``files`` tasks by a hash of its rows, so a busy day can have more.
    """
    rows = spark.read.parquet(source)
    names = [c for c in rows.columns if c != "batch"]
    dealt = F.pmod(F.xxhash64(*names), F.lit(files)).alias("_file")
    days = rows.select(*names, day.alias("day"), dealt)
    spread = days.repartition("day", "_file").sortWithinPartitions("day", "_file", *columns).drop("_file")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(target)


def files_by_day(spark: SparkSession, target: str) -> DataFrame:
    """``day, files, rows`` of a table partitioned by day."""
    rows = spark.read.parquet(target).select("day", F.col(FILE).alias("file"))
    each = rows.groupBy("day", "file").agg(F.count("*").alias("n"))
    return each.groupBy("day").agg(F.count("*").alias("files"), F.sum("n").alias("rows"))
