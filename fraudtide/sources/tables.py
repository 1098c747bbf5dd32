"""Batch scans and writes. Paths and formats are arguments, so S3A or HDFS need no change."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fraudtide.schemas import RAW_TRANSACTION

log = logging.getLogger(__name__)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str = RAW_TRANSACTION) -> DataFrame:
    """Read headed CSV with a fixed schema; fields that do not parse become null.

    Columns go by their names in the header, in whatever order and case it has them; what the schema
    lacks is left out and what the header lacks is null. Files whose headers differ are an error.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name.lower(): f for f in schema.fields}
    read = StructType([StructField(h, known[h.lower()].dataType if h.lower() in known else StringType()) for h in header])
    rows = spark.read.schema(read).option("header", True).option("enforceSchema", False).csv(path)
    there = {h.lower(): h for h in header}
    return rows.select(
        *[
            (rows[f"`{there[f.name.lower()]}`"] if f.name.lower() in there else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write headed CSV part files, one folder per value of ``by``."""
    writer = df.write.option("header", True).mode(mode)
    (writer.partitionBy(*by) if by else writer).csv(path)


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    by: list[str] | None = None,
) -> None:
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*by) if by else writer).save(path)


def scan_first_available(
    spark: SparkSession, candidates: Iterable[tuple[str, str]]
) -> DataFrame | None:
    """Return the first ``(format, path)`` that can be read and holds a row, else None.

    An unreadable or empty candidate is passed over with a warning. Emptiness is probed with a one-row
    job, never with a count.
    """
    for fmt, path in candidates:
        try:
            df = scan_table(spark, path, fmt)
            if not df.isEmpty():
                return df
        except (PySparkException, Py4JJavaError) as error:
            log.warning("passing over %s at %s: %s", fmt, path, str(error).splitlines()[0])
    return None
