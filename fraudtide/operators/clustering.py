"""Compaction and clustering, so that row-group statistics let filters skip files."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BITS = 63
RANGES = 1 << 12  # most quantile ranges a column is cut into
FILE_BYTES = 256 << 20
TASK_BYTES = 128 << 20  # rows of a file as they are sorted, which may be many times what they are stored in


def bits_for(files: int, columns: int) -> int:
    """Bits a column is cut into so that there are at least sixteen cells of the curve to a file."""
    wanted = -(-math.ceil(math.log2(max(files, 1) * 16)) // columns)
    return max(1, min(wanted, RANGES.bit_length() - 1, MAX_BITS // columns))


def _rank_bucket(df: DataFrame, column: str, ends: list[float]) -> DataFrame:
    """Add `_z_<column>`: which of the quantile ranges the value is in; null is 0, NaN the last.

    A binary search in the ends: a step for each bit.
    """
    finite = sorted({float(e) for e in ends if math.isfinite(e)})
    value = F.col(column).cast("double")
    steps = [1 << i for i in reversed(range(len(finite).bit_length()))]
    known = F.lit(finite)

    def step(at: Column, width: Column) -> Column:
        above = F.coalesce(F.get(known, at + width - 1) <= value, F.lit(False))
        return at + F.when(above, width).otherwise(0)

    above = F.aggregate(F.lit(steps), F.lit(0), step) if finite else F.lit(0)
    return df.withColumn(f"_z_{column}", F.when(value.isNull(), F.lit(0)).otherwise(above).cast("bigint"))


def _interleave(columns: list[Column], bits: int) -> Column:
    value = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, c in enumerate(columns):
            digit = F.shiftright(c, bit).bitwiseAND(F.lit(1))
            value = value.bitwiseOR(F.shiftleft(digit, bit * len(columns) + i))
    return value


def _by_range(df: DataFrame, files: int | None, keys: list[Column]) -> DataFrame:
    spread = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys)


def clustered(df: DataFrame, columns: list[str], files: int | None = None) -> DataFrame:
    """Return the same rows, range-partitioned and sorted for ``columns``.

    Without ``files`` adaptive execution sizes the partitions from the data.

    One column is a plain range sort; several follow a Z-order curve over their quantile
    ranges, the more of them the more files there are to be. The row hash breaks ties, so a value filling a third of the rows is spread over
    several files rather than one task.
    """
    original = df.columns
    # Maps cannot be hashed; equal rows are told apart by a random number with a fixed seed.
    hashable = [c for c in original if "map<" not in df.schema[c].dataType.simpleString()]
    tie = F.xxhash64(*hashable, F.rand(42))
    if len(columns) == 1:
        keys = [F.col(columns[0]), tie]
        return _by_range(df, files, keys)
    if len(columns) > MAX_BITS:
        raise ValueError(f"no more than {MAX_BITS} columns can be interleaved")
    bits = bits_for(files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(columns))
    probabilities = [i / (1 << bits) for i in range(1, 1 << bits)]
    ends = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), probabilities, 10_000).alias(c) for c in columns]
    ).first()
    placed = df
    for c in columns:
        placed = _rank_bucket(placed, c, ends[c] or [])
    keys = [_interleave([F.col(f"_z_{c}") for c in columns], bits), tie]
    return _by_range(placed, files, keys).select(*original)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """How many bytes a folder of files has."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def row_bytes(df: DataFrame) -> int:
    """About how many bytes the rows take while they are sorted, from one pass over them.

    Eight for the row and for each column, and what values of no fixed width add as text.
    """
    loose = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    own = [F.octet_length(df[f"`{f.name}`"].cast("string")) for f in df.schema if isinstance(f.dataType, loose)]
    each = sum((F.coalesce(c, F.lit(0)) for c in own), F.lit(8 * (len(df.columns) + 1)).cast("bigint"))
    return df.agg(F.sum(each)).first()[0] or 0


def optimize(
    spark: SparkSession,
    path: str,
    new_path: str,
    columns: list[str],
    files: int | None = None,
    fmt: str = "parquet",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Rewrite a table clustered by ``columns``; its rows do not change.

    Without ``files`` there is one for every ``file_bytes`` of the table, and more where the rows of one would
    take over ``TASK_BYTES`` in the task that sorts them. Delta rewrites in place; a Parquet table is written
    to ``new_path``.
    """
    if fmt == "delta":
        spark.sql(f"OPTIMIZE delta.`{path}` ZORDER BY ({', '.join(columns)})")
        return
    rows = spark.read.parquet(path)
    files = files or max(-(-stored_bytes(spark, path) // file_bytes), -(-row_bytes(rows) // TASK_BYTES), 1)
    clustered(rows, columns, files).write.mode("error").parquet(new_path)


def layout(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``column, files, rows, largest_share, overlapping, pairs``: how well file statistics can skip files.

    ``largest_share`` is the largest file's share of the rows; ``overlapping`` says how many of the ``pairs`` of files
    share a value range of the column. A pair is apart when one ends before the other begins, so pairs are
    counted in one pass over the files' ends in order: two rows per file and column, whatever their rows.
    """
    rows = spark.read.parquet(path)
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    each = rows.select(F.col("_metadata.file_path").alias("file"), values).groupBy("column", "file")
    ranges = each.agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    ends = F.inline(F.array(F.struct(F.col("low").alias("at"), F.lit(0).alias("end")), F.struct(F.col("high").alias("at"), F.lit(1).alias("end"))))
    before = Window.partitionBy("column").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, -1)
    # Where a file begins, all that have ended before are apart from it.
    ordered = ranges.where("low IS NOT NULL").select("column", ends).withColumn("ended", F.coalesce(F.sum("end").over(before), F.lit(0)))
    apart = ordered.groupBy("column").agg(F.sum(F.when(F.col("end") == 0, F.col("ended"))).alias("apart"))
    sizes = ranges.groupBy("column").agg(
        F.count("*").alias("files"), F.sum("n").alias("rows"), (F.max("n") / F.sum("n")).alias("largest_share")
    )
    pairs = F.floor(F.col("files") * (F.col("files") - 1) / 2)
    return sizes.join(apart, "column", "left").select(
        "column", "files", "rows", "largest_share", (pairs - F.coalesce("apart", F.lit(0))).alias("overlapping"), pairs.alias("pairs")
    )
