"""Versioned tables: append, time travel, schema enforcement, evolution, retention.

With ``fmt="delta"`` the calls go to Delta Lake. Without its jar a table is a folder of
Parquet folders ``_version=<n>``, each holding the rows one append added. Spark's committer
writes ``_SUCCESS`` last, and only folders that have it are read, so an append that fails
or is still running shows nothing. Every version is written with the full table schema of
its time, so the newest folder names all columns and no schema-merging pass is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

VERSION = "_version"
COMMITTED_AT = "_committed_at"


class SchemaMismatch(ValueError):
    """The rows to append do not fit the table."""


class UnknownVersion(ValueError):
    """The table has no such readable version."""


def _matching(spark: SparkSession, pattern: str) -> list:
    found = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    statuses = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found)
    return [status.getPath() for status in statuses or []]


def _number(folder) -> int:
    return int(folder.getName().split("=")[1])


def versions(spark: SparkSession, path: str) -> list[int]:
    """List the readable versions of a Parquet-backed table, by its folders alone."""
    markers = _matching(spark, f"{path}/{VERSION}=*/_SUCCESS")
    return sorted(_number(marker.getParent()) for marker in markers)


def _next_number(spark: SparkSession, path: str) -> int:
    """Skip unfinished folders too: one may belong to an append that is still running."""
    return max([_number(f) for f in _matching(spark, f"{path}/{VERSION}=*")], default=-1) + 1


def _folder(path: str, version: int) -> str:
    return f"{path}/{VERSION}={version}"


def table_schema(spark: SparkSession, path: str, version: int) -> StructType:
    """Return the columns of the table as of a version."""
    stored = spark.read.parquet(_folder(path, version)).schema
    return StructType([f for f in stored.fields if f.name != COMMITTED_AT])


def align(df: DataFrame, target: StructType, merge_schema: bool = False) -> DataFrame:
    """Fit rows to the table's columns, or raise ``SchemaMismatch``.

    A column the table lacks is refused unless ``merge_schema``; a column the rows lack is
    filled with null; a type must match exactly.
    """
    wanted = {f.name: f.dataType for f in target.fields}
    given = {f.name: f.dataType for f in df.schema.fields}
    problems = [
        f"{name}: {given[name].simpleString()} instead of {kind.simpleString()}"
        for name, kind in wanted.items()
        if name in given and given[name] != kind
    ]
    added = [f for f in df.schema.fields if f.name not in wanted]
    if added and not merge_schema:
        problems += [f"{f.name}: not a column of the table" for f in added]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    fields = [*target.fields, *[StructField(f.name, f.dataType, True) for f in added]]
    return df.select(
        *[F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    )


def append_version(
    df: DataFrame,
    path: str,
    merge_schema: bool = False,
    fmt: str = "parquet",
    committed_at: str | None = None,
) -> int | None:
    """Append rows as the next version and return its number (None for Delta).

    The first append creates the table. ``committed_at`` (timestamp text) replaces the
    current time, for replays.
    """
    spark = df.sparkSession
    if fmt == "delta":
        writer = df.write.format("delta").mode("append").option("mergeSchema", str(merge_schema).lower())
        writer.save(path)
        return None
    existing = versions(spark, path)
    number = _next_number(spark, path)
    if existing:
        df = align(df, table_schema(spark, path, existing[-1]), merge_schema)
    stamp = F.lit(committed_at).cast("timestamp") if committed_at else F.current_timestamp()
    # Of two appends that picked the same number the later one fails instead of mixing in.
    df.withColumn(COMMITTED_AT, stamp).write.mode("error").parquet(_folder(path, number))
    return number


def _stored(spark: SparkSession, path: str, as_of: int | None) -> DataFrame:
    existing = versions(spark, path)
    readable = [v for v in existing if as_of is None or v <= as_of]
    if not readable or (as_of is not None and as_of > existing[-1]):
        raise UnknownVersion(f"{path} has versions {existing}, not {as_of}")
    newest = spark.read.parquet(_folder(path, readable[-1])).schema
    schema = StructType([*newest.fields, StructField(VERSION, IntegerType(), True)])
    return (
        spark.read.schema(schema)
        .option("basePath", path)
        .parquet(*[_folder(path, v) for v in readable])
    )


def read_version(spark: SparkSession, path: str, as_of: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Read the table at a version (default: the latest).

    Later versions are not listed, let alone read. Older rows show null in columns added
    since.
    """
    if fmt == "delta":
        reader = spark.read.format("delta")
        return (reader if as_of is None else reader.option("versionAsOf", as_of)).load(path)
    return _stored(spark, path, as_of).drop(VERSION, COMMITTED_AT)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Report each version's rows and commit time, without reading the data columns."""
    return (
        _stored(spark, path, None)
        .groupBy(F.col(VERSION).alias("version"))
        .agg(F.count("*").alias("rows"), F.max(COMMITTED_AT).alias("committed_at"))
    )


def purge_history(spark: SparkSession, path: str, new_path: str, cutoff: str, fmt: str = "parquet", hours: float = 168.0) -> int | None:
    """Give up the versions superseded before ``cutoff`` (timestamp text).

    The newest version committed before the cutoff becomes the oldest one kept: its rows,
    from however many appends, are written as one folder of ``new_path``, and later
    versions follow unchanged. Reads at kept versions give the same rows as before. The
    caller then switches to ``new_path``. Returns the oldest kept version. Delta purges in
    place by ``hours``.
    """
    if fmt == "delta":
        spark.sql(f"VACUUM delta.`{path}` RETAIN {float(hours):g} HOURS")
        return None
    before = history(spark, path).where(F.col("committed_at") < F.lit(cutoff).cast("timestamp"))
    oldest = before.agg(F.max("version")).first()[0]
    kept = [v for v in versions(spark, path) if oldest is None or v > oldest]
    if oldest is not None:
        _stored(spark, path, oldest).drop(VERSION).write.mode("error").parquet(_folder(new_path, oldest))
    for v in kept:
        spark.read.parquet(_folder(path, v)).write.mode("error").parquet(_folder(new_path, v))
    return oldest
