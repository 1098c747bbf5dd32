"""Publication of a table under the names dashboard SQL uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def publish_views(
    spark: SparkSession,
    df: DataFrame,
    name: str = "transactions",
    database: str = "fraud_lakehouse",
    location: str | None = None,
) -> None:
    """Create the database and the session, global and dotted-name views of ``df``.

    ``location`` is where the database would keep managed tables; the views hold no data.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    df.createOrReplaceTempView(name)
    df.createOrReplaceGlobalTempView(name)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW `{database}.{name}` AS SELECT * FROM {name}")
