"""Mirror of dashboard rows in a relational store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fraudtide.operators.adapt import DASHBOARD_COLUMNS, adapt_for_dashboard

# Dashboards ask for the mirrored amount by its exact, quoted name.
MIRROR_COLUMNS = list(DASHBOARD_COLUMNS)
CONNECTIONS = 8


def mirror_rows(df: DataFrame) -> DataFrame:
    """Return the three columns the mirror table holds, whatever shape ``df`` has."""
    return adapt_for_dashboard(df).select(*MIRROR_COLUMNS)


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, connections: int = CONNECTIONS, batch_size: int = 10_000
) -> dict[str, str]:
    """Options for a JDBC write that opens at most ``connections`` connections."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }


def export_jdbc(df: DataFrame, mode: str = "overwrite", **connection) -> None:
    """Write the mirror rows to a database table; credentials come from the caller.

    The rows are dealt to the connections by a shuffle, so that what comes before keeps its own parallelism.
    """
    rows = mirror_rows(df).repartition(int(connection.get("connections", CONNECTIONS)))
    rows.write.format("jdbc").options(**jdbc_options(**connection)).mode(mode).save()
