"""JSON transaction events: encoding for a topic, decoding from one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fraudtide.schemas import TRANSACTION_EVENT

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
CORRUPT = "_corrupt_record"


def iso_utc(timestamp: Column) -> Column:
    """Format a timestamp as ISO-8601 with microseconds (the session runs in UTC)."""
    return F.date_format(timestamp, ISO_MICROS)


def parse_iso(text: Column) -> Column:
    """Parse ISO-8601 text; text that is no timestamp gives null, not an error."""
    return F.try_to_timestamp(text)


def message_key(time_col: str = "Time", fallback_id: str | None = None) -> Column:
    """Return ``tx_<whole seconds>``; a row without a time is keyed by a stable id."""
    whole = F.col(time_col).try_cast("bigint").cast("string")
    if fallback_id:
        whole = F.coalesce(whole, F.col(fallback_id).cast("string"))
    return F.concat(F.lit("tx_"), whole)


def first_events(df: DataFrame, n: int, time_col: str = "event_time", id_col: str = "event_id") -> DataFrame:
    """Cap a replay at its first ``n`` events; those of one instant go by id."""
    return df.orderBy(time_col, id_col).limit(n)


def encode_events(
    df: DataFrame,
    clock: Column | None = None,
    fallback_id: str | None = None,
    passthrough: list[str] | None = None,
) -> DataFrame:
    """Turn transactions into ``key, value`` records with a JSON value.

    ``clock`` is the timestamp stamped on each event (default: now, as a live publisher
    does; pass a column to replay recorded times). Only contract columns that are
    present are sent. Null fields are left out of the JSON.
    """
    stamped = df.withColumn(
        "event_timestamp", iso_utc(F.current_timestamp() if clock is None else clock)
    )
    fields = [name for name in TRANSACTION_EVENT.names if name in stamped.columns]
    return stamped.select(
        *(passthrough or []),
        message_key(fallback_id=fallback_id).alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("value"),
    )


def decode_events(
    df: DataFrame,
    value_col: str = "value",
    schema: StructType = TRANSACTION_EVENT,
    keep_corrupt: bool = False,
    passthrough: list[str] | None = None,
) -> DataFrame:
    """Parse JSON values into typed columns plus ``event_time``; works on streams.

    Malformed text yields null columns. With ``keep_corrupt`` the unparsable source text is
    kept in ``_corrupt_record``.
    """
    target = schema
    options = {"mode": "PERMISSIVE"}
    if keep_corrupt:
        target = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
        options["columnNameOfCorruptRecord"] = CORRUPT
    payload = F.from_json(F.col(value_col).cast("string"), target, options)
    return (
        df.select(*(passthrough or []), payload.alias("data"))
        .select(*(passthrough or []), "data.*")
        .withColumn("event_time", parse_iso(F.col("event_timestamp")))
    )
