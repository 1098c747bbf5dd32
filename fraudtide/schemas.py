"""Fixed schemas. Data is never read with schema inference: that costs an extra pass."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

COMPONENTS = [f"V{i}" for i in range(1, 29)]
FEATURE_COLUMNS = [*COMPONENTS, "Amount", "Time"]


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_components = {name: DoubleType() for name in COMPONENTS}

# Transaction file: Time, V1..V28, Amount, Class.
RAW_TRANSACTION = _struct(Time=DoubleType(), **_components, Amount=DoubleType(), Class=IntegerType())

# JSON transaction event; the four leading fields are the contract's required ones.
TRANSACTION_EVENT = _struct(
    event_timestamp=StringType(),
    Time=DoubleType(),
    Amount=DoubleType(),
    Class=IntegerType(),
    **_components,
)
REQUIRED_EVENT_FIELDS = ["event_timestamp", "Time", "Amount", "Class"]

WINDOW_FEATURES = _struct(
    window_start=TimestampType(),
    window_end=TimestampType(),
    Class=IntegerType(),
    tx_count_1m=LongType(),
    total_amount_1m=DoubleType(),
    avg_amount_1m=DoubleType(),
)

ALERT = _struct(
    event_timestamp=StringType(),
    Time=DoubleType(),
    Amount=DoubleType(),
    prediction=DoubleType(),
    actual_label=IntegerType(),
)

# Driver table `events`.
EVENT_LOG = _struct(
    event_id=LongType(),
    ts=TimestampNTZType(),
    user_id=LongType(),
    event_type=StringType(),
    value=DoubleType(),
    props=StringType(),
)
