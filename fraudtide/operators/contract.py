"""Validation of JSON events against the transaction contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudtide.functions.events import CORRUPT, decode_events
from fraudtide.schemas import REQUIRED_EVENT_FIELDS

DATE_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"


def validate_contract(
    df: DataFrame,
    value_col: str = "value",
    required: list[str] = REQUIRED_EVENT_FIELDS,
    features: list[str] | None = None,
    passthrough: list[str] | None = None,
) -> DataFrame:
    """Decode events and add `valid` and `reject_reason`; works on streams.

    Reasons, the first that applies: `malformed_json`, `missing:<field>`, `type:<field>`,
    `bad_timestamp` (our own, beyond the contract's types), and with ``features`` `no_number:<field>` for one that is not there to
    score. The source text is looked at again only for events that failed the
    typed parse. Rejected rows stay in the result, so a caller can route them.
    """
    kept = [*(passthrough or []), value_col]
    decoded = decode_events(df, value_col, keep_corrupt=True, passthrough=kept)
    text = F.col(value_col).cast("string")
    # JSON Schema counts 1.0 as an integer. Looked at again only where the typed parse gave none.
    number = F.from_json(text, "Class double")["Class"]
    whole = F.when(number == F.floor(number), number.cast("int"))
    decoded = decoded.withColumn("Class", F.when(F.col("Class").isNull(), whole).otherwise(F.col("Class")))

    def absent(name: str) -> Column:
        return F.col(name).isNull() & F.get_json_object(text, f"$.{name}").isNull()

    # Blank text is not reported as corrupt; a wrongly typed field is, but its text is JSON.
    blank = text.isNull() | (F.trim(text) == "")
    unreadable = F.col(CORRUPT).isNotNull() & F.get_json_object(text, "$").isNull()
    reason = F.when(blank | unreadable, "malformed_json")
    for name in required:
        reason = reason.when(absent(name), f"missing:{name}")
    for name in required:
        reason = reason.when(F.col(name).isNull(), f"type:{name}")
    # A JSON number decodes to text and may even parse (2024), but has no date-time shape.
    dated = F.col("event_timestamp").rlike(DATE_TIME)
    reason = reason.when(F.col("event_time").isNull() | ~dated, "bad_timestamp")
    for name in features or []:
        reason = reason.when(F.col(name).isNull() | F.isnan(name), f"no_number:{name}")
    return (
        decoded.withColumn("reject_reason", reason)
        .withColumn("valid", F.col("reject_reason").isNull())
        .drop(CORRUPT)
    )


def reasons(required: list[str] = REQUIRED_EVENT_FIELDS, features: list[str] | None = None) -> list[str]:
    """Every reason that ``validate_contract`` may give."""
    fields = [f"{kind}:{name}" for kind in ("missing", "type") for name in required]
    return ["malformed_json", *fields, "bad_timestamp", *[f"no_number:{name}" for name in features or []]]


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where("valid").drop("valid", "reject_reason")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.where("not valid")
