"""Fill in the columns a query needs from whichever columns a table has."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Sources to try in order for one target column, and the value if none is there."""

    target: str
    default: object
    sources: list[str] = field(default_factory=list)
    cast: str | None = None

    def column(self, present: dict[str, str], fold: Callable[[str], str]) -> Column:
        for name in self.sources:
            if fold(name) in present:
                return F.col(name).cast(self.cast) if self.cast else F.col(name)
        return self.default if isinstance(self.default, Column) else F.lit(self.default)


DASHBOARD_COLUMNS = ("window_start", "prediction", "Amount")


def dashboard_rules() -> list[Rule]:
    return [
        Rule("prediction", 0.0, ["Class"], "double"),
        Rule("Amount", 100.0, ["avg_amount_1m", "total_amount_1m"], "double"),
        Rule(
            "window_start",
            F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"),
            ["event_timestamp"],
        ),
    ]


def adapt_columns(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add the target columns ``df`` lacks. Decided from its schema, before any job runs.

    Names are compared as the session resolves them; a column that is there in another case gets the
    target's name.
    """
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = str if sensitive else str.lower
    present = {fold(name): name for name in df.columns}
    missing = {rule.target: rule.column(present, fold) for rule in rules if fold(rule.target) not in present}
    renamed = {present[fold(r.target)]: r.target for r in rules if present.get(fold(r.target), r.target) != r.target}
    adapted = df.withColumns(missing) if missing else df
    return adapted.withColumnsRenamed(renamed) if renamed else adapted


def adapt_for_dashboard(df: DataFrame) -> DataFrame:
    return adapt_columns(df, dashboard_rules())
