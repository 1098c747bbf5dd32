"""Reading the given tables and writing intermediate ones."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudtide.session import consumed
from fraudtide.session import materialised as written
from fraudtide.session import session_conf

# What counts as a word, and what stands between words. Fixed values.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

__all__ = ["BLANKS", "WORD", "Steps", "materialised", "read_table", "texts", "words"]


# Spark drops the shuffle files of a query when it has ended, not only when the driver forgets it.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back; its shuffles are dropped."""
    with session_conf(df.sparkSession, CLEANUP):
        return written(df, label)


class Steps:
    """Intermediate results that are deleted when the block ends: what follows must have been written by then."""

    def __enter__(self) -> Steps:
        self.folders = ExitStack()
        return self

    def written(self, df: DataFrame, label: str) -> DataFrame:
        """As ``materialised``, for the length of the block."""
        path = self.folders.enter_context(consumed(df.sparkSession, label))
        with session_conf(df.sparkSession, CLEANUP):
            df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def __exit__(self, *error: object) -> None:
        self.folders.close()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one; other columns are left out."""
    return docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))


def words(text: Column) -> Column:
    """The words of a text as an array, empty for a text without any."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")
