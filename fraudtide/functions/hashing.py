"""A portable row hash, the basis of repeatable samples and splits.

``DataFrame.sample`` and ``randomSplit`` depend on how rows are partitioned, so a re-run
after a repartition picks other rows. Hashing a row id does not, needs no shuffle, and a
task that is run again gives the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 52  # exact as a double, which percentile_approx works in


def row_hash(id_col: str | Column, seed: int, purpose: str = "") -> Column:
    """Return a 52-bit non-negative hash of ``seed``, ``purpose`` and the row id, as a bigint.

    Hashes of different purposes are independent: a sample of one part of a split takes as large a
    share of it as of any other part.
    """
    start = f"{seed}:{purpose}:" if purpose else f"{seed}:"
    text = F.concat(F.lit(start), F.col(id_col) if isinstance(id_col, str) else id_col)
    hex_digits = F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4)
    return F.conv(hex_digits, 16, 10).cast("bigint")


def hash_unit(id_col: str | Column, seed: int, purpose: str = "") -> Column:
    """Return the row hash scaled to [0, 1)."""
    return row_hash(id_col, seed, purpose).cast("double") / F.lit(float(1 << HASH_BITS))
