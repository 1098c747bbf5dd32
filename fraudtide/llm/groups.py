"""Python helpers for tasks that see sorted rows of many small groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 8192) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of at least ``rows`` rows that hold whole groups, and the number of each row's group.

    The rows must be sorted by ``keys``. A table grows beyond ``rows`` only by the one group at its
    end, so groups must be bounded by whoever made them.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table = pa.Table.from_batches(held)
            ids = group_numbers(table, keys)
            cut = int(np.searchsorted(ids, ids[-1]))
            if cut:
                yield table.slice(0, cut), ids[:cut]
            held, size = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if size:
        table = pa.Table.from_batches(held)
        yield table, group_numbers(table, keys)


def group_numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Numbers that rise by one where any of the keys changes."""
    change = np.zeros(table.num_rows, dtype=np.int64)
    for key in keys:
        values = table.column(key).to_numpy(zero_copy_only=False)
        change[1:] |= values[1:] != values[:-1]
    return np.cumsum(change)


FILTER_BITS = 25  # 4 MB, whatever the number of values


def bit_filter(values: DataFrame) -> np.ndarray:
    """A bitmap of the low bits of a bigint column: who is not in it is not among the values.

    For leaving out most rows before a join; the join decides. The bitmap has a fixed size: for very
    many values it lets more pass, never less.
    """
    name = values.columns[0]
    place = F.col(name).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = values.where(F.col(name).isNotNull()).select(place.alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(63)).cast("int"))
    words = words.groupBy(F.floor(F.col("place") / 63).alias("word")).agg(F.bit_or(bit).alias("bits"))
    bitmap = np.zeros((1 << FILTER_BITS) // 63 + 1, dtype=np.int64)
    found = words.toArrow()
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bitmap


def may_be_in(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values.astype(np.int64) & ((1 << FILTER_BITS) - 1)
    return (bitmap[place // 63] >> (place % 63)) & 1 == 1


class Forest:
    """Union-find over the places 0..n-1, joined in bulk."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.root[a] != self.root[b]
        a, b = a[apart], b[apart]
        while len(a):
            x, y = self.root[a], self.root[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(self.root, high, low)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
            apart = self.root[a] != self.root[b]
            a, b = a[apart], b[apart]
