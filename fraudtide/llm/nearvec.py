"""Near-duplicate vectors by p-stable hashing for the Euclidean distance.

Vectors are scaled to length one, so that a cosine is a distance. Every table projects them on random
directions, shifts and quantises: near vectors fall into the same cells in some table with a
probability that grows with the cosine. Who shares a bucket is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudtide.llm.components import components
from fraudtide.llm.groups import Forest, whole_groups
from fraudtide.llm.tables import materialised


@dataclass(frozen=True)
class Stable:
    """``tables`` of ``hashes`` cells of ``width``: at a cosine of 0.93 a pair shares a bucket in one
    table with probability 0.105, and in any of 40 with 0.988; at 0.97 with over 0.9999."""

    cosine: float = 0.93
    tables: int = 40
    hashes: int = 14
    width: float = 2.0
    seed: int = 5
    block: int = 512


def bucket_keys(vectors: np.ndarray, rules: Stable) -> np.ndarray:
    """A 32-bit key per vector and table, from unit vectors of one length."""
    rng = np.random.default_rng((rules.seed, vectors.shape[1]))
    directions = rng.standard_normal((vectors.shape[1], rules.tables * rules.hashes))
    shift = rng.uniform(0, rules.width, rules.tables * rules.hashes)
    mixers = rng.integers(1, 1 << 62, rules.hashes, dtype=np.int64) | 1
    keys = np.empty((len(vectors), rules.tables), dtype=np.int32)
    for at in range(0, len(vectors), 4096):
        cells = np.floor((vectors[at : at + 4096] @ directions + shift) / rules.width).astype(np.int64)
        mixed = (cells.reshape(-1, rules.tables, rules.hashes) * mixers).sum(axis=2)
        keys[at : at + 4096] = ((mixed ^ (mixed >> 31)) * 0x2545F4914F6CDD1D >> 32).astype(np.int32)
    return keys


def _usable() -> Column:
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(numbers, lambda x: x != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine & some, F.lit(False))


def classes(vectors: DataFrame) -> DataFrame:
    """Equal vectors with equal labels as one: ``rep`` (smallest id), ``n``, ``label, dim, embedding``."""
    plain = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.where(_usable()).select("vec_id", "label", plain.alias("embedding"))
    keyed = rows.withColumns({"h1": F.xxhash64("label", "embedding"), "h2": F.xxhash64("embedding", F.lit(1))})
    grouped = keyed.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    return materialised(grouped, "vector-classes")


def _hashed(reps: DataFrame, rules: Stable) -> DataFrame:
    """``rep, n, label, vec, keys``: vectors and all their bucket keys as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.array(v, dtype="<f8") for v in batch.column("embedding").to_pylist()]
            keys: list[bytes] = [b""] * len(values)
            for dim in {len(v) for v in values}:
                own = [i for i, v in enumerate(values) if len(v) == dim]
                block = np.stack([values[i] for i in own])
                block /= np.abs(block).max(axis=1, keepdims=True)
                block /= np.linalg.norm(block, axis=1, keepdims=True)
                for i, k in zip(own, bucket_keys(block, rules), strict=True):
                    keys[i] = k.astype("<i4").tobytes()
            columns = [batch.column(c) for c in ("rep", "n", "label")]
            packed = [pa.array([v.tobytes() for v in values], pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *packed], ["rep", "n", "label", "vec", "keys"])

    label = reps.schema["label"].dataType.simpleString()
    schema = f"rep long, n long, label {label}, vec binary, keys binary"
    return materialised(reps.select("rep", "n", "label", "embedding").mapInArrow(run, schema), "vector-keys")


def _slots(hashed: DataFrame, rules: Stable) -> DataFrame:
    """``rep, label, size, tab, key``: one row per vector and table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype="<i4").reshape(-1, rules.tables)
            for t in range(rules.tables):
                table = pa.array(np.full(len(keys), t, dtype=np.int32))
                own = [*batch.columns[:3], table, pa.array(np.ascontiguousarray(keys[:, t]))]
                yield pa.RecordBatch.from_arrays(own, ["rep", "label", "size", "tab", "key"])

    label = hashed.schema["label"].dataType.simpleString()
    rows = hashed.select("rep", "label", F.length("vec").alias("size"), "keys")
    return rows.mapInArrow(run, f"rep long, label {label}, size int, tab int, key int")


GROUP = ["tab", "key", "label", "size", "low", "high"]


def _compare(table: pa.Table, group: np.ndarray, rules: Stable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group that link, each pair of vectors in the first table it shares only."""
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), dtype="<i4").reshape(-1, rules.tables)
    tab = table.column("tab").to_numpy()
    block, across = table.column("block").to_numpy(), (table.column("low").to_numpy() != table.column("high").to_numpy())
    raw = table.column("vec").to_pylist()
    unit = {}
    sizes = table.column("size").to_numpy()
    place = np.zeros(len(raw), dtype=np.int64)
    for size in np.unique(sizes):
        own = np.nonzero(sizes == size)[0]
        rows = np.frombuffer(b"".join([raw[i] for i in own]), dtype="<f8").reshape(len(own), -1)
        rows = rows / np.abs(rows).max(axis=1, keepdims=True)
        unit[size] = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        place[own] = np.arange(len(own))
    longest = int(np.bincount(group).max()) if len(group) else 0
    tables = np.arange(rules.tables)
    for step in range(1, longest):
        a = np.nonzero(group[:-step] == group[step:])[0]
        a = a[~across[a] | (block[a] != block[a + step])]
        for at in range(0, len(a), 65_536):
            i = a[at : at + 65_536]
            j = i + step
            i, j = (x[~((keys[i] == keys[j]) & (tables < tab[i][:, None])).any(axis=1)] for x in (i, j))
            linked = np.zeros(len(i), dtype=bool)
            for size, rows in unit.items():
                own = sizes[i] == size
                cosine = np.einsum("ij,ij->i", rows[place[i[own]]], rows[place[j[own]]])
                linked[own] = cosine >= rules.cosine
            if linked.any():
                yield i[linked], j[linked]


def _links(hashed: DataFrame, rules: Stable) -> DataFrame:
    """``a, b, n``: links that join all that is linked, and with b null how many vectors ``a`` links to.

    Buckets of one are dropped before vectors move. Buckets over ``block`` rows are dealt out by pairs
    of blocks, so a task holds two blocks at most and no pair is left out.
    """
    slots = materialised(_slots(hashed, rules), "vector-slots")
    key = ["tab", "key", "label", "size"]
    buckets = slots.groupBy(*key).agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / rules.block).cast("int")
    members = slots.join(buckets, key).withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = members.select(*key, "rep", "block", other).select(
        *key, "rep", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    rows = dealt.join(hashed.select("rep", "n", "vec", "keys"), "rep").repartition(*GROUP).sortWithinPartitions(*GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, GROUP):
            rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
            links, forest = np.zeros(len(rep), dtype=np.int64), Forest(len(rep))
            for i, j in _compare(table, group, rules):
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                forest.join(i, j)
            some, below = np.nonzero(links)[0], np.nonzero(forest.root != np.arange(len(rep)))[0]
            a = np.concatenate([rep[some], rep[below]])
            b = pa.array([None] * len(some) + rep[forest.root[below]].tolist(), pa.int64())
            count = np.concatenate([links[some], np.zeros(len(below), dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(count)], ["a", "b", "n"])

    return materialised(rows.mapInArrow(run, "a long, b long, n long"), "vector-links")


def near_vectors(vectors: DataFrame, rules: Stable = Stable()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``vec_id, embedding, label``.

    Vectors link when their labels are equal, their lengths too, and their cosine is at least
    ``rules.cosine``. A vector that is null, empty or zero, holds a null or what is not finite, or has
    a null label or id, links with nothing. Repeated rows are vectors of their own that link.
    """
    reps = classes(vectors)
    hashed = _hashed(reps, rules)
    found = _links(hashed, rules)
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    joined = components(found.where("b IS NOT NULL").select("a", "b")).select(F.col("id").alias("rep"), "component")
    known = reps.select("h1", "h2", "rep", "n").join(counts, "rep", "left").join(joined, "rep", "left")
    plain = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select("vec_id", "label", F.when(_usable(), plain).alias("embedding"))
    keys = {"h1": F.xxhash64("label", "embedding"), "h2": F.xxhash64("embedding", F.lit(1))}
    keyed = rows.select(
        "vec_id", *[F.when(F.col("embedding").isNotNull(), key).alias(name) for name, key in keys.items()]
    )
    component = F.coalesce("component", "rep", "vec_id")
    return keyed.join(known, ["h1", "h2"], "left").select(
        "vec_id",
        F.coalesce(F.col("n") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
