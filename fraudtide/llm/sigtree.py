"""Exact Jaccard join of word n-gram sets with signature trees.

A document is the set of its word n-grams. Equal sets are one class. Classes meet where they share one
of their rarest n-grams; there, a tree over their bitmaps finds the pairs whose overlap may be large
enough: a node holds its members' bitmaps combined by OR, the range of their sizes and the most
n-grams that share a bit. Pairs of nodes are followed down only while their overlap can suffice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudtide.llm.components import components
from fraudtide.llm.groups import bit_filter, may_be_in, whole_groups
from fraudtide.llm.tables import materialised

CLASS_BITS = 16  # n-grams are counted in so many hash classes, whatever the size of the corpus
FANOUT = 8
FRONTIER = 1 << 15  # pairs of nodes looked at together
WORD_MEMO = 400_000
COUNTED_TOGETHER = 512  # documents
SMALL_GROUP = 64  # members of a group whose pairs are counted rather than followed down a tree
COMMON = 4  # prefix n-grams that similar sets have in common


@dataclass(frozen=True)
class Grams:
    """n-grams of ``words`` words; Jaccard of at least ``over / under``; ``block``: documents of one
    group that a task compares, larger groups are dealt out by pairs of blocks."""

    words: int = 5
    over: int = 4
    under: int = 5
    block: int = 1024


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def gram_set(text: str | None, words: int, memo: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams; of fewer words the whole sequence is one.

    Words lie between blanks; A-Z are lower-cased.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, parts), dtype=np.uint64, count=len(parts))
    size = min(words, len(hashes))
    joined = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        joined = _mix(joined * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - size + 1 + i])
    joined.sort()
    fresh = np.ones(len(joined), dtype=bool)
    np.not_equal(joined[1:], joined[:-1], out=fresh[1:])
    return joined[fresh]


def digest(grams: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63) if len(grams) else None


def signature(grams: np.ndarray) -> bytes:
    """Bitmap of at least four bits per n-gram, a power of two of them, 64 at least."""
    bits = max(64, 1 << (4 * len(grams) - 1).bit_length())
    flags = np.zeros(bits, dtype=bool)
    flags[(grams & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def rarity_ranks(docs: DataFrame, rules: Grams) -> np.ndarray:
    """Rank by frequency of each of the 2^CLASS_BITS classes of n-gram hashes, over all documents.

    Every task sums its own documents first; what reaches the driver is of fixed size.
    """
    size = 1 << CLASS_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, counts = _WordHashes(), np.zeros(size, dtype=np.int64)
        held: list[np.ndarray] = []

        def add() -> None:
            classes = np.concatenate(held) & np.uint64(size - 1)
            np.add(counts, np.bincount(classes.astype(np.int64), minlength=size), out=counts)
            held.clear()

        for batch in batches:
            for value in batch.column(0):
                held.append(gram_set(value.as_py(), rules.words, memo))
                if len(held) >= COUNTED_TOGETHER or len(held[-1]) >= size:
                    add()
        if held:
            add()
        some = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["c", "n"])

    parts = docs.select("text").mapInArrow(run, "c long, n long")
    counts = np.zeros(size, dtype=np.int64)
    for row in parts.groupBy("c").agg(F.sum("n").alias("n")).collect():
        counts[row["c"]] = row["n"]
    ranks = np.empty(size, dtype=np.uint64)
    ranks[np.lexsort((np.arange(size), counts))] = np.arange(size, dtype=np.uint64)
    return ranks


def prefix(grams: np.ndarray, ranks: np.ndarray, rules: Grams) -> np.ndarray:
    """The rarest n-grams of a set: any set similar enough has ``COMMON`` of them among its own.

    A set that needs fewer for its whole overlap has that many in common.
    """
    rank = ranks[(grams & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)]
    order = np.sort(rank << np.uint64(64 - CLASS_BITS) | grams >> np.uint64(CLASS_BITS))
    needed = -(-len(grams) * rules.over // rules.under)
    return order[: len(grams) - needed + min(COMMON, needed)]


SETS = "n int, digest long, heads array<long>, prefix binary, sig binary"


def heads(grams: np.ndarray) -> list[int]:
    """The least n-gram in each of two orders that do not mind rarity: near copies mostly share them."""
    least = (grams[0], (grams * np.uint64(0xD6E8FEB86659FD93)).min())
    return [int(np.uint64(g).view(np.int64)) for g in least]


def gram_sets(docs: DataFrame, rules: Grams) -> DataFrame:
    """``doc_id, n, digest, heads, prefix, sig`` of each row; all but ``n`` null for an empty set."""
    ranks = docs.sparkSession.sparkContext.broadcast(rarity_ranks(docs, rules))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        types = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        for batch in batches:
            rows = []
            for value in batch.column(1):
                grams = gram_set(value.as_py(), rules.words, memo)
                if not len(grams):
                    rows.append((0, None, None, None, None))
                    continue
                own = prefix(grams, ranks.value, rules)
                rows.append((len(grams), digest(grams), heads(grams), own.tobytes(), signature(grams)))
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n", "digest", "heads", "prefix", "sig"])

    return materialised(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SETS}"), "gram-sets")


# --- the tree -----------------------------------------------------------------------------


def _count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


class Tree:
    """Levels of nodes over bitmaps of one width; a node covers ``FANOUT`` nodes below it."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, component: np.ndarray):
        # Per level: bitmap, least and greatest size, most n-grams beyond one per bit, components.
        self.levels = [(bits, sizes, sizes, sizes - _count(bits), component, component)]
        while len(self.levels[-1][0]) > 1:
            b, low, high, extra, c0, c1 = self.levels[-1]
            at = np.arange(0, len(b), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(b, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(extra, at),
                    np.minimum.reduceat(c0, at),
                    np.maximum.reduceat(c1, at),
                )
            )


def _may_overlap(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, rules: Grams, leaves: bool) -> np.ndarray:
    """Whether any members of nodes ``i`` and ``j`` of two levels can be similar enough, and apart.

    Two sets share no more n-grams than bits, plus those of the set with fewer that share a bit.
    """
    low, high = a[1][i], b[1][j]
    fits = (a[2][i] * rules.under >= b[1][j] * rules.over) & (b[2][j] * rules.under >= a[1][i] * rules.over)
    fits &= ~((a[4][i] == a[5][i]) & (b[4][j] == b[5][j]) & (a[4][i] == b[4][j]))
    some = np.nonzero(fits)[0]
    low, high = a[1][i[some]], b[1][j[some]]
    x, y = a[0][i[some]], b[0][j[some]]
    most = _count(x & y) + np.minimum(a[3][i[some]], b[3][j[some]])
    if leaves:  # each bit that one alone has is an n-gram less in common
        most = np.minimum(most, np.minimum(low - _count(x & ~y), high - _count(y & ~x)))
    fits[some] = most * (rules.over + rules.under) >= (low + high) * rules.over
    return fits


def dual_traversal(a: Tree, b: Tree, rules: Grams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of members that may be similar: of two trees, or ``i < j`` of one."""
    same = a is b
    depth = max(len(a.levels), len(b.levels)) - 1

    def level(tree: Tree, d: int) -> tuple:
        return tree.levels[min(d, len(tree.levels) - 1)]

    stack = [(depth, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        d, i, j = stack.pop()
        fits = _may_overlap(level(a, d), level(b, d), i, j, rules, leaves=d == 0)
        i, j = i[fits], j[fits]
        if d == 0:
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        kids = []
        for tree, nodes in ((a, i), (b, j)):
            if d < len(tree.levels):
                kids.append((nodes[:, None] * FANOUT + np.arange(FANOUT), len(tree.levels[d - 1][0])))
            else:
                kids.append((nodes[:, None], len(level(tree, d - 1)[0])))
        (x, nx), (y, ny) = kids
        x, y = np.broadcast_arrays(x[:, :, None], y[:, None, :])
        x, y = x.ravel(), y.ravel()
        valid = (x < nx) & (y < ny)
        if same:
            valid &= x <= y
        x, y = x[valid], y[valid]
        for at in range(0, len(x), FRONTIER):
            stack.append((d - 1, x[at : at + FRONTIER], y[at : at + FRONTIER]))


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def similar_pairs(
    sizes: np.ndarray, sigs: list[bytes], component: np.ndarray, rules: Grams
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of places that may be similar, in different components, and how alike their bitmaps are."""
    order = np.lexsort((sizes, component))
    widths = np.array([len(sigs[p]) // 8 for p in order])
    groups = []
    for width in np.unique(widths):
        own = order[widths == width]
        bits = np.frombuffer(b"".join([sigs[p] for p in own]), dtype="<u8").reshape(len(own), -1)
        groups.append((int(width), own, bits, Tree(bits, sizes[own], component[own])))

    def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return _count(x & y) / np.maximum(1, _count(x | y))

    for k, (width, own, bits, tree) in enumerate(groups):
        for i, j in dual_traversal(tree, tree, rules):
            yield own[i], own[j], alike(bits[i], bits[j])
        # Twice the n-grams are never similar, so only the next width can be.
        if k + 1 < len(groups) and groups[k + 1][0] == 2 * width:
            _, wider, wide, _ = groups[k + 1]
            folded = _fold(wide, width)
            for i, j in dual_traversal(tree, Tree(folded, sizes[wider], component[wider]), rules):
                yield own[i], wider[j], alike(bits[i], folded[j])


def best_forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs such as join what was apart, the most alike first."""
    if not pairs:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b, score = (np.concatenate(x) for x in zip(*pairs, strict=True))
    best = np.argsort(-score, kind="stable")
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    kept: list[int] = []
    for at, x, y in zip(best.tolist(), a[best].tolist(), b[best].tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            kept.append(at)
            if len(kept) == n - 1:
                break
    return a[kept], b[kept]


# --- the join -----------------------------------------------------------------------------

LINK = "a long, b long"


def _candidates(rows: DataFrame, keys: list[str], rules: Grams, forest: bool) -> DataFrame:
    """``a, b``: digests of pairs that may be similar, of rows ``keys, digest, n, sig, component, side``."""
    placed = rows.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, keys, rows=2 * rules.block):
            ids, sizes = table.column("digest").to_numpy(), table.column("n").to_numpy().astype(np.int64)
            sigs, component = table.column("sig").to_pylist(), table.column("component").to_numpy()
            side = table.column("side").to_numpy()
            ends = np.concatenate([[0], np.nonzero(np.diff(group))[0] + 1, [len(group)]])
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for begin, end in zip(ends[:-1], ends[1:], strict=True):
                if end - begin < 2:
                    continue
                own = slice(begin, end)
                pairs = similar_pairs(sizes[own], sigs[own], component[own], rules)
                for i, j in [best_forest(end - begin, list(pairs))] if forest else ((i, j) for i, j, _ in pairs):
                    i, j = i + begin, j + begin
                    # Of two blocks only pairs across them: each block has been compared with itself.
                    keep = (ids[i] != ids[j]) & ((side[i] == -1) | (side[i] != side[j]))
                    found.append((ids[i[keep]], ids[j[keep]]))
            a = np.concatenate([x for x, _ in found]) if found else np.zeros(0, dtype=np.int64)
            b = np.concatenate([y for _, y in found]) if found else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return placed.mapInArrow(run, LINK)


def _first_round(sets: DataFrame, rules: Grams) -> DataFrame:
    """Candidates among classes with one head in common. Large groups are split; their first class is in
    every part. What this round misses the second one finds."""
    heads = sets.select("digest", F.posexplode("heads").alias("order", "head"))
    groups = heads.groupBy("order", "head").agg(F.count("*").alias("members"), F.min("digest").alias("lead"))
    parts = F.ceil(F.col("members") / rules.block).cast("int")
    rows = heads.join(groups.where("members > 1"), ["order", "head"]).withColumn("parts", parts)
    mine = F.array(F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    part = F.explode(F.when(F.col("digest") == F.col("lead"), every).otherwise(mine)).alias("part")
    dealt = rows.select("order", "head", part, "digest").join(sets.select("digest", "n", "sig"), "digest")
    dealt = dealt.withColumns({"component": F.col("digest"), "side": F.lit(-1)})
    return _candidates(dealt, ["order", "head", "part"], rules, forest=True)


def _tokens(sets: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """``token, digest, component, n``: a row per n-gram of each prefix, of those ``among`` at least."""
    bitmap = None if among is None else sets.sparkSession.sparkContext.broadcast(bit_filter(among))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(3).to_pylist()
            counts = np.array([len(p) // 8 for p in raw], dtype=np.int64)
            tokens = np.frombuffer(b"".join(raw), dtype="<i8")
            rows = np.repeat(np.arange(len(raw)), counts)
            if bitmap is not None:
                some = may_be_in(bitmap.value, tokens)
                tokens, rows = tokens[some], rows[some]
            own = [pa.array(batch.column(i).to_numpy()[rows]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(tokens), *own], ["token", "digest", "component", "n"])

    rows = sets.select("digest", "component", "n", "prefix")
    return rows.mapInArrow(run, "token long, digest long, component long, n int")


def _second_round(sets: DataFrame, rules: Grams) -> DataFrame:
    """All candidates that share n-grams of their prefixes and are not joined yet.

    Similar sets have ``COMMON`` of them in common: either one belongs to a large group, in which trees
    are compared, or all to small groups, in which it is counted how many a pair shares.
    """
    tokens = _tokens(sets)
    shared = tokens.groupBy("token").agg(
        F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    shared = materialised(shared.where("low <> high").select("token", "members"), "gram-tokens")
    rows = materialised(_tokens(sets, shared.select("token")).join(shared, "token"), "gram-members")

    small = rows.where(F.col("members") <= SMALL_GROUP)
    fits = f"least(a.n, b.n) * {rules.under} >= greatest(a.n, b.n) * {rules.over}"
    met = small.alias("a").join(small.alias("b"), F.expr("a.token = b.token AND a.digest < b.digest"))
    met = met.where(F.expr(f"a.component <> b.component AND {fits}")).groupBy(
        F.col("a.digest").alias("a"), F.col("b.digest").alias("b"), F.least("a.n", "b.n").alias("least")
    )
    needed = F.least(F.lit(COMMON), F.ceil(F.col("least") * rules.over / F.lit(rules.under)))
    counted = met.agg(F.count("*").alias("common")).where(F.col("common") >= needed).select("a", "b")

    rows = rows.where(F.col("members") > SMALL_GROUP)
    blocks = F.ceil(F.col("members") / rules.block).cast("int")
    rows = rows.withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = rows.select("token", "digest", "component", "n", "block", other).select(
        "token",
        "digest",
        "component",
        "n",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.when(F.col("block") == F.col("other"), F.lit(-1)).otherwise(F.col("block")).alias("side"),
    )
    # In a pair of blocks every member stands for its own; alone with itself a block has side -1.
    dealt = dealt.join(sets.select("digest", "sig"), "digest")
    return counted.unionByName(_candidates(dealt, ["token", "low", "high"], rules, forest=False))


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, rules: Grams) -> DataFrame:
    """The pairs that are similar enough, by their whole texts' n-grams.

    Texts meet at the second of a pair, which is held while the others pass by; one with many
    partners is dealt out to several tasks.
    """
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = materialised(pairs, "gram-pairs")
    homes = pairs.groupBy(F.col("b").alias("home")).agg(F.ceil(F.count("*") / 256).cast("int").alias("parts"))
    guests = pairs.join(homes, pairs["b"] == homes["home"]).select(
        "home", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), F.col("a").alias("digest")
    )
    hosts = homes.select(
        "home", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("home").alias("digest")
    )
    needed = materialised(guests.unionByName(hosts).join(sets.select("digest", "rep"), "digest"), "gram-needed")
    bitmap = docs.sparkSession.sparkContext.broadcast(bit_filter(needed.select("rep")))

    @F.pandas_udf("boolean")
    def named(ids: pd.Series) -> pd.Series:
        return pd.Series(may_be_in(bitmap.value, ids.to_numpy()))

    texts = docs.select("doc_id", "text").where(
        F.col("doc_id").isNull() | named(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")))
    )
    texts = texts.join(needed, texts["doc_id"].eqNullSafe(needed["rep"]))
    placed = texts.select("home", "part", "role", "digest", "text").repartition("home", "part")
    rows = placed.sortWithinPartitions("home", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, home, host = _WordHashes(), None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for at, (key, _, role, own) in enumerate(zip(*columns, strict=True)):
                grams = gram_set(batch.column(4)[at].as_py(), rules.words, memo)
                if digest(grams) != own:  # another row with the same id
                    continue
                if role == 0:
                    home, host = key, grams
                elif home == key:
                    shared = len(np.intersect1d(host, grams, assume_unique=True))
                    if shared * rules.under >= (len(host) + len(grams) - shared) * rules.over:
                        found.append((own, key))
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return materialised(rows.mapInArrow(run, LINK).distinct(), "gram-links")


def similar_documents(docs: DataFrame, rules: Grams = Grams()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row: the smallest id it is linked to, itself included.

    A null text, or one without words, has an empty set and links with nothing. Repeated rows have
    equal sets and so link. A null id is no component's smallest unless alone. Other columns are left
    out; an empty table gives none.
    """
    rows = gram_sets(docs, rules)
    sets = rows.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"),
        F.first("n").alias("n"),
        F.first("heads").alias("heads"),
        F.first("prefix").alias("prefix"),
        F.first("sig").alias("sig"),
    )
    sets = materialised(sets, "gram-classes")
    links = _verified(_first_round(sets, rules), docs, sets, rules)
    known = components(links).select(F.col("id").alias("digest"), "component")
    marked = sets.join(known, "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    marked = materialised(marked, "gram-marked")
    more = _verified(_second_round(marked, rules), docs, sets, rules)
    final = components(links.unionByName(more)).select(F.col("id").alias("digest"), "component")
    placed = sets.select("digest", "rep").join(final, "digest", "left")
    placed = placed.select("digest", "rep", F.coalesce("component", "digest").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = materialised(placed.join(smallest, "component").select("digest", "component_id"), "gram-components")
    return rows.select("doc_id", "n", F.col("digest").alias("own")).join(
        found, F.col("own") == found["digest"], "left"
    ).select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, rules: Grams = Grams()) -> DataFrame:
    """The documents that are the smallest id of their component, in the columns of ``docs``.

    Rows that repeat an id stay or go together.
    """
    found = similar_documents(docs, rules)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("stays"))
    return docs.join(stay.distinct(), docs["doc_id"].eqNullSafe(F.col("stays")), "left_semi")
