"""SimHash document fingerprints and the search for all within a Hamming radius.

Every term of a text, a run of three words, has a 128-bit hash whose bits vote with the term's weight;
the signs of the sums are the fingerprint. The search keeps one table per choice of blocks that may
all agree: within ``radius`` differing bits at least ``blocks - radius`` blocks are untouched.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudtide.llm.tables import BLANKS, materialised, texts

BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
HALVES = ("hi", "lo")
BITS = 128
TERM_WORDS = 3
LONG_WORD = 4  # words of more characters weigh 1 more
TWO_LANES = 0x0000000100000001  # two 32-bit counters in one bigint
LANE = 0xFFFFFFFF

ID_RANGES = 256
DOCS_PER_BUCKET = 1024


def votes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprint of ``text`` for each value of ``keys``, as the bigints ``hi`` and ``lo``.

    Terms are exploded and summed map-side; two vote counters share one bigint. A text of fewer
    words is one term, and so is one without words. ``keys`` must tell rows apart.
    """
    trimmed = F.btrim("text", F.lit(BLANK_CHARACTERS))
    listed = rows.select(*keys, F.split(trimmed, BLANKS).alias("w"))
    many = F.greatest(F.lit(1), F.size("w") - (TERM_WORDS - 1))
    runs = F.arrays_zip(*[F.slice("w", F.lit(i + 1), many).alias(f"w{i}") for i in range(TERM_WORDS)])
    terms = listed.select(*keys, F.inline(runs))
    parts = [F.col(f"w{i}") for i in range(TERM_WORDS)]
    weight = reduce(
        lambda a, w: a + F.when(F.length(w) > LONG_WORD, F.lit(1)).otherwise(F.lit(0)), parts, F.lit(1)
    ).cast("long")
    hashed = terms.select(
        *keys, weight.alias("weight"), *[F.xxhash64(F.lit(half), *parts).alias(half) for half in HALVES]
    )
    lanes = [
        F.sum(F.shiftrightunsigned(F.col(half), k).bitwiseAND(F.lit(TWO_LANES)) * F.col("weight")).alias(f"{half}{k}")
        for half in HALVES
        for k in range(32)
    ]
    summed = hashed.groupBy(*keys).agg(F.sum("weight").alias("all"), *lanes)

    def sign(half: str) -> Column:
        def bit(value: Column, k: int) -> Column:
            power = (1 << k) - (1 << 64 if k == 63 else 0)
            return F.when(value * 2 > F.col("all"), F.lit(power)).otherwise(F.lit(0)).cast("long")

        lane = [F.col(f"{half}{k}") for k in range(32)]
        low = [bit(lane[k].bitwiseAND(F.lit(LANE)), k) for k in range(32)]
        high = [bit(F.shiftrightunsigned(lane[k], 32), k + 32) for k in range(32)]
        return reduce(lambda a, b: a.bitwiseOR(b), low + high)

    return summed.select(*keys, *[sign(half).alias(half) for half in HALVES])


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def hex_text(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def id_buckets(docs: DataFrame) -> Column:
    """A bucket number that rises with ``doc_id``: quantile ranges, each cut into equal widths.

    At most ``ID_RANGES`` quantiles come to the driver; the number of widths follows the row count,
    so that a bucket has about ``DOCS_PER_BUCKET`` documents. Null ids come first, in bucket -1.
    """
    shares = [i / ID_RANGES for i in range(ID_RANGES + 1)]
    found = docs.agg(F.count("doc_id").alias("n"), F.percentile_approx("doc_id", shares).alias("q")).first()
    if not found["n"]:
        return F.lit(-1).cast("long")
    ends = sorted(set(found["q"]))[:: -(-ID_RANGES * DOCS_PER_BUCKET // found["n"])]
    splits = -(-found["n"] // (DOCS_PER_BUCKET * len(ends)))
    lows = F.array(*[F.lit(e).cast("long") for e in ends])
    doc_id = F.col("doc_id").cast("long")
    range_no = F.greatest(F.lit(1), F.size(F.filter(lows, lambda e: e <= doc_id)))
    low, last = F.element_at(lows, range_no), F.lit(found["q"][-1]).cast("long")
    high = F.when(range_no == len(ends), last).otherwise(
        F.element_at(lows, F.least(F.lit(len(ends)), range_no + 1))
    )
    share = (doc_id - low) / F.greatest(F.lit(1).cast("long"), high - low)
    inside = F.greatest(F.lit(0), F.least(F.lit(splits - 1), F.floor(share * splits)))
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(range_no * splits + inside).cast("long")


def with_next(docs: DataFrame) -> DataFrame:
    """``bucket, place, guest, doc_id, text, next_text``: documents in the order of ``doc_id, text``.

    The order runs inside buckets; each also gets, as a guest that comes last, the first document of
    the bucket after it (of the first bucket after the last). A third of all rows cannot share a
    bucket unless they share an id. The one global order is over bucket numbers.
    """
    rows = texts(docs)
    rows = rows.withColumn("bucket", id_buckets(docs))
    first = F.min(F.struct("doc_id", "text")).alias("first")
    heads = materialised(rows.groupBy("bucket").agg(first), "simhash-heads")
    order = Window.orderBy("bucket")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = heads.select(
        F.col("bucket").alias("of"), F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(whole)).alias("host")
    )
    guests = heads.join(before, heads["bucket"] == before["of"]).select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.text").alias("text"), F.col("host").alias("bucket")
    )
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    inside = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    return both.select(
        "bucket",
        F.row_number().over(inside).alias("place"),
        "guest",
        "doc_id",
        "text",
        F.lead("text").over(inside).alias("next_text"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, hi, lo`` of each row; null texts are empty ones, repeated rows give repeated rows."""
    rows = with_next(docs).where("NOT guest").select("bucket", "place", "doc_id", "text")
    return votes(rows, ["bucket", "place", "doc_id"]).select("doc_id", *HALVES)


def block_tables(blocks: int, radius: int) -> list[tuple[int, ...]]:
    """The choices of blocks that may all agree, in a fixed order."""
    return list(combinations(range(blocks), blocks - radius))


def _block(i: int, blocks: int) -> list[tuple[str, int, int]]:
    """The pieces (half, first bit, width) of block ``i``."""
    begin, end = BITS * i // blocks, BITS * (i + 1) // blocks
    pieces = []
    for at, half in enumerate(HALVES):
        a, b = max(begin, 64 * at), min(end, 64 * (at + 1))
        if a < b:
            pieces.append((half, a - 64 * at, b - a))
    return pieces


def _bits(value: Column, first: int, width: int) -> Column:
    shifted = F.shiftrightunsigned(value, first)
    return shifted if width == 64 else shifted.bitwiseAND(F.lit((1 << width) - 1))


def near(queries: DataFrame, index: DataFrame, radius: int = 4, blocks: int = 6) -> DataFrame:
    """Pairs of a query's and an index row's fingerprint at most ``radius`` bits apart.

    Both have ``hi, lo``, each fingerprint once. Returns ``hi, lo, near_hi, near_lo, bits``, each pair
    once: a pair that agrees in more blocks than asked for counts in its first table only. Keys have
    ``128 * (blocks - radius) / blocks`` bits, so a table's buckets stay small.
    """
    chosen = block_tables(blocks, radius)

    def keyed(df: DataFrame, prefix: str = "") -> DataFrame:
        keys = [
            F.struct(
                F.lit(t).alias("table"),
                F.xxhash64(*[_bits(F.col(prefix + h), a, w) for i in table for h, a, w in _block(i, blocks)]).alias("key"),
            )
            for t, table in enumerate(chosen)
        ]
        return df.select("*", F.explode(F.array(*keys)).alias("at")).select("*", "at.table", "at.key").drop("at")

    left = keyed(queries.select(*HALVES))
    right = keyed(index.select(F.col("hi").alias("near_hi"), F.col("lo").alias("near_lo")), "near_")

    def agrees(i: int) -> Column:
        same = [_bits(F.col(h).bitwiseXOR(F.col(f"near_{h}")), a, w) == 0 for h, a, w in _block(i, blocks)]
        return reduce(lambda a, b: a & b, same)

    match = [reduce(lambda a, b: a & b, [F.col(f"same{i}") for i in table]) for table in chosen]
    first = F.coalesce(*[F.when(m, F.lit(t)) for t, m in enumerate(match)])
    pairs = left.join(right, ["table", "key"])
    bits = distance((F.col("hi"), F.col("lo")), (F.col("near_hi"), F.col("near_lo")))
    pairs = pairs.withColumn("bits", bits).where(F.col("bits") <= radius)
    pairs = pairs.withColumns({f"same{i}": agrees(i) for i in range(blocks)})
    return pairs.where(first == F.col("table")).select(*HALVES, "near_hi", "near_lo", "bits")


def fingerprint_report(docs: DataFrame, radius: int = 4, blocks: int = 6, every: int = 20) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how near they are.

    The edited text has the last half of the text replaced by as much of the next document's start.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    (1 minus the share of differing bits) and ``n_within``: for documents whose id is divisible by
    ``every``, how many others have a fingerprint within ``radius`` bits; null for the rest.
    Null and empty texts are empty texts, all with one fingerprint. Rows with equal ids follow each
    other by text; a lone document is its own next one. Other columns are left out.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.length("text") - half)
    edited = F.concat(kept, F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = with_next(docs).withColumn("edited", edited)
    rows = rows.withColumns({"n_chars": F.length("text").cast("long"), "sha": F.sha2("edited", 256)})
    names = ["bucket", "place", "guest", "doc_id", "n_chars", "sha"]
    versions = F.array(
        F.struct(F.lit(0).alias("edit"), F.col("text")), F.struct(F.lit(1).alias("edit"), F.col("edited").alias("text"))
    )
    both = rows.select(*names, F.explode(versions).alias("v")).select(*names, "v.edit", "v.text")
    each = votes(both.where("NOT guest OR edit = 0"), [*names, "edit"])
    own = {f"{h}{e}": F.max(F.when(F.col("edit") == e, F.col(h))).alias(f"{h}{e}") for e in (0, 1) for h in HALVES}
    wide = each.groupBy(*names).agg(*own.values())
    inside = Window.partitionBy("bucket").orderBy("place")
    wide = wide.withColumns({f"{h}2": F.lead(f"{h}0").over(inside) for h in HALVES}).where("NOT guest")
    wide = materialised(wide, "simhash-fingerprints")

    shared = wide.groupBy(F.col("hi0").alias("hi"), F.col("lo0").alias("lo")).agg(F.count("*").alias("n"))
    asked = wide.where(F.col("doc_id") % every == 0).select(F.col("hi0").alias("hi"), F.col("lo0").alias("lo"))
    pairs = near(asked.distinct(), shared, radius, blocks)
    found = (
        pairs.join(shared.select(F.col("hi").alias("near_hi"), F.col("lo").alias("near_lo"), "n"), ["near_hi", "near_lo"])
        .groupBy(F.col("hi").alias("hi0"), F.col("lo").alias("lo0"))
        .agg((F.sum("n") - 1).alias("n_within"))
    )
    likeness = [
        (1 - distance((F.col("hi0"), F.col("lo0")), (F.col(f"hi{e}"), F.col(f"lo{e}"))) / F.lit(float(BITS)))
        for e in (1, 2)
    ]
    return wide.join(found, ["hi0", "lo0"], "left").select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        hex_text(F.col("hi0"), F.col("lo0")).alias("fingerprint"),
        hex_text(F.col("hi1"), F.col("lo1")).alias("edited_fingerprint"),
        likeness[0].alias("near_edited"),
        likeness[1].alias("near_next"),
        F.when(F.col("doc_id") % every == 0, F.col("n_within")).alias("n_within"),
    )
