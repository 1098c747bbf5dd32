"""Mix sources to target weights by capped water-filling.

Each source gets words in proportion to its weight; a source that would be repeated more than
``max_epochs`` times is clamped there and what it gives up is shared among the others by weight,
until none is above. Documents are then repeated whole, and the remaining fraction of a repetition
is taken in a seeded order of the source's documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudtide.functions.hashing import HASH_BITS, row_hash
from fraudtide.llm.tables import WORD, materialised


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources by code point, null last; ``share`` is of all words."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    max_epochs: int = 2
    seed: int = 7
    bucket_bits: int = 12


def sized(docs: DataFrame, mix: Mix) -> DataFrame:
    """Add ``size`` (words; 0 for a null text), the seeded ``place`` in the source and its ``bucket``."""
    key = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    place = row_hash(F.concat(F.lit("mix:"), key), mix.seed)
    size = F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumns(
        {"size": size, "place": place, "bucket": F.shiftright(place, HASH_BITS - mix.bucket_bits)}
    )


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Water-filling over ``source, source_size``; adds ``target``.

    Sources are taken by ascending size per weight, the order in which a rising level clamps them:
    the level is right at the first source that it leaves below its clamp. One row per source, so
    the two global orders are over the number of sources only.
    """
    choices = F.array(*[F.lit(w) for w in mix.weights])
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weighted = ranked.withColumn(
        "weight", F.element_at(choices, ((F.col("rank") - 1) % len(mix.weights) + 1).cast("int"))
    ).withColumn("clamp", F.col("source_size") * mix.max_epochs)
    filled = Window.orderBy(F.col("clamp") / F.col("weight"), "rank")
    above = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    below = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * F.lit(mix.share) - F.coalesce(F.sum("clamp").over(below), F.lit(0))
    ) / F.sum("weight").over(above)
    levels = weighted.withColumn("level", level)
    holds = F.when(F.col("level") * F.col("weight") <= F.col("clamp"), F.struct("clamp_order", "level"))
    whole = Window.partitionBy()
    final = (
        levels.withColumn("clamp_order", F.row_number().over(filled))
        .withColumn("final", F.min(holds).over(whole)["level"])
        .withColumn("target", F.least(F.col("clamp").cast("double"), F.col("final") * F.col("weight")))
    )
    return final.select("source", "source_size", "target")


def mix_plan(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: its target, whole repetitions, and where the fractional one ends.

    The fraction ends in bucket ``edge``, ``edge_left`` words into it. Words are summed per source
    and bucket first, so no task holds a source; a source has at most 2^bucket_bits such rows.
    """
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    buckets = materialised(buckets, "mix-buckets")
    sources = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    planned = targets(sources, mix).withColumn("budget", F.floor(F.col("target") + 0.5))
    planned = planned.withColumn(
        "whole",
        F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)),
    ).withColumn("part", F.col("budget") - F.col("whole") * F.col("source_size"))
    planned = materialised(planned, "mix-targets")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    run = buckets.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    ends = planned.alias("p").join(run.alias("b"), F.expr("p.source <=> b.source")).where(
        "b.before < p.part AND p.part <= b.before + b.words"
    )
    edge = ends.groupBy(F.col("p.source").alias("of")).agg(
        F.min("b.bucket").alias("edge"), F.min(F.expr("p.part - b.before")).alias("edge_left")
    )
    plan = planned.join(edge, planned["source"].eqNullSafe(edge["of"]), "left").select(
        planned["source"].alias("of"),
        "source_size",
        "target",
        "whole",
        F.coalesce("edge", F.lit(-1)).alias("edge"),
        F.coalesce("edge_left", F.lit(0)).alias("edge_left"),
    )
    return materialised(plan, "mix-plan")


def shares(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``source_size, target, whole`` and ``part``, the words of the fractional repetition.

    Only the rows of each source's last bucket need the words before them; they are the 2^-bucket_bits
    part of a source, so a hot source is not gathered. Rows with equal places go by id and size.
    """
    joined = rows.join(plan, rows["source"].eqNullSafe(plan["of"])).drop("of")
    inside = joined.where("bucket <> edge").withColumn(
        "part", F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0).cast("long"))
    )
    order = Window.partitionBy("source").orderBy("place", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("edge_left") - before))
    last = joined.where("bucket = edge").withColumn("part", part)
    return inside.unionByName(last)


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """How many words the mix takes from each document.

    Returns ``doc_id, size, source_size, target, taken``. Null and empty texts have size 0 and give
    nothing; a source without words has target 0; a null source is a source of its own; repeated
    rows count each; other columns are left out; an empty table gives none.
    """
    rows = materialised(
        sized(docs.select("doc_id", "source", "text"), mix).drop("text"), "mix-sizes"
    )
    taken = shares(rows, mix_plan(rows, mix))
    return taken.select(
        "doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken")
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: every document as often as its source asks, in the columns of ``docs``.

    Needs ``doc_id, text, source``. Texts stay as they are: the document at which a source's fraction ends,
    one per source, is taken if at least half of its words are due, so a source misses its target by half a document
    at most. Null and empty texts have no words and are in no mix; a null source is a source of its own;
    repeated rows count each; rows with equal places go by id and size; an empty table gives none.
    """
    names = docs.columns
    columns = ["doc_id", "source", "text"]
    narrow = materialised(sized(docs.select(*columns), mix).drop("text"), "mix-sizes")
    plan = mix_plan(narrow, mix)
    body = sized(docs.select(*columns, F.struct(*[docs[c] for c in names]).alias("row")), mix)
    taken = shares(body, plan)
    once_more = (F.col("part") > 0) & (F.col("part") * 2 >= F.col("size"))
    times = F.when(F.col("size") > 0, F.col("whole") + once_more.cast("long")).otherwise(0)
    rows = taken.select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names])
