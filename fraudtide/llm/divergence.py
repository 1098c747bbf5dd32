"""How much the sources of a language differ in their words.

Identical texts of a language become one, with how often each source has it, and are tokenised once; the
counts and document frequencies of their terms are weighted with those multiplicities. Two sources are then
compared over the terms that both have, on top of what each of them has by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudtide.llm.tables import materialised
from fraudtide.llm.vocabulary import Numbers, summed

# A term is a run of letters A-Z and of whatever is not ASCII; only A-Z are lower-cased.
_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256))

HELD = 1_000_000  # terms of texts a task counts at a time


@dataclass(frozen=True)
class Audit:
    """``documents``: in how many documents of its language a term must be. ``smoothing`` is added to every
    count, ``scale`` stands for a probability of 1. ``terms``: how many telling terms a source shows."""

    documents: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    terms: int = 50


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def collapsed(docs: DataFrame) -> DataFrame:
    """``lang, text, sources``: each different text of a language once, and how often each source has it.

    Texts are told apart by 128 bits of hashes. Copies are reduced in the tasks that read them, so a text
    that fills a third of the table is no hot key; ``sources`` has an entry per source at most.
    """
    rows = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")])
    hashes = [F.xxhash64(F.lit(i), "text").alias(f"h{i}") for i in (1, 2)]
    keys = ["lang", "h1", "h2"]
    keyed = rows.select("*", *hashes)
    copies = keyed.groupBy(*keys, "source").agg(F.count("*").alias("n"))
    sources = copies.groupBy(*keys).agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    return keyed.groupBy(*keys).agg(F.any_value("text").alias("text")).join(sources, keys).select("lang", "text", "sources")


SHARES = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]))


def _counted(numbers: Numbers, groups: list[tuple[str, str]], parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """A row per language and term of what a task has counted, with the shares of the sources."""
    group, code, n, documents = (np.concatenate(p) for p in zip(*parts, strict=True))
    key, n, documents = summed(group << 31 | code, n, documents)
    group, code = key >> 31, key & ((1 << 31) - 1)
    names = sorted({lang for lang, _ in groups})
    place = {lang: i for i, lang in enumerate(names)}
    lang = np.array([place[lang] for lang, _ in groups])[group]
    order = np.lexsort((code, lang))
    lang, code = lang[order], code[order]
    starts = np.nonzero(np.r_[True, (lang[1:] != lang[:-1]) | (code[1:] != code[:-1])])[0]
    source = pa.DictionaryArray.from_arrays(pa.array(group[order]), pa.array([s for _, s in groups], pa.string()))
    shares = pa.StructArray.from_arrays(
        [source.dictionary_decode(), pa.array(n[order]), pa.array(documents[order])], fields=list(SHARES.value_type)
    )
    offsets = pa.array(np.r_[starts, len(code)].astype(np.int32))
    terms = pa.array(numbers.words, pa.binary()).take(pa.array(code[starts])).cast(pa.string())
    langs = pa.array(names, pa.string()).take(pa.array(lang[starts]))
    return pa.RecordBatch.from_arrays([langs, terms, pa.ListArray.from_arrays(offsets, shares)], ["lang", "term", "shares"])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, group_no, parts, held = Numbers(), {}, [], 0

    def done() -> pa.RecordBatch:
        return _counted(numbers, list(group_no), parts)

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for lang, value, shares in zip(langs, batch.column(1).cast(pa.binary()), sources, strict=True):
            words = terms_of(value.as_py())
            if not words:
                continue
            code = None
            for share in shares:
                if held >= HELD:
                    yield done()
                    numbers, group_no, parts, held, code = Numbers(), {}, [], 0, None
                if code is None:
                    code, n = np.unique(numbers.of(words), return_counts=True)
                group = group_no.setdefault((lang, share["source"]), len(group_no))
                parts.append((np.full(len(code), group), code, n * share["n"], np.full(len(code), share["n"])))
                held += len(code)
    if parts:
        yield done()


def term_counts(docs: DataFrame, rules: Audit) -> DataFrame:
    """``lang, term, source, n, in_lang, first`` of the kept terms, by source.

    ``in_lang`` is the term's count in its language, ``first`` marks one row of each kept term.
    """
    shares = "array<struct<source:string,n:long,docs:long>>"
    counted = collapsed(docs).mapInArrow(_count_terms, f"lang string, term string, shares {shares}")
    rows = counted.repartition("lang", "term").select("lang", "term", F.inline("shares"))
    each = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    seen = each.withColumns({"in_lang": F.sum("n").over(whole), "in_docs": F.sum("docs").over(whole)})
    seen = seen.withColumn("first", F.row_number().over(whole.orderBy("source")) == 1)
    kept = seen.where(F.col("in_docs") >= rules.documents)
    return materialised(kept.select("lang", "term", "source", "n", "in_lang", "first"), "divergence-terms")


def _share(count: Column | str, total: str, kept: str, rules: Audit) -> Column:
    """A smoothed probability in whole parts of the scale; decimals keep the product exact."""
    above = (F.col(count) if isinstance(count, str) else count) + rules.smoothing
    above = above.cast("decimal(20,0)") * F.lit(rules.scale).cast("decimal(10,0)")
    below = (F.col(total) + rules.smoothing * F.col(kept)).cast("decimal(20,0)")
    return F.when(F.col(kept) > 0, F.lit(1).cast("long") + F.call_function("div", above, below))


def groups_of(docs: DataFrame, terms: DataFrame, rules: Audit) -> DataFrame:
    """Every ``lang, source`` that occurs, with its total ``n``, its language's number of kept terms and
    total, and ``none``, the share of a kept term that it does not have."""
    every = docs.select(*[F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = own.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    sizes = terms.groupBy("lang").agg(F.count_if("first").alias("kept"))
    rows = every.join(own, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang", "left")
    rows = rows.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "kept")])
    none = F.coalesce(_share(F.lit(0), "total", "kept", rules), F.lit(0))
    return materialised(rows.withColumn("none", none), "divergence-groups")


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of each two sources of a language.

    All kept terms count as if neither source had them, then each source's own terms are put right against
    the other's ``none``, by how many terms have a share, then the terms that both have. Nothing is
    done for terms that neither has.
    """
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("other_none"))
    both_of = groups.join(other, "lang").where("source <> item")
    base = both_of.select("lang", "source", "item", (F.col("kept") * gap("none", "other_none")).alias("value"))
    alike = shares.groupBy("lang", "source", "none", "share").agg(F.count("*").alias("terms"))
    own = alike.join(other, "lang").where("source <> item")
    moved = F.col("terms") * (gap("share", "other_none") - gap("none", "other_none"))
    own = own.groupBy("lang", "source", "item").agg(F.sum(moved).alias("value"))
    own = own.union(own.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    right = shares.select("lang", "term", *[F.col(c).alias(f"other_{c}") for c in ("source", "share", "none")])
    met = shares.select("lang", "term", "source", "share", "none").join(right, ["lang", "term"]).where("source < other_source")
    extra = gap("share", "other_share") - gap("share", "other_none") - gap("other_share", "none") + gap("none", "other_none")
    met = met.groupBy("lang", "source", F.col("other_source").alias("item")).agg(F.sum(extra).alias("value"))
    met = met.union(met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    return base.union(own).union(met).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, rules: Audit = Audit()) -> DataFrame:
    """``lang, source, part, item, value, rank`` of ``text, lang, source``.

    Part ``pair``: how far each other source of the language is away, all of them; part ``term``: the terms
    that a source has more often than its language, the first ``rules.terms``. Ranks go by value, then by
    the item's bytes. Null texts, languages and sources are read as empty ones; repeated rows count each; a
    source without terms is compared all the same, and all values of a language without kept terms are 0;
    an empty table gives no rows; other columns are left out.
    """
    terms = term_counts(docs, rules)
    groups = groups_of(docs, terms, rules)
    rated = terms.join(groups, ["lang", "source"])
    rated = rated.withColumns(
        {"share": _share("n", "total", "kept", rules), "usual": _share("in_lang", "lang_total", "kept", rules)}
    )
    telling = rated.where("share > usual").select(
        "lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    pairs = _pairs(groups, rated.select("lang", "term", "source", "share", "none"))
    ranked = pairs.withColumn("rank", rank).withColumn("part", F.lit("pair")).unionByName(
        telling.withColumn("rank", rank).where(F.col("rank") <= rules.terms).withColumn("part", F.lit("term"))
    )
    return ranked.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
