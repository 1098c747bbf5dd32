"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity; two sets that are similar enough share a
word among the first few of each, which is what they are joined on. Length and position bound the
overlap before the texts are compared. A line goes when an earlier line, kept or not, matches it.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudtide.llm.tables import Steps, materialised

BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
CLASS_BITS = 20  # words are counted in so many hash classes, whatever the size of the corpus
STRIP_BITS = 8  # their levels are held in so many strips
LEVELS = 3  # a class has one byte, its level: so many for every doubling of its count, 127 at most
HASH_BITS = 63 - 7
SET = ("key", "low", "high", "shape")  # what of a set moves with each word of its prefix
# A level is held as the byte whose checksum begins with it: no function makes a number of a byte faster.
LEVEL_BYTES = {zlib.crc32(bytes([b])) >> 24: f"{b:02X}" for b in range(256)}
FEW = 256  # the sets of a word whose class is counted about so often at most all meet at once


@dataclass(frozen=True)
class Similar:
    """Jaccard of at least ``over / under``."""

    over: int = 4
    under: int = 5


def _words(text: Column) -> Column:
    """Words of a text, and empty strings where blanks follow each other. One plain separator is several
    times as fast as a class of characters, and looking for the others much faster than replacing them."""
    rare = [F.lit(blank) for blank in BLANK_CHARACTERS[1:]]
    plain = reduce(lambda t, blank: F.replace(t, blank, F.lit(" ")), rare, text)
    has_rare = reduce(or_, [F.contains(text, blank) for blank in rare])
    return F.split(F.when(has_rare, plain).otherwise(text), " ")


def _version(text: Column) -> Column:
    """Tells rows of one id but different texts apart."""
    return F.xxhash64(text)


def _identity(doc_id: Column) -> list[Column]:
    """An id, null or not, as columns without nulls, so that joins and groups share one partitioning."""
    return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id")]


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, version, line_no, line``."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select("doc_id", _version(text).alias("version"), F.split(text, "\n").alias("all"))
    # For the plain explode Spark infers a filter on the array, which splits every text again.
    return rows.select("doc_id", "version", F.posexplode_outer("all").alias("line_no", "line"))


def _level(count: Column) -> Column:
    return F.least(F.lit(127), F.floor(LEVELS * F.log2(count)).cast("int"))


def word_levels(docs: DataFrame) -> Column:
    """How frequent each of the 2^CLASS_BITS classes of word hashes is in ``text``: a byte each.

    Counted over all rows, map-side first. The 2^CLASS_BITS bytes, a fixed number, come to the
    driver and go back as a constant: an array of strips, one for each value of the lowest STRIP_BITS bits.
    A plan's text names the strips of an array, but has every digit of a plain binary, several times over in
    each description that the driver makes of a running query.
    """
    size = 1 << CLASS_BITS
    words = docs.select(F.explode_outer(_words(F.coalesce(docs["text"], F.lit("")))).alias("w")).where("w <> ''")
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(size - 1)).alias("id")).agg(F.count("*").alias("n"))
    codes = F.array(*[F.lit(LEVEL_BYTES[level]) for level in range(128)])
    level = F.get(codes, F.coalesce(_level(F.col("n")), F.lit(0))).alias("level")
    every = docs.sparkSession.range(size).join(counts, "id", "left").select("id", level)
    strip = F.array_sort(F.collect_list(F.struct("id", "level")))["level"]
    strips = every.groupBy(F.col("id").bitwiseAND(F.lit((1 << STRIP_BITS) - 1)).alias("at")).agg(F.array_join(strip, "").alias("bytes"))
    return F.array(*[F.unhex(F.lit(row["bytes"])) for row in strips.orderBy("at").collect()])


def _hashes(text: Column) -> Column:
    """Distinct words as hashes."""
    return F.array_distinct(F.array_remove(F.transform(_words(text), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))


def _ordered(hashes: Column, levels: Column) -> Column:
    """Hashes of words as bigints in the order of rarity: level of the class, which the low bits of a hash name,
    then its high bits."""

    def place(h: Column) -> Column:
        strip = F.get(levels, h.bitwiseAND(F.lit((1 << STRIP_BITS) - 1)))
        at = F.shiftright(h, STRIP_BITS).bitwiseAND(F.lit((1 << CLASS_BITS - STRIP_BITS) - 1)).cast("int") + 1
        # Never null: arrays that may have nulls are sorted as objects.
        checksum = F.coalesce(F.crc32(F.substring(strip, at, F.lit(1))), F.lit(0).cast("long"))
        return F.shiftleft(F.shiftright(checksum, 24), HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - HASH_BITS))

    return F.sort_array(F.transform(hashes, place))


def _has_words(line: str | Column) -> Column:
    return F.btrim(line, F.lit(BLANK_CHARACTERS)) != ""


def classes(rows: DataFrame) -> DataFrame:
    """Equal lines as one: ``key, more`` and the first of them, ``doc_id, version, line_no, line``.

    Equal lines are reduced map-side, so one that fills a third of all rows is no hot key. Lines are
    told apart by 128 bits; different lines of equal words are found by the join like others.
    """
    keyed = rows.where(_has_words("line")).withColumns({"key": F.xxhash64("line"), "more": F.xxhash64(F.lit(1), "line")})
    first = F.min(F.struct("doc_id", "line_no", "version", "line")).alias("first")
    return materialised(keyed.groupBy("key", "more").agg(first).select("key", "more", "first.*"), "line-classes")


def _parities(words: str, half: bool) -> Column:
    """For each value of the low six bits of a word, whether an odd number of words have it: of all words,
    or of the half of them whose next bit is set."""
    one = F.lit(1).cast("long")

    def turn(bits: Column, w: Column) -> Column:
        mine = F.shiftright(w, 6).bitwiseAND(one) if half else one
        return bits.bitwiseXOR(F.call_function("shiftleft", mine, w.bitwiseAND(F.lit(63)).cast("int")))

    return F.aggregate(words, F.lit(0).cast("long"), turn)


def prefixes(groups: DataFrame, levels: Column, rules: Similar) -> DataFrame:
    """``word, key, low, high, shape``: the rarest words of each set that it may be found by.

    ``low`` and ``high`` are 128 parities of the set: every one that differs between two sets is a word that only
    one of them has, and unlike bits that are merely set they do not fill up in long lines. ``shape`` has the
    size of the set and, in its lower half, the place of the word.
    """
    sets = groups.select("key", _ordered(_hashes(F.col("line")), levels).alias("words"))
    needed = F.expr(f"(size(words) * {rules.over} + {rules.under - 1}) div {rules.under}").cast("int")
    first = F.slice("words", F.lit(1), F.size("words") - needed + 1)
    bits = [_parities("words", False).alias("low"), _parities("words", True).alias("high")]
    rows = sets.select("key", F.size("words").alias("n"), *bits, first.alias("first"))
    rows = rows.select("key", "n", F.col("low").bitwiseXOR(F.col("high")).alias("low"), "high", F.posexplode_outer("first").alias("pos", "word"))
    shape = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("pos").cast("long"))
    return rows.select("word", *SET[:-1], shape.alias("shape"))


def _n(side: str) -> Column:
    return F.shiftright(F.col(f"{side}.shape"), 32)


def _place(side: str) -> Column:
    return F.col(f"{side}.shape").bitwiseAND(F.lit((1 << 32) - 1))


def _may_match(a: str, b: str, rules: Similar) -> Column:
    """Length, position and parity filters: what the two may share still reaches the overlap needed."""
    both = _n(a) + _n(b)
    differ = [F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in ("low", "high")]
    size = F.least(_n(a), _n(b)) * rules.under >= F.greatest(_n(a), _n(b)) * rules.over
    rest = F.least(_n(a) - _place(a), _n(b) - _place(b))
    needed = both * rules.over
    return (
        ((both - differ[0] - differ[1]) * (rules.over + rules.under) >= needed * 2)
        & (rest * (rules.over + rules.under) >= needed)
        & size
    )


def _meets(a: str, b: str, rules: Similar) -> Column:
    """Whether ``a``, which has at least as many words, may match ``b`` and their word is among the first of
    ``b``: as ``a`` is no smaller, they share a word among fewer of ``b`` than ``prefixes`` has."""
    larger = (_n(a) > _n(b)) | ((_n(a) == _n(b)) & (F.col(f"{a}.key") < F.col(f"{b}.key")))
    # The place is below n - ceil(n * 2 * over / (over + under)) + 1.
    early = (_n(b) - _place(b)) * (rules.over + rules.under) >= _n(b) * (2 * rules.over)
    return larger & early & _may_match(a, b, rules)


def _verified(pairs: DataFrame, groups: DataFrame, rules: Similar, steps: Steps) -> DataFrame:
    """``key, more`` of the later line of each of the pairs ``key, other`` that match by their words."""
    pairs = steps.written(pairs.distinct(), "line-pairs")
    named = steps.written(pairs.select("key").union(pairs.select("other")).distinct(), "line-names")
    # Only the lines that are named move on, split into words once.
    words = F.array_remove(F.array_distinct(_words(F.col("line"))), "").alias("words")
    age = F.struct("doc_id", "line_no", "key").alias("age")
    sets = steps.written(groups.join(named, "key").select("key", "more", age, words), "line-sets")
    a, b = sets.alias("a"), sets.alias("b")
    both = pairs.alias("p").join(a, F.expr("p.key = a.key")).join(b, F.expr("p.other = b.key"))
    shared = F.size(F.array_intersect("a.words", "b.words"))
    close = shared * (rules.over + rules.under) >= (F.size("a.words") + F.size("b.words")) * rules.over
    later = F.col("a.age") > F.col("b.age")
    names = [F.when(later, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in ("key", "more")]
    return both.where(close).select(*names).distinct()


def _met(groups: DataFrame, levels: Column, rules: Similar, steps: Steps) -> tuple[DataFrame, DataFrame]:
    """``key, other`` of the pairs that may match by a word of at most ``FEW`` lines, and the rows of
    ``prefixes`` of the words of more.

    One join does both, so that prefixes are computed and shuffled once: a row of a frequent word is dealt out
    by word and key and meets itself alone. The join has a single bigint as its key, which sorts fastest.
    """
    frequent = F.shiftright("word", HASH_BITS) > _level(F.lit(FEW))
    rows = prefixes(groups, levels, rules)
    rows = rows.withColumn("at", F.when(frequent, F.xxhash64("word", "key")).otherwise(F.col("word")))
    a, b = rows.alias("a"), rows.alias("b")
    # Both sides use the same columns and neither has a filter of its own: they share one exchange.
    alone, other = [F.shiftright(f"{side}.word", HASH_BITS) > _level(F.lit(FEW)) for side in "ab"]
    meets = F.when(alone | other, F.expr("a.key = b.key")).otherwise(_meets("a", "b", rules))
    pairs = a.join(b, F.col("a.at") == F.col("b.at")).where(meets)
    names = [F.least("a.key", "b.key").alias("key"), F.when(~alone, F.greatest("a.key", "b.key")).alias("other")]
    met = steps.written(pairs.select(*names, *[F.when(alone, F.col(f"a.{c}")).alias(c) for c in ("word", *SET[1:])]), "line-met")
    return met.where("other IS NOT NULL").select("key", "other"), met.where("other IS NULL").drop("other")


def later_matches(groups: DataFrame, levels: Column, rules: Similar) -> DataFrame:
    """``key, more`` of every line that matches an earlier one.

    The sets of a word that few have meet each other. In a larger group each set first meets the first
    of all and the one before it, which decides nearly all of a group of variants. Who is still
    undecided, in whatever group, then meets all the others before it.
    """
    with Steps() as steps:
        met, many = _met(groups, levels, rules, steps)
        order = Window.partitionBy("word").orderBy("doc_id", "line_no", "key")
        member = F.struct(*SET)
        placed = many.join(groups.select("key", "doc_id", "line_no"), "key").select(
            "word",
            member.alias("a"),
            F.row_number().over(order).alias("place"),
            F.first(member).over(order).alias("leader"),
            F.lag(member).over(order).alias("last"),
        )
        shared = placed.where("place > 1").select(
            "word",
            "a.*",
            "place",
            F.when(_may_match("a", "leader", rules), F.col("leader.key")).alias("leader"),
            F.when((F.col("place") > 2) & _may_match("a", "last", rules), F.col("last.key")).alias("last"),
        )
        shared = steps.written(shared, "line-words")
        near = shared.select("key", F.explode(F.array_compact(F.array("leader", "last"))).alias("other")).where("key <> other")
        near = near.select(F.least("key", "other").alias("key"), F.greatest("key", "other").alias("other"))
        first = steps.written(_verified(met.unionByName(near), groups, rules, steps), "line-matches")

        members = shared.select("word", "place", *SET)
        undecided = members.where("place > 3").join(first.select("key"), "key", "left_anti")
        more = (
            undecided.alias("a")
            .join(members.alias("b"), F.expr("a.word = b.word AND b.place < a.place - 1"))
            .where(_may_match("a", "b", rules))
            .select(F.least("a.key", "b.key").alias("key"), F.greatest("a.key", "b.key").alias("other"))
        )
        return materialised(first.unionByName(_verified(more, groups, rules, steps)).distinct(), "line-matches")


def kept_lines(docs: DataFrame, rules: Similar) -> DataFrame:
    """``id, no_id, version, kept``: the numbers of the lines with words that stay: first lines that match
    none before them."""
    groups = classes(lines(docs))
    gone = later_matches(groups, word_levels(groups.select(F.col("line").alias("text"))), rules)
    stays = groups.join(gone, ["key", "more"], "left_anti")
    return stays.groupBy(*_identity(F.col("doc_id")), "version").agg(F.collect_list("line_no").alias("kept"))


def dedup_lines(docs: DataFrame, rules: Similar = Similar()) -> DataFrame:
    """``doc_id, version, n_lines, n_kept, text`` per id and text, the text of the lines that stay.

    Earlier is by ``doc_id``, then line. A null or empty text has one line without words, which stays;
    rows that repeat id and text are one row here. Null ids come first.
    """
    whole = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(*_identity(docs["doc_id"]), _version(whole).alias("version"), whole.alias("text"))
    keys = ["id", "no_id", "version"]
    # Split below the join: above it, the lines would be split again for every line that is looked up.
    every = rows.groupBy(*keys).agg(F.min("text").alias("text")).select(*keys, F.split("text", "\n").alias("all"))
    joined = every.join(kept_lines(docs, rules), keys, "left")
    number = F.sequence(F.lit(0), F.size("all") - 1)
    # Lines without words stay as well.
    stays = F.filter(number, lambda n: ~_has_words(F.get("all", n)) | F.coalesce(F.array_contains("kept", n), F.lit(False)))
    joined = joined.withColumn("kept", stays)
    text = F.array_join(F.transform("kept", lambda n: F.get("all", n)), "\n")
    return joined.select(
        F.when(~F.col("no_id"), F.col("id")).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "version",
        F.size("all").cast("long").alias("n_lines"),
        F.size("kept").cast("long").alias("n_kept"),
        text.alias("text"),
    )


def without_repeats(docs: DataFrame, rules: Similar = Similar()) -> DataFrame:
    """The documents with the lines that stay, in the columns of ``docs``; ``n_chars`` follows the text.

    A document all of whose words are gone goes itself; one that had none stays as it is. Rows that
    repeat id and text become one row, with the other columns of one of them, the same in every run.
    """
    names = docs.columns
    whole = F.coalesce(docs["text"], F.lit(""))
    kept = [c for c in names if c not in ("doc_id", "text")]
    # The other columns are those of one row: the first by a hash of them all, nulls and maps aside.
    plain = [c for c in kept if "map<" not in docs.schema[c].dataType.simpleString()]
    others = F.struct(F.xxhash64(*plain) if plain else F.lit(0), *[docs[c].alias(f"own_{i}") for i, c in enumerate(names) if c in plain])
    maps = [F.any_value(docs[c]).alias(f"own_{i}") for i, c in enumerate(names) if c in kept and c not in plain]
    had = F.bool_or(F.btrim(whole, F.lit(BLANK_CHARACTERS)) != "").alias("had")
    keys = [docs["doc_id"].alias("own_id"), _version(whole).alias("own_version")]
    rows = docs.groupBy(*keys).agg(had, F.min(others).alias("others"), *maps)
    rows = rows.select("own_id", "own_version", "had", "others.*", *[f"own_{i}" for i, c in enumerate(names) if c in kept and c not in plain])
    fresh = dedup_lines(docs.select("doc_id", "text"), rules)
    joined = fresh.join(rows, F.expr("doc_id <=> own_id AND version = own_version"))
    left = F.btrim("text", F.lit(BLANK_CHARACTERS)) != ""
    joined = joined.where(left | ~F.col("had"))
    known = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in names:
        known["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return joined.select(*[known.get(c, F.col(f"own_{i}")).alias(c) for i, c in enumerate(names)])


def line_report(docs: DataFrame, rules: Similar = Similar()) -> DataFrame:
    """``doc_id, n_lines, n_kept, text`` of each document after deduplication."""
    return dedup_lines(docs.select("doc_id", "text"), rules).drop("version")
