"""Collocations: which phrases occur far more often than their parts would make one expect.

The phrases of up to four words are the upper nodes of a suffix tree over the words of the corpus. The tree
is cut vertically, by word prefixes: a prefix whose suffixes would not fit the memory of a task is extended
by another word, and prefixes are put together into groups that fit. Every group builds its subtree, cut off
at the depth of the longest phrase, from the suffixes that begin with its prefixes, on its own; how often a
phrase occurs is the sum of the leaves below its node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudtide.llm.tables import materialised
from fraudtide.llm.vocabulary import Numbers

# Pieces end at these characters, blanks and tabs stand between words; only A-Z are lower-cased.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
STOP = b"."  # no word has it
WORD_BYTES = bytes(STOP[0] if b in PIECE_ENDS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

HELD = 2_000_000  # words a task counts at a time


@dataclass(frozen=True)
class Mining:
    """``least``: how often a phrase must occur; ``words``: how long it may be; ``covered``: the percentage
    of its occurrences inside one longer phrase from which on it is left out; ``best``: how many phrases a
    language shows; ``memory``: how many suffixes a group may have.

    At most one prefix for every ``memory`` words of the corpus, and depth, is too heavy for a group and
    sent to all tasks; raise ``memory`` with the corpus.
    """

    least: int = 30
    words: int = 4
    covered: int = 80
    best: int = 2000
    memory: int = 500_000
    scale: int = 2_000_000


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, with ``STOP`` wherever a piece ends."""
    return text.translate(WORD_BYTES).replace(STOP, b" . ").split()


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, dict[str, np.ndarray]]]:
    """Of about ``HELD`` words at a time: the different words, and per language the numbers of the words in
    order. 0 stands between texts and pieces."""
    numbers, held, size = Numbers((STOP,)), {}, 0
    stop = np.zeros(1, dtype=np.int64)

    def done() -> tuple[pa.Array, dict[str, np.ndarray]]:
        return pa.array(numbers.words, pa.binary()), {lang: np.concatenate(parts) for lang, parts in held.items()}

    for batch in batches:
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            code = numbers.of(words_of(value.as_py()))
            held.setdefault(lang, [stop]).extend((code, stop))
            size += len(code)
            if size >= HELD:
                yield done()
                numbers, held, size = Numbers((STOP,)), {}, 0
    if size:
        yield done()


def _hashes(lang: str, prefixes: list[bytes]) -> np.ndarray:
    start = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(p, start) for p in prefixes), dtype=np.uint64, count=len(prefixes))


@dataclass(frozen=True)
class Frequent:
    """A bitmap of the words that occur often enough: who is not in it does not. 16 bits a word, up to 2^28
    bits (32 MB); beyond 17 million words it lets more and more others pass, which costs time but no result."""

    bits: np.ndarray

    @staticmethod
    def of(words: DataFrame, rules: Mining) -> Frequent:
        often = words.where(F.col("n") >= rules.least)
        size = 1 << min(28, max(16, int(often.count() * 16).bit_length()))

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True)
                at = np.array([int(_hashes(lang, [w.as_py()])[0]) & (size - 1) for lang, w in pairs], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["word", "bit"])

        marks = often.select("lang", "phrase").mapInArrow(places, "word long, bit long")
        found = marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        bits = np.zeros(size >> 5, dtype=np.uint32)
        bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
        return Frequent(bits)

    def has(self, lang: str, words: list[bytes]) -> np.ndarray:
        at = (_hashes(lang, words) & np.uint64(len(self.bits) * 32 - 1)).astype(np.int64)
        return (self.bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


def _suffixes(code: np.ndarray, first: np.ndarray, usable: np.ndarray, depth: int, least: int) -> np.ndarray:
    """A row of the next ``depth`` words for each word that may be the first; 0 from the first one on that is
    not usable. Suffixes of fewer than ``least`` words are left out."""
    code = np.where(usable[code], code, 0).astype(np.int32)
    padded = np.r_[code, np.zeros(depth, dtype=np.int32)]
    long = first[code]
    for i in range(1, least):
        long &= padded[i : i + len(code)] > 0
    at = np.nonzero(long)[0]
    rows = np.stack([padded[at + i] for i in range(depth)], axis=1)
    for i in range(least, depth):
        rows[:, i][rows[:, i - 1] == 0] = 0
    return rows


def _different(rows: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different rows in order, and how many there are of each or the sums of ``n``.

    Rows are compared as one number; where that would pass 63 bits, what there is of it is numbered anew.
    """
    bits = int(rows.max(initial=0)).bit_length()
    key, used = rows[:, 0].astype(np.int64), bits
    for i in range(1, rows.shape[1]):
        if used + bits > 63:
            found, key = np.unique(key, return_inverse=True)
            used = len(found).bit_length()
        key, used = key << bits | rows[:, i], used + bits
    order = np.argsort(key)
    starts = _starts(key[order])
    total = np.diff(np.r_[starts, len(key)]) if n is None else np.add.reduceat(n[order], starts) if len(key) else n
    return rows[order[starts]], total


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where the rows of an ordered array change, the first one included."""
    if not len(ordered):
        return np.zeros(0, dtype=np.int64)
    change = np.ones(len(ordered), dtype=bool)
    if ordered.ndim == 1:
        change[1:] = ordered[1:] != ordered[:-1]
    else:
        change[1:] = reduce(np.logical_or, (ordered[1:, i] != ordered[:-1, i] for i in range(ordered.shape[1])))
    return np.nonzero(change)[0]


def _joined(words: pa.Array, rows: np.ndarray) -> pa.Array:
    """The words of each row, with a blank between them; 0 stands for none."""
    some = rows > 0
    offsets = np.r_[0, np.cumsum(some.sum(axis=1))].astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words.take(pa.array(rows[some]))), b" ")


def counted(docs: DataFrame) -> DataFrame:
    """``lang, phrase, n`` of the single words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, codes in chunks(batches):
            for lang, code in codes.items():
                n = np.bincount(code, minlength=len(words))
                n[0] = 0
                some = np.nonzero(n)[0]
                yield _counts(lang, words.take(pa.array(some)), n[some])

    return _sums(docs.select("lang", "text").mapInArrow(run, COUNTS))


COUNTS = "lang string, phrase string, n long"


def _counts(lang: str, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), dtype=np.int64))), phrases.cast(pa.string()), pa.array(n)]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "n"])


def _sums(parts: DataFrame) -> DataFrame:
    return materialised(parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "phrases-counts")


Prefixes = dict[tuple[str, bytes], int]  # heavy ones of every length and how often they occur


def _prefixes(words: pa.Array, rows: np.ndarray, length: int) -> tuple[list[bytes], np.ndarray]:
    """The different beginnings of ordered rows, and which one each row has."""
    starts = _starts(rows[:, :length])
    which = np.zeros(len(rows), dtype=np.int64)
    which[starts] = 1
    return _joined(words, rows[starts, :length]).to_pylist(), np.cumsum(which) - 1


def _heavy(lang: str, prefixes: list[bytes], heavy: Prefixes) -> np.ndarray:
    return np.fromiter(((lang, p) in heavy for p in prefixes), dtype=bool, count=len(prefixes))


def extended(docs: DataFrame, heavy: Prefixes, length: int, often: Frequent) -> DataFrame:
    """``lang, phrase, n`` of the phrases of ``length`` words that go on from a heavy prefix."""
    known = docs.sparkSession.sparkContext.broadcast((heavy, often))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, often = known.value
        for words, codes in chunks(batches):
            for lang, code in codes.items():
                first = _those(words, code, lambda found, of=lang: _heavy(of, found, heavy))
                usable = _those(words, code, lambda found, of=lang: often.has(of, found))
                rows, n = _different(_suffixes(code, first, usable, length, length))
                for i in range(2, length):  # what begins a heavy prefix is heavy itself
                    prefixes, which = _prefixes(words, rows, i)
                    some = _heavy(lang, prefixes, heavy)[which]
                    rows, n = rows[some], n[some]
                yield _counts(lang, _joined(words, rows), n)

    return _sums(docs.select("lang", "text").mapInArrow(run, COUNTS))


def _those(words: pa.Array, code: np.ndarray, test: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
    """Which of the words are in ``code`` and pass the test; only those in it are tested."""
    there = np.nonzero(np.bincount(code, minlength=len(words)))[0][1:]
    passed = np.zeros(len(words), dtype=bool)
    passed[there] = test(words.take(pa.array(there)).to_pylist())
    return passed


def _bucket(lang: str, prefixes: list[bytes], buckets: int) -> np.ndarray:
    return (_hashes(lang, prefixes) >> np.uint64(20)).astype(np.int64) % buckets


@dataclass(frozen=True)
class Cut:
    """The vertical cut of the tree: heavy prefixes, and the group of every bucket of the others."""

    heavy: Prefixes
    group: np.ndarray


def vertical_cut(docs: DataFrame, words: DataFrame, often: Frequent, rules: Mining) -> tuple[Cut, list[DataFrame]]:
    """Extends prefixes until they fit, then packs them; also returns the counts of the prefixes that were extended
    from one word on, among which are the heavy ones.

    The buckets that prefixes are hashed to are so many that a group takes about eight of them.
    """
    levels, heavy = [words], {}
    total = words.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, 8 * total // rules.memory)
    for length in range(1, rules.words):
        rows = levels[-1].where(F.col("n") > rules.memory).toArrow().to_pylist()
        if not rows:
            break
        heavy.update({(r["lang"], r["phrase"].encode()): r["n"] for r in rows})
        levels.append(extended(docs, heavy, length + 1, often))

    def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True)
            at = np.array([_bucket(lang, [p.as_py()], buckets)[0] for lang, p in pairs], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(2)], ["bucket", "n"])

    every = words.where(F.col("n") >= rules.least)
    for level in levels[1:]:
        every = every.union(level)
    every = every.where(F.col("n") <= rules.memory)
    load = np.zeros(buckets, dtype=np.int64)
    found = every.mapInArrow(loads, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    load[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    group, at, room = np.zeros(buckets, dtype=np.int32), 0, rules.memory
    for i, n in enumerate(load.tolist()):
        if n > room and room < rules.memory:
            at, room = at + 1, rules.memory
        group[i] = at
        room -= n
    return Cut(heavy, group), levels[1 : rules.words - 1]


def dealt(docs: DataFrame, cut: Cut, often: Frequent, rules: Mining) -> DataFrame:
    """``grp, lang, suffixes, counts``: the suffixes of every group, those of equal words as one."""
    known = docs.sparkSession.sparkContext.broadcast((cut, often))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, often = known.value
        for words, codes in chunks(batches):
            for lang, code in codes.items():
                usable = _those(words, code, lambda found, of=lang: often.has(of, found))
                rows, n = _different(_suffixes(code, usable, usable, rules.words, 2))
                if len(rows):
                    yield from _by_group(lang, words, rows, n, cut)

    schema = "grp int, lang string, suffixes string, counts array<int>"
    return docs.select("lang", "text").mapInArrow(run, schema)


def _by_group(lang: str, words: pa.Array, rows: np.ndarray, n: np.ndarray, cut: Cut) -> Iterator[pa.RecordBatch]:
    """Each suffix goes to the group of its shortest prefix that is not heavy; those that end before are known."""
    group = np.full(len(rows), -1, dtype=np.int64)
    at = np.arange(len(rows))
    for length in range(1, rows.shape[1] + 1):
        at = at[rows[at, length - 1] > 0]
        prefixes, which = _prefixes(words, rows[at], length)
        heavy = _heavy(lang, prefixes, cut.heavy)
        group[at] = np.where(heavy, -1, cut.group[_bucket(lang, prefixes, len(cut.group))])[which]
        at = at[heavy[which]]
    order = np.argsort(group, kind="stable")
    order = order[group[order] >= 0]
    group, rows, n = group[order], rows[order], n[order]
    if not len(group):
        return
    starts = _starts(group)
    offsets = pa.array(np.r_[starts, len(group)].astype(np.int32))
    suffixes = pc.binary_join(pa.ListArray.from_arrays(offsets, _joined(words, rows)), b"\n").cast(pa.string())
    counts = pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32)))
    langs = pa.array([lang] * len(starts), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(group[starts].astype(np.int32)), langs, suffixes, counts], ["grp", "lang", "suffixes", "counts"])


def _subtree(blocks: pa.ChunkedArray, counts: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Of every depth from 2: its nodes, as rows of word numbers, the sums of the leaves below, and the words."""
    suffixes = pc.split_pattern(pc.split_pattern(blocks, "\n").combine_chunks().flatten(), " ")
    flat = suffixes.flatten().dictionary_encode()
    sizes = np.diff(suffixes.offsets.to_numpy())
    rows = np.zeros((len(sizes), depth), dtype=np.int64)
    rows[np.arange(depth) < sizes[:, None]] = flat.indices.to_numpy().astype(np.int64) + 1
    leaves, n = _different(rows, counts)
    words = pa.array([b"", *(w.encode() for w in flat.dictionary.to_pylist())], pa.binary())
    for length in range(2, depth + 1):
        inside = leaves[:, length - 1] > 0
        node, below = leaves[inside, :length], n[inside]
        starts = _starts(node)
        if len(starts):
            yield node[starts], np.add.reduceat(below, starts), words


def subtrees(suffixes: DataFrame, cut: Cut, rules: Mining) -> DataFrame:
    """``lang, phrase, n`` of the nodes that occur often enough, each group by itself."""
    heavy = suffixes.sparkSession.sparkContext.broadcast(cut.heavy)

    def build(table: pa.Table) -> pa.Table:
        made = []
        for lang in pc.unique(table.column("lang")).to_pylist():
            own = table.filter(pc.equal(table.column("lang"), lang))
            counts = pc.list_flatten(own.column("counts")).to_numpy().astype(np.int64)
            for nodes, n, words in _subtree(own.column("suffixes").cast(pa.large_string()), counts, rules.words):
                some = np.nonzero(n >= rules.least)[0]
                phrases = _joined(words, nodes[some]).to_pylist()
                whole = np.array([(lang, p) not in heavy.value for p in phrases], dtype=bool)
                made.append(_counts(lang, pa.array([p for p, w in zip(phrases, whole, strict=True) if w], pa.binary()), n[some][whole]))
        return pa.Table.from_batches(made, schema=_counts("", pa.array([], pa.binary()), np.zeros(0, dtype=np.int64)).schema)

    return suffixes.groupBy("grp").applyInArrow(build, COUNTS)


def frequencies(docs: DataFrame, rules: Mining = Mining()) -> tuple[DataFrame, DataFrame]:
    """The counts of all single words, and those of the phrases of two to ``rules.words`` words that are
    frequent enough, both as ``lang, phrase, n``. A null language is ``und``."""
    rows = docs.select(F.coalesce(docs["lang"], F.lit("und")).alias("lang"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    words = counted(rows)
    often = Frequent.of(words, rules)
    cut, levels = vertical_cut(rows, words, often, rules)
    nodes = materialised(subtrees(dealt(rows, cut, often, rules), cut, rules), "phrases-nodes")
    for level in levels:
        nodes = nodes.union(level.where(F.col("n") > F.lit(max(rules.memory, rules.least - 1))))
    return words, nodes


SALTS = 16


def _parts(length: Column, make: Callable[[Column], Column]) -> Column:
    return F.explode(F.transform(F.sequence(F.lit(1), length - 1), make))


def _joined_words(words: Column, start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _scored(found: DataFrame, counts: DataFrame, rules: Mining) -> DataFrame:
    """``lang, phrase, a, l, r, score`` by the cut that scores lowest.

    Both parts of a cut occur at least as often as the phrase, so their counts are known. A frequent
    word ends or begins many phrases: the counts of words are there once per salt.
    """
    size = F.size("words")
    cut = lambda k: F.struct(
        k.alias("k"),
        _joined_words(F.col("words"), 1, k).alias("left"),
        _joined_words(F.col("words"), k + 1, size - k).alias("right"),
    )
    rows = found.select("lang", "phrase", "a", _parts(size, cut).alias("c")).select("lang", "phrase", "a", "c.*")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    single = lambda c: F.instr(c, " ") == 0
    every = F.when(single("phrase"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    known = counts.select("lang", "phrase", "n", F.explode(every).alias("salt"))
    for part, name in (("left", "l"), ("right", "r")):
        own = known.select(
            F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias(name), F.col("salt").alias("own_salt")
        )
        key = F.when(single(part), salt).otherwise(F.lit(0))
        rows = rows.join(own, (F.col("lang") == F.col("of")) & (F.col(part) == F.col("part")) & (key == F.col("own_salt"))).drop("of", "part", "own_salt")
    above = F.col("a").cast("decimal(20,0)") * F.lit(rules.scale).cast("decimal(10,0)")
    score = F.call_function("div", above, (F.col("l") + F.col("r")).cast("decimal(20,0)"))
    best = rows.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def _not_covered(found: DataFrame, rules: Mining) -> DataFrame:
    """``found`` without the phrases that mostly occur inside one longer phrase."""
    size = F.size("words")
    starts = F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: _joined_words(F.col("words"), at, n)),
    )
    inner = found.where(size > 2).select("lang", F.explode(F.array_distinct(F.flatten(starts))).alias("phrase"), F.col("a").alias("outer"))
    both = found.select("lang", "phrase", "a", F.lit(None).cast("long").alias("outer")).union(
        inner.select("lang", "phrase", F.lit(None).cast("long"), "outer")
    )
    each = both.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("outer").alias("outer"))
    share = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by).cast("decimal(4,0)")
    alone = F.col("outer").isNull() | (share("outer", 100) < share("a", rules.covered))
    return each.where(alone).select("lang", "phrase", "a", F.split("phrase", " ").alias("words"))


def collocations(docs: DataFrame, rules: Mining = Mining()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of each language.

    Needs ``text, lang``. ``a`` is how often the phrase occurs, ``l`` and ``r`` its two parts, ``n`` all words
    of the language. Ties go to the more frequent phrase, then by bytes. Null texts are empty, a null
    language is ``und``; repeated rows count each; a language without frequent phrases has no rows, nor has
    an empty table; texts may be of any length; other columns are left out.
    """
    words, nodes = frequencies(docs, rules)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    found = nodes.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    scored = _scored(_not_covered(found, rules), words.where(F.col("n") >= rules.least).union(nodes), rules)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.best)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
