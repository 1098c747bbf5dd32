"""Language identification by cross-parsing.

A suffix automaton of labelled text per language gives, at any point of a text, the longest match
with that language's sample. Greedy longest matches cut the text into phrases; the language in which the
text can be written down in the fewest bits wins: where it is cut, the place of each phrase in the sample,
and in full each letter that the sample lacks. As that is a whole code, samples of any size compare: a small
one has cheaper places, down to a bound, but needs more phrases.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNDETERMINED = "und"
SPACE, OTHER = 0, 1  # codes of what is no letter, and of letters outside the alphabet
LANES = 192  # documents below which walking one by one is faster than side by side
ROWS = 1024  # documents of a batch looked at together
GROUP_CHARS = 4 << 20  # characters walked side by side
LETTER_BITS = 17.0  # a letter in full: Unicode has about 2^17
LEAST_SAMPLE = 1 << 10  # smaller samples cost as much a phrase as one of so many characters


@dataclass(frozen=True)
class Sample:
    """Bounds of the labelled sample: ``docs`` per language with ``chars`` in all, and languages. ``size`` bounds
    the table of all languages, which every task is sent; a sample that takes more is refused."""

    docs: int = 64
    chars: int = 40_000
    languages: int = 200
    alphabet: int = 250
    seed: int = 11
    size: int = 1 << 30


def held_out(doc_id: Column) -> Column:
    """Documents that the languages are not learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letter_codes(alphabet: str) -> np.ndarray:
    """Code of every code point."""
    codes = np.zeros(0x110000, dtype=np.uint8)
    codes[[c for c in range(0x110000) if chr(c).isalpha()]] = OTHER
    for i, c in enumerate(alphabet):
        codes[ord(c)] = i + 2
    return codes


def encoded(text: str, codes: np.ndarray) -> np.ndarray:
    """Letter codes of the lower-cased text, what is no letter as one space between letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    values = codes[points]
    keep = values != SPACE
    keep[1:] |= values[:-1] != SPACE
    values = values[keep]
    return values[: len(values) - 1] if len(values) and values[-1] == SPACE else values


def suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """Transitions of the suffix automaton as a states x ``width`` table; 0 is no transition.

    No transition leads to the start state, so its number can stand for none.
    """
    moves, link, size = [{}], [-1], [0]
    last = 0
    for c in codes:
        new, p = len(moves), last
        moves.append({})
        link.append(0)
        size.append(size[last] + 1)
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    table = np.zeros((len(moves), width), dtype=np.int32)
    for state, out in enumerate(moves):
        for c, to in out.items():
            table[state, c] = to
    return table


def place_type(states: int, width: int) -> type:
    """What holds the places of a table of so many states: with many languages 32 bits do not."""
    return np.int32 if states * width < 1 << 31 else np.int64


class Languages:
    """Automata of several languages in one table; states are kept as places in it."""

    def __init__(self, samples: dict[str, list[str]], bounds: Sample):
        # A sample without letters says nothing about a language.
        samples = {k: v for k, v in samples.items() if any(c.isalpha() for t in v for c in t.lower())}
        self.names = sorted(samples)
        letters = Counter(c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha())
        self.alphabet = "".join(sorted(sorted(letters, key=lambda c: (-letters[c], c))[: bounds.alphabet]))
        width, held = len(self.alphabet) + 2, 0
        self.width = width
        codes = letter_codes(self.alphabet)
        tables, self.starts, sizes, at = [], [], [], 0
        most = sum(2 * (sum(len(x.lower()) for x in t) + len(t)) + 1 for t in samples.values()) + 1
        kind = place_type(most, width)
        for name in self.names:
            values: list[int] = []
            for t in samples[name]:
                values += [*encoded(t, codes).tolist(), SPACE]
            table = suffix_automaton(values, width)
            tables.append(np.where(table > 0, (table.astype(np.int64) + at) * width, 0).astype(kind))
            held += tables[-1].nbytes
            if held > bounds.size:
                raise ValueError(f"the languages take more than {bounds.size} bytes: lower the characters of a sample")
            self.starts.append(at * width)
            sizes.append(len(values))
            at += len(table)
        # After a character that matches nowhere comes a state from which nothing leads on.
        self.dead = at * width
        self.table = np.concatenate([*tables, np.zeros((1, width), kind)]).ravel()
        self.bits = np.array([log2(max(n, LEAST_SAMPLE) + 1) for n in sizes])  # a place in the sample, or none
        self.common = max(self.bits, default=0.0)
        self.lacks = np.array([self.table[s : s + width] == 0 for s in self.starts], dtype=np.int64)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text in each language, a row per text.

        Texts are walked side by side, the longest first; when few are left they go on alone. A
        character that a language's sample lacks is a phrase of its own.
        """
        result = np.zeros((len(texts), len(self.names)), dtype=np.int64)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        begin = 0
        while begin < len(order):
            end, total = begin, 0
            while end < len(order) and (end == begin or total + len(texts[order[end]]) <= GROUP_CHARS):
                total += len(texts[order[end]])
                end += 1
            group = order[begin:end]
            result[group] = self._group([texts[i] for i in group])
            begin = end
        return result

    def _group(self, texts: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat = np.concatenate(texts) if texts else np.zeros(0, np.uint8)
        starts = np.array(self.starts, dtype=np.int64)[:, None]
        state = np.repeat(starts, len(texts), axis=1)
        count = np.zeros(state.shape, dtype=np.int64)
        together = int(sizes[LANES]) if len(texts) > LANES else 0
        active = np.searchsorted(-sizes, -np.arange(1, together + 1), side="right")
        for step in range(together):
            n = active[step]
            c = flat[offsets[:n] + step].astype(np.int64)
            to = self.table[state[:, :n] + c]
            miss = to == 0
            if step:
                count[:, :n] += miss
            again = self.table[starts + c]
            state[:, :n] = np.where(miss, np.where(again == 0, self.dead, again), to)
        walk = memoryview(self.table)
        for i, text in enumerate(texts):
            if sizes[i] <= together:
                break
            rest = text[together:].tolist()
            for j, start in enumerate(self.starts):
                s, n = int(state[j, i]), 0
                for c in rest:
                    s = walk[s + c]
                    if not s:
                        n += 1
                        s = walk[start + c] or self.dead
                # The first phrase begins with the text, even with a character that matches nowhere.
                count[j, i] += n - (not together and len(rest) > 0 and not walk[start + rest[0]])
        return (count + 1).T * (sizes > 0)[:, None]

    def unmatched(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of characters of each text that each language's sample lacks, a row per text."""
        counts = np.array([np.bincount(t, minlength=self.width) for t in texts], dtype=np.int64)
        return counts @ self.lacks.T

    def predict(self, texts: list[str | None], codes: np.ndarray) -> tuple[list, list, list, list]:
        """Language, score, bits per character and number of letters of each text.

        The score is how far the best language is ahead of the next: 1 minus the ratio of their bits. Bits
        per character are those of its phrases at the price of the largest sample, the same for all
        languages, so that what a small sample is cheapest for does not look like a language.
        """
        values = [encoded(t or "", codes) for t in texts]
        letters = np.array([int((v != SPACE).sum()) for v in values], dtype=np.int64)
        if not self.names or not len(values):
            nothing = [0.0] * len(values)
            return [UNDETERMINED] * len(values), nothing, nothing, letters.tolist()
        known = letters > 0
        phrases, extra = self.phrases(values), self.unmatched(values) * LETTER_BITS
        sizes = np.maximum(1, [len(v) for v in values])[:, None]
        cut = np.clip(phrases / sizes, 1e-12, 1 - 1e-12)
        cuts = -sizes * (cut * np.log2(cut) + (1 - cut) * np.log2(1 - cut))
        bits = phrases * self.bits + cuts + extra
        best = bits.argmin(axis=1)
        ranked = np.sort(bits, axis=1)
        second = ranked[:, 1] if len(self.names) > 1 else np.full(len(values), np.inf)
        score = np.where(known, 1 - ranked[:, 0] / np.maximum(second, 1e-9), 0.0)
        alike = np.take_along_axis(phrases * self.common + extra, best[:, None], axis=1) / sizes
        per_char = np.where(known, alike[:, 0], 0.0)
        names = [self.names[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        return names, np.clip(score, 0.0, 1.0).tolist(), per_char.tolist(), letters.tolist()


def learn(docs: DataFrame, bounds: Sample = Sample()) -> Languages:
    """Languages from a bounded sample of ``doc_id, text, lang``.

    Of every language, the ``docs`` documents of lowest hash give a piece each, an equal share of ``chars`` from a
    hashed position, so that openings count no more than the rest; repeated rows count once. Held-out
    documents, null languages and texts without letters are left out. At most ``chars`` characters a language come to
    the driver, and no more languages than ``languages``.
    """
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    place = F.xxhash64(F.lit(bounds.seed), "doc_id", "text")  # of both: null ids are many documents
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct(place).alias("count"))
    sizes = sizes.limit(bounds.languages + 1).collect()
    if len(sizes) > bounds.languages:
        raise ValueError(f"more than {bounds.languages} languages")
    chance = F.lit(0.0)
    for row in sizes:  # four times what is needed, so that only few texts are ordered
        share = min(1.0, 4.0 * bounds.docs / row["count"])
        chance = F.when(F.col("lang") == row["lang"], F.lit(share)).otherwise(chance)
    unit = F.pmod(place, F.lit(1 << 20)) / F.lit(float(1 << 20))
    size = bounds.chars // bounds.docs
    positions = F.greatest(F.length("text") - size + 1, F.lit(1))
    start = F.pmod(F.xxhash64(F.lit(bounds.seed + 1), "doc_id", "text"), positions) + 1
    part = F.substring(F.col("text"), start.cast("int"), F.lit(size))
    few = usable.where(unit <= chance).select("lang", place.alias("place"), part.alias("part")).distinct()
    order = Window.partitionBy("lang").orderBy("place", "part")
    rows = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= bounds.docs)
    samples: dict[str, list[str]] = {row["lang"]: [] for row in sizes}
    for row in rows.orderBy("lang", "n").select("lang", "part").collect():
        samples[row["lang"]].append(row["part"])
    return Languages(samples, bounds)


def identify(docs: DataFrame, languages: Languages) -> DataFrame:
    """``doc_id, lang_pred, score, bits_per_char, letters`` of every whole text.

    A null text, or one without letters, is ``und`` with score 0. Only the text is looked at; repeated
    rows give repeated rows, an empty table gives none.
    """
    model = docs.sparkSession.sparkContext.broadcast(languages)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = letter_codes(model.value.alphabet)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = model.value.predict(part.column(1).to_pylist(), codes)
                types = (pa.string(), pa.float64(), pa.float64(), pa.int64())
                arrays = [pa.array(values, t) for values, t in zip(found, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *arrays], ["doc_id", "lang_pred", "score", "bits_per_char", "letters"]
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, bits_per_char double, letters long"
    )


@dataclass(frozen=True)
class Rejects:
    """What is in no learned language: no letters, or ``letters`` and more of them at over ``bits`` per
    character, where prose of a learned language has 2 to 3 and shuffled letters over 7."""

    bits: float = 6.0
    letters: int = 32


def in_a_language(docs: DataFrame, bounds: Sample = Sample(), rejects: Rejects = Rejects()) -> DataFrame:
    """The rows in a learned language, in the columns of ``docs``, with ``lang`` as identified.

    Needs ``doc_id, text, lang``. Rows with a null text or without letters go; repeated rows stay
    repeated, other columns as they are whatever their names.
    """
    languages = learn(docs.select("doc_id", "text", "lang"), bounds)
    model = docs.sparkSession.sparkContext.broadcast(languages)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = letter_codes(model.value.alphabet)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = model.value.predict(part.column(1).to_pylist(), codes)
                types = (pa.string(), pa.float64(), pa.float64(), pa.int64())
                arrays = [pa.array(values, t) for values, t in zip(found, types, strict=True)]
                columns = [*part.columns, arrays[0], *arrays[2:]]
                yield pa.RecordBatch.from_arrays(columns, ["row", "text", "found", "bits", "letters"])

    # The text is passed on once, beside the other columns.
    others = [docs[c] for c in names if c not in ("text", "lang")] or [F.lit(0).alias("none")]
    whole = docs.select(F.struct(*others).alias("row"), "text")
    row = whole.schema["row"].dataType.simpleString()
    told = whole.mapInArrow(run, f"row {row}, text string, found string, bits double, letters long")
    strange = (F.col("bits") > rejects.bits) & (F.col("letters") >= rejects.letters)
    kept = told.where((F.col("found") != UNDETERMINED) & ~strange)
    fresh = {"lang": F.col("found"), "text": F.col("text")}
    return kept.select(*[fresh.get(c, F.col("row").getField(c)).alias(c) for c in names])


def language_report(docs: DataFrame, bounds: Sample = Sample()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits_per_char``: learn from the rest, predict all."""
    found = identify(docs, learn(docs.select("doc_id", "text", "lang"), bounds))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_char")
