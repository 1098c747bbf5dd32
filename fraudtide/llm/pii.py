"""Personal data: direct identifiers by pattern, and the terms that give them away.

How strongly a term reveals an entity is estimated from co-occurrence over the whole corpus, in different
texts, so that copies count once everywhere. Of the n_t texts that have the term, n_et have it near the entity;
what the term discloses is the lower end of the confidence interval of that share, which few texts keep low
and which the size of the rest of the corpus does not move. Terms that at least two texts show with
the entity are generalised above one threshold and removed above another. A term of one text only proves
nothing: such terms are counted apart.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudtide.llm.groups import bit_filter, may_be_in
from fraudtide.llm.secrets import span_text
from fraudtide.llm.tables import materialised

KINDS = ("email", "ip", "card", "phone", "term")

# What the direct identifiers look like. Each is searched so that long runs of one
# character class cost time in proportion to their length.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]")

TERM = re.compile(r"[^\W\d_]{3,}")
MASK = (1 << 62) - 1  # the low bits, which are all that a bitmap looks at
COUNTED_TERMS = 400_000  # terms a task counts before it passes them on


@dataclass(frozen=True)
class Disclosure:
    """``reach``: terms on either side of an entity that are its context. ``deviations``: how far below the
    share of texts the lower end of its interval is. ``witnesses``: how many different texts must have both."""

    reach: int = 10
    deviations: float = 1.28  # one-sided, nine times in ten
    witnesses: int = 2
    generalise: float = 0.5
    remove: float = 0.8


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        m = DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
            end = m.end()
        at = text.find("@", max(end, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers each; of a longer row of numbers every four in turn."""
    for m in DOTTED.finditer(text):
        begin, parts = m.start(), m[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = begin + sum(map(len, four)) + 3
            if all(int(p[-20:]) <= 255 and not p[:-20].strip("0") for p in four):
                yield begin, end
            begin = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = NO_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(NO_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


FINDERS = (emails, addresses, cards, phones)


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """Start, number of the kind (from 1) and end of every direct identifier, in order."""
    return sorted((a, n, b) for n, find in enumerate(FINDERS, 1) for a, b in find(text))


def entity(text: str, kind: int) -> str:
    """What makes two spans the same entity: letters in lower case, numbers without separators."""
    value = text.lower() if kind == 1 else text if kind == 2 else NO_DIGIT.sub("", text)
    return f"{KINDS[kind - 1]}:{value}"


def contexts(text: str, spans: list[tuple[int, int, int]], reach: int) -> list[dict]:
    """For each identifier the terms near it, with their places."""
    if not spans:
        return []
    found = []
    terms = TERM.finditer(text)
    before: deque = deque(maxlen=reach)
    waiting: list[tuple[dict, int, int]] = []  # context, how many terms are still to come, end

    def inside(a: int, b: int) -> bool:
        while held and held[0][2] <= a:
            held.popleft()
        return any(s < b and a < e for s, _, e in islice(held, 8))

    held = deque(spans)
    ahead = deque(spans)
    for m in terms:
        a, b = m.span()
        while ahead and ahead[0][0] < b:
            s, kind, e = ahead.popleft()
            context = {"entity": entity(text[s:e], kind), "terms": list(before)}
            found.append(context)
            waiting.append((context, reach, e))
        if inside(a, b):
            continue
        term = {"term": m[0].lower(), "start": a, "end": b}
        waiting = [(c, n - 1, e) for c, n, e in waiting if n > 0 and (a < e or c["terms"].append(term) is None)]
        before.append(term)
        if not ahead and not waiting:
            break
    for s, kind, e in ahead:
        found.append({"entity": entity(text[s:e], kind), "terms": list(before)})
    return found


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("rule_no", pa.int32()), ("end", pa.int32())]))
TERMS = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
CONTEXTS = pa.list_(pa.struct([("entity", pa.string()), ("terms", TERMS)]))
FOUND = (
    "spans array<struct<start:int,rule_no:int,end:int>>, contexts array<struct<entity:string,"
    "terms:array<struct<term:string,start:int,end:int>>>>, copy long"
)


def text_hash(text: str) -> int:
    """What makes two texts copies; of a null text that of the empty one."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def scan(docs: DataFrame, reach: int, with_text: bool = False) -> DataFrame:
    """``doc_id, spans, contexts, copy``: direct identifiers of every whole text, what stands near them, and
    the text's hash; with the ``text`` itself on request."""
    extra = ["text"] if with_text else []
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, near, copies = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                own = identifiers(text)
                spans.append([{"start": a, "rule_no": n, "end": b} for a, n, b in own])
                near.append(contexts(text, own, reach))
                copies.append(text_hash(text))
            arrays = [pa.array(spans, SPANS), pa.array(near, CONTEXTS), pa.array(copies, pa.int64())]
            texts = [batch.column(1)] if extra else []
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, *texts], ["doc_id", "spans", "contexts", "copy", *extra])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {FOUND}{', text string' if extra else ''}")


def term_texts(docs: DataFrame, copied: DataFrame, wanted: DataFrame) -> DataFrame:
    """``term, n_t``: in how many different texts each term is, of all ``wanted`` terms and a few others.
    ``copied`` has the hashes of texts that are there more than once.

    Counted per task before the shuffle. Only what may be a copy passes on its terms with its hash, once a
    task, and is counted by hash: no text is moved. Terms that are near no entity are not moved either.
    """
    maps = bit_filter(copied), bit_filter(wanted.select(F.xxhash64("term").alias("term")))
    bitmap = docs.sparkSession.sparkContext.broadcast(maps)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        terms, copies = zip(*counts, strict=True)
        arrays = [pa.array(terms, pa.string()), pa.array(copies, pa.int64()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["term", "copy", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        seen: set[int] = set()
        copies, terms = bitmap.value
        near: dict[str, bool] = {}

        def asked(term: str) -> bool:
            if term not in near:  # the hash is Spark's of a string
                near[term] = bool(may_be_in(terms, np.array([xxhash.xxh64_intdigest(term.encode(), 42) & MASK]))[0])
            return near[term]

        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                copy = text_hash(text)
                if not may_be_in(copies, np.array([copy]))[0]:
                    copy = None
                elif copy in seen:
                    continue
                else:
                    seen.add(copy)
                counts.update((term, copy) for term in set(map(str.lower, TERM.findall(text))) if asked(term))
                if len(counts) >= COUNTED_TERMS or len(near) >= COUNTED_TERMS:
                    if counts:
                        yield batch_of(counts)
                    counts.clear()
                    seen.clear()
                    near.clear()
        if counts:
            yield batch_of(counts)

    parts = docs.select("text").mapInArrow(run, "term string, copy long, n long")
    single = parts.groupBy("term", "copy").agg(F.sum("n").alias("n"))
    return single.groupBy("term").agg(F.sum(F.when(F.col("copy").isNull(), F.col("n")).otherwise(1)).alias("n_t"))


def lower_bound(hits: Column, tries: Column, deviations: float) -> Column:
    """The lower end of Wilson's interval of a share."""
    z2 = deviations * deviations
    share = hits / tries
    spread = deviations * F.sqrt(share * (1 - share) / tries + z2 / (4 * tries * tries))
    return (share + z2 / (2 * tries) - spread) / (1 + z2 / tries)


def disclosing(found: DataFrame, docs: DataFrame, rules: Disclosure) -> DataFrame:
    """``entity, term, share, single`` of the terms that reveal an entity, and of those of a single text.

    Everything is counted in different texts, so copies of a document do not make its words telling, nor
    hide those that are. Entities in many documents are summed map-side first; nothing about one entity is
    gathered.
    """
    near = found.select("copy", F.explode("contexts").alias("c")).select("copy", "c.entity", "c.terms")
    pairs = near.select("entity", "copy", F.explode("terms.term").alias("term")).distinct()
    both = materialised(pairs.groupBy("entity", "term").agg(F.count("*").alias("n_et")), "pii-pairs")
    copies = found.groupBy("copy").agg(F.count("*").alias("n")).where("n > 1").select("copy")
    rated = both.join(term_texts(docs, copies, both.select("term").distinct()), "term")
    share = lower_bound(F.col("n_et").cast("double"), F.col("n_t").cast("double"), rules.deviations)
    told = rated.select("entity", "term", share.alias("share"), (F.col("n_t") == 1).alias("single"), "n_et")
    reveals = (F.col("n_et") >= rules.witnesses) & (F.col("share") >= rules.generalise)
    return told.where(F.col("single") | reveals).drop("n_et")


def _count_of(number: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["rule_no"] == number)).cast("long")


def personal_spans(docs: DataFrame, rules: Disclosure = Disclosure(), with_text: bool = False) -> DataFrame:
    """``doc_id, spans, terms, n_single`` of each row: direct identifiers, revealing terms with their share, and
    how many terms near an identifier no other text has.

    Null and empty texts have neither. Repeated rows give repeated rows, null ids are ids like others; other
    columns are left out, but for the ``text`` on request.
    """
    rows = scan(docs, rules.reach, with_text).withColumn("row", F.monotonically_increasing_id())
    rows = materialised(rows, "pii-rows")
    telling = disclosing(rows, docs, rules)
    places = rows.select("row", F.explode("contexts").alias("c")).select("row", "c.entity", F.explode("c.terms").alias("t"))
    hits = (
        places.select("row", "entity", "t.term", "t.start", "t.end")
        .join(telling, ["entity", "term"])
        .groupBy("row", "start", "end")
        .agg(F.max(F.when(~F.col("single"), F.col("share"))).alias("share"))
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("share").isNotNull(), F.struct("start", "end", "share")))).alias("terms"),
            F.count_if(F.col("share").isNull()).alias("n_single"),
        )
    )
    none = F.array().cast("array<struct<start:int,end:int,share:double>>")
    every = rows.join(hits, "row", "left")
    columns = ["doc_id", "spans", F.coalesce("terms", none).alias("terms"), F.coalesce("n_single", F.lit(0)).alias("n_single")]
    return every.select(*columns, *(["text"] if with_text else []))


def personal_report(docs: DataFrame, rules: Disclosure = Disclosure()) -> DataFrame:
    """``doc_id``, a count per kind, ``base_sha256`` of the direct identifiers and all ``spans``.

    ``n_term`` counts the revealing terms, which ``spans`` has as kind ``term``; ``n_found`` all spans, and ``n_single``
    the terms near an identifier that no other text has, which are no spans.
    """
    found = personal_spans(docs, rules)
    as_spans = F.transform(
        "terms", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("rule_no"), t["end"].alias("end"))
    )
    every = F.array_sort(F.concat("spans", as_spans))
    return found.select(
        "doc_id",
        *[_count_of(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS[:-1], 1)],
        F.size("terms").cast("long").alias("n_term"),
        (F.size("spans") + F.size("terms")).cast("long").alias("n_found"),
        "n_single",
        F.sha2(span_text(F.col("spans"), list(KINDS)), 256).alias("base_sha256"),
        span_text(every, list(KINDS)).alias("spans"),
    )


def cleaned(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced; of spans that overlap the first, and longest, counts."""
    parts, at = [], 0
    for begin, end, to in sorted(spans, key=lambda s: (s[0], -s[1])):
        if begin >= at:
            parts += [text[at:begin], to]
            at = end
    return "".join([*parts, text[at:]])


def general(term: str, share: float, rules: Disclosure) -> str:
    """What stands for a revealing term: nothing, or the class of words that it belongs to."""
    if share >= rules.remove:
        return ""
    return "[NAME]" if term[:1].isupper() else "[WORD]"


def sanitise(docs: DataFrame, rules: Disclosure = Disclosure()) -> DataFrame:
    """``doc_id, text`` with identifiers replaced by their kind and revealing terms generalised or removed.

    Every row gives a row: texts stay with their spans all the way, so that neither repeated nor null ids
    mix them up. A null text stays null; an empty table gives none; other columns are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = personal_spans(docs, rules, with_text=True).select("doc_id", "text", "spans", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans, terms in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                if text is None:
                    texts.append(None)
                    continue
                marks = [(s["start"], s["end"], f"[{KINDS[s['rule_no'] - 1].upper()}]") for s in spans]
                marks += [(t["start"], t["end"], general(text[t["start"] : t["end"]], t["share"], rules)) for t in terms]
                texts.append(cleaned(text, marks))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return found.mapInArrow(run, f"doc_id {kind}, text string")
