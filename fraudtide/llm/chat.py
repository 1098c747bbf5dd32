"""Chat formatting: conversations rendered by a compiled template, with loss masks, and read back.

Control strings inside texts are escaped by a backslash after their first character; where there are
backslashes already there is one more, so that taking one away gives the text back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudtide.llm.template import compile_template

# How turns are marked. What is neither user nor assistant names its role.
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role | escape }}[TEXT]{{ m.text | escape }}[/ROLE]{% endif %}"
    "{% endfor %}"
)
CONTROL = r"/?INST\]|/?ROLE\]|TEXT\]|/s>"
PLAIN = re.compile(rf"([\[<])(\\*)({CONTROL})")
ESCAPED = re.compile(rf"([\[<])\\(\\*)({CONTROL})")

PART_CHARS = 1 << 20  # a longer conversation is put out in several rows
PARTS = "part int, formatted string, loss array<struct<start:long,end:long>>"
REPORT = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def escape(text: object) -> str:
    return PLAIN.sub(r"\1\\\2\3", "" if text is None else str(text))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _runs(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Each conversation id with its rows, which come one by one; a null id is an id too."""
    row = next(rows, None)
    while row is not None:
        key, ahead = row[0], [row]

        def own(key=key, ahead=ahead) -> Iterator[tuple]:
            while ahead and ahead[0] is not None and ahead[0][0] == key:
                current = ahead.pop()
                ahead.append(next(rows, None))
                yield current

        run = own()
        yield key, run
        for _ in run:
            pass
        row = ahead[0]


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], cost) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    for row in rows:
        held.append(row)
        size += cost(row)
        if size >= 4 * PART_CHARS or len(held) >= 10_000:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _parts(pieces: Iterator[tuple[str, bool]]) -> Iterator[tuple[int, str, list[dict]]]:
    """Number, text and marked spans of each part; places count from the conversation's start."""
    number, at, texts, size, spans, inside = 0, 0, [], 0, [], False
    for text, marked in pieces:
        if marked:
            if inside and spans:
                spans[-1]["end"] = at + len(text)
            else:
                spans.append({"start": at, "end": at + len(text)})
        inside = marked
        texts.append(text)
        at += len(text)
        size += len(text)
        if size >= PART_CHARS:
            yield number, "".join(texts), spans
            number, texts, size, spans = number + 1, [], 0, []
    if texts or not number:
        yield number, "".join(texts), spans


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Conversations as the template renders them: ``conv_id, part, formatted, loss``.

    ``turns`` has ``conv_id, turn, role, text``; turns come in order of ``turn``, then role and text.
    A null text or role is empty; rows with a null id are one conversation. ``loss`` has the spans to
    train on, in characters from the conversation's start. A conversation longer than ``PART_CHARS``
    takes several rows, one after the other; its turns stream through one task and are never held
    together. Other columns are left out; an empty table gives no rows.
    """
    kind = pa.int64() if turns.schema["conv_id"].dataType.simpleString() == "bigint" else None
    id_type = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape})

        def rows() -> Iterator[tuple]:
            for key, own in _runs(_rows(batches)):
                messages = ({"role": role, "text": text} for _, role, text in own)
                for number, text, spans in _parts(render({"messages": messages})):
                    yield key, number, text, spans

        types = [kind, pa.int32(), pa.string(), SPANS]
        yield from _batches(rows(), ["conv_id", "part", "formatted", "loss"], types, lambda r: len(r[2]))

    placed = turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
    ordered = placed.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {id_type}, {PARTS}")


def read_turns(parts: Iterator[str]) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation; no more than one turn is held."""
    held = ""
    for part in parts:
        held += part
        at = 0
        while at < len(held):
            if held.startswith("[INST] ", at):
                begin, end = at + 7, held.find(" [/INST]", at + 7)
                role, after = "user", end + 8
            elif held.startswith("[ROLE]", at):
                middle = held.find("[TEXT]", at + 6)
                begin, end = middle + 6, held.find("[/ROLE]", middle + 6) if middle >= 0 else -1
                role, after = unescape(held[at + 6 : middle]), end + 7
            else:
                begin, end = at, held.find("</s>", at)
                role, after = "assistant", end + 4
            if end < 0:
                break
            yield role, unescape(held[begin:end])
            at = after
        held = held[at:]
    if held:
        raise ValueError("a formatted conversation ends within a turn")


class _Loss:
    """Length and digest of the unescaped text under the mask, span by span."""

    def __init__(self):
        self.digest, self.chars, self.raw, self.end = sha256(), 0, "", -1

    def add(self, text: str, start: int, end: int) -> None:
        if start != self.end:
            self.finish()
        self.raw += text
        self.end = end

    def finish(self) -> None:
        plain = unescape(self.raw)
        self.chars += len(plain)
        self.digest.update(plain.encode())
        self.raw = ""


def conversation_report(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``format_conversations``: one row per conversation.

    Returns ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. A
    conversation's parts must follow each other, as they do in the formatter's output.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for key, own in _runs(_rows(batches)):
                loss, seen = _Loss(), [0]

                def parts(own=own, loss=loss, seen=seen) -> Iterator[str]:
                    for _, _, text, spans in own:
                        for s in spans:
                            loss.add(text[s["start"] - seen[0] : s["end"] - seen[0]], s["start"], s["end"])
                        seen[0] += len(text)
                        yield text

                digest, turns = sha256(), 0
                for role, text in read_turns(parts()):
                    digest.update(f"{role}\n{text}\n".encode())
                    turns += 1
                loss.finish()
                yield key, turns, digest.hexdigest(), loss.chars, loss.digest.hexdigest(), seen[0]

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kind = pa.int64() if id_type == "bigint" else None
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield from _batches(rows(), names, types, lambda r: 200)

    return formatted.mapInArrow(run, f"conv_id {id_type}, {REPORT}")


def chat_report(turns: DataFrame) -> DataFrame:
    """Format all conversations and one of control strings, id -1, and read them back."""
    spark = turns.sparkSession
    text = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    columns = ["conv_id", "turn", "role", "text"]
    both = turns.select(*[F.col(c) for c in columns]).unionByName(probe)
    return conversation_report(format_conversations(both))
