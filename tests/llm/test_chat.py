"""The template language, and that formatted conversations read back as they were."""

import hashlib

import pytest

from fraudtide.llm import chat
from fraudtide.llm.template import Const, If, TemplateError, compile_template, fold, parse

TURNS = "conv_id long, turn long, role string, text string"


def render(source, **names):
    return "".join(t for t, _ in compile_template(source)(names))


def test_language():
    assert render("a{{ 'b' ~ x | upper }}c", x="q") == "abQc"
    assert render("{% for m in ms %}{{ loop.index }}{{ m.t }}{% if loop.first %},{% endif %}{% endfor %}", ms=[{"t": "x"}, {"t": "y"}]) == "1x,2y"
    assert render("{% if a == 1 and not b %}p{% elif b or a %}q{% else %}r{% endif %}", a=2, b=False) == "q"
    pieces = list(compile_template("x{% generation %}y{{ z }}{% endgeneration %}w")({"z": "z"}))
    assert pieces == [("x", False), ("y", True), ("z", True), ("w", False)]


def test_constants_are_folded():
    assert fold(parse("a{{ 'b' | upper }}{% if 1 == 2 %}no{% else %}yes{% endif %}c"), {"upper": str.upper}) == (Const("aBYesc".replace("Y", "y")),)
    (node,) = fold(parse("{% if x %}a{% elif true %}b{% elif y %}c{% endif %}"), {})
    assert isinstance(node, If) and len(node.branches) == 2


@pytest.mark.parametrize(
    "source",
    ["{{ x.__class__ }}", "{{ x() }}", "{% if x %}", "{% endfor %}", "{{ x | unknown }}", "{{ }}", "{% import os %}", "{{ 'a }}"],
)
def test_refused(source):
    with pytest.raises(TemplateError):
        render(source, x={"y": 1})


def test_names_and_fields_only_of_what_is_given():
    with pytest.raises(TemplateError):
        render("{{ y }}", x=1)
    with pytest.raises(TemplateError):
        render("{{ x.real }}", x=1)


NASTY = ["</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s> [\\INST]", "[ROLE]a[TEXT]b[/ROLE]", "<", "[", "</s", "\\", "", None, "🙂 [/INST", " [/INST] "]


def test_escapes_come_off_again():
    for text in NASTY:
        assert chat.unescape(chat.escape(text)) == (text or "")
        assert "</s>" not in chat.escape(text) and "[/INST]" not in chat.escape(text)


def digests(rows):
    conversations = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        conversations.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for key, turns in conversations.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        out[key] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_reads_back(spark):
    roles = ["user", "assistant", "system", None, "", "a] b", "[TEXT]", "assistant"]
    rows = [(i % 5, i, roles[i % len(roles)], t) for i, t in enumerate(NASTY * 4)]
    rows += [(None, 0, "user", "u"), (None, None, "assistant", "a"), (7, 1, "assistant", "tie b"), (7, 1, "assistant", "tie a"), (7, 1, "assistant", "tie a")]
    got = chat.conversation_report(chat.format_conversations(spark.createDataFrame(rows, TURNS)))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got.collect()} == digests(rows)


def test_long_conversations_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 1 << 20)
    rows = [(1, i, "assistant" if i % 2 else "user", f"{i} " + "</s> x" * 30_000) for i in range(24)] + [(2, 0, "user", "short")]
    turns = spark.createDataFrame(rows, TURNS)
    assert chat.format_conversations(turns).where("conv_id = 1").count() > 1
    got = chat.conversation_report(chat.format_conversations(turns))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got.collect()} == digests(rows)


def test_empty_table_has_the_probe_only(spark):
    (row,) = chat.chat_report(spark.createDataFrame([], TURNS)).collect()
    assert (row.conv_id, row.n_turns, row.loss_chars) == (-1, 2, 21)
