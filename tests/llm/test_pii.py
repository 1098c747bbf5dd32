"""Identifiers against plain matching, and which terms give them away."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fraudtide.llm import pii

PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def expected(text):
    found = []
    for kind, pattern in enumerate(PLAIN, 1):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = (
                True,
                kind == 2 and all(int(p) <= 255 for p in m[0].split(".")),
                12 <= len(digits) <= 19 and luhn(digits),
                9 <= len(digits) <= 15,
            )
            if fits[kind - 1]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_identifiers():
    rng = random.Random(3)
    pieces = ["4111 1111 1111 1111", "+1 (555) 123-4567", "a.b@c.de", "1.2.3.4.5.6.7.8", "999.1.1.1", "0001.2.3.4", "@", "x@y", "a@b.c_d@e.f"]
    for _ in range(20_000):
        text = "".join(rng.choice("ab1234567890.@@+-_ ()%é.-00") for _ in range(rng.randint(0, 40)))
        assert pii.identifiers(text) == expected(text)
    for _ in range(2_000):
        text = rng.choice([" ", "", "-"]).join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))
        assert pii.identifiers(text) == expected(text)


def test_long_runs_take_linear_time():
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+" * 400_000, "@" * 200_000, "1 " * 200_000):
        pii.identifiers(run)


def report(docs):
    return sorted((r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.personal_report(docs).collect())


def wanted(docs):
    rows = []
    for r in docs.collect():
        spans = expected(r.text)
        joined = ",".join(f"{pii.KINDS[k - 1]}:{a}:{b}" for a, k, b in spans)
        rows.append((hashlib.sha256(joined.encode()).hexdigest(), *[sum(k == n for _, k, _ in spans) for n in (1, 2, 3, 4)]))
    return sorted(rows)


def test_documents(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        assert report(docs) == wanted(docs)
    assert pii.personal_report(no_documents).count() == 0


def telling_documents(spark):
    filler = ["lorem ipsum dolor", "amet elit sed", "tempor magna aliqua", "quis nostrud enim", "duis aute irure"]
    rows = [(i, f"{filler[i % 5]} write to Zyxwv at z@x.org about {filler[(i * 2 + 1) % 5]} {i % 7}") for i in range(5)]
    rows += [(100 + i, f"{filler[i % 5]} and {filler[(i + 1) % 5]} without any about") for i in range(200)]
    rows += [(400 + i, "hapax writes to h@x.org always the same") for i in range(9)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_revealing_terms(spark):
    docs = telling_documents(spark)
    found = {r.doc_id: r for r in pii.personal_report(docs).collect()}
    at = "lorem ipsum dolor write to ".__len__()
    assert f"term:{at}:{at + 5}" in found[0].spans.split(",")
    # What is common elsewhere tells nothing, and copies of one context are one witness.
    assert all(found[100 + i].n_term == 0 for i in range(200))
    assert all(found[400 + i].n_term == 0 for i in range(9))


def test_sanitised_texts(spark):
    clean = {r.doc_id: r.text for r in pii.sanitise(telling_documents(spark)).collect()}
    assert "z@x.org" not in clean[0] and "Zyxwv" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[100] == "lorem ipsum dolor and amet elit sed without any about"


def test_contexts_leave_identifiers_out():
    text = "one two three a@b.org four five"
    (context,) = pii.contexts(text, pii.identifiers(text), 2)
    assert [t["term"] for t in context["terms"]] == ["two", "three", "four", "five"]
    assert all(text[t["start"] : t["end"]] == t["term"] for t in context["terms"])


def test_copies_hide_nothing_and_few_texts_are_decided(spark):
    rows = [(i, f"plain words without any number {'abcdefghij'[i % 10] * 3} {'klmnopqrst'[i // 10 % 10] * 3} {'uvwxyz'[i // 100] * 3}") for i in range(600)]
    rows += [(1000 + i, f"words {'abc'[i] * 3} Zyxwv plain z@x.org without") for i in range(3)]
    rows += [(2000 + i, "words aaa Zyxwv plain z@x.org without") for i in range(500)]
    rows += [(3000, "plain Solus words s@x.org without"), (3001, "plain Duo duo@x.org words"), (3002, "words Duo plain duo@x.org")]
    rows += [(4000 + i, None) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shares = told(docs)
    assert shares.keys() == {("email:z@x.org", "zyxwv"), ("email:duo@x.org", "duo")}
    assert told(docs.dropDuplicates(["text"])) == shares
    assert 0.5 < shares["email:duo@x.org", "duo"] < shares["email:z@x.org", "zyxwv"] < 1
    report = {r.doc_id: r for r in pii.personal_report(docs).collect()}
    assert {i for i, r in report.items() if r.n_term} == {r[0] for r in rows if "@" in (r[1] or "")} - {3000}
    assert (report[3000].n_single, report[3001].n_single, report[3000].n_found) == (1, 0, 1)
    # However many texts there are without any of it, nothing changes.
    more = [(5000 + i, f"unrelated text of its own {chr(97 + i % 26) * 4} {chr(97 + i // 26) * 5}") for i in range(650)]
    assert told(docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))) == shares


def told(docs, rules=pii.Disclosure()):
    rows = pii.disclosing(pii.scan(docs, rules.reach), docs, rules).where("NOT single").collect()
    return {(r.entity, r.term): r.share for r in rows}


def test_disclosure_against_a_count_over_all_pairs(spark):
    rng = random.Random(5)
    names = ["Adamo", "Bertil", "Cosima", "the", "from", "with", "Dunja"]
    rows = []
    for i in range(250):
        who = rng.randrange(4)
        near = rng.choice(names[:2]) if who < 2 else rng.choice(names)
        text = " ".join([rng.choice(names), rng.choice(names), near] + [f"p{who}@x.org"] * (rng.random() < 0.4) + [rng.choice(names)] * rng.randint(0, 3))
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rules = pii.Disclosure(reach=2, generalise=0.05)
    n_t, n_et = Counter(), Counter()
    for text in {t for _, t in rows}:
        n_t.update({w.lower() for w in pii.TERM.findall(text)})
        n_et.update({(c["entity"], t["term"]) for c in pii.contexts(text, pii.identifiers(text), 2) for t in c["terms"]})

    def bound(k, n, z=rules.deviations):
        return (k / n + z * z / (2 * n) - z * ((k / n * (1 - k / n) + z * z / (4 * n)) / n) ** 0.5) / (1 + z * z / n)

    want = {(e, t): bound(k, n_t[t]) for (e, t), k in n_et.items() if n_t[t] > 1 and k >= 2 and bound(k, n_t[t]) >= 0.05}
    assert told(docs, rules) == pytest.approx(want) and len(want) > 8


def test_sanitising_rows_of_repeated_and_null_ids(spark, no_documents):
    rows = [(1, "write to a@b.co now"), (1, "other text"), (None, "call a@b.co"), (None, None), (1, "write to a@b.co now"), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(3))
    got = sorted((str(r.doc_id), str(r.text)) for r in pii.sanitise(docs).collect())
    assert got == sorted([("1", "write to [EMAIL] now")] * 2 + [("1", "other text"), ("None", "call [EMAIL]"), ("None", "None"), ("2", "")])
    assert pii.sanitise(no_documents).isEmpty()


def test_texts_with_a_term(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["aaa", "bbb", "ccc", "ddd"]) for _ in range(rng.randint(0, 4))) for _ in range(300)] + [None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    copied = spark.createDataFrame([(pii.text_hash(t),) for t in {t or "" for t in texts}], "copy long")
    want = {w: sum(w in t for t in {t or "" for t in texts}) for w in ("aaa", "bbb", "ccc", "ddd")}
    asked = spark.createDataFrame([(w,) for w in want], "term string")
    assert {r.term: r.n_t for r in pii.term_texts(docs, copied, asked).collect()} == want
    few = {r.term for r in pii.term_texts(docs, copied, asked.where("term = 'bbb'")).collect()}
    assert few == {"bbb"}
