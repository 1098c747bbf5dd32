"""Findings against Python's matcher, and what the ledger spares."""

import hashlib
import re

from fraudtide.llm import secrets

BASE = (
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)


def expected(text):
    spans = []
    for number, (kind, pattern, group, least) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                spans.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(spans)]


def check(df, docs):
    got = sorted((r.spans, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in df.collect())
    want = []
    for r in docs.collect():
        spans = expected(r.text)
        joined = ",".join(spans)
        counts = [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]
        want.append((joined, hashlib.sha256(joined.encode()).hexdigest(), *counts))
    assert got == sorted(want)


def test_tricky_texts(spark):
    key, digits = "AKIA" + "Q7" * 9, "0123456789abcdef" * 2
    texts = [
        "token: token: abcdefgh", "TOKEN=secret=abcdef", "passwd = 'a' password : \"hunter22x\"", f"🙂é {key} {digits}",
        f"{digits}g{digits}", "AKIAAKIA" + "A" * 13, "api_key:abcdef apikey=abcde api-key=abcdef", f"ſecret=abcdefgh {digits}" * 30,
        "toKen=123456", "",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check(secrets.secret_report(docs), docs)


def test_odd_documents(odd_documents, no_documents):
    check(secrets.secret_report(odd_documents), odd_documents)
    assert secrets.secret_report(no_documents).count() == 0


def test_ledger_scans_only_what_is_new(spark):
    docs = spark.createDataFrame([(1, "token=abcdef1"), (2, "token=abcdef1"), (3, "x")], "doc_id long, text string")
    ledger = secrets.scan_unseen(docs).persist()
    assert ledger.count() == 2 * len(secrets.RULES)
    assert secrets.scan_unseen(docs, ledger).count() == 0
    newer = (secrets.Rule("hex", "[0-9a-f]{6,}+", version=2), *secrets.RULES[:2])
    fresh = secrets.scan_unseen(docs, ledger, newer)
    assert {(r.rule, r.rule_version) for r in fresh.collect()} == {("hex", 2)} and fresh.count() == 2
    later = docs.union(spark.createDataFrame([(4, "token=zzzzzz")], docs.schema))
    added = secrets.scan_unseen(later, ledger)
    assert added.select("blob").distinct().count() == 1
    found = {r.path: len(r.spans) for r in secrets.findings(later, ledger.union(added)).collect()}
    assert found == {1: 1, 2: 1, 3: 0, 4: 1}
