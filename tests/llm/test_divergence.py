"""Divergences of sources against plain counting."""

import re
from collections import Counter, defaultdict

from fraudtide.llm import divergence
from fraudtide.llm.divergence import Audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text)]


def plain(rows, rules):
    rows = [(r.text or "", r.lang or "", r.source or "") for r in rows]
    out = []
    for lang in {lang for _, lang, _ in rows}:
        own = [(terms(t), s) for t, of, s in rows if of == lang]
        seen = Counter(t for ts, _ in own for t in set(ts))
        kept = {t for t, n in seen.items() if n >= rules.documents}
        counts = defaultdict(Counter)
        for ts, s in own:
            counts[s].update(t for t in ts if t in kept)
        every = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + rules.scale * (c[t] + rules.smoothing) // (sum(c.values()) + rules.smoothing * len(kept))

        for s, c in counts.items():
            pair = [(sum(abs(share(c, t) - share(o, t)) for t in kept), other) for other, o in counts.items() if other != s]
            term = [(share(c, t) - share(every, t), t) for t in kept if c[t] and share(c, t) > share(every, t)]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, rules.terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def found(docs, rules=Audit()):
    return sorted(tuple(r) for r in divergence.divergence(docs, rules).collect())


def test_as_plain_counting(documents, odd_documents):
    for docs, rules in ((documents, Audit()), (documents, Audit(documents=3, terms=7)), (odd_documents, Audit(documents=2)), (odd_documents, Audit(documents=1))):
        assert found(docs, rules) == plain(docs.collect(), rules)


def test_copies_sources_and_languages(spark):
    rows = [("Ab c-ab É\x00é", "x", s) for s in ("a", "a", "b", None)] * 20 + [("ab", None, "a"), (None, "x", "empty"), ("", "", "b"), ("zz top", "y", "only")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    for least in (1, 2, 80):
        assert found(docs, Audit(documents=least)) == plain(docs.collect(), Audit(documents=least))


def test_no_kept_terms_and_no_rows(spark, no_documents):
    docs = spark.createDataFrame([("one", "x", "a"), ("two", "x", "b")], "text string, lang string, source string")
    assert found(docs) == [("x", "a", "pair", "b", 0, 1), ("x", "b", "pair", "a", 0, 1)]
    assert found(no_documents) == []


def test_tasks_that_count_in_several_steps(documents, monkeypatch):
    whole = found(documents)
    batches = [b for b in divergence.collapsed(documents).toArrow().to_batches()]
    monkeypatch.setattr(divergence, "HELD", 500)
    parts = Counter()
    for batch in divergence._count_terms(iter(batches)):
        for row in batch.to_pylist():
            for share in row["shares"]:
                parts[row["lang"], share["source"], row["term"]] += share["n"]
    want = Counter((r.lang, r.source, t) for r in documents.collect() for t in terms(r.text))
    assert parts == want and whole


def test_huge_counts_are_exact(spark):
    counts = spark.createDataFrame([(4 * 10**15 + 7, 9 * 10**15 + 11, 12345)], "n long, total long, kept long")
    got = counts.select(divergence._share("n", "total", "kept", Audit())).first()[0]
    assert got == 1 + 10**9 * (4 * 10**15 + 12) // (9 * 10**15 + 11 + 5 * 12345)
