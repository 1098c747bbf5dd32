"""Collocations against counting all phrases, whatever the memory of a group."""

import random
import re
from collections import Counter, defaultdict

import pytest

from fraudtide.llm import phrases
from fraudtide.llm.phrases import Mining


def pieces(text):
    lower = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", lower)]


def counts_of(rows, words):
    counts = defaultdict(Counter)
    for r in rows:
        own = counts[r.lang if r.lang is not None else "und"]
        for piece in pieces(r.text):
            for k in range(1, words + 1):
                own.update(" ".join(piece[i : i + k]) for i in range(len(piece) - k + 1))
    return counts


def plain(rows, rules):
    out = []
    for lang, f in counts_of(rows, rules.words).items():
        n = sum(c for p, c in f.items() if " " not in p)
        candidates = {p: c for p, c in f.items() if " " in p and c >= rules.least}
        covered = set()
        for longer, c in candidates.items():
            ws = longer.split(" ")
            for k in range(2, len(ws)):
                for i in range(len(ws) - k + 1):
                    inner = " ".join(ws[i : i + k])
                    if 100 * c >= rules.covered * f[inner]:
                        covered.add(inner)
        scored = []
        for p, a in candidates.items():
            if p in covered:
                continue
            ws = p.split(" ")
            cuts = [(f[" ".join(ws[:k])], f[" ".join(ws[k:])]) for k in range(1, len(ws))]
            score, _, left, right = min((rules.scale * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
            scored.append((-score, -a, p.encode(), (p, a, left, right, n, score)))
        out += [(lang, i, *row) for i, (*_, row) in enumerate(sorted(scored)[: rules.best], 1)]
    return sorted(out)


def found(docs, rules):
    return sorted(tuple(r) for r in phrases.collocations(docs, rules).collect())


@pytest.fixture(scope="module")
def crowded(spark):
    """Few words, some of them in a third of all places, phrases that repeat, and two languages."""
    rng = random.Random(8)
    words = ["the"] * 8 + ["of"] * 4 + ["Él", "漢", "a\x00b", "new", "york", "city", "x", "y", "z"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        text += rng.choice(["", ", New  York\tcity hall!", " the the the the the", "\r\n\n. . one-off%d" % i])
        rows.append((text, rng.choice(["en", "en", None, "und", "xx"])))
    return spark.createDataFrame(rows, "text string, lang string").repartition(5)


@pytest.mark.parametrize("memory", [4, 60, 700, 10**6])
def test_as_counting_all(crowded, memory):
    rules = Mining(least=8, memory=memory, best=60)
    assert found(crowded, rules) == plain(crowded.collect(), rules)


def test_frequencies_are_those_of_all_phrases(crowded):
    rules = Mining(least=5, memory=100)
    words, nodes = phrases.frequencies(crowded, rules)
    want = counts_of(crowded.collect(), 4)
    assert {(r.lang, r.phrase): r.n for r in words.collect()} == {(g, p): c for g, f in want.items() for p, c in f.items() if " " not in p}
    rows = nodes.collect()
    assert len({(r.lang, r.phrase) for r in rows}) == len(rows)
    assert {(r.lang, r.phrase): r.n for r in rows} == {(g, p): c for g, f in want.items() for p, c in f.items() if " " in p and c >= 5}


def test_given_documents_and_odd_ones(documents, odd_documents, no_documents):
    assert found(documents, Mining()) == plain(documents.collect(), Mining())
    for rules in (Mining(least=2), Mining(least=1, memory=1500)):
        assert found(odd_documents, rules) == plain(odd_documents.collect(), rules)
    assert found(no_documents, Mining()) == []


def test_groups_fit_their_memory(crowded):
    rules = Mining(least=5, memory=300)
    rows = phrases.frequencies(crowded, rules)[0]
    docs = crowded.fillna("und", ["lang"])
    often = phrases.Frequent.of(rows, rules)
    cut, levels = phrases.vertical_cut(docs, rows, often, rules)
    assert cut.heavy and levels
    sizes = phrases.dealt(docs, cut, often, rules).selectExpr("grp", "aggregate(counts, 0L, (a, b) -> a + b) AS n").groupBy("grp").sum("n").collect()
    assert len(sizes) > 3 and max(r[1] for r in sizes) <= 2 * rules.memory


def test_rows_are_counted_by_their_first_words():
    import numpy as np

    rng = np.random.default_rng(1)
    for top in (3, 40_000, 2**31 - 1):
        rows = rng.integers(0, top, (500, 4))
        rows = rows[rng.integers(0, 500, 3000)]
        got, n = phrases._different(rows)
        want = Counter(map(tuple, rows.tolist()))
        assert list(map(tuple, got.tolist())) == sorted(want) and n.tolist() == [want[k] for k in sorted(want)]


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**15
    found = spark.createDataFrame([("en", "a b", big, ["a", "b"])], "lang string, phrase string, a long, words array<string>")
    counts = spark.createDataFrame([("en", "a", big), ("en", "b", 3 * big)], "lang string, phrase string, n long")
    assert phrases._scored(found, counts, Mining()).first().score == 500_000
