"""Edited texts, likeness and the search, each against plain Python."""

import hashlib

from pyspark.sql import functions as F

from fraudtide.llm import simhash


def bits(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def ordered(docs):
    return sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))


def check(docs):
    rows = ordered(docs)
    want = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.append((str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = simhash.fingerprint_report(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    for r in got:
        assert r.near_edited == 1 - bits(r.fingerprint, r.edited_fingerprint) / 128
        assert 0 <= r.near_next <= 1
    return got


def test_documents(documents):
    got = {r.doc_id: r for r in check(documents)}
    ids = sorted(got)
    for i, doc_id in enumerate(ids):
        following = got[ids[(i + 1) % len(ids)]]
        assert got[doc_id].near_next == 1 - bits(got[doc_id].fingerprint, following.fingerprint) / 128
        near = sum(bits(got[doc_id].fingerprint, r.fingerprint) <= 4 for r in got.values()) - 1
        assert got[doc_id].n_within == (near if doc_id % 20 == 0 else None)
    by_text = {}
    for r in documents.collect():
        by_text.setdefault(r.text, set()).add(got[r.doc_id].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    nearer = sum(r.near_edited > r.near_next for r in got.values())
    assert nearer > 0.95 * len(got)


def test_odd_documents(odd_documents, no_documents):
    check(odd_documents)
    assert simhash.fingerprint_report(no_documents).count() == 0
    assert simhash.fingerprints(no_documents).count() == 0


def test_many_small_buckets(documents, monkeypatch):
    monkeypatch.setattr(simhash, "DOCS_PER_BUCKET", 7)
    check(documents)


def test_search_finds_all_within_the_radius(spark):
    rows = [(int(i * 0x9E3779B97F4A7C15 % (1 << 62)), i * 7919) for i in range(40)]
    rows += [(hi ^ sum(1 << (5 * k) for k in range(n)), lo ^ (1 << 40 if n % 2 else 0)) for hi, lo in rows[:20] for n in range(1, 6)]
    table = spark.createDataFrame(rows, "hi long, lo long").distinct()
    all_ = [tuple(r) for r in table.collect()]
    for radius, blocks in ((4, 6), (2, 3), (3, 7)):
        got = sorted((r.hi, r.lo, r.near_hi, r.near_lo) for r in simhash.near(table, table, radius, blocks).collect())
        want = sorted((*a, *b) for a in all_ for b in all_ if (a[0] ^ b[0]).bit_count() + (a[1] ^ b[1]).bit_count() <= radius)
        assert got == want


def test_weights_and_signs(spark):
    rows = spark.createDataFrame([(1, "a b c"), (2, "a b c a b c a b c"), (3, " a\tb\nc ")], "doc_id long, text string")
    prints = {r.doc_id: (r.hi, r.lo) for r in simhash.votes(rows, ["doc_id"]).collect()}
    assert prints[1] == prints[3]
    one = rows.where("doc_id = 1").select(F.xxhash64(F.lit("hi"), F.lit("a"), F.lit("b"), F.lit("c")).alias("hi")).first().hi
    assert prints[1][0] == one
