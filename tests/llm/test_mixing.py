"""Water-filling against a loop, and what the mix takes."""

from collections import Counter, defaultdict

import pytest

from fraudtide.llm import mixing


def filled(sizes, weights, total, epochs):
    """Clamp, share out again, until no source is above its clamp."""
    left, targets, open_ = total, {}, set(sizes)
    while open_:
        weight = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / weight > epochs * sizes[s]}
        if not over:
            return targets | {s: left * weights[s] / weight for s in open_}
        for s in over:
            targets[s] = epochs * sizes[s]
            left -= targets[s]
        open_ -= over
    return targets


def ordered(sources):
    return sorted((s for s in sources if s is not None), key=lambda s: s.encode()) + ([None] if None in sources else [])


def by_source(docs):
    source_of = {r.doc_id: r.source for r in docs.collect()}
    by = defaultdict(list)
    for r in mixing.mix_report(docs).collect():
        assert 0 <= r.taken <= 2 * r.size
        by[source_of[r.doc_id]].append(r)
    return by


def test_targets_and_taken_words(documents):
    by = by_source(documents)
    sizes = {s: own[0].source_size for s, own in by.items()}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(ordered(sizes))}
    want = filled(sizes, weights, 1.5 * sum(sizes.values()), 2)
    for s, own in by.items():
        assert own[0].target == pytest.approx(want[s])
        assert sum(r.size for r in own) == sizes[s]
        assert abs(sum(r.taken for r in own) - want[s]) <= 1


def test_reruns_and_partitions_agree(documents):
    once = sorted(mixing.mix_report(documents).collect())
    assert once == sorted(mixing.mix_report(documents.repartition(13)).collect())


def test_odd_documents(odd_documents, no_documents):
    rows = mixing.mix_report(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mix_report(no_documents).count() == 0
    assert mixing.mixed(no_documents).count() == 0


def test_mixed_rows_have_the_words_of_the_plan(documents, odd_documents):
    mixed = mixing.mixed(documents)
    assert mixed.columns == documents.columns
    texts = {(r.doc_id, r.text) for r in documents.collect()}
    rows = mixed.collect()
    assert {(r.doc_id, r.text) for r in rows} <= texts
    times = Counter(r.doc_id for r in rows)
    for own in by_source(documents).values():
        assert all(times[r.doc_id] in (r.taken // r.size, -(-r.taken // r.size)) for r in own if r.size)
        missed = sum(times[r.doc_id] * r.size - r.taken for r in own)
        assert 2 * abs(missed) <= max(r.size for r in own)
    odd = mixing.mixed(odd_documents)
    assert odd.columns == odd_documents.columns
    assert odd.exceptAll(odd_documents.unionAll(odd_documents)).count() == 0
    assert odd.where("text IS NULL OR trim(text) = ''").count() == 0
