"""Components against all pairs."""

import random

import numpy as np
import pytest

from fraudtide.llm import sigtree
from fraudtide.llm.groups import Forest


def gram_sets(rows, k):
    sets = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc_id] = frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    return sets


def expected(rows, k, over, under):
    sets = gram_sets(rows, k)
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and under * len(sets[a] & sets[b]) >= over * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed=6, groups=6, copies=25):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(500)]
    shared = [rng.choice(pool) for _ in range(60)]
    rows = []
    for g in range(groups):
        base = [rng.choice(pool) for _ in range(rng.choice([3, 12, 80, 130, 300]))]
        for _ in range(copies):
            text = [rng.choice(pool) if rng.random() < 0.012 else w for w in base]
            rows.append(" ".join(text + (shared if g % 2 else [])))
    rows += ["Two Words", "two words", "", None, "one"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "over", "under", "block"), [(3, 9, 10, 1024), (5, 4, 5, 1024), (2, 4, 5, 8)])
def test_all_pairs(spark, k, over, under, block):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sigtree.similar_documents(docs, sigtree.Grams(words=k, over=over, under=under, block=block))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == expected(rows, k, over, under)


@pytest.mark.parametrize("small", [0, 3, 64])
def test_second_round_alone_finds_all(spark, monkeypatch, small):
    monkeypatch.setattr(sigtree, "SMALL_GROUP", small)
    monkeypatch.setattr(sigtree, "_first_round", lambda sets, rules: sets.selectExpr("digest a", "digest b").where("false"))
    rows = near_copies(seed=9, groups=4, copies=15)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sigtree.similar_documents(docs, sigtree.Grams(words=3, over=9, under=10, block=6))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == expected(rows, 3, 9, 10)


def test_traversal_loses_no_pair():
    rng = np.random.default_rng(3)
    rules = sigtree.Grams(words=3, over=9, under=10)
    base = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    sets = []
    for _ in range(120):
        size = rng.integers(60, 400)
        own = base[: size].copy()
        change = rng.integers(0, size, size // 25)
        own[change] = rng.integers(0, 1 << 63, len(change), dtype=np.uint64)
        sets.append(np.unique(own))
    sizes = np.array([len(s) for s in sets])
    sigs = [sigtree.signature(s) for s in sets]
    found = set()
    for i, j, _ in sigtree.similar_pairs(sizes, sigs, np.arange(len(sets)), rules):
        found |= {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True)}
    for a in range(len(sets)):
        for b in range(a):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if 10 * shared >= 9 * (sizes[a] + sizes[b] - shared):
                assert (b, a) in found


def test_forest():
    forest = Forest(6)
    forest.join(np.array([4, 2, 5]), np.array([5, 3, 3]))
    assert forest.root.tolist() == [0, 1, 2, 2, 2, 2]


def test_odd_documents(odd_documents, no_documents):
    rules = sigtree.Grams(words=3, over=9, under=10)
    rows = sigtree.similar_documents(odd_documents, rules).collect()
    assert len(rows) == odd_documents.count()
    found = {r.doc_id: r for r in rows}
    assert found[0].n_shingles == found[1].n_shingles == found[2].n_shingles == 0
    assert found[1].component_id == 1 and found[6].component_id == 5 and found[10].component_id == 9
    assert sigtree.similar_documents(no_documents, rules).count() == 0
    kept = sigtree.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert {6, 10} & {r.doc_id for r in kept.collect()} == set()
