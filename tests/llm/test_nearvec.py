"""Links and components against all pairs."""

import math
import random

import numpy as np
import pytest

from fraudtide.llm import nearvec
from fraudtide.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, least=0.93):
    good = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, dtype=np.float32).astype(float)
        good.append((vec_id, label, x / np.linalg.norm(x)))
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (a, la, x) in enumerate(good):
        for b, lb, y in good[:n]:
            if la == lb and len(x) == len(y) and x @ y >= least:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (links[i], find(i), find(i) == i) for i in links}


def clustered(n=160, seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(8):
        base = [rng.gauss(0, 1) for _ in range(32)]
        for _ in range(n // 8):
            noise = rng.choice([0.0, 0.05, 0.15])
            scale = rng.choice([1.0, 1e-3, 50.0])
            rows.append([scale * (x + rng.gauss(0, noise)) for x in base])
    out = [(i, v, i % 2) for i, v in enumerate(rows)]
    rng.shuffle(out)
    return out


def result(spark, rows, rules=nearvec.Stable()):
    got = nearvec.near_vectors(spark.createDataFrame(rows, SCHEMA), rules).collect()
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


@pytest.mark.parametrize("block", [512, 4])
def test_all_pairs(spark, block):
    rows = clustered()
    assert result(spark, rows, nearvec.Stable(block=block)) == expected(rows)


def test_odd_vectors(spark):
    v = [1.0] * 8
    rows = [
        (1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0] * 8, 1), (7, [None, *v[1:]], 1),
        (8, [float("nan"), *v[1:]], 1), (9, [float("inf"), *v[1:]], 1), (10, [], 1), (11, [-0.0, *v[1:]], 1), (12, [0.0, *v[1:]], 1),
        (13, [1e-30] * 8, 1), (14, v[:7], 1),
    ]
    assert result(spark, rows) == expected(rows)
    empty = nearvec.near_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)]
    got = nearvec.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in got) == [(0, 0), (1, 1), (1, 1)]


def test_recall_at_the_threshold():
    """Pairs at a cosine of 0.935 share a bucket in some table in more than nine of ten cases."""
    rng = np.random.default_rng(0)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = rng.standard_normal((2000, 64))
    r -= (r * a).sum(axis=1, keepdims=True) * a
    r /= np.linalg.norm(r, axis=1, keepdims=True)
    b = 0.935 * a + math.sqrt(1 - 0.935**2) * r
    rules = nearvec.Stable()
    same = (nearvec.bucket_keys(a, rules) == nearvec.bucket_keys(b, rules)).any(axis=1)
    assert same.mean() > 0.97


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {i: i for e in edges for i in e}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for e in edges if e[0] != e[1] for i in e}
