import math
import random

import pytest

from wardline.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, is_query, k, scale=256):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for i, v in whole:
        if is_query(i):
            scored = sorted(
                (-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i and len(w) == len(v)
            )
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, is_query="vec_id % 50 = 0", k=5):
    vectors = topk.integer_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding")
    return sorted(tuple(r) for r in topk.top_k(vectors, vectors.where(is_query), k).collect())


@pytest.mark.parametrize("blocks", [(8192, 1024, 16), (40, 3, 4)])
def test_matches_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("CANDIDATE_BLOCK", "QUERY_BLOCK", "SLICE"), blocks):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11),
             (2004, [0.5] * 3), (2050, [0.25] * 3), (2051, []), (2100, []), (2101, [0.0] * 12), (None, [0.1] * 12)]
    assert run(spark, rows) == brute(rows, lambda i: i % 50 == 0, 5)


def test_pairs_fall_to_their_bounds(monkeypatch):
    """Most pairs are given up before their last dimensions are added."""
    import numpy as np

    rng = np.random.default_rng(1)
    q, c = (np.floor(256 * rng.normal(size=(64, n)) * 0.1) for n in (50, 4000))
    late = []
    plain = topk._by_pairs
    monkeypatch.setattr(topk, "_by_pairs", lambda np, *a: late.append((len(a[4]), a[7])) or plain(np, *a))
    found = topk._bounded(np, np.arange(50), q, np.arange(1000, 5000), c, 5)
    want = []
    for i, row in enumerate((q.T @ c).tolist()):
        best = sorted((-s, 1000 + j) for j, s in enumerate(row))[:5]
        want += [(i, j, int(-s)) for s, j in best]
    assert sorted(found) == sorted(want)
    assert late and late[0][0] < 0.5 * 50 * 4000 and late[0][1] < 64


def test_few_candidates_empty_table_and_large_components(spark):
    rows = [(0, [1.0, -2.0]), (1, [0.5, 0.5])]
    assert run(spark, rows) == brute(rows, lambda i: i % 50 == 0, 5)
    assert run(spark, []) == []
    big = [(0, [5e5, -15e5]), (1, [1e6, 1.0]), (2, [-5e5, 25e4])]
    assert run(spark, big) == brute(big, lambda i: i % 50 == 0, 5)


def test_extra_columns(spark):
    rows = [(0, [1.0]), (1, [2.0])]
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS VEC_ID", "2 AS v", "3 AS block")
    vectors = topk.integer_vectors(wide, "vec_id", "embedding")
    assert topk.top_k(vectors, vectors, 1).count() == 2
