import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardline.llm import maxscore

from .conftest import SCHEMA

ITEMS = "item_id long, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(d[0], Counter(terms(d[1]))) for d in docs]
    n_docs = sum(1 for _, b in bags if b)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, query in wanted.items():
        scored = []
        for doc, bag in bags:
            if doc is None:
                continue
            m = 10 + (90 * sum(bag.values()) * n_docs) // max(1, n_terms)
            score = 0
            for t in query:
                if tf := bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def run(spark, make_docs, docs, items, k=10, parts=4):
    frame = make_docs(docs).repartition(parts)
    found = maxscore.rank(frame, spark.createDataFrame(items, ITEMS), k)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def corpus(seed=4, n=600):
    rng = random.Random(seed)
    stock = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(stock, weights, k=rng.randrange(1, 120)))) for i in range(n)]
    items = [(i, " ".join(rng.choices(stock, weights, k=25))) for i in range(30)]
    docs += [(2000 + i, items[3][1]) for i in range(40)]  # ties
    docs += [(3000 + i, docs[i][1] + " " + items[i][1]) for i in range(10)]
    return docs, items


@pytest.mark.parametrize("limits", [(16 << 20, 1 << 20), (2000, 40)])
def test_matches_brute_force(spark, make_docs, monkeypatch, limits):
    """Also with blocks of a few documents, floors from some of them, and several parts of queries."""
    monkeypatch.setattr(maxscore, "BLOCK_BYTES", limits[0])
    monkeypatch.setattr(maxscore, "SLICE_BYTES", limits[0] // 2)
    monkeypatch.setattr(maxscore, "PART_TERMS", limits[1] * 5)
    monkeypatch.setattr(maxscore, "FLOOR_BLOCKS", 3)
    docs, items = corpus()
    if limits[1] == 40:
        items = items[:8]
    assert run(spark, make_docs, docs, items) == brute(docs, items)


def test_odd_rows(spark, make_docs, odd_rows, clash):
    docs = odd_rows + [(20, "AbC-dEf 1,2;3 É"), (21, "abc def"), (22, "É é"), (23, "!!! ..."), (24, None), (24, "abc")]
    items = [(1, "abc DEF é"), (None, "w1 w2"), (None, "w3"), (2, None), (3, ""), (4, "?"), (5, "nowhere"), (1, "one"),
             (6, "x" * 300_000), (7, "w5"), (7, "w5")]
    assert run(spark, make_docs, docs, items) == brute(docs, items)
    wide = clash(make_docs(docs))
    items_wide = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS Item_Id", "'a' AS TEXT", "2 AS term")
    found = sorted((tuple(r) for r in maxscore.rank(wide, items_wide).collect()), key=repr)
    assert found == brute(docs, items)


def test_empty_tables(spark, make_docs):
    docs, items = corpus(5, 20)
    assert run(spark, make_docs, [], items) == []
    assert run(spark, make_docs, docs, []) == []
    assert run(spark, make_docs, [(1, None)], items) == []
    assert spark.createDataFrame([], SCHEMA).count() == 0


def test_pairs_tighten_bounds():
    """Two lists that share no document bound a document by the larger maximum, not by the sum."""
    assert maxscore.prefix_bounds([5, 7], [0]) == [0, 5, 7]
    assert maxscore.prefix_bounds([5, 7], [9]) == [0, 5, 9]
    assert maxscore.prefix_bounds([5, 7], [-1]) == [0, 5, 12]
    assert maxscore.prefix_bounds([5, 7, 4, 6], [0, 11, 0]) == [0, 5, 7, 11, 13]


def test_pairs_skip_more_than_single_terms(monkeypatch):
    """Lists that two kinds of documents hold: pair bounds open fewer candidates, same answer."""
    rng = np.random.default_rng(0)
    n, opened = 4000, {}
    wide = [np.flatnonzero(np.arange(n) % 2 == i % 2) for i in range(6)]
    rare = rng.choice(n, 40, replace=False)
    rare.sort()
    lists = [*wide, rare]
    impacts = [np.full(len(x), 10 + i) for i, x in enumerate(wide)] + [np.full(len(rare), 45)]

    class Queries:
        terms = np.arange(7, dtype="u8")
        pairs = np.array([(i, i + 1) for i in range(6)])

    starts = np.cumsum([0] + [len(x) for x in lists])[:-1]
    docs, flat = np.concatenate(lists).astype("u4"), np.concatenate(impacts)
    here, joint = maxscore._pair_maxima(np, Queries.pairs, np.arange(7), starts, np.append(starts, len(docs))[1:], docs, flat, n)
    row = {"ids": np.arange(n).astype("<i8"), "known": np.ones(n, "u1"), "terms": np.arange(7).astype("<i4"),
           "starts": starts.astype("<i8"), "docs": docs, "impacts": flat.astype("<i8"),
           "maxima": np.array([x.max() for x in impacts]).astype("<i8"), "pairs": here.astype("<i4"), "joint": joint.astype("<i8")}
    block = maxscore.Block(np, Queries, {k: v.tobytes() for k, v in row.items()})
    query, after = np.arange(7), np.arange(6)
    found = {}
    for kind in ("pairs", "singles"):
        if kind == "singles":
            block.pair_max = np.full(6, -1)
        _, maxima, near = maxscore._present(np, block, query, after)
        opened[kind] = sum(b < 70 for b in maxscore.prefix_bounds(maxima, near))
        docs_found, scores = maxscore._search(np, block, query, after, 70, np.zeros(n, np.int64))
        found[kind] = dict(zip(docs_found.tolist(), scores.tolist(), strict=True))
    assert found["pairs"] == found["singles"] and found["pairs"]
    assert opened["pairs"] > opened["singles"]
