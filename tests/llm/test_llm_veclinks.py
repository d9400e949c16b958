import math

import numpy as np
import pytest

from wardline.llm import veclinks

SCHEMA = "vec_id long, e array<double>"


def brute(rows, threshold=0.9):
    unit = []
    for _, v in rows:
        good = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        a = np.array(v) / np.abs(v).max() if good else None
        unit.append(a / np.linalg.norm(a) if good else None)
    n = len(rows)
    above, count = list(range(n)), [0] * n

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for a in range(n):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                count[a] += 1
                count[b] += 1
                above[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), 2**63), i)
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(find(k))
        out.append((i, count[k], c, c is None or i == c))
    return sorted(out, key=repr)


def run(spark, rows, threshold=0.9):
    found = veclinks.near_duplicates(spark.createDataFrame(rows, SCHEMA), "vec_id", "e", threshold)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def clustered(dims=24):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(150, dims))
    rows = [(i, b.tolist()) for i, b in enumerate(base)]
    for i in range(150, 600):
        spread = rng.choice([0.02, 0.3, 0.35, 0.4])
        rows.append((i, (base[rng.integers(0, 12)] + rng.normal(size=dims) * spread).tolist()))
    return rows, base


@pytest.mark.parametrize("sizes", [(4096, 512, 64, 16), (50, 7, 2, 3)])
def test_matches_brute_force(spark, monkeypatch, sizes):
    """In one block, and in many blocks under several levels of boxes."""
    for name, value in zip(("BLOCK", "TILE", "TOP", "FAN"), sizes):
        monkeypatch.setattr(veclinks, name, value)
    rows, base = clustered()
    rows += [(1000 + i, base[3].tolist()) for i in range(40)]  # copies
    rows += [(2000 + i, (base[5] * 2.0**i).tolist()) for i in range(5)]
    rows += [(5, base[9].tolist()), (None, base[7].tolist())]
    want = brute(rows)
    assert sum(r[1] for r in want) > 1000
    assert run(spark, rows) == want


def test_odd_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0] * 3), (4, [None] * 3), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf")] * 3),
            (7, [1e200] * 3), (8, [2e200] * 3), (9, [1e-200] * 3), (10, [1.0, 2.0]), (11, [1.0, 2.0]), (12, [-0.0, 1.0]),
            (13, [0.0, 1.0]), (14, [1.0]), (14, [1.0]), (15, [-1.0]), (None, [0.0, -1.0]), (None, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_the_threshold_itself_links(spark):
    rows = [(1, [1.0, 0.0]), (2, [3.0, 4.0]), (3, [4.0, 3.0])]
    assert run(spark, rows, 0.6) == brute(rows, 0.6)
    assert [r[1] for r in run(spark, rows, 0.6)] == [2, 2, 2]


def test_tight_group_is_linked_by_its_boxes(spark, monkeypatch):
    """Within one tight group no product of two vectors is formed, and all links are counted."""
    monkeypatch.setattr(veclinks, "_tile_links", None)
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(16) + rng.normal(size=16) * 1e-3).tolist()) for i in range(1500)]
    assert {r[1:3] for r in run(spark, rows)} == {(1499, 0)}


def test_slices_give_pairs_up(monkeypatch):
    """On vectors without links, few pairs come to a whole product."""
    rng = np.random.default_rng(2)
    table = rng.normal(size=(512, 64))
    unit = veclinks._unit(np, table)
    basis = {64: np.linalg.svd(unit, full_matrices=False)[2][:32].T}
    whole = []
    monkeypatch.setattr(np, "einsum", lambda *a: whole.append(a) or np.multiply(a[1], a[2]).sum(axis=1))
    block = (np.arange(512), np.ones(512, np.int64), table)
    node, *_ = veclinks.link_blocks(np, block, block, True, basis, 0.9)
    assert len(node) == 0
    compared = sum(len(a[1]) for a in whole if a[1] is not a[2])
    assert compared < 512 * 512 * 0.01


def test_extra_columns_and_floats(spark):
    rows, _ = clustered(8)
    wide = spark.createDataFrame(rows[:200], SCHEMA).selectExpr(
        "vec_id", "CAST(e AS array<float>) AS e", "1 AS VEC_ID", "'x' AS d1", "2 AS node"
    )
    narrow = [(i, [float(np.float32(x)) for x in v]) for i, v in rows[:200]]
    found = sorted(map(tuple, veclinks.near_duplicates(wide, "vec_id", "e").collect()), key=repr)
    assert found == brute(narrow)
