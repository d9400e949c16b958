import random
import re

import pytest

from wardline.llm import neardup


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows, percent=85):
    sets = {}
    for doc, text in rows:
        sets.setdefault(doc, shingles(text))
    head = {d: d for d in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = sorted(d for d in sets if d is not None)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                head[y] = x
    out = []
    for doc, text in rows:
        if doc is None:
            out.append((None, len(shingles(text)), None, True))
        else:
            out.append((doc, len(sets[doc]), find(doc), find(doc) == doc))
    return sorted(out, key=repr)


def run(frame, percent=85):
    return sorted((tuple(r) for r in neardup.near_duplicates(frame, percent).collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return words


@pytest.mark.parametrize("percent", [85, 92])
def test_families_of_copies_match_brute_force(make_docs, percent):
    rng = random.Random(percent)
    rows, doc = [], 0
    for family in range(8):
        base = [f"f{family}-{rng.randrange(500)}" for _ in range(rng.choice([6, 30, 150, 400]))]
        pool = [base]
        for _ in range(rng.choice([2, 12, 40])):
            source = rng.choice(pool)  # copies of copies: chains without a common centre
            copy = edited(rng, source, rng.randrange(4)) if len(base) > 10 else list(source)
            pool.append(copy)
            rows.append((doc, " ".join(copy).upper() if doc % 5 == 0 else " ".join(copy)))
            doc += 1
    rng.shuffle(rows)
    assert run(make_docs(rows), percent) == brute(rows, percent)


def test_a_link_past_the_centre_is_found(make_docs):
    """x is linked with y alone, and y with the bucket's smallest document: no star holds x-y."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    y = edited(rng, base, 4)
    x = edited(rng, y, 4)
    rows = [(1, " ".join(base)), (2, " ".join(y)), (3, " ".join(x))]
    want = brute(rows)
    assert [r[2] for r in want] == [1, 1, 1]
    assert run(make_docs(rows)) == want


def test_templates_do_not_make_all_pairs(make_docs):
    """Two page templates that carry the same bodies: nothing is linked, and pairs grow with documents."""
    seen = []
    for n in (40, 80):
        rng = random.Random(n)
        rows = []
        for i in range(n):
            body = [f"b{rng.randrange(10**9)}" for _ in range(60)]
            for t in (0, 1):
                template = [f"t{t}-{k}" for k in range(160)]
                rows.append((2 * i + t, " ".join(template + body)))
        frame = make_docs(rows)
        assert run(frame) == brute(rows)
        kept = []
        plain = neardup._residual_pairs
        neardup._residual_pairs = lambda *a: kept.append(plain(*a)) or kept[0]
        try:
            neardup.near_duplicates(frame, 85)
        finally:
            neardup._residual_pairs = plain
        seen.append(kept[0].count())
    assert seen[1] <= 2 * seen[0] + 10 and seen[1] <= 80


def test_odd_rows(make_docs, odd_rows, clash):
    rows = [r for r in odd_rows if r[0] not in (4, 5)]
    assert run(clash(make_docs(rows))) == brute(rows)
    assert run(make_docs([])) == []
    long = {r[0]: r for r in run(make_docs([r for r in odd_rows if r[0] in (4, 5)]))}
    assert long[5][2:] == (4, False) and long[4][2:] == (4, True)


def test_densification_agrees_between_equal_and_differs_between_other_sets():
    import numpy as np

    some = [np.sort(np.random.default_rng(i).integers(0, 2**64, n, dtype=np.uint64)) for i, n in enumerate((1, 3, 50, 5000))]
    a, b = neardup.densified(np, some), neardup.densified(np, some[::-1])[::-1]
    assert (a == b).all()
    assert all(np.isin(row, own).all() for row, own in zip(a, some))


@pytest.mark.parametrize("links", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)]])
def test_components(spark, links):
    found = {r.node: r.comp for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    head = {x: x for l in links for x in l if l[0] != l[1]}
    for _ in range(len(head)):
        for a, b in links:
            if a != b:
                head[a] = head[b] = min(head[a], head[b])
    assert found == head


def test_pipeline_drops_pairs_from_four_fifths_on(spark, make_docs):
    import corpus_pipeline

    rng = random.Random(80)
    rows = []
    for pair in range(60):
        base = [f"p{pair}-{n}" for n in range(120 + pair)]
        # a changed tail of d words leaves n - 4 - d shingles of n - 4 + d
        d = int((len(base) - 4) / 9) + (pair % 3 == 0)
        rows += [(2 * pair, " ".join(base)), (2 * pair + 1, " ".join(base[: len(base) - d] + [f"e{rng.random()}" for _ in range(d)]))]
    want = {r[0] for r in brute(rows, 80) if r[3]}
    assert len(want) == 80 and len([r for r in brute(rows, 85) if r[3]]) == 120
    kept = corpus_pipeline.drop_near_duplicates(spark, make_docs(rows), "").collect()
    assert {r.doc_id for r in kept} == want
