import random
import re

import pytest

from wardline.llm import substring


def brute(rows, size=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words):
        if doc is not None:
            for k in range(len(w) - size + 1):
                at = tuple(w[k : k + size])
                first[at] = min(first.get(at, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[k : k + size])] < doc:
                gone[k : k + size] = [True] * size
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def run(frame, size=13):
    return sorted((tuple(r) for r in substring.dedup(frame, size).collect()), key=repr)


def test_cover_holds_every_difference():
    found = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert found == set(range(substring.PERIOD))


@pytest.mark.parametrize("size", [7, 13, 20])
def test_matches_brute_force_over_many_blocks(make_docs, monkeypatch, size):
    monkeypatch.setattr(substring, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(substring, "BUCKET_HASHES", 100)
    rng = random.Random(size)
    passages = [[f"p{i}-{j}" for j in range(rng.choice([6, 12, 13, 14, 40]))] for i in range(12)]
    rows = []
    for doc in range(150):
        text = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(passages)
        rows.append((doc, "  ".join(text)))
    rows += [(200 + i, rows[3][1]) for i in range(20)]
    rows += [(3, "a b " * 30), (3, "a b " * 30)]
    assert run(make_docs(rows), size) == brute(rows, size)


def test_odd_rows(make_docs, odd_rows, clash):
    rows = [r for r in odd_rows if len(r[1] or "") < 100_000] + [(None, "w " * 40), (50, "w " * 40), (51, "w " * 40)]
    assert run(clash(make_docs(rows))) == brute(rows)
    assert run(make_docs([])) == []


def test_a_very_long_text_and_its_copy(make_docs, odd_rows):
    got = {r[0]: r for r in run(make_docs([r for r in odd_rows if r[0] in (4, 5, 7)]))}
    assert got[4][2] == 0 and got[5][1:] == (60_000, 60_000, "") and got[7][1:3] == (1, 0)
