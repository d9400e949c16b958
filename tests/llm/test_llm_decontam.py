import random

from wardline.llm import decontam


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def words(rng, n, stock=5000):
    return [f"w{rng.randrange(stock)}" for _ in range(n)]


def brute(rows, items):
    """Best item-sized window of each document and item, over all windows."""
    import math
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in items for w in [split(t)]}
    held = {}
    for s in sets.values():
        for x in s:
            held[x] = held.get(x, 0) + 1
    weigh = lambda s: sum(1 / (1 + math.log2(held.get(x, 1))) for x in s)
    out = {}
    for doc, text in rows:
        w = split(text)
        for item, t in items:
            own = min(len(split(t)), len(w))
            if own < 5:
                continue
            best = (0, 0)
            for k in range(len(w) - own + 1):
                part = {tuple(w[j : j + 5]) for j in range(k, k + own - 4)}
                if part & sets[item]:
                    value = weigh(part & sets[item]) / weigh(part | sets[item])
                    best = max(best, (value, -k))
            if best[0] >= 0.8:
                out[doc, item] = (-best[1], round(best[0], 9))
    return out


def test_matches_brute_force(spark, make_docs):
    rng = random.Random(1)
    items = [(i, " ".join(words(rng, rng.choice([15, 22, 40, 60])))) for i in range(12)]
    items += [(20, items[3][1] + " more at the end")]
    rows = []
    for doc in range(60):
        text = words(rng, rng.randrange(200))
        if doc % 2:
            passage = rng.choice(items)[1].split()
            if doc % 4 == 1 and len(passage) > 30:  # one word changed near the start
                passage[1] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        rows.append((doc, ", ".join(text).upper() if doc % 3 == 0 else " ".join(text)))
    rows.append((100, items[0][1]))
    rows.append((101, " ".join(items[2][1].split()[1:])))  # shorter than the item
    want = brute(rows, items)
    assert len(want) > 25
    for part_bytes in (4 << 20, 800):  # one pass, and many
        found = decontam.find_leaks(make_docs(rows), bench(spark, items), part_bytes).collect()
        got = {(r.doc_id, r.item_id): (r.first_word, round(r.similarity, 9)) for r in found}
        if part_bytes > 800:
            assert got == want and len(got) == len(found)
        else:  # weights are counted within a part
            assert {k for k, v in want.items() if v[1] == 1} <= set(got)


def test_index_finds_everything_within_the_radius():
    import numpy as np

    rng = random.Random(2)
    index = decontam.Index([(i, " ".join(words(rng, 30))) for i in range(9)])
    names, own, _ = index.by_size[30]
    gen = np.random.default_rng(5)
    for distance in (0, 1, 30, decontam.RADIUS, decontam.RADIUS + 1):
        bits = np.unpackbits(own.view(np.uint8), axis=1)
        for row in bits:
            row[gen.choice(decontam.BITS, distance, replace=False)] ^= 1
        asked = np.packbits(bits, axis=1).view(np.uint16)
        window, item, found = index.lookup(np, 30, asked)
        same = window == item
        assert (same.sum() == 9 and (found[same] == distance).all()) == (distance <= decontam.RADIUS)


def test_odd_rows(spark, make_docs, odd_rows, clash):
    items = [(1, "one"), (2, "no id here at all, only a text"), (3, None), (4, ""), (None, "w1 w2 w3 w4 w5"), (5, "... !"), (6, odd_rows[4][1])]
    found = decontam.find_leaks(clash(make_docs(odd_rows)), clash(bench(spark, items))).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in found) == [(0, 2), (4, 6), (5, 6), (6, 1)]
    assert decontam.find_leaks(make_docs([]), bench(spark, items)).collect() == []
    assert decontam.find_leaks(make_docs(odd_rows), bench(spark, [])).collect() == []


def test_items_with_repeated_shingles(spark, make_docs):
    rng = random.Random(7)
    refrain = lambda n, times: words(rng, n) + words(rng, 5) * times
    items = [(i, " ".join(refrain(20, rng.choice([6, 10, 20])) + words(rng, 20))) for i in range(6)]
    items += [(6, "0 " * 60), (7, " ".join(["- + |"] * 30 + words(rng, 15))), (8, " ".join(words(rng, 8) * 6))]
    rows = []
    for i, text in items:
        rows.append((i, " ".join(words(rng, 50) + text.split() + words(rng, 50))))
        edited = text.split()
        edited[1] = "edited"
        rows.append((100 + i, " ".join(words(rng, 9) + edited)))
        rows.append((200 + i, " ".join(words(rng, 5000) + text.split() * 3)))
    want = brute(rows, items)
    assert {(k + i, i) for i, _ in items for k in (0, 200)} <= set(want) and len(want) > 24
    found = decontam.find_leaks(make_docs(rows), bench(spark, items)).collect()
    assert {(r.doc_id, r.item_id): (r.first_word, round(r.similarity, 9)) for r in found} == want


def test_fingerprints_of_windows_count_each_shingle_once():
    import numpy as np

    gen = np.random.default_rng(3)
    shingles = gen.integers(0, 2**63, 40, dtype=np.uint64)[gen.integers(0, 40, 6000)]
    shingles[1000:1300] = shingles[0]
    seen = 0
    for size, starts, own, prints in decontam._windows_near(np, [9, 64, 300], shingles, np.arange(0, 6000, 7)):
        for at, got in list(zip(starts.tolist(), prints, strict=True))[::17]:
            part = np.unique(shingles[at : at + own - 4])
            want = decontam.fingerprints(np, decontam.bit_rows(np, part).astype("i4").sum(axis=0)[None])
            assert (want[0] == got).all()
            seen += 1
    assert seen > 500


def test_equal_and_missing_item_ids(spark, make_docs):
    rng = random.Random(11)
    texts = [" ".join(words(rng, rng.choice([3, 20, 20, 35]))) for _ in range(24)]
    items = [((None, 1, 2)[n % 3], text) for n, text in enumerate(texts)]
    rows = [(n, " ".join(words(rng, 30) + text.split() + words(rng, 30))) for n, text in enumerate(texts)]
    rows.append((50, " ".join([texts[0], *words(rng, 9), texts[1], *words(rng, 9), texts[4]])))
    want = {(n, items[n][0]) for n in range(24)} | {(50, None), (50, 1)}
    for part_bytes in (4 << 20, 800):
        found = decontam.find_leaks(make_docs(rows), bench(spark, items), part_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)
        assert all(r.similarity == 1 for r in found)


def test_weights_do_not_depend_on_the_parts(spark, make_docs):
    rng = random.Random(13)
    common = [words(rng, 12) for _ in range(4)]
    items = [(i, " ".join(words(rng, 20) + common[i % 4] + common[i % 3] + words(rng, 9))) for i in range(16)]
    rows = []
    for doc in range(48):  # own words exchanged for those of another item, near the threshold
        text = items[doc % 16][1].split()
        n = rng.randrange(1, 9)
        text[:n] = rng.choice(common)[:n] if doc % 2 else words(rng, n)
        rows.append((doc, " ".join(words(rng, 20) + text + words(rng, 20))))
    want = brute(rows, items)
    assert 10 < sum(0.8 <= v < 0.95 for _, v in want.values())
    for part_bytes in (4 << 20, 1500, 500):
        found = decontam.find_leaks(make_docs(rows), bench(spark, items), part_bytes).collect()
        got = {(r.doc_id, r.item_id): (r.first_word, round(r.similarity, 9)) for r in found}
        assert len(got) == len(found) and got == want


def test_parts_by_items_repeated_rows_and_thinning(spark, make_docs):
    """Many short items, one row of the benchmark very often: bounded parts, same result; documents that
    hold no word run of the benchmark are not read again."""
    rng = random.Random(17)
    items = [(i, " ".join(words(rng, rng.choice([2, 4, 16])))) for i in range(60)] + [(5, "only these five words here")] * 3000
    rows = [(n, " ".join(words(rng, 20) + items[n % 61][1].split() + words(rng, 20))) for n in range(90)]
    rows += [(1000 + n, " ".join(f"clean{rng.random()}" for _ in range(60))) for n in range(200)]
    whole = sorted(map(tuple, decontam.find_leaks(make_docs(rows), bench(spark, items)).collect()), key=repr)
    parted = decontam.find_leaks(make_docs(rows), bench(spark, items), part_items=15).collect()
    assert sorted(map(tuple, parted), key=repr) == whole and len({r[0] for r in whole}) == 90
    docs = make_docs(rows)
    kept = {r.doc_id for r in docs.where(decontam._may_hold(bench(spark, items))).collect()}
    assert set(range(90)) <= kept and len(kept) < 120
