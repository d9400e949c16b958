import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from wardline.llm import convtrie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    given = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            given[c].append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [(r, x) for _, _, r, x in sorted(turns)] for c, turns in given.items()}
    built = {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = given.get(c - c % 100, [])[:h] + own[h:]
    members, children, leaves, saved = defaultdict(list), defaultdict(set), {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[x] for x in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def run(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in convtrie.prefix_trie(frame).collect()), key=repr)


def chats(seed=1, n=250):
    rng = random.Random(seed)
    rows = [
        (c, t, "user" if rng.random() < 0.9 else "assistant", rng.choice(["a", "bb", "ccc", "é日"]))
        for c in range(n)
        for t in range(rng.randrange(1, 9))
    ]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [(50_000, 32, 1024), (3, 2, 4), (1, 2, 1)])
def test_matches_brute_force(spark, monkeypatch, sizes):
    """Also where runs, merged ranges and buckets are so small that every node crosses boundaries."""
    for name, value in zip(("RUN", "FAN", "BUCKET"), sizes):
        monkeypatch.setattr(convtrie, name, value)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = chats()
        rows += [(c, t, "user", f"long{t}") for c in range(1000, 1030) for t in range(c - 1000 + 8)]  # each one longer
        rows += [(c, t, "user", f"copy{t}") for c in range(1100, 1140) for t in range(10)]
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_one_conversation_holds_most_rows(spark):
    rows = chats(2, 30) + [(1500, t, "user", "x" * (t % 7)) for t in range(4000)]
    rows += [(1501, t, "user", "x" * (t % 7)) for t in range(3000)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "a", "no conversation"), (1600, None, None, None), (1600, 0, "user", None), (1600, 3, None, "q"),
        (1601, 1, "user", ""), (-5, 1, "u", "negative"), (-5, 2, "u", "negative"), (0, 0, "", ""),
        (1700, 0, "u", "same"), (1700, 0, "u", "same"), (1700, 0, "u", "same"), (1701, 5, "u", "y" * 200_000),
        (1702, 5, "u", "y" * 200_000), (2**40, 1, "far", "away"),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(None, 1, "a", "b")]) == []
    assert run(spark, []) == []


def test_extra_columns(spark):
    rows = chats(3, 20)
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS CONV_ID", "2 AS seg", "'x' AS Text", "3 AS d")
    assert sorted(map(tuple, convtrie.prefix_trie(wide).collect()), key=repr) == brute(rows)
