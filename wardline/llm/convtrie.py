"""Prefix trie of conversations: union-find over the LCP edges of sorted neighbours.

Every conversation c is rebuilt first: the first h turns of conversation c - c % 100 (of a
negative c rounded down), then its own turns after its first h, with h = crc32(decimal c) % 6. A node of depth d stands for a distinct
sequence of the first d rebuilt turns (role, text).

1. Turns become a 128-bit hash and a length, are ordered within their conversation over ranges, so
   one conversation may span many tasks, and get the hash of the prefix that they end: the XOR of
   hashes of (turn, place), added up over ranges.
2. A sort key is contracted: it holds only the places where a prefix parts, that is, where it is
   followed by different turns or also ends. Keys with m places need m conversations of growing
   length, so no key is longer than the square root of twice the rows, whatever the conversations.
3. Conversations are ordered by key, by range. Neighbours have an LCP edge, as deep as their last
   common place. Each run of rows is joined by union-find over its edges in descending depth: every
   merge creates or extends the branching node of that depth. Components inside the run are final.
   Those that hold its first or last row stay open: only their contracted chain is handed on.
4. Runs are merged across their boundaries, FAN ranges at a time: chains meet in equal places, what
   no longer touches the new boundary is closed, and so on until one forest is left.
5. A closed component's smallest conversation gives the rows of all nodes on its stretch down from
   its parent, with sums by subtraction of running lengths.

Turns without conv_id are left out. Ties of `turn` come by role, then by a hash of the text; equal
rows are turns of their own. Null role and text are empty. An empty table has no nodes. Conversations
that a rebuild leaves without turns are members of the root. The digest of the conversations that
end at a node is a hash of one long text, so its ids stream through one task per node, in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layers import materialize
from .common import lookup, pick

FAN = 32
RUN = 50_000  # rows joined at once
BUCKET = 1024
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing

NODE = "d long, p1 long, p2 long"
RECORD = f"{NODE}, l long, pd long, pp1 long, pp2 long, n long, least long, children long, leaves long, saved long"
FOUND = f"part long, closed boolean, first boolean, last boolean, {RECORD}"


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a
    row per node, for rows (conv_id, turn, role, text)."""
    turns, convs = _rebuilt(pick(conversations, "conv_id", "turn", "role", "text"))
    ends = turns.where("last").select("c", "d", "p1", "p2", "l").union(
        convs.where("depth = 0").select("c", *[F.lit(0).cast("long")] * 4)
    )
    closed = _forest(_keys(turns, ends))
    return _nodes(closed, turns, _digests(ends))


# --- turns -----------------------------------------------------------------------------------


def _rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of rebuilt conversations (c, d, x1, x2, p1, p2, n, l, last): place from 1, hash of the
    turn at its place, hash of the prefix, code points of the turn and of the prefix; and the
    conversations (c, depth)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("c"),
        "turn",
        role.alias("role"),
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), role, text).alias("t2"),
        F.char_length(text).cast("bigint").alias("n"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("t1"), F.col("t2"), F.col("row")]
    dealt = plain.repartitionByRange("c", *order).withColumn("seg", F.spark_partition_id())
    dealt = materialize(dealt, "turns")

    upward = Window.partitionBy("c").orderBy("seg")
    segs = dealt.groupBy("c", "seg").agg(F.count(F.lit(1)).alias("m"))
    segs = materialize(
        segs.withColumn("before", F.sum("m").over(upward) - F.col("m")).withColumn("total", F.sum("m").over(Window.partitionBy("c"))),
        "turn-segments",
    )
    sizes = segs.where("before = 0").select("c", "total")
    h = F.crc32(F.col("c").cast("string").cast("binary")) % 6
    own = sizes.select("c", "total", h.alias("h"), (F.col("c") - F.pmod("c", F.lit(100))).alias("base"))
    base = sizes.select(F.col("c").alias("base"), F.col("total").alias("base_total"))
    convs = own.join(base, "base", "left").withColumn("k", F.least("h", F.coalesce("base_total", F.lit(0))))
    depth = F.col("k") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    convs = materialize(convs.select("c", "h", "base", "k", depth.cast("long").alias("depth")), "conversations")

    known = segs.select("c", "seg", "before").join(convs, "c")
    within = Window.partitionBy("c", "seg").orderBy(*order)
    place = F.row_number().over(within)
    placed = dealt.withColumn("place", place).join(known, ["c", "seg"]).withColumn("i", F.col("before") + F.col("place") - 1)

    def at(place):
        return (F.xxhash64("t1", "t2", place).alias("x1"), F.xxhash64(place, F.lit(2), "t2", "t1").alias("x2"))

    heads = placed.where("i < 5 AND c % 100 = 0").select(F.col("c").alias("base"), "i", "t1", "t2", "n")
    heads = materialize(heads, "turn-heads")
    taken = convs.join(heads, "base").where("i < h").select("c", "depth", (F.col("i") + 1).alias("d"), *at(F.col("i")), "n")
    first = _running(taken, ["c"], "d")

    moved = placed.where("i >= h").withColumn("d", F.col("k") + F.col("i") - F.col("h") + 1)
    own = moved.select("c", "seg", "depth", "d", *at(F.col("d") - 1), "n")
    own = materialize(_running(own, ["c", "seg"], "d"), "turn-prefixes")
    start = taken.groupBy("c").agg(F.bit_xor("x1").alias("a1"), F.bit_xor("x2").alias("a2"), F.sum("n").alias("al"))
    parts = own.groupBy("c", "seg").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"), F.sum("n").alias("sl"))
    earlier = upward.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = (
        parts.select(
            "c", "seg",
            *[F.coalesce(f(c).over(earlier), zero).alias(c) for f, c in ((F.bit_xor, "s1"), (F.bit_xor, "s2"), (F.sum, "sl"))],
        )
        .join(start, "c", "left")
        .select(
            "c", "seg",
            *[F.col(s).bitwiseXOR(F.coalesce(a, zero)).alias(s) for s, a in (("s1", "a1"), ("s2", "a2"))],
            (F.col("sl") + F.coalesce("al", zero)).alias("sl"),
        )
    )
    rest = own.join(carried, ["c", "seg"]).select(
        "c", "depth", "d", "x1", "x2", "n",
        F.col("p1").bitwiseXOR(F.col("s1")).alias("p1"),
        F.col("p2").bitwiseXOR(F.col("s2")).alias("p2"),
        (F.col("l") + F.col("sl")).alias("l"),
    )
    turns = rest.unionByName(first).withColumn("last", F.col("d") == F.col("depth")).drop("depth")
    return materialize(turns, "rebuilt-turns"), convs.select("c", "depth")


def _running(turns: DataFrame, group: list, order: str) -> DataFrame:
    """With the prefix hash and length over the rows of the group so far."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return turns.select(
        "*",
        F.bit_xor("x1").over(upto).alias("p1"),
        F.bit_xor("x2").over(upto).alias("p2"),
        F.sum("n").over(upto).alias("l"),
    )


# --- keys ------------------------------------------------------------------------------------


def _keys(turns: DataFrame, ends: DataFrame) -> DataFrame:
    """(c, key): the places at which a conversation's prefix parts from others, and its end."""
    before = [F.col(p).bitwiseXOR(F.col(x)).alias(p) for p, x in (("p1", "x1"), ("p2", "x2"))]
    follow = turns.select((F.col("d") - 1).alias("d"), *before, F.col("p1").alias("next"))
    stop = ends.select("d", "p1", "p2", F.lit(0).cast("long").alias("next"))
    parting = follow.union(stop).groupBy("d", "p1", "p2").agg(F.min("next").alias("u"), F.max("next").alias("v"))
    parting = materialize(parting.where("u <> v").select("d", "p1", "p2", F.lit(True).alias("parts")), "partings")
    slim = turns.select("c", "d", "p1", "p2", "l", "last")
    held = lookup(slim, parting, ["d", "p1", "p2"]).where("parts OR last")
    keys = held.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("d", "p1", "p2", "l"))).alias("key"))
    alone = ends.where("d = 0").select("c", F.expr("CAST(array() AS array<struct<d:long,p1:long,p2:long,l:long>>)").alias("key"))
    return keys.union(alone)


# --- forest ----------------------------------------------------------------------------------


def _forest(keys: DataFrame) -> DataFrame:
    """Closed components (RECORD) of all conversations."""

    def build(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        forest = None
        for run in _runs(batches):
            closed, forest = _merge(forest, _contract(run))
            yield _table(part, closed, None)
        if forest is not None:
            yield _table(part, [], forest)

    dealt = keys.repartitionByRange("key", "c").sortWithinPartitions("key", "c")
    found = materialize(dealt.mapInArrow(build, FOUND), "forest")
    closed = [found.where("closed")]
    still = found.where("NOT closed")
    while True:
        most = still.agg(F.max("part")).first()[0]
        if most is None:
            break
        final = most < FAN

        found = still.withColumn("was", F.col("part")).withColumn("part", F.floor(F.col("part") / FAN))
        found = materialize(found.groupBy("part").applyInArrow(_folder(final), FOUND), "forest")
        closed.append(found.where("closed"))
        if final:
            break
        still = found.where("NOT closed")
    out = closed[0]
    for more in closed[1:]:
        out = out.union(more)
    return out.drop("part", "closed", "first", "last")


ROOT = (0, 0, 0)
L, PARENT, N, LEAST, CHILDREN, LEAVES, SAVED = range(7)


class Forest:
    """Open components {place: [l, parent, n, least, children, leaves, saved]} of a run of rows, and
    the places on the way to its first and its last row. What counts below a place holds closed
    children only, until the place is closed itself."""

    def __init__(self, nodes: dict, first: set, last: set):
        self.nodes, self.first, self.last = nodes, first, last


def _runs(batches):
    """Runs of at most RUN rows (c, key), keys as tuples of (d, p1, p2, l) behind the root's."""
    held = []
    for batch in batches:
        column = batch.column(batch.schema.names.index("key"))
        fields = column.flatten().flatten()
        flat = list(zip(*[f.to_pylist() for f in fields], strict=True))
        at = 0
        for c, size in zip(batch.column(batch.schema.names.index("c")).to_pylist(), column.value_lengths().to_pylist(), strict=True):
            held.append((c, [(*ROOT, 0), *flat[at : at + size]]))
            at += size
            if len(held) == RUN:
                yield held
                held = []
    if held:
        yield held


def _close(state: list, parent: list) -> None:
    """Count a finished component as a child of its parent."""
    state[LEAVES] = state[LEAVES] or 1
    parent[N] += state[N]
    parent[CHILDREN] += 1
    parent[LEAVES] += state[LEAVES]
    parent[SAVED] += state[SAVED] + (state[N] - 1) * (state[L] - parent[L])


def _contract(run: list):
    """(closed components, Forest) of sorted rows (c, key): union-find over the LCP edges of
    neighbours, deepest first."""
    keys = [k for _, k in run]
    # An edge per pair of neighbours: the index of the last place that both keys hold.
    shared = []
    for one, other in zip(keys, keys[1:], strict=False):
        j = 0
        for x, y in zip(one, other, strict=False):
            if x != y:
                break
            j += 1
        shared.append(j - 1)
    edges = sorted(range(len(shared)), key=lambda i: -keys[i][shared[i]][0])

    above = list(range(len(run)))  # union-find over components, named by their first row
    end = list(range(len(run)))
    index = [len(k) - 1 for k in keys]
    state = [[k[-1][3], None, 1, c, 0, 0, 0] for c, k in run]
    closed, opened = [], {}

    def find(x):
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    def leave(x, j, into):
        """Component x, deeper than place j, becomes a child of that place."""
        at, key = index[x], keys[x]
        into[LEAST] = min(into[LEAST], state[x][LEAST])
        if x == 0 or end[x] == len(run) - 1:  # it may go on beyond the run
            opened[key[at][:3]] = state[x]
        else:
            _close(state[x], into)
            closed.append((key[at][:3], key[j][:3], state[x]))

    for i in edges:
        a, b, j = find(i), find(i + 1), shared[i]
        if index[a] == j:
            into = state[a]
        else:
            into = [keys[a][j][3], None, 0, state[a][LEAST], 0, 0, 0]
            leave(a, j, into)
        if index[b] == j:
            for k in (N, CHILDREN, LEAVES, SAVED):
                into[k] += state[b][k]
            into[LEAST] = min(into[LEAST], state[b][LEAST])
        else:
            leave(b, j, into)
        above[b], end[a], index[a], state[a] = a, end[b], j, into
    opened[keys[0][index[0]][:3]] = state[0]

    nodes = {}
    for key in (keys[0], keys[-1]):
        for j, place in enumerate(key):
            parent = key[j - 1][:3] if j else None
            one = opened.get(place[:3]) or [place[3], None, 0, None, 0, 0, 0]
            one[PARENT] = parent
            nodes[place[:3]] = one
    return closed, Forest(nodes, {p[:3] for p in keys[0]}, {p[:3] for p in keys[-1]})


def _merge(forest, found):
    """(closed components, Forest) of two neighbouring runs."""
    closed, right = found
    if forest is None:
        return closed, right
    nodes = forest.nodes
    for place, more in right.nodes.items():
        one = nodes.setdefault(place, more)
        if one is not more:
            for k in (N, CHILDREN, LEAVES, SAVED):
                one[k] += more[k]
            one[LEAST] = _least(one[LEAST], more[LEAST])
    merged = Forest(nodes, forest.first, right.last)
    return closed + _settle(merged, merged.first | merged.last), merged


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _settle(forest: Forest, stay: set) -> list:
    """Close the components that are not to stay, deepest first."""
    closed = []
    for place in sorted(set(forest.nodes) - stay, reverse=True):
        state = forest.nodes.pop(place)
        parent = forest.nodes.get(state[PARENT])
        if parent is not None:
            parent[LEAST] = _least(parent[LEAST], state[LEAST])
            _close(state, parent)
        else:
            state[LEAVES] = state[LEAVES] or 1
        closed.append((place, state[PARENT], state))
    return closed


def _folder(final: bool):
    return lambda table: _fold(table, final)


def _fold(table, final: bool):
    """Forests of neighbouring ranges merged; with `final` closed altogether."""
    ranges = {}
    names = table.column_names
    for values in zip(*[table.column(n).to_pylist() for n in names], strict=True):
        row = dict(zip(names, values, strict=True))
        forest = ranges.setdefault(row["was"], Forest({}, set(), set()))
        place = (row["d"], row["p1"], row["p2"])
        parent = None if row["pd"] is None else (row["pd"], row["pp1"], row["pp2"])
        forest.nodes[place] = [row["l"], parent, *(row[k] for k in ("n", "least", "children", "leaves", "saved"))]
        for name in ("first", "last"):
            if row[name]:
                getattr(forest, name).add(place)
    part = table.column("part")[0].as_py()
    closed, merged = [], None
    for _, forest in sorted(ranges.items(), key=lambda x: x[0]):
        done, merged = _merge(merged, ([], forest))
        closed += done
    if final:
        closed += _settle(merged, set())
        merged = None
    import pyarrow as pa

    return pa.Table.from_batches([_table(part, closed, merged)])


def _table(part: int, closed: list, forest):
    """Rows of FOUND."""
    import pyarrow as pa

    rows = [(part, True, False, False, *p, s[L], *(q or (None,) * 3), *s[N:]) for p, q, s in closed]
    if forest is not None:
        for p, s in forest.nodes.items():
            rows.append((part, False, p in forest.first, p in forest.last, *p, s[L], *(s[PARENT] or (None,) * 3), *s[N:]))
    names = [x.split()[0] for x in FOUND.split(", ")]
    kinds = [pa.bool_() if "boolean" in x else pa.int64() for x in FOUND.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


# --- result ----------------------------------------------------------------------------------


def _digests(ends: DataFrame) -> DataFrame:
    """(d, p1, p2, sha): digest of the ids of the conversations that end at a place, streamed."""

    def hash_all(batches):
        import hashlib

        import pyarrow as pa

        place, state, done = None, None, []

        def table():
            columns = list(zip(*done, strict=True)) or [()] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["d", "p1", "p2", "sha"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for d, p1, p2, c in zip(*columns, strict=True):
                if place == (d, p1, p2):
                    state.update(b",%d" % c)
                    continue
                if place is not None:
                    done.append((*place, state.hexdigest()))
                place, state = (d, p1, p2), hashlib.sha256(b"%d" % c)
            yield table()
            done = []
        if place is not None:
            done = [(*place, state.hexdigest())]
            yield table()

    place = ("d", "p1", "p2")
    dealt = ends.select(*place, "c").repartition(*place).sortWithinPartitions(*place, "c")
    return dealt.mapInArrow(hash_all, f"{NODE}, sha string")


def _nodes(closed: DataFrame, turns: DataFrame, digests: DataFrame) -> DataFrame:
    place = ["d", "p1", "p2"]
    above = ["pd", "pp1", "pp2"]
    closed = materialize(closed.join(digests, place, "left"), "components")
    parents = closed.select(*[F.col(c).alias(a) for c, a in zip(place, above, strict=True)], F.col("least").alias("top"))
    whole = lookup(closed.where("pd IS NOT NULL"), parents, above)
    columns = ("least", "d", "pd", "top", "l", "n", "children", "leaves", "saved", "sha")
    stretch = whole.select(*columns).withColumn(
        "bucket", F.explode(F.sequence(F.floor((F.col("pd") + 1) / BUCKET), F.floor(F.col("d") / BUCKET)))
    )
    # Rows of one conversation and BUCKET depths meet the stretches that they may lie on.
    rows = turns.select(
        F.col("c").alias("least"), F.floor(F.col("d") / BUCKET).alias("bucket"), F.col("d").alias("depth"),
        (F.col("l") - F.col("n")).alias("l_before"),
    )
    met = rows.join(stretch, ["least", "bucket"]).where("depth > pd AND depth <= d")
    bottom = F.col("depth") == F.col("d")
    empty = F.lit(EMPTY)
    inner = met.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == F.col("pd") + 1, F.col("top")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(bottom, F.col("children")).otherwise(F.lit(1)).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + (F.col("n") - 1) * (F.col("l") - F.col("l_before"))).alias("saved_tokens"),
        F.when(bottom, F.coalesce("sha", empty)).otherwise(empty).alias("ends_sha256"),
    )
    root = closed.where("pd IS NULL").select(
        F.col("least").alias("conv_id"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", empty).alias("ends_sha256"),
    )
    return inner.unionByName(root)
