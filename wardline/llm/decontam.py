"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Words are runs of ASCII letters and digits (A-Z lower-cased) and non-ASCII characters, so case and
punctuation do not hide a passage. For every item length that the benchmark has, each window of so
many words of a document gets a BITS-bit SimHash over its distinct SHINGLE-word shingles, like the
item itself: a shingle that repeats within the window counts once. The index cuts the
items' fingerprints of that length into BLOCKS blocks and lists each item under all block values
within RADIUS // BLOCKS bits of its own: by the pigeonhole principle any fingerprint within RADIUS
shares a listed value in some block, so none within the radius is missed. What the index finds is
checked for its Hamming distance and then exactly: the weighted Jaccard similarity of the two
shingle sets must reach `threshold`. A shingle weighs 1 / (1 + log2(items that hold it)), counted over
the distinct rows of the whole benchmark, in whole units of 1 / UNIT: sums are exact, in any order.

At similarity 0.8 the expected distance is 39 of 256 bits (deviation 5.7); a radius of 60 leaves out
about one window in ten thousand there, and practically none above.

Only windows that hold some benchmark shingle are fingerprinted: any other has similarity 0 with
every item. A document shorter than an item is compared as one window. Items of fewer than SHINGLE
words are one shingle and match where their words stand; items without words match nothing.

The benchmark is sent to the tasks in parts of `part_bytes` of text and `part_items` items at most, one
pass for each part, so what is broadcast, and the index that a task makes of it (some 70 kB an item),
have a bound whatever the benchmark's size. With several parts the documents are first thinned to those
that may hold a shingle (or short item) of the benchmark, by one filter of 2**GATE_BITS bits, and the
passes read these only. Also with several parts, shingles are counted over all of them first, and a part gets the counts of its own shingles.
A window's other shingles may be held by items of other parts: their weights are joined to the
windows that could reach the threshold, and the similarity is made from the sums. One row per
document and item id: the best window (the first among equals). Rows of the benchmark that share an
id are one item with several texts, of which the best match counts; rows without id are items like
any other, together under a null id. Null text has no words.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.layers import materialize
from .common import bound_batches, pick
from .licenses import word_table
from .wordhash import Hasher, mix, slices, windows

SHINGLE = 5
BITS, BLOCKS, RADIUS = 256, 16, 60
THRESHOLD = 0.8
PART_BYTES = 4 << 20
PART_ITEMS = 2000
GATE_BITS = 24
SLICE_BYTES = 1 << 20
STEP = 4096  # windows fingerprinted at once
UNIT = 1 << 40
# A window that may match: weights of what it shares and of the union, without `others`, which are
# the window's shingles that the part does not know.
CANDIDATE = (
    "doc_id long, item_id long, first_word long, n_words long, distance int, shared long, known long,"
    " others array<long>"
)


def weigh(count: int) -> int:
    """Weight of a shingle that so many items hold."""
    import math

    return round(UNIT / (1 + math.log2(count)))


def bit_rows(np, shingles):
    """Matrix of +1 / -1: the BITS random bits of each shingle."""
    parts = [mix(np, shingles + np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)) for i in range(BITS // 64)]
    raw = np.stack(parts, axis=1).view(np.uint8)
    return np.unpackbits(raw, axis=1).astype(np.int8) * 2 - 1


def fingerprints(np, sums):
    """Packed signs (a tie counts as 1) of summed bit rows, as 16-bit blocks."""
    return np.packbits(sums >= 0, axis=1).view(np.uint16)


def ones_table(np):
    """Number of bits set in each 16-bit value."""
    values = np.arange(1 << 16, dtype=np.uint16)
    return np.unpackbits(values.view(np.uint8).reshape(-1, 2), axis=1).sum(axis=1).astype(np.uint8)


class Index:
    """The items of one part of the benchmark, by length. Inside, an item is its place in the part;
    `ids` has the ids, which need not differ. `counts` has the sorted shingles of the part that several
    items of the whole benchmark hold, and how many; without it the part is the whole benchmark.
    `most` is the largest number of items that hold one shingle."""

    def __init__(self, items, counts=None, most: int = 1):
        import numpy as np
        import pyarrow as pa

        self.ids = [i for i, _ in items]
        hashes, first, *_ = Hasher().words(pa.array([t for _, t in items], pa.string()), table=word_table())
        self.short: dict[int, dict[int, list]] = {}
        self.by_size: dict[int, tuple] = {}
        sets, sizes = {}, {}
        for n in range(len(self.ids)):
            own = hashes[first[n] : first[n + 1]]
            if 0 < len(own) < SHINGLE:
                whole = int(windows(np, own, len(own))[0])
                self.short.setdefault(len(own), {}).setdefault(whole, []).append(n)
            elif len(own):
                sets[n] = windows(np, own, SHINGLE)
                sizes.setdefault(len(own), []).append(n)
        unique = [np.unique(s) for s in sets.values()]
        every = np.concatenate(unique) if unique else np.zeros(0, np.uint64)
        self.known, count = np.unique(every, return_counts=True)
        self.whole = counts is None
        if not self.whole:
            count = np.ones(len(self.known), "i8")
            count[np.searchsorted(self.known, counts[0])] = counts[1]
        levels, level = np.unique(count, return_inverse=True)
        self.weight = np.array([weigh(c) for c in levels.tolist()], "i8")[level]
        self.least = UNIT if self.whole else weigh(most)
        self.gate = np.zeros(1 << 20, bool)
        self.gate[(self.known >> np.uint64(44)).astype("i8")] = True
        self.sets = {n: np.unique(s) for n, s in sets.items()}
        self.ones = ones_table(np)
        near = np.flatnonzero(self.ones <= RADIUS // BLOCKS).astype(np.uint16)
        for size, members in sizes.items():
            prints = fingerprints(
                np, np.stack([bit_rows(np, np.unique(sets[n])).astype(np.int32).sum(axis=0) for n in members])
            )
            tables = []
            for block in range(BLOCKS):
                values = (prints[:, block][:, None] ^ near[None, :]).ravel()
                owners = np.repeat(np.arange(len(members), dtype=np.int32), len(near))
                order = np.argsort(values, kind="stable")
                tables.append((values[order], owners[order]))
            self.by_size[size] = (members, prints, tables)

    def holds(self, np, shingles):
        """Which shingles some item has."""
        maybe = np.flatnonzero(self.gate[(shingles >> np.uint64(44)).astype("i8")])
        if not len(maybe) or not len(self.known):
            return np.zeros(0, "i8")
        at = np.minimum(np.searchsorted(self.known, shingles[maybe]), len(self.known) - 1)
        return maybe[self.known[at] == shingles[maybe]]

    def compare(self, np, item, shingles) -> tuple:
        """(weight shared, weight of the union without the others, the others) of an item and a window;
        others are the window's shingles that no item of the part has."""
        own, other = self.sets[item], np.unique(shingles)
        both = np.intersect1d(own, other, assume_unique=True)
        at = np.minimum(np.searchsorted(self.known, other), len(self.known) - 1)
        met = self.known[at] == other
        shared, mine = (self.weight[np.searchsorted(self.known, x)].sum() for x in (both, own))
        return int(shared), int(mine + self.weight[at[met]].sum() - shared), other[~met]

    def lookup(self, np, size: int, prints):
        """(window, item place) pairs within the radius."""
        _, own, tables = self.by_size[size]
        found = []
        for block, (values, owners) in enumerate(tables):
            asked = prints[:, block]
            low, high = np.searchsorted(values, asked, "left"), np.searchsorted(values, asked, "right")
            count = high - low
            window = np.repeat(np.arange(len(prints)), count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            found.append(window * len(own) + owners[place].astype("i8"))
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(own), pairs % len(own)
        distance = self.ones[prints[window] ^ own[item]].sum(axis=1, dtype=np.int32)
        near = distance <= RADIUS
        return window[near], item[near], distance[near]


def _repeats(np, shingles):
    """Places whose shingle stands earlier too, and the last place where it does."""
    order = np.argsort(shingles, kind="stable")
    same = np.flatnonzero(shingles[order[1:]] == shingles[order[:-1]])
    return order[same + 1], order[same]


def _repeated(np, bits, again, before, span: int, n: int):
    """What repeats add to the summed bit rows of the windows of `span` shingles at 0 ... n - 1: the
    place `again` is a repeat in the windows that also hold the place `before`."""
    added = np.zeros((n + 1, BITS), np.int32)
    first = again - span + 1
    early = first <= 0
    added[0] = bits[again[early]].sum(axis=0, dtype=np.int32)
    inside = ~early & (first < n)
    added[first[inside]] += bits[again[inside]]  # no two have the same place
    ended = (early | inside) & (before + 1 < n)
    added[before[ended] + 1] -= bits[again[ended]]
    return np.cumsum(added[:n], axis=0)


def _windows_near(np, sizes, shingles, hits):
    """Fingerprints of the windows of one document that hold a benchmark shingle, a stretch at a
    time: (size, starts, words in the window, fingerprints). `hits` are the places of such
    shingles."""
    n = len(shingles) + SHINGLE - 1
    widest = max(min(size, n) for size in sizes) - SHINGLE + 1
    before = np.zeros(len(shingles) + 1, "i8")
    before[hits + 1] = 1
    before = np.cumsum(before)
    low = np.maximum(hits - widest + 1, 0)
    fresh = np.concatenate([[True], low[1:] > hits[:-1]])  # a gap that no window spans
    for a, last in zip(low[fresh].tolist(), hits[np.append(fresh[1:], True)].tolist(), strict=True):
        for at in range(a, last + 1, STEP):
            end = min(at + STEP, last + 1)  # window starts of this stretch
            high = min(end + widest, len(shingles))
            rows = np.zeros((high - at + 1, BITS), np.int32)
            bits = bit_rows(np, shingles[at:high])
            np.cumsum(bits, axis=0, out=rows[1:])
            again, before_it = _repeats(np, shingles[at:high])
            for size in sizes:
                own = min(size, n)
                span = own - SHINGLE + 1
                starts = np.arange(at, min(end, n - own + 1))
                starts = starts[before[starts + span] > before[starts]]
                if len(starts):
                    sums = rows[starts - at + span] - rows[starts - at]
                    close = again - before_it < span
                    if close.any():
                        sums -= _repeated(np, bits, again[close], before_it[close], span, end - at)[starts - at]
                    yield size, starts, own, fingerprints(np, sums)


def _best(np, index: Index, size: int, waiting: list, best: dict) -> None:
    """Looks up collected windows (document, its shingles, starts, words, fingerprints) and keeps
    what may be the best of each document and item in `best`: [the best similarity that is certain,
    candidates]. Shingles that the part does not know weigh 1 at most and index.least at least."""
    prints = np.concatenate([w[4] for w in waiting])
    owner = np.repeat(np.arange(len(waiting)), [len(w[2]) for w in waiting])
    starts = np.concatenate([w[2] for w in waiting])
    places = index.by_size[size][0]
    for window, item, distance in zip(*(x.tolist() for x in index.lookup(np, size, prints)), strict=True):
        doc, shingles, _, own, _ = waiting[owner[window]]
        start = int(starts[window])
        shared, known, others = index.compare(np, places[item], shingles[start : start + own - SHINGLE + 1])
        if index.whole:  # no other part has them
            known, others = known + len(others) * UNIT, others[:0]
        certain = float(shared) / float(known + len(others) * UNIT)
        possible = float(shared) / float(known + len(others) * index.least)
        held = best.setdefault((doc, places[item]), [0.0, []])
        if possible < THRESHOLD or possible <= held[0]:  # of equals the first counts, and starts rise
            continue
        if certain > held[0]:
            held[0], held[1] = certain, [c for c in held[1] if c[0] >= certain]
        held[1].append((possible, start, own, distance, shared, known, others))


def _counted(items: DataFrame) -> tuple:
    """((part, shingle, n) of the shingles that n > 1 items of the whole benchmark hold, for every part
    that has them; the same without parts), for items (text, part)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hasher, table = Hasher(), word_table()
        for batch in slices(batches, "text", SLICE_BYTES):
            words, first, *_ = hasher.words(batch.column("text"), table=table)
            parts = batch.column("part").to_pylist()
            for n, part in enumerate(parts):
                own = np.unique(windows(np, words[first[n] : first[n + 1]], SHINGLE)).view("i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), part, "i8")), pa.array(own)], ["part", "shingle"]
                )

    held = items.select("text", "part").mapInArrow(run, "part long, shingle long")
    held = materialize(held.groupBy("part", "shingle").agg(F.count("*").alias("n")), "item-shingles")
    several = held.groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    several = materialize(several, "shingle-counts")
    return materialize(held.select("part", "shingle").join(several, "shingle"), "part-shingle-counts"), several


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES, part_items: int = PART_ITEMS
) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance, similarity) for documents (doc_id, text) and a
    benchmark (item_id, text). Rows of the benchmark that are equal count once."""
    spark = docs.sparkSession
    bound_batches(spark)
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    items = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    items = materialize(items.where("text IS NOT NULL").distinct(), "benchmark-items")
    total, n = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    parts = max(1, -(-2 * (total or 0) // part_bytes), -(-2 * n // part_items) if n > part_items else 1)
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    if parts == 1:
        found = plain.mapInArrow(_finder(_send(items), None, 1), CANDIDATE)
        union = F.col("known")
    else:
        found = _by_part(plain, items, parts)
        union = F.col("known") + F.col("others")
    found = found.withColumn("similarity", F.col("shared").cast("double") / union.cast("double"))
    found = found.where(F.col("similarity") >= THRESHOLD)
    best = F.max_by(F.struct("first_word", "n_words", "distance", "similarity"), F.struct("similarity", -F.col("first_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _send(items: DataFrame):
    """Broadcast of the rows of one part."""
    rows = items.sort("item_id", "text").collect()
    return items.sparkSession.sparkContext.broadcast([(r.item_id, r.text) for r in rows])


def _by_part(plain: DataFrame, items: DataFrame, parts: int) -> DataFrame:
    """Candidates with `others` as the weight of those shingles. Parts run and are written one after
    the other, so that one broadcast is held at a time."""
    import numpy as np

    plain = materialize(plain.where(_may_hold(items)), "may-hold-items")
    of_part, several = _counted(items)
    most = several.agg(F.max("n")).first()[0] or 1
    found = None
    for part in range(parts):
        held = _send(items.where(F.col("part") == part))
        counts = of_part.where(F.col("part") == part).select("shingle", "n").toPandas()
        own = counts["shingle"].to_numpy("i8").view(np.uint64)
        order = np.argsort(own)
        shared = plain.sparkSession.sparkContext.broadcast((own[order], counts["n"].to_numpy("i8")[order]))
        some = plain.mapInArrow(_finder(held, shared, most), CANDIDATE)
        some = some.select("*", F.lit(part).alias("part"), F.monotonically_increasing_id().alias("row"))
        some = materialize(some, "candidates")
        held.unpersist()
        shared.unpersist()
        found = some if found is None else found.unionByName(some)
    weight = F.udf(weigh, "long")
    levels = several.select("n").distinct().select("n", weight("n").alias("weight"))
    weights = several.join(levels, "n").select("shingle", "weight")
    open_ = found.select("part", "row", F.explode("others").alias("shingle")).join(weights, "shingle", "left")
    sums = open_.groupBy("part", "row").agg(F.sum(F.coalesce("weight", F.lit(UNIT))).alias("others"))
    closed = found.drop("others").join(sums, ["part", "row"], "left")
    return closed.withColumn("others", F.coalesce("others", F.lit(0)))


def _hashes(np, words, first, sizes) -> list:
    """For each size, hashes of all runs of so many words inside the texts, and the text of each."""
    out = []
    for size in sizes:
        every = windows(np, words, size)
        of = np.searchsorted(first, np.arange(len(every)), "right") - 1
        inside = np.arange(len(every)) + size <= first[of + 1]
        out.append((every[inside], of[inside]))
    return out


def _may_hold(items: DataFrame):
    """Column: whether a text may hold a shingle of the benchmark, or one of its items of fewer words. The
    filter has 2**GATE_BITS bits, whatever the benchmark's size: a large one lets more texts pass."""
    import numpy as np

    def marks(batches):
        import numpy as np
        import pyarrow as pa

        hasher, table = Hasher(), word_table()
        for batch in slices(batches, "text", SLICE_BYTES):
            words, first, *_ = hasher.words(batch.column("text"), table=table)
            length = np.diff(first)
            spots = []
            for size, (hashes, of) in zip(range(1, SHINGLE + 1), _hashes(np, words, first, range(1, SHINGLE + 1)), strict=True):
                spots.append(hashes if size == SHINGLE else hashes[length[of] == size])
            spots = np.unique(np.concatenate(spots) >> np.uint64(64 - GATE_BITS)).astype("i8")
            yield pa.RecordBatch.from_arrays([pa.array(spots)], ["spot"])

    rows = (
        items.select("text").mapInArrow(marks, "spot long")
        .groupBy(F.shiftright("spot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 AS int))")).alias("value"))
        .toPandas()
    )
    bits = np.zeros(2**GATE_BITS // 64, "<i8")
    bits[rows["word"].to_numpy("i8")] = rows["value"].to_numpy("i8")
    gate = items.sparkSession.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool))

    @F.pandas_udf("boolean")
    def may_hold(texts: pd.Series) -> pd.Series:
        import numpy as np
        import pyarrow as pa

        hasher, table, out = Hasher(), word_table(), []
        for batch in slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])], "text", SLICE_BYTES):
            words, first, *_ = hasher.words(batch.column("text"), table=table)
            held = np.zeros(batch.num_rows, bool)
            for hashes, of in _hashes(np, words, first, range(1, SHINGLE + 1)):
                held[of[gate.value[(hashes >> np.uint64(64 - GATE_BITS)).astype("i8")]]] = True
            out.append(held)
        return pd.Series(np.concatenate(out) if out else np.zeros(0, bool), index=texts.index)

    return may_hold("text")


def _finder(held, counts, most: int):
    def find(batches):
        import numpy as np
        import pyarrow as pa

        index = Index(held.value, None if counts is None else counts.value, most)
        hasher, table = Hasher(), word_table()
        for batch in slices(batches, "text", SLICE_BYTES):
            ids = batch.column("doc_id").to_pylist()
            words, first, *_ = hasher.words(batch.column("text"), table=table)
            rows = []
            for size, wanted in index.short.items():
                every = windows(np, words, size)
                for at in np.flatnonzero(np.isin(every, np.array(list(wanted), np.uint64))).tolist():
                    doc = int(np.searchsorted(first, at, "right")) - 1
                    if at + size <= first[doc + 1]:
                        rows += [(ids[doc], index.ids[i], int(at - first[doc]), size, 0, UNIT, UNIT, []) for i in wanted[int(every[at])]]
            shingles = windows(np, words, SHINGLE)
            hits = index.holds(np, shingles)
            of = np.searchsorted(first, hits, "right") - 1
            inside = hits + SHINGLE <= first[of + 1]
            hits, of = hits[inside], of[inside]
            best: dict = {}
            waiting: dict = {}
            for doc in np.unique(of).tolist() if index.by_size else []:
                a, b = int(first[doc]), int(first[doc + 1])
                own = shingles[a : b - SHINGLE + 1]
                for size, starts, n, prints in _windows_near(np, list(index.by_size), own, hits[of == doc] - a):
                    queue = waiting.setdefault(size, [])
                    queue.append((doc, own, starts, n, prints))
                    if sum(len(w[2]) for w in queue) > STEP:
                        _best(np, index, size, waiting.pop(size), best)
            for size, queue in waiting.items():
                _best(np, index, size, queue, best)
            for (doc, i), (_, some) in best.items():
                rows += [(ids[doc], index.ids[i], *c[1:6], c[6].view("i8")) for c in some]
            kinds = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 2 + [pa.list_(pa.int64())]
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "item_id", "first_word", "n_words", "distance", "shared", "known", "others"],
            )

    return find
