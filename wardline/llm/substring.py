"""Exact substring dedup: words covered by a long window that an earlier document holds too.

A window is `size` consecutive words. Positions of a document are sampled by a difference cover: of
every PERIOD positions those in COVER, chosen so that for any two positions there is a shift below
PERIOD that moves both onto the cover. Any two equal windows therefore share an anchor, the hash of
size - PERIOD + 1 words, at the same shift, although each document is sampled on its own.

1. Every block of documents sends the hashes of its anchors; a bucket answers which of them more
   than one document holds (see `packed`).
2. Anchors that are shared extend: only windows around a shared anchor are hashed whole and sent,
   each with the smallest document of the block that holds it; a bucket answers which windows a
   smaller document of another block holds.
3. Within a block, repeats are found directly. Words covered by any window whose first document is
   smaller are removed.

Everything is one plan: the texts are shuffled into blocks once and that exchange is reused by the
three steps. Windows are equal when their 64-bit hashes are (and they hold a shared anchor).

Words stand between ASCII white space and are compared as they are. Null text has no words. Rows
with a null doc_id come before and after nobody: they stay whole and remove nothing. Repeated rows
of one document do not remove each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, bound_batches, pick
from .packed import SENT, edges, joined, sent, sent_table, to_table
from .wordhash import Hasher, windows

SIZE = 13
# A perfect difference set, {a - b mod 7} is everything.
PERIOD, COVER = 7, (0, 1, 3)
BLOCK_BYTES = 2 << 20
BUCKET_HASHES = 1 << 20
REPLY = "bucket long, block int, bits binary"
RESULT = "doc_id long, n_words long, n_removed long, text string"
MEMO = -1  # a block's message to itself


def dedup(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, n_removed, text) for documents (doc_id, text): the words that stay, joined
    by one space."""
    if size < PERIOD:
        raise ValueError(f"Windows need {PERIOD} words at least")
    bound_batches(docs.sparkSession)
    plain = pick(docs, "doc_id", "text")
    n_blocks, total = blocks_for(plain, "text", BLOCK_BYTES)
    n_buckets = max(1, total // 14 // BUCKET_HASHES)
    dealt = plain.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
    )

    def send_anchors(key, table):
        import numpy as np

        hashes, docs_of, _, _ = _anchors(np, _Texts(np, table), size)
        unique, several = _shared_inside(np, hashes, docs_of)
        return sent_table(sent(np, key[0].as_py(), unique, n_buckets, several.astype(np.uint8)))

    def find_shared(key, table):
        import numpy as np

        hashes, lengths = joined(np, table.column("hashes").to_pylist(), "<u8")
        inside, _ = joined(np, table.column("more").to_pylist(), np.uint8)
        _, where, count = np.unique(hashes, return_inverse=True, return_counts=True)
        seen = count > 1
        seen[where[inside > 0]] = True
        return _reply(np, table, lengths, seen[where])

    def send_windows(key, texts, replies):
        import numpy as np

        held = _Texts(np, texts)
        bits = _answers(np, replies)
        marked, memo = _candidates(np, held, bits, size, n_buckets)
        every = windows(np, held.hashes, size)
        unique, first = np.unique(every[marked], return_index=True)
        smallest = held.doc_of(marked[first])  # texts stand in order of doc_id
        base = int(smallest.min()) if len(smallest) else 0
        block = key[0].as_py()
        rows = sent(np, block, unique, n_buckets, smallest - base, base)
        rows.append((MEMO - block, block, b"", memo, 0))
        return sent_table(rows)

    def find_smaller(key, table):
        import numpy as np

        if key[0].as_py() <= MEMO:  # each block's message to itself goes through
            return _reply_table([(MEMO, b, m) for b, m in zip(
                table.column("block").to_pylist(), table.column("more").to_pylist(), strict=True)])
        hashes, lengths = joined(np, table.column("hashes").to_pylist(), "<u8")
        docs_of, _ = joined(np, table.column("more").to_pylist(), "<i8")
        docs_of = docs_of + np.repeat(np.array(table.column("base").to_pylist(), "i8"), lengths)
        unique, where = np.unique(hashes, return_inverse=True)
        least = np.full(len(unique), np.iinfo("i8").max)
        np.minimum.at(least, where, docs_of)
        return _reply(np, table, lengths, least[where] < docs_of)

    def remove(key, texts, replies):
        import numpy as np

        held = _Texts(np, texts)
        memo, bits = _memo(np, replies)
        every = windows(np, held.hashes, size)
        starts = held.starts(size)
        own = every[starts]
        gone = np.zeros(len(held.hashes) + 1, np.int32)
        if len(starts):
            # Repeats inside the block: the first in order is the smallest document.
            _, first, where = np.unique(own, return_index=True, return_inverse=True)
            owners = held.doc_of(starts)
            bad = owners[first][where] < owners
            marked = _marked(np, held, memo, size, n_buckets)
            unique, place = np.unique(every[marked], return_inverse=True)
            smaller = _spread(np, unique, bits, n_buckets)
            bad[np.searchsorted(starts, marked[smaller[place]])] = True
            np.add.at(gone, starts[bad], 1)
            np.add.at(gone, starts[bad] + size, -1)
        removed = np.cumsum(gone[:-1]) > 0
        return held.without(removed)

    anchors = dealt.groupBy("block").applyInArrow(send_anchors, SENT)
    shared = anchors.groupBy("bucket").applyInArrow(find_shared, REPLY)
    candidates = (
        dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(send_windows, SENT)
    )
    smaller = candidates.groupBy("bucket").applyInArrow(find_smaller, REPLY)
    return dealt.groupBy("block").cogroup(smaller.groupBy("block")).applyInArrow(remove, RESULT)


class _Texts:
    """Word hashes of a block's texts, in order of doc_id; rows without doc_id come last."""

    def __init__(self, np, table):
        import pyarrow as pa

        self.np = np
        table = table.sort_by("doc_id")
        self.table = table
        texts = table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())
        self.texts = texts
        self.hashes, self.first, *_ = Hasher().words(texts, lower=False)
        ids = table.column("doc_id")
        self.with_id = table.num_rows - ids.null_count
        self.ids = ids.slice(0, self.with_id).to_numpy().astype("i8")

    def starts(self, size):
        """Places where a window of that many words of one document (with an id) starts."""
        np = self.np
        last = np.maximum(self.first[1:] - size + 1, self.first[:-1])[: self.with_id]
        flags = np.zeros(len(self.hashes) + 1, np.int32)
        np.add.at(flags, self.first[:-1][: self.with_id], 1)
        np.add.at(flags, last, -1)
        return np.flatnonzero(np.cumsum(flags[:-1]) > 0)

    def text_of(self, places):
        return self.np.searchsorted(self.first, places, "right") - 1

    def doc_of(self, places):
        return self.ids[self.text_of(places)]

    def without(self, removed):
        import itertools

        import pyarrow as pa

        counts, gone, kept = [], [], []
        for i, text in enumerate(self.texts.to_pylist()):
            a, b = int(self.first[i]), int(self.first[i + 1])
            words = (text or "").encode("utf-8").split()
            mask = removed[a:b]
            if mask.any():
                words = list(itertools.compress(words, ~mask))
            counts.append(b - a)
            gone.append(int(mask.sum()))
            kept.append(b" ".join(words).decode("utf-8"))
        return pa.table(
            {
                "doc_id": self.table.column("doc_id"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()),
                "text": pa.array(kept, pa.string()),
            }
        )


def _anchors(np, held: _Texts, size: int):
    """(hashes, doc ids, places, anchor length) of the anchors at cover positions of documents that
    hold a window."""
    length = size - PERIOD + 1
    every = windows(np, held.hashes, length)
    starts = held.starts(size)
    # Anchors of a window's last shift stand up to PERIOD - 1 behind the last window.
    flags = np.zeros(len(held.hashes) + 1, np.int32)
    np.add.at(flags, starts, 1)
    np.add.at(flags, np.minimum(starts + PERIOD, len(held.hashes)), -1)
    places = np.flatnonzero(np.cumsum(flags[:-1]) > 0)
    inside = places - held.first[held.text_of(places)]
    places = places[np.isin(inside % PERIOD, COVER)]
    return every[places], held.doc_of(places), places, length


def _shared_inside(np, hashes, docs_of):
    """Sorted distinct hashes, and which of them several documents of the block hold."""
    unique, where = np.unique(hashes, return_inverse=True)
    low = np.full(len(unique), np.iinfo("i8").max)
    high = np.full(len(unique), np.iinfo("i8").min)
    np.minimum.at(low, where, docs_of)
    np.maximum.at(high, where, docs_of)
    return unique, low < high


def _reply(np, table, lengths, hit):
    """One REPLY row for each row received that has a hit: a bit for each of its hashes."""
    ends = np.cumsum(lengths)
    rows = []
    for bucket, block, a, b in zip(
        table.column("bucket").to_pylist(), table.column("block").to_pylist(),
        ends - lengths, ends, strict=True,
    ):
        if hit[a:b].any():
            rows.append((bucket, block, np.packbits(hit[a:b]).tobytes()))
    return _reply_table(rows)


def _reply_table(rows):
    import pyarrow as pa

    return to_table(rows, ["bucket", "block", "bits"], [pa.int64(), pa.int32(), pa.binary()])


def _answers(np, replies):
    return dict(zip(replies.column("bucket").to_pylist(), replies.column("bits").to_pylist(), strict=True))


def _spread(np, unique, bits: dict, n_buckets: int):
    """The bits of all buckets as one mask over the block's sorted distinct hashes."""
    hit = np.zeros(len(unique), bool)
    at = edges(np, unique, n_buckets)
    for bucket, raw in bits.items():
        a, b = at[bucket], at[bucket + 1]
        hit[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a).astype(bool)
    return hit


def _candidates(np, held: _Texts, bits: dict, size: int, n_buckets: int):
    """(places of windows around a shared anchor, packed mask of the shared anchors)."""
    hashes, _, places, _ = _anchors(np, held, size)
    unique, where = np.unique(hashes, return_inverse=True)
    hit = _spread(np, unique, bits, n_buckets)
    return _around(np, held, places[hit[where]], size), np.packbits(hit).tobytes()


def _marked(np, held: _Texts, memo, size: int, n_buckets: int):
    """The same places, from the packed mask."""
    hashes, _, places, _ = _anchors(np, held, size)
    unique, where = np.unique(hashes, return_inverse=True)
    hit = np.unpackbits(np.frombuffer(memo, np.uint8), count=len(unique)).astype(bool)
    return _around(np, held, places[hit[where]], size)


def _around(np, held: _Texts, anchors, size: int):
    """Starts of windows that hold one of the anchors at a shift below PERIOD."""
    starts = held.starts(size)
    flags = np.zeros(len(held.hashes) + 1, np.int32)
    text = held.text_of(anchors)
    np.add.at(flags, np.maximum(anchors - PERIOD + 1, held.first[text]), 1)
    np.add.at(flags, anchors + 1, -1)
    near = np.cumsum(flags[:-1]) > 0
    return starts[near[starts]]


def _memo(np, replies):
    bits = _answers(np, replies)
    return bits.pop(MEMO, b""), bits
