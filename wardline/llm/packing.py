"""Mixture-controlled packing of token sequences.

Each source is a queue of documents. Every window of `window` tokens is filled by deficit
round-robin: a window credits each queue with its target share of the tokens, a queue spends its
credit in whole tokens, and what it could not spend (or overspent by less than a token) is carried
to the next window. That schedule has a closed form: token t (from 0) of a queue with weight w is
due at (t + 1/2) / w, windows take tokens in the order they are due (ties: the earlier queue), and
a queue's deficit after any window is its target minus what it has spent. A task can therefore find
the state of the schedule at any window without the windows before it, so deficits carry exactly
across windows and partitions while every partition is packed on its own. A queue that runs dry
leaves the others to share by their weights. Within a window the queues stand one after the other.

Any number of sources: they are the leaves of a tree whose nodes have FAN children at most. The schedule
above is that of the root over its children; a child that is a node itself hands the tokens it gets to
its own children by the same rule, with the sum of their weights as its own. So the state at a window
costs FAN steps a level, each source keeps its name and its share, deficits stay below a token a level,
and what a source that ran dry leaves goes to its node first. Up to FAN sources are one level.

By default the weights are the queues' own token counts, so that all last to the end. All windows
are full but the last; what remains is cut into sequences of falling powers of two, which need no
padding. A document is cut at the windows that its tokens are in, which are found token by token where
the document is spread thinly, so its cost follows its own length and not the number of windows.

Steps: tokenise once and write (document, tokens), where each task also counts its queues' tokens;
sum those counts over tasks to place every document in its queue; cut. Ids cross a shuffle only where
the counts of (task, queue), BROADCAST_ROWS, are too many to be sent to all tasks. Null text counts as
empty, a null source is a queue of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import row_numbers
from ..sources.layers import materialize
from .common import bound_batches, pick
from .wordhash import Hasher, mix, slices, text_bytes, word_spans

WINDOW = 4096
FAN = 32
SENT_SOURCES = 100_000  # so many sources' tree is sent to the tasks, some 3 MB; larger ones travel by path
MAX_KNOWN_PIECES, MAX_KNOWN_IDS = 700_000, 6_000_000  # some 30 MB
MAX_NEWEST = 50_000
ENCODE_WORDS = 5_000
SLICE_BYTES = 1 << 20  # text handled at once
BROADCAST_ROWS = 500_000  # of (block, queue) rows, some 40 bytes each

TOKENS = "block int, doc_id long, queue string, before long, n long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, source string"
)


class WordTokenizer:
    """Token ids of texts, piece by piece, remembering the pieces it has met.

    It holds for tokenizers like the given one: lower-casing, splitting at white space and between
    letters, single digits and other signs, so a text's ids are those of its pieces. Words of plain
    ASCII without an apostrophe, `<` or control character are cut into such pieces here, and only
    new pieces go to the tokenizer, without its normaliser and splitter, which would not change
    them. All other words go to the tokenizer whole and unchanged."""

    def __init__(self, load: Callable, width: str):
        import numpy as np
        from tokenizers import pre_tokenizers

        self.width = width
        self.hasher = Hasher()
        self.tokenizer = load()
        self.usual = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        split = [
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
        self.plain = None, pre_tokenizers.Sequence(split)
        kind = np.zeros(256, np.uint8)  # 0 goes to the tokenizer whole
        kind[33:127] = 3
        kind[97:123] = kind[65:91] = 1
        kind[48:58] = 2
        kind[[ord("'"), ord("<")]] = 0
        self.kind = kind
        self._forget()

    def _use(self, steps):
        """One tokenizer serves both ways, to hold its vocabulary once."""
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = steps

    def _forget(self):
        import numpy as np

        # Piece numbers by hash: sorted arrays, and a short list of the newest pieces.
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.newest: dict[int, int] = {}
        # Of piece i: self.flat[starts[i]:starts[i] + counts[i]]. Arrays with room to grow.
        self.pieces, self.used = 0, 0
        self.starts, self.counts = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, self.width)

    def _find(self, unique):
        """Piece numbers of hashes, -1 for pieces not met before."""
        import numpy as np

        out = np.full(len(unique), -1, dtype="i8")
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, unique), len(self.hashes) - 1)
            same = self.hashes[at] == unique
            out[same] = self.numbers[at[same]]
        if self.newest:
            rest = np.flatnonzero(out < 0)
            get = self.newest.get
            out[rest] = [get(h, -1) for h in unique[rest].tolist()]
        return out

    def _add(self, hashes):
        """Numbers new hashes from the last one on."""
        import numpy as np

        base = self.pieces
        self.newest.update(zip(hashes.tolist(), range(base, base + len(hashes)), strict=True))
        if len(self.newest) > MAX_NEWEST:
            every = np.concatenate([self.hashes, np.array(list(self.newest), np.uint64)])
            numbers = np.concatenate([self.numbers, np.array(list(self.newest.values()), np.int32)])
            order = np.argsort(every)
            self.hashes, self.numbers = every[order], numbers[order]
            self.newest = {}

    def ids(self, texts) -> tuple:
        """(ids of all texts in a row, where each text's ids start, and the end)."""
        import numpy as np
        import pandas as pd

        data, bounds = text_bytes(texts)
        space = self.hasher.space[data]
        starts, ends = word_spans(np, space, bounds)
        kind = self.kind[data]
        odd = np.zeros(len(data) + 1, np.int32)
        np.cumsum((kind == 0) & ~space, out=odd[1:])
        simple = odd[ends] == odd[starts]
        # Within simple words a piece starts at each digit and wherever the kind changes.
        cut = np.zeros(len(data), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        cover = np.zeros(len(data) + 1, np.int8)
        cover[starts[simple]] += 1
        cover[ends[simple]] -= 1
        cut &= np.cumsum(cover[:-1], dtype=np.int8).astype(bool)
        cut[starts] = False
        more = np.flatnonzero(cut)
        a = np.sort(np.concatenate([starts, more]))
        b = np.sort(np.concatenate([ends, more]))
        folded = self.hasher.lower[data]
        plain = odd[b] == odd[a]
        hashes = self.hasher.spans(folded, a, b)
        if not plain.all():  # case may matter to the tokenizer there: hash them as they are
            rest = np.flatnonzero(~plain)
            hashes[rest] = mix(np, self.hasher.spans(data, a[rest], b[rest]) + np.uint64(1))
        codes, unique = pd.factorize(hashes)
        if self.pieces > MAX_KNOWN_PIECES or self.used > MAX_KNOWN_IDS:
            self._forget()
        numbers = self._find(unique)
        fresh = np.flatnonzero(numbers < 0)
        if len(fresh):
            seen = np.full(len(unique), -1, dtype="i8")
            seen[codes[::-1]] = np.arange(len(codes))[::-1]  # first place of each
            self._learn(folded, data, a, b, plain, seen[fresh], unique[fresh])
            numbers[fresh] = self._find(unique[fresh])
        pieces = numbers[codes]
        counts = self.counts[pieces].astype("i8")
        total = np.concatenate([[0], np.cumsum(counts)])
        place = np.arange(total[-1]) + np.repeat(self.starts[pieces] - total[:-1], counts)
        return self.flat[place], total[np.searchsorted(a, bounds, "left")]

    def _learn(self, folded, data, a, b, plain, places, hashes):
        """Encodes the new pieces at `places` and appends their ids. Letters alone, in composed
        form, need no splitter either."""
        import unicodedata

        import numpy as np

        simple = plain[places]
        others, order_others = [], []
        order_words = np.flatnonzero(simple).tolist()
        low, high = a[places], b[places]
        raw = folded.tobytes()
        words = [raw[low[i] : high[i]].decode("ascii") for i in order_words]
        raw = data.tobytes()
        for i in np.flatnonzero(~simple).tolist():
            text = raw[low[i] : high[i]].decode("utf-8")
            small = text.lower()
            if (
                text.isalpha()
                and len(small) == len(text)
                and "\u03c3" not in small
                and "\u03c2" not in small
                and unicodedata.is_normalized("NFC", text)
            ):
                words.append(small)
                order_words.append(i)
            else:
                others.append(text)
                order_others.append(i)
        ids, counts = [], []
        self._use(self.plain)
        for at in range(0, len(words), ENCODE_WORDS):
            some = words[at : at + ENCODE_WORDS]
            code = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids.append(np.array(code.ids, dtype=self.width))
            counts.append(np.bincount(np.array(code.word_ids, dtype="i8"), minlength=len(some)))
        self._use(self.usual)
        for at in range(0, len(others), ENCODE_WORDS):
            codes = self.tokenizer.encode_batch(others[at : at + ENCODE_WORDS], add_special_tokens=False)
            found = [c.ids for c in codes]
            counts.append(np.array([len(x) for x in found], dtype="i8"))
            ids.append(np.array([x for y in found for x in y], dtype=self.width))
        order = np.array(order_words + order_others)
        self._add(hashes[order])
        counts, ids = np.concatenate(counts), np.concatenate(ids)
        self.starts = _put(self.starts, self.pieces, self.used + np.cumsum(counts) - counts)
        self.counts = _put(self.counts, self.pieces, counts)
        self.flat = _put(self.flat, self.used, ids)
        self.pieces += len(counts)
        self.used += len(ids)


def _put(array, used: int, more):
    """`more` behind the first `used` entries of an array, which doubles where it is too small."""
    import numpy as np

    if used + len(more) > len(array):
        grown = np.zeros(max(2 * len(array), used + len(more)), array.dtype)
        grown[:used] = array[:used]
        array = grown
    array[used : used + len(more)] = more
    return array


def _worker_tokenizer(name: str, load: Callable, width: str) -> WordTokenizer:
    """The tokenizer of this worker process: tasks that follow in it reuse the pieces it has met.
    What is remembered never changes a result. `name` stands for what `load` does."""
    import sys
    import types

    kept = sys.modules.setdefault("_wardline_worker", types.ModuleType("_wardline_worker"))
    at = (name, width)
    if at not in kept.__dict__.setdefault("tokenizers", {}):
        kept.tokenizers[at] = WordTokenizer(load, width)
    return kept.tokenizers[at]


def tokenise(docs: DataFrame, load: Callable, end_id: int, width: str = "<u4") -> DataFrame:
    """TOKENS for documents (doc_id, text, queue). `load` makes the tokenizer inside a task. `before`
    counts the tokens of the document's queue that come earlier in the same block, a block being
    what one task reads."""

    name = hashlib.sha256(cloudpickle.dumps(load)).hexdigest()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        words = _worker_tokenizer(name, load, width)
        end = np.array([end_id], dtype=width).tobytes()
        used: dict = {}
        for batch in slices(batches, "text", SLICE_BYTES):
            queues = batch.column("queue").to_pylist()
            flat, at = words.ids(batch.column("text"))
            counts = (np.diff(at) + 1).tolist()
            ids = [flat[a:b].tobytes() + end for a, b in zip(at[:-1], at[1:], strict=True)]
            before = []
            for queue, n in zip(queues, counts, strict=True):
                before.append(used.get(queue, 0))
                used[queue] = before[-1] + n
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(ids), pa.int32()), batch.column("doc_id"),
                 batch.column("queue"), pa.array(before, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                ["block", "doc_id", "queue", "before", "n", "ids"],
            )

    return docs.select("doc_id", "text", "queue").mapInArrow(run, TOKENS)


class Node:
    """The order in which a node's tokens come from its children. Token t of a child with weight w is due at
    (t + 1/2) / w; equal ones come by child."""

    def __init__(self, totals, weights):
        import numpy as np

        self.totals = np.array(totals, dtype="f8")
        self.weights = np.array(weights, dtype="f8")
        dry = np.sort(self.totals / self.weights)
        self.dry = np.concatenate([[0.0], dry])
        self.spent = np.array([np.minimum(self.totals, self.weights * t).sum() for t in self.dry])

    def taken_at(self, wanted):
        """Matrix: tokens of each child among the node's first so many tokens, exactly."""
        import numpy as np

        due = np.interp(wanted, self.spent, self.dry)
        got = np.minimum(np.floor(due[:, None] * self.weights[None, :] + 0.5), self.totals[None, :])
        open_rows = np.arange(len(wanted))
        children = len(self.totals)
        while len(open_rows):
            part = got[open_rows]
            short = wanted[open_rows] - part.sum(axis=1)
            following = np.where(part < self.totals, (part + 0.5) / self.weights, np.inf)
            latest = np.where(part > 0, (part - 0.5) / self.weights, -np.inf)
            put = following.argmin(axis=1)
            drop = children - 1 - latest[:, ::-1].argmax(axis=1)
            rows = np.arange(len(open_rows))
            soon, late = following[rows, put], latest[rows, drop]
            swap = (short == 0) & ((late > soon) | ((late == soon) & (drop > put)))
            more, less = (short > 0) | swap, (short < 0) | swap
            got[open_rows[more], put[more]] += 1
            got[open_rows[less], drop[less]] -= 1
            open_rows = open_rows[more | less]
        return got.astype("i8")

    def rank(self, child: int, positions):
        """Place in the node's order of a child's tokens, exactly."""
        import numpy as np

        due = ((positions + 0.5) / self.weights[child])[:, None]
        earlier = np.arange(len(self.totals)) < child
        got = np.floor(due * self.weights + 0.5)
        # A token of another child comes first if it is due before, or at once and that child is earlier.
        for _ in range(2):
            last = (got - 0.5) / self.weights
            got -= (got > 0) & ~((last < due) | ((last == due) & earlier))
            following = (got + 0.5) / self.weights
            got += (following < due) | ((following == due) & earlier)
        got = np.minimum(got, self.totals)
        got[:, child] = positions
        return got.sum(axis=1).astype("i8")


class Sequences:
    """Sequences of all the tokens: full windows, then falling powers of two."""

    def __init__(self, n: int, window: int):
        import numpy as np

        self.window, self.n = window, n
        full, rest = divmod(n, window)
        tail = [1 << b for b in reversed(range(window.bit_length())) if rest >> b & 1]
        self.full = full
        self.tail = np.concatenate([[0], np.cumsum(tail)]).astype("i8") + full * window
        self.count = full + len(tail)

    def first_token(self, sequence):
        """Tokens before each sequence, in all."""
        import numpy as np

        late = np.clip(sequence - self.full, 0, len(self.tail) - 1)
        return np.where(sequence <= self.full, sequence * self.window, self.tail[late])

    def sequence_of(self, token):
        """Sequence that holds the token of each rank."""
        import numpy as np

        late = self.full + np.searchsorted(self.tail, token, side="right") - 1
        return np.clip(np.where(token < self.full * self.window, token // self.window, late), 0, self.count - 1)


class Tree:
    """The nodes on the ways from the root to some sources: node (level, i) has the children FAN * i and
    on, of the level below; level 0 are the sources themselves."""

    def __init__(self, levels: int):
        self.levels, self.nodes = levels, {}

    def add(self, level: int, place: int, totals, weights) -> None:
        if (level, place) not in self.nodes:
            self.nodes[level, place] = Node(totals, weights)

    def way(self, source: int) -> list:
        """(node, child) from the root down to the source."""
        steps = [(level, source // FAN**level, source // FAN ** (level - 1) % FAN) for level in range(self.levels, 0, -1)]
        return [(self.nodes[level, place], child) for level, place, child in steps]

    def rank(self, source: int, positions):
        """Place among all tokens of a source's tokens."""
        for node, child in reversed(self.way(source)):
            positions = node.rank(child, positions)
        return positions

    def taken(self, source: int, wanted):
        """(tokens of the source, tokens of what stands before it) for each number of first tokens."""
        import numpy as np

        ahead = np.zeros(len(wanted), "i8")
        for node, child in self.way(source):
            got = node.taken_at(wanted)
            ahead = ahead + got[:, :child].sum(axis=1)
            wanted = got[:, child]
        return wanted, ahead


def whole_tree(totals: list, weights: list) -> Tree:
    levels = 1
    while FAN**levels < len(totals):
        levels += 1
    tree = Tree(levels)
    for level in range(1, levels + 1):
        for place in range(-(-len(totals) // FAN)):
            some = slice(place * FAN, (place + 1) * FAN)
            tree.add(level, place, totals[some], weights[some])
        groups = range(0, len(totals), FAN)
        totals, weights = ([sum(x[i : i + FAN]) for i in groups] for x in (totals, weights))
    return tree


STRETCH = 1 << 16  # windows that a document is followed through at once


def _windows_of(np, tree: Tree, sequences: Sequences, source: int, first: int, count: int):
    """Sequences that hold tokens first ... first + count - 1 of a source, a stretch at a time."""
    ends = sequences.sequence_of(tree.rank(source, np.array([first, first + count - 1])))
    if ends[1] - ends[0] < 2 * count:
        for a in range(int(ends[0]), int(ends[1]) + 1, STRETCH):
            yield np.arange(a, min(a + STRETCH, int(ends[1]) + 1))
    else:
        for a in range(first, first + count, STRETCH):
            positions = np.arange(a, min(a + STRETCH, first + count))
            yield np.unique(sequences.sequence_of(tree.rank(source, positions)))


def cut(tokens: DataFrame, sequences: Sequences, tree: Tree, names: list | None, width: str = "<u4") -> DataFrame:
    """PIECES of (doc_id, queue, number, position, n, ids, path): `number` is the queue's place among the
    sources, `position` the tokens of the queue before the document. `tree` is whole, or (without `names`)
    gets its nodes from the rows' `path`: totals and weights of the nodes up to the root."""

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        size = np.dtype(width).itemsize
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                doc, queue = batch.column("doc_id").to_pylist(), batch.column("number").to_pylist()
                first, count = batch.column("position").to_pylist(), batch.column("n").to_pylist()
                if names is None:
                    paths = batch.column("path").to_pylist()
                    own_tree = Tree(tree.levels)
                    for source, path in zip(queue, paths, strict=True):
                        for level, node in enumerate(path, 1):
                            own_tree.add(level, source // FAN**level, node["totals"], node["weights"])
                    called = dict(zip(queue, batch.column("queue").to_pylist(), strict=True))
                else:
                    own_tree, called = tree, names
                ids = batch.column("ids")
                rows = []
                # Documents of one source that follow each other share windows.
                for source in dict.fromkeys(queue):
                    docs = [i for i, q in enumerate(queue) if q == source]
                    ends = np.array([[first[i], first[i] + count[i] - 1] for i in docs], "i8")
                    found = sequences.sequence_of(own_tree.rank(source, ends.ravel())).reshape(-1, 2)
                    thin = [i for i, (a, b) in zip(docs, found.tolist(), strict=True) if b - a >= min(2 * count[i], STRETCH)]
                    near = [(i, a, b) for i, (a, b) in zip(docs, found.tolist(), strict=True) if i not in set(thin)]
                    work = [(i, w) for i in thin for w in _windows_of(np, own_tree, sequences, source, first[i], count[i])]
                    if near:
                        every = np.unique(np.concatenate([np.arange(a, b + 1) for _, a, b in near]))
                        work.append(([i for i, *_ in near], every))
                    for which, held in work:
                        edges = np.unique(np.concatenate([held, held + 1]))
                        taken, ahead = own_tree.taken(source, sequences.first_token(edges))
                        left, right = np.searchsorted(edges, held), np.searchsorted(edges, held + 1)
                        low, high = taken[left], taken[right]
                        before = ahead[right] - ahead[left]
                        for i in which if isinstance(which, list) else [which]:
                            a, b = first[i], first[i] + count[i]
                            raw = ids[i].as_py()
                            from_, to = np.searchsorted(high, a, "right"), np.searchsorted(low, b, "left")
                            for j in range(from_, to):
                                begin, end = max(int(low[j]), a), min(int(high[j]), b)
                                if begin >= end:
                                    continue
                                piece = raw[(begin - a) * size : (end - a) * size]
                                if size != 4:
                                    piece = np.frombuffer(piece, width).astype("<u4").tobytes()
                                rows.append(
                                    (doc[i], begin - a, end - begin, zlib.crc32(piece), count[i], int(held[j]),
                                     int(before[j]) + begin - int(low[j]), called[source])
                                )
                columns = list(zip(*rows, strict=True)) or [[]] * 8
                kinds = [pa.int64()] * 7 + [pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"],
                )

    columns = ["doc_id", "number", "position", "n", "ids"] + (["queue", "path"] if names is None else [])
    return tokens.select(*columns).mapInArrow(run, PIECES)


def _paths(sources: DataFrame, levels: int) -> DataFrame:
    """(queue, number, path) of sources (queue, number, n, w): the nodes from the source's own up to the
    root, each with its children's totals and weights."""
    out = sources.select("queue", "number", F.array().cast(f"array<{PATH}>").alias("path"))
    below = sources.select(F.col("number").alias("place"), "n", "w")
    for level in range(1, levels + 1):
        children = F.array_sort(F.collect_list(F.struct("place", "n", "w")))
        nodes = below.groupBy(F.floor(F.col("place") / FAN).alias("above")).agg(
            children.alias("c"), F.sum("n").alias("n"), F.sum("w").alias("w")
        )
        nodes = materialize(nodes, "queue-nodes")
        node = F.struct(
            F.transform("c", lambda x: x["n"]).alias("totals"), F.transform("c", lambda x: x["w"]).alias("weights")
        )
        step = nodes.select("above", node.cast(PATH).alias("node"))
        out = (
            out.withColumn("above", F.floor(F.col("number") / FAN**level))
            .join(step, "above")
            .select("queue", "number", F.concat("path", F.array("node")).alias("path"))
        )
        below = nodes.select(F.col("above").alias("place"), "n", "w")
    return out


PATH = "struct<totals:array<bigint>,weights:array<double>>"


def pack(
    docs: DataFrame,
    load: Callable,
    end_id: int,
    window: int = WINDOW,
    weights: dict | None = None,
    width: str = "<u4",
) -> DataFrame:
    """PIECES of documents (doc_id, text, source): every token in exactly one piece, no gaps within
    a sequence. `weights` gives sources their share (relative; sources not named get 1); without it
    the token counts do. `width` is the stored width of an id."""
    plain = pick(docs, "doc_id", "text", "source")
    spark = docs.sparkSession
    bound_batches(spark)
    named = plain.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("source").alias("queue"),
    )
    tokens = materialize(tokenise(named, load, end_id, width), "tokens")
    counts = materialize(tokens.groupBy("block", "queue").agg(F.sum("n").alias("n")), "token-counts")
    totals = materialize(counts.groupBy("queue").agg(F.sum("n").alias("n")), "source-counts")
    n_sources, n = totals.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_sources:
        return spark.createDataFrame([], PIECES)
    sequences = Sequences(n, window)
    if n_sources <= SENT_SOURCES:
        rows = sorted(totals.collect(), key=lambda r: (r["queue"] is not None, r["queue"]))
        names = [r["queue"] for r in rows]
        own = [r["n"] for r in rows]
        tree = whole_tree(own, own if weights is None else [max(weights.get(q, 1), 1e-9) for q in names])
        numbers = spark.createDataFrame([(q, i) for i, q in enumerate(names)], "q string, number long")
    else:
        names, levels = None, 1
        while FAN**levels < n_sources:
            levels += 1
        tree = Tree(levels)
        weight = F.col("n").cast("double")
        if weights is not None:
            given = spark.createDataFrame([(q, float(max(w, 1e-9))) for q, w in weights.items()], "q string, given double")
            totals = totals.join(given, F.col("queue").eqNullSafe(F.col("q")), "left")
            weight = F.coalesce("given", F.lit(1.0))
        placed = row_numbers(totals.select("queue", "n", weight.alias("w"), F.lit(0).alias("one")), "one", "number", F.col("queue").asc_nulls_first())
        placed = materialize(placed.select("queue", (F.col("number") - 1).alias("number"), "n", "w"), "sources")
        numbers = materialize(_paths(placed, levels).withColumnRenamed("queue", "q"), "source-paths")
    earlier = Window.partitionBy("queue").orderBy("block")
    offsets = (
        counts.withColumn("base", F.sum("n").over(earlier) - F.col("n"))
        .join(F.broadcast(numbers) if names else numbers, F.col("queue").eqNullSafe(F.col("q")))
        .select(F.col("block").alias("b"), "q", "base", *numbers.columns[1:])
    )
    if names and counts.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    placed = tokens.join(offsets, (F.col("block") == F.col("b")) & F.col("queue").eqNullSafe(F.col("q")))
    return cut(placed.withColumn("position", F.col("base") + F.col("before")), sequences, tree, names, width)
