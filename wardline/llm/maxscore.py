"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

Terms are runs of ASCII letters and digits and of everything beyond ASCII, A-Z lower-cased. A term's
weight, a document's length factor and its score are integers, see `weight`, `_factors` and `_impacts`.

1. Index. Documents are read once, in tasks; every BLOCK_BYTES of text become a block with a list
   per query term (documents, occurrences). Blocks stay where they are read: no text is exchanged.
2. Impacts. With the corpus counts known, each list gets its impacts and their maximum. Then the pair
   lists: for two terms that are neighbours in some query (terms by rising weight) the intersection
   of their lists is formed, and its joint maximum kept.
3. Bounds. A document holds one of two terms or both, so a pair adds at most the largest of the two
   maxima and the joint one: often far less than their sum. The bound of a query's first i terms is
   the least over all ways to cut them into neighbouring pairs and single terms.
4. Floors. A bounded number of blocks is searched for documents with high impacts, scored in full:
   the k-th best is a floor that the answer cannot fall below.
5. Search. In each block, terms whose bound stays below the floor open no candidates; a block whose
   whole bound does is skipped. Candidates from the other lists are completed term by term, those
   that cannot reach the floor any more are dropped. Each task returns k rows a query at most.

Queries are sent to the tasks in parts of at most about PART_TERMS terms; the floors and limits
decide only how much is skipped, never a result. Terms are compared as 64-bit hashes.

Rows of one item_id are one item, whose terms are those of all its rows; null is an item_id like any
other. Items without terms, or without a document above 0, have no rows. Every row of documents is a
document, also when ids repeat. Documents without doc_id count in the statistics but are not ranked.
Null texts have no terms.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layers import materialize
from .common import bound_batches, byte_batches, pick
from .wordhash import Hasher, slices

BLOCK_BYTES = 16 << 20
BLOCK_DOCS = 1 << 18
SLICE_BYTES = 1 << 20
PART_TERMS = 1 << 20
FLOOR_BLOCKS = 256

BLOCK = "n_docs long, n_terms long, ids binary, known binary, sizes binary, terms binary, starts binary, docs binary, counts binary"
INDEX = "ids binary, known binary, terms binary, starts binary, docs binary, impacts binary, maxima binary, pairs binary, joint binary"
FOUND = "query int, doc_id long, score long"


def rank(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents (doc_id, text) of each item (item_id, text)."""
    spark = documents.sparkSession
    bound_batches(spark)
    docs = pick(documents, "doc_id", "text")
    items = pick(items, "item_id", "text")
    wanted = materialize(_item_terms(items), "item-terms")
    total = wanted.count()
    parts = max(1, -(-total // PART_TERMS))
    out = []
    for part in range(parts):
        some = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).toArrow()
        out.append(_rank_part(docs, some, _kind(items), k))
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    return found


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) with the term's hash."""

    def terms(batches):
        import numpy as np
        import pyarrow as pa

        hasher = term_hasher()
        for batch in slices(batches, "text", SLICE_BYTES):
            hashes, first, *_ = hasher.words(batch.column("text"), lower=True)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            order = np.lexsort((hashes, row))
            row, hashes = row[order], hashes[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
            items = batch.column("item_id").take(pa.array(row[fresh]))
            yield pa.RecordBatch.from_arrays([items, pa.array(hashes[fresh].view("i8"))], ["item_id", "term"])

    return items.mapInArrow(terms, f"item_id {_kind(items)}, term long").distinct()


def _kind(items: DataFrame) -> str:
    return items.schema["item_id"].dataType.simpleString()


def term_hasher() -> Hasher:
    """Splits at every ASCII sign but letters and digits (A-Z are lower-cased before)."""
    import numpy as np

    hasher = Hasher()
    apart = np.zeros(256, bool)
    apart[:128] = True
    for low, high in (b"09", b"az"):
        apart[low : high + 1] = False
    hasher.space = apart
    return hasher


class Queries:
    """A part of the items as arrays: hashes of their terms (sorted, `terms`) and the places of each
    query's terms, by rising weight once weights are known; the pairs of neighbours in any query."""

    def __init__(self, some):
        import numpy as np

        hashes = some.column("term").to_numpy().view("u8")
        self.terms, at = np.unique(hashes, return_inverse=True)
        items = some.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
        codes, self.names = items.indices.to_numpy(), items.dictionary.to_pylist()
        order = np.argsort(codes, kind="stable")
        cuts = np.searchsorted(codes[order], np.arange(1, len(self.names)))
        self.lists = [at[x] for x in np.split(order, cuts)] if self.names else []

    def weigh(self, weights):
        import numpy as np

        self.weights = weights
        self.lists = [q[np.lexsort((q, weights[q]))] for q in self.lists]
        pairs = [np.column_stack([q[:-1], q[1:]]) for q in self.lists if len(q) > 1]
        pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        self.pairs = pairs
        key = pairs[:, 0] * len(self.terms) + pairs[:, 1]
        # Place of the pair of each term with its successor; none for the last.
        self.after = [np.searchsorted(key, q[:-1] * len(self.terms) + q[1:]) for q in self.lists]


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _rank_part(docs: DataFrame, some, kind: str, k: int) -> DataFrame:
    import numpy as np

    spark = docs.sparkSession
    queries = Queries(some)
    blocks = materialize(_blocks(docs, queries.terms), "lexical-blocks")
    stats = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l"), F.count(F.lit(1)).alias("b")).first()
    n_docs, n_terms = stats.n or 0, stats.l or 0
    holding = np.zeros(len(queries.terms), np.int64)
    with byte_batches(spark):
        # One row per term of this part.
        for row in _holding(blocks, len(queries.terms)).toLocalIterator():
            holding[row.term] = row.df
        queries.weigh(np.array([weight(n_docs, int(df)) for df in holding], np.int64))
        sent = spark.sparkContext.broadcast(queries)
        index = materialize(_impact_lists(blocks, sent, n_docs, n_terms), "lexical-index")
        step = max(1, -(-stats.b // FLOOR_BLOCKS))
        some = index.where(F.pmod(F.hash("terms", "ids"), F.lit(step)) == 0)
        floors = np.ones(len(queries.lists), np.int64)
        best = _best(some.mapInArrow(_floor_task(sent, k), FOUND), k)
        for row in best.where(F.col("rank") == k).select("query", "score").toLocalIterator():
            floors[row.query] = max(1, row.score)
        limits = spark.sparkContext.broadcast(floors)
        found = materialize(index.mapInArrow(_search_task(sent, limits, k), FOUND), "lexical-found")
    names = spark.createDataFrame(list(enumerate(queries.names)), f"query int, item_id {kind}")
    return _best(found, k).join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


# --- index -----------------------------------------------------------------------------------


def _blocks(docs: DataFrame, wanted) -> DataFrame:
    """BLOCK rows: documents of some BLOCK_BYTES of text, and the lists of the wanted terms in them."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def build(batches):
        import numpy as np
        import pyarrow as pa

        hasher, wanted = term_hasher(), sent.value
        held, size, count = [], 0, 0

        def block():
            ids, known, sizes, keys, counts = (np.concatenate([h[i] for h in held]) for i in range(5))
            keys, counts = keys[order := np.argsort(keys, kind="stable")], counts[order]
            term, doc = keys >> 32, keys & 0xFFFFFFFF
            terms, starts = np.unique(term, return_index=True)
            values = [int((sizes > 0).sum()), int(sizes.sum())]
            arrays = [ids, known, sizes, terms.astype("<i4"), starts.astype("<i8"), doc.astype("<u4"), counts.astype("<u4")]
            columns = [pa.array([v], pa.int64()) for v in values] + [pa.array([a.tobytes()], pa.binary()) for a in arrays]
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in BLOCK.split(", ")])

        for batch in slices(batches, "text", SLICE_BYTES):
            hashes, first, _, _, data = hasher.words(batch.column("text"), lower=True)
            ids = batch.column("doc_id").cast(pa.int64())
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(wanted, hashes)
            at[at == len(wanted)] = 0
            hit = wanted[at] == hashes if len(wanted) else np.zeros(len(hashes), bool)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first)) + count
            keys, counts = np.unique((at[hit].astype(np.int64) << 32) | doc[hit], return_counts=True)
            held.append((ids.astype("<i8"), known.astype(np.uint8), np.diff(first).astype("<i8"), keys, counts))
            size, count = size + len(data), count + batch.num_rows
            if size >= BLOCK_BYTES or count >= BLOCK_DOCS:
                yield block()
                held, size, count = [], 0, 0
        if held:
            yield block()

    return docs.mapInArrow(build, BLOCK)


def _holding(blocks: DataFrame, n: int) -> DataFrame:
    """(term, df): documents that hold each wanted term; every task adds up its blocks first."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        df = np.zeros(n, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                terms, starts = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("terms", "<i4"), ("starts", "<i8")))
                length = len(batch.column("docs")[i].as_buffer()) // 4
                df[terms] += np.diff(np.append(starts, length))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some])], ["term", "df"])

    counted = blocks.select("terms", "starts", "docs").mapInArrow(count, "term long, df long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"))


def _factors(np, sizes, n_docs: int, n_terms: int):
    """Length factors: 10 + (90 * n * N) div L, in whole numbers of any size."""
    own, at = np.unique(sizes, return_inverse=True)
    return np.array([10 + (90 * int(n) * n_docs) // max(1, n_terms) for n in own], np.int64)[at] if len(own) else own


def _impacts(counts, factors):
    return (1_000_000_000 * counts) // (1000 * counts + 8 * factors)


def _impact_lists(blocks: DataFrame, sent, n_docs: int, n_terms: int) -> DataFrame:
    """INDEX rows: lists with impacts and their maxima, and the joint maxima of the pairs."""

    def weigh(batches):
        import numpy as np
        import pyarrow as pa

        queries = sent.value
        names = [x.split()[0] for x in INDEX.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                terms = np.frombuffer(row["terms"], "<i4")
                starts, sizes = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["sizes"], "<i8")
                docs = np.frombuffer(row["docs"], "<u4")
                counts = np.frombuffer(row["counts"], "<u4").astype("i8")
                ends = np.append(starts, len(docs))[1:]
                own = np.repeat(queries.weights[terms], ends - starts)
                impacts = own * _impacts(counts, _factors(np, sizes, n_docs, n_terms)[docs])
                maxima = np.maximum.reduceat(impacts, starts) if len(starts) else np.zeros(0, "i8")
                pairs, joint = _pair_maxima(np, queries.pairs, terms, starts, ends, docs, impacts, len(sizes))
                arrays = [impacts.astype("<i8"), maxima.astype("<i8"), pairs.astype("<i4"), joint.astype("<i8")]
                kept = [row[n] for n in ("ids", "known", "terms", "starts", "docs")] + [a.tobytes() for a in arrays]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in kept], names)

    return blocks.mapInArrow(weigh, INDEX)


def _pair_maxima(np, pairs, terms, starts, ends, docs, impacts, n_docs):
    """(places of the pairs that have both terms in the block, joint maxima of their intersections)."""
    if not len(terms) or not len(pairs):
        return np.zeros(0, "i4"), np.zeros(0, "i8")
    at = np.searchsorted(terms, pairs)
    at[at == len(terms)] = 0
    here = np.flatnonzero((terms[at] == pairs).all(axis=1))
    joint = np.zeros(len(here), np.int64)
    # Neighbours with one first term follow each other: its impacts are laid out by document once.
    laid, spread = -1, np.zeros(n_docs, np.int64)
    for place, pair in enumerate(here):
        a, b = at[pair]
        if a != laid:
            if laid >= 0:
                spread[docs[starts[laid] : ends[laid]]] = 0
            laid = a
            spread[docs[starts[a] : ends[a]]] = impacts[starts[a] : ends[a]]
        other = spread[docs[starts[b] : ends[b]]]
        both = other > 0
        if both.any():
            joint[place] = (other[both] + impacts[starts[b] : ends[b]][both]).max()
    return here, joint


# --- search ----------------------------------------------------------------------------------


class Block:
    """An index block in a task."""

    def __init__(self, np, queries, row):
        kinds = {"ids": "<i8", "known": "u1", "terms": "<i4", "starts": "<i8", "docs": "<u4", "impacts": "<i8",
                 "maxima": "<i8", "pairs": "<i4", "joint": "<i8"}
        for name, kind in kinds.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        self.ends = np.append(self.starts, len(self.docs))[1:]
        self.place = np.full(len(queries.terms), -1, np.int64)
        self.place[self.terms] = np.arange(len(self.terms))
        self.pair_max = np.full(len(queries.pairs), -1, np.int64)
        self.pair_max[self.pairs] = self.joint

    def list(self, t):
        a, b = self.starts[t], self.ends[t]
        return self.docs[a:b], self.impacts[a:b]

    def add(self, np, t, docs, scores):
        """Scores of the (sorted) documents with list t added."""
        own, impacts = self.list(t)
        at = np.searchsorted(own, docs)
        at[at == len(own)] = 0
        hit = own[at] == docs
        scores[hit] += impacts[at[hit]]


def prefix_bounds(maxima, pair_maxima) -> list:
    """bounds[i]: what the first i terms can add to one document. `pair_maxima[i]` is the joint maximum
    of terms i and i + 1 (0 where they never meet), or negative where it is not known."""
    bounds = [0]
    for i, top in enumerate(maxima):
        best = bounds[i] + top
        if i and pair_maxima[i - 1] >= 0:
            best = min(best, bounds[i - 1] + max(top, maxima[i - 1], pair_maxima[i - 1]))
        bounds.append(best)
    return bounds


def _present(np, block, query, after):
    """(places of the query's lists in the block, their maxima, joint maxima of neighbours)."""
    place = block.place[query]
    here = np.flatnonzero(place >= 0)
    lists = place[here]
    joint = np.full(max(0, len(here) - 1), -1, np.int64)
    if len(here) > 1:
        near = np.flatnonzero(np.diff(here) == 1)
        joint[near] = block.pair_max[after[here[near]]]
    return lists, block.maxima[lists].tolist(), joint.tolist()


def _search(np, block, query, after, floor: int, scratch):
    """(documents, scores) of the block with a score of at least `floor` (1 or more)."""
    lists, maxima, joint = _present(np, block, query, after)
    bounds = prefix_bounds(maxima, joint)
    if bounds[-1] < floor:
        return None
    first = next(i for i in range(len(lists)) if bounds[i + 1] >= floor)
    touched = []
    for t in lists[first:]:
        docs, impacts = block.list(t)
        scratch[docs] += impacts
        touched.append(docs)
    docs = np.flatnonzero(scratch).astype("u4") if len(touched) > 1 else touched[0]
    scores = scratch[docs]
    scratch[docs] = 0
    for i in range(first, -1, -1):
        live = scores + bounds[i] >= floor
        if not live.all():
            docs, scores = docs[live], scores[live]
        if not len(docs):
            return None
        if i:
            block.add(np, lists[i - 1], docs, scores)
    return docs, scores


def _top(np, ids, scores, k):
    """The k best, equal scores by id."""
    if len(ids) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _rows(np, best):
    import pyarrow as pa

    query = np.concatenate([np.full(len(i), q, np.int32) for q, (i, _) in best.items()] or [np.zeros(0, np.int32)])
    columns = [np.concatenate([b[j] for b in best.values()] or [np.zeros(0, np.int64)]) for j in range(2)]
    return pa.RecordBatch.from_arrays([pa.array(query), *map(pa.array, columns)], ["query", "doc_id", "score"])


def _each_block(np, queries, batches):
    for batch in batches:
        for i in range(batch.num_rows):
            block = Block(np, queries, {n: batch.column(n)[i].as_py() for n in batch.schema.names})
            yield block, block.known.astype(bool)


def _floor_task(sent, k):
    """Tops of each task among documents with high impacts: a few documents a query and block, from the
    lists of its heaviest terms, scored in full."""

    def look(batches):
        import numpy as np

        queries, best = sent.value, {}
        for block, known in _each_block(np, queries, batches):
            for q, query in enumerate(queries.lists):
                lists = block.place[query]
                lists = lists[lists >= 0]
                some = []
                for t in lists[-3:]:
                    docs, impacts = block.list(t)
                    if len(docs) > k:
                        docs = docs[np.argpartition(impacts, len(impacts) - k)[-k:]]
                    some.append(docs)
                if not some:
                    continue
                docs = np.unique(np.concatenate(some))
                docs = docs[known[docs]]
                scores = np.zeros(len(docs), np.int64)
                for t in lists:
                    block.add(np, t, docs, scores)
                _keep(np, best, q, block.ids[docs], scores, k)
        yield _rows(np, best)

    return look


def _keep(np, best, q, ids, scores, k):
    if q in best:
        ids, scores = (np.concatenate([old, new]) for old, new in zip(best[q], (ids, scores), strict=True))
    best[q] = _top(np, ids, scores, k)


def _search_task(sent, limits, k):
    def look(batches):
        import numpy as np

        queries, floors, best = sent.value, limits.value.copy(), {}
        for block, known in _each_block(np, queries, batches):
            scratch = np.zeros(len(block.ids), np.int64)
            for q, query in enumerate(queries.lists):
                found = _search(np, block, query, queries.after[q], int(floors[q]), scratch)
                if found is None:
                    continue
                docs, scores = found
                good = known[docs] & (scores > 0)
                _keep(np, best, q, block.ids[docs[good]], scores[good], k)
                if len(best[q][1]) == k:
                    floors[q] = max(floors[q], best[q][1][-1])
        yield _rows(np, best)

    return look
