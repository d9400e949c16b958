"""Exact top-k by inner product: columnar branch and bound.

Vectors become integers, floor(scale * x), and are packed into blocks held dimension by dimension
(vertical layout). A task takes one block of queries and one block of candidates and adds up scores
one slice of dimensions at a time. After each slice, Cauchy-Schwarz over the mass that remains,
|q rest| * |c rest|, bounds what a candidate can still reach, and pairs of query and candidate that can
no longer reach the query's k-th best are compacted away before the next slice: first whole candidates
that no query wants, then, once few pairs are left, the pairs one by one. The k-th best is known early:
after the first slices the candidates of each query that lead so far are scored in full. Each task
returns at most k rows per query of its block; a window per query takes the best k of those.

Queries and candidates meet block by block through an equi-join on a block number (every candidate
block is sent once to each query block), so neither side is collected or broadcast, and no task
holds more than one block of each.

Vectors that are null, or hold null or non-finite components, take no part; neither do vectors of
another length than the query's, for that query. Scores are exact: sums below 2**53 are added in
doubles, larger ones as Python integers, and sums beyond a 64-bit integer are cut to its range.
Ties go to the smaller id. Rows with equal ids count as separate candidates, except that a query
never meets rows of its own id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
SLICE = 16
CELLS = 1 << 22  # scores held at once
LEAD_SLICES = 2  # after so many slices the leading candidates are scored in full
PAIRS = 1 << 18  # pairs whose components are gathered at once


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) as doubles, rows without a whole finite vector left out."""
    plain = pick(vectors, id_column, vector_column).toDF("vec_id", "v")
    scaled = F.transform("v", lambda x: x.cast("double") * scale)
    bad = F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = plain.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(~bad)
    # rint, not floor: Spark's floor gives a long, which large components would overflow.
    down = F.transform(
        scaled, lambda x: F.rint(x) - F.when(F.rint(x) > x, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    return whole.select(F.col("vec_id").cast("bigint"), down.alias("v"))


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """One row per block of at most about `size` vectors of one length: ids and components, packed
    dimension by dimension. Block numbers come from a hash of the id; their count follows the rows."""
    counted = rows.select("vec_id", "v", F.size("v").alias("dims"))
    total = counted.count()
    n = max(1, -(-total // size))
    grouped = counted.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))

    def pack(key, frame):
        import numpy as np
        import pandas as pd

        dims = int(key[1])
        table = np.stack(frame["v"].to_numpy()).astype("f8") if dims else np.zeros((len(frame), 0))
        order = np.lexsort((frame["vec_id"].to_numpy(),))
        ids = frame["vec_id"].to_numpy(dtype="i8")[order]
        return pd.DataFrame(
            {
                "block": [key[0]],
                "dims": [dims],
                "ids": [ids.tobytes()],
                "columns": [np.ascontiguousarray(table[order].T).tobytes()],
            }
        )

    packed = grouped.groupBy("block", "dims").applyInPandas(
        pack, "block int, dims int, ids binary, columns binary"
    )
    return packed.toDF(f"{name}_block", "dims", f"{name}_ids", f"{name}_columns"), n


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for frames of (vec_id, v) as `integer_vectors` makes them."""
    q, query_blocks = _blocks(queries, QUERY_BLOCK, "q")
    c, _ = _blocks(vectors, CANDIDATE_BLOCK, "c")
    sent = c.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    pairs = sent.join(q, ["q_block", "dims"]).select("dims", "q_ids", "q_columns", "c_ids", "c_columns")

    def search(frames):
        import pandas as pd

        for frame in frames:
            for row in frame.itertuples(index=False):
                found = _search_block(row.dims, row.q_ids, row.q_columns, row.c_ids, row.c_columns, k)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    best = pairs.mapInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search_block(dims, q_ids, q_columns, c_ids, c_columns, k):
    """Best k candidates of a block for each query of a block: list of (query, candidate, score)."""
    import numpy as np

    q_ids, c_ids = np.frombuffer(q_ids, "i8"), np.frombuffer(c_ids, "i8")
    q = np.frombuffer(q_columns, "f8").reshape(dims, len(q_ids))
    c = np.frombuffer(c_columns, "f8").reshape(dims, len(c_ids))
    out = []
    step = max(1, CELLS // max(1, len(c_ids)))
    for at in range(0, len(q_ids), step):
        out += _bounded(np, q_ids[at : at + step], q[:, at : at + step], c_ids, c, k)
    return out


def _bounded(np, q_ids, q, c_ids, c, k):
    dims = len(c)
    exact = dims == 0 or float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * dims < 2.0**53
    if not exact:
        return _with_integers(q_ids, q, c_ids, c, k)
    # Dimensions in which the queries carry most mass come first.
    order = np.argsort(-np.square(q).sum(axis=1), kind="stable")
    q, c = q[order], c[order]
    q_rest = np.sqrt(np.cumsum(np.square(q[::-1]), axis=0)[::-1])
    c_rest = np.sqrt(np.cumsum(np.square(c[::-1]), axis=0)[::-1])
    alive = np.arange(len(c_ids))
    own = q_ids[:, None] == c_ids[None, :]
    scores = np.where(own, -np.inf, 0.0)
    floor = np.full(len(q_ids), -np.inf)
    for start in range(0, dims, SLICE):
        end = min(start + SLICE, dims)
        scores += q[start:end].T @ c[start:end][:, alive]
        if end == dims:
            break
        if floor[0] == -np.inf and end >= min(LEAD_SLICES * SLICE, dims - 1):
            floor = _floor(np, q, c, alive, scores, end, k)
        keep = _reach(np, scores, q_rest[end][:, None], c_rest[end][alive][None, :]) >= floor[:, None]
        if 2 * keep.sum() < keep.size:
            at, column = np.nonzero(keep)
            return _by_pairs(np, q_ids, q, c_ids, c, at, alive[column], scores[at, column], end, floor, q_rest, c_rest, k)
        wanted = keep.any(axis=0)
        if not wanted.all():
            alive, scores = alive[wanted], scores[:, wanted]
    at, column = np.nonzero(np.isfinite(scores))
    return _best(np, q_ids, c_ids, at, alive[column], scores[at, column], k)


def _reach(np, scores, q_rest, c_rest):
    """What a score can still become, rounding allowed for."""
    return scores + q_rest * c_rest * (1 + 1e-9) + 1e-6


def _floor(np, q, c, alive, scores, end, k):
    """A score that each query's k-th best of this block reaches at least: that of the k-th best among the
    candidates that lead after the first `end` dimensions (-inf where there are fewer than k)."""
    n = scores.shape[1]
    if n < k:
        return np.full(len(scores), -np.inf)
    some = min(n, 4 * k)
    lead = np.argpartition(scores, n - some, axis=1)[:, n - some :]
    rest = np.einsum("iq,iqj->qj", q[end:], c[end:][:, alive[lead]])
    whole = np.take_along_axis(scores, lead, axis=1) + rest
    return np.partition(whole, some - k, axis=1)[:, some - k]


def _by_pairs(np, q_ids, q, c_ids, c, at, column, scores, end, floor, q_rest, c_rest, k):
    """The remaining dimensions for the pairs (query place, candidate place) that are left."""
    dims = len(c)
    while end < dims:
        step = min(end + SLICE, dims)
        for a in range(0, len(at), PAIRS):
            some = slice(a, a + PAIRS)
            scores[some] += np.einsum("ip,ip->p", q[end:step][:, at[some]], c[end:step][:, column[some]])
        end = step
        if end < dims:
            keep = _reach(np, scores, q_rest[end][at], c_rest[end][column]) >= floor[at]
            at, column, scores = at[keep], column[keep], scores[keep]
    return _best(np, q_ids, c_ids, at, column, scores, k)


def _best(np, q_ids, c_ids, at, column, scores, k):
    """The best k of each query among scored pairs, ties to the smaller id."""
    good = np.isfinite(scores)
    at, column, scores = at[good], column[good], scores[good]
    order = np.lexsort((c_ids[column], -scores, at))
    at, column, scores = at[order], column[order], scores[order]
    first = np.searchsorted(at, at)
    top = np.arange(len(at)) - first < k
    return list(zip(q_ids[at[top]].tolist(), c_ids[column[top]].tolist(), scores[top].astype("i8").tolist(), strict=True))


def _with_integers(q_ids, q, c_ids, c, k):
    """Components too large for doubles to add exactly: Python integers, query by query."""
    import heapq

    low, high = -(2**63), 2**63 - 1
    columns = [[int(x) for x in col] for col in c.T]
    found = []
    for i, query in enumerate(q_ids):
        own = [int(x) for x in q[:, i]]
        scored = (
            (min(high, max(low, sum(a * b for a, b in zip(own, col, strict=True)))), -int(cid))
            for cid, col in zip(c_ids, columns, strict=True)
            if cid != query
        )
        for score, minus in heapq.nlargest(k, scored):
            found.append((int(query), -minus, score))
    return found
