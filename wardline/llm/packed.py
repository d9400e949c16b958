"""Exchanging hashes in bulk: which hashes of a block of documents also occur elsewhere.

Documents are dealt into blocks. A block sends its distinct hashes, sorted and packed, one row for
each range of hash values (bucket); a bucket sees the hashes of all blocks in its range and answers
each row. So a shuffle carries eight bytes a hash instead of a row a hash, a hash that very many
documents hold arrives once a block at most, and both sides work on arrays. Block and bucket counts
follow the data, so neither grows without bound.
"""

from __future__ import annotations

SENT = "bucket long, block int, hashes binary, more binary, base long"


def edges(np, hashes, buckets: int):
    """Where each bucket's range starts in sorted hashes, and the end."""
    cuts = [min((k << 64) // buckets, 2**64 - 1) for k in range(1, buckets)]
    inner = np.searchsorted(hashes, np.array(cuts, dtype=np.uint64), "left")
    return np.concatenate([[0], inner, [len(hashes)]])


def sent(np, block: int, hashes, buckets: int, more=None, base: int = 0) -> list:
    """Rows of SENT for a block's sorted distinct hashes. `more` is an array with an entry each."""
    at = edges(np, hashes, buckets)
    rows = []
    for k in np.flatnonzero(at[1:] > at[:-1]).tolist():
        a, b = at[k], at[k + 1]
        rows.append((k, block, hashes[a:b].tobytes(), None if more is None else more[a:b].tobytes(), base))
    return rows


def to_table(rows: list, names: list, kinds: list):
    """Arrow table of row tuples; kinds are pyarrow types."""
    import pyarrow as pa

    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def sent_table(rows: list):
    import pyarrow as pa

    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
    return to_table(rows, ["bucket", "block", "hashes", "more", "base"], kinds)


def joined(np, arrays: list, kind):
    """Packed columns of several rows as one array, and the length of each."""
    parts = [np.frombuffer(x, kind) for x in arrays]
    return np.concatenate(parts) if parts else np.zeros(0, kind), [len(p) for p in parts]
