"""Words of many texts as 64-bit hashes, computed on whole Arrow batches at once.

A word's hash is a polynomial over random codes of its bytes, modulo 2**64, mixed with its length;
words over LONG bytes are hashed by BLAKE2b, so crafted repeats cannot collide. Windows of words
hash the same way from word hashes. Two different words or windows share a hash with probability
about 2**-64 each pair.
"""

from __future__ import annotations

CHUNK = 1 << 16
LONG = 512


class Hasher:
    """Tables for hashing byte spans. Made once a task."""

    def __init__(self):
        import numpy as np

        rng = np.random.Generator(np.random.PCG64(20240229))
        self.codes = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        base = 0x9E3779B97F4A7C15 | 1
        self.power = self._powers(np, base, CHUNK + 1)
        self.inverse = self._powers(np, pow(base, -1, 2**64), CHUNK + 1)
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        self.space = space
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.lower = lower

    @staticmethod
    def _powers(np, base, n):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    def spans(self, data, starts, ends):
        """Hashes of data[starts[i]:ends[i]], spans in order and without overlap."""
        import hashlib

        import numpy as np

        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            low = int(starts[at])
            to = int(np.searchsorted(ends, low + CHUNK, "right"))
            if to == at:  # one span longer than a chunk: hashed below
                at += 1
                continue
            high = int(ends[to - 1])
            prefix = np.zeros(high - low + 1, np.uint64)
            np.cumsum(self.codes[data[low:high]] * self.power[: high - low], out=prefix[1:])
            a, b = starts[at:to] - low, ends[at:to] - low
            out[at:to] = (prefix[b] - prefix[a]) * self.inverse[a]
            at = to
        out = mix(np, out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        for i in np.flatnonzero(ends - starts > LONG):
            digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
            out[i] = np.frombuffer(digest, "<u8")[0]
        return out

    def words(self, texts, lower: bool = False, table=None):
        """(hashes of all words, first word of each text and the end, word starts, word ends, bytes)
        for an Arrow array of texts; null has no words. Words are what stands between ASCII white space,
        after `lower` (folds A-Z) or a byte table of the caller's own."""
        import numpy as np

        data, bounds = text_bytes(texts)
        if table is not None:
            data = np.frombuffer(table, np.uint8)[data]
        elif lower:
            data = self.lower[data]
        starts, ends = word_spans(np, self.space[data], bounds)
        first = np.searchsorted(starts, bounds, "left")
        return self.spans(data, starts, ends), first, starts, ends, data


def text_bytes(texts):
    """(bytes, bounds): the UTF-8 bytes of an Arrow string array one after the other, and where each
    text starts (and the last one ends)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = texts.buffers()
    bounds = np.frombuffer(places, "<i8")[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, "i8")
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches, column: str, size: int):
    """Arrow batches cut into runs of rows with about `size` bytes of text (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(lengths, dtype="i8") - lengths) // size
        edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else []
        for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def word_spans(np, space, bounds):
    """Starts and ends of runs of bytes that are not space; runs end at the bounds of texts."""
    inside = ~space
    if not len(inside):
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    fresh = inside.copy()
    fresh[1:] &= space[:-1]
    heads = bounds[:-1][bounds[:-1] < len(inside)]
    fresh[heads] |= inside[heads]
    last = inside.copy()
    last[:-1] &= space[1:]
    tails = bounds[1:][bounds[1:] > 0] - 1
    last[tails] |= inside[tails]
    return np.flatnonzero(fresh), np.flatnonzero(last) + 1


def mix(np, x):
    """Spreads 64-bit values over their range (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(np, hashes, size: int):
    """Hash of hashes[i:i + size] for every i that has that many left (all texts run together)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = np.uint64(0xC2B2AE3D27D4EB4F)
    for i in range(size):
        total *= factor
        total += hashes[i : i + n]
    return mix(np, total)


def shingle_sets(np, hashes, first, size: int) -> list:
    """Sorted distinct shingles of each text; a shorter text with words has one, all its words."""
    every = windows(np, hashes, size)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(every[a : b - size + 1]))
        elif b > a:
            whole = windows(np, hashes[a:b], int(b - a))
            out.append(mix(np, whole + np.uint64(int(b - a))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
