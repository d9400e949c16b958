"""Near-duplicate documents by one-permutation MinHash, confirmed on full shingle sets.

A document's set holds its distinct runs of SHINGLE words (A-Z lower-cased, words between ASCII
white space); a shorter text with words is one shingle. Two documents are linked when their sets'
Jaccard similarity is at least `percent` / 100. Components of links are the result; a document
without words is linked with nothing.

1. Equal sets collapse to a class, led by the smallest id: copies cost nothing further.
2. One hash per shingle fills BINS bins with their minima; an empty bin borrows from a bin chosen by
   hashes of its own number until one is full (optimal densification). Bands of `rows` bins are the
   keys of buckets.
3. Star edges: each member of a bucket is compared with the bucket's smallest member only, so edges
   stay linear in bucket entries. Candidates are confirmed on full sets, links contracted to
   components.
4. The rest, exactly: members of one bucket that are still in different components may be linked
   without either being the star's centre. Such documents are matched by prefixes: in how many of them
   a shingle stands is counted exactly (see `packed`), and of the n shingles of a set the
   n - ceil(percent * n / 100) + 1 rarest are its prefix. Linked sets share a shingle of both prefixes,
   so only documents that share one (and a bucket) meet there, those of different components alone; and
   a pair is compared only if 100 * m >= percent * (n1 + n2 - m) for the least m of what bounds the
   overlap: the shingles of either that any other of these documents holds, and those of either less the
   bits of its sketch (2**SKETCH_BITS bits, set by hash) that the other's sketch lacks. Text that many
   documents share (a template) is frequent and in no prefix, and a copy with many edits of its own falls
   out without being compared with its family.

No pair that shares a bucket is lost and none is capped; that two documents at the threshold share
no bucket has a chance of about 4e-5 with 256 bins in bands of 8 (0.85), about 3e-6 in
bands of 6 (0.80), and less above it.

Rows without doc_id are linked with nothing (component null, kept). Rows of one id count as one
document. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.layers import materialize
from .common import blocks_for, bound_batches, pick
from .packed import SENT, edges, joined, sent, sent_table, to_table
from .wordhash import Hasher, mix, shingle_sets, slices

SHINGLE = 5
BINS = 256
ROWS = 8
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 2 << 20
BUCKET_HASHES = 1 << 20
BROADCAST_ROWS = 2_000_000  # of single ids: some 32 MB

SIGNED = "doc_id long, n long, digest binary, bands array<long>"
REPLY = "bucket long, block int, counts binary"
MOST = 255  # counts are kept up to this
SKETCH_BITS = 12  # a set's sketch has a bit for each value of so many bits of a shingle's hash


def densified(np, sets: list):
    """Matrix of bin minima, one row a set; empty bins borrow. Sets must not be empty."""
    heads = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
    table = np.zeros((len(sets), BINS), np.uint64)
    full = np.zeros((len(sets), BINS), bool)
    for i, values in enumerate(sets):
        at = np.searchsorted(values, heads)
        count = np.diff(np.append(at, len(values)))
        full[i] = count > 0
        table[i, full[i]] = values[at[full[i]]]
    row, bin_ = np.nonzero(~full)
    attempt = 0
    while len(row):
        attempt += 1
        asked = mix(np, bin_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        lender = (asked % np.uint64(BINS)).astype(np.int64)
        lent = full[row, lender]
        table[row[lent], bin_[lent]] = table[row[lent], lender[lent]]
        row, bin_ = row[~lent], bin_[~lent]
    return table


def band_keys(np, table, size: int = ROWS):
    """Matrix of bucket keys: each band's `size` bins and its number, hashed."""
    bands = BINS // size
    keys = np.zeros((len(table), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    for i in range(size):
        keys = mix(np, keys * np.uint64(0xC2B2AE3D27D4EB4F) + table[:, i::size][:, :bands])
    return keys.view(np.int64)


def signatures(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """SIGNED for documents (doc_id, text): set size, digest of the set, bucket keys."""

    def sign(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        hasher = Hasher()
        for batch in slices(batches, "text", SLICE_BYTES):
            hashes, first, *_ = hasher.words(batch.column("text"), lower=True)
            sets = shingle_sets(np, hashes, first, SHINGLE)
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(np, densified(np, [sets[i] for i in some]), rows)
            bands: list = [[]] * len(sets)
            for i, own in zip(some, keys.tolist(), strict=True):
                bands[i] = own
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n", "digest", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(sign, SIGNED)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; texts are (rep, text)."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        hasher = Hasher()
        for batch in slices(batches, "text_a", SLICE_BYTES):
            sides = []
            for name in ("text_a", "text_b"):
                hashes, first, *_ = hasher.words(batch.column(name), lower=True)
                sides.append(shingle_sets(np, hashes, first, SHINGLE))
            good = []
            for one, other in zip(*sides, strict=True):
                merged = np.concatenate([one, other])
                merged.sort()
                same = int((merged[1:] == merged[:-1]).sum())
                good.append(100 * same >= percent * (len(merged) - same))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, comp): the smallest node that each node of the links (a, b) reaches. Every round
    points each node to its smallest neighbour, follows that pointer once more, and contracts the
    links; their number at least halves along any path."""
    a, b = F.col("a"), F.col("b")
    rest = materialize(
        links.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), name
    )
    labels = None
    while True:
        both = rest.select("a", "b").union(rest.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select(a.alias("node"), F.least("a", "m").alias("p"))
        near = materialize(near, f"{name}-near")
        jump = near.select(F.col("node").alias("p"), F.col("p").alias("q"))
        near = materialize(near.join(jump, "p").select("node", F.col("q").alias("p")), f"{name}-parents")
        if labels is None:
            labels = near.select("node", F.col("p").alias("comp"))
        else:
            step = near.select(F.col("node").alias("comp"), "p")
            labels = labels.join(step, "comp", "left").select("node", F.coalesce("p", "comp").alias("comp"))
            labels = materialize(labels, f"{name}-labels")
        rest = (
            rest.join(near.select(F.col("node").alias("a"), F.col("p").alias("pa")), "a")
            .join(near.select(F.col("node").alias("b"), F.col("p").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        rest = materialize(rest, name)
        if rest.isEmpty():
            return labels


def prefixes(texts: DataFrame, percent: int) -> DataFrame:
    """(rep, shared, prefix, sketch): how many shingles of each text (rep, text) any other of these texts
    holds, those of its rarest ones, its prefix, that do, and the sketch of its set."""
    n_blocks, total = blocks_for(texts, "text", BLOCK_BYTES)
    n_buckets = max(1, total // 6 // BUCKET_HASHES)
    dealt = texts.select(F.pmod(F.xxhash64("rep"), F.lit(n_blocks)).cast("int").alias("block"), "rep", "text")

    def sets_of(np, table):
        hashes, first, *_ = Hasher().words(table.column("text"), lower=True)
        return shingle_sets(np, hashes, first, SHINGLE)

    def send(key, table):
        import numpy as np

        sets = sets_of(np, table)
        unique, count = np.unique(np.concatenate(sets), return_counts=True)
        return sent_table(sent(np, key[0].as_py(), unique, n_buckets, np.minimum(count, MOST).astype(np.uint8)))

    def find(key, table):
        import numpy as np
        import pyarrow as pa

        hashes, lengths = joined(np, table.column("hashes").to_pylist(), "<u8")
        inside, _ = joined(np, table.column("more").to_pylist(), np.uint8)
        _, where = np.unique(hashes, return_inverse=True)
        seen = np.minimum(np.bincount(where, weights=inside), MOST).astype(np.uint8)[where]
        ends = np.cumsum(lengths)
        parts = [seen[a:b].tobytes() for a, b in zip(ends - lengths, ends, strict=True)]
        rows = list(zip(table.column("bucket").to_pylist(), table.column("block").to_pylist(), parts, strict=True))
        return to_table(rows, ["bucket", "block", "counts"], [pa.int64(), pa.int32(), pa.binary()])

    def choose(key, table, replies):
        import numpy as np
        import pyarrow as pa

        sets = sets_of(np, table)
        unique = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        at = edges(np, unique, n_buckets)
        count = np.zeros(len(unique), np.uint8)
        for bucket, raw in zip(replies.column("bucket").to_pylist(), replies.column("counts").to_pylist(), strict=True):
            count[at[bucket] : at[bucket + 1]] = np.frombuffer(raw, np.uint8)
        shared, rare, sketches = [], [], []
        for own in sets:
            spots = np.zeros(1 << SKETCH_BITS, np.uint8)
            spots[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] = 1
            sketches.append(np.packbits(spots, bitorder="little").view("<i8"))
            held = count[np.searchsorted(unique, own)]
            first = np.lexsort((own, held))[: len(own) - -(-percent * len(own) // 100) + 1]
            shared.append(int((held > 1).sum()))
            rare.append(own[first][held[first] > 1].view(np.int64))
        return pa.table({"rep": table.column("rep"), "shared": pa.array(shared, pa.int64()), "prefix": pa.array(rare, pa.list_(pa.int64())),
                         "sketch": pa.array(sketches, pa.list_(pa.int64()))})

    answers = dealt.groupBy("block").applyInArrow(send, SENT).groupBy("bucket").applyInArrow(find, REPLY)
    chosen = dealt.groupBy("block").cogroup(answers.groupBy("block"))
    return chosen.applyInArrow(choose, "rep long, shared long, prefix array<long>, sketch array<long>")


def _can_link(m: Column, n1: Column, n2: Column, percent: int) -> Column:
    """Whether sets of these sizes can be linked if they share m at most."""
    return m * 100 >= (n1 + n2 - m) * percent


def _residual_pairs(entries: DataFrame, labels: DataFrame, texts: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents from buckets that hold several components, which are in different components,
    share a shingle of both prefixes, and may still be linked."""
    named = entries.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "comp", F.coalesce("comp", "rep")
    )
    mixed = named.groupBy("key").agg(F.min("comp").alias("main"), F.max("comp").alias("other")).where("main < other")
    own = named.join(mixed.select("key"), "key").groupBy("rep").agg(
        F.first("n").alias("n"), F.first("comp").alias("comp"), F.collect_set("key").alias("keys")
    )
    reps = materialize(own, "open-documents")
    counts = materialize(prefixes(texts.join(reps.select("rep"), "rep", "left_semi"), percent), "prefixes")
    # A partner holds at least percent / 100 of the shingles.
    alive = reps.join(counts, "rep").where(F.col("shared") * 100 >= F.col("n") * percent)
    met = materialize(alive.select("*", F.explode("prefix").alias("shingle")), "prefix-entries")
    # Of a shingle's documents those of its commonest component do not meet each other.
    commonest = (
        met.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("c"))
        .groupBy("shingle").agg(F.max_by("comp", F.struct("c", -F.col("comp"))).alias("main"), F.count(F.lit(1)).alias("comps"))
        .where("comps > 1")
    )
    met = materialize(met.join(commonest.select("shingle", "main"), "shingle"), "mixed-prefixes")
    columns = ("rep", "n", "comp", "shared", "keys", "prefix", "sketch")
    x = met.where("comp <> main").select("shingle", *[F.col(c).alias(f"{c}_x") for c in columns])
    y = met.select("shingle", "main", *[F.col(c).alias(f"{c}_y") for c in columns])
    bound = _can_link(F.least("shared_x", "shared_y"), F.col("n_x"), F.col("n_y"), percent)
    # Each bit of a sketch that the other's lacks stands for a shingle that the other does not hold.
    lacks = "aggregate(zip_with(sketch_{0}, sketch_{1}, (a, b) -> bit_count(a & ~b)), 0, (s, c) -> s + c)"
    most = F.least(*[F.col(f"n_{a}") - F.expr(lacks.format(a, b)) for a, b in ("xy", "yx")])
    # A pair meets at every shingle that both prefixes have; only the smallest one makes a row.
    apart = F.expr("comp_x <> comp_y AND (comp_y = main OR rep_x < rep_y)")
    once = F.expr("arrays_overlap(keys_x, keys_y)") & (x["shingle"] == F.expr("array_min(array_intersect(prefix_x, prefix_y))"))
    near = _can_link(most, F.col("n_x"), F.col("n_y"), percent)
    pairs = x.join(y, (x["shingle"] == y["shingle"]) & apart & bound & near & once)
    pairs = pairs.select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()
    return pairs.join(done, ["a", "b"], "left_anti")


def near_duplicates(docs: DataFrame, percent: int = 85, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for documents (doc_id, text). Bands of fewer `rows`
    find pairs of a lower `percent`."""
    bound_batches(docs.sparkSession)
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = materialize(signatures(plain, rows), "signatures")
    some = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = materialize(
        some.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    entries = classes.select("rep", "n", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(
        F.min("rep").alias("centre"), F.count(F.lit(1)).alias("size"), F.min(F.struct("rep", "n"))["n"].alias("centre_n")
    )
    met = materialize(entries.join(buckets.where("size > 1"), "key"), "bucket-entries")
    reps = materialize(met.select("rep").distinct(), "bucketed")
    if reps.count() <= BROADCAST_ROWS:
        reps = F.broadcast(reps)
    texts = materialize(
        plain.withColumnRenamed("doc_id", "rep").join(reps, "rep", "left_semi"), "bucketed-texts"
    )
    fits = _can_link(F.least("n", "centre_n"), F.col("n"), F.col("centre_n"), percent)
    stars = materialize(
        met.where(F.col("rep") != F.col("centre")).where(fits).select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct(),
        "stars",
    )
    links = materialize(confirm(stars, texts, percent), "links")
    labels = components(links, "star-links")
    rest = materialize(_residual_pairs(met.select("rep", "n", "key"), labels, texts, stars, percent), "rest-pairs")
    more = confirm(rest, texts, percent)
    at_a = labels.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    at_b = labels.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    between = more.join(at_a, "a", "left").join(at_b, "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")
    )
    joined_up = components(between, "rest-links")
    node = F.coalesce("comp", "rep")
    final = (
        classes.select("digest", "rep")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("digest", node.alias("node"))
        .join(joined_up.withColumnRenamed("comp", "last"), "node", "left")
        .select("digest", F.coalesce("last", "node").alias("component"))
    )
    named = signed.select("doc_id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    out = named.join(final, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
