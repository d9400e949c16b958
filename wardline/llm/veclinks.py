"""Near-duplicate vectors by cosine: PCA-ordered, tiled comparison.

Two vectors are linked when the cosine of the angle between them is `threshold` or more. The result
has a row per vector with its number of links and the component of links it belongs to.

1. Equal vectors collapse to a class with a count: copies cost nothing further.
2. A PCA of at most SAMPLE_BYTES of vectors (the lowest by hash) gives the leading directions, those
   with most mass first. It decides only how much work there is, never a result.
3. Classes are ordered along a curve through their leading coordinates, by range, and packed into
   blocks of at most BLOCK rows. Each block has a box around its leading coordinates and the largest
   norm of what lies beyond them (suffix norm). Blocks are grouped FAN at a time into larger boxes,
   level by level, until few are left.
4. From the top down, only pairs of boxes go on in which some pair of vectors could still reach the
   threshold. The pairs of blocks left at the bottom are compared tile by tile (TILE rows a side):
   a tile pair whose boxes cannot reach the threshold is skipped, one whose boxes cannot miss it is
   linked whole, and otherwise products are added up over slices of leading directions; before each
   next slice a pair is given up when the sum and the product of its suffix norms stay below the
   threshold. What survives is decided on whole vectors in doubles.
5. A pair of blocks returns how many links each class has and a spanning forest of its links, so
   output grows with rows, not with links, also inside a large group of near copies.

Vectors that are null, empty, zero, or hold null or non-finite components are linked with nothing;
so are vectors of different lengths with each other. Rows are vectors: rows of one id are counted
each for itself. A vector without id is linked like any other; its id counts for no component, and
where a component has no other id, component_id is null and kept true.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.layers import materialize
from .common import byte_batches, lookup, pick
from .neardup import components

SAMPLE_BYTES = 16 << 20
LEAD = 32  # leading directions
BOX = 16  # of them in a block's box
SLICE = 8
BLOCK, BLOCK_BYTES = 4096, 4 << 20
TILE = 512
FAN, TOP = 16, 64
CURVE, CURVE_BITS = 8, 7  # directions and bits of the curve
EDGE = 1e-9  # bounds are loosened by this, far above rounding


def near_duplicates(vectors: DataFrame, id_column: str, vector_column: str, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of `vectors`."""
    spark = vectors.sparkSession
    rows, classes = _classes(pick(vectors, id_column, vector_column).toDF("vec_id", "v"))
    directions = _directions(classes)
    blocks = _blocks(classes, directions)
    pairs = materialize(_block_pairs(blocks.drop("nodes", "weights", "packed"), threshold), "block-pairs")
    with byte_batches(spark):
        found = materialize(_compare(pairs, blocks, directions, threshold), "vector-links")
    links = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), "vector-forest")
    nodes = _nodes(blocks).join(classes.drop("v", "dims"), ["d1", "d2"])
    merged = (
        nodes.join(links, "node", "left")
        .join(joined, "node", "left")
        .select("d1", "d2", "least_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("comp", "node").alias("comp"))
    )
    merged = materialize(merged, "vector-components")
    least = merged.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = materialize(lookup(merged.drop("least_id"), least, ["comp"]).drop("comp"), "vector-named")
    linked = lookup(rows.where("d1 IS NOT NULL"), named, ["d1", "d2"])
    alone = rows.where("d1 IS NULL").select("vec_id", F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", "n_links", "component_id").union(alone)
    kept = F.col("component_id").isNull() | F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return out.select("vec_id", F.col("n_links").cast("bigint"), "component_id", kept.alias("kept"))


def _nodes(blocks: DataFrame) -> DataFrame:
    """(d1, d2, node): the classes' numbers."""

    def unpack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for raw in batch.column("nodes").to_pylist():
                table = np.frombuffer(raw, "<i8").reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([pa.array(table[:, i].copy()) for i in range(3)], ["d1", "d2", "node"])

    return blocks.select("nodes").mapInArrow(unpack, "d1 long, d2 long, node long")


def _classes(plain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, d1, d2) with a digest of each usable vector, else null; classes (d1, d2, dims,
    n, least_id, v) of equal vectors. Zeros lose their sign."""
    v = F.transform("v", lambda x: x.cast("double") + F.lit(0.0))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("v").isNotNull() & ~bad & F.exists(v, lambda x: x != 0)
    kept = plain.select("vec_id", F.when(F.coalesce(usable, F.lit(False)), v).alias("v"))
    keys = [F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(s), "v")).alias(f"d{s}") for s in (1, 2)]
    keyed = kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), "v", *keys)
    classes = keyed.where("v IS NOT NULL").groupBy("d1", "d2").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id"), F.any_value("v").alias("v")
    )
    classes = classes.select("d1", "d2", F.size("v").alias("dims"), "n", "least_id", "v")
    return keyed.drop("v"), materialize(classes, "vector-classes")


def _directions(classes: DataFrame) -> dict:
    """{length: matrix of leading directions, length x up to LEAD}, from the classes lowest by hash."""
    import numpy as np

    widest = classes.agg(F.max("dims")).first()[0]
    if not widest:
        return {}
    some = classes.select("dims", "v", "d1").orderBy("d1").limit(max(64, SAMPLE_BYTES // (8 * widest))).toPandas()
    out = {}
    for dims, group in some.groupby("dims"):
        unit = _unit(np, np.stack(group["v"].to_numpy()))
        _, _, turned = np.linalg.svd(unit, full_matrices=False)
        out[int(dims)] = turned[: min(LEAD, dims)].T.copy()
    return out


def _unit(np, table):
    """Rows scaled to length one; by their largest component first, so no square over- or underflows."""
    table = table / np.abs(table).max(axis=1, keepdims=True)
    return table / np.sqrt(np.einsum("ij,ij->i", table, table))[:, None]


def _lead(np, unit, directions):
    """(leading coordinates padded to BOX at least, suffix norms beyond BOX)."""
    basis = directions.get(unit.shape[1])
    if basis is None:
        basis = np.eye(unit.shape[1], min(LEAD, unit.shape[1]))
    lead = unit @ basis
    if lead.shape[1] < BOX:
        lead = np.pad(lead, ((0, 0), (0, BOX - lead.shape[1])))
    return lead, _suffix(np, lead, BOX)


def _suffix(np, lead, at):
    return np.sqrt(np.maximum(0.0, 1.0 - np.square(lead[:, :at]).sum(axis=1))) + EDGE


def _blocks(classes: DataFrame, directions: dict) -> DataFrame:
    """(block, rank, dims, low, high, least, most, nodes, weights, packed): blocks along the curve."""

    def place(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            code = np.zeros(batch.num_rows, np.int64)
            for dims, at, table in _tables(np, batch):
                lead, _ = _lead(np, _unit(np, table), directions)
                # Leading coordinates of unit vectors are mostly within two standard deviations.
                spread = 4.0 / np.sqrt(max(dims, 4))
                cell = np.clip((lead[:, :CURVE] / spread + 0.5) * 2**CURVE_BITS, 0, 2**CURVE_BITS - 1).astype(np.int64)
                for bit in range(CURVE_BITS):
                    for i in range(CURVE):
                        code[at] |= ((cell[:, i] >> bit) & 1) << (bit * CURVE + CURVE - 1 - i)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*batch.schema.names, "code"])

    def pack(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def row():
            nonlocal made
            table = np.concatenate([t for t, *_ in held])
            block, made = (part << 20) + made, made + 1
            lead, suffix = _lead(np, _unit(np, table), directions)
            box = lead[:, :BOX]
            nodes = (np.int64(block) << 12) + np.arange(len(table), dtype=np.int64)
            keys = np.concatenate([k for _, k, _ in held])
            weights = np.concatenate([w for *_, w in held])
            with np.errstate(over="ignore"):
                half = table.astype("<f4")
            packed = half if np.array_equal(half, table) else table  # four bytes where they say it all
            return (part, block, table.shape[1], box.min(axis=0).tolist(), box.max(axis=0).tolist(),
                    float(suffix.min()), float(suffix.max()), np.column_stack([keys, nodes]).tobytes(),
                    weights.tobytes(), packed.tobytes())

        def table_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            )

        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()),
                 pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
        schema = pa.schema(list(zip(BLOCK_COLUMNS, kinds, strict=True)))
        for batch in batches:
            for dims, at, table in _tables(np, batch, ordered=True):
                keys = np.column_stack([batch.column(c).to_numpy()[at] for c in ("d1", "d2")])
                weights = batch.column("n").to_numpy()[at]
                step = max(1, min(BLOCK, BLOCK_BYTES // (8 * dims)))
                if held and held[0][0].shape[1] != dims:
                    yield table_of([row()])
                    held, size = [], 0
                start = 0
                while start < len(table):
                    end = min(len(table), start + step - size)
                    held.append((table[start:end], keys[start:end], weights[start:end]))
                    size, start = size + end - start, end
                    if size == step:
                        yield table_of([row()])
                        held, size = [], 0
        if held:
            yield table_of([row()])

    placed = classes.drop("least_id").mapInArrow(place, "d1 long, d2 long, dims int, n long, v array<double>, code long")
    order = ("dims", "code", "d1", "d2")
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    packed = materialize(dealt.mapInArrow(pack, BLOCK_SCHEMA), "vector-blocks")
    # Blocks in one row: as many parts as tasks wrote, so their counts are few.
    parts = packed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()
    before, at = {}, 0
    for part, n in sorted(map(tuple, parts)):
        before[part], at = at, at + n
    start = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else None
    rank = F.lit(0).cast("long") if start is None else start[F.col("part")] + F.col("block") % (1 << 20)
    return packed.withColumn("rank", rank.cast("long"))


BLOCK_COLUMNS = ("part", "block", "dims", "low", "high", "least", "most", "nodes", "weights", "packed")
BLOCK_SCHEMA = (
    "part long, block long, dims int, low array<double>, high array<double>, least double, most double,"
    " nodes binary, weights binary, packed binary"
)


def _tables(np, batch, ordered=False):
    """(length, places, matrix of vectors) for the vectors of a batch; with `ordered` in runs."""
    dims = batch.column("dims").to_numpy()
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(dims, dtype=np.int64)
    if ordered:
        cuts = np.flatnonzero(np.diff(dims)) + 1
        groups = np.split(np.arange(len(dims)), cuts) if len(dims) else []
    else:
        groups = [np.flatnonzero(dims == d) for d in np.unique(dims)]
    for at in groups:
        d = int(dims[at[0]])
        places = (ends[at] - d)[:, None] + np.arange(d)
        yield d, at, flat[places]


def _could_link(threshold: float):
    """Whether boxes a and b may hold a pair that reaches the threshold: by products, and by distance
    (cosine = 1 - distance^2 / 2)."""
    product, gap = [], []
    for i in range(BOX):
        la, ha, lb, hb = (F.col(f"{c}_{s}")[i] for s in "ab" for c in ("low", "high"))
        product.append(F.greatest(la * lb, la * hb, ha * lb, ha * hb))
        apart = F.greatest(la - hb, lb - ha, F.lit(0.0))
        gap.append(apart * apart)
    apart = F.greatest(F.col("least_a") - F.col("most_b"), F.col("least_b") - F.col("most_a"), F.lit(0.0))
    total = reduce(lambda x, y: x + y, product) + F.col("most_a") * F.col("most_b")
    distance = reduce(lambda x, y: x + y, gap) + apart * apart
    return (total >= threshold - 1e-6) & (distance <= 2 - 2 * threshold + 1e-6)


def _block_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a <= b: the blocks that may hold a link, found from the top of the boxes down."""
    count = blocks.count()
    levels = [blocks.select(F.col("rank").alias("id"), "dims", "low", "high", "least", "most")]
    while count > TOP:
        count = -(-count // FAN)
        folded = levels[-1].groupBy(F.floor(F.col("id") / FAN).alias("id")).agg(
            F.array(*[F.min(F.col("low")[i]) for i in range(BOX)]).alias("low"),
            F.array(*[F.max(F.col("high")[i]) for i in range(BOX)]).alias("high"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
        )
        levels.append(materialize(folded, "vector-boxes"))
    top = levels[-1].select("id")
    # At most TOP boxes: their pairs are few.
    pairs = top.toDF("a").withColumn("b", F.explode(F.sequence("a", F.lit(max(count - 1, 0)).cast("long"))))
    for depth, level in reversed(list(enumerate(levels))):
        left, right = (
            level.select(*[F.col(c).alias(f"{c}_{side}") for c in level.columns]).withColumnRenamed(f"id_{side}", side)
            for side in "ab"
        )
        met = pairs.join(left, "a").join(right, "b").where(_could_link(threshold))
        if depth == 0:
            return met.where("dims_a = dims_b").select("a", "b")
        met = materialize(met.select("a", "b"), "box-pairs")

        def children(x):
            return F.explode(F.sequence(x * FAN, x * FAN + FAN - 1))

        wide = met.select(children(F.col("a")).alias("a"), "b").select("a", children(F.col("b")).alias("b"))
        pairs = wide.where("a <= b")


def _compare(pairs: DataFrame, blocks: DataFrame, directions: dict, threshold: float) -> DataFrame:
    """(node, other, links): links of a class inside a pair of blocks (other null), and edges of a
    spanning forest of the links (links null)."""
    slim = blocks.select("rank", "dims", "nodes", "weights", "packed")
    left, right = (
        slim.select(F.col("rank").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in slim.columns[1:]])
        for side in "ab"
    )
    both = pairs.join(left, "a").join(right.drop("dims_b"), "b")
    def compare(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                cell = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                sides = []
                for s in "ab":
                    nodes = np.frombuffer(cell[f"nodes_{s}"], "<i8").reshape(-1, 3)[:, 2]
                    kind = f"<f{len(cell[f'packed_{s}']) // (len(nodes) * cell['dims_a'])}"
                    table = np.frombuffer(cell[f"packed_{s}"], kind).reshape(len(nodes), -1).astype("f8")
                    sides.append((nodes, np.frombuffer(cell[f"weights_{s}"], "<i8"), table))
                node, other, links = link_blocks(np, *sides, cell["a"] == cell["b"], directions, threshold)
                yield pa.RecordBatch.from_arrays([node, other, links], ["node", "other", "links"])

    return both.mapInArrow(compare, "node long, other long, links long")


def link_blocks(np, one, two, same: bool, directions: dict, threshold: float):
    """Links between two blocks (nodes, weights, vectors): columns node, other, links."""
    import pyarrow as pa

    sides = []
    for nodes, weights, table in (one,) if same else (one, two):
        unit = _unit(np, table)
        lead, _ = _lead(np, unit, directions)
        steps = range(SLICE, lead.shape[1] + SLICE, SLICE)
        sides.append((nodes, weights, table, unit, lead, [_suffix(np, lead, at) for at in steps]))
    first, second = sides[0], sides[-1]
    n = len(first[0])
    shift = 0 if same else n
    count = [np.zeros(len(side[0]), np.int64) for side in sides]
    us, vs = [], []
    for i, rows, box_i in _tiles(np, first):
        for j, cols, box_j in _tiles(np, second):
            if same and j < i:
                continue
            verdict = _boxes(np, box_i, box_j, threshold)
            if verdict == "apart":
                continue
            if verdict == "near":
                linked = np.ones((rows.stop - rows.start, cols.stop - cols.start), bool)
            else:
                linked = _tile_links(np, first, rows, second, cols, threshold)
            if same and i == j:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            count[0][rows] += linked @ second[1][cols]
            if not (same and i == j):
                count[-1][cols] += first[1][rows] @ linked
            if verdict == "near":  # a star through the first of either side
                u = np.concatenate([np.full(linked.shape[1], rows.start), np.arange(rows.start, rows.stop)])
                v = np.concatenate([np.arange(cols.start, cols.stop), np.full(linked.shape[0], cols.start)])
            else:
                u, v = np.nonzero(linked)
                u, v = u + rows.start, v + cols.start
            v = v + shift
            label = labels(np, n + (0 if same else len(second[0])), u, v)
            moved = np.flatnonzero(label != np.arange(len(label)))
            us.append(moved)
            vs.append(label[moved])
    node = np.concatenate([s[0] for s in sides])
    total = np.concatenate(count)
    some = np.flatnonzero(total)
    label = labels(np, len(node), *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs)))
    moved = np.flatnonzero(label != np.arange(len(label)))
    nothing = [None]
    return (
        pa.array(np.concatenate([node[some], node[moved]])),
        pa.concat_arrays([pa.array(nothing * len(some), pa.int64()), pa.array(node[label[moved]])]),
        pa.concat_arrays([pa.array(total[some]), pa.array(nothing * len(moved), pa.int64())]),
    )


def _tiles(np, side):
    """(number, rows, box) of each tile; a box is (low, high, largest suffix norm)."""
    lead, suffix = side[4], side[5][-1]
    for i, start in enumerate(range(0, len(lead), TILE)):
        rows = slice(start, min(start + TILE, len(lead)))
        yield i, rows, (lead[rows].min(axis=0), lead[rows].max(axis=0), suffix[rows].max())


def _boxes(np, one, two, threshold: float) -> str:
    """What two boxes tell of their pairs: all apart, all near, or open."""
    (la, ha, sa), (lb, hb, sb) = one, two
    gap = np.maximum(0.0, np.maximum(la - hb, lb - ha))
    best = np.maximum(np.maximum(la * lb, la * hb), np.maximum(ha * lb, ha * hb)).sum() + sa * sb
    if best < threshold - 1e-6 or (gap * gap).sum() > 2 - 2 * threshold + 1e-6:
        return "apart"
    far = np.maximum(np.abs(ha - lb), np.abs(hb - la))
    return "near" if (far * far).sum() + (sa + sb) ** 2 < 2 - 2 * threshold - 1e-6 else "open"


def _tile_links(np, one, rows, two, cols, threshold: float):
    """Matrix of links: sums over slices of leading directions, rows and columns that cannot reach the
    threshold compacted away after each; what is left is decided on whole vectors."""
    lead_a, lead_b = one[4][rows], two[4][cols]
    at_a, at_b = np.arange(len(lead_a)), np.arange(len(lead_b))
    linked = np.zeros((len(lead_a), len(lead_b)), bool)
    sums = np.zeros(linked.shape)
    for step, start in enumerate(range(0, lead_a.shape[1], SLICE)):
        sums += lead_a[at_a, start : start + SLICE] @ lead_b[at_b, start : start + SLICE].T
        rest_a, rest_b = one[5][step][rows][at_a], two[5][step][cols][at_b]
        alive = sums + np.outer(rest_a, rest_b) >= threshold - EDGE
        keep_a, keep_b = alive.any(axis=1), alive.any(axis=0)
        if not keep_a.any():
            return linked
        if keep_a.sum() * keep_b.sum() < 0.7 * alive.size:
            at_a, at_b = at_a[keep_a], at_b[keep_b]
            sums, alive = sums[keep_a][:, keep_b], alive[keep_a][:, keep_b]
    x, y = np.nonzero(alive)
    unit_a, unit_b = one[3][rows][at_a], two[3][cols][at_b]
    if 4 * len(x) > alive.size:
        cosine = (unit_a @ unit_b.T)[x, y]
    else:
        step = max(1, (1 << 20) // unit_a.shape[1])
        parts = [np.einsum("ij,ij->i", unit_a[x[s : s + step]], unit_b[y[s : s + step]]) for s in range(0, len(x), step)]
        cosine = np.concatenate(parts)
    x, y = at_a[x], at_b[y]
    good = cosine >= threshold
    for k in np.flatnonzero(np.abs(cosine - threshold) < 1e-12):  # rounding decides: take the plain formula
        a, b = one[2][rows][x[k]], two[2][cols][y[k]]
        plain = (a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b))
        good[k] = plain >= threshold if np.isfinite(plain) else good[k]
    linked[x[good], y[good]] = True
    return linked


def labels(np, n: int, u, v):
    """The smallest place that each of n places reaches over the links (u, v)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        step = label.copy()
        np.minimum.at(step, label[u], low)
        np.minimum.at(step, label[v], low)
        while not np.array_equal(step, step[step]):
            step = step[step]
        if np.array_equal(step, label):
            return label
        label = step
