"""Clustered tables: rows laid out along a curve through several columns, so that a filter on any of
them reads few files.

Sorted by one column, a table is quick to filter by that one only. Here each column is cut into 2**BITS
ranges with about equally many rows, a row's range numbers are interleaved bit by bit, and the rows are
dealt into files by ranges of that number (a Z-order curve): a file then covers a small box in all the
columns. What each file covers is written beside the data, one row per file, and a read with bounds
opens the files whose boxes meet them. Parquet's own statistics skip within files, as the rows of a file
are in the same order.

The cuts come from a sample of at most about SAMPLE rows, chosen by hash; they decide only how much is
read. A value that holds many rows fills its range alone and is split by the other columns; rows equal
in all columns may be dealt to several files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .layers import read_table, table_path, write_table

BITS = 6
SAMPLE = 50_000
COVER = "_cover"  # what each file covers, where Spark's readers do not look


def write_clustered(frame: DataFrame, layer_dir: str, table: str, columns, n_files: int) -> str:
    """Write a layer table clustered by `columns` into about `n_files` files, and what they cover. Reads its
    input three times (count, sample, rows), so hand it a written table."""
    columns = list(columns)
    ranges = _range_numbers(columns, _cuts(frame, columns))
    # The row's number breaks ties, so rows equal in all columns need not share a file.
    numbered = frame.withColumns(ranges).withColumns(
        {"_place": _curve(list(ranges)), "_row": F.monotonically_increasing_id()}
    ).drop(*ranges)
    order = ["_place", *[f"`{c}`" for c in columns], "_row"]
    dealt = numbered.repartitionByRange(n_files, *order).sortWithinPartitions(*order).drop("_place", "_row")
    path = write_table(dealt, layer_dir, table)
    write_cover(frame.sparkSession, layer_dir, table, columns)
    return path


def write_cover(spark: SparkSession, layer_dir: str, table: str, columns) -> None:
    """Record, for each file of a table, its rows and the least and largest value of the columns."""
    named = _covered(read_table(spark, layer_dir, table), columns)
    named.write.mode("overwrite").parquet(f"{table_path(layer_dir, table)}/{COVER}")


def _covered(rows: DataFrame, columns) -> DataFrame:
    """What each file of a table covers. Whether a column has nulls is a set of one or two values: with
    such an aggregate Spark keeps a row for each file of the task, where the least and largest texts alone
    would make it sort all rows by file."""
    found = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    sides = [f(F.col(f"`{c}`")).alias(f"{side}_{i}") for i, c in enumerate(columns) for side, f in (("low", F.min), ("high", F.max))]
    nulls = [F.array_contains(F.collect_set(F.col(f"`{c}`").isNull()), True).alias(f"null_{i}") for i, c in enumerate(columns)]
    cover = found.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), *sides, *nulls)
    return cover.withColumn("columns", F.array(*[F.lit(c) for c in columns]))


def files_to_read(spark: SparkSession, layer_dir: str, table: str, **bounds) -> DataFrame:
    """(file, rows): the files that may hold a row within the bounds, see `read_within`."""
    cover = spark.read.parquet(f"{table_path(layer_dir, table)}/{COVER}")
    first = cover.select("columns").first()
    columns = first["columns"] if first else list(bounds)
    meets = F.lit(True)
    for name, bound in bounds.items():
        i = columns.index(name)
        low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
        if isinstance(bound, (set, frozenset)):
            parts = [(low <= F.lit(v)) & (high >= F.lit(v)) for v in sorted(bound)]
            meets = meets & reduce(lambda x, y: x | y, parts, F.lit(False))
        else:
            least, most = bound
            if least is not None:
                meets = meets & (high >= F.lit(least))
            if most is not None:
                meets = meets & (low <= F.lit(most))
    return cover.where(F.coalesce(meets, F.lit(False))).select(F.col("_file").alias("file"), "rows")


def read_within(spark: SparkSession, layer_dir: str, table: str, **bounds) -> DataFrame:
    """Rows whose columns lie within bounds: (least, most), both included, None for an open side, or a
    set of values. Nulls lie within none. Opens only files whose cover meets the bounds."""
    whole = read_table(spark, layer_dir, table)
    chosen = [r.file for r in files_to_read(spark, layer_dir, table, **bounds).collect()]
    rows = spark.read.schema(whole.schema).parquet(*chosen) if chosen else whole.limit(0)
    for name, bound in bounds.items():
        value = F.col(f"`{name}`")
        if isinstance(bound, (set, frozenset)):
            rows = rows.where(value.isin(*sorted(bound)))
            continue
        least, most = bound
        rows = rows.where(value.isNotNull())
        rows = rows.where(value >= F.lit(least)) if least is not None else rows
        rows = rows.where(value <= F.lit(most)) if most is not None else rows
    return rows


def has_cover(layer_dir: str, table: str) -> bool:
    return files.path_exists(f"{table_path(layer_dir, table)}/{COVER}")


def _cuts(frame: DataFrame, columns) -> list[list]:
    """For each column the values that cut its rows into 2**BITS ranges, from a sample."""
    plain = frame.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    share = max(1, plain.count() // SAMPLE)
    picked = plain.where(F.pmod(F.xxhash64(*plain.columns, F.monotonically_increasing_id()), F.lit(share)) == 0)
    # Several times SAMPLE never pass, the sample being hashed evenly.
    rows = picked.limit(2 * SAMPLE).collect()
    out = []
    for i in range(len(columns)):
        values = sorted(r[i] for r in rows if r[i] is not None)
        # Cuts repeat at values with many rows, whose numbers are then further from the next.
        out.append([values[len(values) * k // 2**BITS] for k in range(1, 2**BITS)] if values else [])
    return out


def _range_numbers(columns, cuts) -> dict[str, Column]:
    """Number of the range that each column's value is in: how many cuts are not above it."""
    out = {}
    for i, (name, at) in enumerate(zip(columns, cuts, strict=True)):
        value = F.col(f"`{name}`")
        below = F.size(F.filter(F.array(*[F.lit(v) for v in at]), _at_most(value))) if at else F.lit(0)
        out[f"_range_{i}"] = F.when(value.isNull(), F.lit(0)).otherwise(below)
    return out


def _curve(numbers: list[str]) -> Column:
    """A row's place on the curve: the bits of its range numbers, interleaved, the first column's first."""
    place = F.lit(0).cast("bigint")
    for i, number in enumerate(numbers):
        for bit in range(BITS):
            own = F.shiftright(F.col(number), bit).bitwiseAND(F.lit(1)).cast("bigint")
            place = place + F.shiftleft(own, bit * len(numbers) + len(numbers) - 1 - i)
    return place


def _at_most(value: Column):
    return lambda cut: cut <= value
