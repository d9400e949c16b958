"""Helpers shared by the operators: picking columns and measuring input."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layers import materialize

BROADCAST_KEYS = 2_000_000  # some 32 MB
BATCH_ROWS = 1000


def pick(frame: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns. Names are compared exactly (the first of equal names counts), so
    other columns, also ones that differ only in case, neither clash nor travel along."""
    missing = [n for n in names if n not in frame.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    at = {n: frame.columns.index(n) for n in names}
    plain = numbered(frame)
    return plain.select(*[F.col(f"_{at[n]}").alias(n) for n in names])


def numbered(frame: DataFrame) -> DataFrame:
    """The frame with its columns named _0, _1, ...: free of clashes."""
    return frame.toDF(*[f"_{i}" for i in range(len(frame.columns))])


def without_rows(frame: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """Rows of `frame` whose `key` is not among the keys of `dropped` (one column, written already),
    all columns as they were. Null keys stay. Few dropped keys are broadcast, more are joined."""
    plain = numbered(frame)
    at = f"_{frame.columns.index(key)}"
    gone = dropped.toDF("_gone").where("_gone IS NOT NULL").distinct()
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    out = plain.join(gone, F.col(at) == F.col("_gone"), "left_anti")
    return out.toDF(*frame.columns)


def blocks_for(docs: DataFrame, text: str, block_bytes: int) -> tuple[int, int]:
    """(blocks of about `block_bytes` of text, bytes of text): grows with the data."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(1, -(-total // block_bytes)), total


def bound_batches(spark: SparkSession) -> None:
    """Texts can be long: from now on Arrow batches of this session hold BATCH_ROWS rows at most, so
    what a task and its Python worker hold at once stays small. Fewer, if the session says so."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


@contextmanager
def byte_batches(spark: SparkSession, size: int = 16 << 20):
    """Inside the block Arrow batches hold about `size` bytes: for rows that are packed blocks."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lookup(rows: DataFrame, unique: DataFrame, keys: list, how: str = "left") -> DataFrame:
    """`rows` joined with the one row that `unique` has for their keys, both cheap to read again.
    Keys that hold over a thousandth of the rows, fewer than a thousand, are joined by broadcast, so
    none of them fills a task."""
    total = rows.count()
    often = rows.groupBy(*keys).count().where(F.col("count") * 1000 > max(total, 1_000_000)).select(*keys)
    often = materialize(often, "hot-keys")
    if often.isEmpty():
        return rows.join(unique, keys, how)
    few = F.broadcast(materialize(unique.join(F.broadcast(often), keys, "left_semi"), "hot-rows"))
    hot = rows.join(F.broadcast(often), keys, "left_semi").join(few, keys, how)
    rest = rows.join(F.broadcast(often), keys, "left_anti").join(unique, keys, how)
    return hot.unionByName(rest)
