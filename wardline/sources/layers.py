"""Layer tables (Parquet), report files, run manifests, and shared scratch space."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import delete_folder, entry, path_exists


def table_path(layer_dir: str, table: str) -> str:
    return f"{layer_dir.rstrip('/')}/{table}.parquet"


def table_exists(layer_dir: str, table: str) -> bool:
    return entry(table_path(layer_dir, table)) is not None


def read_table(spark: SparkSession, layer_dir: str, table: str) -> DataFrame:
    """The table as it was written: one with a folder for each value of some columns gets these columns
    back with the types that they had, where Spark by itself would guess them from the folders' names."""
    path = table_path(layer_dir, table)
    declared = f"{path}/{SCHEMA_FOLDER}"
    if not path_exists(declared):
        return spark.read.parquet(path)
    schema = StructType.fromJson(json.loads("".join(r.value for r in spark.read.text(declared).collect())))
    names = [F.col(f"`{n.replace('`', '``')}`") for n in schema.names]
    return spark.read.schema(schema).parquet(path).select(*names)


def read_present(spark: SparkSession, layer_dir: str, tables) -> dict[str, DataFrame | None]:
    return {
        t: read_table(spark, layer_dir, t) if table_exists(layer_dir, t) else None for t in tables
    }


def need_table(spark: SparkSession, layer_dir: str, table: str, hint: str) -> DataFrame:
    if not table_exists(layer_dir, table):
        raise FileNotFoundError(f"Missing table: {table_path(layer_dir, table)}. {hint}")
    return read_table(spark, layer_dir, table)


def exact_names(spark: SparkSession) -> SparkSession:
    """A session of the same application that tells column names apart by case. Raw headers may
    hold names that differ in nothing else. Its files hold at most FILE_RECORDS records."""
    exact = spark.newSession()
    exact.conf.set("spark.sql.files.maxRecordsPerFile", str(FILE_RECORDS))
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "wardline.scratch.dir"):
        if value := spark.conf.get(name, None):
            exact.conf.set(name, value)
    exact.conf.set("spark.sql.caseSensitive", "true")
    return exact


SCHEMA_FOLDER = "_schema"  # beside the data, where Spark's readers do not look
CODEC = "zstd"  # layer tables are written once and kept: smaller than with Spark's default


def write_table(
    frame: DataFrame, layer_dir: str, table: str, partition_by=(), replace: str = "table"
) -> str:
    """Write a layer table; with `partition_by` in a folder for each value of those columns, and the
    schema beside them. `replace="folders"` leaves the folders without a row in `frame` as they are; the
    columns must then be those of the table that is there. Null and the empty text share a folder and
    come back as null."""
    path = table_path(layer_dir, table)
    if replace not in ("table", "folders"):
        raise ValueError(f"Replace the table or its folders, not {replace!r}")
    if replace == "folders":
        if not partition_by:
            raise ValueError("Only a table in folders can have some of them replaced")
        if path_exists(path):
            there = read_table(frame.sparkSession, layer_dir, table).schema
            if _plain(there) != _plain(frame.schema):
                raise ValueError(f"The table at {path} has other columns: {there.simpleString()}")
    mode = "dynamic" if replace == "folders" else "static"
    writer = frame.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", CODEC)
    writer.partitionBy(*partition_by).parquet(path)
    if partition_by:
        declared = frame.sparkSession.createDataFrame([(frame.schema.json(),)], "value string")
        declared.coalesce(1).write.mode("overwrite").text(f"{path}/{SCHEMA_FOLDER}")
    return path


def write_measured(
    frame: DataFrame, layer_dir: str, table: str, measures: dict[str, Column]
) -> tuple[str, dict]:
    """Write a layer table; what is measured (aggregates over its rows) is counted as rows are written,
    so that checks need no scan of their own."""
    seen = Observation()
    path = write_table(frame.observe(seen, *[c.alias(n) for n, c in measures.items()]), layer_dir, table)
    return path, seen.get


def _plain(schema: StructType) -> list:
    return [(f.name, f.dataType.simpleString()) for f in schema]


FILE_RECORDS = 500_000  # what a reader gets that cannot or should not split a file: some 30 MB of text


def write_csv(frame: DataFrame, path: str, packed: bool = False) -> str:
    """CSV part files with a header each; as many as the frame has partitions. Quotes are doubled,
    as CSV readers expect them, and spaces at the edges of a text stay. `packed` writes them as gzip, in
    files of at most FILE_RECORDS records, as such a file cannot be split by its readers."""
    writer = (
        frame.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if packed:
        writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
    writer.csv(path)
    return path


def in_report_order(report: DataFrame, order_column: str, keep: bool = False) -> DataFrame:
    """A finished report (tens of rows) as one ordered partition."""
    ordered = report.repartition(1).sortWithinPartitions(order_column)
    return ordered if keep else ordered.drop(order_column)


def write_manifest(records: DataFrame, path: str, kind: str, provenance: dict) -> str:
    """One JSON line per record, each with the run's kind, UTC time and provenance."""
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                          "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    origin = [F.lit(None if v is None else str(v)).cast("string").alias(k) for k, v in provenance.items()]
    extra = [F.struct(*origin).alias("provenance")] if origin else []
    records.coalesce(1).select(
        F.lit(kind).alias("manifest_type"),
        stamp.alias("generated_at_utc"),
        F.lit(path).alias("manifest_path"),
        *extra,
        "*",
    ).write.mode("overwrite").json(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder. Only a local session
    may go without one; it gets a temporary folder, remembered in the session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors")
    root = spark.conf.get("wardline.scratch.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="wardline-")
        spark.conf.set("wardline.scratch.dir", root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


# Scratch folders made inside a `scratch` block.
_MADE: ContextVar[list | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Scratch folders made inside the block are deleted at its end: what leaves the block must not
    read them any more."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            delete_folder(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Inside the block the shuffle files of each query are deleted as it ends, not when the driver
    happens to collect its garbage: a job of many queries holds the files of one at a time."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


SIDE_BY_SIDE = 4


def side_by_side(work: list[Callable]) -> list:
    """Results of independent jobs, in order, a few at a time: a small table's job does not keep the
    cluster waiting for its last task."""
    if len(work) < 2:
        return [job() for job in work]
    with ThreadPoolExecutor(min(SIDE_BY_SIDE, len(work))) as pool:
        return list(pool.map(lambda pair: pair[0].run(pair[1]), [(copy_context(), job) for job in work]))


TASK_BYTES = 8 << 20


@contextmanager
def small_tasks(frame: DataFrame):
    """Inside the block the session's scans and shuffles deal their rows into tasks of at most about
    TASK_BYTES, of which there may be as many as the files that `frame` reads call for: what a task sorts
    or merges does not grow with the data. A shuffle moves a row several times as large as a file holds it."""
    spark = frame.sparkSession
    found = [entry(path) for path in frame.inputFiles()]
    size = sum(e.size_bytes for e in found if e is not None)
    names = (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    )
    before = [spark.conf.get(name) for name in names]
    spark.conf.set(names[0], str(max(int(before[0]), -(-4 * size // TASK_BYTES))))
    for name in names[1:]:
        spark.conf.set(name, str(TASK_BYTES))
    try:
        yield
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)


def materialize(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame that several passes will read, and read it back: cuts the lineage, and the
    copy outlives any executor."""
    spark = frame.sparkSession
    path = scratch_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(frame: DataFrame) -> None:
    """Delete what `materialize` wrote of a frame that nothing reads any more."""
    for folder in {path.rsplit("/", 1)[0] for path in frame.inputFiles()}:
        delete_folder(folder)
