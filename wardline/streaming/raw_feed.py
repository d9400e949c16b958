"""Incremental form of the raw-to-bronze conversion, for tables that grow by part files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..sources import files
from ..sources.layers import table_path


def feed_bronze(
    spark: SparkSession,
    csv_dir: str,
    bronze_dir: str,
    checkpoint_dir: str,
    multiline: bool = True,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append the part files of one `<table>.csv` directory that earlier runs have not seen to its
    bronze table, then stop. The checkpoint remembers finished files, so a run that dies half-way
    repeats its batch without writing a row twice. A part whose header differs fails the run.
    """
    table = files.entry(csv_dir)
    if table is None or not table.header:
        raise ValueError(f"No CSV parts with a header in {csv_dir}")
    schema = StructType([StructField(name, StringType()) for name in table.header])
    name = table.name.rsplit(".", 1)[0]
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(csv_dir)
        .writeStream.format("parquet")
        .option("path", table_path(bronze_dir, name))
        .option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{name}")
        .trigger(availableNow=True)
        .start()
    )
