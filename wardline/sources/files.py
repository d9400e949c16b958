"""File listing on the driver and content hashing in tasks, for local and remote paths."""

from __future__ import annotations

import csv
import hashlib
import io
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1024 * 1024
MAX_HASH_TASKS = 10_000


@dataclass(frozen=True)
class FileEntry:
    """A table file, or a directory of part files that together are one table."""

    name: str
    path: str
    parts: tuple[tuple[str, int], ...]

    @property
    def size_bytes(self) -> int:
        return sum(size for _, size in self.parts)

    @property
    def header(self) -> list[str]:
        """First record of the first part that is not empty."""
        return next((csv_header(path) for path, size in self.parts if size > 0), [])


def _filesystem(path: str):
    """Filesystem and path inside it. `s3a://` is the Hadoop spelling of `s3://`."""
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path[len("file:/"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def is_hidden(path: str) -> bool:
    """Names that Spark's readers leave out: side files of a writer, when they stand in a table's
    folder. A table itself may have such a name."""
    return path.rstrip("/").rsplit("/", 1)[-1].startswith(("_", "."))


def path_exists(path: str) -> bool:
    system, inner = _filesystem(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def delete_folder(path: str) -> None:
    system, inner = _filesystem(path)
    if system.get_file_info(inner).type == fs.FileType.Directory:
        system.delete_dir(inner)


def delete_file(path: str) -> None:
    system, inner = _filesystem(path)
    if system.get_file_info(inner).type == fs.FileType.File:
        system.delete_file(inner)


def read_text(path: str) -> str:
    system, inner = _filesystem(path)
    with system.open_input_stream(inner) as stream:
        return stream.read().decode()


def write_text(path: str, text: str) -> None:
    """Write a small file whole: under another name first, so that no reader sees half of it."""
    system, inner = _filesystem(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(f"{inner}.part") as stream:
        stream.write(text.encode())
    system.move(f"{inner}.part", inner)


def entry(path: str) -> FileEntry | None:
    """The table at `path`: a file, or a directory holding at least one part file at any depth (as
    in tables partitioned by folder); files and folders that Spark's readers skip are no parts."""
    system, inner = _filesystem(path)
    info = system.get_file_info(inner)
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if info.type == fs.FileType.File:
        return FileEntry(name, path, ((path, info.size),))
    if info.type != fs.FileType.Directory:
        return None
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    start = len(inner.rstrip("/")) + 1
    parts = sorted(
        (f"{path.rstrip('/')}/{part.path[start:]}", part.size)
        for part in found
        if part.type == fs.FileType.File
        and not any(is_hidden(step) and "=" not in step for step in part.path[start:].split("/"))
    )
    return FileEntry(name, path, tuple(parts)) if parts else None


def list_directory(path: str, suffix: str) -> list[str]:
    """Sorted names directly under `path` that end with `suffix`; none if it does not exist."""
    system, inner = _filesystem(path)
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name.endswith(suffix))


def _copy_batches(batches):
    for batch in batches:
        for source, target in zip(batch["source"], batch["target"], strict=True):
            (system, inner), (to_system, to_inner) = _filesystem(source), _filesystem(target)
            to_system.create_dir(to_inner.rsplit("/", 1)[0], recursive=True)
            with system.open_input_stream(inner) as stream, to_system.open_output_stream(to_inner) as out:
                while chunk := stream.read(CHUNK):
                    out.write(chunk)
        yield batch


def copy_in_tasks(spark: SparkSession, pairs: list[tuple[str, str]]) -> None:
    """Copy files, (source, target) each, in tasks and by chunks."""
    frame = spark.createDataFrame(pairs, "source string, target string").repartition(len(pairs))
    frame.mapInPandas(_copy_batches, frame.schema).write.format("noop").mode("overwrite").save()


def csv_header(path: str) -> list[str]:
    """First CSV record, without a byte-order mark; empty for an empty file."""
    system, inner = _filesystem(path)
    with system.open_input_stream(inner) as stream:
        text = io.TextIOWrapper(stream, encoding="utf-8-sig", newline="")
        return next(csv.reader(text), [])


def _hash_batches(batches):
    for batch in batches:
        digests = []
        for path in batch["path"]:
            digest = hashlib.sha256()
            system, inner = _filesystem(path)
            with system.open_input_stream(inner) as stream:
                while chunk := stream.read(CHUNK):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


def file_hashes(spark: SparkSession, entries: list[FileEntry]) -> DataFrame:
    """(table, path, sha256) per part file; files are spread over tasks and read in chunks."""
    parts = [(e.path, path) for e in entries for path, _ in e.parts]
    frame = spark.createDataFrame(parts, "table string, path string")
    tasks = max(1, min(len(parts), MAX_HASH_TASKS))
    return frame.repartition(tasks).mapInPandas(
        _hash_batches, "table string, path string, sha256 string"
    )


def table_digests(spark: SparkSession, entries: list[FileEntry]) -> DataFrame:
    """(table, sha256): the file's digest; for part files, the digest of their hex digests joined
    in path order."""
    in_order = F.array_sort(F.collect_list(F.struct("path", "sha256")))
    joined = F.array_join(F.transform(in_order, lambda part: part["sha256"]), "")
    return (
        file_hashes(spark, entries)
        .groupBy("table")
        .agg(
            F.when(F.count(F.lit(1)) == 1, F.max("sha256"))
            .otherwise(F.sha2(joined, 256))
            .alias("sha256")
        )
    )
