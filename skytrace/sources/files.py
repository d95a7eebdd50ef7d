"""Random access to files by path or URI, on the driver and in tasks alike."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def qualified(path: str, default: str | None) -> str:
    """A path as Spark reads it: without a scheme it is one of Spark's default file system."""
    if "://" in path or path.startswith("file:") or not default or default.startswith("file:"):
        return path
    return default.rstrip("/") + "/" + path.lstrip("/")


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a local path or of a ``scheme://`` URI that Arrow knows."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://") :]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_sizes(path: str, suffixes: tuple[str, ...]) -> dict[str, int]:
    """Sizes of a single file, or of a folder's files (not its subfolders') by suffix, in name order.

    A folder is listed; none of its files is opened or looked at on its own.
    """
    system, inner = locate(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.is_file:
        return {path: info.size}
    found = system.get_file_info(fs.FileSelector(inner))
    scheme = path[: len(path) - len(inner)] if "://" in path else ""
    kept = [f for f in found if f.is_file and f.path.lower().endswith(suffixes)]
    return {scheme + f.path: f.size for f in sorted(kept, key=lambda f: f.path)}


def list_files(path: str, suffix: str) -> list[str]:
    """A single file, or the files of a folder by suffix, in name order."""
    return list(list_sizes(path, (suffix,)))


def packed(sizes: dict[str, int], limit: int, opening: int) -> list[list[tuple[str, int, int]]]:
    """Files as ranges ``(file, from, to)`` of at most ``limit``, small ones several to a partition.

    Each range counts for ``opening`` besides its size, since opening a file takes time, too.
    """
    partitions: list[list[tuple[str, int, int]]] = []
    room = 0
    for file, size in sizes.items():
        for start in range(0, size, limit):
            end = min(start + limit, size)
            if end - start + opening > room:
                partitions.append([])
                room = limit + opening
            partitions[-1].append((file, start, end))
            room -= end - start + opening
    return partitions


def missing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` of the inputs, files or folders, that are not there; for checks before a run."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    configuration = spark.sparkContext._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        own = hadoop(path)
        return own.getFileSystem(configuration).exists(own)

    return spark.createDataFrame([(p,) for p in paths if not there(p)], "path string")


def read_range(path: str, start: int, length: int) -> bytes:
    system, inner = locate(path)
    with system.open_input_file(inner) as f:
        f.seek(start)
        return f.read(length)


def file_size(path: str) -> int:
    system, inner = locate(path)
    return system.get_file_info(inner).size


def exists(path: str) -> bool:
    system, inner = locate(path)
    return system.get_file_info(inner).type == fs.FileType.File


def write_file(path: str, chunks: list[bytes]) -> None:
    system, inner = locate(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inner) as f:
        for chunk in chunks:
            f.write(chunk)


def concurrently(call, items: list) -> list:
    """``call`` of every item in order, a few at a time: for short reads of many files."""
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(call, items))


class StagedFolder:
    """Files of a write job, which readers see when the job commits.

    Tasks write below ``_temporary/<job>``, which readers do not list. What failed or repeated
    attempts leave there goes with the folder; only files that the winning attempts report move.
    """

    def __init__(self, path: str, overwrite: bool, extensions: tuple[str, ...]) -> None:
        self.path = path.rstrip("/")
        self.overwrite = overwrite
        self.extensions = extensions
        self.staging = f"{self.path}/_temporary/{uuid.uuid4().hex}"

    def new_stem(self) -> str:
        return f"{self.staging}/part-{uuid.uuid4().hex}"

    def commit(self, files: list[str]) -> None:
        system, folder = locate(self.path)
        system.create_dir(folder, recursive=True)
        old = []
        if self.overwrite:
            present = system.get_file_info(fs.FileSelector(folder))
            old = [f.path for f in present if f.path.lower().endswith(self.extensions)]
        for file in old:
            system.delete_file(file)
        for file in files:
            _, inner = locate(file)
            system.move(inner, f"{folder}/{inner.rsplit('/', 1)[1]}")
        self.discard()

    def discard(self) -> None:
        system, inner = locate(self.staging)
        if system.get_file_info(inner).type == fs.FileType.Directory:
            system.delete_dir(inner)
