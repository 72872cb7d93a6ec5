"""Folders of files of any name, listed and read in tasks.

Spark's own readers pass over names that start with ``_`` or ``.``. The data source here
lists folders with Arrow's file systems (local, HDFS, S3, GCS, Azure), inside tasks: planning
opens only as many folders as it takes to have work for every core.
"""

from __future__ import annotations

import fnmatch
import posixpath
import sys
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import cut_lineage

# Executors get these functions with the job; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "path string, length bigint"
# Folders opened while planning, at most; what lies deeper is opened in tasks.
PLANNED_FOLDERS = 256
# Files given out at once while a folder is listed.
LISTED_FILES = 10_000
# Bytes of files read by a task, where single files are smaller.
TASK_BYTES = 64 << 20
# Bytes of contents handed on at once.
BATCH_BYTES = 8 << 20


@lru_cache(maxsize=16)
def _file_system(root: str) -> pafs.FileSystem:
    return pafs.FileSystem.from_uri(root)[0]


def _opened(uri: str) -> tuple[pafs.FileSystem, str, str]:
    """File system, path inside it and the prefix that makes a path a URI again."""
    scheme, _, rest = uri.partition(":")
    host, slash, path = rest.removeprefix("//").partition("/") if rest.startswith("//") else ("", "/", rest[1:])
    arrow_scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    system = _file_system(f"{arrow_scheme}://{host}/")
    if scheme in ("s3", "s3a", "s3n", "gs"):  # buckets are the first part of a path
        return system, f"{host}/{path}".rstrip("/"), f"{scheme}://"
    return system, slash + path.rstrip("/"), f"{scheme}://{host}"


def _skipped(path: str) -> bool:
    name = posixpath.basename(path)
    return ".DS_Store" in name or (name.startswith(".") and name.endswith(".crc"))


def _children(system: pafs.FileSystem, folder: str) -> tuple[list[str], list[pafs.FileInfo]]:
    """Folders and files right below a folder, in order of their names."""
    found = [i for i in system.get_file_info(pafs.FileSelector(folder)) if not _skipped(i.path)]
    found.sort(key=lambda i: i.path)
    folders = [i.path for i in found if i.type == pafs.FileType.Directory]
    return folders, [i for i in found if i.type == pafs.FileType.File]


def _expanded(system: pafs.FileSystem, path: str) -> list[str]:
    """Paths that match a pattern, part by part; ``[``, ``*`` and ``?`` are wild."""
    found = [""]
    for part in path.split("/"):
        if not any(c in part for c in "*?["):
            found = [posixpath.join(p, part) if p else part or "/" for p in found]
            continue
        below = []
        for folder in found:
            if system.get_file_info(folder).type == pafs.FileType.Directory:
                folders, files = _children(system, folder)
                names = sorted([*folders, *(i.path for i in files)])
                below += [n for n in names if fnmatch.fnmatchcase(posixpath.basename(n), part)]
        found = below
    return found


@dataclass
class Folder(InputPartition):
    path: str
    deep: bool


class FileTreeReader(DataSourceReader):
    def __init__(self, uri: str, parts: int):
        self.uri, self.parts = uri, parts

    def partitions(self) -> list[Folder]:
        """Folders, each with or without what lies below it; opened from the top until there
        are enough of them."""
        system, path, _ = _opened(self.uri)
        roots = _expanded(system, path)
        kinds = [system.get_file_info(r).type for r in roots]
        if not roots or pafs.FileType.NotFound in kinds:
            raise FileNotFoundError(self.uri)
        todo = deque(r for r, k in zip(roots, kinds) if k == pafs.FileType.Directory)
        flat = [Folder(r, False) for r, k in zip(roots, kinds) if k == pafs.FileType.File]
        opened = 0
        while todo and len(todo) < self.parts and opened < PLANNED_FOLDERS:
            folder = todo.popleft()
            folders, _ = _children(system, folder)
            todo.extend(folders)
            flat.append(Folder(folder, False))
            opened += 1
        return flat + [Folder(f, True) for f in todo]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        system, _, prefix = _opened(self.uri)
        if system.get_file_info(partition.path).type == pafs.FileType.File:
            yield self._batch([system.get_file_info(partition.path)], prefix)
            return
        todo = [partition.path]
        while todo:
            folders, files = _children(system, todo.pop())
            if partition.deep:
                todo.extend(reversed(folders))
            for at in range(0, len(files), LISTED_FILES):
                yield self._batch(files[at : at + LISTED_FILES], prefix)

    def _batch(self, files: list[pafs.FileInfo], prefix: str) -> pa.RecordBatch:
        paths = [prefix + quote(i.path, safe="/:!$&'()*+,;=@~-._") for i in files]
        sizes = pa.array([i.size for i in files], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), sizes], ["path", "length"])


class FileTree(DataSource):
    """``spark.read.format("file_tree").load(folder)``: every file below, whatever its name."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> FileTreeReader:
        return FileTreeReader(self.options["path"], int(self.options.get("parts", "8")))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` (a URI), ``length`` of every file below a folder, a file or a pattern.

    Names may start with ``_`` or ``.``; ``.DS_Store`` and checksum files are left out.
    """
    spark.dataSource.register(FileTree)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = unquote(system.makeQualified(jvm_path).toUri().toString())
    cores = spark.sparkContext.defaultParallelism
    return spark.read.format("file_tree").option("parts", str(2 * cores)).load(whole)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths, contents, size = [], [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inside, _ = _opened(unquote(path))
            with system.open_input_stream(inside) as stream:
                contents.append(stream.read())
            paths.append(path)
            size += len(contents[-1])
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(contents)], ["path", "value"])
                paths, contents, size = [], [], 0
    if paths:
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(contents)], ["path", "value"])


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, value`` (bytes) of every file of :func:`list_files`.

    The list is made once, as a table, and dealt out in parts of about ``TASK_BYTES``.
    """
    listed = cut_lineage(list_files(spark, path))
    n, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).head()
    parts = min(n, max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))
    dealt = listed.select("path").repartition(max(parts, 1))
    return dealt.mapInArrow(_contents, "path string, value binary")


def write_files(df: DataFrame, root: str, name: str, text: str) -> int:
    """One file below ``root`` for each row, named by column ``name`` (folders included).

    Returns the number of files. A task that is repeated writes its files again; of rows
    with equal names one is kept.
    """
    spark = df.sparkSession
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = unquote(system.makeQualified(jvm_path).toUri().toString())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder, _ = _opened(whole)
        made, n = set(), 0
        for batch in batches:
            for path, content in zip(*batch.columns):
                path = posixpath.join(folder, path.as_py())
                if (parent := posixpath.dirname(path)) not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(path) as stream:
                    stream.write(content.as_py() or b"")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    rows = df.select(F.col(name), F.col(text).cast("binary"))
    return rows.mapInArrow(write, "n bigint").agg(F.sum("n")).head()[0] or 0
