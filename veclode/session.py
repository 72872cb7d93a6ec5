"""Session helpers: cutting lineage and turning small tables into literals."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder checkpoints go to. Where ``spark.checkpoint.dir`` is unset it is one below
    the warehouse; on a cluster that must not be a folder of one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            folder = checkpoints_below(spark.conf.get("spark.sql.warehouse.dir"), sc.master)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpoints_below(warehouse: str, master: str) -> str:
    one_machine = master == "local" or master.startswith("local[")
    scheme = warehouse.partition(":")[0] if ":" in warehouse else "file"
    if scheme == "file" and not one_machine:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/checkpoints"


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())
# Kept tables: folder -> (application, weak reference to what every plan that reads it holds).
_tables: dict[str, tuple[str, JavaObject]] = {}
_tables_lock = threading.Lock()


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(path, True)
    fs.cancelDeleteOnExit(path)


def release_unused(spark: SparkSession) -> int:
    """Remove the kept tables that no living DataFrame reads any more; how many they were.

    Every plan over a kept table holds the same file index, so once the JVM has collected
    that, no DataFrame, cached result or running query can read the table again.
    """
    application = spark.sparkContext.applicationId
    with _tables_lock:
        for folder, (owner, _) in list(_tables.items()):
            if owner != application:  # a session that has ended
                del _tables[folder]
        unused = [f for f, (_, index) in _tables.items() if index.get() is None]
        for folder in unused:
            del _tables[folder]
    for folder in unused:
        _delete(spark, folder)
    return len(unused)


def release(table: DataFrame) -> None:
    """Remove a table of :func:`cut_lineage` now; whatever still reads it fails."""
    folder = getattr(table, "_kept_in", None)
    with _tables_lock:
        kept = _tables.pop(folder, None)
    if kept:
        _delete(table.sparkSession, folder)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables that :func:`cut_lineage` wrote inside the block when it ends.

    For jobs that have written their result by then; what reads such a table later fails.
    """
    tables: list[str] = []
    token = _scopes.set((*_scopes.get(), tables))
    try:
        yield tables
    finally:
        _scopes.reset(token)
        for folder in tables:
            with _tables_lock:
                _tables.pop(folder, None)
            _delete(spark, folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as a table in the shared checkpoint folder, and read it back.

    Used where several jobs read the same intermediate result: a lost executor then
    costs a re-read, not a re-run of everything before it. Being Parquet, the table is
    counted from its footers and read by column. The order of rows is not kept.

    A table lives as long as a DataFrame that reads it: each call removes those that have
    gone out of use, and the rest go when the application ends.
    """
    spark = df.sparkSession
    release_unused(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4()}"
    for tables in _scopes.get():
        tables.append(folder)
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    table = spark.read.schema(df.schema).parquet(folder)
    index = table._jdf.queryExecution().analyzed().relation().location()
    with _tables_lock:
        owner = spark.sparkContext.applicationId
        _tables[folder] = owner, spark._jvm.java.lang.ref.WeakReference(index)
    table._kept_in = folder
    return table


# Bytes of rows that a Python function gets in one Arrow batch, about.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold ``BATCH_BYTES`` from now on, unless the session has a limit of its own.

    Spark's limit of 64 MB is held several times over by every Python process and by the JVM
    beside it. A row with more is a batch of its own.
    """
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, BATCH_BYTES)


# An input below this many bytes may lie in fewer splits than there are cores.
SMALL_BYTES = 256 << 20


def spread_small(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input out to all cores; leave a large one as it is read.

    A small file is often one row group, hence one task. The limit does not grow with the
    cluster: past it the splits of the files are used and no raw row is shuffled.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if size < SMALL_BYTES else df


# Bytes a task reads at least, once there are tasks for all cores.
TASK_BYTES = 64 << 20


def few_tasks(df: DataFrame) -> DataFrame:
    """Let tasks read several splits each where splits are many and small; nothing is shuffled.

    A split stays what it is and is read as a whole by one task. Without this a small
    ``spark.sql.files.maxPartitionBytes`` costs a task, and where the rows are written a file, a split.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES))


def table_bytes(table: DataFrame) -> int:
    """Bytes of a table of numbers and strings, counted rather than estimated."""
    per_row = F.lit(16)
    for field in table.schema.fields:
        text = isinstance(field.dataType, (StringType, BinaryType))
        width = F.coalesce(F.octet_length(field.name), F.lit(0)) if text else F.lit(8)
        per_row = per_row + width
    return table.agg(F.sum(per_row).alias("bytes")).head()["bytes"] or 0


def literal_array(values: Iterable, element_type: str) -> Column:
    """A constant array. Going through JSON costs one call however long the array is."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{element_type}>")


def sql_strings(values: Iterable[str]) -> str:
    """Comma-separated SQL string literals."""
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
