"""Session defaults and the shared folder that long jobs stage their tables in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table sent to every task, by the size of its files or by Catalyst's estimate of a scan.
MAX_SENT_TABLE = 64 * 1024**2
# Input below this much per core may sit in too few row groups to keep the cores busy.
SPREAD_BYTES_PER_CORE = 8 * 1024**2
# Input of a task that groups what it makes of its rows, by the size of the files.
SPREAD_BYTES_PER_TASK = 2 * 1024**2
# Tasks that a table is hashed to at most, where an estimate of its bytes is far too high.
MAX_SPREAD_TASKS = 20_000
# Objects that one task opens.
PATHS_PER_TASK = 256
# Bytes that Spark hands to a Python worker at once within ``small_batches``, and its setting for that.
BATCH_BYTES = 4 * 1024**2
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Parts for each core that the rows of very many small splits are put in.
PARTS_PER_CORE = 4


def build_session(app: str = "filelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read and write: the session's ``spark.checkpoint.dir``.

    Only a local session that has not set it gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="filelake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder below the shared one that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that outlives lost executors, and gives the next plan real sizes.
    """
    return stage_at(df, label)[0]


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``stage`` with the folder, for loops that ``remove`` each round's table after the next one."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    if _WITHIN:
        _WITHIN[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


# Folders staged within each open ``dropping_staged``.
_WITHIN: list[list[str]] = []


@contextmanager
def dropping_staged(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside, for work whose results are all written by its end."""
    _WITHIN.append([])
    try:
        yield
    finally:
        for path in _WITHIN.pop():
            remove(spark, path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand Python workers at most ``BATCH_BYTES`` at once in the jobs that run inside, for rows that are large.

    By its own setting of 64 MiB Spark holds that much for each task in buffers outside its heap, and so does the worker.
    """
    before = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_BYTES)
        else:
            spark.conf.set(_BATCH_BYTES, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``new_folder`` that no later plan reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def estimated_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def send_if_small(staged: DataFrame) -> DataFrame:
    """Broadcast a table just written by ``stage`` if its files are small, else leave it to Spark.

    Only for scans: their size is that of the files, not a guess about an operator.
    """
    return F.broadcast(staged) if estimated_bytes(staged) <= MAX_SENT_TABLE else staged


def small_side(df: DataFrame, label: str) -> DataFrame:
    """Join side expected to be small: written once, then broadcast only if its files are small."""
    return send_if_small(stage(df, label))


def few_parts(df: DataFrame) -> DataFrame:
    """Put very many small splits together, as a scan of small files has them: a few for each core."""
    return df.coalesce(PARTS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def spread_paths(df: DataFrame, *by: Column) -> DataFrame:
    """Deal a list of object paths to the tasks that open them; rows with equal ``by`` share a task.

    A path is a few bytes but may stand for gigabytes, so the size of the list tells nothing: there are
    ``PATHS_PER_TASK`` paths a task, and on short lists as many tasks as cores. The list is written in few files
    whatever made it, or there would be as many shuffle blocks as the square of the paths.
    """
    staged = stage(few_parts(df), "paths")
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-staged.count() // PATHS_PER_TASK))
    # A number given is kept: adaptive merging would undo the spread of such small rows.
    return staged.repartition(tasks, *(by or staged.columns))


def spread_evenly(df: DataFrame, key: str) -> DataFrame:
    """Hash rows by ``key`` to as many tasks as their bytes ask for, so that work by key stays in the memory of a task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(cores, -(-estimated_bytes(df) // SPREAD_BYTES_PER_TASK)), MAX_SPREAD_TASKS)
    return df.repartition(tasks, key)


def spread(df: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """Hash a small input by ``key`` over all cores before costly per-row work.

    A large input already has more splits than cores and is left where it is. Also tells whether
    the rows moved, so that they need not be shuffled by ``key`` again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) > cores * SPREAD_BYTES_PER_CORE:
        return df, False
    return df.repartition(cores, key), True
