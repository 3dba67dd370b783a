"""Session settings the library relies on, and its shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
CHECKPOINT_SETTING = "spark.checkpoint.dir"
PARTS_SETTING = "spark.sql.shuffle.partitions"
FIRST_PARTS_SETTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows a task of a shuffle should have, about.
TASK_ROWS = 500_000
#: Rows of one slice of a large job, about, and how many slices there may be: what a job shuffles lies on disk one slice at a time.
SLICE_ROWS = 4_000_000
MOST_SLICES = 12
WRITERS_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
#: Codec of everything that is stored; message texts take little more than half of what they take with Spark's own choice.
CODEC = "zstd"


def local_session(app: str = "ordermill", cores: str = "8", shuffle_partitions: str = "8",
                  memory: str = "16g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Event timestamps carry offsets, so every session works in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_freeing, _freeing_lock = {"jobs": 0, "before": None}, threading.Lock()


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written within it go when it is written.

    Else they lie on disk until the driver happens to collect its garbage, those of all steps of a load together. Only writes
    of the library are so: a frame of the user that is collected again may find its shuffle files. Jobs may run side by side.
    """
    with _freeing_lock:
        if _freeing["jobs"] == 0:
            _freeing["before"] = spark.conf.get(CLEANUP_SETTING, None)
        _freeing["jobs"] += 1
        spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            _freeing["jobs"] -= 1
            if _freeing["jobs"] == 0:
                if _freeing["before"] is None:
                    spark.conf.unset(CLEANUP_SETTING)
                else:
                    spark.conf.set(CLEANUP_SETTING, _freeing["before"])


def parts_for(spark: SparkSession, rows: int) -> int:
    """Parts for a shuffle of ``rows``: the session's number, or more where a task would get too many of them."""
    return max(int(spark.conf.get(PARTS_SETTING)), -(-rows // TASK_ROWS))


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs within it begin their shuffles with parts for ``rows``; adaptive execution merges those that turn out small.

    What a task holds so follows neither the load nor the session's number of parts. Fewer than the session's are never asked for.
    """
    before = spark.conf.get(FIRST_PARTS_SETTING, None)
    wanted = parts_for(spark, rows)
    if wanted <= int(before or spark.conf.get(PARTS_SETTING)):
        yield
        return
    spark.conf.set(FIRST_PARTS_SETTING, wanted)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FIRST_PARTS_SETTING)
        else:
            spark.conf.set(FIRST_PARTS_SETTING, before)


def slices_for(rows: int) -> int:
    """Slices for a job over ``rows``; one for all but large ones."""
    return min(MOST_SLICES, max(1, -(-rows // SLICE_ROWS)))


def slice_of(count: int, *key: str | Column) -> Column:
    """Number of the slice a row belongs to, below ``count``: by hash of a key, which may be null."""
    return F.pmod(F.xxhash64(F.lit("slice"), *key), F.lit(count))


def in_slices(df: DataFrame, count: int, *key: str | Column) -> list[DataFrame]:
    """A frame cut into ``count`` frames that hold each row once; rows of one key are in one of them."""
    return [df] if count == 1 else [df.filter(slice_of(count, *key) == n) for n in range(count)]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ordermill-"))
    return context.getCheckpointDir()


def together(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs side by side and return their results in order."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def _hadoop(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, deleted when the driver ends."""
    folder = f"{shared_folder(spark)}/ordermill/{label}-{uuid.uuid4().hex}"
    fs, path = _hadoop(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def materialise(df: DataFrame | Iterable[DataFrame], label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back; or several frames of one schema, one after another.

    Cuts lineage in a way that survives lost executors. Parquet rather than
    ``checkpoint()`` because the copy keeps column pruning, filter pushdown and
    a row count in its footers, by which joins choose to broadcast or shuffle.
    """
    folder = None
    for part in [df] if isinstance(df, DataFrame) else df:
        folder = folder or f"{scratch_folder(part.sparkSession, label)}/rows"
        with freed(part.sparkSession):
            part.write.option("compression", CODEC).mode("append").parquet(folder)
    return part.sparkSession.read.schema(part.schema).parquet(folder)


def materialise_slices(frames: Iterable[DataFrame], label: str, count: int, *key: str | Column) -> list[DataFrame]:
    """Write frames of one schema, one after another, and read them back as ``count`` slices by a key, each in a folder of its own.

    ``discard`` takes one slice, so a job that goes through them frees what it is done with. A task has all its files open at
    once instead of sorting its rows by slice.
    """
    folder = None
    for part in frames:
        spark = part.sparkSession
        folder = folder or scratch_folder(spark, label)
        before = spark.conf.get(WRITERS_SETTING)
        spark.conf.set(WRITERS_SETTING, str(max(int(before), count)))
        try:
            cut = part.withColumn("slice", slice_of(count, *key))
            with freed(spark):
                cut.write.option("compression", CODEC).mode("append").partitionBy("slice").parquet(f"{folder}/rows")
        finally:
            spark.conf.set(WRITERS_SETTING, before)
    made = []
    for n in range(count):
        fs, path = _hadoop(spark, f"{folder}/rows/slice={n}")
        fs.mkdirs(path)  # a slice may have no row
        made.append(spark.read.schema(part.schema).parquet(f"{folder}/rows/slice={n}"))
    return made


def discard(*frames: DataFrame) -> None:
    """Delete the stored copies ``materialise`` made of these frames."""
    for df in frames:
        spark = df.sparkSession
        scratch = f"{shared_folder(spark)}/ordermill/"
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            if scratch in folder:
                fs, path = _hadoop(spark, folder)
                fs.delete(path, True)
