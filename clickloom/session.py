"""Session helpers: shared storage for intermediate tables, and scoped caching."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table with more rows, or more elements in its arrays, isn't broadcast.
BROADCAST_ROWS, BROADCAST_ELEMENTS = 300_000, 1_500_000
# Rows in a file of a table of vectors.
VECTOR_ROWS = 10_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A temporary folder is used only on a local master where nothing is configured. It is kept on
    the Spark context, because the setting itself can't be changed in a running session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/clickloom/{name}-{uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_clickloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = tempfile.mkdtemp(prefix="clickloom-package-")
    archive = shutil.make_archive(f"{target}/clickloom", "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._clickloom_shipped = True


def materialise(df: DataFrame, name: str, rows_per_file: int = 0, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table to the shared folder once and read it back.

    Iterative fits run a job per step, and every job ships the lineage of its input: this cuts it,
    and a lost executor rereads files instead of repeating joins and windows. The scan splits files
    by size, so a partition swollen by a hot key is evened out as well. Like checkpoint files, the
    table stays until the shared folder is expired, because fitted models may refer to it.
    ``rows_per_file`` (0: any) is for rows that take far more memory than storage, as vectors that
    repeat: a scan counts each file as 4 MB at least, so that no task gets more than some 30 files.
    ``partition_by`` keeps rows of different values in different files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path, partitionBy=list(partition_by) or None)
    return spark.read.parquet(path)


def small(df: DataFrame, array: str | None = None) -> DataFrame:
    """The table, to be broadcast if its rows (and elements of ``array``) are counted to be few.

    A larger one is left to a shuffle join, which gives the same rows. The count is a job of its own, so
    a table that is dear to make had best be stored.
    """
    return F.broadcast(df) if few(df, array) else df


def few(df: DataFrame, array: str | None = None) -> bool:
    """Whether the rows (and elements of ``array``) are few enough to be broadcast; they are counted."""
    elements = F.sum(F.size(array)) if array else F.lit(0)
    rows, held = df.agg(F.count("*"), elements).first()
    return rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_ELEMENTS


@contextmanager
def cached(*frames: DataFrame) -> Iterator[None]:
    """Keep tables that several jobs read; tables the caller already cached are left alone."""
    mine = [f for f in frames if f.storageLevel == StorageLevel.NONE]
    for frame in mine:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        for frame in mine:
            frame.unpersist()
