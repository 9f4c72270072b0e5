"""Table reads and writes, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def read_table(
    spark: SparkSession,
    path: str | None = None,
    *,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table read from a file format or a connector (which takes ``options`` and no path).

    The filter and the column list reach the scan.
    """
    df = spark.read.format(format).options(**(options or {})).load(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def write_table(
    df: DataFrame,
    path: str | None = None,
    *,
    mode: str = "overwrite",
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a table; ``mode`` is ``overwrite`` for feature tables and ``append`` for logs."""
    df.write.mode(mode).format(format).options(**(options or {})).save(path)


def extract_parquet(frames: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Replace ``root/<name>`` with a gzip Parquet export of each frame; returns the paths."""
    paths = {name: f"{root}/{name}" for name in frames}
    for name, df in frames.items():
        df.write.mode("overwrite").option("compression", "gzip").parquet(paths[name])
    return paths


def replace_partitions(df: DataFrame, path: str, *, by: Sequence[str]) -> None:
    """Replace the partitions of ``path`` that ``df`` has rows of; all others stay as they are.

    Files take their place when the whole job has succeeded: a run that fails half-way changes nothing.
    """
    write = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write.partitionBy(*by).parquet(path)


def append_results(df: DataFrame, path: str, *, schema: T.StructType, run_date: date) -> None:
    """Project a result table to its fixed schema, stamp ``run_date`` as text and publish it.

    The table is kept by ``run_date``, so a repeated run of a date takes the place of the one before.
    A run publishes all its rows at once, also if it has none. Read with ``read_results``.
    """
    stamped = df.withColumn("run_date", F.lit(run_date.isoformat()))
    projected = stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    rows = stage(projected, "results")
    replace_partitions(rows, path, by=["run_date"])
    if rows.isEmpty():
        remove(df.sparkSession, f"{path}/run_date={run_date.isoformat()}")


def read_results(spark: SparkSession, path: str, *, schema: T.StructType) -> DataFrame:
    """A table of ``append_results``, of all runs."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_log(log: DataFrame, path: str) -> None:
    """Append a data-quality report to the log table of all jobs."""
    write_table(log, path, mode="append")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of stage tables on whatever file system it is."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at ``path``, on whatever file system it is?"""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)


def written(spark: SparkSession, folder: str) -> tuple[tuple[str, int, int], ...]:
    """Name, time of writing and length of what lies in ``folder``."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    entries = path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((e.getPath().getName(), e.getModificationTime(), e.getLen()) for e in entries))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is absent, a session that has set a checkpoint folder uses that one. Only a
    local session, whose executors are the driver, may get a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_DIR, None) or context.getConf().get(_CHECKPOINT_DIR)
    folder = configured or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="clearshelf-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, *, path: str | None = None) -> DataFrame:
    """Write ``df`` once to a new ``path``, by default under the shared folder, and read it back.

    Cuts lineage where several consumers follow. Unlike ``checkpoint()`` the result is a
    columnar table: each consumer reads only its columns, and its size is known to the planner.
    """
    path = path or fresh_path(df.sparkSession, name)
    write_table(df, path, mode="errorifexists")
    return df.sparkSession.read.schema(df.schema).parquet(path)
