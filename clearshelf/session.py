"""Session settings the operators assume."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods above 8,000 bytes: the widest projections run faster without
    # whole-stage code than in its interpreter.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def prefer_small_methods(spark: SparkSession) -> None:
    """Keep methods that the JVM would interpret out of generated code, unless the session has a limit."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, SETTINGS[key])


#: A row of narrow numbers in a broadcast table takes up to so many times its bytes in a compressed file.
_UNPACKED = 64


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Join sides go broadcast by the size that adaptive execution measures, not by the planner's guess.

    The guess takes bytes of compressed files for bytes in memory, and the driver holds every
    broadcast table. Inside, the guess is trusted only where the table fits the threshold unpacked.
    """
    guess, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {key: spark.conf.get(key, None) for key in (guess, measured)}
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if limit <= 0 or spark.conf.get("spark.sql.adaptive.enabled") != "true":
        yield
        return
    spark.conf.set(guess, str(limit // _UNPACKED))
    if before[measured] is None:
        spark.conf.set(measured, str(limit))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and ``bench.py``; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("clearshelf")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for functions that run there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
