"""Session settings the library relies on, and the one place that cuts lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from cratewise.sources.folders import Folder

# Timestamps land as ISO-8601 text in UTC, so the session reads and prints UTC.
# Many-to-one joins lean on AQE to split a hot key; `force` lets it do so even where
# a later operator would have liked the partitioning kept.
# ANSI mode makes a bad value in a strict cast stop the query.
# Batches for Python tasks are bounded by bytes, because texts differ much in length.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# How intermediate tables are written. Rows of more columns than this would be read and written
# by one large generated method, which the JVM runs slowly until it has compiled it, for 4 to 10
# seconds and often twice a stage; without it their expressions are compiled as many small ones.
# Timestamps as whole microseconds take 8 bytes, not the 12 of Spark's default, and are as exact.
COPY_SETTINGS = {
    "spark.sql.codegen.maxFields": "30",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# For jobs that store about as much as they read several times over: files take less room, and
# the shuffle files of a write go with its end, not when the driver happens to collect their owners.
TIGHT_SETTINGS = {"spark.sql.parquet.compression.codec": "zstd", _CLEANUP: "true"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session and return it."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share for stored intermediate results.

    It is the cluster's ``spark.checkpoint.dir``. Only a local session that names none
    gets a scratch folder, which goes when the process ends; a cluster session without one
    is an error.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="checkpoints-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


@contextmanager
def using(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the time of some actions; then those from before."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def checkpointed(df: DataFrame, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored copy, lineage cut.

    With ``release`` the shuffle files it was made from are deleted with the end of the job,
    not when the driver happens to collect their owners; for steps that shuffle about as much
    as the input.
    """
    conf = df.sparkSession.conf
    shared_folder(df.sparkSession)
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true" if release else before)
    try:
        return df.checkpoint(eager=True)
    finally:
        conf.set(_CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return what reads it back.

    Unlike a checkpoint, readers take only the columns they need.
    """
    spark = df.sparkSession
    return copied(df, f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}", "error")


def copied(df: DataFrame, path: str, mode: str) -> DataFrame:
    """Write ``df`` as Parquet for the library's own use and return what reads it back."""
    spark = df.sparkSession
    with using(spark, COPY_SETTINGS):
        df.write.mode(mode).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete stored copies that nothing reads any more."""
    for df in tables:
        for folder in {os.path.dirname(unquote(path)) for path in df.inputFiles()}:
            if not os.path.basename(folder).startswith("stored-"):
                raise ValueError(f"no stored copy: {folder}")
            Folder(df.sparkSession, folder).delete()
