"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "packetloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every job here relies on.

    Nothing about cluster size is fixed here: partition counts, executor
    memory and ``spark.checkpoint.dir`` come from the submitting side.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[dict[str, str]]:
    """Session settings for the length of a block; gives the ones before, which come back after it."""
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield before
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a session on one machine may leave it unset; it gets a temporary
    folder, created once and remembered on the context. On a cluster that
    folder would be another one on every machine, so it is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None or named.rstrip("/") not in (current.rstrip("/"), os.path.dirname(current.rstrip("/"))):
            context.setCheckpointDir(named)
        return named
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="packetloom-"))
        current = context.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage and drop its lineage.

    Survives executor loss, unlike a local checkpoint; the files are removed
    when the frame goes out of scope if the cleaner is told to.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that writes a frame below the shared folder and reads it back; the tables go with the block.

    A reader of such a table reads only the columns it uses. Results that outlive the block must be cut inside it.
    """
    paths = []

    def store(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "table"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield store
    finally:
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{os.urandom(8).hex()}")
