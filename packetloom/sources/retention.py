"""Deleting old packets from the dated log so that a crash at any point loses no row.

Days before the cutoff's day are dropped as folders. In the cutoff's own day only files that hold an expired row are
replaced: their other rows are written to a staging folder inside the log (readers skip names that begin with ``_``),
then one small file, the plan, appears by a rename. From then on the staged files count and the replaced ones do not,
wherever they lie: ``read_traffic_log`` asks for the plan. Moving staged files in and deleting replaced ones can stop
anywhere and is taken up by the next call. Files appended meanwhile are not in the plan and stay as they are.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom import schema

FOLDER, PLAN = "_retention", "plan.json"
DATED = schema.TRAFFIC_LOG + ", dt DATE"


class Files:
    """File operations on the log's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.root = path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str = "") -> list[str]:
        place = self._path(f"{self.root}/{folder}" if folder else self.root)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{name}"))

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(f"{self.root}/{old}"), self._path(f"{self.root}/{new}")):
            raise OSError(f"{old} could not be renamed to {new} in {self.root}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self._path(f"{self.root}/{folder}"))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(f"{self.root}/{name}"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


@dataclass
class Plan:
    """What is being replaced: the files ``old`` of a day by those staged in ``stage``."""

    day: str
    stage: str
    old: list[str]
    new: list[str]

    @property
    def moved(self) -> list[str]:
        """Names of the staged files in the day's folder."""
        return [f"{self.stage}-{name}" for name in self.new]


def current_plan(files: Files) -> Plan | None:
    name = f"{FOLDER}/{PLAN}"
    return Plan(**json.loads(files.read(name))) if files.exists(name) else None


def finish(files: Files) -> None:
    """Carry out a plan that is published, from wherever it stopped; then remove what no plan names."""
    plan = current_plan(files)
    if plan is not None:
        for name, moved in zip(plan.new, plan.moved):
            if files.exists(f"{FOLDER}/{plan.stage}/{name}"):
                files.make(f"dt={plan.day}")
                files.rename(f"{FOLDER}/{plan.stage}/{name}", f"dt={plan.day}/{moved}")
        for name in plan.old:
            files.delete(f"dt={plan.day}/{name}")
        files.delete(f"{FOLDER}/{PLAN}")
    for name in files.names(FOLDER):
        files.delete(f"{FOLDER}/{name}")


def live(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the log, each once, also while a deletion is under way."""
    logs = spark.read.schema(DATED).parquet(path)
    files = Files(spark, path)
    plan = current_plan(files)
    if plan is None:
        return logs
    replaced = (F.col("dt") == F.lit(plan.day).cast("date")) & F.col("_metadata.file_name").isin(plan.old)
    logs = logs.where(~F.coalesce(replaced, F.lit(False))) if plan.old else logs
    staged = [f"{files.root}/{FOLDER}/{plan.stage}/{n}" for n in plan.new if files.exists(f"{FOLDER}/{plan.stage}/{n}")]
    if not staged:
        return logs
    # a file that is named itself is read whatever its folder is called
    return logs.unionByName(spark.read.schema(schema.TRAFFIC_LOG).parquet(*staged).withColumn("dt", F.lit(plan.day).cast("date")))


def delete_expired(spark: SparkSession, path: str, days: float = 7, as_of: datetime | None = None) -> None:
    """Delete from the stored log what is older than ``as_of - days``; the cutoff itself stays.

    ``as_of`` is the newest packet's time by default. One deletion at a time; appends may go on. An empty log stays.
    """
    files = Files(spark, path)
    finish(files)
    logs = spark.read.schema(DATED).parquet(path)
    newest = as_of or logs.where(F.col("dt") == logs.agg(F.max("dt")).scalar()).agg(F.max("timestamp")).first()[0]
    if newest is None:
        return
    cutoff = newest - timedelta(days=days)
    edge = cutoff.date().isoformat()
    for name in files.names():
        if name.startswith("dt=") and name[3:] < edge:
            files.delete(name)
    day = logs.where(F.col("dt") == F.lit(edge).cast("date")).withColumn("_file", F.col("_metadata.file_name"))
    fresh = F.col("timestamp") >= F.lit(cutoff).cast("timestamp_ntz")
    # one name per file of a day
    old = sorted(r[0] for r in day.where(~fresh).select("_file").distinct().collect())
    if not old:
        return
    stage = os.urandom(8).hex()
    kept = day.where(fresh & F.col("_file").isin(old)).drop("_file", "dt")
    kept.hint("rebalance").sortWithinPartitions("src_ip", "timestamp").write.parquet(f"{files.root}/{FOLDER}/{stage}")
    new = [n for n in files.names(f"{FOLDER}/{stage}") if n.endswith(".parquet")]
    files.write(f"{FOLDER}/{stage}.json", json.dumps(Plan(edge, stage, old, new).__dict__))
    files.rename(f"{FOLDER}/{stage}.json", f"{FOLDER}/{PLAN}")
    finish(files)
