"""Late packets of a query, counted over its whole life.

A query's own progress holds its last 100 reports. The counter listens to all of them and keeps its sum in a folder, by
the query's id, which stays the same over restarts from one checkpoint. A batch that is replayed after a failure reports
again and replaces what it had reported.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from packetloom.streaming.queries import exists


class LateRows(StreamingQueryListener):
    """Adds up ``numRowsDroppedByWatermark`` of all stateful operators, per query id, below ``folder``.

    Two files per query take turns, so one is whole whatever happens while the other is written. Operators that
    aggregate in the tasks first report groups, not packets; a deduplication or ``hold`` before them counts packets.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.note(str(progress.id), progress.batchId, sum(op.numRowsDroppedByWatermark for op in progress.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def note(self, query: str, batch: int, rows: int) -> None:
        last = self._last(query)
        if batch < last["batch"] or not rows and batch > last["batch"]:
            return
        before = last["before"] if batch == last["batch"] else last["before"] + last["rows"]
        turn = last["turn"] if batch == last["batch"] else 1 - last["turn"]
        self._write(f"{self.folder}/{query}-{turn}.json", {"batch": batch, "before": before, "rows": rows, "turn": turn})

    def total(self, query: str) -> int:
        last = self._last(query)
        return last["before"] + last["rows"]

    def _last(self, query: str) -> dict:
        found = [{"batch": -1, "before": 0, "rows": 0, "turn": 1}]
        for turn in (0, 1):
            path = f"{self.folder}/{query}-{turn}.json"
            if exists(self.spark, path):
                try:
                    found.append(json.loads(self._read(path)))
                except ValueError:
                    pass  # cut short while it was written; the other one holds
        return max(found, key=lambda s: s["batch"])

    def _file(self, path: str):
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self.spark._jsc.hadoopConfiguration()), location

    def _read(self, path: str) -> str:
        files, location = self._file(path)
        stream = files.open(location)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, path: str, state: dict) -> None:
        files, location = self._file(path)
        stream = files.create(location, True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()


@contextmanager
def counted(spark: SparkSession, folder: str) -> Iterator[LateRows]:
    """Listen while queries run; when the block ends all their reports have been added."""
    counter = LateRows(spark, folder)
    spark.streams.addListener(counter)
    try:
        yield counter
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(counter)
