"""Operators that need the packets of a window together and in order, on a stream.

The engine holds the packets: ``hold`` keeps them in keyed list state until an event-time timer says that the watermark
has passed their window, then hands them on. Watermark, late packets, state and its clean-up, and recovery are the
engine's own. The keys are salts alone, a few per task: every window is split over all of them, so no task holds a busy
window alone, and the calls into state follow the keys and the packets, not the number of windows. All keys hand on a
window in one batch, as that depends on the watermark only. What is handed on goes through the distributed batch
operators.

Operators over windows have no state besides. Two operators go on across windows and store a few rows per batch, named
after the batch, so a replayed batch reads what it read before: the rolling statistics (the last ``frame`` packets) and
anchored windows (the packets of the window that is still open).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from packetloom import schema
from packetloom.functions import net
from packetloom.operators import detect, features, ordering
from packetloom.operators.anchored import anchored_windows
from packetloom.operators.ordering import Indexed
from packetloom.session import settings
from packetloom.streaming.queries import exists, minute_rules, remove, run_batches
from packetloom.streaming.source import WATERMARK

SALTS = 8  # keys of state per task
TILE = 10  # seconds that operators without windows of their own wait for
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_SHUFFLES = "spark.sql.shuffle.partitions"

Write = Callable[[DataFrame, int], None]


class _Hold(StatefulProcessor):
    """Packets of one salt until the watermark passes the ends of their windows.

    An entry of the map holds up to an Arrow batch of packets as bytes, under its least and greatest window, so state is
    read and written in few large pieces and entries that stay open are left alone. One timer per
    key waits for the earliest window that is held.
    """

    def __init__(self, width_us: int):
        self.width_us = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "low BIGINT, high BIGINT, n BIGINT", "packets BINARY")
        self.next = handle.getValueState("next", "n BIGINT, at BIGINT")  # number of the next entry, time of the timer

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            if len(pdf):
                self._put(pa.Table.from_pandas(pdf[[*schema.PACKET_COLUMNS, "window_us"]], preserve_index=False))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        last = passed - self.width_us  # the last window that has closed
        n = self.next.get()[0]
        self.next.update((n, None))
        open_windows = []
        for entry in list(self.rows.keys()):
            low, high, _ = entry
            if low > last:
                open_windows.append(low)
                continue
            held = pa.ipc.open_stream(self.rows.getValue(entry)[0]).read_all()
            self.rows.removeKey(entry)
            if high > last:
                self._put(held.filter(pc.greater(held["window_us"], last)))
                held = held.filter(pc.less_equal(held["window_us"], last))
            yield held.to_pandas().assign(passed_us=passed)
        if open_windows:
            self._wait_for(min(open_windows))

    def _put(self, table: pa.Table) -> None:
        span = pc.min_max(table["window_us"]).as_py()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        n, at = self.next.get() or (0, None)
        self.rows.updateValue((span["min"], span["max"], n), (sink.getvalue().to_pybytes(),))
        self.next.update((n + 1, at))
        self._wait_for(span["min"])

    def _wait_for(self, window_us: int) -> None:
        at = -(-(window_us + self.width_us) // 1000)
        n, known = self.next.get()
        if known is not None and known <= at:
            return
        if known is not None:
            self.handle.deleteTimer(known)
        self.handle.registerTimer(at)
        self.next.update((n, at))

    def close(self) -> None:
        pass


def _tasks(spark: SparkSession) -> int:
    """Tasks that hold packets: as many as cores, at most the shuffle partitions; fixed by a stream's first batch."""
    return min(int(spark.conf.get(_SHUFFLES)), max(spark.sparkContext.defaultParallelism, 8))


def hold(stream: DataFrame, seconds: int, slide: int | None = None, salts: int | None = None, delay: str = WATERMARK) -> DataFrame:
    """The packets of every aligned window once it has closed, with ``window_us`` and the watermark ``passed_us``.

    With ``slide`` a packet is handed on once for every window that it lies in. Packets that come after the watermark
    has passed them are dropped and counted by the engine. ``salts`` keys hold the packets, by default SALTS a task.
    """
    salts = salts or SALTS * _tasks(stream.sparkSession)
    step = (slide or seconds) * 1_000_000
    width = seconds * 1_000_000
    moment = F.unix_micros("timestamp")
    last = moment - F.pmod(moment, F.lit(step))
    starts = F.transform(F.sequence(F.lit(0), F.lit(ceil(width / step) - 1)), lambda k: last - k * F.lit(step))
    rows = stream.withWatermark("timestamp", delay).select(
        *schema.PACKET_COLUMNS,
        F.explode(F.filter(starts, lambda s: s + F.lit(width) > moment)).alias("window_us"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"),
    )
    kinds = schema.PACKET.replace("TIMESTAMP_NTZ", "TIMESTAMP") + ", window_us BIGINT, passed_us BIGINT"
    return rows.groupBy("salt").transformWithStateInPandas(_Hold(width), kinds, "append", "eventTime")


def _moment(micros: str) -> F.Column:
    return F.timestamp_add("MICROSECOND", F.col(micros), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def _run(held: DataFrame, each: Callable[[DataFrame, int], None], path: str, trigger: dict | None) -> None:
    """Give every batch of held packets to ``each``, cached, as operators read it more than once."""
    spark = held.sparkSession

    def once(batch: DataFrame, number: int) -> None:
        rows = batch.select(
            "*", _moment("window_us").alias("window_start")).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).persist()
        each(rows, number)
        rows.unpersist()

    with settings(spark, {_PROVIDER: STATE_STORE, _SHUFFLES: str(_tasks(spark))}) as before:
        run_batches(held, once, checkpoint=f"{path}/checkpoint", trigger=trigger, shuffles=before[_SHUFFLES])


def _sink(path: str, write: Write | None) -> Write:
    return write or (lambda rows, number: rows.write.mode("overwrite").parquet(f"{path}/out/epoch={number}"))


def _written(spark: SparkSession, path: str, write: Write | None) -> DataFrame | None:
    return spark.read.parquet(f"{path}/out").drop("epoch") if write is None else None


def run_windows(
    stream: DataFrame, operator: Callable[[DataFrame], DataFrame], path: str, seconds: int = 60, slide: int | None = None,
    write: Write | None = None, trigger: dict | None = None, salts: int | None = None,
) -> DataFrame | None:
    """Apply a batch ``operator`` to the packets of windows as they close; its rows carry ``window_start``.

    The operator must treat windows independently. Its rows go to ``path/out``, whose table is returned, or to ``write``.
    A later call with the same ``path`` continues.
    """
    out = _sink(path, write)

    def each(rows: DataFrame, number: int) -> None:
        if not rows.isEmpty():
            out(operator(rows), number)

    _run(hold(stream, seconds, slide, salts), each, path, trigger)
    return _written(stream.sparkSession, path, write)


def run_features(
    stream: DataFrame, path: str, seconds: int = 60, slide: int | None = None, trigger: dict | None = None, salts: int | None = None,
) -> DataFrame:
    """The 22 features of tumbling or sliding windows."""
    return run_windows(stream, features.features_of_windows, path, seconds, slide, trigger=trigger, salts=salts)


class _Carried:
    """A few packets that one batch leaves to the next, in a folder per batch."""

    def __init__(self, spark: SparkSession, path: str, kinds: str):
        self.spark, self.path, self.kinds = spark, path, kinds

    def before(self, number: int) -> DataFrame:
        """What the batch before left; none at the beginning. A folder that is gone is an error, not a beginning."""
        folder = f"{self.path}/epoch={number - 1}"
        if number and not exists(self.spark, folder):
            raise FileNotFoundError(f"{folder} is needed to go on after batch {number - 1}")
        return self.spark.read.schema(self.kinds).parquet(folder) if number else self.spark.createDataFrame([], self.kinds)

    def leave(self, rows: DataFrame, number: int) -> None:
        rows.select(*[c.split()[0] for c in self.kinds.split(", ")]).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/epoch={number}")
        remove(self.spark, f"{self.path}/epoch={number - 2}")  # no replay goes back as far


def _rolling(spark: SparkSession, path: str, frame: int, write: Write) -> Callable[[DataFrame, int], None]:
    tail = _Carried(spark, f"{path}/tail", schema.PACKET + ", i BIGINT")

    def each(rows: DataFrame, number: int) -> None:
        before = tail.before(number)
        if rows.isEmpty():
            return tail.leave(before, number)
        count, seen = before.agg(F.count("*"), F.coalesce(F.max("i"), F.lit(0))).first()
        idx = ordering.with_global_index(rows.select(*schema.PACKET_COLUMNS).unionByName(before.drop("i")))
        # positions go on over the whole stream; the packets of the tail keep theirs
        placed = Indexed(idx.df.withColumn("i", F.col("i") + F.lit(seen - count)), idx.block_rows, idx.total)
        fresh = placed.df.where(F.col("i") > seen).select(F.col("id").alias("packet_id"))
        write(detect.statistical(placed, frame).join(fresh, "packet_id", "left_semi"), number)
        tail.leave(placed.df.where(F.col("i") > seen - count + idx.total - frame), number)

    return each


def run_rolling(
    stream: DataFrame, path: str, frame: int = 1000, trigger: dict | None = None, write: Write | None = None,
) -> DataFrame | None:
    """The statistical detector live: every packet against the last ``frame``, as slices of TILE seconds close."""
    _run(hold(stream, TILE), _rolling(stream.sparkSession, path, frame, _sink(path, write)), path, trigger)
    return _written(stream.sparkSession, path, write)


def run_anchored(
    stream: DataFrame, path: str, seconds: float = 5.0, trigger: dict | None = None, write: Write | None = None,
) -> DataFrame | None:
    """The 22 features of anchored windows, live: a window comes out once the watermark has passed its end.

    The packets of the window that is still open are left to the next batch, where it opens again at its first packet.
    """
    spark, out = stream.sparkSession, _sink(path, write)
    open_window = _Carried(spark, f"{path}/open", schema.PACKET)
    width = int(round(seconds * 1_000_000))

    def each(rows: DataFrame, number: int) -> None:
        before = open_window.before(number)
        if rows.isEmpty():
            return open_window.leave(before, number)
        # all packets before the slice in which the watermark lies are here
        passed = rows.agg(F.max("passed_us")).first()[0]
        complete = passed - passed % (TILE * 1_000_000)
        idx = ordering.with_global_index(rows.select(*schema.PACKET_COLUMNS).unionByName(before))
        windows = anchored_windows(idx, seconds)
        closed = net.micros("window_start") + F.lit(width) < F.lit(complete)
        found = features.features(windows, ["window_start"])
        out(found.where(closed), number)
        open_window.leave(windows.df.where(~closed), number)

    _run(hold(stream, TILE), each, path, trigger)
    return _written(spark, path, write)


def run_alerts(stream: DataFrame, path: str, write: Write, frame: int = 1000, trigger: dict | None = None) -> None:
    """All detections of a stream into one sink: the rules of closed minutes and the statistical detector.

    Both see every batch, one after the other, so two writers never append to the sink at once. ``write`` must take a
    replay, as ``append_new_alerts`` does.
    """
    statistical = _rolling(stream.sparkSession, path, frame, write)

    def each(rows: DataFrame, number: int) -> None:
        if not rows.isEmpty():
            write(minute_rules(rows), number)
        statistical(rows, number)

    _run(hold(stream, 60), each, path, trigger)
