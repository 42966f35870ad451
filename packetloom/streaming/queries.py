"""Streaming transformations: the live counterparts of the batch operators.

Functions named after an operator take a stream and return a stream. The
``run_*`` functions start a query until its input is used up and wait for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetloom.operators import alerts, detect, ordering
from packetloom.operators.detect import HIGH_RATE_PACKETS, PORT_SCAN_PORTS, SYN_FLOOD_SYNS
from packetloom.session import cut, scratch_path, settings
from packetloom.sources.packets import to_traffic_log
from packetloom.streaming.source import WATERMARK

USE_UP = {"availableNow": True}


def ingest(stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Packets as log rows, repeated deliveries of an id removed within the watermark."""
    return to_traffic_log(stream.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["id"]))


def rate(stream: DataFrame, window: str = "60 seconds", delay: str = WATERMARK, once: bool = False) -> DataFrame:
    """Packets and bytes per window and protocol.

    With ``once`` repeated deliveries count once, and packets later than the watermark are left out one by one, so the
    engine's count of them is a count of packets.
    """
    packets = stream.withWatermark("timestamp", delay)
    return (
        (packets.dropDuplicatesWithinWatermark(["id"]) if once else packets)
        .groupBy(F.window("timestamp", window).alias("w"), "protocol")
        .agg(F.count("*").alias("packets"), F.sum("packet_size").alias("bytes"))
        .select(F.col("w.start").alias("win"), "protocol", "packets", "bytes")
    )


def counting_rules(stream: DataFrame, window: str = "60 seconds", delay: str = WATERMARK) -> DataFrame:
    """(win, src_ip, rule) for port scan, high rate and SYN flood.

    These counters only grow within a window, so exceeding the threshold at its
    end is the same as crossing it once. Ports are counted by a first aggregation
    per port, so no state row holds a set and a busy source is spread by port.
    """
    syn = (F.col("protocol") == "TCP") & F.coalesce("flags", F.lit("")).contains("SYN")
    per_port = (
        stream.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", window), "src_ip", "dst_port")
        .agg(F.count("*").alias("n"), F.count_if(syn).alias("syns"))
    )
    per_source = per_port.groupBy("window", "src_ip").agg(
        F.count("*").alias("ports"), F.sum("n").alias("packets"), F.sum("syns").alias("syns")
    )
    rules = F.array_compact(
        F.array(
            F.when(F.col("ports") > PORT_SCAN_PORTS, "rule:port_scan"),
            F.when(F.col("packets") > HIGH_RATE_PACKETS, "rule:high_rate"),
            F.when(F.col("syns") > SYN_FLOOD_SYNS, "rule:syn_flood"),
        )
    )
    return per_source.select(F.col("window.start").alias("win"), "src_ip", F.explode(rules).alias("rule"))


def packet_rules(stream: DataFrame) -> DataFrame:
    """Suspicious ports and large packets, packet by packet, without state."""
    return detect.packet_rules(stream)


# --- running ----------------------------------------------------------------------

def run_append(
    result: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None, dated: str | None = None,
    started: Callable[[StreamingQuery], None] | None = None,
) -> DataFrame:
    """Append a stream to Parquet and wait for it; the written table.

    A run that is to continue another must name the same ``checkpoint`` (by
    default it lies beside the table). ``trigger`` is passed to the writer; the default uses the input up. With
    ``dated`` the table is partitioned by the day (``dt``) of that time column, as
    ``read_traffic_log`` expects. ``started`` is given the running query, for its id or its progress.
    """
    written = result if dated is None else result.withColumn("dt", F.to_date(dated))
    writer = written.writeStream.outputMode("append").format("parquet").option("path", path)
    if dated is not None:
        writer = writer.partitionBy("dt")
    query = writer.option("checkpointLocation", checkpoint or f"{path}-checkpoint").trigger(**(trigger or USE_UP)).start()
    if started is not None:
        started(query)
    query.awaitTermination()
    return result.sparkSession.read.schema(written.schema).parquet(path)


def run_batches(
    stream: DataFrame, each: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None,
    trigger: dict | None = None, started: Callable[[StreamingQuery], None] | None = None, shuffles: str | None = None,
) -> None:
    """Call ``each`` for every batch and wait; ``checkpoint``, ``trigger`` and ``started`` as in ``run_append``.

    A stream plans its state without adaptive execution, in a session of its own. Its part of a batch is planned before
    ``each`` is called, so the operators that ``each`` runs get back the settings of the caller's session for that time:
    adaptive execution, and ``shuffles`` as the number of shuffle partitions.
    """
    outer = stream.sparkSession.conf
    own = {key: outer.get(key) for key in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    if shuffles is not None:
        own["spark.sql.shuffle.partitions"] = shuffles

    def planned(batch: DataFrame, number: int) -> None:
        with settings(batch.sparkSession, own):
            each(batch, number)

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(planned)
        .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, "checkpoint"))
        .trigger(**(trigger or USE_UP))
        .start()
    )
    if started is not None:
        started(query)
    query.awaitTermination()


def append_new_alerts(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that appends only alerts whose id is not stored yet.

    A replayed batch adds nothing. Only the days of the batch are looked up.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # written out rather than persisted: a persisted frame keeps all shuffle partitions, each a file of the sink
        found = cut(
            alerts.escalate(alerts.from_detections(batch.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))))
            .dropDuplicates(["id"])
            .withColumn("dt", F.to_date("timestamp"))
        )
        span = found.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi")).first()
        if span["lo"] is not None:
            fresh = found
            if exists(spark, path):
                stored = spark.read.schema(found.schema).parquet(path).where(
                    F.col("dt").between(F.lit(span["lo"]), F.lit(span["hi"]))
                )
                fresh = found.join(stored.select("id"), "id", "left_anti")
            fresh.write.mode("append").partitionBy("dt").parquet(path)

    return write


def exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def remove(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def minute_rules(packets: DataFrame) -> DataFrame:
    """All rules but the statistical one over packets of whole minutes, for windows that have closed."""
    idx = ordering.with_global_index(packets)
    found = detect.packet_rules(packets)
    for more in (detect.port_scan(packets), detect.source_rules(packets), detect.ddos_10x(idx)):
        found = found.unionByName(more)
    return found


def run_top_k(stream: DataFrame, path: str, k: int = 5) -> DataFrame:
    """Sources by bytes sent so far; the table is rewritten after every batch."""
    totals = stream.groupBy("src_ip").agg(F.sum("packet_size").alias("total_bytes"))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.orderBy(F.desc("total_bytes"), "src_ip").limit(k).write.mode("overwrite").parquet(path)

    run_batches(totals, write, mode="complete", checkpoint=f"{path}-checkpoint")
    return stream.sparkSession.read.schema("src_ip STRING, total_bytes BIGINT").parquet(path)
