"""Packet streams: reading them, and staging a stored table as one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom import schema
from packetloom.session import scratch_path

WATERMARK = "30 seconds"
SENTINEL_ID = -1
SENTINEL_TIME = "2099-01-01 00:00:00"


def read_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of packet files as a stream. Back-pressure instead of dropped packets.

    Event time is cast to TIMESTAMP because watermarks need it.
    """
    return _typed(
        spark.readStream.schema(schema.PACKET)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def read_kafka(spark: SparkSession, servers: str, topic: str, offsets_per_trigger: int = 1_000_000) -> DataFrame:
    """JSON packets from a Kafka topic (needs the Kafka connector on the class path)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", offsets_per_trigger)
        .load()
    )
    return _typed(raw.select(F.from_json(F.col("value").cast("string"), schema.PACKET).alias("p")).select("p.*"))


def _typed(stream: DataFrame) -> DataFrame:
    return stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def stage(packets: DataFrame, slices: int = 4, files: int = 2, extra: DataFrame | None = None) -> str:
    """Write a packet table as a replayable stream: ``slices`` consecutive spans of time.

    Each span is one append of exactly ``files`` files, so reading ``files`` per
    trigger replays the spans in order. ``extra`` rows (late or repeated packets)
    come after the last span. A final sentinel packet far in the future lets all
    windows close.
    """
    spark = packets.sparkSession
    path = scratch_path(spark, "stream")
    table = packets.select(*schema.PACKET_COLUMNS)
    low, high = table.agg(F.min("timestamp"), F.max("timestamp")).first()
    width = (high - low) / slices
    for k in range(slices):
        part = table
        if k > 0:
            part = part.where(F.col("timestamp") > F.lit(low + k * width).cast("timestamp_ntz"))
        if k < slices - 1:
            part = part.where(F.col("timestamp") <= F.lit(low + (k + 1) * width).cast("timestamp_ntz"))
        part.repartition(files).write.mode("append").parquet(path)
    if extra is not None:
        extra.select(*schema.PACKET_COLUMNS).repartition(files).write.mode("append").parquet(path)
    sentinel = spark.range(1).select(
        F.lit(SENTINEL_ID).cast("bigint").alias("id"),
        F.lit(SENTINEL_TIME).cast("timestamp_ntz").alias("timestamp"),
        F.lit("0.0.0.0").alias("src_ip"),
        F.lit("0.0.0.0").alias("dst_ip"),
        F.lit(0).alias("src_port"),
        F.lit(0).alias("dst_port"),
        F.lit("NONE").alias("protocol"),
        F.lit(0).cast("bigint").alias("packet_size"),
        F.lit(None).cast("string").alias("flags"),
        F.lit(0).alias("ttl"),
    )
    sentinel.coalesce(1).write.mode("append").parquet(path)
    return path
