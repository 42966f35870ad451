"""Reading and writing packet logs, alerts and resolutions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom import schema
from packetloom.sources import retention

LARGE_PACKET_BYTES = 10_000
LARGE_PACKET_SCALE = 50_000.0


# --- packet view over the event stream table -------------------------------

def packets_from_events(events: DataFrame) -> DataFrame:
    """The packet table derived from an ``events`` table, row by row.

    Purely projective, so column pruning and filters on ``event_id`` reach the
    scan and the work is proportional to the events read.
    """
    # Generated rather than projected: a filter on any derived column then stays above
    # this point instead of repeating the JSON extraction for each of its references.
    k = F.explode(F.array(F.get_json_object("props", "$.k").cast("int"))).alias("k")
    scanner = F.expr("event_id % 5 = 0")
    step1 = events.select(
        "event_id",
        F.when(scanner, F.lit(1).cast("bigint")).otherwise(F.col("user_id")).alias("s"),
        "event_type",
        "value",
        k,
    )
    step2 = step1.withColumn(
        "d0",
        F.when(scanner, F.col("k").cast("bigint"))
        .when(F.col("k").between(12, 15) & (F.col("s") < 64), F.lit(4).cast("bigint"))
        .otherwise(F.expr("s - s % 8 + k % 8")),
    )
    step3 = step2.withColumn("d", F.expr("CASE WHEN d0 = s THEN s - s % 8 + (s + 1) % 8 ELSE d0 END"))
    address = (
        "CASE WHEN {0} % 10 = 9 THEN '198.18.' ELSE '10.0.' END || CAST({0} DIV 250 AS STRING)"
        " || '.' || CAST({0} % 250 AS STRING)"
    )
    return step3.select(
        F.col("event_id").alias("id"),
        F.expr(
            "timestampadd(MICROSECOND, event_id * 50000 + k * 300 + (event_id DIV 400) * 7000000,"
            " TIMESTAMP_NTZ '2024-01-01 08:55:00')"
        ).alias("timestamp"),
        F.expr(address.format("s")).alias("src_ip"),
        F.expr(address.format("d")).alias("dst_ip"),
        F.expr(
            "CAST(CASE WHEN event_type = 'error' THEN 0 WHEN k % 10 = 0 THEN 53"
            " ELSE 1024 + (event_id * 7919) % 60000 END AS INT)"
        ).alias("src_port"),
        F.expr(
            "CAST(CASE WHEN event_type = 'error' THEN 0 WHEN k = 44 THEN 4444 WHEN k = 37 THEN 31337"
            " WHEN event_id % 5 = 0 THEN 1 + (event_id * 13) % 2000 WHEN k % 5 = 0 THEN 53"
            " WHEN k % 5 = 1 THEN 80 WHEN k % 5 = 2 THEN 443 WHEN k % 5 = 3 THEN 22 ELSE 3306 END AS INT)"
        ).alias("dst_port"),
        F.expr(
            "CASE event_type WHEN 'signup' THEN 'UDP' WHEN 'error' THEN 'ICMP' ELSE 'TCP' END"
        ).alias("protocol"),
        F.expr(
            "CAST(CASE WHEN k = 77 THEN 9000 + floor(value * 40) ELSE 40 + floor(value * 10) END AS BIGINT)"
        ).alias("packet_size"),
        F.expr(
            "CASE WHEN event_type IN ('signup', 'error') THEN NULL WHEN event_id % 5 = 0 OR k % 6 = 0 THEN 'SYN'"
            " WHEN k % 6 = 1 THEN 'ACK' WHEN k % 6 = 2 THEN 'SYN-ACK' WHEN k % 6 = 3 THEN 'FIN'"
            " WHEN k % 6 = 4 THEN 'RST' ELSE 'PSH-ACK' END"
        ).alias("flags"),
        F.expr("CASE WHEN k % 3 = 0 THEN 64 WHEN k % 3 = 1 THEN 128 ELSE 255 END").cast("int").alias("ttl"),
    )


def load_packets(spark: SparkSession, folder: str) -> DataFrame:
    return packets_from_events(spark.read.parquet(f"{folder}/events.parquet"))


# --- traffic log ------------------------------------------------------------

def flag_large_packets(
    logs: DataFrame, limit: int = LARGE_PACKET_BYTES, scale: float = LARGE_PACKET_SCALE
) -> DataFrame:
    """Mark oversized, not yet flagged rows; the score grows with the size up to 1."""
    hit = (F.col("packet_size") > limit) & ~F.col("is_anomaly")
    return logs.withColumns(
        {
            "anomaly_score": F.when(hit, F.least(F.lit(1.0), F.col("packet_size") / F.lit(scale))).otherwise(
                F.col("anomaly_score")
            ),
            "is_anomaly": F.col("is_anomaly") | hit,
        }
    )


def to_traffic_log(packets: DataFrame) -> DataFrame:
    """Packets as log rows: defaults filled, payload dropped, large packets flagged.

    Accepts stream-element naming (``size``) as well as log naming.
    """
    columns = packets.columns
    size = F.col("size") if "size" in columns else F.col("packet_size")
    return flag_large_packets(
        packets.select(
            "id",
            "timestamp",
            "src_ip",
            "dst_ip",
            F.coalesce("src_port", F.lit(0)).alias("src_port"),
            F.coalesce("dst_port", F.lit(0)).alias("dst_port"),
            "protocol",
            size.cast("bigint").alias("packet_size"),
            "flags",
            "ttl",
            (F.coalesce("is_anomaly", F.lit(False)) if "is_anomaly" in columns else F.lit(False)).alias("is_anomaly"),
            (F.coalesce("anomaly_score", F.lit(0.0)) if "anomaly_score" in columns else F.lit(0.0)).alias(
                "anomaly_score"
            ),
        )
    )


def from_traffic_log(logs: DataFrame) -> DataFrame:
    """Log rows as stream elements (``size``, no verdict columns)."""
    return logs.select(
        "id", "timestamp", "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
        F.col("packet_size").alias("size"), "flags", "ttl",
    )


def write_traffic_log(logs: DataFrame, path: str, mode: str = "append") -> None:
    """Append to the date-partitioned log.

    Days are rebalanced: adaptive execution splits a busy day into tasks of the
    advisory size and merges small ones, so the number of writers follows the
    data. Rows are sorted by source, so that file statistics prune IP lookups.
    """
    dated = logs.withColumn("dt", F.to_date("timestamp"))
    (
        dated.hint("rebalance", "dt")
        .sortWithinPartitions("dt", "src_ip", "timestamp")
        .write.mode(mode)
        .partitionBy("dt")
        .parquet(path)
    )


def read_traffic_log(spark: SparkSession, path: str) -> DataFrame:
    """The stored log; a missing score reads as 0. Keeps ``dt`` for pruning."""
    return (
        retention.live(spark, path)
        .withColumn("anomaly_score", F.coalesce("anomaly_score", F.lit(0.0)))
        .withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))
    )


# --- alerts -----------------------------------------------------------------

def write_alerts(alerts: DataFrame, path: str) -> None:
    alerts.write.mode("append").parquet(path)


def read_alerts(spark: SparkSession, path: str, resolutions: DataFrame | None = None) -> DataFrame:
    alerts = spark.read.schema(schema.ALERT).parquet(path).fillna(0, ["packet_count", "byte_count"])
    return current_alerts(alerts, resolutions) if resolutions is not None else alerts


def current_alerts(alerts: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Alert state: the log joined with the latest resolution of each alert."""
    latest = resolutions.groupBy("alert_id").agg(F.max("resolved_at").alias("resolved_at"))
    joined = alerts.join(latest, alerts["id"] == latest["alert_id"], "left").drop("alert_id")
    return joined.withColumn("is_resolved", F.col("resolved_at").isNotNull())
