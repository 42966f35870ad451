"""Alerts derived from detections, their state and reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALERT_ID_FACTOR = 16


def describe(details: Column) -> Column:
    return F.array_join(
        F.transform(F.map_entries(details), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", "
    )


def alert_type(method: Column) -> Column:
    return (
        F.when(method.contains("port_scan"), "port_scan")
        .when(method.contains("ddos") | method.contains("high_rate") | method.contains("syn_flood"), "ddos_suspect")
        .when(method.contains("large_packet"), "large_packet")
        .otherwise("anomaly")
    )


def severity(score: Column) -> Column:
    return F.when(score >= 0.8, 4).when(score >= 0.6, 3).when(score >= 0.4, 2).otherwise(1)


def escalate(alerts: DataFrame, at_least: int = 3) -> DataFrame:
    """Stamp severe alerts; the stamp is the event time, so reruns agree."""
    stamp = F.concat(
        "description", F.lit(" [AUTO-ESCALATED at "), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("]")
    )
    return alerts.withColumn("description", F.when(F.col("severity") >= at_least, stamp).otherwise(F.col("description")))


def from_detections(detections: DataFrame) -> DataFrame:
    """One alert per detection; the id follows from packet and rule, so replays collide."""
    return detections.select(
        (F.col("packet_id") * ALERT_ID_FACTOR + F.col("rule_order")).alias("id"),
        "timestamp",
        alert_type(F.col("detection_method")).alias("alert_type"),
        severity(F.col("score")).alias("severity"),
        F.get("related_ips", F.lit(0)).alias("src_ip"),
        F.get("related_ips", F.lit(1)).alias("dst_ip"),
        describe(F.col("details")).alias("description"),
        F.lit(0).cast("bigint").alias("packet_count"),
        F.lit(0).cast("bigint").alias("byte_count"),
    )


def resolve(alerts: DataFrame, chosen: Column, delay_minutes: int = 0) -> DataFrame:
    """Resolution rows for the chosen alerts, to be appended to the resolution log."""
    return alerts.where(chosen).select(
        F.col("id").alias("alert_id"),
        (F.col("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(delay_minutes))).alias("resolved_at"),
    )


def recent(alerts: DataFrame, limit: int = 50) -> DataFrame:
    return alerts.orderBy(F.desc("timestamp"), F.desc("id")).limit(limit)


def unresolved(alerts: DataFrame, resolutions: DataFrame, limit: int | None = 50) -> DataFrame:
    open_alerts = alerts.join(
        resolutions.select("alert_id").distinct(), alerts["id"] == F.col("alert_id"), "left_anti"
    ).orderBy(F.desc("severity"), F.desc("timestamp"), F.desc("id"))
    return open_alerts if limit is None else open_alerts.limit(limit)


def by_type_severity(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_type", "severity").agg(F.count("*").alias("alerts"))


def rollup_type_severity(alerts: DataFrame) -> DataFrame:
    return alerts.rollup("alert_type", "severity").agg(F.count("*").alias("alerts"))


def metrics(alerts: DataFrame, packets: DataFrame) -> DataFrame:
    n = packets.agg(F.count("*")).scalar()
    return alerts.agg(F.count("*").alias("alert_count")).select(
        "alert_count",
        n.alias("packet_count"),
        F.round(100.0 * F.col("alert_count") / F.greatest(n, F.lit(1)), 6).alias("alert_rate_percent"),
    )


def flagged_ips(alerts: DataFrame, scanners: DataFrame, targets: DataFrame, limit: int | None = None) -> DataFrame:
    """Addresses named by alerts, scanners or targets: count, worst severity, reasons.

    The three sources are stacked as long rows and grouped once, which costs one
    shuffle instead of two outer joins. All alerts count; a screen may pass a
    ``limit`` to consider the newest only.
    """
    chosen = alerts if limit is None else recent(alerts, limit)
    named = chosen.select(
        F.explode(F.array_compact(F.array("src_ip", "dst_ip"))).alias("ip"),
        F.lit(1).alias("alerts"),
        "severity",
        F.col("alert_type").alias("reason"),
    )

    def hint(df: DataFrame, level: int, reason: str) -> DataFrame:
        return df.select(
            "ip", F.lit(0).alias("alerts"), F.lit(level).alias("severity"), F.lit(reason).alias("reason")
        )

    return (
        named.unionByName(hint(scanners, 2, "port_scan"))
        .unionByName(hint(targets, 3, "ddos_suspect"))
        .groupBy("ip")
        .agg(
            F.sum("alerts").alias("alert_count"),
            F.max("severity").alias("highest_severity"),
            F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("reasons"),
        )
        .orderBy(F.desc("highest_severity"), "ip")
    )
