"""Registered queries: ordered operators, detectors and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.operators import alerts, detect, graph, ml_detect, ordering, traffic
from packetloom.plans.detect_sql import ALERTS, DETECTIONS, EMIT, ROLL_SQL, RULES_SQL, STATISTICAL_SQL
from packetloom.plans.registry import LOGS_SQL, query
from packetloom.session import cut, scratch_path
from packetloom.sources.packets import current_alerts, load_packets, read_alerts, to_traffic_log, write_alerts

LEAN = ["id", "timestamp", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "packet_size", "flags"]


def _index(spark, sf, columns=LEAN):
    return ordering.with_global_index(load_packets(spark, sf).select(*columns))


def _show(detections):
    return detections.select(
        "packet_id", "timestamp", "src_ip", "dst_ip", "detection_method", "rule_order",
        F.round("score", 6).alias("score"),
        F.array_join("related_ips", ",").alias("related_ips"),
        alerts.describe(F.col("details")).alias("description"),
    )


def _alerts(spark, sf):
    """The alert table, written once: queries that read it twice do not detect twice."""
    return cut(alerts.from_detections(detect.detect_all(load_packets(spark, sf))))


# --- order ----------------------------------------------------------------------

@query("global_index", "SELECT id, i FROM ix", ROLL_SQL)
def global_index(spark, sf):
    return _index(spark, sf, ["id", "timestamp"]).df.select("id", "i")


@query("inter_arrival", "SELECT id, iat_us FROM ix", ROLL_SQL)
def inter_arrival(spark, sf):
    return ordering.inter_arrival(_index(spark, sf, ["id", "timestamp"])).df.select("id", "iat_us")


@query(
    "inter_arrival_by_src",
    """SELECT id, src_ip, date_diff('microsecond', lag(timestamp) OVER (PARTITION BY src_ip ORDER BY timestamp, id),
    timestamp) AS iat_us FROM packets""",
)
def inter_arrival_by_src(spark, sf):
    idx = _index(spark, sf, ["id", "timestamp", "src_ip"])
    return ordering.inter_arrival(idx, ["src_ip"]).df.select("id", "src_ip", "iat_us")


@query(
    "rolling_stats",
    """SELECT id, n, size_mean, size_std, iat_n, iat_mean, round(iat_std, 6) AS iat_std FROM roll""",
    ROLL_SQL,
)
def rolling_stats(spark, sf):
    stats = detect.rolling_stats(_index(spark, sf))
    return stats.select("id", "n", "size_mean", "size_std", "iat_n", "iat_mean", F.round("iat_std", 6).alias("iat_std"))


@query("running_src_count", "SELECT id, win, src_ip, src_count FROM rc", RULES_SQL)
def running_src_count(spark, sf):
    return detect.running_source_counts(_index(spark, sf, ["id", "timestamp", "src_ip"])).df.select(
        "id", "win", "src_ip", "src_count"
    )


@query("running_distinct_ports", "SELECT id, win, src_ip, unique_ports FROM rc", RULES_SQL)
def running_distinct_ports(spark, sf):
    idx = _index(spark, sf, ["id", "timestamp", "src_ip", "dst_port"])
    return detect.running_distinct_ports(idx).df.select("id", "win", "src_ip", "unique_ports")


@query("every_nth", "SELECT id, i FROM ix WHERE i % 10 = 0", ROLL_SQL)
def every_nth(spark, sf):
    return ordering.every_nth(_index(spark, sf, ["id", "timestamp"]), 10).select("id", "i")


LAST_SQL = """SELECT id, i, array_to_string(list_sort(list_distinct(list_concat(s, d))), ',') AS related FROM (
    SELECT id, i, list(src_ip) OVER w AS s, list(dst_ip) OVER w AS d FROM ix
    WINDOW w AS (ORDER BY i ROWS 9 PRECEDING)) q"""


def _related(spark, sf, every):
    rows = ml_detect.recent_endpoints(_index(spark, sf, ["id", "timestamp", "src_ip", "dst_ip"]), 10, every)
    return rows.select("id", "i", F.array_join("related", ",").alias("related"))


@query("last10_ips", LAST_SQL, ROLL_SQL)
def last10_ips(spark, sf):
    return _related(spark, sf, 1)


@query("related_ips", LAST_SQL + " WHERE i % 10 = 0", ROLL_SQL)
def related_ips(spark, sf):
    """As the model detector names them, at every tenth packet."""
    return _related(spark, sf, 10)


@query(
    "chrono_split",
    """SELECT CASE WHEN i <= (SELECT count(*) * 80 // 100 FROM packets) THEN 'train' ELSE 'test' END AS part,
    count(*) AS n, min(id) AS first_id, max(timestamp) AS last_seen FROM ix GROUP BY 1""",
    ROLL_SQL,
)
def chrono_split(spark, sf):
    train, test = ordering.chronological_split(_index(spark, sf, ["id", "timestamp"]))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("timestamp").alias("last_seen")
    )


# --- detectors --------------------------------------------------------------------

@query("detect_statistical", EMIT.format("d_stat"), [ROLL_SQL, STATISTICAL_SQL])
def detect_statistical(spark, sf):
    return _show(detect.statistical(_index(spark, sf)))


def _rule(name, table, run):
    @query(name, EMIT.format(table), RULES_SQL)
    def registered(spark, sf):
        return _show(run(load_packets(spark, sf)))


_rule("detect_suspicious_port", "d_port", detect.suspicious_port)
_rule("detect_large_packet", "d_large", detect.large_packet)
_rule("detect_port_scan", "d_scan", detect.port_scan)
_rule("detect_high_rate", "d_rate", detect.high_rate)
_rule("detect_syn_flood", "d_syn", detect.syn_flood)


@query("detect_ddos_10x", EMIT.format("d_ddos"), RULES_SQL)
def detect_ddos_10x(spark, sf):
    return _show(detect.ddos_10x(_index(spark, sf, ["id", "timestamp", "src_ip", "dst_ip"])))


@query("detect_all", EMIT.format("det"), DETECTIONS)
def detect_all(spark, sf):
    return _show(detect.detect_all(load_packets(spark, sf)))


@query(
    "aggregate_score",
    """SELECT packet_id, count(*) AS detections, round(least(1.0::DOUBLE,
    sum(score * w) / greatest(sum(w), 1.0)), 6) AS aggregate_score
    FROM (SELECT *, CASE WHEN detection_method = 'statistical' THEN 0.3::DOUBLE ELSE 0.4::DOUBLE END AS w FROM det) q
    GROUP BY 1""",
    DETECTIONS,
)
def aggregate_score(spark, sf):
    scored = detect.aggregate_score(detect.detect_all(load_packets(spark, sf)))
    return scored.withColumn("aggregate_score", F.round("aggregate_score", 6))


@query(
    "detector_stats",
    """SELECT (SELECT count(*) FROM packets) AS total_packets_checked, count(*) AS anomalies_detected,
    round(count(*) / greatest((SELECT count(*) FROM packets), 1), 6) AS anomaly_rate, true AS statistical_enabled,
    true AS rule_enabled, false AS ml_enabled FROM det""",
    DETECTIONS,
)
def detector_stats(spark, sf):
    packets = load_packets(spark, sf)
    return detect.detector_stats(detect.detect_all(packets), packets).withColumn(
        "anomaly_rate", F.round("anomaly_rate", 6)
    )


@query(
    "recent_detections",
    EMIT.format("(SELECT * FROM det ORDER BY timestamp DESC, packet_id DESC, rule_order DESC LIMIT 20) q"),
    DETECTIONS,
)
def recent_detections(spark, sf):
    return _show(detect.recent_detections(detect.detect_all(load_packets(spark, sf)), 20))


# --- alerts -------------------------------------------------------------------------

@query("alert_from_detection", "SELECT * FROM alerts", ALERTS)
def alert_from_detection(spark, sf):
    return _alerts(spark, sf)


ESCALATED_SQL = """CASE WHEN severity >= 3 THEN description || ' [AUTO-ESCALATED at '
    || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || ']' ELSE description END AS description"""


@query("alert_escalate", f"SELECT id, severity, {ESCALATED_SQL} FROM alerts", ALERTS)
def alert_escalate(spark, sf):
    return alerts.escalate(_alerts(spark, sf)).select("id", "severity", "description")


@query("alerts_from_traffic", f"SELECT * REPLACE ({ESCALATED_SQL}) FROM alerts", ALERTS)
def alerts_from_traffic(spark, sf):
    """Detection, alert and escalation in one job, as appended to the alert log."""
    return alerts.escalate(_alerts(spark, sf))


@query(
    "scan_alerts",
    """SELECT a.id, timestamp, alert_type, severity, coalesce(packet_count, 0) AS packet_count,
    CASE WHEN a.id % 3 = 0 THEN timestamp + INTERVAL 5 MINUTE END AS resolved_at, a.id % 3 = 0 AS is_resolved
    FROM alerts a""",
    ALERTS,
)
def scan_alerts(spark, sf):
    """The stored alert log with its resolutions."""
    path = scratch_path(spark, "alerts")
    write_alerts(_alerts(spark, sf), path)
    stored = read_alerts(spark, path)
    state = read_alerts(spark, path, alerts.resolve(stored, F.expr("id % 3 = 0"), 5))
    return state.select("id", "timestamp", "alert_type", "severity", "packet_count", "resolved_at", "is_resolved")


@query(
    "resolve_alert",
    """SELECT is_resolved, count(*) AS alerts, max(resolved_at) AS last_resolved FROM (
    SELECT id % 3 = 0 AS is_resolved, CASE WHEN id % 3 = 0 THEN timestamp + INTERVAL 9 MINUTE END AS resolved_at
    FROM alerts) q GROUP BY 1""",
    ALERTS,
)
def resolve_alert(spark, sf):
    """Resolving twice keeps the later time."""
    table = _alerts(spark, sf)
    chosen = F.expr("id % 3 = 0")
    log = alerts.resolve(table, chosen, 5).unionByName(alerts.resolve(table, chosen, 9))
    return current_alerts(table, log).groupBy("is_resolved").agg(
        F.count("*").alias("alerts"), F.max("resolved_at").alias("last_resolved")
    )


@query(
    "alerts_unresolved",
    """SELECT id, timestamp, alert_type, severity, src_ip, dst_ip FROM alerts WHERE id % 3 <> 0
    ORDER BY severity DESC, timestamp DESC, id DESC LIMIT 50""",
    ALERTS,
)
def alerts_unresolved(spark, sf):
    table = _alerts(spark, sf)
    still = alerts.unresolved(table, alerts.resolve(table, F.expr("id % 3 = 0")))
    return still.select("id", "timestamp", "alert_type", "severity", "src_ip", "dst_ip")


@query(
    "recent_alerts",
    """SELECT id, timestamp, alert_type, severity, src_ip, dst_ip FROM alerts
    ORDER BY timestamp DESC, id DESC LIMIT 50""",
    ALERTS,
)
def recent_alerts(spark, sf):
    return alerts.recent(_alerts(spark, sf)).select("id", "timestamp", "alert_type", "severity", "src_ip", "dst_ip")


@query(
    "alerts_by_type_severity",
    "SELECT alert_type, severity, count(*) AS alerts FROM alerts GROUP BY 1, 2",
    ALERTS,
)
def alerts_by_type_severity(spark, sf):
    return alerts.by_type_severity(_alerts(spark, sf))


@query(
    "alerts_rollup",
    "SELECT alert_type, severity, count(*) AS alerts FROM alerts GROUP BY ROLLUP (alert_type, severity)",
    ALERTS,
)
def alerts_rollup(spark, sf):
    return alerts.rollup_type_severity(_alerts(spark, sf))


@query(
    "alert_metrics",
    """SELECT count(*) AS alert_count, (SELECT count(*) FROM packets) AS packet_count,
    round(100.0::DOUBLE * count(*) / greatest((SELECT count(*) FROM packets), 1), 6) AS alert_rate_percent
    FROM alerts""",
    ALERTS,
)
def alert_metrics(spark, sf):
    return alerts.metrics(_alerts(spark, sf), load_packets(spark, sf))


@query(
    "table_stats",
    """SELECT 'traffic_log' AS table_name, count(*) AS row_count FROM logs
    UNION ALL SELECT 'alerts', count(*) FROM alerts""",
    [LOGS_SQL, *ALERTS],
)
def table_stats(spark, sf):
    return traffic.table_stats(to_traffic_log(load_packets(spark, sf)), _alerts(spark, sf))


@query(
    "flagged_ips",
    """SELECT ip, CAST(sum(c) AS BIGINT) AS alert_count, max(severity) AS highest_severity,
    array_to_string(list_sort(list(DISTINCT reason)), ', ') AS reasons FROM (
      SELECT unnest([src_ip, dst_ip]) AS ip, 1 AS c, severity, alert_type AS reason
      FROM alerts
      UNION ALL SELECT src_ip, 0, 2, 'port_scan' FROM packets GROUP BY src_ip HAVING count(DISTINCT dst_ip) >= 10
      UNION ALL SELECT dst_ip, 0, 3, 'ddos_suspect' FROM packets GROUP BY dst_ip HAVING count(DISTINCT src_ip) >= 10) q
    WHERE ip IS NOT NULL GROUP BY ip""",
    ALERTS,
)
def flagged_ips(spark, sf):
    edges = graph.edges(load_packets(spark, sf))
    return alerts.flagged_ips(_alerts(spark, sf), graph.port_scanners(edges, 10), graph.ddos_targets(edges, 10))
