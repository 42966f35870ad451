"""Registered queries: scans, filters, aggregates, top-k, sets, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.functions import net
from packetloom.operators import traffic
from packetloom.plans.registry import LOGS_SQL, query
from packetloom.session import scratch_path
from packetloom.sources.packets import (
    from_traffic_log,
    load_packets,
    read_traffic_log,
    to_traffic_log,
    write_traffic_log,
)
from packetloom.sources.retention import delete_expired

IP = "10.0.0.1"

INTERNAL_SQL = """(len(string_split({0}, '.')) = 4 AND EXISTS (
  SELECT 1 FROM (SELECT TRY_CAST(string_split({0},'.')[1] AS BIGINT) * 16777216
    + TRY_CAST(string_split({0},'.')[2] AS BIGINT) * 65536 + TRY_CAST(string_split({0},'.')[3] AS BIGINT) * 256
    + TRY_CAST(string_split({0},'.')[4] AS BIGINT) AS v) q
  WHERE v BETWEEN 167772160 AND 184549375 OR v BETWEEN 2886729728 AND 2887778303
     OR v BETWEEN 3232235520 AND 3232301055 OR v BETWEEN 2130706432 AND 2147483647))"""


@query("scan_packets", "SELECT * FROM packets")
def scan_packets(spark, sf):
    return load_packets(spark, sf)


@query("packet_to_log", "SELECT * FROM logs", LOGS_SQL)
def packet_to_log(spark, sf):
    return to_traffic_log(load_packets(spark, sf))


@query(
    "log_to_packet",
    "SELECT id, timestamp, src_ip, dst_ip, src_port, dst_port, protocol, packet_size AS size, flags, ttl FROM packets",
)
def log_to_packet(spark, sf):
    return from_traffic_log(to_traffic_log(load_packets(spark, sf)))


@query(
    "timerange",
    """SELECT id, timestamp, src_ip, dst_ip, packet_size FROM packets
    WHERE timestamp BETWEEN TIMESTAMP '2024-01-01 08:55:30' AND TIMESTAMP '2024-01-01 08:58:00'""",
)
def timerange(spark, sf):
    hit = traffic.in_time_range(load_packets(spark, sf), "2024-01-01 08:55:30", "2024-01-01 08:58:00")
    return hit.select("id", "timestamp", "src_ip", "dst_ip", "packet_size")


def _by_ip(direction, where):
    @query(f"by_ip_{direction}", f"SELECT * FROM packets WHERE {where}")
    def run(spark, sf):
        return traffic.by_ip(load_packets(spark, sf), IP, direction)


_by_ip("src", f"src_ip = '{IP}'")
_by_ip("dst", f"dst_ip = '{IP}'")
_by_ip("both", f"src_ip = '{IP}' OR dst_ip = '{IP}'")


@query(
    "anomalies",
    """SELECT id, timestamp, src_ip, dst_ip, packet_size, round(anomaly_score, 6) AS anomaly_score FROM logs
    WHERE is_anomaly ORDER BY logs.anomaly_score DESC, timestamp DESC, id LIMIT 50""",
    LOGS_SQL,
)
def anomalies(spark, sf):
    return traffic.anomalies(to_traffic_log(load_packets(spark, sf)), 50).select(
        "id", "timestamp", "src_ip", "dst_ip", "packet_size", F.round("anomaly_score", 6).alias("anomaly_score")
    )


@query(
    "large_packet_flag",
    "SELECT id, packet_size, round(anomaly_score, 6) AS anomaly_score FROM logs WHERE is_anomaly",
    LOGS_SQL,
)
def large_packet_flag(spark, sf):
    logs = to_traffic_log(load_packets(spark, sf))
    return logs.where("is_anomaly").select("id", "packet_size", F.round("anomaly_score", 6).alias("anomaly_score"))


@query(
    "retention",
    """SELECT count(*) FILTER (timestamp < c) AS deleted, count(*) FILTER (timestamp >= c) AS kept
    FROM packets, (SELECT max(timestamp) - INTERVAL 5 MINUTE AS c FROM packets) q""",
)
def retention(spark, sf):
    """Counts around a real deletion: what the log held before and what it holds after."""
    path = scratch_path(spark, "log")
    logs = to_traffic_log(load_packets(spark, sf))
    write_traffic_log(logs, path)
    delete_expired(spark, path, days=5 / 1440)
    kept = read_traffic_log(spark, path).agg(F.count("*").alias("kept"))
    return kept.select((logs.agg(F.count("*")).scalar() - F.col("kept")).alias("deleted"), "kept")


@query(
    "retention_counts",
    """SELECT count(*) FILTER (timestamp < c) AS deleted, count(*) FILTER (timestamp >= c) AS kept
    FROM packets, (SELECT max(timestamp) - INTERVAL 5 MINUTE AS c FROM packets) q""",
)
def retention_counts(spark, sf):
    return traffic.retention_counts(load_packets(spark, sf), days=5 / 1440)


@query("log_append", "SELECT * FROM logs", LOGS_SQL)
def log_append(spark, sf):
    """Two appends to the dated log, read back."""
    path = scratch_path(spark, "log")
    logs = to_traffic_log(load_packets(spark, sf))
    write_traffic_log(logs.where("id % 2 = 0"), path)
    write_traffic_log(logs.where("id % 2 = 1"), path)
    return read_traffic_log(spark, path).drop("dt")


@query(
    "capture_filter",
    "SELECT id, src_ip, dst_ip, src_port, dst_port FROM packets WHERE protocol='TCP' AND (src_port=80 OR dst_port=80)",
)
def capture_filter(spark, sf):
    hit = traffic.capture_filter(load_packets(spark, sf), protocol="tcp", port=80)
    return hit.select("id", "src_ip", "dst_ip", "src_port", "dst_port")


@query(
    "is_internal_ip",
    f"SELECT ip, {INTERNAL_SQL.format('ip')} AS is_internal FROM "
    "(SELECT src_ip AS ip FROM packets UNION SELECT dst_ip FROM packets) u",
)
def is_internal_ip(spark, sf):
    return traffic.endpoints(load_packets(spark, sf)).select("ip", net.is_internal_ip("ip").alias("is_internal"))


@query(
    "conn_key",
    """SELECT least(src_ip, dst_ip) AS ip_a, greatest(src_ip, dst_ip) AS ip_b, count(*) AS packet_count,
    count(DISTINCT src_ip) AS directions FROM packets GROUP BY 1, 2""",
)
def conn_key(spark, sf):
    return (
        load_packets(spark, sf)
        .groupBy(net.connection_key().alias("k"))
        .agg(F.count("*").alias("packet_count"), F.count_distinct("src_ip").alias("directions"))
        .select("k.ip_a", "k.ip_b", "packet_count", "directions")
    )


@query(
    "packet_count_by_ip",
    """SELECT src_ip, count(*) AS packet_count FROM packets
    WHERE timestamp >= (SELECT max(timestamp) FROM packets) - INTERVAL 5 MINUTE GROUP BY src_ip""",
)
def packet_count_by_ip(spark, sf):
    return traffic.packet_count_by_ip(load_packets(spark, sf), 5)


@query(
    "traffic_totals",
    """SELECT count(*) AS packet_count, CAST(coalesce(sum(packet_size), 0) AS BIGINT) AS total_bytes,
    round(coalesce(sum(packet_size) / count(*), 0), 6) AS avg_packet_size, count(DISTINCT src_ip) AS unique_sources,
    count(DISTINCT dst_ip) AS unique_destinations FROM packets
    WHERE timestamp >= (SELECT max(timestamp) FROM packets) - INTERVAL 4 MINUTE""",
)
def traffic_totals(spark, sf):
    return traffic.traffic_totals(load_packets(spark, sf), 4).withColumn(
        "avg_packet_size", F.round("avg_packet_size", 6)
    )


@query("protocol_distribution", "SELECT protocol, count(*) AS packet_count FROM packets GROUP BY 1")
def protocol_distribution(spark, sf):
    return traffic.protocol_distribution(load_packets(spark, sf))


@query(
    "top_sources",
    """SELECT src_ip, count(*) AS packet_count, CAST(sum(packet_size) AS BIGINT) AS total_bytes FROM packets
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_sources(spark, sf):
    return traffic.top_sources(load_packets(spark, sf))


LAST_4 = "timestamp >= (SELECT max(timestamp) FROM packets) - INTERVAL 4 MINUTE"


@query("protocol_distribution_recent", f"SELECT protocol, count(*) AS packet_count FROM packets WHERE {LAST_4} GROUP BY 1")
def protocol_distribution_recent(spark, sf):
    return traffic.protocol_distribution(load_packets(spark, sf), 4)


@query(
    "top_sources_recent",
    f"""SELECT src_ip, count(*) AS packet_count, CAST(sum(packet_size) AS BIGINT) AS total_bytes FROM packets
    WHERE {LAST_4} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_sources_recent(spark, sf):
    return traffic.top_sources(load_packets(spark, sf), 10, 4)


@query(
    "anomaly_trend_recent",
    f"""SELECT count(*) FILTER (is_anomaly) AS anomaly_count, count(*) FILTER (NOT is_anomaly) AS normal_count,
    round(100.0::DOUBLE * count(*) FILTER (NOT is_anomaly) / greatest(count(*), 1), 6) AS normal_percent,
    round(100.0::DOUBLE * count(*) FILTER (is_anomaly) / greatest(count(*), 1), 6) AS anomalous_percent FROM logs
    WHERE {LAST_4}""",
    LOGS_SQL,
)
def anomaly_trend_recent(spark, sf):
    return traffic.anomaly_trend(to_traffic_log(load_packets(spark, sf)), 4)


@query(
    "bandwidth_hogs",
    "SELECT src_ip, CAST(sum(packet_size) AS BIGINT) AS total_bytes FROM packets GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def bandwidth_hogs(spark, sf):
    return traffic.bandwidth_hogs(load_packets(spark, sf))


@query(
    "anomaly_trend",
    """SELECT count(*) FILTER (is_anomaly) AS anomaly_count, count(*) FILTER (NOT is_anomaly) AS normal_count,
    round(100.0::DOUBLE * count(*) FILTER (NOT is_anomaly) / greatest(count(*), 1), 6) AS normal_percent,
    round(100.0::DOUBLE * count(*) FILTER (is_anomaly) / greatest(count(*), 1), 6) AS anomalous_percent FROM logs""",
    LOGS_SQL,
)
def anomaly_trend(spark, sf):
    return traffic.anomaly_trend(to_traffic_log(load_packets(spark, sf)))


PAIRS_SQL = """SELECT src_ip, dst_ip, count(*) AS packet_count, CAST(sum(packet_size) AS BIGINT) AS total_bytes,
    array_to_string(list_sort(list(DISTINCT protocol)), ',') AS protocols, min(timestamp) AS first_seen,
    max(timestamp) AS last_seen FROM packets GROUP BY 1, 2"""


@query("connection_pairs", PAIRS_SQL + " ORDER BY 3 DESC, 1, 2 LIMIT 100")
def connection_pairs(spark, sf):
    return traffic.connection_pairs(load_packets(spark, sf), 100)


@query("connection_pairs_all", PAIRS_SQL)
def connection_pairs_all(spark, sf):
    return traffic.connection_pairs(load_packets(spark, sf), None)


@query(
    "ip_stats",
    """SELECT coalesce(s.ip, r.ip) AS ip, coalesce(packets_sent, 0) AS packets_sent,
    CAST(coalesce(bytes_sent, 0) AS BIGINT) AS bytes_sent, coalesce(packets_received, 0) AS packets_received,
    CAST(coalesce(bytes_received, 0) AS BIGINT) AS bytes_received, coalesce(ud, 0) AS unique_destinations,
    coalesce(us, 0) AS unique_sources, coalesce(packets_sent, 0) + coalesce(packets_received, 0) AS total_packets,
    CAST(coalesce(bytes_sent, 0) + coalesce(bytes_received, 0) AS BIGINT) AS total_bytes,
    coalesce(protocols_used, '') AS protocols_used, first_seen, last_seen
    FROM (SELECT src_ip AS ip, count(*) AS packets_sent, sum(packet_size) AS bytes_sent, count(DISTINCT dst_ip) AS ud,
      array_to_string(list_sort(list(DISTINCT protocol)), ',') AS protocols_used, min(timestamp) AS first_seen,
      max(timestamp) AS last_seen FROM packets GROUP BY 1) s
    FULL JOIN (SELECT dst_ip AS ip, count(*) AS packets_received, sum(packet_size) AS bytes_received,
      count(DISTINCT src_ip) AS us FROM packets GROUP BY 1) r ON s.ip = r.ip""",
)
def ip_stats(spark, sf):
    return traffic.ip_stats(load_packets(spark, sf))


@query(
    "capture_stats",
    """SELECT count(*) AS total_packets, CAST(sum(packet_size) AS BIGINT) AS total_bytes,
    count(*) FILTER (protocol = 'TCP') AS tcp_packets, count(*) FILTER (protocol = 'UDP') AS udp_packets,
    count(*) FILTER (protocol = 'ICMP') AS icmp_packets,
    count(*) FILTER (protocol NOT IN ('TCP','UDP','ICMP')) AS other_packets,
    round(date_diff('microsecond', min(timestamp), max(timestamp)) / 1e6, 6) AS runtime_seconds,
    round(count(*) / greatest(date_diff('microsecond', min(timestamp), max(timestamp)) / 1e6, 1.0), 6)
      AS packets_per_second FROM packets""",
)
def capture_stats(spark, sf):
    return traffic.capture_stats(load_packets(spark, sf))


@query(
    "volume_per_minute",
    """SELECT date_trunc('minute', timestamp) AS minute, count(*) AS packets FROM packets GROUP BY 1
    HAVING (SELECT count(DISTINCT date_trunc('minute', timestamp)) FROM packets) >= 2""",
)
def volume_per_minute(spark, sf):
    return traffic.volume_per_minute(load_packets(spark, sf))


@query(
    "volume_folded",
    """SELECT strftime(timestamp, '%H:%M') AS minute, count(*) AS packets FROM packets GROUP BY 1
    HAVING (SELECT count(DISTINCT strftime(timestamp, '%H:%M')) FROM packets) >= 2""",
)
def volume_folded(spark, sf):
    return traffic.volume_per_minute(load_packets(spark, sf), fold_days=True)


@query(
    "volume_filled",
    """SELECT g.minute AS minute, count(p.id) AS packets
    FROM (SELECT unnest(generate_series(date_trunc('minute', min(timestamp)), date_trunc('minute', max(timestamp)),
      INTERVAL 1 MINUTE)) AS minute FROM packets) g
    LEFT JOIN packets p ON date_trunc('minute', p.timestamp) = g.minute GROUP BY 1""",
)
def volume_filled(spark, sf):
    return traffic.volume_per_minute_filled(load_packets(spark, sf))


@query("recent_packets", "SELECT * FROM packets ORDER BY timestamp DESC, id DESC LIMIT 100")
def recent_packets(spark, sf):
    return traffic.recent(load_packets(spark, sf), 100)


@query("vertices", "SELECT src_ip AS ip FROM packets UNION SELECT dst_ip FROM packets")
def vertices(spark, sf):
    return traffic.endpoints(load_packets(spark, sf))


def _neighbors(direction, sql):
    @query(f"neighbors_{direction}", sql)
    def run(spark, sf):
        return traffic.neighbors(load_packets(spark, sf), direction)


_neighbors("out", "SELECT DISTINCT src_ip AS ip, dst_ip AS neighbor FROM packets")
_neighbors("in", "SELECT DISTINCT dst_ip AS ip, src_ip AS neighbor FROM packets")
_neighbors(
    "both",
    "SELECT src_ip AS ip, dst_ip AS neighbor FROM packets UNION SELECT dst_ip, src_ip FROM packets",
)


@query(
    "tcp_flags",
    """SELECT id, letters, CASE WHEN t = '' THEN 'NONE' ELSE t END AS flag_text FROM (SELECT id, letters,
      array_to_string([x for x in [CASE WHEN contains(letters,'S') THEN 'SYN' END,
        CASE WHEN contains(letters,'A') THEN 'ACK' END, CASE WHEN contains(letters,'F') THEN 'FIN' END,
        CASE WHEN contains(letters,'R') THEN 'RST' END, CASE WHEN contains(letters,'P') THEN 'PSH' END,
        CASE WHEN contains(letters,'U') THEN 'URG' END] if x IS NOT NULL], '-') AS t
      FROM (SELECT id, CASE WHEN id % 7 = 0 THEN 'EC' WHEN id % 7 = 1 THEN 'UPRFAS' ELSE
        array_to_string([substr(x, 1, 1) for x in string_split(coalesce(flags, ''), '-')], '') END AS letters
        FROM packets) a) b""",
)
def tcp_flags(spark, sf):
    letters = F.when(F.expr("id % 7 = 0"), F.lit("EC")).when(F.expr("id % 7 = 1"), F.lit("UPRFAS")).otherwise(
        F.array_join(F.transform(F.split(F.coalesce("flags", F.lit("")), "-"), lambda x: F.substring(x, 1, 1)), "")
    )
    return load_packets(spark, sf).select("id", letters.alias("letters")).withColumn(
        "flag_text", net.tcp_flag_text("letters")
    )
