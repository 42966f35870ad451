"""Fixed schemas of the packet, alert and model tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


PACKET = (
    "id BIGINT, timestamp TIMESTAMP_NTZ, src_ip STRING, dst_ip STRING, src_port INT, dst_port INT, "
    "protocol STRING, packet_size BIGINT, flags STRING, ttl INT"
)
TRAFFIC_LOG = PACKET + ", is_anomaly BOOLEAN, anomaly_score DOUBLE"
ALERT = (
    "id BIGINT, timestamp TIMESTAMP_NTZ, alert_type STRING, severity INT, src_ip STRING, dst_ip STRING, "
    "description STRING, packet_count BIGINT, byte_count BIGINT"
)
RESOLUTION = "alert_id BIGINT, resolved_at TIMESTAMP_NTZ"

PACKET_COLUMNS = [
    "id", "timestamp", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "packet_size", "flags", "ttl",
]

SEVERITY_LABELS = {1: "LOW", 2: "MEDIUM", 3: "HIGH", 4: "CRITICAL"}
ALERT_TYPES = ["port_scan", "ddos_suspect", "anomaly", "high_traffic", "unusual_protocol", "large_packet"]

# Fixed order of the 22 traffic features; models address them by position.
FEATURES = [
    "avg_packet_size",
    "std_packet_size",
    "min_packet_size",
    "max_packet_size",
    "avg_inter_arrival_time",
    "std_inter_arrival_time",
    "packets_per_second",
    "tcp_ratio",
    "udp_ratio",
    "icmp_ratio",
    "unique_src_ports",
    "unique_dst_ports",
    "well_known_port_ratio",
    "unique_destinations",
    "unique_sources",
    "avg_bytes_per_connection",
    "syn_ratio",
    "ack_ratio",
    "fin_ratio",
    "rst_ratio",
    "hour_of_day",
    "is_business_hours",
]
