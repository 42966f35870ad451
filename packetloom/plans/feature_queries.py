"""Registered queries: traffic features and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.operators import features, scaling
from packetloom.plans.registry import query
from packetloom.schema import FEATURES
from packetloom.sources.packets import load_packets


def feature_sql(rows: str, keys: list[str], extra: str = "") -> str:
    """Check SQL for one feature row per key over the relation ``rows``."""
    group = ", ".join(keys)
    part = f"PARTITION BY {group}" if keys else ""
    lead = f"{group}, " if keys else ""
    tail = f"GROUP BY {group}" if keys else ""
    return f"""SELECT {lead}n AS packets, s / n AS avg_packet_size,
  sqrt(CAST(n * q - s * s AS DOUBLE)) / n AS std_packet_size, CAST(lo AS DOUBLE) AS min_packet_size,
  CAST(hi AS DOUBLE) AS max_packet_size,
  CASE WHEN n > 1 THEN sp / CAST(n - 1 AS DOUBLE) / 1e6 ELSE 0 END AS avg_inter_arrival_time,
  CASE WHEN n > 1 THEN sqrt(CAST((n - 1) * iq - CAST(sp AS HUGEINT) * sp AS DOUBLE)) / (n - 1) / 1e6 ELSE 0 END
    AS std_inter_arrival_time,
  CASE WHEN n > 1 AND sp > 0 THEN n / (sp / 1e6) ELSE 0 END AS packets_per_second,
  tcp / n AS tcp_ratio, udp / n AS udp_ratio, icmp / n AS icmp_ratio, CAST(dsp AS DOUBLE) AS unique_src_ports,
  CAST(ddp AS DOUBLE) AS unique_dst_ports, wk / (2 * n) AS well_known_port_ratio,
  CAST(dd AS DOUBLE) AS unique_destinations, CAST(ds AS DOUBLE) AS unique_sources, s / dpair AS avg_bytes_per_connection,
  coalesce(syn / nullif(fl, 0), 0) AS syn_ratio, coalesce(ack / nullif(fl, 0), 0) AS ack_ratio,
  coalesce(fin / nullif(fl, 0), 0) AS fin_ratio, coalesce(rst / nullif(fl, 0), 0) AS rst_ratio,
  hrs / n AS hour_of_day, biz / n AS is_business_hours
FROM (SELECT {lead}count(*) AS n, CAST(sum(packet_size) AS BIGINT) AS s,
  CAST(sum(packet_size * packet_size) AS BIGINT) AS q, min(packet_size) AS lo, max(packet_size) AS hi,
  date_diff('microsecond', min(timestamp), max(timestamp)) AS sp, sum(CAST(iat AS HUGEINT) * iat) AS iq,
  count(*) FILTER (protocol = 'TCP') AS tcp, count(*) FILTER (protocol = 'UDP') AS udp,
  count(*) FILTER (protocol = 'ICMP') AS icmp, count(DISTINCT src_port) AS dsp, count(DISTINCT dst_port) AS ddp,
  count(*) FILTER (src_port BETWEEN 0 AND 1023) + count(*) FILTER (dst_port BETWEEN 0 AND 1023) AS wk,
  count(DISTINCT dst_ip) AS dd, count(DISTINCT src_ip) AS ds, count(DISTINCT (src_ip, dst_ip)) AS dpair,
  count(*) FILTER (f) AS fl, count(*) FILTER (f AND contains(flags, 'SYN')) AS syn,
  count(*) FILTER (f AND contains(flags, 'ACK')) AS ack, count(*) FILTER (f AND contains(flags, 'FIN')) AS fin,
  count(*) FILTER (f AND contains(flags, 'RST')) AS rst, CAST(sum(hour(timestamp)) AS BIGINT) AS hrs,
  count(*) FILTER (hour(timestamp) BETWEEN 9 AND 16) AS biz
  FROM (SELECT *, date_diff('microsecond', lag(timestamp) OVER ({part} ORDER BY timestamp, id), timestamp) AS iat,
    protocol = 'TCP' AND coalesce(flags, '') <> '' AS f FROM {rows}) x {tail}) y {extra}"""


WINDOWED_SQL = "wr AS (SELECT *, time_bucket(INTERVAL 60 SECOND, timestamp) AS window_start FROM packets)"
WIN_FEATURES = [WINDOWED_SQL, f"wf AS ({feature_sql('wr', ['window_start'])})"]
ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES)


def rounded(df, *first):
    """Feature columns to six places (square roots of large integers may differ in the last bit)."""
    return df.select(*first, *[F.round(c, 6).alias(c) for c in FEATURES])


def _show(sql, keys):
    return f"SELECT {', '.join([*keys, 'packets'])}, {ROUNDED} FROM ({sql}) z"


@query("features_all", _show(feature_sql("packets", []), []))
def features_all(spark, sf):
    return rounded(features.features_all(load_packets(spark, sf)), "packets")


@query("features_windowed", _show("SELECT * FROM wf", ["window_start"]), WIN_FEATURES)
def features_windowed(spark, sf):
    return rounded(features.features_windowed(load_packets(spark, sf), 60), "window_start", "packets")


SLIDING_SQL = """sr AS (SELECT p.*, time_bucket(INTERVAL 10 SECOND, timestamp) - o * INTERVAL 10 SECOND AS window_start
      FROM packets p, range(3) t(o))"""


@query("feature_buffer", _show(feature_sql("sr", ["window_start"]), ["window_start"]), SLIDING_SQL)
def feature_buffer(spark, sf):
    """Sliding buffer: 30 s of traffic every 10 s."""
    return rounded(features.features_windowed(load_packets(spark, sf), 30, 10), "window_start", "packets")


def _by_ip(direction, rows):
    @query(f"features_by_ip_{direction}", _show(feature_sql(rows, ["ip"]), ["ip"]))
    def run(spark, sf):
        return rounded(features.features_by_ip(load_packets(spark, sf), direction), "ip", "packets")


_by_ip("src", "(SELECT *, src_ip AS ip FROM packets) r")
_by_ip("dst", "(SELECT *, dst_ip AS ip FROM packets) r")
_by_ip(
    "both",
    "(SELECT *, src_ip AS ip FROM packets UNION ALL SELECT *, dst_ip FROM packets WHERE src_ip <> dst_ip) r",
)

ANCHORED_SQL = [
    """starts(s) AS (SELECT min(timestamp) FROM packets UNION ALL
      SELECT (SELECT min(timestamp) FROM packets WHERE timestamp > s + INTERVAL 5 SECOND) FROM starts
      WHERE s IS NOT NULL)""",
    """ar AS (SELECT p.*, a.s AS window_start FROM packets p
      ASOF JOIN (SELECT s FROM starts WHERE s IS NOT NULL) a ON p.timestamp >= a.s)""",
    f"af AS ({feature_sql('ar', ['window_start'])})",
]


@query("features_anchored", _show("SELECT * FROM af", ["window_start"]), ANCHORED_SQL)
def features_anchored(spark, sf):
    return rounded(features.features_anchored(load_packets(spark, sf), 5), "window_start", "packets")


TRAILING_SQL = [
    "ix AS (SELECT *, row_number() OVER (ORDER BY timestamp, id) AS i FROM packets)",
    """tr AS (SELECT p.i AS probe, x.* FROM ix p JOIN ix x ON x.i <= p.i AND x.timestamp > p.timestamp
      - INTERVAL 30 SECOND WHERE p.i % 10 = 0)""",
    f"tf AS ({feature_sql('tr', ['probe'])})",
]


@query("features_trailing", _show("SELECT probe AS i, * FROM tf", ["i"]), TRAILING_SQL)
def features_trailing(spark, sf):
    idx = features.index_packets(load_packets(spark, sf))
    return rounded(features.features_trailing(idx, 30, every=10), "i", "packets")


# --- scaling ------------------------------------------------------------------------

FIT_SQL = "fit AS (" + " UNION ALL ".join(
    f"SELECT {i} AS feature, '{c}' AS name, min({c}) AS min, max({c}) AS max, avg({c}) AS mean,"
    f" CASE WHEN coalesce(stddev_pop({c}), 0) > 1e-12 THEN stddev_pop({c}) ELSE 1.0 END AS std FROM wf"
    for i, c in enumerate(FEATURES)
) + ")"


@query(
    "scaler_fit",
    """SELECT CAST(feature AS INT) AS feature, name, round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean,
    round(std, 6) AS std FROM fit""",
    [*WIN_FEATURES, FIT_SQL],
)
def scaler_fit(spark, sf):
    model = scaling.fit(features.features_windowed(load_packets(spark, sf), 60), FEATURES)
    return model.select("feature", "name", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")])


MINMAX_SQL = "mm AS (SELECT window_start, " + ", ".join(
    f"CASE WHEN (SELECT max({c}) - min({c}) FROM wf) > 0 THEN ({c} - (SELECT min({c}) FROM wf))"
    f" / (SELECT max({c}) - min({c}) FROM wf) ELSE 0.0 END AS {c}"
    for c in FEATURES
) + " FROM wf)"


@query("minmax", f"SELECT window_start, {ROUNDED} FROM mm", [*WIN_FEATURES, MINMAX_SQL])
def minmax(spark, sf):
    from packetloom.session import cut

    table = cut(features.features_windowed(load_packets(spark, sf), 60))
    scaled = scaling.minmax(table, scaling.Scaler(scaling.fit(table, FEATURES)), FEATURES)
    return rounded(scaled, "window_start")


@query(
    "zscore",
    "SELECT window_start, " + ", ".join(
        f"round(({c} - (SELECT mean FROM fit WHERE name = '{c}')) / (SELECT std FROM fit WHERE name = '{c}'), 5)"
        f" AS {c}" for c in FEATURES
    ) + " FROM wf",
    [*WIN_FEATURES, FIT_SQL],
)
def zscore(spark, sf):
    from packetloom.session import cut

    table = cut(features.features_windowed(load_packets(spark, sf), 60))
    scaled = scaling.zscore(table, scaling.Scaler(scaling.fit(table, FEATURES)), FEATURES)
    return scaled.select("window_start", *[F.round(c, 5).alias(c) for c in FEATURES])
