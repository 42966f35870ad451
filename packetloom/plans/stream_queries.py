"""Registered queries: streams replayed from the packet table, checked against batch SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from packetloom.operators import detect, ordering
from packetloom.plans.detect_queries import ESCALATED_SQL, _show
from packetloom.plans.detect_sql import ALERTS, EMIT, ROLL_SQL, RULES_SQL, STATISTICAL_SQL
from packetloom.plans.feature_queries import ANCHORED_SQL, ROUNDED, SLIDING_SQL, WIN_FEATURES, feature_sql, rounded
from packetloom.plans.registry import LOGS_SQL, query
from packetloom.session import cut, scratch_path
from packetloom.sources.packets import load_packets
from packetloom.streaming import held, late, queries, source

FILES = 2


def _stream(spark, packets, extra=None):
    return source.read_files(spark, source.stage(packets, files=FILES, extra=extra), FILES)


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("stream_ingest", "SELECT * FROM logs", LOGS_SQL)
def stream_ingest(spark, sf):
    """Every 50th packet of the newest traffic is delivered twice; the log has each once."""
    packets = load_packets(spark, sf)
    newest = packets.agg(F.max("timestamp")).scalar()
    repeated = packets.where(
        (F.col("id") % 50 == 0) & (F.col("timestamp") >= newest - F.expr("INTERVAL 25 SECONDS"))
    )
    path = scratch_path(spark, "log")
    queries.run_append(queries.ingest(_stream(spark, packets, repeated)), path, dated="timestamp")
    stored = spark.read.parquet(path).drop("dt")
    return _ntz(stored.where(F.col("id") != source.SENTINEL_ID), "timestamp")


RATE_SQL = """SELECT date_trunc('minute', timestamp) AS win, protocol, count(*) AS packets,
    CAST(sum(packet_size) AS BIGINT) AS bytes FROM packets GROUP BY 1, 2"""


@query("stream_rate", RATE_SQL)
def stream_rate(spark, sf):
    stream = _stream(spark, load_packets(spark, sf))
    return _ntz(queries.run_append(queries.rate(stream), scratch_path(spark, "rate")), "win")


@query(
    "stream_rules",
    """SELECT win, src_ip, detection_method AS rule FROM (SELECT date_trunc('minute', timestamp) AS win, src_ip,
    detection_method FROM d_scan UNION ALL SELECT date_trunc('minute', timestamp), src_ip, detection_method FROM d_rate
    UNION ALL SELECT date_trunc('minute', timestamp), src_ip, detection_method FROM d_syn) q""",
    RULES_SQL,
)
def stream_rules(spark, sf):
    stream = _stream(spark, load_packets(spark, sf))
    return _ntz(queries.run_append(queries.counting_rules(stream), scratch_path(spark, "rules")), "win")


@query("stream_ddos", EMIT.format("d_ddos"), RULES_SQL)
def stream_ddos(spark, sf):
    stream = _stream(spark, load_packets(spark, sf))

    def operator(packets):
        return detect.ddos_10x(ordering.with_global_index(packets))

    return _show(held.run_windows(stream, operator, scratch_path(spark, "ddos")))


@query(
    "stream_stateless",
    EMIT.format("(SELECT * FROM d_port UNION ALL SELECT * FROM d_large) q"),
    RULES_SQL,
)
def stream_stateless(spark, sf):
    stream = _stream(spark, load_packets(spark, sf))
    return _show(_ntz(queries.run_append(queries.packet_rules(stream), scratch_path(spark, "hits")), "timestamp"))


@query("stream_features", f"SELECT window_start, packets, {ROUNDED} FROM wf", WIN_FEATURES)
def stream_features(spark, sf):
    rows = held.run_features(_stream(spark, load_packets(spark, sf)), scratch_path(spark, "features"))
    return rounded(rows, "window_start", "packets")


@query(
    "stream_features_sliding",
    f"SELECT window_start, packets, {ROUNDED} FROM ({feature_sql('sr', ['window_start'])}) z",
    SLIDING_SQL,
)
def stream_features_sliding(spark, sf):
    """30 s of traffic every 10 s, each window split over all keys of state."""
    rows = held.run_features(_stream(spark, load_packets(spark, sf)), scratch_path(spark, "sliding"), 30, 10)
    return rounded(rows, "window_start", "packets")


@query("stream_features_anchored", f"SELECT window_start, packets, {ROUNDED} FROM af", ANCHORED_SQL)
def stream_features_anchored(spark, sf):
    """Windows of 5 s that open at their first packet."""
    rows = held.run_anchored(_stream(spark, load_packets(spark, sf)), scratch_path(spark, "anchored"), 5.0)
    return rounded(rows, "window_start", "packets")


@query("stream_rolling", EMIT.format("d_stat"), [ROLL_SQL, STATISTICAL_SQL])
def stream_rolling(spark, sf):
    stream = _stream(spark, load_packets(spark, sf))
    return _show(held.run_rolling(stream, scratch_path(spark, "rolling")))


def _twice(write):
    """A writer that is given the same detections twice; they are worked out once."""

    def each(batch, epoch):
        found = cut(batch)
        write(found, epoch)
        write(found, epoch)

    return each


@query(
    "stream_alerts",
    f"SELECT * REPLACE ({ESCALATED_SQL}) FROM alerts WHERE id % 16 > 0",
    ALERTS,
)
def stream_alerts(spark, sf):
    """The rules of closed minutes, without the statistical one. Every batch is written twice, as a replay after a failure would."""
    path = scratch_path(spark, "alerts")
    write = queries.append_new_alerts(f"{path}/alerts")

    held.run_windows(_stream(spark, load_packets(spark, sf)), queries.minute_rules, path, write=_twice(write))
    return spark.read.parquet(f"{path}/alerts").drop("dt")


@query("stream_all_alerts", f"SELECT * REPLACE ({ESCALATED_SQL}) FROM alerts", ALERTS)
def stream_all_alerts(spark, sf):
    """All rules, the statistical one too, in one sink. Every batch is written twice, as a replay after a failure would."""
    path = scratch_path(spark, "all-alerts")
    write = queries.append_new_alerts(f"{path}/alerts")

    held.run_alerts(_stream(spark, load_packets(spark, sf)), path, _twice(write))
    return spark.read.parquet(f"{path}/alerts").drop("dt")


@query(
    "stream_topk",
    "SELECT src_ip, CAST(sum(packet_size) AS BIGINT) AS total_bytes FROM packets GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def stream_topk(spark, sf):
    return queries.run_top_k(_stream(spark, load_packets(spark, sf)), scratch_path(spark, "topk"), 5)


LATE_SQL = """edge AS (SELECT epoch_us(min(timestamp)) + (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) // 2 - 90000000
    AS t FROM packets), late AS (SELECT count(*) AS n FROM packets, edge WHERE id % 7 = 0 AND epoch_us(timestamp) < t)"""


@query("stream_late", f"SELECT win, protocol, packets, bytes, n AS late_rows FROM ({RATE_SQL}) r, late", LATE_SQL)
def stream_late(spark, sf):
    """Packets that come minutes late do not change windows that are already closed; they are counted."""
    packets = load_packets(spark, sf)
    low, high = packets.agg(F.min("timestamp"), F.max("timestamp")).first()
    cutoff = low + (high - low) // 2 - timedelta(seconds=90)
    late_packets = packets.where((F.col("id") % 7 == 0) & (F.col("timestamp") < F.lit(cutoff).cast("timestamp_ntz")))
    ids: list[str] = []
    with late.counted(spark, scratch_path(spark, "late-rows")) as counter:
        table = queries.run_append(
            queries.rate(_stream(spark, packets, late_packets), once=True), scratch_path(spark, "late"),
            started=lambda q: ids.append(str(q.id)))
    return _ntz(table, "win").withColumn("late_rows", F.lit(counter.total(ids[0])).cast("bigint"))
