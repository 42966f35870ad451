"""Sources, sinks, alerts, traffic reports and streams."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from packetloom.functions import net
from packetloom.operators import alerts, detect, traffic
from packetloom.sources import ipv4, nsl_kdd
from packetloom.sources import packets as store
from packetloom.streaming import queries, source
from tests import helpers


def test_log_round_trip_prunes_days(spark, tmp_path):
    rows = []
    for day in range(3):
        for k in range(20):
            helpers.packet(rows, helpers.START + timedelta(days=day, seconds=k), "10.0.0.1", "10.0.0.2", size=600 * k)
    path = str(tmp_path / "log")
    store.write_traffic_log(store.to_traffic_log(helpers.table(spark, rows)), path)
    log = store.read_traffic_log(spark, path)
    assert log.count() == 60
    flagged = log.where("is_anomaly").select("anomaly_score", "packet_size").collect()
    assert len(flagged) == 9 and all(r["anomaly_score"] == r["packet_size"] / 50000 for r in flagged)
    hit = traffic.in_time_range(log, "2024-01-02 00:00:00", "2024-01-02 23:59:59")
    assert hit.count() == 20
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_retention(spark):
    rows = []
    helpers.packet(rows, helpers.START - timedelta(days=30), "10.0.0.1", "10.0.0.2")
    helpers.packet(rows, helpers.START, "10.0.0.1", "10.0.0.2")
    packets = helpers.table(spark, rows)
    assert traffic.retention_counts(packets, 7).first().asDict() == {"deleted": 1, "kept": 1}
    kept, expired = traffic.split_retention(packets, 7)
    assert (kept.count(), expired.count()) == (1, 1)


def test_totals(spark):
    rows = []
    for k in range(50):
        helpers.packet(rows, helpers.START, "192.168.1.1", f"10.0.0.{k % 10}", size=100 * (k + 1))
    packets = helpers.table(spark, rows)
    row = traffic.traffic_totals(packets, 60).first()
    assert (row["packet_count"], row["unique_sources"], row["unique_destinations"]) == (50, 1, 10)
    empty = traffic.traffic_totals(packets.where("false")).first()
    assert (empty["packet_count"], empty["total_bytes"], empty["avg_packet_size"]) == (0, 0, 0.0)
    assert traffic.volume_per_minute(packets).isEmpty()
    with pytest.raises(ValueError):
        traffic.by_ip(packets, "10.0.0.1", "sideways")


def test_pairs(spark):
    rows = []
    for _ in range(10):
        helpers.packet(rows, helpers.START, "192.168.1.1", "8.8.8.8")
    pair = traffic.connection_pairs(helpers.table(spark, rows)).collect()
    assert len(pair) == 1 and pair[0]["packet_count"] == 10


def test_internal_addresses(spark):
    cases = {
        "10.1.2.3": True, "172.16.0.1": True, "172.32.0.1": False, "192.168.255.255": True, "127.0.0.1": True,
        "8.8.8.8": False, "fe80::1": False, "10.0.0": False, "10.x.0.1": False, "10.0.999.1": True,
    }
    table = spark.createDataFrame([(ip,) for ip in cases], "ip STRING")
    assert {r["ip"]: r["v"] for r in table.select("ip", net.is_internal_ip("ip").alias("v")).collect()} == cases


def test_flag_text(spark):
    cases = {"SA": "SYN-ACK", "PA": "ACK-PSH", "": "NONE", "EC": "NONE", "UFRPAS": "SYN-ACK-FIN-RST-PSH-URG"}
    table = spark.createDataFrame([(x,) for x in cases], "f STRING")
    assert {r["f"]: r["t"] for r in table.select("f", net.tcp_flag_text("f").alias("t")).collect()} == cases


def test_header_decoding(spark):
    good = bytes([0x45, 0, 0x01, 0x02, 0, 0, 0, 0, 64, 6, 0, 0, 192, 168, 1, 200, 8, 8, 4, 4])
    table = spark.createDataFrame(
        [(1, good), (2, good[:19]), (3, bytes([0x60]) + good[1:]), (4, None)], "id INT, raw BINARY"
    )
    decoded, rejected = ipv4.decode(table)
    row = decoded.first()
    assert (row["version"], row["header_length"], row["total_length"], row["ttl"], row["protocol"]) == (4, 20, 258, 64, 6)
    assert (row["src_ip"], row["dst_ip"]) == ("192.168.1.200", "8.8.4.4")
    assert {r["id"]: r["reason"] for r in rejected.collect()} == {2: "too_short", 3: "not_ipv4", 4: "missing"}


def test_connection_record_file(spark, tmp_path):
    line = ["0", "TCP", "http", "sf"] + [str(k) for k in range(4, 41)]
    lines = [",".join(line + ["Neptune", "20"]), "too,short", ",".join(line + [" normal "])]
    lines.append(",".join(["x"] + line[1:] + ["mystery", "3"]))
    path = tmp_path / "records.txt"
    path.write_text("\n".join(lines * 10) + "\n")
    records = nsl_kdd.load(spark, str(path))
    assert records.count() == 30
    assert nsl_kdd.load(spark, str(path), max_records=2).count() == 1
    kinds = {r["label"]: (r["category"], r["binary_label"], r["difficulty"]) for r in records.collect()}
    assert kinds == {
        "neptune": ("dos", "anomaly", 20), "normal": ("normal", "normal", 0), "mystery": ("unknown", "anomaly", 3),
    }
    vector = nsl_kdd.encode(records.where("label = 'normal'")).first()["vector"]
    assert len(vector) == 70 and vector[1:4] == [1.0, 0.0, 0.0] and vector[4] == 1.0 and vector[23] == 1.0
    row = nsl_kdd.map_to_features(records.where("label = 'normal'")).first()
    assert (row["avg_packet_size"], row["avg_bytes_per_connection"], row["tcp_ratio"]) == (4.0, 5.0, 1.0)
    assert (row["packets_per_second"], row["unique_dst_ports"], row["hour_of_day"]) == (22.0, 23.0, 12.0)


def make_alerts(spark):
    rows = helpers.random_packets(120)
    return alerts.from_detections(detect.suspicious_port(helpers.table(spark, rows)))


def test_alert_state(spark):
    table = make_alerts(spark)
    n = table.count()
    assert n > 0 and alerts.unresolved(table, alerts.resolve(table, F.lit(False)), None).count() == n
    assert alerts.unresolved(table, alerts.resolve(table, F.lit(True)), None).isEmpty()
    row = alerts.escalate(table).first()
    assert row["severity"] == 3 and "[AUTO-ESCALATED at 2024-01-01" in row["description"]


def test_alert_sink_ignores_replays(spark, tmp_path):
    rows = helpers.random_packets(120)
    hits = detect.suspicious_port(helpers.table(spark, rows))
    write = queries.append_new_alerts(str(tmp_path / "alerts"))
    write(hits, 0)
    write(hits, 0)
    write(hits.limit(3), 1)
    assert spark.read.parquet(str(tmp_path / "alerts")).count() == hits.count()


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    rows = helpers.random_packets(300)
    packets = helpers.table(spark, rows)
    late = packets.orderBy("timestamp").limit(5).withColumn("id", F.col("id") + 10_000)
    stream = source.read_files(spark, source.stage(packets, extra=late), 2)
    got = queries.run_append(queries.rate(stream), str(tmp_path / "rate"))
    got = got.withColumn("win", F.col("win").cast("timestamp_ntz"))
    want = packets.groupBy(net.minute_window().alias("win"), "protocol").agg(
        F.count("*").alias("packets"), F.sum("packet_size").alias("bytes")
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
