"""Ordered operators against sequential replays, with blocks far smaller than the hot source."""

import glob
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from packetloom.operators import detect, features, ordering
from packetloom.operators.anchored import anchored_windows
from packetloom.schema import FEATURES
from packetloom.session import scratch_tables
from tests import helpers


@pytest.fixture(scope="module")
def rows():
    return helpers.random_packets()


def index(spark, rows, block_rows=17, partitions=5):
    return ordering.with_global_index(helpers.table(spark, rows), partitions=partitions, block_rows=block_rows)


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_index_is_the_sorted_position(spark, rows, partitions):
    got = {r["id"]: r["i"] for r in index(spark, rows, partitions=partitions).df.collect()}
    assert got == {p["id"]: k for k, p in enumerate(helpers.named(rows), start=1)}


def test_rolling_statistics(spark, rows):
    frame = 15
    want = helpers.rolling(rows, frame)
    for r in detect.rolling_stats(index(spark, rows), frame).collect():
        (mean, std), gap = want[r["id"]]
        assert r["size_mean"] == pytest.approx(mean)
        assert r["size_std"] == pytest.approx(std)
        if gap is not None:
            assert r["iat_mean"] == pytest.approx(gap[0], abs=1e-9)
            assert r["iat_std"] == pytest.approx(gap[1], abs=1e-6)


def test_frame_longer_than_a_block(spark, rows):
    want = helpers.rolling(rows, 60)
    for r in detect.rolling_stats(index(spark, rows, block_rows=7), 60).collect():
        assert r["size_mean"] == pytest.approx(want[r["id"]][0][0])


def test_running_counts_of_a_hot_source(spark, rows):
    want, _ = helpers.running_rules(rows)
    idx = index(spark, rows)
    counts = {r["id"]: r["src_count"] for r in detect.running_source_counts(idx).df.collect()}
    ports = {r["id"]: r["unique_ports"] for r in detect.running_distinct_ports(idx).df.collect()}
    assert {k: (counts[k], ports[k]) for k in counts} == want


def test_relative_rate_first_crossing(spark, rows):
    _, want = helpers.running_rules(rows)
    got = [r["packet_id"] for r in detect.ddos_10x(index(spark, rows), times=3).collect()]
    assert want and sorted(got) == sorted(want)


def test_first_crossings_match_running_counts(spark, rows):
    packets = helpers.table(spark, rows)
    seen, _ = helpers.running_rules(rows)
    ordered = helpers.named(rows)

    def first(which, threshold):
        hit = {}
        for p in ordered:
            if seen[p["id"]][which] > threshold:
                hit.setdefault((helpers.minute(p["timestamp"]), p["src_ip"]), p["id"])
        return sorted(hit.values())

    assert sorted(r["packet_id"] for r in detect.high_rate(packets, 20).collect()) == first(0, 20)
    assert sorted(r["packet_id"] for r in detect.port_scan(packets, 12).collect()) == first(1, 12)


@pytest.mark.parametrize("seconds,block_rows", [(5, 17), (1, 5), (100, 17)])
def test_anchored_windows(spark, rows, seconds, block_rows):
    placed = anchored_windows(index(spark, rows, block_rows=block_rows), seconds).df
    assert {r["id"]: r["window_start"] for r in placed.select("id", "window_start").collect()} == helpers.anchored(
        rows, seconds
    )


def test_trailing_features(spark, rows):
    want = helpers.trailing(rows, 10, 7)
    got = features.features_trailing(index(spark, rows), 10, 7).collect()
    assert len(got) == len(want)
    for r in got:
        assert [r[f] for f in FEATURES] == pytest.approx(want[r["i"]], abs=1e-6)


def test_features_of_a_hot_source(spark, rows):
    idx = index(spark, rows)
    got = {r["src_ip"]: [r[f] for f in FEATURES] for r in features.features(idx, ["src_ip"]).collect()}
    groups = {}
    for p in helpers.named(rows):
        groups.setdefault(p["src_ip"], []).append(p)
    assert set(got) == set(groups)
    for ip, packets in groups.items():
        assert got[ip] == pytest.approx(helpers.feature_row(packets), abs=1e-6)


def test_empty_input_gives_zero_features(spark):
    row = features.features_all(helpers.table(spark, [])).first()
    assert [row[f] for f in FEATURES] == [0.0] * 22


def test_steady_traffic_is_not_flagged(spark):
    from datetime import timedelta

    rows = []
    for k in range(101):
        helpers.packet(rows, helpers.START + timedelta(milliseconds=10 * k), "10.0.0.1", "10.0.0.2")
    assert detect.statistical(index(spark, rows)).count() == 0


def test_aggregate_score_of_a_lone_hit(spark):
    one = spark.createDataFrame([(1, "statistical", 1.0)], "packet_id BIGINT, detection_method STRING, score DOUBLE")
    assert detect.aggregate_score(one).first()["aggregate_score"] == pytest.approx(0.3)


def test_chronological_split(spark, rows):
    train, test = ordering.chronological_split(index(spark, rows[:33]))
    assert (train.count(), test.count()) == (26, 7)
    assert train.agg(F.max("i")).first()[0] == 26


def test_near_neighbours_agree_with_all_neighbours(spark, rows):
    idx, within = index(spark, rows), 3_000_000
    keys = {"all": [], "src": ["src_ip"], "pair": ["src_ip", "dst_ip"]}
    names = [f"{name}_{side}_us" for name in keys for side in ("prev", "next")]
    every = {r["i"]: r for r in ordering.neighbour_gaps(idx, keys).df.collect()}
    crossed = 0
    for r in ordering.neighbour_gaps(idx, keys, within=within).df.collect():
        for name in names:
            want, got = every[r["i"]][name], r[name]
            if name.startswith("all") or (want is not None and want < within):
                assert got == want
                crossed += r["i"] % 17 in (0, 1)
            else:
                assert got is None or got >= within
    assert crossed > 20


@pytest.mark.parametrize("block_rows,every", [(7, 1), (1000, 10)])
def test_oldest_live_packet(spark, rows, block_rows, every):
    times = [p["timestamp"] for p in helpers.named(rows)]
    with scratch_tables(spark) as store:
        got = {r["i"]: r["oldest"] for r in features._oldest_live(index(spark, rows, block_rows), 10, every, store).collect()}
    want = {
        k: next(j for j, t in enumerate(times, start=1) if t > times[k - 1] - timedelta(seconds=10))
        for k in range(every, len(times) + 1, every)
    }
    assert got == want


def test_trailing_features_leave_no_tables_behind(spark, rows):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{folder}/table-*"))
    with scratch_tables(spark) as store:
        table = features.features_trailing(features.index_packets(helpers.table(spark, rows[:40]), store=store), 10, 7)
    assert set(glob.glob(f"{folder}/table-*")) == before
    assert sorted(r["i"] for r in table.collect()) == [7, 14, 21, 28, 35]
    assert features.features_trailing(index(spark, []), 10, 7).count() == 0
