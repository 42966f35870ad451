"""Live operators over restarts and replays, against the batch result."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from packetloom.operators import alerts, detect, features, ordering
from packetloom.sources import packets as store
from packetloom.sources import retention
from packetloom.streaming import held, late, queries, source
from tests.helpers import random_packets, table


@pytest.fixture()
def packets(spark):
    rows = random_packets(700, seed=11)
    start = rows[0][1].replace(second=0)
    return table(spark, [
        (i, start + timedelta(milliseconds=900 * k), *rest[:5], 90_000 if k % 97 == 96 else rest[5], *rest[6:])
        for k, (i, _, *rest) in enumerate(rows)])


def feed(packets, folder, parts, last=True):
    """Append spans of the table as one file each; with ``last`` a packet that lets everything close."""
    low, high = packets.agg(F.min("timestamp"), F.max("timestamp")).first()
    width = (high - low) / 6
    for k in parts:
        part = packets.where((F.col("timestamp") >= F.lit(low + k * width).cast("timestamp_ntz")) | F.lit(k == 0))
        if k < 5:
            part = part.where(F.col("timestamp") < F.lit(low + (k + 1) * width).cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(folder)
    if last:
        packets.limit(1).withColumns({"id": F.lit(source.SENTINEL_ID).cast("bigint"), "timestamp": F.lit(source.SENTINEL_TIME).cast("timestamp_ntz")}).coalesce(
            1).write.mode("append").parquet(folder)


def rows_of(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


FEATURES_SHOWN = ["window_start", "packets", "avg_packet_size", "std_inter_arrival_time", "unique_dst_ports", "unique_sources"]


@pytest.mark.parametrize("seconds,slide,salts", [(60, None, 5), (25, 10, 2)])
def test_windows_go_on_after_a_restart(spark, packets, tmp_path, seconds, slide, salts):
    """A window is split over several keys, and its packets come before and after a restart."""
    folder, path = f"{tmp_path}/in", f"{tmp_path}/work"
    feed(packets, folder, [0, 1, 2], last=False)
    held.run_features(source.read_files(spark, folder, 2), path, seconds, slide, salts=salts)
    before = spark.read.parquet(f"{path}/out").count()
    feed(packets, folder, [3, 4, 5])
    got = held.run_features(source.read_files(spark, folder, 2), path, seconds, slide, salts=salts)
    assert 0 < before < got.count()
    assert rows_of(got, *FEATURES_SHOWN) == rows_of(features.features_windowed(packets, seconds, slide), *FEATURES_SHOWN)


def test_anchored_windows_go_on_after_a_restart(spark, packets, tmp_path):
    folder, path = f"{tmp_path}/in", f"{tmp_path}/work"
    feed(packets, folder, [0, 1], last=False)
    held.run_anchored(source.read_files(spark, folder, 2), path, 7.0)
    before = spark.read.parquet(f"{path}/out").count()
    feed(packets, folder, [2, 3, 4, 5])
    got = held.run_anchored(source.read_files(spark, folder, 2), path, 7.0)
    assert 0 < before < got.count()
    assert rows_of(got, *FEATURES_SHOWN) == rows_of(features.features_anchored(packets, 7.0), *FEATURES_SHOWN)


def test_rolling_statistics_go_on_after_a_restart(spark, packets, tmp_path):
    folder, path = f"{tmp_path}/in", f"{tmp_path}/work"
    feed(packets, folder, [0, 1], last=False)
    held.run_rolling(source.read_files(spark, folder, 2), path, 50)
    feed(packets, folder, [2, 3, 4, 5])
    got = held.run_rolling(source.read_files(spark, folder, 2), path, 50)
    want = detect.statistical(ordering.with_global_index(packets), 50)
    assert want.count() > 0
    assert rows_of(got, "packet_id", "score") == rows_of(want, "packet_id", "score")


def test_what_a_batch_left_is_needed_to_go_on(spark, packets, tmp_path):
    carried = held._Carried(spark, f"{tmp_path}/tail", "id BIGINT, timestamp TIMESTAMP_NTZ")
    assert carried.before(0).isEmpty()
    for number in range(3):
        for _ in range(2):  # a replay reads and leaves the same
            before = carried.before(number)
            carried.leave(packets.where(F.col("id") < number + 3), number)
    assert carried.before(2).count() == 4 and carried.before(3).count() == 5
    with pytest.raises(FileNotFoundError):
        carried.before(1)
    assert before.count() == 4


def test_alerts_of_all_rules_reach_one_sink(spark, packets, tmp_path):
    """The statistical detector (rule 0 of 16) is among them."""
    folder, path = f"{tmp_path}/in", f"{tmp_path}/work"
    feed(packets, folder, range(6))
    held.run_alerts(source.read_files(spark, folder, 4), path, queries.append_new_alerts(f"{path}/alerts"), 50)
    found = queries.minute_rules(packets).unionByName(detect.statistical(ordering.with_global_index(packets), 50))
    want = alerts.escalate(alerts.from_detections(found)).dropDuplicates(["id"])
    got = spark.read.parquet(f"{path}/alerts")
    assert want.where("id % 16 = 0").count() > 0 and want.where("id % 16 > 0").count() > 0
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


def test_late_packets_are_counted_over_a_whole_life(spark, packets, tmp_path):
    """More batches than a query's own progress holds, over a restart, with a late packet in most of them."""
    folder, path = f"{tmp_path}/in", f"{tmp_path}/rate"
    rows = packets.orderBy("timestamp").collect()
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "7")
    found, want, ids = [], 0, []
    try:
        for part in (range(12), range(12, 18)):
            for k in part:
                chunk = [r for r in rows[40 * k : 40 * k + 40]] if k < 17 else rows[680:]
                if k >= 4:  # minutes late
                    chunk += [(10_000 + 10 * k + j, *rows[j][1:]) for j in range(k % 3)]
                    want += k % 3
                spark.createDataFrame(chunk, packets.schema).coalesce(1).write.mode("append").parquet(folder)
            with late.counted(spark, f"{tmp_path}/late") as counter:
                queries.run_append(queries.rate(source.read_files(spark, folder), once=True), path, started=lambda q: ids.append(q))
            found.append(counter.total(str(ids[-1].id)))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert ids[0].id == ids[1].id and len(ids[0].recentProgress) < 12
    assert found[0] == sum(k % 3 for k in range(4, 12)) and found[1] == want


def test_late_count_takes_replays_and_torn_files(spark, tmp_path):
    counter = late.LateRows(spark, str(tmp_path))
    for batch in range(150):
        counter.note("q", batch, batch % 2)
        counter.note("q", batch, batch % 2)  # the same batch again, after a failure
    assert counter.total("q") == 75 and late.LateRows(spark, str(tmp_path)).total("q") == 75
    counter.note("q", 149, 4)  # a replay that saw other packets replaces what the batch had
    assert counter.total("q") == 78
    counter.note("q", 150, 2)
    turn = counter._last("q")["turn"]
    counter.note("q", 151, 1)
    (tmp_path / f"q-{1 - turn}.json").write_text('{"batch": 15')
    (tmp_path / f".q-{1 - turn}.json.crc").unlink(missing_ok=True)
    assert counter.total("q") == 80 and counter.total("other") == 0


def test_appended_log_goes_on_after_a_restart(spark, packets, tmp_path):
    folder, path = f"{tmp_path}/in", f"{tmp_path}/log"
    feed(packets, folder, [0, 1, 2], last=False)
    queries.run_append(queries.ingest(source.read_files(spark, folder)), path, dated="timestamp")
    feed(packets, folder, [3, 4, 5], last=False)
    queries.run_append(queries.ingest(source.read_files(spark, folder)), path, dated="timestamp")
    stored = spark.read.parquet(path)
    assert sorted(r.id for r in stored.collect()) == sorted(r.id for r in packets.collect())
    assert "dt" in stored.columns


AT = datetime(2024, 3, 10, 12)


def hourly(first, last):
    return [(i, AT - timedelta(hours=3 * i), "10.0.0.1", "10.0.0.2", 1, 2, "TCP", 100, "ACK", 64) for i in range(first, last)]


def kept_ids(rows):
    return [i for i, t, *_ in rows if t >= AT - timedelta(days=3)]


def ids_of(spark, path):
    return sorted(r.id for r in store.read_traffic_log(spark, path).collect())


def test_retention_drops_days_and_replaces_files_of_the_edge(spark, tmp_path):
    path = f"{tmp_path}/log"
    for part in (hourly(0, 40), hourly(40, 90)):
        store.write_traffic_log(store.to_traffic_log(table(spark, part)), path)
    fresh_only = [(1000, AT - timedelta(days=3), *hourly(0, 1)[0][2:])]
    store.write_traffic_log(store.to_traffic_log(table(spark, fresh_only)), path)
    edge = sorted(p.name for p in (tmp_path / "log" / "dt=2024-03-07").glob("*.parquet"))
    rows = hourly(0, 90) + fresh_only
    for _ in range(2):
        retention.delete_expired(spark, path, days=3)
        assert ids_of(spark, path) == kept_ids(rows)
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == kept_ids(rows)
    left = {p.name for p in (tmp_path / "log" / "dt=2024-03-07").glob("*.parquet")}
    assert left & set(edge) and not (tmp_path / "log" / "_retention" / "plan.json").exists()
    retention.delete_expired(spark, path, days=0, as_of=AT + timedelta(days=9))
    assert ids_of(spark, path) == []
    retention.delete_expired(spark, path, days=0)


class Crash(Exception):
    pass


@pytest.mark.parametrize("appended", [False, True])
def test_retention_that_stops_anywhere_loses_no_row(spark, tmp_path, monkeypatch, appended):
    """A crash before every single file operation: rows are there, each once, at once and after the next call."""
    rows, more = hourly(0, 40), [(2000, AT - timedelta(days=2, hours=23), *hourly(0, 1)[0][2:])]
    wanted, stopped = kept_ids(rows), 0
    for at in range(60):
        path = f"{tmp_path}/log{at}"
        store.write_traffic_log(store.to_traffic_log(table(spark, rows)).repartition(1), path)
        store.write_traffic_log(store.to_traffic_log(table(spark, hourly(24, 26))).withColumn("id", F.col("id") + 500), path)
        steps = iter(range(at))
        with monkeypatch.context() as patched:
            for name in ("rename", "delete", "write", "make"):
                def step(self, *args, do=getattr(retention.Files, name)):
                    if next(steps, None) is None:
                        raise Crash(args)
                    return do(self, *args)

                patched.setattr(retention.Files, name, step)
            try:
                retention.delete_expired(spark, path, days=3)
                crashed = False
            except Crash:
                crashed, stopped = True, stopped + 1
        expired = [r[0] for r in rows if r[0] not in wanted] + [525]
        found = ids_of(spark, path)
        assert [i for i in found if i not in expired] == sorted([*wanted, 524]) and len(found) == len(set(found))
        if appended:
            store.write_traffic_log(store.to_traffic_log(table(spark, more)), path)
            assert 2000 in ids_of(spark, path)
        retention.delete_expired(spark, path, days=3, as_of=AT)
        assert ids_of(spark, path) == sorted([*wanted, 524, *([2000] if appended else [])])
        if not crashed:
            break
    assert stopped >= 6


def test_recent_rows_of_a_dated_log_prune_days(spark, tmp_path, capsys):
    from packetloom.operators import traffic

    at = datetime(2024, 3, 10, 0, 30)
    rows = [(i, at - timedelta(minutes=25 * i), "10.0.0.1", "10.0.0.2", 1, 2, "TCP", 100, "ACK", 64) for i in range(100)]
    store.write_traffic_log(store.to_traffic_log(table(spark, rows)), f"{tmp_path}/log")
    recent = traffic.since(store.read_traffic_log(spark, f"{tmp_path}/log"), 60)
    assert sorted(r.id for r in recent.collect()) == [0, 1, 2]
    recent.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line]
    assert filters and "dt" in filters[0]


def test_batches_run_with_the_settings_of_the_caller(spark, packets, tmp_path):
    """A stream's own session has no adaptive execution, and as many shuffle partitions as state has tasks."""
    folder, seen = f"{tmp_path}/in", []
    feed(packets, folder, [0, 1])
    keys = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")

    def write(rows, number):
        seen.append(tuple(rows.sparkSession.conf.get(k) for k in keys))

    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        held.run_windows(source.read_files(spark, folder, 2), lambda rows: rows, f"{tmp_path}/work", write=write)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "23"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen and set(seen) == {("true", "23")}


class Memory:
    """State of one key, in place of the engine's."""

    def __init__(self):
        self.map, self.value, self.timers, self.calls = {}, None, set(), 0

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return self

    def keys(self):
        return iter(self.map)

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.map[key], self.calls = value, self.calls + 1

    def removeKey(self, key):
        del self.map[key]

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.add(at)
        self.calls += 1

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_state_calls_follow_the_batches_not_the_windows():
    """A batch over a hundred windows is one entry and one timer; what is handed on is what has closed, each packet once."""
    import pandas as pd

    state, hold = Memory(), held._Hold(60_000_000)
    hold.init(state)
    minutes = list(range(100))
    rows = pd.DataFrame({c: minutes for c in held.schema.PACKET_COLUMNS} | {"window_us": [m * 60_000_000 for m in minutes]})
    list(hold.handleInputRows((0,), iter([rows, rows.iloc[:0]]), None))
    assert state.timers == {60_000} and len(state.map) == 1 and state.calls <= 3

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    given = []
    for watermark, closed in ((60_000 * 40, 40), (60_000 * 70 + 59_999, 70), (60_000 * 100, 100)):
        assert min(state.timers) <= watermark
        fired = min(state.timers)
        for pdf in hold.handleExpiredTimer((0,), At(watermark), None):
            assert set(pdf["passed_us"]) == {watermark * 1000}
            given += list(pdf["id"])
        state.timers.discard(fired)
        assert sorted(given) == list(range(closed))
    assert not state.map and not state.timers
