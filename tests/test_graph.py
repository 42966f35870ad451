import random

import pytest
from pyspark.sql import functions as F

from packetloom.operators import graph, graph_search
from packetloom.operators.skew import skew_join

# A triangle of inner hosts whose second member talks to an outer server, which a third party pings.
TRIANGLE = [
    ("10.1.0.1", "10.1.0.2", 40, "TCP"),
    ("10.1.0.2", "10.1.0.3", 60, "TCP"),
    ("10.1.0.3", "10.1.0.1", 20, "UDP"),
    ("10.1.0.2", "203.0.113.7", 500, "TCP"),
    ("203.0.113.7", "10.1.0.2", 90, "TCP"),
    ("198.51.100.4", "203.0.113.7", 10, "ICMP"),
]
PAIR = "src_ip STRING, dst_ip STRING, packet_size BIGINT, protocol STRING"


def edges(spark, rows):
    return graph.edges(spark.createDataFrame(rows, PAIR))


@pytest.fixture(scope="module")
def triangle(spark):
    return edges(spark, TRIANGLE)


@pytest.fixture(scope="module")
def wheel(spark):
    """Six hosts in a ring, a middle one linked to all of them, and a host that probes twelve addresses."""
    rim = [f"10.2.0.{k}" for k in range(1, 7)]
    rows = [(a, b, 7, "TCP") for a, b in zip(rim, rim[1:] + rim[:1])] + [("10.2.0.100", host, 3, "UDP") for host in rim]
    return edges(spark, rows + [("10.2.9.9", f"10.3.0.{k}", 1, "TCP") for k in range(12)])


def test_triangle_with_a_server(triangle):
    vertices = {r["ip"]: r for r in graph.vertices(triangle).collect()}
    assert triangle.count() == 6 and len(vertices) == 5
    middle = vertices["10.1.0.2"]
    assert (middle["out_degree"], middle["in_degree"], middle["degree"], middle["total_bytes"]) == (2, 2, 4, 560)
    assert vertices["10.1.0.3"]["is_internal"] and not vertices["198.51.100.4"]["is_internal"]
    both = sorted((r["src_ip"], r["dst_ip"]) for r in graph.bidirectional(triangle).collect())
    assert both == [("10.1.0.2", "203.0.113.7"), ("203.0.113.7", "10.1.0.2")]
    assert graph.top_by_degree(graph.vertices(triangle), 2).select("ip", "degree").collect() == [("10.1.0.2", 4), ("203.0.113.7", 3)]


def test_weight_is_one_more_than_the_packets(spark):
    row = edges(spark, [("a", "b", 5, "TCP")] * 3).first()
    assert (row["packet_count"], row["weight"], row["byte_count"]) == (3, 4, 15)


def test_components_and_paths(triangle, wheel):
    assert graph_search.connected_components(triangle).select("component").distinct().count() == 1
    assert sorted(r["component"] for r in graph_search.connected_components(wheel).select("component").distinct().collect()) == [
        "10.2.0.1", "10.2.9.9"]
    path = [r["ip"] for r in graph_search.shortest_path(triangle, "198.51.100.4", "10.1.0.1").orderBy("step").collect()]
    assert path == ["198.51.100.4", "203.0.113.7", "10.1.0.2", "10.1.0.1"]
    assert [r["ip"] for r in graph_search.shortest_path(triangle, "10.1.0.3", "10.1.0.3").collect()] == ["10.1.0.3"]
    assert graph_search.shortest_path(triangle, "10.1.0.3", "10.1.0.77").isEmpty()
    assert graph_search.shortest_path(wheel, "10.2.0.1", "10.3.0.1").isEmpty()


def test_wheel_with_a_prober(wheel):
    assert [(r["ip"], r["peers"]) for r in graph.port_scanners(wheel, 10).collect()] == [("10.2.9.9", 12)]
    vertices = graph.vertices(wheel)
    assert [r["ip"] for r in graph.hub_nodes(vertices, 2.0).collect()] == ["10.2.9.9"]
    low, high = graph.degree_centrality(vertices).agg(F.min("centrality"), F.max("centrality")).first()
    assert (low, high) == (round(1 / 19, 4), round(12 / 19, 4))
    local = {r["ip"]: r["clustering"] for r in graph_search.local_clustering(wheel).collect()}
    assert (local["10.2.0.4"], local["10.2.0.100"], local["10.2.9.9"]) == (0.6667, 0.4, 0.0)


def test_self_loop_counts_as_a_neighbour(spark):
    rows = [("a", "a", 1, "TCP"), ("a", "b", 1, "TCP"), ("a", "c", 1, "TCP"), ("b", "c", 1, "TCP")]
    local = {r["ip"]: r for r in graph_search.local_clustering(edges(spark, rows)).collect()}
    # Neighbours a, b, c: all three pairs are connected.
    assert (local["a"]["neighbors"], local["a"]["clustering"]) == (3, 1.0)


def random_edges(seed, n=60, m=110):
    rng = random.Random(seed)
    rows = [(f"h{rng.randint(0, n):02d}", f"h{rng.randint(0, n):02d}", 1, "TCP") for _ in range(m)]
    return rows + [("h00", f"h{k:02d}", 1, "TCP") for k in range(5, 30)]


@pytest.mark.parametrize("seed", [1, 2])
def test_searches_against_plain_python(spark, seed):
    rows = random_edges(seed)
    table = edges(spark, rows)
    near = {}
    for a, b, *_ in rows:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)

    def walk(start):
        distance, queue = {start: 0}, [start]
        for u in queue:
            for v in near[u]:
                if v not in distance:
                    distance[v] = distance[u] + 1
                    queue.append(v)
        return distance

    reach = {u: walk(u) for u in near}
    labels = {r["ip"]: r["component"] for r in graph_search.connected_components(table, rows_per_task=4).collect()}
    assert labels == {u: min(reach[u]) for u in near}
    chosen = spark.createDataFrame([("h00",), ("h07",)], "ip STRING")
    chosen = chosen.join(graph.vertices(table).select("ip"), "ip")
    got = {(r["source"], r["ip"]): r["distance"] for r in graph_search.bfs_distances(table, chosen, 4).collect()}
    assert got == {(s, v): d for s in ("h00", "h07") if s in near for v, d in reach[s].items()}
    local = {r["ip"]: r["closed_pairs"] for r in graph_search.local_clustering(table, rows_per_task=4).collect()}
    for u, mine in near.items():
        mine = sorted(mine)
        assert local[u] == sum(w in near[v] for k, v in enumerate(mine) for w in mine[k + 1:])


def test_skew_join_equals_join(spark):
    left = spark.range(200).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), F.col("id").alias("x"))
    right = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "k BIGINT, y STRING")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(tuple, left.join(right, "k", how).collect()), key=str)
        got = skew_join(left, right, ["k"], ["x"], how, rows_per_task=10)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_approximate_closeness_is_close(wheel):
    exact = {r["ip"]: r["centrality"] for r in graph_search.closeness(wheel).collect()}
    near = {r["ip"]: r["centrality"] for r in graph_search.approximate_closeness(wheel).collect()}
    assert set(exact) == set(near)
    assert all(abs(near[k] - exact[k]) <= 0.05 * max(exact[k], 0.1) for k in exact)


def test_unknown_centrality(triangle):
    with pytest.raises(ValueError):
        graph.most_central(graph.vertices(triangle), 3, "betweenness")


def test_flagged_addresses_count_all_alerts(spark):
    from packetloom.operators import alerts

    table = spark.range(250).selectExpr(
        "id", "timestampadd(SECOND, id, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS timestamp", "'10.0.0.' || (id % 5) AS src_ip",
        "CAST(NULL AS STRING) AS dst_ip", "'anomaly' AS alert_type", "CASE WHEN id = 0 THEN 4 ELSE 1 END AS severity")
    none = spark.createDataFrame([], "ip STRING, peers BIGINT")
    got = {r["ip"]: (r["alert_count"], r["highest_severity"]) for r in alerts.flagged_ips(table, none, none).collect()}
    assert got == {"10.0.0.0": (50, 4)} | {f"10.0.0.{k}": (50, 1) for k in range(1, 5)}


def test_a_large_clique_has_short_lists(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "LIST_PIECE", 8)
    hosts = [f"h{k:02d}" for k in range(40)]
    rows = [(a, b, 1, "TCP") for i, a in enumerate(hosts) for b in hosts[i + 1:]]
    local = graph_search.local_clustering(edges(spark, rows + [("h00", "x", 1, "TCP")]), rows_per_task=100)
    got = {r["ip"]: (r["neighbors"], r["closed_pairs"]) for r in local.collect()}
    assert got == {h: (39, 741) for h in hosts[1:]} | {"h00": (40, 741), "x": (1, 0)}


def test_closeness_rounds_follow_the_largest_component(spark, monkeypatch):
    """Sources of different components share bits: 60 chains of 5 spread at once, one of 150 sources in three rounds."""
    calls = []
    spread = graph_search._spread
    monkeypatch.setattr(graph_search, "_spread", lambda *args: calls.append(args[3]) or spread(*args))
    short = [(f"c{c}v{k}", f"c{c}v{k + 1}") for c in range(60) for k in range(4)]
    star = [("hub", f"leaf{k}") for k in range(149)]

    def edges(pairs):
        return spark.createDataFrame([(a, b) for a, b in pairs] + [("self", "self")], "src_ip STRING, dst_ip STRING")

    few = {r.ip: (r.reachable, r.total_distance) for r in graph_search.closeness(edges(short), words=1).collect()}
    assert calls == [0]
    assert few["self"] == (0, 0) and few["c7v0"] == (4, 10) and few["c59v2"] == (4, 6) and len(few) == 301
    calls.clear()
    both = {r.ip: (r.reachable, r.total_distance) for r in graph_search.closeness(edges(short + star), words=1).collect()}
    assert calls == [0, 64, 128]
    assert both == few | {"hub": (149, 149)} | {f"leaf{k}": (149, 1 + 2 * 148) for k in range(149)}
    assert graph_search.closeness(edges(short).limit(0)).count() == 0
