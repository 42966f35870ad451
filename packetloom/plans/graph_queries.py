"""Registered queries: the communication graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.operators import graph, graph_search
from packetloom.plans import report
from packetloom.plans.registry import query
from packetloom.plans.traffic_queries import INTERNAL_SQL
from packetloom.session import cut
from packetloom.sources.packets import load_packets

GRAPH_SQL = f"""
edges0 AS (SELECT src_ip, dst_ip, count(*) AS packet_count, CAST(sum(packet_size) AS BIGINT) AS byte_count,
  array_to_string(list_sort(list(DISTINCT protocol)), ',') AS protocols FROM packets GROUP BY 1, 2),
edges AS (SELECT e.*, e.packet_count + 1 AS weight, EXISTS (SELECT 1 FROM edges0 r WHERE r.src_ip = e.dst_ip
  AND r.dst_ip = e.src_ip) AS is_bidirectional FROM edges0 e),
vertices AS (SELECT ip, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree,
  CAST(sum(i) + sum(o) AS BIGINT) AS degree, CAST(sum(b) AS BIGINT) AS total_bytes, CAST(sum(p) AS BIGINT)
  AS packet_count, {INTERNAL_SQL.format('ip')} AS is_internal
  FROM (SELECT src_ip AS ip, 0 AS i, 1 AS o, byte_count AS b, packet_count AS p FROM edges0
    UNION ALL SELECT dst_ip, 1, 0, 0, 0 FROM edges0) q GROUP BY ip),
adj AS (SELECT src_ip AS u, dst_ip AS v FROM edges0 WHERE src_ip <> dst_ip
  UNION SELECT dst_ip, src_ip FROM edges0 WHERE src_ip <> dst_ip),
dstats AS (SELECT round(sum(degree) / count(*), 2) AS mean,
  round((count(*) * sum(CAST(degree AS HUGEINT) * degree) - sum(degree) * sum(degree))::DOUBLE / count(*) / count(*), 2)
    AS variance,
  round(sqrt((count(*) * sum(CAST(degree AS HUGEINT) * degree) - sum(degree) * sum(degree))::DOUBLE
    / count(*) / count(*)), 2) AS std_dev, min(degree) AS min, max(degree) AS max FROM vertices)
"""

COMPONENT_SQL = """
reach(a, b) AS (SELECT ip, ip FROM vertices UNION SELECT r.a, x.v FROM reach r JOIN adj x ON r.b = x.u),
components AS (SELECT a AS ip, min(b) AS component FROM reach GROUP BY a)
"""

DISTANCE_SQL = """
hops(source, ip, distance) USING KEY (source, ip) AS (SELECT ip, ip, 0 FROM vertices
  UNION SELECT h.source, x.v, min(h.distance) + 1 FROM hops h JOIN adj x ON h.ip = x.u
  WHERE NOT EXISTS (SELECT 1 FROM recurring.hops r WHERE r.source = h.source AND r.ip = x.v) GROUP BY 1, 2),
dist AS (SELECT * FROM hops)
"""

CLUSTER_SQL = """
nb AS (SELECT u AS ip, count(*) AS neighbors FROM adj GROUP BY 1),
tri AS (SELECT x.u AS ip, count(*) AS c FROM adj x JOIN adj y ON x.u = y.u AND x.v < y.v
  JOIN adj z ON z.u = x.v AND z.v = y.v GROUP BY 1),
local AS (SELECT nb.ip, neighbors, coalesce(c, 0) AS closed_pairs, CASE WHEN neighbors < 2 THEN 0.0::DOUBLE
  ELSE round(2.0::DOUBLE * coalesce(c, 0) / (neighbors * (neighbors - 1)), 4) END AS clustering
  FROM nb LEFT JOIN tri ON nb.ip = tri.ip)
"""

CENTRAL = "SELECT ip, round({0}::DOUBLE / ((SELECT count(*) FROM vertices) - 1), 4) AS centrality FROM vertices"


def _edges(spark, sf):
    return graph.edges(load_packets(spark, sf).select("src_ip", "dst_ip", "packet_size", "protocol"))


def _vertices(spark, sf):
    return graph.vertices(_edges(spark, sf))


def _text(edge_table):
    return edge_table.withColumn("protocols", F.array_join("protocols", ","))


@query("graph_edges", "SELECT * FROM edges", GRAPH_SQL)
def graph_edges(spark, sf):
    return _text(_edges(spark, sf))


@query("graph_vertices", "SELECT * FROM vertices", GRAPH_SQL)
def graph_vertices(spark, sf):
    return _vertices(spark, sf)


@query("bidirectional", "SELECT src_ip, dst_ip FROM edges WHERE is_bidirectional", GRAPH_SQL)
def bidirectional(spark, sf):
    return graph.bidirectional(_edges(spark, sf))


@query("pair_bytes", "SELECT src_ip, dst_ip, byte_count FROM edges", GRAPH_SQL)
def pair_bytes(spark, sf):
    return graph.pair_bytes(_edges(spark, sf))


STATS_SQL = """SELECT count(*) AS vertex_count, (SELECT count(*) FROM edges) AS edge_count,
    round((SELECT count(*) FROM edges)::DOUBLE / (count(*) * (count(*) - 1)), 4) AS density,
    round(sum(degree) / count(*), 2) AS avg_degree, max(degree) AS max_degree, min(degree) AS min_degree,
    count(*) FILTER (is_internal) AS internal_nodes, count(*) FILTER (NOT is_internal) AS external_nodes,
    (SELECT count(DISTINCT component) FROM components) AS components FROM vertices"""


@query("graph_stats", STATS_SQL, [GRAPH_SQL, COMPONENT_SQL])
def graph_stats(spark, sf):
    edge_table = cut(_edges(spark, sf))
    vertex_table = graph.vertices(edge_table)
    return graph.graph_stats(edge_table, vertex_table, graph_search.connected_components(edge_table))


@query("degree_distribution", "SELECT degree, count(*) AS vertices FROM vertices GROUP BY 1", GRAPH_SQL)
def degree_distribution(spark, sf):
    return graph.degree_distribution(_vertices(spark, sf))


@query("degree_stats", "SELECT * FROM dstats", GRAPH_SQL)
def degree_stats(spark, sf):
    return graph.degree_stats(_vertices(spark, sf))


@query("degree_centrality", CENTRAL.format("degree"), GRAPH_SQL)
def degree_centrality(spark, sf):
    return graph.degree_centrality(_vertices(spark, sf))


@query("degree_centrality_in", CENTRAL.format("in_degree"), GRAPH_SQL)
def degree_centrality_in(spark, sf):
    return graph.in_degree_centrality(_vertices(spark, sf))


@query("degree_centrality_out", CENTRAL.format("out_degree"), GRAPH_SQL)
def degree_centrality_out(spark, sf):
    return graph.out_degree_centrality(_vertices(spark, sf))


@query("most_central", CENTRAL.format("degree") + " ORDER BY 2 DESC, 1 LIMIT 5", GRAPH_SQL)
def most_central(spark, sf):
    return graph.most_central(_vertices(spark, sf), 5, "degree")


@query("most_central_in", CENTRAL.format("in_degree") + " ORDER BY 2 DESC, 1 LIMIT 5", GRAPH_SQL)
def most_central_in(spark, sf):
    return graph.most_central(_vertices(spark, sf), 5, "in_degree")


@query("most_central_out", CENTRAL.format("out_degree") + " ORDER BY 2 DESC, 1 LIMIT 5", GRAPH_SQL)
def most_central_out(spark, sf):
    return graph.most_central(_vertices(spark, sf), 5, "out_degree")


@query(
    "high_degree",
    "SELECT v.* FROM vertices v, dstats s WHERE degree > mean + 2.0 * std_dev",
    GRAPH_SQL,
)
def high_degree(spark, sf):
    return graph.high_degree(_vertices(spark, sf), 2.0)


@query(
    "hub_nodes",
    """SELECT ip, degree, in_degree, out_degree, total_bytes, is_internal,
    out_degree / greatest(in_degree, 1) AS ratio FROM vertices, dstats WHERE degree > mean + 3.0 * std_dev""",
    GRAPH_SQL,
)
def hub_nodes(spark, sf):
    return graph.hub_nodes(_vertices(spark, sf), 3.0)


@query("top_by_degree", "SELECT * FROM vertices ORDER BY degree DESC, ip LIMIT 10", GRAPH_SQL)
def top_by_degree(spark, sf):
    return graph.top_by_degree(_vertices(spark, sf), 10)


@query("top_by_traffic", "SELECT * FROM vertices ORDER BY total_bytes DESC, ip LIMIT 10", GRAPH_SQL)
def top_by_traffic(spark, sf):
    return graph.top_by_traffic(_vertices(spark, sf), 10)


@query("port_scanners", "SELECT ip, out_degree AS peers FROM vertices WHERE out_degree >= 10", GRAPH_SQL)
def port_scanners(spark, sf):
    return graph.port_scanners(_edges(spark, sf), 10)


@query("ddos_targets", "SELECT ip, in_degree AS peers FROM vertices WHERE in_degree >= 10", GRAPH_SQL)
def ddos_targets(spark, sf):
    return graph.ddos_targets(_edges(spark, sf), 10)


def _hosts(spark, sf):
    """An inventory of hosts, here one per customer."""
    return spark.read.parquet(f"{sf}/customer.parquet").selectExpr(
        "'10.0.' || CAST(c_custkey DIV 250 AS STRING) || '.' || CAST(c_custkey % 250 AS STRING) AS ip"
    )


ISOLATED_SQL = """SELECT DISTINCT '10.0.' || CAST(c_custkey // 250 AS VARCHAR) || '.' || CAST(c_custkey % 250 AS VARCHAR)
    AS ip FROM customer WHERE '10.0.' || CAST(c_custkey // 250 AS VARCHAR) || '.' || CAST(c_custkey % 250 AS VARCHAR)
    NOT IN (SELECT ip FROM vertices)"""


@query("isolated", ISOLATED_SQL, GRAPH_SQL)
def isolated(spark, sf):
    """Hosts of an inventory that never appear in the traffic."""
    return graph.isolated(_hosts(spark, sf), _edges(spark, sf))


@query(
    "asymmetry",
    "SELECT ip, round(out_degree / in_degree, 2) AS ratio FROM vertices WHERE in_degree > 0 AND out_degree > 0",
    GRAPH_SQL,
)
def asymmetry(spark, sf):
    return graph.asymmetry(_vertices(spark, sf))


@query(
    "adjacency",
    """SELECT a.p AS i, b.p AS j, weight FROM edges
    JOIN (SELECT ip, row_number() OVER (ORDER BY ip) - 1 AS p FROM vertices) a ON src_ip = a.ip
    JOIN (SELECT ip, row_number() OVER (ORDER BY ip) - 1 AS p FROM vertices) b ON dst_ip = b.ip""",
    GRAPH_SQL,
)
def adjacency(spark, sf):
    edge_table = cut(_edges(spark, sf))
    return graph.adjacency(edge_table, graph.vertices(edge_table))


def _probes(edge_table):
    """Every edge's source with the edge two groups of addresses further: hits and misses."""
    return edge_table.select("src_ip", F.regexp_replace("dst_ip", "[0-9]$", "3").alias("dst_ip")).distinct()


PROBE_SQL = "probes AS (SELECT DISTINCT src_ip, regexp_replace(dst_ip, '[0-9]$', '3') AS dst_ip FROM edges0)"


@query(
    "vertex_lookup",
    """SELECT p.ip, v.degree, v.total_bytes FROM (SELECT DISTINCT dst_ip AS ip FROM probes) p
    LEFT JOIN vertices v ON p.ip = v.ip""",
    [GRAPH_SQL, PROBE_SQL],
)
def vertex_lookup(spark, sf):
    edge_table = _edges(spark, sf)
    probes = _probes(edge_table).select(F.col("dst_ip").alias("ip")).distinct()
    return graph.probe_vertices(probes, graph.vertices(edge_table)).select("ip", "degree", "total_bytes")


@query(
    "edge_lookup",
    """SELECT p.src_ip, p.dst_ip, e.weight, e.byte_count FROM probes p
    LEFT JOIN edges e ON p.src_ip = e.src_ip AND p.dst_ip = e.dst_ip""",
    [GRAPH_SQL, PROBE_SQL],
)
def edge_lookup(spark, sf):
    edge_table = _edges(spark, sf)
    return graph.probe_edges(_probes(edge_table), edge_table).select("src_ip", "dst_ip", "weight", "byte_count")


@query(
    "is_connected",
    """SELECT p.src_ip, p.dst_ip, EXISTS (SELECT 1 FROM edges0 e WHERE (e.src_ip = p.src_ip AND e.dst_ip = p.dst_ip)
    OR (e.src_ip = p.dst_ip AND e.dst_ip = p.src_ip)) AS connected FROM probes p""",
    [GRAPH_SQL, PROBE_SQL],
)
def is_connected(spark, sf):
    edge_table = _edges(spark, sf)
    return graph.probe_connected(_probes(edge_table), edge_table)


@query(
    "enrich_edges",
    """SELECT e.src_ip, e.dst_ip, e.weight, a.degree AS src_degree, a.is_internal AS src_internal,
    b.degree AS dst_degree, b.is_internal AS dst_internal FROM edges e JOIN vertices a ON e.src_ip = a.ip
    JOIN vertices b ON e.dst_ip = b.ip""",
    GRAPH_SQL,
)
def enrich_edges(spark, sf):
    edge_table = cut(_edges(spark, sf))
    return graph.enrich_edges(edge_table, graph.vertices(edge_table)).select(
        "src_ip", "dst_ip", "weight", "src_degree", "src_internal", "dst_degree", "dst_internal"
    )


@query(
    "graph_export",
    """SELECT 'vertex' AS kind, '{"id":"' || ip || '","label":"' || ip || '","in_degree":' || in_degree
    || ',"out_degree":' || out_degree || ',"degree":' || degree || ',"total_bytes":' || total_bytes
    || ',"packet_count":' || packet_count || ',"is_internal":' || CAST(is_internal AS VARCHAR) || '}' AS document
    FROM vertices UNION ALL SELECT 'edge', '{"source":"' || src_ip || '","target":"' || dst_ip || '","weight":'
    || weight || ',"byte_count":' || byte_count || ',"protocols":["' || replace(protocols, ',', '","')
    || '"],"is_bidirectional":' || CAST(is_bidirectional AS VARCHAR) || '}' FROM edges""",
    GRAPH_SQL,
)
def graph_export(spark, sf):
    edge_table = cut(_edges(spark, sf))
    return graph.to_json_lines(edge_table, graph.vertices(edge_table))


# --- iterative ------------------------------------------------------------------

@query("connected_components", "SELECT * FROM components", [GRAPH_SQL, COMPONENT_SQL])
def connected_components(spark, sf):
    return graph_search.connected_components(cut(_edges(spark, sf)))


@query("local_clustering", "SELECT * FROM local", [GRAPH_SQL, CLUSTER_SQL])
def local_clustering(spark, sf):
    return graph_search.local_clustering(cut(_edges(spark, sf)))


@query(
    "avg_clustering",
    "SELECT round(sum(clustering) / count(*), 4) AS avg_clustering FROM local",
    [GRAPH_SQL, CLUSTER_SQL],
)
def avg_clustering(spark, sf):
    return graph_search.average_clustering(graph_search.local_clustering(cut(_edges(spark, sf))))


@query("bfs_distances", "SELECT * FROM dist", [GRAPH_SQL, DISTANCE_SQL])
def bfs_distances(spark, sf):
    return graph_search.bfs_distances(cut(_edges(spark, sf)))


CLOSENESS_SQL = """SELECT source AS ip, count(*) FILTER (distance > 0) AS reachable,
    CAST(sum(distance) AS BIGINT) AS total_distance, round(coalesce(
      (count(*) FILTER (distance > 0))::DOUBLE / ((SELECT count(*) FROM vertices) - 1)
      * ((count(*) FILTER (distance > 0))::DOUBLE / nullif(sum(distance), 0)), 0), 4) AS centrality
    FROM dist GROUP BY 1"""


@query("closeness", CLOSENESS_SQL, [GRAPH_SQL, DISTANCE_SQL])
def closeness(spark, sf):
    return graph_search.closeness(cut(_edges(spark, sf)))


@query("most_central_closeness", f"SELECT ip, centrality FROM ({CLOSENESS_SQL}) c ORDER BY 2 DESC, 1 LIMIT 5", [GRAPH_SQL, DISTANCE_SQL])
def most_central_closeness(spark, sf):
    edge_table = cut(_edges(spark, sf))
    return graph.most_central(graph.vertices(edge_table), 5, "closeness", graph_search.closeness(edge_table))


@query("closeness_approx", CLOSENESS_SQL, [GRAPH_SQL, DISTANCE_SQL])
def closeness_approx(spark, sf):
    """Below some hundred vertices a sketch holds every one of them, so its sums are exact there."""
    return graph_search.approximate_closeness(cut(_edges(spark, sf)))


@query("closeness_error", "SELECT ip, true AS within FROM vertices", GRAPH_SQL)
def closeness_error(spark, sf):
    """Whether the sketched closeness of a vertex lies within a twentieth (or 0.005) of the exact one."""
    edge_table = cut(_edges(spark, sf))
    near = graph_search.approximate_closeness(edge_table).select("ip", F.col("centrality").alias("near"))
    both = graph_search.closeness(edge_table).join(near, "ip")
    bound = F.greatest(0.05 * F.col("centrality"), F.lit(0.005))
    return both.select("ip", (F.abs(F.col("near") - F.col("centrality")) <= bound).alias("within"))


@query(
    "shortest_path",
    """SELECT CAST(distance AS INT) AS step, ip FROM walk""",
    [
        GRAPH_SQL,
        """hops(ip, distance) USING KEY (ip) AS (SELECT '10.0.0.8', 0 UNION SELECT x.v, min(h.distance) + 1 FROM hops h
          JOIN adj x ON h.ip = x.u WHERE NOT EXISTS (SELECT 1 FROM recurring.hops r WHERE r.ip = x.v) GROUP BY 1),
        dist AS (SELECT * FROM hops),
        walk(ip, distance) AS (SELECT ip, distance FROM dist WHERE ip = '10.0.0.98'
          UNION ALL SELECT (SELECT min(x.v) FROM adj x JOIN dist d ON d.ip = x.v AND d.distance = w.distance - 1
            WHERE x.u = w.ip), w.distance - 1 FROM walk w WHERE w.distance > 0)""",
    ],
)
def shortest_path(spark, sf):
    return graph_search.shortest_path(cut(_edges(spark, sf)), "10.0.0.8", "10.0.0.98")


@query(
    "analysis_report",
    f"""SELECT 'graph_stats' AS section, key, value::DOUBLE AS value FROM (
      UNPIVOT (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM ({STATS_SQL}) s) ON COLUMNS(*) INTO NAME key VALUE value) a
    UNION ALL SELECT 'degree_stats', key, value FROM (
      UNPIVOT (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM dstats) ON COLUMNS(*) INTO NAME key VALUE value) b
    UNION ALL SELECT 'degree_distribution', CAST(degree AS VARCHAR), count(*) FROM vertices GROUP BY degree
    UNION ALL SELECT 'clustering', 'avg_clustering', round(sum(clustering) / count(*), 4) FROM local
    UNION ALL SELECT 'top_degree', * FROM ({CENTRAL.format('degree')} ORDER BY 2 DESC, 1 LIMIT 5) c
    UNION ALL SELECT 'top_in_degree', * FROM ({CENTRAL.format('in_degree')} ORDER BY 2 DESC, 1 LIMIT 5) d
    UNION ALL SELECT 'top_out_degree', * FROM ({CENTRAL.format('out_degree')} ORDER BY 2 DESC, 1 LIMIT 5) e
    UNION ALL SELECT 'potential_scanners', ip, out_degree FROM vertices WHERE out_degree >= 10
    UNION ALL SELECT 'potential_ddos_targets', ip, in_degree FROM vertices WHERE in_degree >= 10
    UNION ALL SELECT 'hub_nodes', ip, degree FROM vertices, dstats WHERE degree > mean + 2.0 * std_dev
    UNION ALL SELECT 'isolated_nodes', ip, 0 FROM ({ISOLATED_SQL}) f""",
    [GRAPH_SQL, COMPONENT_SQL, CLUSTER_SQL],
)
def analysis_report(spark, sf):
    return report.analysis_report(load_packets(spark, sf), _hosts(spark, sf))
