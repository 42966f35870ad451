"""The analysis report: every graph finding as (section, key, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.operators import graph, graph_search
from packetloom.session import cut


def _rows(df: DataFrame, section: str, key, value) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"), key.cast("string").alias("key"), value.cast("double").alias("value")
    )


def _one_row(df: DataFrame, section: str) -> DataFrame:
    """A one-row frame turned into one row per column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in df.columns])
    return df.select(F.explode(pairs).alias("e")).select(
        F.lit(section).alias("section"), F.col("e.k").alias("key"), F.col("e.v").alias("value")
    )


def analysis_report(packets: DataFrame, known_hosts: DataFrame | None = None) -> DataFrame:
    """Graph statistics, degrees, clustering, central nodes, scanners, targets, hubs, isolated hosts."""
    edge_table = cut(graph.edges(packets))
    vertex_table = cut(graph.vertices(edge_table))
    components = graph_search.connected_components(edge_table, vertex_table)
    local = graph_search.local_clustering(edge_table)
    ip = F.col("ip")
    parts = [
        _one_row(graph.graph_stats(edge_table, vertex_table, components), "graph_stats"),
        _one_row(graph.degree_stats(vertex_table), "degree_stats"),
        _rows(graph.degree_distribution(vertex_table), "degree_distribution", F.col("degree"), F.col("vertices")),
        _one_row(graph_search.average_clustering(local), "clustering"),
        *[
            _rows(graph.most_central(vertex_table, 5, kind), f"top_{kind}", ip, F.col("centrality"))
            for kind in ("degree", "in_degree", "out_degree")
        ],
        _rows(graph.port_scanners(edge_table, 10), "potential_scanners", ip, F.col("peers")),
        _rows(graph.ddos_targets(edge_table, 10), "potential_ddos_targets", ip, F.col("peers")),
        _rows(graph.hub_nodes(vertex_table, 2.0), "hub_nodes", ip, F.col("degree")),
    ]
    if known_hosts is not None:
        parts.append(_rows(graph.isolated(known_hosts, edge_table), "isolated_nodes", ip, F.lit(0)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
