"""The who-talks-to-whom graph: edges, vertices, degrees and reports on them.

An *edge* is a directed pair with counters, a *vertex* an address. All functions
after ``edges`` read the edge table, which is far smaller than the packets;
callers that use it more than once should persist it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import net
from packetloom.operators.ordering import with_global_index
from packetloom.operators.skew import skew_join
from packetloom.operators.traffic import pair_protocol_counts


def edges(packets: DataFrame, limit: int | None = None) -> DataFrame:
    """Directed edges; ``weight`` is one more than the packet count.

    The packets are first reduced per (src, dst, protocol). Bidirectionality needs
    no self join: grouping by undirected pair shows whether both directions occur,
    with at most two entries per pair.
    """
    base = pair_protocol_counts(packets, times=False).groupBy("src_ip", "dst_ip").agg(
        F.sum("packet_count").alias("packet_count"),
        F.sum("total_bytes").alias("byte_count"),
        F.array_sort(F.collect_list("protocol")).alias("protocols"),
    )
    if limit is not None:
        base = base.orderBy(F.desc("packet_count"), "src_ip", "dst_ip").limit(limit)
    paired = base.groupBy(F.least("src_ip", "dst_ip").alias("_a"), F.greatest("src_ip", "dst_ip").alias("_b")).agg(
        F.collect_list(F.struct("src_ip", "dst_ip", "packet_count", "byte_count", "protocols")).alias("_d")
    )
    return paired.select(
        F.explode("_d").alias("e"), ((F.size("_d") == 2) | (F.col("_a") == F.col("_b"))).alias("is_bidirectional")
    ).select("e.*", (F.col("e.packet_count") + 1).alias("weight"), "is_bidirectional")


def vertices(edge_table: DataFrame) -> DataFrame:
    """Degrees count distinct neighbours per direction; bytes and packets are those sent."""
    ends = edge_table.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("src_ip").alias("ip"), F.lit(0).alias("i"), F.lit(1).alias("o"),
                    F.col("byte_count").alias("b"), F.col("packet_count").alias("p"),
                ),
                F.struct(
                    F.col("dst_ip").alias("ip"), F.lit(1).alias("i"), F.lit(0).alias("o"),
                    F.lit(0).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("p"),
                ),
            )
        ).alias("v")
    ).select("v.*")
    return (
        ends.groupBy("ip")
        .agg(
            F.sum("i").alias("in_degree"),
            F.sum("o").alias("out_degree"),
            F.sum("b").alias("total_bytes"),
            F.sum("p").alias("packet_count"),
        )
        .select(
            "ip", "in_degree", "out_degree", (F.col("in_degree") + F.col("out_degree")).alias("degree"),
            "total_bytes", "packet_count", net.is_internal_ip("ip").alias("is_internal"),
        )
    )


def pair_bytes(edge_table: DataFrame) -> DataFrame:
    return edge_table.select("src_ip", "dst_ip", "byte_count")


def bidirectional(edge_table: DataFrame) -> DataFrame:
    return edge_table.where("is_bidirectional").select("src_ip", "dst_ip")


def graph_stats(edge_table: DataFrame, vertex_table: DataFrame, components: DataFrame | None = None) -> DataFrame:
    """One row; zeros for an empty graph. ``components`` is (ip, component) if wanted."""
    m = edge_table.agg(F.count("*")).scalar()
    n = F.count("*")
    one = vertex_table.agg(
        n.alias("vertex_count"),
        m.alias("edge_count"),
        F.round(F.when(n > 1, m / (n * (n - 1))).otherwise(m / F.lit(1)), 4).alias("density"),
        F.round(F.coalesce(F.sum("degree"), F.lit(0)) / F.greatest(n, F.lit(1)), 2).alias("avg_degree"),
        F.coalesce(F.max("degree"), F.lit(0)).alias("max_degree"),
        F.coalesce(F.min("degree"), F.lit(0)).alias("min_degree"),
        F.count_if("is_internal").alias("internal_nodes"),
        F.count_if(~F.col("is_internal")).alias("external_nodes"),
    )
    if components is not None:
        one = one.withColumn("components", components.agg(F.count_distinct("component")).scalar())
    return one


def degree_distribution(vertex_table: DataFrame) -> DataFrame:
    return vertex_table.groupBy("degree").agg(F.count("*").alias("vertices")).orderBy("degree")


def degree_stats(vertex_table: DataFrame) -> DataFrame:
    """Population moments from exact integer sums, rounded to two places."""
    n, s, q = F.count("*"), F.sum("degree"), F.sum(F.col("degree") * F.col("degree"))
    d = F.greatest(n, F.lit(1))
    spread = F.coalesce((n * q - s * s).cast("double"), F.lit(0.0)) / d / d
    return vertex_table.agg(
        F.round(F.coalesce(s, F.lit(0)) / d, 2).alias("mean"),
        F.round(spread, 2).alias("variance"),
        F.round(F.sqrt(spread), 2).alias("std_dev"),
        F.coalesce(F.min("degree"), F.lit(0)).alias("min"),
        F.coalesce(F.max("degree"), F.lit(0)).alias("max"),
    )


def _centrality(vertex_table: DataFrame, column: str) -> DataFrame:
    n = vertex_table.agg(F.count("*")).scalar()
    return vertex_table.select(
        "ip", F.when(n > 1, F.round(F.col(column) / (n - 1), 4)).otherwise(0.0).alias("centrality")
    )


def degree_centrality(vertex_table: DataFrame) -> DataFrame:
    return _centrality(vertex_table, "degree")


def in_degree_centrality(vertex_table: DataFrame) -> DataFrame:
    return _centrality(vertex_table, "in_degree")


def out_degree_centrality(vertex_table: DataFrame) -> DataFrame:
    return _centrality(vertex_table, "out_degree")


def most_central(vertex_table: DataFrame, n: int = 10, kind: str = "degree", closeness: DataFrame | None = None):
    """Top ``n`` by a centrality; ``closeness`` needs its (ip, centrality) table."""
    makers = {"degree": degree_centrality, "in_degree": in_degree_centrality, "out_degree": out_degree_centrality}
    if kind == "closeness" and closeness is not None:
        scores = closeness.select("ip", "centrality")
    elif kind in makers:
        scores = makers[kind](vertex_table)
    else:
        raise ValueError(f"unknown centrality {kind!r}")
    return scores.orderBy(F.desc("centrality"), "ip").limit(n)


def _threshold(vertex_table: DataFrame, factor: float) -> Column:
    """mean + factor * deviation, from the rounded statistics."""
    return degree_stats(vertex_table).select(F.col("mean") + F.lit(float(factor)) * F.col("std_dev")).scalar()


def high_degree(vertex_table: DataFrame, factor: float = 2.0) -> DataFrame:
    return vertex_table.where(F.col("degree") > _threshold(vertex_table, factor)).orderBy(F.desc("degree"), "ip")


def hub_nodes(vertex_table: DataFrame, factor: float = 3.0) -> DataFrame:
    ratio = F.col("out_degree") / F.greatest("in_degree", F.lit(1))
    return high_degree(vertex_table, factor).select(
        "ip", "degree", "in_degree", "out_degree", "total_bytes", "is_internal", ratio.alias("ratio")
    )


def top_by_degree(vertex_table: DataFrame, n: int = 10) -> DataFrame:
    return vertex_table.orderBy(F.desc("degree"), "ip").limit(n)


def top_by_traffic(vertex_table: DataFrame, n: int = 10) -> DataFrame:
    return vertex_table.orderBy(F.desc("total_bytes"), "ip").limit(n)


def port_scanners(edge_table: DataFrame, threshold: int = 20) -> DataFrame:
    """Sources with at least ``threshold`` distinct destinations (edges are distinct pairs)."""
    return (
        edge_table.groupBy(F.col("src_ip").alias("ip"))
        .agg(F.count("*").alias("peers"))
        .where(F.col("peers") >= threshold)
        .orderBy(F.desc("peers"), "ip")
    )


def ddos_targets(edge_table: DataFrame, threshold: int = 20) -> DataFrame:
    return (
        edge_table.groupBy(F.col("dst_ip").alias("ip"))
        .agg(F.count("*").alias("peers"))
        .where(F.col("peers") >= threshold)
        .orderBy(F.desc("peers"), "ip")
    )


def isolated(known_hosts: DataFrame, edge_table: DataFrame) -> DataFrame:
    """Known hosts without any edge."""
    seen = edge_table.select(F.explode(F.array("src_ip", "dst_ip")).alias("ip")).distinct()
    return known_hosts.select("ip").distinct().join(seen, "ip", "left_anti")


def asymmetry(vertex_table: DataFrame) -> DataFrame:
    ratio = F.round(F.col("out_degree") / F.col("in_degree"), 2)
    return (
        vertex_table.where((F.col("in_degree") > 0) & (F.col("out_degree") > 0))
        .select("ip", ratio.alias("ratio"))
        .orderBy(F.desc(F.abs(F.col("ratio") - 1)), "ip")
    )


def adjacency(edge_table: DataFrame, vertex_table: DataFrame) -> DataFrame:
    """Sparse matrix (i, j, weight); positions follow the sorted addresses, from 0."""
    position = with_global_index(vertex_table.select("ip"), order=("ip",)).df.select(
        "ip", (F.col("i") - 1).alias("pos")
    )
    rows = position.select(F.col("ip").alias("src_ip"), F.col("pos").alias("i"))
    columns = position.select(F.col("ip").alias("dst_ip"), F.col("pos").alias("j"))
    placed = skew_join(
        skew_join(edge_table.select("src_ip", "dst_ip", "weight"), rows, ["src_ip"], ["dst_ip"]),
        columns, ["dst_ip"], ["src_ip"],
    )
    return placed.select("i", "j", "weight")


def dense_block(edge_table: DataFrame, vertex_table: DataFrame, n: int = 10) -> DataFrame:
    """The dense matrix of the ``n`` busiest addresses, one column per address."""
    chosen = [r["ip"] for r in top_by_degree(vertex_table, n).select("ip").collect()]
    hit = edge_table.where(F.col("src_ip").isin(chosen) & F.col("dst_ip").isin(chosen))
    return hit.groupBy("src_ip").pivot("dst_ip", sorted(chosen)).agg(F.sum("weight")).fillna(0)


def probe_vertices(probes: DataFrame, vertex_table: DataFrame) -> DataFrame:
    """Point lookups as a batch: every probe ``ip`` with its vertex, or NULLs."""
    return probes.join(vertex_table, "ip", "left")


def probe_edges(probes: DataFrame, edge_table: DataFrame) -> DataFrame:
    return probes.join(edge_table, ["src_ip", "dst_ip"], "left")


def probe_connected(probes: DataFrame, edge_table: DataFrame) -> DataFrame:
    """Whether an edge exists in either direction between each (src_ip, dst_ip) probe."""
    pairs = edge_table.select(
        F.least("src_ip", "dst_ip").alias("_a"), F.greatest("src_ip", "dst_ip").alias("_b"), F.lit(True).alias("_hit")
    ).distinct()
    keyed = probes.withColumns({"_a": F.least("src_ip", "dst_ip"), "_b": F.greatest("src_ip", "dst_ip")})
    return keyed.join(pairs, ["_a", "_b"], "left").select(
        "src_ip", "dst_ip", F.coalesce("_hit", F.lit(False)).alias("connected")
    )


def enrich_edges(edge_table: DataFrame, vertex_table: DataFrame) -> DataFrame:
    """Edges with degree and location of both ends; the edges of hubs are split."""
    side = vertex_table.select("ip", "degree", "is_internal")
    src = side.select(F.col("ip").alias("src_ip"), F.col("degree").alias("src_degree"),
                      F.col("is_internal").alias("src_internal"))
    dst = side.select(F.col("ip").alias("dst_ip"), F.col("degree").alias("dst_degree"),
                      F.col("is_internal").alias("dst_internal"))
    return skew_join(skew_join(edge_table, src, ["src_ip"], ["dst_ip"]), dst, ["dst_ip"], ["src_ip"])


def to_json_lines(edge_table: DataFrame, vertex_table: DataFrame) -> DataFrame:
    """Graph export: one JSON document per vertex and edge, tagged by kind."""
    v = vertex_table.select(
        F.lit("vertex").alias("kind"),
        F.to_json(
            F.struct(
                F.col("ip").alias("id"), F.col("ip").alias("label"), "in_degree", "out_degree", "degree",
                "total_bytes", "packet_count", "is_internal",
            )
        ).alias("document"),
    )
    e = edge_table.select(
        F.lit("edge").alias("kind"),
        F.to_json(
            F.struct(
                F.col("src_ip").alias("source"), F.col("dst_ip").alias("target"), "weight", "byte_count",
                "protocols", "is_bidirectional",
            )
        ).alias("document"),
    )
    return v.unionByName(e)
