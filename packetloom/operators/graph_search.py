"""Graph operators that iterate or close triangles: components, paths, clustering.

Addresses are numbered once, in their order, and all loops work on the numbers:
minima and joins are on BIGINT, and the smallest number is the smallest address.
Addresses come back in the last step.

The driver only sees row counts that decide when to stop. Every round is cut
with a reliable checkpoint, so plans stay short and lost executors cost one
round at most.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.operators import ordering
from packetloom.operators.skew import ROWS_PER_TASK, hot_keys, skew_join
from packetloom.session import cut


LIST_PIECE = 256  # out-neighbours in one list
WORDS = 16  # of 64 sources each, that spread at once


def undirected(edge_table: DataFrame) -> DataFrame:
    """Distinct unordered pairs (a < b), self-loops left out."""
    return (
        edge_table.where(F.col("src_ip") != F.col("dst_ip"))
        .select(F.least("src_ip", "dst_ip").alias("a"), F.greatest("src_ip", "dst_ip").alias("b"))
        .distinct()
    )


def symmetric(pairs: DataFrame) -> DataFrame:
    """Both directions of unordered pairs as (u, v)."""
    both = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return pairs.select(F.explode(both).alias("e")).select("e.u", "e.v")


@dataclass
class Numbered:
    """A graph over dense numbers: ``names(ip, v)`` in address order from 1, ``pairs(a, b)`` undirected with a < b."""

    names: DataFrame
    pairs: DataFrame
    count: int


def numbered(edge_table: DataFrame) -> Numbered:
    """Number the addresses by one range shuffle and put the numbers into the edges.

    An address of very many edges is one large key on the left of a join with unique keys, which adaptive execution splits.
    """
    ips = edge_table.select(F.explode(F.array("src_ip", "dst_ip")).alias("ip")).distinct()
    idx = ordering.with_global_index(ips, order=("ip",))
    names = idx.df.select("ip", F.col("i").alias("v"))
    pairs = undirected(edge_table)
    for end in ("a", "b"):
        found = names.select(F.col("ip").alias(end), F.col("v").alias(f"_{end}"))
        pairs = pairs.join(found, end)
    return Numbered(names, cut(pairs.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), idx.total)


# --- connected components ------------------------------------------------------

def _large_star(pairs: DataFrame, rows_per_task: int) -> DataFrame:
    """Hang every larger neighbour of a node onto the node's smallest neighbour."""
    both = symmetric(pairs)
    smallest = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n"))
    smallest = smallest.withColumn("m", F.least("m", "u"))
    hot = smallest.where(F.col("_n") > rows_per_task).select(
        "u", F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_pieces")
    )
    joined = skew_join(both.where("v > u"), smallest.select("u", "m"), ["u"], ["v"], hot=hot)
    return joined.select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(pairs: DataFrame, rows_per_task: int) -> DataFrame:
    """Hang a node and its smaller neighbours onto the smallest of them."""
    down = pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
    smallest = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n"))
    hot = smallest.where(F.col("_n") > rows_per_task).select(
        "u", F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_pieces")
    )
    moved = skew_join(down, smallest.select("u", "m"), ["u"], ["v"], hot=hot).where("v != m")
    return (
        moved.select(F.col("m").alias("a"), F.col("v").alias("b"))
        .unionByName(smallest.select(F.col("m").alias("a"), F.col("u").alias("b")))
        .distinct()
    )


def _is_star_forest(pairs: DataFrame) -> bool:
    """No child has two parents and no parent is a child."""
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("ip"), F.lit(1).alias("parent"), F.lit(0).alias("child")),
        F.struct(F.col("b").alias("ip"), F.lit(0).alias("parent"), F.lit(1).alias("child")),
    )).alias("e")).select("e.*")
    roles = ends.groupBy("ip").agg(F.max("parent").alias("parent"), F.sum("child").alias("child"))
    return roles.where("child > 1 OR (child = 1 AND parent = 1)").isEmpty()


def _stars(pairs: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(a, b): every vertex b of a component but the smallest, a."""
    while not _is_star_forest(pairs):
        pairs = cut(_small_star(_large_star(pairs, rows_per_task), rows_per_task))
    return pairs


def connected_components(
    edge_table: DataFrame, vertex_table: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """(ip, component): weakly connected, named by the smallest address.

    Alternating large-star and small-star contraction (Kiveris et al., 2014);
    the number of rounds grows with the logarithm of the component size, not
    with the graph's diameter.
    """
    graph = numbered(edge_table)
    everyone = graph.names.select("ip") if vertex_table is None else vertex_table.select("ip")
    pairs = _stars(graph.pairs, rows_per_task)
    parents = graph.names.select(F.col("v").alias("a"), F.col("ip").alias("component"))
    label = pairs.join(parents, "a").join(graph.names.withColumnRenamed("v", "b"), "b").select("ip", "component")
    return everyone.join(label, "ip", "left").withColumn("component", F.coalesce("component", "ip"))


# --- breadth-first search --------------------------------------------------------

def bfs_distances(
    edge_table: DataFrame, sources: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """(source, ip, distance) over undirected hops, each source with itself at 0.

    A row per source and vertex is what is asked for: ``sources`` (column ``ip``) bounds it, None means every vertex.
    Sums over all sources do not need these rows, see ``closeness``. A new frontier only has to be
    compared with the last two, because a neighbour of level d lies in d-1, d or d+1.
    """
    graph = numbered(edge_table)
    steps = cut(symmetric(graph.pairs).withColumnRenamed("v", "w"))
    asked = graph.names.select("ip") if sources is None else sources.select("ip").distinct()
    frontier = cut(asked.join(graph.names, "ip").select(F.col("v").alias("s"), F.col("v").alias("w")))
    before, depth = None, 0
    result = frontier.withColumn("distance", F.lit(0))
    while True:
        reached = skew_join(
            frontier.withColumnRenamed("w", "u"), steps, ["u"], ["s"], rows_per_task=rows_per_task
        ).select("s", "w").distinct()
        known = frontier if before is None else frontier.unionByName(before)
        fresh = cut(reached.join(known, ["s", "w"], "left_anti"))
        if fresh.isEmpty():
            break
        depth += 1
        result = result.unionByName(fresh.withColumn("distance", F.lit(depth)))
        before, frontier = frontier, fresh
    ends = skew_join(result, graph.names.select(F.col("v").alias("s"), F.col("ip").alias("source")), ["s"], ["w"],
                     rows_per_task=rows_per_task)
    found = skew_join(ends, graph.names.withColumnRenamed("v", "w"), ["w"], ["s"], rows_per_task=rows_per_task)
    # a source outside the graph reaches itself
    alone = asked.join(graph.names, "ip", "left_anti").select(F.col("ip").alias("source"), "ip", F.lit(0).alias("distance"))
    return found.select("source", "ip", "distance").unionByName(alone)


def _closeness(n: int | Column, r: Column, d: Column) -> Column:
    """(r / (n - 1)) * (r / d), rounded to 4; 0 where nothing is reached."""
    n = F.lit(n) if isinstance(n, int) else n
    value = F.when((n > 1) & (d > 0), (r / F.greatest(n - 1, F.lit(1))) * (r / F.greatest(d, F.lit(1)))).otherwise(0.0)
    return F.round(value, 4).alias("centrality")


def closeness(edge_table: DataFrame, sources: DataFrame | None = None, words: int = WORDS) -> DataFrame:
    """(r / (n - 1)) * (r / sum of distances), r = reachable others; rounded to 4.

    Distances are the same both ways, so a vertex needs the sum of its distances from all sources. Sources go 64 to a
    BIGINT, ``words`` of them at a time: a vertex holds one bit per source that has reached it, a hop is a ``bit_or``
    over its neighbours, and the bits that are new add to its sums. The state is one row per vertex; no row per source
    and vertex is ever made. Sources of different components never meet, so every component counts its own from 0 and
    they share the bits: the rounds follow the largest component, not the graph, and a component leaves when all of its
    sources have spread. With ``sources`` only their rows are asked for, which is what ``bfs_distances`` bounds.
    """
    if sources is not None:
        n = edge_table.select(F.explode(F.array("src_ip", "dst_ip")).alias("ip")).distinct().agg(F.count("*")).scalar()
        sums = bfs_distances(edge_table, sources).groupBy(F.col("source").alias("ip")).agg(
            F.count_if(F.col("distance") > 0).alias("reachable"), F.sum("distance").alias("total_distance"))
        return sums.select("ip", "reachable", "total_distance", _closeness(n, F.col("reachable"), F.col("total_distance")))
    graph = numbered(edge_table)
    steps = cut(symmetric(graph.pairs).withColumnRenamed("v", "w"))
    hot = cut(hot_keys(steps, ["u"]))
    zero = F.lit(0).cast("bigint")
    ranked = _ranked(graph)
    sums = ranked.select("v", "rank", "others", zero.alias("reachable"), zero.alias("total_distance"))
    largest = ranked.agg(F.max("others")).first()[0]
    words = max(1, min(words, ceil(((largest or 0) + 1) / 64)))
    done = []  # vertices of components that have spread
    for first in range(0, (largest or 0) + 1, 64 * words):
        if first:
            done.append(sums.where(F.col("others") < first))
            sums = cut(sums.where(F.col("others") >= first))
            left = sums.select(F.col("v").alias("u"))
            steps = cut(skew_join(steps, left, ["u"], ["w"], hot=hot))
        sums = _spread(steps, hot, sums, first, words)
    out = graph.names.join(reduce(DataFrame.unionByName, done, sums), "v")
    return out.select("ip", "reachable", "total_distance", _closeness(graph.count, F.col("reachable"), F.col("total_distance")))


def _ranked(graph: Numbered) -> DataFrame:
    """(v, rank, others): a vertex's place in its component, from 0, and the number of the others there."""
    child = _stars(graph.pairs).select(F.col("b").alias("v"), "a")
    members = graph.names.select("v").join(child, "v", "left").select("v", F.coalesce("a", "v").alias("component"))
    idx = ordering.with_global_index(members, order=("component", "v"))
    spans = idx.df.groupBy("component").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    return cut(skew_join(idx.df, spans, ["component"], ["v"]).select(
        "v", (F.col("i") - F.col("first")).alias("rank"), (F.col("n") - 1).alias("others")))


def _spread(steps: DataFrame, hot: DataFrame, sums: DataFrame, first: int, words: int) -> DataFrame:
    """``sums`` with what the 64 * words sources of every component from rank ``first`` on add."""
    fronts, seen = [f"f{k}" for k in range(words)], [f"s{k}" for k in range(words)]
    kept = ["v", "rank", "others"]
    at = F.col("rank") - F.lit(first)
    own = [
        F.when((at >= 64 * k) & (at < 64 * (k + 1)), F.call_function("shiftleft", F.lit(1).cast("bigint"), (at - 64 * k).cast("int")))
        .otherwise(F.lit(0)).cast("bigint") for k in range(words)
    ]
    state = sums.select("*", *[c.alias(f) for c, f in zip(own, fronts)], *[c.alias(f) for c, f in zip(own, seen)])
    hop = 0
    while True:
        hop += 1
        front = state.where(reduce(Column.__or__, [F.col(f) != 0 for f in fronts])).select(F.col("v").alias("u"), *fronts)
        met = skew_join(steps, front, ["u"], ["w"], hot=hot).groupBy(F.col("w").alias("v")).agg(
            *[F.bit_or(f).alias(f"i{k}") for k, f in enumerate(fronts)])
        fresh = [F.coalesce(f"i{k}", F.lit(0)).bitwiseAND(F.bitwise_not(f"s{k}")) for k in range(words)]
        moved = state.drop(*fronts).join(met, "v", "left").select(
            *kept, "reachable", "total_distance", *[c.alias(f) for c, f in zip(fresh, fronts)], *seen)
        news = reduce(Column.__add__, [F.bit_count(f) for f in fronts]).cast("bigint")
        state = cut(moved.select(
            *kept, (F.col("reachable") + news).alias("reachable"), (F.col("total_distance") + hop * news).alias("total_distance"),
            *fronts, *[F.col(s).bitwiseOR(F.col(f)).alias(s) for s, f in zip(seen, fronts)], (news > 0).alias("_new")))
        if state.where("_new").isEmpty():
            return state.select(*kept, "reachable", "total_distance")
        state = state.drop("_new")


def approximate_closeness(edge_table: DataFrame, precision: int = 12) -> DataFrame:
    """Closeness of all vertices from HyperLogLog balls (Boldi & Vigna, 2013).

    Each round merges the neighbours' sketches, so the state is one sketch per
    vertex; growth of the estimated ball from hop to hop gives the distance sum.
    Stops when no estimate grows, however far the last vertex is.
    """
    graph = numbered(edge_table)
    steps = cut(symmetric(graph.pairs))
    state = cut(
        graph.names.groupBy("v").agg(F.hll_sketch_agg("v", precision).alias("sketch")).select(
            "v", "sketch", F.lit(1).cast("bigint").alias("ball"), F.lit(0).cast("bigint").alias("total_distance")
        )
    )
    hop = 0
    while True:
        hop += 1
        incoming = skew_join(
            steps, state.select(F.col("v").alias("u"), "sketch"), ["u"], ["v"]
        ).select("v", "sketch")
        merged = (
            incoming.unionByName(state.select("v", "sketch"))
            .groupBy("v")
            .agg(F.hll_union_agg("sketch").alias("sketch"))
        )
        grown = merged.join(state.select("v", F.col("ball").alias("old"), "total_distance"), "v")
        size = F.hll_sketch_estimate("sketch")
        state = cut(
            grown.select(
                "v", "sketch", F.greatest(size, F.col("old")).alias("ball"),
                (F.col("total_distance") + hop * F.greatest(size - F.col("old"), F.lit(0))).alias("total_distance"),
                (size > F.col("old")).alias("grew"),
            )
        )
        if state.where("grew").isEmpty():
            break
        state = state.drop("grew")
    r, d = F.col("ball") - 1, F.col("total_distance")
    return state.join(graph.names, "v").select("ip", r.alias("reachable"), "total_distance", _closeness(graph.count, r, d))


def shortest_path(edge_table: DataFrame, src: str, dst: str) -> DataFrame:
    """(step, ip) along a shortest undirected path; no rows if there is none.

    The smallest parent wins at every node, so the path is unique.
    """
    spark = edge_table.sparkSession
    empty = spark.createDataFrame([], "step INT, ip STRING")
    graph = numbered(edge_table)
    known = {r["ip"]: r["v"] for r in graph.names.where(F.col("ip").isin(src, dst)).collect()}
    if len(known) < len({src, dst}):
        return empty
    if src == dst:
        return spark.createDataFrame([(0, src)], "step INT, ip STRING")
    steps = cut(symmetric(graph.pairs))
    frontier = cut(spark.createDataFrame([(known[src], None)], "w BIGINT, parent BIGINT"))
    levels = [frontier]
    while True:
        reached = (
            skew_join(steps, frontier.select(F.col("w").alias("u")), ["u"], ["v"])
            .groupBy(F.col("v").alias("w"))
            .agg(F.min("u").alias("parent"))
        )
        recent_levels = frontier if len(levels) < 2 else frontier.unionByName(levels[-2])
        frontier = cut(reached.join(recent_levels.select("w"), "w", "left_anti"))
        if frontier.isEmpty():
            return empty
        levels.append(frontier)
        if not frontier.where(F.col("w") == known[dst]).isEmpty():
            break
    path, node = [(len(levels) - 1, known[dst])], known[dst]
    for depth in range(len(levels) - 1, 0, -1):
        node = levels[depth].where(F.col("w") == node).first()["parent"]
        path.append((depth - 1, node))
    return spark.createDataFrame(path[::-1], "step INT, v BIGINT").join(graph.names, "v").select("step", "ip")


# --- clustering -------------------------------------------------------------------

def triangles(edge_table: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(ip, triangles) for every vertex that closes at least one.

    Edges point from the lower to the higher degree, so no vertex keeps more than
    sqrt(2 * edges) out-neighbours, however large the hubs. These are dealt by
    hash into buckets of about ``LIST_PIECE``; an edge intersects the lists of its
    two ends bucket by bucket, so a row carries short lists only, and both joins
    split a vertex by the list entries that meet there. Only closed triangles
    become rows.
    """
    graph = numbered(edge_table)
    pairs = graph.pairs
    degree = symmetric(pairs).groupBy("u").agg(F.count("*").alias("d"))
    with_a = skew_join(pairs, degree.select(F.col("u").alias("a"), F.col("d").alias("da")), ["a"], ["b"],
                       rows_per_task=rows_per_task)
    with_both = skew_join(with_a, degree.select(F.col("u").alias("b"), F.col("d").alias("db")), ["b"], ["a"],
                          rows_per_task=rows_per_task)
    low_first = F.struct("da", "a") < F.struct("db", "b")
    oriented = cut(
        with_both.select(
            F.when(low_first, F.col("a")).otherwise(F.col("b")).alias("u"),
            F.when(low_first, F.col("b")).otherwise(F.col("a")).alias("v"),
        )
    )
    widest = oriented.groupBy("u").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("v"), F.lit(max(1, ceil(widest / LIST_PIECE)))).alias("bucket")
    out = cut(oriented.groupBy("u", bucket).agg(F.collect_list("v").alias("out")))
    rows_met = max(1, rows_per_task // LIST_PIECE)
    from_u = cut(skew_join(oriented, out.withColumnRenamed("out", "out_u"), ["u"], ["v"], rows_per_task=rows_met))
    ends = skew_join(
        from_u, out.select(F.col("u").alias("v"), "bucket", F.col("out").alias("out_v")), ["v", "bucket"], ["u"],
        rows_per_task=rows_met,
    )
    closed = ends.select("u", "v", F.array_intersect("out_u", "out_v").alias("third")).where(F.size("third") > 0)
    counted = closed.select(
        F.explode(
            F.concat(
                F.array(
                    F.struct(F.col("u").alias("w"), F.size("third").cast("bigint").alias("c")),
                    F.struct(F.col("v").alias("w"), F.size("third").cast("bigint").alias("c")),
                ),
                F.transform("third", lambda x: F.struct(x.alias("w"), F.lit(1).cast("bigint").alias("c"))),
            )
        ).alias("e")
    ).select("e.*")
    summed = counted.groupBy(F.col("w").alias("v")).agg(F.sum("c").alias("triangles"))
    return summed.join(graph.names, "v").select("ip", "triangles")


def local_clustering(edge_table: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(ip, neighbors, closed_pairs, clustering), rounded to 4.

    A vertex with a self-loop is its own neighbour: one more neighbour, and one
    more closed pair per other neighbour.
    """
    base = symmetric(undirected(edge_table)).groupBy(F.col("u").alias("ip")).agg(F.count("*").alias("k"))
    loops = edge_table.where(F.col("src_ip") == F.col("dst_ip")).select(F.col("src_ip").alias("ip"), F.lit(1).alias("loop"))
    rows = (
        base.join(loops, "ip", "full_outer")
        .join(triangles(edge_table, rows_per_task), "ip", "left")
        .fillna(0, ["k", "loop", "triangles"])
    )
    n = F.col("k") + F.col("loop")
    closed = F.col("triangles") + F.col("loop") * F.col("k")
    return rows.select(
        "ip",
        n.alias("neighbors"),
        closed.alias("closed_pairs"),
        F.when(n < 2, 0.0).otherwise(F.round(2 * closed / F.greatest(n * (n - 1), F.lit(1)), 4)).alias("clustering"),
    )


def average_clustering(local: DataFrame) -> DataFrame:
    """Mean of the rounded coefficients, summed exactly."""
    total = F.sum(F.col("clustering").cast("decimal(10,4)")).cast("double")
    return local.agg(
        F.round(F.coalesce(total / F.greatest(F.count("*"), F.lit(1)), F.lit(0.0)), 4).alias("avg_clustering")
    )
