"""Entropy decision tree (binary splits), grown level by level.

One level is one pass: rows find their node through the compiled tree, shrink to
counts per (node, feature, value, class), and running class counts over the
values give the gain of every midpoint at once. The driver holds only the tree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators import ordering
from packetloom.session import cut

LEAST_GAIN = 1e-12  # less is rounding noise

NODE_SCHEMA = (
    "node_id INT, depth INT, feature INT, feature_name STRING, threshold DOUBLE, left INT, right INT, "
    "class STRING, samples BIGINT, gain DOUBLE"
)


@dataclass
class Node:
    node_id: int
    depth: int
    samples: int
    label: str
    feature: int | None = None
    threshold: float | None = None
    gain: float = 0.0
    left: int | None = None
    right: int | None = None


def entropy(df: DataFrame, label: str) -> DataFrame:
    """One row: -sum(p log2 p) of the label distribution, 0 when empty."""
    counts = df.groupBy(label).agg(F.count("*").alias("c"))
    n = counts.agg(F.sum("c")).scalar()
    p = F.col("c") / n
    return counts.agg(F.coalesce(-F.sum(p * F.log2(p)), F.lit(0.0)).alias("entropy"))


def _entropy_of(counts: list[Column], total: Column) -> Column:
    out = F.lit(0.0)
    for c in counts:
        p = F.try_divide(c.cast("double"), total.cast("double"))
        out = out - F.when(c > 0, p * F.log2(p)).otherwise(0.0)
    return out


def split_gains(
    rows: DataFrame, columns: Sequence[str], label: str, classes: Sequence[str], node: str = "node"
) -> DataFrame:
    """Gain of every split "value <= v" per (node, feature): (node, feature, value, gain, counts).

    The largest value of a feature is no split and is left out. The value runs of
    a feature are cut into blocks, so a feature with as many values as rows is
    still scanned by many tasks.
    """
    cells = rows.select(
        node, F.col(label).alias("_label"),
        F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("feature", "value"),
    )
    counted = cells.groupBy(node, "feature", "value").agg(
        *[F.count_if(F.col("_label") == c).alias(f"c{k}") for k, c in enumerate(classes)]
    )
    idx = ordering.with_global_index(counted, order=(node, "feature", "value"))
    left = [F.col(f"l{k}") for k in range(len(classes))]
    summed = ordering.running_sums(
        idx, [node, "feature"], {f"l{k}": F.col(f"c{k}") for k in range(len(classes))}
    ).df
    totals = rows.groupBy(node).agg(
        *[F.count_if(F.col(label) == c).alias(f"t{k}") for k, c in enumerate(classes)]
    )
    whole = [F.col(f"t{k}") for k in range(len(classes))]
    # At most one row per open node of the level.
    joined = summed.join(F.broadcast(totals), node)
    n, n_left = sum(whole[1:], whole[0]), sum(left[1:], left[0])
    right = [t - l for t, l in zip(whole, left)]
    n_right = n - n_left
    gain = _entropy_of(whole, n) - (
        n_left / n * _entropy_of(left, n_left) + n_right / n * _entropy_of(right, n_right)
    )
    return joined.where(n_right > 0).select(
        node, "feature", "value", gain.alias("gain"), n_left.alias("n_left"), n_right.alias("n_right"),
        *left, *[c.alias(f"r{k}") for k, c in enumerate(right)],
    )


def best_splits(gains: DataFrame, rows: DataFrame, columns: Sequence[str], node: str = "node") -> DataFrame:
    """The best split per node: highest gain, then lowest feature, then lowest threshold."""
    order = F.struct(F.round("gain", 9).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("value")).alias("v"))
    others = [c for c in gains.columns if c != node]
    best = gains.groupBy(node).agg(F.max_by(F.struct(*others), order).alias("b")).select(node, "b.*")
    best = cut(best.where(F.col("gain") > LEAST_GAIN))
    # The threshold is the midpoint to the next larger value of that feature in the node.
    value = F.get(F.array(*[F.col(c).cast("double") for c in columns]), F.col("feature"))
    following = (
        rows.join(F.broadcast(best.select(node, "feature", F.col("value").alias("_v"))), node)
        .withColumn("_x", value)
        .groupBy(node)
        .agg(F.min(F.when(F.col("_x") > F.col("_v"), F.col("_x"))).alias("_next"))
    )
    return best.join(following, node).withColumn("threshold", (F.col("value") + F.col("_next")) / 2).drop("_next")


class DecisionTree:
    """A fitted tree: a small list of nodes and what can be compiled from it."""

    def __init__(self, nodes: list[Node], columns: Sequence[str]):
        self.nodes = {n.node_id: n for n in nodes}
        self.columns = list(columns)

    @staticmethod
    def fit(
        rows: DataFrame, columns: Sequence[str], label: str = "label", max_depth: int = 10, min_samples_split: int = 5
    ) -> "DecisionTree":
        rows = cut(rows.select(*columns, label))
        totals = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
        if not totals:
            raise ValueError("no rows to fit")
        classes = sorted(totals)
        tree = DecisionTree([_node(1, 0, [totals[c] for c in classes], classes)], columns)
        open_nodes = _splittable({1: [totals[c] for c in classes]}, 0, max_depth, min_samples_split)
        depth = 0
        while open_nodes:
            placed = rows.withColumn("node", tree.node_of()).where(F.col("node").isin(open_nodes))
            gains = split_gains(placed, columns, label, classes)
            counts: dict[int, list[int]] = {}
            for split in best_splits(gains, placed, columns).collect():
                parent = tree.nodes[split["node"]]
                parent.feature, parent.threshold, parent.gain = split["feature"], split["threshold"], split["gain"]
                parent.left, parent.right = 2 * parent.node_id, 2 * parent.node_id + 1
                for child, side in ((parent.left, "l"), (parent.right, "r")):
                    counts[child] = [split[f"{side}{k}"] for k in range(len(classes))]
                    tree.nodes[child] = _node(child, depth + 1, counts[child], classes)
            depth += 1
            open_nodes = _splittable(counts, depth, max_depth, min_samples_split)
        return tree

    def _walk(self, leaf, node_id: int = 1) -> Column:
        node = self.nodes[node_id]
        if node.left is None:
            return F.lit(leaf(node))
        test = F.col(self.columns[node.feature]) <= F.lit(float(node.threshold))
        return F.when(test, self._walk(leaf, node.left)).otherwise(self._walk(leaf, node.right))

    def node_of(self) -> Column:
        return self._walk(lambda n: n.node_id)

    def predict(self) -> Column:
        """The predicted class as an expression over the feature columns."""
        return self._walk(lambda n: n.label)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (n.node_id, n.depth, n.feature, None if n.feature is None else self.columns[n.feature], n.threshold,
             n.left, n.right, n.label, n.samples, n.gain)
            for n in sorted(self.nodes.values(), key=lambda n: n.node_id)
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @staticmethod
    def from_table(table: DataFrame, columns: Sequence[str]) -> "DecisionTree":
        return DecisionTree(
            [
                Node(r["node_id"], r["depth"], r["samples"], r["class"], r["feature"], r["threshold"], r["gain"],
                     r["left"], r["right"])
                for r in table.collect()
            ],
            columns,
        )


def _node(node_id: int, depth: int, counts: list[int], classes: list[str]) -> Node:
    """A node named by its majority class; ties go to the smaller label."""
    majority = max(range(len(classes)), key=lambda k: (counts[k], -k))
    return Node(node_id, depth, sum(counts), classes[majority])


def _splittable(counts: dict[int, list[int]], depth: int, max_depth: int, min_samples: int) -> list[int]:
    if depth >= max_depth:
        return []
    return [n for n, c in counts.items() if sum(c) >= min_samples and sum(1 for x in c if x > 0) > 1]


def importance(nodes: DataFrame) -> DataFrame:
    """Per feature: share of the plain gain sum, and of the gain sum weighted by node size."""
    used = nodes.where(F.col("feature").isNotNull())
    sums = used.groupBy("feature_name").agg(
        F.sum("gain").alias("g"), F.sum(F.col("gain") * F.col("samples")).alias("w")
    )
    total = sums.agg(F.sum("g").alias("g"), F.sum("w").alias("w"))
    return sums.select(
        "feature_name",
        (F.col("g") / total.select("g").scalar()).alias("gain_sum"),
        (F.col("w") / total.select("w").scalar()).alias("gain_weighted"),
    )
