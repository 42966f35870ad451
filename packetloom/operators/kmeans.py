"""K-means over wide feature tables, with the centroids as a small driver-side model."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators.ordering import Indexed
from packetloom.session import cut


class KMeans:
    """Fitted centroids and the expressions built from them."""

    def __init__(self, centroids, columns: Sequence[str], inertia: float | None = None):
        self.centroids = np.asarray(centroids, dtype=float)
        self.columns = list(columns)
        self.inertia = inertia

    def _squares(self) -> Column:
        """Squared distance to every centroid, as an array."""
        point = [F.col(c) for c in self.columns]
        out = []
        for centroid in self.centroids:
            total = F.lit(0.0)
            for x, c in zip(point, centroid):
                total = total + (x - F.lit(float(c))) * (x - F.lit(float(c)))
            out.append(total)
        return F.array(*out)

    def with_cluster(self, table: DataFrame) -> DataFrame:
        """Add ``cluster`` (nearest, lowest number on ties) and ``distance``."""
        return (
            table.withColumn("_d", F.transform(self._squares(), F.sqrt))
            .withColumn("distance", F.array_min("_d"))
            .withColumn("cluster", (F.array_position("_d", F.col("distance")) - 1).cast("int"))
            .drop("_d")
        )

    def with_scores(self, table: DataFrame) -> DataFrame:
        """Add ``anomaly_score``: distance relative to the largest distance of the table."""
        placed = self.with_cluster(table)
        top = placed.agg(F.max("distance")).scalar()
        return placed.withColumn(
            "anomaly_score", F.when(top > 0, F.try_divide(F.col("distance"), top)).otherwise(F.col("distance"))
        )

    def step(self, table: DataFrame) -> tuple["KMeans", float]:
        """One Lloyd step: the new centroids and how far they moved in total."""
        means = (
            self.with_cluster(table).groupBy("cluster").agg(*[F.avg(c).alias(c) for c in self.columns]).collect()
        )
        moved = self.centroids.copy()
        for row in means:
            moved[row["cluster"]] = [row[c] for c in self.columns]
        shift = float(np.sqrt(((moved - self.centroids) ** 2).sum(axis=1)).sum())
        return KMeans(moved, self.columns), shift

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (k, j, name, float(self.centroids[k, j]))
            for k in range(len(self.centroids)) for j, name in enumerate(self.columns)
        ]
        return spark.createDataFrame(rows, "cluster INT, feature INT, name STRING, value DOUBLE")

    @staticmethod
    def from_table(table: DataFrame, columns: Sequence[str]) -> "KMeans":
        rows = table.collect()
        centroids = np.zeros((max(r["cluster"] for r in rows) + 1, len(columns)))
        for r in rows:
            centroids[r["cluster"], r["feature"]] = r["value"]
        return KMeans(centroids, columns)


def _draw(seed: int, turn: int) -> Column:
    """A number below 2^52 from the seed, the round and the row's index alone."""
    text = F.concat(F.lit(f"{seed}:{turn}:"), F.col("i").cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("decimal(16,0)")


def parallel_seeds(idx: Indexed, columns: Sequence[str], k: int = 2, seed: int = 42, rounds: int = 2) -> KMeans:
    """k-means|| seeding (Bahmani et al., 2012), the same whatever the partitions and blocks are.

    A round draws every row on its own, with 2 k times its share of the squared distances; shares are whole millionths
    of the largest distance of the first round, so their sum is exact, and the draw is a hash of seed, round and index. The few rows drawn (about
    2 k a round) are weighted by the rows nearest to them. Of these the heaviest is the first centroid, each further one
    has the largest weight times squared distance from those before; ties go to the lower index.
    """
    rows = idx.df.select("i", *columns)
    first = rows.orderBy(_draw(seed, 0), "i").limit(1).collect()
    if not first:
        raise ValueError("k-means needs at least one row")
    drawn = {r["i"]: [float(r[c]) for c in columns] for r in first}
    most = None
    for turn in range(1, rounds + 1):
        away = rows.withColumn("_d", F.array_min(KMeans([drawn[i] for i in sorted(drawn)], columns)._squares()))
        if most is None:
            most = away.agg(F.max("_d")).first()[0]
            if not most > 0:
                break
        weighted = away.withColumn("_w", F.floor(F.col("_d") / F.lit(most) * 1_000_000 + 0.5).cast("bigint"))
        total = weighted.agg(F.sum("_w")).first()[0]
        if not total:
            break
        share = F.col("_w").cast("decimal(20,0)") * F.lit(2 * k * 2**52).cast("decimal(18,0)")
        for r in weighted.where(_draw(seed, turn) * F.lit(total).cast("decimal(20,0)") < share).select("i", *columns).collect():
            drawn[r["i"]] = [float(r[c]) for c in columns]
    order = sorted(drawn)
    points = np.array([drawn[i] for i in order])
    sizes = np.zeros(len(order))
    for r in KMeans(points, columns).with_cluster(rows).groupBy("cluster").count().collect():
        sizes[r["cluster"]] = r["count"]
    chosen = [int(sizes.argmax())]
    while len(chosen) < k:
        squares = ((points[:, None] - points[chosen][None]) ** 2).sum(2).min(1)
        chosen.append(int((sizes * squares).argmax()))
    return KMeans(points[chosen], columns)


def fit(
    table: DataFrame, columns: Sequence[str], init: KMeans, max_iterations: int = 100, tolerance: float = 1e-6
) -> KMeans:
    """Lloyd iterations from given centroids; an empty cluster keeps its centroid."""
    rows = cut(table.select(*columns)).persist()  # every iteration reads all of it
    try:
        model = init
        for _ in range(max_iterations):
            assigned_by = model
            model, shift = model.step(rows)
            if shift < tolerance:
                break
        model.inertia = _inertia(assigned_by, model, rows)
    finally:
        rows.unpersist()
    return model


def _inertia(assigned_by: KMeans, model: KMeans, rows: DataFrame) -> float:
    """Sum of squared distances to the final centroid of the last assignment."""
    placed = assigned_by.with_cluster(rows).drop("distance")
    square = F.element_at(model._squares(), F.col("cluster") + 1)
    return float(placed.agg(F.coalesce(F.sum(square), F.lit(0.0))).first()[0])


def fit_mllib(table: DataFrame, columns: Sequence[str], k: int = 2, seed: int = 42, max_iterations: int = 100) -> KMeans:
    """The same model from MLlib's parallel seeding, for tables where k is large."""
    from pyspark.ml.clustering import KMeans as MLKMeans
    from pyspark.ml.feature import VectorAssembler

    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(table.select(*columns))
    model = MLKMeans(k=k, seed=seed, maxIter=max_iterations, tol=1e-6).fit(vectors)
    return KMeans([c.tolist() for c in model.clusterCenters()], columns, model.summary.trainingCost)


def cluster_sizes(placed: DataFrame) -> DataFrame:
    return placed.groupBy("cluster").agg(F.count("*").alias("size"))
