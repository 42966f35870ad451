"""Linear regression by full-batch gradient descent on the Gram matrix.

The gradient of the squared error needs the data only through Z'Z, Z'y and their
sums, so one distributed pass replaces a pass per epoch; the epochs themselves
run on a matrix as wide as the feature count. Columns are standardised first,
which keeps the Gram matrix free of cancellation.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def gram(table: DataFrame, columns: Sequence[str], target: str, means=None, stds=None) -> DataFrame:
    """(i, j, value): products summed over the rows of [1, z_0, ..., z_k, y], i <= j.

    Each task multiplies its Arrow batches and emits one small triangle, so the
    shuffle does not grow with the rows.
    """
    columns = list(columns)
    mu = np.zeros(len(columns)) if means is None else np.asarray(means, dtype=float)
    sd = np.ones(len(columns)) if stds is None else np.asarray(stds, dtype=float)
    size = len(columns) + 2

    def partial(batches):
        total = np.zeros((size, size))
        for batch in batches:
            x = (batch[columns].to_numpy(dtype=float) - mu) / sd
            full = np.column_stack([np.ones(len(batch)), x, batch[target].to_numpy(dtype=float)])
            total += full.T @ full
        i, j = np.triu_indices(size)
        yield pd.DataFrame({"i": i, "j": j, "value": total[i, j]})

    parts = table.select(*columns, F.col(target).cast("double").alias(target)).mapInPandas(
        partial, "i INT, j INT, value DOUBLE"
    )
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


class LinearRegression:
    """Fitted weights on standardised columns."""

    def __init__(self, columns, means, stds, weights, bias):
        self.columns = list(columns)
        self.means, self.stds = np.asarray(means, dtype=float), np.asarray(stds, dtype=float)
        self.weights, self.bias = np.asarray(weights, dtype=float), float(bias)

    @staticmethod
    def fit(
        table: DataFrame, columns: Sequence[str], target: str, rate: float = 0.01, epochs: int = 1000
    ) -> "LinearRegression":
        columns = list(columns)
        stats = table.agg(
            *[F.avg(c).alias(f"m{k}") for k, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(columns)],
        ).first()
        means = [stats[f"m{k}"] for k in range(len(columns))]
        stds = [stats[f"s{k}"] if (stats[f"s{k}"] or 0) > 1e-12 else 1.0 for k in range(len(columns))]
        size = len(columns) + 2
        matrix = np.zeros((size, size))
        for row in gram(table, columns, target, means, stds).collect():
            matrix[row["i"], row["j"]] = matrix[row["j"], row["i"]] = row["value"]
        n, z_sum, y_sum = matrix[0, 0], matrix[0, 1:-1], matrix[0, -1]
        zz, zy = matrix[1:-1, 1:-1], matrix[1:-1, -1]
        weights, bias = np.zeros(len(columns)), y_sum / n
        for _ in range(epochs):
            slope = 2 / n * (zz @ weights + bias * z_sum - zy)
            tilt = 2 / n * (z_sum @ weights + n * bias - y_sum)
            weights, bias = weights - rate * slope, bias - rate * tilt
        return LinearRegression(columns, means, stds, weights, bias)

    def predict(self) -> Column:
        out = F.lit(self.bias)
        for c, mean, std, weight in zip(self.columns, self.means, self.stds, self.weights):
            out = out + (F.col(c) - F.lit(float(mean))) / F.lit(float(std)) * F.lit(float(weight))
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(-1, "bias", 0.0, 1.0, self.bias)] + [
            (k, c, float(self.means[k]), float(self.stds[k]), float(self.weights[k]))
            for k, c in enumerate(self.columns)
        ]
        return spark.createDataFrame(rows, "feature INT, name STRING, mean DOUBLE, std DOUBLE, weight DOUBLE")

    @staticmethod
    def from_table(table: DataFrame) -> "LinearRegression":
        rows = table.orderBy("feature").collect()
        body = rows[1:]
        return LinearRegression(
            [r["name"] for r in body], [r["mean"] for r in body], [r["std"] for r in body],
            [r["weight"] for r in body], rows[0]["weight"],
        )


def fit_normal(table: DataFrame, columns: Sequence[str], target: str):
    """MLlib's converged solution by the normal equations, for comparison."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression as MLLinearRegression

    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(table)
    return MLLinearRegression(featuresCol="features", labelCol=target, solver="normal").fit(vectors)
