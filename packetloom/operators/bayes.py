"""Gaussian naive Bayes with a parameter table of one row per (class, feature)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLOOR = 1e-6
UNDERFLOW = -100.0


def fit(table: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """(class, prior, feature, name, mean, std): one aggregation per class, one pass.

    A class of one row has variance 1e-6; a deviation of zero becomes 1e-6.
    """
    n = table.agg(F.count("*")).scalar()
    stats = table.groupBy(F.col(label).alias("class")).agg(
        F.count("*").alias("c"),
        *[F.avg(x).alias(f"m_{x}") for x in columns],
        *[F.var_pop(x).alias(f"v_{x}") for x in columns],
    )
    upright = stats.select(
        "class",
        (F.col("c") / n).alias("prior"),
        "c",
        F.posexplode(
            F.array(
                *[
                    F.struct(F.lit(x).alias("name"), F.col(f"m_{x}").alias("mean"), F.col(f"v_{x}").alias("var"))
                    for x in columns
                ]
            )
        ).alias("feature", "p"),
    )
    variance = F.when(F.col("c") > 1, F.col("p.var")).otherwise(FLOOR)
    return upright.select(
        "class", "prior", "feature", "p.name", "p.mean",
        F.when(variance > 0, F.sqrt(variance)).otherwise(FLOOR).alias("std"),
    )


class NaiveBayes:
    """A fitted classifier read from its (small) parameter table."""

    def __init__(self, params: DataFrame):
        self.priors: dict[str, float] = {}
        self.params: dict[str, list[tuple[str, float, float]]] = {}
        for r in params.orderBy("class", "feature").collect():
            self.priors[r["class"]] = r["prior"]
            self.params.setdefault(r["class"], []).append((r["name"], r["mean"], r["std"]))
        self.classes = sorted(self.priors)

    def _log_likelihood(self, cls: str) -> Column:
        total = F.lit(math.log(self.priors[cls]))
        for name, mean, std in self.params[cls]:
            std = max(std, FLOOR)
            off = F.col(name) - F.lit(mean)
            pdf = F.lit(1 / (math.sqrt(2 * math.pi) * std)) * F.exp(-(off * off) / F.lit(2 * std * std))
            total = total + F.when(pdf > 0, F.ln(pdf)).otherwise(UNDERFLOW)
        return total

    def predict(self, table: DataFrame) -> DataFrame:
        """Add ``predicted`` (smallest label on ties) and ``p_<class>`` for every class."""
        logs = {c: f"_l{k}" for k, c in enumerate(self.classes)}
        scored = table.withColumns({logs[c]: self._log_likelihood(c) for c in self.classes})
        top = F.greatest(*logs.values()) if len(logs) > 1 else F.col(logs[self.classes[0]])
        scored = scored.withColumn("_top", top)
        weights = {c: F.exp(F.col(logs[c]) - F.col("_top")) for c in self.classes}
        total = sum(list(weights.values())[1:], weights[self.classes[0]])
        best = F.coalesce(*[F.when(F.col(logs[c]) == F.col("_top"), c) for c in self.classes])
        return scored.withColumns(
            {"predicted": best, **{f"p_{c}": weights[c] / total for c in self.classes}}
        ).drop("_top", *logs.values())
