"""Feature scaling with a model table of one row per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A spread this small relative to the data is rounding noise of a constant column.
NOISE = 1e-12


def fit(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, name, min, max, mean, std) with population deviation, 1 where it is zero.

    All columns are reduced in one pass over the table; the one resulting row is
    then turned upright.
    """
    stats = table.agg(
        *[
            F.struct(
                F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")
            ).alias(c)
            for c in columns
        ]
    )
    upright = stats.select(
        F.posexplode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("name"), F.col(c)["min"].alias("min"), F.col(c)["max"].alias("max"),
                        F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std"),
                    )
                    for c in columns
                ]
            )
        ).alias("feature", "s")
    )
    std = F.col("s.std")
    return upright.select(
        "feature", "s.name", "s.min", "s.max", "s.mean",
        F.when(std > NOISE, std).otherwise(1.0).alias("std"),
    )


class Scaler:
    """A fitted scaler: one small row per feature, read once from its model table."""

    def __init__(self, model: DataFrame):
        rows = model.orderBy("feature").collect()
        if not rows:
            raise RuntimeError("scaler is not fitted")
        self.params = {r["name"]: (r["min"], r["max"], r["mean"], r["std"]) for r in rows}


def minmax(table: DataFrame, scaler: Scaler, columns: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min), 0 for a constant feature; values outside are not clipped."""
    out = {}
    for c in columns:
        low, high, _, _ = scaler.params[c]
        width = high - low
        out[c] = (F.col(c) - F.lit(low)) / F.lit(width) if width > 0 else F.lit(0.0)
    return table.withColumns(out)


def zscore(table: DataFrame, scaler: Scaler, columns: Sequence[str]) -> DataFrame:
    return table.withColumns(
        {c: (F.col(c) - F.lit(scaler.params[c][2])) / F.lit(scaler.params[c][3]) for c in columns}
    )
