"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def hot_keys(left: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of pieces each needs.

    There can be at most rows / rows_per_task of them, which is what makes the
    result small enough to broadcast.
    """
    counted = left.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_task)
    return counted.select(*keys, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_pieces"))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join with the left rows of hot keys split into pieces by a hash of ``spread``.

    Right rows of a hot key are repeated once per piece; all others are joined as
    usual. ``how`` may be inner, left, left_semi or left_anti.
    """
    keys = list(keys)
    if hot is None:
        hot = hot_keys(left, keys, rows_per_task)
    pieces = F.broadcast(hot)
    salted_left = left.join(pieces, keys, "left").withColumn(
        "_salt", F.when(F.col("_pieces").isNull(), 0).otherwise(
            F.pmod(F.xxhash64(*spread), F.coalesce("_pieces", F.lit(1))).cast("int"))
    ).drop("_pieces")
    salted_right = right.join(pieces, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    ).drop("_pieces")
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")
