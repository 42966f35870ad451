"""Classification and regression metrics as one-row aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def classification(df: DataFrame, truth: str, predicted: str, positive="anomaly", negative="normal") -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 (rounded to 4, 0 when undefined)."""
    t, p = F.col(truth), F.col(predicted)
    counts = df.agg(
        F.count("*").alias("n"),
        F.count_if((t == positive) & (p == positive)).alias("tp"),
        F.count_if((t == negative) & (p == negative)).alias("tn"),
        F.count_if((t == negative) & (p == positive)).alias("fp"),
        F.count_if((t == positive) & (p == negative)).alias("fn"),
    )
    precision = _share(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _share(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(
        "tp", "tn", "fp", "fn",
        F.round(_share(F.col("tp") + F.col("tn"), F.col("n")), 4).alias("accuracy"),
        F.round(precision, 4).alias("precision"),
        F.round(recall, 4).alias("recall"),
        F.round(_share(2 * precision * recall, precision + recall), 4).alias("f1_score"),
    )


def regression(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """MSE, RMSE and R squared (0 when the target does not vary)."""
    t, p = F.col(truth), F.col(predicted)
    sums = df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum((t - p) * (t - p)), F.lit(0.0)).alias("res"),
        F.coalesce(F.var_pop(t) * F.count("*"), F.lit(0.0)).alias("tot"),
    )
    mse = _share(F.col("res"), F.col("n"))
    return sums.select(
        "n",
        F.round(mse, 6).alias("mse"),
        F.round(F.sqrt(mse), 6).alias("rmse"),
        F.round(F.when(F.col("tot") > 0, 1 - F.try_divide(F.col("res"), F.col("tot"))).otherwise(0.0), 4).alias(
            "r_squared"
        ),
    )
