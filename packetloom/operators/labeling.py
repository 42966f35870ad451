"""Weak labels and regression targets for feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.operators.ordering import Indexed

# A feature row is suspicious beyond any of these limits.
LIMITS = {"max_packet_size": 10_000, "packets_per_second": 50, "unique_destinations": 20, "syn_ratio": 0.8}
SHARES = {"max_packet_size": 0.3, "packets_per_second": 0.3, "unique_destinations": 0.2, "syn_ratio": 0.2}


def weak_label() -> Column:
    hit = F.lit(False)
    for name, limit in LIMITS.items():
        hit = hit | (F.col(name) > limit)
    return F.when(hit, "anomaly").otherwise("normal")


def weak_score() -> Column:
    """Sum of the shares of all exceeded limits, at most 1."""
    tenths = sum(F.when(F.col(n) > limit, int(SHARES[n] * 10)).otherwise(0) for n, limit in LIMITS.items())
    return F.least(tenths / F.lit(10.0), F.lit(1.0))


def score_from_label(label: str = "label") -> Column:
    return F.when(F.col(label) == "anomaly", 0.9).otherwise(0.1)


def augment_one_class(idx: Indexed, label: str = "label", score: str | None = "score", copies: int = 10) -> DataFrame:
    """If all rows share one label, append ``copies`` inflated anomalies made of the first rows.

    Copy j takes row j modulo the row count, with the mean size times 10 and the
    packet rate times 20.
    """
    rows = idx.df
    if rows.agg(F.count_distinct(label)).first()[0] != 1:
        return rows
    lead = rows.where(F.col("i") <= min(copies, idx.total)).withColumn(
        "_copy", F.explode(F.sequence(F.col("i") - 1, F.lit(copies - 1), F.lit(max(idx.total, 1))))
    )
    changed = {
        "avg_packet_size": F.col("avg_packet_size") * 10,
        "packets_per_second": F.col("packets_per_second") * 20,
        label: F.lit("anomaly"),
        "i": F.lit(idx.total) + F.col("_copy") + 1,
    }
    if score is not None and score in rows.columns:
        changed[score] = F.lit(0.9)
    return rows.unionByName(lead.withColumns(changed).drop("_copy"))
