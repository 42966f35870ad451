"""The model-based detector: trailing features, scaled, judged by a fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.operators import features, ordering, scaling
from packetloom.operators.bayes import NaiveBayes
from packetloom.operators.detect import COLUMNS, RULE_ORDER
from packetloom.operators.kmeans import KMeans
from packetloom.operators.ordering import Indexed
from packetloom.operators.scaling import Scaler
from packetloom.operators.tree import DecisionTree
from packetloom.schema import FEATURES
from packetloom.session import cut

BUFFER_SECONDS, EVERY, MIN_BUFFER, KMEANS_DISTANCE = 30, 10, 10, 0.7


def recent_endpoints(idx: Indexed, rows: int = 10, every: int = 1) -> DataFrame:
    """(id, related): sorted addresses of the last ``rows`` packets at every ``every``-th packet."""
    frame = W.partitionBy("_block").orderBy("i").rowsBetween(-(rows - 1), 0)
    return (
        ordering.with_halo(idx.replace(idx.df.select("i", "id", "src_ip", "dst_ip")), rows - 1)
        .withColumn("_src", F.collect_set("src_ip").over(frame))
        .withColumn("_dst", F.collect_set("dst_ip").over(frame))
        .where(F.col("_own") & (F.col("i") % every == 0))
        .select("id", "i", F.array_sort(F.array_union("_src", "_dst")).alias("related"))
    )


def judge(table: DataFrame, model: DecisionTree | KMeans | NaiveBayes) -> tuple[str, DataFrame]:
    """The model's name and the table with ``score`` and ``hit``."""
    if isinstance(model, DecisionTree):
        out = table.withColumn("hit", model.predict() == "anomaly")
        return "decision_tree", out.withColumn("score", F.when(F.col("hit"), 0.8).otherwise(0.2))
    if isinstance(model, KMeans):
        out = model.with_cluster(table).withColumnRenamed("distance", "score")
        return "kmeans", out.withColumn("hit", F.col("score") > KMEANS_DISTANCE)
    if isinstance(model, NaiveBayes):
        out = model.predict(table)
        score = F.col("p_anomaly") if "anomaly" in model.classes else F.lit(0.0)
        return "naive_bayes", out.withColumn("hit", F.col("predicted") == "anomaly").withColumn("score", score)
    raise ValueError(f"no detector for {type(model).__name__}")


def ml(idx: Indexed, model, scaler: Scaler | None, seconds: int = BUFFER_SECONDS, every: int = EVERY) -> DataFrame:
    """Judge the last ``seconds`` of traffic at every ``every``-th packet.

    Without a scaler the model sees raw features. Needs at least ten packets in
    the buffer; the addresses named are those of the last ten of them.
    """
    rows = features.features_trailing(idx, seconds, every).where(F.col("packets") >= MIN_BUFFER)
    # Written out: the models below use every feature many times over.
    scaled = rows if scaler is None else cut(scaling.minmax(rows, scaler, FEATURES))
    name, judged = judge(scaled, model)
    judged = cut(judged.select("id", "timestamp", "score", "hit"))  # the model is worked out once, not again in the filter
    related = recent_endpoints(idx, 10, every).select("id", "related")
    hits = judged.where("hit").select("id", "timestamp", "score").join(related, "id")
    details = F.create_map(
        F.lit("model_type"), F.lit(name), F.lit("prediction_score"), F.format_string("%.4f", "score")
    )
    return hits.select(
        F.col("id").alias("packet_id"),
        "timestamp",
        F.get("related", F.lit(0)).alias("src_ip"),
        F.get("related", F.lit(1)).alias("dst_ip"),
        F.lit(f"ml:{name}").alias("detection_method"),
        F.lit(RULE_ORDER["ml"]).alias("rule_order"),
        "score",
        F.col("related").alias("related_ips"),
        details.alias("details"),
    ).select(*COLUMNS)
