"""Training jobs: split by time, fit, evaluate; and the full training run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.operators import bayes, kmeans, labeling, metrics, ordering, scaling, tree
from packetloom.operators.bayes import NaiveBayes
from packetloom.operators.features import features_anchored
from packetloom.operators.linreg import LinearRegression
from packetloom.operators.ordering import Indexed
from packetloom.operators.scaling import Scaler
from packetloom.schema import FEATURES
from packetloom.session import cut

MIN_LOGS = 100


def labelled(feature_rows: DataFrame) -> DataFrame:
    return feature_rows.withColumns({"label": labeling.weak_label(), "score": labeling.weak_score()})


def split(idx: Indexed) -> tuple[DataFrame, DataFrame]:
    """First 80% by index for training, the rest for testing."""
    return ordering.chronological_split(idx, 80)


def train_tree(idx: Indexed, columns=FEATURES, **options) -> tuple[tree.DecisionTree, DataFrame]:
    train, test = split(idx)
    model = tree.DecisionTree.fit(train, columns, **options)
    return model, metrics.classification(test.withColumn("predicted", model.predict()), "label", "predicted")


def train_bayes(idx: Indexed, columns=FEATURES) -> tuple[DataFrame, DataFrame]:
    train, test = split(idx)
    params = cut(bayes.fit(train, columns))
    return params, metrics.classification(NaiveBayes(params).predict(test), "label", "predicted")


def train_linear(idx: Indexed, columns=FEATURES, target: str = "score") -> tuple[LinearRegression, DataFrame]:
    train, test = split(idx)
    model = LinearRegression.fit(train, columns, target)
    return model, metrics.regression(test.withColumn("predicted", model.predict()), target, "predicted")


def train_kmeans(idx: Indexed, columns=FEATURES, k: int = 2) -> tuple[kmeans.KMeans, DataFrame]:
    model = kmeans.fit(idx.df, columns, kmeans.parallel_seeds(idx, columns, k))
    return model, kmeans.cluster_sizes(model.with_cluster(idx.df))


@dataclass
class Trained:
    tree: tree.DecisionTree
    kmeans: kmeans.KMeans
    bayes: DataFrame
    linear: LinearRegression
    scaler: DataFrame
    summary: DataFrame


def train_rows(idx: Indexed, columns=FEATURES) -> Trained:
    """All four models and the scaler on labelled rows; ``summary`` is (model, metric, value)."""
    spark = idx.df.sparkSession
    tree_model, tree_metrics = train_tree(idx, columns)
    k_model, k_sizes = train_kmeans(idx, columns)
    nb_params, nb_metrics = train_bayes(idx, columns)
    lin_model, lin_metrics = train_linear(idx, columns)

    def long(model: str, row: DataFrame) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(c).alias("m"), F.col(c).cast("double").alias("v")) for c in row.columns])
        return row.select(F.explode(cells).alias("e")).select(
            F.lit(model).alias("model"), F.col("e.m").alias("metric"), F.col("e.v").alias("value")
        )

    sizes = k_sizes.select(
        F.lit("kmeans").alias("model"), F.concat(F.lit("size_"), F.col("cluster")).alias("metric"),
        F.col("size").cast("double").alias("value"),
    )
    inertia = spark.createDataFrame([("kmeans", "inertia", k_model.inertia)], "model STRING, metric STRING, value DOUBLE")
    summary = (
        long("decision_tree", tree_metrics).unionByName(long("naive_bayes", nb_metrics))
        .unionByName(long("linear_regression", lin_metrics)).unionByName(sizes).unionByName(inertia)
    )
    return Trained(tree_model, k_model, nb_params, lin_model, cut(scaling.fit(idx.df, columns)), summary)


def train_all(packets: DataFrame, seconds: float = 5.0, limit: int | None = None) -> Trained:
    """The training run: anchored windows, weak labels, all models.

    ``limit`` takes only the newest packets; None uses them all.
    """
    rows = packets if limit is None else packets.orderBy(F.desc("timestamp"), F.desc("id")).limit(limit)
    if rows.limit(MIN_LOGS).count() < MIN_LOGS:
        raise ValueError(f"need at least {MIN_LOGS} packets to train")
    table = labelled(features_anchored(rows, seconds))
    idx = ordering.with_global_index(table, order=("window_start",))
    full = labeling.augment_one_class(idx)
    if full is not idx.df:
        idx = ordering.with_global_index(full.withColumnRenamed("i", "position"), order=("position",))
    return train_rows(idx)


def save_model(table: DataFrame, path: str, kind: str) -> None:
    """One model's table below ``path``, to be read by ``load_model``."""
    table.write.mode("overwrite").parquet(f"{path}/{kind}")


def save(trained: Trained, spark: SparkSession, path: str) -> None:
    """Every model as a Parquet table below ``path``."""
    save_model(trained.tree.table(spark), path, "decision_tree")
    save_model(trained.kmeans.table(spark), path, "kmeans")
    save_model(trained.bayes, path, "naive_bayes")
    save_model(trained.linear.table(spark), path, "linear_regression")
    save_model(trained.scaler, path, "scaler")


def load_model(spark: SparkSession, path: str, kind: str):
    """A stored model by name: decision_tree, kmeans, naive_bayes, linear_regression or scaler."""
    makers = {
        "decision_tree": lambda t: tree.DecisionTree.from_table(t, FEATURES),
        "kmeans": lambda t: kmeans.KMeans.from_table(t, FEATURES),
        "naive_bayes": NaiveBayes,
        "linear_regression": LinearRegression.from_table,
        "scaler": Scaler,
    }
    if kind not in makers:
        raise ValueError(f"unknown model {kind!r}")
    return makers[kind](spark.read.parquet(f"{path}/{kind}"))
