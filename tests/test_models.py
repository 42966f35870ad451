import math
import random

import pytest
from pyspark.sql import functions as F

from packetloom.operators import bayes, kmeans, labeling, linreg, metrics, ordering, scaling, tree
from packetloom.plans import training
from packetloom.schema import FEATURES


def frame(spark, rows, columns, label=None):
    kinds = [f"{c} DOUBLE" for c in columns] + (["label STRING"] if label else [])
    return spark.createDataFrame(rows, ", ".join(kinds))


def test_entropy(spark):
    for labels, want in (("aaa", 0.0), ("abab", 1.0), ("a" * 7 + "b" * 3, 0.8813)):
        table = spark.createDataFrame([(x,) for x in labels], "label STRING")
        assert tree.entropy(table, "label").first()[0] == pytest.approx(want, abs=1e-4)


def test_separable_tree(spark):
    rows = [(float(x), 1.0, "a" if x < 5 else "b") for x in (1, 2, 3, 10, 11, 12)]
    table = frame(spark, rows, ["x", "y"], True)
    model = tree.DecisionTree.fit(table, ["x", "y"])
    assert model.nodes[1].threshold == 6.5 and model.nodes[1].feature == 0
    assert [r["p"] for r in table.orderBy("x").select(model.predict().alias("p")).collect()] == list("aaabbb")
    importance = tree.importance(model.table(spark)).first()
    assert (importance["feature_name"], importance["gain_sum"], importance["gain_weighted"]) == ("x", 1.0, 1.0)


def plain_tree(rows, depth=0, max_depth=10, min_split=5):
    """Straightforward recursive growth over in-memory rows."""
    labels = [r[-1] for r in rows]
    counts = {c: labels.count(c) for c in sorted(set(labels))}
    leaf = max(counts, key=lambda c: (counts[c], [-ord(x) for x in c]))
    if depth >= max_depth or len(rows) < min_split or len(counts) == 1:
        return leaf

    def h(part):
        seen = [r[-1] for r in part]
        return -sum(seen.count(c) / len(seen) * math.log2(seen.count(c) / len(seen)) for c in set(seen))

    best = (1e-12, None)
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            left, right = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            gain = h(rows) - len(left) / len(rows) * h(left) - len(right) / len(rows) * h(right)
            if gain > best[0] + 1e-12:
                best = (gain, (f, cut, left, right))
    if best[1] is None:
        return leaf
    f, cut, left, right = best[1]
    return f, cut, plain_tree(left, depth + 1, max_depth, min_split), plain_tree(right, depth + 1, max_depth, min_split)


def test_tree_against_recursive_growth(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(90):
        x, y, z = (round(rng.uniform(0, 10), 1) for _ in range(3))
        rows.append((x, y, z, "anomaly" if (x > 6 and y < 5) or z > 9 or rng.random() < 0.05 else "normal"))
    model = tree.DecisionTree.fit(frame(spark, rows, ["x", "y", "z"], True), ["x", "y", "z"], max_depth=4)

    def shape(node_id):
        n = model.nodes[node_id]
        return n.label if n.left is None else (n.feature, pytest.approx(n.threshold), shape(n.left), shape(n.right))

    assert plain_tree(rows, max_depth=4) == shape(1)


def test_kmeans(spark):
    corners = [(0.0, 0.0), (0.1, 0.0), (0.0, 0.1), (10.0, 10.0), (10.1, 10.0), (10.0, 10.1)]
    idx = ordering.with_global_index(frame(spark, corners, ["x", "y"]), order=("x", "y"))
    model = kmeans.fit(idx.df, ["x", "y"], kmeans.parallel_seeds(idx, ["x", "y"], 2))
    placed = model.with_cluster(idx.df).collect()
    low = {r["cluster"] for r in placed if r["x"] < 5}
    high = {r["cluster"] for r in placed if r["x"] > 5}
    assert len(low) == len(high) == 1 and low != high
    assert model.inertia == pytest.approx(0.0266666, abs=1e-4)


def test_seeds_do_not_depend_on_partitions_or_blocks(spark):
    rng = random.Random(8)
    points = [(rng.gauss(4 * (k % 3), 1), rng.gauss(0, 1)) for k in range(500)] + [(1.0, 1.0)] * 250
    found = []
    for parts, block in ((1, 10_000), (3, 100), (7, 64)):
        table = frame(spark, points, ["x", "y"]).repartition(parts)
        idx = ordering.with_global_index(table, order=("x", "y"), partitions=parts, block_rows=block)
        found.append(kmeans.parallel_seeds(idx, ["x", "y"], 3).centroids.tolist())
    assert found[0] == found[1] == found[2] and len({tuple(c) for c in found[0]}) == 3
    same = ordering.with_global_index(frame(spark, [(2.0, 2.0)] * 5, ["x", "y"]), order=("x", "y"))
    assert kmeans.parallel_seeds(same, ["x", "y"], 2).centroids.tolist() == [[2.0, 2.0]] * 2


def test_outlier_scores_highest(spark):
    rows = frame(spark, [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (100.0, 100.0)], ["x", "y"])
    scores = kmeans.KMeans([[25.25, 25.25]], ["x", "y"]).with_scores(rows)
    assert scores.orderBy(F.desc("anomaly_score")).first()["x"] == 100.0
    three_four = kmeans.KMeans([[0.0, 0.0]], ["x", "y"]).with_cluster(frame(spark, [(3.0, 4.0)], ["x", "y"]))
    assert three_four.first()["distance"] == 5.0


def test_naive_bayes(spark):
    rows = [(v, "a") for v in (1.0, 1.5, 2.0)] + [(v, "b") for v in (10.0, 10.5, 11.0)]
    table = frame(spark, rows, ["x"], True)
    for r in bayes.NaiveBayes(bayes.fit(table, ["x"])).predict(table).collect():
        assert r["predicted"] == r["label"] and r["p_a"] + r["p_b"] == pytest.approx(1.0)


def test_single_row_class_has_small_variance(spark):
    table = frame(spark, [(1.0, "a"), (2.0, "b"), (3.0, "b")], ["x"], True)
    stds = {r["class"]: r["std"] for r in bayes.fit(table, ["x"]).collect()}
    assert stds["a"] == pytest.approx(1e-3) and stds["b"] == pytest.approx(0.5)


def test_regression_equals_descent_over_rows(spark):
    rows = [(float(i), float(i * i), 3.0 * i + 5 + (i % 3)) for i in range(40)]
    table = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, y DOUBLE")
    model = linreg.LinearRegression.fit(table, ["a", "b"], "y")
    n = len(rows)
    mean = [sum(r[k] for r in rows) / n for k in range(2)]
    std = [math.sqrt(sum((r[k] - mean[k]) ** 2 for r in rows) / n) for k in range(2)]
    z = [[(r[k] - mean[k]) / std[k] for k in range(2)] for r in rows]
    w, bias = [0.0, 0.0], sum(r[2] for r in rows) / n
    for _ in range(1000):
        errors = [sum(a * b for a, b in zip(zi, w)) + bias - r[2] for zi, r in zip(z, rows)]
        slope = [2 / n * sum(e * zi[k] for e, zi in zip(errors, z)) for k in range(2)]
        w = [w[k] - 0.01 * slope[k] for k in range(2)]
        bias -= 0.01 * 2 / n * sum(errors)
    assert list(model.weights) == pytest.approx(w, rel=1e-6) and model.bias == pytest.approx(bias)


def test_line_is_learned(spark):
    table = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x DOUBLE, y DOUBLE")
    model = linreg.LinearRegression.fit(table, ["x"], "y")
    points = spark.createDataFrame([(5.0,), (10.0,)], "x DOUBLE").select(model.predict().alias("p")).collect()
    assert [p["p"] for p in points] == pytest.approx([11, 21], abs=1)


def test_scaler(spark):
    table = frame(spark, [(0.0, 7.0), (100.0, 7.0), (50.0, 7.0)], ["x", "c"])
    scaler = scaling.Scaler(scaling.fit(table, ["x", "c"]))
    low_high = scaling.minmax(table, scaler, ["x", "c"]).where("x = 0.5").first()
    assert low_high["c"] == 0.0
    assert scaling.zscore(table.where("x = 50"), scaler, ["x"]).first()["x"] == 0.0
    with pytest.raises(RuntimeError):
        scaling.Scaler(scaling.fit(table, ["x"]).where("false"))


def test_metrics(spark):
    pairs = [("anomaly", "anomaly")] * 3 + [("anomaly", "normal")] + [("normal", "anomaly")] * 2 + [("normal", "normal")] * 4
    row = metrics.classification(spark.createDataFrame(pairs, "t STRING, p STRING"), "t", "p").first()
    assert (row["tp"], row["fn"], row["fp"], row["tn"]) == (3, 1, 2, 4)
    assert (row["accuracy"], row["precision"], row["recall"], row["f1_score"]) == (0.7, 0.6, 0.75, 0.6667)


def feature_table(spark, n=60):
    rng = random.Random(5)
    rows = []
    for k in range(n):
        values = [rng.uniform(0, 1) for _ in FEATURES]
        if k % 4 == 0:
            values[FEATURES.index("max_packet_size")] = 20_000.0
        rows.append((k, *values))
    table = spark.createDataFrame(rows, "position BIGINT, " + ", ".join(f"{f} DOUBLE" for f in FEATURES))
    return ordering.with_global_index(training.labelled(table), order=("position",))


def test_training_saves_and_loads(spark, tmp_path):
    trained = training.train_rows(feature_table(spark))
    training.save(trained, spark, str(tmp_path))
    summary = {(r["model"], r["metric"]): r["value"] for r in trained.summary.collect()}
    assert summary[("decision_tree", "accuracy")] == 1.0
    again = training.load_model(spark, str(tmp_path), "decision_tree")
    assert again.nodes[1].threshold == trained.tree.nodes[1].threshold
    assert list(training.load_model(spark, str(tmp_path), "linear_regression").weights) == pytest.approx(
        list(trained.linear.weights)
    )
    assert training.load_model(spark, str(tmp_path), "naive_bayes").classes == ["anomaly", "normal"]
    assert training.load_model(spark, str(tmp_path), "kmeans").centroids.shape == (2, 22)


def test_one_class_gets_copies(spark):
    idx = feature_table(spark, 4)
    single = idx.replace(idx.df.withColumn("label", F.lit("normal")))
    out = labeling.augment_one_class(single).orderBy("i").collect()
    assert len(out) == 14 and [r["label"] for r in out[4:]] == ["anomaly"] * 10
    assert [r["avg_packet_size"] for r in out[4:]] == pytest.approx(
        [out[k % 4]["avg_packet_size"] * 10 for k in range(10)]
    )
    assert labeling.augment_one_class(idx).count() == 4
