"""Registered queries: weak labels, models, metrics and the model-based detector."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetloom.operators import alerts, bayes, detect, features, kmeans, labeling, linreg, metrics, ml_detect
from packetloom.operators import ordering, scaling, tree
from packetloom.plans import training
from packetloom.plans.detect_sql import DETECTIONS
from packetloom.plans.feature_queries import ANCHORED_SQL, TRAILING_SQL, feature_sql
from packetloom.plans.registry import query
from packetloom.schema import FEATURES
from packetloom.session import cut, scratch_path, scratch_tables
from packetloom.sources.packets import load_packets

SECONDS = 5
LABEL_SQL = """CASE WHEN max_packet_size > 10000 OR packets_per_second > 50 OR unique_destinations > 20
  OR syn_ratio > 0.8 THEN 'anomaly' ELSE 'normal' END"""
SCORE_SQL = """least(1.0::DOUBLE, (CASE WHEN max_packet_size > 10000 THEN 3 ELSE 0 END
  + CASE WHEN packets_per_second > 50 THEN 3 ELSE 0 END + CASE WHEN unique_destinations > 20 THEN 2 ELSE 0 END
  + CASE WHEN syn_ratio > 0.8 THEN 2 ELSE 0 END) / 10.0::DOUBLE)"""
ROWS_SQL = [
    f"w5 AS (SELECT *, time_bucket(INTERVAL {SECONDS} SECOND, timestamp) AS window_start FROM packets)",
    f"f5 AS ({feature_sql('w5', ['window_start'])})",
    f"""lab AS (SELECT *, {LABEL_SQL} AS label, {SCORE_SQL} AS score, row_number() OVER (ORDER BY window_start) AS i
      FROM f5)""",
]
LIST = ", ".join(FEATURES)
NAMES = "[" + ", ".join(f"'{c}'" for c in FEATURES) + "]"


def long_sql(table: str, key: str, extra: str = "") -> str:
    """(key, extra, feature, name, value): a feature table turned upright."""
    more = f", {extra}" if extra else ""
    return (
        f"SELECT {key}{more}, unnest(range({len(FEATURES)})) AS feature, unnest({NAMES}) AS name,"
        f" unnest([{LIST}]) AS value FROM {table}"
    )


def _rows(spark, sf):
    """Labelled 5-second feature windows, written once because models read them repeatedly."""
    return cut(training.labelled(features.features_windowed(load_packets(spark, sf), SECONDS)))


def _indexed(spark, sf):
    return ordering.with_global_index(
        training.labelled(features.features_windowed(load_packets(spark, sf), SECONDS)), order=("window_start",)
    )


# --- labels ---------------------------------------------------------------------

@query("weak_label", "SELECT window_start, label FROM lab", ROWS_SQL)
def weak_label(spark, sf):
    return training.labelled(features.features_windowed(load_packets(spark, sf), SECONDS)).select(
        "window_start", "label"
    )


@query("weak_score", "SELECT window_start, score FROM lab", ROWS_SQL)
def weak_score(spark, sf):
    return training.labelled(features.features_windowed(load_packets(spark, sf), SECONDS)).select(
        "window_start", "score"
    )


@query(
    "one_class_augment",
    """SELECT i, 'normal' AS label, round(avg_packet_size, 6) AS avg_packet_size,
      round(packets_per_second, 6) AS packets_per_second, 0.0::DOUBLE AS score FROM lab
    UNION ALL SELECT (SELECT count(*) FROM lab) + i, 'anomaly', round(avg_packet_size * 10, 6),
      round(packets_per_second * 20, 6), 0.9::DOUBLE FROM lab WHERE i <= 10""",
    ROWS_SQL,
)
def one_class_augment(spark, sf):
    idx = _indexed(spark, sf)
    single = idx.replace(idx.df.withColumns({"label": F.lit("normal"), "score": F.lit(0.0)}))
    return labeling.augment_one_class(single).select(
        "i", "label", F.round("avg_packet_size", 6).alias("avg_packet_size"),
        F.round("packets_per_second", 6).alias("packets_per_second"), "score",
    )


# --- decision tree ----------------------------------------------------------------

@query(
    "entropy",
    """SELECT round(-sum(c / n * log2(c / n)), 6) AS entropy
    FROM (SELECT count(*) AS c, (SELECT count(*) FROM lab) AS n FROM lab GROUP BY label) q""",
    ROWS_SQL,
)
def entropy(spark, sf):
    return tree.entropy(_rows(spark, sf), "label").select(F.round("entropy", 6).alias("entropy"))


GAIN_SQL = [
    *ROWS_SQL,
    f"cells AS ({long_sql('lab', 'i', 'label')})",
    """vals AS (SELECT feature, value, count(*) FILTER (label = 'anomaly') AS a,
      count(*) FILTER (label = 'normal') AS b FROM cells GROUP BY 1, 2)""",
    """cum AS (SELECT feature, value, lead(value) OVER w AS following, sum(a) OVER w AS la, sum(b) OVER w AS lb,
      (SELECT count(*) FROM lab WHERE label = 'anomaly') AS ta, (SELECT count(*) FROM lab WHERE label = 'normal') AS tb
      FROM vals WINDOW w AS (PARTITION BY feature ORDER BY value))""",
    """parts AS (SELECT feature, value, following, ta + tb AS n, la + lb AS nl, ta + tb - la - lb AS nr,
      [la, lb] AS l, [ta - la, tb - lb] AS r, [ta, tb] AS t FROM cum WHERE ta + tb - la - lb > 0)""",
    """gains AS (SELECT feature, value, (value + following) / 2 AS threshold, CAST(nl AS BIGINT) AS n_left,
      CAST(nr AS BIGINT) AS n_right,
      list_sum([CASE WHEN c > 0 THEN -c / n * log2(c / n) ELSE 0 END for c in t])
      - nl / n * list_sum([CASE WHEN c > 0 THEN -c / nl * log2(c / nl) ELSE 0 END for c in l])
      - nr / n * list_sum([CASE WHEN c > 0 THEN -c / nr * log2(c / nr) ELSE 0 END for c in r]) AS gain FROM parts)""",
]


def _root_gains(spark, sf):
    rows = _rows(spark, sf).withColumn("node", F.lit(1))
    return rows, tree.split_gains(rows, FEATURES, "label", ["anomaly", "normal"])


@query(
    "information_gain",
    """SELECT CAST(feature AS INT) AS feature, round(value, 6) AS value, n_left, n_right, round(gain, 6) AS gain
    FROM gains""",
    GAIN_SQL,
)
def information_gain(spark, sf):
    _, gains = _root_gains(spark, sf)
    return gains.select(
        "feature", F.round("value", 6).alias("value"), "n_left", "n_right", F.round("gain", 6).alias("gain")
    )


@query(
    "best_split",
    """SELECT CAST(feature AS INT) AS feature, round(threshold, 6) AS threshold, n_left, n_right,
    round(gain, 6) AS gain FROM gains ORDER BY round(gains.gain, 9) DESC, gains.feature, gains.threshold LIMIT 1""",
    GAIN_SQL,
)
def best_split(spark, sf):
    rows, gains = _root_gains(spark, sf)
    return tree.best_splits(gains, rows, FEATURES).select(
        "feature", F.round("threshold", 6).alias("threshold"), "n_left", "n_right", F.round("gain", 6).alias("gain")
    )


def grown_sql(train: str, rows: str = "lab") -> list[str]:
    """A tree grown level by level over the rows of ``train``, and all ``rows`` walked down it."""
    return [
        *ROWS_SQL,
        f"everything AS MATERIALIZED ({long_sql(rows, 'i', 'label')})",
        f"cells AS MATERIALIZED (SELECT * FROM everything WHERE i IN (SELECT i FROM {train}))",
        """grown AS (SELECT 0 AS depth, i, label, 1 AS node, CAST(NULL AS BIGINT) AS f, CAST(NULL AS DOUBLE) AS t,
          CAST(NULL AS DOUBLE) AS g FROM (SELECT DISTINCT i, label FROM cells) c
        UNION ALL
        SELECT p.depth + 1, p.i, p.label, CASE WHEN x.value <= s.t THEN 2 * p.node ELSE 2 * p.node + 1 END, s.f, s.t, s.g
        FROM grown p JOIN (
          SELECT node, arg_min(feature, (-round(gain, 9), feature, threshold)) AS f,
            arg_min(threshold, (-round(gain, 9), feature, threshold)) AS t, max(gain) AS g
          FROM (SELECT *, (value + following) / 2 AS threshold,
              (CASE WHEN ta > 0 THEN -ta / n * log2(ta / n) ELSE 0 END
                + CASE WHEN tb > 0 THEN -tb / n * log2(tb / n) ELSE 0 END)
              - (CASE WHEN la > 0 THEN -la / n * log2(la / nl) ELSE 0 END
                + CASE WHEN lb > 0 THEN -lb / n * log2(lb / nl) ELSE 0 END)
              - (CASE WHEN ta > la THEN -(ta - la) / n * log2((ta - la) / (n - nl)) ELSE 0 END
                + CASE WHEN tb > lb THEN -(tb - lb) / n * log2((tb - lb) / (n - nl)) ELSE 0 END) AS gain
            FROM (SELECT node, feature, value, lead(value) OVER w AS following, sum(a) OVER w AS la,
                sum(b) OVER w AS lb, sum(a + b) OVER w AS nl, sum(a) OVER k AS ta, sum(b) OVER k AS tb,
                sum(a + b) OVER k AS n
              FROM (SELECT node, feature, value, count(*) FILTER (c.label = 'anomaly') AS a,
                  count(*) FILTER (c.label = 'normal') AS b FROM grown r JOIN cells c ON r.i = c.i
                WHERE depth < 10 GROUP BY 1, 2, 3) v
              WINDOW w AS (PARTITION BY node, feature ORDER BY value), k AS (PARTITION BY node, feature)) u
            WHERE following IS NOT NULL AND n >= 5 AND ta > 0 AND tb > 0) q
          WHERE gain > 1e-12 GROUP BY node) s ON s.node = p.node
        JOIN cells x ON x.i = p.i AND x.feature = s.f)""",
        """splits AS (SELECT node // 2 AS node, any_value(f) AS f, any_value(t) AS t, any_value(g) AS g FROM grown
          WHERE depth > 0 GROUP BY 1)""",
        f"""nodes AS (SELECT n.node, depth, f, ({NAMES})[f + 1] AS feature_name, t, g, samples,
          CASE WHEN a >= b THEN 'anomaly' ELSE 'normal' END AS class
          FROM (SELECT node, depth, count(*) AS samples, count(*) FILTER (label = 'anomaly') AS a,
            count(*) FILTER (label = 'normal') AS b FROM grown GROUP BY 1, 2) n LEFT JOIN splits s ON n.node = s.node)""",
        f"""walk AS (SELECT i, 1 AS node FROM {rows} UNION ALL
          SELECT w.i, CASE WHEN x.value <= s.t THEN 2 * w.node ELSE 2 * w.node + 1 END FROM walk w
          JOIN splits s ON s.node = w.node JOIN everything x ON x.i = w.i AND x.feature = s.f)""",
        """guess AS (SELECT i, class AS p FROM (SELECT i, max(node) AS node FROM walk GROUP BY 1) q
          JOIN nodes USING (node))""",
    ]


@query(
    "id3_nodes",
    """SELECT CAST(node AS INT) AS node_id, CAST(depth AS INT) AS depth, CAST(f AS INT) AS feature, feature_name,
    round(t, 6) AS threshold, CAST(CASE WHEN f IS NOT NULL THEN 2 * node END AS INT) AS left,
    CAST(CASE WHEN f IS NOT NULL THEN 2 * node + 1 END AS INT) AS right, class, samples,
    round(coalesce(g, 0), 6) AS gain FROM nodes""",
    grown_sql("lab"),
)
def id3_nodes(spark, sf):
    nodes = tree.DecisionTree.fit(_rows(spark, sf), FEATURES).table(spark)
    return nodes.withColumns({"threshold": F.round("threshold", 6), "gain": F.round("gain", 6)})


@query(
    "id3_predict",
    "SELECT window_start, label, p AS predicted FROM lab JOIN guess USING (i)",
    grown_sql("lab"),
)
def id3_predict(spark, sf):
    rows = _rows(spark, sf)
    model = tree.DecisionTree.fit(rows, FEATURES)
    return rows.select("window_start", "label", model.predict().alias("predicted"))


@query(
    "id3_importance",
    """SELECT feature_name, round(sum(g) / (SELECT sum(g) FROM nodes), 6) AS gain_sum,
    round(sum(g * samples) / (SELECT sum(g * samples) FROM nodes), 6) AS gain_weighted FROM nodes
    WHERE f IS NOT NULL GROUP BY 1""",
    grown_sql("lab"),
)
def id3_importance(spark, sf):
    shares = tree.importance(tree.DecisionTree.fit(_rows(spark, sf), FEATURES).table(spark))
    return shares.withColumns({c: F.round(c, 6) for c in ("gain_sum", "gain_weighted")})


# --- k-means -------------------------------------------------------------------------

MM_SQL = [
    *ROWS_SQL,
    f"long AS ({long_sql('lab', 'i', 'label')})",
    """rng AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long GROUP BY 1)""",
    """sc AS (SELECT i, label, feature, CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0.0 END AS value
      FROM long JOIN rng USING (feature))""",
    "c0 AS (SELECT CASE label WHEN 'anomaly' THEN 0 ELSE 1 END AS cluster, feature, avg(value) AS c FROM sc GROUP BY 1, 2)",
    """near AS (SELECT i, cluster, sqrt(sum((value - c) * (value - c))) AS distance FROM sc JOIN c0 USING (feature)
      GROUP BY 1, 2)""",
    """placed AS (SELECT i, CAST(arg_min(cluster, (round(distance, 12), cluster)) AS INT) AS cluster,
      min(distance) AS distance FROM near GROUP BY 1)""",
]


def _scaled(spark, sf):
    """Min-max scaled labelled windows with their index."""
    idx = _indexed(spark, sf)
    scaler = scaling.Scaler(scaling.fit(idx.df, FEATURES))
    return idx.replace(cut(scaling.minmax(idx.df, scaler, FEATURES)))


def _class_means(rows):
    means = rows.groupBy("label").agg(*[F.avg(c).alias(c) for c in FEATURES]).orderBy("label").collect()
    return kmeans.KMeans([[m[c] for c in FEATURES] for m in means], FEATURES)


@query("kmeans_predict", "SELECT i, cluster FROM placed", MM_SQL)
def kmeans_predict(spark, sf):
    rows = _scaled(spark, sf).df
    return _class_means(rows).with_cluster(rows).select("i", "cluster")


@query("kmeans_distance", "SELECT i, round(distance, 6) AS distance FROM placed", MM_SQL)
def kmeans_distance(spark, sf):
    rows = _scaled(spark, sf).df
    return _class_means(rows).with_cluster(rows).select("i", F.round("distance", 6).alias("distance"))


@query(
    "kmeans_scores",
    """SELECT i, round(distance / (SELECT max(distance) FROM placed), 6) AS anomaly_score,
    distance / (SELECT max(distance) FROM placed) > 0.7 AS is_anomaly FROM placed""",
    MM_SQL,
)
def kmeans_scores(spark, sf):
    rows = _scaled(spark, sf).df
    return _class_means(rows).with_scores(rows).select(
        "i", F.round("anomaly_score", 6).alias("anomaly_score"), (F.col("anomaly_score") > 0.7).alias("is_anomaly")
    )


@query("cluster_sizes", "SELECT cluster, count(*) AS size FROM placed GROUP BY 1", MM_SQL)
def cluster_sizes(spark, sf):
    rows = _scaled(spark, sf).df
    return kmeans.cluster_sizes(_class_means(rows).with_cluster(rows))


@query(
    "kmeans_step",
    """SELECT cluster, CAST(feature AS INT) AS feature, round(avg(value), 6) AS value
    FROM sc JOIN placed USING (i) GROUP BY 1, 2""",
    MM_SQL,
)
def kmeans_step(spark, sf):
    rows = _scaled(spark, sf).df
    moved, _ = _class_means(rows).step(rows)
    return moved.table(spark).select("cluster", "feature", F.round("value", 6).alias("value"))


def lloyd_sql(source: str, rounds: int = 2, steps: int = 40) -> list[str]:
    """Two clusters of ``source(i, feature, value)``: drawn candidates, two of them, then Lloyd steps that come to rest.

    The last step's centroids are ``fitted(cluster, feature, c)``, its assignment ``member(i, cluster)``.
    """
    squares = "SELECT p.i, c.i AS j, sum((p.value - c.value) * (p.value - c.value)) AS d FROM pts p JOIN pts c USING (feature)"
    nearest = """SELECT i, arg_min(cluster, (round(distance, 12), cluster)) AS cluster FROM (SELECT p.i, cluster,
      sqrt(sum((value - c) * (value - c))) AS distance FROM pts p JOIN {0} USING (feature) GROUP BY 1, 2) q GROUP BY 1"""
    out = [
        f"pts AS MATERIALIZED (SELECT i, feature, value FROM {source})",
        "m0 AS MATERIALIZED (SELECT i FROM (SELECT DISTINCT i FROM pts) p ORDER BY md5('42:0:' || i)[:13], i LIMIT 1)",
    ]
    for r in range(1, rounds + 1):
        out += [
            f"""d{r} AS MATERIALIZED (SELECT i, min(d) AS d FROM ({squares} WHERE c.i IN (SELECT i FROM m{r - 1}) GROUP BY 1, 2) s
              GROUP BY 1)""",
            f"w{r} AS MATERIALIZED (SELECT i, CAST(floor(d / (SELECT max(d) FROM d1) * 1000000 + 0.5) AS HUGEINT) AS w FROM d{r})",
            f"""m{r} AS MATERIALIZED (SELECT i FROM m{r - 1} UNION SELECT i FROM w{r} WHERE
              CAST(('0x' || md5('42:{r}:' || i)[:13]) AS HUGEINT) * (SELECT sum(w) FROM w{r}) < w * 18014398509481984)""",
        ]
    out += [
        f"""cand AS MATERIALIZED (SELECT i AS cluster, feature, value AS c FROM pts WHERE i IN (SELECT i FROM m{rounds}))""",
        f"cn AS MATERIALIZED (SELECT cluster AS j, count(*) AS n FROM ({nearest.format('cand')}) q GROUP BY 1)",
        "k0 AS MATERIALIZED (SELECT j FROM cn ORDER BY n DESC, j LIMIT 1)",
        f"""k1 AS MATERIALIZED (SELECT cn.j FROM cn JOIN ({squares} WHERE c.i IN (SELECT j FROM k0) GROUP BY 1, 2) s ON s.i = cn.j
          ORDER BY n * d DESC, cn.j LIMIT 1)""",
        """l0 AS MATERIALIZED (SELECT 0 AS cluster, feature, value AS c FROM pts WHERE i IN (SELECT j FROM k0)
          UNION ALL SELECT 1, feature, value FROM pts WHERE i IN (SELECT j FROM k1))""",
    ]
    for t in range(1, steps + 1):
        out += [
            f"a{t} AS MATERIALIZED ({nearest.format(f'l{t - 1}')})",
            f"l{t} AS MATERIALIZED (SELECT cluster, feature, avg(value) AS c FROM pts JOIN a{t} USING (i) GROUP BY 1, 2)",
        ]
    return [*out, f"fitted AS (SELECT * FROM l{steps})", f"member AS (SELECT * FROM a{steps})"]


FITTED_SQL = f"""SELECT CAST(cluster AS INT) AS cluster, CAST(feature AS INT) AS feature, ({NAMES})[feature + 1] AS name,
    round(c, 6) AS value FROM fitted"""


@query("kmeans_fit", FITTED_SQL, [*MM_SQL[:6], *lloyd_sql("sc")])
def kmeans_fit(spark, sf):
    idx = _scaled(spark, sf)
    fitted = kmeans.fit(idx.df, FEATURES, kmeans.parallel_seeds(idx, FEATURES, 2)).table(spark)
    return fitted.withColumn("value", F.round("value", 6))


@query("kmeans_fit_mllib")
def kmeans_fit_mllib(spark, sf):
    return kmeans.fit_mllib(_scaled(spark, sf).df, FEATURES, 2).table(spark)


# --- naive Bayes -----------------------------------------------------------------------

NB_SQL = [
    *ROWS_SQL,
    f"long AS ({long_sql('lab', 'i', 'label')})",
    """nb AS (SELECT label AS class, count(*) / (SELECT count(*) FROM lab) AS prior, feature, name, avg(value) AS mean,
      CASE WHEN CASE WHEN count(*) > 1 THEN var_pop(value) ELSE 1e-6 END > 0
        THEN sqrt(CASE WHEN count(*) > 1 THEN var_pop(value) ELSE 1e-6 END) ELSE 1e-6 END AS std
      FROM long GROUP BY label, feature, name)""",
    """pdfs AS (SELECT i, class, prior, value, 1 / (sqrt(2 * pi()) * greatest(std, 1e-6))
        * exp(-((value - mean) ** 2) / (2 * greatest(std, 1e-6) ** 2)) AS pdf
      FROM long JOIN nb USING (feature, name))""",
    """ll AS (SELECT i, class, ln(any_value(prior)) + sum(CASE WHEN pdf > 0 THEN ln(nullif(pdf, 0)) ELSE -100 END) AS l
      FROM pdfs GROUP BY 1, 2)""",
    """pr AS (SELECT i, class, exp(l - max(l) OVER (PARTITION BY i)) AS w,
      row_number() OVER (PARTITION BY i ORDER BY l DESC, class) AS rn FROM ll)""",
]


@query(
    "nb_fit",
    """SELECT class, round(prior, 6) AS prior, CAST(feature AS INT) AS feature, name, round(mean, 6) AS mean,
    round(std, 6) AS std FROM nb""",
    NB_SQL,
)
def nb_fit(spark, sf):
    params = bayes.fit(_rows(spark, sf), FEATURES)
    return params.select(
        "class", F.round("prior", 6).alias("prior"), "feature", "name", F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
    )


@query(
    "model_store",
    """SELECT i, max(class) FILTER (rn = 1) AS predicted FROM pr GROUP BY i""",
    NB_SQL,
)
def model_store(spark, sf):
    """Predictions of a model that was saved and loaded again."""
    rows, path = _indexed(spark, sf).df, scratch_path(spark, "models")
    training.save_model(bayes.fit(rows, FEATURES), path, "naive_bayes")
    return training.load_model(spark, path, "naive_bayes").predict(rows).select("i", "predicted")


@query(
    "nb_predict",
    """SELECT i, max(class) FILTER (rn = 1) AS predicted,
    round(coalesce(sum(w) FILTER (class = 'anomaly'), 0) / sum(w), 6) AS p_anomaly,
    round(coalesce(sum(w) FILTER (class = 'normal'), 0) / sum(w), 6) AS p_normal FROM pr GROUP BY i""",
    NB_SQL,
)
def nb_predict(spark, sf):
    idx = _indexed(spark, sf)
    model = bayes.NaiveBayes(bayes.fit(idx.df, FEATURES))
    return model.predict(idx.df).select(
        "i", "predicted", *[F.round(f"p_{c}", 6).alias(f"p_{c}") for c in ("anomaly", "normal")]
    )


# --- regression --------------------------------------------------------------------------

@query(
    "linreg_gram",
    """SELECT CAST(a.p AS INT) AS i, CAST(b.p AS INT) AS j, round(sum(a.v * b.v), 4) AS value FROM vec a
    JOIN vec b ON a.k = b.k AND a.p <= b.p GROUP BY 1, 2""",
    [
        *ROWS_SQL,
        f"long AS ({long_sql('lab', 'i', 'label')})",
        """st AS (SELECT feature, avg(value) AS m, CASE WHEN stddev_pop(value) > 1e-12 THEN stddev_pop(value) ELSE 1 END
          AS s FROM long GROUP BY 1)""",
        """vec AS (SELECT i AS k, 0 AS p, 1.0::DOUBLE AS v FROM lab UNION ALL
          SELECT i, feature + 1, (value - m) / s FROM long JOIN st USING (feature)
          UNION ALL SELECT i, 23, score FROM lab)""",
    ],
)
def linreg_gram(spark, sf):
    """The sums the regression needs: products of 1, the standardised features and the target."""
    rows = _rows(spark, sf)
    params = scaling.Scaler(scaling.fit(rows, FEATURES)).params
    sums = linreg.gram(rows, FEATURES, "score", [params[c][2] for c in FEATURES], [params[c][3] for c in FEATURES])
    return sums.select("i", "j", (F.round("value", 4) + F.lit(0.0)).alias("value"))


def descent_sql(train: str) -> list[str]:
    """Gradient descent over the rows of ``train``: 1000 epochs as a recursion, then predictions for all rows."""
    return [
        *ROWS_SQL,
        f"everything AS ({long_sql('lab', 'i')})",
        f"tr AS (SELECT * FROM lab WHERE i IN (SELECT i FROM {train}))",
        """st AS (SELECT feature, avg(value) AS m, CASE WHEN stddev_pop(value) > 1e-12 THEN stddev_pop(value) ELSE 1 END
          AS s FROM everything WHERE i IN (SELECT i FROM tr) GROUP BY 1)""",
        "za AS (SELECT i, feature, (value - m) / s AS v FROM everything JOIN st USING (feature))",
        "z AS (SELECT za.*, score FROM za JOIN tr USING (i))",
        """gm AS (SELECT list(line ORDER BY f) AS g FROM (SELECT f, list(x ORDER BY h) AS line FROM (
          SELECT a.feature AS f, b.feature AS h, sum(a.v * b.v) AS x FROM z a JOIN z b ON a.i = b.i GROUP BY 1, 2) q
          GROUP BY 1) r)""",
        """zs AS (SELECT list(sv ORDER BY feature) AS s, list(zy ORDER BY feature) AS zy FROM (
          SELECT feature, sum(v) AS sv, sum(v * score) AS zy FROM z GROUP BY 1) q)""",
        """base AS MATERIALIZED (SELECT g, s, zy, (SELECT count(*) FROM tr)::DOUBLE AS n, (SELECT sum(score) FROM tr) AS y
          FROM gm, zs)""",
        f"""gd AS (SELECT 0 AS t, [0.0::DOUBLE for k in range({len(FEATURES)})] AS w, y / n AS b FROM base UNION ALL
          SELECT t + 1, [w[k] - 0.01 * 2 / n * (list_dot_product(g[k], w) + b * s[k] - zy[k])
            for k in range(1, {len(FEATURES) + 1})],
          b - 0.01 * 2 / n * (list_dot_product(s, w) + n * b - y) FROM gd, base WHERE t < 1000)""",
        "fin AS MATERIALIZED (SELECT w, b FROM gd WHERE t = 1000)",
        """guess AS (SELECT i, any_value(b) + sum(v * w[feature + 1]) AS p FROM za, fin GROUP BY i)""",
    ]


REGRESSION_SQL = """SELECT count(*) AS n, round(avg((score - p) ** 2), 6) AS mse, round(sqrt(avg((score - p) ** 2)), 6) AS rmse,
    round(CASE WHEN var_pop(score) > 0 THEN 1 - avg((score - p) ** 2) / var_pop(score) ELSE 0 END, 4) AS r_squared
    FROM lab JOIN guess USING (i)"""


@query(
    "linreg_fit",
    f"""SELECT CAST(feature AS INT) AS feature, ({NAMES})[feature + 1] AS name, round(m, 6) AS mean, round(s, 6) AS std,
      round(w[feature + 1], 6) AS weight FROM st, fin
    UNION ALL SELECT -1, 'bias', 0, 1, round(b, 6) FROM fin""",
    descent_sql("lab"),
)
def linreg_fit(spark, sf):
    weights = linreg.LinearRegression.fit(_rows(spark, sf), FEATURES, "score").table(spark)
    return weights.withColumns({c: F.round(c, 6) for c in ("mean", "std", "weight")})


@query(
    "linreg_predict",
    "SELECT window_start, score, round(p, 6) AS predicted FROM lab JOIN guess USING (i)",
    descent_sql("lab"),
)
def linreg_predict(spark, sf):
    rows = _rows(spark, sf)
    model = linreg.LinearRegression.fit(rows, FEATURES, "score")
    return rows.select("window_start", "score", F.round(model.predict(), 6).alias("predicted"))


@query("linreg_eval", REGRESSION_SQL, descent_sql("lab"))
def linreg_eval(spark, sf):
    rows = _rows(spark, sf)
    model = linreg.LinearRegression.fit(rows, FEATURES, "score")
    return metrics.regression(rows.withColumn("predicted", model.predict()), "score", "predicted")


# --- training ----------------------------------------------------------------------------

FIRST_80 = "(SELECT i FROM lab WHERE i <= (SELECT count(*) * 80 // 100 FROM lab)) f"
LAST_20 = "i > (SELECT count(*) * 80 // 100 FROM lab)"
CONFUSION_SQL = f"""cm AS (SELECT count(*) AS n, count(*) FILTER (label='anomaly' AND p='anomaly') AS tp,
  count(*) FILTER (label='normal' AND p='normal') AS tn, count(*) FILTER (label='normal' AND p='anomaly') AS fp,
  count(*) FILTER (label='anomaly' AND p='normal') AS fn FROM lab JOIN guess USING (i) WHERE {LAST_20})"""
METRIC_SQL = """SELECT tp, tn, fp, fn, round(coalesce((tp + tn) / nullif(n, 0), 0), 4) AS accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1_score FROM cm"""


@query("train_eval_tree", METRIC_SQL, [*grown_sql(FIRST_80), CONFUSION_SQL])
def train_eval_tree(spark, sf):
    return training.train_tree(_indexed(spark, sf))[1]


SPLIT_NB = [
    *ROWS_SQL,
    f"long AS ({long_sql('lab', 'i', 'label')})",
    "edge AS (SELECT count(*) * 80 // 100 AS e FROM lab)",
    """nb AS (SELECT label AS class, count(*) / (SELECT e FROM edge) AS prior, feature, avg(value) AS mean,
      CASE WHEN CASE WHEN count(*) > 1 THEN var_pop(value) ELSE 1e-6 END > 0
        THEN sqrt(CASE WHEN count(*) > 1 THEN var_pop(value) ELSE 1e-6 END) ELSE 1e-6 END AS std
      FROM long WHERE i <= (SELECT e FROM edge) GROUP BY label, feature)""",
    """ll AS (SELECT i, label, class, ln(any_value(prior)) + sum(CASE WHEN pdf > 0 THEN ln(nullif(pdf, 0)) ELSE -100 END)
      AS l FROM (SELECT i, label, class, prior, 1 / (sqrt(2 * pi()) * greatest(std, 1e-6))
        * exp(-((value - mean) ** 2) / (2 * greatest(std, 1e-6) ** 2)) AS pdf
        FROM long JOIN nb USING (feature) WHERE i > (SELECT e FROM edge)) q GROUP BY 1, 2, 3)""",
    "pred AS (SELECT i, label, arg_max(class, l) AS p FROM ll GROUP BY 1, 2)",
    """cm AS (SELECT count(*) AS n, count(*) FILTER (label='anomaly' AND p='anomaly') AS tp,
      count(*) FILTER (label='normal' AND p='normal') AS tn, count(*) FILTER (label='normal' AND p='anomaly') AS fp,
      count(*) FILTER (label='anomaly' AND p='normal') AS fn FROM pred)""",
]
@query("train_eval_bayes", METRIC_SQL, SPLIT_NB)
def train_eval_bayes(spark, sf):
    return training.train_bayes(_indexed(spark, sf))[1]


@query("train_eval_linreg", REGRESSION_SQL + f" WHERE {LAST_20}", descent_sql(FIRST_80))
def train_eval_linreg(spark, sf):
    return training.train_linear(_indexed(spark, sf))[1]


@query(
    "train_eval_kmeans",
    "SELECT CAST(cluster AS INT) AS cluster, count(*) AS size FROM member GROUP BY 1",
    [*ROWS_SQL, *lloyd_sql(f"({long_sql('lab', 'i')}) f")],
)
def train_eval_kmeans(spark, sf):
    return training.train_kmeans(_indexed(spark, sf))[1]


@query(
    "classification_metrics",
    METRIC_SQL,
    """cm AS (SELECT count(*) AS n, count(*) FILTER (toxic = 1 AND quality = 0) AS tp,
      count(*) FILTER (toxic = 0 AND quality = 1) AS tn, count(*) FILTER (toxic = 0 AND quality = 0) AS fp,
      count(*) FILTER (toxic = 1 AND quality = 1) AS fn FROM labels)""",
)
def classification_metrics(spark, sf):
    """Two label columns as truth and prediction."""
    table = spark.read.parquet(f"{sf}/labels.parquet").select(
        F.when(F.col("toxic") == 1, "anomaly").otherwise("normal").alias("truth"),
        F.when(F.col("quality") == 0, "anomaly").otherwise("normal").alias("predicted"),
    )
    return metrics.classification(table, "truth", "predicted")


def _upright(model: str, columns: list[str], ctes: list[str], select: str) -> str:
    """(model, metric, value) of a one-row SELECT that sees ``ctes`` on top of the labelled rows."""
    names, values = ", ".join(f"'{c}'" for c in columns), ", ".join(f"CAST({c} AS DOUBLE)" for c in columns)
    inner = f"(WITH RECURSIVE {', '.join(ctes[len(ROWS_SQL):])} {select})"
    return f"SELECT '{model}' AS model, unnest([{names}]) AS metric, unnest([{values}]) AS value FROM {inner} {model}"


COUNTED = ["tp", "tn", "fp", "fn", "accuracy", "precision", "recall", "f1_score"]
ALL_LONG = [*ROWS_SQL, *lloyd_sql(f"({long_sql('lab', 'i')}) f")]
SUMMARY_SQL = " UNION ALL ".join([
    _upright("decision_tree", COUNTED, [*grown_sql(FIRST_80), CONFUSION_SQL], METRIC_SQL),
    _upright("naive_bayes", COUNTED, SPLIT_NB, METRIC_SQL),
    _upright("linear_regression", ["n", "mse", "rmse", "r_squared"], descent_sql(FIRST_80), REGRESSION_SQL + f" WHERE {LAST_20}"),
    _upright(
        "kmeans", ["size_0", "size_1", "inertia"], ALL_LONG,
        """SELECT (SELECT count(*) FROM member WHERE cluster = 0) AS size_0, (SELECT count(*) FROM member WHERE cluster = 1) AS size_1,
          (SELECT sum((value - c) * (value - c)) FROM pts JOIN member USING (i) JOIN fitted USING (cluster, feature)) AS inertia"""),
])


@query(
    "train_all",
    f"SELECT model, metric, round(value, 4) AS value FROM ({SUMMARY_SQL}) s",
    [
        *ANCHORED_SQL,
        f"lab0 AS MATERIALIZED (SELECT *, {LABEL_SQL} AS label, {SCORE_SQL} AS score, row_number() OVER (ORDER BY window_start) AS i FROM af)",
        """lab AS MATERIALIZED (SELECT * FROM lab0 UNION ALL SELECT * REPLACE (avg_packet_size * 10 AS avg_packet_size,
          packets_per_second * 20 AS packets_per_second, 'anomaly' AS label, 0.9 AS score, (SELECT count(*) FROM lab0) + i AS i)
          FROM lab0 WHERE i <= 10 AND (SELECT count(DISTINCT label) FROM lab0) = 1)""",
    ],
)
def train_all(spark, sf):
    """The whole run on anchored windows: tree, naive Bayes and regression on the last fifth, clusters on all rows."""
    return training.train_all(load_packets(spark, sf), SECONDS).summary.withColumn("value", F.round("value", 4))


# --- the model-based detector ---------------------------------------------------------------

PROBES_SQL = [
    f"tf AS ({feature_sql('tr', ['probe'])})",
    *MM_SQL,
    f"tlong AS ({long_sql('tf', 'probe', 'packets')})",
    """tsc AS MATERIALIZED (SELECT probe, packets, feature, CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0.0 END AS value
      FROM tlong JOIN rng USING (feature) WHERE packets >= 10)""",
]
RELATED_SQL = """rel AS (SELECT p.i AS probe, list_sort(list_distinct(flatten(list([x.src_ip, x.dst_ip])))) AS related
      FROM ix p JOIN ix x ON x.i BETWEEN p.i - 9 AND p.i WHERE p.i % 10 = 0 GROUP BY 1)"""
SCALED_SQL = "slab AS MATERIALIZED (SELECT i, label, " + ", ".join(
    f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"
    f" ELSE 0.0 END AS {c}" for c in FEATURES) + " FROM lab)"
CLASS_MEANS_SQL = """judged AS (SELECT probe, score FROM (SELECT probe, min(distance) AS score FROM (SELECT probe, cluster,
      sqrt(sum((value - c) * (value - c))) AS distance FROM tsc JOIN c0 USING (feature) GROUP BY 1, 2) q GROUP BY 1) d
      WHERE score > 0.7)"""
FITTED_MEANS_SQL = [*lloyd_sql("sc"), CLASS_MEANS_SQL.replace("c0", "fitted")]
TREE_SQL = [
    SCALED_SQL,
    *grown_sql("(SELECT i FROM lab) f", "slab")[len(ROWS_SQL):],
    """descent AS (SELECT probe, 1 AS node FROM (SELECT DISTINCT probe FROM tsc) p UNION ALL
      SELECT w.probe, CASE WHEN x.value <= s.t THEN 2 * w.node ELSE 2 * w.node + 1 END FROM descent w
      JOIN splits s ON s.node = w.node JOIN tsc x ON x.probe = w.probe AND x.feature = s.f)""",
    """judged AS (SELECT probe, 0.8::DOUBLE AS score FROM (SELECT probe, max(node) AS node FROM descent GROUP BY 1) q
      JOIN nodes USING (node) WHERE class = 'anomaly')""",
]
BAYES_SQL = [
    """nb AS (SELECT label AS class, count(*) / (SELECT count(*) FROM lab) AS prior, feature, avg(value) AS mean,
      CASE WHEN CASE WHEN count(*) > 1 THEN var_pop(value) ELSE 1e-6 END > 0
        THEN sqrt(CASE WHEN count(*) > 1 THEN var_pop(value) ELSE 1e-6 END) ELSE 1e-6 END AS std FROM sc GROUP BY label, feature)""",
    """ll AS (SELECT probe, class, ln(any_value(prior)) + sum(CASE WHEN pdf > 0 THEN ln(nullif(pdf, 0)) ELSE -100 END) AS l
      FROM (SELECT probe, class, prior, 1 / (sqrt(2 * pi()) * greatest(std, 1e-6))
        * exp(-((value - mean) ** 2) / (2 * greatest(std, 1e-6) ** 2)) AS pdf FROM tsc JOIN nb USING (feature)) q GROUP BY 1, 2)""",
    """judged AS (SELECT probe, 1 / sum(exp(l - a)) AS score FROM (SELECT *, max(CASE WHEN class = 'anomaly' THEN l END)
      OVER (PARTITION BY probe) AS a, max(l) OVER (PARTITION BY probe) AS m FROM ll) q WHERE a = m GROUP BY 1)""",
]


def _ml_sql(name: str) -> str:
    return f"""SELECT p.id AS packet_id, p.timestamp, related[1] AS src_ip, related[2] AS dst_ip, 'ml:{name}' AS detection_method,
    CAST(7 AS INT) AS rule_order, round(score, 6) AS score, array_to_string(related, ',') AS related_ips,
    'model_type={name}, prediction_score=' || printf('%.4f', score) AS description
    FROM judged JOIN ix p ON p.i = probe JOIN rel ON rel.probe = judged.probe"""


def _judged(spark, sf, make):
    """Trailing 30 s judged by a model of the scaled training windows."""
    with scratch_tables(spark) as store:
        idx = features.index_packets(load_packets(spark, sf), store=store)
        rows = cut(training.labelled(features.features_windowed(idx, SECONDS)))
        scaler = scaling.Scaler(scaling.fit(rows, FEATURES))
        found = cut(ml_detect.ml(idx, make(cut(scaling.minmax(rows, scaler, FEATURES))), scaler))
    return found.select(
        "packet_id", "timestamp", "src_ip", "dst_ip", "detection_method", "rule_order",
        F.round("score", 6).alias("score"), F.array_join("related_ips", ",").alias("related_ips"),
        alerts.describe(F.col("details")).alias("description"),
    )


@query("detect_ml", _ml_sql("kmeans"), [*TRAILING_SQL[:2], *PROBES_SQL, RELATED_SQL, CLASS_MEANS_SQL])
def detect_ml(spark, sf):
    """By distance to the class means."""
    return _judged(spark, sf, _class_means)


@query("detect_ml_kmeans", _ml_sql("kmeans"), [*TRAILING_SQL[:2], *PROBES_SQL, RELATED_SQL, *FITTED_MEANS_SQL])
def detect_ml_kmeans(spark, sf):
    """By distance to fitted centroids."""

    def fitted(rows):
        idx = ordering.with_global_index(rows, order=("window_start",))
        return kmeans.fit(idx.df, FEATURES, kmeans.parallel_seeds(idx, FEATURES, 2))

    return _judged(spark, sf, fitted)


@query("detect_ml_tree", _ml_sql("decision_tree"), [*TRAILING_SQL[:2], *PROBES_SQL, RELATED_SQL, *TREE_SQL])
def detect_ml_tree(spark, sf):
    return _judged(spark, sf, lambda rows: tree.DecisionTree.fit(rows, FEATURES))


@query("detect_ml_bayes", _ml_sql("naive_bayes"), [*TRAILING_SQL[:2], *PROBES_SQL, RELATED_SQL, *BAYES_SQL])
def detect_ml_bayes(spark, sf):
    return _judged(spark, sf, lambda rows: bayes.NaiveBayes(cut(bayes.fit(rows, FEATURES))))


@query(
    "detect_ensemble",
    """SELECT detection_method, count(*) AS detections FROM (SELECT detection_method FROM det
    UNION ALL SELECT 'ml:decision_tree' FROM judged) u GROUP BY 1""",
    [*DETECTIONS, TRAILING_SQL[1], *PROBES_SQL, *TREE_SQL],
)
def detect_ensemble(spark, sf):
    """Statistical, rule and tree-model detections together, on one index."""
    packets = load_packets(spark, sf)
    with scratch_tables(spark) as store:
        idx = features.index_packets(packets, store=store)
        rows = cut(training.labelled(features.features_windowed(idx, SECONDS)))
        scaler = scaling.Scaler(scaling.fit(rows, FEATURES))
        model = tree.DecisionTree.fit(scaling.minmax(rows, scaler, FEATURES), FEATURES)
        found = detect.detect_all(
            packets, ("statistical", "rule", "ml"), idx=idx, ml=ml_detect.ml(idx, model, scaler)
        )
        return cut(found.groupBy("detection_method").agg(F.count("*").alias("detections")))
