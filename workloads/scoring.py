"""Scoring tables and streams, cross-validation, search, and the end-to-end jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sparkfold.operators.fit import fit
from sparkfold.operators.models import Model
from sparkfold.operators.score import (
    predict,
    predict_proba,
    score,
    score_batch,
    score_monitor,
    write_scored,
)
from sparkfold.operators.specs import (
    LinearRegression,
    LogisticRegression,
    MajorityClass,
    MeanTarget,
    MLPClassifier,
)
from sparkfold.plans.jobs import evaluate_job, train_job
from sparkfold.plans.search import cross_val_score, grid_search, randomized_search
from sparkfold.runtime import scratch_path
from sparkfold.sources.models import save_model
from sparkfold.streaming.scoring import (
    append_monitor,
    monitor_stream,
    read_monitor,
    score_stream,
    utc_instant,
    write_monitor,
    write_scores,
)
from workloads.base import (
    EV,
    OD,
    embeddings,
    events,
    orders,
    query,
    round_columns,
    rounded,
    table,
)
from workloads.splits import CLASS_FOLD, FOLD, shuffled, stratified_sql


def binary_model(threshold: float = 0.5) -> Model:
    """Fixed weights, so that scoring can be compared exactly."""
    params = {"weights": np.array([0.9, -0.6]), "bias": np.array([-0.2])}
    return Model("logistic", ["x1", "x2"], 2, params, [0, 1], {"threshold": threshold})


P = "1 / (1 + exp(-(0.9 * x1 - 0.6 * x2 - 0.2)))"

# --- batch scoring -----------------------------------------------------------------------------


@query(
    "r01_regression_predict",
    f"""WITH {OD}, m AS (SELECT regr_slope(t, x2) AS w, regr_intercept(t, x2) AS b,
          avg(t) AS mean FROM od)
        SELECT id, round(w * x2 + b, 6) AS prediction, round(mean, 6) AS baseline FROM od, m""",
)
def r01(spark, d):
    rows = orders(spark, d)
    line = fit(LinearRegression(), rows, ["x2"], "t")
    mean = fit(MeanTarget(), rows, ["x2"], "t")
    scored = predict(predict(rows, line), mean, "baseline")
    return scored.select(
        "id", rounded("prediction").alias("prediction"), rounded("baseline").alias("baseline")
    )


@query(
    "r02_predict_proba_binary",
    f"WITH {OD} SELECT id, round(1 - {P}, 9) AS p0, round({P}, 9) AS p1 FROM od",
)
def r02(spark, d):
    scored = predict_proba(orders(spark, d).select("id", "x1", "x2"), binary_model())
    return scored.select(
        "id", *[rounded(F.get("probability", F.lit(i)), 9).alias(f"p{i}") for i in range(2)]
    )


SOFT_W = [[0.5, -0.4, 0.1], [0.2, 0.3, -0.6]]
SOFT_B = [0.1, 0.0, -0.1]
LOGIT = "({w0} * x1 + {w1} * x2 + {b})"
LOGITS = [
    LOGIT.format(w0=SOFT_W[0][k], w1=SOFT_W[1][k], b=SOFT_B[k]) for k in range(3)
]


@query(
    "r03_predict_proba_softmax",
    f"""WITH {OD}, e AS (SELECT id, exp({LOGITS[0]}) AS e0, exp({LOGITS[1]}) AS e1,
          exp({LOGITS[2]}) AS e2 FROM od)
        SELECT id, round(e0 / (e0 + e1 + e2), 9) AS p0, round(e1 / (e0 + e1 + e2), 9) AS p1,
               round(e2 / (e0 + e1 + e2), 9) AS p2,
               CAST(CASE WHEN e0 >= e1 AND e0 >= e2 THEN 10 WHEN e1 >= e2 THEN 20 ELSE 30 END
               AS BIGINT) AS prediction FROM e""",
)
def r03(spark, d):
    model = Model(
        "softmax", ["x1", "x2"], 2, {"weights": np.array(SOFT_W), "bias": np.array(SOFT_B)},
        [10, 20, 30],
    )
    scored = predict(orders(spark, d).select("id", "x1", "x2"), model, proba="proba")
    return scored.select(
        "id", "prediction",
        *[rounded(F.get("proba", F.lit(i)), 9).alias(f"p{i}") for i in range(3)],
    )


@query(
    "r04_class_decision",
    f"""WITH {OD} SELECT id, CAST(CASE WHEN {P} >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS even_cut,
        CAST(CASE WHEN {P} >= 0.35 THEN 1 ELSE 0 END AS BIGINT) AS low_cut FROM od""",
)
def r04(spark, d):
    rows = orders(spark, d).select("id", "x1", "x2")
    scored = predict(predict(rows, binary_model(), "even_cut"), binary_model(0.35), "low_cut")
    return scored.select("id", "even_cut", "low_cut")


NET_W0 = [[0.8, -0.5, 0.3], [-0.2, 0.9, 0.4]]
NET_B0 = [0.1, -0.1, 0.05]
NET_W1 = [[0.7, -0.3], [0.2, 0.6], [-0.5, 0.4]]
NET_B1 = [0.0, 0.1]
HIDDEN = ", ".join(
    f"greatest({NET_W0[0][k]} * x1 + {NET_W0[1][k]} * x2 + {NET_B0[k]}, 0) AS h{k}"
    for k in range(3)
)
OUTS = [
    " + ".join(f"{NET_W1[k][j]} * h{k}" for k in range(3)) + f" + {NET_B1[j]}" for j in range(2)
]


@query(
    "r05_mlp_predict",
    f"""WITH {OD}, h AS (SELECT id, {HIDDEN} FROM od),
        z AS (SELECT id, {OUTS[0]} AS z0, {OUTS[1]} AS z1 FROM h)
        SELECT id, round(exp(z1) / (exp(z0) + exp(z1)), 9) AS p1,
               CAST(CASE WHEN z0 >= z1 THEN 0 ELSE 1 END AS BIGINT) AS prediction FROM z""",
)
def r05(spark, d):
    params = {
        "0.weights": np.array(NET_W0), "0.bias": np.array(NET_B0),
        "1.weights": np.array(NET_W1), "1.bias": np.array(NET_B1),
    }
    model = Model("mlp_classifier", ["x1", "x2"], 2, params, [0, 1], {"activation": "relu"})
    scored = predict(orders(spark, d).select("id", "x1", "x2"), model, proba="proba")
    return scored.select(
        "id", "prediction", rounded(F.get("proba", F.lit(1)), 9).alias("p1")
    )


def _rule(i, k, a, b):
    """Weights from a rule, so that SQL can state the same network."""
    return ((i * a + k * b) % 11 - 5) / 20.0


@query(
    "r05_mlp_predict_matrix",
    """WITH x AS (SELECT vec_id AS id, unnest(range(len(embedding))) AS j,
         unnest(embedding)::DOUBLE AS v FROM embeddings),
    h AS (SELECT id, k, greatest(sum(v * ((j * 7 + k * 3) % 11 - 5) / 20.0) + 0.1, 0) AS h
          FROM x, (SELECT unnest(range(24)) AS k) GROUP BY id, k),
    z AS (SELECT id, c, sum(h * ((k * 5 + c * 2) % 11 - 5) / 20.0) - 0.05 * c AS z
          FROM h, (SELECT unnest(range(10)) AS c) GROUP BY id, c),
    p AS (SELECT id, c, exp(z) / sum(exp(z)) OVER (PARTITION BY id) AS p FROM z)
    SELECT id, CAST(arg_max(c, p) AS BIGINT) AS prediction, round(max(p), 8) AS p FROM p
    GROUP BY id""",
)
def r05_matrix(spark, d):
    params = {
        "0.weights": np.array([[_rule(j, k, 7, 3) for k in range(24)] for j in range(64)]),
        "0.bias": np.full(24, 0.1),
        "1.weights": np.array([[_rule(k, c, 5, 2) for c in range(10)] for k in range(24)]),
        "1.bias": np.array([-0.05 * c for c in range(10)]),
    }
    model = Model(
        "mlp_classifier", "embedding", 64, params, list(range(10)), {"activation": "relu"}
    )
    scored = predict(embeddings(spark, d), model, proba="proba")
    return scored.select("id", "prediction", rounded(F.array_max("proba"), 8).alias("p"))


@query("r05_mlp_predict_wide")
def r05_wide(spark, d):
    rows = embeddings(spark, d)
    spec = MLPClassifier(hidden_layer_sizes=(24,), learning_rate=0.02, max_iter=6, seed=1)
    model = fit(spec, rows, "embedding", "label", id_col="id")
    scored = predict(rows, model, proba="proba")
    return scored.select("id", "label", "prediction", rounded(F.array_max("proba"), 6).alias("p"))


@query(
    "r06_score_batch",
    f"""WITH {OD} SELECT id, CAST(CASE WHEN {P} >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction,
        round({P}, 9) AS probability, 'v1' AS model_version FROM od""",
)
def r06(spark, d):
    scored = score_batch(orders(spark, d).select("id", "x1", "x2"), binary_model(), "v1")
    return round_columns(scored.drop("x1", "x2"), ["probability"], 9)


@query(
    "r06_score_monitor",
    f"""WITH {OD}, p AS (SELECT {P} AS p FROM od)
        SELECT count(*) AS n_predictions, 2 AS n_features, round(min(p), 9) AS probability_min,
               round(avg(p), 9) AS probability_mean, round(max(p), 9) AS probability_max FROM p""",
)
def r06_monitor(spark, d):
    scored = score_batch(orders(spark, d), binary_model(), "v1")
    names = ["probability_min", "probability_mean", "probability_max"]
    return round_columns(score_monitor(scored, 2), names, 9)


@query(
    "r06_score_job",
    f"""WITH {OD}, p AS (SELECT {P} AS p FROM od)
        SELECT count(*) AS n_predictions, 2 AS n_features, round(min(p), 9) AS probability_min,
               round(avg(p), 9) AS probability_mean, round(max(p), 9) AS probability_max,
               count(*) AS n_stored FROM p""",
)
def r06_job(spark, d):
    path = scratch_path(spark, "scored")
    seen = write_scored(orders(spark, d), binary_model(), "v1", path)
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_stored"))
    row = stored.select("*", *[F.lit(value).alias(name) for name, value in seen.items()])
    names = ["probability_min", "probability_mean", "probability_max"]
    row = row.withColumn("n_predictions", F.col("n_predictions").cast("long"))
    return round_columns(row, names, 9)


def event_model() -> Model:
    params = {"weights": np.array([0.02, -0.001]), "bias": np.array([-1.0])}
    return Model("logistic", ["value", "user_id"], 2, params, [0, 1], {"threshold": 0.5})


EP = "1 / (1 + exp(-(0.02 * value - 0.001 * user_id - 1.0)))"


def event_stream(spark, d):
    """The events table as an unbounded input."""
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


@query(
    "r07_score_stream",
    f"""WITH {EV} SELECT id, CAST(CASE WHEN {EP} >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction,
        round({EP}, 9) AS probability, 'live' AS model_version FROM ev""",
)
def r07(spark, d):
    stream = event_stream(spark, d).select(F.col("event_id").alias("id"), "value", "user_id")
    scored = score_stream(stream, event_model(), "live").drop("value", "user_id")
    path = scratch_path(spark, "scored")
    write_scores(scored, path, scratch_path(spark, "scored-checkpoint")).awaitTermination()
    return round_columns(spark.read.parquet(path), ["probability"], 9)


@query(
    "r07_score_stream_invalid_rows",
    f"""WITH {EV}, p AS (SELECT id, CASE WHEN id % 5 < 3 THEN NULL ELSE {EP} END AS p FROM ev)
        SELECT id, CAST(CASE WHEN p IS NULL THEN NULL WHEN p >= 0.5 THEN 1 ELSE 0 END AS BIGINT)
          AS prediction, round(p, 9) AS probability, 'live' AS model_version FROM p""",
)
def r07_invalid(spark, d):
    # NULL, NaN and infinite features do not stop the stream
    dirty = (
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("double"))
        .when(F.col("event_id") % 5 == 1, F.lit(float("nan")))
        .when(F.col("event_id") % 5 == 2, F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    stream = event_stream(spark, d).select(F.col("event_id").alias("id"), dirty.alias("value"), "user_id")
    scored = score_stream(stream, event_model(), "live", invalid="null").drop("value", "user_id")
    path = scratch_path(spark, "scored")
    write_scores(scored, path, scratch_path(spark, "scored-checkpoint")).awaitTermination()
    return round_columns(spark.read.parquet(path), ["probability"], 9)


WINDOWED = f"""WITH {EV}, p AS (SELECT date_trunc('day', ts) AS day, {EP} AS p FROM ev)
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n_predictions, 2 AS n_features,
       round(min(p), 9) AS probability_min, round(avg(p), 9) AS probability_mean,
       round(max(p), 9) AS probability_max FROM p GROUP BY day"""


def _monitored(spark, d):
    stream = event_stream(spark, d).select(
        utc_instant(F.col("ts")).alias("at"), "value", "user_id"
    )
    scored = score_stream(stream, event_model(), "live")
    return monitor_stream(scored, "at", 2, window="1 day", delay="1 hour")


def _monitor_rows(df):
    day = F.date_format(
        F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.col("window.start").cast("timestamp_ntz")
        ),
        "yyyy-MM-dd",
    )
    names = ["probability_min", "probability_mean", "probability_max"]
    return round_columns(df.withColumn("day", day).drop("window"), names, 9)


@query("r08_stream_monitor", WINDOWED)
def r08(spark, d):
    path = scratch_path(spark, "monitor")
    write_monitor(
        _monitored(spark, d), path, scratch_path(spark, "monitor-checkpoint")
    ).awaitTermination()
    return _monitor_rows(read_monitor(spark, path))


@query(
    "r08_stream_monitor_closed_windows",
    WINDOWED + """ HAVING day + INTERVAL 1 DAY <= (SELECT max(ts) FROM ev) - INTERVAL 1 HOUR""",
)
def r08_append(spark, d):
    path = scratch_path(spark, "monitor")
    append_monitor(
        _monitored(spark, d), path, scratch_path(spark, "monitor-checkpoint")
    ).awaitTermination()
    return _monitor_rows(spark.read.parquet(path))


@query(
    "r09_default_score_classifier",
    f"""WITH {OD} SELECT round(avg(CAST(y = CAST({P} >= 0.4 AS INTEGER) AS DOUBLE)), 9) AS score
        FROM od""",
)
def r09(spark, d):
    scored = score(orders(spark, d), binary_model(0.4), "y")
    return round_columns(scored, ["score"], 9)


# --- cross-validation and search ---------------------------------------------------------------

FOLDED = FOLD.format(OD, shuffled(3), "od", 5)
CV_LINE = f"""WITH folds AS ({FOLDED}), {OD}, rows_ AS (SELECT * FROM od JOIN folds USING (id)),
k AS (SELECT unnest(range(5)) AS fold),
m AS (SELECT k.fold, regr_slope(t, x2) AS w, regr_intercept(t, x2) AS b
      FROM k JOIN rows_ r ON r.fold <> k.fold GROUP BY k.fold),
e AS (SELECT r.fold, t, t - (w * x2 + b) AS e FROM rows_ r JOIN m ON m.fold = r.fold) """


@query(
    "x01_cross_val_score_linear",
    CV_LINE + """SELECT CAST(fold AS INTEGER) AS fold,
    round(1 - sum(e * e) / (var_pop(t) * count(*)), 8) AS score FROM e GROUP BY fold""",
)
def x01(spark, d):
    scores = cross_val_score(
        LinearRegression(), orders(spark, d), ["x2"], "t", "id", cv=5, seed=3
    )
    return round_columns(scores, ["score"], 8)


CV_LOGISTIC = f"""WITH RECURSIVE {OD}, base AS (SELECT id, y AS label, x1, x2 FROM od),
{CLASS_FOLD.format(shuffled(5), 4)},
gd(k, e, w1, w2, b) AS (
  SELECT unnest(range(4)), 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT k, e + 1, w1 - 0.7 * avg((p - label) * x1), w2 - 0.7 * avg((p - label) * x2),
         b - 0.7 * avg(p - label)
  FROM (SELECT k, e, w1, w2, b, label, x1, x2, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p
        FROM gd JOIN folded ON folded.fold <> gd.k WHERE e < 4) GROUP BY k, e, w1, w2, b),
scored AS (SELECT fold, label, CAST(1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) >= 0.37 AS INTEGER)
           AS guess FROM folded JOIN gd ON gd.k = folded.fold AND gd.e = 4) """


def cv_logistic_spec(**changes):
    settings = {
        "learning_rate": 0.7, "max_iter": 4, "tol": 0.0, "start": "zeros", "threshold": 0.37
    }
    return LogisticRegression(**{**settings, **changes})


@query(
    "x01_cross_val_score_logistic_stratified",
    CV_LOGISTIC + """SELECT CAST(fold AS INTEGER) AS fold,
    round(avg(CAST(label = guess AS DOUBLE)), 8) AS score FROM scored GROUP BY fold""",
)
def x01_logistic(spark, d):
    scores = cross_val_score(
        cv_logistic_spec(), orders(spark, d), ["x1", "x2"], "y", "id",
        cv=4, stratified=True, seed=5,
    )
    return round_columns(scores, ["score"], 8)


@query(
    "x01_cross_val_score_majority",
    f"""WITH folds AS ({FOLDED}), {OD}, rows_ AS (SELECT y3, fold FROM od JOIN folds USING (id)),
    c AS (SELECT k.fold, y3, count(*) AS n FROM (SELECT unnest(range(5)) AS fold) k
          JOIN rows_ r ON r.fold <> k.fold GROUP BY k.fold, y3),
    top AS (SELECT fold, y3 FROM c QUALIFY row_number() OVER
            (PARTITION BY fold ORDER BY n DESC, y3) = 1)
    SELECT CAST(r.fold AS INTEGER) AS fold, round(avg(CAST(r.y3 = top.y3 AS DOUBLE)), 8) AS score
    FROM rows_ r JOIN top ON top.fold = r.fold GROUP BY r.fold""",
)
def x01_majority(spark, d):
    scores = cross_val_score(MajorityClass(), orders(spark, d), ["x1"], "y3", "id", seed=3)
    return round_columns(scores, ["score"], 8)


SCORERS = {
    "r2": "1 - sum(e * e) / (var_pop(t) * count(*))",
    "neg_mean_squared_error": "-avg(e * e)",
    "neg_root_mean_squared_error": "-sqrt(avg(e * e))",
    "neg_mean_absolute_error": "-avg(abs(e))",
    "callable": "-max(abs(e))",
}


def _largest_gap(y_true, y_pred):
    return -F.max(F.abs(y_true - y_pred))


def _register_scorers():
    for name, sql in SCORERS.items():

        def compute(spark, d, name=name):
            scoring = _largest_gap if name == "callable" else name
            scores = cross_val_score(
                LinearRegression(), orders(spark, d), ["x2"], "t", "id",
                cv=5, seed=3, scoring=scoring,
            )
            return round_columns(scores, ["score"], 5)

        query(
            f"x02_scorer_{name}",
            CV_LINE + f"SELECT CAST(fold AS INTEGER) AS fold, round({sql}, 5) AS score "
            "FROM e GROUP BY fold",
        )(compute)


_register_scorers()


@query(
    "x02_scorer_f1",
    CV_LOGISTIC + """SELECT CAST(fold AS INTEGER) AS fold, round(2.0 * sum(label * guess)
    / (2 * sum(label * guess) + sum((1 - label) * guess) + sum(label * (1 - guess))), 8) AS score
    FROM scored GROUP BY fold""",
)
def x02_f1(spark, d):
    scores = cross_val_score(
        cv_logistic_spec(), orders(spark, d), ["x1", "x2"], "y", "id",
        cv=4, stratified=True, seed=5, scoring="f1",
    )
    return round_columns(scores, ["score"], 8)


RIDGE = f"""WITH folds AS ({FOLDED}), {OD}, rows_ AS (SELECT * FROM od JOIN folds USING (id)),
k AS (SELECT unnest(range(5)) AS fold),
g AS (SELECT k.fold, avg(x2) AS mx, avg(t) AS mt, covar_pop(x2, t) * count(*) AS xt,
             var_pop(x2) * count(*) AS xx
      FROM k JOIN rows_ r ON r.fold <> k.fold GROUP BY k.fold),
cand AS ({{candidates}}),
m AS (SELECT candidate, l2, fold, xt / (xx + l2) AS w, mt - mx * xt / (xx + l2) AS b FROM g, cand),
s AS (SELECT candidate, l2, r.fold, 1 - sum((t - w * x2 - b) ^ 2) / (var_pop(t) * count(*)) AS score
      FROM rows_ r JOIN m ON m.fold = r.fold GROUP BY candidate, l2, r.fold),
means AS (SELECT candidate, l2, avg(score) AS mean FROM s GROUP BY candidate, l2) """
STRENGTHS = [0.0, 500.0, 20000.0, 1000000.0]
CANDIDATES = " UNION ALL ".join(
    f"SELECT {i} AS candidate, {s}::DOUBLE AS l2" for i, s in enumerate(STRENGTHS)
)


def ridge_spec():
    return LinearRegression(penalty="l2")


@query(
    "x03_grid_search_ridge",
    RIDGE.format(candidates=CANDIDATES)
    + """SELECT candidate, l2::VARCHAR AS strength, round(mean, 8) AS mean_score,
    candidate = (SELECT candidate FROM means ORDER BY mean DESC, candidate LIMIT 1) AS is_best
    FROM means""",
)
def x03(spark, d):
    result = grid_search(
        ridge_spec(), {"regularization_strength": STRENGTHS}, orders(spark, d), ["x2"], "t",
        "id", cv=5, seed=3,
    )
    strength = F.element_at("params", F.lit("regularization_strength"))
    return result.summary.select(
        "candidate", strength.alias("strength"), rounded("mean_score", 8).alias("mean_score"),
        "is_best",
    )


@query(
    "x03_grid_search_fold_scores",
    RIDGE.format(candidates=CANDIDATES)
    + "SELECT candidate, CAST(fold AS INTEGER) AS fold, round(score, 8) AS score FROM s",
)
def x03_folds(spark, d):
    result = grid_search(
        ridge_spec(), {"regularization_strength": STRENGTHS}, orders(spark, d), ["x2"], "t",
        "id", cv=5, seed=3,
    )
    return round_columns(result.scores.drop("params"), ["score"], 8)


@query(
    "x03_grid_search_ties",
    f"""WITH folds AS ({FOLD.format(OD, shuffled(0), 'od', 3)}), {OD},
    rows_ AS (SELECT * FROM od JOIN folds USING (id)),
    m AS (SELECT k.fold, regr_slope(t, x2) AS w, regr_intercept(t, x2) AS b
          FROM (SELECT unnest(range(3)) AS fold) k JOIN rows_ r ON r.fold <> k.fold GROUP BY k.fold),
    s AS (SELECT r.fold, 1 - sum((t - w * x2 - b) ^ 2) / (var_pop(t) * count(*)) AS score
          FROM rows_ r JOIN m ON m.fold = r.fold GROUP BY r.fold)
    SELECT CAST(c.c AS INTEGER) AS candidate, (c.c + 1)::VARCHAR AS seed,
           round((SELECT avg(score) FROM s), 8) AS mean_score, c.c = 0 AS is_best
    FROM (SELECT unnest(range(3)) AS c) c""",
)
def x03_ties(spark, d):
    # the seed does not matter to a closed form, so all candidates tie and the first one wins
    result = grid_search(
        LinearRegression(), {"seed": [1, 2, 3]}, orders(spark, d), ["x2"], "t", "id", cv=3
    )
    return result.summary.select(
        "candidate", F.element_at("params", F.lit("seed")).alias("seed"),
        rounded("mean_score", 8).alias("mean_score"), "is_best",
    )


@query(
    "x03_grid_search_logistic_zero_start",
    f"""WITH RECURSIVE {OD}, base AS (SELECT id, y AS label, x1, x2 FROM od),
    {CLASS_FOLD.format(shuffled(5), 4)},
    cand AS (SELECT * FROM (VALUES (0, 0.2, 0.0), (1, 0.2, 900.0), (2, 1.2, 0.0), (3, 1.2, 900.0))
             AS c(c, lr, l2)),
    gd(c, lr, l2, k, e, w1, w2, b) AS (
      SELECT c, lr::DOUBLE, l2::DOUBLE, unnest(range(4)), 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
      FROM cand
      UNION ALL
      SELECT c, lr, l2, k, e + 1, w1 - lr * (avg((p - label) * x1) + l2 * w1 / count(*)),
             w2 - lr * (avg((p - label) * x2) + l2 * w2 / count(*)), b - lr * avg(p - label)
      FROM (SELECT gd.*, label, x1, x2, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p
            FROM gd JOIN folded ON folded.fold <> gd.k WHERE e < 4)
      GROUP BY c, lr, l2, k, e, w1, w2, b),
    s AS (SELECT c, k, avg(CAST(label = CAST(1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) >= 0.37
            AS INTEGER) AS DOUBLE)) AS score
          FROM folded JOIN gd ON gd.k = folded.fold AND gd.e = 4 GROUP BY c, k),
    means AS (SELECT c, avg(score) AS mean FROM s GROUP BY c)
    SELECT c AS candidate, round(mean, 8) AS mean_score,
           c = (SELECT c FROM means ORDER BY mean DESC, c LIMIT 1) AS is_best FROM means""",
)
def x03_logistic_zero(spark, d):
    grid = {"learning_rate": [0.2, 1.2], "regularization_strength": [0.0, 900.0]}
    result = grid_search(
        cv_logistic_spec(), grid, orders(spark, d), ["x1", "x2"], "y", "id",
        cv=4, stratified=True, seed=5,
    )
    return round_columns(result.summary.drop("params"), ["mean_score"], 8)


SOFT_NAMES = [f"w{i}{k}" for i in range(2) for k in range(3)] + [f"b{k}" for k in range(3)]
SOFT_START = [*np.random.default_rng(0).normal(0.0, 0.01, (2, 3)).ravel().tolist(), 0.0, 0.0, 0.0]
SOFT_EXPS = ", ".join(f"exp(w0{k} * x1 + w1{k} * x2 + b{k}) AS e{k}" for k in range(3))
SOFT_ERRORS = ", ".join(
    f"e{k} / (e0 + e1 + e2) - CAST(label = {k} AS INTEGER) AS r{k}" for k in range(3)
)
SOFT_MOVE = ", ".join(
    [f"w{i}{k} - lr * (avg(r{k} * x{i + 1}) + l2 * w{i}{k} / count(*))"
     for i in range(2) for k in range(3)]
    + [f"b{k} - lr * avg(r{k})" for k in range(3)]
)


@query(
    "x03_grid_search_logistic",
    f"""WITH RECURSIVE {OD}, base AS (SELECT id, y3 AS label, x1, x2 FROM od),
    {CLASS_FOLD.format(shuffled(2), 3)},
    cand AS (SELECT * FROM (VALUES (0, 0.05, 0.0), (1, 0.05, 50.0), (2, 0.5, 0.0), (3, 0.5, 50.0))
             AS c(c, lr, l2)),
    gd(c, lr, l2, k, e, {', '.join(SOFT_NAMES)}) AS (
      SELECT c, lr::DOUBLE, l2::DOUBLE, unnest(range(3)), 0,
             {', '.join(f'{v!r}::DOUBLE' for v in SOFT_START)} FROM cand
      UNION ALL
      SELECT c, lr, l2, k, e + 1, {SOFT_MOVE} FROM (SELECT *, {SOFT_ERRORS} FROM (
        SELECT gd.*, label, x1, x2, {SOFT_EXPS} FROM gd JOIN folded ON folded.fold <> gd.k
        WHERE e < 8)) GROUP BY c, lr, l2, k, e, {', '.join(SOFT_NAMES)})
    SELECT c AS candidate, CAST(fold AS INTEGER) AS fold,
           lr::VARCHAR AS learning_rate, l2::VARCHAR AS strength,
           round(avg(CAST(label = CASE WHEN e0 >= e1 AND e0 >= e2 THEN 0 WHEN e1 >= e2 THEN 1
                 ELSE 2 END AS DOUBLE)), 6) AS score
    FROM (SELECT c, lr, l2, fold, label, {SOFT_EXPS} FROM folded JOIN gd
          ON gd.k = folded.fold AND gd.e = 8) GROUP BY c, lr, l2, fold""",
)
def x03_logistic(spark, d):
    grid = {"learning_rate": [0.05, 0.5], "regularization_strength": [0.0, 50.0]}
    result = grid_search(
        LogisticRegression(max_iter=8), grid, orders(spark, d), ["x1", "x2"], "y3", "id",
        cv=3, stratified=True, seed=2,
    )
    return result.scores.select(
        "candidate", "fold", F.element_at("params", F.lit("learning_rate")).alias("learning_rate"),
        F.element_at("params", F.lit("regularization_strength")).alias("strength"),
        rounded("score").alias("score"),
    )


DRAWN = " UNION ALL ".join(
    f"SELECT {i} AS position, {s}::DOUBLE AS l2"
    for i, s in enumerate([0.0, 10.0, 500.0, 3000.0, 20000.0, 1000000.0])
)


@query(
    "x04_randomized_search",
    RIDGE.format(
        candidates=f"""SELECT CAST(row_number() OVER (ORDER BY md5(concat('5:', position)),
          position) - 1 AS INTEGER) AS candidate, l2 FROM ({DRAWN}) QUALIFY candidate < 3"""
    ).replace(shuffled(3), shuffled(5))
    + """SELECT candidate, l2::VARCHAR AS strength, round(mean, 8) AS mean_score,
    candidate = (SELECT candidate FROM means ORDER BY mean DESC, candidate LIMIT 1) AS is_best
    FROM means""",
)
def x04(spark, d):
    strengths = [0.0, 10.0, 500.0, 3000.0, 20000.0, 1000000.0]
    result = randomized_search(
        ridge_spec(), {"regularization_strength": strengths}, orders(spark, d), ["x2"], "t",
        "id", n_iter=3, seed=5, cv=5,
    )
    strength = F.element_at("params", F.lit("regularization_strength"))
    return result.summary.select(
        "candidate", strength.alias("strength"), rounded("mean_score", 8).alias("mean_score"),
        "is_best",
    )


# --- jobs --------------------------------------------------------------------------------------

SPLIT_SQL = stratified_sql(f"WITH {OD} SELECT id, y AS label FROM od", "ceil(count(*) * 0.25)", 42)
REPORT = """scored AS (SELECT id, label AS y, {p} AS p, CAST({p} >= {cut} AS INTEGER) AS yhat
  FROM test),
ranked AS (SELECT y, sum(y) OVER w AS tp, row_number() OVER w AS k FROM scored
  WINDOW w AS (ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING)),
t AS (SELECT sum(y) AS pos, count(*) - sum(y) AS neg FROM scored),
c AS (SELECT count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y = 0 AND yhat = 1) AS fp,
  count(*) FILTER (y = 1 AND yhat = 0) AS fn, count(*) FILTER (y = 0 AND yhat = 0) AS tn,
  avg(-ln(CASE y WHEN 1 THEN p ELSE 1 - p END)) AS log_loss, count(*) AS n FROM scored)
SELECT round((tp + tn) / n, 9) AS accuracy,
  round((CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END
    + CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END) / 2, 9) AS precision_macro,
  round((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) AS recall_macro,
  round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fn + fp)) / 2, 9) AS f1_macro,
  round((SELECT sum((1 - y) * tp) / (max(pos) * max(neg)) FROM ranked, t), 9) AS roc_auc,
  round((SELECT sum(y * (CASE WHEN k = 1 THEN 1.0 ELSE (tp - 1) / (k - 1) END + tp / k) / 2)
         / max(pos) FROM ranked, t), 9) AS pr_auc,
  round(log_loss, 9) AS log_loss, n AS n_test_samples"""
REPORT_COLUMNS = [
    "accuracy", "precision_macro", "recall_macro", "f1_macro", "roc_auc", "pr_auc", "log_loss"
]


def report_rows(report):
    return round_columns(report.drop("confusion_matrix", "labels"), REPORT_COLUMNS, 9)


# Split, descent on the training rows that are not held out, and the report on the test rows.
JOB = f"""WITH RECURSIVE {OD}, split AS ({SPLIT_SQL}),
ranked_parts AS (SELECT split.*, x1, x2, row_number() OVER (PARTITION BY is_test
    ORDER BY {shuffled('{seed}:holdout')}) AS place, count(*) OVER (PARTITION BY is_test) AS size
  FROM split JOIN od USING (id)),
parts AS (SELECT *, place <= least(greatest(1, ceil(size * {{held}})), size - 1)
  AND {{held}} > 0 AS held FROM ranked_parts),
gd(e, w1, w2, b) AS (
  SELECT 0, {{w1}}::DOUBLE, {{w2}}::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT e + 1, w1 - 0.5 * (avg((p - label) * x1) + {{l2}} * w1 / count(*)),
         w2 - 0.5 * (avg((p - label) * x2) + {{l2}} * w2 / count(*)), b - 0.5 * avg(p - label)
  FROM (SELECT e, w1, w2, b, label, x1, x2, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p
        FROM gd, parts WHERE NOT is_test AND NOT held AND e < {{epochs}})
  GROUP BY e, w1, w2, b),
final AS (SELECT w1, w2, b FROM gd WHERE e = {{epochs}}),
test AS (SELECT id, label, w1 * x1 + w2 * x2 + b AS z FROM parts, final WHERE is_test),
train AS (SELECT count(*) AS n_train, avg(CAST(label = CAST(1 / (1 + exp(-(w1 * x1 + w2 * x2
  + b))) >= {{cut}} AS INTEGER) AS DOUBLE)) AS acc FROM parts, final WHERE NOT is_test),
{REPORT.format(p='(1 / (1 + exp(-z)))', cut='{cut}')}"""
TRAINED = """, round((tp + tn) / n, 9) AS test_accuracy, round(acc, 9) AS train_accuracy,
n_train AS n_train_samples FROM c, train"""


def job_sql(tail: str, *, epochs: int, cut: float, seed: int | None, held=0.0, l2=0.0) -> str:
    """``seed`` draws the starting weights; without one they are zero."""
    start = np.zeros(2) if seed is None else np.random.default_rng(seed).normal(0.0, 0.01, 2)
    return JOB.format(
        epochs=epochs, cut=cut, held=held, l2=l2, seed=seed or 0, w1=float(start[0]),
        w2=float(start[1]),
    ) + tail


@query("j01_train_job", job_sql(TRAINED, epochs=12, cut=0.4, seed=42, held=0.2, l2=0.01))
def j01(spark, d):
    spec = LogisticRegression(
        learning_rate=0.5, max_iter=12, regularization_strength=0.01, early_stopping=True,
        validation_fraction=0.2, n_iter_no_change=20, threshold=0.4, seed=42,
    )
    outcome = train_job(
        orders(spark, d), ["x1", "x2"], "y", "id", scratch_path(spark, "registry"), spec=spec,
        meta={"model_name": "orders-status", "version": "1"},
    )
    report = report_rows(outcome.report)
    return round_columns(report, ["train_accuracy", "test_accuracy"], 9)


def flagship(spark, d):
    """Orders: check, stratified split, logistic descent from zero, report on the test part."""
    rows = orders(spark, d)
    spec = LogisticRegression(
        learning_rate=0.5, max_iter=20, tol=0.0, start="zeros", threshold=0.33
    )
    outcome = train_job(
        rows, ["x1", "x2"], "y", "id", scratch_path(spark, "registry"), spec=spec,
        meta={"model_name": "orders-status", "version": "flagship"},
    )
    return round_columns(
        report_rows(outcome.report), ["train_accuracy", "test_accuracy"], 9
    )


query("j01_train_job_zero_start", job_sql(TRAINED, epochs=20, cut=0.33, seed=None))(flagship)


@query(
    "j02_evaluate_job",
    f"""WITH {OD}, split AS ({SPLIT_SQL}),
    test AS (SELECT id, label, {P} AS z FROM split JOIN od USING (id) WHERE is_test),
    {REPORT.format(p='z', cut=0.4)}, 'stored' AS model_version FROM c""",
)
def j02(spark, d):
    path = scratch_path(spark, "registry")
    save_model(
        spark, binary_model(0.4), path, {"model_name": "orders-status", "version": "stored"}
    )
    report = evaluate_job(orders(spark, d), "y", "id", path, "orders-status", "stored")
    return report_rows(report)


@query(
    "j02_evaluate_after_training",
    job_sql(", '2' AS model_version FROM c", epochs=5, cut=0.33, seed=0),
)
def j02_round_trip(spark, d):
    path = scratch_path(spark, "registry")
    rows = orders(spark, d)
    train_job(
        rows, ["x1", "x2"], "y", "id", path,
        spec=LogisticRegression(learning_rate=0.5, max_iter=5, threshold=0.33, seed=0),
        meta={"model_name": "orders-status", "version": "2"},
    )
    return report_rows(evaluate_job(rows, "y", "id", path, "orders-status", "2"))


# Three classes: softmax from zero on the training part, the report on the test part.
JOB_NAMES = [f"w{i}{k}" for i in range(2) for k in range(3)] + [f"b{k}" for k in range(3)]
JOB_MOVE = ", ".join(
    [f"w{i}{k} - 0.6 * (avg(r{k} * x{i + 1}) + 4.0 * w{i}{k} / count(*))"
     for i in range(2) for k in range(3)]
    + [f"b{k} - 0.6 * avg(r{k})" for k in range(3)]
)
JOB_SPLIT = stratified_sql(f"WITH {OD} SELECT id, y3 AS label FROM od", "ceil(count(*) * 0.3)", 8)
JOB_CLASSES = f"""WITH RECURSIVE {OD}, split AS ({JOB_SPLIT}),
parts AS (SELECT split.*, x1, x2 FROM split JOIN od USING (id)),
gd(e, {', '.join(JOB_NAMES)}) AS (
  SELECT 0, {', '.join(['0.0::DOUBLE'] * 9)}
  UNION ALL
  SELECT e + 1, {JOB_MOVE} FROM (SELECT *, {SOFT_ERRORS} FROM (
    SELECT gd.*, label, x1, x2, {SOFT_EXPS} FROM gd, parts WHERE NOT is_test AND e < 6))
  GROUP BY e, {', '.join(JOB_NAMES)}),
scored AS (SELECT *, CASE WHEN e0 >= e1 AND e0 >= e2 THEN 0 WHEN e1 >= e2 THEN 1 ELSE 2 END AS guess
  FROM (SELECT is_test, label, {SOFT_EXPS} FROM parts, gd WHERE e = 6)),
k AS (SELECT unnest(range(3)) AS k),
s AS (SELECT k, count(*) FILTER (label = k AND guess = k) AS tp, count(*) FILTER (label <> k AND guess = k)
  AS fp, count(*) FILTER (label = k AND guess <> k) AS fn FROM scored, k WHERE is_test GROUP BY k),
m AS (SELECT avg(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END) AS precision_macro,
  avg(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END) AS recall_macro,
  avg(CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END) AS f1_macro
  FROM s WHERE tp + fp + fn > 0)
SELECT round(avg(CAST(label = guess AS DOUBLE)) FILTER (is_test), 9) AS accuracy,
  round(max(precision_macro), 9) AS precision_macro, round(max(recall_macro), 9) AS recall_macro,
  round(max(f1_macro), 9) AS f1_macro,
  round(avg(-ln(CASE label WHEN 0 THEN e0 WHEN 1 THEN e1 ELSE e2 END / (e0 + e1 + e2)))
    FILTER (is_test), 9) AS log_loss, count(*) FILTER (is_test) AS n_test_samples"""


def _three_classes(spark, d, name):
    rows, path = orders(spark, d), scratch_path(spark, "registry")
    spec = LogisticRegression(
        learning_rate=0.6, max_iter=6, tol=0.0, start="zeros", regularization_strength=4.0
    )
    outcome = train_job(
        rows, ["x1", "x2"], "y3", "id", path, spec=spec, test_size=0.3, seed=8,
        meta={"model_name": "orders-status", "version": name},
    )
    return rows, path, outcome.report


CLASS_COLUMNS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "log_loss"]


@query(
    "j01_train_job_three_classes",
    JOB_CLASSES + """, round(avg(CAST(label = guess AS DOUBLE)) FILTER (is_test), 9) AS test_accuracy,
    round(avg(CAST(label = guess AS DOUBLE)) FILTER (NOT is_test), 9) AS train_accuracy,
    count(*) FILTER (NOT is_test) AS n_train_samples FROM scored, m""",
)
def j01_classes(spark, d):
    report = _three_classes(spark, d, "three")[2].drop("confusion_matrix", "labels")
    return round_columns(report, [*CLASS_COLUMNS, "train_accuracy", "test_accuracy"], 9)


@query(
    "j02_evaluate_job_three_classes", JOB_CLASSES + ", 'three' AS model_version FROM scored, m"
)
def j02_classes(spark, d):
    rows, path, _ = _three_classes(spark, d, "three")
    report = evaluate_job(rows, "y3", "id", path, "orders-status", "three", test_size=0.3, seed=8)
    return round_columns(report.drop("confusion_matrix", "labels"), CLASS_COLUMNS, 9)


# --- models of every kind in the scoring jobs ---------------------------------------------------

SOFT_CTE = f"""WITH {OD}, e AS (SELECT id, exp({LOGITS[0]}) AS e0, exp({LOGITS[1]}) AS e1,
  exp({LOGITS[2]}) AS e2 FROM od)
SELECT id, CAST(CASE WHEN e0 >= e1 AND e0 >= e2 THEN 10 WHEN e1 >= e2 THEN 20 ELSE 30 END
         AS BIGINT) AS prediction, round(e1 / (e0 + e1 + e2), 9) AS probability,
       'soft' AS model_version"""


def soft_model() -> Model:
    params = {"weights": np.array(SOFT_W), "bias": np.array(SOFT_B)}
    return Model("softmax", ["x1", "x2"], 2, params, [10, 20, 30])


@query(
    "r06_score_batch_softmax",
    SOFT_CTE + ", round(e2 / (e0 + e1 + e2), 9) AS p_third FROM e",
)
def r06_softmax(spark, d):
    rows = orders(spark, d).select("id", "x1", "x2")
    scored = score_batch(rows, soft_model(), "soft", per_class=True)
    third = F.get("probabilities", F.lit(2))
    scored = scored.withColumn("p_third", third).drop("x1", "x2", "probabilities")
    return round_columns(scored, ["probability", "p_third"], 9)


@query("r07_score_stream_softmax", SOFT_CTE + " FROM e")
def r07_softmax(spark, d):
    batch = table(spark, d, "orders")
    stream = (
        spark.readStream.schema(batch.schema).option("pathGlobFilter", "orders.parquet").parquet(d)
    )
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1998-04-01").cast("date"))
    rows = stream.select(
        F.col("o_orderkey").alias("id"),
        ((F.col("o_totalprice") - 250000) / 150000).alias("x1"),
        (days / 1000.0).alias("x2"),
    )
    path = scratch_path(spark, "scored")
    scored = score_stream(rows, soft_model(), "soft").drop("x1", "x2")
    write_scores(scored, path, scratch_path(spark, "scored-checkpoint")).awaitTermination()
    return round_columns(spark.read.parquet(path), ["probability"], 9)


@query(
    "r06_score_batch_invalid_rows",
    f"""WITH {OD}, p AS (SELECT id, CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL
          ELSE {P} END AS p FROM od)
        SELECT id, CAST(CASE WHEN p IS NULL THEN NULL WHEN p >= 0.5 THEN 1 ELSE 0 END AS BIGINT)
          AS prediction, round(p, 9) AS probability, 'v1' AS model_version FROM p""",
)
def r06_invalid(spark, d):
    # NULL, NaN and infinite features: the rows stay and have no output
    dirty = (
        F.when(F.col("id") % 7 == 0, F.lit(None).cast("double"))
        .when(F.col("id") % 7 == 1, F.lit(float("nan")))
        .when(F.col("id") % 7 == 2, F.lit(float("inf")))
        .otherwise(F.col("x1"))
    )
    rows = orders(spark, d).select("id", dirty.alias("x1"), "x2")
    scored = score_batch(rows, binary_model(), "v1", invalid="null")
    return round_columns(scored.drop("x1", "x2"), ["probability"], 9)
