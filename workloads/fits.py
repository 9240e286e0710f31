"""Estimators: parameters and histories of fitted models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.operators.fit import fit, start_weights
from sparkfold.operators.models import Model
from sparkfold.operators.score import predict, score
from sparkfold.operators.specs import (
    LinearRegression,
    LogisticRegression,
    MajorityClass,
    MeanTarget,
    MLPClassifier,
    MLPRegressor,
)
from workloads.base import (
    DOC,
    LI,
    OD,
    documents,
    embeddings,
    lineitems,
    orders,
    query,
    rounded,
    table,
)
from workloads.splits import shuffled


def parameters(spark: SparkSession, model: Model, digits: int = 6) -> DataFrame:
    """One row per parameter value: (param, position, value)."""
    rows = [
        (name, i, float(v)) for name, values in model.params.items()
        for i, v in enumerate(np.ravel(values))
    ]
    df = spark.createDataFrame(rows, "param string, position int, value double")
    return df.withColumn("value", rounded("value", digits))


def history(spark: SparkSession, model: Model, *names: str, digits: int = 6) -> DataFrame:
    return model.history(spark).select(
        "epoch", *[rounded(name, digits).alias(name) for name in names]
    )


@query(
    "f01_majority_class",
    """SELECT CAST(n AS BIGINT) AS majority FROM (SELECT c_nationkey AS n, count(*) AS c
       FROM customer GROUP BY c_nationkey ORDER BY c DESC, n LIMIT 1)""",
)
def f01(spark, d):
    rows = table(spark, d, "customer").select("c_nationkey", "c_acctbal")
    model = fit(MajorityClass(), rows, ["c_acctbal"], "c_nationkey")
    return predict(rows.select("c_acctbal"), model, "majority").select("majority").distinct()


@query("f02_mean_target", f"WITH {LI} SELECT round(avg(t), 6) AS prediction FROM li")
def f02(spark, d):
    rows = lineitems(spark, d)
    model = fit(MeanTarget(), rows, ["q"], "t")
    return predict(rows, model).select(rounded("prediction").alias("prediction")).distinct()


CENTRED = """WITH {li}, m AS (SELECT sum({w}) AS n, sum({w} * q) / sum({w}) AS mq,
  sum({w} * d) / sum({w}) AS md, sum({w} * t) / sum({w}) AS mt FROM li),
c AS (SELECT sum({w} * (q - mq) ^ 2) + {l2} AS qq, sum({w} * (q - mq) * (d - md)) AS qd,
  sum({w} * (d - md) ^ 2) + {l2} AS dd, sum({w} * (q - mq) * (t - mt)) AS qt,
  sum({w} * (d - md) * (t - mt)) AS dt FROM li, m),
s AS (SELECT (qt * dd - dt * qd) / (qq * dd - qd * qd) AS wq,
  (dt * qq - qt * qd) / (qq * dd - qd * qd) AS wd FROM c)
SELECT 'weights' AS param, 0 AS position, round(wq, 6) AS value FROM s
UNION ALL SELECT 'weights', 1, round(wd, 6) FROM s
UNION ALL SELECT 'bias', 0, round(mt - wq * mq - wd * md, 6) FROM s, m"""


@query("f03_normal_equation", CENTRED.format(li=LI, w="1.0", l2="0.0"))
def f03(spark, d):
    model = fit(LinearRegression(), lineitems(spark, d), ["q", "d"], "t")
    return parameters(spark, model)


@query("f03_normal_equation_weighted_ridge", CENTRED.format(li=LI, w="w", l2="5000.0"))
def f03_ridge(spark, d):
    spec = LinearRegression(penalty="l2", regularization_strength=5000.0)
    model = fit(spec, lineitems(spark, d), ["q", "d"], "t", weight="w")
    return parameters(spark, model)


@query(
    "f03_normal_equation_no_intercept",
    f"""WITH {LI}, c AS (SELECT sum(q * q) AS qq, sum(q * d) AS qd, sum(d * d) AS dd,
          sum(q * t) AS qt, sum(d * t) AS dt FROM li)
        SELECT 'weights' AS param, 0 AS position,
               round((qt * dd - dt * qd) / (qq * dd - qd * qd), 6) AS value FROM c
        UNION ALL SELECT 'weights', 1, round((dt * qq - qt * qd) / (qq * dd - qd * qd), 6) FROM c
        UNION ALL SELECT 'bias', 0, 0.0""",
)
def f03_origin(spark, d):
    model = fit(LinearRegression(fit_intercept=False), lineitems(spark, d), ["q", "d"], "t")
    return parameters(spark, model)


@query(
    "f03_normal_equation_loss",
    f"""WITH {LI} SELECT 1 AS epoch,
        round(0.5 * regr_syy(t, q) * (1 - regr_r2(t, q)) / count(*), 6) AS train_loss FROM li""",
)
def f03_loss(spark, d):
    model = fit(LinearRegression(), lineitems(spark, d), ["q"], "t")
    return history(spark, model, "train_loss")


@query(
    "f03_normal_equation_wide",
    """SELECT CAST(j AS INTEGER) AS position, 0.0::DOUBLE AS moment
       FROM (SELECT unnest(range(max(len(embedding)))) AS j FROM embeddings)""",
)
def f03_wide(spark, d):
    # 64 features: the residuals of the least-squares answer are orthogonal to every feature
    rows = embeddings(spark, d)
    model = fit(LinearRegression(), rows, "embedding", "label")
    scored = predict(rows, model).withColumn("gap", F.col("prediction") - F.col("label"))
    parts = scored.select("gap", F.posexplode("embedding").alias("position", "x"))
    moments = parts.groupBy("position").agg((F.sum(F.col("gap") * F.col("x"))).alias("m"))
    return moments.select("position", rounded("m", 5).alias("moment"))


# Descent on one feature from the moments of the table; {n}, {lr}, {step} fill in a variant.
MOMENTS = """s AS (SELECT count(*)::DOUBLE AS n, avg(q * q) AS qq, avg(q) AS q1, avg(q * t) AS qt,
  avg(t) AS t1, avg(t * t) AS tt FROM li)"""
LOSS = "0.5 * (w * w * qq + 2 * w * b * q1 + b * b - 2 * w * qt - 2 * b * t1 + tt)"

GD = f"""WITH RECURSIVE {LI}, {MOMENTS},
gd(e, w, b, norm) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT e + 1, w - {{lr}} * gw, b - {{lr}} * gb, sqrt(gw * gw + gb * gb)
  FROM (SELECT e, w, b, w * qq + b * q1 - qt + {{slope}} / n AS gw, w * q1 + b - t1 AS gb
        FROM gd, s WHERE e < {{epochs}}))"""


@query(
    "f04_linear_descent",
    GD.format(lr=0.1, slope="1000.0 * w", epochs=25)
    + f""" SELECT e AS epoch, round({LOSS} + 1000.0 * w * w / (2 * n), 6) AS train_loss,
    round(norm, 6) AS grad_norm, round(sqrt(w * w + b * b), 6) AS param_norm
    FROM gd, s WHERE e > 0""",
)
def f04(spark, d):
    spec = LinearRegression(
        solver="gradient_descent", learning_rate=0.1, max_iter=25, tol=0.0,
        penalty="l2", regularization_strength=1000.0,
    )
    model = fit(spec, lineitems(spark, d), ["q"], "t")
    return history(spark, model, "train_loss", "grad_norm", "param_norm")


@query(
    "f04_linear_descent_l1",
    GD.format(lr=0.2, slope="4000.0 * sign(w)", epochs=20)
    + f""" SELECT e AS epoch, round({LOSS} + 4000.0 * abs(w) / n, 6) AS train_loss,
    round(norm, 6) AS grad_norm, round(sqrt(w * w + b * b), 6) AS param_norm
    FROM gd, s WHERE e > 0""",
)
def f04_l1(spark, d):
    spec = LinearRegression(
        solver="gradient_descent", learning_rate=0.2, max_iter=20, tol=0.0,
        penalty="l1", regularization_strength=4000.0,
    )
    model = fit(spec, lineitems(spark, d), ["q"], "t")
    return history(spark, model, "train_loss", "grad_norm", "param_norm")


HELD = """ranked AS (SELECT *, row_number() OVER (ORDER BY {order}) <=
  (SELECT least(greatest(1, ceil(count(*) * {fraction})), count(*) - 1) FROM {source}) AS held
  FROM {source})"""


@query(
    "f04_linear_descent_early_stopping",
    f"""WITH RECURSIVE {OD},
    {HELD.format(order=shuffled('6:holdout'), fraction=0.2, source='od')},
    s AS (SELECT avg(x2 * x2) AS qq, avg(x2) AS q1, avg(x2 * t) AS qt, avg(t) AS t1
          FROM ranked WHERE NOT held),
    gd(e, w, b) AS (
      SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT e + 1, w - 0.3 * (w * qq + b * q1 - qt), b - 0.3 * (w * q1 + b - t1)
      FROM gd, s WHERE e < 15)
    SELECT e AS epoch, round(0.5 * avg((w * x2 + b - t) ^ 2) FILTER (NOT held), 5) AS train_loss,
           round(0.5 * avg((w * x2 + b - t) ^ 2) FILTER (held), 5) AS val_loss
    FROM gd, ranked WHERE e > 0 GROUP BY e""",
)
def f04_stop(spark, d):
    spec = LinearRegression(
        solver="gradient_descent", learning_rate=0.3, max_iter=15, tol=0.0,
        early_stopping=True, validation_fraction=0.2, seed=6,
    )
    model = fit(spec, orders(spark, d), ["x2"], "t", id_col="id")
    return history(spark, model, "train_loss", "val_loss", digits=5)


@query(
    "f05_logistic_descent",
    f"""WITH RECURSIVE {LI}, gd(e, w1, w2, b) AS (
      SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT e + 1, w1 - 0.5 * (avg((p - r) * q) + 200.0 * w1 / count(*)),
             w2 - 0.5 * (avg((p - r) * d) + 200.0 * w2 / count(*)), b - 0.5 * avg(p - r)
      FROM (SELECT e, w1, w2, b, r, q, d, 1 / (1 + exp(-(w1 * q + w2 * d + b))) AS p
            FROM gd, li WHERE e < 8) GROUP BY e, w1, w2, b)
    SELECT e AS epoch, round(avg(-(r * ln(p) + (1 - r) * ln(1 - p)))
             + 200.0 * (w1 * w1 + w2 * w2) / (2 * count(*)), 8) AS train_loss,
           round(sqrt(w1 * w1 + w2 * w2 + b * b), 8) AS param_norm
    FROM (SELECT *, 1 / (1 + exp(-(w1 * q + w2 * d + b))) AS p FROM gd, li WHERE e > 0)
    GROUP BY e, w1, w2, b""",
)
def f05(spark, d):
    spec = LogisticRegression(
        learning_rate=0.5, max_iter=8, tol=0.0, regularization_strength=200.0, start="zeros"
    )
    model = fit(spec, lineitems(spark, d), ["q", "d"], "r")
    return history(spark, model, "train_loss", "param_norm", digits=8)


@query(
    "f05_logistic_balanced_early_stopping",
    f"""WITH RECURSIVE {DOC}, c AS (SELECT y, (SELECT count(*) FROM doc) / (2.0 * count(*)) AS cw
          FROM doc GROUP BY y),
    base AS (SELECT id, y, x1, x2, w * cw AS g FROM doc JOIN c USING (y)),
    {HELD.format(order=shuffled('3:holdout'), fraction=0.25, source='base')},
    gd(e, w1, w2, b) AS (
      SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT e + 1, w1 - 0.4 * sum(g * (p - y) * x1) / sum(g),
             w2 - 0.4 * sum(g * (p - y) * x2) / sum(g), b - 0.4 * sum(g * (p - y)) / sum(g)
      FROM (SELECT e, w1, w2, b, y, x1, x2, g, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p
            FROM gd, ranked WHERE e < 10 AND NOT held) GROUP BY e, w1, w2, b),
    l AS (SELECT e, g, held, -(y * ln(p) + (1 - y) * ln(1 - p)) AS l FROM (
      SELECT *, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p FROM gd, ranked WHERE e > 0))
    SELECT e AS epoch,
      round(sum(g * l) FILTER (NOT held) / sum(g) FILTER (NOT held), 7) AS train_loss,
      round(sum(g * l) FILTER (held) / sum(g) FILTER (held), 7) AS val_loss FROM l GROUP BY e""",
)
def f05_balanced(spark, d):
    spec = LogisticRegression(
        learning_rate=0.4, max_iter=10, n_iter_no_change=10, start="zeros",
        class_weight="balanced", early_stopping=True, validation_fraction=0.25, seed=3,
    )
    model = fit(spec, documents(spark, d), ["x1", "x2"], "y", id_col="id", weight="w")
    return history(spark, model, "train_loss", "val_loss", digits=7)


SOFT = "exp(w{0} * x1 + b{0}) / (exp(w0 * x1 + b0) + exp(w1 * x1 + b1) + exp(w2 * x1 + b2))"
SOFT_COLUMNS = ", ".join(f"{SOFT.format(k)} AS p{k}" for k in range(3))
SOFT_STEP = ", ".join(
    [f"w{k} - 0.8 * (avg((p{k} - CAST(y3 = {k} AS INTEGER)) * x1) + 60.0 * w{k} / count(*))"
     for k in range(3)]
    + [f"b{k} - 0.8 * avg(p{k} - CAST(y3 = {k} AS INTEGER))" for k in range(3)]
)


@query(
    "f06_softmax_descent",
    f"""WITH RECURSIVE {OD}, gd(e, w0, w1, w2, b0, b1, b2) AS (
      SELECT 0, {', '.join(['0.0::DOUBLE'] * 6)}
      UNION ALL
      SELECT e + 1, {SOFT_STEP} FROM (SELECT *, {SOFT_COLUMNS} FROM gd, od WHERE e < 6)
      GROUP BY e, w0, w1, w2, b0, b1, b2)
    SELECT e AS epoch, round(avg(-ln(CASE y3 WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END))
             + 60.0 * (w0 * w0 + w1 * w1 + w2 * w2) / (2 * count(*)), 8) AS train_loss,
           round(sqrt(w0*w0 + w1*w1 + w2*w2 + b0*b0 + b1*b1 + b2*b2), 8) AS param_norm
    FROM (SELECT *, {SOFT_COLUMNS} FROM gd, od WHERE e > 0)
    GROUP BY e, w0, w1, w2, b0, b1, b2""",
)
def f06(spark, d):
    spec = LogisticRegression(
        learning_rate=0.8, max_iter=6, tol=0.0, regularization_strength=60.0, start="zeros"
    )
    model = fit(spec, orders(spark, d), ["x1"], "y3")
    return history(spark, model, "train_loss", "param_norm", digits=8)


SOFT_GRADIENT = """g{n} AS (SELECT c, j, avg((p - own) * v) AS g FROM p{m} JOIN x USING (id)
  GROUP BY c, j), gb{n} AS (SELECT c, avg(p - own) AS g FROM p{m} GROUP BY c),
w{n} AS (SELECT c, j, w - 1.0 * g AS w FROM w{m} JOIN g{n} USING (c, j)),
b{n} AS (SELECT c, b - 1.0 * g AS b FROM b{m} JOIN gb{n} USING (c)),
z{n} AS (SELECT id, c, sum(v * w) + max(b) AS z FROM x JOIN w{n} USING (j) JOIN b{n} USING (c)
  GROUP BY id, c),
e{n} AS (SELECT id, c, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM z{n}),
p{n} AS (SELECT e{n}.id, c, e / sum(e) OVER (PARTITION BY e{n}.id) AS p,
  CAST(c = label AS INTEGER) AS own FROM e{n} JOIN rows_ USING (id))"""
SOFT_SUMMARY = """SELECT {n} AS epoch,
  round((SELECT avg(-ln(p)) FROM p{n} WHERE own = 1), 8) AS train_loss,
  round(sqrt((SELECT sum(w * w) FROM w{n}) + (SELECT sum(b * b) FROM b{n})), 8) AS param_norm"""


@query(
    "f06_softmax_embeddings_zero_start",
    """WITH rows_ AS (SELECT vec_id AS id, label, embedding FROM embeddings),
    x AS (SELECT id, unnest(range(len(embedding))) AS j, unnest(embedding)::DOUBLE AS v FROM rows_),
    classes AS (SELECT DISTINCT label AS c FROM rows_),
    w0 AS (SELECT c, j, 0.0::DOUBLE AS w FROM classes, (SELECT DISTINCT j FROM x)),
    b0 AS (SELECT c, 0.0::DOUBLE AS b FROM classes),
    p0 AS (SELECT id, c, 1.0 / (SELECT count(*) FROM classes) AS p,
      CAST(c = label AS INTEGER) AS own FROM rows_, classes), """
    + ", ".join(SOFT_GRADIENT.format(n=n, m=n - 1) for n in (1, 2))
    + " " + " UNION ALL ".join(SOFT_SUMMARY.format(n=n) for n in (1, 2)),
)
def f06_wide_zero(spark, d):
    # 64 features and 10 classes: the matrix form of the pass
    spec = LogisticRegression(learning_rate=1.0, max_iter=2, start="zeros")
    model = fit(spec, embeddings(spark, d), "embedding", "label")
    return history(spark, model, "train_loss", "param_norm", digits=8)


def random_softmax_sql(epochs: int) -> str:
    """Epochs of 64 features and 10 classes from the estimator's random start."""
    start = np.random.default_rng(0).normal(0.0, 0.01, (64, 10)).tolist()
    cells = ", ".join(f"({c}, {j}, {start[j][c]!r}::DOUBLE)" for j in range(64) for c in range(10))
    steps = [SOFT_GRADIENT.format(n=n, m=n - 1) for n in range(1, epochs + 1)]
    forward = "z0 AS" + SOFT_GRADIENT.format(n=0, m=0).split("z0 AS", 1)[1]
    parts = ",\n".join([forward, *steps])
    for n in range(epochs + 1):
        for name in ("g", "gb", "w", "b", "p"):
            parts = parts.replace(f"\n{name}{n} AS (", f"\n{name}{n} AS MATERIALIZED (")
    ends = " UNION ALL ".join(
        f"""{SOFT_SUMMARY.format(n=n).replace(', 8)', ', 6)')}, round(sqrt((SELECT sum(g * g) FROM g{n})
        + (SELECT sum(g * g) FROM gb{n})), 6) AS grad_norm""" for n in range(1, epochs + 1)
    )
    return f"""WITH rows_ AS (SELECT vec_id AS id, label, embedding FROM embeddings),
    x AS MATERIALIZED (SELECT id, unnest(range(len(embedding))) AS j,
      unnest(embedding)::DOUBLE AS v FROM rows_),
    w0 AS (SELECT * FROM (VALUES {cells}) AS w(c, j, w)),
    b0 AS (SELECT DISTINCT c, 0.0::DOUBLE AS b FROM w0),
    {parts} {ends}"""


@query("f06_softmax_embeddings", random_softmax_sql(15))
def f06_wide(spark, d):
    spec = LogisticRegression(learning_rate=1.0, max_iter=15)
    model = fit(spec, embeddings(spark, d), "embedding", "label")
    return history(spark, model, "train_loss", "grad_norm", "param_norm")


@query(
    "f07_mini_batch_descent",
    f"""WITH RECURSIVE {OD}, nb AS (SELECT CAST(ceil(count(*) / 4000) AS BIGINT) AS nb FROM od),
    steps AS (
      SELECT x1, x2, y, (row_number() OVER (ORDER BY {shuffled('2:0')}) - 1) // 4000 AS step FROM od
      UNION ALL
      SELECT x1, x2, y, nb + (row_number() OVER (ORDER BY {shuffled('2:1')}) - 1) // 4000
      FROM od, nb),
    gd(step, w1, w2, b) AS (
      SELECT 0::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT step + 1, w1 - 0.5 * (avg((p - y) * x1) + 20.0 * w1 / count(*)),
             w2 - 0.5 * (avg((p - y) * x2) + 20.0 * w2 / count(*)), b - 0.5 * avg(p - y)
      FROM (SELECT step, w1, w2, b, x1, x2, y, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p
            FROM gd JOIN steps USING (step)) GROUP BY step, w1, w2, b),
    ends AS (SELECT CAST(step / nb AS INTEGER) AS epoch, w1, w2, b FROM gd, nb
             WHERE step IN (nb, 2 * nb))
    SELECT epoch, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p)))
             + 20.0 * (w1 * w1 + w2 * w2) / (2 * count(*)), 8) AS train_loss,
           round(sqrt(w1 * w1 + w2 * w2 + b * b), 8) AS param_norm
    FROM (SELECT *, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p FROM ends, od)
    GROUP BY epoch, w1, w2, b""",
)
def f07(spark, d):
    spec = LogisticRegression(
        learning_rate=0.5, max_iter=2, regularization_strength=20.0, start="zeros",
        batch_strategy="mini_batch", batch_size=4000, seed=2,
    )
    rows = orders(spark, d)
    model = fit(spec, rows, ["x1", "x2"], "y", id_col="id")
    return history(spark, model, "train_loss", "param_norm", digits=8)


# Batches of 1,500 rows over two epochs; gd holds the parameters before each step.
BATCHES = f"""{OD}, nb AS (SELECT CAST(ceil(count(*) / 1500) AS BIGINT) AS nb FROM od),
    steps AS (
      SELECT x1, x2, t, y3, (row_number() OVER (ORDER BY {shuffled('6:0')}) - 1) // 1500 AS step FROM od
      UNION ALL
      SELECT x1, x2, t, y3, nb + (row_number() OVER (ORDER BY {shuffled('6:1')}) - 1) // 1500
      FROM od, nb)"""
BATCH_NAMES = [f"w{i}{k}" for i in range(2) for k in range(3)] + [f"b{k}" for k in range(3)]
BATCH_EXPS = ", ".join(f"exp(w0{k} * x1 + w1{k} * x2 + b{k}) AS e{k}" for k in range(3))
BATCH_ERRORS = ", ".join(f"e{k} / (e0 + e1 + e2) - CAST(y3 = {k} AS INTEGER) AS r{k}" for k in range(3))
BATCH_MOVE = ", ".join(
    [f"w{i}{k} - 0.4 * (avg(r{k} * x{i + 1}) + 5.0 * w{i}{k} / count(*))" for i in range(2) for k in range(3)]
    + [f"b{k} - 0.4 * avg(r{k})" for k in range(3)]
)


@query(
    "f07_mini_batch_softmax",
    f"""WITH RECURSIVE {BATCHES}, gd(step, {', '.join(BATCH_NAMES)}) AS (
      SELECT 0::BIGINT, {', '.join(['0.0::DOUBLE'] * 9)}
      UNION ALL
      SELECT step + 1, {BATCH_MOVE} FROM (SELECT *, {BATCH_ERRORS} FROM (
        SELECT *, {BATCH_EXPS} FROM gd JOIN steps USING (step)))
      GROUP BY step, {', '.join(BATCH_NAMES)}),
    ends AS (SELECT CAST(step / nb AS INTEGER) AS epoch, gd.* FROM gd, nb WHERE step IN (nb, 2 * nb)),
    norms AS (SELECT *, {' + '.join(f'w{i}{k} * w{i}{k}' for i in range(2) for k in range(3))} AS ww,
      b0 * b0 + b1 * b1 + b2 * b2 AS bb FROM ends)
    SELECT epoch, round(avg(-ln(CASE y3 WHEN 0 THEN e0 WHEN 1 THEN e1 ELSE e2 END / (e0 + e1 + e2)))
             + 5.0 * ww / (2 * count(*)), 8) AS train_loss, round(sqrt(ww + bb), 8) AS param_norm
    FROM (SELECT *, {BATCH_EXPS} FROM norms, od) GROUP BY epoch, ww, bb""",
)
def f07_softmax(spark, d):
    spec = LogisticRegression(
        learning_rate=0.4, max_iter=2, regularization_strength=5.0, start="zeros",
        batch_strategy="mini_batch", batch_size=1500, seed=6,
    )
    model = fit(spec, orders(spark, d), ["x1", "x2"], "y3", id_col="id")
    return history(spark, model, "train_loss", "param_norm", digits=8)


# adam on one feature: first and second moments of both parameters, corrected by the step
ADAM = {
    p: f"{p} - 0.1 * (m{p} / (1 - 0.9 ** step)) / (sqrt(v{p} / (1 - 0.999 ** step)) + 1e-8)"
    for p in ("w", "b")
}


@query(
    "f07_mini_batch_linear_adam",
    f"""WITH RECURSIVE {BATCHES}, gd(step, w, b, mw, mb, vw, vb) AS (
      SELECT 0::BIGINT, {', '.join(['0.0::DOUBLE'] * 6)}
      UNION ALL
      SELECT step, {ADAM['w']}, {ADAM['b']}, mw, mb, vw, vb FROM (
        SELECT step + 1 AS step, w, b, 0.9 * mw + 0.1 * gw AS mw, 0.9 * mb + 0.1 * gb AS mb,
               0.999 * vw + 0.001 * gw * gw AS vw, 0.999 * vb + 0.001 * gb * gb AS vb
        FROM (SELECT step, w, b, mw, mb, vw, vb, avg((w * x2 + b - x1) * x2) AS gw,
                     avg(w * x2 + b - x1) AS gb
              FROM gd JOIN steps USING (step) GROUP BY step, w, b, mw, mb, vw, vb))),
    ends AS (SELECT CAST(step / nb AS INTEGER) AS epoch, w, b FROM gd, nb WHERE step IN (nb, 2 * nb))
    SELECT epoch, round(0.5 * avg((w * x2 + b - x1) ^ 2), 8) AS train_loss,
           round(sqrt(w * w + b * b), 8) AS param_norm
    FROM ends, od GROUP BY epoch, w, b""",
)
def f07_adam(spark, d):
    spec = LinearRegression(
        solver="gradient_descent", optimizer="adam", learning_rate=0.1, max_iter=2,
        batch_strategy="mini_batch", batch_size=1500, seed=6,
    )
    model = fit(spec, orders(spark, d), ["x2"], "x1", id_col="id")
    return history(spark, model, "train_loss", "param_norm", digits=8)


def _start(seed: int, *shapes):
    rng = np.random.default_rng(seed)
    return [float(start_weights("xavier", s, rng)[0, 0]) for s in shapes]


FIRST, SECOND = _start(8, (1, 1), (1, 1))


@query(
    "f08_mlp_regressor_one_unit",
    f"""WITH RECURSIVE {OD}, gd(e, a, c, v, b) AS (
      SELECT 0, {FIRST!r}::DOUBLE, 0.0::DOUBLE, {SECOND!r}::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT e + 1, a - 0.1 * (avg(g * v * (1 - h * h) * x1) + 30.0 * a / count(*)),
             c - 0.1 * avg(g * v * (1 - h * h)), v - 0.1 * (avg(g * h) + 30.0 * v / count(*)),
             b - 0.1 * avg(g)
      FROM (SELECT *, 2 * (v * h + b - x2) AS g
            FROM (SELECT *, tanh(a * x1 + c) AS h FROM gd, od WHERE e < 5))
      GROUP BY e, a, c, v, b)
    SELECT e AS epoch, round(avg((v * h + b - x2) ^ 2) + 30.0 * (a * a + v * v)
           / (2 * count(*)), 8) AS train_loss
    FROM (SELECT *, tanh(a * x1 + c) AS h FROM gd, od WHERE e > 0) GROUP BY e, a, c, v, b""",
)
def f08_unit(spark, d):
    spec = MLPRegressor(
        hidden_layer_sizes=(1,), activation="tanh", optimizer="sgd", learning_rate=0.1,
        max_iter=5, alpha=30.0, seed=8,
    )
    model = fit(spec, orders(spark, d), ["x1"], "x2")
    return history(spark, model, "train_loss", digits=8)


# Adam and weight decay on rows that are not kept aside, the loss of those that are.
NET_ADAM = {
    p: f"{p} - 0.05 * (m{p} / (1 - 0.9 ** e)) / (sqrt(s{p} / (1 - 0.999 ** e)) + 1e-8)" for p in "acvb"
}
NET_MEMORY = ", ".join(
    [f"0.9 * m{p} + 0.1 * g{p} AS m{p}" for p in "acvb"]
    + [f"0.999 * s{p} + 0.001 * g{p} * g{p} AS s{p}" for p in "acvb"]
)
NET_STATE = ", ".join([*"acvb", *(f"m{p}" for p in "acvb"), *(f"s{p}" for p in "acvb")])


@query(
    "f08_mlp_regressor_adam_holdout",
    f"""WITH RECURSIVE {OD}, placed AS (
      SELECT x1, x2, row_number() OVER (ORDER BY {shuffled('8:holdout')}) <= ceil(0.2 * count(*) OVER ())
        AS held FROM od),
    gd(e, {NET_STATE}) AS (
      SELECT 0, {FIRST!r}::DOUBLE, 0.0::DOUBLE, {SECOND!r}::DOUBLE, {', '.join(['0.0::DOUBLE'] * 9)}
      UNION ALL
      SELECT e, {', '.join(NET_ADAM[p] for p in 'acvb')},
             {', '.join([f'm{p}' for p in 'acvb'] + [f's{p}' for p in 'acvb'])}
      FROM (SELECT e + 1 AS e, a, c, v, b, {NET_MEMORY} FROM (
        SELECT e, {NET_STATE}, avg(g * v * (1 - h * h) * x1) + 40.0 * a / count(*) AS ga,
               avg(g * v * (1 - h * h)) AS gc, avg(g * h) + 40.0 * v / count(*) AS gv, avg(g) AS gb
        FROM (SELECT *, 2 * (v * h + b - x2) AS g
              FROM (SELECT *, tanh(a * x1 + c) AS h FROM gd, placed WHERE NOT held AND e < 6))
        GROUP BY e, {NET_STATE}))),
    l AS (SELECT e, a, v, held, avg((v * h + b - x2) ^ 2) + 40.0 * (a * a + v * v) / (2 * count(*)) AS loss
      FROM (SELECT *, tanh(a * x1 + c) AS h FROM gd, placed WHERE e > 0) GROUP BY e, a, v, held)
    SELECT e AS epoch, round(max(loss) FILTER (NOT held), 8) AS train_loss,
           round(max(loss) FILTER (held), 8) AS val_loss FROM l GROUP BY e""",
)
def f08_adam(spark, d):
    spec = MLPRegressor(
        hidden_layer_sizes=(1,), activation="tanh", optimizer="adam", learning_rate=0.05, max_iter=6,
        alpha=40.0, early_stopping=True, validation_fraction=0.2, n_iter_no_change=20, seed=8,
    )
    model = fit(spec, orders(spark, d), ["x1"], "x2", id_col="id")
    return history(spark, model, "train_loss", "val_loss", digits=8)


def _network_start(seed: int, *shapes):
    rng = np.random.default_rng(seed)
    return [start_weights("he", shape, rng) for shape in shapes]


# Two inputs, two tanh units, three classes: a?? are the first weights, v?? the second.
NET_A, NET_V = _network_start(5, (2, 2), (2, 3))
NET_NAMES = (
    [f"a{i}{k}" for i in range(2) for k in range(2)] + [f"c{k}" for k in range(2)]
    + [f"v{k}{o}" for k in range(2) for o in range(3)] + [f"b{o}" for o in range(3)]
)
NET_START = [
    *np.ravel(NET_A).tolist(), 0.0, 0.0, *np.ravel(NET_V).tolist(), 0.0, 0.0, 0.0
]
NET_UNITS = ", ".join(f"tanh(a0{k} * x1 + a1{k} * x2 + c{k}) AS h{k}" for k in range(2))
NET_EXPS = ", ".join(f"exp(v0{o} * h0 + v1{o} * h1 + b{o}) AS e{o}" for o in range(3))
NET_ERRORS = ", ".join(
    f"e{o} / (e0 + e1 + e2) - CAST(y3 = {o} AS INTEGER) AS r{o}" for o in range(3)
)
NET_BACK = ", ".join(
    f"({' + '.join(f'r{o} * v{k}{o}' for o in range(3))}) * (1 - h{k} * h{k}) AS s{k}"
    for k in range(2)
)
NET_STEP = ", ".join(
    [f"a{i}{k} - 0.4 * avg(s{k} * x{i + 1})" for i in range(2) for k in range(2)]
    + [f"c{k} - 0.4 * avg(s{k})" for k in range(2)]
    + [f"v{k}{o} - 0.4 * avg(r{o} * h{k})" for k in range(2) for o in range(3)]
    + [f"b{o} - 0.4 * avg(r{o})" for o in range(3)]
)


@query(
    "f08_mlp_classifier_two_units",
    f"""WITH RECURSIVE {OD}, gd(e, {', '.join(NET_NAMES)}) AS (
      SELECT 0, {', '.join(f'{v!r}::DOUBLE' for v in NET_START)}
      UNION ALL
      SELECT e + 1, {NET_STEP} FROM (SELECT *, {NET_BACK} FROM (SELECT *, {NET_ERRORS} FROM (
        SELECT *, {NET_EXPS} FROM (SELECT *, {NET_UNITS} FROM gd, od WHERE e < 4))))
      GROUP BY e, {', '.join(NET_NAMES)})
    SELECT e AS epoch, round(avg(-ln(CASE y3 WHEN 0 THEN e0 WHEN 1 THEN e1 ELSE e2 END
           / (e0 + e1 + e2))), 8) AS train_loss
    FROM (SELECT *, {NET_EXPS} FROM (SELECT *, {NET_UNITS} FROM gd, od WHERE e > 0)) GROUP BY e""",
)
def f08_units(spark, d):
    spec = MLPClassifier(
        hidden_layer_sizes=(2,), activation="tanh", optimizer="sgd", learning_rate=0.4,
        max_iter=4, initializer="he", seed=5,
    )
    model = fit(spec, orders(spark, d), ["x1", "x2"], "y3")
    return history(spark, model, "train_loss", digits=8)


@query("f08_mlp_classifier")
def f08(spark, d):
    spec = MLPClassifier(
        hidden_layer_sizes=(32, 16), learning_rate=0.01, max_iter=12, dropout_rate=0.1,
        alpha=0.01, initializer="he", early_stopping=True, seed=4,
    )
    model = fit(spec, embeddings(spark, d), "embedding", "label", id_col="id")
    return history(spark, model, "train_loss", "val_loss", "learning_rate")


@query(
    "f09_local_descent_one_step",
    f"""WITH RECURSIVE {OD}, gd(e, w1, w2, b) AS (
      SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT e + 1, w1 - 0.6 * avg((p - y) * x1), w2 - 0.6 * avg((p - y) * x2),
             b - 0.6 * avg(p - y)
      FROM (SELECT e, w1, w2, b, y, x1, x2, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p
            FROM gd, od WHERE e < 4) GROUP BY e, w1, w2, b)
    SELECT e AS epoch, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 8) AS train_loss,
           round(sqrt(w1 * w1 + w2 * w2 + b * b), 8) AS param_norm
    FROM (SELECT *, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p FROM gd, od WHERE e > 0)
    GROUP BY e, w1, w2, b""",
)
def f09_one_step(spark, d):
    # one step per shard: the row-weighted average of the shards is a full-batch step
    rows = orders(spark, d)
    spec = LogisticRegression(
        learning_rate=0.6, max_iter=4, batch_strategy="stochastic", batch_size=10**9, shards=16,
        start="zeros", tol=0.0, gradient_tol=0.0,
    )
    model = fit(spec, rows, ["x1", "x2"], "y", id_col="id")
    return history(spark, model, "train_loss", "param_norm", digits=8)


def _epoch_of_shards(e: int, before: str, strength: float) -> str:
    """Every shard's steps of 64 rows from the parameters of ``before``, and their average m{e}."""
    return f"""s{e} AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY win, turn{e}) - 1) // 64
      AS step FROM placed),
    g{e}(shard, step, w1, w2, b) AS (
      SELECT shard, 0::BIGINT, w1, w2, b FROM (SELECT DISTINCT shard FROM placed), {before}
      UNION ALL
      SELECT shard, step + 1, w1 - 0.05 * (avg((p - y) * x1) + {strength} * w1 / count(*)),
             w2 - 0.05 * (avg((p - y) * x2) + {strength} * w2 / count(*)), b - 0.05 * avg(p - y)
      FROM (SELECT shard, step, w1, w2, b, x1, x2, y, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p
            FROM g{e} JOIN s{e} USING (shard, step)) GROUP BY shard, step, w1, w2, b),
    m{e} AS (SELECT sum(n * w1) / sum(n) AS w1, sum(n * w2) / sum(n) AS w2, sum(n * b) / sum(n) AS b
      FROM (SELECT * FROM g{e} QUALIFY row_number() OVER (PARTITION BY shard ORDER BY step DESC) = 1)
      JOIN (SELECT shard, count(*) AS n FROM placed GROUP BY shard) USING (shard))"""


def shard_sql(epochs: int, start: list[float], strength: float, digits: int) -> str:
    """Epochs of eight shards that walk in windows of 4,096 rows."""
    turns = ", ".join(f"md5(concat('4:{e}:', id)) AS turn{e}" for e in range(epochs))
    walks = ", ".join(_epoch_of_shards(e, f"m{e - 1}" if e else "z", strength) for e in range(epochs))
    ends = " UNION ALL ".join(f"SELECT {e + 1} AS epoch, * FROM m{e}" for e in range(epochs))
    return f"""WITH RECURSIVE {OD}, cut AS (
    SELECT y, x1, x2, CAST('0x' || substr(md5(concat('4:shard:', id)), 1, 13) AS BIGINT) % 8 AS shard,
           md5(concat('4:walk:', id)) AS walk, {turns} FROM od),
    placed AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY walk) - 1) // 4096 AS win
      FROM cut),
    z AS (SELECT {start[0]!r}::DOUBLE AS w1, {start[1]!r}::DOUBLE AS w2, 0.0::DOUBLE AS b), {walks}
    SELECT epoch, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p)))
             + {strength} * (w1 * w1 + w2 * w2) / (2 * count(*)), {digits}) AS train_loss,
           round(sqrt(w1 * w1 + w2 * w2 + b * b), {digits}) AS param_norm
    FROM (SELECT *, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + b))) AS p FROM ({ends}), od)
    GROUP BY epoch, w1, w2, b"""


@query("f09_local_descent_windows", shard_sql(2, [0.0, 0.0], 3.0, 8))
def f09_windows(spark, d):
    spec = LogisticRegression(
        learning_rate=0.05, max_iter=2, batch_strategy="stochastic", batch_size=64, seed=4,
        regularization_strength=3.0, start="zeros", tol=0.0, gradient_tol=0.0,
    )
    model = fit(spec, orders(spark, d), ["x1", "x2"], "y", id_col="id")
    return history(spark, model, "train_loss", "param_norm", digits=8)


@query("f09_local_descent", shard_sql(3, np.random.default_rng(4).normal(0.0, 0.01, 2).tolist(), 0.0, 6))
def f09(spark, d):
    spec = LogisticRegression(
        learning_rate=0.05, max_iter=3, batch_strategy="stochastic", batch_size=64, seed=4,
        n_iter_no_change=3,
    )
    model = fit(spec, orders(spark, d), ["x1", "x2"], "y", id_col="id")
    return history(spark, model, "train_loss", "param_norm")


RULES = f"""WITH RECURSIVE {LI}, {MOMENTS},
gd(e, w, b, mw, mb, vw, vb) AS (
  SELECT 0, {', '.join(['0.0::DOUBLE'] * 6)}
  UNION ALL
  SELECT e, {{w}}, {{b}}, mw, mb, vw, vb FROM (
    SELECT e + 1 AS e, w, b, gw, gb, {{mw}} AS mw, {{mb}} AS mb, {{vw}} AS vw, {{vb}} AS vb
    FROM (SELECT gd.*, w * qq + b * q1 - qt AS gw, w * q1 + b - t1 AS gb FROM gd, s
          WHERE e < {{epochs}})))
SELECT e AS epoch, round({LOSS}, 6) AS train_loss, round(w, 8) AS weight, round(b, 8) AS bias
FROM gd, s WHERE e = {{epochs}}"""


def _rule(move: str, m: str, v: str, epochs: int = 6) -> str:
    parts = {}
    for p in ("w", "b"):
        fill = {"p": p, "g": f"g{p}", "m": f"m{p}", "v": f"v{p}"}
        parts[p] = move.format(**fill)
        parts[f"m{p}"], parts[f"v{p}"] = m.format(**fill), v.format(**fill)
    return RULES.format(epochs=epochs, **parts)


RULE_SQL = {
    "sgd": _rule("{p} - 0.5 * {g}", "0.0", "0.0"),
    "momentum": _rule("{p} + {m}", "0.9 * {m} - 0.5 * {g}", "0.0"),
    "rmsprop": _rule(
        "{p} - 0.5 * {g} / (sqrt({v}) + 1e-8)", "0.0", "0.9 * {v} + 0.1 * {g} * {g}"
    ),
    "adam": _rule(
        "{p} - 0.5 * ({m} / (1 - 0.9 ^ e)) / (sqrt({v} / (1 - 0.999 ^ e)) + 1e-8)",
        "0.9 * {m} + (1 - 0.9) * {g}", "0.999 * {v} + (1 - 0.999) * {g} * {g}",
    ),
}


def _register_rules():
    for rule, sql in RULE_SQL.items():

        def compute(spark, d, rule=rule):
            spec = LinearRegression(
                solver="gradient_descent", optimizer=rule, learning_rate=0.5, max_iter=6, tol=0.0
            )
            model = fit(spec, lineitems(spark, d), ["q"], "t")
            last = model.history(spark).filter(F.col("epoch") == model.n_iter)
            return last.select(
                "epoch", rounded("train_loss").alias("train_loss"),
                rounded(F.lit(float(model.params["weights"][0])), 8).alias("weight"),
                rounded(F.lit(float(model.params["bias"][0])), 8).alias("bias"),
            )

        query(f"f10_update_{rule}", sql)(compute)


_register_rules()

SCHEDULE_SQL = {
    "constant": "0.3",
    "step": "0.3 * 0.5 ^ (({0}) // 10)",
    "cosine": "0.3 * 0.5 * (1 + cos(pi() * ({0}) / 24))",
}


def _register_schedules():
    for kind, formula in SCHEDULE_SQL.items():

        def compute(spark, d, kind=kind):
            spec = LinearRegression(
                solver="gradient_descent", learning_rate_schedule=kind, learning_rate=0.3,
                max_iter=24, tol=0.0, gradient_tol=0.0, n_iter_no_change=24,
            )
            model = fit(spec, lineitems(spark, d), ["q"], "t")
            return history(spark, model, "learning_rate", "train_loss")

        sql = GD.format(lr=f"({formula.format('e')})", slope="0.0", epochs=24) + (
            f" SELECT e AS epoch, round({formula.format('e - 1')}, 6)::DOUBLE AS learning_rate, "
            f"round({LOSS}, 6) AS train_loss FROM gd, s WHERE e > 0"
        )
        query(f"f11_schedule_{kind}", sql)(compute)


_register_schedules()


@query(
    "f12_stopping_rule",
    f"""WITH RECURSIVE {LI}, {MOMENTS}, gd(e, w, b) AS (
      SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT e + 1, w - 0.6 * (w * qq + b * q1 - qt), b - 0.6 * (w * q1 + b - t1)
      FROM gd, s WHERE e < 40),
    l AS (SELECT e, {LOSS} AS loss FROM gd, s WHERE e > 0),
    watch(e, best, stalled) AS (
      SELECT 0, CAST('inf' AS DOUBLE), 0
      UNION ALL
      SELECT l.e, CASE WHEN best - loss > 0.5 THEN loss ELSE best END,
             CASE WHEN best - loss > 0.5 THEN 0 ELSE stalled + 1 END
      FROM watch JOIN l ON l.e = watch.e + 1 WHERE stalled < 3)
    SELECT l.e AS epoch, round(loss, 6) AS train_loss, true AS converged
    FROM l JOIN watch USING (e)""",
)
def f12(spark, d):
    spec = LinearRegression(
        solver="gradient_descent", learning_rate=0.6, max_iter=40, tol=0.5, n_iter_no_change=3
    )
    model = fit(spec, lineitems(spark, d), ["q"], "t")
    return history(spark, model, "train_loss").withColumn("converged", F.lit(model.converged))


@query(
    "f12_stopping_rule_gradient",
    GD.format(lr=0.7, slope="0.0", epochs=60)
    + f""", stop AS (SELECT min(e) AS e FROM gd WHERE e > 0 AND norm <= 0.01)
    SELECT gd.e AS epoch, round({LOSS}, 6) AS train_loss, round(norm, 6) AS grad_norm,
    true AS converged FROM gd, s, stop WHERE gd.e > 0 AND gd.e <= stop.e""",
)
def f12_gradient(spark, d):
    spec = LinearRegression(
        solver="gradient_descent", learning_rate=0.7, max_iter=60, tol=0.0, gradient_tol=0.01,
        n_iter_no_change=60,
    )
    model = fit(spec, lineitems(spark, d), ["q"], "t")
    return history(spark, model, "train_loss", "grad_norm").withColumn(
        "converged", F.lit(model.converged)
    )


@query(
    "r09_default_score_regressor",
    f"WITH {LI} SELECT round(regr_r2(t, q), 9) AS score FROM li",
)
def r09(spark, d):
    rows = lineitems(spark, d)
    model = fit(LinearRegression(), rows, ["q"], "t")
    return score(rows, model, "t").select(rounded("score", 9).alias("score"))
