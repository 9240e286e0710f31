"""Evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfold.functions import scalar
from sparkfold.operators import metrics
from workloads.base import (
    ORACLE,
    EV,
    LI,
    OD,
    events,
    lineitems,
    orders,
    query,
    round_columns,
    rounded,
    table,
)

# Per-class counts over the union of true and predicted labels.
STATS = """stats AS (
    SELECT label, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(support) AS support FROM (
      SELECT a AS label, CAST(a = b AS INTEGER) AS tp, 0 AS fp, CAST(a <> b AS INTEGER) AS fn,
             1 AS support FROM pairs
      UNION ALL SELECT b, 0, CAST(a <> b AS INTEGER), 0, 0 FROM pairs) GROUP BY label),
scores AS (
    SELECT *, CASE WHEN tp + fp = 0 THEN {zero} ELSE tp / (tp + fp) END AS p,
           CASE WHEN tp + fn = 0 THEN {zero} ELSE tp / (tp + fn) END AS r FROM stats),
scored AS (
    SELECT *, CASE WHEN p + r = 0 THEN {zero} ELSE 2 * p * r / (p + r) END AS f FROM scores)"""

THREE = f"WITH {OD}, pairs AS (SELECT y3 AS a, p3 AS b FROM od), {STATS.format(zero=0.0)} "
TWO = f"WITH {EV}, pairs AS (SELECT y AS a, yhat AS b FROM ev), {STATS.format(zero=0.0)} "
# predictions that miss a class, and a class that is never true
GAPS = (
    f"WITH {OD}, pairs AS (SELECT y AS a, CASE WHEN pr = 2 THEN 3 ELSE 0 END AS b FROM od), "
    f"{STATS.format(zero=0.5)} "
)


def gaps(spark, d):
    return orders(spark, d).withColumn("yhat", F.when(F.col("pr") == 2, 3).otherwise(0))


@query("m01_accuracy", f"WITH {EV} SELECT round(avg(CAST(y = yhat AS DOUBLE)), 9) AS accuracy FROM ev")
def m01(spark, d):
    return round_columns(metrics.accuracy(events(spark, d), "y", "yhat"), ["accuracy"], 9)


@query(
    "m01_accuracy_by_group",
    """SELECT l_suppkey, round(avg(CAST(trunc(l_quantity / 10) = trunc(l_discount * 50)
       AS DOUBLE)), 9) AS accuracy FROM lineitem GROUP BY l_suppkey""",
)
def m01_by(spark, d):
    # labels given as doubles are truncated toward zero
    rows = table(spark, d, "lineitem").select(
        "l_suppkey", (F.col("l_quantity") / 10).alias("a"), (F.col("l_discount") * 50).alias("b")
    )
    return round_columns(metrics.accuracy(rows, "a", "b", ["l_suppkey"]), ["accuracy"], 9)


@query(
    "m02_confusion_matrix",
    f"""WITH {OD}, pairs AS (SELECT y AS a, CASE WHEN pr = 2 THEN 3 ELSE 0 END AS b FROM od),
        labels AS (SELECT a AS v FROM pairs UNION SELECT b FROM pairs)
        SELECT CAST(t.v AS BIGINT) AS y_true, CAST(p.v AS BIGINT) AS y_pred,
               (SELECT count(*) FROM pairs WHERE a = t.v AND b = p.v) AS n
        FROM labels t, labels p""",
)
def m02(spark, d):
    return metrics.confusion_matrix(gaps(spark, d), "y", "yhat")


@query(
    "m02_confusion_matrix_labels",
    f"""WITH {EV}, labels AS (SELECT unnest([0, 1, 2]) AS v)
        SELECT CAST(t.v AS BIGINT) AS y_true, CAST(p.v AS BIGINT) AS y_pred,
               (SELECT count(*) FROM ev WHERE y = t.v AND yhat = p.v) AS n
        FROM labels t, labels p""",
)
def m02_labels(spark, d):
    return metrics.confusion_matrix(events(spark, d), "y", "yhat", labels=[0, 1, 2])


@query(
    "m02_confusion_display",
    f"""WITH {OD} SELECT CAST(y3 AS BIGINT) AS y_true, count(*) FILTER (p3 = 0) AS "0",
        count(*) FILTER (p3 = 1) AS "1", count(*) FILTER (p3 = 2) AS "2" FROM od GROUP BY y3""",
)
def m02_display(spark, d):
    return metrics.confusion_display(orders(spark, d), "y3", "p3", [0, 1, 2])


@query(
    "m03_class_stats",
    GAPS + """SELECT CAST(label AS BIGINT) AS label, CAST(tp AS BIGINT) AS tp,
    CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(support AS BIGINT) AS support
    FROM stats""",
)
def m03(spark, d):
    return metrics.class_stats(gaps(spark, d), "y", "yhat")


MODES = {
    "binary": "max(CASE WHEN label = 1 THEN {0} END)",
    "macro": "avg({0})",
    "weighted": "sum({0} * support) / sum(support)",
}
MICRO = "(sum(tp) / sum(tp + {0}))"


def _sql_for(source: str, mode: str, name: str) -> str:
    if mode != "micro":
        value = MODES[mode].format({"precision": "p", "recall": "r", "f1": "f"}[name])
    elif name == "f1":
        p, r = MICRO.format("fp"), MICRO.format("fn")
        value = f"2 * {p} * {r} / ({p} + {r})"
    else:
        value = MICRO.format("fp" if name == "precision" else "fn")
    return f"{source} SELECT round({value}, 9) AS {name} FROM scored"


def _register_averages():
    for key, name, run in (
        ("m04_precision", "precision", metrics.precision),
        ("m04_recall", "recall", metrics.recall),
        ("m05_f1", "f1", metrics.f1),
    ):
        for mode in ("binary", "macro", "micro", "weighted"):

            def compute(spark, d, name=name, run=run, mode=mode):
                if mode == "binary":
                    result = run(events(spark, d), "y", "yhat", average=mode)
                else:
                    result = run(orders(spark, d), "y3", "p3", average=mode)
                return round_columns(result, [name], 9)

            query(f"{key}_{mode}", _sql_for(TWO if mode == "binary" else THREE, mode, name))(
                compute
            )


_register_averages()


@query(
    "m05_zero_division",
    GAPS + """SELECT round(avg(p), 9) AS precision, round(avg(r), 9) AS recall,
    round(avg(f), 9) AS f1 FROM scored""",
)
def m05_zero(spark, d):
    result = metrics.precision_recall_f1(
        gaps(spark, d), "y", "yhat", average="macro", zero_division=0.5
    )
    return round_columns(result, result.columns, 9)


@query(
    "m05_scores_by_group",
    f"""WITH {OD}, g AS (SELECT pr, y AS a, CAST(x1 > 0 AS INTEGER) AS b FROM od),
        c AS (SELECT pr, sum(a * b) AS tp, sum((1 - a) * b) AS fp, sum(a * (1 - b)) AS fn
              FROM g GROUP BY pr)
        SELECT pr, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
               round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 9)
               AS f1 FROM c""",
)
def m05_by(spark, d):
    rows = orders(spark, d).withColumn("yhat", (F.col("x1") > 0).cast("int"))
    result = metrics.precision_recall_f1(rows, "y", "yhat", by=["pr"])
    return round_columns(result, ["precision", "recall", "f1"], 9)


CLIPPED = "greatest(least({0}, 1 - 1e-15), 1e-15)"


@query(
    "m06_log_loss",
    f"""WITH {EV} SELECT round(avg(-ln(CASE y WHEN 1 THEN {CLIPPED.format('p')}
        ELSE {CLIPPED.format('(1 - p)')} END)), 9) AS log_loss FROM ev""",
)
def m06(spark, d):
    result = metrics.log_loss(events(spark, d), "y", "p", [0, 1], single=True)
    return round_columns(result, ["log_loss"], 9)


@query(
    "m06_log_loss_matrix",
    f"""WITH {OD}, z AS (SELECT y3, [x1, x2, pr - 3.0, 0.5] AS z FROM od),
        e AS (SELECT y3, list_transform(z, lambda v: exp(v - list_max(z))) AS e FROM z)
        SELECT round(avg(-ln({CLIPPED.format('e[y3 + 1] / list_sum(e)')})), 9) AS log_loss
        FROM e""",
)
def m06_matrix(spark, d):
    # labels 10, 11, 12 by position in the list; the fourth column belongs to no label
    logits = F.array(F.col("x1"), F.col("x2"), F.col("pr") - 3.0, F.lit(0.5))
    rows = orders(spark, d).select(
        (F.col("y3") + 10).alias("label"), scalar.softmax(logits).alias("proba")
    )
    result = metrics.log_loss(rows, "label", "proba", [10, 11, 12])
    return round_columns(result, ["log_loss"], 9)


RANKED = f"""WITH {EV}, r AS (
    SELECT p, y, sum(y) OVER w AS tp, row_number() OVER w AS k FROM ev
    WINDOW w AS (ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING)),
t AS (SELECT sum(y) AS pos, count(*) - sum(y) AS neg, max(p) AS top FROM ev)"""
ABOVE = "top + greatest(1.0, abs(top)) * 2.220446049250313e-16"


@query(
    "m07_roc_curve",
    RANKED + f""" SELECT CAST(k AS BIGINT) AS point, round((k - tp) / neg, 9) AS fpr,
    round(tp / pos, 9) AS tpr, p AS threshold FROM r, t
    UNION ALL SELECT 0, 0.0, 0.0, {ABOVE} FROM t""",
)
def m07(spark, d):
    curve = metrics.roc_curve(events(spark, d), "y", "p", "id")
    return round_columns(curve, ["fpr", "tpr"], 9)


@query(
    "m08_roc_auc",
    RANKED + " SELECT round(sum((1 - y) * tp) / (max(pos) * max(neg)), 9) AS roc_auc FROM r, t",
)
def m08(spark, d):
    return round_columns(metrics.roc_auc(events(spark, d), "y", "p", "id"), ["roc_auc"], 9)


@query(
    "m08_roc_auc_tied_scores",
    f"""WITH {OD}, r AS (SELECT y, sum(y) OVER (ORDER BY pr DESC, id ROWS UNBOUNDED PRECEDING)
          AS tp FROM od)
        SELECT round(sum((1 - y) * tp) / (sum(y) * sum(1 - y)), 9) AS roc_auc FROM r""",
)
def m08_tied(spark, d):
    # five distinct scores for all orders: the order inside a tie is decided by id
    rows = orders(spark, d)
    result = metrics.roc_auc(rows, "y", "pr", "id", bucket_rows=1000)
    return round_columns(result, ["roc_auc"], 9)


@query(
    "m09_pr_curve",
    RANKED + f""" SELECT CAST(k AS BIGINT) AS point, round(tp / k, 9) AS precision,
    round(tp / pos, 9) AS recall, p AS threshold FROM r, t
    UNION ALL SELECT 0, 1.0, 0.0, {ABOVE} FROM t""",
)
def m09(spark, d):
    curve = metrics.pr_curve(events(spark, d), "y", "p", "id", bucket_rows=1500)
    return round_columns(curve, ["precision", "recall"], 9)


@query(
    "m10_pr_auc",
    RANKED + """, s AS (SELECT k, tp / k AS prec, tp / pos AS rec FROM r, t
      UNION ALL SELECT 0, 1.0, 0.0),
    g AS (SELECT prec, rec, lag(prec) OVER (ORDER BY k) AS p0, lag(rec) OVER (ORDER BY k) AS r0
          FROM s)
    SELECT round(sum((rec - r0) * (prec + p0) / 2), 9) AS pr_auc FROM g""",
)
def m10(spark, d):
    return round_columns(metrics.pr_auc(events(spark, d), "y", "p", "id"), ["pr_auc"], 9)


GUESS = f"WITH {LI}, g AS (SELECT t, 50 + 15 * q - d AS f, t - (50 + 15 * q - d) AS e FROM li) "


def guessed(spark, d):
    return lineitems(spark, d).withColumn("f", 50 + 15 * F.col("q") - F.col("d"))


R2 = "1 - sum(e * e) / (var_pop(t) * count(*))"
REGRESSION = {
    "m11_mae": ("mae", "avg(abs(e))"),
    "m12_mse": ("mse", "avg(e * e)"),
    "m12_rmse": ("rmse", "sqrt(avg(e * e))"),
    "m13_r2": ("r2", R2),
    "m14_adjusted_r2": ("adjusted_r2", f"1 - (1 - ({R2})) * (count(*) - 1) / (count(*) - 3)"),
    "m15_explained_variance": ("explained_variance", "1 - var_pop(e) / var_pop(t)"),
}


def _register_regression():
    for key, (name, sql) in REGRESSION.items():

        def compute(spark, d, name=name):
            features = 2 if name == "adjusted_r2" else None
            result = metrics.regression_metric(
                guessed(spark, d), name, "t", "f", n_features=features
            )
            return round_columns(result, [name])

        query(key, f"{GUESS} SELECT round({sql}, 6) AS {name} FROM g")(compute)


_register_regression()


@query(
    "m13_r2_constant_target",
    f"WITH {OD} SELECT p3, CASE p3 WHEN 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS r2 FROM od GROUP BY p3",
)
def m13_constant(spark, d):
    # a constant target: 1 when it is met exactly, 0 otherwise
    rows = orders(spark, d).select(
        "p3", F.lit(0.1).alias("a"), (F.lit(0.1) + F.col("p3") * F.col("x1")).alias("b")
    )
    return metrics.regression_metric(rows, "r2", "a", "b", by=["p3"])


@query(
    "m16_classification_report",
    TWO + f""", ranked AS (
    SELECT y, sum(y) OVER w AS tp, row_number() OVER w AS k FROM ev
    WINDOW w AS (ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING)),
    t AS (SELECT sum(y) AS pos, count(*) - sum(y) AS neg FROM ev),
    cells AS (SELECT y, yhat, count(*) AS n FROM ev GROUP BY y, yhat)
    SELECT round((SELECT avg(CAST(y = yhat AS DOUBLE)) FROM ev), 9) AS accuracy,
      round(avg(p), 9) AS precision_macro, round(avg(r), 9) AS recall_macro,
      round(avg(f), 9) AS f1_macro,
      (SELECT n FROM cells WHERE y = 0 AND yhat = 0) AS c00,
      (SELECT n FROM cells WHERE y = 0 AND yhat = 1) AS c01,
      (SELECT n FROM cells WHERE y = 1 AND yhat = 0) AS c10,
      (SELECT n FROM cells WHERE y = 1 AND yhat = 1) AS c11,
      round((SELECT sum((1 - y) * tp) / (max(pos) * max(neg)) FROM ranked, t), 9) AS roc_auc,
      round((SELECT sum(y * (CASE WHEN k = 1 THEN 1.0 ELSE (tp - 1) / (k - 1) END + tp / k) / 2)
             / max(pos) FROM ranked, t), 9) AS pr_auc
    FROM scored""",
)
def m16(spark, d):
    report = metrics.classification_report(
        events(spark, d), "y", "yhat", score="p", id_col="id"
    )
    cells = {
        f"c{i}{j}": F.get(F.get("confusion_matrix", F.lit(i)), F.lit(j))
        for i in range(2) for j in range(2)
    }
    report = report.withColumns(cells).drop("confusion_matrix", "labels")
    return round_columns(
        report,
        ["accuracy", "precision_macro", "recall_macro", "f1_macro", "roc_auc", "pr_auc"], 9,
    )


@query(
    "m17_regression_report",
    GUESS + "SELECT " + ", ".join(
        f"round({sql}, 6) AS {name}" for name, sql in REGRESSION.values()
    ) + " FROM g",
)
def m17(spark, d):
    report = metrics.regression_report(guessed(spark, d), "t", "f", n_features=2)
    return report.select(*[rounded(c).alias(c) for c in report.columns])


# --- the same answers from many buckets -------------------------------------------------------


@query("m07_roc_curve_bucketed", ORACLE["m07_roc_curve"])
def m07_bucketed(spark, d):
    curve = metrics.roc_curve(events(spark, d), "y", "p", "id", bucket_rows=300)
    return round_columns(curve, ["fpr", "tpr"], 9)


@query("m10_pr_auc_bucketed", ORACLE["m10_pr_auc"])
def m10_bucketed(spark, d):
    result = metrics.pr_auc(events(spark, d), "y", "p", "id", bucket_rows=300)
    return round_columns(result, ["pr_auc"], 9)


@query("m16_classification_report_bucketed", ORACLE["m16_classification_report"])
def m16_bucketed(spark, d):
    report = metrics.classification_report(
        events(spark, d), "y", "yhat", score="p", id_col="id", bucket_rows=300
    )
    cells = {
        f"c{i}{j}": F.get(F.get("confusion_matrix", F.lit(i)), F.lit(j))
        for i in range(2) for j in range(2)
    }
    report = report.withColumns(cells).drop("confusion_matrix", "labels")
    return round_columns(
        report,
        ["accuracy", "precision_macro", "recall_macro", "f1_macro", "roc_auc", "pr_auc"], 9,
    )


@query(
    "m06_log_loss_default_labels",
    """WITH p AS (SELECT label, [CAST((c * 7 + vec_id) % 11 + 1 AS DOUBLE)
         FOR c IN range(10)] AS e FROM embeddings)
       SELECT round(avg(-ln(e[label + 1] / list_sum(e))), 9) AS log_loss FROM p""",
)
def m06_default_labels(spark, d):
    weights = F.transform(
        F.sequence(F.lit(0), F.lit(9)),
        lambda c: ((c * 7 + F.col("vec_id")) % 11 + 1).cast("double"),
    )
    rows = table(spark, d, "embeddings").select("label", weights.alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    rows = rows.select("label", F.transform("e", lambda x: x / total).alias("proba"))
    return round_columns(metrics.log_loss(rows, "label", "proba"), ["log_loss"], 9)
