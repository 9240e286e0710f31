"""Sources, checks, encoders, column functions and losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfold.functions import losses, scalar
from sparkfold.operators import checks, encode
from sparkfold.operators.fit import Job, fit, fit_all
from sparkfold.operators.score import predict
from sparkfold.operators.specs import LinearRegression
from sparkfold.runtime import scratch_path
from sparkfold.sources import models as model_table
from sparkfold.sources import tables
from workloads.base import (
    DOC,
    EV,
    LI,
    OD,
    documents,
    embeddings,
    events,
    lineitems,
    orders,
    query,
    rounded,
    table,
)

# --- sources -----------------------------------------------------------------------------------


@query(
    "s01_load_dataset",
    "SELECT o_orderkey, o_totalprice, CAST(o_custkey AS BIGINT) AS o_custkey FROM orders",
)
def s01(spark, d):
    return tables.load_dataset(
        spark, f"{d}/orders.parquet", ["o_totalprice"], "o_custkey", "o_orderkey"
    )


@query(
    "s01_load_dataset_array",
    """SELECT vec_id, CAST(label AS BIGINT) AS label, len(embedding) AS width,
       round(CAST(embedding[1] AS DOUBLE), 9) AS first_value FROM embeddings""",
)
def s01_array(spark, d):
    loaded = tables.load_dataset(
        spark, f"{d}/embeddings.parquet", "embedding", "label", "vec_id"
    )
    return loaded.select(
        "vec_id", "label", F.size("embedding").cast("long").alias("width"),
        rounded(F.get("embedding", F.lit(0)), 9).alias("first_value"),
    )


@query("s02_ingest", f"WITH {EV} SELECT id, value, p, CAST(y AS BIGINT) AS y FROM ev")
def s02(spark, d):
    path = scratch_path(spark, "ingested")
    return tables.ingest(events(spark, d), ["value", "p"], "y", "id", path)


@query(
    "s03_dataset_summary",
    f"""WITH {OD} SELECT y3 AS label, count(*) AS n,
        CAST(sum(count(*)) OVER () AS BIGINT) AS n_samples, 2 AS n_features
        FROM od GROUP BY y3""",
)
def s03(spark, d):
    return tables.dataset_summary(orders(spark, d), ["x1", "x2"], "y3")


LINE = "regr_slope(t, q) AS slope, regr_intercept(t, q) AS icept"


@query(
    "s04_save_models",
    f"""WITH {LI}, s AS (SELECT count(*) AS n, avg(q) AS mq, avg(t) AS mt,
          covar_pop(q, t) * count(*) AS sqt, var_pop(q) * count(*) AS sqq FROM li),
        m AS (SELECT version, sqt / (sqq + l2) AS slope, mt - mq * sqt / (sqq + l2) AS icept
          FROM s, (VALUES ('l2=0.0', 0.0), ('l2=1000.0', 1000.0), ('l2=50000.0', 50000.0))
          AS v(version, l2))
        SELECT 'price-line' AS model_id, version, 'weights' AS param, 0 AS position,
               round(slope, 6) AS value FROM m
        UNION ALL SELECT 'price-line', version, 'bias', 0, round(icept, 6) FROM m""",
)
def s04(spark, d):
    strengths = [0.0, 1000.0, 50000.0]
    jobs = [Job(LinearRegression(penalty="l2", regularization_strength=s)) for s in strengths]
    fitted = fit_all(jobs, lineitems(spark, d), ["q"], "t")
    path = scratch_path(spark, "models")
    stored = [
        model_table.StoredModel(
            m, model_table.describe(m, {"model_name": "price-line", "version": f"l2={s}"})
        )
        for m, s in zip(fitted, strengths, strict=True)
    ]
    model_table.save_models(spark, stored, path)
    saved = spark.read.schema(model_table.PARAMETERS).parquet(f"{path}/parameters")
    return saved.select(
        "model_id", "version", "param", F.get("idx", F.lit(0)).alias("position"),
        rounded("value").alias("value"),
    )


@query(
    "s05_load_model",
    f"""WITH {OD}, m AS (SELECT regr_slope(t, x2) AS slope, regr_intercept(t, x2) AS icept FROM od)
        SELECT id, round(x2 * slope + icept, 6) AS prediction FROM od, m""",
)
def s05(spark, d):
    rows = orders(spark, d)
    path = scratch_path(spark, "models")
    model_table.save_model(
        spark, fit(LinearRegression(), rows, ["x2"], "t"), path,
        {"model_name": "orders", "version": "1"},
    )
    loaded = model_table.load_model(spark, path, "orders", "1")
    return predict(rows, loaded.model).select("id", rounded("prediction").alias("prediction"))


# --- checks ------------------------------------------------------------------------------------

NOT_FINITE = "({0} IS NULL OR isnan({0}) OR isinf({0}))"


@query(
    "v01_feature_check",
    f"""WITH f AS (SELECT nullif(l_discount, 0) AS a,
          CASE WHEN l_tax = 0 THEN CAST('nan' AS DOUBLE) WHEN l_quantity > 49
               THEN CAST('inf' AS DOUBLE) ELSE l_tax END AS b FROM lineitem)
        SELECT count(*) AS n_rows, count(*) FILTER ({NOT_FINITE.format('a')}
          OR {NOT_FINITE.format('b')}) AS bad_features FROM f""",
)
def v01(spark, d):
    dirty = table(spark, d, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("a"),
        F.when(F.col("l_tax") == 0, float("nan"))
        .when(F.col("l_quantity") > 49, float("inf"))
        .otherwise(F.col("l_tax")).alias("b"),
    )
    return checks.check_counts(dirty, checks.feature_checks(["a", "b"]))


@query(
    "v01_feature_check_array",
    """SELECT count(*) AS n_rows, count(*) FILTER (embedding[1] < 0) AS bad_features,
       CAST(min(len(embedding)) AS INTEGER) AS min_width,
       CAST(max(len(embedding)) AS INTEGER) AS max_width FROM embeddings""",
)
def v01_array(spark, d):
    nan_first = F.transform(
        "embedding",
        lambda v, i: F.when((i == 0) & (v < 0), float("nan")).otherwise(v.cast("double")),
    )
    dirty = embeddings(spark, d).withColumn("embedding", nan_first)
    return checks.check_counts(dirty, checks.feature_checks("embedding"))


@query(
    "v02_target_check",
    "SELECT count(*) FILTER (l_discount = 0) AS bad_targets FROM lineitem",
)
def v02(spark, d):
    dirty = table(spark, d, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("target")
    )
    return checks.check_counts(dirty, checks.target_checks("target"))


@query(
    "v03_binary_check",
    f"""WITH {OD} SELECT count(*) FILTER (y NOT IN (0, 1)) AS binary_bad,
        count(*) FILTER (y3 NOT IN (0, 1)) AS not_binary FROM od""",
)
def v03(spark, d):
    rows = orders(spark, d)
    both = {
        "binary_bad": checks.binary_checks("y")["not_binary"],
        **checks.binary_checks("y3"),
    }
    return checks.check_counts(rows, both)


@query(
    "v04_class_check",
    """SELECT CAST(min(quality) AS BIGINT) AS min_label, CAST(max(quality) AS BIGINT) AS max_label,
       count(DISTINCT quality) AS n_classes FROM labels""",
)
def v04(spark, d):
    rows = table(spark, d, "labels").select(F.col("quality").cast("long").alias("label"))
    checks.require_class_type(rows, "label")
    return checks.check_counts(
        rows, checks.class_checks("label") | {"n_classes": F.count_distinct("label")}
    )


@query(
    "v05_weight_check",
    """SELECT count(*) FILTER (o_orderkey % 5 = 0) AS bad_weights,
       count(*) FILTER (o_orderkey % 5 <> 0 AND o_totalprice < 100000) AS negative_weights,
       round(sum(CASE WHEN o_orderkey % 5 <> 0 THEN (o_totalprice - 100000) / 1000000 END), 4)
       AS weight_total FROM orders""",
)
def v05(spark, d):
    weight = F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_totalprice") - 100000) / 1000000)
    dirty = table(spark, d, "orders").select(weight.alias("weight"))
    counts = checks.check_counts(dirty, checks.weight_checks("weight"))
    return counts.withColumn("weight_total", rounded("weight_total", 4))


@query(
    "v06_width_check",
    "SELECT count(*) FILTER (len(embedding) - label % 2 <> 64) AS wrong_width FROM embeddings",
)
def v06(spark, d):
    shorter = F.slice("embedding", F.lit(1), F.size("embedding") - F.col("label") % 2)
    rows = embeddings(spark, d).withColumn("embedding", shorter)
    return checks.check_counts(rows, checks.width_checks("embedding", 64))


@query(
    "v07_probability_check",
    f"""WITH {EV} SELECT count(*) FILTER (value / 400 > 1) AS outside_unit,
        CAST(0 AS BIGINT) AS bad_probabilities, CAST(0 AS BIGINT) AS too_few_columns,
        count(*) FILTER (CAST(value AS INTEGER) % 3 = 2) AS unknown_labels FROM ev""",
)
def v07(spark, d):
    # DuckDB rounds when it casts to an integer, so the label rounds here too
    rows = events(spark, d).select(
        F.bround("value").cast("int").alias("whole"),
        F.array(1 - F.col("value") / 400, F.col("value") / 400).alias("proba"),
    )
    rows = rows.withColumn("label", F.col("whole") % 3)
    return checks.check_counts(rows, checks.probability_checks("proba", "label", [0, 1]))


@query(
    "v07_unknown_labels",
    """SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS label FROM lineitem
       WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
)
def v07_labels(spark, d):
    known = table(spark, d, "supplier").filter(F.col("s_acctbal") > 0)
    return checks.unknown_labels(
        table(spark, d, "lineitem"), "l_suppkey", known, "s_suppkey"
    )


# --- encoders ----------------------------------------------------------------------------------


@query(
    "e01_label_table",
    """SELECT CAST(ascii(o_orderstatus) AS BIGINT) AS label,
       CAST(row_number() OVER (ORDER BY ascii(o_orderstatus)) - 1 AS INTEGER) AS index
       FROM orders GROUP BY o_orderstatus""",
)
def e01(spark, d):
    rows = table(spark, d, "orders").select(F.ascii("o_orderstatus").alias("code"))
    return encode.label_table(rows, "code")


@query(
    "e01_label_index",
    """SELECT l_orderkey, l_suppkey, CAST(dense_rank() OVER (ORDER BY l_suppkey) - 1 AS INTEGER)
       AS label_index FROM lineitem""",
)
def e01_rows(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    return encode.add_label_index(rows, "l_suppkey")


@query(
    "e02_one_hot",
    f"""WITH {OD} SELECT id, CAST(y3 = 0 AS DOUBLE) AS h0, CAST(y3 = 1 AS DOUBLE) AS h1,
        CAST(y3 = 2 AS DOUBLE) AS h2, CAST(0 AS DOUBLE) AS h3 FROM od""",
)
def e02(spark, d):
    rows = orders(spark, d).select("id", scalar.one_hot("y3", 4).alias("h"))
    return rows.select("id", *[F.get("h", F.lit(i)).alias(f"h{i}") for i in range(4)])


@query(
    "e03_class_weight_balanced",
    """SELECT CAST(quality AS BIGINT) AS label, count(*) AS n,
       round((SELECT count(*) FROM labels) / (2.0 * count(*)), 9) AS class_weight
       FROM labels GROUP BY quality""",
)
def e03(spark, d):
    weights = encode.class_weight_table(table(spark, d, "labels"), "quality", "balanced")
    return weights.withColumn("class_weight", rounded("class_weight", 9))


@query(
    "e03_class_weight_explicit",
    f"""WITH {OD} SELECT CAST(y3 AS BIGINT) AS label, count(*) AS n,
        CASE y3 WHEN 1 THEN 2.5 ELSE 1.0 END::DOUBLE AS class_weight FROM od GROUP BY y3""",
)
def e03_explicit(spark, d):
    return encode.class_weight_table(orders(spark, d), "y3", {1: 2.5})


@query(
    "e04_effective_weight",
    f"""WITH {DOC}, c AS (SELECT y, (SELECT count(*) FROM doc) / (2.0 * count(*)) AS cw
          FROM doc GROUP BY y)
        SELECT id, y, round(w * cw, 6) AS effective_weight FROM doc JOIN c USING (y)""",
)
def e04(spark, d):
    weighted = encode.add_effective_weight(
        documents(spark, d), "y", weight="w", class_weight="balanced"
    )
    return weighted.select("id", "y", rounded("effective_weight").alias("effective_weight"))


# --- column functions --------------------------------------------------------------------------


@query(
    "c01_sigmoid",
    f"""WITH {OD} SELECT id, round(1 / (1 + exp(-greatest(least(x1 * 3, 500.0), -500.0))), 9)
        AS small, round(1 / (1 + exp(-greatest(least(x1 * 1000, 500.0), -500.0))), 9) AS large
        FROM od""",
)
def c01(spark, d):
    x = F.col("x1")
    return orders(spark, d).select(
        "id", rounded(scalar.sigmoid(x * 3), 9).alias("small"),
        rounded(scalar.sigmoid(x * 1000), 9).alias("large"),
    )


LOGITS = "[x1, x2 * 400, pr - 3.0]"


def _logits():
    return F.array(F.col("x1"), F.col("x2") * 400, F.col("pr") - 3.0)


@query(
    "c02_softmax",
    f"""WITH {OD}, z AS (SELECT id, {LOGITS} AS z FROM od),
        e AS (SELECT id, list_transform(z, lambda v: exp(v - list_max(z))) AS e FROM z)
        SELECT id, round(e[1] / list_sum(e), 9) AS s0, round(e[2] / list_sum(e), 9) AS s1,
               round(e[3] / list_sum(e), 9) AS s2 FROM e""",
)
def c02(spark, d):
    rows = orders(spark, d).select("id", scalar.softmax(_logits()).alias("s"))
    return rows.select("id", *[rounded(F.get("s", F.lit(i)), 9).alias(f"s{i}") for i in range(3)])


@query(
    "c03_log_sum_exp",
    f"""WITH {OD}, z AS (SELECT id, {LOGITS} AS z FROM od)
        SELECT id, round(list_max(z) + ln(list_sum(list_transform(z,
               lambda v: exp(v - list_max(z))))), 6) AS lse FROM z""",
)
def c03(spark, d):
    return orders(spark, d).select("id", rounded(scalar.log_sum_exp(_logits())).alias("lse"))


@query(
    "c03_log_sum_exp_grouped",
    f"""WITH {OD}, m AS (SELECT y3, p3, max(x2 * 900) AS top FROM od GROUP BY y3, p3)
        SELECT y3, p3, round(max(top) + ln(sum(exp(x2 * 900 - top))), 6) AS lse
        FROM od JOIN m USING (y3, p3) GROUP BY y3, p3""",
)
def c03_grouped(spark, d):
    rows = orders(spark, d).withColumn("z", F.col("x2") * 900)
    result = scalar.grouped_log_sum_exp(rows, ["y3", "p3"], "z", "lse")
    return result.withColumn("lse", rounded("lse"))


@query(
    "c04_clip_probability",
    f"""WITH {EV} SELECT id, greatest(least(p, 1 - 0.2), 0.2) AS wide,
        greatest(least(p - 0.5, 1 - 1e-15), 1e-15) AS narrow FROM ev""",
)
def c04(spark, d):
    return events(spark, d).select(
        "id", scalar.clip_probability("p", 0.2).alias("wide"),
        scalar.clip_probability(F.col("p") - 0.5).alias("narrow"),
    )


@query(
    "c05_l2_norm",
    """SELECT vec_id AS id, round(sqrt(list_sum(list_transform(embedding,
         lambda v: CAST(v AS DOUBLE) * v))), 5) AS norm,
       round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * v)), 5) AS squared
       FROM embeddings""",
)
def c05(spark, d):
    rows = embeddings(spark, d).withColumn("v", F.col("embedding").cast("array<double>"))
    return rows.select(
        "id", rounded(scalar.l2_norm("v"), 5).alias("norm"),
        rounded(scalar.squared_l2_norm("v"), 5).alias("squared"),
    )


@query(
    "c05_l2_norm_column",
    f"WITH {LI} SELECT round(sqrt(sum(q * q)), 6) AS norm FROM li",
)
def c05_column(spark, d):
    return lineitems(spark, d).agg(rounded(scalar.column_l2_norm("q")).alias("norm"))


@query(
    "c06_activations",
    f"""WITH {OD} SELECT id, greatest(x1, 0) + 0.0 AS relu,
        CASE WHEN x1 > 0 THEN x1 ELSE x1 * 0.01 END AS leaky,
        round(1 / (1 + exp(-x1)), 9) AS logistic, round(tanh(x1), 9) AS hyperbolic FROM od""",
)
def c06(spark, d):
    arr = F.array("x1")
    names = {"relu": "relu", "leaky_relu": "leaky", "sigmoid": "logistic", "tanh": "hyperbolic"}
    rows = orders(spark, d).select(
        "id", *[scalar.activate(k, arr).alias(v) for k, v in names.items()]
    )
    first = {v: F.get(v, F.lit(0)) for v in names.values()}
    return rows.select(
        "id", (first["relu"] + 0.0).alias("relu"), first["leaky"].alias("leaky"),
        rounded(first["logistic"], 9).alias("logistic"),
        rounded(first["hyperbolic"], 9).alias("hyperbolic"),
    )


@query(
    "c07_linear_score",
    f"WITH {OD} SELECT id, round(x1 * 0.7 + x2 * -1.3 + 0.25, 9) AS score FROM od",
)
def c07(spark, d):
    value = scalar.linear_score(["x1", "x2"], [0.7, -1.3], 0.25)
    return orders(spark, d).select("id", rounded(value, 9).alias("score"))


RAMP = [round(0.05 * (i % 7) - 0.1, 2) for i in range(64)]


@query(
    "c07_linear_score_array",
    f"""SELECT vec_id AS id, round(list_sum(list_transform(list_zip(embedding, {RAMP}),
        lambda v: CAST(v[1] AS DOUBLE) * CAST(v[2] AS DOUBLE))) + 0.5, 6) AS score
        FROM embeddings""",
)
def c07_array(spark, d):
    rows = embeddings(spark, d).withColumn("v", F.col("embedding").cast("array<double>"))
    return rows.select("id", rounded(scalar.linear_score("v", RAMP, 0.5)).alias("score"))


@query(
    "c08_dense_layer",
    f"""WITH {OD} SELECT id, round(x1 * 0.5 + x2 * -0.25 + 0.1, 9) AS u0,
        round(x1 * -1.5 + x2 * 2.0 - 0.2, 9) AS u1 FROM od""",
)
def c08(spark, d):
    layer = scalar.dense_array(F.array("x1", "x2"), [[0.5, -1.5], [-0.25, 2.0]], [0.1, -0.2])
    rows = orders(spark, d).select("id", layer.alias("u"))
    return rows.select("id", *[rounded(F.get("u", F.lit(i)), 9).alias(f"u{i}") for i in range(2)])


# --- losses ------------------------------------------------------------------------------------


@query(
    "a01_weighted_mean",
    f"WITH {LI} SELECT round(sum(t * w) / sum(w), 6) AS weighted, round(avg(t), 6) AS plain FROM li",
)
def a01(spark, d):
    return lineitems(spark, d).agg(
        rounded(losses.weighted_mean("t", "w")).alias("weighted"),
        rounded(losses.weighted_mean("t")).alias("plain"),
    )


@query(
    "a02_mse_loss",
    f"""WITH {LI}, e AS (SELECT (t - (50 + 2 * q)) ^ 2 AS e, w FROM li)
        SELECT round(sum(e * w) / sum(w), 5) AS weighted, round(avg(e), 5) AS plain FROM e""",
)
def a02(spark, d):
    guess = 50 + 2 * F.col("q")
    return lineitems(spark, d).agg(
        rounded(losses.mse_loss("t", guess, "w"), 5).alias("weighted"),
        rounded(losses.mse_loss("t", guess), 5).alias("plain"),
    )


@query(
    "a03_binary_cross_entropy",
    f"""WITH {EV}, e AS (SELECT -(y * ln(greatest(least(p, 1 - 1e-15), 1e-15)) + (1 - y)
          * ln(1 - greatest(least(p, 1 - 1e-15), 1e-15))) AS e, value AS w FROM ev)
        SELECT round(sum(e * w) / sum(w), 6) AS weighted, round(avg(e), 6) AS plain FROM e""",
)
def a03(spark, d):
    return events(spark, d).agg(
        rounded(losses.binary_cross_entropy("y", "p", "value")).alias("weighted"),
        rounded(losses.binary_cross_entropy("y", "p")).alias("plain"),
    )


@query(
    "a04_categorical_cross_entropy",
    f"""WITH {OD}, z AS (SELECT y3, t AS w, [x1, x2, pr - 3.0] AS z FROM od),
        e AS (SELECT y3, w, list_transform(z, lambda v: exp(v - list_max(z))) AS e FROM z),
        l AS (SELECT w, -ln(greatest(least(e[y3 + 1] / list_sum(e), 1 - 1e-15), 1e-15)) AS l FROM e)
        SELECT round(sum(l * w) / sum(w), 6) AS weighted, round(avg(l), 6) AS plain FROM l""",
)
def a04(spark, d):
    proba = scalar.softmax(F.array(F.col("x1"), F.col("x2"), F.col("pr") - 3.0))
    rows = orders(spark, d).withColumn("proba", proba)
    return rows.agg(
        rounded(losses.categorical_cross_entropy("y3", "proba", "t")).alias("weighted"),
        rounded(losses.categorical_cross_entropy("y3", "proba")).alias("plain"),
    )


@query(
    "a05_objective_l2",
    f"""WITH {LI} SELECT round(sum(0.5 * (t - (50 + 2 * q - 1.5 * d)) ^ 2 * w) / sum(w)
        + 300 * (2 * 2 + 1.5 * 1.5) / (2 * sum(w)), 5) AS objective FROM li""",
)
def a05(spark, d):
    rows = lineitems(spark, d)
    weights = [2.0, -1.5]
    row_loss = 0.5 * losses.squared_error("t", scalar.linear_score(["q", "d"], weights, 50.0))
    result = losses.objective(
        rows, row_loss, weights, penalty="l2", strength=300.0, weight="w"
    )
    return result.withColumn("objective", rounded("objective", 5))


@query(
    "a05_objective_l1",
    f"""WITH {OD}, e AS (SELECT y, 1 / (1 + exp(-(0.4 * x1 - 0.8 * x2 + 0.1))) AS p FROM od)
        SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))) + 25 * (0.4 + 0.8) / count(*), 6)
        AS objective FROM e""",
)
def a05_l1(spark, d):
    weights = [0.4, -0.8]
    p = scalar.sigmoid(scalar.linear_score(["x1", "x2"], weights, 0.1))
    rows = orders(spark, d).withColumn("p", p)
    result = losses.objective(
        rows, losses.binary_entropy("y", "p"), weights, penalty="l1", strength=25.0
    )
    return result.withColumn("objective", rounded("objective"))


@query(
    "e01_label_index_customers",
    """SELECT o_orderkey, o_custkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER)
       AS label_index FROM orders""",
)
def e01_customers(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return encode.add_label_index(rows, "o_custkey")


@query(
    "e02_one_hot_default_width",
    f"""WITH {OD} SELECT id, CAST(pr = 0 AS DOUBLE) AS h0, CAST(pr = 1 AS DOUBLE) AS h1,
        CAST(pr = 5 AS DOUBLE) AS h5, (SELECT CAST(max(pr) + 1 AS INTEGER) FROM od) AS width
        FROM od""",
)
def e02_default(spark, d):
    rows = encode.add_one_hot(orders(spark, d).select("id", "pr"), "pr", "h")
    return rows.select(
        "id", *[F.get("h", F.lit(i)).alias(f"h{i}") for i in (0, 1, 5)], F.size("h").alias("width")
    )


@query(
    "e03_class_weight_customers",
    """SELECT o_custkey AS label, count(*) AS n, round((SELECT count(*) FROM orders)
         / ((SELECT count(DISTINCT o_custkey) FROM orders) * CAST(count(*) AS DOUBLE)), 9)
         AS class_weight FROM orders GROUP BY o_custkey""",
)
def e03_customers(spark, d):
    weights = encode.class_weight_table(table(spark, d, "orders"), "o_custkey", "balanced")
    return weights.withColumn("class_weight", rounded("class_weight", 9))
