import json
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.helpers import rows_cls, rows_reg, spark_error

from sparkfold.operators import fit as fitting
from sparkfold.operators import metrics, splits
from sparkfold.operators.fit import fit
from sparkfold.operators.models import Model
from sparkfold.operators.score import (
    monitor_columns,
    predict,
    predict_proba,
    score_batch,
    score_monitor,
    write_scored,
)
from sparkfold.operators.specs import (
    LinearRegression,
    LogisticRegression,
    MeanTarget,
    MLPClassifier,
    MLPRegressor,
)
from sparkfold.plans import jobs, search
from sparkfold.runtime import scratch_path, scratch_root
from sparkfold.sources import models as model_table
from sparkfold.sources import tables
from sparkfold.streaming import scoring as streaming

POINTS = [[v] for v in (0, 0.2, 0.4, 0.8, 1.2, 1.8, 2.2, 2.8)]
LABELS = [0] * 4 + [1] * 4


def eight(spark):
    return rows_cls(spark, POINTS, LABELS)


# --- search ------------------------------------------------------------------------------------


def test_grid_search_finds_the_better_rate(spark):
    result = search.grid_search(
        LogisticRegression(max_iter=12), {"learning_rate": [0.01, 0.3]}, eight(spark),
        "features", "label", "id", cv=4, stratified=True, seed=3,
    )
    assert result.best_params == {"learning_rate": 0.3} and result.best_score >= 0.75
    assert result.scores.count() == 8 and result.best_model.classes == [0, 1]


def test_stacked_folds_equal_separate_fits(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(40, 2)), rng.integers(0, 3, 40)
    df = rows_cls(spark, x, y)
    spec = LogisticRegression(
        learning_rate=0.5, max_iter=6, early_stopping=True, validation_fraction=0.2, seed=4
    )
    folded = search.with_folds(df, "id", "label", 3, False, 7)
    scores = {
        r["fold"]: r["score"] for r in search.cross_val_score(
            spec, df, "features", "label", "id", cv=3, seed=7
        ).collect()
    }
    for fold in range(2):
        train, test = (folded.filter(F.col("_cv_fold") == fold if own else
                                     F.col("_cv_fold") != fold) for own in (False, True))
        model = fit(spec, train, "features", "label", id_col="id")
        alone = metrics.accuracy(predict(test, model), "label", "prediction").first()[0]
        assert scores[fold] == pytest.approx(alone)


def test_a_fold_may_miss_a_class(spark):
    df = rows_cls(spark, [[v] for v in range(5)], [0] * 2 + [1] * 2 + [2])
    scores = search.cross_val_score(
        LogisticRegression(learning_rate=0.3, max_iter=4), df, "features", "label", "id",
        cv=5, seed=1,
    )
    assert scores.count() == 5


def test_regression_search_with_a_callable(spark):
    x = np.linspace(0, 1, 20)
    df = rows_reg(spark, [[v] for v in x], 3 * x)
    result = search.grid_search(
        LinearRegression(penalty="l2"), {"regularization_strength": [10.0, 0.0]}, df,
        "features", "label", "id", cv=4, scoring=lambda y, p: -F.max(F.abs(y - p)),
    )
    assert result.best_params == {"regularization_strength": 0.0}
    assert result.best_score == pytest.approx(0.0, abs=1e-9)


def test_networks_of_different_shapes_are_searched_together(spark):
    rng = np.random.default_rng(3)
    df = rows_cls(spark, rng.normal(size=(24, 2)), [0, 1, 2] * 8)
    grid = {"hidden_layer_sizes": [(), (3,), (4, 2)], "activation": ["tanh"]}
    spec = MLPClassifier(learning_rate=0.05, max_iter=3, seed=1)
    scores = {
        (r["candidate"], r["fold"]): r["score"] for r in search.grid_search(
            spec, grid, df, "features", "label", "id", cv=2, stratified=True, seed=1
        ).scores.collect()
    }
    folded = search.with_folds(df, "id", "label", 2, True, 1)
    alone = fit(
        MLPClassifier(hidden_layer_sizes=(4, 2), activation="tanh", learning_rate=0.05,
                      max_iter=3, seed=1),
        folded.filter("_cv_fold <> 1"), "features", "label", id_col="id",
    )
    held = predict(folded.filter("_cv_fold = 1"), alone)
    assert len(scores) == 6
    assert scores[(2, 1)] == pytest.approx(
        metrics.accuracy(held, "label", "prediction").first()[0]
    )


@pytest.mark.parametrize("kind", ["classify", "regress"])
def test_sums_give_the_scores_of_rows(spark, monkeypatch, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 2))
    if kind == "classify":
        df = rows_cls(spark, x, (x[:, 0] + rng.normal(size=90) > 0).astype(int) + 1)
        spec, names = LogisticRegression(max_iter=3, learning_rate=0.4, seed=2), ["accuracy", "f1"]
        grid = {"regularization_strength": [0.0, 5.0]}
    else:
        df = rows_reg(spark, x, 3 + x @ [1.0, -2.0] + rng.normal(size=90))
        spec, names = LinearRegression(penalty="l2"), list(search.REGRESSION_SCORERS)
        grid = {"regularization_strength": [0.0, 50.0]}

    def scores(name):
        found = search.grid_search(
            spec, grid, df, "features", "label", "id", cv=3, seed=4, scoring=name
        ).scores.collect()
        return [r["score"] for r in sorted(found, key=lambda r: (r["candidate"], r["fold"]))]

    def by_rows(name):
        def from_rows(fitting, table, folded, features, label, models, scoring, classify, weight):
            rows = search.scored_folds(folded, features, label, models)
            found = search.fold_scores(rows, scoring, classify).collect()
            return {(r["candidate"], r["fold"]): r["score"] for r in found}

        with monkeypatch.context() as patch:
            patch.setattr(search, "fold_scores_of", from_rows)
            return scores(name)

    for name in names:
        wanted = by_rows(name)
        assert scores(name) == pytest.approx(wanted, abs=1e-10)
        with monkeypatch.context() as patch:
            patch.setattr(search, "sums_only", lambda *_: None)
            assert scores(name) == pytest.approx(wanted, abs=1e-10)
            patch.setattr(search, "COMPILED_SCORES", 0)
            assert scores(name) == pytest.approx(wanted, abs=1e-10)


def test_exact_and_constant_targets(spark):
    df = rows_reg(spark, [[v] for v in range(12)], [2.0 * v for v in range(12)])
    scores = search.cross_val_score(LinearRegression(), df, "features", "label", "id", cv=3)
    assert [r["score"] for r in scores.collect()] == pytest.approx([1.0] * 3)
    flat = rows_reg(spark, [[v] for v in range(12)], [7.0] * 12)
    mean = search.cross_val_score(MeanTarget(), flat, "features", "label", "id", cv=3)
    assert [r["score"] for r in mean.collect()] == [1.0] * 3
    with pytest.raises(ValueError, match="positive_label"):
        search.cross_val_score(
            LogisticRegression(max_iter=2), rows_cls(spark, POINTS, [2, 3] * 4), "features", "label",
            "id", cv=2, scoring="f1",
        )


@pytest.mark.parametrize("early", [False, True])
def test_a_search_scans_its_source_once(spark, early):
    seen = spark.sparkContext.accumulator(0)
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rng = np.random.default_rng(2)
    df = rows_cls(spark, rng.normal(size=(40, 2)), [0, 1] * 20)
    source = df.mapInArrow(counted, df.schema)
    result = search.grid_search(
        LogisticRegression(max_iter=2, early_stopping=early), {"learning_rate": [0.1, 0.2]}, source,
        "features", "label", "id", cv=4, stratified=True,
    )
    assert seen.value == 40 and result.best_model.n_iter == 2
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held


def test_more_holdouts_than_mask_bits(spark, monkeypatch):
    monkeypatch.setattr(fitting, "MASK_BITS", 3)
    spec = LogisticRegression(max_iter=2, early_stopping=True, validation_fraction=0.3)
    result = search.grid_search(
        spec, {"learning_rate": [0.1, 0.2]}, eight(spark), "features", "label", "id", cv=2, stratified=True
    )
    monkeypatch.undo()
    again = search.grid_search(
        spec, {"learning_rate": [0.1, 0.2]}, eight(spark), "features", "label", "id", cv=2, stratified=True
    )
    assert [tuple(r) for r in result.scores.collect()] == [tuple(r) for r in again.scores.collect()]
    assert np.array_equal(result.best_model.params["weights"], again.best_model.params["weights"])


def test_random_search_is_repeatable():
    candidates = search.parameter_grid({"a": [1, 2], "b": [3, 4, 5]})
    assert candidates[:4] == [{"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 1, "b": 5},
                              {"a": 2, "b": 3}]
    assert search.draw(candidates, 3, 9) == search.draw(candidates, 3, 9)
    assert len({str(c) for c in search.draw(candidates, 6, 1)}) == 6
    for bad in (0, 7):
        with pytest.raises(ValueError):
            search.draw(candidates, bad, 1)
    for grid in ({}, {"a": []}):
        with pytest.raises(ValueError):
            search.parameter_grid(grid)


def test_unusable_scores_never_win(spark):
    with pytest.raises(RuntimeError, match="usable"):
        search.grid_search(
            LinearRegression(), {"seed": [1]}, rows_reg(spark, POINTS, LABELS), "features",
            "label", "id", cv=2, scoring=lambda y, p: F.max(F.lit(float("nan")) + y * 0),
        )
    with pytest.raises(ValueError, match="scoring"):
        search.cross_val_score(
            LinearRegression(), rows_reg(spark, POINTS, LABELS), "features", "label", "id",
            cv=2, scoring="rank",
        )


# --- model table and jobs ----------------------------------------------------------------------


def test_model_round_trip(spark):
    df = rows_cls(spark, [(0, 0), (0, 1), (1, 0), (1, 1)], [0, 0, 0, 1])
    spec = LogisticRegression(learning_rate=1.0, max_iter=5, class_weight={1: 3.0})
    model = fit(spec, df, "features", "label")
    path = scratch_path(spark, "test-models")
    meta = {"model_name": "gate", "version": "7", "schema_version": 99, "n_features": 5}
    model_table.save_model(spark, model, path, meta, {"accuracy": 0.5})
    model_table.save_model(spark, model, path, {"model_name": "gate", "version": "8"})
    stored = model_table.load_model(spark, path, "gate", "7")
    assert stored.metadata["schema_version"] == 1 and stored.metadata["n_features"] == 2
    assert stored.metrics == {"accuracy": 0.5} and stored.version == "7"
    assert stored.model.settings["class_weight"] == {1: 3.0}
    assert stored.model.history_rows == model.history_rows
    before, after = (
        [r["probability"] for r in predict_proba(df, m).orderBy("id").collect()]
        for m in (model, stored.model)
    )
    assert before == after
    with pytest.raises(ValueError, match="no version"):
        model_table.load_model(spark, path, "gate", "9")
    with pytest.raises(FileNotFoundError):
        model_table.load_model(spark, path + "-missing", "gate", "7")


def test_networks_are_stored_too(spark):
    df = rows_reg(spark, [[v] for v in range(6)], range(6))
    model = fit(MLPRegressor(hidden_layer_sizes=(3,), max_iter=2), df, "features", "label")
    path = scratch_path(spark, "test-models")
    model_table.save_model(spark, model, path, {"model_name": "net", "version": "1"})
    again = model_table.load_model(spark, path, "net", "1").model
    for name, values in model.params.items():
        assert np.array_equal(values, again.params[name])


@pytest.mark.parametrize(
    "change", [{"schema_version": 2}, {"model_type": "tree"}, {"hyperparameters": None}]
)
def test_bad_metadata_is_refused(change):
    good = {"schema_version": 1, "model_type": "logistic", "hyperparameters": {}}
    model_table.check_metadata(good)
    bad = {k: v for k, v in {**good, **change}.items() if v is not None}
    with pytest.raises(ValueError):
        model_table.check_metadata(json.loads(json.dumps(bad)))


def blobs(spark):
    """Two groups of 40 points around (-1, -0.8) and (1, 0.9)."""
    rng = np.random.default_rng(42)
    x = np.vstack([
        rng.normal((-1.0, -0.8), 0.35, (40, 2)), rng.normal((1.0, 0.9), 0.35, (40, 2))
    ])
    rows = [(i, float(a), float(b), int(i >= 40)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, label int").coalesce(1)


def test_train_then_evaluate(spark):
    path = scratch_path(spark, "test-registry")
    raw = blobs(spark)
    table = tables.ingest(raw, ["x1", "x2"], "label", "id", scratch_path(spark, "test-data"))
    spec = LogisticRegression(
        learning_rate=0.2, max_iter=25, regularization_strength=0.01, seed=7
    )
    outcome = jobs.train_job(
        table, ["x1", "x2"], "label", "id", path, spec=spec,
        meta={"model_name": "blobs", "version": "1"},
    )
    report = outcome.report.first().asDict()
    assert report["test_accuracy"] >= 0.9 and report["train_accuracy"] >= 0.9
    assert (report["n_train_samples"], report["n_test_samples"]) == (60, 20)
    again = jobs.evaluate_job(table, "label", "id", path, "blobs", "1").first().asDict()
    assert again["model_version"] == "1"
    for name in ("accuracy", "roc_auc", "pr_auc", "log_loss"):
        assert again[name] == pytest.approx(report[name])
    stored = model_table.load_model(spark, path, "blobs", "1")
    assert stored.metrics["n_train_samples"] == 60


def test_ingest_keeps_what_is_stored(spark):
    path = scratch_path(spark, "test-data")
    first = tables.ingest(blobs(spark), ["x1", "x2"], "label", "id", path)
    second = tables.ingest(blobs(spark).limit(3), ["x1", "x2"], "label", "id", path)
    assert first.count() == second.count() == 80
    assert dict(second.dtypes) == {"id": "bigint", "x1": "double", "x2": "double",
                                   "label": "bigint"}
    summary = tables.dataset_summary(first, ["x1", "x2"], "label").orderBy("label").collect()
    assert [tuple(r) for r in summary] == [(0, 40, 80, 2), (1, 40, 80, 2)]
    bad = blobs(spark).withColumn("x1", F.lit(float("nan")))
    with pytest.raises(ValueError, match="finite"):
        tables.ingest(bad, ["x1", "x2"], "label", "id", scratch_path(spark, "test-data"))


def test_ingest_tells_requests_apart(spark):
    path = scratch_path(spark, "test-data")
    raw = blobs(spark)
    tables.ingest(raw, ["x1", "x2"], "label", "id", path, source="v1")
    for features, options in ((["x1"], {"source": "v1"}), (["x1", "x2"], {"source": "v2"}),
                              (["x1", "x2"], {"source": "v1", "classify": False})):
        with pytest.raises(ValueError, match="another request"):
            tables.ingest(raw, features, "label", "id", path, **options)
    assert tables.ingest(raw, ["x1", "x2"], "label", "id", path, source="v1").count() == 80
    # rows that were added or lost since
    spark.read.parquet(path).limit(5).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="not the one"):
        tables.ingest(raw, ["x1", "x2"], "label", "id", path, source="v1")
    other = scratch_path(spark, "test-data")
    raw.write.parquet(other)
    with pytest.raises(ValueError, match="no ingest"):
        tables.ingest(raw, ["x1", "x2"], "label", "id", other)
    assert spark.read.parquet(other).count() == 80


def test_an_interrupted_ingest_is_made_anew(spark):
    path, seen = scratch_path(spark, "test-data"), spark.sparkContext.accumulator(0)

    def counted(batches, fail):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
        if fail:
            raise RuntimeError("the job dies here")

    raw = blobs(spark)
    with spark_error("dies here"):
        tables.ingest(raw.mapInArrow(lambda b: counted(b, True), raw.schema), ["x1", "x2"], "label", "id", path)
    with pytest.raises(ValueError, match="finite"):
        tables.ingest(raw.withColumn("x1", F.lit(float("inf"))), ["x1", "x2"], "label", "id", path)
    seen.value = 0
    table = tables.ingest(
        raw.mapInArrow(lambda b: counted(b, False), raw.schema), ["x1", "x2"], "label", "id", path
    )
    assert table.count() == 80 and seen.value == 80


def test_invalid_rows_are_scored_in_one_scan(spark, tmp_path):
    rows = [(i, float(i), None if i % 3 == 0 else 1.0, "kept") for i in range(30)]
    spark.createDataFrame(rows, "id long, a double, prediction double, `_bad` string").write.parquet(
        str(tmp_path / "in")
    )
    df = spark.read.parquet(str(tmp_path / "in"))
    for size in (1, 600):
        names = ["a", "prediction"]
        params = {"weights": np.ones(2), "bias": np.zeros(1)} | ({"pad": np.ones(600)} if size > 1 else {})
        model = Model("logistic", names, 2, params, [0, 1], {"threshold": 0.5})
        scored = score_batch(df, model, "v", invalid="null")
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Union" not in plan
        got = {r["id"]: (r["prediction"], r["_bad"]) for r in scored.collect()}
        assert got == {i: (None if i % 3 == 0 else 1, "kept") for i in range(30)}


def test_monitor_folders_are_merged(spark, tmp_path):
    start = 1_700_000_000
    schema = "id long, at timestamp, probability double"
    files = [
        # every trigger has rows of its hour, late ones of the hour before and one that is too late
        [(t, start + 3600 * t, 0.1), (t, start + 3600 * t - 1800, 0.5 + t / 200), (t, start - 10**6 + t, 0.9)]
        for t in range(50)
    ]
    source = str(tmp_path / "in")
    for t, rows in enumerate(files):
        df = spark.createDataFrame(rows, "id long, at long, probability double")
        df = df.withColumn("at", F.timestamp_seconds("at")).coalesce(1)
        df.write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    monitor = streaming.monitor_stream(stream, "at", 1, window="1 hour", delay="2 hours")
    out, state = str(tmp_path / "monitor"), str(tmp_path / "state")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        streaming.write_monitor(monitor, out, state, fan=4).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    folders = sorted(p.name for p in (tmp_path / "monitor").glob("level=*/last=*"))
    levels = sorted(p.name for p in (tmp_path / "monitor").glob("level=*"))
    assert len(levels) > 2 and len(folders) < 4 * len(levels)

    def rows(table):
        return sorted(tuple(r) for r in table.selectExpr(
            "window.start", "n_predictions", "probability_min", "round(probability_mean, 12)", "probability_max"
        ).collect())

    batch = spark.read.schema(schema).parquet(source).groupBy(F.window("at", "1 hour").alias("window")).agg(
        *monitor_columns(1)
    )
    late = batch.filter(F.col("window.start") > F.timestamp_seconds(F.lit(start - 7200)))
    assert [r for r in rows(streaming.read_monitor(spark, out)) if r in rows(late)] == rows(late)

    # a trigger that is repeated after its merges changes nothing
    before = rows(streaming.read_monitor(spark, out))
    own = spark.read.parquet(f"{out}/level=2/last=47").filter("epoch = 47")
    assert own.count() > 0
    own.write.parquet(f"{out}/level=0/last=47")
    streaming.merge_levels(spark, out, 47, 4)
    assert rows(streaming.read_monitor(spark, out)) == before
    assert sorted(p.name for p in (tmp_path / "monitor").glob("level=*/last=*")) == folders


def test_scoring_service_rows(spark):
    df = eight(spark)
    model = fit(LogisticRegression(learning_rate=1.0, max_iter=20), df, "features", "label")
    scored = score_batch(df, model, "v3")
    row = score_monitor(scored, model.n_features).first()
    seen = write_scored(df, model, "v3", scratch_path(spark, "test-scored"))
    assert seen == pytest.approx(row.asDict())
    assert row["n_predictions"] == 8 and row["n_features"] == 1
    assert 0 < row["probability_min"] < row["probability_mean"] < row["probability_max"] < 1
    assert scored.select("model_version").distinct().first()[0] == "v3"


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    df = eight(spark).withColumn(
        "at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600)
    )
    model = fit(LogisticRegression(learning_rate=1.0, max_iter=5), df, "features", "label")
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    df.write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    scored = streaming.score_stream(stream, model, "v1")
    assert scored.isStreaming
    streaming.write_scores(scored, sink, str(tmp_path / "c1")).awaitTermination()
    # a second run finds nothing new and adds nothing
    streaming.write_scores(scored, sink, str(tmp_path / "c1")).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(sink).orderBy("id")
           .select("id", "prediction", "probability").collect()]
    assert got == [tuple(r) for r in score_batch(df, model, "v1").orderBy("id")
                   .select("id", "prediction", "probability").collect()]
    monitor = streaming.monitor_stream(scored, "at", 1, window="2 hours", delay="10 minutes")
    out = str(tmp_path / "monitor")
    streaming.write_monitor(monitor, out, str(tmp_path / "c2")).awaitTermination()
    assert streaming.read_monitor(spark, out).agg(F.sum("n_predictions")).first()[0] == 8


class Session:
    """Just enough of a session to name a scratch folder."""

    def __init__(self, master, **settings):
        self.conf = settings
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: None)


def test_scratch_folder_is_the_configured_one():
    cluster = Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/somewhere"})
    assert scratch_root(cluster) == "hdfs:///shared/somewhere"
    assert scratch_path(cluster, "x").startswith("hdfs:///shared/somewhere/x-")
    # never a machine-local folder on a cluster
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session("yarn"))


# --- plans -------------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_shuffled_split_is_a_projection(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey", "o_totalprice")
    plan = plan_of(splits.train_test_split(orders, "o_orderkey", stratify=None))
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan
    plan = plan_of(splits.k_fold(orders, "o_orderkey", shuffle=True))
    assert "Exchange" not in plan and "Join" not in plan


def test_curves_shuffle_rows_once_and_never_into_one_task(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").select(
        F.col("event_id").alias("id"), "value", (F.col("event_type") == "purchase").alias("y"),
        "props",
    ).withColumn("y", F.col("y").cast("int"))
    areas = metrics.curve_areas(events, "y", "value", "id", bucket_rows=100)
    plan = plan_of(areas)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "props" not in plan
    # the only single partitions hold bucket totals and the final sums
    window_below = plan[plan.index("Window"):]
    assert "Exchange hashpartitioning(_b1" in window_below


def test_reports_have_no_cross_join(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").select(
        F.col("event_id").alias("id"), (F.col("value") / 600).alias("p"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
    ).withColumn("yhat", (F.col("p") > 0.5).cast("int"))
    plan = plan_of(metrics.classification_report(events, "y", "yhat", score="p", id_col="id"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scoring_reads_the_features_only(spark, data):
    rows = spark.read.parquet(f"{data}/lineitem.parquet")
    model = fit(LinearRegression(), rows, ["l_quantity"], "l_extendedprice")
    plan = plan_of(predict(rows, model).select("prediction"))
    assert "ReadSchema: struct<l_quantity:double>" in plan
    assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan
