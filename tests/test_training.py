import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.helpers import rows_cls, rows_reg, spark_error

from sparkfold.operators import linear, passes, training
from sparkfold.operators.fit import Fitting, Job, fit, fit_all
from sparkfold.operators.network import Net, batch_sums, kept, pack, unpack
from sparkfold.operators.score import predict, predict_proba, score
from sparkfold.operators.specs import (
    LinearRegression,
    LogisticRegression,
    MajorityClass,
    MeanTarget,
    MLPClassifier,
    MLPRegressor,
)
from sparkfold.operators.updates import StopRule, Update, scheduled_rate

FEATURES = "features"


def predicted(df, model):
    return [r["prediction"] for r in predict(df, model).orderBy("id").collect()]


# --- updates, schedules, stopping --------------------------------------------------------------


@pytest.mark.parametrize(
    "rule, expected",
    [
        (Update("sgd"), (0.95, -0.975)),
        (Update("momentum"), (0.95, -0.975)),
        (Update("rmsprop", decay=0.0), (0.9, -0.9)),
        (Update("adam", beta1=0.0, beta2=0.0), (0.9, -0.9)),
    ],
)
def test_update_rules(rule, expected):
    moved = rule.move(np.array([1.0, -1.0]), np.array([0.5, -0.25]), 0.1)
    assert moved == pytest.approx(expected, abs=1e-6)


def test_schedules():
    assert scheduled_rate("constant", 0.1, 7, 10) == 0.1
    assert [scheduled_rate("step", 0.1, e, 10, step_every=2) for e in (0, 1, 2)] == [0.1, 0.1, 0.05]
    assert scheduled_rate("cosine", 0.1, 0, 10) == pytest.approx(0.1)
    assert scheduled_rate("cosine", 0.1, 10, 10) == pytest.approx(0.0)
    for bad in (("linear", 0), ("constant", -1)):
        with pytest.raises(ValueError):
            scheduled_rate(bad[0], 0.1, bad[1], 10)


def test_plateau():
    rule, epochs = StopRule(tol=1.0, patience=2, gradient_tol=None), 0
    while True:
        epochs += 1
        if rule.reached(9.0 - 1e-3 * epochs, 1.0):
            break
    assert epochs == 3
    assert StopRule(0.0, 5, 1e-3).reached(1.0, 1e-4)


@pytest.mark.parametrize(
    "spec, change",
    [
        (LinearRegression, {"learning_rate": 0.0}),
        (LinearRegression, {"max_iter": 0}),
        (LinearRegression, {"penalty": "l1"}),
        (LinearRegression, {"penalty": "l3"}),
        (LinearRegression, {"regularization_strength": -1.0}),
        (LogisticRegression, {"threshold": 1.0}),
        (LogisticRegression, {"multi_class": "ovr"}),
        (LogisticRegression, {"tol": -1.0}),
        (LogisticRegression, {"batch_strategy": "half"}),
        (MLPClassifier, {"hidden_layer_sizes": (3, 0)}),
        (MLPClassifier, {"dropout_rate": 1.0}),
        (MLPRegressor, {"activation": "gelu"}),
        (MLPRegressor, {"alpha": -0.1}),
        (MLPRegressor, {"validation_fraction": 1.0}),
    ],
)
def test_bad_settings(spec, change):
    with pytest.raises(ValueError):
        spec(**change)


# --- gradients ---------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "family, shapes, activation",
    [
        ("linear", ((2, 1),), "relu"),
        ("logistic", ((2, 1),), "relu"),
        ("softmax", ((2, 3),), "relu"),
        ("softmax_net", ((2, 4), (4, 3)), "tanh"),
        ("softmax_net", ((2, 4), (4, 3), (3, 3)), "sigmoid"),
        ("mse", ((2, 5), (5, 1)), "relu"),
        ("mse", ((2, 5), (5, 1)), "leaky_relu"),
    ],
)
def test_gradients_against_central_differences(family, shapes, activation):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(9, 2))
    y = rng.integers(0, 2 if family == "logistic" else 3, 9).astype(float)
    block = {"x": x, "y": y, "w": rng.random(9) + 0.5}
    net = Net(family, shapes, activation)
    theta = rng.normal(0, 0.7, net.size)
    gradient = batch_sums([net], [theta], block, 0)[4:]
    for i in range(net.size):
        step = np.zeros(net.size)
        step[i] = 1e-6
        up, down = (batch_sums([net], [theta + s], block, 0)[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-4)


def test_stacked_models_equal_single_ones():
    rng = np.random.default_rng(2)
    n = 40
    block = {
        "x": rng.normal(size=(n, 3)), "y": rng.integers(0, 3, n).astype(float),
        "fold": rng.integers(0, 2, n), "vmask": rng.integers(0, 4, n), "key": np.arange(n),
    }
    nets = [
        Net("softmax", ((3, 3),), fold=0, bit=1),
        Net("softmax_net", ((3, 4), (4, 3)), "tanh", dropout=0.3, fold=1, bit=0),
        Net("softmax_net", ((3, 5), (5, 3)), class_weight=np.array([1.0, 2.0, 0.5])),
    ]
    thetas = [rng.normal(size=net.size) for net in nets]
    together = batch_sums(nets, thetas, block, 3)
    apart = np.concatenate([
        batch_sums([net], [theta], block, 3) for net, theta in zip(nets, thetas)
    ])
    assert np.allclose(together, apart, atol=1e-12)
    # masked rows do not count: the same as leaving them out
    own = (block["fold"] != 0) & (block["vmask"] & 2 == 0)
    alone = batch_sums(
        [Net("softmax", ((3, 3),))], [thetas[0]],
        {"x": block["x"][own], "y": block["y"][own]}, 3,
    )
    assert np.allclose(together[:2], alone[:2]) and np.allclose(together[4:16], alone[4:])


def test_dropout_mask_depends_on_the_row_only():
    keys = np.arange(4000, dtype=np.int64)
    whole = kept(keys, 6, 0.25, (1, 2, 0))
    assert np.array_equal(whole[100:200], kept(keys[100:200], 6, 0.25, (1, 2, 0)))
    assert set(np.unique(whole)) == {0.0, 1 / 0.75}
    assert abs((whole == 0).mean() - 0.25) < 0.01
    assert not np.array_equal(whole, kept(keys, 6, 0.25, (1, 3, 0)))
    columns = (whole == 0).astype(float)
    assert np.abs(np.corrcoef(columns.T) - np.eye(6)).max() < 0.06


@pytest.mark.parametrize(
    "family, shapes", [("linear", ((2, 1),)), ("logistic", ((2, 1),)), ("softmax", ((2, 3),))]
)
def test_sql_pass_equals_arrow_pass(spark, family, shapes):
    rng = np.random.default_rng(4)
    classes = {"linear": 50, "logistic": 2, "softmax": 3}[family]
    rows = [
        (float(a), float(b), int(y), float(w), int(f), int(m)) for a, b, y, w, f, m in zip(
            rng.normal(size=80), rng.normal(size=80), rng.integers(0, classes, 80),
            rng.random(80), rng.integers(0, 3, 80), rng.integers(0, 4, 80),
        )
    ]
    df = spark.createDataFrame(
        rows, "_x0 double, _x1 double, _y int, _w double, _fold int, _vmask long"
    )
    table = passes.TrainingTable(df, 2, False, 80)
    weight = None if family == "linear" else np.linspace(0.5, 1.5, classes)
    nets = [Net(family, shapes, fold=1, bit=1, class_weight=weight), Net(family, shapes, fold=2)]
    thetas = [rng.normal(size=net.size) for net in nets]
    assert passes.fits_sql(table, nets)
    pairs = zip(
        passes.sql_pass(table, df, nets, thetas), passes.arrow_pass(table, df, nets, thetas, 0)
    )
    for by_sql, by_arrow in pairs:
        for name in ("train_loss", "train_weight", "watch_loss", "watch_weight", "gradient"):
            assert np.allclose(getattr(by_sql, name), getattr(by_arrow, name))


def test_pack_and_unpack():
    layers = [(np.arange(6.0).reshape(2, 3), np.ones(3)), (np.ones((3, 1)), np.zeros(1))]
    again = unpack(pack(layers), ((2, 3), (3, 1)))
    assert all(np.array_equal(a, b) for x, y in zip(layers, again) for a, b in zip(x, y))


# --- baselines and linear regression -----------------------------------------------------------


def test_baselines(spark):
    df = rows_cls(spark, [[0]] * 5, [3, 1, 3, 1, 2])
    model = fit(MajorityClass(), df, FEATURES, "label")
    assert model.classes == [1, 2, 3] and predicted(df, model) == [1] * 5
    mean = fit(MeanTarget(), df, FEATURES, "label")
    assert predicted(df, mean) == [2.0] * 5
    assert score(df, mean, "label").first()["score"] == pytest.approx(0.0)


def test_exact_plane(spark):
    points = [(0, 1), (1, 0), (2, 3), (3, 2)]
    df = rows_reg(spark, points, [1.5 + 2 * a - 0.5 * b for a, b in points])
    model = fit(LinearRegression(), df, FEATURES, "label")
    assert model.params["weights"] == pytest.approx([2.0, -0.5], abs=1e-10)
    assert model.params["bias"][0] == pytest.approx(1.5, abs=1e-10)
    assert score(df, model, "label").first()["score"] == pytest.approx(1.0)


def test_ridge_shrinks_and_matches_the_normal_equations(spark):
    rng = np.random.default_rng(0)
    x, w = rng.normal(2, 1, size=(60, 12)), rng.random(60)
    y = x @ rng.normal(size=12) + rng.normal(size=60)
    df = rows_reg(spark, x.tolist(), y, w)
    spec = LinearRegression(penalty="l2", regularization_strength=3.0)
    model = fit(spec, df, FEATURES, "label", weight="weight")
    a = np.hstack([np.ones((60, 1)), x])
    normal = (a * w[:, None]).T @ a + np.diag([0.0] + [3.0] * 12)
    expected = np.linalg.solve(normal, (a * w[:, None]).T @ y)
    assert model.params["weights"] == pytest.approx(expected[1:], abs=1e-8)
    assert model.params["bias"][0] == pytest.approx(expected[0], abs=1e-8)
    gap = y - a @ expected
    loss = 0.5 * (w @ gap**2) / w.sum() + 3.0 * np.sum(expected[1:] ** 2) / (2 * w.sum())
    assert model.history_rows[0][1] == pytest.approx(loss, abs=1e-9)


def test_dependent_features_get_the_smallest_answer(spark):
    df = rows_reg(spark, [[v, v] for v in (1.0, 2.0, 3.0)], [2.0, 4.0, 6.0])
    model = fit(LinearRegression(fit_intercept=False), df, FEATURES, "label")
    assert model.params["weights"] == pytest.approx([1.0, 1.0], abs=1e-9)


def test_weighted_line(spark):
    df = rows_reg(spark, [[0], [1], [2]], [0, 1, 10], [10, 10, 1])
    plain = fit(LinearRegression(), df, FEATURES, "label")
    weighted = fit(LinearRegression(), df, FEATURES, "label", weight="weight")
    at_one = [predicted(df, m)[1] for m in (plain, weighted)]
    assert abs(at_one[1] - 1) < abs(at_one[0] - 1)


def test_descent_reaches_the_closed_form(spark):
    x = np.linspace(-2, 2, 25)
    df = rows_reg(spark, [[v] for v in x], 3 * x - 1)
    spec = LinearRegression(
        solver="gradient_descent", learning_rate=0.1, max_iter=2000, tol=0.0, gradient_tol=1e-8
    )
    model = fit(spec, df, FEATURES, "label")
    exact = fit(LinearRegression(), df, FEATURES, "label")
    assert model.converged and model.n_iter < 2000
    assert np.allclose(predicted(df, model), predicted(df, exact), atol=1e-2)


def test_l1_shrinks(spark):
    df = rows_reg(spark, [[v] for v in range(5)], range(5))
    slopes = [
        abs(fit(
            LinearRegression(solver="gradient_descent", learning_rate=0.05, max_iter=800,
                             penalty="l1", regularization_strength=s),
            df, FEATURES, "label",
        ).params["weights"][0])
        for s in (0.0, 4.0)
    ]
    assert slopes[1] < slopes[0]


def test_no_intercept_keeps_the_bias_at_zero(spark):
    df = rows_reg(spark, [[1], [2], [3]], [5, 6, 7])
    spec = LinearRegression(solver="gradient_descent", max_iter=20, fit_intercept=False)
    assert fit(spec, df, FEATURES, "label").params["bias"][0] == 0.0


# --- logistic and softmax regression -----------------------------------------------------------

LINE = ([[v] for v in range(6)], [0, 0, 0, 1, 1, 1])


def numpy_logistic(x, y, epochs, rate, strength, seed):
    w, b, n = np.random.default_rng(seed).normal(0, 0.01, x.shape[1]), 0.0, len(y)
    for _ in range(epochs):
        e = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - rate * (x.T @ e + strength * w) / n, b - rate * e.mean()
    return w, b


def test_logistic_iterates(spark):
    df = rows_cls(spark, *LINE)
    spec = LogisticRegression(
        learning_rate=0.3, max_iter=15, tol=0.0, regularization_strength=2.0, seed=9
    )
    model = fit(spec, df, FEATURES, "label")
    w, b = numpy_logistic(np.arange(6.0)[:, None], np.array(LINE[1]), 15, 0.3, 2.0, 9)
    assert model.params["weights"] == pytest.approx(w, abs=1e-12)
    assert model.params["bias"] == pytest.approx([b], abs=1e-12)
    again = fit(spec, df.repartition(5), FEATURES, "label")
    assert again.params["weights"] == pytest.approx(model.params["weights"], abs=1e-12)


def test_and_gate(spark):
    df = rows_cls(spark, [(0, 0), (0, 1), (1, 0), (1, 1)], [0, 0, 0, 1])
    model = fit(LogisticRegression(learning_rate=1.0, max_iter=12), df, FEATURES, "label")
    proba = [r["probability"] for r in predict_proba(df, model).collect()]
    assert all(len(p) == 2 and sum(p) == pytest.approx(1.0) for p in proba)
    assert model.n_iter == len(model.history_rows) and model.history(spark).count() == model.n_iter


def test_three_clusters(spark):
    points = [(-2, -2), (-1.5, -2), (2, -2), (2.5, -1.5), (0, 2), (0.5, 2.5)]
    df = rows_cls(spark, points, [0, 0, 1, 1, 2, 2])
    model = fit(LogisticRegression(learning_rate=0.5, max_iter=20), df, FEATURES, "label")
    assert model.kind == "softmax" and predicted(df, model) == [0, 0, 1, 1, 2, 2]


def test_two_column_softmax(spark):
    df = rows_cls(spark, *LINE)
    spec = LogisticRegression(learning_rate=0.5, max_iter=5, multi_class="multinomial")
    model = fit(spec, df, FEATURES, "label")
    assert model.kind == "softmax" and model.params["weights"].shape == (1, 2)


def test_class_weight_raises_the_rare_class(spark):
    df = rows_cls(spark, [[v] for v in (0, 0.2, 0.4, 0.6, 0.8, 3)], [0] * 5 + [1])
    at_two = rows_cls(spark, [[2.0]], [1])
    p = [
        predict_proba(
            at_two,
            fit(LogisticRegression(learning_rate=0.5, max_iter=8, class_weight=w),
                df, FEATURES, "label"),
        ).first()["probability"][1]
        for w in (None, {0: 1.0, 1: 20.0})
    ]
    assert p[1] > p[0]


def test_early_stopping(spark):
    df = rows_cls(spark, *LINE)
    spec = LogisticRegression(
        learning_rate=0.1, max_iter=200, tol=1.0, n_iter_no_change=3, early_stopping=True,
        validation_fraction=0.34, seed=1,
    )
    model = fit(spec, df, FEATURES, "label", id_col="id")
    assert model.converged and model.n_iter == 4
    assert all(row[2] is not None for row in model.history_rows)
    with pytest.raises(ValueError, match="id_col"):
        fit(spec, df, FEATURES, "label")


def test_labels_keep_their_values(spark):
    df = rows_cls(spark, [[-2], [-1], [1], [2]], [-7, -7, 40, 40])
    model = fit(LogisticRegression(learning_rate=1.0, max_iter=10), df, FEATURES, "label")
    assert model.classes == [-7, 40] and predicted(df, model) == [-7, -7, 40, 40]


def test_fit_errors(spark):
    df = rows_cls(spark, *LINE)
    with pytest.raises(ValueError, match="two classes"):
        fit(LogisticRegression(), df.filter("label = 1"), FEATURES, "label")
    with pytest.raises(ValueError, match="integer"):
        fit(LogisticRegression(), rows_reg(spark, [[1]], [1]), FEATURES, "label")
    with pytest.raises(ValueError, match="finite"):
        fit(LinearRegression(), rows_reg(spark, [[float("nan")]], [1]), FEATURES, "label")
    with pytest.raises(ValueError, match="together"):
        fit_all([Job(MajorityClass()), Job(MeanTarget())], df, FEATURES, "label")
    model = fit(LogisticRegression(max_iter=1), df, FEATURES, "label")
    with spark_error("number of features"):
        predict(rows_cls(spark, [[1, 2]], [0]), model).collect()


def test_mini_batches_match_a_plain_loop(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(23, 2)), rng.integers(0, 2, 23)
    df = rows_cls(spark, x, y)
    spec = LogisticRegression(
        learning_rate=0.4, max_iter=2, batch_strategy="mini_batch", batch_size=8, start="zeros",
        seed=3,
    )
    model = fit(spec, df, FEATURES, "label", id_col="id")
    w, b = np.zeros(2), 0.0
    for epoch in range(2):
        ids = sorted(range(23), key=lambda i: hashlib.md5(f"3:{epoch}:{i}".encode()).hexdigest())
        for at in range(0, 23, 8):
            rows = ids[at:at + 8]
            e = 1 / (1 + np.exp(-(x[rows] @ w + b))) - y[rows]
            w, b = w - 0.4 * x[rows].T @ e / len(rows), b - 0.4 * e.mean()
    assert model.params["weights"] == pytest.approx(w, abs=1e-12)
    assert model.params["bias"] == pytest.approx([b], abs=1e-12)


@pytest.mark.parametrize("optimizer", ["sgd", "adam"])
def test_batches_in_one_barrier_stage(spark, monkeypatch, optimizer):
    rng = np.random.default_rng(11)
    x, y = rng.normal(size=(61, 3)), rng.integers(0, 3, 61)
    df = rows_cls(spark, x.tolist(), y.tolist()).repartition(3)
    spec = LogisticRegression(
        learning_rate=0.1, max_iter=3, batch_strategy="mini_batch", batch_size=16, optimizer=optimizer,
        regularization_strength=2.0, early_stopping=True, validation_fraction=0.2, seed=5,
    )
    found = []
    for rows in (10**9, 4):
        monkeypatch.setattr(training, "BARRIER_ROWS", rows)
        found.append(fit(spec, df, FEATURES, "label", id_col="id"))
    assert training.barrier_tasks(spark, 16) == 4
    monkeypatch.setattr(training, "barriers_run", lambda spark: False)
    found.append(fit(spec, df, FEATURES, "label", id_col="id"))
    for model in found[1:]:
        assert np.allclose(model.params["weights"], found[0].params["weights"], rtol=0, atol=1e-9)
        assert np.allclose(np.array(model.history_rows, float), np.array(found[0].history_rows, float), atol=1e-9)


@pytest.mark.parametrize("tasks_rows, optimizer", [(10**9, "adam"), (7, "sgd")])
def test_an_epoch_in_segments_is_the_same_walk(spark, monkeypatch, tasks_rows, optimizer):
    rng = np.random.default_rng(12)
    df = rows_cls(spark, rng.normal(size=(150, 2)).tolist(), rng.integers(0, 3, 150).tolist())
    spec = LogisticRegression(
        learning_rate=0.1, max_iter=2, batch_strategy="mini_batch", batch_size=16, optimizer=optimizer, seed=3,
    )
    monkeypatch.setattr(training, "BARRIER_ROWS", tasks_rows)
    whole = fit(spec, df, FEATURES, "label", id_col="id")
    walk, sizes = training._walk_batches, []

    def counted(run, table, rows, id_col, epoch, rate, tasks, numbers):
        seen = {r["_batch"] for r in rows.select("_batch").distinct().collect()}
        assert seen == set(numbers)
        sizes.append(rows.count() / tasks)
        return walk(run, table, rows, id_col, epoch, rate, tasks, numbers)

    monkeypatch.setattr(training, "_walk_batches", counted)
    monkeypatch.setattr(training, "SEGMENT_ROWS", 32)
    model = fit(spec, df, FEATURES, "label", id_col="id")
    # no task takes more than its segment, however many rows the epoch has
    assert max(sizes) <= 32 and sum(sizes) == 2 * 150 / (1 if tasks_rows > 16 else 2)
    assert np.array_equal(model.params["weights"], whole.params["weights"])
    assert model.history_rows == whole.history_rows


def test_batches_that_a_task_has_no_rows_of():
    import pyarrow as pa

    rows = [pa.RecordBatch.from_pydict({"_x0": [1.0, 2.0], "_y": [0, 1], "_batch": b}) for b in ([1, 1], [1, 4])]
    blocks = list(training.batch_blocks(iter(rows), ["_x0"], 1, 7))
    assert [None if b is None else b["x"][:, 0].tolist() for b in blocks] == [
        None, [1.0, 2.0, 1.0], None, None, [2.0], None, None
    ]


@pytest.mark.parametrize("width, small", [(40, True), (40, False), (2000, False)])
def test_gram_in_blocks(spark, monkeypatch, width, small):
    monkeypatch.setattr(linear, "GRAM_BLOCK", 16 if width < 100 else 256)
    if not small:
        monkeypatch.setattr(linear, "SMALL_TABLE", 0)
    rng = np.random.default_rng(width)
    x, y, w = rng.normal(5, 1, (60, width)), rng.normal(size=60), rng.random(60)
    rows = [(v.tolist(), float(t), float(u), i % 3, 0) for i, (v, t, u) in enumerate(zip(x, y, w))]
    df = spark.createDataFrame(rows, "_x array<double>, _y double, _w double, _fold int, _vmask long")
    table = passes.TrainingTable(df.repartition(5), width, True, 60)
    centre = linear.centre_of(table)
    for (fold, _), gram in linear.gram_by_group(table, centre).items():
        own = np.arange(60) % 3 == fold
        v = np.column_stack([x, y])[own] - centre
        assert np.allclose(gram.n, w[own].sum()) and np.allclose(gram.first, w[own] @ v)
        assert np.allclose(gram.second, (v * w[own][:, None]).T @ v)
        assert (gram.low, gram.high) == (y[own].min(), y[own].max())


@pytest.mark.parametrize("tasks", [3, 1])
def test_local_descent_walks_through_the_shards(spark, monkeypatch, tasks):
    monkeypatch.setattr(training, "WINDOW", 4)
    monkeypatch.setattr(training, "shard_tasks", lambda *_: tasks)
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(40, 2)), rng.integers(0, 2, 40)
    df = rows_cls(spark, x, y).repartition(6)
    spec = LogisticRegression(
        learning_rate=0.2, max_iter=2, batch_strategy="stochastic", batch_size=3, shards=3,
        start="zeros", seed=5, regularization_strength=0.7,
    )
    model = fit(spec, df, FEATURES, "label", id_col="id")

    def key(text):
        return hashlib.md5(text.encode()).hexdigest()

    walk = {
        shard: sorted(
            (i for i in range(40) if int(key(f"5:shard:{i}")[:13], 16) % 3 == shard),
            key=lambda i: key(f"5:walk:{i}"),
        )
        for shard in range(3)
    }
    theta = np.zeros(3)
    for epoch in range(2):
        total = np.zeros(3)
        for shard in range(3):
            ids = [
                i for at in range(0, 40, 4)
                for i in sorted(walk[shard][at:at + 4], key=lambda i: key(f"5:{epoch}:{i}"))
            ]
            own = theta.copy()
            for at in range(0, len(ids), 3):
                rows = ids[at:at + 3]
                e = 1 / (1 + np.exp(-(x[rows] @ own[:2] + own[2]))) - y[rows]
                slope = np.append(x[rows].T @ e + 0.7 * own[:2], e.sum())
                own = own - 0.2 * slope / len(rows)
            total += own * len(ids)
        theta = total / 40
    assert model.params["weights"] == pytest.approx(theta[:2], abs=1e-12)
    assert model.params["bias"] == pytest.approx(theta[2:], abs=1e-12)


def test_shards_grow_with_the_table():
    spec = LogisticRegression(batch_strategy="stochastic")
    assert [training.shard_count(spec, n) for n in (10, 8 * 10**6, 10**9)] == [8, 8, 1000]
    assert training.shard_count(LogisticRegression(shards=5), 10**9) == 5


# --- networks ----------------------------------------------------------------------------------


def test_xor(spark):
    df = rows_cls(spark, [(0, 0), (0, 1), (1, 0), (1, 1)], [0, 1, 1, 0])
    spec = MLPClassifier(
        hidden_layer_sizes=(8,), activation="tanh", learning_rate=0.2, max_iter=50, seed=0
    )
    assert predicted(df, fit(spec, df, FEATURES, "label")) == [0, 1, 1, 0]


def test_parabola(spark):
    x = np.linspace(-1, 1, 30)
    df = rows_reg(spark, [[v] for v in x], x**2)
    spec = MLPRegressor(
        hidden_layer_sizes=(12,), activation="tanh", learning_rate=0.1, max_iter=50, seed=1
    )
    model = fit(spec, df, FEATURES, "label")
    assert np.mean((np.array(predicted(df, model)) - x**2) ** 2) < 0.4 * np.var(x**2)


def test_network_without_hidden_layers(spark):
    df = rows_cls(spark, *LINE)
    spec = MLPClassifier(hidden_layer_sizes=(), learning_rate=0.3, max_iter=10, optimizer="sgd")
    model = fit(spec, df, FEATURES, "label")
    assert set(model.params) == {"0.weights", "0.bias"} and len(predicted(df, model)) == 6


def test_dropout_is_independent_of_partitions(spark):
    df = rows_cls(spark, np.random.default_rng(0).normal(size=(30, 3)), [0, 1, 2] * 10)
    spec = MLPClassifier(
        hidden_layer_sizes=(6,), dropout_rate=0.4, learning_rate=0.05, max_iter=4, seed=2
    )
    models = [fit(spec, d, FEATURES, "label", id_col="id") for d in (df, df.repartition(7))]
    for name, values in models[0].params.items():
        assert np.allclose(values, models[1].params[name], atol=1e-10)
    with pytest.raises(ValueError, match="id_col"):
        fit(spec, df, FEATURES, "label")


def test_expression_and_matrix_scoring_agree(spark, monkeypatch):
    from sparkfold.operators import score as scoring

    df = rows_cls(spark, np.random.default_rng(0).normal(size=(20, 3)), [0, 1] * 10)
    specs = [
        LogisticRegression(learning_rate=0.5, max_iter=3),
        LogisticRegression(learning_rate=0.5, max_iter=3, multi_class="multinomial"),
        MLPClassifier(hidden_layer_sizes=(4,), activation="leaky_relu", max_iter=3),
    ]
    for spec in specs:
        model = fit(spec, df, FEATURES, "label")
        by_expression = [r["probability"] for r in predict_proba(df, model).orderBy("id").collect()]
        monkeypatch.setattr(scoring, "EXPRESSION_PARAMETERS", 0)
        by_matrix = [r["probability"] for r in predict_proba(df, model).orderBy("id").collect()]
        monkeypatch.undo()
        assert np.allclose(by_expression, by_matrix, atol=1e-14)


def test_wide_features_use_the_array_form(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(50, 40))
    y = x @ rng.normal(size=40) + 3
    df = rows_reg(spark, x.tolist(), y)
    table = Fitting(df, FEATURES, "label", None, None, None, False).table([])
    assert table.wide and table.x_columns == ["_x"]
    model = fit(LinearRegression(), df, FEATURES, "label")
    assert np.allclose(predicted(df, model), y, atol=1e-8)


def test_closed_form_matches_spark_ml(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.ml.regression import LinearRegression as SparkLinear

    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=80)
    df = rows_reg(spark, x.tolist(), y)
    ours = fit(
        LinearRegression(penalty="l2", regularization_strength=7.0), df, FEATURES, "label"
    )
    to_vector = F.udf(lambda v: Vectors.dense(v), VectorUDT())
    theirs = SparkLinear(
        standardization=False, solver="normal", regParam=7.0 * float(np.std(y)) / 80
    ).fit(df.select(to_vector("features").alias("features"), "label"))
    assert ours.params["weights"] == pytest.approx(theirs.coefficients.toArray(), abs=1e-8)
