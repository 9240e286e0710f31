"""Cross-validation and hyperparameter search: all candidates and folds in shared passes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.constants import LOGIT_CLIP
from sparkfold.functions.scalar import sql_number
from sparkfold.operators import checks
from sparkfold.operators.fit import Fitting, Job
from sparkfold.operators.linear import centre_of, squared_error_sums
from sparkfold.operators.metrics import accuracy_column, precision_recall_f1, regression_columns
from sparkfold.operators.models import Model
from sparkfold.operators.network import predict as predict_block
from sparkfold.operators.passes import TrainingTable, feature_columns, matrix
from sparkfold.operators.specs import is_classifier
from sparkfold.operators.splits import k_fold, stratified_k_fold

Scoring = str | Callable[[Column, Column], Column] | None

COMPILED_SCORES = 256  # parameters of all models whose scores are one compiled aggregate
EXACT_SHARE = 1e-8  # an error below this share of the spread is summed row by row
SCORED = "candidate int, fold int, y_true double, y_pred double"
# Scorer names and the (sign, regression metric) behind the regression ones.
REGRESSION_SCORERS = {
    "r2": (1.0, "r2"),
    "neg_mean_squared_error": (-1.0, "mse"),
    "neg_root_mean_squared_error": (-1.0, "rmse"),
    "neg_mean_absolute_error": (-1.0, "mae"),
}


@dataclass
class SearchResult:
    best_params: dict
    best_score: float
    best_model: Model
    scores: DataFrame  # (candidate, params, fold, score)
    summary: DataFrame  # (candidate, params, mean_score, is_best)


def with_folds(
    df: DataFrame, id_col: str, label: str, cv: int, stratified: bool, seed: int
) -> DataFrame:
    """Rows with their fold; cross-validation always shuffles."""
    if stratified:
        return stratified_k_fold(
            df, id_col, label, n_splits=cv, shuffle=True, seed=seed, out="_cv_fold"
        )
    return k_fold(df, id_col, n_splits=cv, shuffle=True, seed=seed, out="_cv_fold")


def scored_folds(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    models: Mapping[tuple[int, int], Model],
    fold_col: str = "_cv_fold",
) -> DataFrame:
    """(candidate, fold, y_true, y_pred): every row scored by the models that did not see it."""
    width = next(iter(models.values())).n_features
    columns, wide = feature_columns(features, width)
    names = ["_x"] if wide else [f"_x{i}" for i in range(width)]
    by_fold: dict[int, list] = {}
    for (candidate, fold), model in models.items():
        by_fold.setdefault(fold, []).append((candidate, block_scorer(model)))

    def run(batches):
        for batch in batches:
            x = matrix(batch, names, width)
            y = batch.column("_y").to_numpy(zero_copy_only=False)
            folds = batch.column("_fold").to_numpy(zero_copy_only=False)
            for fold in np.unique(folds).tolist():
                own = folds == fold
                for candidate, scorer in by_fold.get(fold, ()):
                    count = int(own.sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(count, candidate, np.int32)),
                            pa.array(np.full(count, fold, np.int32)),
                            pa.array(y[own]),
                            pa.array(scorer(x[own])),
                        ],
                        names=["candidate", "fold", "y_true", "y_pred"],
                    )

    source = df.select(
        *columns, F.col(label).cast("double").alias("_y"), F.col(fold_col).cast("int").alias("_fold")
    )
    return source.mapInArrow(run, SCORED)


def block_scorer(model: Model) -> Callable[[np.ndarray], np.ndarray]:
    """Predictions of one model for a block of rows, as doubles."""
    if model.kind in ("mean", "majority"):
        value = float(model.params["mean" if model.kind == "mean" else "label"][0])
        return lambda x: np.full(len(x), value)
    layers, name = model.layers(), model.settings.get("activation", "relu")
    if not model.is_classifier:
        return lambda x: predict_block(layers, name, "linear", x)[:, 0]
    classes = np.array(model.classes, dtype=float)
    if model.kind == "logistic":
        cut = model.settings["threshold"]
        return lambda x: classes[
            (predict_block(layers, name, "logistic", x)[:, 0] >= cut).astype(int)
        ]
    return lambda x: classes[predict_block(layers, name, "softmax", x).argmax(axis=1)]


def fold_scores(scored: DataFrame, scoring: Scoring, classify: bool) -> DataFrame:
    """(candidate, fold, score)."""
    by = ["candidate", "fold"]
    if scoring is None:
        scoring = "accuracy" if classify else "r2"
    if callable(scoring):
        return scored.groupBy(*by).agg(
            scoring(F.col("y_true"), F.col("y_pred")).cast("double").alias("score")
        )
    if scoring == "accuracy":
        return scored.groupBy(*by).agg(accuracy_column().alias("score"))
    if scoring == "f1":
        return precision_recall_f1(scored, "y_true", "y_pred", by=by).select(
            *by, F.col("f1").alias("score")
        )
    if scoring in REGRESSION_SCORERS:
        sign, name = REGRESSION_SCORERS[scoring]
        return scored.groupBy(*by).agg((sign * regression_columns()[name]).alias("score"))
    raise ValueError(f"unknown scoring {scoring!r}.")


# --- scores from sums --------------------------------------------------------------------------
#
# A built-in scorer needs a handful of sums per candidate and fold. They are added up where the
# rows are, so what is shuffled grows with candidates and tasks and never with the rows.

CLASS_SUMS = ("n", "hits", "tp", "fp", "fn")
ERROR_SUMS = ("n", "gap", "gap_abs", "gap_sq", "y", "y_sq")


def scoring_name(scoring: Scoring, classify: bool) -> str | None:
    """Name of a built-in scorer of this kind of model; None for a callable."""
    if callable(scoring):
        return None
    name = scoring or ("accuracy" if classify else "r2")
    if name not in ("accuracy", "f1", *REGRESSION_SCORERS):
        raise ValueError(f"unknown scoring {scoring!r}.")
    return name


def score_of(name: str, sums: Mapping[str, float], low: float, high: float) -> float:
    """Score of one candidate on one fold; ``low`` and ``high`` bound its targets."""
    n = sums["n"]
    if not n:
        return float("nan")
    if name == "accuracy":
        return sums["hits"] / n
    if name == "f1":
        tp, fp, fn = sums["tp"], sums["fp"], sums["fn"]
        if tp + fp + fn == 0:
            raise ValueError("positive_label occurs in neither y_true nor y_pred.")
        return 2.0 * tp / (2.0 * tp + fp + fn)
    error = sums["gap_sq"]
    if name == "r2":
        spread = sums["y_sq"] - sums["y"] ** 2 / n
        if low == high or spread <= 0.0:
            return 1.0 if error == 0.0 else 0.0
        return 1.0 - error / spread
    value = {
        "neg_mean_absolute_error": sums["gap_abs"] / n,
        "neg_mean_squared_error": error / n,
        "neg_root_mean_squared_error": float(np.sqrt(error / n)),
    }[name]
    return -value


def _block_sums(name: str, y: np.ndarray, guess: np.ndarray, shift: float) -> list[float]:
    """The sums of a block of rows, in the order of their names."""
    if name in ("accuracy", "f1"):
        one, said = y == 1, guess == 1
        return [
            len(y), (y == guess).sum(), (one & said).sum(), (~one & said).sum(), (one & ~said).sum()
        ]
    gap = y - guess
    if not np.isfinite(gap).all():
        raise ValueError("a prediction is missing or not finite.")
    far = y - shift
    return [len(y), gap.sum(), np.abs(gap).sum(), gap @ gap, far.sum(), far @ far]


def fold_sums(
    table: TrainingTable, classes: Sequence[int], models: Mapping[tuple[int, int], Model], name: str
) -> dict[tuple[int, int], float]:
    """Score of every (candidate, fold) on the rows its model did not see, in one pass.

    Each task sends one row of sums per pair, whatever its number of rows.
    """
    width, names = table.width, table.x_columns
    names_of = CLASS_SUMS if name in ("accuracy", "f1") else ERROR_SUMS
    labels = np.array(classes, dtype=float) if classes else None
    shift = 0.0 if classes else float(centre_of(table)[-1])
    by_fold: dict[int, list] = {}
    for (candidate, fold), model in models.items():
        by_fold.setdefault(fold, []).append((candidate, block_scorer(model)))

    def run(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        ends: dict[int, tuple[float, float]] = {}
        for batch in batches:
            x = matrix(batch, names, width)
            y = batch.column("_y").to_numpy(zero_copy_only=False).astype(float)
            y = y if labels is None else labels[y.astype(int)]
            folds = batch.column("_fold").to_numpy(zero_copy_only=False)
            for fold in np.unique(folds).tolist():
                own = folds == fold
                low, high = ends.get(fold, (np.inf, -np.inf))
                ends[fold] = min(low, y[own].min()), max(high, y[own].max())
                for candidate, scorer in by_fold.get(fold, ()):
                    sums = np.array(_block_sums(name, y[own], scorer(x[own]), shift), dtype=float)
                    key = (candidate, fold)
                    total[key] = total[key] + sums if key in total else sums
        if total:
            columns = [pa.array([k[i] for k in total], pa.int32()) for i in (0, 1)]
            columns += [pa.array([ends[f][i] for _, f in total]) for i in (0, 1)]
            columns += [pa.array([s[i] for s in total.values()]) for i in range(len(names_of))]
            yield pa.RecordBatch.from_arrays(columns, ["candidate", "fold", "low", "high", *names_of])

    schema = ", ".join(f"{n} double" for n in ("low", "high", *names_of))
    rows = table.df.select(*names, "_y", "_fold").mapInArrow(run, f"candidate int, fold int, {schema}")
    found = rows.groupBy("candidate", "fold").agg(
        F.min("low").alias("low"), F.max("high").alias("high"),
        *[F.sum(n).alias(n) for n in names_of],
    ).collect()
    return {
        (r["candidate"], r["fold"]): score_of(name, {n: r[n] for n in names_of}, r["low"], r["high"])
        for r in found
    }


def compiled_sums(
    table: TrainingTable, classes: Sequence[int], models: Mapping[tuple[int, int], Model], name: str
) -> dict[tuple[int, int], float]:
    """The same as one compiled aggregate per fold, for a few small models over separate columns."""
    candidates = sorted({c for c, _ in models})
    names_of = CLASS_SUMS if name in ("accuracy", "f1") else ERROR_SUMS
    shift = 0.0 if classes else float(centre_of(table)[-1])
    guesses = []
    for c in candidates:
        cases = "".join(
            f" WHEN {fold} THEN {_guess(model, table.x_columns)}"
            for (other, fold), model in models.items() if other == c
        )
        guesses.append(f"CASE _fold{cases} END AS _g{c}")
    target = "double(_y)"
    if classes:
        values = "".join(f" WHEN {k} THEN {sql_number(float(v))}" for k, v in enumerate(classes))
        target = f"CASE _y{values} END"
    rows = table.df.selectExpr("_fold", f"{target} AS _t", *guesses)
    sums = [F.expr("min(_t) AS low"), F.expr("max(_t) AS high"), F.expr("double(count(*)) AS n")]
    far = f"(_t - {sql_number(shift)})"
    sums += [F.expr(f"sum({far}) AS y"), F.expr(f"sum({far} * {far}) AS y_sq")]
    for c in candidates:
        gap, one, said = f"(_t - _g{c})", "_t = 1", f"_g{c} = 1"
        texts = {
            "hits": f"_t = _g{c}", "tp": f"{one} AND {said}",
            "fp": f"NOT {one} AND {said}", "fn": f"{one} AND NOT {said}",
        } if classes else {
            "gap": gap, "gap_abs": f"abs({gap})", "gap_sq": f"{gap} * {gap}",
        }
        for key, text in texts.items():
            sums.append(F.expr(f"sum(double({text})) AS {key}_{c}"))
    scores = {}
    for r in rows.groupBy("_fold").agg(*sums).collect():
        for c in candidates:
            if (c, r["_fold"]) in models:
                own = {n: r[n] if n in ("n", "y", "y_sq") else r[f"{n}_{c}"] for n in names_of}
                if not all(np.isfinite(v) for v in own.values()):
                    raise ValueError("a prediction is missing or not finite.")
                scores[(c, r["_fold"])] = score_of(name, own, r["low"], r["high"])
    return scores


def _guess(model: Model, names: Sequence[str]) -> str:
    """SQL: prediction of a small model as a double."""
    if model.kind in ("mean", "majority"):
        return sql_number(float(model.params["mean" if model.kind == "mean" else "label"][0]))
    weights, bias = np.ravel(model.params["weights"]), float(np.ravel(model.params["bias"])[0])
    terms = [f"{n} * {sql_number(float(w))}" for n, w in zip(names, weights, strict=True)]
    z = " + ".join([*terms, sql_number(bias)])
    if model.kind == "linear":
        return f"({z})"
    limit = sql_number(LOGIT_CLIP)
    p = f"1.0D / (1.0D + exp(-greatest(least({z}, {limit}), -{limit})))"
    low, high = (sql_number(float(c)) for c in model.classes)
    return f"CASE WHEN {p} >= {sql_number(model.settings['threshold'])} THEN {high} ELSE {low} END"


def _compiles(table: TrainingTable, models: Mapping[tuple[int, int], Model]) -> bool:
    plain = all(m.kind in ("mean", "majority", "linear", "logistic") for m in models.values())
    return plain and not table.wide and len(models) * (table.width + 1) <= COMPILED_SCORES


def sums_only(fitting: Fitting, table: TrainingTable, models, name: str, weight) -> dict | None:
    """Scores of linear models from the Gram sums of their folds: no row is read.

    None where the sums do not give the score: other models or scorers, weighted sums, or an error
    so small beside the spread of the targets that their differences would not be accurate.
    """
    by_sums = ("r2", "neg_mean_squared_error", "neg_root_mean_squared_error")
    if name not in by_sums or weight is not None or any(m.kind != "linear" for m in models.values()):
        return None
    centre, grams = fitting.sums(table)
    scores = {}
    for (candidate, fold), model in models.items():
        held = [g for key, g in grams.items() if key[0] == fold]
        if not held:
            continue
        gram = reduce(lambda a, b: a + b, held)
        weights, bias = np.ravel(model.params["weights"]), float(np.ravel(model.params["bias"])[0])
        error = squared_error_sums(gram, centre, weights, bias)[0]
        spread = gram.second[-1, -1]
        if error <= EXACT_SHARE * (spread + gram.first[-1] ** 2 / gram.n):
            return None
        sums = {"n": gram.n, "gap_sq": error, "gap_abs": 0.0, "y": gram.first[-1], "y_sq": spread}
        scores[(candidate, fold)] = score_of(name, sums, gram.low, gram.high)
    return scores


def fold_scores_of(fitting, table, folded, features, label, models, scoring, classify, weight) -> dict:
    """Score of every (candidate, fold) by the cheapest way that gives it."""
    name = scoring_name(scoring, classify)
    if name is None or (name in REGRESSION_SCORERS) == classify:
        # a callable sees rows; so does a scorer of the other kind of model
        scored = scored_folds(folded, features, label, models)
        found = fold_scores(scored, scoring, classify).collect()
        return {(r["candidate"], r["fold"]): r["score"] for r in found}
    scores = sums_only(fitting, table, models, name, weight)
    if scores is not None:
        return scores
    classes = fitting.classes if classify else []
    way = compiled_sums if _compiles(table, models) else fold_sums
    return way(table, classes, models, name)


def kept_rows(df, features, label, id_col, weight) -> DataFrame:
    """The columns that a search reads, kept: its folds, fits, scores and refit scan them once."""
    names = [features] if isinstance(features, str) else list(features)
    wanted = dict.fromkeys([id_col, label, *names, *([weight] if weight else [])])
    checks.require_columns(df, features)
    return df.select(*wanted).persist(StorageLevel.MEMORY_AND_DISK)


def _search(
    specs, df, features, label, id_col, weight, cv, scoring, stratified, seed, pick=None
) -> tuple[dict[tuple[int, int], float], Model | None]:
    """Scores of all candidates, and the model of the one that ``pick`` chooses, fitted on all rows."""
    if len({is_classifier(s) for s in specs}) != 1:
        raise ValueError("classifiers and regressors cannot be fitted together.")
    classify = is_classifier(specs[0])
    scoring_name(scoring, classify)
    kept = kept_rows(df, features, label, id_col, weight)
    try:
        folded = with_folds(kept, id_col, label, cv, stratified, seed)
        pairs = [(c, f) for c in range(len(specs)) for f in range(cv)]
        jobs = [Job(specs[c], f) for c, f in pairs]
        refits = [Job(spec) for spec in specs] if pick else []
        fitting = Fitting(folded, features, label, id_col, weight, "_cv_fold", classify)
        with fitting.shared([*jobs, *refits]) as table:
            models = dict(zip(pairs, fitting.run(jobs), strict=True))
            found = fold_scores_of(
                fitting, table, folded, features, label, models, scoring, classify, weight
            )
            scores = {pair: _number(found.get(pair)) for pair in pairs}
            best = fitting.run([refits[pick(scores)]])[0] if pick else None
    finally:
        kept.unpersist()
    return scores, best


def _number(value) -> float:
    return float("nan") if value is None else float(value)


def cross_val_score(
    spec,
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    id_col: str,
    *,
    cv: int = 5,
    scoring: Scoring = None,
    stratified: bool = False,
    seed: int = 0,
    weight: str | None = None,
) -> DataFrame:
    """(fold, score)."""
    scores, _ = _search([spec], df, features, label, id_col, weight, cv, scoring, stratified, seed)
    rows = [(fold, score) for (_, fold), score in scores.items()]
    return df.sparkSession.createDataFrame(rows, "fold int, score double")


def parameter_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations; the last name varies fastest."""
    if not grid:
        raise ValueError("the parameter grid is empty.")
    for name, values in grid.items():
        if not values:
            raise ValueError(f"the parameter grid has no values for {name!r}.")
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def draw(candidates: Sequence[dict], n_iter: int, seed: int) -> list[dict]:
    """A deterministic draw without replacement, ordered by a hash of (seed, position)."""
    if n_iter <= 0:
        raise ValueError("n_iter draws no candidate.")
    if n_iter > len(candidates):
        raise ValueError(f"n_iter asks for more than the {len(candidates)} candidates of the grid.")
    keyed = sorted(
        (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i) for i in range(len(candidates))
    )
    return [candidates[i] for _, i in keyed[:n_iter]]


def grid_search(
    spec,
    grid: Mapping[str, Sequence],
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    id_col: str,
    **options,
) -> SearchResult:
    return search(spec, parameter_grid(grid), df, features, label, id_col, **options)


def randomized_search(
    spec,
    grid: Mapping[str, Sequence],
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    id_col: str,
    *,
    n_iter: int = 10,
    seed: int = 0,
    **options,
) -> SearchResult:
    candidates = draw(parameter_grid(grid), n_iter, seed)
    return search(spec, candidates, df, features, label, id_col, seed=seed, **options)


def search(
    spec,
    candidates: Sequence[Mapping],
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    id_col: str,
    *,
    cv: int = 5,
    scoring: Scoring = None,
    stratified: bool = False,
    seed: int = 0,
    weight: str | None = None,
) -> SearchResult:
    """Score every candidate on every fold and refit the best on all rows.

    The best candidate has the highest mean score; the first one wins ties, and a mean that is not
    a number never wins.
    """
    if not candidates:
        raise ValueError("a search needs at least one candidate.")
    specs = [replace(spec, **params) for params in candidates]
    means: list[float] = []

    def pick(scores) -> int:
        best = None
        for c in range(len(specs)):
            means.append(float(np.mean([scores[(c, f)] for f in range(cv)])))
            if means[c] > (means[best] if best is not None else -np.inf):
                best = c
        if best is None:
            raise RuntimeError("no candidate has a usable score.")
        return best

    scores, model = _search(
        specs, df, features, label, id_col, weight, cv, scoring, stratified, seed, pick
    )
    best = max(range(len(specs)), key=lambda c: (means[c] == means[c], means[c], -c))
    text = [{k: str(v) for k, v in params.items()} for params in candidates]
    spark = df.sparkSession
    return SearchResult(
        dict(candidates[best]),
        means[best],
        model,
        spark.createDataFrame(
            [(c, text[c], f, s) for (c, f), s in scores.items()],
            "candidate int, params map<string,string>, fold int, score double",
        ),
        spark.createDataFrame(
            [(c, text[c], mean, c == best) for c, mean in enumerate(means)],
            "candidate int, params map<string,string>, mean_score double, is_best boolean",
        ),
    )
