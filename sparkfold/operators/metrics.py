"""Evaluation metrics as aggregations, grouped by optional ``by`` columns.

Class metrics all start from one count table ``(by, y_true, y_pred, n)``: counting combines on the
map side, so a hot class costs nothing, and everything after it is arithmetic on class-sized data.
Curve metrics keep the row-by-row definition (ties stay separate, in id order) and need one shuffle
by ordered buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.constants import BUCKET_ROWS, DOUBLE_EPS
from sparkfold.functions.scalar import as_class, clip_probability, col, finite
from sparkfold.operators.checks import count_classes
from sparkfold.operators.order import running_sums, value_buckets

DENSE_CLASSES = 100  # labels whose zero cells a confusion matrix has without being asked for
AVERAGES = ("binary", "macro", "micro", "weighted")


# --- class metrics -----------------------------------------------------------------------------


def pair_counts(df: DataFrame, y_true: str, y_pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, y_true, y_pred, n)."""
    return df.groupBy(
        *by, as_class(y_true).alias("y_true"), as_class(y_pred).alias("y_pred")
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy_column(y_true: str = "y_true", y_pred: str = "y_pred") -> Column:
    return F.avg((as_class(y_true) == as_class(y_pred)).cast("double"))


def accuracy(df: DataFrame, y_true: str, y_pred: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(accuracy_column(y_true, y_pred).alias("accuracy"))


def confusion_matrix(
    df: DataFrame,
    y_true: str,
    y_pred: str,
    *,
    labels: Sequence[int] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """(by, y_true, y_pred, n), one row per cell.

    A given label list must cover all values, and all of its cells are there. Without one the cells
    that occur are there, and the zero cells of groups with up to DENSE_CLASSES labels.
    """
    return _confusion_from_counts(pair_counts(df, y_true, y_pred, by), labels, by)


def _few_labels(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, _labels): sorted labels of the groups that have up to DENSE_CLASSES of them.

    One label more than that is looked at, however many there are.
    """
    every = counts.select(*by, F.explode(F.array("y_true", "y_pred")).alias("_label")).distinct()
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_label"))
    first = every.withColumn("_place", place).filter(F.col("_place") <= DENSE_CLASSES + 1)
    found = first.groupBy(*by).agg(F.array_sort(F.collect_list("_label")).alias("_labels"))
    return found.filter(F.size("_labels") <= DENSE_CLASSES)


def _confusion_from_counts(counts, labels, by) -> DataFrame:
    if labels is None:
        grid = _few_labels(counts, by)
    else:
        given = F.array(*[F.lit(int(v)).cast("long") for v in labels])
        covered = F.array_contains(given, F.col("y_true")) & F.array_contains(given, F.col("y_pred"))
        error = F.raise_error(F.lit("labels must cover every true and predicted value."))
        counts = counts.withColumn("n", F.when(covered, F.col("n")).otherwise(error.cast("long")))
        grid = counts.groupBy(*by).agg(F.count("n").alias("_c")).select(*by, given.alias("_labels"))
    cells = grid.select(*by, F.explode("_labels").alias("y_true"), "_labels").select(
        *by, "y_true", F.explode("_labels").alias("y_pred")
    )
    keys = [*by, "y_true", "y_pred"]
    known = counts.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    zero = cells.join(known, same, "left_anti").withColumn("n", F.lit(0).cast("long"))
    return counts.select(*keys, F.col("n").cast("long")).unionByName(zero)


def confusion_display(df: DataFrame, y_true: str, y_pred: str, labels: Sequence[int]) -> DataFrame:
    """Confusion matrix with one column per predicted label."""
    counts = pair_counts(df, y_true, y_pred)
    wide = counts.groupBy("y_true").pivot("y_pred", [int(v) for v in labels]).agg(F.sum("n"))
    return wide.na.fill(0).orderBy("y_true")


def _stats_from_counts(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    hit = F.col("y_true") == F.col("y_pred")

    def entry(label: str, tp: Column, fp: Column, fn: Column, support: Column) -> Column:
        parts = {"tp": tp, "fp": fp, "fn": fn, "support": support}
        return F.struct(
            F.col(label).alias("label"), *[v.cast("long").alias(k) for k, v in parts.items()]
        )

    n, zero = F.col("n"), F.lit(0)
    as_true = entry("y_true", F.when(hit, n).otherwise(0), zero, F.when(hit, 0).otherwise(n), n)
    as_predicted = entry("y_pred", zero, F.when(hit, 0).otherwise(n), zero, zero)
    spread = counts.select(*by, F.explode(F.array(as_true, as_predicted)).alias("e")).select(
        *by, "e.*"
    )
    return spread.groupBy(*by, "label").agg(
        *[F.sum(name).alias(name) for name in ("tp", "fp", "fn", "support")]
    )


def class_stats(df: DataFrame, y_true: str, y_pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, label, tp, fp, fn, support) over the union of true and predicted labels."""
    return _stats_from_counts(pair_counts(df, y_true, y_pred, by), by)


def _ratio(top: Column, bottom: Column, zero_division: float) -> Column:
    return F.when(bottom == 0, F.lit(float(zero_division))).otherwise(
        top.cast("double") / bottom
    )


def _f1(precision: Column, recall: Column, zero_division: float) -> Column:
    return F.when(precision + recall == 0.0, F.lit(float(zero_division))).otherwise(
        2.0 * precision * recall / (precision + recall)
    )


def _averaged(average: str, positive_label: int, zero_division: float) -> dict[str, Column]:
    """Precision, recall and F1 as aggregates over (label, tp, fp, fn, support)."""
    tp, fp, fn, support = F.col("tp"), F.col("fp"), F.col("fn"), F.col("support")
    scores = {
        "precision": _ratio(tp, tp + fp, zero_division),
        "recall": _ratio(tp, tp + fn, zero_division),
    }
    scores["f1"] = _f1(scores["precision"], scores["recall"], zero_division)
    if average == "macro":
        return {name: F.avg(value) for name, value in scores.items()}
    if average == "weighted":
        total = F.sum(support)
        return {
            name: F.when(total == 0, F.lit(float(zero_division))).otherwise(
                F.sum(value * support) / total
            )
            for name, value in scores.items()
        }
    if average == "micro":
        result = {
            "precision": _ratio(F.sum(tp), F.sum(tp + fp), zero_division),
            "recall": _ratio(F.sum(tp), F.sum(tp + fn), zero_division),
        }
        result["f1"] = _f1(result["precision"], result["recall"], zero_division)
        return result
    if average == "binary":
        message = F.lit("positive_label occurs in neither y_true nor y_pred.")
        positive = F.col("label") == int(positive_label)
        found = F.count_if(positive) > 0
        return {
            name: F.when(found, F.max(F.when(positive, value))).otherwise(
                F.raise_error(message).cast("double")
            )
            for name, value in scores.items()
        }
    raise ValueError(f"average must be one of {AVERAGES}.")


def precision_recall_f1(
    df: DataFrame,
    y_true: str,
    y_pred: str,
    *,
    average: str = "binary",
    positive_label: int = 1,
    zero_division: float = 0.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """(by, precision, recall, f1) in one averaging mode."""
    scores = _averaged(average, positive_label, zero_division)
    return class_stats(df, y_true, y_pred, by).groupBy(*by).agg(
        *[value.alias(name) for name, value in scores.items()]
    )


def precision(df, y_true, y_pred, **options) -> DataFrame:
    return precision_recall_f1(df, y_true, y_pred, **options).drop("recall", "f1")


def recall(df, y_true, y_pred, **options) -> DataFrame:
    return precision_recall_f1(df, y_true, y_pred, **options).drop("precision", "f1")


def f1(df, y_true, y_pred, **options) -> DataFrame:
    return precision_recall_f1(df, y_true, y_pred, **options).drop("precision", "recall")


def log_loss_column(y_true: str, proba: Column | str, labels: Sequence[int]) -> Column:
    """Log loss as an aggregate. ``proba`` is an array, one entry per label in list order.

    Unknown labels, missing columns and values outside 0..1 are errors.
    """
    known = F.array(*[F.lit(int(v)).cast("long") for v in labels])
    position = F.array_position(known, as_class(y_true)).cast("int")
    arr = col(proba)
    bad = arr.isNull() | F.exists(
        arr, lambda p: p.isNull() | F.isnan(p) | (p < 0.0) | (p > 1.0)
    )

    def error(message: str) -> Column:
        return F.raise_error(F.lit(message)).cast("double")

    value = (
        F.when(arr.isNull() | (F.size(arr) < len(labels)), error("y_proba needs a column for each class label."))
        .when(bad, error("y_proba must be finite and lie between 0 and 1."))
        .when(position == 0, error("y_true has labels that are not in the label list."))
        .otherwise(-F.log(clip_probability(F.get(arr, position - 1))))
    )
    return F.avg(value)


def log_loss(
    df: DataFrame,
    y_true: str,
    proba: str,
    labels: Sequence[int] | None = None,
    *,
    single: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Log loss of a probability array, or (``single``) of the second label's probability.

    A column belongs to a position of the label list. For an array the list may be left out: then
    it is the sorted distinct labels of all rows, of which there must be as many as columns.
    """
    if labels is None:
        if single:
            raise ValueError("a single probability needs the label list.")
        labels = [row["label"] for row in count_classes(df, y_true)]
        wide = df.agg(F.max(F.size(proba))).first()[0]
        if wide != len(labels):
            raise ValueError(f"{len(labels)} labels occur, but there are {wide} probabilities.")
    arr = F.array(1.0 - F.col(proba), F.col(proba)) if single else F.col(proba)
    return df.groupBy(*by).agg(log_loss_column(y_true, arr, labels).alias("log_loss"))


# --- curves ------------------------------------------------------------------------------------


def _positions(
    df: DataFrame,
    y_true: str,
    score: str,
    id_col: str,
    positive_label: int,
    bucket_rows: int,
) -> DataFrame:
    """Rows by descending score, then id, with running counts ``tp`` and ``k``."""
    rows = df.select(
        F.col(id_col).alias("_id"),
        finite(score, "a score is missing or not finite.").alias("score"),
        (as_class(y_true) == int(positive_label)).cast("long").alias("hit"),
    )
    n_rows = rows.count()
    bucketed, n_buckets = value_buckets(rows, -F.col("score"), "_id", n_rows, bucket_rows)
    return running_sums(
        bucketed,
        ["_b1", "_b2"],
        n_buckets,
        [F.col("score").desc(), F.col("_id")],
        {"tp": F.col("hit"), "k": F.lit(1).cast("long")},
        place=["score", "_id"],
    )


def _or_error(value: Column, condition: Column, message: str) -> Column:
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)).cast("double"))


BOTH_CLASSES = "curve metrics need positive and negative rows."


def _curve_columns(kind: str, tp: Column, k: Column, p: Column, n: Column) -> dict[str, Column]:
    both = (p > 0) & (p < n)
    recall_ = _or_error(tp / p, both, BOTH_CLASSES)
    if kind == "roc":
        return {"fpr": _or_error((k - tp) / (n - p), both, BOTH_CLASSES), "tpr": recall_}
    return {"precision": tp / k, "recall": recall_}


def _curve(
    df, y_true, score, id_col, positive_label, bucket_rows, kind, first
) -> DataFrame:
    positions = _positions(df, y_true, score, id_col, positive_label, bucket_rows)
    tp, k = F.col("tp").cast("double"), F.col("k").cast("double")
    totals = F.col("tp_total").cast("double"), F.col("k_total").cast("double")
    curve = _curve_columns(kind, tp, k, *totals)
    points = positions.select(
        F.col("k").alias("point"),
        *[v.alias(name) for name, v in curve.items()],
        F.col("score").alias("threshold"),
    )
    top = F.max(F.col(score).cast("double"))
    above = top + F.greatest(F.lit(1.0), F.abs(top)) * F.lit(DOUBLE_EPS)
    start = df.agg(
        F.lit(0).cast("long").alias("point"),
        *[F.lit(v).alias(name) for name, v in zip(curve, first, strict=True)],
        above.alias("threshold"),
    )
    return start.unionByName(points)


def roc_curve(
    df: DataFrame,
    y_true: str,
    score: str,
    id_col: str,
    *,
    positive_label: int = 1,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(point, fpr, tpr, threshold): one point per row, ties not merged, first point (0, 0)."""
    return _curve(df, y_true, score, id_col, positive_label, bucket_rows, "roc", (0.0, 0.0))


def pr_curve(
    df: DataFrame,
    y_true: str,
    score: str,
    id_col: str,
    *,
    positive_label: int = 1,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(point, precision, recall, threshold), first point at recall 0 and precision 1."""
    return _curve(df, y_true, score, id_col, positive_label, bucket_rows, "pr", (1.0, 0.0))


def _area_columns() -> dict[str, Column]:
    """Trapezoid areas of both curves as aggregates of the running counts."""
    hit = F.col("hit") == 1
    tp, k = F.col("tp").cast("double"), F.col("k").cast("double")
    p, n = F.max("tp_total").cast("double"), F.max("k_total").cast("double")
    # ROC moves right at a negative row, at the height reached so far
    roc = F.sum(F.when(hit, 0.0).otherwise(tp)) / (p * (n - p))
    # PR moves right at a positive row; the point before it has one positive and one row less
    before = F.when(k == 1.0, 1.0).otherwise((tp - 1.0) / (k - 1.0))
    pr = F.sum(F.when(hit, (before + tp / k) / 2.0).otherwise(0.0)) / p
    both = (p > 0.0) & (p < n)
    return {
        "roc_auc": _or_error(roc, both, BOTH_CLASSES),
        "pr_auc": _or_error(pr, both, BOTH_CLASSES),
    }


def curve_areas(
    df: DataFrame,
    y_true: str,
    score: str,
    id_col: str,
    *,
    positive_label: int = 1,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(roc_auc, pr_auc) from one ordered pass; no curve is kept."""
    positions = _positions(df, y_true, score, id_col, positive_label, bucket_rows)
    return positions.agg(*[v.alias(name) for name, v in _area_columns().items()])


def roc_auc(df, y_true, score, id_col, **options) -> DataFrame:
    return curve_areas(df, y_true, score, id_col, **options).select("roc_auc")


def pr_auc(df, y_true, score, id_col, **options) -> DataFrame:
    return curve_areas(df, y_true, score, id_col, **options).select("pr_auc")


# --- regression --------------------------------------------------------------------------------


def regression_columns(
    y_true: str = "y_true", y_pred: str = "y_pred", n_features: int | None = None
) -> dict[str, Column]:
    """All regression metrics as aggregates, for one fused pass."""
    y = finite(y_true, "a target is missing or not finite.")
    p = finite(y_pred, "a prediction is missing or not finite.")
    gap = y - p
    n = F.count(F.lit(1)).cast("double")
    residual = F.sum(gap * gap)
    # exact for a constant target, where a variance of rounded sums need not be zero
    constant = F.min(y) == F.max(y)

    def against(part: Column, whole: Column) -> Column:
        perfect = F.when(part == 0.0, 1.0).otherwise(0.0)
        return F.when(constant | (whole == 0.0), perfect).otherwise(1.0 - part / whole)

    r2 = against(residual, F.var_pop(y) * n)
    gap_variance = F.when(F.min(gap) == F.max(gap), 0.0).otherwise(F.var_pop(gap))
    result = {
        "mae": F.avg(F.abs(gap)),
        "mse": F.avg(gap * gap),
        "rmse": F.sqrt(F.avg(gap * gap)),
        "r2": r2,
        "explained_variance": against(gap_variance, F.var_pop(y)),
    }
    if n_features is not None:
        spare = n - F.lit(float(n_features)) - 1.0
        message = F.lit("adjusted R2 needs more than n_features + 1 samples.")
        result["adjusted_r2"] = F.when(
            spare > 0.0, 1.0 - (1.0 - r2) * (n - 1.0) / spare
        ).otherwise(F.raise_error(message).cast("double"))
    return result


def regression_report(
    df: DataFrame,
    y_true: str,
    y_pred: str,
    *,
    n_features: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    columns = regression_columns(y_true, y_pred, n_features)
    return df.groupBy(*by).agg(*[v.alias(name) for name, v in columns.items()])


def regression_metric(
    df: DataFrame,
    name: str,
    y_true: str,
    y_pred: str,
    *,
    n_features: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One of mae, mse, rmse, r2, explained_variance, adjusted_r2."""
    columns = regression_columns(y_true, y_pred, n_features)
    return df.groupBy(*by).agg(columns[name].alias(name))


# --- classification report ---------------------------------------------------------------------


def classification_report(
    df: DataFrame,
    y_true: str,
    y_pred: str,
    *,
    score: str | None = None,
    id_col: str | None = None,
    extra: dict[str, Column] | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row: accuracy, macro precision/recall/F1, the confusion matrix, and with a score both
    areas. With more than DENSE_CLASSES labels the matrix and its labels are NULL: the cells that
    occur are rows of ``confusion_matrix``. ``extra`` adds aggregates over the rows (log loss, sizes).

    The class part is derived from one count table and the areas from one ordered pass. The curves
    themselves have a point per row and stay tables: ``roc_curve`` and ``pr_curve``.
    """
    counts = pair_counts(df, y_true, y_pred)
    n = F.col("n")
    hits = F.sum(F.when(F.col("y_true") == F.col("y_pred"), n).otherwise(0))
    share = counts.agg((hits.cast("double") / F.sum(n)).alias("accuracy"))
    averages = _averaged("macro", 1, 0.0)
    parts = [
        share,
        _stats_from_counts(counts, ()).agg(
            *[v.alias(f"{name}_macro") for name, v in averages.items()]
        ),
        _matrix_row(counts),
    ]
    if score is not None:
        if id_col is None:
            raise ValueError("a score needs id_col, which orders equal scores.")
        parts.append(curve_areas(df, y_true, score, id_col, bucket_rows=bucket_rows))
    if extra:
        parts.append(df.agg(*[v.alias(name) for name, v in extra.items()]))
    return side_by_side(parts)


def _matrix_row(counts: DataFrame) -> DataFrame:
    """The dense matrix and its labels in one row, of up to DENSE_CLASSES labels."""
    few = _few_labels(counts, ())
    # the cells of a small matrix only: those of a large one do not reach the row
    cells = counts.join(F.broadcast(few.select(F.explode("_labels").alias("y_true"))), "y_true")
    row = cells.agg(F.map_from_entries(F.collect_list(F.struct(F.struct("y_true", "y_pred"), "n"))).alias("_n"))
    both = side_by_side([few, row])

    def cell(t: Column, p: Column) -> Column:
        key = F.struct(t.alias("y_true"), p.alias("y_pred"))
        return F.coalesce(F.try_element_at("_n", key), F.lit(0)).cast("long")

    matrix = F.transform("_labels", lambda t: F.transform("_labels", lambda p: cell(t, p)))
    return both.select(matrix.alias("confusion_matrix"), F.col("_labels").alias("labels"))


def side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row frames merged into one row (their column names differ)."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(
        *[F.any_value(name, F.lit(True)).alias(name) for name in stacked.columns]
    )
