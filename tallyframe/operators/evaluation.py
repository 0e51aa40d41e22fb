"""Confusion matrices, per-class metrics and threshold curves.

Everything is an aggregation over ``(label, prediction)`` or ``(label, score)``. The
optional ``by`` columns (a model name, train or test) give one result per group in
the same pass. A label or prediction other than 0 counts as positive; rows where
one is NULL or NaN are left out, from matrices by their prediction and from curves by
their score. ``weight`` names a whole number of equal rows that one row stands for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named
from tallyframe.operators.ordering import running_sums


def confusion_matrix(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """``label, prediction, n`` for the four cells, the empty ones included."""
    truth, guess = named(label) != 0, named(prediction) != 0
    counts, cells = [], []
    for actual in (0, 1):
        for predicted in (0, 1):
            name = f"n{actual}{predicted}"
            hit = (truth if actual else ~truth) & (guess if predicted else ~guess)
            n = F.count_if(hit) if weight is None else F.coalesce(F.sum(F.when(hit, named(weight))), F.lit(0))
            counts.append(n.cast("bigint").alias(name))
            cells.append(
                F.struct(
                    F.lit(actual).alias("label"),
                    F.lit(predicted).alias("prediction"),
                    F.col(name).alias("n"),
                )
            )
    counted = df.groupBy(*map(named, by)).agg(*counts)
    return counted.select(*map(named, by), F.inline(F.array(*cells)))


def _figures(beta: float) -> dict[str, Column]:
    """Metrics as expressions over the cell counts ``n00, n01, n10, n11``."""
    n00, n01, n10, n11 = (F.col(name).cast("double") for name in ("n00", "n01", "n10", "n11"))
    rows = n00 + n01 + n10 + n11
    figures = {
        "accuracy": F.try_divide(n00 + n11, rows),
        "error": F.try_divide(n01 + n10, rows),
    }
    weight = beta * beta
    for side, hits, guessed, actual in (
        (0, n00, n00 + n10, n00 + n01),
        (1, n11, n11 + n01, n11 + n10),
    ):
        # A class that is never predicted has precision 0; one that never occurs
        # has no recall.
        precision = F.when(guessed > 0, F.try_divide(hits, guessed)).otherwise(0.0)
        recall = F.try_divide(hits, actual)
        both = weight * precision + recall
        measure = F.when(both == 0, 0.0).otherwise(
            F.try_divide((1 + weight) * precision * recall, both)
        )
        figures[f"precision_{side}"] = precision
        figures[f"recall_{side}"] = recall
        figures[f"f_measure_{side}"] = measure
        figures[f"share_{side}"] = F.try_divide(actual, rows)
    figures["weighted_f"] = (
        F.coalesce(figures["f_measure_0"], F.lit(0.0)) * figures["share_0"]
        + F.coalesce(figures["f_measure_1"], F.lit(0.0)) * figures["share_1"]
    )
    return figures


def metrics_table(matrix: DataFrame, by: Sequence[str] = (), beta: float = 1.0) -> DataFrame:
    """All metrics of a confusion matrix, one row per group."""
    cells = [
        F.coalesce(
            F.sum(F.when((F.col("label") == a) & (F.col("prediction") == p), F.col("n"))),
            F.lit(0),
        ).alias(f"n{a}{p}")
        for a in (0, 1)
        for p in (0, 1)
    ]
    wide = matrix.groupBy(*map(named, by)).agg(*cells)
    figures = _figures(beta)
    names = ["accuracy", "error"]
    names += [f"{m}_{side}" for side in (0, 1) for m in ("precision", "recall", "f_measure")]
    names.append("weighted_f")
    return wide.select(*map(named, by), *[figures[name].alias(name) for name in names])


def metric_rows(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metrics as rows ``metric, class, value``; ``class`` is NULL for overall ones."""
    rows = []
    for name in table.columns:
        if name in by:
            continue
        stem, _, side = name.rpartition("_")
        per_class = side in ("0", "1")
        rows.append(
            F.struct(
                F.lit(stem if per_class else name).alias("metric"),
                F.lit(int(side) if per_class else None).cast("int").alias("class"),
                named(name).alias("value"),
            )
        )
    return table.select(*map(named, by), F.inline(F.array(*rows)))


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    beta: float = 1.0,
) -> DataFrame:
    """Accuracy, error, and precision, recall and F per class, as rows."""
    table = metrics_table(confusion_matrix(df, label, prediction, by), by, beta)
    return metric_rows(table.drop("weighted_f"), by)


def weighted_f1(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """F1 averaged over the classes by their number of rows."""
    table = metrics_table(confusion_matrix(df, label, prediction, by, weight), by)
    return table.select(*map(named, by), F.col("weighted_f").alias("weighted_f1"))


def compare_models(
    df: DataFrame,
    by: Sequence[str],
    label: str = "label",
    prediction: str = "prediction",
    metric: str = "accuracy",
) -> DataFrame:
    """All metrics of several models and row sets, the best first; one pass."""
    table = metrics_table(confusion_matrix(df, label, prediction, by), by)
    return table.orderBy(F.desc_nulls_last(metric), *by)


def threshold_counts(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: Sequence[str] = (),
    buckets: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Hits and false alarms at each distinct score taken as the threshold.

    ``threshold, hits, alarms`` are the positives and negatives that score exactly
    this; ``tp, fp`` those that score at least this; ``positives, negatives`` all.
    """
    n = F.lit(1) if weight is None else named(weight)
    # NaN would be ordered above every number, and so count as the surest positive.
    rows = df.where(named(label).isNotNull() & ~F.isnan(named(score).cast("double"))).select(
        *map(named, by),
        named(score).cast("double").alias("threshold"),
        F.when(named(label) != 0, n).otherwise(0).cast("bigint").alias("hits"),
        F.when(named(label) != 0, 0).otherwise(n).cast("bigint").alias("alarms"),
    )
    counted = running_sums(rows, by, "threshold", ["hits", "alarms"], buckets)
    return counted.withColumnsRenamed(
        {
            "cum_hits": "tp",
            "cum_alarms": "fp",
            "all_hits": "positives",
            "all_alarms": "negatives",
        }
    )


def threshold_curves(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: Sequence[str] = (),
    beta: float = 1.0,
    buckets: int | None = None,
    points: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Every figure at every threshold: ``fpr, tpr, precision, recall, f_measure``.

    ``first`` marks the highest threshold of the group. ``points`` thins the curve
    for drawing: of the exact points, the first and those are kept that complete
    another ``1 / points`` of the group's rows. ``counts`` are the rows' threshold counts
    where these have been made already.
    """
    if counts is None:
        counts = threshold_counts(df, score, label, by, buckets)
    if points is not None:
        counts = counts.where(_completes_step(points))
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    precision = tp / (tp + fp)
    recall = F.try_divide(tp, F.col("positives"))
    weight = beta * beta
    both = weight * precision + recall
    return counts.select(
        *map(named, by),
        "threshold",
        "tp",
        "fp",
        ((F.col("tp") == F.col("hits")) & (F.col("fp") == F.col("alarms"))).alias("first"),
        F.try_divide(fp, F.col("negatives")).alias("fpr"),
        recall.alias("tpr"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.when(both == 0, 0.0)
        .otherwise(F.try_divide((1 + weight) * precision * recall, both))
        .alias("f_measure"),
    )


def _completes_step(points: int) -> Column:
    rows = F.col("positives") + F.col("negatives")
    upto, own = F.col("tp") + F.col("fp"), F.col("hits") + F.col("alarms")
    step = F.floor(upto * F.lit(points) / rows)
    return (upto == own) | (F.floor((upto - own) * F.lit(points) / rows) < step)


def roc_curve(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: Sequence[str] = (),
    buckets: int | None = None,
    points: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Exact ROC points ``threshold, fpr, tpr``; (0, 0) has a NULL threshold."""
    curve = threshold_curves(df, score, label, by, buckets=buckets, points=points, counts=counts)
    return _with_start(curve, by, {"fpr": F.lit(0.0), "tpr": F.lit(0.0)})


def pr_curve(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: Sequence[str] = (),
    buckets: int | None = None,
    points: int | None = None,
) -> DataFrame:
    """Exact precision and recall points; recall 0 repeats the first precision."""
    curve = threshold_curves(df, score, label, by, buckets=buckets, points=points)
    return _with_start(curve, by, {"recall": F.lit(0.0), "precision": F.col("precision")})


def _with_start(curve: DataFrame, by: Sequence[str], start: dict[str, Column]) -> DataFrame:
    """Put the start point before each group's highest threshold.

    That threshold is the one whose running count is its own count, so the point is
    added in the same projection, without another look at the rows.
    """
    point = F.struct("threshold", *start)
    origin = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        *[value.alias(name) for name, value in start.items()],
    )
    points = F.when(F.col("first"), F.array(origin, point)).otherwise(F.array(point))
    return curve.select(*map(named, by), F.inline(points))


def f_measure_by_threshold(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: Sequence[str] = (),
    beta: float = 1.0,
) -> DataFrame:
    """F-measure of class 1 at each threshold."""
    return threshold_curves(df, score, label, by, beta).select(
        *map(named, by), "threshold", "f_measure"
    )


def precision_by_threshold(
    df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Precision of class 1 at each threshold."""
    return threshold_curves(df, score, label, by).select(
        *map(named, by), "threshold", "precision"
    )


def recall_by_threshold(
    df: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Recall of class 1 at each threshold."""
    return threshold_curves(df, score, label, by).select(
        *map(named, by), "threshold", "recall"
    )


def auc_roc(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: Sequence[str] = (),
    buckets: int | None = None,
    weight: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Exact area under the ROC curve, equal scores counting half; NULL for one class."""
    if counts is None:
        counts = threshold_counts(df, score, label, by, buckets, weight)
    above = F.col("tp").cast("double") - F.col("hits").cast("double") / 2
    area = F.sum(F.col("alarms").cast("double") * above)
    pairs = F.max(F.col("positives").cast("double") * F.col("negatives").cast("double"))
    return counts.groupBy(*map(named, by)).agg(F.try_divide(area, pairs).alias("auc"))
