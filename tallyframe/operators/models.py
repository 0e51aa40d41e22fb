"""Five binary classifiers: fitting, scoring and tuning, all by MLlib."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    Evaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named
from tallyframe.operators.cells import NO_FOLD, Problem, on_values, problems
from tallyframe.sources.scratch import use_checkpoint_dir

CLASSIFIERS: dict[str, type[Estimator]] = {
    "logistic": LogisticRegression,
    "linear_svc": LinearSVC,
    "decision_tree": DecisionTreeClassifier,
    "gbt": GBTClassifier,
    "random_forest": RandomForestClassifier,
}

# The chosen settings of each classifier.
FINAL_PARAMS: dict[str, dict[str, Any]] = {
    "logistic": {
        "maxIter": 30,
        "regParam": 0.0001,
        "family": "binomial",
        "fitIntercept": False,
        "elasticNetParam": 1.0,
    },
    "linear_svc": {
        "regParam": 0.0001,
        "threshold": 0.0,
        "aggregationDepth": 6,
        "tol": 0.001,
        "fitIntercept": False,
        "maxIter": 1000,
    },
    "decision_tree": {"maxDepth": 15, "maxBins": 64, "minInstancesPerNode": 100},
    "gbt": {"maxDepth": 30, "maxBins": 10, "minInstancesPerNode": 1000, "maxIter": 100},
    "random_forest": {
        "maxDepth": 10,
        "maxBins": 16,
        "minInstancesPerNode": 10,
        "numTrees": 30,
    },
}

# The settings each classifier was tuned over.
TUNING_GRIDS: dict[str, dict[str, list[Any]]] = {
    "logistic": {
        "elasticNetParam": [0.0, 0.5, 1.0],
        "fitIntercept": [False, True],
        "maxIter": [10, 30, 50, 1000],
        "family": ["binomial"],
        "regParam": [0.0001, 0.001, 0.1, 1.0, 2.0],
    },
    "linear_svc": {
        "threshold": [0.0, 0.1, 0.2],
        "aggregationDepth": [2, 4, 6],
        "tol": [0.001, 0.1, 1.0],
        "regParam": [0.0001, 0.001, 0.1, 1.0, 10.0],
        "fitIntercept": [False, True],
        "maxIter": [100, 1000, 10000],
    },
    "decision_tree": {
        "maxBins": [8, 16, 32, 64],
        "minInstancesPerNode": [10, 100, 200, 500],
    },
    "gbt": {
        "maxDepth": [10, 30],
        "minInstancesPerNode": [100, 200, 300, 400, 500, 1000],
        "maxBins": [10],
        "maxIter": [20, 30, 40, 50, 100],
    },
    "random_forest": {
        "maxDepth": [5, 10, 30],
        "maxBins": [8, 16],
        "numTrees": [5, 10, 30],
        "minInstancesPerNode": [10, 100, 200],
    },
}

# What a classifier is given besides its grid while it is tuned.
TUNING_BASE: dict[str, dict[str, Any]] = {"random_forest": {"numTrees": 30}}

# The figure each classifier was tuned by.
TUNING_METRICS = {
    "logistic": "areaUnderROC",
    "linear_svc": "areaUnderROC",
    "decision_tree": "areaUnderROC",
    "gbt": "areaUnderROC",
    "random_forest": "f1",
}

LINEAR = ("logistic", "linear_svc")


def classifier(
    kind: str,
    features: str = "features",
    label: str = "label",
    settings: Mapping[str, Any] | None = None,
    **params,
) -> Estimator:
    """An unfitted classifier with the chosen settings, any of which may be replaced.

    ``settings={}`` starts from MLlib's defaults instead.
    """
    chosen = {**(FINAL_PARAMS[kind] if settings is None else settings), **params}
    if kind not in LINEAR:
        chosen.setdefault("seed", 42)
        # Deep trees: node ids are kept and checkpointed, not found again from the root.
        chosen.setdefault("cacheNodeIds", True)
    return CLASSIFIERS[kind](featuresCol=features, labelCol=label, **chosen)


def fit_classifier(
    kind: str, train: DataFrame, features: str = "features", label: str = "label", **params
) -> Model:
    """Fit one classifier.

    Trees and their ensembles cut their lineage by checkpoints every tenth step, which
    needs the session's checkpoint folder; the linear models do not.
    """
    if kind not in LINEAR:
        use_checkpoint_dir(train.sparkSession)
    if kind == "gbt":
        return fit_boosted(train, features, label, **params)
    return classifier(kind, features, label, **params).fit(train.select(features, label))


def fit_boosted(train: DataFrame, features: str, label: str, **params) -> Model:
    """Boosted trees, fitted on cells: rounds are many, and each goes over the counted rows only."""
    chosen = {**FINAL_PARAMS["gbt"], **params}
    most = chosen.get("maxBins", 32)
    problem = problems(train, features, label, [most])[NO_FOLD, most]
    if problem.limits is None:
        return classifier("gbt", features, label, **params).fit(train.select(features, label))
    # Node ids are kept for rows that are many.
    own = classifier("gbt", settings={}, **{**chosen, **problem.params(chosen), "cacheNodeIds": False})
    cells = problem.train().drop("inside").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = own.fit(cells)
    finally:
        cells.unpersist()
    names = {"featuresCol": features, "labelCol": label}
    return on_values(train.sparkSession, model, problem.limits, {**chosen, "cacheNodeIds": True, **names})


def positive_score(df: DataFrame) -> Column:
    """Probability of class 1, or its raw score for a model without probabilities."""
    source = "probability" if "probability" in df.columns else "rawPrediction"
    return vector_to_array(named(source))[1]


def predict(model: Model, df: DataFrame, score: str = "score") -> DataFrame:
    """Add ``prediction`` and the positive class's ``score``."""
    scored = model.transform(df)
    return scored.withColumn(score, positive_score(scored))


def linear_score(
    df: DataFrame,
    weights: Mapping[str, float],
    intercept: float = 0.0,
    threshold: float = 0.5,
) -> DataFrame:
    """Score rows by a logistic model with known weights, as one projection.

    Adds the raw ``margin``, the probability ``score`` and the ``prediction``.
    """
    margin = F.lit(float(intercept))
    for name, weight in weights.items():
        margin = margin + named(name) * F.lit(float(weight))
    scored = df.withColumn("margin", margin)
    scored = scored.withColumn("score", 1.0 / (1.0 + F.exp(-F.col("margin"))))
    return scored.withColumn(
        "prediction", F.when(F.col("score") > threshold, 1.0).otherwise(0.0)
    )


def evaluator(metric: str, label: str = "label") -> Evaluator:
    """The evaluator for a tuning metric."""
    if metric in ("areaUnderROC", "areaUnderPR"):
        return BinaryClassificationEvaluator(labelCol=label, metricName=metric)
    return MulticlassClassificationEvaluator(labelCol=label, metricName=metric)


# A setting that cannot move the area under a curve: a cut-off on the finished score.
NO_EFFECT_ON_AREA = ("threshold",)


def distinct_points(points: Sequence[dict], metric: str) -> list[int]:
    """For each grid point, the place of the first one with the same metric."""
    idle = NO_EFFECT_ON_AREA if metric in ("areaUnderROC", "areaUnderPR") else ()
    first: dict[tuple, int] = {}
    places = []
    for at, point in enumerate(points):
        key = tuple(
            sorted((param.name, repr(v)) for param, v in point.items() if param.name not in idle)
        )
        places.append(first.setdefault(key, at))
    return places


def tune(
    kind: str,
    train: DataFrame,
    grid: Mapping[str, Sequence[Any]] | None = None,
    features: str = "features",
    label: str = "label",
    fold: str | None = None,
    folds: int = 10,
    metric: str | None = None,
    parallelism: int = 8,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Cross-validate a grid; returns the fitted search and its result table.

    Without ``grid`` the full one of the classifier is taken; settings that it does
    not list stay at MLlib's defaults. The table is ``grid_id, params, metric,
    avg_metric, std_metric, fitted_as``; the last is the point whose fits were measured. ``fold`` names a column of fold numbers, which makes the
    folds independent of the partitioning. Points that differ only in settings
    without effect on the metric share their fits; the fitted search holds the first
    of them. The rows are kept in memory and on disk while the search runs, so that
    the features are computed once and not for every fit.
    """
    if kind not in LINEAR:
        use_checkpoint_dir(train.sparkSession)
    grid = TUNING_GRIDS[kind] if grid is None else grid
    metric = metric or TUNING_METRICS[kind]
    estimator = classifier(kind, features, label, TUNING_BASE.get(kind, {}))
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    points = builder.build()
    places = distinct_points(points, metric)
    fitted_at = sorted(set(places))
    if kind == "decision_tree" and fold:
        return _tune_cells(kind, train, features, label, fold, folds, metric, parallelism, estimator, points, places)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=[points[at] for at in fitted_at],
        evaluator=evaluator(metric, label),
        numFolds=folds,
        parallelism=parallelism,
        seed=42,
        **({"foldCol": fold} if fold else {}),
    )
    rows = train.select(features, label, *([fold] if fold else []))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = search.fit(rows)
    finally:
        rows.unpersist()
    return fitted, _tuning_table(train, fitted, metric, points, places)


def _tuning_table(
    train: DataFrame, fitted: CrossValidatorModel, metric: str, points: Sequence[dict], places: Sequence[int]
) -> DataFrame:
    fitted_at = sorted(set(places))
    results = [
        (
            at,
            {param.name: json.dumps(value) for param, value in point.items()},
            metric,
            float(fitted.avgMetrics[fitted_at.index(places[at])]),
            float(fitted.stdMetrics[fitted_at.index(places[at])]),
            places[at],
        )
        for at, point in enumerate(points)
    ]
    return train.sparkSession.createDataFrame(
        results,
        "grid_id int, params map<string,string>, metric string, "
        "avg_metric double, std_metric double, fitted_as int",
    )


def _tune_cells(
    kind: str,
    train: DataFrame,
    features: str,
    label: str,
    fold: str,
    folds: int,
    metric: str,
    parallelism: int,
    estimator: Estimator,
    points: Sequence[dict],
    places: Sequence[int],
) -> tuple[CrossValidatorModel, DataFrame]:
    """The search of ``tune`` with the rows of each fold and number of bins counted in cells.

    All cells come from one scan of the rows; fits and metrics go over cells and their weights. Only
    the best point is fitted on the rows.
    """
    fitted_at = sorted(set(places))
    named_points = {at: {param.name: value for param, value in points[at].items()} for at in fitted_at}
    most = {at: point.get("maxBins", estimator.getOrDefault("maxBins")) for at, point in named_points.items()}
    judge = evaluator(metric).setWeightCol("weight")
    rows = train.select(features, label, fold).persist(StorageLevel.MEMORY_AND_DISK)
    values: dict[tuple[int, int], float] = {}

    def measure(held: int, bins: int, problem: Problem) -> None:
        data = problem.data.persist(StorageLevel.MEMORY_AND_DISK) if problem.limits is not None else problem.data
        own = replace(problem, data=data)
        try:
            for at in fitted_at:
                if most[at] == bins:
                    settings = own.params({**TUNING_BASE.get(kind, {}), **named_points[at], "maxBins": bins})
                    model = classifier(kind, settings={}, **settings).fit(own.train())
                    values[at, held] = judge.evaluate(model.transform(own.held()))
        finally:
            if problem.limits is not None:
                data.unpersist()

    try:
        sizes = {row[0]: row[1] for row in rows.groupBy(named(fold)).count().collect()}
        wrong = [one for one in sizes if one is None or not 0 <= one < folds]
        if wrong:
            raise ValueError(f"Fold number must be in range [0, {folds}), but got {wrong[0]}.")
        for held in range(folds):
            if not sizes.get(held):
                raise ValueError(f"The validation data at fold {held} is empty.")
            if sizes[held] == sum(sizes.values()):
                raise ValueError(f"The training data at fold {held} is empty.")
        found = problems(rows, features, label, sorted(set(most.values())), fold, range(folds))
        with ThreadPoolExecutor(parallelism) as pool:
            for job in [pool.submit(measure, held, bins, problem) for (held, bins), problem in found.items()]:
                job.result()
        table = [[values[at, held] for held in range(folds)] for at in fitted_at]
        means = [sum(line) / folds for line in table]
        deviations = [(sum((v - mean) ** 2 for v in line) / folds) ** 0.5 for line, mean in zip(table, means)]
        best = points[fitted_at[max(range(len(means)), key=means.__getitem__)]]
        fitted = CrossValidatorModel(estimator.fit(rows, best), means, None, deviations)
    finally:
        rows.unpersist()
    return fitted, _tuning_table(train, fitted, metric, points, places)


def best_point(results: DataFrame) -> DataFrame:
    """The grid point with the best average metric, the first one on a tie."""
    row = F.struct(*map(named, results.columns))
    order = F.struct(F.col("avg_metric"), -F.col("grid_id"))
    return results.agg(F.max_by(row, order).alias("best")).select("best.*")
