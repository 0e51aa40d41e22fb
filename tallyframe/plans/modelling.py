"""Split, featurise, fit and compare several models."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named
from tallyframe.operators.evaluation import compare_models, roc_curve
from tallyframe.operators.features import fit_features, linear_features, tree_features
from tallyframe.operators.models import CLASSIFIERS, LINEAR, fit_classifier
from tallyframe.operators.sampling import split_column


# The columns that hold the features of each family of models.
VECTORS = {"linear": "linearFeatures", "tree": "indexedFeatures"}

# Most rows of one task in a tree fit whose rows are spread.
ROWS_A_TASK = 100_000


@dataclass(frozen=True)
class Modelling:
    """Fitted models and their predictions ``model, key, part, label, prediction, score``."""

    features: Mapping[str, PipelineModel]
    models: Mapping[str, Model]
    predictions: DataFrame

    def comparison(self, metric: str = "accuracy") -> DataFrame:
        """Metrics of every model on the training and the test rows."""
        return compare_models(self.predictions, ["model", "part"], metric=metric)

    def roc(self, counts: DataFrame | None = None) -> DataFrame:
        """ROC points of every model on the training and the test rows."""
        return roc_curve(self.predictions, by=["model", "part"], counts=counts)


def run_models(
    df: DataFrame,
    key: str,
    numeric: Sequence[str],
    coded: Sequence[str],
    kinds: Sequence[str] = tuple(CLASSIFIERS),
    params: Mapping[str, Mapping[str, Any]] | None = None,
    label: str = "label",
    seed: int = 42,
    fit_scope: str = "train",
    spread: bool = False,
) -> Modelling:
    """Fit the models on the same training rows and score all rows.

    ``fit_scope='all'`` fits encoder and indexer on all rows, test rows included,
    with the highest code of each column left out; ``'train'`` keeps the test rows
    out of every fit. Scaling is fitted on the training rows in both cases.

    ``spread`` gives the tree fits, which compute much per row, at least as many tasks
    as the session has cores, and more where those would hold very many rows. It costs a count, and
    one shuffle where the table has fewer partitions. To see how many it has, a table that was
    shuffled before has to be computed, so leave it off for such a table.
    """
    if fit_scope not in ("train", "all"):
        raise ValueError("fit_scope must be 'train' or 'all'")
    settings = params or {}
    rows = split_column(df, key, seed=seed)
    features: dict[str, PipelineModel] = {}
    for family in dict.fromkeys(map(_family, kinds)):
        features[family] = _fit_family(family, rows, numeric, coded, fit_scope)

    # Train features are made once per family, and so are those of the rows to score.
    models: dict[str, Model] = {}
    for kind in kinds:
        family = _family(kind)
        train = features[family].transform(rows).where(F.col("part") == "train")
        # Boosted trees are fitted on cells, which are few.
        if spread and family == "tree" and kind != "gbt":
            train = spread_rows(train, key)
        models[kind] = fit_classifier(kind, train, VECTORS[family], label, **settings.get(kind, {}))
    return Modelling(features, models, _score_all(rows, key, label, features, models))


def join_models(df: DataFrame, key: str, runs: Sequence[Modelling], label: str = "label", seed: int = 42) -> Modelling:
    """Models of several runs over the same table as one, scored in one scan.

    Each kind of model may be in one run only. Where runs fitted the features of a family each
    by itself, those of the first are taken; over the same training rows they are the same.
    """
    features: dict[str, PipelineModel] = {}
    models: dict[str, Model] = {}
    for run in runs:
        if set(run.models) & set(models):
            raise ValueError("a kind of model is in more than one run")
        models.update(run.models)
        for family, pipeline in run.features.items():
            features.setdefault(family, pipeline)
    return Modelling(features, models, _score_all(split_column(df, key, seed=seed), key, label, features, models))


def _family(kind: str) -> str:
    return "linear" if kind in LINEAR else "tree"


def _score_all(
    rows: DataFrame,
    key: str,
    label: str,
    features: Mapping[str, PipelineModel],
    models: Mapping[str, Model],
) -> DataFrame:
    """One row per row and model, from one scan: every model adds columns of its own."""
    ready = rows
    for pipeline in features.values():
        ready = pipeline.transform(ready)
    cells = []
    for at, (kind, model) in enumerate(models.items()):
        guess, raw, chance = f"guess_{at}", f"raw_{at}", f"chance_{at}"
        own = model.copy()
        own.setPredictionCol(guess).setRawPredictionCol(raw)
        source = raw
        if own.hasParam("probabilityCol"):
            own.setProbabilityCol(chance)
            source = chance
        ready = own.transform(ready)
        cells.append(
            F.struct(
                F.lit(kind).alias("model"),
                named(guess).alias("prediction"),
                vector_to_array(named(source))[1].alias("score"),
            )
        )
    found = ready.select(key, "part", named(label), F.inline(F.array(*cells)))
    return found.select("model", key, "part", named(label), "prediction", "score")


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Hash rows by key to one partition per core, or per ``ROWS_A_TASK`` rows, if there are fewer now.

    A forest keeps about a kilobyte for a row in each of its tasks, so those must not grow with the table.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = max(cores, math.ceil(df.count() / ROWS_A_TASK))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, named(key))


def _fit_family(
    family: str,
    rows: DataFrame,
    numeric: Sequence[str],
    coded: Sequence[str],
    fit_scope: str,
) -> PipelineModel:
    train = rows.where(F.col("part") == "train")
    all_rows = fit_scope == "all"
    if family == "tree":
        pipeline = tree_features([*numeric, *coded], keep_unseen=not all_rows)
        return fit_features(pipeline, rows, rows if all_rows else train)[0]
    pipeline = linear_features(numeric, coded, VECTORS["linear"], keep_unseen=not all_rows)
    if not all_rows or not coded:
        return fit_features(pipeline, rows, train)[0]
    # The encoder sees all rows, the scaler only the training rows.
    encoder, *rest = pipeline.getStages()
    encoded = encoder.fit(rows)
    tail = pipeline.copy().setStages(rest).fit(encoded.transform(train))
    return PipelineModel([encoded, *tail.stages])
