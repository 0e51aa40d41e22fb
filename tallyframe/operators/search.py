"""Grid searches whose points share their work.

A plain search fits every point on every fold by itself. Here

* an ensemble is fitted with the most trees that the grid asks for, and its beginnings, which
  are the ensembles of the points with fewer trees, are scored in the same scan;
* an ensemble none of whose trees reached the depth limit is that of any higher limit too;
* forests of rows that fall in few cells are grown on the cells, each forest in one task (``forest``);
* logistic points are solved together: one scan gives the gradients and the second
  derivatives of all that are still open, whatever their penalty, intercept or fold.

Metrics are exact, computed once over the scores of all points and folds.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark import SparkContext, StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.columns import named
from tallyframe.operators.cells import Problem, categories, problems
from tallyframe.operators.evaluation import auc_roc, weighted_f1
from tallyframe.operators.forest import MOST_CELLS, forest_votes
from tallyframe.operators.models import TUNING_GRIDS, TUNING_METRICS, classifier
from tallyframe.sources.scratch import scratch_path, use_checkpoint_dir

# The setting that says how many trees an ensemble has, and the model that a beginning of it is.
SIZES = {"gbt": "maxIter", "random_forest": "numTrees"}

RESULTS = "grid_id int, params map<string,string>, metric string, fitted_as int"


def grid_points(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """All points of a grid; the last setting changes fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def first_alike(points: Sequence[Mapping[str, Any]], idle: Sequence[str]) -> list[int]:
    """For each point, the first one that differs from it in idle settings at most."""
    seen: dict[str, int] = {}
    return [
        seen.setdefault(json.dumps({name: value for name, value in point.items() if name not in idle}), at)
        for at, point in enumerate(points)
    ]


def fold_metric(scored: DataFrame, metric: str, by: Sequence[str], weight: str | None = None) -> DataFrame:
    """``by`` and the ``value`` of the metric over each group of scored rows."""
    if metric == "areaUnderROC":
        return auc_roc(scored, by=list(by), weight=weight).withColumnRenamed("auc", "value")
    if metric == "f1":
        return weighted_f1(scored, by=list(by), weight=weight).withColumnRenamed("weighted_f1", "value")
    raise ValueError(f"no exact form of {metric!r} here; use tune")


def result_table(
    points: Sequence[Mapping[str, Any]], places: Sequence[int], metric: str, values: DataFrame
) -> DataFrame:
    """The search's table, from ``fitted_as, fold, value`` of the points that were fitted."""
    listed = values.sparkSession.createDataFrame(
        [
            (at, {name: json.dumps(value) for name, value in point.items()}, metric, places[at])
            for at, point in enumerate(points)
        ],
        RESULTS,
    )
    sums = values.groupBy("fitted_as").agg(
        F.avg("value").alias("avg_metric"), F.stddev_pop("value").alias("std_metric")
    )
    return listed.join(sums, "fitted_as", "left").select(
        "grid_id", "params", "metric", "avg_metric", "std_metric", "fitted_as"
    )


# Ensembles


def beginning(model: Model, trees: int) -> Model:
    """The ensemble of the first trees of a fitted one, on a column ``features``."""
    java, context = model._java_obj, SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml
    boosted = isinstance(model, GBTClassificationModel)
    kind = ml.regression.DecisionTreeRegressionModel if boosted else ml.classification.DecisionTreeClassificationModel
    own = _array(context, kind, list(java.trees())[:trees])
    if boosted:
        weights = _array(context, context._jvm.double, list(java.treeWeights())[:trees])
        made = ml.classification.GBTClassificationModel(java.uid(), own, weights, java.numFeatures(), java.numClasses())
        return GBTClassificationModel(made)
    return RandomForestClassificationModel(
        ml.classification.RandomForestClassificationModel(java.uid(), own, java.numFeatures(), java.numClasses())
    )


def _array(context: SparkContext, kind, values: list):
    out = context._gateway.new_array(kind, len(values))
    for at, value in enumerate(values):
        out[at] = value
    return out


def deepest(model: Model) -> int:
    """The depth of the deepest tree."""
    return max((tree.depth for tree in model.trees), default=0)


# The settings that a forest on cells knows; any other is left to MLlib.
FOREST_SETTINGS = {"maxDepth", "maxBins", "minInstancesPerNode", "numTrees"}

SCORES = "label double, fold int, setting int, size int, score double, prediction double, weight bigint"


def grown_on_cells(
    rows: DataFrame, settings: Sequence[Mapping[str, Any]], folds: int
) -> tuple[dict[tuple[int, int], Problem], list[int]]:
    """Cells of each fold and number of bins, and the settings whose forests can be grown on them."""
    if not all(set(one) <= FOREST_SETTINGS for one in settings):
        return {}, []
    if dict(rows.dtypes)["fold"] not in ("tinyint", "smallint", "int", "bigint"):
        return {}, []
    if rows.agg(F.max("label")).first()[0] != 1:
        return {}, []
    most = [one["maxBins"] for one in settings]
    found = problems(rows.where("fold IS NOT NULL"), "features", "label", sorted(set(most)), "fold", range(folds))
    usable = {bins for bins in most if all(found[held, bins].limits is not None and found[held, bins].n <= MOST_CELLS for held in range(folds))}
    return found, [at for at, bins in enumerate(most) if bins in usable]


def cell_forests(
    rows: DataFrame,
    found: Mapping[tuple[int, int], Problem],
    settings: Mapping[int, Mapping[str, Any]],
    sizes: Sequence[int],
    folds: int,
) -> DataFrame:
    """Scores of the held cells by the forests of all settings and numbers of trees, one task for each forest.

    Settings that differ in their depth limit only are one forest.
    """
    nominal = categories(rows, "features")
    alike: dict[tuple[int, int], dict[int, int]] = {}
    for at, one in settings.items():
        alike.setdefault((one["maxBins"], one["minInstancesPerNode"]), {}).setdefault(one["maxDepth"], at)
    limits = {key: problem.limits for key, problem in found.items()}
    jobs = [(held, bins, leaf) for held in range(folds) for bins, leaf in alike]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        held, bins, leaf = (int(frame[name].iloc[0]) for name in ("held", "bins", "leaf"))
        x = np.stack(frame["cells"].to_numpy()).astype(np.int64)
        widths = [nominal.get(slot, 0) or len(limits[held, bins].get(slot, ())) + 1 for slot in range(x.shape[1])]
        # Cells of cut slots count from 1.
        x -= np.array([slot not in nominal for slot in range(x.shape[1])], np.int64)
        label, weight, inside = (frame[name].to_numpy() for name in ("label", "weight", "inside"))
        if (x[~inside] >= widths).any():
            raise ValueError("a category is not among those of its column's metadata")
        # Sorted, so that the draws do not depend on how the cells came here.
        kinds, at = np.unique(x[~inside], axis=0, return_inverse=True)
        counts = np.zeros((len(kinds), 2))
        np.add.at(counts, (at.ravel(), label[~inside].astype(int)), weight[~inside])
        if not counts[:, 1].any():
            raise ValueError(f"no row outside fold {held} has label 1")
        asked, back = np.unique(x[inside], axis=0, return_inverse=True)
        back, parts = back.ravel(), []
        depths = alike[bins, leaf]
        for depth, size, votes in forest_votes(
            kinds, counts, asked, widths, list(nominal), sorted(depths), leaf, sizes, (42, held, bins)
        ):
            total = votes.sum(axis=1)
            score = votes[:, 1] / np.where(total == 0, 1, total)
            guess = (votes[:, 1] > votes[:, 0]).astype(float)
            parts.append(pd.DataFrame({
                "label": label[inside], "fold": held, "setting": depths[depth], "size": size,
                "score": score[back], "prediction": guess[back], "weight": weight[inside].astype(int),
            }))
        return pd.concat(parts)

    tables = [
        found[held, bins].data.select(
            F.lit(held).alias("held"), F.lit(bins).alias("bins"), vector_to_array("features").alias("cells"), "label", "inside", "weight"
        )
        for held in range(folds)
        for bins in sorted({bins for bins, _ in alike})
    ]
    leaves = F.create_map(*[
        part
        for most in sorted({bins for bins, _ in alike})
        for part in (F.lit(most), F.array(*[F.lit(leaf) for bins, leaf in alike if bins == most]))
    ])
    cells = reduce(DataFrame.unionAll, tables).withColumn("leaf", F.explode(leaves[F.col("bins")]))
    keys = ("held", "bins", "leaf")
    # More partitions than forests, so that few share one; their number also keeps small ones from being put together.
    return cells.repartition(4 * len(jobs), *keys).groupBy(*keys).applyInPandas(run, SCORES)


def search_ensemble(
    kind: str,
    train: DataFrame,
    grid: Mapping[str, Sequence[Any]] | None = None,
    features: str = "features",
    label: str = "label",
    fold: str = "fold",
    folds: int = 10,
    metric: str | None = None,
    parallelism: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """Cross-validate a grid of boosted trees or forests: the table of ``tune``, and the folds' values.

    One fit serves all points of a fold that differ in the number of trees. For boosted trees
    that is exact: rounds do not depend on how many follow. A forest of the first trees
    of a larger one is a forest of so many independently drawn trees; its random draws are
    not those of a separate fit with the same seed. Where no tree of a fit reached its depth
    limit, points that differ in a higher limit only take its scores. Forests of rows in few cells are
    grown on the cells, where a tree's upper part is the tree of a lower limit. Scores are written
    to the shared folder, so that nothing is fitted again when an executor is lost. The folds'
    values are ``fitted_as, fold, value``.
    """
    use_checkpoint_dir(train.sparkSession)
    size = SIZES[kind]
    grid = dict(TUNING_GRIDS[kind] if grid is None else grid)
    metric = metric or TUNING_METRICS[kind]
    points = grid_points(grid)
    sizes = sorted(set(grid.pop(size)))
    settings = grid_points(grid)
    rows = train.select(named(features).alias("features"), named(label).alias("label"), named(fold).alias("fold"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    path = scratch_path(train.sparkSession, f"search-{kind}")

    def write(model: Model, setting: int, held: int) -> None:
        """Scores of all beginnings over the held rows, from one scan."""
        scored = rows.where(F.col("fold") == held)
        cells = []
        for at, trees in enumerate(sizes):
            part = beginning(model, trees)
            part.setPredictionCol(f"guess_{at}").setRawPredictionCol(f"raw_{at}").setProbabilityCol(f"chance_{at}")
            scored = part.transform(scored)
            cells.append(
                F.struct(
                    F.lit(trees).alias("size"),
                    vector_to_array(named(f"chance_{at}"))[1].alias("score"),
                    named(f"guess_{at}").alias("prediction"),
                )
            )
        out = scored.select("label", "fold", F.lit(setting).alias("setting"), F.inline(F.array(*cells)), F.lit(1).alias("weight"))
        out.to(T.StructType.fromDDL(SCORES)).write.parquet(f"{path}/of={setting}-{held}")

    base = classifier(kind, settings={})
    whole = [{**{name: base.getOrDefault(name) for name in ("maxDepth", "maxBins", "minInstancesPerNode")}, **one} for one in settings]

    def fit_family(family: list[int], held: int) -> None:
        done = None
        for setting in sorted(family, key=lambda at: settings[at].get("maxDepth", 0)):
            if done is None or deepest(done) >= done.getOrDefault("maxDepth"):
                estimator = classifier(kind, settings={}, **settings[setting], **{size: sizes[-1]})
                done = estimator.fit(rows.where(F.col("fold") != held).select("features", "label"))
            write(done, setting, held)

    try:
        rows.count()
        found, easy = grown_on_cells(rows, whole, folds) if kind == "random_forest" else ({}, [])
        if easy:
            cell_forests(rows, found, {at: whole[at] for at in easy}, sizes, folds).write.parquet(f"{path}/of=cells")
        # Settings that differ in nothing but their depth limit, the lowest limit first.
        families: dict[int, list[int]] = {}
        for at, first in enumerate(first_alike(settings, ("maxDepth",))):
            if at not in easy:
                families.setdefault(first, []).append(at)
        with ThreadPoolExecutor(parallelism) as pool:
            # The fits that take longest first, or a late one keeps all others waiting.
            jobs = [pool.submit(fit_family, family, held) for family in families.values() for held in range(folds)]
            for job in jobs:
                job.result()
    finally:
        rows.unpersist()
    scored = train.sparkSession.read.schema(SCORES).parquet(f"{path}/of=*")
    values = fold_metric(scored, metric, ["setting", "size", "fold"], "weight")
    # Each point is the setting and size it names.
    names = train.sparkSession.createDataFrame(
        [
            (at, settings.index({name: value for name, value in point.items() if name != size}), point[size])
            for at, point in enumerate(points)
        ],
        "fitted_as int, setting int, size int",
    )
    values = values.join(names, ["setting", "size"]).select("fitted_as", "fold", "value")
    return result_table(points, list(range(len(points))), metric, values), values
