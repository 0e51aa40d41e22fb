"""Tree fits on counted cells, against fits on the rows."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import tallyframe as tf
from tallyframe.operators import models
from tallyframe.operators.cells import NO_FOLD, cut_values, first_and_count, problems


@pytest.fixture(scope="module")
def data(spark):
    """Rows of three features, one with many values, and folds by key."""
    drawn = np.random.default_rng(5)
    x, code = drawn.normal(size=3000).round(4), drawn.integers(0, 4, 3000)
    label = (x + 0.5 * code + drawn.normal(size=3000) > 1).astype(int)
    lines = [(i, float(a), int(c), i % 2, int(y)) for i, (a, c, y) in enumerate(zip(x, code, label))]
    rows = spark.createDataFrame(lines, "id int, x double, code int, side int, label int")
    out = tf.fit_features(tf.tree_features(["x", "code", "side"]), tf.fold_column(rows, "id", 3))[1].coalesce(2).cache()
    yield out
    out.unpersist()


def test_cells_hold_every_row_once(data):
    problem = problems(data, "indexedFeatures", "label", [8], "fold", range(3))
    rows = data.count()
    for held in range(3):
        one = problem[held, 8]
        assert one.limits is not None and one.n <= 8 * 4 * 2 * 2 * 2 < rows / 2
        sizes = {r.inside: r.n for r in one.data.groupBy("inside").agg(F.sum("weight").alias("n")).collect()}
        assert sizes == {False: one.total, True: rows - one.total}
        assert sizes[True] == data.where(F.col("fold") == held).count()


def test_boosted_trees_on_cells_are_those_of_the_rows(data):
    settings = {"maxIter": 3, "maxDepth": 4, "minInstancesPerNode": 40}
    assert problems(data, "indexedFeatures", "label", [10])[NO_FOLD, 10].n < 400
    ours = tf.fit_classifier("gbt", data, "indexedFeatures", **settings)
    theirs = tf.classifier("gbt", "indexedFeatures", **settings).fit(data)
    assert ours.getMinInstancesPerNode() == 40 and ours.getMaxBins() == 10 and ours.getFeaturesCol() == "indexedFeatures"
    assert ours.trees[0].toDebugString.split("\n")[1:] == theirs.trees[0].toDebugString.split("\n")[1:]
    # The fit saw cells: a tree's root counts them, not the rows.
    assert ours.trees[0]._java_obj.rootNode().impurityStats().rawCount() < 400
    both = tf.predict(ours, data).select("id", "score").join(tf.predict(theirs, data).select("id", F.col("score").alias("s")), "id")
    assert both.where("abs(score - s) > 0.005").count() == 0


def test_leaves_of_more_than_half_the_rows_allow_no_split(data):
    model = tf.fit_classifier("gbt", data, "indexedFeatures", maxIter=2, minInstancesPerNode=1501)
    assert [tree.depth for tree in model.trees] == [0, 0] and model.getMaxDepth() == 30
    model = tf.fit_classifier("gbt", data, "indexedFeatures", maxIter=1, minInstancesPerNode=100)
    assert model.trees[0].depth > 1


def test_search_on_cells_is_many_fits(data, monkeypatch):
    """Areas of every point and fold against fits on the rows; the rows are fitted once, for the best point."""
    grid = {"maxBins": [6, 12], "minInstancesPerNode": [10, 200]}
    fitted, table = tf.tune("decision_tree", data, grid, "indexedFeatures", fold="fold", folds=3)
    for row in table.collect():
        own = []
        for fold in range(3):
            settings = {name: int(value) for name, value in row.params.items()}
            model = tf.classifier("decision_tree", "indexedFeatures", settings={}, **settings).fit(data.where(F.col("fold") != fold))
            own.append(BinaryClassificationEvaluator().evaluate(model.transform(data.where(F.col("fold") == fold))))
        assert row.avg_metric == pytest.approx(sum(own) / 3, abs=1e-9)
        assert row.std_metric == pytest.approx(np.std(own), abs=1e-9)
    best = tf.best_point(table).first()
    assert fitted.bestModel.getOrDefault("maxBins") == int(best.params["maxBins"])
    assert tf.predict(fitted.bestModel, data).where("score IS NULL").count() == 0
    # A search over cells alone does not fit the rows of a fold.
    seen = []
    made = models.classifier
    monkeypatch.setattr(models, "classifier", lambda *args, **params: seen.append(params) or made(*args, **params))
    tf.tune("decision_tree", data, {"maxBins": [6]}, "indexedFeatures", fold="fold", folds=3)
    assert [one.get("weightCol") for one in seen].count("weight") == 3


def test_a_fold_without_rows_is_refused(data):
    with pytest.raises(ValueError, match="empty"):
        tf.tune("decision_tree", data, {"maxBins": [6]}, "indexedFeatures", fold="fold", folds=4)
    with pytest.raises(ValueError, match="range"):
        tf.tune("decision_tree", data, {"maxBins": [6]}, "indexedFeatures", fold="fold", folds=2)


@pytest.mark.parametrize("label", [None, 0.5, -1.0])
def test_a_label_that_is_no_class_is_refused(data, label):
    wrong = F.when(F.col("id") == 7, F.lit(label).cast("double")).otherwise(F.col("label").cast("double"))
    with pytest.raises(Exception, match="whole numbers"):
        tf.fit_classifier("gbt", data.withColumn("label", wrong), "indexedFeatures", maxIter=1)


def test_few_rows_of_many_kinds_are_fitted_as_rows(spark):
    lines = [(float(i), float(i * 7 % 41), int(i % 3 == 0)) for i in range(40)]
    rows = tf.assemble(spark.createDataFrame(lines, "a double, b double, label int"), ["a", "b"])
    assert problems(rows, "features", "label", [32])[NO_FOLD, 32].limits is None
    assert tf.fit_classifier("gbt", rows, maxIter=1, minInstancesPerNode=5).numFeatures == 2


def test_spread_tasks_do_not_grow_with_the_table(spark, monkeypatch):
    from tallyframe.plans import modelling

    monkeypatch.setattr(modelling, "ROWS_A_TASK", 50)
    rows = spark.range(0, 2000, 1, 10)
    spread = modelling.spread_rows(rows, "id")
    sizes = spread.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert spread.rdd.getNumPartitions() == 40 and sizes[0] < 2 * 50 and sizes[1] == 2000
    monkeypatch.setattr(modelling, "ROWS_A_TASK", 100_000)
    assert modelling.spread_rows(rows, "id").rdd.getNumPartitions() == 10


def test_cut_points_and_counts():
    values = np.array([1.0, 2.0, 4.0, 8.0])
    assert cut_values(values, np.ones(4), 4) == [1.5, 3.0, 6.0]
    assert cut_values(values, np.array([5, 1, 1, 5]), 2) == [3.0]
    wide = [np.array([0, 1, 0, 1]) * 2**40, np.array([3, 3, 3, 3]) * 2**30, np.array([1, 0, 1, 0])]
    first, counts = first_and_count(wide)
    assert sorted(first.tolist()) == [0, 1] and counts.tolist() == [2, 2]
