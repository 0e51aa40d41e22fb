"""Forests grown on cells, against MLlib's forests on the rows."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import tallyframe as tf
from tallyframe.operators import search
from tallyframe.operators.cells import NO_FOLD, categories, problems
from tallyframe.operators.forest import forest_votes, grow

GRID = {"maxDepth": [2, 30], "maxBins": [8, 12], "numTrees": [2, 40], "minInstancesPerNode": [10, 150]}


@pytest.fixture(scope="module")
def data(spark):
    """Rows of four features, two with many values, and folds by key."""
    drawn = np.random.default_rng(8)
    x, z, code = drawn.normal(size=9000).round(3), drawn.integers(0, 40, 9000), drawn.integers(0, 7, 9000)
    label = (x + np.array([0, 2, -1, 1, 0, 3, -2])[code] + drawn.normal(size=9000) > 1).astype(int)
    lines = [(i, float(a), int(b), int(c), i % 2, int(y)) for i, (a, b, c, y) in enumerate(zip(x, z, code, label))]
    rows = spark.createDataFrame(lines, "id int, x double, z int, code int, side int, label int")
    out = tf.fit_features(tf.tree_features(["x", "z", "code", "side"]), tf.fold_column(rows, "id", 3))[1].coalesce(2).cache()
    yield out
    out.unpersist()


def cells_of(data, bins):
    """Cells of all rows with their counts of both classes, numbers of bins and categories."""
    problem, nominal = problems(data, "indexedFeatures", "label", [bins])[NO_FOLD, bins], categories(data, "indexedFeatures")
    lines = problem.data.select(vector_to_array("features").alias("x"), "label", "weight").collect()
    x = np.array([line.x for line in lines]).astype(int)
    x -= np.array([at not in nominal for at in range(x.shape[1])], int)
    counts = np.zeros((len(x), 2))
    counts[np.arange(len(x)), [int(line.label) for line in lines]] = [line.weight for line in lines]
    widths = [nominal.get(at) or len(problem.limits[at]) + 1 for at in range(x.shape[1])]
    return x, counts, widths, list(nominal), problem.limits


@pytest.mark.parametrize("depth, leaf", [(0, 1), (4, 300), (12, 40)])
def test_a_tree_of_all_rows_and_features_is_that_of_mllib(data, depth, leaf):
    x, counts, widths, nominal, limits = cells_of(data, 12)
    grown = grow(x, counts[None], widths, nominal, max(depth, 14), leaf, len(widths), np.random.default_rng(1))
    theirs = RandomForestClassifier(
        featuresCol="indexedFeatures", maxBins=12, maxDepth=depth, minInstancesPerNode=leaf, numTrees=1,
        bootstrap=False, featureSubsetStrategy="all",
    ).fit(data)
    lines = tf.predict(theirs, data).select(vector_to_array("indexedFeatures").alias("x"), "score").limit(3000).collect()
    asked = np.array([
        [np.searchsorted(limits[at], v) if at in limits and at not in nominal else v for at, v in enumerate(line.x)] for line in lines
    ]).astype(int)
    # A tree of a lower limit is the upper part of that of a higher one.
    ours = grown.votes(asked, 1, depth)[0]
    assert np.allclose(ours[:, 1], [line.score for line in lines], atol=1e-12)
    assert len({round(line.score, 9) for line in lines}) > (1 if depth else 0)


def test_bags_count_rows(data):
    """A forest of stumps without splits votes by the shares of its bags, which vary as bags of rows do."""
    x, counts, widths, nominal, _ = cells_of(data, 8)
    share, n = counts[:, 1].sum() / counts.sum(), counts.sum()
    votes, before = [], 0.0
    for depth, size, summed in forest_votes(x, counts, x[:1], widths, nominal, [0], 1, list(range(1, 401)), (42, 0, 8)):
        votes.append(summed[0, 1] - before)
        before = summed[0, 1]
    assert len(votes) == 400 and np.mean(votes) == pytest.approx(share, abs=0.002)
    assert np.std(votes) == pytest.approx((share * (1 - share) / n) ** 0.5, rel=0.15)


def test_nodes_are_cut_in_parts_without_a_difference(data, monkeypatch):
    from tallyframe.operators import forest

    x, counts, widths, nominal, _ = cells_of(data, 12)
    bags = np.random.default_rng(3).poisson(counts, (5, *counts.shape)).astype(float)
    whole = grow(x, bags, widths, nominal, 30, 5, 2, np.random.default_rng(9))
    monkeypatch.setattr(forest, "COUNTS", 40)
    parts = grow(x, bags, widths, nominal, 30, 5, 2, np.random.default_rng(9))
    assert (whole.feature == parts.feature).all() and (whole.counts == parts.counts).all()
    assert (whole.votes(x, 5, 30) == parts.votes(x, 5, 30)).all()


def test_search_grows_forests_on_cells(data, monkeypatch):
    """No forest is fitted on rows, and the points are as good as MLlib's own fits."""
    made = search.classifier
    fitted = []

    def watched(*args, **params):
        out = made(*args, **params)
        fit = out.fit
        out.fit = lambda *rest: fitted.append(params) or fit(*rest)
        return out

    monkeypatch.setattr(search, "classifier", watched)
    table, values = tf.search_ensemble("random_forest", data, GRID, "indexedFeatures", folds=3)
    found = table.orderBy("grid_id").collect()
    assert not fitted and len(found) == 16 and values.count() == 48
    for row in (found[2], found[14], found[15]):
        settings = {name: int(value) for name, value in row.params.items()}
        own = []
        for fold in range(3):
            model = tf.classifier("random_forest", "indexedFeatures", settings={}, **settings).fit(data.where(F.col("fold") != fold))
            own.append(tf.weighted_f1(tf.predict(model, data.where(F.col("fold") == fold))).first().weighted_f1)
        assert row.avg_metric == pytest.approx(sum(own) / 3, abs=0.015), settings
    again = tf.search_ensemble("random_forest", data.repartition(7), GRID, "indexedFeatures", folds=3, metric="areaUnderROC")[0]
    same = tf.search_ensemble("random_forest", data, GRID, "indexedFeatures", folds=3, metric="areaUnderROC")[0]
    ours, theirs = ([row.avg_metric for row in one.orderBy("grid_id").collect()] for one in (again, same))
    assert ours == pytest.approx(theirs, abs=1e-12) and min(ours) > 0.7


def test_rows_without_a_fold_are_in_no_forest(data):
    grid = {"maxDepth": [3], "maxBins": [8], "numTrees": [3], "minInstancesPerNode": [10]}
    unplaced = data.withColumn("label", 1 - F.col("label")).withColumn("fold", F.lit(None).cast("int"))
    both = tf.search_ensemble("random_forest", data.unionAll(unplaced), grid, "indexedFeatures", folds=3)[0].first()
    assert both.avg_metric == pytest.approx(tf.search_ensemble("random_forest", data, grid, "indexedFeatures", folds=3)[0].first().avg_metric, abs=1e-12)


def test_other_settings_and_more_classes_are_left_to_mllib(data):
    rows = data.select(F.col("indexedFeatures").alias("features"), "label", "fold")
    one = {"maxDepth": 3, "maxBins": 8, "minInstancesPerNode": 10}
    assert search.grown_on_cells(rows, [one], 3)[1] == [0]
    assert search.grown_on_cells(rows, [{**one, "impurity": "entropy"}], 3)[1] == []
    assert search.grown_on_cells(rows.withColumn("label", F.col("label") * 2), [one], 3)[1] == []


def test_weights_stand_for_equal_rows(spark):
    lines = [(0.1, 0, 0.0, 3), (0.4, 1, 0.0, 2), (0.4, 0, 1.0, 5), (0.8, 1, 1.0, 4), (0.9, 1, 1.0, 1), (0.9, 0, 1.0, 0)]
    counted = spark.createDataFrame(lines, "score double, label int, prediction double, n bigint")
    rows = counted.select("*", F.explode(F.expr("CASE WHEN n > 0 THEN sequence(1, n) ELSE array() END")))
    assert tf.weighted_f1(counted, weight="n").collect() == tf.weighted_f1(rows).collect()
    assert tf.auc_roc(counted, weight="n").first().auc == pytest.approx(tf.auc_roc(rows).first().auc, abs=1e-15)
    assert tf.confusion_matrix(counted, weight="n").collect() == tf.confusion_matrix(rows).collect()
