import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import tallyframe as tf
from tallyframe.operators import models
from workload.inputs import CODED, FEATURES, NUMERIC
from workload.queries import prepared

SMALL = {
    "decision_tree": {"maxDepth": 5, "minInstancesPerNode": 20},
    "gbt": {"maxDepth": 3, "maxIter": 5, "minInstancesPerNode": 20},
    "random_forest": {"maxDepth": 5, "numTrees": 5},
    "linear_svc": {"maxIter": 50},
}


@pytest.fixture(scope="module")
def rows(spark):
    return prepared(spark, "/root/testdata/sf0.01").cache()


def test_one_hot_leaves_the_highest_code_out(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "b int")
    vectors = {tuple(r[0].toArray()) for r in tf.one_hot(df, ["b"]).collect()}
    assert vectors == {(0, 1, 0), (0, 0, 1), (0, 0, 0)}
    assert tf.one_hot(df, ["b"]).columns == ["b_OH"]


def test_one_hot_of_unseen_codes(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "b int")
    seen = df.where("b < 3")
    vectors = sorted(tuple(r[0].toArray()) for r in tf.one_hot(df, ["b"], fit_on=seen, keep_unseen=True).collect())
    assert vectors == [(0, 0, 0), (0, 0, 1), (0, 1, 0)]
    with pytest.raises(Exception, match="[Uu]nseen|invalid"):
        tf.one_hot(df, ["b"], fit_on=seen).collect()


def test_index_by_number_of_values(spark):
    df = spark.range(60).select((F.col("id") % 3 + 1).alias("few"), F.lit(7).alias("one"), F.col("id").alias("many"))
    out = tf.fit_features(tf.tree_features(["few", "one", "many"]), df)[1]
    wide = tf.vector_columns(out, "indexedFeatures", ["f", "o", "m"], ["few", "many"])
    for row in wide.collect():
        assert (row.f, row.o, row.m) == (row.few - 1, 0.0, row.many)


def test_constant_column_scales_to_zero(spark):
    df = spark.range(10).select(F.lit(7.0).alias("k"), F.col("id").alias("x"))
    out = tf.fit_features(tf.linear_features(["k", "x"], []), df)[1]
    cells = out.select(vector_to_array("features_scaled").alias("s"), vector_to_array("features").alias("n")).collect()
    assert all(row.s[0] == 0.0 for row in cells)
    for row in cells:
        assert sum(v * v for v in row.n) == pytest.approx(1.0)
    mean, sd = 4.5, (sum((i - 4.5) ** 2 for i in range(10)) / 9) ** 0.5
    assert sorted(row.s[1] for row in cells) == pytest.approx([(i - mean) / sd for i in range(10)])


def test_assemble_refuses_missing_cells(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    with pytest.raises(Exception):
        tf.assemble(df, ["x"]).collect()


@pytest.mark.parametrize("kind", list(models.CLASSIFIERS))
def test_every_classifier_learns(spark, rows, kind):
    run = tf.run_models(rows, "id", NUMERIC, CODED, [kind], SMALL)
    out = run.predictions.cache()
    assert out.count() == rows.count()
    assert out.where("score IS NULL OR prediction NOT IN (0, 1)").count() == 0
    test = out.where("part = 'test'")
    assert tf.auc_roc(test).first().auc > (0.9 if kind in ("logistic", "gbt") else 0.85)
    if kind != "linear_svc":
        assert out.where("score < 0 OR score > 1").count() == 0
    assert {r.part for r in run.comparison().collect()} == {"train", "test"}
    out.unpersist()


def test_models_do_not_depend_on_partitions(spark, rows):
    few = tf.run_models(rows.coalesce(1), "id", NUMERIC, CODED, ["decision_tree"], SMALL)
    many = tf.run_models(rows.repartition(8), "id", NUMERIC, CODED, ["decision_tree"], SMALL)
    assert few.predictions.exceptAll(many.predictions).count() == 0


def test_fit_on_all_rows_keeps_the_old_encoding(spark, rows):
    run = tf.run_models(rows, "id", NUMERIC, CODED, ["logistic"], fit_scope="all")
    encoder = run.features["linear"].stages[0]
    assert encoder.getOrDefault("handleInvalid") == "error"
    scaler = run.features["linear"].stages[2]
    train = tf.split_column(rows, "id").where("part = 'train'")
    assert scaler.mean[0] == pytest.approx(train.agg(F.avg("bmi")).first()[0])
    assert run.roc().where("part = 'test' AND threshold IS NULL").count() == 1
    with pytest.raises(ValueError):
        tf.run_models(rows, "id", NUMERIC, CODED, ["logistic"], fit_scope="test")


def test_linear_score_is_the_model(spark, rows):
    data = tf.assemble(rows, FEATURES)
    model = LogisticRegression(maxIter=5, regParam=0.1).fit(data)
    weights = dict(zip(FEATURES, map(float, model.coefficients)))
    ours = tf.linear_score(rows, weights, model.intercept).select("id", "score", "prediction")
    theirs = tf.predict(model, data).select("id", F.col("score").alias("s"), F.col("prediction").alias("p"))
    joined = ours.join(theirs, "id")
    assert joined.where("abs(score - s) > 1e-9 OR prediction <> p").count() == 0


def test_grid_search(spark, rows):
    data = tf.fold_column(tf.fit_features(tf.tree_features(FEATURES), rows)[1], "id", 3)
    grid = {"maxDepth": [1, 4], "maxBins": [8]}
    fitted, table = tf.tune("decision_tree", data, grid, "indexedFeatures", fold="fold", folds=3)
    found = table.orderBy("grid_id").collect()
    assert [r.params for r in found] == [{"maxDepth": "1", "maxBins": "8"}, {"maxDepth": "4", "maxBins": "8"}]
    assert {r.metric for r in found} == {"areaUnderROC"}
    best = max(found, key=lambda r: r.avg_metric)
    assert tf.best_point(table).first().grid_id == best.grid_id
    assert fitted.bestModel.getOrDefault("maxDepth") == grid["maxDepth"][best.grid_id]


def test_first_of_equal_points_is_best(spark):
    table = spark.createDataFrame(
        [(0, {"a": "1"}, "f1", 0.5, 0.0), (1, {"a": "2"}, "f1", 0.7, 0.0), (2, {"a": "3"}, "f1", 0.7, 0.0)],
        "grid_id int, params map<string,string>, metric string, avg_metric double, std_metric double",
    )
    assert tf.best_point(table).first().grid_id == 1


def test_fixed_settings_are_valid(spark):
    sizes = {"logistic": 120, "linear_svc": 810, "decision_tree": 16, "gbt": 60, "random_forest": 54}
    for kind, grid in models.TUNING_GRIDS.items():
        size = 1
        for name, values in grid.items():
            size *= len(values)
            assert tf.classifier(kind).hasParam(name)
        assert size == sizes[kind]
    assert tf.classifier("gbt").getMaxDepth() == 30
    assert tf.classifier("gbt", settings={}).getMaxDepth() == 5


def test_points_with_the_same_metric_share_fits(spark, rows):
    data = tf.fold_column(tf.assemble(rows, FEATURES), "id", 2)
    grid = {"threshold": [0.0, 0.2], "regParam": [0.01, 10.0], "maxIter": [5]}
    _, table = tf.tune("linear_svc", data, grid, fold="fold", folds=2)
    found = table.collect()
    assert len(found) == 4 and len({str(sorted(r.params.items())) for r in found}) == 4
    assert len({r.fitted_as for r in found}) == 2 and all(r.fitted_as <= r.grid_id for r in found)
    by_reg = {}
    for r in found:
        by_reg.setdefault(r.params["regParam"], set()).add((r.avg_metric, r.std_metric))
    assert len(by_reg) == 2 and all(len(values) == 1 for values in by_reg.values())
    alone = {"threshold": [0.2], "regParam": [0.01], "maxIter": [5]}
    _, single = tf.tune("linear_svc", data, alone, fold="fold", folds=2)
    assert single.first().avg_metric == pytest.approx(next(iter(by_reg["0.01"]))[0], abs=1e-6)
    # Accuracy does depend on the threshold.
    points = [p for p in models.ParamGridBuilder().addGrid(models.LinearSVC.threshold, [0.0, 0.2]).build()]
    assert models.distinct_points(points, "accuracy") == [0, 1]
    assert models.distinct_points(points, "areaUnderROC") == [0, 0]


def matrix_of(rows, features, fold):
    """Features of the rows outside a fold, and of those in it, by MLlib stages fitted outside it."""
    outside, inside = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
    fitted = features.fit(outside)
    return fitted.transform(outside), fitted.transform(inside)


def test_logistic_search_is_many_fits(spark, rows):
    """Solutions of all points and folds, against MLlib's fits on features made fold by fold."""
    data = tf.fold_column(rows, "id", 3).cache()
    grid = {"elasticNetParam": [0.0, 1.0], "fitIntercept": [False, True], "maxIter": [10, 1000], "regParam": [0.0001, 0.1]}
    table, solved = tf.search_logistic(data, NUMERIC, CODED, grid, folds=3)
    found = table.orderBy("grid_id").collect()
    assert [r.grid_id for r in found] == list(range(16)) and all(r.violation <= 1e-8 for r in found)
    assert [r.fitted_as for r in found] == [0, 1, 0, 1, 4, 5, 4, 5, 8, 9, 8, 9, 12, 13, 12, 13]
    by_problem = {(r.fitted_as, r.fold): r for r in solved.collect()}
    assert len(by_problem) == 8 * 3
    for point, fold in ((0, 0), (5, 1), (8, 2), (13, 0)):
        ours = by_problem[point, fold]
        outside, inside = matrix_of(data, tf.linear_features(NUMERIC, CODED), fold)
        settings = {name: eval(value.capitalize()) for name, value in found[point].params.items()}  # noqa: S307
        model = LogisticRegression(**{**settings, "maxIter": 2000, "tol": 1e-12}).fit(outside)
        width = len(ours.coefficients)
        # One slot for unseen codes is empty in MLlib's vectors; ours follow the codes that occur.
        theirs = tf.predict(model, inside)
        by_theirs = tf.auc_roc(theirs).first().auc
        assert ours.value == pytest.approx(by_theirs, abs=2e-4), (point, fold, width)
        ours_norm, theirs_norm = sum(abs(v) for v in ours.coefficients), sum(abs(v) for v in model.coefficients)
        assert ours_norm == pytest.approx(theirs_norm, rel=0.02, abs=1e-4)
    mean = sum(by_problem[0, fold].value for fold in range(3)) / 3
    assert found[0].avg_metric == pytest.approx(mean) == found[2].avg_metric


def test_logistic_search_does_not_depend_on_partitions(spark, rows):
    data = tf.fold_column(rows.limit(2000), "id", 2)
    grid = {"elasticNetParam": [0.5], "fitIntercept": [True], "regParam": [0.01]}
    one = tf.search_logistic(data.coalesce(1), NUMERIC, CODED, grid, folds=2)[0].first()
    many = tf.search_logistic(data.repartition(13), NUMERIC, CODED, grid, folds=2)[0].first()
    assert one.avg_metric == pytest.approx(many.avg_metric, abs=1e-9)


def test_folds_do_not_see_their_own_rows(spark):
    """Scaling of a fold is that of the other folds; a code only it has gets no weight."""
    lines = [(i, float(i * i), 1 if i < 12 else 2, i % 3) for i in range(24)] + [(24, 5.0, 9, 2), (25, 6.0, 9, 2)]
    data = spark.createDataFrame(lines, "id int, x double, code int, fold int").repartition(5)
    made = tf.fold_features(data, ["x"], ["code"], folds=3)
    assert made.slots == (("code", 1), ("code", 2), ("code", 9))
    for fold in range(3):
        rest = [line for line in lines if line[3] != fold]
        for at, value in enumerate([lambda r: r[1], *[lambda r, c=c: float(r[2] == c) for c in (1, 2, 9)]]):
            cells = [value(line) for line in rest]
            mean = sum(cells) / len(cells)
            deviation = (sum((c - mean) ** 2 for c in cells) / (len(cells) - 1)) ** 0.5
            assert made.means[fold][at] == pytest.approx(mean)
            assert made.scales[fold][at] == (pytest.approx(1 / deviation) if deviation else 0.0)
    assert made.scales[2][3] == 0.0 and made.scales[0][3] > 0


def test_quadratic_steps_reach_the_optimum():
    import numpy as np

    from tallyframe.operators.logistic_search import quadratic_step

    random = np.random.default_rng(4)
    for _ in range(200):
        k = int(random.integers(1, 9))
        root = random.normal(size=(k + 2, k))
        curve, slope, u = root.T @ root, random.normal(size=k) * 3, random.normal(size=k) * random.integers(0, 2, k)
        l1, l2 = np.full(k, random.choice([0.0, 0.5, 3.0])), np.full(k, random.choice([0.0, 0.1]))
        step = quadratic_step(u, slope, curve, l1, l2, 1e-8)
        smooth, place = slope + curve @ step + l2 * (u + step), u + step
        wrong = np.where(place != 0, smooth + l1 * np.sign(place), np.sign(smooth) * np.maximum(np.abs(smooth) - l1, 0))
        assert np.abs(wrong).max() < 1e-6


@pytest.mark.parametrize("kind, metric", [("gbt", "areaUnderROC"), ("random_forest", "f1")])
def test_ensemble_search_is_many_fits(spark, rows, kind, metric):
    """Points scored by beginnings, against separate fits; limits that no tree reached share a fit."""
    data = tf.fold_column(tf.fit_features(tf.tree_features(FEATURES), rows.limit(1500))[1], "id", 2).coalesce(1).cache()
    size = "maxIter" if kind == "gbt" else "numTrees"
    grid = {"maxDepth": [2, 8, 12], "maxBins": [8], size: [1, 3], "minInstancesPerNode": [60]}
    table, values = tf.search_ensemble(kind, data, grid, "indexedFeatures", folds=2, parallelism=2)
    found = table.orderBy("grid_id").collect()
    assert [r.params[size] for r in found] == ["1", "3"] * 3 and {r.metric for r in found} == {metric}
    assert found[2].avg_metric == found[4].avg_metric and found[3].avg_metric == found[5].avg_metric
    held = {(r.fitted_as, r.fold): r.value for r in values.collect()}
    assert len(held) == 12
    for point in ((0, 1, 5) if kind == "gbt" else (1, 5)):
        settings = {name: int(value) for name, value in found[point].params.items()}
        own = []
        for fold in (0, 1):
            model = tf.classifier(kind, "indexedFeatures", settings={}, **settings).fit(data.where(F.col("fold") != fold))
            scored = tf.predict(model, data.where(F.col("fold") == fold))
            one = tf.auc_roc(scored).first().auc if metric == "areaUnderROC" else tf.weighted_f1(scored).first().weighted_f1
            assert held[point, fold] == pytest.approx(one, abs=1e-12)
            own.append(one)
        assert found[point].avg_metric == pytest.approx(sum(own) / 2)
    # A forest of the first tree is a forest of one tree, not that of a fit with one tree.
    assert all(0.3 <= r.avg_metric <= 1 for r in found)


def test_runs_are_joined(spark, rows):
    runs = [tf.run_models(rows, "id", NUMERIC, CODED, [kind], SMALL) for kind in ("decision_tree", "logistic")]
    both = tf.join_models(rows, "id", runs)
    assert set(both.models) == {"decision_tree", "logistic"}
    for run in runs:
        kind = next(iter(run.models))
        mine = both.predictions.where(F.col("model") == kind)
        assert mine.exceptAll(run.predictions).count() == 0 and mine.count() == rows.count()
    with pytest.raises(ValueError):
        tf.join_models(rows, "id", [runs[0], runs[0]])
