import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import tallyframe as tf

TINY = [(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.5, 0)]


def matrix(spark, n11, n10, n01, n00):
    rows = [(1, 1, n11), (1, 0, n10), (0, 1, n01), (0, 0, n00)]
    return spark.createDataFrame(rows, "label int, prediction int, n bigint")


# Two published confusion matrices and the metrics printed for them.
PUBLISHED = [
    ((6630, 1723, 2371, 5797), 0.7521941771, 0.7708776596, 0.7097208619, 0.7390362060),
    ((27063, 6370, 9303, 24298), 0.7661932751, 0.7922916395, 0.7231332401, 0.7561343727),
]


@pytest.mark.parametrize("cells, accuracy, precision, recall, f_measure", PUBLISHED)
def test_published_metrics(spark, cells, accuracy, precision, recall, f_measure):
    rows = tf.metric_rows(tf.metrics_table(matrix(spark, *cells))).collect()
    found = {(row.metric, row["class"]): row.value for row in rows}
    assert found["accuracy", None] == pytest.approx(accuracy)
    assert found["error", None] == pytest.approx(1 - accuracy)
    assert found["precision", 0] == pytest.approx(precision)
    assert found["recall", 0] == pytest.approx(recall)
    assert found["f_measure", 0] == pytest.approx(f_measure)
    if cells[0] == 6630:
        assert found["precision", 1] == pytest.approx(0.7365848239)
        assert found["recall", 1] == pytest.approx(0.7937268047)


def test_empty_cells_and_odd_codes(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0), (3, 2.0), (None, 1.0), (1, None)], "label int, prediction double")
    cells = {(r.label, r.prediction): r.n for r in tf.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_classes_that_do_not_occur(spark):
    table = tf.metrics_table(matrix(spark, 0, 0, 0, 4)).first()
    assert table.precision_1 == 0.0 and table.recall_1 is None and table.f_measure_1 is None
    assert table.accuracy == table.weighted_f == 1.0
    assert tf.metrics_table(matrix(spark, 0, 4, 0, 0)).first().f_measure_1 == 0.0


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(7)
    label = rng.integers(0, 2, 3000)
    # Adding zero turns -0.0 to 0.0, which MLlib counts as two thresholds.
    score = np.clip((label + rng.normal(size=3000)) / 3, -1, 2).round(2) + 0.0
    rows = [(int(a), float(s), float(s > 0.2), "m" if i % 3 else "n") for i, (a, s) in enumerate(zip(label, score))]
    return spark.createDataFrame(rows, "label int, score double, prediction double, model string").cache()


def test_metrics_are_mllibs(spark, predictions):
    df = predictions.select(F.col("label").cast("double"), "prediction")
    table = tf.metrics_table(tf.confusion_matrix(df, by=[]), beta=2.0).first()

    def native(name, **options):
        return MulticlassClassificationEvaluator(metricName=name, **options).evaluate(df)

    assert table.accuracy == pytest.approx(native("accuracy"))
    for side in (0, 1):
        assert table[f"precision_{side}"] == pytest.approx(native("precisionByLabel", metricLabel=float(side)))
        assert table[f"recall_{side}"] == pytest.approx(native("recallByLabel", metricLabel=float(side)))
        assert table[f"f_measure_{side}"] == pytest.approx(native("fMeasureByLabel", metricLabel=float(side), beta=2.0))
    assert tf.weighted_f1(df).first().weighted_f1 == pytest.approx(native("f1"))


def test_auc_is_mllibs(spark, predictions):
    df = predictions.select(
        F.col("label").cast("double"), "score", array_to_vector(F.array(-F.col("score"), "score")).alias("rawPrediction")
    )
    exact = BinaryClassificationEvaluator(numBins=0).evaluate(df)
    for buckets in (2, 7, 200):
        assert tf.auc_roc(df, buckets=buckets).first().auc == pytest.approx(exact)
    by_model = {r.model: r.auc for r in tf.auc_roc(predictions, by=["model"]).collect()}
    only = tf.auc_roc(predictions.where("model = 'n'")).first().auc
    assert by_model["n"] == pytest.approx(only) and by_model.keys() == {"m", "n"}


def points(df):
    return [(r.fpr, r.tpr) for r in df.orderBy("fpr", "tpr").collect()]


def test_tiny_roc(spark):
    df = spark.createDataFrame(TINY, "score double, label int")
    third = 1 / 3
    want = [(0, 0), (0, third), (0, 2 * third), (0.5, 2 * third), (0.5, 1), (1, 1)]
    assert points(tf.roc_curve(df)) == [pytest.approx(p) for p in want]
    assert tf.auc_roc(df).first().auc == pytest.approx(5 / 6)
    start = tf.roc_curve(df).where("threshold IS NULL").collect()
    assert [(r.fpr, r.tpr) for r in start] == [(0.0, 0.0)]


def test_roc_of_equal_scores(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 1), (0.5, 0)], "score double, label int")
    assert points(tf.roc_curve(df)) == [(0.0, 0.0), (1.0, 1.0)]
    assert tf.auc_roc(df).first().auc == 0.5


def test_roc_of_one_class(spark):
    df = spark.createDataFrame([(0.5, 1), (0.7, 1)], "score double, label int")
    assert tf.auc_roc(df).first().auc is None
    assert {r.fpr for r in tf.roc_curve(df).where("threshold IS NOT NULL").collect()} == {None}


def test_pr_curve(spark):
    df = spark.createDataFrame(TINY, "score double, label int")
    found = [(r.threshold, r.recall, r.precision) for r in tf.pr_curve(df).orderBy(F.desc_nulls_first("threshold")).collect()]
    assert found[0] == (None, 0.0, 1.0)
    assert found[1:] == [
        (0.9, pytest.approx(1 / 3), 1.0),
        (0.8, pytest.approx(2 / 3), 1.0),
        (0.7, pytest.approx(2 / 3), pytest.approx(2 / 3)),
        (0.6, 1.0, 0.75),
        (0.5, 1.0, 0.6),
    ]


def test_curves_by_threshold(spark):
    df = spark.createDataFrame(TINY, "score double, label int")
    precision = {r.threshold: r.precision for r in tf.precision_by_threshold(df).collect()}
    recall = {r.threshold: r.recall for r in tf.recall_by_threshold(df).collect()}
    measure = {r.threshold: r.f_measure for r in tf.f_measure_by_threshold(df, beta=2.0).collect()}
    for cut in (0.9, 0.8, 0.7, 0.6, 0.5):
        tp = sum(y for s, y in TINY if s >= cut)
        flagged = sum(s >= cut for s, _ in TINY)
        p, r = tp / flagged, tp / 3
        assert precision[cut] == pytest.approx(p) and recall[cut] == pytest.approx(r)
        assert measure[cut] == pytest.approx(5 * p * r / (4 * p + r))


def test_bucketed_curve_is_the_plain_window(spark):
    df = tf.read_table(spark, "/root/testdata/sf0.01/lineitem.parquet").where("l_returnflag IN ('R', 'N')")
    df = df.select((F.col("l_extendedprice") / 200000).alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    found = tf.threshold_curves(df, buckets=100)
    plain = df.groupBy("score").agg(F.sum("label").alias("hits"), F.count("*").alias("n"))
    plain = plain.orderBy(F.desc("score")).toPandas()
    plain["tp"], plain["all"] = plain.hits.cumsum(), plain.n.cumsum()
    ours = found.orderBy(F.desc("threshold")).toPandas()
    assert ours.threshold.tolist() == plain.score.tolist()
    assert ours.tp.tolist() == plain.tp.tolist()
    assert (ours.tp + ours.fp).tolist() == plain["all"].tolist()


def test_compare_orders_by_metric(spark, predictions):
    table = tf.compare_models(predictions, ["model"], metric="recall_1").collect()
    assert [r.model for r in sorted(table, key=lambda r: -r.recall_1)] == [r.model for r in table]


def test_thinned_curve_is_part_of_the_exact_one(spark, predictions):
    exact = {(r.model, r.threshold, r.fpr, r.tpr) for r in tf.roc_curve(predictions, by=["model"]).collect()}
    thin = [(r.model, r.threshold, r.fpr, r.tpr) for r in tf.roc_curve(predictions, by=["model"], points=20).collect()]
    assert set(thin) <= exact and len(thin) == len(set(thin)) < len(exact)
    for model in ("m", "n"):
        mine = [p for p in thin if p[0] == model]
        assert 10 < len(mine) <= 22
        assert (model, None, 0.0, 0.0) in mine and any(p[2:] == (1.0, 1.0) for p in mine)


def test_nan_scores_are_left_out(spark):
    df = spark.createDataFrame([(float("nan"), 1), (0.9, 0), (0.1, 1)], "score double, label int")
    assert tf.auc_roc(df).first().auc == 0.0
