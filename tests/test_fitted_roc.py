"""The curves of fitted models: rows are scored once, scores are counted once."""

import pytest

import tallyframe as tf
from tallyframe.operators.ordering import bucket_count
from tallyframe.sources import staged
from workload import queries
from workload.inputs import CODED, NUMERIC

SMALL = {"decision_tree": {"maxDepth": 4}, "gbt": {"maxDepth": 3, "maxIter": 3}, "random_forest": {"numTrees": 3}, "linear_svc": {"maxIter": 20}}


@pytest.fixture
def small_models(spark, monkeypatch):
    """Quick fits in place of the chosen ones."""
    made = {}

    def chosen(spark, sf_dir, kind):
        if kind not in made:
            made[kind] = tf.run_models(queries.prepared(spark, sf_dir), "id", NUMERIC, CODED, [kind], SMALL)
        return made[kind]

    monkeypatch.setattr(queries, "chosen_model", chosen)


def test_rows_are_scored_once(spark, sf_dir, small_models):
    found = queries.QUERIES["fitted_roc"].run(spark, sf_dir)
    assert "orders" not in found._jdf.queryExecution().executedPlan().toString()
    assert len(found.inputFiles()) > 0 and not [name for name in found.inputFiles() if "/steps-" not in name]
    rows = found.collect()
    assert len(rows) == 10 and all((r.starts, r.ends, r.falls, r.good_area) == (1, 1, 0, True) for r in rows)


def test_scores_are_dealt_once(spark, sf_dir, small_models, monkeypatch):
    """Both sides of the running sums read one shuffle of the counted scores."""
    plans = []

    def watched(df, name):
        out = staged(df, name)
        if name == "steps":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return out

    monkeypatch.setattr(queries, "staged", watched)
    queries.QUERIES["fitted_roc"].run(spark, sf_dir)
    assert len(plans) == 1 and "ReusedExchange" in plans[0] and plans[0].count("FileScan") == 1


def test_curves_of_counts_are_those_of_the_rows(spark):
    lines = [(i, "ab"[i % 2], float(i * 7 % 30) / 30, int(i % 3 == 0 or i > 150)) for i in range(200)] + [(200, "a", None, 1)]
    rows = spark.createDataFrame(lines, "id int, m string, score double, label int")
    counts = staged(tf.threshold_counts(rows, by=["m"]), "counts")
    for curve in (tf.roc_curve, tf.auc_roc):
        ours, theirs = curve(rows, by=["m"], counts=counts), curve(rows, by=["m"])
        assert ours.count() == theirs.count() > 1 and ours.exceptAll(theirs).count() == 0
    assert tf.roc_curve(rows, by=["m"], points=4, counts=counts).exceptAll(tf.roc_curve(rows, by=["m"], points=4)).count() == 0


def test_more_buckets_than_tasks(spark):
    """Buckets go to tasks by hash: one for each task leaves some tasks without any."""
    rows = spark.range(10)
    assert bucket_count(rows) >= 4 * int(spark.conf.get("spark.sql.shuffle.partitions")) and bucket_count(rows, 3) == 3
