"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import tallyframe as tf
from workload.inputs import CODED, NUMERIC, survey
from workload.queries import QUERIES, pair_scored, prepared, scored

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Model fits run many jobs before there is a plan to look at.
PLANNED = [name for name in QUERIES if not name.startswith(("fit", "cv_", "pipeline_"))]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    text = plan(QUERIES[name].run(spark, sf_dir))
    assert not [word for word in BANNED if word in text]


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


def test_running_sums_scan_once(spark, sf_dir):
    text = final_plan(tf.auc_roc(scored(spark, sf_dir), score="margin"))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_no_window_over_the_rows_in_one_task(spark, sf_dir):
    """The only single task works on bucket totals."""
    text = plan(tf.roc_curve(scored(spark, sf_dir), score="margin"))
    below = text[text.index("SinglePartition") :].splitlines()[1]
    assert "keys=[bucket" in below
    assert text.count("SinglePartition") == 1
    by_model = scored(spark, sf_dir).withColumn("model", F.col("genhlth"))
    assert "SinglePartition" not in plan(tf.roc_curve(by_model, score="margin", by=["model"]))


def test_share_counts_once(spark, sf_dir, capsys):
    """The total is a subquery over the same shuffle."""
    shares = tf.group_count(tf.read_table(spark, f"{sf_dir}/events.parquet"), "event_type", share=True)
    shares.collect()
    shares.explain("formatted")
    subquery = capsys.readouterr().out.split("===== Subqueries =====")[1]
    assert "ReusedExchange" in subquery.split("Initial Plan")[0]


def test_scans_read_only_what_is_asked(spark, sf_dir):
    text = plan(tf.missing_profile(survey(spark, sf_dir).select("bmi")))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    prices = tf.read_table(spark, f"{sf_dir}/lineitem.parquet")
    text = plan(tf.summary_stats(prices, ["l_tax"]))
    assert set(part.split(">")[0] for part in text.split("ReadSchema: struct<")[1:]) == {"l_tax:double"}


def test_row_filters_are_pushed_to_the_scan(spark, sf_dir):
    rows = tf.read_table(spark, f"{sf_dir}/lineitem.parquet").select("l_quantity", "l_discount")
    text = plan(tf.apply_rules(rows, [tf.below("l_quantity", 10), tf.keep("l_discount", 0.01, 0.02)]))
    pushed = text[text.index("PushedFilters") :]
    assert "LessThan(l_quantity,10" in pushed and "In(l_discount" in pushed


def test_choices_need_no_shuffle(spark, sf_dir):
    rows = scored(spark, sf_dir)
    for out in (
        tf.split_column(rows, "id"),
        tf.fold_column(rows, "id"),
        tf.stratified_sample(rows, "label", {1: 1.0, 0: 0.2}, "id"),
    ):
        assert "Exchange" not in plan(out)


def test_profiles_shuffle_one_row_per_task(spark, sf_dir):
    for out in (
        tf.missing_profile(survey(spark, sf_dir)),
        tf.target_corr(survey(spark, sf_dir), "bmi", ["genhlth", "michd"]),
        tf.confusion_matrix(scored(spark, sf_dir)),
        tf.rule_audit(survey(spark, sf_dir), [tf.drop("genhlth", 9)]),
    ):
        text = plan(out)
        assert text.count("Exchange") == 1 and "partial_" in text


def test_all_models_score_in_one_scan(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    run = tf.run_models(rows, "id", NUMERIC, CODED, ["logistic", "linear_svc", "decision_tree"])
    assert final_plan(run.comparison()).count("FileScan") == 1
    assert final_plan(run.predictions).count("FileScan") == 1
    assert final_plan(pair_scored(spark, sf_dir)).count("FileScan") == 1
