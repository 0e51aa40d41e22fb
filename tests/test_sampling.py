import warnings

import pytest
from pyspark.sql import functions as F

import tallyframe as tf
from tallyframe.functions.hashing import hash_unit


def test_split_does_not_depend_on_partitions(spark):
    orders = tf.read_table(spark, "/root/testdata/sf0.01/orders.parquet").select("o_orderkey")
    want = None
    for n in (1, 8):
        train = tf.split_column(orders.repartition(n), "o_orderkey").where("part = 'train'")
        assert train.count() == 11957
        keys = train.agg(F.sum(F.xxhash64("o_orderkey") % 1000003)).first()[0]
        assert want in (None, keys)
        want = keys


def test_split_weights(spark):
    df = tf.split_column(spark.range(20000), "id", {"a": 2, "b": 1, "c": 1})
    n = {r.part: r.n for r in tf.group_count(df, "part").collect()}
    assert sum(n.values()) == 20000
    assert n["a"] == pytest.approx(10000, rel=0.05) and n["b"] == pytest.approx(5000, rel=0.05)
    assert tf.split_column(spark.range(3), "id", {"all": 1}).where("part = 'all'").count() == 3
    with pytest.raises(ValueError):
        tf.split_column(spark.range(3), "id", {"a": 0})


def test_keys(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "a string, b string")
    assert df.select(hash_unit(["a", "b"])).distinct().count() == 2
    nulls = spark.createDataFrame([(None, None), (1, None)], "a int, b string")
    for choice in (tf.split_column(nulls, ["a", "b"]), tf.fold_column(nulls, "b", 5)):
        with pytest.raises(Exception, match="holds NULL"):
            choice.collect()


def test_choices_with_one_seed_are_independent(spark):
    df = spark.range(40000).withColumn("label", F.lit(0))
    kept = tf.split_column(tf.stratified_sample(df, "label", {0: 0.3}, "id"), "id")
    n = {r.part: r.n for r in tf.group_count(kept, "part").collect()}
    assert n["train"] / (n["train"] + n["test"]) == pytest.approx(0.8, abs=0.02)
    folds = tf.fold_column(kept, "id", 10)
    sizes = [r.n for r in tf.group_count(folds, "fold").collect()]
    assert len(sizes) == 10 and min(sizes) > 900


@pytest.mark.parametrize("native", [False, True])
def test_unlisted_strata_leave_with_a_warning(spark, native):
    df = spark.range(100).withColumn("label", (F.col("id") % 2).cast("int"))
    with pytest.warns(UserWarning):
        if native:
            out = tf.stratified_sample_native(df, "label", {1: 1.0}, check_strata=True)
        else:
            out = tf.stratified_sample(df, "label", {1: 1.0}, "id", check_strata=True)
    assert {(r.label, r.n) for r in tf.group_count(out, "label").collect()} == {(1, 50)}
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        tf.stratified_sample(df, "label", {1: 1.0, 0: 0.5}, "id", check_strata=True)


def test_balance(spark):
    df = spark.range(10000).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    fractions = tf.balance_fractions(df, "label")
    assert {r.label: r.fraction for r in fractions.collect()} == {1: 1.0, 0: 0.25}
    n = {r.label: r.n for r in tf.group_count(tf.stratified_sample(df, "label", fractions, "id"), "label").collect()}
    assert n[1] == 2000 and n[0] == pytest.approx(2000, rel=0.1)


def test_balance_of_thousands_of_strata(spark):
    df = spark.range(15000).withColumn("label", F.least(F.col("id") % 5001, F.lit(4999)))
    fractions = tf.balance_fractions(df, "label")
    assert fractions.count() == 5000
    kept = tf.stratified_sample(df, "label", fractions, "id")
    assert kept.columns == df.columns and kept.select("label").distinct().count() > 4500


def test_folds_read_their_own_files(spark, tmp_path):
    rows = tf.fold_column(tf.split_column(spark.range(500).withColumnRenamed("id", "k"), "k"), "k", 4)
    path = str(tmp_path / "folds")
    tf.write_folds(rows, path)
    want = [tuple(r) for r in rows.collect()]
    for held, others in ((0, False), (3, True)):
        found = tf.read_folds(spark, path, "train", held, others)
        assert sorted(r.k for r in found.collect()) == sorted(
            k for k, part, fold in want if part == "train" and (fold != held if others else fold == held)
        )
        plan = found._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
        assert "PartitionFilters: [isnotnull(part" in scan and "fold#" in scan.split("PartitionFilters")[1].split("]")[0]
        assert all(f"part=train/fold={f}" in name for name in found.inputFiles() for f in [name.split("fold=")[1][0]] if "part=train" in name)
    assert tf.read_folds(spark, path).count() == 500
