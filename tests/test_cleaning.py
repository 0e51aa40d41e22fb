import pytest
from pyspark.sql import functions as F

import tallyframe as tf


def test_filters_drop_null_codes(spark):
    df = spark.createDataFrame([(None,), (9,), (1,)], "a int")
    assert [row.a for row in tf.apply_rules(df, [tf.drop("a", 9)]).collect()] == [1]
    assert [row.a for row in tf.apply_rules(df, [tf.keep("a", 1, 9)]).collect()] == [9, 1]
    assert tf.apply_rules(df, []).count() == 3


def test_order_of_rules_counts(spark):
    df = spark.createDataFrame([(8,), (0,), (1,)], "a int")
    recode_first = [tf.recode("a", 8, 0), tf.drop("a", 0)]
    drop_first = [tf.drop("a", 0), tf.recode("a", 8, 0)]
    assert [row.a for row in tf.apply_rules(df, recode_first).collect()] == [1]
    assert sorted(row.a for row in tf.apply_rules(df, drop_first).collect()) == [0, 1]
    audit = {r.rule_no: (r.rows_in, r.rows_out) for r in tf.rule_audit(df, recode_first).collect()}
    assert audit == {1: (3, 3), 2: (3, 1)}


def test_recode_keeps_the_type_and_the_rest(spark):
    df = spark.createDataFrame([(888.0,), (5.0,), (None,)], "a double")
    out = tf.apply_rules(df, [tf.recode("a", 888, 0)])
    assert out.schema["a"].dataType.simpleString() == "double"
    assert [row.a for row in out.collect()] == [0.0, 5.0, None]


def test_rules_name_known_columns(spark):
    with pytest.raises(ValueError):
        tf.apply_rules(spark.range(1), [tf.drop("nope", 1)])


def test_audit_counts_add_up(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), (F.col("id") % 7).alias("b"))
    rules = [tf.drop("a", 9), tf.recode("b", 6, 0), tf.below("b", 5), tf.keep("a", 1, 2, 3)]
    audit = tf.rule_audit(df, rules).orderBy("rule_no").collect()
    assert audit[0].rows_in == 1000
    for before, after in zip(audit, audit[1:]):
        assert before.rows_out == after.rows_in
    for step in range(1, 5):
        assert audit[step - 1].rows_out == tf.apply_rules(df, rules[:step]).count()


def test_rules_reach_the_scan_as_one_filter(spark, sf_dir):
    df = tf.read_table(spark, f"{sf_dir}/lineitem.parquet").select("l_quantity", "l_tax")
    out = tf.apply_rules(df, [tf.below("l_quantity", 40), tf.drop("l_tax", 0.08), tf.recode("l_tax", 0.01, 0)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Filter ") == 1
    assert "LessThan(l_quantity,40" in plan and "l_extendedprice" not in plan


def test_label(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (7, "c"), (None, "d")], "diag int, k string")
    assert {(r.k, r.label) for r in tf.make_label(df, "diag", 1, 3).collect()} == {("a", 1), ("b", 0)}
    swapped = tf.make_label(df, "diag", 3, 1)
    assert {(r.k, r.label) for r in swapped.collect()} == {("a", 0), ("b", 1)}


def test_codebook_takes_one_entry_per_feature(spark):
    answers = spark.createDataFrame([(1, 5), (1, 6), (2, None)], "A int, B int")
    texts = spark.createDataFrame([("A", "short a")], "feature string, short_text string")
    book = spark.createDataFrame(
        [("A", 2020, "q2", "r2"), ("A", 2020, "q1", "r1"), ("A", 2019, "q0", "r0"), ("Z", 2020, "qz", "rz")],
        "feature string, year int, question string, responses string",
    )
    plain = tf.feature_details(answers, ["A", "B"], texts, book, 2020, counts=False)
    assert {tuple(r) for r in plain.select("feature", "short_text", "question", "responses").collect()} == {
        ("A", "short a", "q1", "r1"),
        ("B", None, None, None),
    }
    latest = tf.codebook_join(tf.feature_rows(answers), texts, book, 2020, prefer=[F.col("responses") != "r2"])
    assert {r.feature: r.question for r in latest.collect()}["A"] == "q2"
    counted = tf.feature_details(answers, ["A", "B"], texts, book, 2020)
    assert {(r.feature, r.code, r.n, r.question) for r in counted.collect()} == {
        ("A", "1", 2, "q1"),
        ("A", "2", 1, "q1"),
        ("B", "5", 1, None),
        ("B", "6", 1, None),
        ("B", None, 1, None),
    }


def test_csv_and_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1, "x"), (2, None, "y, \"z\"")], "i int, d double, s string")
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / f"t.{fmt}")
        tf.write_table(df, path, fmt=fmt)
        back = tf.read_table(spark, path, df.schema)
        assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}
    inferred = tf.read_table(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "double", "string"]
    one = str(tmp_path / "one.csv")
    tf.write_table(df.repartition(4), one, fmt="csv", single_file=True)
    assert len([p for p in (tmp_path / "one.csv").iterdir() if p.suffix == ".csv"]) == 1


def test_size_and_schema_reports(spark):
    df = spark.range(5).withColumn("x", F.lit("a"))
    sizes = tf.table_sizes({"before": df, "after": df.where("id > 1").drop("x")}, "step")
    assert {tuple(r) for r in sizes.collect()} == {("before", 5, 2), ("after", 3, 1)}
    assert [(r.name, r.type) for r in tf.schema_rows(df).orderBy("position").collect()] == [("id", "bigint"), ("x", "string")]
    assert [r.id for r in tf.preview(df, 2, [F.desc("id")]).collect()] == [4, 3]


def test_label_must_be_a_new_name(spark):
    df = spark.createDataFrame([(1, 1)], "answer int, label int")
    with pytest.raises(ValueError, match="already has"):
        tf.make_label(df, "answer", 1, 3)
