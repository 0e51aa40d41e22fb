"""The preset analysis on a small table with the survey's column names."""

import pytest
from pyspark.sql import functions as F

import tallyframe as tf
from tallyframe.plans import health_survey as hs


@pytest.fixture(scope="module")
def survey(spark):
    def code(name, n, first=1):
        return (F.pmod(F.xxhash64(F.lit(name), "id"), F.lit(n)) + first).cast("int")

    df = spark.range(4000).withColumns(
        {
            "GENHLTH": code("g", 6),
            "_AGE80": code("a", 63, 18),
            "_BMI5": code("b", 4000, 1500) + F.when(F.col("id") % 50 == 0, 5000).otherwise(0),
            "_MICHD": code("m", 2),
            "EMPLOY1": code("e", 9),
            "DIFFWALK": code("d", 2),
            "_DRDXAR2": code("x", 2),
            "ALCDAY5": F.when(F.col("id") % 4 == 0, 888).when(F.col("id") % 9 == 0, 999).otherwise(code("l", 30, 101)),
            "RMVTETH4": F.when(F.col("id") % 5 == 0, 8).otherwise(code("r", 3)),
            "EXERANY2": code("y", 2),
            "CHECKUP1": F.when(F.col("id") % 7 == 0, 8).otherwise(code("c", 4)),
            "PNEUVAC4": F.when(F.col("id") % 11 == 0, 9).otherwise(code("p", 2)),
            "SEXVAR": code("s", 2),
            "_AGEG5YR": code("5", 14),
            "EMPTY": F.lit(None).cast("int"),
        }
    )
    risk = F.col("_AGE80") + F.col("_BMI5") / 100 + code("n", 20)
    return df.withColumn("DIABETE4", F.when(F.col("id") % 40 == 0, 7).when(risk > 105, 1).otherwise(3)).cache()


def test_explore(survey):
    found = hs.explore(survey.drop("id"), 0.5)
    assert "_AGE80" in found.features and "EMPTY" not in found.features
    assert found.table.columns[-1] == "DIABETE4"


def test_prepare(survey):
    clean = hs.prepare(survey, "id", 0.5)
    assert clean.columns == ["id", *hs.NUMERIC, *hs.CODED, "label"]
    bad = clean.where(
        "GENHLTH = 9 OR _BMI5 >= 6000 OR _MICHD = 2 OR EMPLOY1 = 9 OR _DRDXAR2 = 2 OR "
        "ALCDAY5 IN (888, 999) OR RMVTETH4 IN (8, 9) OR CHECKUP1 IN (8, 9) OR PNEUVAC4 = 9"
    )
    assert bad.count() == 0
    wanted = survey.where(
        "DIABETE4 = 1 AND GENHLTH <> 9 AND _BMI5 < 6000 AND EMPLOY1 <> 9 AND ALCDAY5 <> 999 AND PNEUVAC4 <> 9"
    )
    assert clean.where("label = 1").count() == wanted.count()
    n = {r.label: r.n for r in tf.group_count(clean, "label").collect()}
    native = {r.label: r.n for r in tf.group_count(hs.prepare(survey.drop("id"), None, 0.5), "label").collect()}
    assert native[1] == n[1] and native[0] == pytest.approx(n[0], rel=0.3)


def test_reports(spark, survey):
    texts = spark.createDataFrame([(1, "Male"), (2, "Female")], "code int, label string")
    shares = hs.sex_shares(survey, texts).collect()
    assert sum(r.share for r in shares) == pytest.approx(1.0)
    assert [r.n for r in shares] == sorted(r.n for r in shares) and all(r.label for r in shares)
    bins = hs.bmi_histogram(survey).collect()
    assert len(bins) == 64 and sum(r.n for r in bins) == survey.where("_BMI5 < 6000").count()
    assert max(r.hi for r in bins) < 60


def test_questions(spark, survey):
    short = spark.createDataFrame([("GENHLTH", "GENERAL HEALTH")], "feature string, short_text string")
    book = spark.createDataFrame([("GENHLTH", 2020, "How is it?", "1 good")], "feature string, year int, question string, responses string")
    found = hs.questions(survey, short, book)
    assert found.count() == len(hs.CANDIDATES)
    assert found.where("question IS NOT NULL").first().short_text == "GENERAL HEALTH"


def test_model(survey):
    clean = hs.prepare(survey, "id", 0.5)
    run = hs.model(clean, "id", kinds=["logistic", "decision_tree"])
    table = {(r.model, r.part): r.accuracy for r in run.comparison().collect()}
    assert len(table) == 4 and table["logistic", "test"] > 0.6
