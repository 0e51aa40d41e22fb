"""Counts and correlations of the survey table that were worked out beforehand."""

import pytest

import tallyframe as tf
from workload.inputs import survey
from workload.queries import labelled, prepared

SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

# Fixed values, per scale.
MISSING = {
    SMALL: {"allnull": 1500, "sparse": 1050, "half99": 750, "nanny": 30, "txt": 752},
    LARGE: {"allnull": 15000, "sparse": 10500, "half99": 7500, "nanny": 300, "txt": 7500},
}
DROPPED = {SMALL: {"allnull", "sparse", "txt"}, LARGE: {"allnull", "sparse"}}
ANSWERS = {SMALL: {1: 308, 3: 1035, 7: 157}, LARGE: {1: 3259, 3: 10041, 7: 1700}}
WITHIN = {SMALL: 1462, LARGE: 14625}
CLASSES = {SMALL: {0: 630, 1: 184}, LARGE: {0: 6123, 1: 2028}}
PARTS = {SMALL: {"train": 656, "test": 158}, LARGE: {"train": 6494, "test": 1657}}
CORRELATIONS = {
    SMALL: {"bmi": 0.560451, "genhlth": 0.017856, "alcday": 0.00319, "checkup": -0.003774, "michd": -0.025202, "half99": -0.023525, "konst": None},
    LARGE: {"bmi": 0.58034, "genhlth": -0.021472, "alcday": 0.003735, "checkup": 0.001719, "michd": -0.006992, "half99": 0.000625, "konst": None},
}


def counts(df, key):
    return {row[key]: row.n for row in tf.group_count(df, key).collect()}


@pytest.mark.parametrize("sf_dir", [SMALL, LARGE])
def test_known_counts(spark, sf_dir):
    rows = survey(spark, sf_dir)
    found = {r.feature: r.n_missing for r in tf.missing_profile(rows).collect() if r.n_missing}
    # One key is 99, the code for a missing answer, unless the key is told apart.
    assert found == {**MISSING[sf_dir], "id": 1}
    told = tf.missing_profile(rows, column_codes={"id": ()})
    assert {r.feature: r.n_missing for r in told.collect() if r.n_missing} == MISSING[sf_dir]
    assert set(rows.columns) - set(tf.prune_columns(rows, 0.5).columns) == DROPPED[sf_dir]
    assert counts(rows, "diag") == ANSWERS[sf_dir]
    assert tf.apply_rules(rows, [tf.below("bmi", 6000)]).count() == WITHIN[sf_dir]
    clean = prepared(spark, sf_dir)
    assert counts(clean, "label") == CLASSES[sf_dir]
    assert counts(tf.split_column(clean, "id"), "part") == PARTS[sf_dir]


@pytest.mark.parametrize("sf_dir", [SMALL, LARGE])
def test_known_correlations(spark, sf_dir):
    want = CORRELATIONS[sf_dir]
    found = {r.feature: r.corr for r in tf.target_corr(labelled(spark, sf_dir), "label", list(want)).collect()}
    assert found == {name: value if value is None else pytest.approx(value, abs=1e-6) for name, value in want.items()}


def test_known_balance(spark):
    fractions = {r.label: r.fraction for r in tf.balance_fractions(prepared(spark, LARGE), "label").collect()}
    assert fractions == {1: 1.0, 0: pytest.approx(0.3312, abs=1e-4)}
