"""Settings of the diabetes analysis on the public 2020 telephone health survey."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyframe.functions.columns import named
from tallyframe.operators.cleaning import (
    Rule,
    apply_rules,
    below,
    drop,
    make_label,
    recode,
)
from tallyframe.operators.codebook import feature_details, label_codes
from tallyframe.operators.profiling import (
    drop_null_rows,
    group_count,
    histogram,
    prune_columns,
)
from tallyframe.operators.sampling import stratified_sample_native
from tallyframe.plans.modelling import Modelling, run_models
from tallyframe.plans.preparation import prepare_training_set
from tallyframe.plans.selection import FeatureSelection, select_features

# The target, its two answers and the size limits of the analysis.
TARGET = "DIABETE4"
YES, NO = 1, 3
SURVEY_YEAR = 2020
MIN_PRESENT = 300000
MIN_CORRELATION = 0.1
BALANCE = {1: 1.0, 0: 0.1541}
SEED = 42

# The features that stay after the redundant ones are dropped.
NUMERIC = ["_AGE80", "_BMI5", "_MICHD", "_DRDXAR2", "ALCDAY5"]
CODED = ["GENHLTH", "EMPLOY1", "DIFFWALK", "RMVTETH4", "EXERANY2", "CHECKUP1", "PNEUVAC4"]

# The features that correlate with the target, redundant ones included.
CANDIDATES = [
    "GENHLTH",
    "_AGE_G",
    "_BMI5",
    "_AGE80",
    "_AGEG5YR",
    "_BMI5CAT",
    "_MICHD",
    "EMPLOY1",
    "_RFHLTH",
    "WTKG3",
    "DIFFWALK",
    "_DRDXAR2",
    "HAVARTH4",
    "_HCVU651",
    "_AGE65YR",
    "_RFBMI5",
    "_DRNKDRV",
    "ALCDAY5",
    "RMVTETH4",
    "EXERANY2",
    "CVDINFR4",
    "_TOTINDA",
    "CHECKUP1",
    "PNEUVAC4",
]

# Refused answers leave, "none" becomes 0, no becomes 0.
RULES: list[Rule] = [
    drop("GENHLTH", 9),
    below("_BMI5", 6000),
    recode("_MICHD", 2, 0),
    drop("EMPLOY1", 9),
    drop("DIFFWALK", 9),
    recode("_DRDXAR2", 2, 0),
    drop("ALCDAY5", 999),
    recode("ALCDAY5", 888, 0),
    drop("RMVTETH4", 9),
    recode("RMVTETH4", 8, 0),
    drop("EXERANY2", 9),
    drop("CHECKUP1", 9),
    recode("CHECKUP1", 8, 0),
    drop("PNEUVAC4", 9),
]


def explore(survey: DataFrame, min_present: int | float = MIN_PRESENT) -> FeatureSelection:
    """Well filled columns that correlate with the target."""
    return select_features(survey, TARGET, min_present, MIN_CORRELATION)


def sex_shares(survey: DataFrame, texts: DataFrame) -> DataFrame:
    """Share of each sex among those who gave an age; ``texts(code, label)``."""
    answered = survey.where(named("_AGEG5YR") < 14)
    shares = group_count(answered, "SEXVAR", share=True)
    return label_codes(shares, "SEXVAR", texts, "code", "label").orderBy("n", "SEXVAR")


def bmi_histogram(survey: DataFrame, bins: int = 64) -> DataFrame:
    """Histogram of the body mass index, which the survey stores times 100."""
    return histogram(survey.where(named("_BMI5") < 6000), named("_BMI5") / 100, bins)


def questions(
    answers: DataFrame, short_texts: DataFrame, codebook: DataFrame, counts: bool = False
) -> DataFrame:
    """What each candidate column asks, on request with the count of each code."""
    return feature_details(answers, CANDIDATES, short_texts, codebook, SURVEY_YEAR, counts)


def prepare(
    survey: DataFrame, key: str | None = None, min_present: int | float = MIN_PRESENT
) -> DataFrame:
    """The balanced training table, of the rows complete in all well filled columns.

    With a ``key`` the class sample follows the hash of the key; without one it is
    Spark's own ``sampleBy``, whose rows depend on the partitioning.
    """
    features = [*NUMERIC, *CODED]
    keys = [] if key is None else [key]
    complete = drop_null_rows(
        prune_columns(survey, min_present, always_keep=[*keys, *features, TARGET])
    )
    if key is not None:
        return prepare_training_set(
            complete, key, TARGET, YES, NO, features, RULES, BALANCE, SEED
        )
    columns = complete.select(*map(named, [*features, TARGET]))
    clean = apply_rules(make_label(columns, TARGET, YES, NO), RULES)
    return stratified_sample_native(clean, "label", BALANCE, SEED)


def model(prepared: DataFrame, key: str, **options) -> Modelling:
    """Fit and score the five classifiers on a prepared table."""
    return run_models(prepared, key, NUMERIC, CODED, seed=SEED, **options)
