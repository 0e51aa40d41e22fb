"""Stratified samples, splits and folds."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named
from tallyframe.functions.hashing import hash_part, hash_unit
from tallyframe.operators.profiling import class_balance


def balance_fractions(df: DataFrame, label: str) -> DataFrame:
    """``label, fraction``: what brings every class to the smallest one's size."""
    return class_balance(df, label).where(named(label).isNotNull()).select(named(label), "fraction")


def stratified_sample(
    df: DataFrame,
    label: str,
    fractions: Mapping[Any, float] | DataFrame,
    key: str | list[str],
    seed: int = 42,
    check_strata: bool = False,
) -> DataFrame:
    """Keep each row with the probability of its class, chosen by the hash of its key.

    ``fractions`` is a mapping, or a frame ``label, fraction`` with a row per class, which
    is joined and may have any number of classes. A class that is not listed has
    probability 0. ``check_strata`` looks for such classes first and warns.
    """
    unit = hash_unit(key, seed, "sample")
    if isinstance(fractions, DataFrame):
        listed = fractions.select(named(label).alias("__class"), F.col("fraction").alias("__fraction"))
        joined = df.join(listed, named(label) == F.col("__class"))
        return joined.where(unit < F.col("__fraction")).select(*[named(name) for name in df.columns])
    if check_strata:
        _warn_of_unlisted(df, label, fractions)
    if not fractions:
        raise ValueError("give the sampling fraction of at least one class")
    pairs = iter(fractions.items())
    code, fraction = next(pairs)
    limit = F.when(named(label) == F.lit(code), F.lit(float(fraction)))
    for code, fraction in pairs:
        limit = limit.when(named(label) == F.lit(code), F.lit(float(fraction)))
    return df.where(unit < limit.otherwise(0.0))


def stratified_sample_native(
    df: DataFrame,
    label: str,
    fractions: Mapping[Any, float],
    seed: int = 42,
    check_strata: bool = False,
) -> DataFrame:
    """Spark's own ``sampleBy``; the rows chosen depend on the partitioning."""
    if check_strata:
        _warn_of_unlisted(df, label, fractions)
    return df.sampleBy(label, fractions=dict(fractions), seed=seed)


def _warn_of_unlisted(df: DataFrame, label: str, fractions: Mapping[Any, float]) -> None:
    others = df.where(~F.coalesce(named(label).isin(*fractions), F.lit(False)))
    if not others.isEmpty():
        warnings.warn(
            f"some values of {label!r} have no sampling fraction and are left out",
            stacklevel=3,
        )


# Four fifths of the rows train, one fifth tests.
TRAIN_TEST = {"train": 0.8, "test": 0.2}


def split_column(
    df: DataFrame,
    key: str | list[str],
    weights: Mapping[str, float] | None = None,
    seed: int = 42,
    part: str = "part",
) -> DataFrame:
    """Add the name of the part each row belongs to."""
    unit = hash_unit(key, seed)
    return df.withColumn(part, hash_part(unit, weights or TRAIN_TEST))


def fold_column(
    df: DataFrame, key: str | list[str], folds: int = 10, seed: int = 42, fold: str = "fold"
) -> DataFrame:
    """Add the row's fold, 0 to ``folds - 1``."""
    unit = hash_unit(key, seed, "fold")
    return df.withColumn(fold, F.floor(unit * folds).cast("int"))
