"""From the raw table to a balanced training table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from tallyframe.functions.columns import named
from tallyframe.operators.cleaning import Rule, apply_rules, make_label
from tallyframe.operators.sampling import balance_fractions, stratified_sample


def prepare_training_set(
    df: DataFrame,
    key: str,
    target: str,
    positive: Any,
    negative: Any,
    features: Sequence[str],
    rules: Sequence[Rule],
    fractions: Mapping[Any, float] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Select columns, make the label, clean, and balance the classes.

    Everything but the class counts is one scan with one filter and one projection.
    ``fractions`` given beforehand save that count, else it is joined by class.
    """
    columns = [key, *features, target]
    labelled = make_label(df.select(*map(named, columns)), target, positive, negative)
    clean = apply_rules(labelled, rules)
    if fractions is None:
        fractions = balance_fractions(clean, "label")
    return stratified_sample(clean, "label", fractions, key, seed)
