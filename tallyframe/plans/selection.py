"""Which columns relate to the target?"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named, numeric_columns
from tallyframe.operators.correlation import (
    corr_matrix,
    prune_redundant,
    select_by_corr,
    target_corr,
)
from tallyframe.operators.profiling import drop_null_rows, prune_columns


@dataclass(frozen=True)
class FeatureSelection:
    """The chosen columns with the target, and what led to them.

    ``complete`` is the cleaned table before the choice, ``correlations`` those of its
    columns with the target.
    """

    table: DataFrame
    complete: DataFrame
    correlations: DataFrame
    features: list[str]


def select_features(
    df: DataFrame,
    target: str,
    min_present: int | float = 0,
    threshold: float = 0.1,
    redundancy: float | None = None,
    prefer: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> FeatureSelection:
    """Prune sparse columns and incomplete rows, then rank columns by correlation.

    With ``redundancy``, a column that correlates this strongly with a better one is
    dropped as well. Three passes over the table: the fill of each column, all
    target correlations, and the matrix of those selected.
    """
    table = drop_null_rows(prune_columns(df, min_present, always_keep=[target]))
    candidates = numeric_columns(table, exclude=[target, *exclude])
    correlations = target_corr(table, target, candidates, complete=True)
    # One short row per selected column; their names decide the next schema.
    ranked = select_by_corr(correlations, threshold).orderBy(F.desc("abs_corr"), "feature")
    rows = ranked.collect()
    features = [row.feature for row in rows]
    if redundancy is not None and len(features) > 1:
        strengths = df.sparkSession.createDataFrame(rows, ranked.schema)
        features = prune_redundant(
            strengths, corr_matrix(table, features), redundancy, prefer
        )
    return FeatureSelection(
        table.select(*map(named, [*features, target])), table, correlations, features
    )
