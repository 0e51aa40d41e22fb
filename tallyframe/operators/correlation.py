"""Correlation with a target, between features, and choosing features by it."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named, numeric_columns, sql_name, sql_text
from tallyframe.functions.statistics import pairwise_corr_sql, varies_sql
from tallyframe.operators.gram import correlation_rows
from tallyframe.operators.profiling import drop_null_rows, per_column
from tallyframe.sources.scratch import scratch_path
from tallyframe.sources.tables import preview

# So many columns have at most 55 pairs, which generated code takes in one aggregate.
AGGREGATED_COLUMNS = 10


def target_corr(
    df: DataFrame,
    target: str,
    columns: Sequence[str] | None = None,
    complete: bool = False,
) -> DataFrame:
    """Correlation of every column with the target, in one pass.

    ``feature, corr, abs_corr``; the target itself is left out, and ``corr`` is NULL
    for a constant column. Each correlation is over the rows where both cells are
    present; ``complete`` says that all are, which makes the pass cheaper.
    """
    columns = [name for name in (columns or numeric_columns(df)) if name != target]
    pairs = per_column(
        df,
        columns,
        lambda name: {"corr": pairwise_corr_sql(name, target, complete)},
        size=50,
    )
    return pairs.withColumn("abs_corr", F.abs("corr"))


def select_by_corr(correlations: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Features whose absolute correlation is above the threshold; NULL is not."""
    return correlations.where(F.col("abs_corr") > threshold)


def top_corr(correlations: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` features with the largest absolute correlation, names breaking ties."""
    return preview(correlations, n, [F.desc_nulls_last("abs_corr"), "feature"])


def corr_matrix(
    df: DataFrame, columns: Sequence[str] | None = None, method: str | None = None
) -> DataFrame:
    """Correlation of all pairs as ``feature_i, feature_j, corr``, both orders.

    Rows with a NULL or NaN among the columns are left out. Pairs with a constant column
    are NULL, and so are all pairs of an empty table. The pairs of up to ten columns are one
    aggregate; more columns are a blocked matrix product in the tasks, whose blocks are merged
    and never come to the driver. ``method`` asks for one of these (``'aggregate'``, ``'blocks'``),
    or for MLlib's matrix (``'mllib'``), which runs jobs at once and is collected.
    """
    columns = list(columns or numeric_columns(df))
    rows = drop_null_rows(
        df.select(*[named(name).cast("double").alias(name) for name in columns])
    )
    if method == "aggregate" or (method is None and len(columns) <= AGGREGATED_COLUMNS):
        return _matrix_by_aggregate(rows, columns)
    if method in ("blocks", None):
        return correlation_rows(rows, columns)
    if method == "mllib":
        return _matrix_by_mllib(rows, columns)
    raise ValueError(f"unknown method {method!r}")


def _matrix_by_aggregate(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Covariances and deviations of all pairs in one pass, for a few columns."""
    if len(columns) > AGGREGATED_COLUMNS:
        raise ValueError(f"one aggregate takes at most {AGGREGATED_COLUMNS} columns")
    aggregates = [
        f"if({varies_sql(sql_name(name))}, stddev_samp({sql_name(name)}), NULL) AS s{at}" for at, name in enumerate(columns)
    ]
    cells = []
    for (i, first), (j, second) in combinations_with_replacement(enumerate(columns), 2):
        value = f"if(s{i} > 0, 1.0D, NULL)" if i == j else f"try_divide(v{i}_{j}, s{i} * s{j})"
        if i != j:
            aggregates.append(f"covar_samp({sql_name(first)}, {sql_name(second)}) AS v{i}_{j}")
        for one, two in dict.fromkeys([(first, second), (second, first)]):
            cells.append(f"struct({sql_text(one)} AS feature_i, {sql_text(two)} AS feature_j, {value} AS corr)")
    return rows.selectExpr(*aggregates).selectExpr(f"inline(array({', '.join(cells)}))")


def _matrix_by_mllib(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    if rows.isEmpty():
        return correlation_rows(rows, columns)
    vectors = VectorAssembler(inputCols=list(columns), outputCol="cells").transform(rows)
    # MLlib returns the matrix itself: columns x columns, whatever the row count.
    matrix = Correlation.corr(vectors.select("cells"), "cells").first()[0].toArray()
    flags = rows.selectExpr(*[varies_sql(sql_name(name)) for name in columns]).first()
    pairs = [
        (a, b, float(matrix[i, j]) if flags[i] and flags[j] else None)
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return rows.sparkSession.createDataFrame(
        pairs, "feature_i string, feature_j string, corr double"
    )


def wide_matrix(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix with one row and one column per feature."""
    return (
        matrix.groupBy(F.col("feature_i").alias("feature"))
        .pivot("feature_j", list(columns))
        .agg(F.max("corr"))
    )


def independent_features(
    target: DataFrame,
    matrix: DataFrame,
    threshold: float = 0.9,
    prefer: Sequence[str] = (),
) -> DataFrame:
    """``feature, preferred, abs_corr`` of the features that repeat none kept before them.

    Features are visited in the order of ``prefer`` and then by falling absolute correlation
    with the target and by name; one is kept when its absolute correlation with every kept
    feature is below ``threshold``. The visit is done in rounds of joins: a feature before
    which no open one repeats it is kept, what repeats a kept one goes, and the others wait for
    the next round. A round is written to the shared folder, and only the number of open
    features comes to the driver, so any number of features and pairs will do.
    """
    spark = target.sparkSession
    places = spark.createDataFrame([(name, at) for at, name in enumerate(prefer)], "feature string, preferred int")
    open_ = _written(
        target.where(F.col("abs_corr").isNotNull())
        .select("feature", F.col("abs_corr").cast("double").alias("abs_corr"))
        .join(places, "feature", "left")
        .select("feature", "preferred", "abs_corr")
    )

    def visit(frame: str) -> Column:
        """What orders features: by preference, strength and name."""
        first = F.coalesce(F.col(f"{frame}.preferred"), F.lit(len(prefer)))
        strength = F.when(F.col(f"{frame}.preferred").isNull(), -F.col(f"{frame}.abs_corr")).otherwise(0.0)
        return F.struct(first.alias("a"), strength.alias("b"), F.col(f"{frame}.feature").alias("c"))

    close = matrix.where((F.abs("corr") >= threshold) & (F.col("feature_i") != F.col("feature_j")))
    sides = close.select(F.col("feature_i").alias("one"), F.col("feature_j").alias("two"))
    pairs = _written(
        sides.unionAll(sides.select(F.col("two"), F.col("one"))).distinct()
        .join(open_.alias("x"), F.col("one") == F.col("x.feature"))
        .join(open_.alias("y"), F.col("two") == F.col("y.feature"))
        # The one that is visited first on the left.
        .where(visit("x") < visit("y"))
        .select("one", "two")
    )
    kept = None
    while open_.count():
        names = open_.select(F.col("feature").alias("one"))
        waiting = pairs.join(names, "one", "left_semi").select(F.col("two").alias("feature"))
        chosen = _written(open_.join(waiting, "feature", "left_anti"))
        gone = pairs.join(chosen.select(F.col("feature").alias("one")), "one", "left_semi").select(F.col("two").alias("feature"))
        open_ = _written(open_.join(chosen, "feature", "left_anti").join(gone, "feature", "left_anti"))
        kept = chosen if kept is None else kept.unionAll(chosen)
    return target.limit(0).select("feature", F.lit(0).alias("preferred"), "abs_corr") if kept is None else kept


def _written(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read again, which cuts its lineage."""
    path = scratch_path(df.sparkSession, "features")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prune_redundant(
    target: DataFrame,
    matrix: DataFrame,
    threshold: float = 0.9,
    prefer: Sequence[str] = (),
) -> list[str]:
    """The features of ``independent_features`` in the order of their visit: one name per kept feature."""
    kept = independent_features(target, matrix, threshold, prefer).collect()
    last = len(prefer)
    return [
        row.feature
        for row in sorted(kept, key=lambda r: (last, -r.abs_corr, r.feature) if r.preferred is None else (r.preferred, 0.0, r.feature))
    ]
