"""Feature vectors, as unfitted MLlib pipelines and as single steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Normalizer,
    OneHotEncoder,
    StandardScaler,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named

# The suffix of encoded columns, and how many distinct values a
# column may have to be treated as a category by the tree models.
ENCODED_SUFFIX = "_OH"
MOST_CATEGORIES = 10


def one_hot_stage(
    columns: Sequence[str], suffix: str = ENCODED_SUFFIX, keep_unseen: bool = True
) -> OneHotEncoder:
    """Encode codes as vectors; the code itself is the slot.

    ``keep_unseen=False`` leaves out the highest code (all zeros) and fails on a code
    that was not there at fit time, so it has to be fitted on all rows.
    ``keep_unseen=True`` gives every code seen at fit time a slot and turns any other
    to all zeros, so it can be fitted on the training rows alone.
    """
    return OneHotEncoder(
        inputCols=list(columns),
        outputCols=[name + suffix for name in columns],
        handleInvalid="keep" if keep_unseen else "error",
    )


def one_hot(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = ENCODED_SUFFIX,
    fit_on: DataFrame | None = None,
    keep_unseen: bool = False,
) -> DataFrame:
    """Encode the columns and drop the originals."""
    model = one_hot_stage(columns, suffix, keep_unseen).fit(df if fit_on is None else fit_on)
    return model.transform(df).drop(*columns)


def one_hot_observed(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """One 0/1 column per code that occurs, named ``column_code``; the originals go.

    No slot stands for a code that is not there, and none is left out. Codes of ``fit_on``
    come to the driver, since they decide the schema: meant for coded columns. Any other
    code, and NULL, is all zeros.
    """
    seen = (df if fit_on is None else fit_on).agg(
        *[F.sort_array(F.collect_set(named(name))).alias(f"c{at}") for at, name in enumerate(columns)]
    ).first()
    slots = [
        F.coalesce((named(name) == F.lit(code)).cast("int"), F.lit(0)).alias(f"{name}_{code}")
        for at, name in enumerate(columns)
        for code in seen[at]
    ]
    return df.select(*[named(name) for name in df.columns if name not in columns], *slots)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Put columns in one vector; a NULL or NaN cell is an error."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid="error"
    ).transform(df)


def linear_features(
    numeric: Sequence[str],
    coded: Sequence[str],
    output: str = "features",
    keep_unseen: bool = True,
) -> Pipeline:
    """Features for linear models.

    One-hot, assemble, standardise each column by mean and deviation, then scale
    each row to length 1, in this order.
    """
    encoder = [one_hot_stage(coded, keep_unseen=keep_unseen)] if coded else []
    return Pipeline(
        stages=[
            *encoder,
            VectorAssembler(
                inputCols=[*numeric, *[name + ENCODED_SUFFIX for name in coded]],
                outputCol=f"{output}_unscaled",
                handleInvalid="error",
            ),
            StandardScaler(
                inputCol=f"{output}_unscaled",
                outputCol=f"{output}_scaled",
                withMean=True,
                withStd=True,
            ),
            Normalizer(inputCol=f"{output}_scaled", outputCol=output, p=2.0),
        ]
    )


def tree_features(
    columns: Sequence[str],
    output: str = "indexedFeatures",
    max_categories: int = MOST_CATEGORIES,
    keep_unseen: bool = True,
) -> Pipeline:
    """Features for tree models: assemble, then index the columns with few values."""
    return Pipeline(
        stages=[
            VectorAssembler(
                inputCols=list(columns), outputCol="features", handleInvalid="error"
            ),
            VectorIndexer(
                inputCol="features",
                outputCol=output,
                maxCategories=max_categories,
                handleInvalid="keep" if keep_unseen else "error",
            ),
        ]
    )


def fit_features(
    pipeline: Pipeline, df: DataFrame, fit_on: DataFrame | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows (or on ``df``) and transform ``df``."""
    model = pipeline.fit(df if fit_on is None else fit_on)
    return model, model.transform(df)


def vector_columns(
    df: DataFrame, vector: str, names: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Give each slot of a vector its own column."""
    cells = vector_to_array(named(vector))
    return df.select(*map(named, keep), cells.alias("cells")).select(
        *map(named, keep),
        *[F.col("cells")[at].alias(name) for at, name in enumerate(names)],
    )
