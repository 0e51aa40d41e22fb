"""What a coded column asks and what its codes mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named
from tallyframe.operators.cleaning import Rule


def codebook_join(
    features: DataFrame,
    short_texts: DataFrame,
    codebook: DataFrame,
    year: int,
    prefer: Sequence[Column | str] = ("question",),
) -> DataFrame:
    """Short text, full question and responses of each feature.

    ``features(feature)``, ``short_texts(feature, short_text)`` and
    ``codebook(feature, year, question, responses)``. A feature without an entry
    stays, with NULL. Where the codebook has several entries for a feature and year,
    the first one in the order of ``prefer`` is taken; that is an aggregate with one
    row per feature, so the joins never multiply rows.
    """
    order = F.struct(*[named(c) if isinstance(c, str) else c for c in prefer])
    entries = (
        codebook.where(F.col("year") == year)
        .groupBy("feature")
        .agg(F.min_by(F.struct("question", "responses"), order).alias("entry"))
        .select("feature", "entry.question", "entry.responses")
    )
    texts = short_texts.groupBy("feature").agg(F.min("short_text").alias("short_text"))
    return features.join(texts, "feature", "left").join(entries, "feature", "left")


def feature_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The column names of a table as rows: ``feature_no, feature``."""
    rows = list(enumerate(columns or df.columns))
    return df.sparkSession.createDataFrame(rows, "feature_no int, feature string")


def code_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per code of each column in one pass: ``feature, code, n``."""
    cells = df.select(*[named(name).cast("string").alias(name) for name in columns])
    long = cells.unpivot([], [named(name) for name in columns], "feature", "code")
    return long.groupBy("feature", "code").agg(F.count("*").alias("n"))


def feature_details(
    df: DataFrame,
    columns: Sequence[str],
    short_texts: DataFrame,
    codebook: DataFrame,
    year: int,
    counts: bool = True,
) -> DataFrame:
    """Question and responses of each column, with the count of each code on request."""
    details = codebook_join(feature_rows(df, columns), short_texts, codebook, year)
    if not counts:
        return details
    return code_counts(df, columns).join(details, "feature", "left")


def label_codes(
    counts: DataFrame, code: str, labels: DataFrame, label_code: str, label: str
) -> DataFrame:
    """Put the text of each code beside its count; codes without a text stay."""
    texts = labels.groupBy(named(label_code).alias(code)).agg(
        F.min(named(label)).alias(label)
    )
    return counts.join(texts, code, "left")


def unmatched_codes(
    df: DataFrame, columns: Sequence[str], listed: DataFrame, rules: Sequence[Rule] = ()
) -> DataFrame:
    """Codes that occur though the codebook does not list them and no rule names them.

    ``feature, code, n``; ``listed(feature, code)`` holds codes as text. A bound names no
    single code, so ``below`` rules do not count. NULL cells are not codes.
    """
    named_codes = [
        (rule.column, str(code)) for rule in rules if rule.action != "below" for code in rule.values
    ]
    known = listed.select("feature", F.col("code").cast("string").alias("code"))
    if named_codes:
        known = known.unionAll(df.sparkSession.createDataFrame(named_codes, known.schema))
    counts = code_counts(df, columns).where(F.col("code").isNotNull())
    return counts.join(known.distinct(), ["feature", "code"], "left_anti")
