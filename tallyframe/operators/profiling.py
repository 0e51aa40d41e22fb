"""Missing cells, group counts, summaries and histograms."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import chunks, named, numeric_columns, sql_name, sql_text
from tallyframe.functions.missing import MISSING_CODES, MISSING_TEXTS, missing_sql
from tallyframe.operators.radix import exact_quantiles

# Aggregates of this many columns go in one pass. A wider table takes several
# passes, each reading only its own columns.
COLUMNS_PER_PASS = 100

# The rows of a summary, in their usual order.
SUMMARY_ROWS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def per_column(
    df: DataFrame,
    columns: Sequence[str],
    stats: Callable[[str], Mapping[str, str]],
    label: str = "feature",
    shared: Mapping[str, str] | None = None,
    size: int = COLUMNS_PER_PASS,
) -> DataFrame:
    """Aggregate many columns in one global pass and return one row per column.

    ``stats(name)`` gives the aggregates of one column as SQL texts; ``shared``
    aggregates are computed once per pass and repeated on each row.
    """
    shared = dict(shared or {})
    passes = []
    for group in chunks(columns, size):
        aggregates = [f"{text} AS shared_{stat}" for stat, text in shared.items()]
        rows = []
        for place, name in enumerate(group):
            cells = [f"{sql_text(name)} AS {label}"]
            for stat, text in stats(name).items():
                aggregates.append(f"{text} AS c{place}_{stat}")
                cells.append(f"c{place}_{stat} AS {stat}")
            cells += [f"shared_{stat} AS {stat}" for stat in shared]
            rows.append(f"struct({', '.join(cells)})")
        totals = df.selectExpr(*aggregates)
        passes.append(totals.selectExpr(f"inline(array({', '.join(rows)}))"))
    return reduce(DataFrame.unionAll, passes)


def missing_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    codes: Sequence[float] = MISSING_CODES,
    texts: Sequence[str] = MISSING_TEXTS,
    text_match: str = "contains",
    column_codes: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Missing and present cells of every column: ``feature, n_missing, n_present``.

    ``column_codes`` replaces ``codes`` for single columns, for instance where 99 is
    a real value.
    """
    fields = {field.name: field for field in df.schema.fields}
    own_codes = column_codes or {}

    def stats(name: str) -> dict[str, str]:
        test = missing_sql(fields[name], own_codes.get(name, codes), texts, text_match)
        return {"n_missing": f"count_if({test})"}

    counted = per_column(df, columns or df.columns, stats, shared={"n_rows": "count(*)"})
    return counted.select(
        "feature", "n_missing", (F.col("n_rows") - F.col("n_missing")).alias("n_present")
    )


def well_filled_columns(df: DataFrame, min_present: int | float, **rules) -> list[str]:
    """Columns with at least ``min_present`` present cells.

    An int is a number of rows, a float a share of them. 0 keeps every column; more
    than the number of rows keeps none.
    """
    profile = missing_profile(df, **rules)
    if isinstance(min_present, float):
        if not 0.0 <= min_present <= 1.0:
            raise ValueError("a float min_present is a share between 0 and 1")
        # The share as it is written, in whole numbers: 0.07 of 100 rows are 7 rows.
        share = Fraction(repr(min_present))
        enough = F.col("n_present").cast("decimal(38,0)") * F.lit(share.denominator) >= (
            F.col("n_missing") + F.col("n_present")
        ).cast("decimal(38,0)") * F.lit(share.numerator)
    else:
        enough = F.col("n_present") >= F.lit(min_present)
    # One row per column comes to the driver, since it decides the next schema.
    kept = {row.feature for row in profile.where(enough).collect()}
    return [name for name in df.columns if name in kept]


def prune_columns(
    df: DataFrame,
    min_present: int | float = 0,
    always_keep: Sequence[str] = (),
    **rules,
) -> DataFrame:
    """Drop the columns that have too few present cells."""
    kept = set(well_filled_columns(df, min_present, **rules)) | set(always_keep)
    return df.select(*[named(name) for name in df.columns if name in kept])


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the rows without NULL or NaN."""
    return df.na.drop("any", subset=list(columns) if columns is not None else None)


def group_count(
    df: DataFrame, keys: str | Sequence[str], share: bool = False
) -> DataFrame:
    """Rows per group as ``n``, and on request the group's ``share`` of all rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = df.groupBy(*[named(key) for key in keys]).agg(F.count("*").alias("n"))
    if not share:
        return counts
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the sampling fraction that evens the classes out."""
    counts = group_count(df, label)
    smallest = counts.agg(F.min("n")).scalar()
    return counts.withColumn("fraction", smallest / F.col("n"))


def summary_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, min, exact quartiles and max per column.

    ``feature, n, mean, sd, min, q1, q2, q3, max``; NULL cells are left out. The quartiles are
    selected at once by a few scans, the other figures by one scan when they are asked for.
    """
    columns = list(columns or numeric_columns(df))

    def stats(name: str) -> dict[str, str]:
        cell = f"CAST({sql_name(name)} AS DOUBLE)"
        return {
            "n": f"count({cell})",
            "mean": f"avg({cell})",
            "sd": f"stddev_samp({cell})",
            "min": f"min({cell})",
            "max": f"max({cell})",
        }

    moments = per_column(df, columns, stats)
    cuts = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    long = exact_quantiles(df, columns, list(cuts.values()))
    wide = long.groupBy("feature").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(q) for q, p in cuts.items()]
    )
    return moments.join(wide, "feature", "left").select(
        "feature", "n", "mean", "sd", "min", "q1", "q2", "q3", "max"
    )


def summary_texts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, smallest and largest cell of text columns: ``feature, n, min, max``, in one pass."""
    texts = [field.name for field in df.schema.fields if field.dataType.simpleString() == "string"]

    def stats(name: str) -> dict[str, str]:
        cell = sql_name(name)
        return {"n": f"count({cell})", "min": f"min({cell})", "max": f"max({cell})"}

    return per_column(df, list(columns or texts), stats)


def summary_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The summary laid out as ``DataFrame.summary`` does: one row per statistic."""
    columns = list(columns or numeric_columns(df))
    picks = ["n", "mean", "sd", "min", "q1", "q2", "q3", "max"]
    cells = F.array(
        *[
            F.struct(F.lit(row).alias("summary"), F.col(pick).cast("double").alias("value"))
            for row, pick in zip(SUMMARY_ROWS, picks)
        ]
    )
    long = summary_stats(df, columns).select("feature", F.inline(cells))
    return long.groupBy("summary").pivot("feature", columns).agg(F.max("value"))


def transpose(
    df: DataFrame,
    pivot_col: str,
    values: Sequence[str],
    columns: Sequence[str] | None = None,
    label: str = "feature",
    joined: str | None = None,
) -> DataFrame:
    """Turn columns to rows and the ``values`` of ``pivot_col`` to columns.

    ``values`` is stated, which saves the job that would look for them. Where several rows
    share a ``pivot_col`` value, an error is raised, as one cell cannot hold them; with
    ``joined``, cells become texts and those of such rows are sorted and joined by it.
    """
    columns = list(columns or [name for name in df.columns if name != pivot_col])
    cells = [named(name) if joined is None else named(name).cast("string").alias(name) for name in columns]
    long = df.select(named(pivot_col), *cells).unpivot(
        [named(pivot_col)], [named(name) for name in columns], label, "value"
    )
    if joined is not None:
        cell = F.array_join(F.array_sort(F.collect_list("value")), joined)
    else:
        # Rows are counted, not cells: two rows clash even where one holds NULL.
        several = F.raise_error(F.lit(f"several rows share a value of {pivot_col!r}"))
        cell = F.when(F.count(F.lit(1)) > 1, several.cast(long.schema["value"].dataType)).otherwise(F.max("value"))
    return long.groupBy(label).pivot(pivot_col, list(values)).agg(cell)


def histogram(df: DataFrame, column: str | Column, bins: int = 64) -> DataFrame:
    """Equal-width histogram ``bin, lo, hi, n`` with the empty bins present.

    Bins are closed on the left and open on the right, the last one closed on both
    sides. NULL, NaN and infinite cells are left out. Only counts leave the tasks.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    cell = named(column) if isinstance(column, str) else column
    values = df.select(cell.cast("double").alias("x"))
    values = values.where(F.abs("x") < F.lit(float("inf")))
    # One row with the range comes to the driver and is a constant from here on.
    low, high = values.agg(F.min("x"), F.max("x")).first()
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins

    def edge(place: Column) -> Column:
        return F.when(place == bins, F.lit(high)).otherwise(
            place * F.lit(width) + F.lit(low)
        )

    # Rounding can put a value that lies on an edge one bin off, so the first guess
    # is checked against the edges themselves.
    guess = F.least(F.floor((F.col("x") - low) / F.lit(width)), F.lit(bins - 1)).cast("int")
    placed = values.select("x", guess.alias("guess")).select(
        F.when(F.col("x") < edge(F.col("guess")), F.col("guess") - 1)
        .when(
            (F.col("x") >= edge(F.col("guess") + 1)) & (F.col("guess") != bins - 1),
            F.col("guess") + 1,
        )
        .otherwise(F.col("guess"))
        .alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("lo"),
        edge(F.col("bin") + 1).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )
