"""Table scans, sinks and size reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """Scan a Parquet or headed CSV table.

    The format follows the file name unless ``fmt`` is given. A CSV without
    ``schema`` has its types inferred, which reads the file once more. With a
    schema, a CSV column is taken by its place, so list all columns in file order.
    """
    first = path if isinstance(path, str) else path[0]
    fmt = fmt or ("csv" if first.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
        if schema is not None:
            reader = reader.option("mode", "FAILFAST").option("enforceSchema", False)
    return reader.load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    single_file: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Write a prepared table, one file per task.

    ``single_file=True`` gives one file. The rows are computed in parallel first
    and only then moved to one writer, which holds the whole output: meant for
    small exports.
    """
    if single_file:
        df = df.repartition(1)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_folds(df: DataFrame, path: str, part: str = "part", fold: str = "fold", mode: str = "overwrite") -> None:
    """Write a prepared table laid out for its readers: a folder for each part and fold.

    Rows of one folder are spread over the tasks that hold them, not moved to one writer.
    """
    write_table(df, path, mode=mode, partition_by=[part, fold])


def read_folds(
    spark: SparkSession, path: str, part: str | None = None, held: int | None = None, others: bool = False
) -> DataFrame:
    """Rows of a part, and of one fold or (``others``) of all other folds.

    The choice is on folder names, so files of other parts and folds are not read.
    """
    df = spark.read.parquet(path)
    if part is not None:
        df = df.where(F.col("part") == part)
    if held is not None:
        df = df.where(F.col("fold") != held if others else F.col("fold") == held)
    return df


def schema_rows(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, as rows."""
    rows = [
        (place, field.name, field.dataType.simpleString(), field.nullable)
        for place, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )


def table_sizes(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """Row and column count of each named frame; also serves as a before/after report."""
    sizes = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias(label),
            "n_rows",
            F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, sizes)


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order (kept per task, then merged)."""
    return df.orderBy(*order_by).limit(n)
