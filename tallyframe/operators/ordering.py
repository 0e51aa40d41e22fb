"""Ordered work (running sums) spread over many tasks.

A window ordered over the whole table moves every row to one task. Here the value
range is cut in buckets that hold about as many rows each; the order between
buckets is known, so a running sum is the sum of the earlier buckets plus a window
inside the bucket. Equal values are added up first, so that a value held by a
third of all rows is one row by the time it is sorted. The cut points only balance
the work: results are exact whatever they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.columns import named

# Cut points travel to the driver and back, so their number has a bound unless one is given.
MOST_BUCKETS = 2000


def bucket_count(df: DataFrame, buckets: int | None = None) -> int:
    """Number of buckets: as asked, else four for each of the session's shuffle tasks, to a bound.

    Tasks get their buckets by hash, so with one for each some would get several and others none.
    """
    if buckets is None:
        buckets = min(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    return max(2, buckets)


def cut_points(df: DataFrame, value: str, buckets: int) -> list[float]:
    """Values that cut the rows in ``buckets`` runs of about equal size.

    A tenth of the rows is enough, since the cuts balance the work and decide nothing
    else. Quantile sketches are merged in two steps, so no single task has to merge
    the sketches of all input tasks.
    """
    steps = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    accuracy = F.lit(max(100, 4 * buckets))
    first = (
        df.sample(0.1, seed=42)
        .groupBy((F.spark_partition_id() % 64).alias("part"))
        .agg(F.percentile_approx(value, steps, accuracy).alias("cuts"))
        .select(F.explode("cuts").alias("cut"))
    )
    row = first.agg(F.percentile_approx("cut", steps, accuracy).alias("cuts")).first()
    return sorted({cut for cut in row.cuts or [] if cut == cut and abs(cut) != float("inf")})


def add_bucket(df: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    """Add ``bucket``, which never falls as ``value`` grows; NaN comes last."""
    edges = [float("-inf"), *(cuts or [0.0]), float("inf")]
    placed = Bucketizer(
        splits=edges, inputCol=value, outputCol="bucket", handleInvalid="keep"
    ).transform(df)
    return placed.withColumn("bucket", F.col("bucket").cast("int"))


def running_sums(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    sums: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """One row per ``(by, value)`` with each sum and its running total.

    The running total ``cum_<name>`` covers this value and all larger ones; the
    overall total is ``all_<name>``. NULL values are left out.
    """
    by = list(by)
    rows = df.where(named(value).isNotNull())
    cuts = cut_points(rows, value, bucket_count(df, buckets))
    totals = [F.sum(named(name)).alias(name) for name in sums]
    distinct = rows.groupBy(*map(named, by), named(value)).agg(*totals)
    placed = add_bucket(distinct, value, cuts)

    per_bucket = placed.groupBy(*map(named, by), "bucket").agg(*totals)
    earlier = (
        Window.partitionBy(*map(named, by))
        .orderBy(F.desc("bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    group = Window.partitionBy(*map(named, by))
    offsets = per_bucket.select(
        *map(named, by),
        "bucket",
        *[
            F.coalesce(F.sum(named(name)).over(earlier), F.lit(0)).alias(f"before_{name}")
            for name in sums
        ],
        *[F.sum(named(name)).over(group).alias(f"all_{name}") for name in sums],
    )
    inside = (
        Window.partitionBy(*map(named, by), "bucket")
        .orderBy(named(value).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = placed.select(
        "*", *[F.sum(named(name)).over(inside).alias(f"in_{name}") for name in sums]
    )
    # Every row has its bucket's offset. A left join says the same as an inner one and
    # leaves both inputs alike down to the scan, so their shuffle is done once.
    joined = within.join(offsets, [*by, "bucket"], "left")
    return joined.select(
        *map(named, by),
        named(value),
        *map(named, sums),
        *[
            (F.col(f"before_{name}") + F.col(f"in_{name}")).alias(f"cum_{name}")
            for name in sums
        ],
        *[F.col(f"all_{name}") for name in sums],
    )
