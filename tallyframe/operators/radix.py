"""Exact quantiles by radix selection.

A double is turned into a whole number of 64 bits in the same order. Each scan counts, per
column, the next 16 bits of the cells whose leading bits are those of a quantile, and so
narrows every quantile of every column at once: at most four scans, fewer where the cells
left for a quantile are all equal. Tasks give counts only, at most 65,536 for a column and
quantile; no cell is shuffled, nothing is sampled, and what comes to the driver is one row
per column and quantile.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.columns import named
from tallyframe.sources.workers import map_arrow

#: Bits of a cell that one scan counts, and scans until no bit is left.
DIGIT = 16
SCANS = 4


def to_keys(values: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of the doubles; both zeros are equal, and NaN is above all."""
    clean = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = clean.view(np.uint64)
    negative = (bits >> np.uint64(63)).astype(bool) & ~np.isnan(values)
    top = np.uint64(1 << 63)
    return np.where(negative, ~bits, (bits & ~top) | top)


def to_value(key: int) -> float:
    """The double of a key."""
    bits = key ^ (1 << 63) if key >> 63 else ~key & ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


class Digits:
    """Counts of the next digit of the cells that begin with one of a column's prefixes."""

    def __init__(self, depth: int, prefixes: dict[int, list[int]]):
        self.depth, self.prefixes = depth, prefixes

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.uint64(64 - DIGIT * (self.depth + 1))
        # Per column and prefix: counts, the lowest and the highest key of each digit.
        counts = {
            (at, prefix): [np.zeros(1 << DIGIT, np.int64), {}]
            for at, own in self.prefixes.items()
            for prefix in own
        }
        for batch in batches:
            for at, own in self.prefixes.items():
                column = batch.column(f"c{at}").drop_null()
                keys = to_keys(column.to_numpy(zero_copy_only=False).astype(np.float64))
                for prefix in own:
                    mine = keys if not self.depth else keys[keys >> np.uint64(64 - DIGIT * self.depth) == np.uint64(prefix)]
                    if not len(mine):
                        continue
                    digits = ((mine >> rest) & np.uint64((1 << DIGIT) - 1)).astype(np.int64)
                    held = counts[at, prefix]
                    held[0] += np.bincount(digits, minlength=1 << DIGIT)
                    order = np.lexsort((mine, digits)) if rest else np.argsort(digits, kind="stable")
                    firsts = np.flatnonzero(np.diff(digits[order], prepend=-1))
                    lasts = np.append(firsts[1:], len(order)) - 1
                    for digit, low, high in zip(
                        digits[order[firsts]].tolist(), mine[order[firsts]].tolist(), mine[order[lasts]].tolist()
                    ):
                        old = held[1].get(digit, (low, high))
                        held[1][digit] = (min(old[0], low), max(old[1], high))
        for (at, prefix), (many, ends) in counts.items():
            digits = np.flatnonzero(many)
            if len(digits):
                low, high = (np.array([ends[d][side] for d in digits.tolist()], np.uint64).view(np.int64) for side in (0, 1))
                yield pa.RecordBatch.from_pydict(
                    {
                        "place": np.full(len(digits), at, np.int32),
                        "prefix": np.full(len(digits), prefix, np.int64),
                        "digit": digits.astype(np.int32),
                        "n": many[digits],
                        # As signed numbers whose order is that of the keys.
                        "low": low ^ np.int64(-(1 << 63)),
                        "high": high ^ np.int64(-(1 << 63)),
                    }
                )


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles ``feature, p, value`` of many columns at once.

    The value for ``p`` is the smallest one that at least a share ``p`` of the column's
    non-NULL cells do not exceed. NaN is a cell above all others. A column without cells has
    no rows.
    """
    columns = list(columns)
    rows = df.select(*[named(name).cast("double").alias(f"c{at}") for at, name in enumerate(columns)])
    #: What is still open: per column, the prefix and the rank within it of each quantile.
    open_: list[tuple[int, float, int, int]] = [(at, float(p), 0, -1) for at in range(len(columns)) for p in probabilities]
    found: list[tuple[str, float, float]] = []
    for depth in range(SCANS):
        if not open_:
            break
        prefixes: dict[int, list[int]] = {}
        for at, _, prefix, _ in open_:
            if prefix not in prefixes.setdefault(at, []):
                prefixes[at].append(prefix)
        narrowed = []
        for row in _digit_of_each(rows, depth, prefixes, open_).collect():
            low, high = row["low"] + (1 << 63), row["high"] + (1 << 63)
            if low == high:
                found.append((columns[row["place"]], row["p"], to_value(low)))
            else:
                narrowed.append((row["place"], row["p"], (row["prefix"] << DIGIT) | row["digit"], row["rest"]))
        open_ = narrowed
    return df.sparkSession.createDataFrame(found, "feature string, p double, value double")


def _digit_of_each(
    rows: DataFrame, depth: int, prefixes: dict[int, list[int]], wanted: Sequence[tuple[int, float, int, int]]
) -> DataFrame:
    """For each wanted quantile the digit that holds it, the rank within that, and the digit's ends."""
    needed = rows.select(*[f"c{at}" for at in prefixes])
    parts = map_arrow(needed, Digits(depth, prefixes), "place int, prefix long, digit int, n long, low long, high long")
    counts = parts.groupBy("place", "prefix", "digit").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    group = Window.partitionBy("place", "prefix")
    upto = group.orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("last", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(group))
    # One row per column and quantile.
    asked = rows.sparkSession.createDataFrame(list(wanted), "place int, p double, prefix long, rank long")
    rank = F.when(F.col("rank") < 0, F.greatest(F.ceil(F.col("p") * F.col("total")), F.lit(1))).otherwise(F.col("rank"))
    return (
        ranked.join(F.broadcast(asked), ["place", "prefix"])
        .withColumn("rank", rank)
        .where((F.col("last") >= F.col("rank")) & (F.col("last") - F.col("n") < F.col("rank")))
        .select("place", "p", "prefix", "digit", (F.col("rank") - F.col("last") + F.col("n")).alias("rest"), "low", "high")
    )
