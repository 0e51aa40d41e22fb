"""Co-moments of many columns as blocks of one matrix product.

Each task multiplies the centred rows of its batches, one product for all pairs of columns,
and gives the sums out in blocks of a bounded width. Two such blocks merge exactly as if
their rows had been one batch, so blocks meet in two steps whatever the number of tasks, and
neither a row nor the whole matrix leaves a task. Very wide tables are multiplied in
several scans, each of which reads two groups of columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import chunks, named
from tallyframe.sources.workers import map_arrow

#: Columns of a block that is shuffled.
BLOCK = 128
#: Columns of one side of a product; a task holds the sums of its square.
SIDE = 2048
#: First merges of a block; each takes the tasks that share a number.
MERGES = 512


class Moments:
    """Rows so far, and per column the mean, smallest and largest value; co-moments of two sides."""

    def __init__(self, left: int, right: int):
        self.n = 0.0
        self.means = [np.zeros(left), np.zeros(right)]
        self.squares = [np.zeros(left), np.zeros(right)]
        self.lows = [np.full(left, np.inf), np.full(right, np.inf)]
        self.highs = [np.full(left, -np.inf), np.full(right, -np.inf)]
        self.co = np.zeros((left, right))

    @classmethod
    def of(cls, left: np.ndarray, right: np.ndarray) -> Moments:
        """Those of the rows of two matrices."""
        out = cls(left.shape[1], right.shape[1])
        out.n = float(len(left))
        sides = (left, right)
        out.means = [side.mean(axis=0) for side in sides]
        centred = [side - mean for side, mean in zip(sides, out.means)]
        out.squares = [(side * side).sum(axis=0) for side in centred]
        out.lows, out.highs = [side.min(axis=0) for side in sides], [side.max(axis=0) for side in sides]
        out.co = centred[0].T @ centred[1]
        return out

    def add(self, other: Moments) -> None:
        """Take in the rows of ``other``."""
        if not other.n:
            return
        total = self.n + other.n
        apart = [theirs - ours for ours, theirs in zip(self.means, other.means)]
        share = self.n * other.n / total
        self.co = self.co + other.co + np.outer(apart[0], apart[1]) * share
        for side in (0, 1):
            self.squares[side] = self.squares[side] + other.squares[side] + apart[side] ** 2 * share
            self.means[side] = self.means[side] + apart[side] * (other.n / total)
            self.lows[side] = np.minimum(self.lows[side], other.lows[side])
            self.highs[side] = np.maximum(self.highs[side], other.highs[side])
        self.n = total

    def part(self, rows: slice, columns: slice) -> Moments:
        """The moments of some columns of each side."""
        out = Moments(0, 0)
        out.n, out.co = self.n, self.co[rows, columns]
        for name in ("means", "squares", "lows", "highs"):
            left, right = getattr(self, name)
            setattr(out, name, [left[rows], right[columns]])
        return out

    def packed(self) -> bytes:
        vectors = [*self.means, *self.squares, *self.lows, *self.highs]
        return np.concatenate([[self.n, len(self.means[0])], *vectors, self.co.ravel()]).tobytes()

    @classmethod
    def opened(cls, data: bytes) -> Moments:
        cells = np.frombuffer(data, np.float64)
        left = int(cells[1])
        # 2 numbers, 4 vectors a side, and the block: solve for the other width.
        right = (len(cells) - 2 - 4 * left) // (4 + left)
        out = cls(0, 0)
        out.n, at = float(cells[0]), 2
        for name in ("means", "squares", "lows", "highs"):
            pair = []
            for width in (left, right):
                pair.append(cells[at : at + width])
                at += width
            setattr(out, name, pair)
        out.co = cells[at:].reshape(left, right)
        return out

    def correlations(self) -> np.ndarray:
        """The correlations; NaN where a column does not vary."""
        varies = [low < high for low, high in zip(self.lows, self.highs)]
        size = np.sqrt(np.where(varies[0], self.squares[0], np.nan))[:, None] * np.sqrt(np.where(varies[1], self.squares[1], np.nan))
        return self.co / size


def correlation_rows(rows: DataFrame, columns: Sequence[str], side: int = SIDE, block: int = BLOCK) -> DataFrame:
    """``feature_i, feature_j, corr`` of all pairs in both orders; NULL where a column does not vary.

    ``rows`` holds complete rows of doubles. An empty table gives every pair with NULL.
    """
    groups = list(chunks(list(columns), side))
    out = None
    for one, left in enumerate(groups):
        for right in groups[one:]:
            part = _pair_of_groups(rows, left, right, block)
            out = part if out is None else out.unionAll(part)
    return out


def _pair_of_groups(rows: DataFrame, left: Sequence[str], right: Sequence[str], block: int) -> DataFrame:
    """All pairs of two groups of columns, or of one group with itself."""
    left, right = list(left), list(right)
    alone = left == right
    places = [
        (i, j)
        for i in range(0, len(left), block)
        for j in range(0, len(right), block)
        if not alone or i <= j
    ]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments(len(left), len(right))
        for batch in batches:
            if batch.num_rows:
                cells = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
                one = np.column_stack(cells[: len(left)])
                total.add(Moments.of(one, one if alone else np.column_stack(cells[len(left) :])))
        for i, j in places:
            data = total.part(slice(i, i + block), slice(j, j + block)).packed()
            yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "j": pa.array([j], pa.int32()), "cells": [data]})

    def merged(frame: pd.DataFrame) -> Moments:
        found = list(map(Moments.opened, frame["cells"]))
        total = Moments(len(found[0].means[0]), len(found[0].means[1]))
        for each in found:
            total.add(each)
        return total

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": frame["i"][:1], "j": frame["j"][:1], "cells": [merged(frame).packed()]})

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        found = merged(frame).correlations()
        names_i, names_j = left[i : i + block], right[j : j + block]
        if alone and i == j:
            # A block with itself: one value for both orders, and exactly 1 for a column that varies.
            found = np.triu(found, 1) + np.triu(found, 1).T + np.diag(np.where(np.isnan(np.diag(found)), np.nan, 1.0))
        at_i, at_j = np.repeat(names_i, len(names_j)), np.tile(names_j, len(names_i))
        values = found.ravel()
        if not (alone and i == j):
            at_i, at_j, values = np.concatenate([at_i, at_j]), np.concatenate([at_j, at_i]), np.concatenate([values, values])
        return pd.DataFrame({"feature_i": at_i, "feature_j": at_j, "corr": [None if np.isnan(v) else v for v in values.tolist()]})

    schema = "i int, j int, cells binary"
    # Each column once, under a name of its own place.
    wanted = left if alone else left + right
    numbered = rows.select(*[named(name).alias(f"c{at}") for at, name in enumerate(wanted)])
    blocks = map_arrow(numbered, sums, schema)
    # An empty table may have no task at all; one of no rows adds nothing and makes every block.
    nothing = rows.sparkSession.range(1).where("id < 0").selectExpr(*[f"0.0D AS c{at}" for at in range(len(wanted))])
    blocks = blocks.unionAll(map_arrow(nothing.repartition(1), sums, schema))
    some = blocks.withColumn("salt", F.spark_partition_id() % MERGES).groupBy("i", "j", "salt").applyInPandas(merge, schema)
    return some.groupBy("i", "j").applyInPandas(finish, "feature_i string, feature_j string, corr double")
