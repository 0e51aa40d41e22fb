"""A search over logistic settings that solves all points and folds together.

The features of a fold's fit are made from the other folds alone: moments of each fold are
computed once, in one pass, and those of all others are merged, so no fold sees its own
rows in scaling or encoding. Each scan then gives, for every problem (point and fold) that
is still open, the loss, the gradient and the second derivatives over the rows outside its
fold, as one matrix product per fold. The steps themselves are small: a penalised quadratic
problem of as many unknowns as there are features, solved on the driver for all open
problems at once. A problem is closed when its optimality conditions hold to a tolerance.

The objective is that of MLlib's classifier: mean loss, and the penalty on coefficients of
columns scaled to unit deviation, intercept left out. It is solved to its optimum, so settings
of ``maxIter`` share their solution.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import named, sql_name
from tallyframe.operators.models import TUNING_GRIDS
from tallyframe.operators.search import first_alike, fold_metric, grid_points, result_table
from tallyframe.sources.workers import map_arrow

#: Codes that the coded columns may have together.
MOST_SLOTS = 1000
#: Cells of a task's products at a time, and of what a scan sums up.
BATCH_CELLS = 2_000_000
SUM_CELLS = 8_000_000
MERGES = 64


@dataclass(frozen=True)
class Moments:
    """Rows, means and sums of squared distances from them, per column."""

    n: float
    mean: np.ndarray
    spread: np.ndarray

    def with_rows_of(self, other: Moments) -> Moments:
        """Both merged."""
        total = self.n + other.n
        if not total:
            return self
        apart = other.mean - self.mean
        return Moments(
            total, self.mean + apart * (other.n / total), self.spread + other.spread + apart**2 * (self.n * other.n / total)
        )

    def deviation(self) -> np.ndarray:
        """The sample deviation."""
        return np.sqrt(self.spread / (self.n - 1)) if self.n > 1 else np.zeros_like(self.spread)


@dataclass(frozen=True)
class FoldFeatures:
    """What makes a row of columns the features of a fold's fits."""

    numeric: tuple[str, ...]
    #: Column and code of each one-hot slot.
    slots: tuple[tuple[str, int], ...]
    #: Per fold: means and inverse deviations over all other folds; 0 for a constant column.
    means: np.ndarray = field(repr=False)
    scales: np.ndarray = field(repr=False)

    def raw(self, batch: pa.RecordBatch) -> np.ndarray:
        """Numeric columns and one-hot slots of a batch."""
        cells = [batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64) for name in self.numeric]
        codes = {name: batch.column(name).to_numpy(zero_copy_only=False) for name, _ in self.slots}
        cells += [(codes[name] == code).astype(np.float64) for name, code in self.slots]
        return np.column_stack(cells)

    def of_fold(self, raw: np.ndarray, fold: int) -> np.ndarray:
        """Scaled by the other folds' moments, then each row scaled to length 1."""
        scaled = (raw - self.means[fold]) * self.scales[fold]
        length = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
        return scaled / np.where(length > 0, length, 1.0)


def fold_features(
    df: DataFrame, numeric: Sequence[str], coded: Sequence[str], fold: str = "fold", folds: int = 10
) -> FoldFeatures:
    """Encoding and scaling for every fold, from one pass over the codes and one over the moments.

    A code that the other folds do not have is constant there, and so has no weight in that fold.
    """
    codes = [
        df.select(F.lit(name).alias("name"), named(name).cast("int").alias("code")).distinct() for name in coded
    ]
    slots: list[tuple[str, int]] = []
    if codes:
        both = codes[0]
        for more in codes[1:]:
            both = both.unionAll(more)
        rows = both.where("code is not null").limit(MOST_SLOTS + 1).collect()
        if len(rows) > MOST_SLOTS:
            raise ValueError(f"the coded columns have more than {MOST_SLOTS} codes")
        slots = sorted(((row["name"], row["code"]) for row in rows), key=lambda slot: (list(coded).index(slot[0]), slot[1]))
    cells = [f"CAST({sql_name(name)} AS DOUBLE)" for name in numeric]
    cells += [f"IF({sql_name(name)} = {code}, 1.0D, 0.0D)" for name, code in slots]
    sums = [F.count(F.lit(1)).alias("n")]
    for at, cell in enumerate(cells):
        sums += [F.avg(F.expr(cell)).alias(f"m{at}"), F.var_pop(F.expr(cell)).alias(f"v{at}")]
    width = len(cells)
    own: dict[int, Moments] = {}
    # One row per fold.
    for row in df.groupBy(named(fold).alias("fold")).agg(*sums).collect():
        mean = np.array([row[f"m{at}"] for at in range(width)], np.float64)
        own[row["fold"]] = Moments(row["n"], mean, np.array([row[f"v{at}"] for at in range(width)], np.float64) * row["n"])
    means, scales = np.zeros((folds, width)), np.zeros((folds, width))
    for held in range(folds):
        rest = Moments(0.0, np.zeros(width), np.zeros(width))
        for other, moments in sorted(own.items()):
            if other != held:
                rest = rest.with_rows_of(moments)
        deviation = rest.deviation()
        # Merged deviations of a constant may be rounding errors above zero.
        constant = deviation <= 1e-12 * np.maximum(1.0, np.abs(rest.mean))
        means[held] = rest.mean
        scales[held] = np.where(constant, 0.0, 1.0 / np.where(constant, 1.0, deviation))
    return FoldFeatures(tuple(numeric), tuple(slots), means, scales)


@dataclass
class Problem:
    """One point on one fold: its penalties, where its solution stands, and the step being tried."""

    point: int
    fold: int
    l1: float
    l2: float
    intercept: bool
    weights: np.ndarray
    step: np.ndarray | None = None
    share: float = 1.0
    value: float = math.inf
    promise: float = 0.0
    violation: float = math.inf

    def tried(self) -> np.ndarray:
        return self.weights if self.step is None else self.weights + self.share * self.step


class Sums:
    """Loss, gradients and second derivatives of open problems, over the rows outside their folds."""

    def __init__(self, features: FoldFeatures, folds: int, weights: dict[int, np.ndarray]):
        self.features, self.folds, self.weights = features, folds, weights

    def shapes(self) -> dict[int, tuple[int, int]]:
        width = self.features.means.shape[1] + 1
        return {fold: (1 + width + width * (width + 1) // 2, own.shape[1]) for fold, own in self.weights.items()}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = self.features.means.shape[1] + 1
        upper = np.triu_indices(width)
        sums = {fold: np.zeros(shape) for fold, shape in self.shapes().items()}
        rows = max(1, BATCH_CELLS // len(upper[0]))
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                part = batch.slice(first, rows)
                raw = self.features.raw(part)
                label = part.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
                own = part.column("fold").to_numpy(zero_copy_only=False)
                for fold, weights in self.weights.items():
                    here = own != fold
                    z = np.column_stack([self.features.of_fold(raw[here], fold), np.ones(int(here.sum()))])
                    y = label[here][:, None]
                    margin = z @ weights
                    chance = 0.5 * (1.0 + np.tanh(0.5 * margin))
                    out = sums[fold]
                    out[0] += (np.logaddexp(0.0, margin) - y * margin).sum(axis=0)
                    out[1 : 1 + width] += z.T @ (chance - y)
                    out[1 + width :] += (z[:, upper[0]] * z[:, upper[1]]).T @ (chance * (1.0 - chance))
        yield _one_row(np.concatenate([sums[fold].ravel() for fold in self.weights]))


class Spreads:
    """Rows, sums and sums of squares of each fold's features over the other folds."""

    def __init__(self, features: FoldFeatures, folds: int):
        self.features, self.folds = features, folds

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = self.features.means.shape[1]
        sums = np.zeros((self.folds, 1 + 2 * width))
        for batch in batches:
            raw = self.features.raw(batch)
            own = batch.column("fold").to_numpy(zero_copy_only=False)
            for fold in range(self.folds):
                z = self.features.of_fold(raw[own != fold], fold)
                sums[fold] += np.concatenate([[len(z)], z.sum(axis=0), (z * z).sum(axis=0)])
        yield _one_row(sums.ravel())


def _one_row(cells: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"cells": [np.ascontiguousarray(cells, np.float64).tobytes()]})


def summed(rows: DataFrame, task) -> np.ndarray:
    """The tasks' arrays added up, in two steps; one array comes to the driver."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(frame["cells"].iloc[0], np.float64).copy()
        for cells in frame["cells"].iloc[1:]:
            total += np.frombuffer(cells, np.float64)
        return pd.DataFrame({"cells": [total.tobytes()]})

    parts = map_arrow(rows, task, "cells binary").withColumn("part", F.spark_partition_id() % MERGES)
    some = parts.groupBy("part").applyInPandas(add, "cells binary")
    found = some.withColumn("part", F.lit(0)).groupBy("part").applyInPandas(add, "cells binary").collect()
    if not found:
        raise ValueError("there are no rows to learn from")
    return np.frombuffer(found[0]["cells"], np.float64)


def search_logistic(
    train: DataFrame,
    numeric: Sequence[str],
    coded: Sequence[str] = (),
    grid: Mapping[str, Sequence[Any]] | None = None,
    label: str = "label",
    fold: str = "fold",
    folds: int = 10,
    tolerance: float = 1e-8,
    most_scans: int = 200,
) -> tuple[DataFrame, DataFrame]:
    """Cross-validate logistic settings on columns: the table of ``tune``, and the solved problems.

    The grid may have ``elasticNetParam``, ``fitIntercept``, ``regParam``, ``maxIter`` and
    ``family`` (binomial). The table has ``violation`` besides, the largest over the folds by which
    the optimality conditions fail; the second frame has ``fitted_as, fold, value, violation,
    coefficients, intercept``, the area under the curve of the fold's own rows and the solution
    on features of unit rows. A problem that is not solved after ``most_scans`` scans has a
    violation above ``tolerance`` there.
    """
    spark = train.sparkSession
    grid = TUNING_GRIDS["logistic"] if grid is None else grid
    if set(grid.get("family", ["binomial"])) - {"binomial", "auto"}:
        raise ValueError("only the binomial family")
    points = grid_points(grid)
    places = first_alike(points, ("maxIter", "family"))
    columns = list(dict.fromkeys([*numeric, *coded]))
    rows = train.select(
        *[named(name) for name in columns], named(label).cast("double").alias("label"), named(fold).cast("int").alias("fold")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        features = fold_features(rows, numeric, coded, "fold", folds)
        width = features.means.shape[1]
        sums = summed(rows, Spreads(features, folds)).reshape(folds, 1 + 2 * width)
        counts, mean = sums[:, 0], sums[:, 1 : 1 + width] / sums[:, :1]
        variance = (sums[:, 1 + width :] - counts[:, None] * mean**2) / np.maximum(counts[:, None] - 1, 1)
        deviations = np.where(features.scales > 0, np.sqrt(np.maximum(variance, 0.0)), 0.0)
        problems = [
            Problem(
                at,
                held,
                point.get("regParam", 0.0) * point.get("elasticNetParam", 0.0),
                point.get("regParam", 0.0) * (1 - point.get("elasticNetParam", 0.0)),
                point.get("fitIntercept", True),
                np.zeros(width + 1),
            )
            for at, point in enumerate(points)
            if places[at] == at
            for held in range(folds)
        ]
        # As many problems at a time as a stated number of sums holds.
        each = 2 + width + (width + 1) * (width + 2) // 2
        room = max(1, SUM_CELLS // each)
        for first in range(0, len(problems), room):
            solve(rows, features, folds, problems[first : first + room], counts, deviations, tolerance, most_scans)
        scored = map_arrow(rows, Scores(features, problems), "fitted_as int, fold int, label double, score double")
        values = fold_metric(scored, "areaUnderROC", ["fitted_as", "fold"])
        solved = spark.createDataFrame(
            [(p.point, p.fold, p.violation, p.weights[:width].tolist(), float(p.weights[width])) for p in problems],
            "fitted_as int, fold int, violation double, coefficients array<double>, intercept double",
        )
        # The rows are let go after this, so the values are brought over: one per problem.
        held = [(row["fitted_as"], row["fold"], row["value"]) for row in values.collect()]
    finally:
        rows.unpersist()
    values = spark.createDataFrame(held, "fitted_as int, fold int, value double")
    worst = solved.groupBy("fitted_as").agg(F.max("violation").alias("violation"))
    table = result_table(points, places, "areaUnderROC", values).join(worst, "fitted_as")
    return (
        table.select("grid_id", "params", "metric", "avg_metric", "std_metric", "fitted_as", "violation"),
        solved.join(values, ["fitted_as", "fold"], "left"),
    )


class Scores:
    """The scores of each row by all solutions for its fold."""

    def __init__(self, features: FoldFeatures, problems: Sequence[Problem]):
        self.features = features
        self.own: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for held in sorted({p.fold for p in problems}):
            mine = [p for p in problems if p.fold == held]
            self.own[held] = (np.array([p.point for p in mine], np.int32), np.column_stack([p.weights for p in mine]))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = self.features.raw(batch)
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
            own = batch.column("fold").to_numpy(zero_copy_only=False)
            for held, (points, weights) in self.own.items():
                here = np.flatnonzero(own == held)
                for first in range(0, len(here), 4096):
                    at = here[first : first + 4096]
                    z = np.column_stack([self.features.of_fold(raw[at], held), np.ones(len(at))])
                    margin = z @ weights
                    yield pa.RecordBatch.from_pydict(
                        {
                            "fitted_as": np.tile(points, len(at)),
                            "fold": np.full(margin.size, held, np.int32),
                            "label": np.repeat(label[at], len(points)),
                            "score": margin.ravel(),
                        }
                    )


def solve(
    rows: DataFrame,
    features: FoldFeatures,
    folds: int,
    problems: Sequence[Problem],
    counts: np.ndarray,
    deviations: np.ndarray,
    tolerance: float,
    most_scans: int,
) -> None:
    """Steps for all open problems after each scan, until all are closed."""
    width = features.means.shape[1] + 1
    upper = np.triu_indices(width)
    for _ in range(most_scans):
        still = [p for p in problems if p.violation > tolerance]
        if not still:
            return
        own = {held: [p for p in still if p.fold == held] for held in sorted({p.fold for p in still})}
        task = Sums(features, folds, {held: np.column_stack([p.tried() for p in mine]) for held, mine in own.items()})
        cells, at = summed(rows, task), 0
        moved: list[tuple[Problem, np.ndarray, np.ndarray]] = []
        for held, (length, many) in task.shapes().items():
            found = cells[at : at + length * many].reshape(length, many) / counts[held]
            at += length * many
            for place, problem in enumerate(own[held]):
                second = np.zeros((width, width))
                second[upper] = found[1 + width :, place]
                second = second + np.triu(second, 1).T
                state = take(problem, float(found[0, place]), found[1 : 1 + width, place], deviations[held])
                if state is not None:
                    moved.append((problem, state, second))
        for problem, gradient, second in moved:
            aim(problem, gradient, second, deviations[problem.fold], tolerance)


def scale_of(problem: Problem, deviation: np.ndarray) -> np.ndarray:
    """What turns weights to those of columns of unit deviation; 0 where a weight stays 0."""
    return np.append(deviation, 1.0 if problem.intercept else 0.0)


def take(problem: Problem, loss: float, gradient: np.ndarray, deviation: np.ndarray) -> np.ndarray | None:
    """Accept what was tried, and return its gradient; or halve the step, and return nothing."""
    at = problem.tried()
    scaled = (at * scale_of(problem, deviation))[:-1]
    value = loss + 0.5 * problem.l2 * float(scaled @ scaled) + problem.l1 * float(np.abs(scaled).sum())
    slack = 1e-13 * max(1.0, abs(problem.value if math.isfinite(problem.value) else 1.0))
    if problem.step is not None and not value <= problem.value + 1e-4 * problem.share * problem.promise + slack:
        if problem.share > 1e-6:
            problem.share *= 0.5
            return None
        # No smaller step helps: the place before is as good as it gets here.
        problem.step, problem.share = None, 1.0
        return None
    problem.weights, problem.step, problem.share, problem.value = at, None, 1.0, value
    return gradient


def aim(problem: Problem, gradient: np.ndarray, second: np.ndarray, deviation: np.ndarray, tolerance: float) -> None:
    """State by how much the optimality conditions fail, and the next step."""
    scale = scale_of(problem, deviation)
    free = np.flatnonzero(scale > 0)
    size = scale[free]
    u = problem.weights[free] * size
    slope = gradient[free] / size
    curve = second[np.ix_(free, free)] / np.outer(size, size)
    penal = np.where(free < len(scale) - 1, 1.0, 0.0)
    l1, l2 = problem.l1 * penal, problem.l2 * penal
    smooth = slope + l2 * u
    problem.violation = float(
        np.abs(np.where(u != 0, smooth + l1 * np.sign(u), np.sign(smooth) * np.maximum(np.abs(smooth) - l1, 0.0))).max(initial=0.0)
    )
    if problem.violation <= tolerance:
        return
    step = quadratic_step(u, slope, curve, l1, l2, tolerance)
    promise = float(slope @ step + 0.5 * (l2 * ((u + step) ** 2 - u**2)).sum() + (l1 * (np.abs(u + step) - np.abs(u))).sum())
    problem.step = np.zeros(len(scale))
    problem.step[free] = step / size
    # Weights that the step sets to zero are exactly zero after a full step.
    gone = free[(u + step == 0) & (l1 > 0)]
    problem.step[gone] = -problem.weights[gone]
    problem.promise = min(promise, 0.0)


def quadratic_step(
    u: np.ndarray, slope: np.ndarray, curve: np.ndarray, l1: np.ndarray, l2: np.ndarray, tolerance: float, rounds: int = 200
) -> np.ndarray:
    """The step that minimises slope.d + d.curve.d / 2 with the penalties at ``u + d``.

    Coordinate steps say which weights move away from zero, and linear solves go along flat
    directions, which coordinate steps alone would creep through.
    """
    full = curve + np.diag(l2)
    # Rows whose columns add up to a constant leave the curve flat in one direction.
    flat = 1e-10 * max(1e-12, float(np.trace(full)) / max(1, len(u)))
    full = full + flat * np.eye(len(u))
    base = slope + l2 * u
    step = np.zeros(len(u))
    diagonal = np.diag(full)
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(u)):
            rest = base[j] + full[j] @ step - diagonal[j] * step[j]
            # The place of this weight that is best with all others fixed.
            aimed = diagonal[j] * u[j] - rest
            new = math.copysign(max(abs(aimed) - l1[j], 0.0), aimed) / diagonal[j] - u[j]
            moved = max(moved, abs(new - step[j]) * diagonal[j])
            step[j] = new
        if moved <= 0.1 * tolerance:
            return step
        # Within the signs found so far the problem is linear: go towards its solution, and where
        # a weight would change its sign on the way, stop there, leave it at zero and go on.
        place = u + step
        live = (place != 0) | (l1 == 0)
        sign = np.sign(place) * (l1 > 0)
        while live.any():
            at = np.flatnonzero(live)
            slopes = base[at] + l1[at] * sign[at] + full[at] @ step
            move = -np.linalg.solve(full[np.ix_(at, at)], slopes)
            place = u[at] + step[at]
            turns = (sign[at] != 0) & (np.sign(place + move) * sign[at] <= 0) & (move != 0)
            reach = np.where(turns, -place / np.where(move != 0, move, 1.0), 1.0)
            first = int(np.argmin(reach))
            if not turns.any() or reach[first] >= 1.0:
                step[at] += move
                break
            step[at] += max(float(reach[first]), 0.0) * move
            step[at[first]] = -u[at[first]]
            live[at[first]] = False
        smooth = base + full @ step
        resting = ~live
        if (np.abs(smooth[resting]) <= l1[resting] + 0.1 * tolerance).all():
            return step
    return step
