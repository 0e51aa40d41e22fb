"""Tree fits on cells: rows that fall in the same bins, counted.

A tree sees of a row only its bins and its label, so rows that are equal in both can be one row
with a weight. The cut points between bins are those MLlib takes: of all rows where these are few, else of a
sample as large as its own or larger. A fit then costs what the cells cost, however many rows they
stand for. Where counting saves less than half of the rows (many features, few rows), the rows
themselves are fitted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.columns import named
from tallyframe.sources.scratch import scratch_path
from tallyframe.sources.workers import map_arrow, ship

# How many rows MLlib looks at for cut points at least, and how many rows are counted at a time.
LEAST_SAMPLED = 10_000
CHUNK = 200_000
# Cells of one task in a fit.
CELLS_A_TASK = 50_000
# No rows are held out.
NO_FOLD = -1

CELL = "held int, bins int, cells array<int>, label int, inside boolean, weight bigint"


@dataclass(frozen=True)
class Problem:
    """Rows or cells of one fit: ``features, label, inside, weight``; ``inside`` are the rows held out.

    ``limits`` are the cut points by slot where ``data`` holds cells, else None. ``total`` is the weight
    outside, ``n`` the number of rows or cells.
    """

    data: DataFrame
    total: int
    n: int
    limits: Mapping[int, Sequence[float]] | None

    def train(self) -> DataFrame:
        return self.data.where(~F.col("inside"))

    def held(self) -> DataFrame:
        return self.data.where("inside")

    def params(self, params: Mapping[str, Any]) -> dict[str, Any]:
        """Settings that make a fit on the cells what it would be on the rows."""
        if self.limits is None:
            return dict(params)
        return {**params, **weighted_params(params, self.total, self.n)}


def weighted_params(params: Mapping[str, Any], total: float, n: int) -> dict[str, Any]:
    """The least number of rows in a leaf as a weight, and bins enough that every one of the cells' is kept."""
    leaf = params.get("minInstancesPerNode", 1)
    out = {"weightCol": "weight", "minInstancesPerNode": 1, "maxBins": max(params.get("maxBins", 32), math.isqrt(n) + 2)}
    if total >= 2 * leaf:
        # Weights are whole numbers, so half a row keeps clear of rounding.
        return {**out, "minWeightFractionPerNode": (leaf - 0.5) / total}
    return {**out, "maxDepth": 0}


def categories(df: DataFrame, features: str) -> dict[int, int]:
    """Slots of a vector column that hold categories, and how many."""
    attributes = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return {
        one["idx"]: one.get("num_vals") or len(one.get("vals") or (0, 1))
        for kind in ("nominal", "binary")
        for one in attributes.get(kind, [])
    }


def cut_values(values: np.ndarray, counts: np.ndarray, bins: int) -> list[float]:
    """MLlib's cut points between distinct sorted values that occur so often."""
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) < bins:
        return middles.tolist()
    stride = counts.sum() / bins
    target, current, cuts = stride, float(counts[0]), []
    for at in range(1, len(values)):
        before, current = current, current + float(counts[at])
        if abs(before - target) < abs(current - target):
            cuts.append(float(middles[at - 1]))
            target += stride
    return cuts


def cut_points(
    rows: DataFrame, nominal: Mapping[int, int], bins: Sequence[int], sizes: Mapping[int, int], held: Sequence[int]
) -> dict[tuple[int, int], dict[int, list[float]]]:
    """Cut points by slot, for each fold held out and number of bins; ``rows`` are ``cells, label, fold``."""
    n = sum(sizes.values())
    enough = 2 * max(LEAST_SAMPLED, max(bins) ** 2)
    some = rows if n <= enough else rows.sample(False, enough / n, 42)
    left = {one: n - sizes.get(one, 0) for one in held}

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for one in held:
            counted = frame[frame["fold"] != one].groupby("value")["n"].sum().sort_index()
            for most in bins:
                cuts = cut_values(counted.index.to_numpy(np.float64), counted.to_numpy(), min(most, left[one])) if len(counted) else []
                found.append((frame["slot"].iloc[0], one, most, cuts))
        return pd.DataFrame(found, columns=["slot", "held", "bins", "cuts"])

    values = some.select(F.posexplode("cells").alias("slot", "value"), "fold").where(~F.isnan("value"))
    if nominal:
        values = values.where(~F.col("slot").isin(*nominal))
    counted = values.groupBy("slot", "value", "fold").agg(F.count(F.lit(1)).alias("n"))
    limits: dict[tuple[int, int], dict[int, list[float]]] = {(one, most): {} for one in held for most in bins}
    for row in counted.groupBy("slot").applyInPandas(find, "slot int, held int, bins int, cuts array<double>").collect():
        limits[row.held, row.bins][row.slot] = list(row.cuts)
    return limits


def first_and_count(columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first of each kind of equal rows, and how many they are; columns are whole numbers from 0."""
    code, span = np.zeros(len(columns[0]), np.int64), 1
    for column in columns:
        size = int(column.max()) + 1
        if span * size >= 2**62:
            code, span = np.unique(code, return_inverse=True)[1].astype(np.int64), len(code)
        code, span = code * size + column, span * size
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return first, counts


def count_cells(rows: DataFrame, limits: Mapping[tuple[int, int], Mapping[int, Sequence[float]]]) -> DataFrame:
    """``held, bins, cells, label, inside, weight`` of all problems, from one scan of ``cells, label, fold``."""
    cuts = {problem: {slot: np.array(values) for slot, values in by.items()} for problem, by in limits.items()}

    def counted(values: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> Iterator[pa.RecordBatch]:
        whole = np.nan_to_num(values).astype(np.int64)
        for (one, most), by in cuts.items():
            columns = [
                # A value at a cut point goes left, as in a tree. Cells of cut slots count from 1.
                np.searchsorted(by[at], values[:, at]) + 1 if at in by else whole[:, at]
                for at in range(values.shape[1])
            ]
            inside = folds == one
            first, counts = first_and_count([*columns, labels, inside.astype(np.int64)])
            table = np.column_stack([column[first] for column in columns]).astype(np.int32)
            ends = pa.array(np.arange(len(first) + 1, dtype=np.int32) * table.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(first), one, np.int32)),
                    pa.array(np.full(len(first), most, np.int32)),
                    pa.ListArray.from_arrays(ends, pa.array(table.ravel())),
                    pa.array(labels[first].astype(np.int32)),
                    pa.array(inside[first]),
                    pa.array(counts.astype(np.int64)),
                ],
                names=["held", "bins", "cells", "label", "inside", "weight"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield from opened(kept)
                kept, n = [], 0
        if kept:
            yield from opened(kept)

    def opened(kept: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, labels, folds = pa.Table.from_batches(kept).combine_chunks().columns
        flat = values.combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return counted(flat.reshape(len(labels), -1), labels.to_numpy().astype(np.int64), folds.to_numpy())

    parts = map_arrow(rows, run, CELL)
    return parts.groupBy("held", "bins", "cells", "label", "inside").agg(F.sum("weight").alias("weight"))


def problems(
    train: DataFrame, features: str, label: str, bins: Sequence[int], fold: str | None = None, held: Sequence[int] = (NO_FOLD,)
) -> dict[tuple[int, int], Problem]:
    """One problem for each fold held out and each number of bins."""
    spark = train.sparkSession
    ship(spark)
    number = named(fold).cast("int") if fold else F.lit(NO_FOLD - 1)
    rows = train.select(named(features).alias("features"), named(label).alias("label"), number.alias("fold"))
    whole = F.col("label").cast("int")
    wrong = F.col("label").isNull() | (F.col("label") != whole) | (whole < 0)
    # As MLlib does: a label that is no class is an error, not a class of its own.
    checked = F.when(wrong, F.raise_error(F.lit("labels must be whole numbers from 0"))).otherwise(whole)
    plain = rows.select(vector_to_array("features").alias("cells"), checked.alias("label"), "fold")
    sizes = {row.fold: row.n for row in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, nominal = sum(sizes.values()), categories(train, features)
    metadata = train.schema[features].metadata

    def as_rows(one: int) -> Problem:
        data = rows.select("features", "label", (F.col("fold") == one).alias("inside"), F.lit(1.0).alias("weight"))
        return Problem(data, n - sizes.get(one, 0), n, None)

    # A category too many is MLlib's to refuse.
    wanted = [most for most in bins if max(nominal.values(), default=0) <= most]
    out = {(one, most): as_rows(one) for one in held for most in bins}
    if not wanted or not n:
        return out
    limits = cut_points(plain, nominal, wanted, sizes, held)
    path = scratch_path(spark, "cells")
    count_cells(plain, limits).write.partitionBy("held", "bins").parquet(path)
    schema = "cells array<int>, label int, inside boolean, weight bigint, held int, bins int"
    cells = spark.read.schema(schema).parquet(path)
    for row in cells.groupBy("held", "bins").agg(F.count(F.lit(1)).alias("n")).collect():
        if 2 * row.n <= n and row.n >= max(nominal.values(), default=0):
            own = spark.read.schema(schema).parquet(f"{path}/held={row.held}/bins={row.bins}")
            vector = array_to_vector(F.col("cells").cast("array<double>"))
            data = own.select(
                vector.alias("features", metadata=metadata), F.col("label").cast("double").alias("label"), "inside",
                F.col("weight").cast("double").alias("weight"),
            ).coalesce(math.ceil(row.n / CELLS_A_TASK))
            out[row.held, row.bins] = Problem(data, n - sizes.get(row.held, 0), row.n, limits[row.held, row.bins])
    return out


def on_values(spark: SparkSession, model: Model, limits: Mapping[int, Sequence[float]], keep: Mapping[str, Any]) -> Model:
    """A model of cells as one of the rows' own values: a saved model whose thresholds are the cut points.

    ``keep`` are settings by which the model is known.
    """
    path = scratch_path(spark, "model")
    model.write().save(f"{path}/cells")
    places = spark.createDataFrame(
        [(slot, at, cut) for slot, cuts in limits.items() for at, cut in enumerate(cuts)], "slot int, at int, cut double"
    )
    nodes = spark.read.parquet(f"{path}/cells/data")
    nested = "nodeData" in nodes.columns
    split = F.col("nodeData.split" if nested else "split")
    threshold = split["leftCategoriesOrThreshold"]
    cut = (split["numCategories"] == -1) & (split["featureIndex"] >= 0)
    # Cells count from 1, so the first cut point lies at 1.5.
    joined = nodes.join(
        F.broadcast(places), cut & (split["featureIndex"] == F.col("slot")) & (F.round(F.get(threshold, F.lit(0)) - 1.5) == F.col("at")), "left"
    )
    mended = split.withField("leftCategoriesOrThreshold", F.when(cut, F.array("cut")).otherwise(threshold))
    fields = {"nodeData": F.col("nodeData").withField("split", mended)} if nested else {"split": mended}
    joined.withColumns(fields).select(*nodes.columns).write.parquet(f"{path}/values/data")
    spark.read.text(f"{path}/cells/metadata").coalesce(1).write.text(f"{path}/values/metadata")
    if nested:
        spark.read.parquet(f"{path}/cells/treesMetadata").write.parquet(f"{path}/values/treesMetadata")
    out = type(model).load(f"{path}/values")
    for name in ("weightCol", "minWeightFractionPerNode", "maxBins", "minInstancesPerNode", "maxDepth"):
        if out.isSet(name):
            out.clear(out.getParam(name))
    return out._set(**{name: value for name, value in keep.items() if out.hasParam(name)})
