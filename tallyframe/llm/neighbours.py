"""Nearest neighbours by a block matrix join of int8 tiles with error bounds.

Vectors are quantised to int8 with a scale of their own. Rows and queries are packed in
blocks; every block of queries meets every block of rows by an equality join on tile
numbers. In a tile, the int8 product gives each inner product up to a bound that follows
from the quantisation errors. Pairs whose upper bound is below the k-th largest lower
bound cannot be among the k nearest and go; the others are computed again from the
original vectors in double precision. Tiles' winners are merged by heaps.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import map_batches, rows_in, ship, stage

BLOCK = "block int, ids binary, quantised binary, scales binary, errors binary, norms binary, vectors binary"


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 values, scales, norms of the errors and norms of the rows.

    ``vectors`` is double. The error's norm is computed from what int8 keeps, and raised by
    a little to cover rounding.
    """
    largest = np.abs(vectors).max(axis=1)
    scales = largest / 127.0
    # A scale that underflows keeps nothing; its whole vector then counts as error.
    safe = np.where(scales > 0, scales, 1.0)
    kept = np.clip(np.rint(vectors / safe[:, None]), -127, 127).astype(np.int8)
    errors = norms_of(vectors - kept * safe[:, None]) * (1 + 1e-9)
    return kept, safe, errors, norms_of(vectors) * (1 + 1e-9)


def norms_of(vectors: np.ndarray) -> np.ndarray:
    """Euclidean norms that neither overflow nor underflow on the way."""
    top = np.abs(vectors).max(axis=1, initial=0.0)
    safe = np.where(top > 0, top, 1.0)
    return np.sqrt(((vectors / safe[:, None]) ** 2).sum(axis=1)) * top


def valid(column: str):
    """Whether a vector takes part: not null or empty, all components finite, not all zero."""
    limit = F.lit(1.7976931348623157e308)
    return (
        F.col(column).isNotNull()
        & (F.size(column) > 0)
        & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= limit))
        & F.exists(column, lambda x: x != 0)
    )


def blocks_of(rows: DataFrame, size: int, total: int) -> DataFrame:
    """One row per block of about ``size`` vectors: ids and matrices as bytes.

    Rows are dealt by the hash of id and vector; copies of one id would meet in a block but
    are dealt by their place in the input as well, so that no block grows with them.
    """
    count = max(1, math.ceil(total / size))

    def pack(key, group):
        vectors = np.array(group["vector"].tolist(), dtype=np.float64)
        kept, scales, errors, norms = quantise(vectors)
        return pd.DataFrame(
            [
                (
                    int(key[0]),
                    group["id"].to_numpy(np.int64).tobytes(),
                    kept.tobytes(),
                    scales.tobytes(),
                    errors.tobytes(),
                    norms.tobytes(),
                    vectors.tobytes(),
                )
            ],
            columns=[part.split()[0] for part in BLOCK.split(", ")],
        )

    ship(rows.sparkSession)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(count)).cast("int"))
    return dealt.groupBy("block").applyInPandas(pack, BLOCK)


def opened(parts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """The arrays of a block, from its columns after the number."""
    kinds = (np.int64, np.int8, np.float64, np.float64, np.float64, np.float64)
    ids, kept, scales, errors, norms, vectors = (np.frombuffer(part, kind) for part, kind in zip(parts, kinds))
    return ids, kept.reshape(len(ids), width), scales, errors, norms, vectors.reshape(len(ids), width)


def exact_products(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal rows have equal results wherever they stand."""
    return (rows * query[None, :]).sum(axis=1)


def tile(queries: tuple[np.ndarray, ...], rows: tuple[np.ndarray, ...], k: int) -> list[tuple[int, int, float]]:
    """The at most ``k`` best ``(query, row, score)`` of each query in one tile."""
    q_ids, q_kept, q_scales, q_errors, q_norms, q_vectors = queries
    r_ids, r_kept, r_scales, r_errors, r_norms, r_vectors = rows
    # Sums of products of int8 values are whole numbers, which float32 holds exactly up to 2^24.
    exact = np.float32 if q_kept.shape[1] * 127 * 127 < 1 << 24 else np.float64
    products = (q_kept.astype(exact) @ r_kept.T.astype(exact)).astype(np.float64)
    estimate = products * q_scales[:, None] * r_scales[None, :]
    # q.r = (Q + e)(R + f): the rest is at most |e| |r| + (|q| + |e|) |f|, and rounding.
    bound = q_errors[:, None] * r_norms[None, :] + (q_norms + q_errors)[:, None] * r_errors[None, :]
    bound += 1e-12 * (q_norms[:, None] * r_norms[None, :]) + np.finfo(np.float64).tiny
    low = estimate - bound
    same = q_ids[:, None] == r_ids[None, :]
    low[same] = -np.inf
    out: list[tuple[int, int, float]] = []
    for at in range(len(q_ids)):
        mine = low[at]
        floor = -np.inf if len(mine) <= k else np.partition(mine, len(mine) - k)[len(mine) - k]
        left = np.flatnonzero((estimate[at] + bound[at] >= floor) & ~same[at])
        scores = exact_products(q_vectors[at], r_vectors[left])
        best = np.lexsort((r_ids[left], -scores))[:k]
        out += [(int(q_ids[at]), int(r_ids[left[b]]), float(scores[b])) for b in best]
    return out


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    query_block: int = 512,
    row_block: int = 4096,
) -> DataFrame:
    """The ``k`` rows with the largest inner product for each query: ``query_id, rank, vec_id, score``.

    Both inputs have ``vec_id`` and ``embedding``. Exact: the bounds lose nothing. Vectors that
    are null, empty, zero or hold null or non-finite components take no part; so do rows
    with a null id, and vectors of a width other than the most frequent one raise an error.
    Ties go to the smaller id. Repeated rows are one row. Fewer candidates give fewer
    rows; an empty table gives an empty result.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return (
            df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & valid("vector"))
            .distinct()
        )

    widths = [row["w"] for row in clean(vectors).select(F.size("vector").alias("w")).distinct().limit(2).collect()]
    if len(widths) > 1:
        raise ValueError(f"vectors have several widths, {sorted(widths)} among them")
    if not widths:
        return spark.createDataFrame([], schema)
    width = widths[0]
    rows, asked = clean(vectors), clean(queries).filter(F.size("vector") == width)
    row_count = rows_in(rows)
    row_blocks = stage(blocks_of(rows, row_block, row_count), "row-blocks")
    query_blocks = blocks_of(asked, query_block, rows_in(asked))
    tiles = max(1, math.ceil(row_count / row_block))
    # A query block goes once to each tile of its row; blocks of rows are shuffled once.
    names = [part.split()[0] for part in BLOCK.split(", ")]
    spread = query_blocks.select(
        *[F.col(name).alias(f"q_{name}") for name in names],
        F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("block"),
    )
    pairs = row_blocks.join(spread, "block")

    def each(got: dict[str, list]) -> dict[str, list]:
        found: list[tuple[int, int, float]] = []
        for at in range(len(got["block"])):
            asked_block, row_block_ = (
                opened([got[prefix + name][at] for name in names[1:]], width) for prefix in ("q_", "")
            )
            found += tile(asked_block, row_block_, k)
        return dict(zip(("query_id", "vec_id", "score"), map(list, zip(*found)))) if found else {
            "query_id": [], "vec_id": [], "score": []
        }

    winners = map_batches(pairs, "query_id long, vec_id long, score double", each)

    def merge(key, group):
        best = heapq.nsmallest(
            k, zip(-group["score"].to_numpy(), group["vec_id"].to_numpy())
        )
        # The same pair may come from repeated ids with several vectors.
        return pd.DataFrame(
            [(int(key[0]), at, int(vec), float(-score)) for at, (score, vec) in enumerate(best, 1)],
            columns=["query_id", "rank", "vec_id", "score"],
        )

    return winners.groupBy("query_id").applyInPandas(merge, schema)
