"""Random forests on cells, grown in the task.

MLlib draws a forest's bags by row: a row is in a bag as often as a Poisson number of mean 1 says. Rows
that are equal in bins and label can be told apart by nothing else, so the rows of a cell that stands for
``n`` of them are in a bag as often as a Poisson number of mean ``n`` says. A tree then costs what the cells
cost, and where these fit in one task, no level of it is a Spark job.

Splits follow MLlib's rules for two classes: Gini impurity, categories ordered by their count of class 1, a
square root of the features drawn at each node, and leaves of one prediction joined with their parent. No
choice at a node depends on the depth limit, so a tree with a lower limit is the upper part of one with a higher.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

# Cells of one task, pairs of a tree and a cell grown at a time, and counts of a histogram at a time.
MOST_CELLS = 200_000
PAIRS = 250_000
COUNTS = 1_000_000


@dataclass(frozen=True)
class Trees:
    """Nodes of several trees, level by level; the first are the roots. A node's right child follows its left one.

    ``levels`` are the places where levels begin, and that where the last one ends.
    """

    feature: np.ndarray
    left: np.ndarray
    goes_left: np.ndarray
    counts: np.ndarray
    levels: Sequence[int]

    def ends(self, depth: int) -> np.ndarray:
        """Which nodes are leaves under a depth limit, after leaves of one prediction are joined."""
        out, guess = self.feature < 0, self.counts[:, 1] > self.counts[:, 0]
        depth = min(depth, len(self.levels) - 1)
        out[self.levels[depth] :] = True
        for level in range(depth - 1, -1, -1):
            at = np.arange(self.levels[level], self.levels[level + 1])
            at = at[~out[at]]
            one, other = self.left[at], self.left[at] + 1
            out[at] = out[one] & out[other] & (guess[one] == guess[other])
        return out

    def votes(self, x: np.ndarray, trees: int, depth: int) -> np.ndarray:
        """Shares of both classes in the leaf of each tree and row, ``(trees, rows, 2)``; zeros for an empty bag."""
        ends, rows = self.ends(depth), np.arange(len(x))
        node = np.repeat(np.arange(trees)[:, None], len(x), axis=1)
        while not ends[node].all():
            cell = x[rows, np.maximum(self.feature[node], 0)]
            node = np.where(ends[node], node, self.left[node] + ~self.goes_left[node, cell])
        counts = self.counts[node]
        total = counts.sum(axis=2, keepdims=True)
        return counts / np.where(total == 0, 1, total)


def gini(zeros: np.ndarray, ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Impurity of counts of two classes, in MLlib's order of operations."""
    safe = np.where(total == 0, 1, total)
    a, b = zeros / safe, ones / safe
    return np.where(total == 0, 0.0, 1.0 - a * a - b * b)


def best_splits(
    local: np.ndarray, x: np.ndarray, weights: np.ndarray, nodes: np.ndarray, taken: np.ndarray,
    bins: Sequence[int], nominal: Sequence[int], leaf: int,
) -> tuple[np.ndarray, np.ndarray]:
    """For each node the feature to split by, -1 for none, and which of its bins go left."""
    k, most = len(nodes), max(bins)
    feature, gains, goes_left = np.full(k, -1), np.zeros(k), np.zeros((k, most + 1), bool)
    total = nodes.sum(axis=1)
    impurity = gini(nodes[:, 0], nodes[:, 1], total)
    for at, n in enumerate(bins):
        if n < 2:
            continue
        key = local * n + x[:, at]
        zeros, ones = (np.bincount(key, weights[:, one], k * n).reshape(k, n) for one in (0, 1))
        rank = np.broadcast_to(np.arange(n), (k, n))
        if at in nominal:
            order = np.argsort(np.where(zeros + ones > 0, ones, np.inf), axis=1, kind="stable")
            rank = np.argsort(order, axis=1, kind="stable")
            zeros, ones = np.take_along_axis(zeros, order, 1), np.take_along_axis(ones, order, 1)
        zeros, ones = zeros.cumsum(axis=1)[:, :-1], ones.cumsum(axis=1)[:, :-1]
        lesser = zeros + ones
        greater = total[:, None] - lesser
        safe = np.where(total == 0, 1, total)[:, None]
        gain = (
            impurity[:, None]
            - lesser / safe * gini(zeros, ones, lesser)
            - greater / safe * gini(nodes[:, :1] - zeros, nodes[:, 1:] - ones, greater)
        )
        gain[(lesser < leaf) | (greater < leaf)] = -np.inf
        gain[~taken[:, at]] = -np.inf
        split = gain.argmax(axis=1)
        found = gain[np.arange(k), split]
        better = found > gains
        gains[better], feature[better] = found[better], at
        goes_left[better] = False
        goes_left[better, :n] = rank[better] <= split[better, None]
    return feature, goes_left


def grow(
    x: np.ndarray, bags: np.ndarray, bins: Sequence[int], nominal: Sequence[int], depth: int, leaf: int,
    features: int, random: np.random.Generator,
) -> Trees:
    """Trees over cells ``x``, numbers of bins from 0; ``bags`` are ``(trees, cells, 2)`` counts of both classes.

    Each node looks at so many ``features`` drawn for it.
    """
    tree, cell = np.nonzero(bags.any(axis=2))
    weights, node = bags[tree, cell], tree
    here = bags.sum(axis=1)
    levels, out = [0], []
    step = max(1, COUNTS // max(bins))
    for level in range(depth + 1):
        k, start = len(here), levels[-1]
        feature, goes_left = np.full(k, -1), np.zeros((k, max(bins) + 1), bool)
        if level < depth and k:
            taken = np.zeros((k, len(bins)), bool)
            np.put_along_axis(taken, random.random((k, len(bins))).argsort(axis=1)[:, :features], True, axis=1)
            if k > step:
                by_node = node.argsort(kind="stable")
                cell, weights, node = cell[by_node], weights[by_node], node[by_node]
            for first in range(0, k, step):
                last = min(first + step, k)
                part = slice(*np.searchsorted(node, [first, last])) if k > step else slice(None)
                feature[first:last], goes_left[first:last] = best_splits(
                    node[part] - first, x[cell[part]], weights[part], here[first:last], taken[first:last], bins, nominal, leaf
                )
        split = feature >= 0
        left = np.where(split, start + k + 2 * (split.cumsum() - 1), -1)
        out.append((feature, left, goes_left, here))
        levels.append(start + k)
        if not split.any():
            break
        stay = split[node]
        cell, weights, node = cell[stay], weights[stay], node[stay]
        node = left[node] + ~goes_left[node, x[cell, feature[node]]] - (start + k)
        here = np.column_stack([np.bincount(node, weights[:, one], 2 * split.sum()) for one in (0, 1)])
    return Trees(*(np.concatenate(parts) for parts in zip(*out)), levels)


def forest_votes(
    x: np.ndarray, weights: np.ndarray, asked: np.ndarray, bins: Sequence[int], nominal: Sequence[int],
    depths: Sequence[int], leaf: int, sizes: Sequence[int], seed: Sequence[int],
) -> Iterator[tuple[int, int, np.ndarray]]:
    """Summed votes over the rows ``asked`` for each depth limit and number of trees: ``depth, size, votes``.

    ``weights`` count the rows of both classes in each cell. One forest of the most trees and the highest limit is
    grown; the others are its beginnings and upper parts. The same cells in the same order give the same forest.
    """
    # MLlib takes all features where it grows one tree alone.
    features = len(bins) if max(sizes) == 1 else math.ceil(math.sqrt(len(bins)))
    batch = max(1, min(max(sizes), PAIRS // max(1, len(x), len(asked))))
    asked = np.minimum(asked, max(bins))
    sums = {depth: np.zeros((len(asked), 2)) for depth in depths}
    for first in range(0, max(sizes), batch):
        trees = min(batch, max(sizes) - first)
        random = np.random.default_rng([*seed, first])
        bags = random.poisson(weights, (trees, *weights.shape)).astype(np.float64)
        grown = grow(x, bags, bins, nominal, max(depths), leaf, features, random)
        for depth in depths:
            votes = grown.votes(asked, trees, depth)
            for at in range(trees):
                sums[depth] = sums[depth] + votes[at]
                if first + at + 1 in sizes:
                    yield depth, first + at + 1, sums[depth]
