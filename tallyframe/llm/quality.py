"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad. What speaks for either are features of the line and of
the lines before and after it, and what the label of the line before it was. The
probability that a line is good, given all lines of its text, comes from a forward and a
backward pass; a document's score is the mean of these over its lines, weighted by their
lengths. The field is fitted by maximum likelihood to a bounded sample of labelled documents,
all of whose lines have the document's label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import SPACES, give_back, held_out, map_batches, without
from tallyframe.llm.labelled import training_sample

#: At most about so many labelled documents are fitted to.
SAMPLE = 8_000
#: For fitting alone, longer texts are cut in stretches of so many lines.
STRETCH = 64
MARKS = "#*$%&<>"


def line_facts(line: str, seen: set[str]) -> list[float]:
    """What one line shows: shares and counts, each between 0 and about 1."""
    words = line.split()
    many, size = len(words), len(line) or 1
    letters = sum(map(len, words)) or 1
    lowered = line.lower()
    upper = sum(a != b for a, b in zip(line, lowered)) if lowered != line and len(lowered) == len(line) else 0
    different = len(set(words))
    adjacent = sum(map(str.__eq__, words[1:], words)) if different < many else 0
    pairs = len(set(zip(words, words[1:]))) if different < many else many - 1
    bars, shouts = line.count("|"), line.count("!")
    marks = sum(map(line.count, MARKS))
    digits = sum(map(str.isdigit, line)) if not line.isalpha() else 0
    again = line in seen
    seen.add(line)
    ends = line.rstrip(SPACES)[-1:]
    mean = letters / many if many else 0.0
    values = [
        upper / letters, min(1.0, 5 * shouts / max(many, 1)), min(1.0, 3 * marks / max(many, 1)), min(1.0, 2 * bars / max(many, 1)),
        digits / letters,
        adjacent / max(many - 1, 1), 1 - different / max(many, 1), 1 - pairs / max(many - 1, 1),
        min(1.0, mean / 12), min(1.0, np.log1p(many) / 6), min(1.0, np.log1p(size) / 8),
        float(again), float(ends in (".", "?")), float(line[:1].isupper()), float(many == 0),
    ]
    steps = [
        values[0] > 0.3, values[0] > 0.7, values[1] > 0.1, values[1] > 0.6, values[2] > 0.05, values[2] > 0.5,
        values[3] > 0.1, values[3] > 0.5, values[5] > 0.1, values[5] > 0.5, values[7] > 0.1, values[7] > 0.4,
        values[6] > 0.5, values[6] > 0.75, many < 3, many < 8, many < 20, many < 50, mean > 8, mean > 12,
    ]
    return values + list(map(float, steps))


def text_facts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths of the lines of a text; a null or empty text is one empty line."""
    lines = (text or "").split("\n")
    seen: set[str] = set()
    facts = np.array([line_facts(line, seen) for line in lines])
    before, after = np.zeros_like(facts), np.zeros_like(facts)
    before[1:], after[:-1] = facts[:-1], facts[1:]
    many = len(lines)
    place = np.zeros((many, 4))
    place[0, 0] = place[-1, 1] = place[:, 2] = 1.0
    place[:, 3] = float(many == 1)
    return np.hstack([facts, before, after, place]), np.array([len(line) + 1 for line in lines], np.float64)


@dataclass(frozen=True)
class Field:
    """Weights for a good line, and scores for each of (bad, good) after (bad, good)."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        """The probability of each line to be good, given the scores of all its text's lines."""
        return chain_marginals(scores[None, :], np.ones((1, len(scores)), bool), self.moves)[0][0]


def chain_marginals(scores: np.ndarray, there: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward passes over many chains, one row each; ``there`` marks real lines.

    Returns the probabilities of good, the log partition functions, and the expected
    number of each move. Chains start at the left; a bad line's score is 0.
    """
    chains, longest = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], axis=2)
    forward = np.zeros((chains, longest, 2))
    forward[:, 0] = emit[:, 0]
    for t in range(1, longest):
        came = np.logaddexp(forward[:, t - 1, 0, None] + moves[0], forward[:, t - 1, 1, None] + moves[1])
        forward[:, t] = np.where(there[:, t, None], came + emit[:, t], forward[:, t - 1])
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    backward = np.zeros((chains, longest, 2))
    for t in range(longest - 2, -1, -1):
        nxt = emit[:, t + 1] + backward[:, t + 1]
        goes = np.logaddexp(moves[:, 0] + nxt[:, 0, None], moves[:, 1] + nxt[:, 1, None])
        backward[:, t] = np.where(there[:, t + 1, None], goes, 0.0)
    good = np.exp(np.minimum(forward[:, :, 1] + backward[:, :, 1] - total[:, None], 0.0))
    joint = (
        forward[:, :-1, :, None] + moves[None, None] + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]
    )
    expected = (np.exp(np.minimum(joint, 0.0)) * there[:, 1:, None, None]).sum(axis=(0, 1))
    return good, total, expected


def fit_field(texts: list[str | None], labels: list[int], steps: int = 150, ridge: float = 1e-4) -> Field:
    """Maximum likelihood with a small ridge, by a gradient method with adaptive step sizes."""
    stretches: list[tuple[np.ndarray, int]] = []
    for text, label in zip(texts, labels):
        facts, _ = text_facts(text)
        stretches += [(facts[at : at + STRETCH].astype(np.float32), label) for at in range(0, len(facts), STRETCH)]
    # Stretches of like lengths are worked on together.
    stretches.sort(key=lambda stretch: len(stretch[0]))
    groups = []
    for at in range(0, len(stretches), 512):
        part = stretches[at : at + 512]
        longest = max(len(facts) for facts, _ in part)
        there = np.zeros((len(part), longest), bool)
        stacked = np.zeros((len(part), longest, part[0][0].shape[1]), np.float32)
        for row, (facts, _) in enumerate(part):
            there[row, : len(facts)] = True
            stacked[row, : len(facts)] = facts
        groups.append((stacked, there, np.array([label for _, label in part])))
    width = stretches[0][0].shape[1]
    many = len(stretches)
    theta = np.zeros(width + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights, moves = theta[:width], theta[width:].reshape(2, 2)
        gradient = ridge * theta
        for stacked, there, label in groups:
            good, _, expected = chain_marginals(stacked @ weights, there, moves)
            miss = np.where(there, label[:, None] - good, 0.0)
            gradient[:width] -= np.einsum("ct,ctf->f", miss, stacked) / many
            stays = (there[:, 1:].sum(axis=1)).astype(float)
            seen = np.array([[stays[label == 0].sum(), 0.0], [0.0, stays[label == 1].sum()]])
            gradient[width:] -= (seen - expected).ravel() / many
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.98 * square + 0.02 * gradient**2
        rate = 0.15 * min(1.0, 3 * (1 - step / (steps + 1)))
        theta = theta - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.98**step)) + 1e-8)
    return Field(theta[:width], theta[width:].reshape(2, 2))


def learn_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """A field fitted to at most about ``sample`` labelled documents that are not held out.

    Without labels every line is good or bad alike. The sample's texts are the only ones
    that reach the driver.
    """
    rows = training_sample(documents, labels, "quality", sample).orderBy("doc_id").collect()
    if not rows:
        return Field(np.zeros(text_facts("")[0].shape[1]), np.zeros((2, 2)))
    field = fit_field([row["text"] for row in rows], [row["label"] for row in rows])
    # The driver goes on to other steps; what the fit held is not kept for them.
    del rows
    give_back()
    return field


def score_quality(documents: DataFrame, field: Field, least: float = 0.3) -> DataFrame:
    """``documents`` with ``score`` (0 to 1), ``predicted`` and ``n_bad_lines``.

    Reads ``text`` alone. Null and empty texts are one empty line and are scored like any
    other. All other columns are kept, repeated rows too, but for those named as one of the
    new ones. An empty table gives an empty result.
    """
    from pyspark.sql import types as T

    documents = without(documents, "score", "predicted", "n_bad_lines")
    names = documents.columns

    def each(got: dict[str, list]) -> dict[str, list]:
        scores, bad = [], []
        for text in got["text"]:
            facts, lengths = text_facts(text)
            good = field.marginals(facts @ field.weights)
            scores.append(float(min(1.0, max(0.0, good @ lengths / lengths.sum()))))
            bad.append(int((good < 0.5).sum()))
        return {name: got[name] for name in names} | {
            "score": scores, "predicted": [int(score >= least) for score in scores], "n_bad_lines": bad,
        }

    schema = T.StructType(
        documents.schema.fields
        + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("n_bad_lines", T.IntegerType())]
    )
    return map_batches(documents, schema, each)


def classify_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_bad_lines`` of every document."""
    field = learn_quality(documents, labels, sample)
    return score_quality(documents.select("doc_id", "text"), field).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted", "n_bad_lines"
    )
