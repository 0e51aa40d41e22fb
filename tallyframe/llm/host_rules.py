"""Quality rules by host: failures are added up per host, shrunk, and joined back.

Every document is measured by itself (words, symbols, repeated lines and repeated
three-word windows) and fails or passes the base rules. A host's rate of failures is then
shrunk with a beta prior that is fitted to all hosts by the method of moments, so that
a host of three documents is not judged by those three alone. A host whose shrunk rate
is above ``most_failed`` takes all its documents with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import SPACES, map_batches, stage

SYMBOLS = "#*$%&|<>"
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words covered by windows of ``size`` words that occur twice or more in the list."""
    windows = list(zip(*(words[at:] for at in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    covered = end = 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            covered += at + size - max(at, end)
            end = at + size
    return covered


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """The features of one text; zeros for null or empty ones."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measure_documents(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``host`` and the features."""

    def each(got: dict[str, list]) -> dict[str, list]:
        made = list(zip(*map(measure, got["text"])))
        names = [part.split()[0] for part in FEATURES.split(", ")]
        return {"doc_id": got["doc_id"], "host": got["host"]} | dict(zip(names, map(list, made)))

    kinds = dict(documents.select("doc_id", "host").dtypes)
    return map_batches(
        documents.select("doc_id", "host", "text"),
        f"doc_id {kinds['doc_id']}, host {kinds['host']}, {FEATURES}",
        each,
    )


def host_rates(judged: DataFrame) -> DataFrame:
    """One row per host: documents, failures and the shrunk rate.

    ``judged`` has ``host`` and ``base_failed``. With mean ``m`` and variance ``v`` of the
    raw rates over hosts, the prior weighs ``k = m (1 - m) / v - 1`` documents, at least
    1 and at most 1000; without spread it weighs 1000. The rate is
    ``(failed + m k) / (documents + k)``. A null host is a host of its own. Counting
    has partial sums in each task, so a host with a third of all rows costs no more.
    """
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"),
        F.sum(F.col("base_failed").cast("long")).alias("host_failed"),
    )
    raw = F.col("host_failed") / F.col("host_docs")
    mean, spread = F.avg(raw), F.var_pop(raw)
    weight = F.when(
        spread > 0, F.least(F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0)), F.lit(1000.0))
    ).otherwise(1000.0)
    # Two single numbers, as scalar subqueries over the counts.
    m, k = hosts.agg(mean).scalar(), hosts.agg(weight).scalar()
    shrunk = (F.col("host_failed") + m * k) / (F.col("host_docs") + k)
    return hosts.select("host", "host_docs", "host_failed", F.round(shrunk, 6).alias("host_rate"))


def apply_host_rules(
    documents: DataFrame,
    host: str = "source",
    least_words: int = 50,
    most_repeated: int = 50,
    most_failed: float = 0.5,
) -> DataFrame:
    """Features, base verdict, host figures and the final verdict of each document.

    ``documents`` has ``doc_id``, ``text`` and the host column; other columns are left
    out. Null and empty texts have zeros and fail (no words). Rows are judged one by one,
    so repeated ids stay. An empty table gives an empty result.
    """
    features = measure_documents(
        documents.select("doc_id", F.col(host).alias("host"), "text")
    ).withColumn(
        "base_failed",
        (F.col("n_words") < least_words)
        | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")),
    )
    features = stage(features, "host-features")
    rates = host_rates(features)
    # The joined side is a row per host. Adaptive execution splits a host with many rows.
    joined = features.alias("f").join(
        rates.alias("h"), F.col("f.host").eqNullSafe(F.col("h.host")), "left"
    )
    return joined.select(
        "f.*", "host_docs", "host_failed", "host_rate",
        (~F.col("base_failed") & (F.col("host_rate") <= most_failed)).alias("kept"),
    )
