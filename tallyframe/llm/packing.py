"""Best-fit packing of token sequences, planned on counts of lengths.

Documents are encoded, an end id is appended, and only those longer than a sequence are
cut. The number of pieces of each length goes to the driver (at most ``capacity`` counts,
whatever the corpus). Best-fit decreasing runs over those counts: sequences that look
alike are one group with a count, and a step places as many pieces as the group has
sequences. The plan is then a list of slots: a run of ranks among the pieces of one
length, the first sequence and the place in it. Each piece finds its slot by its rank
within its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import map_batches, stage
from tallyframe.llm.vocabulary import Vocabulary

CAPACITY = 2048


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``total`` ids: whole sequences, the rest first."""
    rest = total % capacity
    return ([rest] if rest else []) + [capacity] * (total // capacity)


def tokenize_pieces(
    documents: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``. Null text counts as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    kind = dict(documents.dtypes)["doc_id"]

    def each(got: dict[str, list]) -> dict[str, list]:
        encode = shared.value.encoder()
        rows: list[tuple] = []
        end = end_id.to_bytes(4, "little")
        for doc_id, text in zip(got["doc_id"], got["text"]):
            ids = encode(text or "") + end
            start = 0
            for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                start += length
        made = list(map(list, zip(*rows)))
        return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), made))

    return map_batches(
        documents.select("doc_id", "text"),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long",
        each,
    )


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: ``(length, first_rank, end_rank, sequence, offset)``.

    Ranks of one length start at 0 and are covered once. Open sequences are kept as runs
    of consecutive numbers with the same space left. The longest pieces go first, each
    into the run with the least space that holds it; a run is cut where fewer pieces
    than sequences are left.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # space left: (first sequence, how many)
    spaces: list[int] = []  # the keys of runs, sorted

    def put(space: int, first: int, many: int) -> None:
        if space:
            if not runs[space]:
                insort(spaces, space)
            runs[space].append((first, many))

    used = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                # No open sequence holds it: as many new ones as fill up with this length.
                fit = capacity // length
                whole, over = divmod(left, fit)
                for many, depth in ((whole, fit), (1 if over else 0, over)):
                    for level in range(depth if many else 0):
                        slots.append((length, rank, rank + many, used, level * length))
                        rank += many
                    if many:
                        put(capacity - depth * length, used, many)
                        used += many
                left = 0
                continue
            space = spaces[at]
            first, many = runs[space].pop()
            if not runs[space]:
                spaces.pop(at)
            take = min(many, left)
            slots.append((length, rank, rank + take, first, capacity - space))
            rank, left = rank + take, left - take
            put(space - length, first, take)
            if take < many:
                put(space, first + take, many - take)
    return slots


def rank_within(pieces: DataFrame, length: str, chunks: int) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... within each length, without one task per length.

    Rows of a length are dealt over ``chunks`` by the hash of their identity; a chunk's
    first rank is the sum of the chunks before it.
    """
    dealt = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(chunks)).cast("int"))
    sizes = dealt.groupBy(length, "chunk").agg(F.count(F.lit(1)).alias("many"))
    before = Window.partitionBy(length).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(length, "chunk", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(length, "chunk").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (
        dealt.withColumn("within", F.row_number().over(inside) - 1)
        .join(firsts, [length, "chunk"])
        .withColumn("rank", F.col("first") + F.col("within"))
        .drop("first", "within", "chunk")
    )


def pack(
    documents: DataFrame,
    vocabulary: Vocabulary,
    capacity: int = CAPACITY,
    end_id: int = 0,
    chunk_rows: int = 20_000,
) -> DataFrame:
    """One row per piece with its sequence and its place there.

    ``documents`` has ``doc_id`` and ``text``; other columns are left out. A null or empty
    text is the end id alone. Repeated rows are packed once each. An empty table gives
    an empty result. Only the counts of lengths come to the driver (at most ``capacity``
    of them), and the broadcast plan grows with ``capacity``, not with the corpus.
    """
    spark = documents.sparkSession
    pieces = stage(tokenize_pieces(documents, vocabulary, capacity, end_id), "pieces")
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = plan_slots(counts, capacity)
    by_length: dict[int, list[tuple]] = defaultdict(list)
    for length, first, end, sequence, offset in sorted(slots):
        by_length[length].append((first, end, sequence, offset))
    # Length to the first ranks, first sequences and offsets of its slots, in rank order.
    table = {
        length: tuple(np.array([slot[at] for slot in group], dtype=np.int64) for at in (0, 2, 3))
        for length, group in by_length.items()
    }
    shared = spark.sparkContext.broadcast(table)
    chunks = max(1, -(-sum(counts.values()) // chunk_rows))
    ranked = rank_within(pieces, "length", chunks)
    kind = dict(documents.dtypes)["doc_id"]

    def each(got: dict[str, list]) -> dict[str, list]:
        sequences, offsets = [], []
        for length, rank in zip(got["length"], got["rank"]):
            firsts, starts, places = shared.value[length]
            at = int(np.searchsorted(firsts, rank, side="right")) - 1
            sequences.append(int(starts[at] + rank - firsts[at]))
            offsets.append(int(places[at]))
        return {name: got[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32")} | {
            "sequence_id": sequences, "offset": offsets,
        }

    return map_batches(
        ranked,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        each,
    )
