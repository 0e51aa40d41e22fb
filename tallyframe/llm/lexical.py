"""Ranked lexical search by dense products of item tiles and document tiles.

Items are short, so the terms that any item holds are a compact vocabulary. A scan of the
documents counts all their terms and keeps those of the vocabulary; that gives how many
documents hold each term, and so the weights. Scores are then matrix products: a tile of
items (items x terms, weights) times a tile of documents (terms x documents, impacts), over
the terms of the item tile alone. Weights and impacts are whole numbers held in float64.
A product takes only as many terms as keep every partial sum below 2^53, so it is exact;
the products of further terms are added up as 64-bit integers.

Each task keeps the best documents of every item over its tiles, with all that tie with the
last one until ids decide; the tasks' winners are merged in two steps.

The vocabulary goes to all tasks. Items whose terms together exceed a stated number of bytes
are dealt over groups, each of which is searched by a scan of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import discard, map_arrow, map_batches, stage

TOP = 50
ITEM_TILE = 64
DOCUMENT_TILE = 512
#: Terms of one product, if the bound of partial sums does not ask for fewer.
TERM_TILE = 4096
#: Bytes of terms that one scan's vocabulary holds, about.
VOCABULARY_BYTES = 4_000_000
#: Partial sums of a product stay below this, so that float64 holds them exactly.
EXACT = 1 << 53
#: An impact is below this: 10^9 tf / (1000 tf + ...).
MOST_IMPACT = 1_000_000
#: Groups of tasks whose winners are merged first.
MERGES = 64

#: Bytes of terms are digits, letters (A-Z as a-z) and all of code points above 127.
_TERM_BYTES = bytes(
    at + 32 if 65 <= at <= 90 else at if at >= 128 or 48 <= at <= 57 or 97 <= at <= 122 else 32 for at in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order, as UTF-8; none for null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class ItemTile:
    """Some items: their numbers, the distinct terms, and where which weight stands."""

    items: np.ndarray
    terms: np.ndarray
    rows: np.ndarray
    columns: np.ndarray
    weights: np.ndarray


def weight(documents: int, holding: int) -> int:
    """The weight of a term that so many of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def item_tiles(items: list[tuple[int, np.ndarray]], weights: np.ndarray) -> list[ItemTile]:
    """Tiles of items (``number, sorted term ids``), each with the terms of its own items."""
    tiles = []
    for first in range(0, len(items), ITEM_TILE):
        part = items[first : first + ITEM_TILE]
        lengths = [len(terms) for _, terms in part]
        flat = np.concatenate([terms for _, terms in part])
        terms, columns = np.unique(flat, return_inverse=True)
        rows = np.repeat(np.arange(len(part)), lengths)
        tiles.append(ItemTile(np.array([n for n, _ in part], np.int64), terms, rows, columns, weights[flat]))
    return tiles


def tile_scores(tile: ItemTile, place: np.ndarray, terms: np.ndarray, owners: np.ndarray, impacts: np.ndarray, count: int) -> np.ndarray:
    """Scores, items x documents, of a tile of ``count`` documents.

    The documents' cells are ``terms, owners, impacts``; ``place`` is scratch space over the
    vocabulary that holds -1 everywhere.
    """
    place[tile.terms] = np.arange(len(tile.terms))
    column = place[terms]
    place[tile.terms] = -1
    total = np.zeros((len(tile.items), count), np.int64)
    heaviest = max(1, int(tile.weights.max(initial=0)))
    width = max(1, min(TERM_TILE, (EXACT - 1) // (heaviest * MOST_IMPACT)))
    for first in range(0, len(tile.terms), width):
        last = min(first + width, len(tile.terms))
        inside = np.flatnonzero((column >= first) & (column < last))
        if not len(inside):
            continue
        impact = np.zeros((last - first, count))
        impact[column[inside] - first, owners[inside]] = impacts[inside]
        own = np.flatnonzero((tile.columns >= first) & (tile.columns < last))
        weights = np.zeros((len(tile.items), last - first))
        weights[tile.rows[own], tile.columns[own] - first] = tile.weights[own]
        total += (weights @ impact).astype(np.int64)
    return total


class Best:
    """The best documents of one item so far: by falling score, then by id with nulls last."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    def floor(self) -> int:
        """What a document must have at least, equal scores included."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (
            np.concatenate(both) for both in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls))
        )
        order = np.lexsort((ids, nulls, -scores))[: self.top]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


def count_terms(documents: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document with a term; terms are those of the vocabulary."""

    def each(got: dict[str, list]) -> dict[str, list]:
        known = vocabulary.value.get
        made: dict[str, list] = {"doc_id": [], "n": [], "terms": [], "counts": []}
        for doc, text in zip(got["doc_id"], got["text"]):
            found = terms_of(text)
            if found:
                held = Counter(map(known, found))
                held.pop(None, None)
                made["doc_id"].append(doc)
                made["n"].append(len(found))
                made["terms"].append(list(held))
                made["counts"].append(list(held.values()))
        return made

    return map_batches(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        "doc_id long, n long, terms array<int>, counts array<long>",
        each,
    )


def best_of_tasks(counted: DataFrame, tiles, size: int, documents: int, total: int, top: int) -> DataFrame:
    """``item, doc_id, score``: the best documents of every item in each task."""
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(size, -1, np.int64)
        best = {int(item): Best(top) for tile in tiles.value for item in tile.items}
        for batch in batches:
            for first in range(0, batch.num_rows, DOCUMENT_TILE):
                part = batch.slice(first, DOCUMENT_TILE)
                ids, lengths, terms, counts = part.columns
                nulls = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                held = np.diff(terms.offsets.to_numpy())
                terms, counts = terms.flatten().to_numpy(), counts.flatten().to_numpy()
                # Python's integers: a product of three counts may pass 64 bits.
                m = np.array([50 + (50 * n * documents) // total for n in lengths.to_pylist()], np.int64)
                owners = np.repeat(np.arange(part.num_rows), held)
                impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * m[owners])
                for tile in tiles.value:
                    scores = tile_scores(tile, place, terms, owners, impacts, part.num_rows)
                    floors = np.array([best[int(item)].floor() for item in tile.items])
                    good = scores >= floors[:, None]
                    for row in np.flatnonzero(good.any(axis=1)):
                        at = np.flatnonzero(good[row])
                        best[int(tile.items[row])].add(scores[row, at], ids[at], nulls[at])
        for item, found in best.items():
            if len(found.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found.scores), item, np.int64)),
                        pa.array(found.ids, mask=found.nulls),
                        pa.array(found.scores),
                    ],
                    schema=schema,
                )

    return map_arrow(counted, run, "item long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, top: int = TOP, vocabulary_bytes: int = VOCABULARY_BYTES) -> DataFrame:
    """The ``top`` documents of each item with a score above 0: ``item_id, rank, doc_id, score``.

    ``documents`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other
    columns are left out. Null texts have no terms: such documents are not counted, such items
    have no rows. Repeated documents are documents of their own. Rows of ``items`` that are equal
    are one item; different texts with one id are ranked each by itself under that id. Equal
    scores go by ascending id, a null id last. Empty tables give an empty result.
    """
    spark = documents.sparkSession
    schema = f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id long, score long"

    def of_items(got: dict[str, list]) -> dict[str, list]:
        terms = [sorted(set(terms_of(text))) for text in got["text"]]
        return {"item_id": got["item_id"], "terms": terms, "bytes": [sum(map(len, found)) for found in terms]}

    asked = map_batches(
        items.select("item_id", "text").distinct(), f"item_id {dict(items.dtypes)['item_id']}, terms array<binary>, bytes long", of_items
    )
    # Written once, so that the numbers stay what they are.
    asked = stage(asked.filter("bytes > 0").withColumn("item", F.monotonically_increasing_id()), "items")
    size = asked.agg(F.sum("bytes").alias("bytes")).first()["bytes"]
    if not size:
        return spark.createDataFrame([], schema)
    groups = math.ceil(size / vocabulary_bytes)
    found = None
    for group in range(groups):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == group)
        part = _search_group(documents, mine, top)
        if part is not None:
            found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], schema)
    # Task by task, then over all: no step has more rows of an item than tasks it merges allow.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = found.withColumn("part", F.spark_partition_id() % MERGES).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    ).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search_group(documents: DataFrame, asked: DataFrame, top: int) -> DataFrame | None:
    """Winners of the tasks for items whose terms fit the bound; None where there are none."""
    spark = documents.sparkSession
    items = [(row["item"], [bytes(term) for term in row["terms"]]) for row in asked.select("item", "terms").collect()]
    if not items:
        return None
    items.sort()
    terms = sorted({term for _, found in items for term in found})
    known = {term: at for at, term in enumerate(terms)}
    counted = stage(count_terms(documents, spark.sparkContext.broadcast(known)), "term-counts")
    sums = counted.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    if not sums["documents"]:
        return None
    holding = np.zeros(len(terms), np.int64)
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("many")).toArrow()
    holding[held["term"].to_numpy()] = held["many"].to_numpy()
    weights = np.array([weight(sums["documents"], int(many)) for many in holding], np.int64)
    tiles = item_tiles([(item, np.array([known[term] for term in found], np.int64)) for item, found in items], weights)
    best = best_of_tasks(counted, spark.sparkContext.broadcast(tiles), len(terms), sums["documents"], sums["total"], top)
    winners = stage(best, "winners")
    discard(counted)
    return winners
