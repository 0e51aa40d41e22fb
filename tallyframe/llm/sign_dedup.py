"""Near-duplicate vectors: sign hashing, exact cosines, connected components.

Equal vectors of one label are one class. A class is signed by the sides of fixed random
hyperplanes on which it lies; the first bits, in runs, are its codes in several tables, and
classes of one label with one code in a table share a bucket. A pair belongs to the first
table whose code it shares, and is looked at only there.

Buckets are looked at twice. First only the signs travel: a pair whose signs differ in too
many places cannot be near enough, and what has no partner left goes. Then the vectors of the
others are fetched, and cosines are computed in double precision. A bucket of many classes is
dealt over parts by hash, and every two parts meet in a task of their own. What leaves a task
is one row per class: how many vectors it is near to, and the smallest class it is joined
with there; pairs are not written.

Codes have more bits where a label has more vectors, and there are as many tables as keep the
probability that a pair at cosine 0.93 shares no code below ``MISS``. Nearer pairs are missed
far more rarely. No bucket, partner or candidate is left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import discard, map_arrow, map_batches, stage
from tallyframe.llm.components import components
from tallyframe.llm.neighbours import norms_of, valid

COSINE = 0.93
#: The probability with which a pair just near enough may share no bucket.
MISS = 0.001
#: Signs of a vector; pairs are compared by all of them before their vectors are fetched.
SIGNS = 256
#: Standard deviations that signs may differ more than a pair at the limit does on average.
SLACK = 6.0
#: Classes of a bucket that chance alone puts there, about.
CHANCE = 64
#: Classes of one part of a bucket.
PART = 512
SEED = 1701

BUCKET = ["label", "place", "code", "low", "high"]


def code_bits(most: int) -> int:
    """Bits of a code where a label has up to ``most`` vectors."""
    return min(30, max(8, math.ceil(math.log2(max(1, most) / CHANCE))))


def tables_for(bits: int, cosine: float = COSINE, miss: float = MISS) -> int:
    """Tables that keep the probability to miss a pair at the limit below ``miss``."""
    same = 1 - math.acos(cosine) / math.pi
    return math.ceil(math.log(miss) / math.log1p(-(same**bits)))


def most_apart(signs: int, cosine: float = COSINE) -> int:
    """The most signs in which a pair near enough differs, up to a probability of 10^-9."""
    share = math.acos(cosine) / math.pi
    return min(signs, math.ceil(signs * share + SLACK * math.sqrt(signs * share * (1 - share))))


def hyperplanes(width: int, signs: int) -> np.ndarray:
    """Fixed random directions, one per column."""
    return np.random.default_rng(SEED).standard_normal((width, signs))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, whatever the size of their components."""
    top = np.abs(vectors).max(axis=1, initial=0.0)
    scaled = vectors / np.where(top > 0, top, 1.0)[:, None]
    return scaled / norms_of(scaled)[:, None]


def codes_of(bits: np.ndarray, width: int, tables: int) -> np.ndarray:
    """The codes (rows x tables) of sign bits (rows x signs)."""
    powers = 1 << np.arange(width, dtype=np.int64)
    return bits[:, : width * tables].reshape(len(bits), tables, width) @ powers


def first_shared(codes: np.ndarray, place: int, near: np.ndarray) -> np.ndarray:
    """``near`` without the pairs that share a code before table ``place``."""
    for earlier in range(place):
        if not near.any():
            break
        own = codes[:, earlier]
        near &= own[:, None] != own[None, :]
    return near


def joined(near: np.ndarray) -> np.ndarray:
    """For each row the first row that it is connected with, by a symmetric matrix of links."""
    label = np.arange(len(near))
    while True:
        low = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1, initial=len(near)))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def by_bucket(rows: DataFrame, columns: str, each: Callable, bucket: Sequence[str] = BUCKET) -> DataFrame:
    """``each`` of all rows of a bucket together; buckets are bounded, and so is what a task holds.

    ``each`` takes a table with the rows of one bucket and returns a list of arrays, or None.
    Rows are sorted by bucket inside their partition and read batch by batch.
    """
    dealt = rows.repartition(*bucket).sortWithinPartitions(*bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(name).to_numpy() for name in bucket], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            out = []
            if last is not None and (keys[0] != last).any():
                out.append(each(pa.Table.from_batches(rest)))
                rest = []
            bounds = [0, *edges.tolist(), batch.num_rows]
            for first, end in zip(bounds[:-1], bounds[1:]):
                rest.append(batch.slice(first, end - first))
                if end < batch.num_rows:
                    out.append(each(pa.Table.from_batches(rest)))
                    rest = []
            last = keys[-1]
            yield from together(out)
        if rest:
            yield from together([each(pa.Table.from_batches(rest))])

    def together(made: list) -> Iterator[pa.RecordBatch]:
        made = [part for part in made if part is not None]
        if made:
            arrays = [np.concatenate([part[at] for part in made]) for at in range(len(made[0]))]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=[c.split()[0] for c in columns.split(", ")])

    return map_arrow(dealt, run, columns)


def across(table: pa.Table) -> np.ndarray:
    """Which pairs of a bucket's rows are its own: those between its two parts, or all in one part."""
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    if low == high:
        return ~np.eye(table.num_rows, dtype=bool)
    side = table["part"].to_numpy() == low
    return side[:, None] != side[None, :]


def dealt_in_parts(rows: DataFrame, size: int) -> DataFrame:
    """Buckets of two or more rows, with each row once for every two parts that it is in."""
    counts = rows.groupBy("label", "place", "code").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    parts = F.ceil(F.col("many") / size).cast("int")
    own = rows.join(counts, ["label", "place", "code"]).withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    )
    return own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "label", "place", "code", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "class", "signs",
    )


def near_vectors(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS, part: int = PART) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``.

    ``vectors`` has ``vec_id, embedding, label``; other columns are left out. Two vectors link when
    their labels are equal and not null and their cosine, in double precision, is at least
    ``cosine``. ``n_links`` counts other vectors that are linked directly, ``component_id`` is the
    smallest id reachable by links, and a row is kept if that is its own. Vectors that are null,
    empty, zero or hold null or non-finite components, or have no label, link with nothing;
    so do vectors of different widths. Equal rows are one vector and each gets its result. Rows
    with a null id take part; a component's id is null only if all its ids are. An empty table
    gives an empty result.
    """
    own = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("long").alias("label")
    )
    usable = F.col("label").isNotNull() & valid("vector")
    # Zeros have one sign, or equal vectors would have different names.
    vector = F.transform("vector", lambda x: x + F.lit(0.0))
    named = own.withColumn("class", F.when(usable, F.xxhash64("label", vector)))
    rows = stage(named.select("vec_id", "class"), "vector-rows")
    classes = stage(
        named.filter("class is not null").select("vec_id", "class", "label", "vector")
        .groupBy("class").agg(
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
            F.min("vec_id").alias("least"),
            (F.count_distinct("vec_id") + F.max(F.col("vec_id").isNull().cast("int"))).alias("copies"),
        ),
        "vector-classes",
    )
    found = near_classes(classes, cosine, miss, part)
    result = rows.join(found, "class", "left")
    component = F.when(F.col("component").isNotNull(), F.col("component.least")).otherwise(F.col("vec_id"))
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def near_classes(classes: DataFrame, cosine: float, miss: float, part: int) -> DataFrame:
    """``class, n_links, component`` of classes with copies or links; the component holds its least id."""
    sizes = classes.groupBy("label", F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("many"))
    # One number per width of vectors; a table has one or a few.
    widths = {row["width"]: row["most"] for row in sizes.groupBy("width").agg(F.max("many").alias("most")).collect()}
    copies = classes.filter("copies > 1").select("class", (F.col("copies") - 1).alias("n_links"), F.col("class").alias("vertex"))
    hits = None
    for width, most in sorted(widths.items()):
        mine = classes.filter(F.size("vector") == width)
        made = stage(near_in_width(mine, width, most, cosine, miss, part), "near-vectors")
        hits = made if hits is None else hits.unionAll(made)
    if hits is None:
        return classes.select("class", F.lit(0).cast("long").alias("n_links"), F.struct("least").alias("component"))
    labels = components(hits.select(F.col("class").alias("a"), F.col("root").alias("b")).filter("a <> b").distinct())
    links = hits.groupBy("class").agg(F.sum("found").alias("found"))
    # Classes that have neither copies nor links need no row.
    linked = classes.select("class", "least", "copies").join(links, "class", "left").filter("copies > 1 or found is not null")
    placed = linked.join(labels.withColumnRenamed("vertex", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    lowest = placed.groupBy("label").agg(F.struct(F.min("least").alias("least")).alias("component"))
    return placed.join(lowest, "label").select(
        "class", (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("n_links"), "component"
    )


def near_in_width(classes: DataFrame, width: int, most: int, cosine: float, miss: float, part: int) -> DataFrame:
    """``class, found, root`` for classes of one width: vectors near to it, and the smallest class joined with it."""
    bits = code_bits(most)
    tables = tables_for(bits, cosine, miss)
    signs = max(SIGNS, -(-bits * tables // 64) * 64)
    apart = most_apart(signs, cosine)

    def signed(got: dict[str, list]) -> dict[str, list]:
        planes = hyperplanes(width, signs)
        sides = unit(np.array(got["vector"], np.float64).reshape(-1, width)) @ planes >= 0
        packed = np.packbits(sides, axis=1)
        return {"class": got["class"], "label": got["label"], "codes": codes_of(sides, bits, tables).tolist(), "signs": [row.tobytes() for row in packed]}

    marked = map_batches(classes.select("class", "label", "vector"), "class long, label long, codes array<long>, signs binary", signed)
    # Each class once in every table.
    spread = stage(marked.select("class", "label", F.posexplode("codes").alias("place", "code"), "signs"), "sign-codes")

    def opened(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        packed = np.frombuffer(b"".join(table["signs"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
        sides = np.unpackbits(packed, axis=1)[:, :signs]
        return table["class"].to_numpy(), sides, codes_of(sides, bits, tables)

    def likely(table: pa.Table) -> list[np.ndarray] | None:
        """Rows with a partner whose signs are near enough."""
        names, sides, codes = opened(table)
        turned = sides.astype(np.float32) * 2 - 1
        near = (turned @ turned.T >= signs - 2 * apart) & across(table)
        at = np.flatnonzero(first_shared(codes, table["place"][0].as_py(), near).any(axis=1))
        if not len(at):
            return None
        keys = [np.full(len(at), table[name][0].as_py(), np.int64) for name in BUCKET]
        kept = np.array(table["signs"].to_pylist(), object)[at]
        return [*keys, table["part"].to_numpy()[at].astype(np.int64), names[at], kept]

    keys = ", ".join(f"{name} long" for name in BUCKET)
    whole = dealt_in_parts(spread, part)
    members = stage(by_bucket(whole, f"{keys}, part long, class long, signs binary", likely), "likely-vectors")
    discard(spread)
    filled = members.join(classes.select("class", "vector", "copies"), "class")

    def checked(table: pa.Table) -> list[np.ndarray] | None:
        """Per row, how many vectors are near enough, and the smallest class that it is joined with."""
        names, _, codes = opened(table)
        vectors = unit(np.array(table["vector"].to_pylist(), np.float64))
        near = first_shared(codes, table["place"][0].as_py(), (vectors @ vectors.T >= cosine) & across(table))
        at = np.flatnonzero(near.any(axis=1))
        if not len(at):
            return None
        order = np.argsort(names)
        root = np.empty(len(names), np.int64)
        root[order] = names[order][joined(near[np.ix_(order, order)])]
        return [names[at], (near @ table["copies"].to_numpy())[at], root[at]]

    return by_bucket(filled, "class long, found long, root long", checked)
