"""Removal of long repeated passages, found by recompression.

A document's words are named, and a few rounds shorten the sequence of names: runs of one
name become one name, then pairs of a "left" and a "right" name become one, where a bit of
the name says which it is. A new name is a hash of the parts' names, so every executor
gives equal parts the same name without asking anyone: naming is global. What
a window's words decide by themselves, whatever stands around it, is its interior; equal
windows have the same interior, down to the names.

Each window picks the longest name of its interior (ties by the name). Equal windows pick
the same one, so a window that repeats has picked a name that was picked at least twice.
Only windows whose pick is shared are looked at again: all their words are hashed, and
hashes that occur twice are repeats. Windows without an interior (long runs of few
words) are picked by their own hash.

Work is on distinct texts. A text that occurs more than once repeats as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import discard, map_batches, stage, without
from tallyframe.llm.hashing import STEP, gathered, mix, signed, window_names, word_names

WINDOW = 35
ROUNDS = 3
#: High bits of a pick hold the words its name stands for; the rest is the name.
LENGTH_BITS = 6


def name_runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names after runs have become one, where each begins, and for each old position its new one."""
    fresh = np.empty(len(names), bool)
    fresh[0] = True
    np.not_equal(names[1:], names[:-1], out=fresh[1:])
    starts = np.flatnonzero(fresh)
    made = names[starts]
    lengths = np.diff(starts, append=len(names))
    long = np.flatnonzero(lengths > 1)
    made[long] = mix(made[long] * STEP + mix(lengths[long].astype(np.uint64)))
    return made, starts, np.cumsum(fresh, dtype=np.int32) - np.int32(1)


def name_pairs(names: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``name_runs`` for left-right pairs, and which old names are left ones."""
    left = (((names ^ (names >> np.uint64(29))) * (np.uint64(2 * turn + 1) * STEP)) >> np.uint64(63)).astype(bool)
    single = np.ones(len(names), bool)
    np.logical_not(left[:-1] & ~left[1:], out=single[1:])
    starts = np.flatnonzero(single)
    made = names[starts]
    joined = np.flatnonzero(np.diff(starts, append=len(names)) > 1)
    made[joined] = mix(mix(made[joined] + STEP) * STEP + names[starts[joined] + 1])
    return made, starts, np.cumsum(single, dtype=np.int32) - np.int32(1), left


def picks(names: np.ndarray, size: int = WINDOW, rounds: int = ROUNDS) -> np.ndarray:
    """What each window picks; 64-bit values, one per start of a window.

    ``low`` and ``high`` are the first and last name of each window's interior. A run at
    either end may go on outside, so the names there are given up. Of the
    rest, a first name that could be the right part of a pair, and a last one that could
    be the left part, are given up as well.
    """
    many = len(names) - size + 1
    low = np.arange(many, dtype=np.int32)
    high = low + np.int32(size - 1)
    gone = np.zeros(many, bool)
    begins, end = np.arange(len(names)), len(names)

    def close() -> None:
        """Give up interiors without a name; their bounds go where they do no harm."""
        np.logical_or(gone, low > high, out=gone)
        np.putmask(low, gone, 0)
        np.putmask(high, gone, 0)

    with np.errstate(over="ignore"):
        for turn in range(rounds):
            names, starts, at = name_runs(names)
            begins = begins[starts]
            low, high = at[low] + np.int32(1), at[high] - np.int32(1)
            close()
            made, starts, at, left = name_pairs(names, turn)
            begins = begins[starts]
            low += ~left[low]
            high -= left[high]
            close()
            low, high, names = at[low], at[high], made
        lengths = np.minimum(np.diff(begins, append=end), (1 << LENGTH_BITS) - 1).astype(np.uint64)
        ranked = (lengths << np.uint64(64 - LENGTH_BITS)) | (names >> np.uint64(LENGTH_BITS))
    high[gone] = -1
    return _range_max(ranked, low, high)


def _range_max(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest value from ``low`` to ``high``; 0 where the range is empty."""
    spans = high - low + 1
    out = np.zeros(len(low), np.uint64)
    widest, power, table = int(spans.max(initial=0)), 0, values
    while 1 << power <= widest:
        now = np.flatnonzero((spans >= 1 << power) & (spans < 2 << power))
        out[now] = np.maximum(table[low[now]], table[high[now] - ((1 << power) - 1)])
        if 2 << power <= widest:
            table = np.maximum(table[: len(table) - (1 << power)], table[1 << power :])
        power += 1
    return out


def windows_of(texts: list[str | None], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every window: the number of its text, its start there, its pick and its hash.

    Texts are strung together: what a window picks does not depend on what stands around it,
    and windows that reach into the next text are left out.
    """
    for number, group in gathered(texts):
        names, lengths = word_names(group)
        if len(names) < size:
            continue
        found, hashed = picks(names, size), window_names(names, size)
        found = np.where(found == 0, hashed, found)
        owner = np.repeat(np.arange(len(group)), lengths)[: len(found)]
        ends = np.cumsum(lengths)
        inside = np.flatnonzero(ends[owner] - np.arange(len(found)) >= size)
        if len(inside):
            owner = owner[inside]
            yield owner + number, inside - (ends - lengths)[owner], found[inside], hashed[inside]


def kept_words(text: str | None, repeats: np.ndarray, size: int) -> tuple[list[bytes], int]:
    """The words that no window starting at ``repeats`` covers, and how many there were."""
    words = [] if text is None else text.encode("utf-8").split()
    if not len(repeats):
        return words, len(words)
    # Each start opens a window and closes it ``size`` words later.
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, repeats, 1)
    np.add.at(depth, repeats + size, -1)
    covered = np.cumsum(depth[:-1]) > 0
    return [words[at] for at in np.flatnonzero(~covered)], len(words)


def starts_of(runs: list[int]) -> np.ndarray:
    """The starts that runs (first times 2^32 plus last) stand for."""
    if not runs:
        return np.zeros(0, np.int64)
    packed = np.array(runs, np.int64)
    firsts, lasts = packed >> 32, packed & 0xFFFFFFFF
    return np.unique(np.concatenate([np.arange(first, last + 1) for first, last in zip(firsts.tolist(), lasts.tolist())]))


def addressed(documents: DataFrame) -> DataFrame:
    """``doc_id, address`` (128-bit hash of the text), ``key`` (64 bits of it) and ``text``."""
    address = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return documents.select("doc_id", address.alias("address"), F.xxhash64(address).alias("key"), "text")


def repeated_windows(documents: DataFrame, size: int = WINDOW) -> DataFrame:
    """``address, copies, runs`` of every text with repeated windows.

    ``runs`` are first and last starts (packed in a long) of windows whose words also start in
    another text, or twice in this one; a text with ``copies`` above 1 repeats as a whole.
    Steps are written to the shared folder one by one, so that the shuffle files of one can
    go before the next makes its own.
    """
    rows = addressed(documents)
    # One document stands for its text. Sums per text are begun in each task.
    texts = stage(
        rows.groupBy("address").agg(
            F.min("key").alias("key"), F.min(F.struct("doc_id")).alias("one"), F.count(F.lit(1)).alias("copies")
        ).select("address", "key", "one.doc_id", "copies"),
        "texts",
    )

    def fresh(got: dict[str, list]) -> tuple[list[int], list[str | None]]:
        """Keys and texts, each text once."""
        once = dict(zip(got["key"], got["text"]))
        return list(once), list(once.values())

    def picked(got: dict[str, list]) -> dict[str, list]:
        keys, bodies = fresh(got)
        made: dict[str, list] = {"key": [], "pick": [], "inside": []}
        for owner, _, found, hashed in windows_of(bodies, size):
            # Stretches of windows with one pick give it once.
            change = np.flatnonzero(
                np.concatenate(([True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])))
            )
            # Picks of windows that are equal to another one here are shared already.
            ordered = np.sort(hashed)
            twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
            shared = np.unique(found[np.isin(hashed, twice)])
            made["key"] += [keys[at] for at in owner[change].tolist()]
            made["pick"] += signed(found[change]).tolist()
            made["inside"] += np.isin(found[change], shared).tolist()
        return made

    found = stage(map_batches(rows.select("key", "text"), "key long, pick long, inside boolean", picked), "picks")
    # Copies of a text give the same rows; its key tells them apart from other texts.
    shared = (
        found.groupBy("pick")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"), F.max("inside").alias("inside"))
        .filter((F.col("first") != F.col("last")) | F.col("inside"))
        .select("pick")
    )
    wanted = found.select("key", "pick").join(shared, "pick").groupBy("key").agg(F.collect_set("pick").alias("wanted"))
    todo = stage(texts.join(wanted, "key").select("key", "doc_id", "wanted"), "todo")
    discard(found)
    again = rows.alias("r").join(
        todo.hint("shuffle_hash").alias("t"),
        (F.col("r.key") == F.col("t.key")) & F.col("r.doc_id").eqNullSafe(F.col("t.doc_id")),
    ).select("r.key", "r.text", "t.wanted")

    def hashed(got: dict[str, list]) -> dict[str, list]:
        keys, bodies = fresh(got)
        sought = dict(zip(got["key"], got["wanted"]))
        made: dict[str, list] = {"name": [], "key": [], "place": []}
        for owner, start, chosen, names in windows_of(bodies, size):
            wish = np.unique(np.concatenate([np.array(sought[keys[at]], np.int64) for at in np.unique(owner).tolist()]))
            here = np.flatnonzero(np.isin(chosen, wish.view(np.uint64)))
            owner, start, names = owner[here], start[here], names[here]
            # Repeats among these texts are settled here; each name leaves once.
            values, first, inverse, many = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
            sure = many[inverse] > 1
            made["name"] += signed(values).tolist()
            made["key"] += [keys[at] for at in owner[first].tolist()]
            made["place"] += (2 * start[first] + (many > 1)).tolist()
            owner, start = owner[sure], start[sure]
            breaks = np.flatnonzero((owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1))
            firsts, lasts = np.append(0, breaks + 1), np.append(breaks, len(owner) - 1)
            if len(owner):
                made["name"] += [None] * len(firsts)
                made["key"] += [keys[at] for at in owner[firsts].tolist()]
                made["place"] += ((start[firsts] << 32) | start[lasts]).tolist()
        return made

    # Rows with a name: place is twice the start, plus 1 if the name is repeated where it comes
    # from. Rows without: place is a run of starts that are settled.
    names = stage(map_batches(again, "name long, key long, place long", hashed, rows=10_000), "names")
    discard(todo)
    group = Window.partitionBy(F.coalesce("name", F.xxhash64("key", "place")))
    told = F.max(F.col("name").isNotNull() & (F.col("place") % 2 == 1)).over(group)
    counted = names.withColumn("many", F.count("name").over(group)).withColumn("told", told)
    start = F.shiftright("place", 1)
    runs = (
        counted.filter(F.col("name").isNull() | (F.col("many") > 1) | F.col("told"))
        .select("key", F.when(F.col("name").isNull(), F.col("place")).otherwise(F.shiftleft(start, 32) + start).alias("run"))
        .repartition("key")
        .groupBy("key")
        .agg(F.collect_list("run").alias("runs"))
    )
    repeats = stage(
        texts.join(runs, "key", "left")
        .filter((F.col("copies") > 1) | F.col("runs").isNotNull())
        .select("address", "copies", "runs"),
        "repeats",
    )
    discard(names, texts)
    return repeats


def dedup(documents: DataFrame, size: int = WINDOW) -> DataFrame:
    """``documents`` with ``n_words, n_removed`` and ``kept``, the words left joined by one blank.

    Removes every word covered by a window of ``size`` words that also starts anywhere else,
    in the same text too. All other columns are kept as they are. Null and empty texts have
    no words and an empty ``kept``. Texts shorter than a window lose nothing. Repeated rows
    are copies of one another. An empty table gives an empty result. Input columns named as
    one of the new ones are replaced.
    """
    documents = without(documents, "n_words", "n_removed", "kept")
    repeats = repeated_windows(documents, size).select(
        F.col("address").alias("__address"), F.col("copies").alias("__copies"), F.col("runs").alias("__runs")
    )
    names = documents.columns
    address = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    # Without their texts first: a text that a third of all documents share is a short row here.
    marks = (
        documents.select(F.col("doc_id").alias("__id"), address.alias("__address"))
        .distinct()
        .join(repeats, "__address")
        .select("__id", "__address", "__copies", F.when(F.col("__copies") == 1, F.col("__runs")).alias("__runs"))
    )
    own = documents.withColumn("__own", address)
    joined = own.join(
        marks.hint("shuffle_hash"),
        (own["__own"] == marks["__address"]) & own["doc_id"].eqNullSafe(marks["__id"]),
        "left",
    ).select(*[f"`{name}`" for name in names], "__copies", "__runs")

    def each(got: dict[str, list]) -> dict[str, list]:
        made: dict[str, list] = {"n_words": [], "n_removed": [], "kept": []}
        for text, copies, runs in zip(got["text"], got["__copies"], got["__runs"]):
            if copies is not None and copies > 1:
                words = [] if text is None else text.encode("utf-8").split()
                total = len(words)
                left = [] if total >= size else words
            else:
                left, total = kept_words(text, starts_of(runs or []), size)
            made["n_words"].append(total)
            made["n_removed"].append(total - len(left))
            made["kept"].append(b" ".join(left).decode("utf-8"))
        return {name: got[name] for name in names} | made

    from pyspark.sql import types as T

    schema = T.StructType(
        documents.schema.fields
        + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    )
    return map_batches(joined, schema, each)
