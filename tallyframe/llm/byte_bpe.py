"""Byte-level BPE over distinct words, merged by Spark higher-order functions.

A text is cut into words by the splitting pattern. Merges depend on a word alone, so words are
counted over all texts, and each frequent word that is no token itself is merged once: its
bytes, as an array of ids, are folded with ``aggregate``, which joins the adjacent pair of
lowest rank until no pair has a rank. The ranks are a literal of the plan, one flat array of
whole numbers in which a pair stands at one of two places.

The merged words, as many as fit a stated number, go to all tasks as one Arrow table. A task
looks up the distinct words of a batch there. Words that are not in it, nearly all of them
such as occur once or twice, are merged in the task by the same rule: short ones side by
side, a step of all of them at once, and long ones on a heap, whose steps grow with the
length of a word and not with its square. So nothing but the bounded table is broadcast, and
no text is shuffled.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import map_arrow, stage
from tallyframe.llm.vocabulary import Vocabulary, packed

#: Most words in the broadcast table, and the most bytes one of them may have.
TABLE_WORDS = 400_000
TABLE_BYTES = 48
#: Parts of texts whose ids a worker keeps.
MEMO_PARTS = 150_000
#: Bits of an id in a pair's number.
ID_BITS = 20
#: Fixed multipliers of the two places at which a pair may stand.
PLACES = ((1_000_003, 1), (7_919, 15_485_863))
NO_RANK = 2_147_483_647
#: Longer words are merged on a heap.
SHORT = 64


def pair_slots(ranks: dict[bytes, int]) -> list[int]:
    """Every pair of tokens that make a token, at one of its two places; 0 where there is none.

    An entry is the pair's number times 2^20 plus the id of the token that the two make.
    """
    if max(ranks.values(), default=0) >= 1 << ID_BITS:
        raise ValueError(f"token ids of more than {ID_BITS} bits")
    pairs = [
        (ranks[token[:at]], ranks[token[at:]], rank)
        for token, rank in ranks.items()
        for at in range(1, len(token))
        if token[:at] in ranks and token[at:] in ranks
    ]
    size = 5 * len(pairs) // 2 + 101
    while True:
        slots = _placed(pairs, size)
        if slots is not None:
            return slots
        size += size // 7 + 2


def _placed(pairs: list[tuple[int, int, int]], size: int) -> list[int] | None:
    """The pairs dealt over slots, each pushing out another that has a second place; None if that fails."""
    held = [-1] * size
    for number in range(len(pairs)):
        at = _place(pairs[number][:2], 0, size)
        for _ in range(200):
            number, held[at] = held[at], number
            if number < 0:
                break
            one, two = (_place(pairs[number][:2], which, size) for which in (0, 1))
            at = two if at == one else one
        else:
            return None
    numbered = [(((left << ID_BITS) | right) << ID_BITS) | rank for left, right, rank in pairs]
    # A slot is empty as 0: the pair (0, 0) that makes 0 does not exist.
    return [0 if number < 0 else numbered[number] for number in held]


def _place(pair: tuple[int, int], which: int, size: int) -> int:
    left, right = PLACES[which]
    return (pair[0] * left + pair[1] * right) % size


def fold_merges(word: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a word (a string column) that is no token itself, as an array of ints.

    The state of the fold is the ids of the word's pieces, the rank of each adjacent pair and
    the lowest of these; a pair without a rank has the largest int. A step joins the first
    pair of lowest rank, whose rank is the id of the joined piece, and looks up the two pairs
    beside it.
    """
    ranks = vocabulary.table()
    slots = pair_slots(ranks)
    table = F.split(F.lit(",".join(map(str, slots))), ",").cast("array<bigint>")
    single = F.from_json(F.lit(json.dumps([ranks[bytes([byte])] for byte in range(256)])), "array<int>")
    none, empty, no_pairs = F.lit(NO_RANK), F.array().cast("array<int>"), F.array().cast("array<bigint>")

    def number(left: Column, right: Column) -> Column:
        return left.cast("bigint") * (1 << ID_BITS) + right.cast("bigint")

    def ranks_of(pairs: Column) -> Column:
        """The ranks of numbered pairs. The table stands here once, since each mention of it is a copy in the plan."""
        low_bits = F.lit((1 << ID_BITS) - 1)

        def rank(pair: Column) -> Column:
            left, right = F.shiftright(pair, ID_BITS), pair.bitwiseAND(low_bits)
            places = F.array(*[((left * one + right * two) % len(slots) + 1).cast("int") for one, two in PLACES])
            entries = F.transform(places, lambda place: F.element_at(table, place))
            own = F.transform(
                entries, lambda entry: F.when(F.shiftright(entry, ID_BITS) == pair, entry.bitwiseAND(low_bits).cast("int"))
            )
            return F.coalesce(F.array_max(own), none)

        return F.transform(pairs, rank)

    def state(pieces: Column, pairs: Column) -> Column:
        low = F.coalesce(F.array_min(pairs), none)
        return F.struct(pieces.alias("pieces"), pairs.alias("pairs"), low.alias("low"))

    whole = F.hex(word.cast("binary"))
    count = (F.length(whole) / 2).cast("int")
    bytes_of = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda at: F.element_at(single, F.conv(F.substring(whole, at * 2 + 1, 2), 16, 10).cast("int") + 1),
    )

    def pair_ranks(pieces: Column) -> Column:
        return ranks_of(
            F.transform(F.slice(pieces, 2, F.size(pieces)), lambda right, at: number(F.element_at(pieces, at + 1), right))
        )

    def step(now: Column, _: Column) -> Column:
        pieces, pairs, low = now["pieces"], now["pairs"], now["low"]

        def at_place(at: Column) -> Column:
            before = F.when(
                at > 1, F.array(number(F.element_at(pieces, F.greatest(at - 1, F.lit(1))), low))
            ).otherwise(no_pairs)
            after = F.when(
                at < F.size(pairs), F.array(number(low, F.element_at(pieces, F.least(at + 2, F.size(pieces)))))
            ).otherwise(no_pairs)
            left = F.concat(F.slice(pieces, F.lit(1), at - 1), F.array(low), F.slice(pieces, at + 2, F.size(pieces)))
            ranked = F.concat(
                F.slice(pairs, F.lit(1), F.greatest(at - 2, F.lit(0))), ranks_of(F.concat(before, after)), F.slice(pairs, at + 2, F.size(pairs))
            )
            return _with(ranked, lambda made: state(left, made))

        # Once no pair has a rank, the steps that are left do nothing.
        return F.when(low == none, now).otherwise(_with(F.array_position(pairs, low).cast("int"), at_place))

    start = _with(bytes_of, lambda pieces: _with(pair_ranks(pieces), lambda pairs: state(pieces, pairs)))
    merged = F.aggregate(F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))), start, step, lambda end: end["pieces"])
    return F.when(count == 0, empty).otherwise(merged)


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word by the same rule: the first of the pairs of lowest rank, again and again."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return merge_short(word, ranks) if len(word) <= SHORT else merge_long(word, ranks)


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """By looking through all pairs at every step, which is fastest for a few."""
    get = ranks.get
    pieces = [word[at : at + 1] for at in range(len(word))]
    pairs = [get(word[at : at + 2], NO_RANK) for at in range(len(word) - 1)]
    while pairs:
        low = min(pairs)
        if low == NO_RANK:
            break
        at = pairs.index(low)
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = get(pieces[at] + pieces[at + 1], NO_RANK)
        if at:
            pairs[at - 1] = get(pieces[at - 1] + pieces[at], NO_RANK)
    return [ranks[piece] for piece in pieces]


def merge_together(words: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """The packed ids of words that are no tokens, merged side by side.

    A step joins in every word the first of its pairs of lowest rank; words without such a pair are
    done and leave. Long words, and all words where not every byte is a token, are merged by themselves.
    """
    ranks = tokens_of(vocabulary)
    singles, keys, made = _pair_arrays(vocabulary)
    alone = [at for at, word in enumerate(words) if singles is None or len(word) > SHORT]
    own = {at: packed(merge_bytes(words[at], ranks)) for at in alone}
    short = [word for at, word in enumerate(words) if at not in own] if own else words
    sizes = np.fromiter(map(len, short), np.int64, len(short))
    if not sizes.sum():
        return [own.get(at, b"") for at in range(len(words))]

    def ranks_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = (left << 32) | right
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        return np.where(keys[at] == pairs, made[at], NO_RANK)

    pieces = singles[np.frombuffer(b"".join(short), np.uint8)]
    word = np.repeat(np.arange(len(short)), sizes)
    # The rank of each piece with the next one; the last piece of a word has none.
    pairs = np.full(len(pieces), NO_RANK)
    inner = np.flatnonzero(word[1:] == word[:-1])
    pairs[inner] = ranks_of(pieces[inner], pieces[inner + 1])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(pieces):
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        low = np.minimum.reduceat(pairs, starts)
        many = np.diff(np.append(starts, len(pieces)))
        lowest = np.repeat(low, many)
        if (low == NO_RANK).any():
            left = lowest != NO_RANK
            done.append((word[~left], pieces[~left]))
            pieces, word, pairs, lowest = pieces[left], word[left], pairs[left], lowest[left]
            if not len(pieces):
                break
        found = np.flatnonzero(pairs == lowest)
        first = found[np.concatenate(([True], word[found[1:]] != word[found[:-1]]))]
        pieces[first] = lowest[first]
        pairs[first] = NO_RANK
        after = first[np.minimum(first + 2, len(word) - 1) == first + 2]
        after = after[word[after + 2] == word[after]]
        pairs[after] = ranks_of(pieces[after], pieces[after + 2])
        before = first[first > 0]
        before = before[word[before - 1] == word[before]]
        pairs[before - 1] = ranks_of(pieces[before - 1], pieces[before])
        kept = np.ones(len(pieces), bool)
        kept[first + 1] = False
        pieces, word, pairs = pieces[kept], word[kept], pairs[kept]
    word, pieces = (np.concatenate(parts) for parts in zip(*done))
    ids = pieces[np.argsort(word, kind="stable")].astype("<u4").tobytes()
    ends = (4 * np.cumsum(np.bincount(word, minlength=len(short)))).tolist()
    merged = [ids[start:end] for start, end in zip([0, *ends[:-1]], ends)]
    if not own:
        return merged
    rest = iter(merged)
    return [own[at] if at in own else next(rest) for at in range(len(words))]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Pairs wait in a heap by rank and place; one that has lost a piece meanwhile is passed over."""
    size = len(word)
    #: Where the piece that starts here ends, and where the one that ends here starts.
    ends, starts = list(range(1, size + 1)), list(range(-1, size))
    waiting = []
    for at in range(size - 1):
        rank = ranks.get(word[at : at + 2])
        if rank is not None:
            waiting.append((rank, at, at + 1, at + 2))
    heapq.heapify(waiting)
    longest = _longest(ranks)
    while waiting:
        _, left, middle, end = heapq.heappop(waiting)
        if ends[left] != middle or ends[middle] != end:
            continue
        ends[left], starts[end] = end, left
        ends[middle] = 0
        if end < size and ends[end] - left <= longest:
            rank = ranks.get(word[left : ends[end]])
            if rank is not None:
                heapq.heappush(waiting, (rank, left, end, ends[end]))
        if left and end - starts[left] <= longest:
            rank = ranks.get(word[starts[left] : end])
            if rank is not None:
                heapq.heappush(waiting, (rank, starts[left], left, end))
    out, at = [], 0
    while at < size:
        out.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return out


_lengths: dict[int, tuple[dict[bytes, int], int]] = {}


def _longest(ranks: dict[bytes, int]) -> int:
    """The bytes of the longest token of a table. Tables are kept, or another one could come to stand at the same place."""
    kept = _lengths.get(id(ranks))
    if kept is None:
        if len(_lengths) >= 4:
            _lengths.clear()
        kept = _lengths[id(ranks)] = ranks, max(map(len, ranks), default=0)
    return kept[1]


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once: a lambda over an array of one."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: What a splitting pattern says where a blank and letters, or letters alone, are one word.
LETTERS_ARE_A_WORD = r" ?\p{L}+"


@lru_cache(maxsize=2)
def splitter(pattern: str):
    """A function from a part of a text to its words.

    A blank and letters are one word by most patterns; where the pattern says so, such a part,
    the usual one, is not searched.
    """
    import regex

    search = regex.compile(pattern, regex.V0).findall
    if LETTERS_ARE_A_WORD not in pattern:
        return search

    def cut(part: str) -> list[str]:
        return [part] if part[:1] == " " and part[1:].isalpha() else search(part)

    return cut


def count_words(texts: DataFrame, vocabulary) -> DataFrame:
    """``word, many`` over all texts, of words that are no tokens; counts are begun in each batch."""

    schema = pa.schema([("word", pa.string()), ("many", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, cut = tokens_of(vocabulary.value), splitter(vocabulary.value.pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 3072):
                parts, places, _ = coded_parts(batch.column(0).slice(first, 3072))
                words: Counter = Counter()
                for part, many in zip(parts, np.bincount(places, minlength=len(parts)).tolist()):
                    for word in cut(part) if many else ():
                        words[word] += many
                kept = [(word, many) for word, many in words.items() if word.encode("utf-8", "surrogatepass") not in tokens]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([word for word, _ in kept], pa.string()), pa.array([many for _, many in kept], pa.int64())], schema=schema
                )
        # The worker goes on to other tasks; what this one held is not kept for them.
        pa.default_memory_pool().release_unused()

    return map_arrow(texts.select("text"), run, "word string, many long").groupBy("word").agg(F.sum("many").alias("many"))


def coded_parts(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct parts of texts, the place of every part of every text among them, and where each text begins.

    Parts are those of ``parts_of``, but that empty ones may be among them. Texts are cut at all
    blanks, and pieces that are empty or begin with white space are put back to those before them.
    """
    split = pc.split_pattern(pc.fill_null(texts, ""), " ")
    starts = np.asarray(split.offsets, np.int64) - split.offsets[0].as_py()
    coded = split.flatten().dictionary_encode()
    pieces, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    parts = [" " + piece for piece in pieces]
    # The first piece of a text has no blank before it; every text has one.
    heads = starts[:-1]
    firsts, own = np.unique(at[heads], return_inverse=True)
    goes_on = np.array([not piece or piece[0].isspace() for piece in pieces], bool)[at]
    goes_on[heads] = False
    places = at.copy()
    places[heads] = len(parts) + own
    parts += [pieces[first] for first in firsts.tolist()]
    if not goes_on.any():
        return parts, places, starts
    kept = np.flatnonzero(~goes_on)
    ends = np.append(kept[1:], len(at))
    first_ones = np.zeros(len(at), bool)
    first_ones[heads] = True
    inserted: dict[str, int] = {}
    for which in np.flatnonzero(ends - kept > 1).tolist():
        start, end = int(kept[which]), int(ends[which])
        joined = " ".join([pieces[one] for one in at[start:end].tolist()])
        part = joined if first_ones[start] else " " + joined
        places[start] = inserted.setdefault(part, len(parts) + len(inserted))
    return parts + list(inserted), places[kept], np.concatenate(([0], np.cumsum(~goes_on)))[starts]


def joined_rows(values: pa.Array, places: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The binary ``values`` at ``places``, those of each row in one; ``starts`` says where rows begin and the last one ends."""
    taken = values.take(pa.array(places))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
    own = pa.py_buffer(np.ascontiguousarray(offsets[starts]))
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, own, taken.buffers()[2] or pa.py_buffer(b"")])


def frequent_words(spark: SparkSession, counts: DataFrame, most: int = TABLE_WORDS) -> DataFrame:
    """The words with the highest counts, all with the same count or none, at most ``most``."""
    from pyspark.sql import Window

    short = counts.filter(F.octet_length("word") <= TABLE_BYTES)
    # One row per count that occurs; far fewer than words.
    sizes = short.groupBy("many").agg(F.count(F.lit(1)).alias("words"))
    above = sizes.withColumn("total", F.sum("words").over(Window.orderBy(F.desc("many"))))
    least = above.filter(F.col("total") <= most).agg(F.min("many").alias("least")).first()["least"]
    return short.filter(F.col("many") >= F.lit(least)) if least is not None else short.limit(0)


def packed_ids(ids: Column) -> Column:
    """Ids as little-endian unsigned 32-bit integers in one binary."""
    return F.unhex(
        F.array_join(
            F.transform(
                ids,
                lambda i: F.concat(
                    *[F.lpad(F.hex(F.shiftright(i, shift).bitwiseAND(F.lit(255))), 2, "0") for shift in (0, 8, 16, 24)]
                ),
            ),
            "",
        )
    )


def encode(documents: DataFrame, vocabulary: Vocabulary, table_words: int = TABLE_WORDS, decoded: bool = False) -> DataFrame:
    """``doc_id, ids``: the ids of every text in one binary, 4 bytes each, little-endian.

    With ``decoded`` also ``body``, the ids decoded again by the same tasks. ``documents`` has
    ``doc_id`` and ``text``; other columns are left out. Null and empty texts have no ids. Rows are
    encoded one by one, so repeated ids stay. An empty table gives an empty result. A word of n
    bytes that is not in the table costs a number of steps of the order n log n, however long it is.
    """
    spark = documents.sparkSession
    given = spark.sparkContext.broadcast(vocabulary)
    counts = stage(count_words(documents, given), "word-counts")
    # Merged by all tasks and written before the driver reads it: a table of bounded size.
    chosen = frequent_words(spark, counts, table_words).repartition("word")
    folded = chosen.select("word", packed_ids(fold_merges(F.col("word"), vocabulary)).alias("ids"))
    with short_plans(spark):
        table = stage(folded, "merged-words")
    shared = spark.sparkContext.broadcast(_as_bytes(table.toArrow()))
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(given.value, _as_table(shared.value))
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                ids = encoder.encode(part.column("text"))
                columns = {"doc_id": part.column("doc_id"), "ids": ids.cast(pa.binary())}
                if decoded:
                    columns["body"] = decoded_rows(ids, given.value).cast(pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind}, ids binary" + ", body binary" * decoded
    return map_arrow(documents.select("doc_id", "text"), run, schema)


class Encoder:
    """Ids of texts in a task, with a memo of parts made up of frequent words."""

    def __init__(self, vocabulary: Vocabulary, merged: pa.Table):
        self.vocabulary, self.cut, self.merged = vocabulary, splitter(vocabulary.pattern), merged
        self.memo: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> pa.Array:
        """The packed ids of each text."""
        memo = self.memo
        if len(memo) > MEMO_PARTS:
            memo.clear()
        parts, places, starts = coded_parts(texts)
        found = [memo.get(part) for part in parts]
        cuts = {part: self.cut(part) for part, ids in zip(parts, found) if ids is None}
        known, rare = word_ids({word for words in cuts.values() for word in words}, self.vocabulary, self.merged)
        here: dict[str, bytes] = {}
        for part, words in cuts.items():
            ids = known[words[0]] if len(words) == 1 else b"".join([known[word] for word in words])
            here[part] = ids
            # Parts with a rare word are not likely to come again.
            if rare.isdisjoint(words):
                memo[part] = ids
        values = [here[part] if ids is None else ids for part, ids in zip(parts, found)]
        return joined_rows(pa.array(values, pa.large_binary()), places, starts)


@contextmanager
def short_plans(spark: SparkSession) -> Iterator[None]:
    """Descriptions of plans are kept by the driver; one that holds a large literal is cut."""
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "100000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def word_ids(words: set[str], vocabulary: Vocabulary, merged: pa.Table) -> tuple[dict[str, bytes], set[str]]:
    """The packed ids of distinct words, and which are neither tokens nor in the table but merged here."""
    tokens = tokens_of(vocabulary)
    out, others, rare = {}, [], set()
    for word in words:
        own = tokens.get(word.encode("utf-8", "surrogatepass"))
        if own is None:
            others.append(word)
        else:
            out[word] = packed([own])
    places = pc.index_in(pa.array(others, pa.string()), value_set=merged["word"])
    for word, ids in zip(others, pc.take(merged["ids"], places).to_pylist()):
        if ids is None:
            rare.add(word)
        else:
            out[word] = ids
    unknown = list(rare)
    out.update(zip(unknown, merge_together([word.encode("utf-8", "surrogatepass") for word in unknown], vocabulary)))
    return out, rare


def _as_bytes(table: pa.Table) -> bytes:
    """An Arrow table as one stretch of bytes, far smaller than a dictionary of objects."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


@lru_cache(maxsize=1)
def _as_table(data: bytes) -> pa.Table:
    """Words and their ids, in one chunk; kept by a worker for its further tasks, as Arrow and not as objects."""
    return pa.ipc.open_stream(data).read_all().combine_chunks()


@lru_cache(maxsize=2)
def tokens_of(vocabulary: Vocabulary) -> dict[bytes, int]:
    """The tokens and their ranks."""
    return vocabulary.table()


@lru_cache(maxsize=2)
def _pair_arrays(vocabulary: Vocabulary) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
    """The id of each byte (None if one has none), and sorted numbers of the pairs that make a token, with its id."""
    ranks = tokens_of(vocabulary)
    singles = [ranks.get(bytes([byte])) for byte in range(256)]
    pairs = sorted(
        ((ranks[token[:at]] << 32) | ranks[token[at:]], rank)
        for token, rank in ranks.items()
        for at in range(1, len(token))
        if token[:at] in ranks and token[at:] in ranks
    )
    # A pair that no two ids make stands for an empty table.
    keys, made = np.array(pairs or [(-1, 0)], np.int64).T.copy()
    return None if None in singles else np.array(singles, np.int64), keys, made


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, ids, body``: the binary pieces of the ids, concatenated."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    kind = dict(encoded.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                ids = part.column("ids")
                body = decoded_rows(ids.cast(pa.large_binary()), shared.value).cast(pa.binary())
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "ids": ids, "body": body})

    return map_arrow(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, ids binary, body binary")


def decoded_rows(ids: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    """The pieces of each row's packed ids, concatenated."""
    rows = pc.fill_null(ids, b"")
    ends = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1]
    data = rows.buffers()[2]
    numbers = np.frombuffer(data, "<u4", (ends[-1] - ends[0]) // 4, ends[0]) if ends[-1] > ends[0] else np.zeros(0, "<u4")
    return joined_rows(_pieces(vocabulary), numbers.astype(np.int64), (ends - ends[0]) // 4)


@lru_cache(maxsize=2)
def _pieces(vocabulary: Vocabulary) -> pa.Array:
    table = vocabulary.table()
    out = [b""] * (max(table.values(), default=-1) + 1)
    for token, rank in table.items():
        out[rank] = token
    return pa.array(out, pa.large_binary())
