"""Periodic runs of words, found on a grammar of the text.

Word ids are compressed by Re-Pair: pairs of symbols that occur twice or more in a text
become symbols, the more frequent of two overlapping pairs first, until no pair repeats.
Many texts are compressed at a time, and in one round every pair is replaced wherever it
is more frequent than the pairs that overlap it.

A run that lies within a symbol crosses the boundary between the two parts of that symbol
or of one below it. So each symbol's boundary is looked at once, where the symbol stands
first, and what crosses it is translated to all places where the symbol stands. A run
that lies in no symbol has an end of a symbol inside it (four repetitions of plain words
would have been a repeated pair), so ends of the symbols that are left are looked at
too, over the whole text. Intervals of one period that lie in others are dropped, which
leaves the maximal ones.

A run of four periods that crosses a boundary has two of them on one side, so its period
is the distance from the boundary to another occurrence of the words beside it. Equality
of stretches is decided by names of all stretches of 1, 2, 4, ... words that repeat in
their text; names are exact, not hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import map_arrow, without, words_of

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Texts are worked on together until they have so many words.
TOGETHER = 250_000


def word_ids(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """An id for every word of the texts, strung together, and the number of words per text."""
    words = pa.array([word for text in texts for word in text], pa.binary()).dictionary_encode()
    return words.indices.to_numpy().astype(np.int64), np.array([len(text) for text in texts], np.int64)


class Names:
    """Names of the stretches of 2^k words that occur at least twice in their text, -1 for the others."""

    def __init__(self, ids: np.ndarray, owner: np.ndarray):
        size = len(ids)
        self.size = size
        code = owner * (int(ids.max(initial=0)) + 1) + ids
        _, names, many = np.unique(code, return_inverse=True, return_counts=True)
        self.levels = [np.where(many[names] > 1, names, -1).astype(np.int32)]
        while True:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            if half >= size:
                break
            # Names belong to one text, so no stretch of two equal halves leaves its text.
            at = np.flatnonzero((last[:-half] >= 0) & (last[half:] >= 0) & (owner[:-half] == owner[half:]))
            if not len(at):
                break
            pair = last[at].astype(np.int64) * size + last[at + half]
            _, made, many = np.unique(pair, return_inverse=True, return_counts=True)
            twice = many[made] > 1
            if not twice.any():
                break
            level = np.full(size, -1, np.int32)
            level[at[twice]] = made[twice]
            self.levels.append(level)

    def _same(self, level: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether the stretches that start at ``one`` and ``two`` are equal; places outside are not."""
        names = self.levels[level]
        good = (one >= 0) & (two >= 0) & (one < self.size) & (two < self.size)
        left, right = names[np.where(good, one, 0)], names[np.where(good, two, 0)]
        return good & (left == right) & (left >= 0)

    def forward(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many words are equal from ``one`` and from ``two`` on; the places differ."""
        far = np.zeros(len(one), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            going = np.arange(len(one))
            while len(going):
                same = self._same(level, one[going] + far[going], two[going] + far[going])
                going = going[same]
                far[going] += 1 << level
                if level + 1 < len(self.levels):
                    break
        return far

    def backward(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many words are equal before ``one`` and before ``two``."""
        far = np.zeros(len(one), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            step = 1 << level
            going = np.arange(len(one))
            while len(going):
                same = self._same(level, one[going] - far[going] - step, two[going] - far[going] - step)
                going = going[same]
                far[going] += step
                if level + 1 < len(self.levels):
                    break
        return far


class Grammar:
    """What Re-Pair makes of texts: rules with their places, and the symbols that are left.

    A rule is ``start, middle, stop``: where it stands first, and the boundary between its parts.
    ``rule, place`` list where each rule stands. ``ends`` are ends of symbols that are left.
    """

    def __init__(self, names: np.ndarray, owner: np.ndarray):
        begin = np.flatnonzero(names >= 0)
        symbol, stop = names[begin].astype(np.int64), begin + 1
        plain = int(names.max(initial=-1)) + 1
        fresh = plain
        firsts: list[tuple[np.ndarray, ...]] = []
        places: list[tuple[np.ndarray, np.ndarray]] = []
        left: list[np.ndarray] = []
        made = 0
        while len(symbol):
            # Pairs of neighbours in one text, and how often each occurs there.
            at = np.flatnonzero((stop[:-1] == begin[1:]) & (owner[begin[:-1]] == owner[begin[1:]]))
            _, pair, many = np.unique(symbol[at] * fresh + symbol[at + 1], return_inverse=True, return_counts=True)
            again = many[pair] > 1
            at, pair = at[again], pair[again]
            # A pair that is alone stays alone, so a symbol with no other pair is done.
            busy = np.zeros(len(symbol), bool)
            busy[at] = busy[at + 1] = True
            done = ~busy & (symbol >= plain)
            left += [begin[done], stop[done]]
            if not len(at):
                break
            rank = np.zeros(len(symbol) + 1, np.int64)
            # More frequent first; ties by a number that has nothing to do with the order of words.
            rank[at + 1] = many[pair] * (len(many) + 1) + _shuffled(len(many))[pair] + 1
            here, before, after = rank[1:], rank[:-1], np.append(rank[2:], 0)
            chosen = np.flatnonzero((here > 0) & (here >= before) & (here >= after))
            # Overlapping places of one pair (a a a): every second one.
            opens = np.flatnonzero(np.diff(chosen, prepend=-2) > 1)
            offset = np.arange(len(chosen)) - np.repeat(opens, np.diff(np.append(opens, len(chosen))))
            chosen = chosen[offset % 2 == 0]
            of = np.full(len(symbol), -1, np.int64)
            of[at] = pair
            _, first, rule = np.unique(of[chosen], return_index=True, return_inverse=True)
            firsts.append((begin[chosen[first]], stop[chosen[first]], stop[chosen[first] + 1]))
            places.append((rule + made, begin[chosen]))
            made += len(first)
            stop[chosen] = stop[chosen + 1]
            symbol[chosen] = fresh + rule
            fresh += len(first)
            busy[chosen + 1] = False
            symbol, begin, stop = symbol[busy], begin[busy], stop[busy]
        empty = np.zeros(0, np.int64)
        self.start, self.middle, self.stop = (
            np.concatenate([part[n] for part in firsts]) if firsts else empty for n in range(3)
        )
        self.rule, self.place = (np.concatenate([part[n] for part in places]) if places else empty for n in range(2))
        self.ends = np.unique(np.concatenate(left)) if left else empty


def _shuffled(many: int) -> np.ndarray:
    """The numbers up to ``many`` in a fixed order that looks like chance."""
    return np.random.default_rng(7).permutation(many)


def crossing(names: Names, start: np.ndarray, middle: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """``boundary, first, last, period`` of the runs around each ``middle``, cut to ``start`` and ``stop``."""
    found: list[tuple[np.ndarray, ...]] = []
    for level, level_names in enumerate(names.levels):
        step = 1 << level
        known = np.flatnonzero(level_names >= 0)
        keys = np.sort(level_names[known].astype(np.int64) * names.size + known)
        # The words from the boundary on, found again q later; or those before it, q earlier.
        for anchor, room, sign in ((middle, (stop - middle) // 2, 1), (middle - step, (middle - start) // 2, -1)):
            most = np.minimum(room, 2 * step - 1)
            ask = np.flatnonzero((most >= step) & (anchor >= 0))
            ask = ask[level_names[anchor[ask]] >= 0]
            base = level_names[anchor[ask]].astype(np.int64) * names.size
            near, far = anchor[ask] + sign * step, anchor[ask] + sign * most[ask]
            low = np.searchsorted(keys, base + np.minimum(near, far))
            high = np.searchsorted(keys, base + np.maximum(near, far), side="right")
            count = high - low
            which = np.repeat(ask, count)
            other = keys[np.repeat(low, count) + _counted(count)] % names.size
            period = np.abs(other - anchor[which])
            at = middle[which]
            one, two = (at, at + period) if sign > 0 else (at - period, at)
            first = np.maximum(one - names.backward(one, two), start[which])
            last = np.minimum(two + names.forward(one, two), stop[which])
            long = last - first >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
            found.append((which[long], first[long], last[long], period[long]))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    which, first, last, period = (np.concatenate(part) for part in zip(*found))
    small = smallest(names, first, last, period)
    return which[small], first[small], last[small], period[small]


def smallest(names: Names, first: np.ndarray, last: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the period is the smallest one; a smaller one would divide it, as a run has several."""
    good = np.ones(len(period), bool)
    for value in np.unique(period).tolist():
        for prime in _primes(value):
            at = np.flatnonzero(good & (period == value))
            part = value // prime
            good[at[names.forward(first[at], first[at] + part) >= last[at] - first[at] - part]] = False
    return good


def _primes(value: int) -> list[int]:
    """The prime divisors."""
    out, at = [], 2
    while at * at <= value:
        if value % at == 0:
            out.append(at)
            while value % at == 0:
                value //= at
        at += 1
    return out + [value] * (value > 1)


def _counted(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def runs_of(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """``text, start, length, period`` of all runs of texts strung together, by text, start and period."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    edges = np.concatenate(([0], np.cumsum(lengths)))
    if not len(ids):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    names = Names(ids, owner)
    grammar = Grammar(names.levels[0], owner)
    # Once for each rule, where it stands first ...
    which, first, last, period = crossing(names, grammar.start, grammar.middle, grammar.stop)
    # ... and from there to all its places.
    order = np.argsort(grammar.rule, kind="stable")
    low = np.searchsorted(grammar.rule[order], which)
    count = np.searchsorted(grammar.rule[order], which, side="right") - low
    moved = grammar.place[order[np.repeat(low, count) + _counted(count)]] - np.repeat(grammar.start[which], count)
    inner = (np.repeat(first, count) + moved, np.repeat(last, count) + moved, np.repeat(period, count))
    # Ends of the symbols that are left, within their whole texts.
    ends = grammar.ends[(grammar.ends > 0) & (grammar.ends < len(ids))]
    text = owner[ends]
    ends, text = ends[ends > edges[text]], text[ends > edges[text]]
    _, *outer = crossing(names, edges[text], ends, edges[text + 1])
    first, last, period = (np.concatenate(part) for part in zip(inner, outer))
    # Of one text and period, by start and with the longer first: what ends no later lies in another.
    order = np.lexsort((-last, first, period, owner[first]))
    first, last, period = first[order], last[order], period[order]
    text = owner[first]
    group = np.cumsum(np.concatenate(([True], (text[1:] != text[:-1]) | (period[1:] != period[:-1])))[: len(text)])
    reach = np.maximum.accumulate(last + group * (len(ids) + 1))
    fresh = np.ones(len(first), bool)
    fresh[1:] = (last + group * (len(ids) + 1))[1:] > reach[:-1]
    first, last, period, text = first[fresh], last[fresh], period[fresh], text[fresh]
    order = np.lexsort((period, first, text))
    return text[order], (first - edges[text])[order], (last - first)[order], period[order]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[at] for at in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def find_runs(documents: DataFrame) -> DataFrame:
    """``documents`` with ``n_words``, the ``runs`` of every text and the ``collapsed`` text.

    ``runs`` holds ``start, length, period`` by start, then period; places count words from 0.
    A run is a stretch of words with this smallest period, of at least six words and four
    periods, that no word beside it prolongs. ``collapsed`` has the words that no run holds
    after its first period, joined by one blank. Null and empty texts have no words and no
    runs. All rows are kept as they are, repeated ones too; a text is worked on by itself,
    whatever its length. An empty table gives an empty result. Input columns named as one of the
    new ones are replaced.
    """
    own = without(documents, "n_words", "runs", "collapsed")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def some(part: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for text, *run in zip(*(part_.tolist() for part_ in runs_of(*word_ids(texts)))):
            found[text].append(tuple(run))
        left = [b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass") for words, runs in zip(texts, found)]
        told = [[dict(zip(("start", "length", "period"), run)) for run in runs] for runs in found]
        columns = [*part.columns, pa.array([len(words) for words in texts], pa.int64()), pa.array(told, spans), pa.array(left, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, texts = 0, 0, []
            for at, text in enumerate(batch.column("text")):
                texts.append(words_of(text.as_py()))
                size += len(texts[-1])
                if size >= TOGETHER or at + 1 == batch.num_rows:
                    yield some(batch.slice(first, len(texts)), texts)
                    first, size, texts = at + 1, 0, []

    from pyspark.sql import types as T

    schema = T.StructType(
        [*own.schema.fields, *T._parse_datatype_string(
            "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
        ).fields]
    )
    return map_arrow(own, run, schema)


def runs_text(runs):
    """A column of runs as text: ``start,length,period`` and a line end for each."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def longest_run(runs):
    """The run of greatest length, the first one on ties, then that of the smallest period; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("small"))))
    return F.when(
        F.size(runs) > 0,
        F.struct((-best["back"]).alias("start"), best["length"].alias("length"), (-best["small"]).alias("period")),
    )
