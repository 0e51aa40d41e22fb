"""Toxicity by a lexicon, caught with its misspellings and weighed by what stands around it.

The lexicon is learned: words, or beginnings of words, that labelled toxic documents hold far
more often than others. It is kept as a trie. A Levenshtein automaton for a term accepts what
is at most one edit away from it, or from a word that begins with it if it is a beginning;
here the automata of all terms run down the trie together, so a word is compared with all
terms at once and left as soon as no state is alive. Each hit is weighed by the words around it: quotation marks and words of
reporting speak for quotation, words of address for abuse. A logistic fit on these counts
gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import held_out, map_batches
from tallyframe.llm.labelled import fit_logistic, sigmoid, training_sample

#: At most about so many labelled documents are learned from.
SAMPLE = 20_000
SHORTEST, LONGEST = 4, 12
TERMS = 300
#: Words on either side of a hit that count as its context.
CONTEXT = 8
MEMO_WORDS = 300_000
WORD = re.compile(r"[^\W_]+")
#: Quotation marks, each with the mark that ends what it opens.
CLOSED_BY = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’"}
MARKS = re.compile("[\"“”„«»‘’\n]")
#: Words that often go with a quotation, and words of address.
REPORTING = frozenset("said says wrote writes quoted quote called word term sagte schrieb dit écrit dijo escribió".split())
ADDRESS = frozenset("you your youre u du dich dein ihr tu toi vous te usted tú".split())


@dataclass(frozen=True)
class Term:
    """A word, or a beginning of words if ``open``."""

    text: str
    open: bool


def words_in(text: str | None) -> list[str]:
    """Lower-case words: letters and digits."""
    return WORD.findall(text.lower()) if text else []


def learn_terms(sample: DataFrame, least_ratio: float = 12.0, least_share: float = 0.01) -> list[Term]:
    """Words and beginnings of words that mark toxic documents.

    A beginning is taken if it is in at least ``least_share`` of the toxic documents (and in
    three), and ``least_ratio`` times as frequent there as in the others. It is then made as
    long as it goes without losing more than a twentieth of its documents. At
    most ``TERMS`` of them come to the driver, those in most toxic documents.
    """

    def each(got: dict[str, list]) -> dict[str, list]:
        marked = (Counter(), Counter())
        for text, label in zip(got["text"], got["label"]):
            found = set(words_in(text))
            parts = {word[:size] for word in found for size in range(SHORTEST, min(len(word), LONGEST) + 1)}
            # A whole word is marked by a blank after it.
            parts |= {word + " " for word in found if SHORTEST <= len(word) <= LONGEST}
            marked[1 if label else 0].update(parts)
        # What no toxic document of the batch holds still counts if another batch has it.
        parts = list(marked[0].keys() | marked[1].keys())
        return {"part": parts, "toxic": [marked[1][p] for p in parts], "clean": [marked[0][p] for p in parts]}

    sizes = {row["label"]: row["n"] for row in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return []
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    counted = (
        map_batches(sample.select("text", "label"), "part string, toxic long, clean long", each)
        .groupBy("part")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= max(3, least_share * toxic))
        .filter(ratio >= least_ratio)
    )
    rows = counted.orderBy(F.desc("toxic"), F.length("part"), "part").limit(LONGEST * TERMS).collect()
    return chosen_terms({row["part"]: row["toxic"] for row in rows})


def chosen_terms(counts: dict[str, int]) -> list[Term]:
    """Shortest beginnings that qualify, each made longer while it keeps its documents."""
    children: dict[str, list[str]] = {}
    for part in counts:
        children.setdefault(part[:-1], []).append(part)
    terms: list[Term] = []
    for part in sorted(counts, key=lambda p: (-counts[p], p)):
        if part[:-1] in counts or part.endswith(" "):
            continue
        first = counts[part]
        while longer := [c for c in children.get(part, []) if counts[c] >= 0.95 * first]:
            part = max(longer, key=lambda c: (counts[c], c))
        terms.append(Term(part.rstrip(" "), not part.endswith(" ")))
    return terms[:TERMS]


class Trie:
    """Terms by letters."""

    def __init__(self, terms: list[Term]):
        self.root: dict = {}
        for at, term in enumerate(terms):
            node = self.root
            for letter in term.text:
                node = node.setdefault(letter, {})
            node[""] = (at, term.open)

    def exact(self, word: str) -> int | None:
        """The term that the word is, or begins with if the term is open."""
        node, found = self.root, None
        for letter in word:
            node = node.get(letter)
            if node is None:
                return found
            if "" in node and node[""][1]:
                found = node[""][0]
        return node[""][0] if "" in node else found


class Automaton:
    """The Levenshtein automata (one edit, or one swap of neighbours) of all terms at once.

    They run down the trie together: a state is the set of places in the trie that a
    beginning of a word can stand at, each with the edits it took. States and moves are
    made as words ask for them and kept; their number is bounded by the lexicon, as
    letters that no term has are one letter. Most words reach the dead state after a
    few letters. An open term is found as soon as a place with one edit ends it, whatever
    follows. Only open terms of fewer than ``SHORTEST`` letters, which are not learned, are
    left out, as nearly every word begins with something close to them.
    """

    DEAD = 0

    def __init__(self, terms: list[Term]):
        self.given = [(at, term) for at, term in enumerate(terms) if not term.open or len(term.text) >= SHORTEST]
        self.trie = Trie([term for _, term in self.given])
        self.alphabet = {letter for _, term in self.given for letter in term.text}
        # Lengths that a word one edit away can have.
        self.shortest = min((len(term.text) for _, term in self.given), default=0) - 1
        self.longest = max((math.inf if term.open else len(term.text) for _, term in self.given), default=0) + 1
        # Places are numbered, so that sets of them can be told apart.
        self.nodes: list[dict] = []
        self.children: list[dict[str, int]] = []
        self._number(self.trie.root)
        self.known: dict[frozenset, int] = {frozenset(): self.DEAD}
        # The first term that a word ending in a state is close to, and the first open one; the number of terms for none.
        self.none = len(self.given)
        self.accepts: list[int] = [self.none]
        self.opens: list[int] = [self.none]
        self.places: list[frozenset] = [frozenset()]
        self.moves: dict[tuple[int, str], int] = {}
        self.start = self._state({(0, 0, "")}) if self.given else self.DEAD

    def _number(self, node: dict) -> int:
        at = len(self.nodes)
        self.nodes.append(node)
        self.children.append({})
        for letter, child in node.items():
            if letter:
                self.children[at][letter] = self._number(child)
        return at

    def _state(self, places: set[tuple[int, int, str]]) -> int:
        """The number of a set of places; a letter of a term may also be left out."""
        places |= {(child, 1, "") for node, edits, waits in places if not edits and not waits for child in self.children[node].values()}
        key = frozenset(places)
        if key not in self.known:
            self.known[key] = len(self.places)
            self.places.append(key)
            ends = [self.nodes[node][""] for node, edits, waits in key if edits and not waits and "" in self.nodes[node]]
            self.accepts.append(min((at for at, _ in ends), default=self.none))
            self.opens.append(min((at for at, open in ends if open), default=self.none))
        return self.known[key]

    def _move(self, state: int, letter: str) -> int:
        places: set[tuple[int, int, str]] = set()
        for node, edits, waits in self.places[state]:
            below = self.children[node]
            if waits:
                # The second letter of a swap.
                if letter == waits:
                    places.add((node, 1, ""))
                continue
            if letter in below:
                places.add((below[letter], edits, ""))
            if not edits:
                places.add((node, 1, ""))
                for other, child in below.items():
                    if other != letter:
                        places.add((child, 1, ""))
                        if letter in self.children[child]:
                            places.add((self.children[child][letter], 1, other))
        return self._state(places)

    def near(self, word: str) -> int | None:
        """The first term one edit away from a word, or from a beginning of it if open; the word is no term itself."""
        state, moves, alphabet, opens, found = self.start, self.moves, self.alphabet, self.opens, self.none
        for letter in word:
            key = (state, letter if letter in alphabet else "?")
            state = moves.get(key, -1)
            if state < 0:
                state = moves[key] = self._move(*key)
            if state == self.DEAD:
                break
            if opens[state] < found:
                found = opens[state]
        found = min(found, self.accepts[state])
        return None if found == self.none else self.given[found][0]


@dataclass(frozen=True)
class Model:
    terms: list[Term]
    weights: np.ndarray


def quotations(text: str) -> list[tuple[int, int]]:
    """Where the stretches between an opening quotation mark and its closing one in a line are.

    A mark between two letters or digits is an apostrophe.
    """
    found: list[tuple[int, int]] = []
    opened: dict[str, int] = {}
    for match in MARKS.finditer(text):
        mark, at = match.group(), match.start()
        if mark == "\n":
            opened.clear()
        elif mark == "’" and text[at - 1 : at].isalnum() and text[at + 1 : at + 2].isalnum():
            continue
        else:
            # A low opening mark is closed by either of the high ones.
            closes = mark if mark in opened else "“" if mark == "”" and "“" in opened else None
            if closes:
                found.append((opened.pop(closes), at))
            elif mark in CLOSED_BY:
                opened[CLOSED_BY[mark]] = at
    return found


class Matcher:
    """Hits of a text, with a memo of words of bounded size."""

    def __init__(self, terms: list[Term]):
        self.trie, self.automaton = Trie(terms), Automaton(terms)
        self.memo: dict[str, tuple[int, bool] | bool] = {}

    def look(self, word: str) -> tuple[int, bool] | bool:
        found = self.trie.exact(word)
        if found is not None:
            hit: tuple[int, bool] | bool = (found, True)
        else:
            found = self.automaton.near(word) if self.automaton.shortest <= len(word) <= self.automaton.longest else None
            hit = False if found is None else (found, False)
        if len(word) <= 2 * LONGEST:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = hit
        return hit

    def facts(self, text: str | None) -> list[float]:
        """The features of a text."""
        words = words_in(text)
        get = self.memo.get
        hits = [(at, hit) for at, word in enumerate(words) if (hit := (known if (known := get(word)) is not None else self.look(word)))]
        exact = near = quoted = abusive = 0.0
        if hits:
            spans = [match.span() for match in WORD.finditer(text.lower())]
            cited = quotations(text.lower())
            for at, (_, same) in hits:
                low, high = max(0, at - CONTEXT), min(len(words), at + CONTEXT + 1)
                around = words[low:at] + words[at + 1 : high]
                inside = any(first < spans[at][0] < last for first, last in cited)
                signs = inside + bool(REPORTING.intersection(around))
                quoted += signs
                abusive += bool(ADDRESS.intersection(around))
                if same:
                    exact += 1
                else:
                    near += 1
        many = len(words)
        terms = len({hit[0] for _, hit in hits})
        return [
            min(exact, 6.0), float(exact >= 1), float(exact >= 2), float(exact >= 3), min(near, 4.0), float(near >= 2),
            min(float(terms), 5.0), float(terms >= 2), quoted / max(len(hits), 1), abusive / max(len(hits), 1),
            min(1.0, 20 * (exact + near) / max(many, 1)), np.log1p(many) / 10, np.log1p(many) / 10 * float(exact >= 1),
        ]


_matchers: dict[tuple[Term, ...], Matcher] = {}


def matcher_for(terms: list[Term]) -> Matcher:
    """A matcher that lives as long as its worker."""
    key = tuple(terms)
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(terms)
    return _matchers[key]


def learn_toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and weights from at most about ``sample`` labelled documents that are not held out.

    Without labels of both kinds there is no lexicon and every text has the same score. The
    driver gets the terms and a row of features per document of the sample.
    """
    rows = training_sample(documents, labels, "toxic", sample)
    terms = learn_terms(rows)

    def each(got: dict[str, list]) -> dict[str, list]:
        facts = matcher_for(terms).facts
        return {"label": got["label"], "facts": [facts(text) for text in got["text"]]}

    seen = map_batches(rows.select("text", "label"), "label int, facts array<double>", each).collect()
    width = len(Matcher([]).facts(""))
    if not seen:
        return Model(terms, np.zeros(width + 1))
    x, y = np.array([row["facts"] for row in seen]), np.array([float(row["label"] > 0) for row in seen])
    return Model(terms, fit_logistic(x, y))


def score_toxicity(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``doc_id, score, predicted, n_hits`` of every document, from ``text`` alone.

    Null and empty texts have no words and are scored like any other. Repeated rows stay. An
    empty table gives an empty result.
    """
    kind = dict(documents.dtypes)["doc_id"]

    def each(got: dict[str, list]) -> dict[str, list]:
        facts = matcher_for(model.terms).facts
        x = np.array([facts(text) for text in got["text"]])
        scores = sigmoid(x @ model.weights[:-1] + model.weights[-1]).tolist()
        return {
            "doc_id": got["doc_id"], "score": scores, "predicted": [int(score >= least) for score in scores],
            "n_hits": [int(row[0] + row[4]) for row in x],
        }

    return map_batches(documents.select("doc_id", "text"), f"doc_id {kind}, score double, predicted int, n_hits int", each)


def classify_toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_hits`` of every document."""
    return score_toxicity(documents, learn_toxicity(documents, labels, sample)).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted", "n_hits"
    )
