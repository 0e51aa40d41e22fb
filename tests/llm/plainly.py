"""The operators' results the long way round, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text):
    return (text or "").encode().split()


def cut_repeats(texts: list, size: int = 35) -> list[tuple[int, int, bytes]]:
    """Words, removed words and what is left, per text."""
    lists = [words(text) for text in texts]
    seen = Counter(tuple(w[i : i + size]) for w in lists for i in range(len(w) - size + 1))
    out = []
    for w in lists:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text) -> frozenset:
    w = (text or "").encode().translate(UPPER).split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    """Per id of ``(id, text)``: set size and component."""
    sets = {doc: shingles(text) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def root(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    holders: dict = {}
    for doc, found in sets.items():
        for item in found:
            holders.setdefault(item, []).append(doc)
    common = Counter((a, b) for docs in holders.values() for i, a in enumerate(docs) for b in docs[i + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            one, two = root(a), root(b)
            parent[max(one, two)] = min(one, two)
    return {doc: (len(found), root(doc)) for doc, found in sets.items()}


SECRETS = [
    ("assign", re.compile("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def secrets(text) -> list[tuple[int, int, int, str]]:
    return sorted(
        (m.start(), at, m.end(), kind)
        for at, (kind, pattern, group, least) in enumerate(SECRETS)
        for m in pattern.finditer(text or "")
        if len(m.group(group)) >= least
    )


def nearest(vectors: dict[int, list], k: int) -> dict[int, list[tuple[int, float]]]:
    good = {i: np.array(v, float) for i, v in vectors.items() if v and None not in v and np.isfinite(v).all() and any(v)}
    return {
        q: sorted(((-float((x * v).sum()), i) for i, v in good.items() if i != q))[:k] for q, x in good.items()
    }


def piece_sums(ids: list[int], size: int) -> list[tuple[int, int, int]]:
    """Start, length and CRC of each piece."""
    rest = len(ids) % size
    lengths = ([rest] if rest else []) + [size] * (len(ids) // size)
    out, at = [], 0
    for n in lengths:
        out.append((at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
        at += n
    return out


def runs(w: list) -> list[tuple[int, int, int]]:
    """Start, length and period of all runs of at least six words and four periods."""
    ids = np.unique(np.array(w, dtype=object), return_inverse=True)[1] if w else np.zeros(0, int)
    out: list[tuple[int, int, int]] = []
    for q in range(1, len(w) // 4 + 1):
        same = np.concatenate(([False], ids[:-q] == ids[q:], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = last - first + q
            inside = any(p < q and s <= first and first + length <= s + n for s, n, p in out)
            if length >= max(6, 4 * q) and not inside:
                out.append((first, length, q))
    return sorted(out, key=lambda run: (run[0], run[2]))


def run_digests(doc, text) -> tuple:
    """What the query states of a document."""
    w = words(text)
    h = zlib.crc32(str(doc).encode())
    if w and h % 10 == 0:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [word if i < a else w[a + (i - a) % p] for i, word in enumerate(w)]
    found = runs(w)
    gone = {at for start, length, period in found for at in range(start + period, start + length)}
    text_of = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    best = min(found, key=lambda run: (-run[1], run[0], run[2]), default=None)
    facts = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (len(found), *facts, sha(text_of.encode()), sha(b" ".join(x for at, x in enumerate(w) if at not in gone)))


def near(vectors: list[tuple], least: float = 0.93) -> dict[int, tuple[int, int, bool]]:
    """Links, component and whether it is kept, per id of ``(id, vector, label)``."""
    good = {
        i: (np.array(v, float) / np.linalg.norm(v), label)
        for i, v, label in vectors
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v)
    }
    parent = {i: i for i, _, _ in vectors}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links: Counter = Counter()
    for a, (x, one) in good.items():
        for b, (y, two) in good.items():
            if a < b and one == two and len(x) == len(y) and float(x @ y) >= least:
                links.update((a, b))
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (links[i], root(i), root(i) == i) for i in parent}


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(documents: list[tuple], items: list[tuple], top: int = 50) -> dict:
    """Per item the best documents as ``(doc_id, score)``."""
    import math

    def terms(text):
        return TERM.findall((text or "").translate({at: at + 32 for at in range(65, 91)}))

    held = [(doc, Counter(terms(text))) for doc, text in documents]
    held = [(doc, found, sum(found.values())) for doc, found in held if found]
    total = sum(n for *_, n in held)
    df = Counter(term for _, found, _ in held for term in found)
    out = {}
    for item, text in items:
        scores = []
        for doc, found, n in held:
            m = 100 - 50 + (50 * n * len(held)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[term] + 1))) * ((10**9 * found[term]) // (1000 * found[term] + 20 * m))
                for term in set(terms(text)) if term in found
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out[item] = [(None if null else doc, -score) for score, null, doc in sorted(scores)[:top]]
    return out
