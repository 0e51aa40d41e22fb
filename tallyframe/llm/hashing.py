"""64-bit names of words and of windows of words, for whole Arrow batches at a time.

A word's name is a sum of one pseudo-random value for each byte and place, a window's a tree of
mixed pairs. Neither is a polynomial, so no arrangement of few bytes or words (such as that of
Thue and Morse) makes two names equal; different words and windows share a name by chance
alone, with a probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers of a 64-bit mixing function.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; different values stay different."""
    values = (values ^ (values >> np.uint64(30))) * MIX_1
    values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


#: Places in a word whose values are looked up; those of further ones are computed.
NEAR = 64


def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    """A value for each byte, and the same with A-Z as a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
    lower = np.arange(256)
    lower[65:91] += 32
    return values, values[lower]


def _at_place(values: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The value of a byte (given by its own value) at a place in a word."""
    return mix(values + place.astype(np.uint64) * MIX_2)


def word_names(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The names of all words of the texts, one after the other, and the number of words per text.

    Words are separated by ASCII white space. A word's name is the mixed sum of a value for
    each byte at its place. With ``lower``, A-Z count as a-z.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edges = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    borders = np.cumsum([len(text) + 1 for text in texts])
    counts = np.diff(np.searchsorted(starts, borders), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(firsts, lengths)
    body, kind = joined[~space], 1 if lower else 0
    values = _NEAR_VALUES[kind][(np.minimum(place, NEAR - 1) << 8) | body]
    far = np.flatnonzero(place >= NEAR)
    if len(far):
        values[far] = _at_place(_VALUES[kind][body[far]], place[far])
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64) * STEP), counts


#: Texts are worked on together until they have so many bytes.
TOGETHER = 1_000_000


def gathered(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as UTF-8 in groups of about ``TOGETHER`` bytes, with the number of the first; null is empty."""
    first, group, size = 0, [], 0
    for at, text in enumerate(texts):
        group.append(b"" if text is None else text.encode("utf-8"))
        size += len(group[-1])
        if size >= TOGETHER:
            yield first, group
            first, group, size = at + 1, [], 0
    if group:
        yield first, group


def window_names(names: np.ndarray, size: int) -> np.ndarray:
    """The names of all windows of ``size`` consecutive words; none if there are fewer words.

    Stretches of 2, 4, 8, ... words are named from their halves; the last two stretches of the
    largest such length that fit in a window, its first and last words, name the window.
    """
    many = len(names) - size + 1
    if many <= 0:
        return np.zeros(0, np.uint64)
    made, length = names, 1
    while 2 * length <= size:
        made = _joined(made[:-length], made[length:])
        length *= 2
    if length < size:
        made = _joined(made[:many], made[size - length : size - length + many])
    return made if size > 1 else mix(made)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of two stretches in this order."""
    return mix(left * MIX_1 + right)


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit values as the engine's longs."""
    return values.view(np.int64)


_VALUES = _byte_values()
_NEAR_VALUES = tuple(
    _at_place(np.tile(values, NEAR), np.repeat(np.arange(NEAR), 256)) for values in _VALUES
)
