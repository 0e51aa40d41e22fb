"""Token ids of texts by a given byte-level BPE vocabulary, with a memo of frequent parts.

A blank followed by anything but white space always begins a new match of the splitting
pattern, and nothing before it depends on what follows. So a text can be cut there and
each part encoded by itself. Words come again and again, so the parts' ids are kept in a
memo of bounded size for as long as the worker lives. Added tokens (such as a mark for the
end of a text) are found in the text before that, and what stands between them is encoded
as if it were a text of its own.
"""

from __future__ import annotations

import base64
import json
import re
import sys
from array import array
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

#: Parts kept by a worker process; the memo starts anew beyond this.
MEMO_PARTS = 400_000
#: Longer parts are encoded but not kept.
MEMO_CHARS = 64


@dataclass(frozen=True)
class Vocabulary:
    """Ranks (the content of a rank file), the splitting pattern and added tokens; sent to the workers as is."""

    ranks: bytes
    pattern: str
    #: Texts that are one id wherever they stand.
    added: tuple[tuple[str, int], ...] = ()

    @classmethod
    def read(cls, path: str, pattern: str, added_from: str | None = None) -> Vocabulary:
        """The rank file at ``path`` and the added tokens of a tokenizer's JSON file, read on the driver."""
        with open(path, "rb") as file:
            return cls(file.read(), pattern, added_tokens(added_from) if added_from else ())

    def table(self) -> dict[bytes, int]:
        """Bytes of each token to its rank, which is its id."""
        lines = (line.split() for line in self.ranks.splitlines() if line)
        return {base64.b64decode(token): int(rank) for token, rank in lines}

    def encoder(self) -> Callable[[str], bytes]:
        """A function from a text to its ids as little-endian unsigned 32-bit integers."""
        return _encoder(self)


def added_tokens(path: str) -> tuple[tuple[str, int], ...]:
    """Added tokens of a tokenizer's JSON file and their ids; those that match more than their own text are refused."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    for token in tokens:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} is not matched as it stands")
    return tuple((token["content"], token["id"]) for token in tokens)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    made = array("I", ids)
    if sys.byteorder != "little":
        made.byteswap()
    return made.tobytes()


@lru_cache(maxsize=2)
def _encoder(vocabulary: Vocabulary) -> Callable[[str], bytes]:
    import tiktoken

    ordinary = tiktoken.Encoding(
        "given", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.table(), special_tokens={}
    ).encode_ordinary
    memo: dict[str, bytes] = {}

    def fresh(part: str) -> bytes:
        made = packed(ordinary(part))
        if len(part) <= MEMO_CHARS:
            if len(memo) >= MEMO_PARTS:
                memo.clear()
            memo[part] = made
        return made

    def encode(text: str) -> bytes:
        found = memo.get
        return b"".join([found(part) or fresh(part) for part in parts_of(text)])

    if not vocabulary.added:
        return encode
    whole = {token: packed([number]) for token, number in vocabulary.added}
    # The longest of those that begin at one place is taken.
    marks = re.compile("(" + "|".join(map(re.escape, sorted(whole, key=len, reverse=True))) + ")")

    def encode_with_added(text: str) -> bytes:
        # Every other piece is an added token.
        return b"".join([whole[piece] if at % 2 else encode(piece) for at, piece in enumerate(marks.split(text))])

    return encode_with_added


def parts_of(text: str) -> list[str]:
    """The text cut before every blank that is followed by something other than white space.

    Runs of blanks and line ends stay with what precedes them.
    """
    if not text:
        return []
    first, *rest = text.split(" ")
    parts = [first] if first else []
    for word in rest:
        if (word and not word[0].isspace()) or not parts:
            parts.append(" " + word)
        else:
            parts[-1] += " " + word
    return parts
