"""Encoding texts chunk by chunk, each distinct chunk once per cache.

A text may be cut before a space that follows a character other than white space: no
match of the byte-level pattern reaches over such a place, as only white-space matches
and the single leading space of a word hold spaces. Encoding the chunks one by one
therefore gives the ids of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

_UNSAFE = re.compile(r"\s ")
_CUT = re.compile(r"(?<!\s) ")


def cut_at_each_space(text: str) -> bool:
    """Whether every space of the text begins a chunk."""
    return not _UNSAFE.search(text)


def space_led_chunks(text: str) -> list[str]:
    """The text's chunks; all but the first have lost the space they begin with."""
    return text.split(" ") if cut_at_each_space(text) else _CUT.split(text)


class ChunkCache:
    """Encoded chunks, at most about twice ``limit`` of them; the longest unused go first.

    ``encode_many`` gets a list of chunks and returns one ``bytes`` for each.
    """

    def __init__(self, encode_many: Callable[[list[str]], Iterable[bytes]], limit: int):
        self._encode_many = encode_many
        self._limit = limit
        self._codes: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def __len__(self) -> int:
        return len(self._codes)

    def codes_of(self, chunks: set[str]) -> Callable[[str], bytes]:
        """A look-up that knows all these chunks; what is new is encoded in one go."""
        if len(self._codes) + len(chunks) > self._limit:
            self._older, self._codes = self._codes, {}
        new = chunks.difference(self._codes)
        if self._older:
            again = new.intersection(self._older)
            self._codes.update(zip(again, map(self._older.__getitem__, again), strict=True))
            new -= again
        # chunks of letters only come together: they are the quickest to tell apart
        wanted = sorted(new, key=str.isalpha)
        if wanted:
            self._codes.update(zip(wanted, self._encode_many(wanted), strict=True))
        return self._codes.__getitem__
