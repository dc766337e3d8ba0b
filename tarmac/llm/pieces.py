"""Cutting texts where byte-level tokenizers always cut, and coding distinct pieces once.

The split patterns of byte-level BPE give a space to the word after it, so a
space before a visible character starts a pre-token whatever stands left of
it.  Cut there, a text falls into pieces whose ids do not depend on their
neighbours, and equal pieces have equal ids.  A text's first piece has no
space before it, so heads are kept apart from the rest.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

_CUT = re.compile(r" (?=\S)")
#: A space that starts no piece; without any, every space does.
_LOOSE = re.compile(r" (?!\S)")


def cut(text: str) -> tuple[str, list[str]]:
    """(head, rest): the text is head + " " + rest[0] + " " + rest[1] ..."""
    parts = _CUT.split(text) if _LOOSE.search(text) else text.split(" ")
    return parts[0], parts[1:]


def head(text: str) -> str:
    return _CUT.split(text, maxsplit=1)[0]


class Recent:
    """A map that remembers what was used lately: twice ``limit`` entries at most.

    When the young half is full it becomes the old one, and what is asked for again comes back from there."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, words: Iterable[str]) -> list[str]:
        """Those of ``words`` that are not known; the others are in ``young`` afterwards."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old, new = self.young, self.old, []
        for w in {w for w in words if w not in young}:
            ids = old.get(w)
            if ids is None:
                new.append(w)
            else:
                young[w] = ids
        return new


class PieceCache:
    """Ids (as bytes) of texts, piece by piece; remembers pieces used lately, so memory is bounded."""

    def __init__(self, encode: Callable[[Iterable[str]], list[bytes]], whole: Iterable[str] = (), limit: int = 250_000) -> None:
        self.encode, self.whole = encode, tuple(whole)
        self.known = Recent(limit)

    def ids(self, text: str) -> bytes:
        """Ids of a text; one that holds a string of ``whole`` is not cut."""
        if any(x in text for x in self.whole):
            return self.encode([text], uncut=True)[0]
        head, rest = cut(text)
        coded = list(map(self.known.young.get, rest))
        if None in coded:
            new = self.known.missing(rest)
            if new:
                self.known.young.update(zip(new, self.encode([" " + p for p in new]), strict=True))
            coded = map(self.known.young.__getitem__, rest)
        first = self.encode([head])[0] if head else b""
        return first + b"".join(coded)
