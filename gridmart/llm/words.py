"""Per-worker caches of word encodings.

Byte-level and piece tokenizers never merge across a space that stands between two other
characters: the space leads the word behind it. A text is therefore the join of its first
word and its space-led words, and equal words have equal encodings wherever they stand.
"""

from __future__ import annotations

from collections.abc import Callable

CACHE_BYTES = 110_000_000
ENTRY_BYTES = 200


class _NotSeparate(Exception):
    """White space beside a space: the words cannot be encoded one by one."""


class _Encodings(dict):
    """Encodings by word, made when first asked for."""

    def __init__(self, encode: Callable[[str], object], lead: str, known: dict[str, object]):
        super().__init__(known)
        self._encode = encode
        self._lead = lead
        self.held = 0

    def __missing__(self, word: str) -> object:
        if not word or word[0].isspace() or word[-1].isspace() or "▁" in word:
            raise _NotSeparate
        value = self[word] = self._encode(self._lead + word)
        self.held += len(word) + ENTRY_BYTES
        return value


class WordCache:
    """Encodings by word, about ``limit`` bytes of them beside those known from the start.

    ``lead`` is what stands before every word but the first. Full, the cache starts anew; it is
    emptied between texts only, so that it exceeds its limit by the words of one text at most.
    """

    def __init__(
        self,
        encode: Callable[[str], object],
        lead: str,
        known: dict[str, object] | None = None,
        limit: int = CACHE_BYTES,
    ):
        self._encode = encode
        self._lead = lead
        self._start = known or {}
        self._limit = limit
        self._known = _Encodings(encode, lead, self._start)

    def word(self, word: str) -> object:
        """The encoding of one word behind its lead."""
        return self._known[word]

    def values(self, text: str) -> list | None:
        """The encodings of the words of a text, in order; None where spaces adjoin other white
        space, so that the text has to be encoded whole."""
        if self._known.held > self._limit:
            self._known = _Encodings(self._encode, self._lead, self._start)
        words = text.split(" ")
        try:
            if not self._lead:
                return list(map(self._known.__getitem__, words))
            first = words[0]
            if not first or first[-1].isspace():
                return None
            words[0] = self._encode(first)
            words[1:] = map(self._known.__getitem__, words[1:])
            return words
        except _NotSeparate:
            return None
