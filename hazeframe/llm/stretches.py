"""Results remembered by stretch of text, for tokenizers that split at white space first."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

#: A space after white space: there, and at a space at the beginning, splitting at spaces isn't enough.
_uneven = re.compile(r" (?<=\s )").search
_cuts = re.compile(r"(?<=\S)(?= )").split


def stretches(text: str) -> list[str]:
    """Keys of the parts of `text` that a tokenizer with public_tokenizers.PATTERN treats on their own.

    A cut stands before a space that follows something other than white space: no match of the pattern goes over it, as
    a space can only begin a match there, and the matches on either side see the same neighbours as in the whole. Python
    knows more white space than the pattern does, which only makes fewer cuts. Most parts are a space and what follows up to
    the next one; their key is what follows. The key of any other part is the part and a space. See `part_of`.
    """
    if not text:
        return []
    if text[0] == " " or _uneven(text):
        return [p[1:] if p[0] == " " and " " not in p[1:] else p + " " for p in _cuts(text)]
    keys = text.split(" ")
    keys[0] += " "
    return keys


def part_of(key: str) -> str:
    """The part of a text that a key stands for."""
    return key[:-1] if key[-1:] == " " else " " + key


class Remembered:
    """`compute(key)` for parts of texts, of which the last `most` at least stay known, and twice as many at most.

    New results are young; when there are `most` of them, they become the old ones, and the old ones that nobody asked for
    since are forgotten. Long parts are computed each time, so that memory is bounded by short ones.
    """

    LONG = 64

    def __init__(self, compute: Callable[[str], Any], most: int):
        self.compute, self.most = compute, most
        self.young: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def __getitem__(self, key: str) -> Any:
        result = self.young.get(key)
        if result is None:
            result = self.old.get(key)
            if result is None:
                result = self.compute(key)
            if len(key) <= self.LONG:
                if len(self.young) >= self.most:
                    self.young, self.old = {}, self.young
                self.young[key] = result
        return result

    def of(self, text: str) -> list[Any]:
        keys = stretches(text)
        found = list(map(self.young.get, keys))
        if None in found:
            for i, result in enumerate(found):
                if result is None:
                    found[i] = self[keys[i]]
        return found
