"""Cutting texts by a tokenizer's pattern, and a memory of encoded matches."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import chain

import regex

# The public byte-level pattern, and the same for characters below
# U+0250 in the syntax of the faster standard module.  There its classes differ
# from the pattern's only at the separators 1C-1F and the numbers that aren't
# decimal digits; texts that hold one of those, or any character from U+0250 on,
# are cut by the pattern itself.
PUBLIC = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
NOT_LATIN = "[\x1c-\x1f²³¹¼-¾ɐ-\U0010ffff]"


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The matches of ``pattern`` in a text, in order."""
    every = regex.compile(pattern).findall
    if pattern != PUBLIC:
        return every
    latin, other = re.compile(LATIN).findall, re.compile(NOT_LATIN).search
    return lambda text: every(text) if other(text) else latin(text)


class Memory:
    """Packed ids of matches.  When a generation is full, it becomes the old
    one and a new one begins; what is met again moves over."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], pattern: str, generation: int):
        self.encode, self.find, self.generation = encode, splitter(pattern), generation
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.new) > self.generation:
            self.new, self.old = {}, self.new
        matches = [*map(self.find, texts)]
        missing = set(chain.from_iterable(matches)).difference(self.new)  # a dict, not its view: looks up the few
        self.new.update((m, self.old[m]) for m in missing if m in self.old)
        if rest := [*missing.difference(self.new)]:
            self.new.update(zip(rest, (array("I", ids).tobytes() for ids in self.encode(rest)), strict=True))
        get = self.new.__getitem__
        return [b"".join(map(get, found)) for found in matches]

    def forget(self) -> None:
        self.new, self.old = {}, {}
