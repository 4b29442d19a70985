"""Pieces of text that byte-level tokenizers treat alone, so that repeated ones cost nothing.

The public splitting pattern never looks past a single space, or a single line break,
between two characters that are no white space. Text is cut there into units whose
tokens can be kept by unit; only texts with neighbouring white space take a slower
path, which leaves such places whole. Whole texts are covered: joined, the units'
tokens are the text's tokens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

_NEIGHBOURS = re.compile(r"\s\s")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")

# Longer units are encoded each time they occur instead of being kept.
LONGEST_KEPT = 48


def units(text: str) -> list[str]:
    """Keys of the units in order: a unit without its space, the first one with one more."""
    if _NEIGHBOURS.search(text) is None:
        parts = text.replace("\n", " \n").split(" ")
    else:
        parts = _LONE_SPACE.split(text)
    parts[0] = " " + parts[0]
    return parts


def unit(key: str) -> str:
    """The text of a unit; a text's units joined are the text."""
    start = key[:1]
    return key[1:] if start == " " else key if start == "\n" else " " + key


class Encoder:
    """Token bytes (32-bit little-endian ids) of texts, kept by unit in bounded memory.

    ``encode_units`` maps distinct units to their token bytes. Two generations of at
    most ``limit`` units are kept: one that is used again moves to the younger.
    """

    def __init__(self, encode_units: Callable[[list[str]], Iterable[bytes]], limit: int = 400_000):
        self.encode_units, self.limit = encode_units, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [units(t) if t else [] for t in texts]
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        young = self.young
        new = set().union(*cut).difference(young)
        again = {key: self.old[key] for key in new if key in self.old}
        young.update(again)
        new = list(new.difference(again))
        young.update(zip(new, self.encode_units([unit(key) for key in new])))
        out = [b"".join(map(young.__getitem__, parts)) for parts in cut]
        for key in new:
            if len(key) > LONGEST_KEPT:
                del young[key]
        return out
