"""Splitting texts into pre-tokens, and the bounded memory of what they encode to.

A pre-token never spans a blank between two other characters except as its first character.
So a text without double white space around a blank falls apart at its blanks into units
that encode alike wherever they stand, and equal units need be looked at once.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import public_tokenizers
import regex

SPECIAL = "<|endoftext|>"
_PATTERN = regex.compile(public_tokenizers.PATTERN)
_BESIDE_BLANK = re.compile(r" (?:(?=\s)|(?<=\s ))")
#: First character of a unit's key where no blank stands before it.
BARE = "\0"
#: Units (and pre-tokens) remembered by one task, twice over.
REMEMBERED = 250_000


def pretokens(text: str) -> list[str]:
    return _PATTERN.findall(text)


def falls_apart(text: str) -> bool:
    """Whether the text, not an empty one, can be cut at each of its blanks."""
    return not (BARE in text or text[0].isspace() or text[-1].isspace() or _BESIDE_BLANK.search(text))


def units(text: str, special: bool = True) -> list[str]:
    """Keys of the pieces of the text, in order, that encode independently.

    A key is the piece without the blank it begins with; of one without, it begins with BARE.
    special: the special token's string is a token of its own, as the vocabulary has it.
    """
    if not text:
        return []
    if not falls_apart(text):
        parts = special_parts(text) if special and SPECIAL in text else pretokens(text)
        return [BARE + p for p in parts]
    keys = text.split(" ")
    keys[0] = BARE + keys[0]
    return keys


def piece(key: str) -> str:
    return key[1:] if key[0] == BARE else " " + key


def special_parts(text: str) -> list[str]:
    out: list[str] = []
    for i, part in enumerate(text.split(SPECIAL)):
        if i:
            out.append(SPECIAL)
        out += pretokens(part)
    return out


class Remembered:
    """Values of what was met lately: two generations, so memory is bounded."""

    def __init__(self, most: int = REMEMBERED):
        self.now: dict = {}
        self.older: dict = {}
        self.most = most

    def unknown(self, lists) -> list:
        """Between batches: the distinct keys of the lists that have no value yet; all others
        are in ``now`` until the next call."""
        if len(self.now) > self.most:
            self.now, self.older = {}, self.now
        now, older, out = self.now, self.older, []
        for key in set().union(*lists).difference(now):
            if key in older:
                now[key] = older[key]
            else:
                out.append(key)
        return out


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
