"""Byte-pair merges as a table of rules, and what follows from their order.

A word is a string of symbols (``chr(0)`` to ``chr(511)``): its bytes, where the
last byte counts from 256 if the vocabulary marks the ends of words.  Merging by
rank, leftmost first, has two properties that both operators build on:

- a sequence of tokens is the encoding of its word exactly if each neighbouring
  pair is the encoding of its own joint text (``MergeTable.apart``);
- so the encoding of a prefix is a prefix of choices: it ends in the one token
  that stays apart from the last token of what comes before it.
"""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

#: Bytes that the byte-level alphabet shows as themselves; the others, in order,
#: are shown as the characters from 256.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]


#: Pairs of tokens of which a worker remembers whether they stay apart.
PAIRS = 200_000


def byte_characters() -> dict[str, int]:
    hidden = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeTable:
    """The merge rules of a tokenizer file (JSON as bytes)."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        self.spec = spec
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_characters()

        def symbols(shown: str) -> str:
            ends = bool(self.end) and shown.endswith(self.end)
            body = shown[: len(shown) - len(self.end)] if ends else shown
            text = "".join(chr(alphabet[c]) for c in body)
            return text[:-1] + chr(ord(text[-1]) + 256) if ends else text

        self.symbols_of = symbols
        # Tokens are numbered by symbols first, then by the rank of their rule.
        count = 512 if self.end else 256
        self.text = [chr(i) for i in range(count)]
        self.left, self.right = list(range(count)), list(range(count))
        self.number = {t: i for i, t in enumerate(self.text)}
        self.rule: dict[tuple[int, int], int] = {}
        for a, b in model["merges"]:
            a, b = self.number[symbols(a)], self.number[symbols(b)]
            joined = self.text[a] + self.text[b]
            if joined in self.number:
                raise ValueError("two rules make one token; ranks are not unique")
            self.rule[a, b] = self.number[joined] = len(self.text)
            self.text.append(joined)
            self.left.append(a)
            self.right.append(b)
        self.base = count
        ids = {symbols(shown): i for shown, i in model["vocab"].items()}
        self.id = [ids[t] for t in self.text]
        self.longest = max(map(len, self.text))
        # Tokens that merging never yields for their own text can't end a prefix.
        sound = bytearray([1]) * len(self.text)
        for t in range(count, len(self.text)):
            a, b = self.left[t], self.right[t]
            sound[t] = sound[a] and sound[b] and self.apart(a, b, until=t)
        self.tokens = {t: i for t, i in self.number.items() if sound[i]}
        # For each beginning of a token: the token it is, if any, and whether it may go on.
        longer = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.beginnings = {b: (self.tokens.get(b), b in longer) for b in longer | set(self.tokens)}
        self._apart: dict[tuple[int, int], bool] = {}

    def follows(self, last: int, token: int) -> bool:
        """``apart`` of two tokens, remembered."""
        pair = last, token
        known = self._apart.get(pair)
        if known is None:
            if len(self._apart) > PAIRS:
                self._apart.clear()
            known = self._apart[pair] = self.apart(last, token)
        return known

    def apart(self, a: int, b: int, until: int | None = None) -> bool:
        """Whether ``a`` and ``b`` side by side are never merged across their border.

        Looks back in time: at each step the younger of the two tokens at the
        border is taken apart, and a rule across the border that is older than
        the token just undone would have come first (of equal rules the left
        one).  ``until``: only rules before that rank count.
        """
        rule, left, right = self.rule, self.left, self.right
        a_ends = b_ends = until if until is not None else len(self.text)
        first = True
        while True:
            across = rule.get((a, b))
            if across is not None and across < a_ends and across <= b_ends and not (first and across == until):
                return False
            first = False
            if a >= b:
                if a < self.base:
                    return True
                a_ends, a = a, right[a]
            else:
                if b < self.base:
                    return True
                b_ends, b = b, left[b]

    def word(self, piece: str) -> str:
        """The symbols of a piece of text."""
        raw = piece.encode("utf-8").decode("latin-1")
        return raw[:-1] + chr(ord(raw[-1]) + 256) if self.end else raw

    @cached_property
    def bytes_of_id(self) -> dict[int, bytes]:
        table = {i: bytes(ord(c) & 255 for c in t) for t, i in zip(self.text, self.id, strict=True)}
        return table | {i: t.encode() for t, i in self.special.items()}

    @cached_property
    def special_pattern(self) -> re.Pattern | None:
        names = sorted(self.special, key=len, reverse=True)
        return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None


def character_classes() -> np.ndarray:
    """For each code point: 0 white space, 1 letter, 2 number, 3 other.

    Asked of the library, whose Unicode tables may differ from Python's.  Planes
    from 4 on hold no letters, numbers or white space.
    """
    points = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    places = np.array(points)
    classes = np.full(0x110000, 3, np.uint8)
    for kind, pattern in ((0, r"\s+"), (1, r"\p{L}+"), (2, r"\p{N}+")):
        # What is not removed is not of the class.
        rest = Split(Regex(pattern), "removed").pre_tokenize_str(every)
        at = 0
        for _, (start, end) in rest:
            classes[places[at:start]] = kind
            at = end
        classes[places[at:]] = kind
    return classes


def class_pattern(classes: np.ndarray, kind: int) -> str:
    """The inside of a regular expression's character class for ``kind``."""
    is_kind = np.concatenate(([False], classes == kind, [False]))
    edges = np.flatnonzero(is_kind[1:] != is_kind[:-1]).reshape(-1, 2)
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.tolist())


def load(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def library(content: bytes) -> Tokenizer:
    return Tokenizer.from_str(content.decode("utf-8"))
