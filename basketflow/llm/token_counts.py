"""Token counts by finite-state transducers.

Two transducers, compiled from the tokenizer file, run in cascade:

- ``Lexer``: characters to pieces.  Its few states are the ways in which a piece
  can be unfinished; a transition tells where pieces begin.  Text is cut into
  chunks of equal length, wherever that falls.  Each chunk is read from *every*
  state at once, which gives its state map (state before to state after); the
  maps of all chunks are composed by a parallel prefix scan, so that the state at
  the start of each chunk is known without reading them one after the other.
- ``WordTransducer``: the symbols of a piece to tokens.  A transition is annotated
  with the tokens it adds (a merge with what came before can take tokens back, so
  the number may be negative); the sum along a piece is its token count.  States
  are determinised when first met, from the merge rules alone.

Counting is a narrow pass over the texts: nothing is shuffled.  Memory is bounded
by the longest text, the text chunk of a batch (4 MiB) and the bounds of the memos.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm import bpe
from basketflow.llm.common import no_cycles, text_chunks, text_or_empty

#: Characters of a chunk that gets a state map.
CHUNK = 128
#: Pieces whose counts are remembered by a worker, and its transducer states.
MEMO, STATES = 300_000, 100_000

#: Endings that the word pattern takes as pieces of their own.
ENDINGS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]


class Lexer:
    """Pieces of ``endings | letters+ | number | others+``; white space parts pieces.

    ``next[state, kind]`` is the state after a character, ``begins[state, kind]``
    has bit 1 if a piece begins at the character, bit 2 if one begins at the
    character before (known only now).  White space counts as pieces of its own.
    """

    def __init__(self, classes: np.ndarray):
        space, letter, number, other, quote = 0, 1, 2, 3, 4
        kinds = {c: 5 + i for i, c in enumerate(sorted({c for e in ENDINGS for c in e[1:]}))}
        self.kind = classes.copy()
        self.kind[ord("'")] = quote
        for c, kind in kinds.items():
            self.kind[ord(c)] = kind
        done, word, signs, quoted = range(4)
        pending = {e[1]: 4 + i for i, e in enumerate(e for e in ENDINGS if len(e) == 3)}
        letters = {letter, *kinds.values()}
        count = 4 + len(pending)
        self.next = np.zeros((count, 5 + len(kinds)), np.uint8)
        self.begins = np.ones_like(self.next)
        for state in range(count):
            for kind in range(self.next.shape[1]):
                to = word if kind in letters else {number: done, other: signs, quote: quoted}.get(kind, done)
                self.next[state, kind] = to
        for kind in letters:
            self.begins[word, kind] = 0
        for state in (signs, quoted):
            for kind in (other, quote):
                self.next[state, kind], self.begins[state, kind] = signs, 0
        for ending in ENDINGS:
            kind = kinds[ending[1]]
            if len(ending) == 2:
                self.next[quoted, kind], self.begins[quoted, kind] = done, 0
                continue
            state = pending[ending[1]]
            self.next[quoted, kind], self.begins[quoted, kind] = state, 0
            # If the ending is not completed, its letter began a word after all.
            self.begins[state] = 2 + self.begins[word]
            self.next[state] = self.next[word]
            last = kinds[ending[2]]
            self.next[state, last], self.begins[state, last] = done, 0

    def starts(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin in a text (which ends in white space), and the kinds."""
        kinds = self.kind[points]
        chunks = -(-len(kinds) // CHUNK)
        grid = np.zeros(chunks * CHUNK, np.uint8)
        grid[: len(kinds)] = kinds
        grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
        width = self.next.shape[1]
        step = (self.next * width).ravel()  # states times width, less than 256
        maps = np.tile(np.arange(len(self.next), dtype=np.uint8) * np.uint8(width), (chunks, 1))
        for column in grid:
            maps = step.take(maps + column[:, None])
        state = self._entries(maps // width).astype(np.uint8) * np.uint8(width)
        begins = np.empty(grid.shape, np.uint8)
        emitted = self.begins.ravel()
        for i, column in enumerate(grid):
            at = state + column
            begins[i] = emitted.take(at)
            state = step.take(at)
        begins = begins.T.ravel()[: len(kinds)]
        marks = (begins & 1).astype(bool)
        marks[:-1] |= begins[1:] > 1
        return np.flatnonzero(marks), kinds

    @staticmethod
    def _entries(maps: np.ndarray) -> np.ndarray:
        """The state before each chunk: prefix scan over composition of the maps."""
        maps, span = maps.astype(np.intp), 1
        while span < len(maps):
            # The map of chunks i-2*span+1 .. i from those of its two halves.
            maps[span:] = np.take_along_axis(maps[span:], maps[:-span], axis=1)
            span *= 2
        return np.concatenate(([0], maps[:-1, 0]))


class WordTransducer:
    """Symbols of a word to changes of the token count.

    A state holds what the future depends on: each end of the prefix that may go
    on to be a token, with the last token before it and the count up to there
    (relative to the count now).
    """

    def __init__(self, table: bpe.MergeTable):
        self.table = table
        self.memo: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        start = (("", None, 0),)
        self.states = [start]
        self.number = {start: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def _move(self, state: int, symbol: str) -> tuple[int, int]:
        beginnings, follows = self.table.beginnings, self.table.follows
        own, going = None, []
        for end, last, count in self.states[state]:
            longer = end + symbol
            token, open_ended = beginnings.get(longer, (None, False))
            if own is None and token is not None and (last is None or follows(last, token)):
                own, added = token, count + 1
            if open_ended:
                going.append((longer, last, count))
        to = (*((end, last, count - added) for end, last, count in going), ("", own, 0))
        number = self.number.get(to)
        if number is None:
            number = self.number[to] = len(self.states)
            self.states.append(to)
            self.moves.append({})
        self.moves[state][symbol] = move = number, added
        return move

    def run(self, piece: str) -> int:
        state = total = 0
        moves = self.moves
        for symbol in self.table.word(piece):
            move = moves[state].get(symbol) or self._move(state, symbol)
            state = move[0]
            total += move[1]
        if len(self.states) > STATES:
            self._reset()
        return total

    def count(self, pieces: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for piece in set(pieces).difference(memo):
            memo[piece] = self.run(piece)
        return np.fromiter(map(memo.__getitem__, pieces), np.int64, len(pieces))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def lowered(text: str) -> str:
    """NFC, then each character in lower case by itself (so no final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(1)
def _unicode_tables(content: bytes) -> tuple[bytes, str]:
    """The classes of characters, and the characters the library lowers otherwise."""
    classes = bpe.character_classes()
    normalizer = bpe.library(content).normalizer
    points = [chr(c) for c in range(1, 0x40000) if not 0xD800 <= c < 0xE000 and classes[c]]
    theirs = normalizer.normalize_str("\0".join(points)).split("\0")
    odd = "".join(c for c, t in zip(points, theirs, strict=True) if lowered(c) != t)
    return zlib.compress(classes.tobytes()), odd


class Counter:
    """Counts the tokens of texts as the library does, without special tokens around."""

    def __init__(self, content: bytes, classes: bytes, odd: str):
        table = bpe.MergeTable(content)
        self.special = table.special_pattern
        self.hints = {t[:2] for t in table.special}
        self.words = WordTransducer(table)
        self.lexer = Lexer(np.frombuffer(zlib.decompress(classes), np.uint8))
        self.odd = np.zeros(0x110000, bool)
        self.odd[[ord(c) for c in odd]] = True
        self.normalizer = bpe.library(content).normalizer

    def parts(self, text: str, normal: Callable[[str], str]) -> tuple[str, int]:
        """The text between special strings, in normal form; how many there are."""
        if not any(h in text for h in self.hints):
            return normal(text) + " ", 0
        found = self.special.split(text)
        return " ".join(map(normal, found[::2])) + " ", len(found) // 2

    def counts(self, texts: list[str]) -> np.ndarray:
        parts, special = zip(*(self.parts(t, lowered) for t in texts), strict=True)
        text = "".join(parts)
        points = code_points(text)
        if self.odd[points].any():
            parts, special = zip(*(self.parts(t, self.normalizer.normalize_str) for t in texts), strict=True)
            text = "".join(parts)
            points = code_points(text)
        starts, kinds = self.lexer.starts(points)
        ends = np.append(starts[1:], len(text))
        full = kinds[starts] != 0
        starts, ends = starts[full], ends[full]
        pieces = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        total = np.concatenate(([0], np.cumsum(self.words.count(pieces))))
        edges = np.cumsum([0, *map(len, parts)])
        return np.diff(total[np.searchsorted(starts, edges)]) + np.array(special)


@lru_cache(2)
def _counter(content: bytes, classes: bytes, odd: str) -> Counter:
    return Counter(content, classes, odd)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) per row.

    Returns ``doc_id`` and these columns, one row for each row of ``docs``, in any
    number of copies.  Null texts count as empty and have no tokens; other columns
    are not read, whatever their names.
    """
    spark = docs.sparkSession
    content = bpe.load(tokenizer)
    machine = spark.sparkContext.broadcast((content, *_unicode_tables(content)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            counter = _counter(*machine.value)
            texts = batch.column("text")
            with no_cycles():
                n_tokens = counter.counts(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.compute.cast(pa.compute.binary_length(texts), pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(n_tokens > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select(F.col("doc_id"), text_or_empty(docs).alias("text")).mapInArrow(count, schema)
