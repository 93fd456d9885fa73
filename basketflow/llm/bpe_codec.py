"""Byte-level BPE encoding and decoding by a trie of words.

A batch's distinct words go into a trie of their bytes.  A depth-first walk passes
the last token of each prefix downwards: the encoding of a node's prefix ends in
the one token (ending there) that stays apart from the last token of the node
where it begins.  Words that share a prefix share the nodes, so the prefix is
encoded once; a word's tokens are read off by going back from its node.

The pass is narrow: no text is shuffled.  Memory is bounded by the longest text,
the text chunk of a batch (4 MiB) and the bound of the memo.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm import bpe
from basketflow.llm.common import no_cycles, one_machine, text_chunks, text_or_empty

#: Distinct words whose tokens a worker remembers.
MEMO = 300_000
BEYOND = re.compile(r"[^\x00-\xff]")


class TrieEncoder:
    """Words to token ids of a merge table."""

    def __init__(self, table: bpe.MergeTable):
        self.table = table

    def encode(self, words: list[str]) -> dict[str, list[int]]:
        """The ids of each of the distinct ``words``.

        A trie node is a dict of its children by symbol; the word that ends there
        is under "".  The state handed down is the chain of the prefix's tokens,
        last first, and with it each end of the prefix that may go on to be a
        token, with the chain before that end.
        """
        root: dict = {}
        symbols = self.table.word
        for word in words:
            node = root
            for symbol in symbols(word):
                child = node.get(symbol)
                if child is None:
                    child = node[symbol] = {}
                node = child
            node[""] = word
        encoded: dict[str, list[int]] = {}
        beginnings, follows, ids = self.table.beginnings, self.table.follows, self.table.id
        stack: list[tuple[dict, list]] = [(root, [("", None)])]
        while stack:
            node, going = stack.pop()
            for symbol, child in node.items():
                if not symbol:
                    found, chain_ = [], going[-1][1]
                    while chain_ is not None:
                        found.append(ids[chain_[0]])
                        chain_ = chain_[1]
                    encoded[child] = found[::-1]
                    continue
                own, longer_ends = None, []
                for end, before in going:
                    longer = end + symbol
                    known = beginnings.get(longer)
                    if known is None:
                        continue
                    token, open_ended = known
                    if own is None and token is not None and (before is None or follows(before[0], token)):
                        own = token, before
                    if open_ended:
                        longer_ends.append((longer, before))
                longer_ends.append(("", own))
                stack.append((child, longer_ends))
        return encoded


class Codec:
    """Texts to ids and back, as the library does."""

    def __init__(self, content: bytes, patterns: tuple[str, str]):
        self.table = bpe.MergeTable(content)
        self.trie = TrieEncoder(self.table)
        self.narrow, self.wide = map(re.compile, patterns)
        self.bytes_of = self.table.bytes_of_id
        self.memo: dict[str, list[int]] = {}

    def pieces(self, text: str) -> list[str]:
        find = (self.wide if BEYOND.search(text) else self.narrow).findall
        special = self.table.special_pattern
        if special is None or not any(name in text for name in self.table.special):
            return find(text)
        found = [[part] if i % 2 else find(part) for i, part in enumerate(special.split(text))]
        return list(chain.from_iterable(found))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        memo.update((name, [i]) for name, i in self.table.special.items())
        with no_cycles():
            pieces = [self.pieces(text) for text in texts]
            memo.update(self.trie.encode(list(set(chain.from_iterable(pieces)).difference(memo))))
        for own in pieces:
            yield list(chain.from_iterable(map(memo.__getitem__, own)))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(1)
def piece_patterns() -> tuple[str, str]:
    """The byte-level splitting pattern, with the library's classes of characters.

    Twice: for texts of code points below 256, and for any text.
    """
    classes = bpe.character_classes()

    def pattern(classes) -> str:
        space, letter, number = (bpe.class_pattern(classes, kind) for kind in range(3))
        return (
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
            f"|[{space}]+(?![^{space}])|[{space}]+"
        )

    return pattern(classes[:256]), pattern(classes)


@one_machine
def _codec(content: bytes, patterns: tuple[str, str]) -> Codec:
    return Codec(content, patterns)


def _broadcast(docs: DataFrame, tokenizer: str):
    return docs.sparkSession.sparkContext.broadcast((bpe.load(tokenizer), piece_patterns()))


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int), one row for each row of ``docs``.

    Null and empty texts have no ids.  Special strings inside a text become their
    ids; nothing is added around it.  Other columns are not read.
    """
    machine = _broadcast(docs, tokenizer)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            ids = _codec(*machine.value).encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(ids), pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id"), text_or_empty(docs).alias("text"))
    return rows.mapInArrow(encoded, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``text`` from ``ids``; null ids give an empty text."""
    machine = _broadcast(encoded, tokenizer)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codec = _codec(*machine.value)
            texts = [codec.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of the ids of each text and of the text decoded from them.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``, one row for each row
    of ``docs``, copies included.  Encodes and decodes in one pass, so that the ids
    of the corpus are never stored.
    """
    machine = _broadcast(docs, tokenizer)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            codec = _codec(*machine.value)
            n_tokens, of_ids, of_text = [], [], []
            for ids in codec.encode(batch.column("text").to_pylist()):
                n_tokens.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest())
            columns = [batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(of_ids), pa.array(of_text)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id"), text_or_empty(docs).alias("text")).mapInArrow(digests, schema)
