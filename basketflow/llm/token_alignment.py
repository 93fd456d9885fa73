"""Alignment of the tokens of two tokenizers over the same texts.

Both tokenizers encode the whole text.  Where a token of each ends at the same byte
and the next token of each begins with a space, there is an anchor: the text falls
into windows of token ids between anchors, mostly words.  What a window's alignment is
follows from its ids alone, so it is worked out once for each pair of id tuples and
remembered; a document's alignment is the alignments of its windows in order.

Where no token of either can lie across a single space between two words, as for byte-level
BPE beside a BPE of pieces that begin with spaces, all of that follows from the words alone:
each is encoded and aligned once, many new ones at a time, and remembered by its text.

One pass over the texts stores each document's links as counts of id pairs.  How many
documents hold a pair is a sum over these, made per task before the shuffle.  Its
table is as large as the pairs that the vocabularies form, not the corpus; up to a
bound it is broadcast and looked up in place, beyond it joined.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from sentencepiece import sentencepiece_model_pb2
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm import bpe, bpe_codec
from basketflow.llm.common import no_cycles, one_machine, stored, text_chunks, text_or_empty

#: Windows and words that a worker remembers, and the longest of them in tokens.
MEMO, MEMO_TOKENS = 100_000, 64
#: Characters of texts whose new words are encoded and aligned at a time, about.
LEARNT = 50_000
#: Characters of a text beyond which it is split into words first.
SPLIT_BEYOND = 100_000
#: Links of a group that are listed; those of larger ones are counted by ids.
FEW_LINKS = 256
#: Pairs of ids whose counts are broadcast (17 bytes each); more are joined.
BROADCAST_PAIRS = 4_000_000

#: Fixed value: the sign for a space in pieces.
SPACE_SIGN = "▁"
#: A single space between words: none that stands beside white space.
BETWEEN_WORDS = re.compile(r" (?<=[^\s▁] )(?=[^\s▁])")
ACROSS = re.compile(r"[^\s▁]▁")
OUTER_SPACE = re.compile(r"^[\s▁]|[\s▁]$")


#: Of a window: groups as ``a1,a2|b1;a3|b2``, how many, how many links, the pairs of ids
#: of the links one by one (64-bit numbers as bytes), and those of large groups counted.
Alignment = tuple[str, int, int, bytes, Counter | None]


class Aligned(NamedTuple):
    """Of a text: the same, with each pair of ids once and how many links it has."""

    groups: str
    n_groups: int
    n_links: int
    pairs: np.ndarray
    times: np.ndarray


#: Of a word: how many tokens by both tokenizers, and its alignment.
Word = tuple[int, int, str, int, int, bytes, Counter | None]


class Sides(NamedTuple):
    """A tokenizer's tokens: their bytes, how many, and if they begin with a space."""

    tokens: list[bytes]
    sizes: np.ndarray
    marked: np.ndarray


def sides(tokens: list[bytes]) -> Sides:
    return Sides(tokens, np.array(list(map(len, tokens)), np.int64), np.array([t.startswith(b" ") for t in tokens], bool))


def piece_bytes(model: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE_SIGN, " ").encode()


def ends_at_spaces(content: bytes) -> bool:
    """Whether a model's pieces of any text end before each single space between words.

    Merges can't lead across such a place if no piece does, and what is on one side of it
    has no part in the merges of the other.
    """
    model = sentencepiece_model_pb2.ModelProto.FromString(content)
    how, trained = model.normalizer_spec, model.trainer_spec
    as_written = not (how.precompiled_charsmap or how.remove_extra_whitespaces or trained.treat_whitespace_as_suffix)
    spaced = how.add_dummy_prefix and how.escape_whitespaces and trained.model_type == trained.BPE
    return as_written and spaced and not any(ACROSS.search(p.piece) for p in model.pieces)


class ByteEncoder:
    """Texts to token ids of a byte-level BPE, special strings as ordinary text.

    The fast encoder merges neighbours whose joint text is the token of the lowest
    rank, and does not know which two tokens a rule joins.  If merging yields every token
    for its own text, that is the same: what has become of a token's text when its
    rule's turn comes depends on nothing around it, so the two neighbours are those of
    the rule.  For other vocabularies a word's tokens are a proposal; they are its encoding
    exactly if each neighbouring pair stays apart (``bpe.MergeTable.apart``), else the
    word is encoded by the rules themselves.
    """

    def __init__(self, content: bytes, patterns: tuple[str, str]):
        self.table = bpe.MergeTable(content)
        self.narrow, self.wide = map(re.compile, patterns)
        known = self.table.bytes_of_id
        ranks = {known[i]: number for number, i in enumerate(self.table.id)}
        fast = lambda pattern: tiktoken.Encoding("fast", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.narrow_text, self.wide_text, self.proposer = fast(patterns[0]), fast(patterns[1]), fast(r"(?s:.+)")
        self.sound = frozenset(self.table.tokens.values())
        self.exact = len(self.sound) == len(self.table.text)
        self.rules = bpe_codec.TrieEncoder(self.table)
        self.ids = np.array(self.table.id, np.int32)
        self.memo: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        numbers, follows = self.proposer.encode_ordinary(word), self.table.follows
        if self.exact or (self.sound.issuperset(numbers) and all(map(follows, numbers, numbers[1:]))):
            return [self.table.id[n] for n in numbers]
        return self.rules.encode([word])[word]

    def by_words(self, text: str) -> list[int]:
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        words = (self.wide if bpe_codec.BEYOND.search(text) else self.narrow).findall(text)
        for word in set(words).difference(memo):
            memo[word] = self.word(word)
        return list(chain.from_iterable(map(memo.__getitem__, words)))

    def encode(self, text: str) -> np.ndarray:
        # The fast encoder's own splitting is recursive, so long texts are split here.
        if not self.exact or len(text) > SPLIT_BEYOND:
            return np.array(self.by_words(text), np.int32)
        encoder = self.wide_text if bpe_codec.BEYOND.search(text) else self.narrow_text
        return self.ids[np.array(encoder.encode_ordinary(text), np.int64)]


class Aligner:
    def __init__(self, a_json: bytes, patterns: tuple[str, str], b_model: bytes):
        self.a = ByteEncoder(a_json, patterns)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        known = self.a.table.bytes_of_id
        self.of_a = sides([known.get(i, b"") for i in range(max(known) + 1)])
        self.of_b = sides([piece_bytes(self.b, i) for i in range(self.b.vocab_size())])
        # Ids as they are shown within a part of a group, at the end of its A part, and of its B part.
        ids = range(max(len(self.of_a.tokens), len(self.of_b.tokens)))
        self.shown = [f"{i}{after}" for after in ",|;" for i in ids]
        self.memo: dict[tuple[bytes, bytes], Alignment] = {}
        self.by_words = ends_at_spaces(b_model)
        # Words met lately, and those met before them.
        self.known: dict[str, Word | None] = {}
        self.earlier: dict[str, Word | None] = {}

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of each text by both tokenizers; None where they don't give its bytes back."""
        for text, ids in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            raw = " " + text
            content, a, b = raw.encode(), self.a.encode(raw), np.array(ids, np.int32)
            same = text and all(
                b"".join(map(side.tokens.__getitem__, of)) == content for side, of in ((self.of_a, a.tolist()), (self.of_b, ids))
            )
            yield (a, b) if same else None

    def shared(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens of ``a`` and of ``b`` there are up to each byte at which both end."""
        ends_a, ends_b = np.cumsum(self.of_a.sizes[a]), np.cumsum(self.of_b.sizes[b])
        ending = np.zeros(int(ends_b[-1]) + 1, bool)
        ending[ends_b] = True
        in_a = np.flatnonzero(ending[ends_a])
        return in_a + 1, np.searchsorted(ends_b, ends_a[in_a]) + 1

    def worked_out(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> Callable[[int, int], Alignment]:
        """The alignment of any run of a text's groups, given where these end in ``a`` and in ``b``.

        The parts of all groups are laid out in order once; a run is a slice of them.
        """
        width = len(self.of_b.tokens)
        sizes_a, sizes_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        # Tokens in the order of the text's groups, those of a group's A first, with what comes after each.
        places_a = np.arange(len(a)) + np.repeat(ends_b - sizes_b, sizes_a)
        places_b = np.arange(len(b)) + np.repeat(ends_a, sizes_b)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[places_a], codes[places_b] = a, b
        codes[places_a[ends_a - 1]] += len(self.shown) // 3
        codes[places_b[ends_b - 1]] += 2 * (len(self.shown) // 3)
        parts = list(map(self.shown.__getitem__, codes.tolist()))
        until = [0, *(ends_a + ends_b).tolist()]
        # All links of a group: each of its A tokens before each of its B tokens.
        each = sizes_a * sizes_b
        few = each <= FEW_LINKS
        listed = np.where(few, each, 0)
        of = np.repeat(np.arange(len(each)), listed)
        within = np.arange(len(of)) - np.repeat(np.cumsum(listed) - listed, listed)
        one = a[(ends_a - sizes_a)[of] + within // sizes_b[of]].astype(np.int64)
        links = (one * width + b[(ends_b - sizes_b)[of] + within % sizes_b[of]]).tobytes()
        links_until, all_until = [0, *(8 * np.cumsum(listed)).tolist()], [0, *np.cumsum(each).tolist()]
        large = np.flatnonzero(~few).tolist()

        def run(first: int, last: int) -> Alignment:
            counted = None
            for group in large[bisect_left(large, first) : bisect_left(large, last)]:
                counted = counted or Counter()
                others = Counter(b[ends_b[group] - sizes_b[group] : ends_b[group]].tolist())
                own = Counter(a[ends_a[group] - sizes_a[group] : ends_a[group]].tolist())
                for x, times in own.items():
                    counted.update({x * width + y: times * more for y, more in others.items()})
            text = "".join(parts[until[first] : until[last]])[:-1]
            found = links[links_until[first] : links_until[last]]
            return text, last - first, all_until[last] - all_until[first], found, counted

        return run

    def align(self, a: np.ndarray, b: np.ndarray) -> Aligned:
        """The alignment of a text by its windows."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        ends_a, ends_b = self.shared(a, b)
        # A group ends an anchor's window if the tokens after it begin with a space, or the text ends.
        after = self.of_a.marked[a[ends_a[:-1]]] & self.of_b.marked[b[ends_b[:-1]]]
        last = np.append(np.flatnonzero(after), len(ends_a) - 1)
        cuts_a, cuts_b = ((4 * ends[last]).tolist() for ends in (ends_a, ends_b))
        raw_a, raw_b = a.tobytes(), b.tobytes()
        # The id tuples, as bytes.
        windows = [
            (raw_a[i:x], raw_b[j:y]) for i, x, j, y in zip([0, *cuts_a], cuts_a, [0, *cuts_b], cuts_b, strict=False)
        ]
        memo = self.memo
        found = list(map(memo.get, windows))
        if None in found:
            run, cuts = self.worked_out(a, b, ends_a, ends_b), [0, *(last + 1).tolist()]
            for n, known in enumerate(found):
                if known is None:
                    found[n] = known = run(cuts[n], cuts[n + 1])
                    if len(windows[n][0]) + len(windows[n][1]) <= 4 * MEMO_TOKENS:
                        memo[windows[n]] = known
        return joined(found)

    def words(self, text: str) -> list[str]:
        """The text at its single spaces between words; whole where tokens may lie across."""
        if not self.by_words:
            return [text]
        return BETWEEN_WORDS.split(text)

    def encoded(self, words: list[str]) -> list[Word | None]:
        """Each word, with the space before it; None if either tokenizer changes it.

        More than one are encoded as a text of them, so none of them may begin or end with a space.
        """
        raw = "".join(f" {word}" for word in words)
        both = next(self.tokens([raw[1:]]))
        if both is not None:
            a, b = both
            ends_a, ends_b = self.shared(a, b)
            ends = np.cumsum([len(word.encode()) + 1 for word in words])
            shared = np.cumsum(self.of_a.sizes[a])[ends_a - 1]
            last = np.minimum(np.searchsorted(shared, ends), len(shared) - 1)
            if np.array_equal(shared[last], ends):
                run, cuts = self.worked_out(a, b, ends_a, ends_b), [0, *(last + 1).tolist()]
                n_a, n_b = (np.diff(e[last], prepend=0).tolist() for e in (ends_a, ends_b))
                return [(x, y, *run(i, j)) for x, y, i, j in zip(n_a, n_b, cuts, cuts[1:], strict=False)]
        return [None] if len(words) == 1 else [self.encoded([word])[0] for word in words]

    def learn(self, words: set[str]) -> None:
        plain, size = [], 0
        for word in words:
            if not word or OUTER_SPACE.search(word):
                self.known[word] = self.encoded([word])[0]
                continue
            plain.append(word)
            size += len(word)
            if size > LEARNT:
                self.known.update(zip(plain, self.encoded(plain), strict=True))
                plain, size = [], 0
        if plain:
            self.known.update(zip(plain, self.encoded(plain), strict=True))

    def aligned(self, texts: list[str]) -> Iterator[tuple[int, int, Aligned] | None]:
        """Of each text: its tokens by both tokenizers and its alignment; None as in ``tokens``."""
        at = 0
        while at < len(texts):
            size, first = 0, at
            while at < len(texts) and (at == first or size + len(texts[at]) <= LEARNT):
                size += len(texts[at])
                at += 1
            own = [self.words(text) for text in texts[first:at]]
            if len(self.known) > MEMO // 2:
                self.known, self.earlier = {}, self.known
            new = set(chain.from_iterable(own)).difference(self.known)
            again = new.intersection(self.earlier)
            self.known.update((word, self.earlier[word]) for word in again)
            self.learn(new := new - again)
            for text, words in zip(texts[first:at], own, strict=True):
                yield self.of_words(text, words)
            for word in new:
                if (kept := self.known[word]) is None or kept[0] + kept[1] > MEMO_TOKENS:
                    del self.known[word]

    def of_words(self, text: str, words: list[str]) -> tuple[int, int, Aligned] | None:
        found = list(map(self.known.__getitem__, words))
        if text and None not in found:
            n_a, n_b, *alignments = zip(*found, strict=True)
            return sum(n_a), sum(n_b), of_parts(*alignments)
        # A word alone is changed, so all that counts is the text.
        ids = next(self.tokens([text]))
        return ids and (len(ids[0]), len(ids[1]), self.align(*ids))


def joined(found: list[Alignment]) -> Aligned:
    """The alignment of a text, given those of its windows in order."""
    return of_parts(*zip(*found, strict=True))


def of_parts(groups: tuple, n_groups: tuple, n_links: tuple, links: tuple, many: tuple) -> Aligned:
    pairs, times = np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)
    if any(many):
        counted = Counter(dict(zip(pairs.tolist(), times.tolist(), strict=True)))
        for own in filter(None, many):
            counted.update(own)
        pairs, times = (np.array(list(x), np.int64) for x in (counted.keys(), counted.values()))
    return Aligned(";".join(groups), sum(n_groups), sum(n_links), pairs, times)


@one_machine
def _aligner(a_json: bytes, patterns: tuple[str, str], b_model: bytes) -> Aligner:
    return Aligner(a_json, patterns, b_model)


def parts_of(a_file: str, b_file: str) -> tuple[bytes, tuple[str, str], bytes]:
    """What an ``Aligner`` is made of."""
    with open(b_file, "rb") as b:
        return bpe.load(a_file), bpe_codec.piece_patterns(), b.read()


def alignments(docs: DataFrame, a_file: str, b_file: str, groups: bool = False) -> DataFrame:
    """The alignment of each text's tokens by ``a_file`` (byte-level BPE, .json) and ``b_file`` (.model).

    Returns ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``, one row
    for each row of ``docs``, and with ``groups`` their text.  ``pairs`` are the linked id
    pairs (``a * vocabulary of b + b``), each once, ``times`` how many links are between
    them.  Null and empty texts, and texts that either tokenizer changes, have no tokens.
    """
    parts = parts_of(a_file, b_file)
    machine = docs.sparkSession.sparkContext.broadcast(parts)
    n_pairs = len(_aligner(*parts).of_a.tokens) * len(_aligner(*parts).of_b.tokens)
    number = "int" if n_pairs < 2**31 else "long"
    kinds = {"int": np.int32, "long": np.int64}
    nothing = np.empty(0, np.int64)
    empty = Aligned("", 0, 0, nothing, nothing)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*machine.value)
        for batch in text_chunks(batches, "text"):
            sizes, found, digests = [], [], []
            with no_cycles():
                for whole in aligner.aligned(batch.column("text").to_pylist()):
                    n_a, n_b, own = whole or (0, 0, empty)
                    sizes.append((n_a, n_b))
                    digests.append(hashlib.sha256(own.groups.encode()).hexdigest() if whole else "")
                    found.append(own if groups else own._replace(groups=""))
            offsets = pa.array(np.cumsum([0, *(len(x.pairs) for x in found)]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([nothing, *values]).astype(kind)))
                for values, kind in (((x.pairs for x in found), kinds[number]), ((x.times for x in found), np.int64))
            ]
            counts = [[s[0] for s in sizes], [s[1] for s in sizes], [x.n_groups for x in found], [x.n_links for x in found]]
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), *lists]
            columns += [pa.array([x.groups for x in found], pa.string())] * groups
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", *["groups"] * groups]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        f"pairs array<{number}>, times array<long>{', groups string' * groups}"
    )
    return docs.select(F.col("doc_id"), text_or_empty(docs).alias("text")).mapInArrow(aligned, schema)


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``pair, docs, best``: the documents that hold each pair, and if no other pair of its A id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    of_a = Window.partitionBy(F.expr(f"pair div {n_b}"))
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(of_a))


def scored(aligned: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` (a stored table) with ``n_best`` and ``count_sum`` of its links, without the lists."""
    if counts.count() <= broadcast_pairs:
        return _looked_up(aligned, counts)
    kept = [name for name in aligned.columns if name not in ("pairs", "times")]
    rows = stored(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned-rows")
    links = rows.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("_row", "link.*")
    sums = (
        links.join(counts, links["pairs"] == counts["pair"])
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
        )
    )
    return rows.join(sums, "_row", "left").select(
        *kept, F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum")
    )


def _looked_up(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same, with the counts in each task."""
    table = counts.select("pair", "docs", "best").toArrow().combine_chunks()
    keys, docs, best = (table.column(name).to_numpy() for name in ("pair", "docs", "best"))
    order = np.argsort(keys)
    known = aligned.sparkSession.sparkContext.broadcast((keys[order], docs[order].astype(np.int64), best[order].astype(bool)))
    kept = [name for name in aligned.columns if name not in ("pairs", "times")]

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, best = known.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(keys, pairs.flatten().to_numpy())
            bounds = np.cumsum([0, *pairs.value_lengths().to_pylist()])
            sums = [np.concatenate([[0], np.cumsum(values)]) for values in (times * best[at], times * docs[at])]
            columns = [batch.column(name) for name in kept]
            columns += [pa.array(s[bounds[1:]] - s[bounds[:-1]], pa.int64()) for s in sums]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_best", "count_sum"])

    fields = ", ".join(f"{name} {aligned.schema[name].dataType.simpleString()}" for name in kept)
    return aligned.mapInArrow(looked_up, f"{fields}, n_best long, count_sum long")


def aligned_documents(docs: DataFrame, a_file: str, b_file: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Each text's alignment and how its links rank in the corpus.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``,
    one row for each row of ``docs``; repeated rows are documents of their own.  Texts
    without tokens (null, empty, or changed by a tokenizer) have zeros and ``''``.
    Very long texts are aligned whole.  An empty table gives no rows.  Columns other
    than ``doc_id`` and ``text`` are not read.
    """
    aligned = stored(alignments(docs, a_file, b_file), "aligned")
    counts = stored(pair_counts(aligned, sentencepiece.SentencePieceProcessor(model_file=b_file).vocab_size()), "pair-counts")
    return scored(aligned, counts, broadcast_pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
