"""Token alignment against plain loops over whole texts."""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers

from basketflow.llm import token_alignment
from basketflow.llm.queries import op12_token_alignment

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_of() -> dict[str, int]:
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Plain:
    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(A_FILE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
        alphabet = byte_of()
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in json.load(open(A_FILE))["model"]["vocab"].items() if t != "<|endoftext|>"}

    def b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes.fromhex(piece[3:5]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(self.a_bytes[i] for i in a) != raw or b"".join(map(self.b_bytes, b)) != raw:
            return []
        found, own, at_a, at_b, b = [], ([], []), 0, 0, list(b)
        for i in a:
            own[0].append(i)
            at_a += len(self.a_bytes[i])
            while at_b < at_a:
                own[1].append(b[0])
                at_b += len(self.b_bytes(b.pop(0)))
            if at_a == at_b:
                found.append(own)
                own = ([], [])
        return found


def expected(rows: list[tuple]) -> Counter:
    plain = Plain()
    groups = [plain.groups(text) for _, text in rows]
    links = [Counter((x, y) for xs, ys in of for x in xs for y in ys) for of in groups]
    docs = Counter(pair for own in links for pair in own)
    highest = defaultdict(int)
    for (x, _), n in docs.items():
        highest[x] = max(highest[x], n)
    found = Counter()
    for (doc_id, _), of, own in zip(rows, groups, links, strict=True):
        shown = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in of)
        found[
            doc_id, sum(len(x) for x, _ in of), sum(len(y) for _, y in of), len(of), sum(own.values()),
            sum(n for pair, n in own.items() if docs[pair] == highest[pair[0]]),
            sum(n * docs[pair] for pair, n in own.items()),
            sha256(shown.encode()).hexdigest() if of else "",
        ] += 1
    return found


def found(df) -> Counter:
    assert df.columns == NAMES
    return Counter(tuple(r) for r in df.collect())


def odd_rows() -> list[tuple]:
    rng = random.Random(11)
    alphabets = ["abc ", "aé ü", "日本 語", "a▁ b", " \n\t", "0123 .", "<|endoftext|> ", "🙂🏽 x", " a　b", "é ﬁ"]
    rows = [(i, "".join(rng.choices(rng.choice(alphabets), k=rng.randrange(60)))) for i in range(300)]
    rows += [(1, None), (None, "no id at all"), (2, ""), (3, " "), (4, "  two  blanks "), (5, "<s> </s> <|endoftext|>")]
    rows += [(6, "twice the same"), (6, "twice the same"), (7, "a" * 5_000), (8, "word " * 20_000), (9, "\x00 nul")]
    return rows


def test_query_equals_plain_loops(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    verdicts = found(op12_token_alignment(spark, sf_dir))
    assert verdicts == expected(rows)
    assert sum(v[3] for v in verdicts) > 1000


@pytest.mark.parametrize("broadcast_pairs", [token_alignment.BROADCAST_PAIRS, 0])
def test_odd_rows_looked_up_and_joined(spark, broadcast_pairs):
    rows = odd_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, `pairs` string, `a.b` int")
    assert found(token_alignment.aligned_documents(docs.repartition(4), A_FILE, B_FILE, broadcast_pairs)) == expected(rows)


@pytest.mark.parametrize("broadcast_pairs", [token_alignment.BROADCAST_PAIRS, 0])
def test_empty_table(spark, broadcast_pairs):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert found(token_alignment.aligned_documents(docs, A_FILE, B_FILE, broadcast_pairs)) == Counter()


def test_groups_are_returned(spark):
    rows = [(1, "some words, and more"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = Plain()
    for row in token_alignment.alignments(docs, A_FILE, B_FILE, groups=True).collect():
        groups = plain.groups(dict(rows)[row["doc_id"]])
        assert row["groups"] == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        assert sum(row["times"]) == row["n_links"]


def test_windows_are_remembered_by_their_ids():
    aligner = token_alignment.Aligner(*token_alignment.parts_of(A_FILE, B_FILE))
    texts = ["the cat and the dog", "the dog and the cat"]
    first, second = (aligner.align(*ids) for ids in aligner.tokens(texts))
    assert len(aligner.memo) == 4  # " the" and its like once, whatever stands beside them
    assert first.pairs.tolist() == second.pairs.tolist() and first.groups != second.groups
    assert all(isinstance(key, bytes) and len(np.frombuffer(key, np.int32)) for ids in aligner.memo for key in ids)
    aligner.memo.clear()
    assert aligner.align(*next(aligner.tokens(texts[:1]))).groups == first.groups


def test_words_are_encoded_as_the_library_does():
    """Also those for which the fast proposal is wrong: each is checked, and encoded by the rules."""
    aligner = token_alignment.Aligner(*token_alignment.parts_of(A_FILE, B_FILE))
    library = tokenizers.Tokenizer.from_file(A_FILE)
    library.encode_special_tokens = True
    rng = random.Random(2)
    known = [library.decode([i]) for i in range(300, 50_000, 7)]
    texts = ["".join(rng.choices(known, k=rng.randrange(1, 5))) for _ in range(4_000)]
    texts += [t for _, t in odd_rows() if t]
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = aligner.a
    assert encoder.exact
    assert [encoder.encode(t).tolist() for t in texts] == wanted
    assert [encoder.by_words(t) for t in texts] == wanted
    encoder.exact, proposed = False, encoder.proposer.encode_ordinary
    encoder.memo.clear()
    assert [encoder.by_words(t) for t in texts] == wanted
    encoder.memo.clear()
    encoder.proposer = type("Worse", (), {"encode_ordinary": lambda self, w: list(w.encode()) if rng.random() < 0.5 else proposed(w)})()
    assert [encoder.encode(t).tolist() for t in texts] == wanted


def test_words_are_encoded_once_and_aligned_as_whole_texts(monkeypatch):
    monkeypatch.setattr(token_alignment, "MEMO", 40)
    monkeypatch.setattr(token_alignment, "LEARNT", 300)
    aligner = token_alignment.Aligner(*token_alignment.parts_of(A_FILE, B_FILE))
    assert aligner.by_words
    rng = random.Random(5)
    parts = ["don't", "naïve", "日本", "x", "42", "end.\nNext", "\n", "", "\t", "a▁b", "▁", "<s>", "　", "\x1c", "🙂", "z" * 300, "'s", "  "]
    texts = [" ".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(600)] + [t or "" for _, t in odd_rows()]
    for text, ids, whole in zip(texts, aligner.tokens(texts), aligner.aligned(texts), strict=True):
        if ids is None:
            assert whole is None, text
            continue
        n_a, n_b, own = whole
        alone = aligner.align(*ids)
        assert (n_a, n_b) == (len(ids[0]), len(ids[1])), text
        assert own[:3] == alone[:3], text
        assert dict(zip(own.pairs.tolist(), own.times.tolist())) == dict(zip(alone.pairs.tolist(), alone.times.tolist()))

    class Counted:
        def __init__(self, model):
            self.model, self.characters = model, 0

        def encode(self, texts, **how):
            self.characters += sum(map(len, texts))
            return self.model.encode(texts, **how)

    aligner.b = counted = Counted(aligner.b)
    aligner.known.clear()
    aligner.earlier.clear()
    text = "some words and more of some words"
    assert len({w for a in aligner.aligned([text] * 5) for w in a[2].groups.split(";")}) >= 5
    assert counted.characters == len("some words and more of")
