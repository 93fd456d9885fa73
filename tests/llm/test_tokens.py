"""Token counts and BPE encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketflow.llm import bpe, bpe_codec, token_counts
from basketflow.llm.queries import COUNTING_TOKENIZER, ENCODING_TOKENIZER, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COUNTING, ENCODING = map(public_tokenizers.path, (COUNTING_TOKENIZER, ENCODING_TOKENIZER))


def odd_texts() -> list[str]:
    rng = random.Random(5)
    letters = "ab'srtvemld 012.!,\n\t éßΣσİ漢字न́<|endoftext|>🙂\x00\x85　"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    points = [(32, 0x3000), (0x4E00, 0xD7FF), (0x10000, 0x1FFFF)]
    texts += ["".join(chr(rng.randrange(*rng.choice(points))) for _ in range(30)) for _ in range(200)]
    texts += ["a" * n for n in (1, 2, 3, 100, 5000)] + ["ha" * 700, "", " ", "'" * 50, "abᲉΣΑΣ"]
    texts += ["<|startoftext|>x<|endoftext|>", "they'RE 'll'S ''s 're''ve '", " <|endoftext|> <|endoftext|", "x" * 127 + "'r"]
    texts += [" ".join("".join(rng.choice("thean") for _ in range(9)) for _ in range(3000))]
    return texts


def documents(spark, texts):
    rows = [(i, t, "extra") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n_tokens STRING")


def test_counts_equal_the_library(spark):
    texts = [*odd_texts(), None]
    library = Tokenizer.from_file(COUNTING)
    found = {r.doc_id: r for r in token_counts.token_counts(documents(spark, texts), COUNTING, 100).collect()}
    for i, text in enumerate(texts):
        expected = len(library.encode(text or "", add_special_tokens=False).ids)
        row = found[i]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((text or "").encode()), expected, expected > 100), text


def test_chunks_do_not_matter(monkeypatch):
    content = bpe.load(COUNTING)
    counter = token_counts.Counter(content, *token_counts._unicode_tables(content))
    texts = odd_texts()
    whole = counter.counts(texts).tolist()
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(token_counts, "CHUNK", size)
        assert counter.counts(texts).tolist() == whole
    monkeypatch.setattr(token_counts, "STATES", 10)
    monkeypatch.setattr(token_counts, "MEMO", 3)
    assert [int(counter.counts([t])[0]) for t in texts] == whole


def test_ids_equal_the_library_and_come_back(spark):
    texts = [*odd_texts(), None]
    library = Tokenizer.from_file(ENCODING)
    docs = documents(spark, texts)
    encoded = bpe_codec.encode(docs, ENCODING)
    found = {r.doc_id: r.ids for r in encoded.collect()}
    decoded = {r.doc_id: r.text for r in bpe_codec.decode(encoded, ENCODING).collect()}
    digests = {r.doc_id: r for r in bpe_codec.round_trip(docs, ENCODING).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[i] == ids
        assert decoded[i] == library.decode(ids, skip_special_tokens=False) == (text or "")
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_decoding_ids_that_are_no_text():
    library, codec = Tokenizer.from_file(ENCODING), bpe_codec.Codec(bpe.load(ENCODING), bpe_codec.piece_patterns())
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(6))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("path", [COUNTING, ENCODING])
def test_pairs_stay_apart_as_the_library_says(path):
    table, library = bpe.MergeTable(bpe.load(path)), Tokenizer.from_file(path)
    shown = {b: c for c, b in bpe.byte_characters().items()}
    rng = random.Random(1)
    inner = [t for t in table.tokens if not any(ord(c) > 255 for c in t)]
    last = [t for t in table.tokens if ord(t[-1]) > 255] or inner
    repeated = [t for t in inner if len(set(t)) == 1]
    for n in range(4000):
        a, b = (rng.choice(repeated), rng.choice(repeated + last[:50])) if n % 4 == 0 else (rng.choice(inner), rng.choice(last))
        if table.end and ord(b[-1]) < 256:
            continue
        word = "".join(shown[ord(c) & 255] for c in a + b)
        ids = [t.id for t in library.model.tokenize(word)]
        expected = ids == [table.id[table.number[a]], table.id[table.number[b]]]
        assert table.apart(table.number[a], table.number[b]) == expected, (a, b)


@pytest.mark.parametrize("name", ["op1_token_counts", "op2_bpe_round_trip"])
def test_queries_over_whole_tables(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    path = {"op1_token_counts": COUNTING, "op2_bpe_round_trip": ENCODING}[name]
    library = Tokenizer.from_file(path)
    found = {r.doc_id: r.n_tokens for r in QUERIES[name](spark, SF_DIR).collect()}
    assert found == {d.doc_id: len(library.encode(d.text, add_special_tokens=False).ids) for d in docs}


def test_empty_table(spark):
    none = documents(spark, [])
    assert token_counts.token_counts(none, COUNTING).count() == 0
    assert bpe_codec.round_trip(none, ENCODING).count() == 0
