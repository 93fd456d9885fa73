"""What Python workers hold after their work."""

from __future__ import annotations

from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa

from basketflow.llm import bpe, bpe_codec, common, minhash_join


def test_workers_keep_no_words_and_tokens_for_other_work():
    codec = bpe_codec._codec(bpe.load(public_tokenizers.path("byte_bpe_50k.json")), bpe_codec.piece_patterns())
    assert list(codec.encode(["some words"])) and common._MACHINE
    # What a task runs in its worker.
    task = minhash_join.sketches(SimpleNamespace(mapInArrow=lambda run, schema: run), 5)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words of a text", ""]})
    found = pa.Table.from_batches(task(iter([batch])))
    assert found.column("n_shingles").to_pylist() == [1, 0]
    assert not minhash_join.WORD_HASHES and not common._MACHINE


def test_one_machine_at_a_time():
    made = []
    make = common.one_machine(lambda x: made.append(x) or [x])
    other = common.one_machine(lambda x: [x, x])
    assert make(1) is make(1) and made == [1]
    assert other(1) == [1, 1] and len(common._MACHINE) == 1
    assert make(1) == [1] and made == [1, 1]
    common.without_machine()
    assert not common._MACHINE
