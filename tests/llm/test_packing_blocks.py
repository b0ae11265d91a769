"""Packing encodes large blocks: batches are put together, bags are sorted together, words are merged once."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from citecube.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_small_batches_are_encoded_together_and_large_ones_apart():
    texts = ["a" * n for n in (3, 4, 2, 0, 9, 30, 1, 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t])], ["text"]) for t in texts]
    found = [b.column("text").to_pylist() for b in packing.gathered(batches, "text", 10)]
    assert [[len(t) for t in b] for b in found] == [[3, 4, 2, 0], [9], [30], [1, 1]]
    assert list(packing.gathered([], "text", 10)) == []


def test_bags_of_a_block_are_those_of_its_documents():
    rng = np.random.default_rng(5)
    for dtype in ("<u2", "<u4"):
        for most in (50, 900):           # counts of one byte only, and of four as well
            docs = [rng.integers(0, 3, n).astype(dtype) for n in rng.integers(1, most, 40)]
            length, terms, counts = packing.bags_of(pa.array([d.tobytes() for d in docs], pa.binary()), np.dtype(dtype))
            want = list(map(packing.bag, docs))
            assert length.to_pylist() == list(map(len, docs))
            assert terms.to_pylist() == [b.terms.tobytes() for b in want]
            assert counts.to_pylist() == [packing.count_bytes(b.counts) for b in want]
    assert [len(x) for x in packing.bags_of(pa.array([], pa.binary()), np.dtype("<u2"))] == [0, 0, 0]


def test_words_are_merged_once_and_full_caches_change_nothing(monkeypatch):
    texts = ["some words, some Wörds again", "again other words", "", "日本 words", "some other newcomers again"] * 3
    inner = Tokenizer.from_file(PATH)
    want = [np.array([*inner.encode(t, add_special_tokens=False).ids, 2], "<u2").tobytes() for t in texts]
    for most in (packing.WORDS, 2, 0):
        monkeypatch.setattr(packing, "WORDS", most)
        tok, merged = packing.WordTokenizer(PATH), []
        inner_merged = tok._merged
        tok._merged = lambda pieces: merged.extend(pieces) or inner_merged(pieces)
        for _ in range(2):
            assert tok.encode_batch(pa.array(texts), 2).to_pylist() == want
        if most > 2:
            assert len(merged) == len(set(merged))
