"""Tokens, pieces, places, and how close the packing comes to the bound."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsegrain.llm import packing
from pulsegrain.llm.common import stored

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "İSTANBUL ΣΑΣ ﬁ x\x1cy", "don't they've I'LL 'd", "a b c", "é é É", "<|endoftext|> x<|startoftext|>",
       "1234 a1b2 !!?? ---", "日本語 テキスト", "🙂🙂 ok", "x\x85y", "ÀÖØ ß ÿ Ÿ ŒŒ", "µ ª º"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(tokenizer, text):
    assert np.frombuffer(packing.WordIds(PATH).ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(docs, out, tokenizer, capacity):
    """Pieces by brute force, gapless places, no sequence too long."""
    want = []
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(d, k, a, len(ids[a:a + capacity]), zlib.crc32(ids[a:a + capacity].tobytes())) for k, a in enumerate(range(0, len(ids), capacity))]
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, *[x or 0 for x in r]))
    assert order([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out]) == order(want)
    at: dict = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= capacity
    return len(at), sum(at.values())


def test_documents_in_sequences(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    n, total = check([(r.doc_id, r.text) for r in docs.collect()], packing.pack_documents(docs, PATH).collect(), tokenizer, 4096)
    assert n <= -(-total // 4096) + 1


def test_odd_rows_and_shards(spark, documents, tokenizer):
    rows = [(None, "a b"), (1, None), (1, None), (2, "word " * 30_000), *[(7, "same text")] * 300, *[(100 + i, t) for i, t in enumerate(ODD)]]
    out = packing.pack_documents(documents(rows), PATH, 64, shard_pieces=100, islands=3, epochs=2).collect()
    n, total = check(rows, out, tokenizer, 64)
    assert n <= -(-total // 64) + 2


@pytest.mark.parametrize("fan", [64, 3])
def test_many_shards_cost_no_sequences(spark, tokenizer, fan):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = stored(packing.tokenise(docs, PATH), "test-pieces")
    out = packing.pack(pieces, shard_pieces=-(-pieces.count() // 20), fan=fan, loose=4).collect()
    n, total = check([(r.doc_id, r.text) for r in docs.collect()], out, tokenizer, 4096)
    assert {r.sequence_id >> 56 for r in out} >= {0, 1} and n <= -(-total // 4096) + 2


def test_evolution_on_islands_beats_best_fit(spark):
    """Lengths between a quarter and a half of the capacity, where best fit leaves gaps that no piece is short enough for."""
    rng = np.random.default_rng(5)
    lengths = rng.integers(1024, 2048, 600).tolist()
    pieces = stored(spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], packing.TOKENISED), "test-pieces")
    out = packing.pack(pieces, epochs=3, generations=150).collect()
    assert sorted(r.length for r in out) == sorted(lengths)
    alone = packing.first_individual(np.array(lengths, np.int32), 4096, rng, 0.0)
    assert len({r.sequence_id for r in out}) < alone.max() + 1


def test_loose_bins_are_the_least_filled():
    lengths, bins = np.array([9, 1, 5, 5, 3], np.int32), np.array([0, 0, 1, 2, 3])
    assert packing.loose_pieces(lengths, bins, 2).tolist() == [False, False, False, True, True]
    assert packing.loose_pieces(lengths, bins, 0).sum() == 0 and packing.loose_pieces(lengths, bins, 9).all()


def test_no_documents(spark, documents):
    assert packing.pack_documents(documents([]), PATH).count() == 0


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 60, 200).astype(np.int32)
    one, two = (packing.first_individual(lengths, 100, rng, j) for j in (0.0, 0.8))
    for _ in range(20):
        child = packing.crossover(lengths, one, two, 100, rng)
        fill = np.bincount(child, lengths)
        assert child.min() >= 0 and fill.max() <= 100 and (np.bincount(child) > 0).all()
        one, two = two, child


def test_evolution_is_no_worse_than_best_fit():
    rng = np.random.default_rng(3)
    lengths = rng.integers(20, 70, 120).astype(np.int32)
    first = packing.first_individual(lengths, 100, rng, 0.0)
    best = packing.evolve(lengths, [first], 100, 60, rng, 6)[0]
    assert packing.fitness(lengths, best, 100) <= packing.fitness(lengths, first, 100)
    assert np.bincount(best, lengths).max() <= 100
