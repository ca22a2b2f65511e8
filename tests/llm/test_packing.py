import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from granary.llm.packing import ChunkEncoder, default_tokenizer, pack, plan_sequences, price, solve_patterns


def test_encoder_gives_the_tokenizers_ids(prose):
    encoder, whole = ChunkEncoder(default_tokenizer(), 50), Tokenizer.from_file(default_tokenizer())
    texts = [*prose(20, 1), "", "Café ÉCOLE ΣΑΣ", "<|endoftext|> x", "a\x1cb It's 'S ²½Ⅷ", "İ ß ẞ", "é x", "😀 12ab,don't", "﻿a\u0085b"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


class Counting(dict):
    looked_up = 0

    def __getitem__(self, key):
        self.looked_up += 1
        return super().__getitem__(key)


def test_encoder_looks_up_each_chunk_of_a_lot_once():
    encoder, whole = ChunkEncoder(default_tokenizer(), 50), Tokenizer.from_file(default_tokenizer())
    encoder.known = Counting()
    texts = [" Some words, again\xa0and again. " * 50, "", " ", "\x85words12 \u037e \u0374 \u212b", "again"] * 4
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert encoder.known.looked_up < 40 and encoder.encode([]) == []


def test_pricing_is_the_best_knapsack():
    value, pattern = price(np.array([0.3, 0.5, 0.8]), np.array([3, 5, 7]), 16)
    assert value == pytest.approx(0.8 * 2) or value >= 1.6
    assert (pattern * [3, 5, 7]).sum() <= 16


def test_program_reaches_the_material_bound():
    sizes, demand = np.array([3, 5, 8]), np.array([40.0, 40.0, 40.0])
    columns, uses = solve_patterns(sizes, demand, 16, 500)
    assert (columns * sizes[:, None]).sum(0).max() <= 16
    assert np.allclose(columns @ uses, demand) and uses.sum() == pytest.approx(40, abs=0.1)


@pytest.mark.parametrize("histogram", [{}, {1: 1}, {256: 3}, {1: 1000, 100: 7, 129: 5, 255: 2}, {k: k % 7 + 1 for k in range(1, 257)}])
def test_plan_places_each_piece_once_within_capacity(histogram):
    fill, placed = {}, {}
    for size, first, end, each, sequence in plan_sequences(histogram, 256):
        assert first == placed.get(size, 0)
        placed[size] = end
        for rank in range(end - first):
            at = sequence + rank // each
            fill[at] = fill.get(at, 0) + size
    assert placed == histogram and all(v <= 256 for v in fill.values())
    assert sorted(fill) == list(range(len(fill)))


def test_pieces_round_trip_with_odd_rows(make, odd, prose):
    texts = odd + list(enumerate(prose(60, 2), 10))
    rows = pack(make(texts)).collect()
    whole, by_doc, by_sequence = Tokenizer.from_file(default_tokenizer()), {}, {}
    ids = {k: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for k, t in texts}
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(own.tobytes()) == r.ids_crc32 and len(own) == r.length and r.doc_tokens == len(ids[r.doc_id])
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc == {k: len(v) * (2 if k == 7 else 1) for k, v in ids.items()}
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_table_and_extra_columns(make, spark):
    assert pack(make({})).count() == 0
    clash = make({1: "a b"}).selectExpr("doc_id", "text", "1 AS units", "2 AS salt", "3 AS start", "4 AS rank")
    assert pack(clash).select("start", "length").collect() == [(0, 3)]
