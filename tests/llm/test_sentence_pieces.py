import hashlib
import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from granary.llm import sentence_pieces as S

TEXTS = [
    "", " ", "  a  b ", "Hello  world", "a▁b", "中文😀\x00x", "<s>a</s> <0x41>", "\n\n a", "x�y", "é é", "▁", "▁▁▁ ▁", " " * 1000,
    "a" * 3000, "İ ß​ 👩‍👩‍👧", "tab\tand\r\nlines", "x" * 60 + " " + "antidisestablishmentarianism" * 3,
]


@pytest.fixture(scope="module")
def vocabulary():
    return S.PieceVocabulary(S.default_model(), 1000)


def test_ids_and_texts_are_the_librarys(vocabulary, prose):
    draw = random.Random(3)
    mixed = ["".join(draw.choices("aethino rs\n▁.é中😀\t ", k=draw.randint(0, 80))) for _ in range(400)]
    ids, decoded = S.encode_lot(vocabulary, [*TEXTS, *mixed, *prose(10, 4)], whole_texts=True)  # raises on a difference
    assert decoded[3] == TEXTS[3] and len(ids) == len(decoded)


def test_heap_and_rows_of_ranks_agree(vocabulary, prose):
    parts = sorted({p for t in prose(5, 5) for p in vocabulary.cuts.findall(vocabulary.normalize(t))} | {"▁" * 40, "aaaaaaa", "éé中中x"})
    vocabulary.merge_all(parts)
    assert {p: np.frombuffer(vocabulary.known[p], np.int32).tolist() for p in parts} == {p: list(vocabulary.merge(p)) for p in parts}


def slow_merge(vocabulary, text):
    """The definition: join the neighbours of best score, the leftmost of equal ones, until none make a piece."""
    symbols = list(vocabulary.normalize(text))
    while pairs := [(-vocabulary.score[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in vocabulary.score]:
        i = min(pairs)[1]
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
    return [k for s in symbols for k in ([vocabulary.ids[s]] if s in vocabulary.ids else [vocabulary.bytes[b] for b in s.encode()])]


def test_whole_texts_equal_the_slow_definition(vocabulary, prose):
    texts = [*TEXTS[:12], *prose(4, 6, 40)]
    assert [ids.tolist() for ids in vocabulary.encode(texts)] == [slow_merge(vocabulary, t) for t in texts]


@pytest.mark.parametrize("ids", [[], [1, 2], [0], [0, 259], [259], [198], [230, 130], [231, 187, 10, 264], [264, 1, 287]])
def test_any_ids_decode_as_in_the_library(vocabulary, ids):
    assert vocabulary.decode(np.array(ids, np.int32)) == SentencePieceProcessor(model_file=S.default_model()).decode(ids)


def test_table_with_odd_rows(make, odd):
    docs = make(odd).selectExpr("doc_id", "text", "1 AS ids", "'x' AS decoded", "2 AS n_tokens")
    library = SentencePieceProcessor(model_file=S.default_model())
    encoded = S.encode_pieces(docs, remember=5)
    assert sorted((r.doc_id, r.ids, r.decoded) for r in encoded.collect()) == sorted((k, library.encode(t or ""), library.decode(library.encode(t or ""))) for k, t in odd)
    for r in S.piece_digests(encoded).collect():
        ids = library.encode(dict(odd)[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert S.encode_pieces(make({})).count() == 0


def test_a_wrong_id_is_an_error(monkeypatch, vocabulary):
    own = S.PieceVocabulary(S.default_model(), 1000)
    merge = own.rows.merge
    monkeypatch.setattr(own.rows, "merge", lambda parts: ((at, symbols[:, ::-1].copy()) for at, symbols in merge(parts)))
    with pytest.raises(ValueError, match="differ"):
        S.encode_lot(own, ["Hello, antidisestablishment"])
    monkeypatch.setattr(vocabulary, "encode", lambda texts: [np.array([5]) for _ in texts])
    with pytest.raises(ValueError, match="differ"):
        S.encode_lot(vocabulary, ["Hello"], whole_texts=True)


@pytest.mark.parametrize("text", ["▁", " ", "\n", "\n\n x", "x\n\ny", "é\x00é  b", "<s>"])
def test_cuts_are_checked_wherever_they_stand(text):
    own = S.PieceVocabulary(S.default_model(), 1000)
    S.encode_lot(own, [text, "a " + text, text + " a", text * 3], whole_texts=True)
    own.check(list(own.known))
