import random
import re

import numpy as np
import pyarrow as pa
import pytest

from granary.llm.components import connected_components
from granary.llm.decontamination import Benchmark, allowed_edits, best_match, decontaminate, find_leaks
from granary.llm.jaccard_join import _squeeze, _unsqueeze, near_duplicates, parity, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups(texts):
    sets = {}
    for k, t in texts:
        w = WORD.findall((t or "").lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((k, len(sets[k]), find(k)) for k, _ in texts)


def edited(text, n, draw):
    words = text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = "".join(draw.choices("xyz", k=9))
    return " ".join(words)


@pytest.mark.parametrize("frequent_from", [2, 5, 32])
def test_components_equal_brute_force(make, odd, prose, frequent_from):
    draw = random.Random(5)
    texts = list(odd) + list(enumerate(prose(15, 6), 20)) + [(60 + k, t) for k, t in enumerate(["a b c d", "A b  c d", "a b c d e", "x y"])]
    base, passage = prose(2, 7, words=150)
    texts += [(100 + k, edited(base, draw.randrange(7), draw)) for k in range(60)]
    texts += [(200 + k, edited(t, 0, draw) + " " + passage) for k, t in enumerate(prose(20, 8, words=60))]
    texts += [(300 + k, t) for k, t in enumerate([base] * 12)]
    got = near_duplicates(make(texts), frequent_from=frequent_from).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == groups(texts)


def test_join_of_empty_table(make):
    assert near_duplicates(make({})).count() == 0


def test_signatures_meet_for_similar_sets():
    rng = np.random.default_rng(1)
    for n in (1, 4, 30, 63, 64, 70, 200, 700):
        for _ in range(20):
            one = np.unique(rng.integers(0, 2**64, n, np.uint64))
            frequent = np.unique(rng.choice(one, max(1, n * 9 // 10)) >> np.uint64(24))
            lose = int(rng.integers(0, n // 9 + 1))
            two = np.unique(np.r_[rng.permutation(one)[lose:], rng.integers(0, 2**64, lose, np.uint64)])
            if 100 * len(np.intersect1d(one, two)) >= 80 * len(np.union1d(one, two)):
                a, b = (np.concatenate([k for k, _, _ in signatures(s, frequent, np.ones(len(frequent)), 7)[1]]) for s in (one, two))
                assert len(np.intersect1d(a, b))
                assert np.bitwise_count((parity(one) ^ parity(two)).view(np.uint64)).sum() <= len(np.setxor1d(one, two))


def test_packed_tokens_round_trip():
    values = np.unique(np.random.default_rng(2).integers(0, 2**48, 500, np.uint64))
    assert (_unsqueeze(_squeeze(values, 6), len(values), 6, np.uint64) == values).all()


def test_connected_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (20, 20), (3, 1)] + [(k, k + 1) for k in range(100, 140)]
    got = {r.id: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6} | {k: 100 for k in range(100, 141)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_best_match_is_edit_distance():
    draw = random.Random(3)
    for _ in range(300):
        a, b = ([draw.randrange(4) for _ in range(draw.randrange(low, 14))] for low in (1, 0))
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        assert best_match(a, b, 99) == (min(row), row.index(min(row)))


def test_recall_of_edited_passages():
    draw, rng = random.Random(4), np.random.default_rng(4)
    items = [rng.integers(1, 2**62, n).astype(np.uint64) for n in rng.integers(10, 60, 60)]
    bench, docs = Benchmark(list(range(60)), items, 0.2, 4, 10, 5), []
    for item in items:
        words = item.tolist()
        for _ in range(draw.randint(0, allowed_edits(len(words), 0.2))):
            words[draw.randrange(len(words))] = draw.getrandbits(61)
        docs.append(rng.integers(1, 2**62, 80).tolist() + words + rng.integers(1, 2**62, 80).tolist())
    found = bench.search(pa.array(docs, pa.list_(pa.int64())))
    expected = [best_match(i.tolist(), d, allowed_edits(len(i), 0.2)) for i, d in zip(items, docs, strict=True)]
    hits = sum(any(leak[0] == k and leak[1] == e[0] for leak in own) for k, (own, e) in enumerate(zip(found, expected, strict=True)))
    assert all(expected) and hits >= 57
    assert sum(map(len, found)) <= 60


@pytest.mark.parametrize("kind", ["substitute", "insert", "delete"])
@pytest.mark.parametrize("place", [0.0, 0.5, 1.0])
def test_recall_of_gathered_edits(kind, place):
    draw, rng = random.Random(8), np.random.default_rng(8)
    items = [rng.integers(1, 2**62, n).astype(np.uint64) for n in [16, 25, 31, 40, 55, 60, 63, 64, 100, 300] * 4]
    bench, docs = Benchmark(list(range(40)), items, 0.2, 4, 10, 5), []
    for item in items:
        most, words = allowed_edits(len(item), 0.2), item.tolist()
        at = int(place * (len(item) - most))
        new = [] if kind == "delete" else [draw.getrandbits(61) for _ in range(most)]
        words[at : at + (0 if kind == "insert" else most)] = new
        docs.append(rng.integers(1, 2**62, 80).tolist() + words + rng.integers(1, 2**62, 80).tolist())
    found = bench.search(pa.array(docs, pa.list_(pa.int64())))
    assert sum([leak[0] for leak in own] == [k] for k, own in enumerate(found)) >= 39


def test_leaks(make, odd, prose, spark):
    items = prose(6, 9, words=30)
    table = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(6, None), (7, ""), (8, "two words")], "item_id long, text string")
    docs = list(odd) + [(20 + k, t) for k, t in enumerate(prose(10, 10))] + [(40 + k, f"before {t.upper()} after") for k, t in enumerate(items)]
    docs += [(50, "some Two words here"), (51, "two of words"), (52, items[0] * 2)]
    got = {(r.doc_id, r.item_id): (r.distance, r.first_word) for r in find_leaks(make(docs), table).collect()}
    assert {(40 + k, k) for k in range(6)} | {(50, 8), (52, 0)} == set(got) and got[40, 0] == (0, 1)
    kept = decontaminate(make(docs), table)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, _ in docs if k not in {*range(40, 46), 50, 52})
    assert kept.columns == make(docs).columns
    assert find_leaks(make(docs), table.limit(0)).count() == 0 and find_leaks(make({}), table).count() == 0
    assert {(r.doc_id, r.item_id) for r in find_leaks(make(docs), table, block_words=60).collect()} == set(got)


def test_leaks_with_other_ids_and_clashing_columns(make, prose, spark):
    items = prose(2, 9, words=30)
    table = spark.createDataFrame([("a", items[0]), ("a", items[0]), ("b", items[1])], "item_id string, text string")
    docs = make([(1, items[0]), (1, items[0]), (2, "x " * 20_000 + items[1])]).selectExpr("doc_id", "text", "1 AS _word_hashes", "2 AS _h", "3 AS `_H_`")
    assert sorted((r.doc_id, r.item_id) for r in find_leaks(docs, table).collect()) == [(1, "a"), (1, "a"), (2, "b")]
    kept = decontaminate(docs, table.filter("item_id = 'a'"))
    assert kept.columns == docs.columns and [r[:1] + r[2:] for r in map(tuple, kept.collect())] == [(2, 1, 2, 3)]
