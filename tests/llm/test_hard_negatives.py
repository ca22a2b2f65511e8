import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm.hard_negatives import Best, mine_hard_negatives, packed, unpacked

SCHEMA = "vec_id long, embedding array<float>, label int, score string, role int, id int"


def brute(rows, scale=256):
    """The definition over (vec_id, vector, label), each different row once."""
    kept = {(i, tuple(math.floor(scale * x) for x in v), y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in kept:
        if a[0] % 5:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a[1], b[1], strict=False)), b[0], b[2]) for b in kept if b != a)
        for s, i, _ in [x for x in scored if x[2] == a[2]][:5]:
            fits = [x for x in scored if x[2] != a[2] and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(a[0], i, k + 1, x[1], -s, -x[0]) for k, x in enumerate(fits[:3])]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, v, y, "s", 1, 2) for i, v, y in rows], SCHEMA)
    return sorted(map(tuple, mine_hard_negatives(df, F.col("vec_id") % 5 == 0, **more).collect()))


def random_rows(n, seed, step=64):
    """Few different components, so that scores tie."""
    draw = random.Random(seed)
    return [(i, [draw.randint(-2, 3) / step for _ in range(6)], draw.randint(0, 3)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_definition_whatever_the_blocks(spark, seed):
    rows = random_rows(150, seed)
    expected = brute(rows)
    assert len(expected) > 50
    assert mined(spark, rows) == expected
    assert mined(spark, rows, block_rows=2, block_values=20) == expected


def test_odd_rows(spark):
    rows = random_rows(40, 3)
    rows += rows[:20]  # repeated rows
    rows += [(5, [0.5] * 6, 1), (5, [0.25] * 6, 1), (None, [0.1] * 6, 1), (10, None, 1), (15, [0.1, None], 1), (20, [float("nan")] * 6, 1)]
    rows += [(25, [float("inf")] * 6, 2), (30, [0.1] * 6, None), (35, [], 2), (45, [0.0] * 6, 1), (46, [0.0] * 6, 2), (50, [0.5, 0.5], 3)]
    assert mined(spark, rows) == brute(rows)


def test_tables_without_a_result(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(5, [0.5], 1)]) == []
    assert mined(spark, [(5, [0.5], 1), (6, [0.5], 1)]) == []
    assert mined(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []


def test_large_scores_are_exact_or_an_error(spark):
    big = [(5, [3e5, 1.0], 1), (6, [3e5, 1.0], 1), (7, [2e5, 3.0], 2), (8, [2e5, 4.0], 2)]
    assert mined(spark, big) == brute(big)
    with pytest.raises(OverflowError):
        mined(spark, [(5, [1e15, 1e15], 1), (6, [1e15, 1.0], 1)])


def test_pairs_sort_by_anchor_falling_score_kind_and_id():
    draw = random.Random(4)
    pairs = [(draw.choice([-3, 0, 7]), 1, draw.choice([-(2**50), -1, 0, 5]), draw.random() < 0.5, draw.randint(-2, 2), draw.randint(-9, 9)) for _ in range(300)]
    keys = []
    for p in pairs:
        one = [np.array([x]) for x in p]
        keys.append((packed(one[0], one[1], one[2], p[3], one[4], one[5])[0].as_py(), p))
    assert [p for _, p in sorted(keys)] == sorted(pairs, key=lambda p: (p[0], p[1], -p[2], p[3], p[4], p[5]))
    a, k, s, _, i, key = (np.array(c) for c in zip(*pairs, strict=True))
    found = unpacked(packed(a, k, s, True, i, key))
    assert found["score"].tolist() == s.tolist() and found["anchor"].tolist() == a.tolist() and found["id"].tolist() == i.tolist()


def test_best_rows_over_many_lots():
    draw, best, seen = random.Random(5), Best(3, 4), []
    for _ in range(20):
        lot = [(draw.randint(0, 2), draw.randint(-3, 3), draw.randint(0, 9), draw.randint(0, 99)) for _ in range(30)]
        seen += lot
        best.add(*(np.array(c) for c in zip(*lot, strict=True)))
    for slot in range(3):
        expected = sorted((-s, i, k) for x, s, i, k in seen if x == slot)[:4]
        assert list(zip((-best.score[slot]).tolist(), best.id[slot].tolist(), best.key[slot].tolist(), strict=True)) == expected
