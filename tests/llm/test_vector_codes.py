import hashlib
import math
import random

import numpy as np
import pytest

from granary.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label string, points int, trees string, code int"


def points(n, seed, kind):
    draw = np.random.default_rng(seed)
    if kind == "spread":
        return draw.integers(-900, 900, (n, 4))
    if kind == "groups":
        return draw.integers(-900, 900, (7, 4))[draw.integers(0, 7, n)] + draw.integers(-20, 20, (n, 4))
    if kind == "ties":
        return draw.integers(0, 3, (n, 4))
    if kind == "far":
        return np.where(draw.random((n, 4)) < 0.01, 10**6, 0) + draw.integers(0, 3, (n, 4))
    return np.repeat(draw.integers(-9, 9, (1, 4)), n, 0)


def loaded(tree, width=4):
    record = {k: np.array(v, np.int64) for k, v in tree.record().items()}
    return record | {k: record[k].reshape(-1, width) for k in ("centre", "total")}


@pytest.mark.parametrize("kind", ["spread", "groups", "ties", "far", "equal"])
@pytest.mark.parametrize("n", [1, 33, 700])
def test_tree_finds_the_nearest_entries(kind, n):
    x = points(n, n, kind)
    tree = loaded(V.Tree(x))
    assert sorted(tree["order"].tolist()) == list(range(n))
    for k in range(len(tree["start"])):
        inside = x[tree["order"][tree["start"][k] : tree["end"][k]]]
        assert inside.sum(0).tolist() == tree["total"][k].tolist() and ((inside - tree["centre"][k]) ** 2).sum(1).max() == tree["radius"][k]
        if tree["left"][k] >= 0:
            a, b = tree["left"][k], tree["right"][k]
            assert (tree["start"][k], tree["end"][a], tree["end"][k]) == (tree["start"][a], tree["start"][b], tree["end"][b])
    for seed in range(4):
        draw = np.random.default_rng(seed)
        entries = x[draw.integers(0, n, 9)] + draw.integers(0, 2, (9, 4))  # some are equal
        near = ((x[:, None] - entries) ** 2).sum(-1).argmin(1)
        assert V.assigned(tree, x, entries).tolist() == near.tolist()
        sums, counts = V.summed(tree, x, entries)
        assert counts.tolist() == np.bincount(near, minlength=9).tolist()
        assert sums.tolist() == [x[near == k].sum(0).tolist() for k in range(9)]


def test_balls_of_groups_are_owned_whole():
    x = points(2000, 5, "groups")
    tree, entries = loaded(V.Tree(x)), x[np.unique(x // 60, axis=0, return_index=True)[1]][:12]
    balls, _, rows, _ = V.owners(tree, x, entries)
    assert len(rows) < 1000 and (tree["end"][balls] - tree["start"][balls]).max() > 32


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * c) for c in v], y) for i, v, y in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max([1, *(-(-len(v) // parts) for _, v, _ in kept)])
    x = np.array([v + [0] * (parts * width - len(v)) for _, v, _ in kept], object).reshape(-1, parts, width)
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0], x[k].ravel().tolist()))[:entries]
    books = np.array([x[k] for k in order]).reshape(-1, parts, width).transpose(1, 0, 2)
    for step in range(rounds + 1):
        gap = ((x[:, :, None] - books[None]) ** 2).sum(-1)
        near = np.array([[min(range(len(order)), key=lambda e: (g[e], e)) for g in row] for row in gap])
        for p in range(parts) if step < rounds else ():
            for e in range(len(order)):
                own = x[near[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(0) // len(own)
    error = [int(sum(gap[k, p, near[k, p]] for p in range(parts))) for k in range(len(kept))]
    by = {}
    for k, (_, _, y) in enumerate(kept):
        by[y] = by.get(y, 0) + error[k]
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    return sorted((i if i is not None else -99, "".join(f"{e:02x}" for e in near[k]), error[k], by[y], digest) for k, (i, _, y) in enumerate(kept))


def compressed(spark, rows, **more):
    df = spark.createDataFrame([(i, v, y, 1, "t", 2) for i, v, y in rows], SCHEMA)
    return sorted((-99 if r[0] is None else r[0], *r[1:]) for r in map(tuple, V.compress_vectors(df, **more).collect()))


def test_equals_the_definition_whatever_the_lots(spark):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(16)], draw.choice(["a", "b", None])) for i in range(300)]
    rows = [(i, np.float32(v).tolist(), y) for i, v, y in rows]
    expected = brute(rows)
    assert compressed(spark, rows) == expected
    assert compressed(spark, rows, lot_values=200) == expected


def test_odd_rows(spark):
    rows = [(i % 9, [i % 3 / 4, -0.5, 0.25, i % 5 / 8], "x") for i in range(60)]
    rows += [(100, None, "x"), (101, [0.5, None], "x"), (102, [float("nan")], "x"), (103, [float("-inf")], None)]
    rows += [(104, [], None), (None, [0.5], "y"), (105, [0.125] * 9, None)] + [(7, [0.5] * 4, "z")] * 50
    assert compressed(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    assert compressed(spark, []) == []
    assert compressed(spark, [(1, None, "x")]) == []
    few = [(1, [0.5] * 8, "x"), (2, [0.5] * 8, "x"), (3, [-0.5] * 8, "y")]
    assert compressed(spark, few) == brute(few)
    with pytest.raises(OverflowError):
        compressed(spark, [(1, [1e12], "x")])
