"""Hard negatives by a secondary sort: rows that score close to an anchor's positives and bear another label.

Scores are integer inner products. Anchors and rows are dealt into blocks, and
every block of rows meets every block of anchors. A pair that can matter is
packed into a key (anchor, descending score, positives before negatives, id);
``repartition`` by the anchor and ``sortWithinPartitions`` by the key, which is
Spark's repartitionAndSortWithinPartitions for a DataFrame, bring an anchor's
pairs together in that order. A streaming iterator then reads them once: the
first positives open windows of scores, and the negatives that fall into an open
window leave as its result until it is full. It holds five windows, never an
anchor's pairs.

Pairs are not all sent. A first sort finds each anchor's positives, of which a
block of rows has sent its best few; then the windows are known, and a block
sends for each window only the rows that are among the block's own first few in
it. What a block holds back can't be in the result, so nothing is lost, and the
shuffle grows with anchors times blocks and not with pairs.

Blocks hold a bounded number of values. Anchors come first in their block by a
sort, rows stream after them, so a task keeps one block of anchors and one lot
of rows, whatever the table's size.

Defined cases: rows without an id or label, without a vector, or with a missing
or non-finite component take no part. A row that repeats another's id, label and
vector counts once; rows that share an id alone are rows of their own, ordered by
a hash. A vector shorter than others counts as ending in zeros. An empty table,
and an anchor without positives or without fitting negatives, give no rows.
Scores beyond a long's hundredth raise an error. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm.common import discard, in_lots, materialize, ship

#: A pair as bytes whose order is that of the pairs: numbers with the larger end first and the sign turned.
PAIR = np.dtype([("anchor", ">u8"), ("anchor_key", ">u8"), ("falling", ">u8"), ("negative", "u1"), ("id", ">u8"), ("key", ">u8")])
_SIGN = np.uint64(1 << 63)
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _turned(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.int64).astype(np.uint64) ^ _SIGN


def packed(anchor: np.ndarray, anchor_key: np.ndarray, score: np.ndarray, negative: bool, ids: np.ndarray, key: np.ndarray) -> pa.Array:
    """Sortable keys, one for each pair."""
    out = np.zeros(len(ids), PAIR)
    out["anchor"], out["anchor_key"], out["falling"] = _turned(anchor), _turned(anchor_key), ~_turned(score)
    out["negative"], out["id"], out["key"] = negative, _turned(ids), _turned(key)
    offsets = np.arange(len(out) + 1, dtype=np.int32) * PAIR.itemsize
    return pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(offsets), pa.py_buffer(out.tobytes())])


def unpacked(keys: pa.Array) -> dict[str, np.ndarray]:
    rows = np.frombuffer(b"".join(keys.to_pylist()), PAIR)
    found = {c: (rows[c].astype(np.uint64) ^ _SIGN).astype(np.int64) for c in ("anchor", "anchor_key", "id", "key")}
    return found | {"score": (~rows["falling"].astype(np.uint64) ^ _SIGN).astype(np.int64), "negative": rows["negative"]}


class Best:
    """The first few rows of each slot so far: by falling score, then id, then key."""

    def __init__(self, slots: int, keep: int) -> None:
        self.score = np.full((slots, keep), _LEAST)
        self.id, self.key = np.zeros((slots, keep), np.int64), np.zeros((slots, keep), np.int64)
        self.has = np.zeros((slots, keep), bool)

    @property
    def bar(self) -> np.ndarray:
        """The score below which a row can't enter a slot."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, key: np.ndarray) -> None:
        touched = np.unique(slot)
        where = np.nonzero(self.has[touched])
        old = touched[where[0]], where[1]
        slot, score = np.concatenate([old[0], slot]), np.concatenate([self.score[old], score])
        ids, key = np.concatenate([self.id[old], ids]), np.concatenate([self.key[old], key])
        order = np.lexsort((key, ids, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        first = rank < self.score.shape[1]
        at, order = (slot[first], rank[first]), order[first]
        self.score[at], self.id[at], self.key[at], self.has[at] = score[order], ids[order], key[order], True


def _matrix(column: pa.ListArray, width: int, kind: type) -> np.ndarray:
    """Vectors as rows, ended with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width).astype(kind)
    out = np.zeros((len(lengths), width), kind)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


class Positives:
    """Of one block: each anchor's best rows of its own label, itself left out."""

    def __init__(self, anchors: dict[str, np.ndarray], keep: int) -> None:
        self.anchors, self.best = anchors, Best(len(anchors["id"]), keep)

    def meet(self, rows: dict[str, np.ndarray]) -> None:
        a = self.anchors
        score = a["vectors"] @ rows["vectors"].T
        near = (score >= self.best.bar[:, None]) & (a["label"][:, None] == rows["label"])
        i, j = np.nonzero(near)
        other = (a["id"][i] != rows["id"][j]) | (a["key"][i] != rows["key"][j])
        i, j = i[other], j[other]
        if len(i):
            self.best.add(i, score[i, j].astype(np.int64), rows["id"][j], rows["key"][j])

    def pairs(self, first_block: bool) -> Iterator[pa.Array]:
        a, b = self.anchors, self.best
        i, k = np.nonzero(b.has)
        yield packed(a["id"][i], a["key"][i], b.score[i, k], False, b.id[i, k], b.key[i, k])


class Negatives:
    """Of one block: for each window of each anchor the first rows of another label."""

    def __init__(self, anchors: dict[str, np.ndarray], keep: int, low: int, high: int) -> None:
        self.anchors, p = anchors, anchors["scores"]
        self.low = np.where(anchors["known"], -(-low * p // 100), 1)
        self.high = np.where(anchors["known"], high * p // 100, 0)
        self.best = Best(p.size, keep)

    def meet(self, rows: dict[str, np.ndarray]) -> None:
        a, n_windows = self.anchors, self.low.shape[1]
        if not self.low.size:
            return
        real = self.low <= self.high
        least = np.where(real, np.maximum(self.low, self.best.bar.reshape(self.low.shape)), _MOST)
        most = np.where(real, self.high, _LEAST)
        score = a["vectors"] @ rows["vectors"].T
        near = (score >= least.min(1)[:, None]) & (score <= most.max(1)[:, None]) & (a["label"][:, None] != rows["label"])
        i, j = np.nonzero(near)
        s = score[i, j].astype(np.int64)
        for w in range(n_windows):
            fits = (s >= least[i, w]) & (s <= most[i, w])
            if fits.any():
                self.best.add(i[fits] * n_windows + w, s[fits], rows["id"][j[fits]], rows["key"][j[fits]])

    def pairs(self, first_block: bool) -> Iterator[pa.Array]:
        a, b, n_windows = self.anchors, self.best, self.low.shape[1]
        if first_block:  # the positives themselves travel once
            i, w = np.nonzero(a["known"])
            yield packed(a["id"][i], a["key"][i], a["scores"][i, w], False, a["ids"][i, w], a["keys"][i, w])
        slot, k = np.nonzero(b.has)
        found = np.stack([slot // max(n_windows, 1), b.score[slot, k], b.id[slot, k], b.key[slot, k]])
        i, score, ids, key = np.unique(found, axis=1)  # a row may be in several windows
        yield packed(a["id"][i], a["key"][i], score, True, ids, key)


_SEARCHED = "group int, block int, role int, id long, key long, label long, vector array<long>, positives array<struct<score:long,id:long,key:long>>"


def _block(batch: pa.RecordBatch, width: int, kind: type) -> dict[str, np.ndarray]:
    out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key", "label")}
    return out | {"vectors": _matrix(batch.column("vector"), width, kind)}


def _joined(parts: list[pa.RecordBatch], width: int, kind: type, most: int) -> dict[str, np.ndarray]:
    """A block's anchors; of their positives, matrices with a column for each of ``most``."""
    table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    out = _block(table, width, kind)
    own = [p or [] for p in table.column("positives").to_pylist()]
    for name, field in (("scores", "score"), ("ids", "id"), ("keys", "key")):
        out[name] = np.array([[x[field] for x in p] + [0] * (most - len(p)) for p in own], np.int64).reshape(len(own), most)
    return out | {"known": np.arange(most) < np.array([len(p) for p in own])[:, None]}


def _searched(anchors: DataFrame, rows: DataFrame, groups: int, blocks: int, width: int, kind: type, most: int, make) -> DataFrame:
    """(pair) of what each block of rows has for each group of anchors, by the states that ``make`` makes of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, waiting, state = None, [], None

        def done() -> Iterator[pa.RecordBatch]:
            found = state or (make(_joined(waiting, width, kind, most)) if waiting else None)
            for keys in found.pairs(here[1] == 0) if found else ():
                yield pa.RecordBatch.from_arrays([keys], ["pair"])

        for batch in in_lots(batches, 6, rows=512, size=1 << 18):
            place = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
            cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(1)) + 1).tolist(), len(place)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                group, block, role = place[i].tolist()
                if here != (group, block):
                    yield from done()
                    here, waiting, state = (group, block), [], None
                if role == 0:
                    waiting.append(batch.slice(i, j - i))
                elif waiting:
                    state = state or make(_joined(waiting, width, kind, most))
                    state.meet(_block(batch.slice(i, j - i), width, kind))
        yield from done()

    spark = anchors.sparkSession
    own = F.pmod(F.xxhash64("key", "id"), F.lit(groups)).cast("int")
    left = anchors.select(own.alias("group"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("role"), "id", "key", "label", "vector", "positives")
    own = F.pmod(F.xxhash64("id", "key"), F.lit(blocks)).cast("int")
    none = F.lit(None).cast("array<struct<score:long,id:long,key:long>>")
    right = rows.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), own.alias("block"), F.lit(1).alias("role"), "id", "key", "label", "vector", none.alias("positives"))
    both = left.unionByName(right).select(*(f"`{f.name}`" for f in T.StructType.fromDDL(_SEARCHED)))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(groups * blocks, 20_000))
    return both.repartition(tasks, "group", "block").sortWithinPartitions("group", "block", "role").mapInArrow(run, "pair binary")


def _sorted_pairs(pairs: DataFrame) -> DataFrame:
    """Each anchor's pairs in one partition, in the order of their keys."""
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(tasks, F.substring("pair", 1, 16)).sortWithinPartitions("pair")


def first_positives(pairs: DataFrame, most: int) -> DataFrame:
    """(id, key, positives) of each anchor: the first few of its sorted pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own = None, []
        kind = pa.list_(pa.struct([("score", pa.int64()), ("id", pa.int64()), ("key", pa.int64())]))
        for batch in batches:
            p, out = unpacked(batch.column(0)), []
            for anchor, anchor_key, score, i, key in zip(*(p[c].tolist() for c in ("anchor", "anchor_key", "score", "id", "key")), strict=True):
                if here != (anchor, anchor_key):
                    out.append((here, own))
                    here, own = (anchor, anchor_key), []
                if len(own) < most:
                    own.append({"score": score, "id": i, "key": key})
            yield from rows(out, kind)
        yield from rows([(here, own)], kind)

    def rows(found: list, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        found = [(a, own) for a, own in found if a]
        if found:
            ids = [pa.array([a[k] for a, _ in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array([own for _, own in found], kind)], ["id", "key", "positives"])

    return _sorted_pairs(pairs).mapInArrow(run, "id long, key long, positives array<struct<score:long,id:long,key:long>>")


def windowed_negatives(pairs: DataFrame, keep: int, low: int, high: int) -> DataFrame:
    """The result, from sorted pairs: positives open windows, negatives that fall into them leave at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, windows = None, []
        for batch in batches:
            p, out = unpacked(batch.column(0)), []
            for anchor, anchor_key, score, negative, i in zip(*(p[c].tolist() for c in ("anchor", "anchor_key", "score", "negative", "id")), strict=True):
                if here != (anchor, anchor_key):
                    here, windows = (anchor, anchor_key), []
                if not negative:
                    windows.append([i, score, 0])
                    continue
                full = False
                for w in windows:
                    if low * w[1] <= 100 * score <= high * w[1]:
                        w[2] += 1
                        full |= w[2] == keep
                        out.append((anchor, w[0], w[2], i, w[1], score))
                if full:
                    windows = [w for w in windows if w[2] < keep]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return _sorted_pairs(pairs).mapInArrow(run, schema)


def whole_vectors(vectors: DataFrame, vector: str, scale: int) -> tuple[Column, Column]:
    """(the test of a vector without missing or non-finite components, its components times scale, rounded down)."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(finite, F.lit(False)), F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, *, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256, block_rows: int = 500_000, block_values: int = 1 << 17,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor and each of its first ``positives`` other rows of its label: the first ``negatives`` rows of other
    labels whose score is from low to high per cent of the positive's. Labels that are no integers are compared by a hash.
    A group of anchors has at most about ``block_values`` components, a block of rows about ``block_rows`` rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    finite, whole = whole_vectors(vectors, vector, scale)
    kept = vectors.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull() & finite)
    integer = isinstance(vectors.schema[label].dataType, T.IntegralType)
    code = F.col(label).cast("long") if integer else F.xxhash64(label)
    own = kept.select(F.col(id_column).cast("long").alias("id"), code.alias("label"), whole.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = materialize(own.distinct().withColumn("key", F.xxhash64("label", "vector")), "vectors")
    peak = F.max(F.coalesce(F.array_max(F.transform("vector", F.abs)), F.lit(0)))
    seen = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("vector")).alias("width"), peak.alias("peak")).first()
    width = seen["width"] or 1
    largest = (seen["peak"] or 0) ** 2 * width
    if 100 * largest >= _MOST:
        raise OverflowError(f"scores may reach {largest}, beyond a long's hundredth")
    kind = np.float64 if largest < 1 << 53 else np.int64  # sums below 2^53 are exact in either
    per_group = max(1, min(2048, block_values // width))
    groups, blocks = max(1, math.ceil(seen["anchors"] / per_group)), max(64, math.ceil(seen["n"] / block_rows))
    anchors, rows_only = rows.filter("anchor"), rows.select("id", "key", "label", "vector")
    none = F.lit(None).cast("array<struct<score:long,id:long,key:long>>")

    near = _searched(anchors.withColumn("positives", none), rows_only, groups, blocks, width, kind, positives, lambda a: Positives(a, positives))
    known = materialize(first_positives(near, positives), "positives")
    asked = anchors.join(known, ["id", "key"])
    pairs = _searched(asked, rows_only, groups, blocks, width, kind, positives, lambda a: Negatives(a, negatives, low, high))
    out = materialize(windowed_negatives(pairs, negatives, low, high), "negatives")
    discard(rows, known)
    return out
