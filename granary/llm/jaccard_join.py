"""Near-duplicate documents: an exact Jaccard join of word shingle sets.

A document's tokens are the hashes of its distinct shingles, in a global order
that puts frequent tokens last. By the pigeonhole principle two sets that are
similar enough share a signature of their prefixes:

* a rare token by itself, or
* two frequent tokens of the same class. Frequent tokens are dealt into classes,
  and each class of which a prefix holds c tokens can lose one of them before it
  offers no pair, so the prefix is extended until
  ``rare + sum(max(0, c - 1))`` exceeds the number of tokens that may differ.

Short documents index frequent tokens one by one. Which tokens count as frequent
only shapes the order: any choice gives the same links.

Copies are folded into classes first. Classes with a signature in common are
compared with the one among them that has most frequent tokens; small lists are
compared throughout. Where a long list still spans several components, the
members outside its largest component are compared with the rest, after bounds
by length, position and parity bits. All links between different components are found, and no
list is expanded into all its pairs.

Tokens and class ids are 64-bit hashes; sets are compared by 48 bits of them.

Defined cases: a null text or one without words has an empty set, links with
nothing and is its own component; repeated rows are copies; an empty table
gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import ascii_lower, discard, in_lots, materialize, materialize_parts, text_of, words_of
from granary.llm.components import connected_components

_U = np.uint64
#: Lists of up to so many classes are compared throughout.
SHORT_LIST = 6
PARITY_BITS = 10
#: Documents of fewer tokens index frequent tokens one by one.
PAIRS_FROM = 64


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits, as the finalizer of splitmix64 does."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(ascii_lower(text)), lambda w: F.xxhash64(w))


def token_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row's word hashes."""
    ends = column.offsets.to_numpy()
    flat = column.values[ends[0] : ends[-1]].to_numpy(zero_copy_only=False).view(np.uint64)
    ends = ends - ends[0]
    step = _U(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(flat) - width + 1), np.uint64)
        for i in range(width if len(rolled) else 0):
            rolled = rolled * step + flat[i : i + len(rolled)]
        rolled = _mix(rolled)
        out = []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if b - a >= width:
                out.append(np.unique(rolled[a : b - width + 1]))
            elif b > a:  # fewer words than a shingle: the whole sequence
                whole = _U(b - a)
                for w in flat[a:b]:
                    whole = whole * step + w
                out.append(_mix(np.array([whole])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def class_id(tokens: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(_mix(np.array([_mix(tokens ^ _U(0x5851F42D4C957F2D)).sum() + _U(len(tokens))])).view(np.int64)[0])


def parity(tokens: np.ndarray) -> np.ndarray:
    """A bit for each leading PARITY_BITS of a token: whether an odd number of tokens has them.

    Two sets' parities differ in at most as many bits as the sets do in tokens.
    """
    odd = np.bincount((tokens >> _U(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _squeeze(sorted_values: np.ndarray, width: int) -> bytes:
    """Ascending unsigned values as compressed byte planes of their differences."""
    gaps = np.diff(sorted_values, prepend=sorted_values.dtype.type(0))
    planes = gaps.view(np.uint8).reshape(len(gaps), -1)[:, :width].T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unsqueeze(data: bytes, n: int, width: int, kind: type) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    full = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    full[:, :width] = planes.T
    return np.cumsum(full.view(kind).ravel(), dtype=kind)


def classes_and_counts(hashed: DataFrame, width: int, bits: int, flush: int) -> DataFrame:
    """One pass over all texts: a row (doc_id, id, n, parity) for each, and rows of token counts.

    Tokens of the lower half of the hash range are counted, by ``bits`` + 32 of
    their bits; a prefix seldom reaches beyond it. Counts of up to ``flush``
    tokens are summed in the task and sent as one blob for each leading ``bits``.
    """
    kind = hashed.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "id", "n", "parity", "bucket", "m", "low", "many"]
    bits_type = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, id_type = 0, None

        def counted() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            at = np.searchsorted(keys >> _U(32), np.arange((1 << bits) + 1))
            rows = []
            for b, (i, j) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                if j > i:
                    low = (keys[i:j] & _U(0xFFFFFFFF)).astype(np.uint32)
                    rows.append((b, j - i, _squeeze(low, 4), pa.compress(n[i:j].astype("<u4").tobytes(), "zstd", asbytes=True)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            blank = [pa.nulls(len(rows), t) for t in (id_type, pa.int64(), pa.int32(), bits_type)]
            return pa.RecordBatch.from_arrays(blank + [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        for batch in in_lots(batches, 1):
            id_type = batch.column(0).type
            sets = token_sets(batch.column(1), width)
            for s in sets:
                half = s[: int(np.searchsorted(s, _U(1 << 63)))] >> _U(31 - bits)
                held.append(half)
                size += len(half)
            ids = pa.array([class_id(s) for s in sets], pa.int64())
            n = pa.array([len(s) for s in sets], pa.int32())
            odd = pa.array([parity(s) for s in sets], bits_type)
            blank = [pa.nulls(len(sets), t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, n, odd, *blank], names)
            if size > flush:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    schema = "id long, n int, parity array<long>, bucket int, m int, low binary, many binary"
    return hashed.mapInArrow(run, f"doc_id {kind}, {schema}")


def frequent_tokens(counts: DataFrame, least: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and document counts of tokens in ``least`` documents or more, the most frequent, at most ``limit``, by key."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([_unsqueeze(d, m, 4, np.uint32) for d, m in zip(group.low, group.m, strict=True)])
        n = np.concatenate([np.frombuffer(pa.decompress(d, 4 * m, "zstd", asbytes=True), "<u4") for d, m in zip(group.many, group.m, strict=True)])
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        total = np.add.reduceat(n.astype(np.int64), first)
        hot = total >= least
        key = (int(group.bucket.iloc[0]) << 32) + keys[first][hot].astype(np.int64)
        return pd.DataFrame({"key": key, "df": total[hot]})

    found = materialize(counts.groupBy("bucket").applyInPandas(run, "key long, df long"), "frequent")
    # A histogram of document counts, a few hundred rows, tells the least one: the driver gets no more than limit rows.
    level = F.floor(F.log2("df") * 16)
    room, low = limit, math.inf
    for r in sorted(found.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        if r["n"] > room:
            break
        room, low = room - r["n"], r["level"]
    kept = found.filter(level >= F.lit(low)).toPandas().sort_values("key")
    discard(found)
    return kept["key"].to_numpy(np.uint64), kept["df"].to_numpy(float)


def signatures(
    tokens: np.ndarray, frequent: np.ndarray, df: np.ndarray, bits: int
) -> tuple[float, list[tuple[np.ndarray, np.ndarray, np.ndarray | int]]]:
    """How central a set is, and lists (keys, places, slack).

    A set is central that is near the vector of document counts of frequent
    tokens, by cosine. A key's place is that of its first token; slack is the
    number of tokens before it that may be shared without another key.
    """
    n = len(tokens)
    differ = n - -(-4 * n // 5)
    is_frequent, central = np.zeros(n, bool), 0.0
    if len(frequent):
        half = int(np.searchsorted(tokens, _U(1 << 63)))
        keys = tokens[:half] >> _U(31 - bits)
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        is_frequent[:half] = frequent[at] == keys
        central = float(df[at[is_frequent[:half]]].sum() / np.sqrt(n))
    rare, often = tokens[~is_frequent], tokens[is_frequent]
    singles = rare[: differ + 1]
    out = [(singles, np.arange(len(singles)), 0)]
    missing = differ + 1 - len(rare)
    if missing <= 0:
        return central, out
    if n < PAIRS_FROM:
        out.append((often[:missing], len(rare) + np.arange(missing), 0))
    for band in {n.bit_length() - 1, (5 * n // 4).bit_length() - 1}:
        if 1 << band < PAIRS_FROM:
            continue
        classes = (1 << band) // 8
        group = (often >> _U(3)) % _U(classes)
        _, first = np.unique(group, return_index=True)
        gain = np.ones(len(often), int)
        gain[first] = 0
        length = int(np.searchsorted(np.cumsum(gain), missing)) + 1
        part, group = often[:length], group[:length]
        order = np.argsort(group, kind="stable")
        left, right = [], []
        edges = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0, True]) if length else np.zeros(1, int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            i, j = np.triu_indices(b - a, 1)
            left.append(order[a:b][i])
            right.append(order[a:b][j])
        i, j = np.concatenate(left), np.concatenate(right)
        with np.errstate(over="ignore"):
            keys = _mix(part[i] * _U(0xD6E8FEB86659FD93) + _mix(part[j]) + _U(band))
        # Tokens before the pair's first may be shared too, one of each class, the pair's own left out.
        unseen = np.cumsum(gain == 0)[i] - 1
        out.append((keys, len(rare) + i, np.minimum(unseen, classes - 1)))
    return central, out


def postings(hashed: DataFrame, width: int, bits: int, frequent: Any) -> DataFrame:
    """(key, id, n, room, central): room is how many tokens a partner may share from the key's place on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task give the same postings
        names = ["key", "id", "n", "room", "central"]
        for batch in in_lots(batches, 0):
            cols: list[list[np.ndarray]] = [[] for _ in names]
            for tokens in token_sets(batch.column(0), width):
                n = len(tokens)
                if not n or (own := class_id(tokens)) in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(own)
                central, lists = signatures(tokens, *frequent.value, bits)
                for keys, places, slack in lists:
                    cols[0].append(keys.view(np.int64))
                    cols[1].append(np.full(len(keys), own))
                    cols[2].append(np.full(len(keys), n, np.int32))
                    cols[3].append((n - places + slack).astype(np.int32))
                    cols[4].append(np.full(len(keys), central, np.float32))
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names)

    return hashed.select("h").mapInArrow(run, "key long, id long, n int, room int, central float")


def _possible(na: Any, nb: Any, room_a: Any, room_b: Any, least: Any) -> Any:
    """The length and position bounds of a pair with a key in common."""
    return (5 * na >= 4 * nb) & (5 * nb >= 4 * na) & (9 * least(room_a, room_b) >= 4 * (na + nb))


def list_pairs(posted: DataFrame) -> DataFrame:
    """Candidate pairs (a, b), and the members (a, key, n, room; b null) of lists that are not short.

    Rows come by key, a list's pivot first, and stream: no list is held.
    """
    names = ["a", "b", "key", "n", "room"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, open_list = None, False

        def emit(rows: list[np.ndarray], long_first: bool) -> pa.RecordBatch | None:
            key, ids, n, room = rows
            if not len(key):
                return None
            starts = np.r_[True, key[1:] != key[:-1]]
            first = np.flatnonzero(starts)
            sizes = np.diff(np.r_[first, len(key)])
            long_ = sizes > SHORT_LIST
            if long_first:
                long_[0] = True
            pivot = np.repeat(first, sizes)
            is_long = np.repeat(long_, sizes)
            at = np.arange(len(key))
            star = is_long & (at != pivot)
            i, j = [pivot[star]], [at[star]]
            for d in range(1, SHORT_LIST):
                near = at[:-d][(pivot[:-d] == pivot[d:]) & ~is_long[d:]] if len(at) > d else at[:0]
                i.append(near)
                j.append(near + d)
            i, j = np.concatenate(i), np.concatenate(j)
            n64, r64 = n.astype(np.int64), room.astype(np.int64)
            # A pivot is compared whatever its place in the list.
            good = _possible(n64[i], n64[j], r64[i], r64[j], np.minimum) & (ids[i] != ids[j])
            i, j = i[good], j[good]
            member = is_long.copy()
            if long_first:
                member[0] = False
            a = np.r_[np.minimum(ids[i], ids[j]), ids[member]]
            pairs = pa.array(np.maximum(ids[i], ids[j]))
            blank = int(member.sum())
            more = [pa.concat_arrays([pa.nulls(len(i), t), pa.array(x[member])]) for t, x in ((pa.int64(), key), (pa.int32(), n), (pa.int32(), room))]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.concat_arrays([pairs, pa.nulls(blank, pa.int64())]), *more], names)

        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]]
            if held is not None:
                rows = [np.r_[h, r] for h, r in zip(held, rows, strict=True)]
            last = int(np.searchsorted(rows[0] == rows[0][-1], True)) if (rows[0][0] != rows[0][-1]) else 0
            last = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1 if last else 0
            tail = len(rows[0]) - last
            was_open = open_list
            if tail > SHORT_LIST or (was_open and last == 0):  # long: done so far, only its pivot is kept
                out, held, open_list = emit(rows, was_open), [r[last : last + 1] for r in rows], True
            else:
                out, held, open_list = emit([r[:last] for r in rows], was_open), [r[last:] for r in rows], False
            if out is not None and out.num_rows:
                yield out
        if held is not None and not open_list and (out := emit(held, False)) is not None and out.num_rows:
            yield out

    sorted_ = (
        posted.repartition(F.col("key"))
        .sortWithinPartitions("key", F.desc("central"), "id")
        .select("key", "id", "n", "room")
    )
    return sorted_.mapInArrow(run, "a long, b long, key long, n int, room int")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of 0.8 or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 100) for b in batches for i in range(0, b.num_rows, 100)):
            keep, last = [], (None, None)
            for k, row in enumerate(batch.to_pylist()):
                if last[0] != row["a"]:
                    last = (row["a"], _unsqueeze(row["sa"], row["na"], 6, np.uint64))
                other = _unsqueeze(row["sb"], row["nb"], 6, np.uint64)
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                if 100 * both >= 80 * (row["na"] + row["nb"] - both):
                    keep.append(k)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    a = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    return pairs.join(b, "b").join(a, "a").mapInArrow(run, "a long, b long")


def packed_sets(hashed: DataFrame, width: int) -> DataFrame:
    """(id, n, s): each document's set, 48 bits of a token, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_lots(batches, 0):
            sets = [s for s in token_sets(batch.column(0), width) if len(s)]
            arrays = [
                pa.array([class_id(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array([_squeeze(s >> _U(16), 6) for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "s"])

    return hashed.select("h").mapInArrow(run, "id long, n int, s binary")


def split_by_mention(docs: DataFrame, keys: DataFrame, columns: list[str], bits: int = 24) -> tuple[DataFrame, DataFrame]:
    """(rows of docs whose columns are surely not among keys, the other rows): a bitmap of 2**bits hashed keys is broadcast.

    The more keys, the more rows of the second kind are none of them; what joins them sorts those out.
    """
    place = F.pmod(F.xxhash64(*columns), F.lit(1 << bits))
    words = keys.select(place.alias("p")).groupBy((F.expr("p div 64")).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v")
    )
    every = docs.sparkSession.range(1 << (bits - 6)).withColumnRenamed("id", "w").join(words, "w", "left")
    row = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", F.coalesce("v", F.lit(0)).alias("v")))), lambda x: x["v"]).alias("m"))
    marked = docs.withColumn("_m", row.scalar()).withColumn("_p", place)
    hit = F.expr("shiftrightunsigned(_m[cast(_p div 64 as int)], cast(_p % 64 as int)) & 1 = 1")
    return marked.filter(~hit).drop("_m", "_p"), marked.filter(hit).drop("_m", "_p")


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    frequent_from: int = 32,
    frequent_limit: int = 1 << 20,
    bitmap_bits: int = 24,
) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id.

    frequent_limit bounds the broadcast table of frequent tokens; those beyond it
    are ordered as rare ones, which costs time and loses nothing.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    hashed = base.select("doc_id", word_hashes(F.col("text")).alias("h"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(20, max(7, (2 * parts - 1).bit_length()))
    first, counts = materialize_parts(classes_and_counts(hashed, width, bits, 1_000_000), "classes", F.col("bucket").isNull())
    members = first.select("doc_id", "id", "n", "parity")
    frequent = spark.sparkContext.broadcast(frequent_tokens(counts.select("bucket", "m", "low", "many"), frequent_from, frequent_limit))
    discard(counts)
    lists = materialize(list_pairs(postings(hashed, width, bits, frequent)), "lists")
    classes = members.filter("n > 0").groupBy("id").agg(
        F.min("doc_id").alias("doc_id"), F.min("parity").alias("parity")
    )
    pairs = materialize(lists.filter(F.col("b").isNotNull()).select("a", "b").distinct(), "pairs")

    def linked(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        wanted = ends.join(classes, "id").select("doc_id")
        source = split_by_mention(base, wanted, ["doc_id"], bitmap_bits)[1].select("doc_id", word_hashes(F.col("text")).alias("h"))
        # Both joins of verified read the exchange of these sets by id.
        return materialize(verified(pairs, packed_sets(source, width).dropDuplicates(["id"])), "links")

    links = linked(pairs)
    roots = materialize(connected_components(links), "roots")
    # Long lists that still span components: their members outside the largest one against all.
    long_ = lists.filter(F.col("b").isNull()).select("key", F.col("a").alias("id"), "n", "room")
    placed = long_.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    shares = placed.groupBy("key", "root").agg(
        F.count("*").alias("c"), F.sum(F.xxhash64("id").bitwiseAND(F.lit((1 << 40) - 1))).alias("h"), F.sum(F.xxhash64(F.lit(1), "id").bitwiseAND(F.lit((1 << 40) - 1))).alias("g")
    ).groupBy("key").agg(
        F.max(F.struct("c", "root"))["root"].alias("main"), F.count("*").alias("roots"),
        F.xxhash64(F.sum("c"), F.sum("h"), F.sum("g")).alias("members"),
    )
    # Lists of the same members are one; a member keeps the most room that it has in any of them.
    spread = (
        placed.join(shares.filter("roots > 1"), "key")
        .groupBy(F.col("members").alias("key"), "id")
        .agg(F.max("room").alias("room"), F.first("n").alias("n"), F.first("root").alias("root"), F.first("main").alias("main"))
        .join(classes.select("id", "parity"), "id")
    )
    open_ = materialize(spread, "open")
    if not open_.isEmpty():
        x = open_.filter("root <> main").select("key", *(F.col(c).alias(f"{c}_x") for c in ("id", "n", "room", "root", "parity")))
        y = open_.select("key", "main", *(F.col(c).alias(f"{c}_y") for c in ("id", "n", "room", "root", "parity")))
        near = _possible(F.col("n_x").cast("long"), F.col("n_y").cast("long"), F.col("room_x").cast("long"), F.col("room_y").cast("long"), F.least)
        bits_apart = [F.bit_count(F.col("parity_x")[i].bitwiseXOR(F.col("parity_y")[i])) for i in range(1 << PARITY_BITS - 6)]
        near &= 9 * functools.reduce(Column.__add__, bits_apart) <= F.col("n_x") + F.col("n_y")
        once = (F.col("root_y") == F.col("main")) | (F.col("id_x") < F.col("id_y"))
        across = x.join(y, (x.key == y.key) & (F.col("root_x") != F.col("root_y")) & once & near)
        more = across.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()
        more = materialize(more.join(pairs, ["a", "b"], "left_anti"), "pairs")
        if not more.isEmpty():
            links = materialize(links.unionByName(linked(more)), "links")
            roots = materialize(connected_components(links), "roots")
    discard(lists, pairs, open_)
    least = classes.join(roots, "id").groupBy("root").agg(F.min("doc_id").alias("component"))
    of_class = roots.join(least, "root").select("id", "component")
    own = classes.join(of_class, "id", "left").select("id", F.coalesce("component", "doc_id").alias("component_id"))
    out = members.join(own.withColumnRenamed("id", "_id"), (F.col("id") == F.col("_id")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
    out = materialize(out, "components")
    discard(first, links, roots)
    return out
