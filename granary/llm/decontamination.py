"""Benchmark decontamination: passages of benchmark items in documents, a few edits apart at most.

Texts are words (lower case A-Z, split at white space), and distances are word
edit distances. A random walk over a window's words (CGK: emit the word under the
pointer, then advance it or not by a random bit of step and word) maps windows
few edits apart to strings that differ in few places. Sampled places of the
walks are LSH keys; repetitions raise the chance that a leak shares a key with
its item beyond the target recall. An item has windows over its whole length. Windows start at every place that can hold a
leak: an item of n words within d edits shares at least n - 2 - 3 d of its word
trigrams with the text, so places with fewer benchmark trigrams ahead are left
out, exactly. Pairs with a key in common are verified by edit distance.

The benchmark is broadcast in blocks of at most ``block_words`` words; documents
are searched where they lie, without a shuffle.

Defined cases: null or empty texts hold no leak, null or empty items match
nothing; an item of fewer than three words must occur as it is; repeated rows
are searched alike; without documents or items there are no rows; ids may be of
any type that text can hold; columns other than ids and texts are not read, and
``decontaminate`` leaves them as they are, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import ascii_lower, in_lots, text_of, words_of

_U = np.uint64
#: Windows are powers of two, at most half the item (where it has 16 words or more) and this.
LONGEST = 32
#: (item's id as text, distance, first word, end word)
Leak = tuple[str, int, int, int]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def allowed_edits(n: int, share: float) -> int:
    """Edits that an item of n words may have: a share of n, few enough to leave a trigram whole."""
    return max(0, min(int(share * n), (n - 3) // 3)) if n >= 3 else 0


def best_match(item: list[int], text: list[int], most: int) -> tuple[int, int] | None:
    """(distance, end) of the substring of text nearest to item, if within most edits; the first end of ties.

    Bit-parallel columns: bit i of up and down says whether the distance grows or shrinks at the item's word i.
    """
    n = len(item)
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best = (n, 0)
    for j, w in enumerate(text):
        eq = places.get(w, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        h_up = down | ~(d | up) & full
        h_down = up & d
        score += bool(h_up & top) - bool(h_down & top)
        h_up = h_up << 1 & full
        h_down = h_down << 1 & full
        up = h_down | ~(x | h_up) & full
        down = h_up & x
        if score < best[0]:
            best = (score, j + 1)
    return best if best[0] <= most else None


@dataclass
class Benchmark:
    """Items and their LSH tables."""

    ids: list[str]
    words: list[np.ndarray]
    share: float
    walks: int
    samples: int
    places: int
    grams: np.ndarray = field(init=False)
    own_grams: list[set[int]] = field(init=False)
    edits: list[int] = field(init=False)
    #: For each class of items, by the length of its windows: (length, trigrams needed, reach, the last window's start,
    #: edits, by sample: keys, items and starts of windows in them).
    tables: list[tuple[int, int, int, int, int, list[tuple[np.ndarray, ...]]]] = field(init=False)

    def __post_init__(self) -> None:
        sizes = [len(w) for w in self.words]
        edits = self.edits = [allowed_edits(n, self.share) for n in sizes]
        grams = [self.rolled(w) for w in self.words]
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        self.own_grams = [set(g.tolist()) for g in grams]
        self.tables = []
        by_class: dict[int, list[int]] = {}
        for k, n in enumerate(sizes):
            by_class.setdefault(min(LONGEST, 1 << (n.bit_length() - (2 if n >= 16 else 1))), []).append(k)
        for length, own in sorted(by_class.items()):
            # Windows side by side and one at the end: edits that gather in a part of the item leave others whole.
            cut = [(k, a) for k in own for a in sorted({*range(0, sizes[k] - length + 1, length), sizes[k] - length})]
            padded = np.stack([self.words[k][a : a + length] for k, a in cut])
            whose, starts = (np.array(x) for x in zip(*cut, strict=True))
            tables = []
            for keys in self.keys(padded.ravel(), np.arange(len(cut)) * length, length):
                order = np.argsort(keys, kind="stable")
                tables.append((keys[order], whose[order], starts[order]))
            # An edit changes three trigrams, and may make a fourth repeat the one before it.
            needed = min(max(1, int((np.diff(grams[k]) != 0).sum()) + 1 - 4 * edits[k]) for k in own)
            reach, most = max(sizes[k] + edits[k] for k in own), max(edits[k] for k in own)
            self.tables.append((length, needed, reach, int(starts.max()), most, tables))

    @staticmethod
    def rolled(words: np.ndarray) -> np.ndarray:
        """A hash of each three words in a row; of all words where there are fewer."""
        n = min(3, len(words))
        with np.errstate(over="ignore"):
            out = np.zeros(len(words) - n + 1, np.uint64)
            for i in range(n):
                out = out * _U(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i]
            return _mix(out + _U(n))

    def keys(self, words: np.ndarray, starts: np.ndarray, length: int) -> Iterator[np.ndarray]:
        """LSH keys of the windows at starts, an array for each walk and sample.

        A walk takes two steps a word on average; places beyond so many mostly hold nothing, which all windows share.
        """
        steps = 2 * length
        draw = np.random.default_rng(length)
        for walk in range(self.walks):
            at = np.zeros(len(starts), np.int64)
            seen = np.empty((steps, len(starts)), np.uint64)
            with np.errstate(over="ignore"):
                for j in range(steps):
                    inside = at < length
                    seen[j] = np.where(inside, words[np.minimum(starts + at, len(words) - 1)], _U(0))
                    coin = _mix(seen[j] + _U(j * 0x9E37 + walk * 0x85EBCA6B + 1)) >> _U(63)
                    at += coin.astype(np.int64) & inside
                for _ in range(self.samples):
                    key = np.zeros(len(starts), np.uint64)
                    for j in sorted(draw.integers(0, steps, self.places).tolist()):
                        key = _mix(key * _U(0x9E3779B97F4A7C15) + seen[j])
                    yield key

    def search(self, column: pa.Array) -> list[list[Leak]]:
        """The leaks in each row of word hashes, the nearest place of each item."""
        ends = column.offsets.to_numpy().astype(np.int64)
        words = column.values[ends[0] : ends[-1]].to_numpy(zero_copy_only=False).view(np.uint64)
        ends = ends - ends[0]
        rows = len(ends) - 1
        out: list[list[Leak]] = [[] for _ in range(rows)]
        if not len(words) or not len(self.grams):
            return out
        hit = np.zeros(len(words) + 1, np.int64)  # where a benchmark trigram starts that does not repeat the last
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for n in {min(3, len(w)) for w in self.words}:
            if len(words) < n:
                continue
            with np.errstate(over="ignore"):
                rolled = np.zeros(len(words) - n + 1, np.uint64)
                for i in range(n):
                    rolled = rolled * _U(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i]
                rolled = _mix(rolled + _U(n))
            # A bitmap tells most places off before the exact search.
            small = np.zeros(1 << 20, bool)
            small[(self.grams >> _U(44)).astype(np.int64)] = True
            maybe = np.flatnonzero(small[(rolled >> _U(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.grams, rolled[maybe]), len(self.grams) - 1)
            maybe = maybe[self.grams[at] == rolled[maybe]]
            held.append((maybe, rolled[maybe]))
            again = (maybe > 0) & (rolled[maybe] == rolled[np.maximum(maybe - 1, 0)])
            hit[maybe[~again] + 1] = 1
        if not hit.any():
            return out
        total = np.cumsum(hit)
        places, grams = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(places, kind="stable")
        places, grams = places[order], grams[order]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for length, needed, reach, furthest, edits, tables in self.tables:
            ahead = total[np.minimum(np.arange(len(words)) + reach, len(words))] - total[:-1]
            # A window lies as far beyond the leak's start as in the item, by the edits more or less.
            starts = np.concatenate([[0], np.cumsum(ahead >= needed)])
            every = np.arange(len(words))
            own = np.flatnonzero(
                starts[np.minimum(every + edits + 1, len(words))] > starts[np.maximum(every - furthest - edits, 0)]
            )
            own_row = np.searchsorted(ends, own, "right") - 1
            for keys, table in zip(self.keys(words, own, length), tables, strict=True):
                sorted_keys, items, offsets = table
                a, b = np.searchsorted(sorted_keys, keys, "left"), np.searchsorted(sorted_keys, keys, "right")
                some = np.flatnonzero(b > a)
                times = (b - a)[some]
                at = np.repeat(a[some] - np.cumsum(times) + times, times) + np.arange(times.sum())
                found.append((np.repeat(own_row[some], times), items[at], np.repeat(own[some], times) - offsets[at]))
        if not found:
            return out
        rows_, items_, starts_ = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((starts_, items_, rows_))
        rows_, items_, starts_ = rows_[order], items_[order], starts_[order]
        new = np.r_[True, (np.diff(rows_) != 0) | (np.diff(items_) != 0) | (np.diff(starts_) != 0)][: len(order)]
        rows_, items_, starts_ = rows_[new], items_[new], starts_[new]
        # Stretches of text that can hold the item, and only those with as many benchmark trigrams as it needs.
        most_ = np.array(self.edits)[items_]
        firsts = np.maximum(ends[rows_], starts_ - most_)
        lasts = np.minimum(ends[rows_ + 1], starts_ + np.array([len(w) for w in self.words])[items_] + 2 * most_ + most_ // 2)
        need_ = np.maximum(1, np.array([len(g) for g in self.own_grams])[items_] - 3 * most_)
        from_, to = np.searchsorted(places, firsts), np.searchsorted(places, lasts)
        enough = np.flatnonzero((lasts > firsts) & (to - from_ >= need_))
        best: dict[tuple[int, int], Leak] = {}
        done: dict[tuple[int, int], int] = {}
        columns = (rows_, items_, starts_, most_, firsts, lasts, need_, from_, to)
        for r, k, start, most, first, last, need, i, j in zip(*(c[enough].tolist() for c in columns), strict=True):
            known = best.get((r, k))
            if (known and known[1] == 0) or start < done.get((r, k), -1):
                continue
            done[r, k] = start + most // 2 + 1  # the next few starts look at the same words
            if len(self.own_grams[k].intersection(grams[i:j].tolist())) < need:
                continue
            item = self.words[k].tolist()
            match = best_match(item, words[first:last].tolist(), most)
            if match and (not known or match[0] < known[1]):
                distance, end = match
                back = best_match(item[::-1], words[first : first + end][::-1].tolist(), most)
                begin = first + end - (back[1] if back else len(item))
                base = int(ends[r])
                best[r, k] = (self.ids[k], distance, begin - base, first + end - base)
        for (r, _), leak in sorted(best.items()):
            out[r].append(leak)
        return out


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(ascii_lower(text)), lambda w: F.xxhash64(w))


def benchmark_blocks(
    items: DataFrame, id_column: str, text_column: str, block_words: int, **settings: float
) -> Iterator[Benchmark]:
    """The items in blocks whose words number at most block_words, so that what is broadcast is bounded."""
    sized = items.select(F.col(id_column).cast("string").alias("id"), word_hashes(text_of(text_column)).alias("h")).filter(
        F.col("id").isNotNull() & (F.size("h") > 0)
    )
    total = sized.agg(F.sum(F.size("h")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total * 2 // block_words)) if total > block_words else 1
    for block in range(blocks if total else 0):
        part = sized if blocks == 1 else sized.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        rows = part.distinct().orderBy("id").collect()
        yield Benchmark([r["id"] for r in rows], [np.array(r["h"], np.int64).view(np.uint64) for r in rows], **settings)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    share: float = 0.2,
    walks: int = 4,
    samples: int = 10,
    places: int = 5,
    block_words: int = 2_000_000,
) -> DataFrame:
    """One row for each document and item leaked into it: doc_id, item_id, distance, first_word, end_word."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("doc_id"), word_hashes(text_of(text_column)).alias("h"))
    kind = source.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema[item_id_column].dataType.simpleString()
    schema = f"doc_id {kind}, item_id string, distance int, first_word long, end_word long"
    settings = {"share": share, "walks": walks, "samples": samples, "places": places}

    def searched(benchmark: Benchmark) -> DataFrame:
        held = spark.sparkContext.broadcast(benchmark)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in in_lots(batches, 1):
                leaks = held.value.search(batch.column(1))
                at = [k for k, own in enumerate(leaks) for _ in own]
                columns = list(zip(*(x for own in leaks for x in own), strict=True)) or [[]] * 4
                types = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                names = ["doc_id", "item_id", "distance", "first_word", "end_word"]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *arrays], names)

        return source.mapInArrow(run, schema).withColumn("item_id", F.col("item_id").cast(item_kind))

    found = [searched(b) for b in benchmark_blocks(items, item_id_column, item_text_column, block_words, **settings)]
    none = f"doc_id {kind}, item_id {item_kind}, distance int, first_word long, end_word long"
    return functools.reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], none)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    share: float = 0.2,
    walks: int = 4,
    samples: int = 10,
    places: int = 5,
    block_words: int = 2_000_000,
) -> DataFrame:
    """docs without the rows that hold a leak."""
    names = docs.columns
    own = "_h"
    while own in map(str.lower, names):
        own += "_"
    settings = {"share": share, "walks": walks, "samples": samples, "places": places}
    for benchmark in benchmark_blocks(items, item_id_column, item_text_column, block_words, **settings):
        held = docs.sparkSession.sparkContext.broadcast(benchmark)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in in_lots(batches, len(names)):
                clean = [k for k, leaks in enumerate(held.value.search(batch.column(len(names)))) if not leaks]
                yield batch.select(names).take(pa.array(clean, pa.int64()))

        docs = docs.withColumn(own, word_hashes(text_of(text_column))).mapInArrow(run, docs.schema)
    return docs
