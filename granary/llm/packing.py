"""Packing token sequences by cutting-stock column generation.

Each document's token ids, with an end id, are cut into pieces of the sequence
length; the rest is a shorter piece. The histogram of piece lengths, in units of
``granule`` tokens, is a cutting-stock problem: a linear program over patterns
(multisets of lengths that fit a sequence) whose new columns are priced by a
knapsack dynamic program. Rounded patterns are given to ranked pieces: a piece's
rank among those of its length says which copy of which pattern it fills.

Only the histogram (at most length / granule rows) reaches the driver. Ranks are
taken within salted groups and shifted by the groups' counts, so that a length
which many pieces share does not land in one task.

Defined cases: a null text counts as empty, and an empty text is one piece of
the end id alone; repeated rows are packed like any others; an empty table
gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import in_lots, materialize

#: (class, first rank, end rank, pieces of the class in a sequence, first sequence)
Run = tuple[int, int, int, int, int]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: What lower case, composition or white space may treat otherwise than the tokenizer does: special strings,
#: separators, combining marks, and letters beyond Latin whose case depends on their place or changes their number.
_ODD = re.compile("<\\||[\x1c-\x1f\u0130\u0300-\u036f\u03a3\u0483-\u0489\u0591-\uabff\uf900-\ufdff\U00010000-\U0010ffff]")


#: The tokenizer's own split of a chunk into words.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


class ChunkEncoder:
    """Token ids of whole texts as bytes, with the ids of common chunks remembered.

    The tokenizer splits at white space before it merges, so each chunk between
    white space has its own ids. Texts where lower case or splitting may depend
    on more than a chunk go to the tokenizer as they are.
    """

    def __init__(self, path: str, remember: int) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.letters = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # Lower-case words of the letters a-z are left alone by the normalizer and the split into words.
        self.letters.normalizer, self.letters.pre_tokenizer = None, WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[k for w, k in vocabulary.items() if w.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.remember = remember

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_new(self, chunks: list[str], lot: int = 500) -> dict[str, bytes]:
        """Ids of each chunk. Lots of chunks are encoded as one text and cut at the tokens that end a word."""
        out: dict[str, bytes] = {}
        plain = [c for c in chunks if c.isascii() and c.isalpha()]
        others = [c for c in chunks if not (c.isascii() and c.isalpha())]
        kinds = ((self.letters, plain), (self.tokenizer, others))
        for tokenizer, part in ((t, of[i : i + lot]) for t, of in kinds for i in range(0, len(of), lot)):
            ids = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.ends_word[ids]) + 1
            words = np.cumsum([1 if c.isalpha() else len(_SPLIT.findall(c)) for c in part])
            if words[-1] != len(last):  # the two splits differ: one by one
                out.update((c, self.whole(c)) for c in part)
                continue
            cuts, data = (4 * last[words - 1]).tolist(), ids.tobytes()
            out.update({c: data[i:j] for c, i, j in zip(part, [0, *cuts], cuts, strict=False)})
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each different chunk of the texts is looked up once; its ids are then laid out wherever it stands."""
        odd = [bool(_ODD.search(t)) for t in texts]
        split = pc.utf8_split_whitespace(pa.array(["" if o else t.lower() for o, t in zip(odd, texts, strict=True)], pa.string()))
        flat = split.flatten().dictionary_encode()
        chunks, known = flat.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        room = self.remember - len(known)
        ended, need = [], set()
        for c in chunks:  # a stop or comma after a letter is a word of its own
            if c in known:
                continue
            stem = c.rstrip(".,")
            if stem != c and stem and stem[-1].isalpha():
                ended.append((c, stem, c[len(stem) :]))
                need.update((stem, c[len(stem) :]))
            else:
                need.add(c)
        need.discard("")  # stands beside white space at a text's ends
        added = [c for c in need if c not in known]
        known.update(self._encode_new(added))
        known.update([(c, known[stem] + known[tail]) for c, stem, tail in ended])
        own = [known[c] if c else b"" for c in chunks]
        added += [c for c, _, _ in ended]
        for c in added[max(room, 0) :]:  # beyond the bound: forgotten again
            known.pop(c, None)
        at, sizes = flat.indices.to_numpy(), np.fromiter(map(len, own), np.int64, len(own)) // 4
        starts, lengths = (np.cumsum(sizes) - sizes)[at], sizes[at]
        ends = np.cumsum(lengths)
        ids = np.frombuffer(b"".join(own), "<u4")[np.repeat(starts - ends + lengths, lengths) + np.arange(lengths.sum())].tobytes()
        bounds = [0, *(4 * ends[np.cumsum(pc.list_value_length(split).to_numpy()) - 1]).tolist()] if texts else [0]
        return [self.whole(t) if o else ids[i:j] for o, t, i, j in zip(odd, texts, bounds, bounds[1:], strict=False)]


@functools.lru_cache(maxsize=2)
def _encoder(path: str, remember: int) -> ChunkEncoder:
    return ChunkEncoder(path, remember)


def cut_pieces(
    docs: DataFrame, *, path: str, length: int, end_id: int, remember: int, lot: int = 2048
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids and end id, cut every ``length`` ids.

    lot texts, of some million characters at most, are encoded at a time, which bounds the memory of a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = _encoder(path, remember), np.array([end_id], "<u4").tobytes()
        for batch in in_lots(batches, 1, rows=lot, size=4_000_000):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            at, start, size, crc, total = [], [], [], [], []
            for k, ids in enumerate(encoder.encode(texts)):
                ids += last
                n = len(ids) // 4
                for i in range(0, n, length):
                    piece = memoryview(ids)[4 * i : 4 * (i + length)]
                    at.append(k)
                    start.append(i)
                    size.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            columns = [pa.array(c, pa.int64()) for c in (start, size, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names)
        encoder.known.clear()  # a Python worker lives on after the task

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of most value: an unbounded knapsack by dynamic programming over the capacity."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = int(np.searchsorted(sizes, c, "right"))
        best[c] = best[c - 1]
        if fits:
            gains = best[c - sizes[:fits]] + values[:fits]
            k = int(gains.argmax())
            if gains[k] > best[c] + 1e-12:
                best[c], took[c] = gains[k], k
    pattern, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= int(sizes[took[c]])
    return float(best[capacity]), pattern


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """matrix @ vector by its few columns that count, without the threads of a linear algebra library."""
    used = np.flatnonzero(vector)
    return (matrix[:, used] * vector[used]).sum(1)


def _inverse(columns: np.ndarray) -> np.ndarray:
    """By elimination with the largest pivot of each column."""
    n = len(columns)
    work = np.concatenate([columns, np.eye(n)], 1)
    for k in range(n):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        work[[k, pivot]] = work[[pivot, k]]
        work[k] /= work[k, k]
        rest = np.flatnonzero(work[:, k])
        rest = rest[rest != k]
        work[rest] -= work[rest, k][:, None] * work[k]
    return work[:, n:]


def solve_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int, gap: float = 1e-3
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a column each) and their fractional numbers of uses, by the revised simplex method.

    sizes ascend. ``rounds`` bounds the number of columns priced; stopping early
    costs padding, never a piece. Plain array arithmetic throughout: the driver's
    plan takes as long whatever the machine's number of threads.
    """
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    uses = demand / np.diag(columns)
    for step in range(rounds):
        worth, pattern = price(inverse.sum(0), sizes, capacity)
        if worth <= 1 + gap:  # the bound of the program is the present value over worth
            break
        change = _times(inverse, pattern)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = np.where(change > 1e-9, uses / change, np.inf)
        out = int(ratios.argmin())
        columns[:, out] = pattern
        if step % 200 == 199:  # keeps rounding errors from adding up
            inverse = _inverse(columns)
        else:
            row = inverse[out] / change[out]
            rest = np.flatnonzero(change)
            inverse[rest] -= change[rest, None] * row
            inverse[out] = row
        uses = np.maximum(_times(inverse, demand), 0)
    return columns, uses


def plan_sequences(histogram: dict[int, int], capacity: int, rounds: int = 1500) -> list[Run]:
    """Runs that give each piece of each class a sequence; no sequence's classes exceed capacity."""
    sizes = np.array(sorted(histogram), int)
    if not len(sizes):
        return []
    demand = np.array([histogram[s] for s in sizes.tolist()], float)
    columns, uses = solve_patterns(sizes, demand, capacity, rounds)
    whole = np.floor(uses + 1e-9)
    left = (demand - _times(columns, whole)).round().astype(int)
    while (left < 0).any():  # rounding may have used a pattern once too often
        over = int(np.flatnonzero((columns[int((left < 0).argmax())] > 0) & (whole > 0))[0])
        whole[over] -= 1
        left += columns[:, over].astype(int)
    patterns = [(columns[:, k].astype(int), int(whole[k])) for k in np.flatnonzero(whole)]
    while left.any():  # what rounding left over: the largest first, as often as the same pattern fits
        pattern, room = np.zeros(len(sizes), int), capacity
        for k in reversed(range(len(sizes))):
            pattern[k] = min(left[k], room // sizes[k])
            room -= pattern[k] * sizes[k]
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        patterns.append((pattern, times))
        left -= pattern * times
    runs: list[Run] = []
    rank, sequence = dict.fromkeys(sizes.tolist(), 0), 0
    for pattern, times in patterns:
        for size, n in zip(sizes.tolist(), pattern.tolist(), strict=True):
            if n:
                runs.append((size, rank[size], rank[size] + n * times, n, sequence))
                rank[size] += n * times
        sequence += times
    return runs


def pack(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
    length: int = 2048,
    granule: int = 8,
    salts: int = 512,
    remember: int = 400_000,
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    remember bounds the chunks whose ids a Python worker keeps. length must be a
    multiple of granule, whose size sets how many tokens rounding wastes.
    """
    if length % granule:
        raise ValueError("length must be a multiple of granule")
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    path = tokenizer or default_tokenizer()
    pieces = materialize(cut_pieces(source, path=path, length=length, end_id=end_id, remember=remember), "pieces")
    units = F.ceil(F.col("length") / granule).cast("int")
    salted = pieces.withColumn("units", units).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int")
    )
    counts = salted.groupBy("units", "salt").agg(F.count("*").alias("n"))
    histogram = {r["units"]: r["n"] for r in counts.groupBy("units").agg(F.sum("n").alias("n")).collect()}
    runs = docs.sparkSession.createDataFrame(
        plan_sequences(histogram, length // granule),
        "units int, first long, end long, each long, sequence long",
    )
    before = Window.partitionBy("units").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("units", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("units", "salt").orderBy("doc_id", "start")
    ranked = salted.withColumn("place", F.row_number().over(within) - 1).join(
        F.broadcast(shift), ["units", "salt"]  # at most length / granule * salts rows
    )
    rank = F.col("place") + F.col("shift")
    here = (rank >= F.col("first")) & (rank < F.col("end"))
    placed = ranked.join(F.broadcast(runs.withColumnRenamed("units", "of")), (F.col("units") == F.col("of")) & here)
    placed = placed.withColumn("sequence_id", F.col("sequence") + F.expr("(place + shift - first) div each"))
    fill = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "place", "salt")
    offset = F.coalesce(F.sum("length").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset.cast("long").alias("offset")
    )
