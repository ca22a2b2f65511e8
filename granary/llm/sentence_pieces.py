"""Encoding and decoding with merge-type piece vocabularies: a score-ordered agenda of adjacent symbol pairs.

A normalized text starts as single characters. An agenda holds the pairs of
neighbours that together are a piece; the pair of the best score, the leftmost
of equal ones, is merged, which puts its two new neighbours on the agenda, until
no pair is left. What is not a piece then is written as bytes. The agenda of a
long part is a heap; those of short parts of one length are the rows of a matrix
of score ranks, and each round merges the best pair of every row.

No piece of a usual vocabulary has a word mark after another character, or holds
certain characters beside others. Where no piece can reach across, merges on
either side don't touch each other, so a text is cut there; the ids of short
cuts are remembered, at most ``remember`` of them in a worker, from one task to the next.

Results are checked against the sentencepiece library, lot by lot: the ids of each
different cut when it is first met, and the decoded form of every whole text; with
``whole_texts`` the ids of every whole text too, at about twice the time. (A text's
ids are those of its cuts one after the other, as no piece reaches across; where a
vocabulary allows no cuts, whole texts are checked.) A difference raises an error,
so no other result ever leaves a task.

Defined cases: a null text counts as empty, and an empty text has no ids and
decodes to an empty text; repeated rows are encoded like any others; an empty
table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import in_lots

MARK = "▁"  # stands for a space in pieces
SHORT = 48  # characters of a part that is merged along with others
_SIDE = 21  # bits of a symbol
_NONE = np.iinfo(np.int32).max


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PairTable:
    """Which two symbols make a piece. A symbol is a piece's id, or a character that is none, by its code beyond all ids."""

    def __init__(self, ids: dict[str, int], score: dict[str, float], size: int) -> None:
        self.single = np.arange(0x110000, dtype=np.int32) + size
        for piece, k in ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = k
        ranks = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        found = []
        for piece, k in ids.items():
            for i in range(1, len(piece)):
                a, b = (ids.get(x) if len(x) > 1 else int(self.single[ord(x)]) for x in (piece[:i], piece[i:]))
                if a is not None and b is not None:
                    found.append((a << _SIDE | b, ranks[score[piece]], k))
        table = np.array(found, np.int64).reshape(-1, 3)
        # Open addressing: a pair that finds its place taken goes on to the next one; empty places are -1.
        self.bits = max(4, int(np.log2(len(table) + 1)) + 3)
        self.keys, self.row = np.full(1 << self.bits, -1), np.full(1 << self.bits, len(table), np.int32)
        at, waiting = self._place(table[:, 0]), np.arange(len(table))
        while len(waiting):
            free = self.keys[at[waiting]] < 0
            self.keys[at[waiting[free]]], self.row[at[waiting[free]]] = table[waiting[free], 0], waiting[free]
            waiting = waiting[self.row[at[waiting]] != waiting]
            at[waiting] = (at[waiting] + 1) & len(self.keys) - 1
        self.rank, self.made = np.append(table[:, 1], _NONE).astype(np.int32), np.append(table[:, 2], 0).astype(np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # the golden ratio's bits
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair; the last rank where it makes none."""
        keys = (left.astype(np.int64) << _SIDE | right).ravel()
        at = self._place(keys)
        there = self.keys[at]
        on = np.flatnonzero((there != keys) & (there >= 0))
        while len(on):
            at[on] = (at[on] + 1) & len(self.keys) - 1
            there = self.keys[at[on]]
            on = on[(there != keys[on]) & (there >= 0)]
        row = self.row[at].reshape(left.shape)
        return self.rank[row], self.made[row]

    def merge(self, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, symbols in rows) of parts of one length, as their agendas end.

        Each round merges a pair in every row that has one, so the rows left always have the same length.
        """
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols, at = self.single[codes].reshape(len(parts), -1), np.arange(len(parts))
        rank, made = self.look_up(symbols[:, :-1], symbols[:, 1:])
        while rank.shape[1]:
            best = rank.argmin(1)
            row = np.arange(len(at))
            open_ = rank[row, best] != _NONE
            if not open_.all():
                yield at[~open_], symbols[~open_]
                at, symbols, rank, made, best = at[open_], symbols[open_], rank[open_], made[open_], best[open_]
                row = row[: len(at)]
            if not len(at):
                return
            symbols[row, best] = made[row, best]
            width = symbols.shape[1] - 1
            symbols = _without(symbols, best + 1)
            rank, made = _without(rank, best), _without(made, best)
            for side in (best - 1, best):  # the pairs on both sides of the new piece
                has = np.flatnonzero((side >= 0) & (side < width - 1))
                if len(has):
                    c = side[has]
                    rank[has, c], made[has, c] = self.look_up(symbols[has, c], symbols[has, c + 1])
        yield at, symbols


def _without(rows: np.ndarray, column: np.ndarray) -> np.ndarray:
    """rows, each without one of its columns."""
    keep = np.ones(rows.shape, bool)
    keep[np.arange(len(rows)), column] = False
    return rows[keep].reshape(len(rows), -1)


class PieceVocabulary:
    """Pieces with their scores and kinds, and the agenda that encodes with them."""

    def __init__(self, path: str, remember: int) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto.FromString(self.library.serialized_model_proto())
        if model.trainer_spec.model_type != model.trainer_spec.BPE:
            raise ValueError(f"{path} is not a merge-type vocabulary")
        kinds = model.SentencePiece
        self.ids, self.score, self.unused, fixed, self.bytes = {}, {}, set(), [], {}
        self.surface: list[str | int] = []  # what an id decodes to: text, or the value of a byte
        self.unknown = 0
        for k, p in enumerate(model.pieces):
            surface: str | int = p.piece.replace(MARK, " ")
            if p.type == kinds.UNKNOWN:
                self.unknown, surface = k, model.trainer_spec.unk_surface
            elif p.type == kinds.CONTROL:
                surface = ""
            elif p.type == kinds.BYTE:
                surface = int(p.piece[3:5], 16)
                self.bytes[surface] = k
            else:
                self.ids[p.piece], self.score[p.piece] = k, p.score
                if p.type == kinds.UNUSED:
                    self.unused.add(p.piece)
                elif p.type == kinds.USER_DEFINED:
                    fixed.append(p.piece)
            self.surface.append(surface)
        if not model.trainer_spec.byte_fallback:
            self.bytes = {}
        spec = model.normalizer_spec
        self.strips_first = spec.add_dummy_prefix and not model.trainer_spec.treat_whitespace_as_suffix
        self.strips_all = spec.remove_extra_whitespaces
        self.identity = spec.name == "identity" and self.strips_first and spec.escape_whitespaces and not self.strips_all and not spec.precompiled_charsmap
        # A piece that the user defined is never cut or merged; the longest one counts.
        self.first = re.compile("|".join(map(re.escape, sorted(fixed, key=len, reverse=True))) or "(?!)")
        self.fixed = set(fixed)
        self.cuts = self._cuts()
        self.rows = None if self.unused or self.fixed else PairTable(self.ids, self.score, len(self.surface))
        # Bytes below 128 are characters by themselves wherever they stand.
        self.texts = np.array([chr(x) if isinstance(x, int) and x < 128 else "" if isinstance(x, int) else x for x in self.surface], object)
        self.is_high = np.array([isinstance(x, int) and x >= 128 for x in self.surface])
        self.known: dict[str, bytes] = {}
        self.remember, self.remembered = remember, 0

    def _cuts(self) -> re.Pattern | None:
        """Parts of a text that no piece reaches beyond; None where pieces have marks within or the user's own are there."""
        if self.fixed or any(MARK in p.lstrip(MARK) for p in self.ids):
            return None
        joined = sorted(set().union(*(p for p in self.ids if len(p) > 1)) - {MARK})
        inside = "".join(map(re.escape, joined))
        self.alone = next((c for c in "\n\t\r\x00\x01" if c not in joined), None)  # stands between parts that are checked
        if self.alone is None:
            return None
        return re.compile(f"{MARK}+[{inside}]*|[{inside}]+|[^{MARK}{inside}]+" if joined else f"{MARK}+|[^{MARK}]+")

    def normalize(self, text: str) -> str:
        if self.identity:
            return MARK + text.replace(" ", MARK) if text else ""
        return self.library.normalize(text)

    def _symbols(self, part: str) -> list[str]:
        """Single characters, and the user's own pieces."""
        if not self.fixed:
            return list(part)
        out, at = [], 0
        for found in self.first.finditer(part):
            out += [*part[at : found.start()], found.group()]
            at = found.end()
        return [*out, *part[at:]]

    def merge(self, part: str) -> tuple[int, ...]:
        """Ids of a part by the agenda."""
        symbols = self._symbols(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, str]] = []
        halves: dict[str, tuple[str, str]] = {}
        score, fixed, unused = self.score, self.fixed, self.unused

        def offer(i: int, j: int) -> None:
            if i < 0 or j < 0 or symbols[i] in fixed or symbols[j] in fixed:
                return
            both = symbols[i] + symbols[j]
            s = score.get(both)
            if s is not None:
                heapq.heappush(agenda, (-s, i, j, both))
                if both in unused:
                    halves[both] = symbols[i], symbols[j]

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            # An offer is stale once either side has been merged with something else.
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != len(both):
                continue
            symbols[i], symbols[j] = both, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        out: list[int] = []
        waiting = [s for s in reversed(symbols) if s]
        while waiting:
            s = waiting.pop()
            if s in unused and s in halves:
                waiting += reversed(halves[s])
            elif s in self.ids:
                out.append(self.ids[s])
            else:
                out += self._no_piece(s)
        return tuple(out)

    def _no_piece(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode()] if self.bytes else [self.unknown]

    def merge_all(self, parts: list[str]) -> None:
        """Remembers the ids of each part."""
        self.remembered += sum(map(len, parts))
        by_length: dict[int, list[str]] = {}
        for part in parts:
            if self.rows and len(part) <= SHORT:
                by_length.setdefault(len(part), []).append(part)
            else:
                self.known[part] = np.array(self.merge(part), np.int32).tobytes()
        n = len(self.surface)
        for same in by_length.values():
            for at, symbols in self.rows.merge(same):
                width, data = 4 * symbols.shape[1], symbols.tobytes()
                self.known.update(zip(map(same.__getitem__, at.tolist()), [data[i : i + width] for i in range(0, len(data), width)], strict=True))
                for k in np.flatnonzero((symbols >= n).any(1)).tolist():
                    ids = [x for i in symbols[k].tolist() for x in ([i] if i < n else self._no_piece(chr(i - n)))]
                    self.known[same[at[k]]] = np.array(ids, np.int32).tobytes()

    def check(self, parts: list[str]) -> None:
        """Raises an error if the library has other ids for a part: as it begins a text, or after a character that is never joined."""
        if not self.identity:  # the parts are normalized already, and the library would do so again
            return
        lead = np.array(self.library.encode(self.alone), np.int32).tobytes()
        texts = [p[1:].replace(MARK, " ") if p[0] == MARK else self.alone + p for p in parts]
        own = [self.known[p] if p[0] == MARK else lead + self.known[p] for p in parts]
        # A text of spaces alone is one mark longer than the spaces; an empty one has no ids at all.
        own = [b"" if not t else ids for t, ids in zip(texts, own, strict=True)]
        found = self.library.encode(texts, num_threads=1)
        if [len(ids) for ids in own] != [4 * len(ids) for ids in found] or b"".join(own) != np.array(list(itertools.chain.from_iterable(found)), np.int32).tobytes():
            wrong = next(p for p, a, b in zip(parts, own, found, strict=True) if np.frombuffer(a, np.int32).tolist() != b)
            raise ValueError(f"ids differ from the library's for {wrong[:80]!r}")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = map(self.normalize, texts)
        if self.cuts is None:
            return [self._one_unknown(np.array(self.merge(t), np.int32)) for t in whole]
        known, parts = self.known, list(map(self.cuts.findall, whole))
        new = list(set().union(*parts).difference(known))
        self.merge_all(new)
        self.check(new)
        get = known.__getitem__
        return [self._one_unknown(np.frombuffer(b"".join(map(get, own)), np.int32)) for own in parts]

    def _one_unknown(self, ids: np.ndarray) -> np.ndarray:
        """Unknown characters in a row are one id."""
        if self.bytes:
            return ids
        again = (ids == self.unknown) & (np.append(-1, ids[:-1]) == self.unknown)[: len(ids)]
        return ids[~again]

    def forget(self) -> None:
        """Keeps what is remembered within its bound, also in characters."""
        if len(self.known) > self.remember or self.remembered > 16 * self.remember:
            self.known.clear()
            self.remembered = 0

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: bytes in a row are read as UTF-8, marks as spaces, without the space that encoding put first."""
        if self.is_high[ids].any():
            text = "".join(self._read(ids.tolist()))
        else:
            text = "".join(self.texts[ids].tolist())
        if self.strips_all:
            return text.lstrip(" ")
        return text[1:] if self.strips_first and text[:1] == " " and ids[0] != self.unknown else text

    def _read(self, ids: list[int]) -> Iterator[str]:
        for is_byte, run in itertools.groupby(map(self.surface.__getitem__, ids), lambda s: isinstance(s, int)):
            yield _utf8(bytes(run)) if is_byte else "".join(run)


def _utf8(data: bytes) -> str:
    """Each byte that is no part of a character is one replacement character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out += [data[at : at + e.start].decode(), "�"]
            at += e.start + 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str, remember: int) -> PieceVocabulary:
    return PieceVocabulary(path, remember)


def encode_lot(vocabulary: PieceVocabulary, texts: list[str], whole_texts: bool = False) -> tuple[list[np.ndarray], list[str]]:
    """(ids, decoded texts), each equal to the library's."""
    ids = vocabulary.encode(texts)
    if whole_texts or vocabulary.cuts is None or not vocabulary.identity:
        for text, own, other in zip(texts, ids, vocabulary.library.encode(texts, num_threads=1), strict=True):
            if own.tolist() != other:
                raise ValueError(f"ids differ from the library's for a text of {len(text)} characters that begins {text[:80]!r}")
    decoded = list(map(vocabulary.decode, ids))
    for text, own, other in zip(texts, decoded, vocabulary.library.decode(ids, num_threads=1), strict=True):
        if own != other:
            raise ValueError(f"decoding differs from the library's for a text of {len(text)} characters that begins {text[:80]!r}")
    return ids, decoded


def encode_pieces(docs: DataFrame, *, path: str | None = None, remember: int = 600_000, whole_texts: bool = False) -> DataFrame:
    """(doc_id, ids, decoded): every whole text's ids, without begin and end ids, and the text that they decode to."""
    path = path or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path, remember)
        for batch in in_lots(batches, 1, rows=2000, size=1_000_000):
            ids, decoded = encode_lot(vocabulary, [t or "" for t in batch.column(1).to_pylist()], whole_texts)
            vocabulary.forget()
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            columns = [batch.column(0), pa.ListArray.from_arrays(ends, np.concatenate(ids)), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def piece_digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encode_pieces' rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
