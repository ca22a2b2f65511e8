"""Document log-likelihoods of a gated recurrent language model.

Word counts of all training documents give a smoothed unigram base, the model's
vocabulary with its output classes, and the starting biases. The model is a GRU
whose softmax is factored into a class and a word within it. It is trained by
truncated backpropagation in numpy over every training document: each round has
its share of them, trainers each take some of its rows and carry the state from
window to window, and their parameters are averaged after the round, in steps of a
few trainers each. Rows are dealt by a hash of what they hold, in whose order a
trainer takes them; equal rows by the number of the copy too, so that they spread.
The number of trainers, and the cuts of a trainer's stream, follow the tokens. So
scores depend neither on partitions and splits of files nor on Arrow's batches.
Scoring carries the state through whole documents. Words outside the vocabulary count as one symbol of the model times their share
among such words by counts.

The ``known_words`` most frequent words are broadcast; the counts of the others
reach the documents by a join on the word, so no task holds all words.

Defined cases: a null or empty text is the end token alone; without training
documents every count is 0 and both scores are uniform; repeated rows get the
same scores each (each also counts in training); an empty table gives no rows;
a null id is never held out; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import discard, in_lots, materialize
from granary.llm.quality_ranker import held_out

#: The end token: no word is empty.
END = b""
BLOCK = 1024


def tokens_of(text: str | bytes | None) -> list[bytes]:
    """Lower-case words and the end token; bytes lower only A-Z and split only at the six ASCII spaces."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")
    return [*raw.lower().split(), END]


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts (null: empty) one after the other, as ``tokens_of`` has them, and where each text's end."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # What follows a last space is empty: the end token.
    closed = pc.if_else(pc.equal(trimmed, ""), trimmed, pc.binary_join_element_wise(trimmed, "", " "))
    split = pc.ascii_split_whitespace(closed)
    return split.flatten(), np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)


def count_words(texts: DataFrame, lot: int = 4_000_000) -> DataFrame:
    """(word, c) over all tokens of texts, the end token as the empty word; summed in lots of so many characters before
    the shuffle, so that a worker holds no more of a large partition than of a small one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_lots(batches, 0, rows=2000, size=lot):
            found = words_in(batch.column(0))[0].value_counts()
            yield pa.RecordBatch.from_arrays(found.flatten(), ["word", "c"])

    return texts.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int, steps: int = 16) -> DataFrame:
    """Rows of counts (word, c) with the largest c, and the end token: nearly ``most`` of them, never more but for it.

    A histogram of log c, a few hundred rows, tells the least count; no task or driver sorts all words.
    """
    level = F.floor(F.log2("c") * steps)
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    room, least = most, max(sizes, default=0) + 1
    for k in sorted(sizes, reverse=True):
        if sizes[k] > room:
            break
        room, least = room - sizes[k], k
    return counts.filter((level >= least) | (F.col("word") == ""))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _log_softmax_at(x: np.ndarray, at: np.ndarray, small: bool, grads: bool) -> tuple[np.ndarray, np.ndarray]:
    """Natural log softmax of each row of x at one place, and a factor for each row: the row of x times it becomes the
    mean loss's gradient if wanted. Else x is scratch.

    small says that no value of x can leave the range of exp.
    """
    here = np.arange(len(x))
    if not small:
        x -= x.max(1, keepdims=True)
    out = x[here, at]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    out -= np.log(total)
    if grads:
        x[here, at] -= total
    return out, 1 / (total * len(x))[:, None]


@dataclass
class Model:
    """Parameters by name; word k is in class k // width at place k % width."""

    p: dict[str, np.ndarray]
    hidden: int
    width: int

    @classmethod
    def start(cls, counts: np.ndarray, hidden: int, width: int, seed: int = 7) -> Model:
        """Small random weights, and biases from counts (a place for each word, padded to whole classes)."""
        classes = len(counts) // width
        by_class = counts.reshape(classes, width) + 0.5
        total = by_class.sum(1)
        draw = np.random.default_rng(seed)
        small = lambda *s: draw.normal(0, 0.08, s).astype(np.float32)
        p = {
            "input": small(len(counts), 3 * hidden),
            "bias": np.zeros(3 * hidden, np.float32),
            "state": small(hidden, 3 * hidden),
            "class_w": small(hidden, classes) * 0.1,
            "class_b": np.log(total / total.sum()).astype(np.float32),
            "word_w": small(classes, hidden, width) * 0.1,
            "word_b": np.log(by_class / total[:, None]).astype(np.float32),
        }
        return cls(p, hidden, width)

    def log_probabilities(self, h: np.ndarray, y: np.ndarray, grads: dict | None = None) -> np.ndarray | tuple:
        """Natural log probability of words y after states h; with grads (zeros), fills gradients and returns those of h too."""
        p, m, learn = self.p, len(y), grads is not None
        cls, at = np.divmod(y, self.width)
        # States lie between -1 and 1, so weights bound what is exponentiated.
        far = max(
            float((np.abs(p["class_w"]).sum(0) + np.abs(p["class_b"])).max()),
            float((np.abs(p["word_w"]).sum(1) + np.abs(p["word_b"])).max()),
        )
        small = far < 40 and float(np.abs(h).max(initial=0)) <= 1
        # A column of ones brings the biases into the products.
        wide = np.empty((m, self.hidden + 1), h.dtype)
        wide[:, :-1], wide[:, -1] = h, 1
        d = wide @ np.vstack([p["class_w"], p["class_b"]])
        out, by = _log_softmax_at(d, cls, small, learn)
        # Words by class: those of one class share their weights.
        order = np.argsort(cls.astype(np.int16), kind="stable")
        classes = cls[order]
        first = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1]][:m])
        used = list(zip(classes[first].tolist(), first.tolist(), [*first[1:].tolist(), m], strict=True))
        hs, weights = wide[order], np.concatenate([p["word_w"], p["word_b"][:, None]], 1)
        own = np.empty((m, self.width), d.dtype)
        for c, i, j in used:
            np.matmul(hs[i:j], weights[c], out=own[i:j])
        more, own_by = _log_softmax_at(own, at[order], small, learn)
        out[order] += more
        if not learn:
            return out
        found = (wide * by).T @ d
        grads["class_w"][:], grads["class_b"][:] = found[:-1], found[-1]
        dh = d @ p["class_w"].T
        dh *= by
        hs *= own_by
        back = np.empty((m, self.hidden), d.dtype)
        for c, i, j in used:
            found = hs[i:j].T @ own[i:j]
            grads["word_w"][c], grads["word_b"][c] = found[:-1], found[-1]
            np.matmul(own[i:j], p["word_w"][c].T, out=back[i:j])
        back *= own_by
        dh[order] += back
        return out, dh

    def score(self, docs: list[np.ndarray], chunk: int = 1 << 13) -> np.ndarray:
        """Natural log-likelihood of each document (ids that end with the end token), state carried throughout."""
        total = np.zeros(len(docs))
        order = sorted(range(len(docs)), key=lambda k: -len(docs[k]))
        lengths = np.array([len(docs[k]) for k in order], np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        flat = np.concatenate([docs[k] for k in order]) if order else np.zeros(0, np.int64)
        n, given, state = self.hidden, self.p["input"] + self.p["bias"], np.ascontiguousarray(self.p["state"].T)
        h = np.zeros((n, len(docs)), np.float32)  # a column for each document: gates are whole rows
        states, targets, owners, held = [], [], [], 0
        active, last = len(docs), flat[ends[1:] - 1] if order else flat
        for t in range(int(lengths[0]) if order else 0):
            active = int(np.searchsorted(-lengths[:active], -t, "left"))
            x = last[:active] if t == 0 else flat[ends[:active] + t - 1]
            gx = np.ascontiguousarray(given[x].T)
            h = h[:, :active]
            gh = state @ h
            gx[: 2 * n] += gh[: 2 * n]
            both = _sigmoid(gx[: 2 * n])
            new = both[n:] * gh[2 * n :]
            new += gx[2 * n :]
            np.tanh(new, out=new)
            h = (h - new) * both[:n]
            h += new
            states.append(h.T)
            targets.append(flat[ends[:active] + t])
            owners.append(np.arange(active))
            held += active
            if held >= chunk or t == lengths[0] - 1:
                found = self.log_probabilities(np.concatenate(states), np.concatenate(targets))
                total += np.bincount(np.concatenate(owners), found, len(docs))
                states, targets, owners, held = [], [], [], 0
        out = np.zeros(len(docs))
        out[order] = total
        return out

    def train(
        self, docs: list[np.ndarray], *, rows: int = 384, window: int = 16, rate: float = 0.1, squares: dict | None = None
    ) -> int:
        """One pass of truncated backpropagation over docs, ``rows`` streams side by side; the number of tokens.

        squares holds the summed squares of gradients from call to call.
        """
        if not docs:
            return 0
        squares = {} if squares is None else squares
        for k, v in self.p.items():
            squares.setdefault(k, np.full_like(v, 1e-8))
        stream = np.concatenate(docs)
        rows = max(1, min(rows, len(stream) // window))
        steps, extra = divmod(len(stream), rows)  # the first streams are one token longer
        starts = np.arange(rows) * steps + np.minimum(np.arange(rows), extra)
        end = docs[0][-1]
        h, x = np.zeros((rows, self.hidden), np.float32), np.full(rows, end)
        for a in range(0, steps, window):
            part = stream[starts[:, None] + np.arange(a, min(a + window, steps))]
            h = self._learn(part, x, h, end, rate, squares)
            x = part[:, -1]
        if extra:
            self._learn(stream[starts[:extra] + steps][:, None], x[:extra], h[:extra], end, rate, squares)
        return len(stream)

    def _learn(self, part: np.ndarray, x: np.ndarray, h: np.ndarray, end: int, rate: float, squares: dict) -> np.ndarray:
        """One update by the words of part after words x and states h; the states after it."""
        n, steps, rows = self.hidden, part.shape[1], part.shape[0]
        kind = self.p["state"].dtype
        given = np.concatenate([x[:, None], part[:, :-1]], 1).T
        going = (given != end).astype(kind)[:, None, :]  # a new document starts afresh
        # A column for each row of part: gates are whole rows.
        gxs = (self.p["input"][given] + self.p["bias"]).transpose(0, 2, 1).copy()
        state = self.p["state"]
        turned = np.ascontiguousarray(state.T)
        befores, states = (np.empty((steps, n, rows), kind) for _ in range(2))
        kept, h = [], h.T
        for t in range(steps):
            before = np.multiply(h, going[t], out=befores[t])
            gx, gh = gxs[t], turned @ before
            gx[: 2 * n] += gh[: 2 * n]
            both = _sigmoid(gx[: 2 * n])
            z, r, gh = both[:n], both[n:], gh[2 * n :]
            new = r * gh
            new += gx[2 * n :]
            np.tanh(new, out=new)
            h = np.subtract(before, new, out=states[t])
            h *= z
            h += new
            kept.append((z, r, new, gh))
        grads = {k: np.zeros_like(v) for k, v in self.p.items() if k != "input"}
        _, dhs = self.log_probabilities(states.transpose(0, 2, 1).reshape(-1, n), part.T.ravel(), grads)
        dhs = dhs.reshape(steps, rows, n).transpose(0, 2, 1).copy()
        dh = np.zeros((n, rows), kind)
        dx, dstate = (np.empty((steps, 3 * n, rows), kind) for _ in range(2))
        for t in reversed(range(steps)):
            z, r, new, gh = kept[t]
            dh += dhs[t]
            rest = dh * (1 - z)
            dnew = np.multiply(rest, 1 - new * new, out=dx[t, 2 * n :])
            rest *= befores[t] - new
            np.multiply(rest, z, out=dx[t, :n])
            back = np.multiply(dnew, r, out=dstate[t, 2 * n :])
            np.multiply(back * gh, 1 - r, out=dx[t, n : 2 * n])
            dstate[t, : 2 * n] = dx[t, : 2 * n]
            dh *= z
            dh += state @ dstate[t]
            dh *= going[t]
        wide = lambda v: v.transpose(1, 0, 2).reshape(v.shape[1], -1)
        grads["state"] = wide(befores) @ wide(dstate).T
        dx = dx.transpose(0, 2, 1).reshape(-1, 3 * n)
        grads["bias"] = dx.sum(0)
        for k, g in grads.items():
            np.clip(g, -1, 1, out=g)
            squares[k] += g * g
            self.p[k] -= rate * g / np.sqrt(squares[k])
        # Only the words given have a gradient; without one nothing changes.
        flat = given.ravel().astype(np.min_scalar_type(len(self.p["input"])))  # few bits sort fast
        order = np.argsort(flat, kind="stable")
        words, first = np.unique(flat[order], return_index=True)
        g = np.clip(np.add.reduceat(dx[order], first), -1, 1)
        sums = squares["input"][words] + g * g
        squares["input"][words] = sums
        self.p["input"][words] -= rate * g / np.sqrt(sums)
        return h.T

    def blocks(self) -> np.ndarray:
        flat = np.concatenate([self.p[k].ravel() for k in sorted(self.p)])
        return np.pad(flat, (0, -len(flat) % BLOCK)).reshape(-1, BLOCK)

    def with_blocks(self, blocks: np.ndarray) -> Model:
        flat, at, p = blocks.ravel().astype(np.float32), 0, {}
        for k in sorted(self.p):
            p[k] = flat[at : at + self.p[k].size].reshape(self.p[k].shape)
            at += self.p[k].size
        return Model(p, self.hidden, self.width)


class Places:
    """Numbers of known words by a table of Arrow's, and of all others one number."""

    def __init__(self, place: dict[bytes | None, int]) -> None:
        known = [w for w in place if w is not None]
        self.words = pa.array(known, pa.binary()).cast(pa.string())
        self.numbers = np.array([*map(place.get, known), place[None]], np.int32)

    def of(self, words: pa.Array) -> np.ndarray:
        at = pc.index_in(words, value_set=self.words)
        return self.numbers[pc.fill_null(at, len(self.words)).to_numpy(zero_copy_only=False)]


def with_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text, copy): equal rows are numbered from 0, others have 0. Ids alone are read to see whether any repeat;
    rows of those that do are grouped by their text where they are read, and set apart again by their count."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    again = materialize(ids.select(F.col("doc_id").alias("again")), "copies")
    if again.isEmpty():
        discard(again)
        return docs.select("doc_id", "text", F.lit(0).cast("long").alias("copy"))
    same = F.col("doc_id").eqNullSafe(F.col("again"))
    single = docs.join(again, same, "left_anti").select("doc_id", "text", F.lit(0).cast("long").alias("copy"))
    several = docs.join(again, same, "left_semi").groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    return single.unionByName(several.select("doc_id", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy")))


def averaged(found: DataFrame, trainers: int, few: int = 32) -> DataFrame:
    """(at, v): means of the trainers' blocks by their tokens, from (trainer, at, n, v). At most ``few`` are gathered at a
    time, in the trainers' order, until one of each block is left."""

    def average(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("trainer", kind="stable")
        total = np.zeros(BLOCK)
        for v, n in zip(group.v, group.n, strict=True):
            total += np.asarray(v, float) * n
        n = int(group.n.sum())
        return pd.DataFrame({"trainer": group["trainer"].iloc[:1].to_numpy() // few, "at": group["at"].iloc[:1].to_numpy(), "n": [n], "v": [total / n]})

    while trainers > 1:
        by = found.groupBy("at", F.floor(F.col("trainer") / few).alias("step"))
        found, trainers = by.applyInPandas(average, "trainer long, at int, n long, v array<double>"), -(-trainers // few)
    return found.select("at", "v")


def train_model(
    docs: DataFrame, model: Model, place: dict[bytes, int], *, rounds: int, trainers: int, part: int | None = None, lot_tokens: int = 1_000_000
) -> Model:
    """Averages ``trainers`` trainers' parameters after each of ``rounds`` rounds over docs (doc_id, text).

    Each document is learned from in one of the rounds; with part, only one document in part in each round. A trainer
    learns whenever its stream has lot_tokens more, and from what is left at its end.
    """
    spark = docs.sparkSession
    rows = with_copies(docs)
    drawn = F.pmod(F.xxhash64("doc_id", "text", "copy"), F.lit(part or rounds))
    for turn in range(rounds):
        held = spark.sparkContext.broadcast((model, place))

        def run(batches: Iterator[pa.RecordBatch], held: Any = held) -> Iterator[pa.RecordBatch]:
            own, words = held.value
            own = own.with_blocks(own.blocks().copy())
            n, squares, places = 0, {}, Places(words)
            waiting, size = [], 0
            for lot in in_lots(batches, 0, rows=2000, size=2_000_000):
                tokens, ends = words_in(lot.column(0))
                for doc in np.split(places.of(tokens), ends[:-1]):
                    waiting.append(doc)
                    size += len(doc)
                    if size >= lot_tokens:
                        n += own.train(waiting, squares=squares)
                        waiting, size = [], 0
            n += own.train(waiting, squares=squares)
            if n:
                blocks = own.blocks().astype(np.float32)
                values = pa.FixedSizeListArray.from_arrays(pa.array(blocks.ravel()), BLOCK).cast(pa.list_(pa.float32()))
                at = pa.array(np.arange(len(blocks), dtype=np.int32))
                same = [pa.array(np.full(len(blocks), x)) for x in (TaskContext.get().partitionId(), n)]
                yield pa.RecordBatch.from_arrays([same[0], at, same[1], values], ["trainer", "at", "n", "v"])

        row = F.xxhash64("doc_id", "text", "copy", F.lit(turn))
        dealt = rows.filter(drawn == turn).select("text", row.alias("row")).repartition(trainers, "row")
        dealt = dealt.sortWithinPartitions("row").select("text")
        found = dealt.mapInArrow(run, "trainer long, at int, n long, v array<float>")
        # Never fewer steps than trainers need, should a session deal rows to more of them than were asked for.
        most = max(trainers, int(spark.conf.get("spark.sql.shuffle.partitions")))
        blocks = averaged(found, most).toPandas()
        if len(blocks):
            model = model.with_blocks(np.stack(blocks.sort_values("at").v))
    return model


def score_documents(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    parts: int = 7,
    test_part: int = 2,
    known_words: int = 65_536,
    vocabulary: int = 4096,
    width: int = 64,
    hidden: int = 12,
    rounds: int = 3,
    trainer_tokens: int = 1_000_000,
    sample_part: int | None = None,
) -> DataFrame:
    """One row for each row of docs: held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    The model learns from every training document; with sample_part, from one in so many in each round. A round
    has a trainer for every trainer_tokens of its tokens, whatever the session's settings.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    out_of_fit = F.coalesce(held_out(F.col("doc_id"), parts, test_part), F.lit(False))
    training = base.filter(~out_of_fit).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = materialize(count_words(training.select("text")), "words")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, n_words = int(sums["n"]), int(sums["v"])
    top = most_frequent(counts, known_words).orderBy(F.col("word") != "", F.desc("c"), "word").toPandas()  # the end token first
    words = [w.encode() for w in top["word"]] or [END]
    c = top["c"].to_numpy(float) if len(top) else np.zeros(1)
    inside = min(vocabulary - 1, len(words))
    # The model's words by falling count; the unknown word takes the place its own count gives it.
    rest = n_train - c[:inside].sum()
    ids = np.argsort(-np.r_[c[:inside], rest], kind="stable")
    place: dict[Any, int] = {(words[k] if k < inside else None): i for i, k in enumerate(ids.tolist())}
    padded = np.zeros(-(-(inside + 1) // width) * width)
    padded[: inside + 1] = np.r_[c[:inside], rest][ids]
    trainers = max(1, round(n_train / (sample_part or rounds) / trainer_tokens))
    start = Model.start(padded, hidden, width)
    model = train_model(training, start, place, rounds=rounds, trainers=trainers, part=sample_part)
    log_c = np.log10(c + 1)
    rare_total = np.log10(rest + max(0, n_words - inside) + 1)
    held = spark.sparkContext.broadcast((model, place, {w: k for k, w in enumerate(words)}, log_c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, place, known, log_c = held.value
        log_c = np.append(log_c, 0.0)
        unknown, far, places = place[None], len(known), Places(known | {None: len(known)})
        in_model = np.array([place.get(w, unknown) for w in known] + [unknown], np.min_scalar_type(len(place)))
        share = np.where(in_model == unknown, log_c - rare_total, 0.0)  # of a word among those outside the model
        for batch in in_lots(batches, 2, rows=8000, size=24_000_000):  # together, as a step costs much the same for one document as for a thousand
            docs, columns, shares = [], [], []
            for lot in in_lots(iter([batch]), 2, rows=8000, size=2_000_000):  # words take far more room than their numbers
                tokens, ends = words_in(lot.column(2))
                at, starts = places.of(tokens), np.r_[0, ends[:-1]]
                rare = at == far
                n_rare = np.add.reduceat(rare, starts, dtype=np.int64)
                spell = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n_rare)], pa.int32()), tokens.filter(pa.array(rare)))
                sizes = np.diff(ends, prepend=0)
                columns.append([pa.array(sizes), pa.array(sizes - n_rare), pa.array(np.add.reduceat(log_c[at], starts)), spell])
                shares.append(np.add.reduceat(share[at], starts))
                docs += np.split(in_model[at], ends[:-1])
            n_tokens, n_known, logs, words = (pa.concat_arrays(c) for c in zip(*columns, strict=True))
            scores = model.score(docs) / np.log(10) + np.concatenate(shares)
            arrays = [batch.column(0), batch.column(1), n_tokens, n_known, logs, pa.array(scores), words]
            names = ["row", "doc_id", "n_tokens", "n_known", "logs", "score", "rare"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = base.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, n_tokens long, n_known long, logs double, score double, rare array<string>"
    source = base.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    scored = materialize(source.mapInArrow(run, schema), "scored")
    others = scored.select("row", F.explode("rare").alias("word")).join(counts, "word")
    found = others.groupBy("row").agg(F.count("*").alias("k"), F.sum(F.log10(F.col("c") + 1)).alias("s"))
    total = float(np.log10(n_train + n_words + 1))
    more = F.coalesce("s", F.lit(0.0))
    return scored.drop("rare").join(found, "row", "left").select(
        "doc_id",
        out_of_fit.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
