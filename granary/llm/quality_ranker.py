"""Quality scores by Bradley-Terry pairwise ranking.

Each preference pair is a document labelled good and one labelled bad. The
probability that the good one wins is the logistic function of the difference of
their scores, and a score is linear in features of the text alone, so the fit is
a logistic regression on feature differences. The scores' threshold is the
quantile of the fitted documents' scores at the share of bad ones.

Labels are read for at most ``fit_limit`` documents, chosen by a hash of the id
and broadcast; their features, a few numbers each, are fitted on the driver. All
documents are scored where they lie, without a shuffle.

Defined cases: a null text counts as empty and is scored like any other; where
labels of both kinds are missing every score is 0.5; a document with several
labels counts as good if any says so, null labels are not read; repeated rows
get the same score each; an empty table gives no rows; columns other than id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_MARKS = np.frombuffer(b"!?", np.uint8)


def features(text: str) -> list[float]:
    """Shares and lengths that don't depend on the language."""
    words = text.split()
    n = len(words)
    bytes_ = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(1, int(bytes_.sum()))
    upper, lower, digits = bytes_[65:91].sum(), bytes_[97:123].sum(), bytes_[48:58].sum()
    distinct = len(set(words))
    same_next = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in text.split("\n") if x.strip()]
    some, many = max(1, n), max(1, n - 1)
    return [
        np.log1p(n), min(n, 20) / 20, len(text) / some / 10, distinct / some, distinct / some * np.log1p(n) / 5,
        pairs / many, same_next / many, upper / max(1, upper + lower), digits / size,
        bytes_[_SYMBOLS].sum() / some, bytes_[_MARKS].sum() / some, bytes_[33:48].sum() / some,
        bytes_[46] / some, bytes_[44] / some, bytes_[124] / some, bytes_[128:].sum() / size,
        len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), np.log1p(some / max(1, len(lines))),
        float(n == 0),
    ]


@dataclass(frozen=True)
class Ranker:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 at the threshold."""
        raw = np.clip((x - self.centre) / self.spread, -8, 8) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit_ranker(x: np.ndarray, good: np.ndarray, *, pairs_each: int = 8, ridge: float = 1e-3, steps: int = 25) -> Ranker:
    """Newton steps on the mean logistic loss of good-minus-bad feature differences.

    Each document of the larger kind meets ``pairs_each`` of the other, evenly dealt.
    """
    k = x.shape[1] if x.ndim == 2 else 0
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return Ranker(np.zeros(k), np.ones(k), np.zeros(k), 0.0)
    centre, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - centre) / spread, -8, 8)
    rounds = np.arange(max(len(better), len(worse)) * pairs_each)
    turn = rounds // max(len(better), len(worse))
    d = z[better[(rounds + turn * 7) % len(better)]] - z[worse[(rounds + turn * 13) % len(worse)]]
    w = np.zeros(k)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(np.einsum("ij,j->i", d, w), -30, 30)))  # chance that the worse one wins
        slope = np.einsum("ij,i->j", d, p) / len(d) - ridge * w
        bend = np.einsum("ij,i,ik->jk", d, p * (1 - p), d) / len(d) + ridge * np.eye(k)
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    s = np.sort(z @ w)
    at = len(worse)  # the quantile at the share of bad ones, half way to the next score
    return Ranker(centre, spread, w, float((s[at - 1] + s[min(at, len(s) - 1)]) / 2))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.crc32(doc_id.cast("string")) % parts == part


def rank_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    parts: int = 3,
    test_part: int = 1,
    fit_limit: int = 20_000,
) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted.

    labels has doc_id and quality (0 or 1); those in the test part are never read.
    """
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), parts, test_part))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_limit)
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["quality", "x"])

    kind = known.schema["quality"].dataType.simpleString()
    fitted = (
        base.join(F.broadcast(known), "doc_id")  # at most fit_limit rows
        .groupBy("doc_id", "quality")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))  # one text of repeated ids, so that no more rows are fitted
        .select("quality", "text")
        .mapInArrow(describe, f"quality {kind}, x array<double>")
        .toPandas()
    )
    x = np.array(fitted["x"].tolist(), float).reshape(len(fitted), len(features("")))
    ranker = fit_ranker(x, fitted["quality"].to_numpy() == 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t or "") for t in batch.column(1).to_pylist()], float)
            found = ranker.score(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    kind = base.schema["doc_id"].dataType.simpleString()
    scored = base.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id"), parts, test_part), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
