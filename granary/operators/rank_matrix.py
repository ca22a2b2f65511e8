"""Rank correlations of all pairs of columns, from one pass that ranks the values of every column."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions import special
from granary.operators.windows import running_totals
from granary.stored import dropped, stored

SCHEMA = "x string, y string, n long, rho double, p double"


def _slots(df: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], tuple[str, str]]:
    """For each pair the sets of rows within which its two columns are ranked.

    A pair counts the rows in which both are known. Columns without nulls all have the same rows, and are ranked once.
    """
    row = df.agg(F.count("*").alias("_n"), *(F.count(F.col(f"`{c}`")).alias(c) for c in columns)).first()
    whole = {c for c in columns if row[c] == row["_n"]}
    pairs = {}
    for a, b in itertools.combinations(columns, 2):
        own = "" if {a, b} <= whole else f" with {b}", "" if {a, b} <= whole else f" with {a}"
        pairs[a, b] = (a + own[0], b + own[1])
    return pairs


def rank_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, n, rho, p) for every two columns, in their order: Spearman's rho over the rows that have both, ties by
    average rank, and p from the t distribution. Null where fewer than two rows or one value is left.

    Rows of equal values are counted before they are taken apart, values by column before they are ranked, and pairs of
    values before ranks are joined to them, so that what is shuffled is at most a row for each different row, value or pair.
    """
    columns = list(columns)
    known = df.select(*(F.col(f"`{c}`").cast("double").alias(c) for c in columns))
    slots = _slots(known, columns)
    names = sorted({s for own in slots.values() for s in own})
    number = {s: k for k, s in enumerate(names)}
    meets = F.array(
        *(
            F.when(
                F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull(),
                F.struct(F.lit(k).alias("pair"), F.lit(number[slots[a, b][0]]).alias("s"), F.col(f"`{a}`").alias("a"), F.lit(number[slots[a, b][1]]).alias("t"), F.col(f"`{b}`").alias("b")),
            )
            for k, (a, b) in enumerate(slots)
        )
    )
    alike = known.groupBy(*columns).agg(F.count("*").alias("_n"))
    each = alike.select(F.explode(F.array_compact(meets)).alias("m"), "_n").select("m.*", "_n")
    joint = stored(each.groupBy("pair", "s", "a", "t", "b").agg(F.sum("_n").alias("n")), "pairs")
    # A slot's values come from one of the pairs that it serves.
    source = {}
    for k, pair in enumerate(slots):
        for side, slot in zip("ab", slots[pair], strict=True):
            source.setdefault(number[slot], (k, side))
    chosen = F.array(*(F.struct(F.lit(k).alias("pair"), F.lit(side).alias("side"), F.lit(slot).alias("slot")) for slot, (k, side) in source.items()))
    sides = joint.select("pair", "n", F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("s").alias("slot"), F.col("a").alias("v")), F.struct(F.lit("b").alias("side"), F.col("t").alias("slot"), F.col("b").alias("v")))).alias("e"))
    own = sides.filter(F.array_contains(chosen, F.struct("pair", F.col("e.side").alias("side"), F.col("e.slot").alias("slot"))))
    values = own.groupBy(F.col("e.slot").alias("slot"), F.col("e.v").alias("v")).agg(F.sum("n").alias("n"))
    so_far = stored(running_totals(values, "slot", ["v"], ["n"]), "ranks")
    before = so_far.groupBy("slot").agg(F.min(F.col("n_so_far") - F.col("n")).alias("_before"))  # a row for each slot
    ranks = so_far.join(F.broadcast(before), "slot").select("slot", "v", (F.col("n_so_far") - F.col("_before") - (F.col("n") - 1) / 2).alias("rank"))
    ranked = joint.join(ranks.select(F.col("slot").alias("s"), F.col("v").alias("a"), F.col("rank").alias("ra")), ["s", "a"])
    ranked = ranked.join(ranks.select(F.col("slot").alias("t"), F.col("v").alias("b"), F.col("rank").alias("rb")), ["t", "b"])
    totals = joint.groupBy("pair").agg(F.sum("n").alias("m"))  # a row for each pair of columns
    centred = ranked.join(F.broadcast(totals), "pair").withColumns({"ra": F.col("ra") - (F.col("m") + 1) / 2, "rb": F.col("rb") - (F.col("m") + 1) / 2})
    w = F.col("n")
    sums = centred.groupBy("pair").agg(F.first("m").alias("m"), F.sum(w * F.col("ra") * F.col("rb")).alias("ab"), F.sum(w * F.col("ra") * F.col("ra")).alias("aa"), F.sum(w * F.col("rb") * F.col("rb")).alias("bb"))
    found = {r["pair"]: r for r in sums.collect()}
    rows = []
    for k, (a, b) in enumerate(slots):
        r = found.get(k)
        rho = r["ab"] / math.sqrt(r["aa"] * r["bb"]) if r and r["aa"] and r["bb"] else None
        rows.append((a, b, r["m"] if r else 0, rho, spearman_p(rho, r["m"]) if rho is not None else None))
    dropped(joint, so_far)
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def spearman_p(rho: float, n: int) -> float | None:
    """Two-sided, from the t distribution; none for two rows."""
    if n < 3:
        return None
    return 0.0 if abs(rho) >= 1 else special.t_two_sided(rho * math.sqrt((n - 2) / (1 - rho * rho)), n - 2)
