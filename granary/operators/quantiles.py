"""Exact quantiles of large groups, found by narrowing down on the values that have the wanted ranks.

Groups of few rows are ordered as they are. For the others each wanted rank has an
interval of values, at first all. A round draws bounds from the interval's values by
their hashes, counts the rows between bounds and on them, and goes on with the one
place that holds the rank: between two bounds, or on one of them, which ends the
search however many rows share that value. An interval that has become small is
ordered like a small group. So a task holds counts or a few rows, never a group's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.stored import stored

BOUNDS = 63  # of an interval in one round


def _interpolated(values: Column, place: Column) -> Column:
    """Between the rows at the whole places around a place; values are sorted."""
    low, high = F.floor(place), F.ceil(place)
    a, b = F.get(values, low.cast("int")), F.get(values, high.cast("int"))
    return F.when(a == b, a).otherwise((high - place) * a + (place - low) * b)


def exact_quantiles(df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = (), name: str = "quantiles", few: int = 10_000) -> DataFrame:
    """(by..., name): each group's quantiles, an array in the order of fractions, with linear interpolation.

    Nulls are no values; a group without any has null for each fraction, and without ``by`` there is always one row.
    A NaN is greater than all numbers. Null is a group like any other. A task orders at most ``few`` rows of a group.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)), F.col(value).cast("double").alias("_v"))
    counts = stored(rows.groupBy(*keys).agg(F.count("_v").alias("_n")), "groups")
    known = rows.filter("_v IS NOT NULL")
    places = [(F.col("_n") - 1).cast("double") * float(f) for f in fractions]

    small = _near(known, counts.filter(F.col("_n").between(1, few)), keys)
    ordered = small.groupBy(*keys).agg(F.array_sort(F.collect_list("_v")).alias("_s"), F.count("*").alias("_n")).filter("_n > 0")
    found = ordered.select(*keys, F.array(*(_interpolated(F.col("_s"), p) for p in places)).alias(name))
    large = counts.filter(F.col("_n") > few)
    if not large.isEmpty():
        found = found.unionByName(_of_large(known, large, keys, places, few, name))
    none = counts.filter("_n = 0").select(*keys, F.array(*(F.lit(None).cast("double") for _ in fractions)).alias(name))
    out = found.unionByName(none)
    return out.select(*(F.col(k).alias(c) for k, c in zip(keys, by, strict=True)), name)


def _near(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of wanted, where their keys, null or not, are equal. Spark broadcasts wanted if it is small."""
    own = wanted.select(*(F.col(k).alias(f"{k}_") for k in keys), *(c for c in wanted.columns if c not in keys))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_"))
    return rows.join(own, same).drop(*(f"{k}_" for k in keys))


def _of_large(known: DataFrame, large: DataFrame, keys: list[str], places: list[Column], few: int, name: str) -> DataFrame:
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(p).cast("long"), F.ceil(p).cast("long")) for p in places))))
    nothing = F.lit(None).cast("double")
    start = large.select(*keys, F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_before"), F.col("_n").alias("_inside"), nothing.alias("_low"), nothing.alias("_high"), nothing.alias("_found"))
    open_, settled = stored(start, "ranks"), []
    while True:
        ready = open_.filter((F.col("_inside") <= few) | F.col("_found").isNotNull())
        settled.append(_ended(known, ready, keys))
        open_ = open_.filter((F.col("_inside") > few) & F.col("_found").isNull())
        if open_.isEmpty():
            break
        open_ = stored(_narrowed(known, open_, keys), "ranks")
    each = settled[0]
    for more in settled[1:]:
        each = each.unionByName(more)
    values = each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_found"))).alias("_m"))  # two for each fraction
    out = _near(values, large, keys)

    def between(p: Column) -> Column:
        a, b = (F.try_element_at("_m", f(p).cast("long")) for f in (F.floor, F.ceil))
        return F.when(a == b, a).otherwise((F.ceil(p) - p) * a + (p - F.floor(p)) * b)

    return out.select(*keys, F.array(*map(between, places)).alias(name))


def _inside(known: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each value and each rank whose interval holds it."""
    within = (F.col("_low").isNull() | (F.col("_v") > F.col("_low"))) & (F.col("_high").isNull() | (F.col("_v") < F.col("_high")))
    return _near(known, ranks, keys).filter(within)


def _ended(known: DataFrame, ready: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _rank, _found): values of ranks that are found, or whose interval is small enough to be ordered."""
    there = ready.filter("_found IS NOT NULL").select(*keys, "_rank", "_found")
    small = _inside(known, ready.filter("_found IS NULL"), keys)
    sorted_ = small.groupBy(*keys, "_rank", "_before").agg(F.array_sort(F.collect_list("_v")).alias("_s"))
    return there.unionByName(sorted_.select(*keys, "_rank", F.get("_s", (F.col("_rank") - F.col("_before")).cast("int")).alias("_found")))


def _narrowed(known: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """One round: each rank with the part of its interval that holds it.

    Ranks of one interval share its bounds and counts. Bounds are values of the interval, one for each slot of a hash: which
    ones is left to chance, as it were, but any will do. Both aggregates keep plain numbers, so a task holds a row for
    each slot or place, however many rows it reads and groups there are.
    """
    ends = [*keys, "_low", "_high"]
    spans = ranks.select(*ends).distinct()
    slot, draw = F.pmod(F.xxhash64("_v"), F.lit(BOUNDS)), F.xxhash64("_v", F.lit(1))
    drawn = _inside(known, spans, keys).groupBy(*ends, slot.alias("_slot")).agg(F.min_by("_v", draw).alias("_v"))
    bounds = stored(drawn.groupBy(*ends).agg(F.array_sort(F.collect_set("_v")).alias("_b")), "bounds")
    # Place 2k lies below the k-th bound, place 2k + 1 on it.
    below = F.size(F.filter("_b", lambda b: b < F.col("_v")))
    place = 2 * below + F.array_contains("_b", F.col("_v")).cast("int")
    counts = _inside(known, bounds, keys).groupBy(*ends, place.alias("_p")).agg(F.count("*").alias("_c"))
    over = Window.partitionBy(*ends).orderBy("_p")  # a row for each place
    so_far = counts.withColumn("_so_far", F.sum("_c").over(over) - F.col("_c"))
    each = _near(_near(so_far, bounds, ends), ranks.select(*ends, "_rank", "_before"), ends)
    each = each.withColumn("_before", F.col("_before") + F.col("_so_far"))
    here = each.filter((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_c")))
    k = F.floor(F.col("_p") / 2).cast("int")
    on = F.col("_p") % 2 == 1
    return here.select(
        *keys, "_rank", "_before", F.col("_c").alias("_inside"),
        F.when(k > 0, F.get("_b", k - 1)).otherwise(F.col("_low")).alias("_low"),
        F.coalesce(F.get("_b", k), "_high").alias("_high"),
        F.when(on, F.get("_b", k)).alias("_found"),
    )
