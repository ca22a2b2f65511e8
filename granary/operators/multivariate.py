"""Principal components, clusters and composite scores over numeric columns."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.statistics import standardized


def assembled(df: DataFrame, columns: list[str], scale: bool = True) -> DataFrame:
    """df with a vector column features, standardized by population deviation; rows with nulls drop out."""
    known = df.dropna(subset=columns)
    ready = standardized(known, *columns).fillna(0.0, columns) if scale else known
    return VectorAssembler(inputCols=columns, outputCol="features").transform(ready)


def principal_components(df: DataFrame, columns: list[str], k: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(df with F1..Fk, explained shares, loadings); each component's largest loading is positive."""
    vectors = assembled(df, columns)
    model = PCA(k=k, inputCol="features", outputCol="_pc").fit(vectors)
    axes = model.pc.toArray()
    sign = np.sign(axes[np.abs(axes).argmax(0), np.arange(k)])
    scores = model.transform(vectors).withColumn("_pc", vector_to_array("_pc"))
    named = {f"F{i + 1}": F.col("_pc")[i] * float(sign[i]) for i in range(k)}
    return scores.withColumns(named).drop("_pc", "features"), np.array(model.explainedVariance), axes * sign


def best_kmeans(vectors: DataFrame, k: int, seeds: int = 10, seed: int = 20) -> KMeansModel:
    """The run of least cost among several seeds."""
    runs = [KMeans(k=k, seed=seed + i, featuresCol="features").fit(vectors) for i in range(seeds)]
    return min(runs, key=lambda m: m.summary.trainingCost)


def elbow(vectors: DataFrame, largest: int = 9, seeds: int = 3) -> list[tuple[int, float]]:
    """(k, cost) for k from 2 on; for 1 the sum of squares about the mean."""
    values = vectors.select(vector_to_array("features").alias("v"))
    size = len(values.first()["v"])
    one = values.agg(*(F.var_pop(F.col("v")[i]) * F.count("*") for i in range(size))).first()
    return [(1, float(sum(one)))] + [(k, best_kmeans(vectors, k, seeds).summary.trainingCost) for k in range(2, largest + 1)]


def ward_linkage(points: np.ndarray, most: int = 20_000) -> np.ndarray:
    """Ward's hierarchy of a matrix that fits in memory: (one, other, height, size) of each join, lowest first.

    A join of row k makes the cluster n + k. Chains of nearest neighbours end in two clusters that are nearest to each
    other; these are joined at once, and the chain goes on from what is left of it. Clusters are kept by their centres
    alone, as the height of a join is sqrt(2ab / (a + b)) times the distance of centres; so time is quadratic, memory linear.
    """
    n = len(points)
    if n > most:
        raise ValueError(f"Ward's method takes time by the square of rows; {n} are more than {most}, summarize first")
    centre, size, alive = np.array(points, float), np.ones(n), np.ones(n, bool)
    joins, chain = [], []
    while len(joins) < n - 1:
        if not chain:
            chain.append(int(alive.argmax()))
        last = chain[-1]
        gap = ((centre - centre[last]) ** 2).sum(1) * (2 * size * size[last] / (size + size[last]))
        gap[~alive] = np.inf
        gap[last] = np.inf
        near = int(gap.argmin())
        if len(chain) > 1 and gap[chain[-2]] <= gap[near]:  # the one before is as near: no way on
            near = chain[-2]
            del chain[-2:]
            i, j = sorted((last, near))
            joins.append((i, j, float(np.sqrt(gap[near]))))
            both = size[i] + size[j]
            centre[i] = (size[i] * centre[i] + size[j] * centre[j]) / both
            size[i], alive[j] = both, False
        else:
            chain.append(near)
    out, name, count = np.zeros((max(n - 1, 0), 4)), list(range(n)), [1] * n
    for k, (i, j, height) in enumerate(sorted(joins, key=lambda x: x[2])):
        out[k] = (*sorted((name[i], name[j])), height, count[i] + count[j])
        name[i], count[i] = n + k, count[i] + count[j]
    return out


def ward_clusters(points: np.ndarray, distance: float) -> list[int]:
    """Labels of a cut of Ward's hierarchy at ``distance``, in the order in which clusters come first."""
    n = len(points)
    above = list(range(2 * n))
    for k, (i, j, height, _) in enumerate(ward_linkage(points)):
        if height <= distance:
            above[int(i)] = above[int(j)] = n + k
    for k in range(2 * n - 1, -1, -1):
        above[k] = above[above[k]]
    names: dict[int, int] = {}
    return [names.setdefault(above[k], len(names)) for k in range(n)]


def top_levels(links: np.ndarray, levels: int = 3) -> list[tuple[int, int, int | None, float, int]]:
    """(node, level, parent, height, size) of the root at level 0 and what is at most so many levels below it."""
    n = len(links) + 1
    out, todo = [], [(2 * n - 2, 0, None)]
    while todo:
        node, level, parent = todo.pop(0)
        own = links[node - n] if node >= n else None
        out.append((node, level, parent, float(own[2]) if own is not None else 0.0, int(own[3]) if own is not None else 1))
        if own is not None and level < levels:
            todo += [(int(own[k]), level + 1, node) for k in (0, 1)]
    return out


def labelled(vectors: DataFrame, model: KMeansModel, name: str = "cluster") -> DataFrame:
    """vectors with letters for clusters, from a on by their centres' first component, then the next ones.

    The order of a fit's clusters is an accident; that of their centres is not.
    """
    order = sorted(range(len(model.clusterCenters())), key=lambda k: tuple(model.clusterCenters()[k]))
    letters = F.array(*(F.lit(chr(97 + order.index(k))) for k in range(len(order))))
    out = model.transform(vectors)
    return out.withColumn(name, F.get(letters, F.col("prediction"))).drop("prediction")


def richest_cluster(df: DataFrame, measure: str, cluster: str = "cluster") -> DataFrame:
    """The rows of the cluster with the greatest mean of a measure, the first by name of equal ones."""
    means = df.groupBy(cluster).agg(F.avg(measure).alias("_m")).filter("_m IS NOT NULL")
    best = means.agg(F.min(F.struct(-F.col("_m"), F.col(cluster).alias("_c")))["_c"]).scalar()
    return df.filter(F.col(cluster) == best)


def refined(targets: DataFrame, everyone: DataFrame, above_mean: list[str], above: dict[str, float], without: dict[str, list]) -> DataFrame:
    """Rows of targets beyond each bound: the mean of everyone's values, or a number; and without listed values."""
    means = everyone.agg(F.struct(*(F.avg(c).alias(c) for c in above_mean) or [F.lit(0).alias("_")])).scalar()
    out = targets.withColumn("_means", means)
    for c in above_mean:
        out = out.filter(F.col(c) > F.col(f"_means.`{c}`"))
    for c, bound in above.items():
        out = out.filter(F.col(c) > bound)
    for c, values in without.items():
        out = out.filter(~F.col(c).isin(*values))
    return out.drop("_means")


def normalized(df: DataFrame, *columns: str) -> DataFrame:
    """(x - least) / (greatest - least); null where all are equal. The one row of extremes is a subquery."""
    ends = df.agg(*(F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns))
    out = df.withColumn("_r", ends.select(F.struct(*columns).alias("r")).scalar())
    low, high = (lambda c: F.col(f"_r.{c}.low")), (lambda c: F.col(f"_r.{c}.high"))
    return out.withColumns({c: (F.col(c) - low(c)) / F.nullif(high(c) - low(c), F.lit(0.0)) for c in columns}).drop("_r")
