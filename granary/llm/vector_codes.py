"""Vector codes by parts: codebooks fitted exactly with metric trees of the anchors hierarchy.

A vector is cut into equal parts; each part position has a codebook of a few
entries, and a part's code is the nearest entry's index. Rounds of assignment and
averaging fit the codebooks. All arithmetic is on integers, so the result does
not depend on how rows are dealt.

Lots of vectors are made into trees once, a tree for each part position. A tree
is built from the middle: anchors are chosen one after the other, each the point
farthest from its present anchor, and take over the points that are nearer to
them (an anchor's points are tried only down to half the distance between the
two anchors). Anchors' balls are joined upwards, always the two that make the
smallest ball, and split downwards by the same method. Each ball caches its
centre, radius, and its points' sum and count.

A round walks down the trees, one level of all balls at a time. A ball inherits
its parent's list of candidate entries and strikes those that some other entry
beats at every place in the ball. Once one entry is left it owns the ball, whose
cached sum and count are added to that entry without looking at points; the
points of leaves that stay in dispute are compared with what is left of their
lists. A task sends one row for each entry and position, so a round's shuffle
doesn't grow with the vectors of a task.

Lots are bounded in components, and trees are written to the shared folder, from
which every round reads them. The driver sees codebooks alone.

Defined cases: rows whose vector is null or has a missing or non-finite component
are dropped. A vector shorter than others counts as ending in zeros, as does one
whose length is no multiple of the number of parts; empty vectors are zeros. The
first entries are the parts of the first rows by id, then by vector; with fewer
rows there are fewer entries; a null id comes last. Repeated rows count each
time. An empty table gives no rows. Components whose sums or squared distances
would exceed a long raise an error. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import discard, in_lots, materialize, ship
from granary.llm.hard_negatives import _matrix, whole_vectors

#: A tree as flat arrays. Balls' points are order[start:end]; a leaf has no children (-1); the first ball is the root.
TREE = "struct<order:array<int>,start:array<int>,end:array<int>,left:array<int>,right:array<int>,radius:array<long>,centre:array<long>,total:array<long>>"


class Tree:
    """Balls over the rows of a matrix of integers."""

    def __init__(self, points: np.ndarray, leaf: int = 32) -> None:
        self.points, self.leaf = points, leaf
        self.order = np.arange(len(points))
        self.start, self.end, self.left, self.right = [], [], [], []
        self.radius, self.centre, self.total = [], [], []
        self._grow(0, len(points))

    def _ball(self, start: int, end: int) -> int:
        own = self.points[self.order[start:end]]
        total = own.sum(0)
        centre = total // len(own)
        self.start.append(start)
        self.end.append(end)
        self.left.append(-1)
        self.right.append(-1)
        self.total.append(total)
        self.centre.append(centre)
        self.radius.append(int(((own - centre) ** 2).sum(1).max()))  # squared
        return len(self.start) - 1

    def _grow(self, start: int, end: int) -> None:
        """All balls of order[start:end], whose points are put into an order in which those of a ball are together."""
        open_ = [self._ball(start, end)]
        while open_:
            me = open_.pop()
            start, end = self.start[me], self.end[me]
            if end - start <= self.leaf or not self.radius[me]:
                continue
            groups = self._anchors(self.order[start:end])
            if len(groups) < 2:
                continue
            below = self._joined(groups)  # after the groups, the pairs in the order in which they were joined
            sizes = [len(g) for g in groups]
            for i, j in below:
                sizes.append(sizes[i] + sizes[j])
            todo = [(len(sizes) - 1, start, me)]
            while todo:
                node, at, ball = todo.pop()
                if node < len(groups):
                    open_.append(ball)
                    continue
                i, j = below[node - len(groups)]
                for child, place, side in ((i, at, self.left), (j, at + sizes[i], self.right)):
                    inside = self._leaves(child, groups, below)
                    self.order[place : place + len(inside)] = inside
                    side[ball] = self._ball(place, place + len(inside))
                    todo.append((child, place, side[ball]))

    @staticmethod
    def _leaves(node: int, groups: list[np.ndarray], below: list[tuple[int, int]]) -> np.ndarray:
        """The points under a node of the joined groups, left ones first."""
        out, todo = [], [node]
        while todo:
            k = todo.pop()
            if k < len(groups):
                out.append(groups[k])
            else:
                todo += reversed(below[k - len(groups)])
        return np.concatenate(out)

    def _anchors(self, rows: np.ndarray) -> list[np.ndarray]:
        """The rows of each of about as many anchors as the root of their number."""
        points = self.points[rows]
        owner = np.zeros(len(rows), np.int64)
        far = ((points - points[0]) ** 2).sum(1)
        chosen = [0]
        for k in range(1, max(2, int(len(rows) ** 0.5))):
            new = int(far.argmax())
            if not far[new]:
                break
            gaps = ((points[chosen] - points[new]) ** 2).sum(1)
            # A point nearer to its anchor than half the anchors' distance can't be nearer to the new one; 4 as all is squared.
            tried = np.flatnonzero(4 * far >= gaps[owner])
            own = ((points[tried] - points[new]) ** 2).sum(1)
            taken = own < far[tried]
            owner[tried[taken]], far[tried[taken]] = k, own[taken]
            chosen.append(new)
        found = (rows[owner == k] for k in range(len(chosen)))
        return [g for g in found if len(g)]

    def _joined(self, groups: list[np.ndarray]) -> list[tuple[int, int]]:
        """Pairs of nodes, the two that make the smallest ball first; node n + k is the k-th pair of n groups."""
        n = len(groups)
        count = np.array([len(g) for g in groups], float)
        centre = np.array([self.points[g].mean(0) for g in groups])
        radius = np.array([np.sqrt(((self.points[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centre, strict=True)])
        nodes, pairs = list(range(n)), []

        def sizes(i: int) -> np.ndarray:
            """Radii of the balls that would hold i's and another's."""
            gap = np.sqrt(((centre - centre[i]) ** 2).sum(1))
            out = np.maximum((gap + radius + radius[i]) / 2, np.maximum(radius, radius[i]))
            out[i] = np.inf
            return out

        cost = np.array([sizes(i) for i in range(n)])
        for k in range(n - 1):
            i, j = sorted(divmod(int(cost.argmin()), n))
            pairs.append((nodes[i], nodes[j]))
            nodes[i] = n + k
            both = count[i] + count[j]
            new = (count[i] * centre[i] + count[j] * centre[j]) / both
            radius[i] = max(np.sqrt(((centre[k] - new) ** 2).sum()) + radius[k] for k in (i, j))
            centre[i], count[i] = new, both
            cost[j], cost[:, j], centre[j] = np.inf, np.inf, np.inf
            with np.errstate(invalid="ignore"):
                cost[i] = np.where(np.isinf(centre[:, 0]), np.inf, sizes(i))
            cost[:, i] = cost[i]
        return pairs

    def record(self) -> dict[str, list]:
        flat = lambda rows: np.concatenate(rows).tolist() if rows else []
        return {
            "order": self.order.tolist(), "start": self.start, "end": self.end, "left": self.left, "right": self.right,
            "radius": self.radius, "centre": flat(self.centre), "total": flat(self.total),
        }


def owners(tree: dict[str, np.ndarray], points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(balls, entry that owns each, rows in dispute, nearest entry of each); together every point once.

    An entry is struck from a ball's list if another is nearer by more than the ball's reach, so that no point of the
    ball can be as near to it; of equal entries the first stays. Equal distances are settled at the points, by index.
    """
    apart = ((entries[:, None] - entries[None]) ** 2).sum(-1).astype(float)
    same_before = (apart == 0) & (np.arange(len(entries))[:, None] < np.arange(len(entries)))  # [j, i]: j is i, and comes first
    balls, lists = np.array([0]), np.ones((1, len(entries)), bool)
    owned, by, rows, near = [], [], [], []
    while len(balls):
        gap = ((tree["centre"][balls][:, None] - entries[None]) ** 2).sum(-1).astype(float)
        lead = gap[:, None, :] - gap[:, :, None]  # [ball, j, i]: by how much j is nearer to the centre than i
        reach = 2 * np.sqrt(tree["radius"][balls].astype(float))[:, None, None] * np.sqrt(apart)
        beaten = ((lead > reach * (1 + 1e-9) + 1e-9) | same_before) & lists[:, :, None]
        lists = lists & ~beaten.any(1)
        single = lists.sum(1) == 1
        owned.append(balls[single])
        by.append(lists[single].argmax(1))
        leaf = ~single & (tree["left"][balls] < 0)
        for ball, own in zip(balls[leaf].tolist(), lists[leaf], strict=True):
            inside, left = tree["order"][tree["start"][ball] : tree["end"][ball]], np.flatnonzero(own)
            rows.append(inside)
            near.append(left[((points[inside][:, None] - entries[left]) ** 2).sum(-1).argmin(1)])
        go = ~single & ~leaf
        balls, lists = np.concatenate([tree["left"][balls[go]], tree["right"][balls[go]]]), np.concatenate([lists[go]] * 2)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(owned), np.concatenate(by), np.concatenate(rows or none), np.concatenate(near or none)


def assigned(tree: dict[str, np.ndarray], points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Each point's nearest entry."""
    balls, by, rows, near = owners(tree, points, entries)
    out = np.zeros(len(points), np.int64)
    for ball, k in zip(balls.tolist(), by.tolist(), strict=True):
        out[tree["order"][tree["start"][ball] : tree["end"][ball]]] = k
    out[rows] = near
    return out


def summed(tree: dict[str, np.ndarray], points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of the points nearest to each entry; those of owned balls come from what the balls cache."""
    balls, by, rows, near = owners(tree, points, entries)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    np.add.at(sums, by, tree["total"][balls])
    np.add.at(counts, by, tree["end"][balls] - tree["start"][balls])
    np.add.at(sums, near, points[rows])
    np.add.at(counts, near, 1)
    return sums, counts


def _loaded(trees: pa.StructArray, p: int, width: int) -> dict[str, np.ndarray]:
    names = [f.name for f in trees.type]
    tree = {c: trees.field(c)[p].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in names}
    return tree | {c: tree[c].reshape(-1, width) for c in ("centre", "total")}


def _each_lot(batches: Iterator[pa.RecordBatch], parts: int, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[dict[str, np.ndarray]]]]:
    """(row, points of each part, tree of each part) of each lot; one is in memory at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            whole = row.column("points").flatten().to_numpy(zero_copy_only=False).reshape(-1, parts * width)
            points = [whole[:, p * width : (p + 1) * width] for p in range(parts)]
            trees = row.column("trees").flatten()
            yield row, points, [_loaded(trees, p, width) for p in range(parts)]


def tree_lots(rows: DataFrame, parts: int, width: int, lot_values: int) -> DataFrame:
    """(ids, labels, points, trees) of lots of rows (id, label, vector)."""
    id_kind, label_kind = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_lots(batches, 2, rows=max(1, lot_values // (parts * width)), size=lot_values):
            points = _matrix(batch.column(2), parts * width, np.int64)
            trees = [Tree(points[:, p * width : (p + 1) * width]).record() for p in range(parts)]
            one = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (batch.column(0), batch.column(1), pa.array(points.ravel()))]
            yield pa.RecordBatch.from_arrays([*one, pa.array([trees], TREES)], ["ids", "labels", "points", "trees"])

    return rows.mapInArrow(run, f"ids array<{id_kind}>, labels array<{label_kind}>, points array<long>, trees array<{TREE}>")


#: TREE for Arrow.
TREES = pa.list_(
    pa.struct(
        [(c, pa.list_(pa.int32())) for c in ("order", "start", "end", "left", "right")]
        + [(c, pa.list_(pa.int64())) for c in ("radius", "centre", "total")]
    )
)


def refined(lots: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks (part, entry, component) after one round; an entry without points stays."""
    parts, size, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for _, points, trees in _each_lot(batches, parts, width):
            for p in range(parts):
                s, n = summed(trees[p], points[p], books[p])
                sums[p] += s
                counts[p] += n
        p, k = np.nonzero(counts)
        columns = [pa.array(c.astype(np.int32)) for c in (p, k)] + [pa.array(counts[p, k]), pa.array(sums[p, k].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "total"])

    found = lots.select("points", "trees").mapInArrow(run, "part int, entry int, n long, total array<long>")
    each = found.select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
    sums = each.groupBy("part", "entry", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    out = books.copy()
    for r in sums.collect():  # parts x entries x width rows
        out[r["part"], r["entry"], r["at"]] = r["x"] // r["n"]
    return out


def coded(lots: DataFrame, books: np.ndarray, id_kind: str, label_kind: str) -> DataFrame:
    """(id, label, code, error) of every row."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, points, trees in _each_lot(batches, parts, width):
            codes, error = [], np.zeros(len(points[0]), np.int64)
            for p in range(parts):
                own = assigned(trees[p], points[p], books[p])
                codes.append(own)
                error += ((points[p] - books[p][own]) ** 2).sum(1)
            text = [bytes(c).hex() for c in np.stack(codes, 1).astype(np.uint8)]
            columns = [row.column("ids").flatten(), row.column("labels").flatten(), pa.array(text), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    return lots.mapInArrow(run, f"id {id_kind}, label {label_kind}, code string, error long")


def fit_codebooks(lots: DataFrame, first: np.ndarray, rounds: int) -> np.ndarray:
    books = first
    for _ in range(rounds):
        books = refined(lots, books)
    return books


def compress_vectors(
    vectors: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, lot_values: int = 1 << 18,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a whole vector.

    At most 256 entries, as each index is two hex digits. A lot of vectors has at most lot_values components.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits: at most 256 entries")
    ship(vectors.sparkSession)
    finite, whole = whole_vectors(vectors, vector, scale)
    kept = vectors.filter(finite).select(F.col(id_column).alias("id"), F.col(label).alias("label"), whole.alias("vector"))
    peak = F.max(F.coalesce(F.array_max(F.transform("vector", F.abs)), F.lit(0)))
    seen = kept.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), peak.alias("peak")).first()
    width = max(1, -(-(seen["width"] or 0) // parts))
    if (seen["peak"] or 0) >= min((2**62 // (4 * width * parts)) ** 0.5, 2**62 // max(1, seen["n"])):
        raise OverflowError(f"sums or squared distances of components up to {seen['peak']} may exceed a long")
    ends = F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(parts * width) - F.size("vector")))
    begin = kept.select("id", ends.alias("vector")).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    books = np.array([r["vector"] for r in begin], np.int64).reshape(-1, parts, width).transpose(1, 0, 2)
    lots = materialize(tree_lots(kept, parts, width, lot_values), "trees")
    if len(begin):
        books = fit_codebooks(lots, books, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    id_kind, label_kind = (kept.schema[c].dataType.simpleString() for c in ("id", "label"))
    codes = materialize(coded(lots, books, id_kind, label_kind), "codes")
    discard(lots)
    errors = codes.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("_label"), "label_error")
    return codes.join(errors, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
