"""Centroid clustering with a vantage-point tree (operator 11).

Vectors become exact integers, floor(scale * x).  Each round builds a
vantage-point tree over the centroids (a bounded number, a parameter), and
broadcasts it.  A task searches the tree for a batch of vectors at once, each
vector best first: the open node of least possible distance is visited next,
and a vector is done when that bound is beyond its best centroid.  Bounds are
inclusive, so a centroid at exactly the best distance is still seen and the
smaller number wins a tie.  Distances are exact integers; only the bounds are
rounded, and always away from pruning.

What leaves a round are sums per centroid and component, added up in the tasks
before the shuffle.  They travel as digits of ``DIGIT_BITS`` bits, so that
sums of any size stay exact; the driver gets one row per centroid, component
and digit and takes the exact floor of sum / count.

Defined results: vectors that are null, of another length, or holding a null
or non-finite component take no part; a null id counts as the text ``null`` in
the choice of first centroids; repeated rows count each time; fewer vectors
than centroids make fewer centroids; an empty centroid stays where it is; an
empty table gives no rows; extra columns are ignored.  Components whose scaled
size exceeds ``NARROW`` are computed in unbounded integers; a distance or
inertia beyond a 64-bit integer is null, while clusters and centroids stay exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare

COMPONENTS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
#: Centroids of a leaf of the tree.
LEAF = 3
#: Up to this size of a component, squared distances of 64 components fit in a 64-bit integer.
NARROW = 1 << 27
DIGIT_BITS = 40
#: Position under which a partial sum carries the number of vectors.
COUNT = -1

_LONG = (1 << 63) - 1
#: Relative width that covers the rounding of square roots and differences.
_SLACK = 2.0 ** -46


def floor_root(d2: np.ndarray) -> np.ndarray:
    """A number not above the square root: nearly exact for 64-bit integers, whole for unbounded ones."""
    if d2.dtype == object:
        return np.array([math.isqrt(v) for v in d2], object)
    return np.sqrt(d2.astype(np.float64)) * (1 - _SLACK)


def ceil_root(d2: np.ndarray) -> np.ndarray:
    """A number not below the square root."""
    if d2.dtype == object:
        return np.array([math.isqrt(v - 1) + 1 if v > 0 else 0 for v in d2], object)
    return np.sqrt(d2.astype(np.float64)) * (1 + _SLACK)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``a`` to one vector."""
    diff = a - b
    return (diff * diff).sum(axis=1)


@dataclass
class Node:
    """A leaf with its centroids, or a vantage point with an inner and an outer child.

    ``ranges`` holds for each child the least and the largest distance of its
    centroids from the vantage point, rounded outwards.
    """
    members: list[int]
    vantage: int = -1
    children: tuple[int, ...] = ()
    ranges: tuple[tuple, ...] = ()


class Tree:
    def __init__(self, centroids: list[list[int]]):
        self.wide = any(abs(x) > NARROW for c in centroids for x in c)
        self.points = np.array(centroids, object if self.wide else np.int64).reshape(len(centroids), -1)
        self.nodes: list[Node] = []
        self._build(list(range(len(centroids))))

    def _build(self, members: list[int]) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(members))
        if len(members) <= LEAF:
            return at
        # the vantage point: the member whose distances to the others spread most
        far = {m: squared(self.points[members], self.points[m]) for m in members}
        vantage = max(members, key=lambda m: (max(far[m]) - min(far[m]), -m))
        order = sorted(zip(far[vantage].tolist(), members))
        rest = [(d, m) for d, m in order if m != vantage]
        half = len(rest) // 2
        children, ranges = [], []
        for part in (rest[:half], rest[half:]):
            ends = np.array([part[0][0], part[-1][0]], object if self.wide else np.int64)
            children.append(self._build([m for _, m in part]))
            ranges.append((floor_root(ends[:1])[0], ceil_root(ends[1:])[0]))
        self.nodes[at] = Node([vantage], vantage, tuple(children), tuple(ranges))
        return at

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row the number of its nearest centroid, its squared distance, and the distances computed in all."""
        points = self.points
        if rows.dtype == object or self.wide:
            rows, points = rows.astype(object), points.astype(object)
        n = len(rows)
        kind = rows.dtype if rows.dtype == object else np.float64
        best = np.full(n, -1, np.int64)
        distance = np.zeros(n, rows.dtype)
        reach = np.full(n, math.inf, kind)          # not below the best distance
        open_ = np.full((n, len(self.nodes)), math.inf, kind)
        open_[:, 0] = 0
        live, work = np.arange(n), 0
        while len(live):
            node_of = np.argmin(open_[live], axis=1)
            least = open_[live, node_of]
            go = (least <= reach[live]) & (least < math.inf)
            live, node_of = live[go.astype(bool)], node_of[go.astype(bool)]
            for k in np.unique(node_of):
                at = live[node_of == k]
                node = self.nodes[k]
                above = open_[at, k]
                open_[at, k] = math.inf
                for m in node.members:
                    d2 = squared(rows[at], points[m])
                    work += len(at)
                    nearer = (best[at] < 0) | (d2 < distance[at]) | ((d2 == distance[at]) & (m < best[at]))
                    won = at[nearer.astype(bool)]
                    best[won], distance[won] = m, d2[nearer.astype(bool)]
                    reach[won] = ceil_root(distance[won])
                if node.children:                   # d2 is the distance to the vantage point
                    low, high = floor_root(d2), ceil_root(d2)
                    for child, (first, last) in zip(node.children, node.ranges):
                        gap = np.maximum(low - last, first - high)
                        if kind != object:          # the difference itself is rounded too
                            gap = gap - _SLACK * (high + last)
                        open_[at, child] = np.maximum(np.maximum(gap, 0), above)
        return best, distance, work


def integers(column: pa.Array, scale: int, components: int) -> np.ndarray:
    """floor(scale * x) of a batch of complete vectors, exactly."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, components)
    if not np.abs(x).max(initial=0) * scale > NARROW:
        return np.floor(x * scale).astype(np.int64)
    # a double this large is a whole number, so its product is one too
    return np.array([[math.floor(v * scale) if abs(v) < 2.0 ** 900 else int(v) * scale for v in r]
                     for r in x.tolist()], object).reshape(-1, components)


def digits(value: int) -> list[tuple[int, int]]:
    """(place, digit) of an integer; all digits carry its sign."""
    sign, left, out = (-1 if value < 0 else 1), abs(value), []
    for place in range(max(1, -(-left.bit_length() // DIGIT_BITS))):
        out.append((place, sign * (left >> DIGIT_BITS * place & (1 << DIGIT_BITS) - 1)))
    return out


def complete(rows: DataFrame, components: int) -> DataFrame:
    """(vec_id, vector of doubles) of the vectors that take part."""
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return kept.where(F.col("vector").isNotNull() & (F.size("vector") == components) & F.coalesce(good, F.lit(False)))


def first_centroids(vectors: DataFrame, k: int, scale: int, components: int) -> list[list[int]]:
    """The vectors of the k smallest sha256 of ``1:<vec_id>``, as integers."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = vectors.orderBy(key, "vector").limit(k).collect()
    if not rows:
        return []
    return integers(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), scale, components).tolist()


def sums(vectors: DataFrame, centroids: list[list[int]], scale: int, components: int) -> DataFrame:
    """(cluster, pos, place, value): component sums and counts of every cluster, as digits."""
    tree = vectors.sparkSession.sparkContext.broadcast(Tree(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            x = integers(batch.column("vector"), scale, components)
            cluster = tree.value.nearest(x)[0]
            for c in np.unique(cluster).tolist():
                own = x[cluster == c]
                was = total.setdefault(c, [0, [0] * components])
                was[0] += len(own)
                was[1] = [a + b for a, b in zip(was[1], own.sum(axis=0).tolist())]
        out = [(c, pos, place, d) for c, (n, s) in total.items() for pos, v in zip(range(COUNT, components), [n, *s])
               for place, d in digits(v)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            names=["cluster", "pos", "place", "value"])

    parts = vectors.select("vector").mapInArrow(run, "cluster int, pos int, place int, value long")
    return parts.groupBy("cluster", "pos", "place").agg(F.sum("value").alias("value"))


def moved(vectors: DataFrame, centroids: list[list[int]], scale: int, components: int) -> list[list[int]]:
    """The centroids after one round: exact floors of the means, empty ones unmoved."""
    found: dict[int, dict[int, int]] = {}
    for r in sums(vectors, centroids, scale, components).collect():
        own = found.setdefault(r["cluster"], {})
        own[r["pos"]] = own.get(r["pos"], 0) + (r["value"] << DIGIT_BITS * r["place"])
    return [[found[c][i] // found[c][COUNT] for i in range(components)] if c in found else old
            for c, old in enumerate(centroids)]


def assign(vectors: DataFrame, centroids: list[list[int]], scale: int, components: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    tree = vectors.sparkSession.sparkContext.broadcast(Tree(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance, _ = tree.value.nearest(integers(batch.column("vector"), scale, components))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()),
                 pa.array([d if d <= _LONG else None for d in distance.tolist()], pa.int64())],
                names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE,
            components: int = COMPONENTS) -> DataFrame:
    """Every complete vector of (vec_id, vector) with its cluster, distance, inertias and centroid digest."""
    spark = rows.sparkSession
    prepare(spark)
    vectors = complete(rows, components)
    centroids = first_centroids(vectors, k, scale, components)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids, scale, components)
    if centroids:
        found = materialize(assign(vectors, centroids, scale, components), "clusters")
    else:
        found = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["cluster"]: None if r["holes"] else int(r["whole"])
               for r in found.groupBy("cluster").agg(whole.alias("whole"),
                                                     F.count_if(F.col("distance").isNull()).alias("holes")).collect()}
    total = None if None in inertia.values() else sum(inertia.values())
    fits = lambda v: v if v is not None and v <= _LONG else None
    about = [(c, fits(own), fits(total), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
             for c, own in inertia.items()]
    # one row per centroid
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
