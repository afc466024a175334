"""Approximate nearest neighbours by learned partitions (operator 8).

On a bounded sample (``SAMPLE`` vectors, those of smallest hash) the exact
neighbour graph is built and cut into partitions of near equal size by
refining a balanced start: vertices move to the partition of most of their
neighbours while it has room.  A small classifier learns which partitions a
vector's neighbours lie in.  Every row is indexed under the classifier's first
choice; a query is routed to its most probable partitions and the rows there
are reranked exactly, in double precision.  The number of partitions probed is
the smallest that reached ``TARGET`` recall on sample vectors kept out of the
training.  The number of partitions follows the sample, ``MAX_PARTITIONS`` from
4,096 vectors on and never under two, so every table is searched by the index.

Queries and rows meet in blocks of a partition, so neither a large partition
nor one vector that a third of all rows share lands in one task; each block
pair returns the best of its rows per query.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components, and rows without id, take no part; a
query's own id is no candidate; equal distances go to the smaller id; repeated rows
count once; a vec_id with several vectors is one candidate, at the distance of
its nearest one, and asks once, with its smallest vector; fewer candidates than
k give fewer rows, which holds only if there are no more in the table: too small
partitions are joined by further ones; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, prepare

SAMPLE = 6000
SAMPLE_PER_PARTITION = 64
MAX_PARTITIONS = 64
NEIGHBOURS = 10
TARGET = 0.97
HIDDEN = 96
BLOCK = 4096


@dataclass
class Router:
    """Classifier from vector to partition: one hidden layer."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest other rows of each row."""
    out = np.empty((len(x), k), np.int64)
    norm = (x * x).sum(1)
    for a in range(0, len(x), 1024):
        d = norm[a:a + 1024, None] + norm - 2 * x[a:a + 1024] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a:a + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def partition_graph(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 0.1) -> np.ndarray:
    """Balanced partition of a neighbour graph: few edges between parts, no part over (1 + slack) of its share."""
    n = len(x)
    rng = np.random.default_rng(0)
    label = np.zeros(n, np.int64)
    groups, done = [(np.arange(n), 0, parts)], []
    while groups:  # balanced start: split along random directions at the share's quantile
        rows, first, share = groups.pop()
        if share == 1:
            label[rows] = first
            done.append(first)
            continue
        along = x[rows] @ (x[rng.choice(rows)] - x[rng.choice(rows)])
        left = share // 2
        cut = len(rows) * left // share
        order = np.argsort(along, kind="stable")
        groups += [(rows[order[:cut]], first, left), (rows[order[cut:]], first + left, share - left)]
    room = int(np.ceil(n / parts * (1 + slack)))
    src = np.repeat(np.arange(n), graph.shape[1])
    edges = np.concatenate([src, graph.ravel()]), np.concatenate([graph.ravel(), src])
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (edges[0], label[edges[1]]), 1)
        size = np.bincount(label, minlength=parts)
        gain = votes.max(1) - votes[np.arange(n), label]
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            for p in np.argsort(-votes[v], kind="stable"):
                if votes[v, p] <= votes[v, label[v]]:
                    break
                if size[p] < room:
                    size[label[v]] -= 1
                    size[p] += 1
                    label[v] = p
                    moved += 1
                    break
        if not moved:
            break
    return label


def train_router(x: np.ndarray, targets: np.ndarray, hidden: int = HIDDEN, epochs: int = 30) -> Router:
    """Cross-entropy fit by Adam; ``targets`` are rows of partition shares."""
    rng = np.random.default_rng(1)
    d, parts = x.shape[1], targets.shape[1]
    mean, scale = x.mean(0), float(x.std()) or 1.0
    r = Router(mean, scale, rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden),
               rng.normal(0, (2 / hidden) ** 0.5, (hidden, parts)), np.zeros(parts))
    params = [r.w1, r.b1, r.w2, r.b2]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    z = (x - mean) / scale
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            at = order[a:a + 256]
            h = np.maximum(z[at] @ r.w1 + r.b1, 0)
            y = h @ r.w2 + r.b2
            y = np.exp(y - y.max(1, keepdims=True))
            err = (y / y.sum(1, keepdims=True) - targets[at]) / len(at)
            back = (err @ r.w2.T) * (h > 0)
            grads = [z[at].T @ back, back.sum(0), h.T @ err, err.sum(0)]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] -= 3e-3 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return r


def fit_router(x: np.ndarray, parts: int, target: float = TARGET, k: int = NEIGHBOURS) -> Router:
    """Partition the sample's neighbour graph and learn to route; the probes come from kept-out vectors."""
    k = min(k, len(x) - 1)
    if parts == 1 or k < 1 or len(x) < 4:  # too few vectors to keep one out and have neighbours
        d = x.shape[1]
        return Router(np.zeros(d), 1.0, np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    held = np.arange(len(x)) % 8 == 0
    graph = neighbour_graph(x, k)
    fitted = x[~held]
    inner = neighbour_graph(fitted, min(k, len(fitted) - 1))
    label = partition_graph(fitted, inner, parts)
    share = np.zeros((len(fitted), parts))
    np.add.at(share, (np.arange(len(fitted)), label), inner.shape[1])
    np.add.at(share, (np.repeat(np.arange(len(fitted)), inner.shape[1]), label[inner.ravel()]), 1)
    router = train_router(fitted, share / share.sum(1, keepdims=True))
    scores = router.logits(x)
    home = scores.argmax(1)
    rank = np.argsort(np.argsort(-scores[held], axis=1), axis=1)
    found = rank[np.arange(held.sum())[:, None], home[graph[held]]]
    for probes in range(1, parts + 1):
        router.probes = probes
        if (found < probes).mean() >= target:
            break
    return router


def valid(vector: Column, size: int) -> Column:
    usable = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce((F.size(vector) == size) & usable & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def nearest_in_block(k: int):
    """(queries, rows) of one block pair -> the k nearest ids of each query, each by its nearest row."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        rows, ids = _matrix(right["vector"]), right["vec_id"].to_numpy(np.int64)
        norm = (rows * rows).sum(1)
        by_id = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.diff(ids[by_id], prepend=ids[by_id[0]] - 1))
        out = []
        for q, v in zip(left["vec_id"], left["vector"]):
            v = np.asarray(v, np.float64)
            rough = norm - 2 * (rows @ v) + v @ v
            rough[ids == q] = np.inf
            if len(starts) > k:  # whatever may be among the k nearest, rounding of the rough distance included
                each = rough if len(starts) == len(ids) else np.minimum.reduceat(rough[by_id], starts)
                edge = np.partition(each, k - 1)[k - 1]
                near = np.flatnonzero(rough <= edge + 1e-9 * (1 + abs(edge) + v @ v))
            else:
                near = np.arange(len(rough))
            near = near[np.isfinite(rough[near])]
            diff = rows[near] - v
            exact = np.sqrt((diff * diff).sum(1))
            met = set()
            for i in np.lexsort((ids[near], exact)):
                if ids[near[i]] not in met:
                    met.add(ids[near[i]])
                    out.append((q, ids[near[i]], exact[i]))
                    if len(met) == k:
                        break
        return pd.DataFrame(out, columns=names)

    return run


def search(rows: DataFrame, is_query: Column, k: int = 10, sample: int = SAMPLE, probes: int | None = None,
           block: int = BLOCK) -> DataFrame:
    """(vec_id, vector) rows -> (query_id, rank, vec_id, score): each query's k nearest rows found."""
    spark = rows.sparkSession
    prepare(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>"))
    common = (rows.where("vector is not null").groupBy(F.size("vector").alias("n")).count()
              .orderBy(F.desc("count"), F.desc("n")).first())
    if common is None:
        return empty
    rows = rows.where(F.col("vec_id").isNotNull() & valid(F.col("vector"), common["n"]))
    # copies would take the places of real neighbours, in the sample as in the blocks
    rows = materialize(rows.dropDuplicates(["vec_id", "vector"]), "distinct-vectors")
    chosen = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id", "vector").limit(sample).collect()
    if len(chosen) < 2:
        return empty
    x = np.array([r["vector"] for r in chosen])
    parts = min(MAX_PARTITIONS, max(2, len(x) // SAMPLE_PER_PARTITION))
    router = fit_router(x, parts)
    parts = router.w2.shape[1]
    if probes:
        router.probes = min(probes, parts)
    shared = spark.sparkContext.broadcast(router)

    def route(batches):
        for pdf in batches:
            if len(pdf):
                best = np.argsort(-shared.value.logits(_matrix(pdf["vector"])), axis=1, kind="stable")
                yield pdf.assign(parts=list(best.astype(np.int32)))

    routed = rows.mapInPandas(route, "vec_id long, vector array<double>, parts array<int>")
    routed = routed.withColumn("part", F.col("parts")[0]).withColumn("parts", F.when(is_query, F.col("parts")))
    routed = materialize(routed, "routed")
    sizes = {r["part"]: r["n"] for r in routed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    queries = routed.where(is_query).groupBy("vec_id").agg(F.min(F.struct("vector", "parts")).alias("q"))
    # so many partitions that more than k ids are met, beyond the probes if need be; an id counts in one partition only
    ids = routed.groupBy("vec_id").agg(F.min("part").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    size = F.create_map(*[F.lit(v) for r in ids.collect() for v in (r["part"], r["n"])])
    reach = F.transform("q.parts", lambda p, i: F.struct(p.alias("part"), F.aggregate(
        F.slice("q.parts", F.lit(1), i), F.lit(0).cast("long"),
        lambda s, o: s + F.coalesce(F.try_element_at(size, o), F.lit(0)).cast("long")).alias("before"), i.alias("i")))
    wanted = F.filter(reach, lambda r: (r["i"] < router.probes) | (r["before"] <= k))
    queries = queries.select("vec_id", F.col("q.vector").alias("vector"), F.explode(wanted).alias("w"))
    queries = materialize(queries.select("vec_id", "vector", F.col("w.part").alias("part")), "routed-queries")
    asked = {r["part"]: r["n"] for r in queries.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}

    def blocks(counts: dict[int, int], per: int) -> Column:
        entries = [F.lit(v) for p in range(parts) for v in (p, max(1, -(-counts.get(p, 0) // per)))]
        return F.element_at(F.create_map(*entries), F.col("part"))

    n_row, n_query = blocks(sizes, block), blocks(asked, block // 8)
    mine = F.pmod(F.xxhash64("vec_id", "vector"), n_row)  # an id of many vectors spreads over the blocks
    other = F.pmod(F.xxhash64("vec_id"), n_query)
    spread = routed.select("part", "vec_id", "vector", mine.cast("int").alias("rb"),
                           F.explode(F.sequence(F.lit(0), n_query - 1)).alias("qb"))
    asking = queries.select("part", "vec_id", "vector", other.cast("int").alias("qb"),
                            F.explode(F.sequence(F.lit(0), n_row - 1)).alias("rb"))
    keys = ["part", "rb", "qb"]
    found = asking.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(
        nearest_in_block(k), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
