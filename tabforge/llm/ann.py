"""Nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tabforge.session import checkpoint

#: Rows of one block of vectors or queries; the unit that is scored at once.
BLOCK = 4096
#: Rows a partition is meant to hold.
PART_ROWS = 3200


@dataclass
class Router:
    """A small classifier: vector -> probability of each partition (one hidden layer)."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of largest inner product of each row, itself excluded, block by block."""
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 1024):
        s = x[lo:lo + 1024] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        out[lo:lo + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12,
                       slack: float = 1.1) -> np.ndarray:
    """Parts of at most ``slack`` times the mean size that cut few edges of the graph.

    Starts from halving at the median along the widest direction and then moves each vertex to
    the part that holds most of its neighbours, best gains first, where there is room."""
    label = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        big = groups.pop()
        centred = x[big] - x[big].mean(axis=0)
        axis = np.linalg.svd(centred[:2000], full_matrices=False)[2][0]
        order = np.argsort(centred @ axis, kind="stable")
        groups += [big[order[:len(big) // 2]], big[order[len(big) // 2:]]]
    for p, members in enumerate(groups):
        label[members] = p
    room = int(np.ceil(slack * len(x) / parts))
    k = graph.shape[1]
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(len(x)), k), label[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(label, k)), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), label]
        sizes, moved = np.bincount(label, minlength=parts), 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < room:
                sizes[label[v]] -= 1
                sizes[best[v]] += 1
                label[v] = best[v]
                moved += 1
        if moved < len(x) // 200:
            break
    return label


def train_router(x: np.ndarray, graph: np.ndarray, label: np.ndarray, parts: int,
                 hidden: int = 128, epochs: int = 30, seed: int = 5) -> Router:
    """Cross-entropy against the shares of a vector's neighbours (and itself) by partition."""
    rng, (n, d) = np.random.default_rng(seed), x.shape
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), graph.shape[1]), label[graph].ravel()), 1)
    target[np.arange(n), label] += 1
    target /= target.sum(axis=1, keepdims=True)
    p = [rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden),
         rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    total = epochs * -(-n // 128)
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, 128):
            pick = order[lo:lo + 128]
            xb, step = x[pick], step + 1
            h = np.maximum(xb @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (e / e.sum(axis=1, keepdims=True) - target[pick]) / len(pick)
            dh = (dz @ p[2].T) * (h > 0)
            for i, g in enumerate((xb.T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.01 * (g * g - v[i])
                rate = 0.005 * (1 - (step - 1) / total)
                p[i] -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    return Router(*p)


def fit_router(sample: np.ndarray, parts: int, k: int = 20, target_recall: float = 0.97) -> Router:
    """Partition the sample's neighbour graph, train the classifier on nine tenths of it, and set
    ``probes`` to the fewest partitions that hold ``target_recall`` of the other tenth's
    neighbours (at indexing, every vector goes to its most probable partition)."""
    n = len(sample)
    k = min(k, n - 1)
    if n < 4 * parts or k < 1:
        zero = np.zeros((sample.shape[1], 1))
        return Router(zero, np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(sample, k)
    test = np.arange(n) % 10 == 0
    train, = np.nonzero(~test)
    inner = neighbour_graph(sample[train], k)
    label = balanced_partition(sample[train], inner, parts)
    router = train_router(sample[train], inner, label, parts)
    z = router.logits(sample)
    home, rank = z.argmax(axis=1), np.argsort(np.argsort(-z[test], axis=1, kind="stable"), axis=1)
    needed = rank[np.arange(len(rank))[:, None], home[graph[test]]]
    share = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    router.probes = int(min(parts, np.searchsorted(share, target_recall) + 1))
    return router


def _matrix(array: pa.Array) -> np.ndarray:
    """A null-free Arrow list column of one length as a float64 matrix."""
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(array), -1)


def _partitions_udf(router: Router, many: int):
    @arrow_udf("array<int>")
    def partitions(vector: pa.Array) -> pa.Array:
        if not len(vector):
            return pa.array([], pa.list_(pa.int32()))
        z = router.logits(_matrix(vector))
        return pa.array(list(np.argsort(-z, axis=1, kind="stable")[:, :many].astype(np.int32)),
                        pa.list_(pa.int32()))

    return partitions


def _block_search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qid, vid = (t.column("id").to_numpy() for t in (left, right))
        found: list[tuple] = []
        if len(qid) and len(vid):
            queries = _matrix(left.column("vector").combine_chunks())
            vectors = _matrix(right.column("vector").combine_chunks())
            for lo in range(0, len(qid), 256):
                rough = queries[lo:lo + 256] @ vectors.T
                rough[qid[lo:lo + 256, None] == vid[None, :]] = -np.inf
                kth = -np.partition(-rough, min(k, len(vid)) - 1, axis=1)[:, min(k, len(vid)) - 1]
                for i, (row, least) in enumerate(zip(rough, kth, strict=True)):
                    # products are summed again row by row, so equal vectors get equal scores
                    near = np.flatnonzero((row >= least - 1e-9 * max(1.0, abs(least))) & (row > -np.inf))
                    exact = (vectors[near] * queries[lo + i]).sum(axis=1)
                    best = np.lexsort((vid[near], -exact))[:k]
                    found += [(int(qid[lo + i]), int(vid[near[b]]), float(exact[b])) for b in best]
        ids, vids, scores = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(vids, pa.int64()),
                         "score": pa.array(scores, pa.float64())})

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector)`` of the rows that take part: an id, no null or non-finite component, not
    zero, and of the commonest length.  Rows that repeat an id count once, with the least vector."""
    rows = (vectors.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"),
                    F.col(vector_col).cast("array<double>").alias("vector")))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.coalesce(finite, F.lit(False))
                      & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False)))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def search(vectors: DataFrame, k: int = 20, every: int = 20, parts: int | None = None,
           sample_rows: int = 8192, target_recall: float = 0.97, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner product found for each
    row whose id is divisible by ``every``, ties to the smaller id.  ``parts`` follows the number
    of rows (PART_ROWS each, 16 to 256) unless given.

    Index: the neighbour graph of at most ``sample_rows`` rows (those of least id hash) is cut
    into ``parts`` balanced partitions, a classifier learns to name a vector's partitions, and
    every row is put into its most probable one.  A query visits its ``probes`` most probable
    partitions, as many as the sample needs for ``target_recall``, and is scored there against
    every vector in double precision.  Partitions are cut into blocks of at most about 4096 rows
    on both sides, so a partition that holds a third of all rows is many tasks; blocks keep their
    ``k`` best and a ranking merges them.

    Rows without id, null or zero vectors, vectors with null or non-finite components and those of
    an uncommon length take no part; see :func:`usable`.  Fewer candidates than ``k`` give fewer
    rows, an empty table an empty result.
    """
    rows = checkpoint(usable(vectors, id_col, vector_col))
    # One row per vector length, of which the commonest counts.
    shape = (rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "d").first())
    dims, total = (shape["d"], shape["n"]) if shape else (1, 0)
    rows = rows.where(F.size("vector") == dims)
    parts = parts or max(16, min(256, total // PART_ROWS))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").collect()
    router = fit_router(np.array([r[0] for r in sample], np.float64).reshape(-1, dims), parts, k,
                        target_recall)
    homes = checkpoint(rows.withColumn("part", _partitions_udf(router, 1)(F.col("vector"))[0]))
    asked = (rows.where(F.col("id") % every == 0)
             .withColumn("part", F.explode(_partitions_udf(router, router.probes)(F.col("vector")))))
    # At most ``parts`` rows each: how many blocks a partition is cut into.
    held = {r["part"]: -(-r["count"] // BLOCK) for r in homes.groupBy("part").count().collect()}
    wanted = {r["part"]: -(-r["count"] // BLOCK) for r in asked.groupBy("part").count().collect()}

    def blocks(counts: dict):
        pairs = [x for p in range(parts) for x in (F.lit(p), F.lit(counts.get(p, 1)))]
        return F.element_at(F.create_map(*pairs), F.col("part"))

    def spread(df: DataFrame, mine: dict, others: dict, own: str, other: str) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64("id"), blocks(mine)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), blocks(others) - 1)))
                .select("id", "vector", "part", F.col(own).cast("int"), F.col(other).cast("int")))

    left = spread(asked, wanted, held, "qb", "vb").groupBy("part", "qb", "vb")
    right = spread(homes, held, wanted, "vb", "qb").groupBy("part", "qb", "vb")
    near = left.cogroup(right).applyInArrow(_block_search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
