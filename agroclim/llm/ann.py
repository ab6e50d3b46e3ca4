"""Approximate nearest neighbours by learned partitions.

1. On a sample of at most ``SAMPLE`` distinct vectors (those of smallest hash, a documented
   bound) the exact neighbour graph is cut into balanced parts: a start by median splits
   along principal axes, then sweeps that move a vector to the part of most of its
   neighbours while that part has room.
2. A small classifier (one hidden layer, numpy) learns the parts of a vector and its neighbours.
3. Every vector is indexed under its most probable part. A query visits its most probable
   parts, as many as found ``RECALL`` of the nearest vectors of sampled queries that the
   classifier did not learn from.
4. Visited vectors are reranked by their cosine in double precision. Parts are dealt out in
   blocks of about ``BLOCK`` vectors and queries, so a part of copies of one vector is many
   tasks; each block returns its nearest ``k`` per query, and a query's few survivors are
   ranked together, ties to the smaller vec_id.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do those of another length than the most common one (the larger of equals) or
without vec_id; of rows with one vec_id the smallest vector counts; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroclim.llm.common import prepare, stored, table

SAMPLE = 8192
PART_SIZE = 256     # sampled vectors a part
NEIGHBOURS = 10
SWEEPS = 8
ROOM = 1.15
HIDDEN = 96
EPOCHS = 30
RECALL = 0.96
HELD_OUT = 1024
BLOCK = 4096
EVERY = 50
K = 5


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).filter("vec_id is not null and v is not null").filter(fine)
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k nearest others of each unit vector, in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1024):
        near = x[at:at + 1024] @ x.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -2
        out[at:at + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else out[at:at + 1024]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Parts of nearly equal size that cut few neighbour links."""
    label = np.zeros(len(x), dtype=np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        rows = groups.pop(int(np.argmax([len(g) for g in groups])))
        own = x[rows] - x[rows].mean(0)
        axis = np.linalg.eigh(own.T @ own)[1][:, -1]
        order = rows[np.argsort(own @ axis, kind="stable")]
        groups += [order[:len(order) // 2], order[len(order) // 2:]]
    for k, rows in enumerate(groups):
        label[rows] = k
    room = int(np.ceil(ROOM * len(x) / parts))
    for _ in range(SWEEPS):
        votes = np.zeros((len(x), parts), dtype=np.int32)
        for j in range(graph.shape[1]):
            np.add.at(votes, (np.arange(len(x)), label[graph[:, j]]), 1)
            np.add.at(votes, (graph[:, j], label), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), label]
        sizes = np.bincount(label, minlength=parts)
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[label[i]] -= 1
                sizes[best[i]] += 1
                label[i] = best[i]
    return label


class Router:
    """A classifier with one hidden layer: the probability of each part.

    ``share`` holds the share of each part in a vector's neighbourhood.
    """

    def __init__(self, x: np.ndarray, share: np.ndarray):
        parts, self.visits = share.shape[1], share.shape[1]
        rng = np.random.default_rng(3)
        d = x.shape[1]
        self.p = [rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]
        scale = d ** 0.5
        first, second, t = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(EPOCHS if parts > 1 else 0):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 256):
                own = order[at:at + 256]
                a = x[own] * scale
                h = np.maximum(a @ self.p[0] + self.p[1], 0)
                out = h @ self.p[2] + self.p[3]
                out = np.exp(out - out.max(1, keepdims=True))
                out /= out.sum(1, keepdims=True)
                out = (out - share[own]) / len(own)
                back = (out @ self.p[2].T) * (h > 0)
                t += 1
                for p, g, m, s in zip(self.p, (a.T @ back, back.sum(0), h.T @ out, out.sum(0)), first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= 0.003 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(_unit(x) * x.shape[1] ** 0.5 @ self.p[0] + self.p[1], 0)
        out = h @ self.p[2] + self.p[3]
        out = np.exp(out - out.max(1, keepdims=True))
        return out / out.sum(1, keepdims=True)


def fit(rows: DataFrame, sample: int = SAMPLE) -> Router | None:
    """The router learnt from a bounded sample of the valid vectors."""
    taken = rows.select(F.xxhash64("v").alias("h"), "v").dropDuplicates(["h"]).orderBy("h").limit(sample).toArrow()
    if not taken.num_rows:
        return None
    x = _unit(_matrix(taken.column("v").combine_chunks()))
    parts = len(x) // PART_SIZE
    if parts < 2:
        return Router(x, np.ones((len(x), 1)))
    graph = neighbour_graph(x)
    label = balanced_parts(x, graph, parts)
    share = np.zeros((len(x), parts))
    share[np.arange(len(x)), label] = 1
    for j in range(graph.shape[1]):
        np.add.at(share, (np.arange(len(x)), label[graph[:, j]]), 1)
    held = min(HELD_OUT, len(x) // 8)  # the sample's order is a hash's, so its head is random
    router = Router(x[held:], share[held:] / share[held:].sum(1, keepdims=True))
    p = router.probabilities(x)
    part = p.argmax(1)
    nearest = np.take_along_axis(graph[:held], np.argsort(-np.einsum("id,ijd->ij", x[:held], x[graph[:held]]), axis=1)[:, :K], 1)
    order = np.argsort(-p[:held], axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    reached = np.sort(np.take_along_axis(place, part[nearest], 1).ravel())
    router.visits = int(reached[min(len(reached) - 1, int(np.ceil(RECALL * len(reached))))]) + 1
    return router


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _route(shared, many: bool):
    """Rows (vec_id, v) with their part, or a row per part that a query visits."""

    def run(batches):
        router = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(1)
            p = router.probabilities(_matrix(v))
            order = np.argsort(-p, axis=1, kind="stable")
            visit = np.zeros_like(p, dtype=bool)
            visit[:, :router.visits if many else 1] = True
            row, place = np.nonzero(visit)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), v.take(pa.array(row)), pa.array(order[row, place].astype(np.int32))], names=["vec_id", "v", "part"])

    return run


def _cosines(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The measure itself, summed alike for every pair."""
    return np.einsum("ij,ij->i", q, c) / (np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", c, c)))


def _nearest(k: int):
    def run(key, queries, rows):
        import pandas as pd

        empty = pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        if not len(queries) or not len(rows):
            return empty
        q, c = np.stack(queries["v"].to_numpy()), np.stack(rows["v"].to_numpy())
        ids, own = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        unit_q, unit_c, out = _unit(q), _unit(c), []
        for at in range(0, len(q), 256):
            near = unit_q[at:at + 256] @ unit_c.T
            near[own[at:at + 256, None] == ids[None, :]] = -np.inf
            least = np.partition(near, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))]
            # everything that rounding may have put below the k-th is ranked exactly
            row, place = np.nonzero((near >= least[:, None] - 1e-9) & np.isfinite(near))
            score = _cosines(q[at + row], c[place])
            order = np.lexsort([ids[place], -score, row])
            row, place, score = row[order], place[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            keep = rank < k
            out.append(pd.DataFrame({"query_id": own[at + row[keep]], "vec_id": ids[place[keep]], "score": score[keep]}))
        return pd.concat(out) if out else empty

    return run


def _dealt(rows: DataFrame, name: str) -> DataFrame:
    """The number of blocks of each part."""
    return rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest found, of ``vectors`` (vec_id, embedding).

    Queries are the rows whose vec_id is divisible by ``every``; candidates all others.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = stored(valid_vectors(vectors))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    rows = rows.filter(F.size("v") == F.lit(lengths["d"] if lengths else 0))
    router = fit(rows)
    empty = "query_id long, rank int, vec_id long, score double"
    if router is None:
        return spark.createDataFrame([], empty)
    shared = spark.sparkContext.broadcast(router)
    routed = "vec_id long, v array<double>, part int"
    index = stored(rows.mapInArrow(_route(shared, False), routed))
    queries = stored(rows.filter(F.col("vec_id") % every == 0).mapInArrow(_route(shared, True), routed))
    # Parts are few (bounded by the sample), so these tables are too.
    blocks = F.broadcast(stored(_dealt(index, "blocks").join(_dealt(queries, "chunks"), "part")))
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = queries.join(blocks, "part").select("vec_id", "v", "part", deal("chunks").alias("chunk"), others("blocks").alias("block"))
    right = index.join(blocks, "part").select("vec_id", "v", "part", others("chunks").alias("chunk"), deal("blocks").alias("block"))
    key = ["part", "chunk", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_nearest(k), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_learned_partitions(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
