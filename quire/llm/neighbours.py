"""Approximate nearest neighbours by learned partitions.

Index. A bounded sample of the vectors (``SAMPLE``, chosen by a hash of the id)
gives a graph of near neighbours. The graph is cut into ``PARTS`` parts of
nearly equal size with few edges between them: balanced seeds by k-means, then
rounds in which vertices move to the part of most of their neighbours while a
part has room. A small classifier (one hidden layer) learns each vertex's part
and its neighbours' parts from the vector alone. Every row is then put in the part that the classifier holds most
probable. Sample and classifier have fixed sizes, whatever the table holds.

Search. The classifier gives each query's ``PROBES`` most probable parts, and
all rows of these parts are ranked by the exact measure, in double precision.

Parts are dealt into blocks of at most ``BLOCK`` rows and their queries likewise,
so a part that holds a third of the table is many units of work; each unit
returns the best ``k`` of its block for each query. The lists are then
merged.

Nulls: vectors that are null, empty, zero, or hold a null or a non-finite
component take no part, nor do vectors whose length isn't that of most; ids may repeat (a query's own id is
no candidate of it) but not be null. Ties go to the smaller id; equal vectors have exactly
equal scores, as each score is summed in the order of the components. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stored, table, with_arrow, whole_groups

SAMPLE = 8192
PARTS = 32
PROBES = 22
EDGES = 16
HIDDEN = 128
EPOCHS = 30
BLOCK = 4096
SEED = 7


def usable(vectors: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, v): the rows that take part, as arrays of doubles."""
    v = F.col(f"`{vec}`").cast("array<double>")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(f"`{id_col}`").isNotNull() & fine).select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (sizes["d"] if sizes else 0))


def graph(x: np.ndarray, edges: int = EDGES) -> np.ndarray:
    """Each row's ``edges`` nearest others by inner product."""
    k = min(edges, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 1024):
        s = x[lo:lo + 1024] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        out[lo:lo + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """A part for each vertex: at most 10 % over equal size, few edges cut."""
    n = len(x)
    room = int(np.ceil(1.1 * n / parts))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = unit[rng.choice(n, parts, replace=False)]
    for _ in range(15):
        part = (unit @ centres.T).argmax(axis=1)
        for p in range(parts):
            if (part == p).any():
                centres[p] = unit[part == p].mean(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)

    def place(score: np.ndarray) -> np.ndarray:
        """Everyone in the best part with room, the surest first."""
        best = np.sort(score, axis=1)
        order = np.argsort(-(best[:, -1] - best[:, -2] if parts > 1 else best[:, -1]), kind="stable")
        left, out = np.full(parts, room), np.empty(n, np.int64)
        wish = np.argsort(-score, axis=1)
        for i in order:
            p = next(p for p in wish[i] if left[p])
            out[i], left[p] = p, left[p] - 1
        return out

    score = unit @ centres.T
    part = place(score)
    rows = np.arange(n)
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        for j in range(near.shape[1]):
            votes[rows, part[near[:, j]]] += 1
            np.add.at(votes, (near[:, j], part), 1)
        new = place(votes + 0.5 * (np.arange(parts) == part[:, None]) + 0.1 * score)
        if (new == part).mean() > 0.995:
            return new
        part = new
    return part


class Router:
    """One hidden layer and a softmax over the parts; float32."""

    def __init__(self, x: np.ndarray, target: np.ndarray, rng: np.random.Generator, hidden: int = HIDDEN, epochs: int = EPOCHS):
        d, parts = x.shape[1], target.shape[1]
        self.scale = 1.0 / max(float(np.linalg.norm(x, axis=1).mean()), 1e-12)
        x = (x * self.scale).astype(np.float32)
        w = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, parts)), np.zeros(parts)]
        w = [a.astype(np.float32) for a in w]
        mean, square = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
        t = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 256):
                i = order[lo:lo + 256]
                h = np.maximum(x[i] @ w[0] + w[1], 0)
                z = h @ w[2] + w[3]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                dz = (p - target[i]) / len(i)
                dh = (dz @ w[2].T) * (h > 0)
                t += 1
                for a, g in enumerate((x[i].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):  # Adam
                    mean[a] = 0.9 * mean[a] + 0.1 * g
                    square[a] = 0.999 * square[a] + 0.001 * g * g
                    w[a] -= 0.003 * (1 - epoch / epochs) * (mean[a] / (1 - 0.9 ** t)) / (np.sqrt(square[a] / (1 - 0.999 ** t)) + 1e-8)
        self.w = w

    def scores(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x * self.scale).astype(np.float32) @ self.w[0] + self.w[1], 0)
        return h @ self.w[2] + self.w[3]


def fit(vectors: DataFrame, parts: int = PARTS, sample: int = SAMPLE) -> Router | None:
    """The router, fitted on at most ``sample`` vectors with the lowest hashes."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    if not rows:
        return None
    x = np.array([r["v"] for r in rows])
    rng = np.random.default_rng(SEED)
    # copies add nothing to a graph of neighbours and would fill it with themselves
    x = np.unique(x, axis=0)
    parts = max(1, min(parts, len(x) // 32))
    near = graph(x)
    part = balanced_parts(x, near, parts, rng)
    target = np.zeros((len(x), parts), np.float32)
    target[np.arange(len(x)), part] += 0.5
    for j in range(near.shape[1]):
        np.add.at(target, (np.arange(len(x)), part[near[:, j]]), 0.5 / near.shape[1])
    target /= target.sum(axis=1, keepdims=True)
    return Router(x, target, rng)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def routed(vectors: DataFrame, router: Router, probes: int) -> DataFrame:
    """(part, id, v): each row once for each of its ``probes`` best parts."""
    sent = vectors.sparkSession.sparkContext.broadcast(router)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            z = sent.value.scores(_matrix(b.column("v")))
            best = np.argsort(-z, axis=1, kind="stable")[:, :probes]
            for j in range(best.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best[:, j].astype(np.int32)), b.column("id"), b.column("v")], names=["part", "id", "v"])

    return with_arrow(vectors.select("id", "v"), go, "part int, id long, v array<double>")


def top(query_id: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` rows of (ids, x) for each query: (query, id, score)."""
    rough = q @ x.T
    own = query_id[:, None] == ids[None, :]
    rough[own] = -np.inf
    found = []
    scale = np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max(initial=0)
    for i in range(len(q)):
        n = min(k, int((~own[i]).sum()))
        if not n:
            continue
        least = np.partition(rough[i], len(ids) - n)[len(ids) - n]
        # all that may tie with the last, for the exact sums to decide
        c = np.flatnonzero((rough[i] >= least - 1e-12 * scale[i]) & ~own[i])
        exact = np.zeros(len(c))
        for j in range(q.shape[1]):
            exact += x[c, j] * q[i, j]
        best = np.lexsort((ids[c], -exact))[:n]
        found.append((np.full(n, query_id[i]), ids[c[best]], exact[best]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(a) for a in zip(*found, strict=True))


def _search(k: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, ["part", "block", "qblock"]):
            query, ids = t.column("query").to_numpy(zero_copy_only=False), t.column("id").to_numpy()
            x = _matrix(t.column("v").combine_chunks())
            for lo, hi in zip(starts, starts[1:], strict=False):
                is_q = query[lo:hi]
                if not is_q.any() or is_q.all():
                    continue
                i, xs = ids[lo:hi], x[lo:hi]
                qs = np.flatnonzero(is_q)
                for at in range(0, len(qs), 512):
                    got = top(i[qs[at:at + 512]], xs[qs[at:at + 512]], i[~is_q], xs[~is_q], k)
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in got], names=["query_id", "vec_id", "score"])
    return go


def search(base: DataFrame, queries: DataFrame, router: Router, k: int, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows that each query's
    parts hold."""
    base, queries = routed(base, router, 1), routed(queries, router, probes)
    # a row per part: how many blocks its rows and its queries make
    sizes = (base.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
             .join(queries.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("qblocks")), "part"))
    sizes = stored(sizes, "ann-sizes")

    def dealt(rows: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
        n = {"block": "blocks", "qblock": "qblocks"}
        return (rows.join(F.broadcast(sizes), "part")  # at most PARTS rows
                .withColumn(own, F.pmod(F.xxhash64("id"), F.col(n[own])).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n[other]) - 1)))
                .select("part", "block", "qblock", F.lit(is_query).alias("query"), "id", "v"))

    keys = ["part", "block", "qblock"]
    both = dealt(base, "block", "qblock", False).union(dealt(queries, "qblock", "block", True))
    found = with_arrow(both.repartition(*keys).sortWithinPartitions(*keys), _search(k), "query_id long, vec_id long, score double")
    # k rows per query and block; Spark keeps the best k of a query in each task before it shuffles them
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op6_neighbours(spark, sf_dir):
    """The 20 nearest rows of ``embeddings`` for each row whose id is divisible by 20."""
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    router = fit(rows)
    if router is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0.0).alias("score"))
    return search(rows, rows.where("id % 20 = 0"), router, 20)
