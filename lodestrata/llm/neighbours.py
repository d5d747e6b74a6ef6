"""Approximate nearest neighbours in learned partitions of a neighbour graph."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.shared import ship, stored

#: Vectors that the router is fitted on at most, and rows for each part it makes.
SAMPLE, ROWS_PER_PART, MOST_PARTS = 8192, 512, 64
#: Queries look into as many parts as give this recall on rows of the sample that the router was not fitted on, HELD_OUT at most.
RECALL, HELD_OUT = 0.95, 512
GRAPH, HIDDEN, EPOCHS = 10, 96, 25
#: Rows and queries that meet in one task at a time.
BLOCK = 4096


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row, in blocks."""
    k = min(k, len(x) - 1)
    norms, out = (x * x).sum(axis=1), np.empty((len(x), k), dtype=np.int64)
    for i in range(0, len(x), 512):
        d = norms - 2 * (x[i : i + 512] @ x.T)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out[i : i + 512] = np.argpartition(d, k - 1, axis=1)[:, :k] if k else 0
    return out


def neighbours_in(graph: np.ndarray, label: np.ndarray, parts: int) -> np.ndarray:
    """How many neighbours of each row lie in each part."""
    cells = np.repeat(np.arange(len(graph)) * parts, graph.shape[1]) + label[graph].ravel()
    return np.bincount(cells, minlength=len(graph) * parts).reshape(len(graph), parts).astype(float)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 15, slack: float = 1.1) -> np.ndarray:
    """A part for each row: even halves along the widest direction first, then moves to the part that most neighbours lie in.

    A move must gain neighbours and find room; the largest gains go first, so parts stay within ``slack`` of even.
    """
    label, groups = np.zeros(len(x), dtype=np.int64), [(np.arange(len(x)), 0, parts)]
    while groups:
        rows, first, n = groups.pop()
        if n == 1 or not len(rows):
            label[rows] = first
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.svd(centred.T @ centred)[0][:, 0]
        order = rows[np.argsort(centred @ axis, kind="stable")]
        cut = len(order) * (n // 2) // n
        groups += [(order[:cut], first, n // 2), (order[cut:], first + n // 2, n - n // 2)]
    room = int(np.ceil(slack * len(x) / parts))
    for _ in range(rounds):
        near = neighbours_in(graph, label, parts)
        best = near.argmax(axis=1)
        gain = near[np.arange(len(x)), best] - near[np.arange(len(x)), label]
        sizes, moved = np.bincount(label, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < room:
                sizes[label[i]] -= 1
                sizes[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


class Router:
    """A network with one hidden layer that gives the probability of each part."""

    def __init__(self, x: np.ndarray, graph: np.ndarray, label: np.ndarray, parts: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std() + 1e-12
        # The target is where a row and its neighbours lie, so that queries near a border get both sides.
        target = neighbours_in(graph, label, parts)
        target[np.arange(len(x)), label] += max(1, graph.shape[1] // 2)
        target /= target.sum(axis=1, keepdims=True)
        dims = x.shape[1]
        self.w = [rng.normal(size=(dims, HIDDEN)) / np.sqrt(dims), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts)]
        m, v, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        z = (x - self.mean) / self.scale
        for _ in range(EPOCHS):
            order = rng.permutation(len(z))
            for i in range(0, len(z), 256):
                a, t = z[order[i : i + 256]], target[order[i : i + 256]]
                h = np.maximum(a @ self.w[0] + self.w[1], 0)
                out = self._softmax(h @ self.w[2] + self.w[3])
                g = (out - t) / len(a)
                back = (g @ self.w[2].T) * (h > 0)
                step += 1
                for j, grad in enumerate((a.T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                    m[j] = 0.9 * m[j] + 0.1 * grad
                    v[j] = 0.999 * v[j] + 0.001 * grad * grad
                    self.w[j] = self.w[j] - 0.003 * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _softmax(a: np.ndarray) -> np.ndarray:
        e = np.exp(a - a.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.mean) / self.scale) @ self.w[0] + self.w[1], 0)
        return self._softmax(h @ self.w[2] + self.w[3])


def fit_router(x: np.ndarray, parts: int, recall: float = RECALL, k: int = 10) -> tuple[Router, int]:
    """A router fitted on the distinct rows of ``x``, and the number of parts to look into for the recall asked for.

    The number comes from rows held out: their true neighbours in the rest against the parts the router would visit.
    """
    x = np.unique(x, axis=0)
    x = x[np.random.default_rng(3).permutation(len(x))]
    held, rest = x[: min(HELD_OUT, len(x) // 8)], x[min(HELD_OUT, len(x) // 8) :]
    graph = neighbour_graph(rest, GRAPH)
    router = Router(rest, graph, balanced_parts(rest, graph, parts), parts)
    if not len(held) or len(rest) <= k:
        return router, parts
    distance = (rest * rest).sum(axis=1) - 2 * (held @ rest.T)
    near = router(rest).argmax(axis=1)[np.argpartition(distance, k - 1, axis=1)[:, :k]]
    visit = np.argsort(np.argsort(-router(held), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(visit, near, axis=1)
    reached = [(needed < m).mean() for m in range(1, parts + 1)]
    return router, next(m for m, r in enumerate(reached, 1) if r >= min(recall, reached[-1]))


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest rows of each query but its own, by exact distance and then by id; a repeated row counts once."""
    norms, found = (rows * rows).sum(axis=1), []
    for i in range(0, len(queries), 256):
        part = queries[i : i + 256]
        rough = norms - 2 * (part @ rows.T) + (part * part).sum(axis=1)[:, None]
        margin = 1e-9 * (norms.max() + (part * part).sum(axis=1))
        for q, own, d, eps in zip(part, query_ids[i : i + 256], rough, margin, strict=True):
            d[ids == own] = np.inf
            usable = int(np.isfinite(d).sum())
            if not usable:
                continue
            # Repeated rows may fill the first k places, so the bound comes from distinct ones.
            want = k
            while True:
                at = np.flatnonzero(d <= np.partition(d, min(want, usable) - 1)[min(want, usable) - 1] + 2 * eps)
                if want >= usable or len(np.unique(ids[at])) >= k:
                    break
                want *= 2
            exact = np.sqrt(((rows[at] - q) ** 2).sum(axis=1))
            order = np.lexsort((ids[at], exact))
            pairs = dict.fromkeys(zip(ids[at][order].tolist(), exact[order].tolist(), strict=True))
            found += [(own, i, s) for i, s in list(pairs)[:k]]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found for each query, by Euclidean distance in double precision.

    A bounded sample (``sample`` distinct vectors at most, by a hash of their id) is cut into parts of even size along its
    neighbour graph, and a small network learns which part a vector belongs to. It then places every row, and sends each query to its most probable parts, where
    distances to all rows are exact: as many parts as give ``recall`` on held-out rows of the sample, and on to the next
    until they hold k candidates, so a query gets fewer than k rows only if there are fewer. There is a part for each ``ROWS_PER_PART`` rows, ``MOST_PARTS`` at most, so small tables are
    searched whole. Rows of a part are dealt into blocks by a hash of their id, so one common vector doesn't fill a task.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do those of another length than most. Ties go
    to the smaller id. A row that repeats id and vector counts once; a query id with several vectors is searched by each. Empty tables give an empty result. Long vectors are kept whole; other columns are not read, whatever their names.
    """
    spark = vectors.sparkSession
    ship(spark)

    def sound(df: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        ok = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(v, lambda c: c != 0)
        return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(ok)

    rows = sound(vectors)
    lengths = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), "length").limit(1)
    usual = lengths.first()
    asked = sound(queries)
    if usual is None:
        return asked.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    rows, asked = (d.where(F.size("v") == usual["length"]) for d in (rows, asked))
    parts = max(1, min(MOST_PARTS, usual["count"] // ROWS_PER_PART))

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = [np.stack(b["v"].to_numpy()) for b in batches if len(b)]
        router, probes = fit_router(np.concatenate(x), parts, recall, k)
        yield pd.DataFrame({"router": [pickle.dumps(router)], "probes": [probes]})

    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(sample).repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    learned = chosen.select("v").mapInPandas(fitted, "router binary, probes int").first()
    router, probes = spark.sparkContext.broadcast(learned["router"]), learned["probes"]

    def probabilities(v: pd.Series) -> np.ndarray:
        return pickle.loads(router.value)(np.stack(v.to_numpy()))

    @F.pandas_udf("int")
    def part_of(v: pd.Series) -> pd.Series:
        return pd.Series(probabilities(v).argmax(axis=1) if len(v) else [], dtype="int32")

    placed = stored(rows.withColumn("part", part_of("v")), "nn-rows")
    different = placed.select("part", "id").distinct()
    # A number per part: at most MOST_PARTS.
    offered = np.zeros(parts, dtype=np.int64)
    for part, n in different.groupBy("part").count().collect():
        offered[part] = n

    @F.pandas_udf("array<int>")
    def parts_of(v: pd.Series, own: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        order = np.argsort(-probabilities(v), axis=1, kind="stable")
        others = np.tile(offered, (len(v), 1))
        for i, there in enumerate(own):
            if there is not None:
                np.subtract.at(others[i], np.asarray(there, dtype=np.int64), 1)
        # All parts before k candidates are reached, and the one that reaches them.
        short = (np.cumsum(np.take_along_axis(others, order, axis=1), axis=1) < k).sum(axis=1) + 1
        return pd.Series([row[: max(probes, n)] for row, n in zip(order.astype("int32"), short, strict=True)], dtype=object)

    # A row is no candidate for a query of its own id.
    ids = asked.select("id").distinct()
    own = different.join(ids, "id", "left_semi").groupBy("id").agg(F.collect_list("part").alias("own"))
    looked = asked.join(own, "id", "left").withColumn("part", F.explode(parts_of("v", "own"))).drop("own")
    looked = stored(looked, "nn-queries")
    sizes = placed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    asks = looked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("askers"))
    # A row per part: at most MOST_PARTS.
    shape = F.broadcast(stored(sizes.join(asks, "part"), "nn-shape"))
    one = placed.join(shape, "part").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    one = one.withColumn("asker", F.explode(F.sequence(F.lit(0), F.col("askers") - 1))).select("part", "block", "asker", "id", "v")
    two = looked.join(shape, "part").withColumn("asker", F.pmod(F.xxhash64("id"), "askers").cast("int"))
    two = two.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("part", "block", "asker", F.col("id").alias("query"), F.col("v").alias("q"))

    def meet(block: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(block) or not len(asking):
            return pd.DataFrame({"query_id": np.zeros(0, "int64"), "vec_id": np.zeros(0, "int64"), "score": np.zeros(0)})
        return nearest(asking["query"].to_numpy(), np.stack(asking["q"].to_numpy()), block["id"].to_numpy(), np.stack(block["v"].to_numpy()), k)

    keys = ["part", "block", "asker"]
    met = one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
