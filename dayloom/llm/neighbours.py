"""Approximate nearest neighbours by learned partitions of a neighbour graph."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 4096  # vectors that the partition and the classifier are fitted on
GRAPH_DEGREE = 10
PART_ROWS, LEAST_PARTS, MOST_PARTS = 2000, 4, 256
BALANCE = 1.1  # most rows of a part, as a multiple of the mean
TARGET_RECALL = 0.96  # of neighbours of held-out sample vectors, which sets how much probability the probed parts must hold
HIDDEN, EPOCHS, BATCH, RATE = 64, 30, 128, 0.01
BLOCK_ROWS, QUERY_ROWS = 4096, 2048
SLACK = 1e-9  # matrix products may differ from exact scores by less than this


def balanced_partition(near: np.ndarray, start: np.ndarray, parts: int, passes: int = 10) -> np.ndarray:
    """Part of each node of a neighbour graph, none above ``BALANCE`` times the mean: from balanced ``start`` labels nodes move, or swap
    through the room others leave, to where most of their neighbours are."""
    n = len(near)
    label, room = start.copy(), max(1, int(np.ceil(BALANCE * n / parts)))
    mutual: list[list[int]] = [[] for _ in range(n)]
    for a in range(n):
        for b in near[a]:
            mutual[a].append(int(b))
            mutual[int(b)].append(a)
    size = np.bincount(label, minlength=parts)
    random = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0
        for a in random.permutation(n):
            votes = np.bincount(label[mutual[a]], minlength=parts)
            votes[(size >= room) & (np.arange(parts) != label[a])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[label[a]]:
                size[label[a]] -= 1
                size[best] += 1
                label[a] = best
                moved += 1
        if moved < n / 200:
            break
    return label


def balanced_start(unit: np.ndarray, parts: int) -> np.ndarray:
    """Labels of equal numbers by repeated halving along the widest direction."""
    label = np.zeros(len(unit), dtype=np.int64)

    def split(rows: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            label[rows] = first
            return
        centred = unit[rows] - unit[rows].mean(0)
        axis = np.linalg.svd(centred.T @ centred)[0][:, 0]
        order = rows[np.argsort(centred @ axis, kind="stable")]
        half = count // 2
        at = len(rows) * half // count
        split(order[:at], first, half)
        split(order[at:], first + half, count - half)

    split(np.arange(len(unit)), 0, parts)
    return label


@dataclass
class Router:
    """A network of one hidden layer whose output is the chance of each part to hold a vector's neighbours."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    mass: float = 1.0

    def chances(self, unit: np.ndarray) -> np.ndarray:
        logits = np.maximum(unit @ self.w1 + self.b1, 0.0) @ self.w2 + self.b2
        grown = np.exp(logits - logits.max(1, keepdims=True))
        return grown / grown.sum(1, keepdims=True)

    def probes(self, unit: np.ndarray, mass: float | None = None) -> np.ndarray:
        """Which parts to search: the most probable ones until they hold ``mass``."""
        chances = self.chances(unit)
        order = np.argsort(-chances, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(chances, order, 1), 1) - np.take_along_axis(chances, order, 1)
        wanted = np.zeros_like(chances, dtype=bool)
        np.put_along_axis(wanted, order, before < (self.mass if mass is None else mass), 1)
        return wanted


def train(unit: np.ndarray, wanted: np.ndarray) -> Router:
    """Fits the network to the rows of ``wanted`` (distributions over parts) by Adam on the cross entropy."""
    random, (n, d), parts = np.random.default_rng(11), unit.shape, wanted.shape[1]
    values = [random.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), random.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at : at + BATCH]
            x, router = unit[rows], Router(*values)
            hidden = np.maximum(x @ values[0] + values[1], 0.0)
            error = (router.chances(x) - wanted[rows]) / len(rows)
            back = (error @ values[2].T) * (hidden > 0)
            slopes = [x.T @ back + 1e-4 * values[0], back.sum(0), hidden.T @ error + 1e-4 * values[2], error.sum(0)]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                values[i] = values[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*values)


def fit(sample: np.ndarray, parts: int, target: float = TARGET_RECALL) -> Router:
    """Partition of the sample's neighbour graph, network, and the probability mass that reaches ``target`` on held-out rows."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    n, degree = len(unit), min(GRAPH_DEGREE, len(sample) - 1)
    parts = max(1, min(parts, n // 4))
    if parts == 1 or degree < 1:
        d = unit.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    alike = unit @ unit.T
    np.fill_diagonal(alike, -np.inf)
    near = np.argpartition(-alike, degree - 1, axis=1)[:, :degree]
    label = balanced_partition(near, balanced_start(unit, parts), parts)
    hard = np.eye(parts)[label]
    wanted = (hard + hard[near].sum(1)) / (degree + 1)
    held = np.zeros(n, dtype=bool)
    held[np.random.default_rng(3).permutation(n)[: max(1, n // 5)]] = True
    router = train(unit[~held], wanted[~held])
    placed = router.chances(unit).argmax(1)
    for mass in np.linspace(0.5, 1.0, 51):
        searched = router.probes(unit[held], mass)
        if np.take_along_axis(searched, placed[near[held]], 1).mean() >= target:
            break
    router.mass = float(mass) if mass < 1 else 2.0
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (double) of the rows that take part: one for each vec_id, of finite components that are not all zero."""
    value = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), value.alias("embedding")).where("vec_id IS NOT NULL")
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("embedding", lambda x: x != 0.0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, target: float = TARGET_RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of all ``vectors`` for each row of ``queries``, by cosine.

    ``vec_id`` is the key of both: of rows that share one the smallest vector counts, and a query is no candidate of its own. Rows without
    vec_id, or whose vector is null, zero, holds null or non-finite components, or is not of the commonest length of the sample, take no
    part. Ties go to smaller ids; fewer candidates give fewer rows, none give none.

    Partition and network come from at most ``SAMPLE`` vectors, chosen by a hash of their id; every vector is indexed. Of equal vectors
    only the ``k + 1`` smallest ids can be in a result, so no part fills with copies. Parts are searched in blocks of bounded
    rows and queries, and each returns ``k`` rows a query.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    picked = rows.orderBy(F.xxhash64(F.lit(5), "vec_id"), "vec_id").limit(SAMPLE)
    counted = rows.agg(F.count("*")).first()[0]
    asked = usable(queries)
    n_asked = asked.agg(F.count("*")).first()[0]
    sample = [r["embedding"] for r in picked.collect()]
    sizes = pd.Series([len(v) for v in sample]).mode()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sample or not n_asked:
        return spark.createDataFrame([], schema)
    width = int(sizes.iloc[0])
    parts = int(min(MOST_PARTS, max(LEAST_PARTS, counted // PART_ROWS)))
    router = fit(np.array([v for v in sample if len(v) == width]), parts, target)
    n_blocks = max(1, -(-counted // (len(router.b2) * BLOCK_ROWS)))
    n_query_blocks = max(1, -(-n_asked // QUERY_ROWS))

    def unit(batch: pa.RecordBatch) -> np.ndarray:
        found = matrix(batch.column("embedding"))
        return found / np.linalg.norm(found, axis=1, keepdims=True)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = router.chances(unit(batch)).argmax(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=[*batch.schema.names, "part"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                searched = router.probes(unit(batch))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], searched.sum(1).cumsum()]), pa.int32()), pa.array(np.nonzero(searched)[1].astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "parts"])

    def nearest(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        v, q = np.stack(vectors["embedding"].to_list()), np.stack(queries["embedding"].to_list())
        ids, asked_ids = vectors["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        v_norm, q_norm = np.sqrt(np.einsum("ij,ij->i", v, v)), np.sqrt(np.einsum("ij,ij->i", q, q))
        v_unit, q_unit, out = v / v_norm[:, None], q / q_norm[:, None], []
        for at in range(0, len(q), 256):
            score = q_unit[at : at + 256] @ v_unit.T
            score[asked_ids[at : at + 256, None] == ids[None, :]] = -np.inf
            edge = np.partition(score, max(0, score.shape[1] - k), axis=1)[:, max(0, score.shape[1] - k)]
            a, b = np.nonzero((score >= edge[:, None] - SLACK) & (score > -np.inf))
            exact = np.einsum("ij,ij->i", q[at + a], v[b]) / (q_norm[at + a] * v_norm[b])
            found = pd.DataFrame({"query_id": asked_ids[at + a], "vec_id": ids[b], "score": exact})
            out.append(found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k))
        return pd.concat(out)

    fitting = F.size("embedding") == width
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    indexed = rows.where(fitting).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("vec_id", "embedding")
    block = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    placed = indexed.mapInArrow(place, "vec_id bigint, embedding array<double>, part int")
    placed = placed.withColumn("block", block(n_blocks, 1)).withColumn("asked", every(n_query_blocks))
    routed = asked.where(fitting).mapInArrow(route, "vec_id bigint, embedding array<double>, parts array<int>")
    routed = routed.withColumn("asked", block(n_query_blocks, 2)).withColumn("part", F.explode("parts")).drop("parts").withColumn("block", every(n_blocks))
    keys = ["part", "block", "asked"]
    found = placed.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInPandas(nearest, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
