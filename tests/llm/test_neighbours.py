"""Learned partitions against brute force."""
from __future__ import annotations

import numpy as np
import pytest

from dayloom.llm import neighbours
from tests.llm.helpers import with_clashes


def brute(rows: dict, k: int = 5) -> dict:
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids], dtype=np.float64)
    norm = np.linalg.norm(x, axis=1)
    out = {}
    for at, i in enumerate(ids):
        if i % 50 == 0:
            scores = x @ x[at] / (norm * norm[at])
            out[i] = sorted(((-round(s, 9), j) for j, s in zip(ids, scores, strict=True) if j != i))[:k]
    return out


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, folder):
    vectors = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    rows = {r["vec_id"]: r["embedding"] for r in vectors.collect()}
    got = neighbours.search(with_clashes(vectors), vectors.where("vec_id % 50 = 0")).collect()
    want = brute(rows)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    right = sum((q, v) in found for q, best in want.items() for _, v in best)
    assert len(got) == 5 * len(want) and right >= 0.9 * 5 * len(want)
    for r in got:
        q, v = (np.array(rows[i], dtype=np.float64) for i in (r["query_id"], r["vec_id"]))
        assert abs(r["score"] - q @ v / np.sqrt((q @ q) * (v @ v))) < 1e-12


def test_clustered_vectors_need_few_parts():
    random = np.random.default_rng(1)
    centres = random.normal(size=(16, 32))
    points = np.repeat(centres, 60, axis=0) + 0.05 * random.normal(size=(960, 32))
    router = neighbours.fit(points, 16)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    assert router.probes(unit).sum(1).mean() < 6


def test_partition_is_balanced():
    random = np.random.default_rng(2)
    unit = random.normal(size=(600, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = np.argsort(-(unit @ unit.T), axis=1)[:, 1:11]
    start = neighbours.balanced_start(unit, 6)
    label = neighbours.balanced_partition(near, start, 6)
    assert np.bincount(label).max() <= np.ceil(neighbours.BALANCE * 100)
    assert (label[near] == label[:, None]).mean() >= (start[near] == start[:, None]).mean()


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, [nan, 1.0]), (200, [inf, 1.0]), (250, [None, 1.0]), (None, [1.0, 1.0]), (300, [2.0, 2.0]), (350, [1.0, 2.0, 3.0])]
    rows += [(i, [3.0, 0.0]) for i in range(1, 40)] + [(i, [0.0, 1.0]) for i in range(41, 45)] + [(0, [1.0, 0.0])] * 3 + [(7, [3.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted(tuple(r) for r in neighbours.search(vectors, vectors.where("vec_id % 50 = 0")).collect())
    assert [r[:3] for r in got if r[0] == 0] == [(0, n, n) for n in range(1, 6)]
    assert {r[0] for r in got} == {0, 300}
    assert neighbours.search(vectors.limit(0), vectors.limit(0)).count() == 0
    few = vectors.where("vec_id IN (0, 41, 300)")
    assert sorted(tuple(r)[:3] for r in neighbours.search(few, few.where("vec_id = 0")).collect()) == [(0, 1, 300), (0, 2, 41)]
