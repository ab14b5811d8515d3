"""Clusters against a plain loop, the curve against its definition, boxes against all distances, and defined edge cases."""

import hashlib
import math
import random
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.errors import PySparkException

from orderloom.llm import centroid_clustering as cc

SCHEMA = "vec_id long, embedding array<double>, id string, v int, row int, cluster string"


def plain(rows, k=8, rounds=10):
    """(id, cluster, distance, cluster inertia, inertia, digest) by comparing everything with everything."""
    kept = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, v), (_, j) in zip(kept, assign()):
            groups[j].append(v)
        centers = [tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else c for j, c in enumerate(centers)]
    last, per = assign(), defaultdict(int)
    for d, j in last:
        per[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, j, d, per[j], sum(per.values()), digest[j]) for (i, _), (d, j) in zip(kept, last)), key=str)


def check(frame):
    found = cc.cluster(frame).collect()
    got = sorted((tuple(r)[:6] for r in found), key=str)
    assert got == plain([(r["vec_id"], r["embedding"]) for r in frame.select("vec_id", "embedding").collect()])
    return found


@pytest.fixture
def make(spark):
    return lambda rows: spark.createDataFrame([(i, v, "x", 1, 2, "y") for i, v in rows], SCHEMA)


def test_embeddings(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def test_edge_rows(make):
    rng = random.Random(1)
    some = [(k, [rng.uniform(-1, 1) for _ in range(64)]) for k in range(40)]
    odd = [(100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [0.5] * 63 + [None]), (105, [math.nan] + [0.0] * 63),
           (106, [math.inf] * 64), (None, [0.25] * 64), (None, [-0.25] * 64), (7, [0.0] * 64), (107, [-1e-9] * 64), (108, [3e4] + [0.0] * 63)]
    check(make(some + odd + some[:5]))
    assert cc.cluster(make([])).collect() == []
    assert cc.cluster(make([(1, None)])).collect() == []
    assert cc.cluster(make([])).columns == cc.cluster(make(some)).columns
    check(make(some[:3]))
    with pytest.raises(PySparkException, match="too large"):
        cc.cluster(make([*some, (9, [1e6] + [0.0] * 63)])).collect()


def test_ties_and_a_hot_vector(make):
    same = [(k, [0.5] * 64) for k in range(300)]
    check(make(same))  # all first centroids are equal: the smallest number takes all, the others stay
    rng = random.Random(2)
    spread = [(1000 + k, [rng.choice((-0.5, 0.5)) for _ in range(64)]) for k in range(300)]
    check(make(same + spread).repartition(5))


@pytest.mark.parametrize("axes, bits", [(1, 4), (2, 3), (3, 2), (4, 2), (8, 1)])
def test_the_curve_visits_every_cell_by_unit_steps(axes, bits):
    cells = np.array(list(product(range(1 << bits), repeat=axes)))
    keys = cc.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_boxes_never_rule_out_the_nearest():
    rng = np.random.default_rng(3)
    ruled_out = 0
    for _ in range(200):
        centroids = rng.integers(-40, 40, (6, 5))
        v = rng.integers(-40, 40, 5) + rng.integers(-6, 7, (9, 5))
        among = cc.candidates(np.concatenate([v.min(0), v.max(0)]), centroids)
        distances = ((v[:, None, :] - centroids) ** 2).sum(2)
        chosen, distance = cc.nearest(v, centroids, among)
        assert (chosen == distances.argmin(1)).all() and (distance == distances.min(1)).all()
        ruled_out += 6 - len(among)
    assert ruled_out > 200


def test_blocks_rule_centroids_out(make, monkeypatch):
    monkeypatch.setattr(cc, "BLOCK", 16)
    rng = random.Random(5)
    centers = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(8)]
    rows = [(k, [x + rng.gauss(0, 0.05) for x in centers[k % 8]]) for k in range(800)]
    found = check(make(rows))
    assert sum(r["compared"] for r in found) < 3 * len(found)
