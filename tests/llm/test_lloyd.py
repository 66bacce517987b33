from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from riskpanel.llm.lloyd import LloydConfig, cluster, cluster_report, partial_distances
from tests.llm import brute

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance string, row string, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *["clash"] * 4) for i, v in rows], SCHEMA).repartition(3)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def expected(rows, **how):
    return sorted(
        [(*r[:5], hashlib.sha256(",".join(map(str, r[5])).encode()).hexdigest()) for r in brute.clusters(rows, **how)], key=str
    )


def vectors(n, seed=3, width=64):
    rng = random.Random(seed)
    return [(i, [rng.gauss(i % 5, 1) for _ in range(width)]) for i in range(n)]


def test_equals_the_plain_version(spark):
    rows = vectors(300)
    assert got(cluster_report(frame(spark, rows))) == expected(rows)


def test_small_blocks_and_uneven_shards_change_nothing(spark):
    rows = vectors(120, seed=4, width=10)
    config = LloydConfig(clusters=5, width=10, shard_columns=4, chunk_vectors=7, blocks_per_task=2)
    assert got(cluster_report(frame(spark, rows), config)) == expected(rows, k=5, width=10)
    assert got(cluster_report(frame(spark, rows), LloydConfig(clusters=1, rounds=0, width=10))) == expected(rows, k=1, rounds=0, width=10)


def test_awkward_vectors(spark):
    base = [float(i) / 64 for i in range(64)]
    rows = [
        (1, base), (1, base), (2, base),  # a repeated row, and ties between equal centroids
        (3, None), (4, base[:63]), (5, [*base, 0.0]), (6, []), (7, [None, *base[1:]]), (8, [float("nan"), *base[1:]]),
        (9, [float("inf"), *base[1:]]), (None, [x + 1 for x in base]), (-5, [-x - 0.001 for x in base]), (0, [0.0] * 64),
    ]
    assert got(cluster_report(frame(spark, rows))) == expected(rows)
    found = {r.vec_id for r in cluster_report(frame(spark, rows)).collect()}
    assert found == {1, 2, None, -5, 0}


def test_an_empty_cluster_keeps_its_centroid(spark):
    one = [1.0] * 64
    rows = [(i, one) for i in range(20)] + [(50 + i, [float(i)] * 64) for i in range(3)]
    assert got(cluster_report(frame(spark, rows))) == expected(rows)


def test_sums_are_exact_beyond_doubles(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 5, 6]) for _ in range(64)]) for i in range(60)]
    assert got(cluster_report(frame(spark, rows))) == expected(rows)
    huge = [(i, [x * 1e30 for x in v]) for i, v in vectors(20)]
    assert [r[:2] for r in got(cluster_report(frame(spark, huge)))] == [r[:2] for r in expected(huge)]
    assert {r.distance for r in cluster(frame(spark, huge))[0].collect() if r.distance} <= {0, 2**63 - 1}


def test_partial_distances_of_shards_sum_to_the_whole():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-500, 500, (9, 12)), rng.integers(-500, 500, (4, 12))
    whole = ((x[:, None, :] - c) ** 2).sum(axis=2)
    assert (sum(partial_distances(x[:, s : s + 5], c[:, s : s + 5]) for s in range(0, 12, 5)) == whole).all()
    assert (partial_distances(x.astype(object), c) == whole).all()


def test_no_vectors(spark):
    assert cluster_report(frame(spark, [])).collect() == []
    assert cluster_report(frame(spark, [(1, None)])).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
    ]
    with pytest.raises(ValueError):
        LloydConfig(clusters=0)
