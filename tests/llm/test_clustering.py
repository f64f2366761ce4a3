"""Operator 11 against a plain loop and against SQL."""

import hashlib

import numpy as np
import pytest

from meeple.llm import clustering
from meeple.llm.clustering import VantageTree, cluster, squared
from meeple.testing import compare, duck_connection
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string"


def _table(spark, rows):
    return spark.createDataFrame([(i, e, 1, "x", "y") for i, e in rows], SCHEMA)


def _plain(rows, k, rounds):
    """The contract in Python integers: {id: [(cluster, distance)]}, centroids."""
    kept = []
    for i, e in rows:
        if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e):
            kept.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in e]))
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [p for _, p in order[:k]]

    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, p in kept:
            groups.setdefault(nearest(p)[1], []).append(p)
        centroids = [
            [sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)
        ]
    return sorted(((i is None, i or 0, *reversed(nearest(p))) for i, p in kept)), centroids


def _got(df):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["cluster"], r["distance"]) for r in df.collect())


def test_tree_search_equals_brute_force_with_ties():
    rng = np.random.default_rng(4)
    for spread in (1, 3, 200):  # a small spread gives many equal distances and equal centroids
        for k in (1, 2, 4, 5, 17, 60):
            centroids = rng.integers(-spread, spread + 1, size=(k, 6))
            points = rng.integers(-spread, spread + 1, size=(300, 6))
            number, distance = VantageTree.build(centroids).nearest(points)
            every = squared(points, centroids)
            assert (distance == every.min(axis=1)).all()
            assert (number == every.argmin(axis=1)).all()


def test_tree_opens_few_leaves_where_centroids_lie_apart():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-100_000, 100_000, size=(200, 2))
    points = centroids[rng.integers(0, 200, size=50)] + rng.integers(-3, 4, size=(50, 2))
    tree = VantageTree.build(centroids)
    seen = []
    plain = tree._open
    tree._open = lambda node, rows, *rest: (seen.append(len(rows) * len(tree.members[node])), plain(node, rows, *rest))
    number, _ = tree.nearest(points)
    assert (number == squared(points, centroids).argmin(axis=1)).all()
    assert sum(seen) < 0.3 * len(points) * len(centroids)


def test_large_components_stay_exact():
    centroids = np.array([[2**28, 0], [2**28, 1]], dtype=np.int64)
    number, distance = VantageTree.build(centroids).nearest(np.array([[-(2**28), 1]], dtype=np.int64))
    assert number.tolist() == [1] and distance.tolist() == [2**58]


@pytest.mark.parametrize("partitions", [1, 5])
def test_rounds_equal_a_plain_loop(spark, partitions):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=64) / 8).astype(np.float32).tolist()) for i in range(90)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # equal vectors
    rows += [rows[3]] * 5  # repeated rows
    got = cluster(_table(spark, rows).repartition(partitions), k=7, rounds=3)
    want, centroids = _plain(rows, 7, 3)
    assert _got(got) == want
    digests = {r["cluster"]: r["centroid_sha256"] for r in got.collect()}
    for c, digest in digests.items():
        assert digest == hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    total = sum(r[3] for r in want)
    assert {r["inertia"] for r in got.collect()} == {total}


def test_odd_rows(spark):
    fine = [0.5] * 64
    rows = [
        (1, fine), (2, None), (3, []), (4, [0.5] * 63), (5, [0.5] * 65), (6, [None] + fine[1:]), (7, [float("nan")] + fine[1:]),
        (8, [float("inf")] + fine[1:]), (None, fine), (9, [0.0] * 64), (10, [1e30] * 64),
    ]
    got = cluster(_table(spark, rows), k=40, rounds=2)
    want, _ = _plain(rows[:-1], 40, 2)
    assert _got(got) == want  # the too long vector 10 takes no part
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_empty_table(spark):
    got = clustering.op11_clusters(_table(spark, []))
    assert got.collect() == []
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_query_matches_sql(spark):
    got = clustering.op11_clusters(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    result = compare("op11", got, duck_connection(SF_SMALL), clustering.ORACLE_SQL)
    assert result.ok and result.types_match, result.notes
