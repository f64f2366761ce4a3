"""Operator 10 against all cosines."""

import math

import numpy as np
import pytest

from meeple.llm import embeddings
from tests.llm.test_jaccard import roots

SCHEMA = "vec_id long, embedding array<float>, label int, cid string, n_links string"


def corpus(seed=0, n=400):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 3))
        if rows and rng.random() < 0.5:
            _, base, label = rows[int(rng.integers(0, len(rows)))]
            v = np.array(base) + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.06, 0.09])
        else:
            v = rng.normal(size=16)
        rows.append((i * 2, [float(np.float32(x)) for x in v], label))
    return rows


def brute(rows):
    links = []
    for a in range(len(rows)):
        x = np.array(rows[a][1])
        for b in range(a + 1, len(rows)):
            if rows[a][2] == rows[b][2]:
                y = np.array(rows[b][1])
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.93:
                    links.append((rows[a][0], rows[b][0]))
    return links


@pytest.mark.parametrize("partitions", ["3", "8"])
def test_links_and_components(spark, partitions):
    rows = corpus()
    links = brute(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    got = {r["vec_id"]: r for r in embeddings.op10_embeddings(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    part = roots([r[0] for r in rows], links)
    degree = {r[0]: 0 for r in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    found = sum(r["n_links"] for r in got.values())
    assert len(links) > 100 and found >= 0.97 * 2 * len(links)
    assert all(r["n_links"] <= degree[i] for i, r in got.items())
    assert np.mean([r["component_id"] == part[i] for i, r in got.items()]) > 0.97
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_window_reaches_over_short_partitions(spark):
    """Links of one pass are those of the sorted order, however many partitions it is cut into."""
    rows = [(i, v, 1, "a", "b") for i, (_, v, _) in enumerate(corpus(seed=3))]
    classes = spark.createDataFrame(rows, SCHEMA).select("embedding", embeddings.F.col("vec_id").alias("cid"), embeddings.F.lit(1).alias("place")).cache()
    unit = embeddings._unit(np.array([r[1] for r in rows]))
    key = embeddings._keys(unit, 1)[:, 0]
    order = np.lexsort((np.arange(len(rows)), key))
    near = unit[order] @ unit[order].T >= 0.93
    links = [(int(order[i]), int(order[j])) for i in range(len(rows)) for j in range(i + 1, min(len(rows), i + 33)) if near[i, j]]
    want = roots(list(range(len(rows))), links)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = [(r["a"], r["b"]) for r in embeddings._edges(classes, 1, 32, 0.93).filter("b IS NOT NULL").collect()]
            assert roots(list(range(len(rows))), got) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1),
        (12, [3e38, 1e30], 1),
    ]
    got = embeddings.op10_embeddings(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    have = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got)
    alone = [(i, 0, i, True) for i in range(3, 12)]
    assert have == [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), *alone, (12, 3, 1, False)]
    assert embeddings.op10_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0


def test_group_larger_than_window_and_block(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    rows = [(i, [float(x) for x in centre + rng.normal(size=16) * 0.02], 1, "a", "b") for i in range(700)]
    got = embeddings.op10_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["n_links"] for r in got} == {699} and {r["component_id"] for r in got} == {0}


def test_more_vectors_more_passes():
    counts = [embeddings.passes_for(n) for n in (10, 10**3, 10**5, 10**7)]
    assert counts == sorted(counts) and counts[0] < counts[-1]


def test_links_among_crowded_vectors(spark):
    """Pairs just above the threshold inside a label whose vectors have cosine 0.85 with each other."""
    rng = np.random.default_rng(8)
    unit = lambda v: v / np.linalg.norm(v)
    centre, vectors = unit(rng.normal(size=128)), []
    for _ in range(700):
        own = rng.normal(size=128)
        v = math.sqrt(0.85) * centre + math.sqrt(0.15) * unit(own - (own @ centre) * centre)
        side = rng.normal(size=128)
        side = unit(side - (side @ v) * v)
        vectors += [v, 0.935 * v + math.sqrt(1 - 0.935**2) * side]
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(vectors)]
    u = embeddings._unit(np.array([r[1] for r in rows]))
    near = u @ u.T >= 0.93
    links = [(int(a), int(b)) for a, b in np.argwhere(near) if a < b]
    part = roots([r[0] for r in rows], links)
    got = {r["vec_id"]: r for r in embeddings.op10_embeddings(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)).collect()}
    assert len(links) >= 650
    assert sum(r["n_links"] for r in got.values()) == 2 * len(links)
    assert all(got[i]["component_id"] == part[i] for i in got)


def test_evenly_spread_vectors_are_not_crowded(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=64)], 0) for i in range(6000)]
    classes = spark.createDataFrame(rows, "cid long, embedding array<float>, place int").cache()
    passes, usual = embeddings.passes_for(6000), embeddings._usual_signs(6000, 32)
    found = embeddings._edges(classes, passes, 32, 0.93, usual).cache()
    assert embeddings._crowded(found).count() < 300


def test_labels_of_one_hash_stay_apart(spark):
    """Two labels with the same 32-bit hash, and equal vectors under both."""
    a, b = "l328845", "l366526"
    df = spark.createDataFrame([(1, [1.0, 0.5], a), (2, [1.0, 0.5], b), (3, [1.0, 0.51], b), (4, [1.0, 0.5], a)], "vec_id long, embedding array<float>, label string")
    hashes = {r[0] for r in df.selectExpr("hash(label)").collect()}
    assert len(hashes) == 1
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.op10_embeddings(df).collect()}
    assert got == {1: (1, 1), 4: (1, 1), 2: (1, 2), 3: (1, 2)}


def around_one_direction(n, mutual, dims=64, seed=11):
    """n unit vectors of one label whose cosines with each other are about ``mutual``, each followed by
    a partner of cosine 0.935."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    centre = unit(rng.normal(size=(1, dims)))
    own = rng.normal(size=(n, dims))
    v = math.sqrt(mutual) * centre + math.sqrt(1 - mutual) * unit(own - (own @ centre.T) * centre)
    # the partner lies to the side of v and of the common direction, as another vector of the label would
    side = rng.normal(size=(n, dims))
    basis = unit(centre - (v @ centre.T) * v)
    side -= (side * v).sum(axis=1, keepdims=True) * v
    side = unit(side - (side * basis).sum(axis=1, keepdims=True) * basis)
    return np.stack([v, 0.935 * v + math.sqrt(1 - 0.935**2) * side], axis=1).reshape(2 * n, dims)


def test_signs_around_the_mean_find_links_of_vectors_with_a_common_direction(spark):
    """At mutual cosine 0.6 the passes, not the exact comparison, find the links."""
    vectors = around_one_direction(2000, 0.6)
    classes = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)], "cid long, embedding array<double>, place int")
    plans = embeddings._label_plans(classes, 0.93, 32)
    (plan,) = plans.collect()
    assert 0 < plan["passes"] <= embeddings.PASSES
    mean = embeddings._unit(vectors).mean(axis=0)
    assert np.abs(np.array(plan["centre"]) - mean).max() < 1e-6
    placed = classes.join(plans.drop("place", "dim"))
    found = embeddings._edges(placed, 0, 32, 0.93).cache()
    assert embeddings._crowded(found).count() < 0.01 * len(vectors)
    part = roots(list(range(len(vectors))), [(r["a"], r["b"]) for r in found.filter("b IS NOT NULL").collect()])
    assert np.mean([part[i] == part[i + 1] for i in range(0, len(vectors), 2)]) >= 0.99


def test_plans_by_size_and_spread(spark):
    """Small labels need no mean; labels too narrow for signs are compared exactly."""
    wide, narrow = around_one_direction(200, 0.0), around_one_direction(200, 0.99)
    rows = [(1, v) for v in wide] + [(2, v) for v in narrow] + [(3, v) for v in wide[:20]] + [(3, v[:8]) for v in wide]
    df = spark.createDataFrame([(p, [float(x) for x in v]) for p, v in rows], "place long, embedding array<double>")
    plans = {(r["place"], r["dim"]): r for r in embeddings._label_plans(df, 0.93, 32).collect()}
    assert set(plans) == {(1, 64), (2, 64), (3, 64), (3, 8)}
    assert plans[1, 64]["passes"] >= 4 and plans[1, 64]["usual"] == embeddings._usual_signs(400, 32)
    assert plans[2, 64]["passes"] == 0
    assert plans[3, 64]["centre"] is None and plans[3, 64]["usual"] == 0 and plans[3, 64]["passes"] == 2
    got = embeddings._label_plans(df.limit(0), 0.93, 32)
    assert got.count() == 0
