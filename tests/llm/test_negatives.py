"""Operator 12 against plain loops and against SQL."""

import numpy as np
import pytest

from meeple.llm import negatives
from meeple.llm.negatives import ResidueRows, hard_negatives, moduli, moduli_for, reconstruct, residues, scores
from meeple.testing import compare, duck_connection
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, row string, anchor string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def _plain(rows):
    kept = []
    for i, e, label in rows:
        if label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        kept.append((i, label, [int(np.floor(256 * float(np.float32(x)))) for x in e]))
    out = []
    for i, label, p in {(i, label, tuple(p)) for i, label, p in kept if i is not None and i % 100 == 0}:
        scored = [(sum(a * b for a, b in zip(p, q)), j, m) for j, m, q in kept if len(q) == len(p)]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        for s, j, m in [x for x in scored if x[2] == label and x[1] != i][:5]:
            window = [x for x in scored if x[2] != label and 80 * s <= 100 * x[0] <= 100 * s][:5]
            out += [(i, j, r + 1, n, s, t) for r, (t, n, _) in enumerate(window)]
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_residue_products_are_exact():
    rng = np.random.default_rng(2)
    for size, largest in ((64, 256), (64, 2**27), (7, 2**29), (300, 2**26), (1, 2**30), (0, 1)):
        a = rng.integers(-largest, largest + 1, size=(9, size))
        b = rng.integers(-largest, largest + 1, size=(13, size))
        a[:2], b[:2] = largest, -largest  # the extremes
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        got = scores(ResidueRows(a.astype(float)), ResidueRows(b.astype(float)), 0, 9)
        assert got.tolist() == want


def test_moduli_and_reconstruction():
    assert all(n % d for n in moduli() for d in range(2, n))
    assert len(moduli_for(10_000)) == 2 and len(moduli_for(2.0**62)) == 7
    for value in (0, 1, -1, 2**61, -(2**61), 510, 511, -510, -511, 521_220):
        primes = moduli_for(abs(value))
        parts = [np.float32([[((value + p // 2) % p) - p // 2]]) for p in primes]
        assert reconstruct(parts, primes).tolist() == [[value]]
    assert residues(np.array([1e30, -1e30]), 1009).tolist() == [(int(1e30) + 504) % 1009 - 504, -((int(1e30) + 504) % 1009 - 504)]


@pytest.mark.parametrize("block", [7, 64, 32_768])
def test_equals_plain_loops(spark, block):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4, 8))
    rows = [(int(i), (base[i % 4] + rng.normal(size=8) * 0.4).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(0, 700, 2)]
    rows += [(1001 + i, rows[0][1], 2) for i in range(40)]  # ties, of several labels
    rows += [(2001 + i, rows[0][1], int(i % 3)) for i in range(20)]
    rows += [rows[5]] * 3 + [rows[0]] * 2  # repeated rows, a repeated anchor
    got = hard_negatives(_table(spark, rows).repartition(3), block=block)
    want = _plain(rows)
    assert len(want) > 50
    assert _got(got) == want


def test_odd_rows(spark):
    one, two = [1.0, 0.0], [0.9, 0.1]
    rows = [
        (100, one, 3), (101, one, 3), (103, two, 4), (None, one, 4), (None, one, 3), (104, None, 3), (106, one, None),
        (107, [1.0, None], 4), (108, [1.0, float("nan")], 4), (109, [float("inf"), 0.0], 4), (200, [1.0], 3), (201, [1.0], 3),
        (300, [], 3), (301, [], 3), (302, [], 5), (700, one, 9), (701, one, 0), (110, [1e30, 0.0], 4), (400, [-1.0, 0.0], 6), (401, one, 6),
        (100, two, 3),
    ]
    got = hard_negatives(_table(spark, rows))
    assert _got(got) == _plain([r for r in rows if r[0] != 110])


def test_empty_tables_and_no_anchors(spark):
    for rows in ([], [(1, [1.0], 1), (2, [1.0], 1)], [(100, [1.0], 1)]):
        got = negatives.op12_negatives(_table(spark, rows))
        assert got.collect() == []
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_query_matches_sql(spark):
    got = negatives.op12_negatives(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    result = compare("op12", got, duck_connection(SF_SMALL), negatives.ORACLE_SQL)
    assert result.ok and result.types_match, result.notes
