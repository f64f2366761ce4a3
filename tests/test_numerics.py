"""Exact numerics against Python's Decimal, on generated inputs."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meeple.functions import exprs

CENT = Decimal("0.01")


def half_up(x: Decimal, q: Decimal) -> Decimal:
    return x.quantize(q, rounding=ROUND_HALF_UP)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.integers(-10**12, 10**12), st.integers(-(2**62), 2**62)),
                          st.one_of(st.integers(1, 10**7), st.integers(1, 10**15)), st.sampled_from([0, 1, 2])),
                min_size=1, max_size=60))
def test_half_up_mean_matches_decimal(spark, cases):
    df = spark.createDataFrame(cases, "total long, n long, places int")
    got = df.select(
        *[F.when(F.col("places") == p, exprs.half_up_mean("total", "n", p)).alias(f"m{p}") for p in (0, 1, 2)]
    ).collect()
    for (total, n, places), row in zip(cases, got):
        with localcontext() as ctx:
            ctx.prec = 60
            expected = half_up(Decimal(total) / (Decimal(10) ** places) / Decimal(n), CENT)
        # the result is a DOUBLE: the nearest double to the exact hundredths / 100
        assert row[f"m{places}"] == float(int(expected * 100)) / 100, (total, n, places)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 10 * 86_400), min_size=1, max_size=60))
def test_duration_matches_decimal(spark, seconds):
    base = dt.datetime(2024, 1, 1)
    rows = [(base, base + dt.timedelta(seconds=s)) for s in seconds]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.select(exprs.duration_minutes("s", "e")).collect()]
    for s, value in zip(seconds, got):
        assert value == half_up(Decimal(s) / 60, Decimal("0.1"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-500, 500)), min_size=1, max_size=60))
def test_money_recovers_intended_cents(spark, cases):
    # amounts meant as k/100 but carrying binary noise from arithmetic (a + b - b)
    values = [(k / 100 + o) - o for k, o in cases]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(exprs.scaled_units("x", 2)).collect()]
    assert got == [k for k, _ in cases]
