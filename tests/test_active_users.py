"""Distinct users of spans of days from bitmaps, against sets; dense numbers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meeple.operators import tables
from meeple.plans import active_users

D = dt.date(2024, 2, 20)


def _activity(spark, seed, n=400, users=60, days=50):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *(f"u{i}" for i in range(users))]), D + dt.timedelta(rng.choice([0, 1, 2, 3, rng.randrange(days)]))) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "user_id string, event_date date")


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_numbers_are_dense_and_go_on(spark, block, monkeypatch):
    monkeypatch.setattr(active_users, "USERS_PER_BLOCK", block)
    users = spark.createDataFrame([(f"u{i % 40}",) for i in range(90)] + [(None,)], "user_id string")
    first = tables.stage(active_users.number_users(users))
    assert sorted(r["number"] for r in first.collect()) == list(range(1, 41))
    more = spark.createDataFrame([(f"u{i}",) for i in range(30, 60)], "user_id string")
    second = active_users.number_users(more, first)
    assert sorted(r["number"] for r in second.collect()) == list(range(41, 61))
    assert {r["user_id"] for r in second.collect()} == {f"u{i}" for i in range(40, 60)}
    again = {tuple(r) for r in active_users.number_users(users.repartition(5)).collect()}
    assert again == {tuple(r) for r in first.collect()}
    assert active_users.number_users(users.limit(0)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_sets(spark, seed):
    rows, activity = _activity(spark, seed)
    numbers = active_users.number_users(activity)
    # numbers in several buckets of 32,768
    numbers = tables.stage(numbers.withColumn("number", F.col("number") * 10_007))
    bitmaps = tables.stage(active_users.day_bitmaps(activity, numbers))
    assert bitmaps.select("bucket").distinct().count() > 10
    seen = {}
    for u, d in rows:
        if u is not None:
            seen.setdefault(d, set()).add(u)
    union = lambda d, n: len(set().union(*(seen.get(d - dt.timedelta(k), set()) for k in range(n))))
    got = {r["event_date"]: (r["users_1d"], r["users_7d"], r["users_30d"]) for r in active_users.rolling_users(bitmaps).collect()}
    assert got == {d: (union(d, 1), union(d, 7), union(d, 30)) for d in seen}
    last = max(seen)
    assert active_users.users_of_span(bitmaps, last - dt.timedelta(9), last) == union(last, 10)
    assert active_users.users_of_span(bitmaps, D - dt.timedelta(9), D - dt.timedelta(8)) == 0


def test_windows_of_any_length(spark):
    _, activity = _activity(spark, 3)
    bitmaps = tables.stage(active_users.day_bitmaps(activity, active_users.number_users(activity)))
    for have, want in ((1, 1), (1, 2), (2, 3), (7, 8), (7, 14), (7, 28), (7, 30)):
        base = bitmaps if have == 1 else active_users.widened(bitmaps, 1, have)
        direct, stepped = active_users.widened(bitmaps, 1, want), active_users.widened(base, have, want)
        assert sorted(map(str, direct.collect())) == sorted(map(str, stepped.collect()))


def test_no_user_id_is_shuffled(spark):
    _, activity = _activity(spark, 4)
    bitmaps = tables.stage(active_users.day_bitmaps(activity, active_users.number_users(activity)))
    plan = active_users.rolling_users(bitmaps)._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan and "Exchange" in plan
