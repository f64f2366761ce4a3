"""Gold kept up by change feeds equals gold of the changed tables, and reads no raw table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meeple.operators import tables
from meeple.plans import gold, gold_feed
from meeple.registry import QUERIES
from meeple.sources import schemas
from tests.conftest import SF_SMALL
from tests.test_semantics import ntz


def _raw(spark, rng, n):
    day = lambda: dt.date(2024, 3, rng.randint(1, 4))
    user = lambda: rng.choice(["a", "b", "c", "d", None])

    def at(d):
        return dt.datetime(d.year, d.month, d.day, rng.randint(0, 5), rng.randint(0, 59))

    sessions, logins, purchases = [], [], []
    for i in range(n):
        d = day()
        start = at(d)
        end = rng.choice([None, start + dt.timedelta(seconds=rng.randint(1, 9000))])
        sessions.append((f"s{i}", user(), "Arcade", start, end, 1, "win", d))
    for _ in range(n):
        d = day()
        logins.append((user(), at(d), rng.choice(["iOS", "web", None]), "X", d))
    for i in range(n // 2):
        d = day()
        purchases.append((f"p{i}", user(), "Skin", rng.choice([None, -1.0, 2.5, 3.33]), at(d), d))
    people = [(u, f"n{i}", "C", dt.date(2024, 1, 1), 20, "Male") for u in "abce" for i in range(rng.randint(0, 3))]
    return {
        "sessions": (sessions, schemas.RAW_GAME_SESSIONS), "logins": (logins, schemas.RAW_LOGINS),
        "purchases": (purchases, schemas.RAW_PURCHASES), "users": (people, schemas.RAW_USERS),
    }


def _frames(spark, raw):
    return {k: spark.createDataFrame(rows, ntz(schema) if k != "users" else schema) for k, (rows, schema) in raw.items()}


def _rows(df):
    return sorted(map(str, df.collect()))


def _changed(spark, rng, raw):
    """The raw tables with rows gone, added and altered."""
    out = {}
    for k, (rows, schema) in raw.items():
        kept = [r for r in rows if rng.random() < 0.7]
        out[k] = (kept, schema)
    extra = _raw(spark, rng, 12)
    for k in ("sessions", "purchases"):
        out[k] = (out[k][0] + [(f"{rng.random()}-{r[0]}", *r[1:]) for r in extra[k][0]], out[k][1])
    for k in ("logins", "users"):
        out[k] = (out[k][0] + extra[k][0], out[k][1])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_two_feeds_in_a_row_equal_recomputation(spark, seed):
    rng = random.Random(seed)
    raw = _raw(spark, rng, 30)
    old = _frames(spark, raw)
    state = gold_feed.state_of(**old).map(tables.stage)
    published = tables.stage(gold_feed.summary(state))
    for _ in range(2):
        raw = _changed(spark, rng, raw)
        new = _frames(spark, raw)
        feeds = {k: tables.bag_changes(old[k], new[k]) for k in old}
        feeds["sessions"] = tables.signed(tables.changes(old["sessions"], new["sessions"], ["session_id"]))
        state, days = gold_feed.advance(state, **{k: tables.stage(f) for k, f in feeds.items()})
        state = state.map(tables.stage)
        published = tables.stage(gold_feed.advance_summary(published, state, days))
        want = gold.daily_summary(new["sessions"], new["logins"], new["purchases"], new["users"])
        assert _rows(published) == _rows(want)
        assert _rows(gold_feed.demographics(new["users"], state)) == _rows(gold.user_demographics(new["users"], new["sessions"], new["logins"], new["purchases"]))
        rebuilt = gold_feed.state_of(**new)
        for name in ("sessions", "logins", "copies", "cells", "totals"):
            assert _rows(getattr(state, name)) == _rows(getattr(rebuilt, name)), name
        old = new


def test_everything_goes_and_comes_back(spark):
    rng = random.Random(9)
    full = _frames(spark, _raw(spark, rng, 20))
    none = {k: df.limit(0) for k, df in full.items()}
    state = gold_feed.state_of(**full).map(tables.stage)
    first = _rows(gold_feed.summary(state))
    for to, want in ((none, []), (full, first)):
        now = full if to is none else none
        state, _ = gold_feed.advance(state, **{k: tables.stage(tables.bag_changes(now[k], to[k])) for k in full})
        state = state.map(tables.stage)
        assert _rows(gold_feed.summary(state)) == want
        if to is none:
            assert all(getattr(state, f).isEmpty() for f in ("sessions", "logins", "purchases", "copies", "cells", "actives", "totals"))


def test_an_empty_feed_touches_no_day(spark):
    full = _frames(spark, _raw(spark, random.Random(5), 20))
    state = gold_feed.state_of(**full).map(tables.stage)
    nothing = {k: df.limit(0).withColumn(tables.WEIGHT, F.lit(1).cast("long")) for k, df in full.items()}
    after, days = gold_feed.advance(state, **nothing)
    assert days.isEmpty()
    assert _rows(gold_feed.summary(after)) == _rows(gold_feed.summary(state))


def test_no_raw_table_is_scanned(spark):
    files = QUERIES["daily_summary_from_feed"](spark, SF_SMALL).inputFiles()
    assert files and all("meeple-stages" in path for path in files)


def test_bag_changes_count_repeated_rows(spark):
    old = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    got = {tuple(r) for r in tables.bag_changes(old, new).collect()}
    assert got == {(1, "a", -1), (2, None, 1), (3, "c", 1)}
