"""Hand-made rows for each behaviour the jobs must keep."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meeple.functions import exprs
from meeple.operators import tables
from meeple.plans import gold, segments, silver
from meeple.sources import schemas

D = dt.date(2024, 3, 1)
D2 = dt.date(2024, 3, 2)


def ts(day, h, m=0, s=0, us=0):
    return dt.datetime(day.year, day.month, day.day, h, m, s, us)


def ntz(schema: T.StructType) -> T.StructType:
    """The contract with wall-clock timestamps (no zone)."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
            for f in schema.fields
        ]
    )


def users(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_USERS)


def logins(spark, rows):
    return spark.createDataFrame(rows, ntz(schemas.RAW_LOGINS))


def sessions(spark, rows):
    return spark.createDataFrame(rows, ntz(schemas.RAW_GAME_SESSIONS))


def purchases(spark, rows):
    return spark.createDataFrame(rows, ntz(schemas.RAW_PURCHASES))


def leaderboard(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_LEADERBOARD_SNAPSHOTS)


U = [("u1", "ann", "Chile", dt.date(2024, 2, 1), 20, "Female"), ("u2", "bob", "Peru", dt.date(2024, 2, 5), 40, "Male")]


def session(sid, user, start, minutes=10, game="Arcade", score=5, result="Win"):
    return (sid, user, game, start, start + dt.timedelta(minutes=minutes), score, result, start.date())


def test_two_logins_fan_out_and_one_login_variant(spark):
    u = users(spark, U)
    lg = logins(spark, [("u1", ts(D, 9), "Web", "A", D), ("u1", ts(D, 8), "iOS", "B", D)])
    s = sessions(spark, [session("s1", "u1", ts(D, 10))])
    fanned = silver.user_sessions(s, u, lg, D)
    assert fanned.count() == 2
    one = silver.user_sessions(s, u, lg, D, one_login_per_day=True).collect()
    assert len(one) == 1
    assert (one[0]["login_device"], one[0]["login_location"]) == ("Ios", "B")


def test_session_without_login_has_null_device_which_can_win(spark):
    u = users(spark, U)
    lg = logins(spark, [("u2", ts(D, 9), "Web", "A", D)])
    s = sessions(spark, [session("s1", "u1", ts(D, 10)), session("s2", "u1", ts(D, 11)), session("s3", "u2", ts(D, 12))])
    sil = silver.user_sessions(s, u, lg, D)
    devices = sorted((r["session_id"], r["login_device"]) for r in sil.collect())
    assert devices == [("s1", None), ("s2", None), ("s3", "Web")]
    p = purchases(spark, [])
    row = gold.daily_summary_from_silver(sil, silver.purchases_enriched(p, u), D).collect()[0]
    assert row["top_device_type"] is None


def test_day_without_sessions_has_no_row_and_no_purchases_gives_null_revenue(spark):
    u = users(spark, U)
    lg = logins(spark, [])
    s = sessions(spark, [session("s1", "u1", ts(D, 10))])
    p = purchases(spark, [("p1", "u1", "Skin", 5.0, ts(D2, 10), D2)])
    sil_s = silver.user_sessions(s, u, lg)
    sil_p = silver.purchases_enriched(p, u)
    assert gold.daily_summary_from_silver(sil_s, sil_p, D2).count() == 0
    rows = gold.daily_summary_from_silver(sil_s, sil_p).collect()
    assert [r["event_date"] for r in rows] == [D]
    assert rows[0]["total_revenue"] is None and rows[0]["avg_purchase_amount"] is None


def test_ties_go_to_earlier_hour_and_smaller_device_null_last(spark):
    u = users(spark, U)
    lg = logins(spark, [("u1", ts(D, 1), "Web", "A", D), ("u2", ts(D, 1), "Android", "A", D)])
    s = sessions(
        spark,
        [session("s1", "u1", ts(D, 14)), session("s2", "u2", ts(D, 9)), session("s3", None, ts(D, 20)),
         session("s4", None, ts(D, 20, 30))],
    )
    # counts: hour 20 twice, devices: NULL twice, Web once, Android once -> NULL wins
    sil = silver.user_sessions(s, u, lg, D)
    row = gold.daily_summary_from_silver(sil, silver.purchases_enriched(purchases(spark, []), u), D).collect()[0]
    assert row["peak_hour"] == 20 and row["top_device_type"] is None
    # one session each: hours 9 and 14 tie -> 9; devices Android and Web tie -> Android
    sil2 = silver.user_sessions(s.filter(F.col("user_id").isNotNull()), u, lg, D)
    row2 = gold.daily_summary_from_silver(sil2, silver.purchases_enriched(purchases(spark, []), u), D).collect()[0]
    assert (row2["peak_hour"], row2["top_device_type"]) == (9, "Android")
    assert (row2["total_sessions"], row2["unique_active_users"]) == (2, 2)


def test_distinct_users_ignore_null_and_counts_follow_fan_out(spark):
    u = users(spark, U)
    lg = logins(spark, [("u1", ts(D, 1), "Web", "A", D), ("u1", ts(D, 2), "Web", "B", D)])
    s = sessions(spark, [session("s1", "u1", ts(D, 10)), session("s2", None, ts(D, 11))])
    sil = silver.user_sessions(s, u, lg, D)
    row = gold.daily_summary_from_silver(sil, silver.purchases_enriched(purchases(spark, []), u), D).collect()[0]
    assert row["total_sessions"] == 3  # s1 twice (two logins) + s2
    assert row["unique_active_users"] == 1


def test_age_brackets_edges(spark):
    df = spark.createDataFrame([(a,) for a in [12, 13, 17, 18, 45, 46, None]], "age int")
    got = [r[0] for r in df.select(exprs.age_bracket("age")).collect()]
    assert got == ["45+", "13-17", "13-17", "18-25", "36-45", "45+", "45+"]


def test_duration_whole_seconds_and_half_up(spark):
    rows = [
        (ts(D, 10, 0, 0, 900000), ts(D, 10, 0, 3, 100000)),  # 3 s after truncation -> 0.05 -> 0.1
        (ts(D, 10), ts(D, 10, 0, 2)),  # 2 s -> 0.033 -> 0.0
        (ts(D, 23, 50), ts(D2, 0, 20)),  # over midnight -> 30.0
    ]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz")
    got = [float(r[0]) for r in df.select(exprs.duration_minutes("s", "e")).collect()]
    assert got == [0.1, 0.0, 30.0]


def test_session_over_midnight_keeps_start_day(spark):
    u = users(spark, U)
    s = sessions(spark, [session("s1", "u1", ts(D, 23, 50), minutes=30)])
    row = silver.user_sessions(s, u, logins(spark, []), D).collect()[0]
    assert row["event_date"] == D and row["session_duration_minutes"] == 30.0


def test_money_and_means_round_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.015,)], "x double")
    assert [float(r[0]) for r in df.select(exprs.money("x")).collect()] == [1.01, 2.68, 0.02]
    agg = spark.createDataFrame([(1, 0.01), (1, 0.02), (2, -0.07), (2, -0.08)], "g int, amount double")
    out = dict(
        agg.groupBy("g")
        .agg(exprs.half_up_mean(F.sum(exprs.scaled_units("amount", 2)), F.count("amount"), 2).alias("m"))
        .collect()
    )
    assert out == {1: 0.02, 2: -0.08}


def test_labels_normalised(spark):
    u = users(spark, U)
    lg = logins(spark, [("u1", ts(D, 1), "iOS", "A", D)])
    s = sessions(spark, [session("s1", "u1", ts(D, 10), result="WIN"), session("s2", "u1", ts(D, 11), result="lose")])
    rows = {r["session_id"]: r for r in silver.user_sessions(s, u, lg, D).collect()}
    assert (rows["s1"]["result"], rows["s2"]["result"], rows["s1"]["login_device"]) == ("Win", "Lose", "Ios")
    p = purchases(spark, [("p1", "u1", "BOOST", 3.0, ts(D, 1), D), ("p2", "u1", "coins", 3.0, ts(D, 1), D)])
    items = sorted(r["item"] for r in silver.purchases_enriched(p, u, D).collect())
    assert items == ["Boost", "Coins"]


def test_purchase_quality_filters(spark):
    u = users(spark, U)
    p = purchases(
        spark,
        [("p1", None, "Skin", 3.0, ts(D, 1), D), ("p2", "u1", "Skin", 0.0, ts(D, 1), D),
         ("p3", "u1", "Skin", -1.0, ts(D, 1), D), ("p4", "u1", "Skin", 1.005, ts(D, 1), D)],
    )
    rows = silver.purchases_enriched(p, u, D).collect()
    assert [(r["purchase_id"], r["amount"], r["country"]) for r in rows] == [("p4", 1.01, "Chile")]


def test_leaderboard_score_per_session_and_rank_filter(spark):
    u = users(spark, U)
    s = sessions(
        spark,
        [session("s1", "u1", ts(D, 10), score=7), session("s2", "u1", ts(D, 11), score=9),
         session("s3", "u1", ts(D, 12), game="Ranked", score=1)],
    )
    lb = leaderboard(spark, [("u1", "Arcade", 1, D), ("u2", "Arcade", 2, D), ("u1", "Arcade", 0, D), (None, "Arcade", 3, D)])
    rows = sorted((r["user_id"], r["score"]) for r in silver.leaderboard_enriched(lb, u, s, D).collect())
    assert rows == [("u1", 7), ("u1", 9), ("u2", None)]


def _demo(spark, rows):
    return spark.createDataFrame(
        rows,
        "user_id string, gender string, age_bracket string, country string, registration_date date, "
        "total_sessions bigint, avg_session_duration double, total_spent double, num_purchases bigint",
    )


def test_zero_and_negative_account_age(spark):
    as_of = dt.date(2024, 3, 10)
    demo = _demo(
        spark,
        [
            ("today_long", "F", "18-25", "X", as_of, 0, 20.0, 0.0, 0),  # rate NULL, duration ok -> active
            ("today_short", "F", "18-25", "X", as_of, 0, 3.0, 0.0, 0),  # duration short -> inactive
            ("future", "F", "18-25", "X", dt.date(2024, 3, 20), 5, 30.0, 0.0, 0),  # rate < 0 -> inactive
            ("payer", "F", "18-25", "X", dt.date(2024, 1, 1), 0, 0.0, 1.0, 1),  # spends -> active
        ],
    )
    aged = segments.with_account_age(demo, as_of)
    active, inactive = segments.split_inactive(aged, segments.inactive_condition("rate"))
    assert sorted(r["user_id"] for r in active.collect()) == ["payer", "today_long"]
    assert sorted(r["user_id"] for r in inactive.collect()) == ["future", "today_short"]


def test_duplicate_users_active_collapse_inactive_stay(spark):
    row_active = ("a", "F", "18-25", "X", dt.date(2024, 1, 1), 50, 30.0, 5.0, 1)
    row_inactive = ("i", "F", "18-25", "X", dt.date(2024, 1, 1), 1, 1.0, 0.0, 0)
    demo = _demo(spark, [row_active, row_active, row_inactive, row_inactive])
    aged = segments.with_account_age(demo, dt.date(2024, 3, 10))
    active, inactive = segments.split_inactive(aged, segments.inactive_condition("rate"))
    assert active.count() == 1 and inactive.count() == 2


@pytest.mark.parametrize(
    "rule,expected",
    [("simple", ["few"]), ("draft", ["few", "short"]), ("rate", ["few", "short"])],
)
def test_inactive_rules(spark, rule, expected):
    demo = _demo(
        spark,
        [
            ("few", "F", "18-25", "X", dt.date(2024, 3, 1), 2, 30.0, 0.0, 0),
            ("short", "F", "18-25", "X", dt.date(2024, 3, 1), 8, 9.0, 0.0, 0),
            ("busy", "F", "18-25", "X", dt.date(2024, 3, 1), 8, 30.0, 0.0, 0),
        ],
    )
    aged = segments.with_account_age(demo, dt.date(2024, 3, 10))
    _, inactive = segments.split_inactive(aged, segments.inactive_condition(rule))
    assert sorted(r["user_id"] for r in inactive.collect()) == expected


def test_rerun_of_a_day_replaces_it(spark, tmp_dir):
    df = spark.createDataFrame([(1, D), (2, D), (3, D2)], "v int, event_date date")
    path = f"{tmp_dir}/t"
    tables.replace_partitions(df, path)
    tables.replace_partitions(df.filter(F.col("event_date") == D), path)
    assert spark.read.parquet(path).count() == 3
    tables.append(df.filter(F.col("event_date") == D), path, ["event_date"])
    assert spark.read.parquet(path).count() == 5  # parity mode doubles the day


def test_demographics_aggregates_before_joining(spark):
    u = users(spark, U)
    s = sessions(spark, [session("s1", "u1", ts(D, 10), minutes=10), session("s2", "u1", ts(D, 11), minutes=15)])
    p = purchases(spark, [("p1", "u1", "Skin", 2.5, ts(D, 1), D), ("p2", "u1", "Skin", 1.25, ts(D, 1), D), ("p3", "u1", "Coins", 1.0, ts(D, 1), D)])
    demo = gold.user_demographics(u, s, logins(spark, []), p)
    rows = {r["user_id"]: r for r in demo.collect()}
    assert (rows["u1"]["total_sessions"], rows["u1"]["avg_session_duration"]) == (2, 12.5)
    assert (rows["u1"]["total_spent"], rows["u1"]["num_purchases"]) == (4.75, 3)
    assert (rows["u2"]["total_sessions"], rows["u2"]["total_spent"], rows["u2"]["avg_session_duration"]) == (0, 0.0, 0.0)
    assert rows["u1"]["age_bracket"] == "18-25" and rows["u2"]["age_bracket"] == "36-45"


def test_login_without_a_time_comes_last(spark):
    lg = logins(spark, [("u1", None, "Web", "A", D), ("u1", ts(D, 0), "iOS", "B", D), ("u2", None, "Web", "A", D)])
    got = {r["user_id"]: r["device_type"] for r in silver.earliest_login_per_day(lg).collect()}
    assert got == {"u1": "iOS", "u2": "Web"}


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("one_login", [False, True])
def test_gold_equals_gold_from_silver(spark, repeated, one_login):
    """Gold from raw sessions + logins + purchases (no fan-out rows) equals gold from the silver
    tables: with several logins, without any, without a time, with repeated users."""
    u = users(spark, U + [("u1", "ann2", "Chile", dt.date(2024, 2, 1), 21, "Female")] * repeated)
    lg = logins(
        spark,
        [("u1", ts(D, 1), "Web", "A", D), ("u1", ts(D, 2), "web", "B", D), ("u1", ts(D, 3), "iOS", "C", D),
         ("u2", ts(D2, 3), "Android", "C", D2), ("u2", None, "Web", "C", D2)],
    )
    s = sessions(
        spark,
        [session("s1", "u1", ts(D, 10), 7), session("s2", "u1", ts(D, 10, 30), 9), session("s3", "u1", ts(D, 22), 11),
         session("s4", "u2", ts(D, 9), 13), session("s5", None, ts(D, 9), 1), session("s6", "u2", ts(D2, 9), 2),
         session("s7", "stranger", ts(D2, 9), 2)],
    )
    raw = purchases(spark, [("p1", "u1", "Skin", 2.005, ts(D, 1), D), ("p2", None, "Skin", 2.0, ts(D, 1), D), ("p3", "u2", "Skin", -2.0, ts(D, 1), D)])
    p = silver.purchases_enriched(raw, u)
    sil = silver.user_sessions(s, u, lg, one_login_per_day=one_login)
    for run_date in (None, D):
        direct = sorted(map(tuple, gold.daily_summary(s, lg, raw, u, run_date, one_login).collect()))
        via_silver = sorted(map(tuple, gold.daily_summary_from_silver(sil, p, run_date).collect()))
        assert direct == via_silver
    row = [r for r in gold.daily_summary(s, lg, raw, u, one_login_per_day=one_login).collect() if r["event_date"] == D][0]
    per_session = (1 if one_login else 3) * (2 if repeated else 1)
    assert row["total_sessions"] == 3 * per_session + 2
    assert row["peak_hour"] == (9 if per_session == 1 else 10)  # one each: 2 sessions at 9 and at 10
    if not one_login:
        d1 = sorted(map(tuple, gold.user_demographics(u, s, lg, raw).collect()))
        d2 = sorted(map(tuple, gold.user_demographics_from_silver(u, sil, p).collect()))
        assert d1 == d2 and len(d1) == 2 + repeated
