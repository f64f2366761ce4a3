"""End-to-end jobs on a lake of Parquet tables: daily refresh, idempotence, streaming,
segmentation with model persistence."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from meeple.operators import tables
from meeple.plans import gold, jobs, silver
from meeple.sources import ingest
from meeple.sources.schemas import contract_violations
from meeple.sources.adapters import AS_OF, load_raw
from meeple.streaming import start_daily_refresh
from tests.conftest import SF_SMALL

DAYS = [dt.date(2024, 1, d) for d in (10, 11, 12)]


def build_lake(spark, base, days):
    r = load_raw(spark, SF_SMALL)
    lake = jobs.Lake(base)
    r.users.write.mode("overwrite").parquet(lake.path("raw_users"))
    for table, df in [
        ("raw_logins", r.logins), ("raw_game_sessions", r.sessions), ("raw_purchases", r.purchases),
        ("raw_leaderboard_snapshots", r.leaderboard),
    ]:
        jobs.write_raw(df.filter(F.col("event_date").isin(days)), lake, table)
    return lake, r


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_run_day_is_idempotent_and_matches_backfill(spark, tmp_dir):
    lake, r = build_lake(spark, tmp_dir, DAYS)
    for d in DAYS:
        jobs.run_day(spark, lake, d)
    jobs.run_day(spark, lake, DAYS[1], compact_files=2)  # rerun one day, with compaction
    g = lake.read(spark, "gold_daily_summary")
    assert g.count() == len(DAYS)
    expected = gold.daily_summary(r.sessions, r.logins, r.purchases, r.users).filter(F.col("event_date").isin(DAYS))
    got = g.select(*[c for c in gold.DAILY_SUMMARY_COLUMNS])
    assert [tuple(x[:1]) + tuple(x[1:]) for x in rows(got.selectExpr(
        "event_date", "cast(total_sessions as bigint)", "avg_session_duration", "cast(unique_active_users as bigint)",
        "total_revenue", "avg_purchase_amount", "top_device_type", "peak_hour"))] == rows(expected)
    in_days = lambda df: df.filter(F.col("event_date").isin(DAYS))
    demo = gold.user_demographics(r.users, in_days(r.sessions), in_days(r.logins), in_days(r.purchases))
    assert rows(jobs.demographics_from_lake(spark, lake)) == rows(demo)
    sil = lake.read(spark, "silver_user_sessions")
    assert sil.count() == silver.user_sessions(r.sessions, r.users, r.logins).filter(
        F.col("event_date").isin(DAYS)).count()


def test_streaming_refresh_picks_up_new_days(spark, tmp_dir):
    lake, r = build_lake(spark, f"{tmp_dir}/lake", DAYS[:2])
    ckpt = f"{tmp_dir}/ckpt"
    q = start_daily_refresh(spark, lake, ckpt)
    q.awaitTermination(300)
    assert lake.read(spark, "gold_daily_summary").count() == 2
    # a new day of raw files arrives
    for table, df in [("raw_logins", r.logins), ("raw_game_sessions", r.sessions), ("raw_purchases", r.purchases),
                      ("raw_leaderboard_snapshots", r.leaderboard)]:
        jobs.write_raw(df.filter(F.col("event_date") == DAYS[2]), lake, table)
    q = start_daily_refresh(spark, lake, ckpt)
    q.awaitTermination(300)
    g = lake.read(spark, "gold_daily_summary")
    assert sorted(x[0] for x in g.select("event_date").collect()) == DAYS
    # late purchases for an existing day, and nothing else: that day's revenue is refreshed
    before = g.filter(F.col("event_date") == DAYS[0]).first()["total_revenue"]
    late = r.purchases.filter(F.col("event_date") == DAYS[0]).limit(3).withColumn(
        "purchase_id", F.concat(F.lit("late-"), "purchase_id")
    ).withColumn("amount", F.lit(100.0))
    jobs.write_raw(late, lake, "raw_purchases")
    q = start_daily_refresh(spark, lake, ckpt)
    q.awaitTermination(300)
    g = lake.read(spark, "gold_daily_summary")
    after = g.filter(F.col("event_date") == DAYS[0]).first()["total_revenue"]
    copies = {r_["user_id"]: r_["copies"] for r_ in gold.repeated_users(r.users).collect()}
    known = [r_["user_id"] for r_ in late.filter(F.col("user_id").isNotNull()).collect()]
    assert round(after - (before or 0.0), 2) == sum(100.0 * copies.get(u, 1) for u in known)


def test_segmentation_jobs(spark, tmp_dir):
    lake, _ = build_lake(spark, tmp_dir, DAYS)
    for d in DAYS:
        jobs.run_day(spark, lake, d)
    path = jobs.run_segmentation(spark, lake, AS_OF, "v1")
    assert path.endswith("/v1")
    demo = lake.read(spark, "gold_user_demographics")
    n = lake.read(spark, "raw_users").count()
    assert lake.read(spark, "raw_users").select("user_id").distinct().count() <= demo.count() <= n
    assert contract_violations(demo, "gold_user_demographics_written") == []
    jobs.run_scoring(spark, lake, AS_OF)
    scored = lake.read(spark, "gold_user_demographics")  # the same table, with the same columns
    assert contract_violations(scored, "gold_user_demographics_written") == []
    assert n - 10 <= scored.count() <= n
    jobs.run_simple_segments(spark, lake)
    assert contract_violations(lake.read(spark, "gold_user_segments"), "gold_user_segments") == []
    assert contract_violations(lake.read(spark, "gold_daily_summary"), "gold_daily_summary") == []


def replace_raw(spark, lake, table, df):
    """A corrected raw table (read back first: a folder that is read cannot be overwritten)."""
    fixed = tables.stage(df)
    fixed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(lake.path(table))


def test_corrected_days_leave_no_old_rows(spark, tmp_dir):
    """A refunded day, a day whose sessions or leaderboard rows go: rerunning it leaves nothing of
    the first run, down to the demographics."""
    lake, _ = build_lake(spark, tmp_dir, DAYS[:2])
    jobs.run_days(spark, lake, DAYS[:2])
    other = rows(lake.read(spark, "gold_daily_summary").filter(F.col("event_date") == DAYS[1]))
    on_day = F.col("event_date") == DAYS[0]
    raw = lake.read(spark, "raw_purchases")
    replace_raw(spark, lake, "raw_purchases", raw.withColumn("amount", F.when(on_day, 0.0).otherwise(F.col("amount"))))
    replace_raw(spark, lake, "raw_leaderboard_snapshots", lake.read(spark, "raw_leaderboard_snapshots").filter(~on_day))
    (row,) = jobs.run_day(spark, lake, DAYS[0]).collect()
    assert row["total_revenue"] is None and row["total_sessions"] > 0
    for table in ("silver_purchases_enriched", "silver_leaderboard_enriched", "gold_purchase_cells"):
        assert lake.read(spark, table).filter(on_day).count() == 0 < lake.read(spark, table).count()
    replace_raw(spark, lake, "raw_game_sessions", lake.read(spark, "raw_game_sessions").filter(~on_day))
    assert jobs.run_day(spark, lake, DAYS[0]).count() == 0
    for table in ("silver_user_sessions", "gold_session_cells", "gold_daily_summary", "gold_user_day_metrics"):
        assert lake.read(spark, table).filter(on_day).count() == 0 < lake.read(spark, table).count()
    assert rows(lake.read(spark, "gold_daily_summary")) == other
    raws = {t: lake.read(spark, t) for t in ("raw_users", "raw_game_sessions", "raw_logins", "raw_purchases")}
    demo = gold.user_demographics(*raws.values())
    assert rows(jobs.demographics_from_lake(spark, lake)) == rows(demo)


def test_days_together_equal_day_by_day(spark, tmp_dir):
    one, _ = build_lake(spark, f"{tmp_dir}/one", DAYS)
    all_, _ = build_lake(spark, f"{tmp_dir}/all", DAYS)
    for d in DAYS:
        jobs.run_day(spark, one, d, one_login_per_day=True)
    jobs.run_days(spark, all_, DAYS, one_login_per_day=True)
    for table in jobs.LAKE_TABLES:
        if one.exists(spark, table) and not table.startswith("raw"):
            assert rows(one.read(spark, table)) == rows(all_.read(spark, table)), table
    files = [f for f in glob.glob(f"{tmp_dir}/all/silver_user_sessions/event_date=*/*.parquet")]
    assert len(files) <= 2 * len(DAYS)  # few files a day, whatever the partitions behind them
    gold_rows = all_.read(spark, "gold_daily_summary")
    silver_rows = all_.read(spark, "silver_user_sessions").groupBy("event_date").count()
    assert {r["event_date"]: r["total_sessions"] for r in gold_rows.collect()} == dict(map(tuple, silver_rows.collect()))


def test_storage_errors_are_not_empty_tables(spark, tmp_dir):
    lake = jobs.Lake(tmp_dir)
    assert not lake.exists(spark, "raw_users")
    with open(f"{tmp_dir}/gold_session_cells", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        lake.exists(spark, "gold_session_cells")


def test_crm_ingest_job_and_created_tables(spark, tmp_dir):
    r = load_raw(spark, SF_SMALL)
    lake = jobs.Lake(f"{tmp_dir}/lake")
    try:
        names = jobs.create_tables(spark, lake, "meeple_created")
        assert "meeple_created.raw_users" in names
        assert spark.table("meeple_created.silver_user_sessions").count() == 0
        assert contract_violations(spark.table("meeple_created.raw_users"), "raw_users") == []
    finally:
        spark.sql("DROP DATABASE IF EXISTS meeple_created CASCADE")
    jobs.ingest_crm(spark, lake, {
        "raw_users": ingest.crm_export(r.users), "raw_logins": ingest.crm_export(r.logins),
        "raw_game_sessions": ingest.crm_export(r.sessions), "raw_purchases": ingest.crm_export(r.purchases),
        "raw_leaderboard_snapshots": ingest.crm_export(r.leaderboard),
    })
    for table, df in (("raw_users", r.users), ("raw_purchases", r.purchases)):
        assert rows(lake.read(spark, table).select(df.columns)) == rows(df)


def test_first_day_without_activity(spark, tmp_dir):
    """The first run is a day without rows: silver and gold tables do not exist yet."""
    lake, _ = build_lake(spark, tmp_dir, DAYS[:1])
    quiet = dt.date(2024, 1, 1) - dt.timedelta(days=30)  # no rows in any raw table
    assert jobs.run_day(spark, lake, quiet).count() == 0
    assert jobs.run_day(spark, lake, DAYS[0]).count() == 1


def test_register_tables_for_sql(spark, tmp_dir):
    lake, _ = build_lake(spark, tmp_dir, DAYS[:1])
    jobs.run_day(spark, lake, DAYS[0])
    names = jobs.register_tables(spark, lake, database="meeple_sql_test")
    try:
        assert "meeple_sql_test.gold_daily_summary" in names
        n = spark.sql("SELECT count(*) FROM meeple_sql_test.gold_daily_summary").first()[0]
        assert n == 1
        preview = spark.sql("SELECT * FROM meeple_sql_test.silver_user_sessions LIMIT 100").count()
        assert 0 < preview <= 100
        day_rows = spark.sql(
            f"SELECT count(*) FROM meeple_sql_test.raw_game_sessions WHERE event_date = DATE'{DAYS[0]}'"
        ).first()[0]
        assert day_rows > 0
    finally:
        spark.sql("DROP DATABASE IF EXISTS meeple_sql_test CASCADE")


def test_active_users_by_day_from_stored_bitmaps(spark, tmp_dir):
    lake, r = build_lake(spark, tmp_dir, DAYS)
    jobs.run_days(spark, lake, DAYS[:2])
    jobs.store_active_users(spark, lake, DAYS[:2])
    jobs.run_days(spark, lake, DAYS[1:])
    jobs.store_active_users(spark, lake, DAYS[1:])  # a rerun of a day, and a new one
    seen = {}
    for row in r.sessions.filter(F.col("event_date").isin(DAYS)).select("user_id", "event_date").distinct().collect():
        if row["user_id"] is not None:
            seen.setdefault(row["event_date"], set()).add(row["user_id"])
    got = {x["event_date"]: (x["users_1d"], x["users_7d"]) for x in jobs.active_users_by_day(spark, lake).collect()}
    assert got == {d: (len(seen[d]), len(set().union(*(seen[e] for e in DAYS if e <= d)))) for d in DAYS}
    numbers = lake.read(spark, "user_numbers")
    assert numbers.count() == numbers.select("user_id").distinct().count() == numbers.agg(F.max("number")).first()[0]


def test_days_published_through_the_catalog(spark, tmp_dir):
    lake, r = build_lake(spark, f"{tmp_dir}/lake", DAYS)
    plain, _ = build_lake(spark, f"{tmp_dir}/plain", DAYS)
    database = "published_" + str(abs(hash(tmp_dir)))
    try:
        for run in (DAYS[:2], DAYS[1:]):
            jobs.run_days(spark, lake, run, database=database)
        jobs.run_days(spark, plain, DAYS)
        for table in ("silver_user_sessions", "silver_purchases_enriched", "silver_leaderboard_enriched", "gold_daily_summary"):
            want = plain.read(spark, table)
            assert rows(spark.table(f"{database}.{table}").select(*sorted(want.columns))) == rows(want.select(*sorted(want.columns)))
        with pytest.raises(ValueError):
            jobs.run_days(spark, lake, DAYS, database=database, compact_files=2)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_frozen_scoring_of_changed_users(spark, tmp_dir):
    lake, r = build_lake(spark, tmp_dir, DAYS)
    jobs.run_days(spark, lake, DAYS[:2])
    jobs.run_segmentation(spark, lake, AS_OF, "v1", exact=True)
    jobs.run_frozen_scoring(spark, lake, DAYS[1])
    jobs.run_days(spark, lake, DAYS[2:])
    jobs.run_frozen_scoring(spark, lake, AS_OF, changed_days=DAYS[2:])
    changed = rows(lake.read(spark, "gold_user_demographics"))
    jobs.run_frozen_scoring(spark, lake, AS_OF)
    everybody = lake.read(spark, "gold_user_demographics")
    assert changed == rows(everybody) and len({x["user_segment"] for x in everybody.collect()}) > 1
    jobs.run_scoring(spark, lake, AS_OF)
    assert contract_violations(lake.read(spark, "gold_user_demographics"), "gold_user_demographics_written") == []
    jobs.run_segmentation(spark, lake, AS_OF, "ml")
    with pytest.raises(ValueError, match="whole numbers"):
        jobs.run_frozen_scoring(spark, lake, AS_OF)
