"""Sources, sinks and table maintenance in temporary folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from meeple.operators import tables
from meeple.sources import ingest, readers, schemas
from meeple.sources.adapters import load_raw
from tests.conftest import SF_SMALL

D = dt.date(2024, 3, 1)


def bag(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_every_contract_has_columns():
    for name, schema in schemas.SCHEMAS.items():
        assert len(schema.fields) >= 4, name
    assert [f.name for f in schemas.schema_of("gold_daily_summary").fields][-1] == "peak_hour"
    with pytest.raises(KeyError):
        schemas.schema_of("nope")


def test_conform_and_violations(spark):
    raw = spark.createDataFrame([("u1", "n", "C", "2024-01-02", "33", "Male", "extra")],
                                "user_id string, username string, country string, signup_date string, "
                                "age string, gender string, junk string")
    typed = ingest.typed(raw, "raw_users")
    assert schemas.contract_violations(typed, "raw_users") == []
    assert typed.first()["signup_date"] == dt.date(2024, 1, 2) and typed.first()["age"] == 33
    problems = schemas.contract_violations(raw, "raw_users")
    assert "unexpected column junk" in problems and any(p.startswith("age") for p in problems)
    assert schemas.describe(typed)[4] == ("age", "int")


CSV = {
    "raw_users": ("user_id,username,country,signup_date,age,gender", "u1,ann,Chile,2025-06-05,20,Female", "u2,bob,Iran (Islamic Republic of),2025-06-23,,Other"),
    "raw_logins": ("user_id,timestamp,device_type,location,event_date", "u1,2025-06-22T03:04:05.123456,iOS,Lake Ann,2025-06-22", "u2,2025-06-22 03:04:05,Web,X,2025-06-22"),
    "raw_game_sessions": ("session_id,user_id,game_type,start_time,end_time,score,result,event_date", "s1,u1,Practice,2025-07-10 23:50:00.5,2025-07-11 00:10:00,7,Win,2025-07-10"),
    "raw_purchases": ("purchase_id,user_id,item,amount,timestamp,event_date", "p1,u1,Boost,1.52,2025-07-09 10:00:00,2025-07-09", "p2,u2,Boost,47.73,2025-07-09 11:00:00,2025-07-09"),
    "raw_leaderboard_snapshots": ("user_id,game_type,rank,event_date", "u1,Arcade,1,2025-06-20", "u2,Arcade,20,2025-06-24"),
}


@pytest.mark.parametrize("table", sorted(CSV))
def test_read_csv(spark, tmp_dir, table):
    with open(f"{tmp_dir}/{table}.csv", "w") as f:
        f.write("\n".join(CSV[table]) + "\n")
    df = readers.read_csv(spark, f"{tmp_dir}/{table}.csv", table)
    assert df.count() == len(CSV[table]) - 1
    assert schemas.contract_violations(df, table) == []
    first = df.first()
    if table == "raw_game_sessions":
        assert first["end_time"].date() > first["event_date"] and first["score"] == 7
    if table == "raw_purchases":
        assert round(sum(r["amount"] for r in df.collect()), 2) == 49.25
    if table == "raw_users":
        assert [r["age"] for r in df.collect()] == [20, None]
    if table == "raw_logins":
        assert first["timestamp"].microsecond == 123456 and df.filter("timestamp IS NULL").count() == 0


def test_csv_export_round_trip(spark, tmp_dir):
    users = load_raw(spark, SF_SMALL).users
    path = f"{tmp_dir}/users_csv"
    readers.export_csv(users, path)
    back = readers.read_csv(spark, path, "raw_users")
    assert bag(back) == bag(users)


def test_crm_ingest_by_name_not_position(spark, tmp_dir):
    sessions = load_raw(spark, SF_SMALL).sessions
    exported = ingest.crm_export(sessions)
    shuffled = exported.select(*reversed(exported.columns))  # column order must not matter
    back = ingest.from_crm(shuffled, "raw_game_sessions")
    assert back.columns == [f.name for f in schemas.RAW_GAME_SESSIONS.fields]
    assert bag(back) == bag(sessions)
    path = f"{tmp_dir}/raw_sessions"
    ingest.append(back, path, "raw_game_sessions", partition_by=["event_date"])
    assert spark.read.parquet(path).count() == sessions.count()


def test_partitioned_write_prunes(spark, tmp_dir):
    sessions = load_raw(spark, SF_SMALL).sessions
    path = f"{tmp_dir}/sessions"
    tables.write_partitioned(sessions, path, ["event_date"])
    day_count = readers.day(spark.read.parquet(path), "2024-01-15")
    plan = day_count._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert day_count.count() == readers.day(sessions, "2024-01-15").count()


def test_overwrite_and_overwrite_keeping_schema(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    path = f"{tmp_dir}/t"
    tables.overwrite(df, path)
    tables.overwrite(df.withColumn("z", F.lit(1)), path)
    assert spark.read.parquet(path).columns == ["x", "y", "z"]
    with pytest.raises(ValueError):
        tables.overwrite_keeping_schema(df, path, spark.read.parquet(path).schema)
    with pytest.raises(ValueError):
        tables.overwrite_keeping_schema(df.withColumn("z", F.lit("7")), path, spark.read.parquet(path).schema)
    tables.overwrite_keeping_schema(df.withColumn("z", F.lit(7)), path, spark.read.parquet(path).schema)
    assert spark.read.parquet(path).first()["z"] == 7


def test_add_and_drop_columns(spark, tmp_dir):
    df = spark.createDataFrame([(1, D)], "rank int, date date")
    added = tables.add_columns(df, {"event_date": "date"})
    assert added.first()["event_date"] is None
    dropped = tables.drop_columns(added, "date")
    assert dropped.columns == ["rank", "event_date"]
    path = f"{tmp_dir}/t"
    tables.append(df, path)
    tables.append(tables.add_columns(df, {"event_date": "date"}).withColumn("event_date", F.lit(D)), path)
    merged = spark.read.option("mergeSchema", True).parquet(path)
    assert sorted(str(r["event_date"]) for r in merged.collect()) == ["2024-03-01", "None"]


def test_upsert_updates_inserts_and_rejects_duplicate_keys(spark):
    target = spark.createDataFrame([(D, 1, "a"), (dt.date(2024, 3, 2), 2, "b")], "event_date date, n int, s string")
    source = spark.createDataFrame([(D, 10, "A"), (dt.date(2024, 3, 3), 3, "c")], "event_date date, n int, s string")
    out = sorted((str(r[0]), r[1], r[2]) for r in tables.upsert(target, source, ["event_date"]).collect())
    assert out == [("2024-03-01", 10, "A"), ("2024-03-02", 2, "b"), ("2024-03-03", 3, "c")]
    dup = source.unionByName(source)
    with pytest.raises(Exception, match="share a key"):
        tables.upsert(target, dup, ["event_date"]).collect()
    with pytest.raises(Exception, match="share a key"):
        tables.changes(target, dup, ["event_date"]).collect()


def test_upsert_by_partition_never_reads_target(spark, tmp_dir):
    path = f"{tmp_dir}/gold"
    base = spark.createDataFrame([(D, 1), (dt.date(2024, 3, 2), 2)], "event_date date, n int")
    tables.replace_partitions(base, path)
    tables.replace_partitions(spark.createDataFrame([(D, 10)], "event_date date, n int"), path)
    got = sorted((str(r["event_date"]), r["n"]) for r in spark.read.parquet(path).collect())
    assert got == [("2024-03-01", 10), ("2024-03-02", 2)]


def test_change_feed_replays_to_new_version(spark):
    old = spark.createDataFrame(
        [(1, "a", None), (2, "b", 1.0), (3, "c", 2.0), (4, None, 3.0)], "k int, s string, v double"
    )
    new = spark.createDataFrame(
        [(1, "a", None), (2, "B", 1.0), (4, None, 3.5), (5, "e", 5.0)], "k int, s string, v double"
    )
    feed = tables.changes(old, new, ["k"])
    kinds = sorted((r["k"], r["_change_type"]) for r in feed.collect())
    assert kinds == [(2, "update_postimage"), (2, "update_preimage"), (3, "delete"),
                     (4, "update_postimage"), (4, "update_preimage"), (5, "insert")]
    assert bag(tables.apply_changes(old, feed, ["k"])) == bag(new)


def ranges(spark, path):
    rows = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("user_id").alias("lo"), F.max("user_id").alias("hi"), F.count("*").alias("n"), F.countDistinct("user_id").alias("users")
    ).collect()
    return sorted(rows, key=lambda r: r["lo"])


def test_compacted_files_hold_disjoint_users_with_a_common_prefix(spark, tmp_dir):
    ids = spark.range(8000).select(F.format_string("user_%012d", F.col("id") % 1000).alias("user_id"), F.lit(D).alias("event_date"), "id")
    path = f"{tmp_dir}/t"
    tables.replace_days(tables.compacted(ids, "user_id", 8), path, [D], rebalance=False)
    files = ranges(spark, path)
    assert len(files) == 8 and max(r["users"] for r in files) < 250
    assert all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))
    assert bag(spark.read.parquet(path).select("user_id", "event_date", "id")) == bag(ids)


def test_clustered_keeps_rows(spark):
    users = load_raw(spark, SF_SMALL).users
    assert bag(tables.clustered(users, "signup_date")) == bag(users)


def test_missing_table_path_raises(spark, tmp_dir):
    with pytest.raises(AnalysisException):
        readers.read_table(spark, f"{tmp_dir}/missing").count()


def test_compaction_splits_a_hot_user_over_files(spark, tmp_dir):
    base = spark.range(0, 4000).select(
        F.when(F.col("id") < 3000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("user_id"),
        F.lit(D).alias("event_date"),
        F.col("id"),
    )
    path = f"{tmp_dir}/hot"
    tables.compacted(base, "user_id", num_files=4).write.parquet(path)
    sizes = [r["n"] for r in ranges(spark, path)]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_replace_days_empties_days_without_rows(spark, tmp_dir):
    df = spark.createDataFrame([(1, D), (2, D), (3, dt.date(2024, 3, 2)), (4, dt.date(2024, 3, 3))], "v int, event_date date")
    path = f"{tmp_dir}/t"
    days = [D, dt.date(2024, 3, 2), dt.date(2024, 3, 3)]
    tables.replace_days(df, path, days)
    tables.replace_days(df.filter("v = 2"), path, days[:2])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 4]
    tables.replace_days(df, path, [])
    assert spark.read.parquet(path).count() == 2


def test_staging_deletes_what_it_wrote(spark):
    with tables.staging():
        staged = tables.stage(spark.range(3))
        path = staged.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        assert staged.count() == 3 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_keeping_a_schema_refuses_narrower_types(spark, tmp_dir):
    schema = spark.createDataFrame([], "x int, y bigint").schema
    tables.overwrite_keeping_schema(spark.createDataFrame([(1, 2)], "y int, x int"), f"{tmp_dir}/t", schema)
    assert spark.read.parquet(f"{tmp_dir}/t").first() == (2, 1)
    with pytest.raises(ValueError):
        tables.overwrite_keeping_schema(spark.createDataFrame([(1, 2)], "x bigint, y int"), f"{tmp_dir}/t", schema)


def test_change_feed_across_a_new_column(spark):
    old = spark.createDataFrame([(1, "a")], "k int, s string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 1)], "k int, s string, extra int")
    assert [(r["k"], r["_change_type"]) for r in tables.changes(old, new, ["k"]).collect()] == [(2, "insert")]


def test_columns_of_a_stored_table(spark, tmp_dir):
    spark.createDataFrame([(1, "a", D)], "k int, v string, date date").write.option("path", f"{tmp_dir}/v0").saveAsTable("meeple_columns_test")
    try:
        stored = spark.table("meeple_columns_test")
        tables.rewrite_table(spark, "meeple_columns_test", tables.add_columns(tables.drop_columns(stored, "date"), {"event_date": "date"}), f"{tmp_dir}/v1")
        assert spark.table("meeple_columns_test").columns == ["k", "v", "event_date"]
        assert spark.read.parquet(f"{tmp_dir}/v0").columns == ["k", "v", "date"]
    finally:
        spark.sql("DROP TABLE IF EXISTS meeple_columns_test")


def test_upsert_table_swaps_in_a_new_version(spark, tmp_dir):
    old_path = f"{tmp_dir}/v0"
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.option("path", old_path).saveAsTable(
        "meeple_upsert_test"
    )
    try:
        src = spark.createDataFrame([(1, "A"), (3, "c")], "k int, v string")
        tables.upsert_table(spark, "meeple_upsert_test", src, ["k"], f"{tmp_dir}/v1")
        got = sorted(map(tuple, spark.table("meeple_upsert_test").collect()))
        assert got == [(1, "A"), (2, "b"), (3, "c")]
        assert sorted(map(tuple, spark.read.parquet(old_path).collect())) == [(1, "a"), (2, "b")]
    finally:
        spark.sql("DROP TABLE IF EXISTS meeple_upsert_test")


def test_days_filter_and_lake_exists(spark, tmp_dir):
    from meeple.plans.jobs import Lake

    sessions = load_raw(spark, SF_SMALL).sessions
    two = readers.days(sessions, ["2024-01-10", dt.date(2024, 1, 11)])
    assert {r[0] for r in two.select("event_date").distinct().collect()} <= {dt.date(2024, 1, 10), dt.date(2024, 1, 11)}
    lake = Lake(tmp_dir)
    assert not lake.exists(spark, "raw_users")
    sessions.limit(1).write.parquet(lake.path("raw_users"))
    assert lake.exists(spark, "raw_users")


def test_cluster_settings_size_partitions():
    from meeple.session import cluster_settings

    conf = cluster_settings(100 * 1024**4)  # 100 TB of shuffle
    assert int(conf["spark.sql.shuffle.partitions"]) == 409_600
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_settings(1)["spark.sql.shuffle.partitions"]) == 200
