"""Partition folders swapped through the catalog: readers in between, reruns, schema changes."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from meeple.operators import tables, versions

DAYS = [dt.date(2024, 5, d) for d in (1, 2, 3)]


@pytest.fixture()
def daily(spark, tmp_dir):
    name = "swap_" + tmp_dir.rsplit("-", 1)[1].lower().replace("_", "x")
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING, event_date DATE) USING parquet PARTITIONED BY (event_date) LOCATION '{tmp_dir}/{name}'")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, event_date date")


def rows(df):
    return sorted(map(str, df.collect()))


def whole(spark, table):
    return sorted((r["event_date"], r["k"], r["v"]) for r in spark.table(table).collect())


def test_every_step_shows_whole_old_or_new_days(spark, daily):
    old = [(i, "old", d) for d in DAYS for i in range(4)]
    versions.swap_days(spark, daily, frame(spark, old), DAYS)
    assert len(whole(spark, daily)) == 12
    early_reader = spark.table(daily)  # planned before the swap
    early_reader_files = early_reader.inputFiles()
    new = [(i, "new", d) for d in (DAYS[0], DAYS[2]) for i in range(7)]  # the second day becomes empty
    version = versions.fresh_version(versions.location(spark, daily))
    with_rows = versions.write_days(frame(spark, new), DAYS, version)
    assert with_rows == [DAYS[0], DAYS[2]]
    states = [whole(spark, daily)]
    for d in DAYS:
        versions.publish_day(spark, daily, d, version if d in with_rows else None)
        spark.catalog.refreshTable(daily)
        states.append(whole(spark, daily))
    for n, state in enumerate(states):
        for i, d in enumerate(DAYS):
            got = [(k, v) for day, k, v in state if day == d]
            want = [(k, v) for k, v, day in (new if i < n else old) if day == d]
            assert got == sorted(want), (n, d)
    # the old files are still there for a reader that listed them
    assert len(spark.read.parquet(*early_reader_files).collect()) == 12
    assert versions.drop_unused_versions(spark, daily) == 3
    assert whole(spark, daily) == states[-1]


def test_reruns_and_empty_days(spark, daily):
    first = [(1, "a", DAYS[0]), (2, "b", DAYS[1])]
    for _ in range(2):
        versions.swap_days(spark, daily, frame(spark, first), DAYS[:2])
    assert whole(spark, daily) == [(DAYS[0], 1, "a"), (DAYS[1], 2, "b")]
    versions.swap_days(spark, daily, frame(spark, []), DAYS[:1])
    assert whole(spark, daily) == [(DAYS[1], 2, "b")]
    versions.swap_days(spark, daily, frame(spark, []), [DAYS[2]])  # never had rows
    with pytest.raises(ValueError, match="outside"):
        versions.swap_days(spark, daily, frame(spark, [(9, "x", DAYS[2])]), DAYS[:1])
    assert whole(spark, daily) == [(DAYS[1], 2, "b")]
    versions.drop_unused_versions(spark, daily)
    assert whole(spark, daily) == [(DAYS[1], 2, "b")]


def test_a_failed_write_changes_nothing(spark, daily):
    versions.swap_days(spark, daily, frame(spark, [(1, "a", DAYS[0])]), DAYS[:1])
    bad = frame(spark, [(1, "a", DAYS[0])]).withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        versions.swap_days(spark, daily, bad, DAYS[:1])
    assert whole(spark, daily) == [(DAYS[0], 1, "a")]


def test_a_partitioned_table_gains_and_loses_columns(spark, tmp_dir):
    """The leaderboard table: partitioned by game, a day column added, the old date column dropped."""
    spark.sql("DROP TABLE IF EXISTS board")
    spark.sql(f"CREATE TABLE board (user_id STRING, rank INT, date DATE, game_type STRING) USING parquet PARTITIONED BY (game_type) LOCATION '{tmp_dir}/board'")
    old = [("u1", 1, DAYS[0], "Arcade"), ("u2", 2, DAYS[0], "It's a \"game\"")]
    spark.createDataFrame(old, "user_id string, rank int, date date, game_type string").write.insertInto("board")
    try:
        versions.alter_columns(spark, "board", add={"event_date": "date"})
        spark.sql("INSERT INTO board PARTITION (game_type = 'Arcade') SELECT 'u3', 3, DATE '2024-05-01', DATE '2024-05-02'")
        versions.alter_columns(spark, "board", drop=["date"])
        assert spark.table("board").columns == ["user_id", "rank", "event_date", "game_type"]
        want = [("u1", None, "Arcade"), ("u2", None, "It's a \"game\""), ("u3", DAYS[1], "Arcade")]
        got = sorted((r["user_id"], r["event_date"], r["game_type"]) for r in spark.table("board").collect())
        assert got == want  # old and new files under one schema
        with pytest.raises(ValueError, match="rewrite"):
            versions.alter_columns(spark, "board", add={"date": "date"})  # old values would come back
        versions.rewrite(spark, "board")
        assert sorted((r["user_id"], r["event_date"], r["game_type"]) for r in spark.table("board").collect()) == want
        assert "date" not in versions._file_columns(spark, "board")
        versions.alter_columns(spark, "board", add={"date": "string"})
        assert {r["date"] for r in spark.table("board").collect()} == {None}
        for wrong in ({"drop": ["nothing"]}, {"drop": ["game_type"]}, {"add": {"rank": "int"}}):
            with pytest.raises(ValueError):
                versions.alter_columns(spark, "board", **wrong)
        assert len(glob.glob(f"{tmp_dir}/board/*/*.parquet")) >= 3  # the first files stay until dropped
    finally:
        spark.sql("DROP TABLE board")


def test_rewrite_table_takes_partitioned_tables(spark, daily):
    versions.swap_days(spark, daily, frame(spark, [(i, "a", d) for d in DAYS for i in range(3)]), DAYS)
    changed = tables.drop_columns(tables.add_columns(spark.table(daily).filter("event_date > '2024-05-01'"), {"w": "double"}), "v")
    tables.rewrite_table(spark, daily, changed)
    assert spark.table(daily).columns == ["k", "w", "event_date"]
    assert rows(spark.table(daily).select("k", "event_date")) == rows(frame(spark, [(i, "a", d) for d in DAYS[1:] for i in range(3)]).select("k", "event_date"))
    assert len(versions.partitions(spark, daily)) == 2
