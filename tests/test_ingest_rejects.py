"""Rows that do not fit the contract go to the reject table; none is lost."""

import datetime as dt

import pytest

from meeple.registry import QUERIES
from meeple.sources import ingest
from meeple.sources.adapters import load_raw
from tests.conftest import SF_SMALL

TEXT = "session_id string, user_id string, game_type string, start_time string, end_time string, score string, result string, event_date string"
GOOD = ("s1", None, "Arcade", "2024-01-01 10:00:00", "2024-01-01 10:05:00.25", "7", "win", "2024-01-01")


def row(**changes):
    names = [c.split()[0] for c in TEXT.split(", ")]
    return tuple(changes.get(n, v) for n, v in zip(names, GOOD))


def test_errors_name_the_broken_columns(spark):
    rows = [
        row(), row(session_id="s2", score=" 8 "), row(session_id=None), row(session_id="  "), row(score="ten", start_time="soon"),
        row(event_date="2024-02-30"), row(event_date=None), row(end_time=None), row(score=""), row(score="99999999999"),
    ]
    got = ingest.checked(spark.createDataFrame(rows, TEXT), "raw_game_sessions").collect()
    assert [r["_errors"] for r in got] == [
        [], [], ["session_id"], ["session_id"], ["start_time", "score"], ["event_date"], ["event_date"], [], ["score"], ["score"]
    ]
    assert got[1]["score"] == 8 and got[0]["end_time"] == dt.datetime(2024, 1, 1, 10, 5, 0, 250_000)
    assert got[4]["start_time"] is None and got[4]["_source"]["start_time"] == "soon" and got[4]["end_time"] is not None
    assert got[4]["_source"]["session_id"] == "s1"
    with pytest.raises(ValueError, match="missing"):
        ingest.checked(spark.createDataFrame(rows, TEXT).drop("score"), "raw_game_sessions")


@pytest.mark.parametrize("kind", ["users", "logins", "sessions", "purchases", "leaderboard"])
def test_accepted_and_rejected_are_all_rows(spark, kind):
    good, bad = (QUERIES[f"bronze_{kind}_{x}"](spark, SF_SMALL).count() for x in ("accepted", "rejects"))
    assert good and bad and good + bad == getattr(load_raw(spark, SF_SMALL), kind).count()


def test_append_with_rejects(spark, tmp_dir):
    frame = spark.createDataFrame([row(), row(session_id="s2", score="x"), row(session_id="s3", event_date="2024-01-02")], TEXT)
    for n in (1, 2):
        counts = ingest.append_checked(frame, f"{tmp_dir}/good", f"{tmp_dir}/bad", "raw_game_sessions", ["event_date"])
        assert counts == (2, 1)
        assert spark.read.parquet(f"{tmp_dir}/good").count() == 2 * n
    bad = spark.read.parquet(f"{tmp_dir}/bad").collect()
    assert [(r["session_id"], r["score"], r["errors"]) for r in bad] == [("s2", "x", "score")] * 2
    typed = dict(spark.read.parquet(f"{tmp_dir}/good").dtypes)
    assert typed["score"] == "int" and typed["start_time"] == "timestamp_ntz"
    assert ingest.append_checked(frame.limit(0), f"{tmp_dir}/good", f"{tmp_dir}/bad", "raw_game_sessions", ["event_date"]) == (0, 0)


def test_csv_lines_of_wrong_length(spark, tmp_dir):
    with open(f"{tmp_dir}/x.csv", "w") as f:
        f.write("user_id,game_type,rank,event_date\nu1,Arcade,1,2024-01-01\nu2,Arcade\nu3,Arcade,2,2024-01-01,more\nu4,Arcade,first,2024-01-02\n,Arcade,3,2024-01-01\n")
    rows = ingest.read_csv_checked(spark, f"{tmp_dir}/x.csv", "raw_leaderboard_snapshots")
    good, bad = ingest.accepted(rows).collect(), ingest.rejected(rows).collect()
    assert [tuple(r) for r in good] == [("u1", "Arcade", 1, dt.date(2024, 1, 1))]
    assert {(r["user_id"], r["errors"]) for r in bad} == {("u2", "_line,event_date"), ("u3", "_line"), ("u4", "rank"), (None, "user_id")}
    assert {r["_line"] for r in bad if r["user_id"] == "u3"} == {"u3,Arcade,2,2024-01-01,more"}
