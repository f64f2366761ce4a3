"""Every registered query against its DuckDB SQL (row count, columns, exact values)."""

import pytest

from meeple.oracle import ORACLE
from meeple.registry import QUERIES
from meeple.testing import compare, duck_connection
from tests.conftest import SF_ORACLE


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    result = compare(name, QUERIES[name](spark, SF_ORACLE), duck, ORACLE[name])
    assert result.ok, result.notes
    assert result.types_match, result.notes


SCALE_PLAN_QUERIES = [
    "silver_user_sessions", "silver_leaderboard_enriched", "daily_summary_backfill", "daily_summary_from_silver",
    "user_demographics", "user_demographics_from_daily", "active_users", "cluster_labels", "upsert_daily",
    "daily_changes", "compacted_sessions", "ranked_players", "hourly_activity", "daily_summary_one_login",
    "silver_purchases_enriched", "segment_profile", "user_categories", "earnings_by_day", "device_usage",
    "clustered_users", "whales_by_country_given_clusters", "silver_user_sessions_one_login",
]


@pytest.fixture()
def scale_plans(spark):
    """The physical plans of a large cluster: no broadcast joins, no adaptive re-planning."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", SCALE_PLAN_QUERIES)
def test_query_matches_oracle_on_cluster_plans(scale_plans, duck, name):
    result = compare(name, QUERIES[name](scale_plans, SF_ORACLE), duck, ORACLE[name])
    assert result.ok, result.notes
