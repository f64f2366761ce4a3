"""The driver contract of ``__spark_entry__``."""

import importlib

from meeple.sources.schemas import contract_violations


def test_entry_runs_flagship(spark):
    mod = importlib.import_module("__spark_entry__")
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "event_date"
    assert contract_violations(df.drop("total_sessions", "unique_active_users"), "gold_daily_summary", allow_extra=False) == [
        "missing column total_sessions",
        "missing column unique_active_users",
    ]


def test_every_oracle_has_a_query():
    mod = importlib.import_module("__spark_entry__")
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    q = set(q) - set(mod.LLM_QUERIES)  # those are tested beside their operators
    rows_only = set(q) - set(o)
    assert rows_only == {
        "kmeans_segments_ml", "scored_segments_ml", "simple_segments_ml", "silhouette_ml", "k_sweep_ml",
    }
